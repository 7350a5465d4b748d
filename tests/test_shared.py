from tessera.shared import qualified


def test_paths_without_a_scheme_lie_in_the_default_file_system(spark):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.apart.link./in", "file:///tmp")
    try:
        assert qualified(spark, "/tmp/x") == "file:///tmp/x" == qualified(spark, "file:/tmp/x") == qualified(spark, "file:///tmp/x")
        conf.set("fs.defaultFS", "viewfs://apart")
        assert qualified(spark, "/in/x") == "viewfs://apart/in/x" and qualified(spark, "file:///tmp/x") == "file:///tmp/x"
    finally:
        conf.set("fs.defaultFS", before)
