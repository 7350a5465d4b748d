"""Published shards: 256 files of sorted JSON lines a kind, named by the first two hex digits of the key's hash.

Publication is a two-phase commit. Tasks stage files below the root, in a folder of this publication; the commit, which
knows the files of all tasks, puts down a journal of what is to move where. Before the journal is there, nothing published
has changed, so a task or driver that is lost leaves the catalog as it was; once it is there, `recover` carries it out,
as often as it is interrupted. Both kinds and the files that go with them (the lock, the schema) are one publication.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import constraints as V
from tessera.operators.catalog import shard
from tessera.shared import keep

FORMAT, JOURNAL, STAGING = "tessera_shards", ".publication", ".staging-"


def _opened(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _end(files, base: str) -> None:
    """Do what the journal says, wherever it stopped, and delete it with its staging folder."""
    from pyarrow import fs

    there = lambda p: files.get_file_info(p).type == fs.FileType.File
    with files.open_input_stream(f"{base}/{JOURNAL}") as f:
        journal = json.loads(f.read())
    for staged, target in journal["moves"]:
        if there(f"{base}/{staged}"):
            files.create_dir(f"{base}/{target}".rpartition("/")[0], recursive=True)
            if there(f"{base}/{target}") and files.type_name != "local":
                files.delete_file(f"{base}/{target}")  # only a local move replaces
            files.move(f"{base}/{staged}", f"{base}/{target}")
    if files.get_file_info(f"{base}/{journal['staging']}").type == fs.FileType.Directory:
        files.delete_dir(f"{base}/{journal['staging']}")
    files.delete_file(f"{base}/{JOURNAL}")


def recover(root: str) -> bool:
    """End a publication whose commit was interrupted; whether there was one. Staged files without a journal go."""
    from pyarrow import fs

    files, base = _opened(root)
    if files.get_file_info(base).type == fs.FileType.NotFound:
        return False
    begun = files.get_file_info(f"{base}/{JOURNAL}").type == fs.FileType.File
    if begun:
        _end(files, base)
    for x in files.get_file_info(fs.FileSelector(base)):
        if x.base_name.startswith(STAGING):
            files.delete_dir(x.path)
    return begun


def _data_source():
    """The sink, as a class that travels with the tasks: executors needn't have this package."""
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    journal, prefix = JOURNAL, STAGING

    def opened(root: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(root)

    class Staged(WriterCommitMessage):
        def __init__(self, files: list):
            self.files = files

    class Writer(DataSourceArrowWriter):
        def __init__(self, options: dict):
            self.root, self.token, self.beside, self.shards = options["root"], options["token"], json.loads(options["beside"]), json.loads(options["shards"])

        def write(self, iterator):
            from pyspark import TaskContext

            files, base = opened(self.root)
            staging, attempt = f"{prefix}{self.token}", TaskContext.get().taskAttemptId()
            files.create_dir(f"{base}/{staging}", recursive=True)
            done, at, out = [], None, None
            for b in iterator:
                for kind, s, line in zip(*(b.column(c).to_pylist() for c in ("kind", "shard", "line")), strict=True):
                    if (kind, s) != at:
                        if out:
                            out.close()
                        at, name = (kind, s), f"{staging}/{kind}-{s}-{attempt}"
                        out = files.open_output_stream(f"{base}/{name}")
                        done.append((kind, s, name))
                    if line is not None:
                        out.write(line.encode() + b"\n")
            if out:
                out.close()
            return Staged(done)

        def commit(self, messages):
            files, base = opened(self.root)
            staged = [f for m in messages if m is not None for f in m.files]
            if sorted(f[:2] for f in staged) != sorted(map(tuple, self.shards)):
                raise ValueError("a publication stages every shard once")
            moves = [(name, f"{kind}/{s}.jsonl") for kind, s, name in sorted(staged)]
            for i, (name, text) in enumerate(sorted(self.beside.items())):
                at = f"{prefix}{self.token}/beside-{i}"
                with files.open_output_stream(f"{base}/{at}") as f:
                    f.write(text.encode())
                moves.append((at, name))
            with files.open_output_stream(f"{base}/{prefix}{self.token}/journal") as f:
                f.write(json.dumps({"staging": f"{prefix}{self.token}", "moves": moves}).encode())
            files.move(f"{base}/{prefix}{self.token}/journal", f"{base}/{journal}")

        def abort(self, messages):
            from pyarrow import fs

            files, base = opened(self.root)
            if files.get_file_info(f"{base}/{journal}").type == fs.FileType.NotFound and files.get_file_info(f"{base}/{prefix}{self.token}").type == fs.FileType.Directory:
                files.delete_dir(f"{base}/{prefix}{self.token}")

    class Publication(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tessera_shards"

        def writer(self, schema, overwrite):
            return Writer(self.options)

    return Publication


def publish(lines: DataFrame, root: str, beside: dict[str, str] | None = None, kinds: tuple[str, ...] = V.KINDS) -> dict[str, int]:
    """Publish (key, kind, line) below root, every shard of every kind, empty ones with no bytes, and `beside` them texts by
    file name, all or none; how many lines each kind has."""
    spark = lines.sparkSession
    recover(root)
    spark.dataSource.register(_data_source())
    held = lines.select("kind", shard(F.col("key")).alias("shard"), F.col("key").cast("string").alias("key"), "line")
    spine = spark.range(256).select(F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"), F.lpad(F.lower(F.hex("id")), 2, "0").alias("shard"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("line"))
    dealt = held.unionByName(spine).repartition("kind", "shard").sortWithinPartitions("kind", "shard", F.col("key").asc_nulls_first())
    shards = json.dumps([(k, f"{i:02x}") for k in kinds for i in range(256)])
    dealt.select("kind", "shard", "line").write.format(FORMAT).option("root", root).option("token", uuid.uuid4().hex).option("beside", json.dumps(beside or {})).option("shards", shards).mode("append").save()
    recover(root)
    counted = scan_shards(spark, root, kinds[0])
    for k in kinds[1:]:
        counted = counted.union(scan_shards(spark, root, k))
    return dict.fromkeys(kinds, 0) | {r.kind: r["count"] for r in counted.groupBy("kind").count().collect()}


def scan_shards(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """(shard, line, key, kind) of the published lines of a kind, its folder's; a folder that isn't there has none."""
    from pyarrow import fs

    files, base = _opened(root)
    if files.get_file_info(f"{base}/{kind}").type == fs.FileType.NotFound:
        return spark.createDataFrame([], "shard string, line string, key string, kind string")
    lines = spark.read.text(f"{root}/{kind}", pathGlobFilter="*.jsonl", lineSep="\n").select(F.regexp_extract(F.input_file_name(), "([0-9a-f]{2})[.]jsonl$", 1).alias("shard"), F.col("value").alias("line"))
    return lines.withColumns({"key": F.get_json_object("line", "$.canonical_key"), "kind": F.lit(kind)})


def missing(spark: SparkSession, root: str, kinds: tuple[str, ...] = V.KINDS) -> DataFrame:
    """(violation, key) of shard files that aren't there, of kinds that have any."""
    from pyarrow import fs

    files, base = _opened(root)
    found = [(k, x.base_name.removesuffix(".jsonl")) for k in kinds for x in files.get_file_info(fs.FileSelector(f"{base}/{k}", allow_not_found=True)) if x.base_name.endswith(".jsonl")]
    listing = spark.createDataFrame(found, "kind string, shard string")
    names = spark.range(256).select(F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"), F.lpad(F.lower(F.hex("id")), 2, "0").alias("shard"))
    built = names.join(listing.select("kind").distinct(), "kind", "left_semi")
    return built.join(listing, ["kind", "shard"], "left_anti").select(F.lit("missing shard").alias("violation"), F.concat_ws("/", "kind", "shard").alias("key"))


def violations(scanned: DataFrame, kind: str) -> DataFrame:
    """(violation, key): lines that are blank, no entry, of another kind, in a wrong shard or not as an entry is
    rendered (keys in order, no spaces, no carriage return), and keys that occur twice."""
    # A VARIANT's keys are in order; of its whole numbers it doesn't know whether they were written with a point.
    whole = lambda text: F.regexp_replace(text, r'("popularity":[0-9]+)\.0(?=[,}])', "$1")
    rendered = F.to_json(F.try_parse_json("line"))
    wrong = (
        F.when(F.trim("line") == "", "blank line")
        .when(F.col("key").isNull(), "not an entry")
        .when(~F.startswith("key", F.lit(f"{kind}:")), "wrong kind")
        .when(F.col("shard") != shard(F.col("key")), "wrong shard")
        .when(F.col("line").contains("\r") | (whole(F.coalesce(rendered, F.lit(""))) != whole(F.col("line"))), "not canonical")
    )
    found = scanned.select(F.explode_outer(F.array(wrong)).alias("violation"), "key").where("violation IS NOT NULL")  # asked once, not as a filter too
    return found.union(repeated(scanned))


def repeated(scanned: DataFrame) -> DataFrame:
    """(violation, key) of keys that occur more than once."""
    return scanned.groupBy("key").count().where("count > 1 AND key IS NOT NULL").select(F.lit("repeated key").alias("violation"), "key")


def unsound(scanned: DataFrame, kind: str) -> DataFrame:
    """(violation, key) of lines that don't read back strictly as an entry of the kind, or whose entry doesn't hold."""
    checked = keep(V.checked_lines(scanned.where("key IS NOT NULL AND trim(line) <> ''"), kind).select("key", "line", "faults"), "checked")
    faults = checked.select("key", F.explode("faults").alias("violation"))
    # The faultless as one-row tables, so that each is read once and not for every field; a plain explode would ask twice.
    entries = checked.where("size(faults) = 0").select(F.col("key").alias("_key"), F.inline_outer(F.array(F.from_json("line", V.entry_type(kind)))))
    invalid = entries.select(F.col("_key").alias("key"), F.explode_outer(V.violations(entries)).alias("v")).where("v IS NOT NULL").select("key", F.concat(F.lit("invalid "), "v").alias("violation"))
    return faults.unionByName(invalid).select("violation", "key")
