import json

from test_projections import OFFICIAL

from tessera.streaming import crawls


def item(name, status, text, at=None):
    return {"server": {"name": name, "description": text}, "_meta": {OFFICIAL: {"status": status} | ({"updatedAt": at} if at else {})}}


class Crawl:
    def __init__(self, spark, at):
        self.spark, self.at = spark, at
        (at / "in").mkdir()

    def arrive(self, page, *items, name=None):
        (self.at / "in" / f"{name or page}.json").write_text(json.dumps({"page": page, "url": "u", "body": json.dumps({"servers": items})}) + "\n")

    def run(self, **options):
        query = crawls.follow(crawls.pages(self.spark, str(self.at / "in")), f"{self.at}/t", f"{self.at}/c", **options)
        assert query.awaitTermination(120)
        return query

    def records(self):
        return {r.upstream_id: (r.page, json.loads(r.payload)["server"]["description"]) for r in crawls.current(self.spark, f"{self.at}/t").collect()}

    def log(self):
        return self.spark.read.parquet(f"{self.at}/t").count()


def test_incremental_crawl(spark, tmp_path):
    c = Crawl(spark, tmp_path)
    c.arrive(1, item("a", "active", "one"), item("b", "active", "one"), item("a", "active", "again"))
    c.run()
    assert c.records() == {"a": (1, "one"), "b": (1, "one")}
    c.arrive(3, item("a", "active", "three"), item("b", "deleted", ""), item("c", "active", "new"))
    query = c.run()
    assert c.records() == {"a": (3, "three"), "c": (3, "new")} and c.log() == 5
    assert query.lastProgress["numInputRows"] == 1  # a batch reads its own pages alone
    # Late and repeated pages, and a page twice: nothing comes back.
    c.arrive(2, item("a", "active", "two"), item("b", "active", "two"), item("d", "active", "late"))
    c.arrive(3, item("a", "active", "three"), item("b", "deleted", ""), item("c", "active", "new"), name="3-again")
    c.run()
    assert c.records() == {"a": (3, "three"), "c": (3, "new"), "d": (2, "late")} and c.log() == 6
    c.run()  # a restart with nothing new
    assert c.log() == 6


def test_a_restart_after_a_lost_batch_repeats_nothing(spark, tmp_path):
    c = Crawl(spark, tmp_path)
    c.arrive(1, item("a", "active", "one"))
    c.run()
    c.arrive(2, item("a", "active", "two"), item("b", "active", "two"))
    c.run()
    before = c.records()
    # The driver was lost before it could say that the batch is done: the batch runs again.
    for name in ("1", ".1.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    c.run()
    assert c.records() == before == {"a": (2, "two"), "b": (2, "two")} and c.log() == 3


def test_a_window_of_time(spark, tmp_path):
    c = Crawl(spark, tmp_path)
    c.arrive(1, item("old", "active", "x", "2025-12-31T23:59:59Z"), item("new", "active", "x", "2026-01-01T00:00:00Z"), item("gone", "deleted", "", "2026-02-01T00:00:00.5Z"), item("silent", "active", "x"))
    c.run(updated_since="2026-01-01T00:00:00Z")
    assert set(c.records()) == {"new", "silent"} and c.log() == 3
