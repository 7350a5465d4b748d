"""Incremental crawls as a stream: recorded pages arrive as files, and keyed state decides what they change.

For each upstream id the state holds the page and place of what is known, a tombstone included. A batch costs what it
brings: a record from a later page, or earlier on the same one, replaces what is held; late and repeated pages change
nothing, and an old page can't bring back what a later one removed. What changes goes to a log, a Parquet
sink that commits each batch once, so a restart after a loss repeats nothing; `current` is what the log comes to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.sources.pages import registry_items, status_of

PAGE = "page bigint, url string, body string"
CHANGE = "upstream_id string, page bigint, pos int, url string, payload string, gone boolean"
STATE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def pages(spark: SparkSession, at: str, files_a_batch: int | None = None) -> DataFrame:
    """A stream of recorded pages, one JSON object {page, url, body} a line; body is the page as text."""
    reader = spark.readStream.schema(PAGE)
    reader = reader if files_a_batch is None else reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.json(at).select("page", "url", F.try_parse_json("body").alias("payload"))


def _processor():
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Latest(StatefulProcessor):
        """Keeps the latest record of a key, and passes on what replaces it."""

        def init(self, handle) -> None:
            self.held = handle.getValueState("held", "page bigint, pos int")

        def handleInputRows(self, key, rows, timerValues):
            known = self.held.get() if self.held.exists() else None
            at, best = (known[0], -known[1]) if known is not None else None, None
            for r in rows:
                if at is None or (r.page, -r.pos) > at:
                    at, best = (r.page, -r.pos), r
            if best is not None:
                self.held.update((best.page, best.pos))
                yield Row(upstream_id=key[0], page=best.page, pos=best.pos, url=best.url, payload=best.payload, gone=best.gone)

        def close(self) -> None:
            pass

    return Latest()


def changes(stream: DataFrame, updated_since: str | None = None) -> DataFrame:
    """A stream of changes (upstream_id, page, pos, url, payload, gone) from a stream of registry pages, tombstones among
    them; updated_since narrows it to what changed from then on."""
    items = registry_items(stream, include_deleted=True, updated_since=updated_since)
    rows = items.select("upstream_id", "page", F.col("pos").cast("int").alias("pos"), "url", F.to_json("payload").alias("payload"), (status_of(F.col("payload")) == "deleted").alias("gone"))
    return rows.groupBy("upstream_id").transformWithState(statefulProcessor=_processor(), outputStructType=CHANGE, outputMode="Append", timeMode="None")


def follow(stream: DataFrame, table: str, checkpoint: str, updated_since: str | None = None) -> StreamingQuery:
    """Run the stream over what is there, and add what it changes to the log below table."""
    spark = stream.sparkSession
    before = spark.conf.get(STATE, None)
    spark.conf.set(STATE, ROCKSDB)  # what keyed state needs; a query keeps the setting that it starts with
    try:
        return changes(stream, updated_since).writeStream.format("parquet").outputMode("append").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(STATE) if before is None else spark.conf.set(STATE, before)


def current(spark: SparkSession, table: str) -> DataFrame:
    """(upstream_id, page, url, payload) of the records that the log comes to: each id's latest change, unless it removed it."""
    log = spark.read.schema(CHANGE).parquet(table)
    last = log.groupBy("upstream_id").agg(F.max_by(F.struct("page", "url", "payload", "gone"), F.struct(F.col("page").alias("p"), (-F.col("pos")).alias("q"))).alias("x"))
    return last.where("NOT x.gone").select("upstream_id", "x.page", "x.url", "x.payload")
