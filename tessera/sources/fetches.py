"""Recorded crawls: one JSON document per upstream source, scanned into one row per upstream record."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCH = "source_id string, url string, sha256 string, entry_count bigint, page_count bigint, records array<struct<source_id: string, upstream_id: string, url: string, payload: variant>>"


def fetches(spark: SparkSession, at: str) -> DataFrame:
    """The headers and records of every *.json below a directory, by source id; none at all is an error."""
    found = spark.read.schema(FETCH).option("multiLine", True).option("pathGlobFilter", "*.json").json(at)
    if found.isEmpty():
        raise ValueError(f"no recorded crawl in {at}")
    return found.orderBy("source_id")


def records(fetched: DataFrame) -> DataFrame:
    """(source_id, upstream_id, url, payload), the payload as a VARIANT."""
    return fetched.select(F.explode("records").alias("r")).select("r.source_id", "r.upstream_id", "r.url", "r.payload")


def lock(fetched: DataFrame, at: str) -> DataFrame:
    """Statistics of each source's crawl, with the time given from outside."""
    return fetched.select("source_id", "url", "sha256", "entry_count", "page_count", F.lit(at).alias("fetched_at")).orderBy("source_id")


def render_lock(fetched: DataFrame, at: str) -> str:
    """The lock as text: a row for each source, of which there are a handful, in order, with the given time."""
    rows = [r.asDict() for r in lock(fetched, at).collect()]
    return json.dumps({"sources": rows}, indent=2, sort_keys=True, ensure_ascii=False) + "\n"


def read_lock(spark: SparkSession, at: str) -> DataFrame:
    """(source_id, entry_count) of a lock; one that isn't there has none."""
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(at)
    if files.get_file_info(base).type == fs.FileType.NotFound:
        return spark.createDataFrame([], "source_id string, entry_count bigint")
    return spark.read.schema("sources array<struct<source_id: string, entry_count: bigint>>").option("multiLine", True).json(at).select(F.explode("sources").alias("s")).select("s.source_id", "s.entry_count")
