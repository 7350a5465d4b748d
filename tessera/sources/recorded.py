"""Recorded pages as a data source: root/<source_id>/<page>.json, one JSON object {url, body} each.

Every page file is a partition of its own, listed on the driver by name alone. Filters on source_id and page are pushed
down, so other sources' files are neither opened nor planned for; `max_pages` ends each source's walk.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import pages as S

FORMAT = "tessera_pages"
PAGES = "source_id string, page bigint, url string, body string"


@dataclass(frozen=True)
class Limits:
    """How far a crawl goes; what it may be told beforehand."""

    max_pages: int = 1000
    max_records: int = 100_000
    detail_top: int = 500
    include_deleted: bool = False
    updated_since: str | None = None

    @classmethod
    def of(cls, options: dict[str, str]) -> Limits:
        known = {f.name: f for f in fields(cls)}
        if wrong := sorted(set(options) - set(known)):
            raise ValueError(f"unknown limits {wrong}")
        return cls(**{k: v if k == "updated_since" else str(v).lower() == "true" if k == "include_deleted" else int(v) for k, v in options.items()})


def _data_source():
    """The source, as a class that travels with the tasks."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

    class Page(InputPartition):
        def __init__(self, source: str, page: int, path: str):
            self.source, self.page, self.path = source, page, path

    def opened(root: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(root)

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.root, self.most, self.tests = options["path"], int(options.get("max_pages", "1000")), []

        def pushFilters(self, filters):
            compare = {EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}
            for f in filters:
                column = f.attribute[0] if len(f.attribute) == 1 else ""
                if type(f) in compare and column in ("source_id", "page"):
                    self.tests.append((column, compare[type(f)], f.value))
                yield f  # Spark looks again at what is read

        def partitions(self):
            from pyarrow import fs

            files, base = opened(self.root)
            out = []
            for folder in sorted(files.get_file_info(fs.FileSelector(base)), key=lambda x: x.base_name):
                if folder.type != fs.FileType.Directory or not all(test(folder.base_name, value) for column, test, value in self.tests if column == "source_id"):
                    continue
                found = sorted((int(x.base_name[:-5]), x.path) for x in files.get_file_info(fs.FileSelector(folder.path)) if x.base_name.endswith(".json") and x.base_name[:-5].isdigit())
                out += [Page(folder.base_name, n, p) for n, p in found[: self.most] if all(test(n, value) for column, test, value in self.tests if column == "page")]
            return out or [Page("", 0, "")]

        def read(self, partition):
            import json

            if not partition.path:
                return
            with opened(self.root)[0].open_input_stream(partition.path) as f:
                held = json.loads(f.read())
            yield partition.source, partition.page, held.get("url"), json.dumps(held.get("body"))

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tessera_pages"

        def schema(self):
            return "source_id string, page bigint, url string, body string"

        def reader(self, schema):
            return Reader(self.options)

    return Pages


def pages(spark: SparkSession, root: str, max_pages: int = 1000) -> DataFrame:
    """(source_id, page, url, payload) of the pages below root."""
    spark.dataSource.register(_data_source())
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    read = spark.read.format(FORMAT).option("path", root).option("max_pages", max_pages).load()
    return read.select("source_id", "page", "url", F.try_parse_json("body").alias("payload"))


def _registry(p: DataFrame, more, limits: Limits) -> DataFrame:
    return S.registry_records(p, limits.include_deleted, limits.updated_since, most=limits.max_records)


def _smithery(p: DataFrame, more, limits: Limits) -> DataFrame:
    return S.smithery_records(p, more("smithery-details"), limits.detail_top, most=limits.max_records)


#: Sources in the order of a run: from their pages to their records.
SOURCES: dict[str, Callable] = {
    "registry": _registry, "smithery": _smithery, "npm": lambda p, more, limits: S.npm_records(p, limits.max_records), "github_topics": lambda p, more, limits: S.topic_records(p, limits.max_records),
}


def crawl(spark: SparkSession, root: str, source_id: str, **options) -> DataFrame:
    """(source_id, upstream_id, url, payload) of one source's recorded pages; an unknown source is a KeyError."""
    read, limits = SOURCES[source_id], Limits.of(options)
    of = lambda folder: pages(spark, root, limits.max_pages).where(F.col("source_id") == folder).drop("source_id")  # noqa: E731  a scan of its own each
    return read(of(source_id), of, limits)


def crawl_all(spark: SparkSession, root: str, **options) -> DataFrame:
    """The records of all sources, in one table."""
    out = None
    for source_id in SOURCES:
        one = crawl(spark, root, source_id, **options)
        out = one if out is None else out.unionByName(one)
    return out
