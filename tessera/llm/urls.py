"""URL filter: host and path rules first, then a list of blocked URLs behind a blocked Bloom filter.

Each list entry and each page is turned into canonical keys; a page's keys are its canonical URL, the same without
query, and those host suffixes that have as many labels as some entry that names a host. The filter is built in
Spark: each entry sets one bit in each of the eight words of one 512-bit block, and blocks are merged by bit_or.
Its size is at most MAX_BLOCKS whatever the list's, so it can be broadcast; a longer list only lets more false
positives through, and these are removed by an exact join of the possible hits with the list.

Defined results: a null url or one without "://" has empty host and path and is allowed unless "" is listed, which
it can't be; blank list entries are passed over; a page row gives one row, repeated or not.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep, made, pick, ship, small_batches, table

#: (verdict, host, path); a rule fits its host and all subdomains, and paths that start with its own.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: The list that the query is run with: hosts, with all their pages.
LISTED = ("casino-win.example.com/", "free-bets.example.com/", "cheap-pills.example.com/", "ads-track.example.com/", "spam-farm.example.com/", "adult-x.example.net/")
MAX_BLOCKS, BITS_PER_ENTRY = 1 << 16, 16
_LOWER = {c: c + 32 for c in range(65, 91)}
_TRACKING = re.compile(r"(?:utm_\w*|gclid|fbclid|ref)(?:=|$)")


def host_path(url: str | None) -> tuple[str, str, str]:
    """Host, path and query, as the rules take them."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", ""
    rest = rest.partition("#")[0]
    rest, _, query = rest.partition("?")
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path, query


def plain_host(host: str) -> str:
    """Without user, port and final dots."""
    host = host.rpartition("@")[2]
    name, colon, port = host.rpartition(":")
    return (name if colon and (not port or port.isascii() and port.isdigit()) else host).rstrip(".")


def canonical(host: str, path: str, query: str) -> str:
    kept = sorted(x for x in query.split("&") if x and not _TRACKING.match(x))
    return plain_host(host) + (path.rstrip("/") or "/") + ("?" + "&".join(kept) if kept else "")


def entry_key(entry: str | None) -> str:
    """The canonical key of a list entry: a URL, with or without scheme."""
    entry = (entry or "").strip()
    if not entry:
        return ""
    return canonical(*host_path(entry if "://" in entry else f"x://{entry}"))


def page_keys(host: str, path: str, query: str, labels: tuple[int, ...]) -> list[str]:
    name = plain_host(host)
    if not name:
        return []
    parts = name.split(".")
    keys = [canonical(host, path, query), canonical(host, path, "")]
    keys += [".".join(parts[-n:]) + "/" for n in labels if n <= len(parts)]
    return list(dict.fromkeys(keys))


def rule_of(host: str, path: str, rules=RULES) -> tuple[str | None, str | None]:
    """The longest rule that fits, and its verdict; of equals, the one with the longer host, then a block."""
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return (best[3], best[4]) if best else (None, None)


def _bits(key: str, blocks: int) -> tuple[int, np.ndarray]:
    h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"))
    at = (h >> 64) % blocks
    return at, np.array([(h >> (6 * i)) & 63 for i in range(8)], np.uint64)


def bloom(listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> np.ndarray:
    """The filter over listed.key, as blocks of eight words; it fits max_blocks * 64 bytes."""
    blocks = min(max_blocks, max(1, listed.count() * BITS_PER_ENTRY // 512 + 1))
    schema = pa.schema([("block", pa.int64()), *[(f"w{i}", pa.int64()) for i in range(8)]])

    def run(batches):
        for b in small_batches(batches, 65536):
            each = [_bits(k, blocks) for k in b.column("key").to_pylist()]
            words = (np.uint64(1) << np.array([x for _, x in each], np.uint64).reshape(-1, 8)).view(np.int64)
            yield made({"block": [x for x, _ in each], **{f"w{i}": words[:, i] for i in range(8)}}, schema)

    rows = listed.select("key").mapInArrow(run, "block bigint, " + ", ".join(f"w{i} bigint" for i in range(8)))
    out = np.zeros((blocks, 8), np.int64)
    for r in rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)]).toLocalIterator():
        out[r[0]] = r[1:]
    return out.view(np.uint64)


def list_keys(listed: DataFrame) -> DataFrame:
    """(key), distinct, from listed.url."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([entry_key(u) for u in b.column("url").to_pylist()], pa.string())], names=["key"])

    return pick(listed, {"url": "string"}).mapInArrow(run, "key string").where("key <> ''").distinct()


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Each page row's page_id, url, host, path, rule, verdict and, where the list decides, listed_key."""
    spark = pages.sparkSession
    ship(spark)
    keys = list_keys(listed)
    roots = keys.where(F.expr("key like '%/' and locate('/', key) = length(key)"))
    labels = tuple(sorted(r[0] for r in roots.select(F.size(F.split("key", "[.]"))).distinct().collect()))
    blocks = spark.sparkContext.broadcast(bloom(keys, max_blocks))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("possible", pa.list_(pa.string()))])

    def passes(key: str) -> bool:
        at, bits = _bits(key, len(blocks.value))
        return bool(((blocks.value[at] >> bits) & np.uint64(1)).all())

    def run(batches):
        for b in small_batches(batches, 4096):
            out = []
            for page_id, url in zip(b.column("page_id").to_pylist(), b.column("url").to_pylist(), strict=True):
                host, path, query = host_path(url)
                rule, verdict = rule_of(host, path, rules)
                possible = [k for k in page_keys(host, path, query, labels) if passes(k)] if rule is None else []
                out.append((page_id, url, host, path, rule, verdict, possible))
            yield made(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)

    seen = pick(pages, {"page_id": "bigint", "url": "string"}).mapInArrow(run, "page_id bigint, url string, host string, path string, rule string, verdict string, possible array<string>")
    seen = keep(seen, "seen")  # both branches read it, so that pages are scanned and parsed once
    columns = ["page_id", "url", "host", "path", "rule"]
    clear = seen.where("size(possible) = 0").select(*columns, F.coalesce("verdict", F.lit("allow")).alias("verdict"), F.lit(None).cast("string").alias("listed_key"))
    maybe = seen.where("size(possible) > 0").withColumn("row", F.monotonically_increasing_id()).withColumn("want", F.explode("possible"))
    exact = maybe.join(keys, maybe["want"] == keys["key"], "left").groupBy("row", *columns).agg(F.min("key").alias("listed_key"))
    hits = exact.select(*columns, F.when(F.col("listed_key").isNotNull(), "block").otherwise("allow").alias("verdict"), "listed_key")
    return clear.unionByName(hits)


def query(spark, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(x,) for x in LISTED], "url string")
    return filter_urls(table(spark, sf_dir, "pages"), listed).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]+$', '') AS plain
  FROM parts
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN regexp_matches(coalesce(plain, ''), '(^|[.])(casino-win[.]example[.]com|free-bets[.]example[.]com|cheap-pills[.]example[.]com|ads-track[.]example[.]com|spam-farm[.]example[.]com|adult-x[.]example[.]net)$') THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled
"""
