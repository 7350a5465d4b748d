"""Commands on folders, as URIs: build and publish, verify, export, compare, count. `python -m tessera.commands -h`.

Exit codes: 0 done; 1 a violation; 2 a wrong call; 3 the gate refuses; 4 the build fails.
"""

from __future__ import annotations

import argparse
import json
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import catalog as C
from tessera.operators import constraints as V
from tessera.operators import curation as U
from tessera.operators import entries as E
from tessera.operators import projections as P
from tessera.sources import fetches, overlays, shards

KINDS = V.KINDS
DONE, VIOLATED, WRONG_CALL, REFUSED, FAILED = range(5)
LOCK, SCHEMA = "sources.lock", "schema/catalog.schema.json"


def lines(made: DataFrame) -> DataFrame:
    """(key, kind, line) of entries: a kind's lines hold its own fields, defaults written out."""
    each = []
    for kind in KINDS:
        own = made.where(F.col("kind") == kind)
        own = own.select(*[c.alias(n) for n, c in V.columns(own, kind).items()])
        each.append(own.select(F.col("canonical_key").alias("key"), F.lit(kind).alias("kind"), E.canonical_line({f.name: own.schema[f.name].dataType for f in V.ENTRIES[kind]}).alias("line")))
    return reduce(DataFrame.union, each)


def build(spark: SparkSession, crawl: str, out: str, at: str, check_gate: bool = True, overlay: str | None = None, dry: bool = False) -> dict:
    """Recorded crawls to published shards: kinds pass their gates first, then sources mustn't have collapsed, and
    nothing is written unless all do. overlay: a folder of mcp.yaml, skills.yaml and denylist.yaml."""
    shards.recover(out)
    fetched = fetches.fetches(spark, crawl)
    overrides, denials = overlays.folder(spark, overlay) if overlay else (None, None)
    made, bad = E.build(P.project(fetches.records(fetched)), overrides=overrides, denials=denials)
    ready = E.keep(lines(made), "lines")
    report = {"bad": bad.count(), "kinds": {}}
    if denials is not None:
        keys = [r.key for r in denials.select("key").collect()]
        known = U.located(made, keys) if keys else {}
        report["denied"] = len(keys)
        report["still there"] = sorted(known)  # none, unless a denial didn't take
    for kind in KINDS:
        one = C.gate(C.diff(shards.scan_shards(spark, out, kind).select("key", "line"), ready.where(F.col("kind") == kind).select("key", "line"))).first()
        report["kinds"][kind] = one.asDict()
        if check_gate and not one.passes:
            return report | {"refused": kind}
    counts = lambda df: df.select("source_id", F.col("entry_count").alias("n")).withColumnRenamed("source_id", "source")
    gone = C.collapsed_sources(counts(fetches.read_lock(spark, f"{out}/{LOCK}")), counts(fetched)).collect()
    if check_gate and gone:
        return report | {"refused": sorted(r.source for r in gone)}
    if not dry:
        for kind, n in shards.publish(ready, out, {LOCK: fetches.render_lock(fetched, at), SCHEMA: V.json_schema()}).items():
            report["kinds"][kind]["written"] = n
    return report


def _scanned(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {kind: shards.scan_shards(spark, root, kind) for kind in KINDS}


def _text(uri: str) -> str | None:
    from pyarrow import fs

    files, at = fs.FileSystem.from_uri(uri)
    if files.get_file_info(at).type != fs.FileType.File:
        return None
    with files.open_input_stream(at) as f:
        return f.read().decode()


def verify(spark: SparkSession, root: str) -> dict[str, int]:
    """How often each violation occurs: files that are missing, lines that aren't canonical or don't read back, entries that
    don't hold, keys that occur twice in either kind, a schema that isn't the generated one."""
    scanned = _scanned(spark, root)
    found = [shards.missing(spark, root)]
    for kind, one in scanned.items():
        found += [shards.violations(one, kind).where("violation <> 'repeated key'"), shards.unsound(one, kind)]
    found.append(shards.repeated(reduce(DataFrame.union, scanned.values())))
    said = {r.violation: r["count"] for r in reduce(DataFrame.union, found).groupBy("violation").count().collect()}
    written = _text(f"{root}/{SCHEMA}")
    return said if written == V.json_schema() else said | {"no schema" if written is None else "another schema": 1}


def compare(spark: SparkSession, before: str, after: str) -> dict:
    """The report of each kind's gate."""
    pick = lambda root, kind: shards.scan_shards(spark, root, kind).select("key", "line")
    return {kind: C.gate(C.diff(pick(before, kind), pick(after, kind))).first().asDict() for kind in KINDS}


def entries(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The published entries of a kind, in order of key, as columns; a line that doesn't read back strictly is an error."""
    read = V.read_lines(shards.scan_shards(spark, root, kind), kind)
    if (bad := read.where("entry IS NULL").first()) is not None:
        raise E.BuildError(f"{kind}/{bad.shard}: no entry: {bad.line[:80]!r}")
    return read.select("entry.*").orderBy("canonical_key")


def export(spark: SparkSession, root: str, limit: int = 200) -> str:
    """The library's file: a JSON array of the best publishable entries, indented."""
    best = [json.loads(r.app) for r in E.export(entries(spark, root, "mcp"), limit).orderBy("place").collect()]
    return json.dumps(best, indent=2, ensure_ascii=False) + "\n"


def stats(spark: SparkSession, root: str) -> dict:
    """Entries by kind, with zeros, by tier, category and source, and by tenths of popularity; one pass over all lines."""
    v = F.try_parse_json("line")
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    rows = reduce(DataFrame.union, _scanned(spark, root).values())
    tenth = F.least(F.floor(get("$.popularity", "double") * 10), F.lit(9)).cast("string")
    sources = F.transform(F.array_distinct(get("$.sources", "array<struct<source_id: string>>")["source_id"]), lambda s: F.struct(F.lit("sources").alias("what"), s.alias("value")))
    one = lambda what, c: F.struct(F.lit(what).alias("what"), c.alias("value"))
    told = rows.select(F.explode(F.concat(F.array(one("kinds", get("$.kind", "string")), one("tiers", get("$.trust_tier", "string")), one("categories", get("$.category", "string")), one("deciles", tenth)), sources)).alias("x")).groupBy("x.what", "x.value").count().collect()
    of = lambda what: {r.value: r["count"] for r in told if r.what == what and r.value is not None}
    return {"kinds": dict.fromkeys(KINDS, 0) | of("kinds"), "tiers": of("tiers"), "categories": of("categories"), "sources": of("sources"), "deciles": [of("deciles").get(str(d), 0) for d in range(10)]}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, words in {"build": ("crawl", "out", "at"), "verify": ("root",), "export": ("root",), "schema": (), "diff": ("before", "after"), "stats": ("root",)}.items():
        one = commands.add_parser(name)
        for w in words:
            one.add_argument(w)
        if name == "build":
            one.add_argument("--no-gate", action="store_true")
            one.add_argument("--dry-run", action="store_true")
            one.add_argument("--overlays")
        if name == "export":
            one.add_argument("--limit", type=int, default=200)
    try:
        given = parser.parse_args(arguments)
    except SystemExit as e:
        return WRONG_CALL if e.code else DONE
    spark = spark or SparkSession.builder.getOrCreate()
    try:
        if given.command in ("export", "schema"):
            sys.stdout.write(export(spark, given.root, given.limit) if given.command == "export" else V.json_schema())
            return DONE
        if given.command == "build":
            said = build(spark, given.crawl, given.out, given.at, not given.no_gate, given.overlays, given.dry_run)
        else:
            said = {"verify": lambda: verify(spark, given.root), "diff": lambda: compare(spark, given.before, given.after), "stats": lambda: stats(spark, given.root)}[given.command]()
    except (E.BuildError, U.CurationError, overlays.OverlayError) as e:
        print(e, file=sys.stderr)
        return FAILED
    print(json.dumps(said, sort_keys=True, default=str))
    if given.command == "verify" and said:
        return VIOLATED
    return REFUSED if "refused" in said or given.command == "diff" and not all(r["passes"] for r in said.values()) else DONE


if __name__ == "__main__":
    sys.exit(main())
