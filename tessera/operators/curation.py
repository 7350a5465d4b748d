"""What people say about entries: corrections, forced identities and denials, resolved through every key of an entry.

Overrides are (key, kind, aliases, fields), fields a map of names to JSON texts; denials are (key, reason). Both are
written by hand and read on the driver, up to MOST_CURATED of each. What they name is looked up in one pass over the
entries, by a join with the named keys alone; who lands where is then settled in order of key, on rows that only overlays
bound, and one more join corrects the entries.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import fields as N
from tessera.functions import keys as K
from tessera.functions.text import slugify
from tessera.operators import constraints as V
from tessera.operators import entries as E
from tessera.operators import projections as P

MOST_CURATED = 10_000
#: What no override may set.
FIXED = ("canonical_key", "kind", "schema_version")
SOURCE = "curated"
OVERRIDE = "key string, kind string, aliases array<string>, fields map<string,string>"


class CurationError(ValueError):
    """An overlay that is wrong, stale or contradicts another."""


def check(overrides: list[dict]) -> list[dict]:
    """Overrides in order of key, if each is well-formed by itself and no two have one key."""
    seen = set()
    for o in overrides:
        if o["kind"] not in V.KINDS:
            raise CurationError(f"override {o['key']!r} has no kind of {V.KINDS}")
        for k in (o["key"], *o["aliases"]):
            if not re.fullmatch(N.KEY_FORM[1:-1], k) or not k.startswith(f"{o['kind']}:"):
                raise CurationError(f"override {o['key']!r} has a key that is none of its kind: {k!r}")
        if o["key"] in seen:
            raise CurationError(f"two overrides have the key {o['key']!r}")
        seen.add(o["key"])
        known = {f.name for f in V.ENTRIES[o["kind"]]}
        for name in o["fields"]:
            if name in FIXED:
                raise CurationError(f"override {o['key']!r} may not set {name!r}")
            if name not in known:
                raise CurationError(f"override {o['key']!r} names an unknown field {name!r}")
    return sorted(overrides, key=lambda o: o["key"])


def _rows(df: DataFrame) -> list[dict]:
    rows = [r.asDict(recursive=True) for r in df.limit(MOST_CURATED + 1).collect()]
    if len(rows) > MOST_CURATED:
        raise CurationError(f"more than {MOST_CURATED} rows aren't an overlay")
    return rows


def read_overrides(overrides: DataFrame) -> list[dict]:
    return check([r | {"aliases": sorted(set(r["aliases"] or [])), "fields": r["fields"] or {}} for r in _rows(overrides.select("key", "kind", "aliases", "fields"))])


def forced(candidates: DataFrame, overrides: list[dict]) -> DataFrame:
    """Candidates, and one more for each override of several keys of which some candidate has one: it joins what holds them."""
    spark = candidates.sparkSession
    sets = [(o["key"], o["kind"], sorted({o["key"], *o["aliases"]})) for o in overrides if set(o["aliases"]) - {o["key"]}]
    if not sets:
        return candidates
    asked = spark.createDataFrame(sets, "key string, kind string, keys array<string>")
    named = asked.select("key", F.explode("keys").alias("named"))
    held = candidates.select(F.explode("keys").alias("named")).join(F.broadcast(named.select("named").distinct()), "named", "left_semi").distinct()
    known = asked.join(named.join(held, "named").select("key").distinct(), "key", "left_semi")
    given = {"kind": F.col("kind"), "source_id": F.lit(SOURCE), "upstream_id": F.substring("key", 1, 200), "url": F.lit(N.CURATED_URL), "keys": F.col("keys"), "primary_key": K.elect(F.col("keys")), "trust_hint": F.lit("curated")}
    return candidates.unionByName(known.select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in P.CANDIDATE.items()]))


def vouched(spark, overrides: list[dict]) -> DataFrame:
    """(key) of all keys that overrides name; their components are curated."""
    return spark.createDataFrame([(k,) for o in overrides for k in (o["key"], *o["aliases"])], "key string").distinct()


def located(entries: DataFrame, keys: list[str]) -> dict[str, str]:
    """Which of these keys an entry has, and the least canonical key of those that have it."""
    spark = entries.sparkSession
    asked = spark.createDataFrame([(k,) for k in sorted(set(keys))], "key string")
    own = entries.select(F.explode(F.array_union(F.array("canonical_key"), "alias_keys")).alias("key"), "canonical_key")
    met = own.join(F.broadcast(asked), "key", "left_semi").groupBy("key").agg(F.min("canonical_key").alias("owner"))
    return {r.key: r.owner for r in met.collect()}


def aliases_of(entries: DataFrame, owners: list[str]) -> dict[str, list[str]]:
    spark = entries.sparkSession
    few = spark.createDataFrame([(k,) for k in sorted(set(owners))], "canonical_key string")
    return {r.canonical_key: r.alias_keys for r in entries.select("canonical_key", "alias_keys").join(F.broadcast(few), "canonical_key", "left_semi").collect()}


def settle(overrides: list[dict], denied: set[str], places: dict[str, str]) -> dict[str, list[dict]]:
    """Which overrides land on which canonical key, in order of key: one that no entry has is a new entry's own, and what
    an earlier override names counts for later ones."""
    places, out = dict(places), {}
    for o in overrides:
        if clash := sorted(denied & {o["key"], *o["aliases"]}):
            raise CurationError(f"override {o['key']!r} is denied as well ({', '.join(clash)})")
        owner = places.setdefault(o["key"], o["key"])
        if not owner.startswith(f"{o['kind']}:"):
            raise CurationError(f"override {o['key']!r} of {o['kind']} meets {owner!r}")
        out.setdefault(owner, []).append(o)
        for k in o["aliases"]:
            places.setdefault(k, owner)
    return out


def _reference(o: dict) -> dict:
    """Where a correction comes from: the first web address that it states, else the place where corrections are kept."""
    for name in ("docs_url", "homepage", "mcp_url"):
        said = json.loads(o["fields"].get(name, "null"))
        if isinstance(said, str) and said.startswith("https://"):
            return {"source_id": SOURCE, "upstream_id": o["key"][:200], "url": said}
    return {"source_id": SOURCE, "upstream_id": o["key"][:200], "url": N.CURATED_URL}


PLAN = "owner string, o_kind string, created boolean, said map<string,string>, last array<string>, touched array<string>, aliases array<string>, reference struct<source_id: string, upstream_id: string, url: string>, slug_from string"


def _plan(spark, landed: dict[str, list[dict]], existing: dict[str, list[str]], denied: set[str]) -> DataFrame:
    rows = []
    for owner, each in landed.items():
        said = {k: v for o in each for k, v in o["fields"].items()}
        aliases = sorted((set(existing.get(owner, [])) | {k for o in each for k in o["aliases"]} | {o["key"] for o in each if owner not in existing}) - {owner} - denied)[: N.ALIASES]
        names = [json.loads(said.get(n, "null")) for n in ("slug", "name")]
        name = next((x for x in (*names, owner) if isinstance(x, str) and x.strip()), owner)
        rows.append((owner, each[0]["kind"], owner not in existing, said, sorted(each[-1]["fields"]), sorted(said), aliases, _reference(each[0]), name.rsplit(":", 1)[-1].rsplit("/", 1)[-1]))
    return spark.createDataFrame(rows, PLAN)


def _stated(name: str, kind: str) -> Column:
    """An override's value for a field, in the field's type; null where it says nothing."""
    return F.try_variant_get(F.try_parse_json(F.try_element_at("said", F.lit(name))), "$", kind)


def _created(plan: DataFrame, columns: list[str]) -> DataFrame:
    """Entries made of overrides alone, derived as any other entry is."""
    given = {c: _stated(c, t) for c, t in {**P.FIELDS, **P.GATHERED}.items()}
    empty = {"tags": "array<string>", "packages": P.GATHERED["packages"], "remotes": P.GATHERED["remotes"]}
    given |= {c: F.coalesce(given[c], F.array().cast(t)) for c, t in empty.items()} | {c: F.coalesce(given[c], F.lit(False)) for c in ("deprecated", "marketplace_reviewed")}
    given |= {"icon_url": F.coalesce(given["icon_url"], F.lit("")), **{s: F.lit(None).cast("bigint") for s in P.SIGNALS}}
    keys = {"component": F.lit(0).cast("bigint"), "kind": F.col("o_kind"), "canonical_key": F.col("owner"), "alias_keys": F.col("aliases"), "live_keys": F.array("owner"), "all_keys": F.array("owner"), "demoted_keys": F.array().cast("array<string>")}
    merged = E.keep(plan.select(*[c.alias(n) for n, c in {**given, **keys, "sources": F.array("reference"), "trust_tier": F.lit("curated")}.items()], "slug_from"), "created")
    made = E.built(merged)
    return E.keep(made.withColumn("slug", F.coalesce(slugify(F.col("slug_from")), "slug")).select(*columns), "created")


def corrected(entries: DataFrame, plan: DataFrame) -> DataFrame:
    """Entries with what the plan's overrides say, and what follows from it where they don't state it themselves."""
    columns = entries.columns
    every = entries.unionByName(_created(plan.where("created"), columns)) if plan.where("created").count() else entries
    met = every.join(F.broadcast(plan.drop("slug_from", "created")), F.col("canonical_key") == F.col("owner"), "left")
    hit, says = F.col("owner").isNotNull(), lambda c: F.coalesce(F.map_contains_key("said", F.lit(c)), F.lit(False))
    stated = lambda c: F.coalesce(F.array_contains("last", c), F.lit(False))
    faulty = []
    put = {}
    for f in {f.name: f for kind in V.KINDS for f in V.ENTRIES[kind] if f.name not in FIXED}.values():
        kind = V.spark_type(f.kind)
        faulty.append(F.when(says(f.name) & V.mistyped(F.try_parse_json(F.col("said")[f.name]), "$", V.entry_field(f), f.null, whole=False), F.lit(f.name)))
        if f.name == "popularity_signals":
            put |= {s: F.when(says(f.name), F.try_variant_get(F.try_parse_json(F.col("said")[f.name]), f"$.{s}", "bigint")).otherwise(F.col(s)) for s in P.SIGNALS}
        elif f.name in columns:
            put[f.name] = F.when(says(f.name), _stated(f.name, kind).cast(entries.schema[f.name].dataType)).otherwise(F.col(f.name))
    met = met.withColumn("_faulty", F.array_compact(F.array(*faulty))).withColumns(put)
    wrong = met.where(hit & (F.size("_faulty") > 0)).select("owner", "_faulty").first()
    if wrong is not None:
        raise CurationError(f"override of {wrong.owner!r} has values of another type: {wrong._faulty}")
    server = hit & (F.col("kind") == "mcp")
    unverified = F.when(F.col("mcp_url").isNotNull(), F.lit(False)).otherwise(F.col("connector_type").isNull())
    known = F.exists("sources", lambda s: s["source_id"] == SOURCE)
    ranked = F.array_sort(F.transform(F.when(known, F.col("sources")).otherwise(F.concat("sources", F.array("reference"))), lambda s: F.struct(E.source_rank(s["source_id"]).alias("r"), s["upstream_id"].alias("u"), s.alias("s"))))
    met = met.withColumns({
        "trust_tier": F.when(hit & ~stated("trust_tier"), "curated").otherwise(F.col("trust_tier")), "curated_fields": F.when(hit, F.array_sort(F.array_union("curated_fields", "touched"))).otherwise(F.col("curated_fields")), "alias_keys": F.when(hit, F.col("aliases")).otherwise(F.col("alias_keys")),
        "sources": F.when(hit, F.slice(F.transform(ranked, lambda x: x["s"]), 1, N.SOURCES)).otherwise(F.col("sources")),
        "stdio_only": F.when(server & ~stated("stdio_only"), F.col("mcp_url").isNull() & (F.size("packages") > 0)).otherwise(F.col("stdio_only")), "url_unverified": F.when(server & ~stated("url_unverified"), unverified).otherwise(F.col("url_unverified")),
    })
    return V.normalised(met).select(*columns, hit.alias("_hit"))


def apply(entries: DataFrame, overrides: list[dict], denials: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """(entries without denied ones and with corrections, denied keys that name nothing).

    A denial takes an identity away, not a row: all keys of the entry that it names are denied, so no override may name
    one of them. An override whose key no entry has makes an entry of its own. What comes out has to hold as any entry.
    """
    spark = entries.sparkSession
    named = sorted({r["key"] for r in _rows(denials.select("key"))}) if denials is not None else []
    places = located(entries, [*named, *[k for o in overrides for k in (o["key"], *o["aliases"])]]) if named or overrides else {}
    gone = aliases_of(entries, [places[k] for k in named if k in places]) if named else {}
    denied = {*named, *gone, *(k for aliases in gone.values() for k in aliases)}
    landed = settle(overrides, denied, places)
    out = entries
    if gone:
        out = out.join(F.broadcast(spark.createDataFrame([(k,) for k in sorted(gone)], "canonical_key string")), "canonical_key", "left_anti").select(*entries.columns)
    if landed:
        out = E.keep(corrected(out, _plan(spark, landed, aliases_of(out, list(landed)), denied)), "curated")
        bad = out.where("_hit").withColumn("violations", V.violations(out)).where("size(violations) > 0").select("canonical_key", "violations").first()
        if bad is not None:
            raise CurationError(f"override of {bad.canonical_key!r} makes an entry that doesn't hold: {bad.violations}")
        out = out.drop("_hit")
    return out, sorted(k for k in named if k not in places)
