"""From candidates to entries: fusion of each component, the fixed tail of an entry, checks, and what is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import fields as N
from tessera.functions import keys as K
from tessera.functions import lenient as L
from tessera.functions import scoring as S
from tessera.functions.text import clean, collapse, slugify, summarize
from tessera.operators import catalog as C
from tessera.operators.components import components_by_key
from tessera.operators.projections import FIELDS, SIGNALS
from tessera.shared import keep

# What provisional slugs lose at either end, and how much of a name is published.
PREFIXES, SUFFIXES, APP_NAME = ("server-", "mcp-"), ("-mcp", "-server"), 60
SCALES = {name: (ceiling, weight) for name, ceiling, weight in S.SIGNALS}
BAD_ENTRIES = 25


def source_rank(source: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in N.SOURCE_IDS]), source), F.lit(0)) - 1, F.lit(len(N.SOURCE_IDS))).cast("int")


def with_lent_signals(candidates: DataFrame) -> DataFrame:
    """Signals raised to the most that any candidate with the very same repository key has."""
    key = F.try_element_at(F.filter("keys", lambda k: K.space_of(k) == "repo"), F.lit(1))
    return C.lend(candidates.withColumn("_repo", key), "_repo", list(SIGNALS)).drop("_repo")


def ambiguous_keys(candidates: DataFrame) -> DataFrame:
    """(key) of repository keys whose claimants hold disjoint keys in another space. Claims are written as a table, since what
    compares them reads them several times, and each time they would be planned and replanned anew."""
    ids = F.concat_ws("\x1f", "source_id", "upstream_id", "primary_key")
    every = candidates.select(ids.alias("claimant"), "keys").distinct()
    repos = every.select("claimant", F.explode(F.filter("keys", lambda k: K.space_of(k) == "repo")).alias("key"))
    others = every.select("claimant", F.explode(F.filter("keys", lambda k: K.space_of(k) != "repo")).alias("value")).withColumn("space", K.space_of(F.col("value")))
    return C.ambiguous(keep(repos.join(others, "claimant").select("key", "claimant", "space", "value"), "claims"))


def demoted(candidates: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """Candidates with live_keys, those that aren't ambiguous, and demoted_keys; without those that have none left."""
    held = candidates.withColumn("_id", F.xxhash64("source_id", "upstream_id", "primary_key", "keys"))
    pairs = held.select("_id", F.explode("keys").alias("key")).distinct()
    lost = pairs.join(ambiguous.select("key"), "key").groupBy("_id").agg(F.array_sort(F.collect_set("key")).alias("demoted_keys"))
    out = held.join(lost, "_id", "left").withColumn("demoted_keys", F.coalesce("demoted_keys", F.array().cast("array<string>")))
    return out.withColumn("live_keys", F.array_except("keys", "demoted_keys")).where(F.size("live_keys") > 0).drop("_id")


def with_components(candidates: DataFrame) -> DataFrame:
    """Candidates (live_keys, ...) with the component that shared keys put them in, directly or through others."""
    held = candidates.withColumn("_id", F.xxhash64("kind", "source_id", "upstream_id", "primary_key", "live_keys"))
    own = components_by_key(held.select(F.col("_id").alias("id"), F.explode("live_keys").alias("key")))
    return held.join(own, F.col("_id") == F.col("id")).drop("_id", "id")


def impure(components: DataFrame) -> DataFrame:
    """(component, kinds) of components that hold more than one kind; there should be none."""
    return components.groupBy("component").agg(F.array_sort(F.collect_set("kind")).alias("kinds")).where(F.size("kinds") > 1)


def fused(components: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """One row a component: each field's first informative value by source, upstream id and key; the strongest key, the
    others as aliases, the smallest 16; the most of each signal; tags, packages, remotes and sources united and bounded.

    curated, if given, has (key): keys that people vouch for. One aggregation, whose parts are combined before the shuffle.
    """
    order = F.struct(source_rank(F.col("source_id")).alias("r"), F.col("upstream_id").alias("u"), F.col("primary_key").alias("k"))
    first = [F.min_by(F.when(L.informative(F.col(c), t), F.col(c)), F.when(L.informative(F.col(c), t), order)).alias(c) for c, t in FIELDS.items()]
    icon = F.col("icon_url")
    pick = lambda ok: F.min_by(F.when(ok, icon), F.when(ok, order))
    gather = lambda c: F.array_sort(F.flatten(F.collect_set(F.transform(F.col(c), lambda x: F.struct(order.alias("o"), x.alias("x"))))))
    out = components.groupBy("component").agg(
        F.min("kind").alias("kind"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("keys")))).alias("all_keys"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("live_keys")))).alias("live_keys"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("demoted_keys")))).alias("demoted_keys"),
        *[F.max(s).alias(s) for s in SIGNALS], *first, *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("deprecated", "marketplace_reviewed")],
        F.coalesce(pick(icon.contains("api.smithery.ai")), pick(icon != ""), F.lit("")).alias("icon_url"), F.flatten(F.collect_set("tags")).alias("tags"), gather("packages").alias("_packages"), gather("remotes").alias("_remotes"),
        F.collect_set(F.struct(source_rank(F.col("source_id")).alias("rank"), "source_id", "upstream_id", "url")).alias("_sources"),
        F.bool_or((F.col("source_id") == "registry") & (F.col("trust_hint") == "registry_verified")).alias("_registry"), F.bool_or((F.col("source_id") == "smithery") & (F.col("trust_hint") == "smithery_verified")).alias("_smithery"),
        F.bool_or(F.col("trust_hint") == "curated").alias("_curated"),
    )
    # The first of each identity, then in order of identity.
    once = lambda c, one: F.filter(F.transform(c, lambda x, i: F.struct(one(x["x"]).alias("id"), x["x"].alias("x"), (F.array_position(F.transform(c, lambda y: one(y["x"])), one(x["x"])) == i + 1).alias("first"))), lambda x: x["first"])
    united = lambda c, one, most: F.slice(F.transform(F.array_sort(once(c, one)), lambda x: x["x"]), 1, most)
    references = F.array_sort("_sources")
    out = out.withColumns({
        "canonical_key": K.elect(F.col("live_keys")), "packages": united("_packages", lambda x: F.struct(x["registry_type"].alias("a"), x["identifier"].alias("b")), N.PACKAGES), "remotes": united("_remotes", lambda x: F.struct(x["transport"].alias("a"), x["url"].alias("b")), N.REMOTES),
        "tags": F.slice(F.array_sort(F.array_distinct(F.filter(F.transform("tags", lambda t: F.substring(F.lower(F.trim(t)), 1, N.TAG)), lambda t: t != ""))), 1, N.TAGS),
        "sources": F.filter(references, lambda s, i: (i == 0) | ~F.coalesce(F.array_contains(F.transform(F.slice(references, 1, i), lambda y: F.concat_ws("\x1f", y["source_id"], y["upstream_id"])), F.concat_ws("\x1f", s["source_id"], s["upstream_id"])), F.lit(False))),
    })
    out = out.withColumns({"alias_keys": F.slice(F.array_remove("live_keys", F.col("canonical_key")), 1, N.ALIASES), "sources": F.transform(F.slice("sources", 1, N.SOURCES), lambda s: F.struct(s["source_id"].alias("source_id"), s["upstream_id"].alias("upstream_id"), s["url"].alias("url")))})
    if curated is not None:
        vouched = out.select("component", F.explode("all_keys").alias("key")).join(curated.select("key").distinct(), "key", "left_semi").select("component", F.lit(True).alias("_vouched")).distinct()
        out = out.join(vouched, "component", "left").withColumn("_curated", F.col("_curated") | F.coalesce("_vouched", F.lit(False))).drop("_vouched")
    tier = F.when(F.col("_curated"), "curated").when(F.col("_registry"), "registry_verified").when(F.col("_smithery"), "smithery_verified").otherwise("indexed")
    return out.withColumn("trust_tier", tier).drop("_packages", "_remotes", "_sources", "_registry", "_smithery", "_curated")


def provisional_slug() -> Column:
    """The first name that leaves a slug: registry, Smithery, npm, skill, repository, display name, key. They are an array, so
    that the steps of a slug stand in the plan once: written out for each name, they made 12,000 lines of code that the driver
    generated and then couldn't compile."""
    tail = lambda c: F.regexp_replace(c, "^.*/", "")
    bare = tail(F.col("registry_name"))
    bare = F.regexp_replace(F.regexp_replace(bare, "^(?:" + "|".join(PREFIXES) + ")(?=.)", ""), "(?<=.)(?:" + "|".join(SUFFIXES) + ")$", "")
    package = F.when(F.col("npm_package").startswith("@"), F.regexp_replace("npm_package", "^[^/]*/", "")).otherwise(F.col("npm_package"))
    names = F.array(bare, tail(F.col("smithery_qualified_name")), package, F.col("skill_name"), F.col("repo.repo"), F.col("name"), tail(F.regexp_replace("canonical_key", "^.*:", "")))
    return F.try_element_at(F.filter(F.transform(names, slugify), lambda s: s.isNotNull()), F.lit(1))


def built(merged: DataFrame) -> DataFrame:
    """Entries of fused rows, in a fixed order: identity and score, then texts, then what a server's kind derives."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    score = S.popularity([(F.col(n), ceiling, w) for n, (ceiling, w) in SCALES.items()])
    df = merged.withColumns({"slug": provisional_slug(), "popularity": score})
    df = df.withColumns({"name": F.coalesce(F.nullif(collapse(text("name"), N.NAME), F.lit("")), "slug"), "description": collapse(text("description"), N.DESCRIPTION), "homepage": N.https(text("homepage")), "docs_url": N.first_url(text("docs_url")), "license": F.substring(text("license"), 1, 64), "tags": N.tags(F.col("tags"))})
    server = F.col("kind") == "mcp"
    df = df.withColumns({
        "auth_note": collapse(text("auth_note"), N.NOTE), "setup_note": collapse(text("setup_note"), N.NOTE), "mcp_url": F.when(server & K.dialable(F.col("mcp_url")), F.col("mcp_url")),
        "category": F.when(server, F.when(F.col("category").isin(*N.CATEGORY_ICONS), F.col("category")).otherwise(N.category(F.col("name"), F.col("description"), F.col("tags"), F.concat_ws(" ", text("registry_name"), text("npm_package"))))).otherwise(F.coalesce(F.nullif(F.substring("category", 1, 64), F.lit("")), F.lit("General"))),
        "connector_type": F.when(server & F.col("connector_type").isin(*N.CONNECTORS), F.col("connector_type")), "auth_hint": F.when(F.col("auth_hint").isin(*N.AUTH_HINTS), F.col("auth_hint")).otherwise("bearer"),
        "remotes": F.array_sort("remotes"), "packages": F.array_sort("packages"), "tool_count": F.least("tool_count", F.lit(N.TOOLS)),
    })
    holds = F.filter("remotes", lambda r: r["url"] == F.col("mcp_url"))
    declared = F.when(F.col("transport").isin(*N.TRANSPORTS), F.col("transport")).otherwise("unknown")
    df = df.withColumns({
        "icon": F.when(F.col("icon").isin(*N.ICONS), F.col("icon")).otherwise(N.icon(F.col("slug"), F.col("category"))),
        "icon_url": F.when(~server & F.col("icon_url").rlike(N.AVATAR), F.col("icon_url")).otherwise(N.icon_url(text("smithery_qualified_name"), F.col("repo"))),
        "transport": F.when(F.col("mcp_url").isNull(), "unknown").otherwise(F.coalesce(F.try_element_at(holds, F.lit(1))["transport"], declared)), "stdio_only": F.col("mcp_url").isNull() & (F.size("packages") > 0),
        "_trusted": (F.col("trust_tier") == "curated") | ((F.col("trust_tier") == "registry_verified") & (F.size(holds) > 0)),
    })
    host = N.stdio_note(F.try_element_at("packages", F.lit(1))["identifier"])
    df = df.withColumns({
        "url_unverified": F.when(F.col("mcp_url").isNotNull(), ~F.col("_trusted")).otherwise(F.col("connector_type").isNull()),
        "setup_note": F.when(F.col("stdio_only") & (F.col("setup_note") == ""), host).otherwise(F.col("setup_note")),
    })
    finish = lambda c: N.terminated(clean(F.col(c), N.NOTE - 1))
    return df.withColumns({"auth_note": finish("auth_note"), "setup_note": finish("setup_note"), "schema_version": F.lit(1), "curated_fields": F.array().cast("array<string>")}).drop("_trusted", "component")


class BuildError(ValueError):
    """A build that must not be published."""


def build(candidates: DataFrame, curated: DataFrame | None = None, most_bad: int = BAD_ENTRIES, overrides: DataFrame | None = None, denials: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries with unique slugs, entries left out with their violations).

    Overrides of several keys join what holds them; then signals are lent, ambiguous keys demoted, components found, fused
    and built, denials and overrides applied, and slugs assigned, in this order; a table is written after candidates,
    demotion, components, fusion, entries and their checks, so that no plan holds all steps. Components of several kinds, more than most_bad
    bad entries, and overlays that contradict themselves or each other fail the build.
    """
    from tessera.operators import constraints as V
    from tessera.operators import curation as U

    said = U.read_overrides(overrides) if overrides is not None else []
    candidates = keep(candidates, "projected")
    if said:
        candidates = U.forced(candidates, said)
        vouched = U.vouched(candidates.sparkSession, said)
        curated = vouched if curated is None else curated.select("key").union(vouched)
    held = keep(with_lent_signals(candidates), "candidates")
    live = keep(demoted(held, ambiguous_keys(held)), "demoted")  # components read it more than once
    known = keep(with_components(live), "components")
    if (bad := impure(known).first()) is not None:
        raise BuildError(f"component {bad.component} holds {bad.kinds}")
    merged = keep(fused(known, curated), "merged")
    entries = keep(built(merged), "built")
    entries = keep(entries.withColumn("violations", V.violations(entries)), "entries")
    wrong = entries.where(F.size("violations") > 0)
    if (n := wrong.count()) > most_bad:
        raise BuildError(f"{n} entries are bad, more than {most_bad}")
    fine = entries.where(F.size("violations") == 0).drop("violations")
    if said or denials is not None:
        fine, _ = U.apply(fine, said, denials)
    slugs = C.assign_slugs(fine.select(F.col("canonical_key").alias("key"), S.tier_rank(F.col("trust_tier")).alias("rank"), "slug"))
    given = slugs.select(F.col("key").alias("_key"), "given")
    return fine.join(given, F.col("canonical_key") == F.col("_key")).withColumn("slug", F.col("given")).drop("_key", "given"), wrong


def publishable() -> Column:
    """Whether an entry is strong enough for the library: a described, connectable server that somebody vouches for."""
    connectable = (F.col("trust_tier") == "curated") | F.col("mcp_url").isNotNull() | F.col("connector_type").isNotNull() | F.col("stdio_only")
    return (F.col("kind") == "mcp") & (F.col("trust_tier") != "indexed") & ~F.col("deprecated") & (F.col("description") != "") & connectable & F.col("icon").isin(*N.ICONS) & F.col("category").isin(*N.CATEGORY_ICONS)


def published() -> Column:
    """An entry as the library's JSON object: 16 keys, left out where they say no more than the default."""
    unless = lambda c, default: F.when(F.col(c) != default, F.col(c))
    config = F.when(F.size("connector_config") > 0, F.map_from_entries(F.array_sort(F.map_entries("connector_config"))))
    return F.to_json(F.struct(
        "slug", F.substring("name", 1, APP_NAME).alias("name"), "category", "icon", summarize(F.col("description")).alias("description"), F.when(F.col("icon_url").rlike(N.AVATAR), F.col("icon_url")).alias("icon_url"), "connector_type", "mcp_url",
        F.when(F.col("url_unverified"), F.lit(True)).alias("url_unverified"), unless("transport", "unknown").alias("transport"), "auth_hint", unless("auth_note", "").alias("auth_note"), unless("docs_url", "").alias("docs_url"), unless("setup_note", "").alias("setup_note"),
        F.when(F.col("stdio_only"), F.lit(True)).alias("stdio_only"), config.alias("connector_config"),
    ))


def export(entries: DataFrame, limit: int = 200) -> DataFrame:
    """(place, app): the best publishable entries, in the order of publication; a limit below zero is zero."""
    best = entries.where(publishable()).orderBy(S.tier_rank(F.col("trust_tier")), F.desc("popularity"), "canonical_key").limit(max(0, limit))
    return best.withColumn("place", F.row_number().over(Window.orderBy(S.tier_rank(F.col("trust_tier")), F.desc("popularity"), "canonical_key"))).select("place", published().alias("app"))


def canonical_line(columns: dict[str, str]) -> Column:
    """An entry as one line of JSON: keys in order at every depth, nulls kept, numbers as short as they can be.

    columns: names and types of the entry. Spark writes small doubles with exponents; popularity is written apart.
    """
    names = sorted(columns)
    plain = F.to_json(F.struct(*[ordered(F.col(c), columns[c]).alias(c) if c != "popularity" else F.lit("\x00").alias(c) for c in names]), {"ignoreNullFields": "false"})
    number = F.regexp_replace(F.regexp_replace(F.format_string("%.4f", F.col("popularity")), "0+$", ""), r"\.$", ".0")
    return F.replace(plain, F.lit('"\\u0000"'), number) if "popularity" in columns else plain


def ordered(column: Column, kind: str) -> Column:
    """A column whose structs have their fields in order of name, and whose maps have their keys in order."""
    from pyspark.sql.types import ArrayType, MapType, StructType, _parse_datatype_string

    def walk(c: Column, t) -> Column:
        if isinstance(t, StructType):
            return F.when(c.isNotNull(), F.struct(*[walk(c[f.name], f.dataType).alias(f.name) for f in sorted(t.fields, key=lambda f: f.name)]))
        if isinstance(t, ArrayType):
            return F.transform(c, lambda x: walk(x, t.elementType)) if isinstance(t.elementType, (StructType, ArrayType, MapType)) else c
        if isinstance(t, MapType):
            return F.map_from_entries(F.array_sort(F.map_entries(c)))
        return c

    return walk(column, _parse_datatype_string(kind) if isinstance(kind, str) else kind)


def unresolved(entries: DataFrame, overrides: DataFrame) -> DataFrame:
    """(key) of overrides (key) that no entry has, neither as its key nor as an alias."""
    index = C.locate(entries.select(F.col("canonical_key").alias("owner"), F.col("alias_keys").alias("keys")))
    return overrides.select("key").distinct().join(index.select("key"), "key", "left_anti")
