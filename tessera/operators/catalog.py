"""The relational operators of catalog integration, as DataFrame transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.shared import keep

#: Sets of a key that meet in one task; overrides that are broadcast.
SETS_A_BLOCK, MOST_BROADCAST = 1000, 10_000


def held_back(df: DataFrame, condition: Column | str) -> DataFrame:
    """df where the condition holds, tested on the columns of df as they are: an ordinary filter is pushed below the steps
    that made them and written in their terms, which for columns built on columns grows to tens of thousands of terms,
    planned on the driver and computed twice. A generator's output is where that ends."""
    ok = F.expr(condition) if isinstance(condition, str) else condition
    return df.select("*", F.explode_outer(F.array(ok)).alias("_ok")).where("_ok").drop("_ok")


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def budget(df: DataFrame, group: list[str], order: list[Column], most: int) -> DataFrame:
    """At most so many rows of each group, first ones first."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def first_rows(df: DataFrame, blocks: list[str], order: list[Column], most: int) -> DataFrame:
    """The first so many rows in order of (blocks, order), without sorting them all: blocks are counted, the first that
    together have so many rows are picked by a top-k, and only the last of them is cut."""
    keys = [F.col(b).alias(f"_{i}") for i, b in enumerate(blocks)]
    names = [f"_{i}" for i in range(len(blocks))]
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).orderBy(*names).limit(max(0, most))  # each has a row at least
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("_before") < most)
    met = df.join(F.broadcast(before), [F.col(b).eqNullSafe(F.col(n)) for b, n in zip(blocks, names, strict=True)])
    whole = met.where(F.col("_before") + F.col("_n") <= most)
    part = met.where(F.col("_before") + F.col("_n") > most).withColumn("_k", F.row_number().over(Window.partitionBy(*blocks).orderBy(*order)))
    return whole.select(*df.columns).union(part.where(F.col("_before") + F.col("_k") <= most).select(*df.columns))


def fuse(df: DataFrame, group: list[str], order: Column, fields: dict[str, Column], anywhere: dict[str, Column] | None = None) -> DataFrame:
    """For each group, each field's first informative value in the given order; `anywhere` flags are or-ed.

    fields: name to condition that its value informs. One aggregation, combined before the shuffle; no sort.
    """
    first = [F.min_by(F.when(ok, F.col(name)), F.when(ok, order)).alias(name) for name, ok in fields.items()]
    flags = [F.coalesce(F.bool_or(c), F.lit(False)).alias(name) for name, c in (anywhere or {}).items()]
    return df.groupBy(*group).agg(*first, *flags)


def lend(df: DataFrame, key: str, signals: list[str]) -> DataFrame:
    """Rows with each signal raised to the largest that any row with the same key has; null keys borrow nothing."""
    most = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(*[F.max(s).alias(f"_{s}") for s in signals])
    out = df.join(most, F.col(key) == F.col("_key"), "left")
    rest = [c for c in df.columns if c not in signals]
    return out.select(*rest, *[F.greatest(s, f"_{s}").alias(s) for s in signals])


def ambiguous(claims: DataFrame) -> DataFrame:
    """(key) of claims (key, claimant, space, value): some two claimants hold disjoint value sets in one space.

    Where every claimant holds one value, more than one distinct value decides, without a join. Else distinct sets that
    have no value in common meet by key and space.
    """
    held = claims.groupBy("key", "space", "claimant").agg(F.array_sort(F.collect_set("value")).alias("held"))
    sets = held.groupBy("key", "space", "held").agg(F.lit(1).alias("one")).select("key", "space", "held")
    shape = sets.groupBy("key", "space").agg(F.max(F.size("held")).alias("widest"), F.count("*").alias("n")).where("n > 1")
    plain = shape.where("widest = 1").select("key")
    wide = sets.join(shape.where("widest > 1").select("key", "space", "n"), ["key", "space"])
    # A value that all sets of a key hold leaves no two of them disjoint.
    common = wide.select("key", "space", "n", F.explode("held").alias("value")).groupBy("key", "space", "value").agg(F.count("*").alias("holders"), F.first("n").alias("n")).where("holders = n")
    wide = wide.join(common.select("key", "space").distinct(), ["key", "space"], "left_anti")
    # The rest meet in blocks, so that a key with very many sets is many small tasks; a set leaves at its first match.
    blocks = F.ceil(F.col("n") / SETS_A_BLOCK).cast("int")
    dealt = wide.withColumn("block", F.pmod(F.hash("held"), blocks))
    a = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).alias("a")
    b = dealt.alias("b")
    met = a.join(b, F.expr("a.key = b.key AND a.space = b.space AND a.other = b.block AND a.held < b.held AND NOT arrays_overlap(a.held, b.held)"), "left_semi").select("key")
    return plain.union(met).distinct()


def locate(owners: DataFrame) -> DataFrame:
    """(key, owner) of owners (owner, keys): each key's owner, the least of several; an owner owns itself."""
    own = owners.select(F.explode(F.array_union(F.array("owner"), F.coalesce("keys", F.array().cast("array<string>")))).alias("key"), "owner")
    return own.groupBy("key").agg(F.min("owner").alias("owner"))


def deny(entries: DataFrame, index: DataFrame, denied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (owner, ...) without those that a denied key resolves to; and the denied keys that resolve to none."""
    hit = denied.join(index, "key", "left")
    gone = hit.where(F.col("owner").isNotNull()).select("owner").distinct()
    return entries.join(gone, "owner", "left_anti"), hit.where(F.col("owner").isNull()).select("key")


def overlay(entries: DataFrame, overrides: DataFrame, fields: list[str]) -> DataFrame:
    """Entries (key, fields...) corrected by overrides (key, fields map<string,string>); unmatched ones are created.

    Adds curated_fields, what an override set, sorted and comma-joined. Overrides are written by people: up to
    MOST_BROADCAST of them are broadcast, so that entries aren't shuffled; more are joined as any other table.
    """
    given = overrides.select(F.col("key").alias("o_key"), F.col("fields").alias("o"))
    if (twice := given.groupBy("o_key").count().where("count > 1").first()) is not None:
        raise ValueError(f"{twice.o_key!r} is corrected twice")
    few = given.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    met = entries.join(F.broadcast(given) if few else given, F.col("key") == F.col("o_key"), "left").withColumn("created", F.lit(False))
    known = entries.select("key").join(F.broadcast(given.select("o_key")) if few else given.select("o_key"), F.col("key") == F.col("o_key"), "left_semi").distinct()
    absent = given.join(known, F.col("o_key") == F.col("key"), "left_anti")
    new = absent.select(F.col("o_key").alias("key"), *[F.lit(None).cast(entries.schema[f].dataType).alias(f) for f in fields], "o", F.lit(True).alias("created"))
    both = met.select("key", *fields, "o", "created").unionByName(new)
    put = [F.when(F.coalesce(F.map_contains_key("o", F.lit(f)), F.lit(False)), F.col("o")[f]).otherwise(F.col(f)).alias(f) for f in fields]
    named = F.array_join(F.array_sort(F.filter(F.map_keys("o"), lambda k: k.isin(*fields))), ",")
    return both.select("key", *put, F.coalesce(named, F.lit("")).alias("curated_fields"), "created")


def assign_slugs(entries: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(key, slug, given): entries (key, rank, slug) get unique slugs, as if served one by one in order of (rank, key).

    Each asks for its plain slug, then for 27 characters and four hex digits of its key's hash, then for 23 and eight. Who
    is first to ask for a plain slug keeps it, unless the hashed slug of somebody before is the same; so only those who
    come later to theirs, and whose plain slug they may take, go through rounds. In a round every slug goes to the first in
    order of those who ask for it, and the others ask for their next; that ends where serving one by one ends. Who
    finds the last one taken too fails the allocation. Keys are distinct.
    """
    digest = F.sha2(F.col("key").cast("string"), 256)
    asks = F.array("slug", F.concat_ws("_", F.substring("slug", 1, 27), F.substring(digest, 1, 4)), F.concat_ws("_", F.substring("slug", 1, 23), F.substring(digest, 1, 8)))
    every = keep(entries.select("key", "rank", "slug", asks.alias("asks")), "slugs")
    least = every.groupBy("slug").agg(F.min(F.struct("rank", "key")).alias("first"), F.count("*").alias("n"))
    others = keep(every.join(least.where("n > 1").select(F.col("slug").alias("_s"), F.col("first.key").alias("_k")), F.col("slug") == F.col("_s")).where("key <> _k").select("key", "rank", "slug", "asks"), "contested")
    if others.isEmpty():
        return every.select("key", "slug", F.col("slug").alias("given"))
    now, fresh = others.withColumn("turn", F.lit(2)), others
    while not fresh.isEmpty():  # a holder who may be displaced asks for more in turn
        asked = fresh.select(F.explode(F.slice("asks", 2, 2)).alias("slug")).distinct()
        fresh = keep(every.join(asked, "slug", "left_semi").join(now.select("key"), "key", "left_anti").select("key", "rank", "slug", "asks"), "contested")
        now = now.unionByName(fresh.withColumn("turn", F.lit(1)))
    for _ in range(most_rounds):
        now = keep(now, "contested")
        wanted = now.withColumn("given", F.element_at("asks", F.col("turn")))
        first = wanted.groupBy("given").agg(F.min(F.struct("rank", "key")).alias("first"), F.count("*").alias("n")).where("n > 1").select("given", F.col("first.key").alias("holder"))
        if first.isEmpty():
            settled = wanted.select(F.col("key").alias("_key"), "given")
            return every.join(settled, F.col("key") == F.col("_key"), "left").select("key", "slug", F.coalesce("given", "slug").alias("given"))
        met = wanted.join(first, "given", "left")
        now = met.select("key", "rank", "slug", "asks", F.when(F.col("holder").isNull() | (F.col("holder") == F.col("key")), F.col("turn")).otherwise(F.col("turn") + 1).alias("turn"))
        if (lost := now.where("turn > 3").select("key", "slug").first()) is not None:
            raise ValueError(f"slug {lost.slug!r} of {lost.key!r} is taken, and so are its hashed ones")
    raise RuntimeError(f"slugs didn't settle in {most_rounds} rounds")


def diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row of counts and fractions over snapshots (key, line): a full outer join, then one aggregation."""
    both = before.select(F.col("key").alias("a"), F.col("line").alias("x")).join(after.select(F.col("key").alias("b"), F.col("line").alias("y")), F.col("a") == F.col("b"), "full_outer")
    counted = both.agg(
        F.count("a").alias("baseline"),
        F.count("b").alias("candidate"),
        F.count_if(F.col("a").isNull()).alias("added"),
        F.count_if(F.col("b").isNull()).alias("dropped"),
        F.count_if(F.col("x") != F.col("y")).alias("changed"),
    )
    part = lambda c: F.when(F.col("baseline") > 0, F.round(F.col(c) / F.col("baseline"), 6)).otherwise(F.lit(0.0))
    return counted.withColumn("drop_fraction", part("dropped")).withColumn("change_fraction", part("changed"))


def gate(report: DataFrame, most_dropped: float = 0.05, most_changed: float = 0.2, least_baseline: int = 100) -> DataFrame:
    """The report with what it breaches; a small baseline breaches nothing."""
    big = F.col("baseline") >= least_baseline
    out = report.withColumn("drop_breach", big & (F.col("drop_fraction") > most_dropped)).withColumn("change_breach", big & (F.col("change_fraction") > most_changed))
    return out.withColumn("passes", ~(F.col("drop_breach") | F.col("change_breach")))


def collapsed_sources(before: DataFrame, after: DataFrame) -> DataFrame:
    """(source, before, after) of counts (source, n): sources that had rows and have none."""
    joined = before.select("source", F.col("n").alias("before")).join(after.select("source", F.col("n").alias("after")), "source", "left")
    return joined.withColumn("after", F.coalesce("after", F.lit(0).cast("bigint"))).where("before > 0 AND after = 0")


def shard(key: Column) -> Column:
    return F.substring(F.sha2(key.cast("string"), 256), 1, 2)


def shard_plan(entries: DataFrame) -> DataFrame:
    """(shard, n, first_key, last_key) of all 256 shards of entries (key), empty ones too."""
    spark = entries.sparkSession
    spine = spark.range(256).select(F.lpad(F.lower(F.hex("id")), 2, "0").alias("shard"))
    found = entries.groupBy(shard(F.col("key")).alias("shard")).agg(F.count("*").alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))
    return spine.join(found, "shard", "left").select("shard", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "first_key", "last_key")
