"""Each catalog operator applied to the driver's tables, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import keys as K
from tessera.functions import lenient as L
from tessera.functions import scoring as S
from tessera.functions import text as T
from tessera.operators import catalog as C
from tessera.operators.components import components_by_key

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Popularity of customers: orders, quantity and events, each on its own scale.
SCALES = (("n_orders", 100, 0.45), ("quantity", 10_000, 0.35), ("n_events", 1_000, 0.20))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, name, segment, nation, balance, n_orders, quantity, n_events, popularity, tier) of each customer.

    Lines are summed by order before they meet orders, so each join has one row a key on one side.
    """
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    orders = read(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    per = orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.sum("q").cast("bigint").alias("quantity"))
    events = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n_events"))
    c = read(spark, sf_dir, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left").join(events, F.col("c_custkey") == F.col("user_id"), "left")
    score = S.popularity([(F.col(n), ceiling, w) for n, ceiling, w in SCALES])
    tier = F.when(F.col("c_mktsegment") == "BUILDING", "curated").when(F.col("n_events").isNotNull(), "registry_verified").when(F.col("c_acctbal") > 5000, "smithery_verified").otherwise("indexed")
    return c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), "n_orders", "quantity", "n_events", score.alias("popularity"), tier.alias("tier"))


SCORED = """
lines AS (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
per AS (SELECT o_custkey, count(*) AS n_orders, CAST(sum(q) AS BIGINT) AS quantity FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey GROUP BY 1),
ev AS (SELECT user_id, count(*) AS n_events FROM events GROUP BY 1),
base AS (SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance, n_orders, quantity, n_events,
  CASE WHEN n_orders IS NOT NULL THEN least(1, ln(1 + n_orders) / ln(101)) END AS s1, CASE WHEN quantity IS NOT NULL THEN least(1, ln(1 + quantity) / ln(10001)) END AS s2, CASE WHEN n_events IS NOT NULL THEN least(1, ln(1 + n_events) / ln(1001)) END AS s3,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'curated' WHEN n_events IS NOT NULL THEN 'registry_verified' WHEN c_acctbal > 5000 THEN 'smithery_verified' ELSE 'indexed' END AS tier
  FROM customer LEFT JOIN per ON c_custkey = o_custkey LEFT JOIN ev ON c_custkey = user_id),
weighed AS (SELECT *, (CASE WHEN s1 IS NULL THEN 0 ELSE 0.45::DOUBLE END + CASE WHEN s2 IS NULL THEN 0 ELSE 0.35::DOUBLE END + CASE WHEN s3 IS NULL THEN 0 ELSE 0.2::DOUBLE END) AS w,
  coalesce(s1 * 0.45::DOUBLE, 0) + coalesce(s2 * 0.35::DOUBLE, 0) + coalesce(s3 * 0.2::DOUBLE, 0) AS t FROM base),
scored AS (SELECT key, name, segment, nation, balance, n_orders, quantity, n_events, CASE WHEN w > 0 THEN round(t / w * (0.85::DOUBLE + 0.15::DOUBLE * w), 4) ELSE 0 END AS popularity, tier FROM weighed)
"""
TIER_RANK = "CASE tier WHEN 'curated' THEN 0 WHEN 'registry_verified' THEN 1 WHEN 'smithery_verified' THEN 2 ELSE 3 END"


@query(f"WITH {SCORED} SELECT key, n_orders, quantity, n_events, popularity FROM scored")
def popularity_score(spark, sf_dir):
    return scored(spark, sf_dir).select("key", "n_orders", "quantity", "n_events", "popularity")


@query(f"WITH {SCORED} SELECT key, name, tier, popularity FROM scored WHERE tier <> 'indexed' ORDER BY {TIER_RANK}, popularity DESC, key LIMIT 200")
def rank_topk(spark, sf_dir):
    """The ranked export: the best 200 by tier, popularity and key; sorted and cut in one operator."""
    ranked = scored(spark, sf_dir).where("tier <> 'indexed'").orderBy(S.tier_rank(F.col("tier")), F.desc("popularity"), "key").limit(200)
    return ranked.select("key", "name", "tier", "popularity")


@query(f"WITH {SCORED}, spine AS (SELECT unnest(range(10)) AS decile) SELECT CAST(decile AS INT) AS decile, count(key) AS n FROM spine LEFT JOIN scored ON least(CAST(floor(popularity * 10) AS INT), 9) = decile GROUP BY 1")
def decile_histogram(spark, sf_dir):
    found = scored(spark, sf_dir).groupBy(F.least(F.floor(F.col("popularity") * 10), F.lit(9)).cast("int").alias("d")).count()
    spine = spark.range(10).select(F.col("id").cast("int").alias("decile"))
    return spine.join(found, F.col("decile") == F.col("d"), "left").select("decile", F.coalesce("count", F.lit(0).cast("bigint")).alias("n"))


@query(f"WITH {SCORED} SELECT 'tier' AS what, tier AS value, count(*) AS n FROM scored GROUP BY tier UNION ALL SELECT 'segment', segment, count(*) FROM scored GROUP BY segment UNION ALL SELECT 'all', 'all', count(*) FROM scored")
def stats_counts(spark, sf_dir):
    """Counts by tier, by segment and in all, from one pass over grouping sets."""
    s = scored(spark, sf_dir).groupingSets([["tier"], ["segment"], []], "tier", "segment").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    what = F.when(F.col("g") == 1, "tier").when(F.col("g") == 2, "segment").otherwise("all")
    value = F.when(F.col("g") == 1, F.col("tier")).when(F.col("g") == 2, F.col("segment")).otherwise("all")
    return s.select(what.alias("what"), value.alias("value"), "n")


@query(f"WITH {SCORED} SELECT key, tier FROM scored WHERE tier <> 'indexed' AND balance >= 0 AND name <> '' AND (n_orders IS NOT NULL OR tier = 'curated')")
def filter_publishable(spark, sf_dir):
    fine = (F.col("tier") != "indexed") & (F.col("balance") >= 0) & (F.col("name") != "") & (F.col("n_orders").isNotNull() | (F.col("tier") == "curated"))
    return scored(spark, sf_dir).where(fine).select("key", "tier")


@query("""SELECT s_suppkey AS key, (s_name IS NOT NULL AND s_name <> '') AS name_informs, s_acctbal IS NOT NULL AS balance_informs, coalesce(s_acctbal > 0, false) AS flag_informs,
  CASE WHEN s_acctbal < 0 THEN false ELSE true END AS note_informs FROM supplier""")
def filter_informative(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").withColumn("flag", F.col("s_acctbal") > 0).withColumn("note", F.when(F.col("s_acctbal") < 0, "").otherwise("in credit"))
    return s.select(F.col("s_suppkey").alias("key"), L.informative(F.col("s_name"), "string").alias("name_informs"), L.informative(F.col("s_acctbal"), "double").alias("balance_informs"), L.informative(F.col("flag"), "boolean").alias("flag_informs"), L.informative(F.col("note"), "string").alias("note_informs"))


@query("""SELECT 'mcp:url:' || substr(regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '')), '[^\\x21-\\x7e]+', '_', 'g'), 1, 220) AS key, count(*) AS n FROM pages GROUP BY 1""")
def url_key_pages(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(K.url_key("mcp", F.col("url")).alias("key")).agg(F.count("*").alias("n"))


@query("SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, count(*) AS claims, count(DISTINCT url) AS urls FROM pages GROUP BY 1")
def repo_fanout(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(K.url_host(F.col("url")).alias("host")).agg(F.count("*").alias("claims"), F.count_distinct("url").alias("urls"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(json_extract(props, '$.k')) AS present FROM events GROUP BY 1")
def json_extract_count(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("k", L.count(L.parse(F.col("props")), "$.k"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"), F.count("k").alias("present"))


@query(r"""WITH t AS (SELECT doc_id, rtrim(substr(trim(regexp_replace(regexp_replace(text, '[\x00-\x1f\x7f]', ' ', 'g'), '\s+', ' ', 'g')), 1, 500)) AS c FROM documents)
SELECT doc_id, CAST(length(c) AS INT) AS n, sha256(c) AS digest FROM t""")
def collapse_text(spark, sf_dir):
    c = read(spark, sf_dir, "documents").select("doc_id", T.collapse(F.col("text"), 500).alias("c"))
    return c.select("doc_id", F.length("c").alias("n"), F.sha2("c", 256).alias("digest"))


@query()
def summarize_text(spark, sf_dir):
    """No SQL: one rewrite looks behind, which DuckDB's patterns can't."""
    return read(spark, sf_dir, "documents").select("doc_id", T.summarize(F.col("text")).alias("summary"))


def _parts(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("key"), F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("rank"), T.slugify(F.col("p_name")).alias("slug"))


@query(r"""WITH e AS (SELECT p_partkey AS key, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) AS rank,
  regexp_replace(substr(regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 32), '_+$', '') AS slug FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY rank, key) AS n, substr(slug, 1, 27) || '_' || substr(sha256(CAST(key AS VARCHAR)), 1, 4) AS short, substr(slug, 1, 23) || '_' || substr(sha256(CAST(key AS VARCHAR)), 1, 8) AS long FROM e),
m AS (SELECT *, row_number() OVER (PARTITION BY short ORDER BY rank, key) AS m FROM n WHERE n > 1)
SELECT key, slug, slug AS given FROM n WHERE n = 1
UNION ALL SELECT key, slug, CASE WHEN m = 1 AND short NOT IN (SELECT slug FROM n WHERE n = 1) THEN short ELSE long END FROM m""")
def slugify_names(spark, sf_dir):
    return C.assign_slugs(_parts(spark, sf_dir))


RULES = [("Metals", ["steel", "copper", "brass", "nickel", "tin"]), ("Finishes", ["polished", "burnished", "plated", "brushed", "anodized"]), ("Sizes", ["small", "medium", "large", "economy"])]


@query(r"""WITH h AS (SELECT p_partkey AS key, lower(p_name || ' ' || p_type) AS h FROM part)
SELECT key, CASE WHEN regexp_matches(h, '\b(?:steel|copper|brass|nickel|tin)\b') THEN 'Metals' WHEN regexp_matches(h, '\b(?:polished|burnished|plated|brushed|anodized)\b') THEN 'Finishes'
  WHEN regexp_matches(h, '\b(?:small|medium|large|economy)\b') THEN 'Sizes' ELSE 'Developer tools' END AS category FROM h""")
def choose_category(spark, sf_dir):
    text = F.lower(F.concat_ws(" ", "p_name", "p_type"))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), T.first_rule(text, RULES, "Developer tools").alias("category"))


@query("""SELECT c_custkey AS id, CASE WHEN c_acctbal > 5000 THEN 'mcp:repo:host/' || lower(replace(c_name, '#', '-')) WHEN c_acctbal > 0 THEN 'mcp:npm:' || c_custkey ELSE 'mcp:odd:' || lower(c_mktsegment) END AS key FROM customer""")
def elect_primary_key(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    repo = F.when(F.col("c_acctbal") > 5000, K.mint("mcp", "repo", F.concat(F.lit("host/"), F.replace(F.col("c_name"), F.lit("#"), F.lit("-")))))
    npm = F.when(F.col("c_acctbal") > 0, K.mint("mcp", "npm", F.col("c_custkey").cast("string")))
    keys = F.array_compact(F.array(K.mint("mcp", "odd", F.col("c_mktsegment")), npm, repo))
    return c.select(F.col("c_custkey").alias("id"), K.elect(keys).alias("key"))


@query("""WITH m AS (SELECT c_nationkey AS nation, c_acctbal AS customer_balance, NULL AS supplier_balance FROM customer UNION ALL SELECT s_nationkey, NULL, s_acctbal FROM supplier)
SELECT nation, max(customer_balance) AS customer_balance, max(supplier_balance) AS supplier_balance, greatest(max(customer_balance), max(supplier_balance)) AS best FROM m GROUP BY 1""")
def merge_signals(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("customer_balance"))
    s = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("supplier_balance"))
    m = c.unionByName(s, allowMissingColumns=True).groupBy("nation").agg(F.max("customer_balance").alias("customer_balance"), F.max("supplier_balance").alias("supplier_balance"))
    return m.withColumn("best", F.greatest("customer_balance", "supplier_balance"))


@query("""WITH m AS (SELECT c_nationkey AS nation, 0 AS r, c_custkey AS id, c_name AS name, CASE WHEN c_acctbal > 9000 THEN c_mktsegment ELSE '' END AS note, c_acctbal < -900 AS flag FROM customer
  UNION ALL SELECT s_nationkey, 1, s_suppkey, s_name, 'supplier', false FROM supplier)
SELECT nation, arg_min(name, (r, id)) FILTER (WHERE name <> '') AS name, arg_min(note, (r, id)) FILTER (WHERE note <> '') AS note, bool_or(flag) AS flag FROM m GROUP BY 1""")
def merge_fields(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.lit(0).alias("r"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 9000, F.col("c_mktsegment")).otherwise("").alias("note"), (F.col("c_acctbal") < -900).alias("flag"))
    s = read(spark, sf_dir, "supplier").select(F.col("s_nationkey"), F.lit(1), F.col("s_suppkey"), F.col("s_name"), F.lit("supplier"), F.lit(False))
    fields = {n: L.informative(F.col(n), "string") for n in ("name", "note")}
    return C.fuse(c.union(s), ["nation"], F.struct("r", "id"), fields, {"flag": F.col("flag")})


@query("""SELECT o_custkey AS id, array_to_string(list_sort(list_distinct(list(lower(substr(o_orderpriority, 1, 40)))))[1:20], ',') AS tags FROM orders GROUP BY 1""")
def merge_tags(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_set(F.lower(F.substring(F.trim("o_orderpriority"), 1, 40))).alias("t"))
    return o.select("id", F.array_join(F.slice(F.array_sort("t"), 1, 20), ",").alias("tags"))


@query("""WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey ORDER BY l_linenumber) AS n FROM lineitem),
g AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey) AS m FROM f WHERE n = 1)
SELECT l_orderkey AS id, string_agg(l_partkey || ':' || l_suppkey || ':' || l_linenumber, ',' ORDER BY l_partkey, l_suppkey) AS items FROM g WHERE m <= 8 GROUP BY 1""")
def merge_keyed_structs(spark, sf_dir):
    """First item of each identity, by an aggregation rather than a window; sorted by identity, eight at most."""
    first = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.min("l_linenumber").alias("l"))
    items = first.groupBy(F.col("l_orderkey").alias("id")).agg(F.slice(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l"))), 1, 8).alias("i"))
    return items.select("id", F.array_join(F.transform("i", lambda x: F.concat_ws(":", x["l_partkey"], x["l_suppkey"], x["l"])), ",").alias("items"))


@query("""WITH s AS (SELECT DISTINCT l_partkey AS key, l_suppkey AS claimant, year(l_shipdate) AS value FROM lineitem),
h AS (SELECT key, claimant, list_sort(list(value)) AS held FROM s GROUP BY 1, 2), d AS (SELECT DISTINCT key, held FROM h)
SELECT DISTINCT a.key FROM d a JOIN d b ON a.key = b.key AND a.held < b.held AND NOT list_has_any(a.held, b.held)""")
def ambiguous_keys(spark, sf_dir):
    """Parts whose suppliers shipped in disjoint sets of years."""
    claims = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"), F.col("l_suppkey").alias("claimant"), F.lit("year").alias("space"), F.year("l_shipdate").alias("value"))
    return C.ambiguous(claims)


@query("SELECT o_orderkey AS id, o_custkey AS key, max(o_totalprice) OVER (PARTITION BY o_custkey) AS price FROM orders")
def lend_signals(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("price"))
    return C.lend(o, "key", ["price"])


@query(r"""WITH RECURSIVE l AS (SELECT DISTINCT doc_id AS id, lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) AS key FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(trim(regexp_replace(line, '\s+', ' ', 'g'))) > 20),
f AS (SELECT key, min(id) AS first FROM l GROUP BY 1 HAVING count(*) > 1), e AS (SELECT DISTINCT id AS u, first AS v FROM l JOIN f USING (key) WHERE id <> first), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r(node, seen) AS (SELECT DISTINCT u, u FROM b UNION SELECT r.node, b.v FROM r JOIN b ON r.seen = b.u)
SELECT i.id, coalesce(min(r.seen), i.id) AS component FROM (SELECT DISTINCT id FROM l) i LEFT JOIN r ON r.node = i.id GROUP BY i.id""")
def entity_resolution(spark, sf_dir):
    """Documents that share a line of over 20 characters, through any chain of others."""
    lines = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.explode(F.split("text", "\n")).alias("line"))
    key = F.trim(F.regexp_replace("line", r"\s+", " "))
    return components_by_key(lines.select("id", F.lower(key).alias("key")).where(F.length("key") > 20).distinct())


@query("""SELECT o_custkey AS id, CASE WHEN bool_or(o_orderpriority = '1-URGENT' AND o_totalprice > 300000) THEN 'curated' WHEN bool_or(o_orderstatus = 'F' AND o_totalprice > 250000) THEN 'registry_verified'
  WHEN bool_or(o_orderstatus = 'O') THEN 'smithery_verified' ELSE 'indexed' END AS tier FROM orders GROUP BY 1""")
def trust_tier(spark, sf_dir):
    any_ = lambda c: F.bool_or(F.expr(c))
    tier = F.when(any_("o_orderpriority = '1-URGENT' AND o_totalprice > 300000"), "curated").when(any_("o_orderstatus = 'F' AND o_totalprice > 250000"), "registry_verified").when(any_("o_orderstatus = 'O'"), "smithery_verified").otherwise("indexed")
    return read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(tier.alias("tier"))


ALIASES = [("a1", ["Customer#000000001", "nobody"]), ("a2", ["ghost", "phantom"]), ("a3", ["Supplier#000000001"]), ("a4", ["Supplier#000000002", "Customer#000000007", "other"])]


@query("""WITH o(id, keys) AS (VALUES ('a1', ['Customer#000000001', 'nobody']), ('a2', ['ghost', 'phantom']), ('a3', ['Supplier#000000001']), ('a4', ['Supplier#000000002', 'Customer#000000007', 'other'])),
k AS (SELECT c_name AS key FROM customer UNION SELECT s_name FROM supplier)
SELECT id, array_to_string(list_sort(keys), ',') AS keys FROM o WHERE len(keys) >= 2 AND EXISTS (SELECT 1 FROM k WHERE list_contains(keys, k.key))""")
def alias_injection(spark, sf_dir):
    """Forced key sets of two keys or more become candidates if one of their keys is known."""
    forced = spark.createDataFrame(ALIASES, "id string, keys array<string>").where("size(keys) >= 2")
    known = read(spark, sf_dir, "customer").select(F.col("c_name").alias("key")).union(read(spark, sf_dir, "supplier").select("s_name"))
    hit = forced.withColumn("key", F.explode("keys")).join(known, "key", "left_semi").select("id").distinct()
    return forced.join(hit, "id", "left_semi").select("id", F.array_join(F.array_sort("keys"), ",").alias("keys"))


@query("""WITH o AS (SELECT n_name AS owner, [r_name, 'nation-' || n_nationkey] AS keys FROM nation JOIN region ON n_regionkey = r_regionkey), k AS (SELECT unnest(keys) AS key, owner FROM o UNION SELECT owner, owner FROM o)
SELECT key, min(owner) AS owner FROM k GROUP BY 1""")
def locate_index(spark, sf_dir):
    o = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return C.locate(o.select(F.col("n_name").alias("owner"), F.array("r_name", F.concat(F.lit("nation-"), "n_nationkey")).alias("keys")))


OVERRIDES = [("nation-1", {"name": "Corrected", "region": "7"}), ("nation-3", {"region": "9"}), ("nation-99", {"name": "Created"})]


@query("""WITH e AS (SELECT 'nation-' || n_nationkey AS key, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation),
o(key, name, region, curated_fields) AS (VALUES ('nation-1', 'Corrected', '7', 'name,region'), ('nation-3', NULL, '9', 'region'), ('nation-99', 'Created', NULL, 'name'))
SELECT coalesce(e.key, o.key) AS key, coalesce(o.name, e.name) AS name, coalesce(o.region, e.region) AS region, coalesce(curated_fields, '') AS curated_fields, e.key IS NULL AS created FROM e FULL JOIN o ON e.key = o.key""")
def curated_overlay(spark, sf_dir):
    e = read(spark, sf_dir, "nation").select(F.concat(F.lit("nation-"), "n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("region"))
    return C.overlay(e, spark.createDataFrame(OVERRIDES, "key string, fields map<string,string>"), ["name", "region"])


DENIED = ["Supplier#000000003", "supplier-5", "supplier-5", "no-such-key"]


@query("""WITH i AS (SELECT s_name AS key, s_name AS owner FROM supplier UNION SELECT 'supplier-' || s_suppkey, s_name FROM supplier), d(key) AS (VALUES ('Supplier#000000003'), ('supplier-5'), ('no-such-key'))
SELECT s_name AS key, 'kept' AS state FROM supplier WHERE s_name NOT IN (SELECT owner FROM i JOIN d USING (key)) UNION ALL SELECT key, 'stale' FROM d WHERE key NOT IN (SELECT key FROM i)""")
def denylist_anti(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    index = C.locate(s.select(F.col("s_name").alias("owner"), F.array(F.concat(F.lit("supplier-"), "s_suppkey")).alias("keys")))
    denied = spark.createDataFrame([(k,) for k in DENIED], "key string").distinct()
    kept, stale = C.deny(s.select(F.col("s_name").alias("owner")), index, denied)
    return kept.select(F.col("owner").alias("key"), F.lit("kept").alias("state")).union(stale.select("key", F.lit("stale")))


@query("SELECT doc_id, source, source IN ('src1', 'src3') AS reviewed FROM documents WHERE source IN ('src0', 'src1', 'src2', 'src3')")
def allowlist_semi(spark, sf_dir):
    allow = spark.createDataFrame([("src0", False), ("src1", True), ("src2", False), ("src3", True)], "name string, reviewed boolean")
    return read(spark, sf_dir, "documents").join(F.broadcast(allow), F.col("source") == F.col("name")).select("doc_id", "source", "reviewed")


@query("""WITH t AS (SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100), d AS (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS largest FROM orders GROUP BY 1)
SELECT c_custkey AS id, c_acctbal AS balance, n_orders, largest FROM t LEFT JOIN d ON c_custkey = o_custkey""")
def detail_enrich(spark, sf_dir):
    """Details for the top 100 only: orders meet them before they are aggregated."""
    top = read(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(100)
    details = read(spark, sf_dir, "orders").join(F.broadcast(top.select("c_custkey")), F.col("o_custkey") == F.col("c_custkey"), "left_semi").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("largest"))
    return top.join(details, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), "n_orders", "largest")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def first_wins_dedupe(spark, sf_dir):
    return C.first_wins(read(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n <= 5 ORDER BY user_id, ts, event_id LIMIT 400")
def budget_per_group(spark, sf_dir):
    """At most five events a user, then 400 in all: both limits are the feature."""
    order = [F.col("ts"), F.col("event_id")]
    kept = C.budget(read(spark, sf_dir, "events"), ["user_id"], order, 5)
    return C.first_rows(kept, ["user_id"], order, 400).select("user_id", "event_id")


def _snapshots(spark, sf_dir):
    """Orders, and a later state of them: pending ones gone, urgent ones changed, suppliers added."""
    o = read(spark, sf_dir, "orders")
    key = F.concat(F.lit("o"), "o_orderkey")
    before = o.select(key.alias("key"), F.concat_ws("|", "o_custkey", "o_orderstatus").alias("line"))
    after = o.where("o_orderstatus <> 'P'").select(key.alias("key"), F.concat_ws("|", "o_custkey", "o_orderstatus", F.when(F.col("o_orderpriority") == "1-URGENT", "changed")).alias("line"))
    return before, after.union(read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey"), "s_name"))


SNAPSHOTS = """b AS (SELECT 'o' || o_orderkey AS key, o_custkey || '|' || o_orderstatus AS line FROM orders),
a AS (SELECT 'o' || o_orderkey AS key, o_custkey || '|' || o_orderstatus || CASE WHEN o_orderpriority = '1-URGENT' THEN '|changed' ELSE '' END AS line FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT 's' || s_suppkey, s_name FROM supplier),
r AS (SELECT count(b.key) AS baseline, count(a.key) AS candidate, count(*) FILTER (b.key IS NULL) AS added, count(*) FILTER (a.key IS NULL) AS dropped, count(*) FILTER (a.line <> b.line) AS changed FROM b FULL JOIN a ON a.key = b.key),
f AS (SELECT *, CASE WHEN baseline > 0 THEN round(dropped / baseline, 6) ELSE 0 END AS drop_fraction, CASE WHEN baseline > 0 THEN round(changed / baseline, 6) ELSE 0 END AS change_fraction FROM r)"""


@query(f"WITH {SNAPSHOTS} SELECT * FROM f")
def snapshot_diff(spark, sf_dir):
    return C.diff(*_snapshots(spark, sf_dir))


@query(f"WITH {SNAPSHOTS} SELECT *, baseline >= 100 AND drop_fraction > 0.05 AS drop_breach, baseline >= 100 AND change_fraction > 0.2 AS change_breach, NOT (baseline >= 100 AND (drop_fraction > 0.05 OR change_fraction > 0.2)) AS passes FROM f")
def diff_gate(spark, sf_dir):
    return C.gate(C.diff(*_snapshots(spark, sf_dir)))


@query("""WITH b AS (SELECT event_type AS source, count(*) AS before FROM events WHERE value < 50 GROUP BY 1), a AS (SELECT event_type AS source, count(*) AS after FROM events WHERE value >= 50 AND event_type <> 'view' GROUP BY 1)
SELECT source, before, coalesce(after, 0) AS after FROM b LEFT JOIN a USING (source) WHERE coalesce(after, 0) = 0""")
def source_collapse(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumnRenamed("event_type", "source")
    return C.collapsed_sources(e.where("value < 50").groupBy("source").agg(F.count("*").alias("n")), e.where("value >= 50 AND source <> 'view'").groupBy("source").agg(F.count("*").alias("n")))


@query("""WITH s AS (SELECT lpad(lower(to_hex(x)), 2, '0') AS shard FROM (SELECT unnest(range(256)) AS x)), e AS (SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders), g AS (SELECT substr(sha256(key), 1, 2) AS shard, count(*) AS n, min(key) AS first_key, max(key) AS last_key FROM e GROUP BY 1)
SELECT shard, coalesce(n, 0) AS n, first_key, last_key FROM s LEFT JOIN g USING (shard)""")
def shard_plan(spark, sf_dir):
    return C.shard_plan(read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key")))


@query("""WITH j AS (SELECT n_nationkey AS id, '{"key":' || n_nationkey || ',"name":"' || n_name || '","region":' || n_regionkey || '}' AS line FROM nation) SELECT id, line, sha256(line) AS digest FROM j""")
def canonical_lines(spark, sf_dir):
    """Canonical JSON: keys sorted, no spaces, nulls kept."""
    j = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.to_json(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")), {"ignoreNullFields": "false"}).alias("line"))
    return j.withColumn("digest", F.sha2("line", 256))


@query("SELECT conv_id, count(*) AS n, sha256(string_agg(coalesce(text, ''), '' ORDER BY turn)) AS digest FROM conversations GROUP BY 1")
def rolling_digest(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"]), ""), 256).alias("digest"))


@query("""WITH m AS (SELECT DISTINCT p_brand AS old, 'Brand#' || substr(p_brand, 7, 1) AS new FROM part), i AS (SELECT new, string_agg(old, ',' ORDER BY old) AS olds FROM m GROUP BY 1)
SELECT p_partkey AS id, olds FROM part LEFT JOIN i ON 'Brand#' || substr(p_brand, 7, 1) = new""")
def rename_inversion(spark, sf_dir):
    new = F.concat(F.lit("Brand#"), F.substring("p_brand", 7, 1))
    p = read(spark, sf_dir, "part")
    turned = p.groupBy(new.alias("new")).agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("olds"))
    return p.join(turned, new == F.col("new"), "left").select(F.col("p_partkey").alias("id"), "olds")


@query("""SELECT 'orphan order' AS violation, CAST(l_orderkey AS VARCHAR) AS key FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION SELECT 'repeated line', l_orderkey || ':' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION SELECT 'repeated name', p_name FROM part GROUP BY p_name HAVING count(*) > 1 UNION SELECT 'unknown customer', CAST(user_id AS VARCHAR) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)""")
def verify_shards(spark, sf_dir):
    """Violations: rows without their owner, and keys that occur more than once."""
    line, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    row = lambda what, df: df.select(F.lit(what).alias("violation"), F.col("key").cast("string").alias("key"))
    orphan = line.join(orders, line["l_orderkey"] == orders["o_orderkey"], "left_anti").select(F.col("l_orderkey").alias("key")).distinct()
    twice = line.groupBy("l_orderkey", "l_linenumber").count().where("count > 1").select(F.concat_ws(":", "l_orderkey", "l_linenumber").alias("key"))
    names = read(spark, sf_dir, "part").groupBy(F.col("p_name").alias("key")).count().where("count > 1")
    events, customer = read(spark, sf_dir, "events"), read(spark, sf_dir, "customer")
    unknown = events.join(customer, events["user_id"] == customer["c_custkey"], "left_anti").select(F.col("user_id").alias("key")).distinct()
    return row("orphan order", orphan).union(row("repeated line", twice)).union(row("repeated name", names)).union(row("unknown customer", unknown))


@query("""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
SELECT page_id, count(*) AS links, count(DISTINCT link) AS distinct_links, count(*) FILTER (starts_with(link, '/') AND NOT contains(link, '.')) AS plain FROM h GROUP BY 1""")
def page_explode(spark, sf_dir):
    h = read(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    return h.groupBy("page_id").agg(F.count("*").alias("links"), F.count_distinct("link").alias("distinct_links"), F.count_if(F.startswith("link", F.lit("/")) & ~F.contains("link", F.lit("."))).alias("plain"))


CANDIDATE = ["kind", "source", "upstream_id", "keys", "name"]


@query("""SELECT 'mcp' AS kind, 'registry' AS source, c_custkey AS upstream_id, 'mcp:npm:' || lower(c_name) || ',mcp:registry:' || c_custkey AS keys, c_name AS name FROM customer
UNION ALL SELECT 'mcp', 'smithery', s_suppkey, 'mcp:npm:' || lower(s_name) || ',mcp:smithery:' || s_suppkey, s_name FROM supplier UNION ALL SELECT 'mcp', 'npm', p_partkey, 'mcp:npm:' || lower(regexp_replace(trim(p_name), '[^\\x21-\\x7e]+', '_', 'g')), p_name FROM part""")
def normalize_union(spark, sf_dir):
    def shape(df, source, id_, name, space=None):
        keys = [K.mint("mcp", "npm", F.col(name)), *([K.mint("mcp", space, F.col(id_).cast("string"))] if space else [])]
        return df.select(F.lit("mcp").alias("kind"), F.lit(source).alias("source"), F.col(id_).alias("upstream_id"), F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*keys)))), ",").alias("keys"), F.col(name).alias("name"))

    c = shape(read(spark, sf_dir, "customer"), "registry", "c_custkey", "c_name", "registry")
    s = shape(read(spark, sf_dir, "supplier"), "smithery", "s_suppkey", "s_name", "smithery")
    return c.unionByName(s).unionByName(shape(read(spark, sf_dir, "part"), "npm", "p_partkey", "p_name"))


@query("""WITH o AS (SELECT s_nationkey AS nation, 0 AS p, s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT c_nationkey, 1, c_custkey, c_name FROM customer UNION ALL SELECT n, 2, n, 'literal' FROM (VALUES (1), (30), (31)) v(n))
SELECT nation, p AS list, id, name FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY p, id) AS r FROM o) WHERE r = 1""")
def ordered_union(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit(0).alias("list"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = read(spark, sf_dir, "customer").select("c_nationkey", F.lit(1), "c_custkey", "c_name")
    extra = spark.createDataFrame([(n, 2, n, "literal") for n in (1, 30, 31)], "nation int, list int, id bigint, name string")
    return C.first_wins(s.union(c).union(extra), ["nation"], [F.col("list"), F.col("id")])


@query("""WITH r AS (SELECT event_id AS id, CASE WHEN event_type = 'view' AND value < 1 THEN 'not latest' WHEN value < 2 THEN 'deleted' WHEN user_id IS NULL THEN 'no key' WHEN length(props) > 512 THEN 'too long' END AS reason FROM events)
SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM r GROUP BY 1""")
def filter_drops(spark, sf_dir):
    reason = F.when((F.col("event_type") == "view") & (F.col("value") < 1), "not latest").when(F.col("value") < 2, "deleted").when(F.col("user_id").isNull(), "no key").when(F.length("props") > 512, "too long").otherwise("kept")
    return read(spark, sf_dir, "events").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(r"""SELECT page_id, array_to_string(list_filter(string_split(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g'), '/'), lambda x: x <> '' AND x <> '.'), '/') AS path FROM pages""")
def path_clean(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.relative_path(K.url_path(F.col("url")), 200).alias("path"))


@query("""SELECT event_id, 'k=' || json_extract_string(props, '$.k') AS config, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events""")
def map_clean(spark, sf_dir):
    m = F.from_json("props", "map<string,string>")
    entries = F.slice(F.array_sort(F.filter(F.map_entries(m), lambda e: e["value"].isNotNull() & (F.length(e["value"]) <= 500))), 1, 10)
    return read(spark, sf_dir, "events").select("event_id", F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("config"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"))


@query(r"""WITH p AS (SELECT p_partkey AS id, regexp_replace(lower(trim(p_name)), '^server-|-mcp$', '', 'g') AS n, lower(p_brand) AS b FROM part)
SELECT id, regexp_replace(substr(regexp_replace(regexp_replace(coalesce(nullif(n, ''), b), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 32), '_+$', '') AS slug FROM p""")
def provisional_slug(spark, sf_dir):
    bare = lambda c: F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "^server-", ""), "-mcp$", "")
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.coalesce(T.slugify(bare(F.col("p_name"))), T.slugify(F.col("p_brand")), T.slugify(F.col("p_partkey").cast("string"))).alias("slug"))


@query(f"""WITH {SCORED} SELECT key, CASE segment WHEN 'BUILDING' THEN 'home' WHEN 'MACHINERY' THEN 'gear' ELSE 'box' END AS icon, tier <> 'curated' AND balance < 0 AS url_unverified,
  CASE WHEN n_orders IS NULL THEN 'no orders' ELSE 'has ' || n_orders || ' orders' END AS note, CAST(least(coalesce(n_events, 0), 200) AS BIGINT) AS tool_count FROM scored""")
def entry_tail(spark, sf_dir):
    icons = F.create_map(F.lit("BUILDING"), F.lit("home"), F.lit("MACHINERY"), F.lit("gear"))
    note = F.when(F.col("n_orders").isNull(), "no orders").otherwise(F.concat(F.lit("has "), "n_orders", F.lit(" orders")))
    return scored(spark, sf_dir).select("key", F.coalesce(F.try_element_at(icons, F.col("segment")), F.lit("box")).alias("icon"), ((F.col("tier") != "curated") & (F.col("balance") < 0)).alias("url_unverified"), note.alias("note"), F.least(F.coalesce("n_events", F.lit(0)), F.lit(200)).cast("bigint").alias("tool_count"))


@query("""SELECT 'nation' AS source, CAST(n_nationkey AS BIGINT) AS id, n_name AS label, 'region ' || n_regionkey AS note FROM nation
UNION ALL SELECT 'supplier', s_suppkey, s_name, CASE WHEN s_acctbal < 0 THEN 'in debt' ELSE 'nation ' || s_nationkey END FROM supplier
UNION ALL SELECT 'part', p_partkey, p_name, coalesce(nullif(trim(p_type), ''), p_brand) FROM part
UNION ALL SELECT 'customer', c_custkey, c_name, coalesce(nullif(trim(c_mktsegment), ''), 'none') FROM customer
UNION ALL SELECT 'page', page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) FROM pages""")
def source_projections(spark, sf_dir):
    """Five sources in one shape, each field the first of its spellings that says anything."""
    t = lambda name: read(spark, sf_dir, name)
    shape = lambda df, source, id_, label, note: df.select(F.lit(source).alias("source"), F.col(id_).cast("bigint").alias("id"), label.alias("label"), note.alias("note"))
    debt = F.when(F.col("s_acctbal") < 0, "in debt").otherwise(F.concat(F.lit("nation "), F.col("s_nationkey")))
    parts = [
        shape(t("nation"), "nation", "n_nationkey", F.col("n_name"), F.concat(F.lit("region "), F.col("n_regionkey"))),
        shape(t("supplier"), "supplier", "s_suppkey", F.col("s_name"), debt),
        shape(t("part"), "part", "p_partkey", F.col("p_name"), L.first_text(F.col("p_type"), F.col("p_brand"))),
        shape(t("customer"), "customer", "c_custkey", F.col("c_name"), L.first_text(F.col("c_mktsegment"), F.lit("none"))),
        shape(t("pages"), "page", "page_id", K.url_host(F.col("url")), K.url_path(F.col("url"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""WITH RECURSIVE e AS (SELECT DISTINCT user_id, event_type || ':' || CAST(floor(value) AS BIGINT) AS key FROM events), f AS (SELECT key, min(user_id) AS first FROM e GROUP BY 1),
b AS (SELECT DISTINCT user_id AS u, first AS v FROM e JOIN f USING (key)), s AS (SELECT u, v FROM b UNION SELECT v, u FROM b),
r(node, seen) AS (SELECT DISTINCT u, u FROM s UNION SELECT r.node, s.v FROM r JOIN s ON r.seen = s.u), c AS (SELECT node, min(seen) AS component FROM r GROUP BY 1)
SELECT component, count(DISTINCT node) AS members, min(value) AS least, count(*) AS events FROM events JOIN c ON node = user_id GROUP BY 1""")
def component_audit(spark, sf_dir):
    """Users linked by equal type and whole value: each component's members, least value and events."""
    events = read(spark, sf_dir, "events")
    key = F.concat_ws(":", "event_type", F.floor("value"))
    own = components_by_key(events.select(F.col("user_id").alias("id"), key.alias("key")).distinct())
    return events.join(own, F.col("user_id") == F.col("id")).groupBy("component").agg(F.count_distinct("user_id").alias("members"), F.min("value").alias("least"), F.count("*").alias("events"))
