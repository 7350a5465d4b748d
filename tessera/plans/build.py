"""The catalog's build on the driver's tables: records in the shapes of their sources, up to what is published."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import entries as E
from tessera.operators import projections as P
from tessera.plans.queries import query, read
from tessera.sources import pages as S


def dealt(spark, sf_dir, table: str, key: str) -> DataFrame:
    """A table dealt out before its rows of a few bytes become records or lines, of which a task does some thousand a second."""
    return read(spark, sf_dir, table).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)


def recorded(spark, sf_dir) -> DataFrame:
    """Suppliers as registry servers, customers as Smithery's, parts as npm packages, nations as repositories, and pages
    as skills; suppliers and customers with one number share an endpoint, suppliers and parts share repositories. They are
    written as a table, so that each projection is planned once, over a scan, and not anew after each shuffle."""
    digits = lambda c: F.col(c).cast("string")
    s, c, p = dealt(spark, sf_dir, "supplier", "s_suppkey"), dealt(spark, sf_dir, "customer", "c_custkey"), dealt(spark, sf_dir, "part", "p_partkey")
    n, g = read(spark, sf_dir, "nation"), read(spark, sf_dir, "pages")
    endpoint = lambda c: F.concat(F.lit("https://s"), digits(c), F.lit(".example/mcp"))
    repo = lambda owner, name: F.concat(F.lit("https://github.com/n"), digits(owner), F.lit("/r"), digits(name))
    server = F.struct(F.concat(F.lit("io.example/"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-")))).alias("name"), F.lit("A server").alias("description"), F.struct(repo("s_nationkey", "s_suppkey").alias("url")).alias("repository"), F.when(F.col("s_acctbal") > 0, F.array(F.struct(F.lit("http").alias("type"), endpoint("s_suppkey").alias("url")))).alias("remotes"))
    rows = [
        s.select(F.lit("registry").alias("source_id"), digits("s_suppkey").alias("upstream_id"), F.to_json(F.struct(server.alias("server"))).alias("text")),
        c.select(F.lit("smithery"), digits("c_custkey"), F.to_json(F.struct(F.concat(F.lit("@c/"), F.col("c_name")).alias("qualifiedName"), F.col("c_mktsegment").alias("description"), F.col("c_custkey").alias("useCount"), F.struct(endpoint("c_custkey").alias("deploymentUrl"), F.array(F.struct(F.lit("http").alias("type"))).alias("connections"), (F.col("c_acctbal") > 0).alias("verified")).alias("_detail")))),
        p.select(F.lit("npm"), digits("p_partkey"), F.to_json(F.struct(F.struct(F.concat(F.lit("p"), digits("p_partkey")).alias("name"), F.col("p_name").alias("description"), F.array("p_brand").alias("keywords"), F.struct(repo("p_size", "p_partkey").alias("repository")).alias("links")).alias("package"), F.struct(F.col("p_size").alias("monthly")).alias("downloads")))),
        n.select(F.lit("github_topics"), digits("n_nationkey"), F.to_json(F.struct(F.concat(F.lit("n"), digits("n_nationkey"), F.lit("/r1")).alias("full_name"), F.lit(7).alias("stargazers_count")))),
        g.select(F.lit("marketplaces"), digits("page_id"), F.to_json(F.struct(F.concat(F.lit("skills/s"), digits("page_id"), F.lit("/SKILL.md")).alias("skill_path"), F.lit("own/skills").alias("repo"), F.col("url").alias("description")))),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return E.keep(out.select("source_id", "upstream_id", F.lit("https://up.example/").alias("url"), F.try_parse_json("text").alias("payload")), "records")


@query()
def catalog_build(spark, sf_dir):
    """Every entry that the build makes: projection, lent signals, demotion, components, fusion, tail, checks, slugs."""
    made, _ = E.build(P.project(recorded(spark, sf_dir)))
    return made.select("canonical_key", "slug", "trust_tier", "popularity", F.size("alias_keys").alias("aliases"), "category", "icon", "transport", "url_unverified", E.publishable().alias("publishable"), F.array_join("demoted_keys", ",").alias("demoted"))


@query()
def frontmatter_parse(spark, sf_dir):
    """Documents as skill files, with a block of YAML before the text."""
    d = read(spark, sf_dir, "documents")
    text = F.concat(F.lit("---\nname: doc-"), F.col("doc_id").cast("string"), F.lit("\nlicense: "), F.coalesce("source", F.lit("")), F.lit("\nallowed-tools: Read, Write\n---\n"), F.coalesce("text", F.lit("")))
    return d.select("doc_id", S.front_matter(text).alias("f")).select("doc_id", "f.name", "f.license", F.array_join("f.allowed_tools", ",").alias("tools"), "f.frontmatter_bytes", "f.fault")


@query(r"""WITH h AS (SELECT url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
one AS (SELECT host, list_sort(list(DISTINCT path) FILTER (WHERE path LIKE '/en/%')) AS en, list_sort(list(DISTINCT path)) AS every FROM h GROUP BY 1)
SELECT host, len(every) AS paths, len(coalesce(en, [])) AS english, len(list_filter(every, lambda x: NOT list_contains(coalesce(en, []), x))) AS others FROM one""")
def key_sets(spark, sf_dir):
    """Key sets of each host: all paths, the English ones, and what the one lacks of the other."""
    from tessera.functions import keys as K

    h = read(spark, sf_dir, "pages").select(K.url_host(F.col("url")).alias("host"), K.url_path(F.col("url")).alias("path"))
    one = h.groupBy("host").agg(F.collect_set("path").alias("every"), F.collect_set(F.when(F.col("path").startswith("/en/"), F.col("path"))).alias("en"))
    return one.select("host", F.size("every").cast("bigint").alias("paths"), F.size("en").cast("bigint").alias("english"), F.size(F.array_except("every", "en")).cast("bigint").alias("others"))


@query("""WITH RECURSIVE w(k, bound) AS (SELECT 1, (SELECT min(o_totalprice) FROM (SELECT o_totalprice FROM orders ORDER BY o_totalprice DESC LIMIT 1000))
UNION ALL SELECT k + 1, (SELECT min(o_totalprice) FROM (SELECT o_totalprice FROM orders WHERE o_totalprice <= bound ORDER BY o_totalprice DESC LIMIT 1000)) FROM w WHERE k < 5) SELECT k, bound FROM w""")
def star_windows(spark, sf_dir):
    """The descent of a search that shows at most 1000 rows: each window is bounded by the least of the one before. Where
    there are fewer than five, the last bound stands for the rest."""
    found = S.star_windows(read(spark, sf_dir, "orders").select("o_totalprice"), windows=5)
    five = spark.range(1, 6).select(F.col("id").cast("int").alias("k")).join(found, F.col("k") == F.col("window"), "left")
    return five.select("k", F.min("bound").over(Window.orderBy("k")).alias("bound"))


@query("""WITH e AS (SELECT s_suppkey AS id, ['mcp:npm:s' || s_suppkey, 'mcp:repo:github.com/n/' || s_nationkey] AS keys FROM supplier),
d AS (SELECT key FROM (SELECT id, unnest(keys) AS key FROM e) WHERE key LIKE 'mcp:repo:%' GROUP BY 1 HAVING count(*) > 1), o AS (SELECT * FROM (VALUES ('mcp:npm:s1'), ('mcp:npm:nobody'), ('mcp:repo:github.com/n/1')) t(key)),
k AS (SELECT id, key FROM (SELECT id, unnest(keys) AS key FROM e) WHERE key NOT IN (SELECT key FROM d))
SELECT 'demoted' AS what, id, key FROM (SELECT id, unnest(keys) AS key FROM e) WHERE key IN (SELECT key FROM d) UNION ALL SELECT 'unresolved', NULL, key FROM o WHERE key NOT IN (SELECT key FROM k)""")
def demoted_and_unresolved(spark, sf_dir):
    """Repository keys that suppliers with disjoint packages claim, by supplier, and keys of overrides that then nobody has."""
    s = read(spark, sf_dir, "supplier")
    keys = F.array(F.concat(F.lit("mcp:npm:s"), "s_suppkey"), F.concat(F.lit("mcp:repo:github.com/n/"), "s_nationkey"))
    made = s.select(F.col("s_suppkey").alias("id"), F.lit("npm").alias("source_id"), F.col("s_suppkey").cast("string").alias("upstream_id"), keys[0].alias("primary_key"), keys.alias("keys"))
    live = E.demoted(made, E.ambiguous_keys(made))
    entries = live.select(F.col("live_keys")[0].alias("canonical_key"), F.slice("live_keys", 2, 16).alias("alias_keys"))
    asked = spark.createDataFrame([("mcp:npm:s1",), ("mcp:npm:nobody",), ("mcp:repo:github.com/n/1",)], "key string")
    return live.select(F.lit("demoted").alias("what"), "id", F.explode("demoted_keys").alias("key")).union(E.unresolved(entries, asked).select(F.lit("unresolved"), F.lit(None).cast("bigint"), "key"))


# What `recorded` comes to: the keys, the components and the tiers of its servers, without the library.
SERVERS = r"""s AS (SELECT s_suppkey AS i, s_nationkey AS n, s_acctbal > 0 AS dials, 'mcp:registry:io.example/' || lower(replace(s_name, '#', '-')) AS registry FROM supplier),
k AS (
  SELECT i, 'mcp:repo:github.com/n' || n || '/r' || i AS key, 's' AS what, dials AS fine FROM s UNION ALL SELECT i, registry, 's', dials FROM s UNION ALL SELECT i, 'mcp:url:s' || i || '.example/mcp', 's', dials FROM s WHERE dials
  UNION ALL SELECT c_custkey, 'mcp:smithery:@c/' || lower(c_name), 'c', c_acctbal > 0 FROM customer UNION ALL SELECT c_custkey, 'mcp:url:s' || c_custkey || '.example/mcp', 'c', c_acctbal > 0 FROM customer
  UNION ALL SELECT p_partkey, 'mcp:npm:p' || p_partkey, 'p', false FROM part UNION ALL SELECT p_partkey, 'mcp:repo:github.com/n' || p_size || '/r' || p_partkey, 'p', false FROM part
  UNION ALL SELECT n_nationkey, 'mcp:repo:github.com/n' || n_nationkey || '/r1', 't', false FROM nation),
m AS (SELECT what || i AS id, key, what, fine FROM k),
e AS (SELECT DISTINCT a.id AS u, b.id AS v FROM m a JOIN m b ON a.key = b.key),
r AS (SELECT u AS id, min(v) AS c FROM (SELECT e.u, f.v FROM e JOIN e f ON e.v = f.u UNION SELECT e.u, g.v FROM e JOIN e f ON e.v = f.u JOIN e g ON f.v = g.u) GROUP BY 1),
ranked AS (SELECT c, key, what, fine, CASE split_part(key, ':', 2) WHEN 'repo' THEN 0 WHEN 'url' THEN 1 WHEN 'registry' THEN 2 WHEN 'npm' THEN 3 ELSE 5 END AS rank FROM m JOIN r USING (id)),
servers AS (SELECT arg_min(key, (rank, key)) AS canonical_key, list_sort(list_distinct(list(key))) AS keys, CASE WHEN bool_or(what = 's' AND fine) THEN 'registry_verified' WHEN bool_or(what = 'c' AND fine) THEN 'smithery_verified' ELSE 'indexed' END AS tier FROM ranked GROUP BY c)"""


@query(f"""WITH {SERVERS} SELECT canonical_key, array_to_string(list_filter(keys, lambda x: x <> canonical_key), ',') AS aliases, tier FROM servers""")
def catalog_identities(spark, sf_dir):
    """Keys, aliases and tier of every server that the build makes of the tables' records."""
    made, _ = E.build(P.project(recorded(spark, sf_dir)))
    return made.where("kind = 'mcp'").select("canonical_key", F.array_join("alias_keys", ",").alias("aliases"), F.col("trust_tier").alias("tier"))


#: Corrections of the curated build: by a package's alias, of a new entry, joining two components; and denials, one by an alias.
CURATED = [
    ("mcp:npm:p7", "mcp", [], {"name": '"Seven"', "description": '"By its package"'}), ("mcp:npm:made-by-hand", "mcp", ["mcp:npm:made-too"], {"name": '"By hand"', "category": '"Design"'}),
    ("mcp:npm:p11", "mcp", ["mcp:npm:p12"], {"homepage": '"https://joined.example"'}),
]
CURATED_DENIED = ["mcp:npm:p20", "mcp:npm:nobody"]


@query(f"""WITH {SERVERS}, hit AS (SELECT s.*, list_contains(keys, 'mcp:npm:p7') AS seven, list_contains(keys, 'mcp:npm:p11') OR list_contains(keys, 'mcp:npm:p12') AS joined FROM servers s WHERE NOT list_contains(keys, 'mcp:npm:p20')),
one AS (SELECT list_sort(list_distinct(flatten(list(keys)))) AS keys FROM hit WHERE joined),
top AS (SELECT arg_min(key, (CASE split_part(key, ':', 2) WHEN 'repo' THEN 0 WHEN 'url' THEN 1 WHEN 'registry' THEN 2 WHEN 'npm' THEN 3 ELSE 5 END, key)) AS canonical_key FROM (SELECT unnest(keys) AS key FROM one))
SELECT canonical_key, array_to_string(list_filter(keys, lambda x: x <> canonical_key), ',') AS aliases, CASE WHEN seven THEN 'curated' ELSE tier END AS tier, CASE WHEN seven THEN 'description,name' ELSE '' END AS curated_fields FROM hit WHERE NOT joined
UNION ALL SELECT top.canonical_key, array_to_string(list_filter(one.keys, lambda x: x <> top.canonical_key), ','), 'curated', 'homepage' FROM one, top
UNION ALL SELECT 'mcp:npm:made-by-hand', 'mcp:npm:made-too', 'curated', 'category,name'""")
def curated_build(spark, sf_dir):
    """The build with overlays: overrides land by alias, join what they name, make entries of their own; denials take the identity."""
    from tessera.operators import curation as U

    overrides = spark.createDataFrame(CURATED, U.OVERRIDE)
    denials = spark.createDataFrame([(k, "not wanted") for k in CURATED_DENIED], "key string, reason string")
    made, _ = E.build(P.project(recorded(spark, sf_dir)), overrides=overrides, denials=denials)
    return made.where("kind = 'mcp'").select("canonical_key", F.array_join("alias_keys", ",").alias("aliases"), F.col("trust_tier").alias("tier"), F.array_join("curated_fields", ",").alias("curated_fields"))


@query(r"""WITH p AS (SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g') AS path, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM pages),
f AS (SELECT DISTINCT host, array_to_string(list_filter(string_split(path, '/'), lambda x: x <> '' AND x <> '.'), '/') || '/SKILL.md' AS file FROM p WHERE path <> '' AND NOT contains(path, '..')),
r AS (SELECT DISTINCT host, string_split(file, '/')[1] AS root FROM f)
SELECT r.host || '/' || r.root AS plugin, count(*) AS files FROM r JOIN f ON r.host = f.host AND starts_with(f.file, r.root || '/') GROUP BY 1""")
def skill_tree(spark, sf_dir):
    """Files below plugins' roots: paths of pages as a repository's tree for each host, its top folders as plugins."""
    from tessera.functions import keys as K

    h = read(spark, sf_dir, "pages").select(K.url_host(F.col("url")).alias("host"), S.safe_path(K.url_path(F.col("url"))).alias("path")).where("path <> ''")
    trees = h.groupBy(F.concat(F.lit("o/"), "host").alias("repo")).agg(F.to_json(F.struct(F.collect_set(F.struct(F.lit("blob").alias("type"), F.concat("path", F.lit("/SKILL.md")).alias("path"))).alias("tree"))).alias("t")).select("repo", F.parse_json("t").alias("payload"))
    root = F.split("path", "/")[0]
    plugins = h.select(F.concat(F.lit("o/"), "host").alias("repo"), root.alias("plugin_root"), F.concat_ws("/", "host", root).alias("plugin")).distinct().withColumns({"marketplace_repo": F.lit("o/m"), "declared": F.array().cast("array<string>")})
    return S.skill_files(plugins, trees).groupBy("plugin").agg(F.count("*").alias("files"))


@query("""WITH c AS (SELECT c_custkey, 'mcp:npm:' || lower(c_name) AS key, c_name, c_acctbal, c_mktsegment FROM customer)
SELECT key, list_aggregate(list_filter([CASE WHEN c_acctbal < 0 THEN 'tool_count' END, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'category' END, CASE WHEN c_custkey % 3 = 0 THEN 'mcp_url' END, CASE WHEN c_custkey % 5 = 0 THEN 'trust_tier' END,
  CASE WHEN c_custkey % 7 = 0 THEN 'alias is canonical' END], lambda x: x IS NOT NULL), 'string_agg', ',') AS violations FROM c WHERE c_acctbal < 0 OR c_mktsegment <> 'BUILDING' OR c_custkey % 3 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 = 0""")
def entry_violations(spark, sf_dir):
    """What the table of constraints says of customers as entries, some of them spoilt."""
    from tessera.operators import constraints as V

    i = F.col("c_custkey")
    key = F.concat(F.lit("mcp:npm:"), F.lower("c_name"))
    made = read(spark, sf_dir, "customer").select(
        key.alias("canonical_key"), F.lit("mcp").alias("kind"), F.when(i % 7 == 0, F.array(key)).otherwise(F.array().cast("array<string>")).alias("alias_keys"), F.lit("a").alias("slug"), F.col("c_name").alias("name"), F.lit("").alias("description"),
        F.when(i % 5 == 0, "best").otherwise("indexed").alias("trust_tier"), F.array(F.struct(F.lit("npm").alias("source_id"), i.cast("string").alias("upstream_id"), F.lit("https://up.example").alias("url"))).alias("sources"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Design").otherwise(F.col("c_mktsegment")).alias("category"), F.lit("mcp").alias("icon"), F.when(i % 3 == 0, "https://a.example/{x}").alias("mcp_url"), F.when(F.col("c_acctbal") < 0, -1).otherwise(3).alias("tool_count"),
    )
    found = made.select(F.col("canonical_key").alias("key"), V.violations(made).alias("v")).where("size(v) > 0")
    order = F.array(*[F.lit(x) for x in ("tool_count", "category", "mcp_url", "trust_tier", "alias is canonical")])
    return found.select("key", F.array_join(F.concat(F.array_intersect(order, "v"), F.array_except("v", order)), ",").alias("violations"))


@query("""WITH c AS (SELECT c_custkey AS i, 'mcp:npm:' || lower(c_name) AS key FROM customer)
SELECT CASE WHEN i % 11 = 4 AND substr(sha256(key), 1, 2) <> '00' THEN 'wrong shard' ELSE 'not canonical' END AS violation, key FROM c WHERE (i % 11 = 4 AND substr(sha256(key), 1, 2) <> '00') OR i % 10 = 3
UNION ALL SELECT 'absent icon', key FROM c WHERE i % 4 = 0 UNION ALL SELECT 'unknown aaa', key FROM c WHERE i % 6 = 1 UNION ALL SELECT 'mistyped deprecated', key FROM c WHERE i % 9 = 2
UNION ALL SELECT 'invalid category', key FROM c WHERE i % 7 = 5 AND i % 4 <> 0 AND i % 6 <> 1 AND i % 9 <> 2""")
def strict_verification(spark, sf_dir):
    """Customers as published lines, some of them spoilt: what verification says of each. A line that doesn't read back strictly
    isn't looked at as an entry."""
    from tessera import commands
    from tessera.operators.catalog import shard
    from tessera.sources import shards

    c = dealt(spark, sf_dir, "customer", "c_custkey")
    i = F.col("c_custkey")
    made = c.select(
        F.concat(F.lit("mcp:npm:"), F.lower("c_name")).alias("canonical_key"), F.lit("mcp").alias("kind"), F.lit("a").alias("slug"), F.col("c_name").alias("name"), F.lit("").alias("description"), F.lit("indexed").alias("trust_tier"), F.lit(0.25).alias("popularity"),
        F.array(F.struct(F.lit("npm").alias("source_id"), i.cast("string").alias("upstream_id"), F.lit("https://up.example").alias("url"))).alias("sources"), F.when(i % 7 == 5, "Nowhere").otherwise("Design").alias("category"), F.lit("mcp").alias("icon"),
    )
    line = F.col("line")
    number = F.regexp_extract("key", "([0-9]+)$", 1).cast("bigint")
    for hit, old, new in ((number % 4 == 0, '"icon":"mcp",', ""), (number % 6 == 1, '{"alias_keys"', '{"aaa":1,"alias_keys"'), (number % 9 == 2, '"deprecated":false', '"deprecated":"no"'), (number % 10 == 3, '"kind":', '"kind": ')):
        line = F.when(hit, F.replace(line, F.lit(old), F.lit(new))).otherwise(line)
    at = F.when(number % 11 == 4, "00").otherwise(shard(F.col("key")))
    scanned = E.keep(commands.lines(made).select(at.alias("shard"), line.alias("line"), "key", "kind"), "lines")
    return shards.violations(scanned, "mcp").union(shards.unsound(scanned, "mcp"))


@query("""SELECT 'registry' AS source, count(*) FILTER (s_suppkey % 5 > 2) AS kept, count(*) FILTER (s_suppkey % 5 = 2) AS unusable FROM supplier
UNION ALL SELECT 'npm', count(*) FILTER (p_partkey % 3 > 0 AND p_partkey % 4 > 0), count(*) FILTER (p_partkey % 4 = 0) FROM part
UNION ALL SELECT 'smithery', count(*) FILTER (c_custkey % 4 > 1), 0 FROM customer""")
def source_drops(spark, sf_dir):
    """Candidates that projections make of records, and records that lack what identifies them: registry servers deleted,
    superseded or without a name, npm packages insecure or without a name, Smithery servers unlisted or inactive."""
    t = lambda name: read(spark, sf_dir, name)
    named = lambda i, k, rest, name: F.when(i % k == rest, "").otherwise(F.concat(F.lit(name), i.cast("string")))
    s, p, c = F.col("s_suppkey"), F.col("p_partkey"), F.col("c_custkey")
    rows = [
        t("supplier").select(F.lit("registry").alias("source_id"), s.cast("string").alias("upstream_id"), F.to_json(F.struct(F.struct(named(s, 5, 2, "io.x/s").alias("name"), F.when(s % 5 == 0, "deleted").otherwise("active").alias("status"), F.when(s % 5 == 1, F.lit(False)).alias("isLatest")).alias("server"), F.struct(F.struct(F.when(s % 5 == 0, "deleted").otherwise("active").alias("status")).alias(P.OFFICIAL[2:-2])).alias("_meta"))).alias("text")),
        t("part").select(F.lit("npm"), p.cast("string"), F.to_json(F.struct(F.struct(named(p, 4, 0, "p").alias("name")).alias("package"), F.struct((p % 3 == 0).alias("insecure")).alias("flags")))),
        t("customer").select(F.lit("smithery"), c.cast("string"), F.to_json(F.struct(F.concat(F.lit("@c/"), c.cast("string")).alias("qualifiedName"), (c % 4 == 0).alias("unlisted"), (c % 4 == 1).alias("inactive")))),
    ]
    records = E.keep(rows[0].union(rows[1]).union(rows[2]).select("source_id", "upstream_id", F.lit("https://up.example/").alias("url"), F.parse_json("text").alias("payload")), "records")
    sources = spark.createDataFrame([("registry",), ("npm",), ("smithery",)], "source string")
    kept = None
    for name in ("registry", "npm", "smithery"):
        one = P.SOURCES[name](records).select("source_id")
        kept = one if kept is None else kept.union(one)
    counted = lambda df, c: df.groupBy(F.col("source_id").alias("source")).agg(F.count("*").alias(c))
    zero = F.lit(0).cast("bigint")
    return sources.join(counted(kept, "kept"), "source", "left").join(counted(P.unusable(records), "unusable"), "source", "left").select("source", F.coalesce("kept", zero).alias("kept"), F.coalesce("unusable", zero).alias("unusable"))


@query("""WITH l AS (SELECT s_suppkey AS place, s_suppkey <= 2 AS seed, CASE WHEN s_suppkey % 13 = 0 THEN 'no name' ELSE 'o' || s_nationkey || '/r' || (s_suppkey % 40) END AS n FROM supplier),
own AS (SELECT lower(n) AS repo, CASE WHEN bool_or(seed) THEN 'seed' ELSE 'reviewed' END AS origin, min(place) AS place, arg_min(n, place) AS full_name FROM l WHERE n <> 'no name' OR seed GROUP BY 1),
f AS (SELECT c_custkey AS i, (CASE WHEN c_custkey % 7 = 0 THEN 'O' ELSE 'o' END) || c_nationkey || '/R' || (c_custkey % 40) AS n FROM customer WHERE c_custkey % 11 <> 0),
t AS (SELECT lower(n) AS repo, arg_min(n, i) AS full_name FROM f WHERE lower(n) NOT IN (SELECT repo FROM own) GROUP BY 1)
SELECT repo, full_name, origin, place, true AS visited FROM own UNION ALL SELECT repo, full_name, 'topic', NULL, false FROM t""")
def discovery(spark, sf_dir):
    """Repositories to visit and those that wait for a review: customers as a search's results, 100 a page, suppliers as
    the reviewed list, its first two as seeds; some names are in capitals, some are no repository."""
    c, s = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    i = F.col("c_custkey")
    name = F.when(i % 11 == 0, "no name").otherwise(F.concat(F.when(i % 7 == 0, "O").otherwise("o"), F.col("c_nationkey").cast("string"), F.lit("/R"), (i % 40).cast("string")))
    items = c.groupBy(F.floor(i / 100).cast("int").alias("page")).agg(F.array_sort(F.collect_list(F.struct(i.alias("i"), name.alias("full_name")))).alias("items"))
    pages = items.select("page", F.lit("https://up.example/").alias("url"), F.parse_json(F.to_json(F.struct("items"))).alias("payload"))
    k = F.col("s_suppkey")
    own = F.when(k % 13 == 0, "no name").otherwise(F.concat(F.lit("o"), F.col("s_nationkey").cast("string"), F.lit("/r"), (k % 40).cast("string")))
    return S.discovered(pages, s.select(own.alias("full_name"), (k <= 2).alias("seed"), k.alias("place")))
