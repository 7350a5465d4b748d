"""Projections of upstream records to candidates, on records shaped like what the sources send."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import projections as P

OFFICIAL, PUBLISHER = "io.modelcontextprotocol.registry/official", "io.modelcontextprotocol.registry/publisher-provided"


def records(spark, source_id, *payloads, url="https://up.example/x"):
    rows = [(source_id, f"u{i}", url, json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "source_id string, upstream_id string, url string, text string").withColumn("payload", F.parse_json("text")).drop("text")


def one(spark, source_id, payload, **how):
    found = P.SOURCES[source_id](records(spark, source_id, payload, **how)).collect()
    assert len(found) <= 1
    return found[0] if found else None


def several(spark, source_id, *payloads):
    """The candidates of several records in one go, None where a record makes none."""
    found = {r.upstream_id: r for r in P.SOURCES[source_id](records(spark, source_id, *payloads).coalesce(1)).collect()}
    return [found.get(f"u{i}") for i in range(len(payloads))]


def server(**more):
    return {"server": {"name": "io.acme/files", "title": "Files", "description": "Reads  files", "websiteUrl": "https://acme.dev", **more}, "_meta": {OFFICIAL: {"status": "active", "isLatest": True}}}


def test_registry_elects_an_endpoint(spark):
    remotes = [
        {"type": "sse", "url": "https://a.acme.dev/sse"},
        {"type": "streamable-http", "url": "https://{tenant}.acme.dev/mcp"},
        {"type": "http", "url": "https://z.acme.dev/mcp", "headers": [{"name": "X-Key"}, {"name": "x-key"}, {"name": "Accept"}]},
        {"type": "sse", "url": ""},
    ]
    packages = [{"registryType": "npm", "identifier": "@acme/files", "version": "1.0"}, {"registry_type": "OCI", "name": "acme/files", "transport": {"type": "sse"}}, {"registryType": "pypi"}]
    c = one(spark, "registry", server(remotes=remotes, packages=packages, repository={"url": "https://github.com/Acme/Files.git", "subfolder": "/srv/"}, _meta={PUBLISHER: {"tags": ["Files", "b c", "files", 3]}}))
    assert c.mcp_url == "https://z.acme.dev/mcp" and c.transport == "streamable_http" and (c.auth_hint, c.auth_note) == ("header", "Set the Accept header from the provider's dashboard.")
    assert c["keys"] == ["mcp:npm:@acme/files", "mcp:registry:io.acme/files", "mcp:repo:github.com/acme/files#srv", "mcp:url:z.acme.dev/mcp"] and c.primary_key == "mcp:repo:github.com/acme/files#srv"
    assert [r.url for r in c.remotes] == ["https://z.acme.dev/mcp", "https://{tenant}.acme.dev/mcp", "https://a.acme.dev/sse"] and c.remotes[0].header_names == ["Accept", "X-Key"]
    assert [(x.registry_type, x.identifier, x.transport) for x in c.packages] == [("npm", "@acme/files", "stdio"), ("oci", "acme/files", "sse")]
    assert (c.trust_hint, c.verified_upstream, c.name, c.description, c.tags, c.docs_url, c.setup_note) == ("registry_verified", True, "Files", "Reads files", ["files"], "https://acme.dev", "")


@pytest.mark.parametrize(
    ("meta", "there"),
    [({"status": "deleted"}, False), ({"isLatest": False}, False), ({"isLatest": "false"}, True), ({"status": "Deprecated"}, True), ({}, True)],
)
def test_registry_drops(spark, meta, there):
    c = one(spark, "registry", {"server": {"name": "a/b"}, "_meta": {OFFICIAL: meta}})
    assert (c is not None) == there and (c is None or c.deprecated == (meta.get("status") == "Deprecated"))


def test_registry_without_a_dialable_endpoint(spark):
    c = one(spark, "registry", server(remotes=[{"type": "sse", "url": "https://x.dev/{id}"}], packages=[{"registryType": "npm", "identifier": "p"}]))
    assert c.mcp_url is None and c.transport == "unknown" and c.auth_hint == "bearer" and c.auth_note.startswith("The published endpoint is templated (https://x.dev/{id});") and "Host p yourself" in c.setup_note
    assert c.trust_hint == "indexed" and c.verified_upstream
    bare = one(spark, "registry", {"name": "a/b"})
    assert bare.name == "b" and bare["keys"] == ["mcp:registry:a/b"] and bare.remotes == [] and bare.setup_note == ""


def test_smithery(spark):
    detail = {"connections": [{"type": "http", "deploymentUrl": "https://srv.run/mcp", "configSchema": {"properties": {"apiKey": {"x-to": {"header": "X-Api"}}, "region": {}}}}], "tools": [{"name": "a"}, {"name": "b"}], "verified": True, "useCount": "12"}
    c = one(spark, "smithery", {"qualifiedName": "@a/b", "displayName": "B", "_detail": detail})
    assert (c.mcp_url, c.transport, c.auth_hint, c.tool_count, c.smithery_use_count, c.trust_hint) == ("https://srv.run/mcp", "streamable_http", "bearer", 2, 12, "smithery_verified")
    assert c.auth_note == "This server takes configuration (2 field(s)); supply values from the provider's docs." and c.remotes[0].url == "https://srv.run/mcp" and c.packages == []
    local = one(spark, "smithery", {"qualifiedName": "a/b", "useCount": 3, "_detail": {"connections": [{"type": "stdio"}]}})
    assert local.mcp_url is None and local.packages[0].registry_type == "smithery" and local.auth_hint == "none" and "Host a/b yourself" in local.setup_note and local.tool_count is None
    quiet = one(spark, "smithery", {"qualifiedName": "a/b", "inactive": "true"})
    assert quiet.auth_hint == "bearer" and quiet.docs_url == "https://up.example/x" and quiet.name == "a/b"
    assert one(spark, "smithery", {"qualifiedName": "a/b", "inactive": True}) is None and one(spark, "smithery", {"qualifiedName": " "}) is None
    region = one(spark, "smithery", {"qualifiedName": "a/b", "_detail": {"connections": [{"type": "http", "url": "http://plain/mcp", "configSchema": {"properties": {"region": 1}}}]}})
    assert region.auth_hint == "header" and region.mcp_url is None and region.remotes[0].url == "http://plain/mcp"


def test_npm(spark):
    package = {"name": "@a/mcp", "version": "2.0", "description": "d", "keywords": ["MCP", "x"], "license": "MIT", "links": {"repository": "git+https://github.com/a/b.git"}}
    c = one(spark, "npm", {"package": package, "downloads": {"monthly": 1234}, "dependents": "7", "flags": {"insecure": 0}})
    assert (c.npm_downloads_monthly, c.npm_dependents, c.npm_package, c.tags, c.license, c.docs_url, c.primary_key) == (1234, 7, "@a/mcp", ["mcp", "x"], "MIT", "https://github.com/a/b", "mcp:repo:github.com/a/b")
    assert c.mcp_url is None and c.packages[0].version == "2.0"
    assert one(spark, "npm", {"package": package, "flags": {"insecure": "yes"}}) is None and one(spark, "npm", {"package": {}}) is None


def test_github_topics(spark):
    c = one(spark, "github_topics", {"full_name": "Own/Repo", "stargazers_count": 5, "forks_count": True, "topics": ["mcp"], "archived": True, "license": {"spdx_id": "MIT"}})
    assert (c.github_stars, c.github_forks, c.deprecated, c.name, c.primary_key, c.docs_url) == (5, None, True, "repo", "mcp:repo:github.com/own/repo", "https://github.com/own/repo")
    assert one(spark, "github_topics", {"full_name": "just-one"}) is None


def test_skills(spark):
    payload = {"skill_path": "skills/Do-It/SKILL.md", "repo": "https://github.com/Own/Repo", "frontmatter": {"name": "do-it", "description": "Does it", "disable-model-invocation": True, "allowed-tools": "Read, Write,Read"}, "marketplace": "m", "plugin": {"plugin": "p"}, "marketplace_repo": "own/market", "renamed_from": ["old"], "category": "CRM tools", "tags": ["A"], "commit_sha": "A" * 40, "marketplace_reviewed": "yes", "frontmatter_bytes": 99999}
    second = {"path": "a/SKILL.md", "name": "Not A Name", "marketplaceRepo": "o/r", "model_invocable": False, "description": "flat", "skill": {"description": "nested", "license": "MIT"}}
    gone = ({"skill_path": "a/README.md", "repo": "o/r"}, {"skill_path": "../SKILL.md", "repo": "o/r"}, {"skill_path": "a/SKILL.md"}, {"skill_path": "a b!/SKILL.md", "repo": "o/r"})
    third = {"skill_path": "a/SKILL.md", "plugin_source": {"source_value": "own/deep", "kind": "github"}, "marketplace_repo": "x/y"}
    c, flat, nested, *rest = several(spark, "marketplaces", payload, second, third, *gone)
    assert c["keys"] == ["skill:plugin:m/old/do-it", "skill:plugin:m/p/do-it", "skill:skill:github.com/own/repo/skills/do-it"] and c.primary_key == "skill:skill:github.com/own/repo/skills/do-it"
    assert (c.model_invocable, c.allowed_tools, c.category, c.source_ref, c.commit_sha, c.marketplace_reviewed, c.frontmatter_bytes) == (False, ["Read", "Write"], "CRM Tools", "own/repo/skills/Do-It", "a" * 40, True, 8192)
    assert c.icon_url == "https://github.com/own.png?size=128" and c.plugin.marketplace_repo == "own/market" and c.plugin.source_kind == "unknown"
    assert (flat.skill_name, flat.name, flat.description, flat.license, flat.model_invocable, flat.plugin, flat.category) == ("a", "Not A Name", "flat", "MIT", False, None, "General")
    assert nested.repo.repo == "deep" and rest == [None] * 4


def test_unknown_sources_and_records_without_a_name(spark):
    bad = records(spark, "registry", {"server": {}}, [1], None).union(records(spark, "elsewhere", {"name": "x"})).union(records(spark, "marketplaces", {}))
    assert P.project(bad).count() == 0
    assert sorted((r.source_id, r.reason) for r in P.unusable(bad).collect()) == [("marketplaces", "no skill path"), *[("registry", "no server name")] * 3]


@pytest.mark.parametrize(
    ("raw", "want"),
    [(7, 7), (-3, 0), (2.9, 2), (True, None), ("12", 12), (" 007 ", 7), ("1.5", None), (None, None), (9007199254740993, 9007199254740993), ("1234567890123456789", 1234567890123456789), (1e300, 2**63 - 1), ("9" * 25, 2**63 - 1), (2**63 - 1, 2**63 - 1), ("²", None), ([], None), (-1e300, 0)],
)
def test_counts(spark, raw, want):
    from tessera.functions import lenient

    df = spark.createDataFrame([(json.dumps({"k": raw}),)], "t string").select(F.parse_json("t").alias("v"))
    assert df.select(lenient.count(F.col("v"), "$.k").alias("n")).first().n == want


def test_filters_stay_above_the_steps_that_they_test(spark, sf_dir):
    from tessera.operators.catalog import held_back
    from tessera.plans.build import recorded

    made = recorded(spark, sf_dir)
    for f in P.SOURCES.values():
        plan = f(made)._jdf.queryExecution().optimizedPlan().toString()
        assert max(len(line) for line in plan.splitlines() if "Filter" in line) < 2000
    odd = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, ok boolean")
    assert [(r.i, r.ok) for r in held_back(odd, "ok").collect()] == [(1, True)]
    assert [r.i for r in held_back(odd, F.col("i") > 2).collect()] == [3]


def test_projections_of_the_build_are_planned_over_a_table(spark, sf_dir):
    from tessera.plans.build import recorded

    made = recorded(spark, sf_dir)
    assert {r.source_id: r.n for r in made.groupBy("source_id").agg(F.count("payload").alias("n")).collect()}.keys() == P.SOURCES.keys()
    for f in P.SOURCES.values():
        plan = f(made)._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" not in plan and "Union" not in plan


def test_projections_leave_no_constant_to_be_lowered_by_the_planner(spark, sf_dir):
    from pyspark.sql import functions as F

    from tessera.functions import lenient as L

    rows = spark.createDataFrame([('{"a": " \u00c4Bc "}',), ('{"a": 7}',), ('{"a": null}',), ("{}",), ("no JSON",), (None,)], "s string").select(F.try_parse_json("s").alias("v"))
    assert [(r.low, r.before) for r in rows.select(L.low(F.col("v"), "$.a").alias("low"), F.lower(L.text(F.col("v"), "$.a")).alias("before")).collect()] == [("\u00e4bc", "\u00e4bc"), *[("", "")] * 5]
    records = spark.createDataFrame([], "source_id string, upstream_id string, url string, s string").withColumn("payload", F.try_parse_json("s")).drop("s")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        for f in P.SOURCES.values():  # Spark lowers both branches of such a CASE, the constant one on the driver
            assert "lower(CASE" not in f(records)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_claims_are_compared_over_a_table(spark):
    from pyspark.sql import functions as F

    from tessera.operators.entries import ambiguous_keys

    claims = [("a", "mcp:repo:github.com/o/r", "mcp:npm:one"), ("b", "mcp:repo:github.com/o/r", "mcp:npm:two"), ("c", "mcp:repo:github.com/o/s", "mcp:npm:three")]
    made = spark.createDataFrame([("npm", i, k, [k, v]) for i, k, v in claims], "source_id string, upstream_id string, primary_key string, keys array<string>")
    found = ambiguous_keys(made.where(F.size("keys") > 1))
    assert [r.key for r in found.collect()] == ["mcp:repo:github.com/o/r"]
    assert "LogicalRDD" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_steps_of_a_slug_stand_in_the_plan_once(spark):
    from tessera.operators.entries import provisional_slug

    names = "registry_name string, smithery_qualified_name string, npm_package string, skill_name string, repo struct<repo: string>, name string, canonical_key string"
    rows = [("io.x/mcp-Tool-server", "@q/n", None, None, None, None, "a:b:k"), ("...", "@q/N n", None, None, None, None, "a:b:k"), (None, None, "@s/pack", None, None, None, "a:b:k"), ("", "", "--", None, ("re.po",), "x", "a:b:k"), (None, None, None, None, None, "é", "mcp:npm:o/last"), (None, None, None, None, None, None, "::")]
    made = spark.createDataFrame(rows, names).select(provisional_slug().alias("slug"))
    assert [r.slug for r in made.collect()] == ["tool", "n_n", "pack", "re_po", "last", None]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("[^a-z0-9_]+") <= 2  # nullif may say it twice
