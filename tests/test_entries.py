"""From candidates to published entries."""

import json

import pytest
from pyspark.sql import functions as F
from test_projections import OFFICIAL, records

from tessera.operators import constraints as V
from tessera.operators import entries as E
from tessera.operators import projections as P


def npm(name, repo="", monthly=None, description="", keywords=()):
    return {"package": {"name": name, "version": "1", "description": description, "keywords": list(keywords), "links": {"repository": repo}}, "downloads": {"monthly": monthly}}


@pytest.fixture(scope="module")
def build(spark):
    server = {"server": {"name": "io.acme/server-notion", "title": "Notion", "description": "Wiki pages", "repository": {"url": "https://github.com/acme/notion"}, "remotes": [{"type": "http", "url": "https://mcp.acme.dev/"}]}, "_meta": {OFFICIAL: {"status": "active"}}}
    parts = [
        ("registry", server, {"server": {"name": "io.other/notion", "description": "Another", "packages": [{"registryType": "npm", "identifier": "notion-other"}]}}),
        ("smithery", {"qualifiedName": "@acme/notion", "useCount": 50, "description": "From smithery", "_detail": {"deploymentUrl": "https://mcp.acme.dev/", "connections": [{"type": "http"}], "verified": True}}),
        ("npm", npm("notion-mcp", "https://github.com/acme/notion", 100, "A package", ["b", "a"]), npm("one", "https://github.com/mono/repo", 7), npm("two", "https://github.com/mono/repo", 5, "Stripe payments")),
        ("github_topics", {"full_name": "mono/repo", "stargazers_count": 42}, {"full_name": "acme/notion", "stargazers_count": 10, "topics": ["C"]}),
        ("marketplaces", {"skill_path": "skills/x/SKILL.md", "repo": "own/skills", "description": "A skill"}),
    ]
    rows = [(source, f"{source}{i}", "https://up.example/x", json.dumps(p)) for source, *payloads in parts for i, p in enumerate(payloads)]
    every = spark.createDataFrame(rows, "source_id string, upstream_id string, url string, text string").coalesce(1).withColumn("payload", F.parse_json("text")).drop("text")
    curated = spark.createDataFrame([("mcp:npm:notion-other",)], "key string")
    made, wrong = E.build(P.project(every), curated)
    return made, wrong, {r.canonical_key: r for r in made.collect()}


def test_components_and_fusion(build):
    _, wrong, by = build
    assert wrong.count() == 0
    notion = by["mcp:repo:github.com/acme/notion"]
    assert notion.alias_keys == ["mcp:npm:notion-mcp", "mcp:registry:io.acme/server-notion", "mcp:smithery:@acme/notion", "mcp:url:mcp.acme.dev"]
    assert (notion.name, notion.description, notion.trust_tier, notion.slug) == ("Notion", "Wiki pages", "registry_verified", "notion_" + notion.slug[-4:])
    assert (notion.github_stars, notion.npm_downloads_monthly, notion.smithery_use_count, notion.tags) == (10, 100, 50, ["a", "b", "c"])
    assert [s.source_id for s in notion.sources] == ["registry", "smithery", "npm", "github_topics"] and [x.identifier for x in notion.packages] == ["notion-mcp"]
    assert notion.mcp_url == "https://mcp.acme.dev/" and not notion.url_unverified and not notion.stdio_only and notion.category == "Documents & knowledge" and notion.icon == "notebook"
    assert notion.icon_url == "https://api.smithery.ai/servers/@acme/notion/icon" and 0 < notion.popularity < 1


def test_ambiguous_repositories_are_demoted_and_lend_signals(build):
    _, _, by = build
    assert set(by) == {"mcp:repo:github.com/acme/notion", "mcp:registry:io.other/notion", "mcp:npm:one", "mcp:npm:two", "skill:skill:github.com/own/skills/skills/x"} | {k for k in by if k.endswith("mono/repo")}
    assert "mcp:repo:github.com/mono/repo" not in by  # its own candidate has no key left
    assert by["mcp:npm:one"].github_stars == 42 and by["mcp:npm:one"].demoted_keys == ["mcp:repo:github.com/mono/repo"]
    assert by["mcp:npm:two"].category == "Payments & commerce" and by["mcp:npm:two"].stdio_only and "Host two yourself" in by["mcp:npm:two"].setup_note and by["mcp:npm:two"].url_unverified


def test_tiers_and_slugs(build):
    _, _, by = build
    other = by["mcp:registry:io.other/notion"]
    assert other.trust_tier == "curated" and other.slug == "notion" and other.stdio_only  # a curated entry keeps the plain slug
    skill = by["skill:skill:github.com/own/skills/skills/x"]
    assert (skill.slug, skill.category, skill.icon_url) == ("x", "General", "https://github.com/own.png?size=128")


def test_publication(build):
    made, _, _ = build
    apps = [json.loads(r.app) for r in E.export(made).orderBy("place").collect()]
    assert [a["slug"] for a in apps][0] == "notion" and len(apps) == 2 and E.export(made, -1).count() == 0
    assert "icon_url" not in apps[1] and apps[1]["mcp_url"] == "https://mcp.acme.dev/" and "url_unverified" not in apps[1] and apps[0]["stdio_only"] is True and list(apps[0])[:5] == ["slug", "name", "category", "icon", "description"]


def test_canonical_lines(spark, build):
    made, _, by = build
    kinds = {c: made.schema[c].dataType for c in made.columns}
    lines = {json.loads(r.line)["canonical_key"]: r.line for r in made.select(E.canonical_line(kinds).alias("line")).collect()}
    for key, line in lines.items():
        assert line == json.dumps(json.loads(line), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert json.loads(line)["popularity"] == by[key].popularity and "tool_count" in json.loads(line)
    small = spark.createDataFrame([(0.0001, "é"), (0.5, "b"), (0.0, None), (1.0, "")], "popularity double, name string")
    assert [r[0] for r in small.select(E.canonical_line({"popularity": "double", "name": "string"})).collect()] == ['{"name":"é","popularity":0.0001}', '{"name":"b","popularity":0.5}', '{"name":null,"popularity":0.0}', '{"name":"","popularity":1.0}']


def test_violations(spark, build):
    made, _, _ = build
    bad = made.where("kind = 'mcp'").limit(1)
    for change, name in (({"slug": F.lit("No Slug")}, "slug"), ({"mcp_url": F.lit("http://x")}, "mcp_url"), ({"category": F.lit("Nope")}, "category"), ({"alias_keys": F.array("canonical_key")}, "alias is canonical"), ({"docs_url": F.lit("ftp://x")}, "docs_url"), ({"popularity": F.lit(1.5)}, "popularity"), ({"mcp_url": F.lit("https://a.b/x y")}, "mcp_url"), ({"mcp_url": F.lit("https://a.b/x}")}, "mcp_url"), ({"connector_config": F.expr("map('', 'x')")}, "connector_config")):
        changed = bad.withColumns(change)
        assert changed.select(V.violations(changed).alias("v")).first().v == [name]
    with pytest.raises(E.BuildError):
        one = P.project(records(spark, "npm", npm("a")))
        E.build(one.withColumn("url", F.lit("u")).withColumn("primary_key", F.lit("mcp:npm:a")).withColumn("keys", F.array(F.lit("mcp:npm:a b"))), most_bad=0)


def test_unresolved_overrides(spark, build):
    made, _, _ = build
    keys = spark.createDataFrame([("mcp:npm:notion-mcp",), ("mcp:npm:nobody",), ("mcp:npm:nobody",)], "key string")
    assert [r.key for r in E.unresolved(made, keys).collect()] == ["mcp:npm:nobody"]
