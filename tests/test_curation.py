"""Overlays by identity, in the build."""

import json

import pytest
from pyspark.sql import functions as F
from test_entries import npm

from tessera.operators import curation as U
from tessera.operators import entries as E
from tessera.operators import projections as P

REPO, TAVILY = "mcp:repo:github.com/tavily/mcp", "mcp:npm:tavily-mcp"


@pytest.fixture(scope="module")
def candidates(spark):
    server = {"server": {"name": "io.brave/search", "description": "Search", "remotes": [{"type": "http", "url": "https://mcp.brave.dev/"}]}}
    rows = [("npm", npm("tavily-mcp", "https://github.com/tavily/mcp", 10, "Crawled")), ("npm", npm("other", "https://github.com/o/o", 5)), ("npm", npm("brave", "https://github.com/brave/search", 3)), ("registry", server), ("github_topics", {"full_name": "lone/repo", "stargazers_count": 4})]
    every = spark.createDataFrame([(s, f"{s}{i}", "https://up.example/x", json.dumps(p)) for i, (s, p) in enumerate(rows)], "source_id string, upstream_id string, url string, text string")
    return E.keep(P.project(every.withColumn("payload", F.parse_json("text")).drop("text")), "candidates-for-overlays")


@pytest.fixture(scope="module")
def entries(candidates):
    return E.keep(E.build(candidates)[0], "entries-for-overlays")


def override(key, aliases=(), kind="mcp", **fields):
    return {"key": key, "kind": kind, "aliases": sorted(aliases), "fields": {k: json.dumps(v) for k, v in fields.items()}}


def applied(spark, entries, overrides, denied=()):
    denials = spark.createDataFrame([(k, "taken over") for k in denied], "key string, reason string")
    out, stale = U.apply(entries, U.check(list(overrides)), denials)
    return {r.canonical_key: r for r in out.collect()}, stale


SLACK, NEW = "mcp:registry:dev.example/slack", "mcp:url:new.example"


@pytest.fixture(scope="module")
def curated(spark, entries):
    """Everything that holds together, in one go."""
    said = [
        override(TAVILY, ["mcp:smithery:@t/t"], name="By package", homepage="https://t.example", mcp_url="https://mcp.tavily.dev/", docs_url="https://docs.tavily.dev"),
        override(REPO, name="Tavily", auth_note="Use a key", tags=["Search", "b b"], tool_count=7, trust_tier="indexed"),
        override("mcp:npm:other", name="Other", popularity_signals={"github_stars": 9}),
        override(SLACK, slug="slack", name="Slack", description="Channels and people.", category="Communication", icon="message-square", url_unverified=True, connector_type="github"),
        override("mcp:npm:fresh-name", ["mcp:npm:second"]), override(NEW, ["mcp:url:newer.example"], name="New"), override("mcp:url:newer.example", name="Newer"),
    ]
    return applied(spark, entries, said, ["mcp:npm:brave", "mcp:npm:never-was"])


def test_fields_are_laid_over_one_at_a_time(curated, entries):
    by, _ = curated
    one = by["mcp:repo:github.com/o/o"]  # found by its package
    assert (one.name, one.trust_tier, one.curated_fields, one.github_stars, one.npm_downloads_monthly) == ("Other", "curated", ["name", "popularity_signals"], 9, None)
    assert [s.source_id for s in one.sources] == ["curated", "npm"] and one.stdio_only and one.url_unverified and "mcp:npm:other" in one.alias_keys
    assert by["mcp:url:mcp.brave.dev"].trust_tier == "registry_verified"


def test_overrides_of_one_entry_apply_in_order_of_key(curated):
    by, _ = curated
    one = by[REPO]  # npm sorts before repo, so what the repository's override says comes last
    assert TAVILY not in by and one.alias_keys == [TAVILY, "mcp:smithery:@t/t"] and (one.name, one.auth_note, one.description, one.trust_tier) == ("Tavily", "Use a key.", "Crawled", "indexed")
    assert one.curated_fields == ["auth_note", "docs_url", "homepage", "mcp_url", "name", "tags", "tool_count", "trust_tier"] and one.tags == ["search"] and one.tool_count == 7
    assert not one.stdio_only and not one.url_unverified and one.sources[0].url == "https://docs.tavily.dev" and one.homepage == "https://t.example"
    assert by[NEW].name == "Newer" and "mcp:url:newer.example" not in by and by[NEW].trust_tier == "curated"


def test_what_no_entry_has_is_created(curated):
    by, _ = curated
    one = by[SLACK]
    assert (one.slug, one.trust_tier, one.popularity, one.category, one.url_unverified, one.stdio_only) == ("slack", "curated", 0.0, "Communication", True, False)
    assert [tuple(s) for s in one.sources] == [("curated", SLACK, U.N.CURATED_URL)] and one.alias_keys == []
    assert by["mcp:npm:fresh-name"].slug == "fresh_name" and by["mcp:npm:fresh-name"].alias_keys == ["mcp:npm:second"]


def test_denials_take_the_whole_identity(spark, entries, curated):
    by, stale = curated
    assert not any("brave/search" in k and "repo" in k for k in by) and len(by) == entries.count() - 1 + 3 and stale == ["mcp:npm:never-was"]
    for o in (override(REPO, name="Back again"), override("mcp:npm:x", [REPO]), override("mcp:npm:y", [TAVILY])):
        with pytest.raises(U.CurationError, match="denied"):
            applied(spark, entries, [o], [TAVILY])
    with pytest.raises(U.CurationError, match="denied"):
        applied(spark, entries, [override("mcp:npm:never-was")], ["mcp:npm:never-was"])


def test_what_contradicts_itself_fails(spark, entries):
    for bad, says in (
        ([override(REPO, iconUrl="https://x.example")], "iconUrl"), ([override(REPO, canonical_key="mcp:npm:z")], "may not set"), ([override(REPO), override(REPO)], "two overrides"), ([override("skill:npm:a")], "kind"),
        ([override(REPO, category="Miscellaneous", mcp_url="https://a.b/{x}")], "category.*mcp_url"), ([override(REPO, name=5)], "name"), ([override(REPO, ["no key"])], "none of its kind"), ([override(REPO, kind="other")], "no kind"),
    ):
        with pytest.raises(U.CurationError, match=says):
            applied(spark, entries, bad)


def test_the_build_joins_what_an_override_names_together(spark, candidates):
    rows = [override("mcp:npm:brave", ["mcp:registry:io.brave/search"], name="Brave"), override("mcp:npm:nobody", ["mcp:npm:nobody2"], name="Nobody")]
    overrides = spark.createDataFrame([(o["key"], o["kind"], o["aliases"], o["fields"]) for o in rows], U.OVERRIDE)
    denials = spark.createDataFrame([("mcp:npm:other", "taken over")], "key string, reason string")
    made, wrong = E.build(candidates, overrides=overrides, denials=denials)
    by = {r.canonical_key: r for r in made.collect()}
    brave = by["mcp:repo:github.com/brave/search"]
    assert {"mcp:npm:brave", "mcp:registry:io.brave/search"} <= set(brave.alias_keys) and brave.name == "Brave" and brave.trust_tier == "curated" and brave.slug == "search"
    assert by["mcp:npm:nobody"].alias_keys == ["mcp:npm:nobody2"] and "mcp:repo:github.com/o/o" not in by and wrong.count() == 0
    assert not any("io.brave" in k for k in by)
