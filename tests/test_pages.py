"""Recorded pages, read into records."""

import json

import pytest
from pyspark.sql import functions as F
from test_projections import OFFICIAL

from tessera.operators import projections
from tessera.sources import pages as S


def paged(spark, *payloads, **columns):
    rows = [(i, f"https://up/{i}", json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "page int, url string, text string").withColumn("payload", F.parse_json("text")).drop("text").withColumns({k: F.lit(v) for k, v in columns.items()})


def test_registry_pages(spark):
    item = lambda name, **meta: {"server": {"name": name}, "_meta": {OFFICIAL: meta}}
    p = paged(spark, {"servers": [item("a/b c", status="active"), item("old", isLatest=False), item("gone", status="Deleted"), {"name": "bare"}, {"server": {}}], "metadata": {"nextCursor": "x1"}}, {"servers": [item("a/b c", status="late")]}, {"servers": None}, {"nope": 1})
    got = {r.upstream_id: r.url for r in S.registry_records(p).collect()}
    assert got == {"a/b c": "https://registry.modelcontextprotocol.io/v0/servers/a%2Fb%20c/versions", "bare": "https://registry.modelcontextprotocol.io/v0/servers/bare/versions"}
    assert {r.upstream_id for r in S.registry_records(p, include_deleted=True).collect()} == {*got, "gone"}
    assert [r.page for r in S.faults(p, "registry").collect()] == [3]
    assert [r[0] for r in p.orderBy("page").select(S.next_cursor(F.col("payload"))).collect()] == ["x1", None, None, None]
    kept = S.registry_records(p).where("upstream_id = 'a/b c'").select(F.to_json("payload")).first()[0]
    assert json.loads(kept)["_meta"][OFFICIAL]["status"] == "active"


def test_smithery_pages(spark):
    p = paged(spark, {"servers": [{"qualifiedName": "a", "useCount": 9}, {"qualifiedName": "b", "useCount": 3}, {"qualifiedName": "c", "inactive": True}, {"qualifiedName": "a", "useCount": 1}, {}]})
    schema = {"properties": {"k": {"type": "string", "x-to": {"header": "X", "more": 1}}, "z": 1}, "required": ["z", "k", 3], "title": "no"}
    d = paged(spark, {"qualifiedName": "a", "deploymentUrl": "https://a/mcp", "connections": [{"type": "http", "configSchema": schema}, 4], "tools": [{"name": "t", "inputSchema": {}}], "useCount": "7", "extra": 1}, {"qualifiedName": "b", "displayName": "B"})
    got = {r.upstream_id: json.loads(r.j) for r in S.smithery_records(p, d, top=1).select("upstream_id", F.to_json("payload").alias("j")).collect()}
    assert set(got) == {"a", "b"} and "_detail" not in got["b"] and got["a"]["useCount"] == 9
    detail = got["a"]["_detail"]
    assert len(detail) == 11 and detail["tools"] == [{"name": "t"}] and detail["useCount"] is None and detail["iconUrl"] is None
    assert detail["connections"] == [{"configSchema": {"properties": {"k": {"x-to": {"header": "X"}}, "z": {"x-to": None}}, "required": ["k", "z"]}, "deploymentUrl": None, "type": "http", "url": None}]
    c = projections.smithery(S.smithery_records(p, d)).where("smithery_qualified_name = 'a'").first()
    assert c.mcp_url == "https://a/mcp" and c.tool_count == 1 and c.auth_hint == "header"


def test_npm_and_topic_pages(spark):
    p = paged(spark, {"objects": [{"package": {"name": " x "}}, {"package": {"name": "bad"}, "flags": {"insecure": 1}}, {"package": {"name": "worse"}, "flags": {"insecure": "no"}}, {"package": {}}]}, {"objects": [{"package": {"name": "x"}}]})
    assert [(r.upstream_id, r.url) for r in S.npm_records(p).collect()] == [("x", "https://www.npmjs.com/package/x")]
    t = paged(spark, {"items": [{"full_name": "A/B", "stargazers_count": 5}, {"full_name": "a/b"}, {"full_name": "none"}, {"full_name": "c/d", "html_url": "https://h", "stargazers_count": 3}]}, topic="mcp")
    assert sorted((r.upstream_id, r.url) for r in S.topic_records(t).collect()) == [("a/b", "https://github.com/A/B"), ("c/d", "https://h")]
    seen = S.topic_records(t).withColumn("topic", F.lit("mcp"))
    assert tuple(S.window_bound(seen).first()) == ("mcp", 3)


def test_discovered_repositories(spark):
    item = lambda *names: {"items": [{"full_name": n} for n in names]}
    p = paged(spark, item("X/Second", "s/eed", "bad name", None, " new/One "), item("NEW/one", "r/ev", "x/second", "n" * 65 + "/r"), {"items": None}, {"other": 1})
    listed = spark.createDataFrame([("S/Eed", True, 0), ("R/ev", False, 1), ("s/eed", False, 2), ("not a name", False, 3), ("odd seed", True, 4), (None, False, 5), ("r/EV", None, 6)], "full_name string, seed boolean, place int")
    both = {("s/eed", "S/Eed", "seed", 0, True), ("odd seed", "odd seed", "seed", 4, True), ("r/ev", "R/ev", "reviewed", 1, True)}
    for only in (True, False):
        topics = {("x/second", "X/Second", "topic", None, not only), ("new/one", "new/One", "topic", None, not only)}
        assert {tuple(r) for r in S.discovered(p, listed, only).collect()} == both | topics
    assert S.discovered(p.where("false"), listed.where("false")).count() == 0
    assert {r.origin for r in S.discovered(p, listed.where("false")).collect()} == {"topic"}


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("./plugins/a/", ("relative", "plugins/a", "", "", "")), ("../up", ("unknown", '"../up"', "", "", "")), (None, ("unknown", "null", "", "", "")), (7, ("unknown", "7", "", "", "")),
        ({"source": "url", "url": "https://g/x.git", "sha": "A" * 40}, ("url", "https://g/x.git", "", "", "a" * 40)), ({"source": "URL", "url": "https://g/x", "path": "in/x", "ref": "v1"}, ("git-subdir", "https://g/x", "in/x", "v1", "")),
        ({"source": "git-subdir", "url": "u", "path": "p"}, ("git-subdir", "u", "p", "", "")), ({"source": "github", "repo": "o/r"}, ("github", "https://github.com/o/r", "", "", "")), ({"source": "npm", "package": "@a/b"}, ("npm", "@a/b", "", "", "")),
        ({"source": "github", "repo": "nope"}, ("unknown", '{"repo":"nope","source":"github"}', "", "", "")), ({"source": "url", "url": "u", "path": "../x"}, ("unknown", '{"path":"../x","source":"url","url":"u"}', "", "", "")),
    ],
)
def test_plugin_sources(spark, source, want):
    df = spark.createDataFrame([(json.dumps(source),)], "t string").select(F.parse_json("t").alias("v"))
    assert tuple(df.select(S.plugin_source(F.col("v")).alias("s")).first().s) == want


def test_plugins_and_their_skills(spark):
    manifest = {"name": "m", "owner": {"name": "o"}, "metadata": {"pluginRoot": "./pl"}, "renames": {"old": "one", "older": "one", "x": 3}, "plugins": [{"name": "one", "source": "./one", "skills": ["./more", "../no", "extra/SKILL.md"], "keywords": "A, b c,d", "category": "CRM tools"}, {"name": "one", "source": "./again"}, {"name": "two", "source": {"source": "github", "repo": "Ext/Repo"}}, {"source": "./x"}]}
    m = paged(spark, manifest, {"name": "", "owner": "o", "plugins": []}, marketplace_repo="o/market")
    found = S.plugins(m)
    got = {r.plugin: r for r in found.collect()}
    assert set(got) == {"one", "two"} and got["one"].plugin_root == "pl/one" and got["one"].declared == ["extra", "more"] and got["one"].tags == ["a", "d"] and got["one"].category == "CRM Tools" and got["two"].repo == "Ext/Repo"
    assert [tuple(r) for r in S.renames(m).collect()] == [("o/market", "one", ["old", "older"])]
    blob = lambda p, t="blob": {"type": t, "path": p}
    trees = paged(spark, {"tree": [blob("pl/one/skills/a/SKILL.md"), blob("pl/one2/b/SKILL.md"), blob("SKILL.md"), blob("pl/one/x/SKILL.md", "tree")]}, repo="o/market").unionByName(paged(spark, {"tree": [blob("deep/er/SKILL.md"), blob("SKILL.md"), blob("a/README.md")]}, repo="ext/repo"))
    assert sorted((r.plugin, r.skill_path) for r in S.skill_files(found, trees).collect()) == [("one", "pl/one/extra/SKILL.md"), ("one", "pl/one/more/SKILL.md"), ("one", "pl/one/skills/a/SKILL.md"), ("two", "deep/er/SKILL.md")]


def test_front_matter(spark):
    texts = [
        "---\nname: Do-It\ndescription: >\n  two\n  lines\nallowed-tools: Read, Write,Read\ndisable-model-invocation: yes\nversion: 1.0\n---\nbody", "﻿---\r\nname: x\r\nallowed_tools: [b, a, 3]\r\n---", "no", None, "---\nname: x\n", "---\nname: [\n---", "---\n- a\n---", "---\nname: Not Good\n---", "---\nname: x\ndescription: " + "y" * 9000 + "\n---",
    ]
    got = [r.f for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(S.front_matter(F.col("t")).alias("f")).collect()]
    assert (got[0].name, got[0].description, got[0].allowed_tools, got[0].disable_model_invocation, got[0].version, got[0].fault) == ("do-it", "two lines", ["Read", "Write"], True, "1.0", None)
    assert (got[1].name, got[1].allowed_tools, got[1].disable_model_invocation) == ("x", ["a", "b"], False)
    assert [g.fault for g in got[2:]] == ["no block", "no block", "never closed", "no YAML", "no mapping", "no usable name", "too long"]
