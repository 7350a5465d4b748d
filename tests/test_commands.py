import json

import pytest
from pyspark.sql import functions as F

from tessera import commands
from tessera.operators import constraints as V
from tessera.sources import shards


def crawl(at, n):
    records = [{"source_id": "npm", "upstream_id": f"p{i}", "url": "https://up.example", "payload": {"package": {"name": f"p{i}", "description": "Does é"}, "downloads": {"monthly": i}}} for i in range(n)]
    at.mkdir(exist_ok=True)
    (at / "npm.json").write_text(json.dumps({"source_id": "npm", "url": "u", "sha256": "0", "entry_count": n, "page_count": 1, "records": records}))


OVERLAY = """version: 1
entries:
- key: mcp:npm:p1
  kind: mcp
  aliases: [mcp:npm:p2]
  fields: {name: Joined, description: Two as one, category: Design, url_unverified: false, connector_type: cli}
"""


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """A built catalog: 120 packages, one pair joined by an overlay, one denied."""
    at = tmp_path_factory.mktemp("catalog")
    crawl(at / "crawl", 120)
    (at / "overlays").mkdir()
    (at / "overlays/mcp.yaml").write_text(OVERLAY)
    (at / "overlays/denylist.yaml").write_text("entries:\n- {key: 'mcp:npm:p3', reason: taken over by somebody}\n")
    said = commands.build(spark, str(at / "crawl"), f"file://{at}/out", "2026-01-01T00:00:00Z", overlay=f"file://{at}/overlays")
    return at, said


def bytes_of(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.is_file() and not p.name.endswith(".crc")}


def test_build_export_stats_and_gate(spark, published, capsys, monkeypatch):
    at, said = published
    out = f"file://{at}/out"
    run = lambda *a: (commands.main(list(a), spark), capsys.readouterr().out)
    assert said["kinds"]["mcp"]["written"] == 118 and said["kinds"]["skill"]["written"] == 0 and said["still there"] == []
    assert len(bytes_of(at / "out")) == 514 and run("verify", out) == (0, "{}\n")
    code, text = run("stats", out)
    found = json.loads(text)
    assert found["kinds"] == {"mcp": 118, "skill": 0} and found["tiers"] == {"curated": 1, "indexed": 117} and found["categories"]["Design"] == 1 and found["sources"] == {"npm": 118, "curated": 1} and sum(found["deciles"]) == 118
    code, text = run("export", out, "--limit", "5")
    assert code == 0 and [a["name"] for a in json.loads(text)] == ["Joined"] and text == json.dumps(json.loads(text), indent=2, ensure_ascii=False) + "\n"
    assert run("schema")[1] == (at / "out/schema/catalog.schema.json").read_text()
    before = bytes_of(at / "out")
    fewer = commands.entries(spark, out, "mcp").limit(90)
    monkeypatch.setattr(commands.E, "build", lambda *a, **k: (fewer, fewer.where("false")))  # a build that lost a quarter
    assert run("build", str(at / "crawl"), out, "2026-01-02T00:00:00Z")[0] == commands.REFUSED and bytes_of(at / "out") == before
    (at / "bad").mkdir()
    (at / "bad/mcp.yaml").write_text(OVERLAY.replace("category: Design", "Category: Design"))
    assert run("build", str(at / "crawl"), out, "2026-01-02T00:00:00Z", "--overlays", f"file://{at}/bad")[0] == commands.FAILED and bytes_of(at / "out") == before
    assert run("nothing")[0] == commands.WRONG_CALL


def test_every_fault_is_named(spark, published, tmp_path):
    """Faults are planted one a shard; each is found, by name."""
    at, _ = published
    for name, raw in bytes_of(at / "out").items():
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_bytes(raw)
    full = [p for p in sorted((tmp_path / "mcp").glob("*.jsonl")) if p.stat().st_size]
    put = lambda line, **change: json.dumps({k: v for k, v in (json.loads(line) | change).items() if v is not ...}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    changes = [
        ("unknown extra", lambda x: put(x, extra=1)), ("absent icon", lambda x: put(x, icon=...)), ("mistyped tags", lambda x: put(x, tags="a")), ("mistyped name", lambda x: put(x, name=None)), ("mistyped sources", lambda x: put(x, sources=[{"source_id": "npm"}])),
        ("invalid category", lambda x: put(x, category="Nowhere")), ("invalid popularity", lambda x: put(x, popularity=1.5)), ("invalid mcp_url", lambda x: put(x, mcp_url="https://a.b/x y")), ("not canonical", lambda x: x.replace('":"', '": "', 1)), ("not an entry", lambda x: "[]"),
        ("blank line", lambda x: x + "\n"), ("repeated key", lambda x: x + "\n" + x), ("wrong kind", lambda x: x.replace('"canonical_key":"mcp:', '"canonical_key":"skill:')),
    ]
    for (_, change), p in zip(changes, full, strict=False):
        first, *rest = p.read_text().splitlines()
        p.write_text("\n".join([change(first), *rest]) + "\n")
    crlf = full[len(changes)]
    crlf.write_bytes(crlf.read_bytes().replace(b"\n", b"\r\n"))
    next(p for p in (tmp_path / "skill").glob("*.jsonl")).unlink()
    full[len(changes) + 1].rename(tmp_path / "mcp" / ("00.jsonl" if full[len(changes) + 1].name != "00.jsonl" else "01.jsonl"))
    (tmp_path / "schema/catalog.schema.json").write_text("{}")
    said = commands.verify(spark, f"file://{tmp_path}")
    assert {name for name, _ in changes} | {"missing shard", "wrong shard", "another schema"} <= set(said)
    assert said["missing shard"] == 2 and said["not canonical"] >= 2


def test_a_task_that_fails_leaves_the_catalog_as_it_was(spark, published):
    at, _ = published
    before = bytes_of(at / "out")
    rows = spark.range(400).select(F.concat(F.when(F.col("id") % 2 == 0, "mcp:npm:").otherwise("skill:skill:"), "id").alias("key")).withColumn("kind", F.split("key", ":")[0])
    dies = F.udf(lambda k: 1 / 0 if k.endswith("99") else "{}")
    with pytest.raises(Exception, match="division"):
        shards.publish(rows.withColumn("line", dies("key")), f"file://{at}/out", {"sources.lock": "new"})
    assert bytes_of(at / "out") == before


def test_a_commit_that_stopped_is_ended_or_taken_back(spark, tmp_path):
    root = f"file://{tmp_path}"
    lines = spark.range(40).select(F.concat(F.lit("mcp:npm:"), "id").alias("key"), F.lit("mcp").alias("kind")).withColumn("line", F.to_json(F.struct(F.col("key").alias("canonical_key"))))
    assert shards.publish(lines, root, {"sources.lock": "one"}) == {"mcp": 40, "skill": 0}
    before = bytes_of(tmp_path)
    # Lost while staging: what was staged goes, nothing else changes.
    (tmp_path / ".staging-x").mkdir()
    (tmp_path / ".staging-x/mcp-00-1").write_text("half")
    assert not shards.recover(root) and bytes_of(tmp_path) == before
    # Lost between two moves: the journal is carried out.
    (tmp_path / ".staging-y").mkdir()
    (tmp_path / ".staging-y/b").write_text("two")
    (tmp_path / ".publication").write_text(json.dumps({"staging": ".staging-y", "moves": [[".staging-y/a", "mcp/00.jsonl"], [".staging-y/b", "sources.lock"]]}))
    assert shards.recover(root) and bytes_of(tmp_path) == before | {"sources.lock": b"two"}
    assert shards.publish(lines, root, {"sources.lock": "three"}) == {"mcp": 40, "skill": 0} and bytes_of(tmp_path) == before | {"sources.lock": b"three"}


def test_the_schema_says_what_the_table_says(spark):
    schema = json.loads(V.json_schema())
    assert V.json_schema() == json.dumps(schema, indent=2, sort_keys=True, ensure_ascii=False) + "\n"
    server = schema["$defs"]["McpEntry"]
    assert server["additionalProperties"] is False and server["required"] == sorted(f.name for f in V.ENTRIES["mcp"]) and set(schema["$defs"]) == {*V.STRUCTS, "McpEntry", "SkillEntry"}
    assert server["properties"]["alias_keys"]["maxItems"] == 16 and server["properties"]["mcp_url"]["anyOf"][0]["pattern"] == V.MCP_URL and server["properties"]["kind"]["const"] == "mcp" and server["properties"]["popularity"] == {"type": "number", "minimum": 0.0, "maximum": 1.0, "default": 0.0}
    assert schema["$defs"]["SkillEntry"]["properties"]["plugin"] == {"anyOf": [{"$ref": "#/$defs/PluginRef"}, {"type": "null"}], "default": None}


def test_candidates_and_components_are_checked(spark):
    row = spark.createDataFrame([("mcp", "npm", "a", "https://u", "mcp:npm:a", ["mcp:npm:a"], "indexed"), ("mcp", "", "", "", "mcp:npm:b", ["skill:npm:a"], "best"), (None,) * 7], "kind string, source_id string, upstream_id string, url string, primary_key string, keys array<string>, trust_hint string")
    got = [r.v for r in row.coalesce(1).select(V.candidate_violations(row).alias("v")).collect()]
    assert got[0] == [] and got[1] == ["source_id", "upstream_id", "url", "primary key is no key", "key of another kind", "trust_hint"] and len(got[2]) == 9
    merged = spark.createDataFrame([("mcp", "mcp:npm:a", ["mcp:npm:a"], [], ["s"], "indexed"), ("mcp", "mcp:npm:a", ["mcp:npm:b"], ["x"], [], "indexed")], "kind string, canonical_key string, alias_keys array<string>, demoted_keys array<string>, sources array<string>, trust_tier string")
    assert [r.v for r in merged.coalesce(1).select(V.merged_violations(merged).alias("v")).collect()] == [["alias is canonical"], ["demoted_keys", "no candidate"]]
