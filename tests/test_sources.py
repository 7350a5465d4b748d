import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import lenient
from tessera.sources import fetches, overlays, shards


def test_recorded_crawls(spark, tmp_path):
    rows = [{"source_id": "npm", "upstream_id": i, "url": "u", "payload": {"n": n}} for i, n in (("a", 1), ("b", "x"))]
    (tmp_path / "npm.json").write_text(json.dumps({"source_id": "npm", "url": "u", "sha256": "0", "entry_count": 2, "page_count": 1, "records": rows}, indent=1))
    got = fetches.fetches(spark, str(tmp_path))
    read = fetches.records(got).select("upstream_id", lenient.count(F.col("payload"), "$.n").alias("n")).collect()
    assert sorted((r.upstream_id, r.n) for r in read) == [("a", 1), ("b", None)]
    assert fetches.lock(got, "2026-01-01T00:00:00Z").first().fetched_at == "2026-01-01T00:00:00Z"


def test_shards_written_and_scanned(spark, tmp_path):
    root = f"file://{tmp_path}"
    lines = spark.range(40).select(F.concat(F.lit("mcp:npm:"), "id").alias("key"), F.lit("mcp").alias("kind")).withColumn("line", F.to_json(F.struct(F.col("key").alias("canonical_key"))))
    assert shards.publish(lines, root) == {"mcp": 40, "skill": 0}
    files = sorted((tmp_path / "mcp").glob("*.jsonl"))
    assert len(files) == 256 == len(list((tmp_path / "skill").glob("*.jsonl"))) and any(f.stat().st_size == 0 for f in files)
    assert all(f.read_text().splitlines() == sorted(f.read_text().splitlines()) for f in files)
    scanned = shards.scan_shards(spark, root, "mcp")
    assert scanned.count() == 40 and shards.violations(scanned, "mcp").count() == 0
    assert shards.violations(scanned.union(scanned.limit(1)), "mcp").count() == 1 and shards.violations(scanned, "skill").count() == 40


def test_overlays(spark):
    pytest.importorskip("yaml")
    got = overlays.overrides(spark, "version: 1\nentries:\n- key: mcp:npm:a\n  aliases: ['mcp:npm:z', 'mcp:npm:b']\n  fields: {name: A, deprecated: true, tags: [x]}\n").first()
    assert (got.key, got.kind, got.aliases, got.fields) == ("mcp:npm:a", "mcp", ["mcp:npm:b", "mcp:npm:z"], {"name": '"A"', "deprecated": "true", "tags": '["x"]'})
    one = "entries:\n- {key: 'mcp:npm:a', fields: {name: A}}\n"
    for texts in ((one, one), ("- a\n",), (one.replace("name", "iconUrl"),), (one.replace("{name: A}", "[name]"),), ("entries:\n- {key: 'mcp:npm:a', aliases: x}\n",), ("entries:\n- {fields: {}}\n",)):
        with pytest.raises(overlays.OverlayError):
            overlays.overrides(spark, *texts)
    with pytest.raises(overlays.OverlayError):
        overlays.overrides(spark, one, kinds=("skill",))
    assert overlays.denials(spark, "entries:\n- {key: k, reason: long enough}\n").count() == 1
    for bad in ("entries:\n- {key: k, reason: short}\n", "entries: []\nentries: []\n"):
        with pytest.raises(overlays.OverlayError):
            overlays.denials(spark, bad)


def test_verification_parses_a_line_once(spark):
    from tessera.sources import shards

    lines = spark.createDataFrame([("00", "{}", "mcp:npm:a", "mcp")], "shard string, line string, key string, kind string")
    asked = lambda df: df._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson")
    assert asked(shards.unsound(lines, "mcp")) == 0  # the checked lines are a table
    assert asked(shards.violations(lines, "mcp")) == 1
