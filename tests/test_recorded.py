"""Recorded pages as a data source, and what only its records need."""

import json

import pytest
from pyspark.sql import functions as F
from test_pages import paged

from tessera.operators import catalog as C
from tessera.operators import projections as P
from tessera.sources import pages as S
from tessera.sources import recorded as R


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    at = tmp_path_factory.mktemp("recorded")
    page = lambda source, n, body: ((at / source).mkdir(exist_ok=True), (at / source / f"{n}.json").write_text(json.dumps({"url": f"https://up/{n}", "body": body})))
    for n in range(1, 13):  # 12 pages of 5, two of each seen on the page before
        page("npm", n, {"objects": [{"package": {"name": f"p{3 * n + i}"}} for i in range(5)]})
    page("registry", 1, {"servers": [{"server": {"name": "a/b"}}, {"server": {"name": "c/d", "status": "deleted"}}]})
    page("smithery", 1, {"servers": [{"qualifiedName": "x", "useCount": 2}]})
    page("smithery-details", 1, {"qualifiedName": "x", "displayName": "X"})
    (at / "npm" / "notes.txt").write_text("not a page")
    return str(at)


def test_filters_open_only_what_they_name(spark, root):
    every = R.pages(spark, root)
    parts = lambda df: df.rdd.getNumPartitions()
    assert parts(every) == 15 and every.count() == 15
    assert parts(every.where("source_id = 'npm'")) == 12 and parts(every.where("source_id IN ('registry', 'smithery')")) == 2
    assert parts(every.where("source_id = 'npm' AND page > 4 AND page <= 6")) == 2 and every.where("source_id = 'npm' AND page > 4 AND page <= 6").count() == 2
    assert every.where("source_id = 'nobody'").count() == 0 and parts(R.pages(spark, root, max_pages=3).where("source_id = 'npm'")) == 3


def test_limits_are_exact(spark, root):
    got = R.crawl(spark, root, "npm", max_records=17)
    assert sorted((r.upstream_id for r in got.collect()), key=lambda x: int(x[1:])) == [f"p{i}" for i in range(3, 20)]
    assert R.crawl(spark, root, "npm").count() == 38 and R.crawl(spark, root, "npm", max_pages=2).count() == 8 and R.crawl(spark, root, "npm", max_records=0).count() == 0
    assert [r.upstream_id for r in R.crawl(spark, root, "registry").collect()] == ["a/b"] and R.crawl(spark, root, "registry", include_deleted="true").count() == 2
    assert P.smithery(R.crawl(spark, root, "smithery")).first().name == "X" and R.crawl_all(spark, root).groupBy("source_id").count().count() == 3
    with pytest.raises(KeyError):
        R.crawl(spark, root, "nobody")
    with pytest.raises(ValueError, match="unknown limits"):
        R.crawl(spark, root, "npm", most="3")


def test_first_rows_as_a_sort_gives_them(spark):
    df = spark.range(500).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("block"), F.hash("id").alias("x"), "id").repartition(4)
    rows = sorted(((r.block is not None, r.block or 0), r.x, r.id) for r in df.collect())
    for most in (0, 1, 70, 71, 72, 300, 500, 900):
        got = sorted(((r.block is not None, r.block or 0), r.x, r.id) for r in C.first_rows(df, ["block"], [F.col("x"), F.col("id")], most).collect())
        assert got == rows[:most]


def test_star_windows_as_a_descent_gives_them(spark):
    def descent(stars, windows, shown):
        out, bound = [], None
        while len(out) < windows:
            own = sorted((s for s in stars if bound is None or s <= bound), reverse=True)[:shown]
            if not own or own[-1] == bound:
                return out
            bound = own[-1]
            out.append((len(out) + 1, len(own), bound))
            if len(own) < shown:
                return out
        return out

    for stars in ([5] * 30, list(range(100)), [i // 3 for i in range(100)], [9, 9, 9, 8, 8, 1], []):
        df = spark.createDataFrame([(s,) for s in [*stars, None]], "stars int")
        for windows, shown in ((3, 10), (20, 7), (2, 3)):
            assert [tuple(r) for r in S.star_windows(df, windows, shown).collect()] == descent(stars, windows, shown)


def test_wire_faults(spark):
    m = spark.createDataFrame([("npm", 1, 5, "a", None), ("npm", 2, 5, "b", None), ("npm", 3, 5, "a", None), ("smithery", 1, 5, "a", 3), ("smithery", 2, 0, None, 3), ("smithery", 3, 0, None, 3)], "source_id string, page int, items int, first_id string, pages_said int")
    assert sorted(map(tuple, S.wire_faults(m).collect())) == [("npm", 3, "wrapped"), ("smithery", 2, "empty below the last")]


def test_skill_records(spark):
    manifest = {"name": "m", "owner": {"name": "o"}, "renames": {"old": "one"}, "plugins": [{"name": "one", "source": "./pl", "description": "A plugin", "license": "MIT", "skills": ["more"], "keywords": ["k"]}, {"name": "two", "source": {"source": "github", "repo": "Ext/Repo", "sha": "b" * 40}}]}
    trees = paged(spark, {"sha": "A" * 40, "tree": [{"type": "blob", "path": f"pl/{x}/SKILL.md"} for x in ("a", "b/c", "bad")]}, repo="o/market").unionByName(paged(spark, {"sha": "C" * 40, "tree": [{"type": "blob", "path": "x/SKILL.md"}]}, repo="ext/repo"))
    front = lambda name, more="": f"---\nname: {name}\n{more}---\nnever indexed\n"
    texts = [("o/market", "pl/a/SKILL.md", front("a", "description: Own\n")), ("o/market", "pl/b/c/SKILL.md", front("c", "allowed-tools: Read\ndisable-model-invocation: true\n")), ("o/market", "pl/bad/SKILL.md", "no block"), ("Ext/Repo", "x/SKILL.md", front("x", "license: GPL\n")), ("o/market", "other/SKILL.md", front("o"))]
    files = spark.createDataFrame(texts, "repo string, skill_path string, text string")
    manifests, reviewed = paged(spark, manifest, marketplace_repo="o/market"), spark.createDataFrame([("O/Market",)], "marketplace_repo string")
    made = S.skill_records(manifests, trees, files, reviewed)
    got = {r.upstream_id: (r.url, json.loads(r.j)) for r in made.select("upstream_id", "url", F.to_json("payload").alias("j")).collect()}
    assert set(got) == {"o/market#one#pl/a", "o/market#one#pl/b/c", "o/market#two#x"}
    url, a = got["o/market#one#pl/a"]
    assert url == a["docs_url"] == "https://github.com/o/market/blob/HEAD/pl/a/SKILL.md" and sorted(a) == sorted(S.SKILL_KEYS)
    assert (a["description"], a["license"], a["commit_sha"], a["renamed_from"], a["tags"], a["marketplace_reviewed"], a["repo"]) == ("Own", "MIT", "a" * 40, ["old"], ["k"], True, {"host": "github.com", "owner": "o", "repo": "market", "subpath": "pl/a"})
    assert a["plugin"] == {"marketplace": "m", "marketplace_repo": "o/market", "plugin": "one", "source_kind": "relative", "source_value": "pl", "sha": "a" * 40} and a["icon_url"] == "https://github.com/o.png?size=128"
    c, x = got["o/market#one#pl/b/c"][1], got["o/market#two#x"][1]
    assert (c["description"], c["model_invocable"], c["allowed_tools"]) == ("A plugin", False, ["Read"]) and (x["license"], x["commit_sha"], x["source_ref"], x["icon_url"]) == ("GPL", "b" * 40, "ext/repo/x", "https://github.com/ext.png?size=128")
    assert S.more_than_pointers(made).count() == 0 and P.skills(made).count() == 3
    assert [r.upstream_id for r in S.skill_records(manifests, trees, files, most=2).collect()] == ["o/market#two#x", "o/market#one#pl/a"] and S.skill_records(manifests, trees, files, per_repo=1).count() == 2
    leaky = spark.createDataFrame([("i", json.dumps({"name": "x", "body": "do this", "description": "y" * 600, "plugin": {"sha": "z" * 600}}))], "upstream_id string, t string").withColumn("payload", F.parse_json("t"))
    assert sorted(r.key for r in S.more_than_pointers(leaky).collect()) == ["body", "description", "plugin"]
