import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import catalog, components


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_components_of_path_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 15)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = dict(rows(components.connected(spark.createDataFrame(edges, "u bigint, v bigint"))))
    assert {got[i] for i in range(21)} == {0} and {got[100 + i] for i in range(15)} == {100} and {got[i] for i in (200, 201, 202)} == {200}
    assert 300 not in got


def test_components_of_random_graphs_with_hubs(spark):
    r = random.Random(1)
    for hub_edges in (1, 64):
        edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000, 1000 + i) for i in range(200)] + [(1100, 2000 - i) for i in range(90)] + [(None, 3), (5, None)]
        parent = {}

        def find(a, parent=parent):
            while parent.setdefault(a, a) != a:
                a = parent[a]
            return a

        for a, b in edges:
            if a is not None and b is not None and a != b:
                a, b = sorted((find(a), find(b)))
                parent[b] = a
        got = dict(rows(components.connected(spark.createDataFrame(edges, "u bigint, v bigint"), hub_edges=hub_edges)))
        assert got == {a: find(a) for a in list(parent)}
    assert components.connected(spark.createDataFrame([(1, 1)], "u bigint, v bigint")).count() == 0


def test_components_by_key_leave_loners(spark):
    got = rows(components.components_by_key(spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "b"), (4, "c")], "id bigint, key string")))
    assert got == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_overlapping_sets_are_not_ambiguous(spark):
    claims = [("r", 1, "npm", "a"), ("r", 2, "npm", "a"), ("r", 2, "npm", "b"), ("s", 1, "npm", "a"), ("s", 2, "npm", "b"), ("t", 1, "npm", "a"), ("t", 1, "npm", "b"), ("t", 2, "npm", "c")]
    assert rows(catalog.ambiguous(spark.createDataFrame(claims, "key string, claimant int, space string, value string"))) == [("s",), ("t",)]
    # u: a ring of overlapping pairs, far apart ones disjoint; v: all hold one value.
    more = [("u", i, "npm", f"p{j % 9}") for i in range(9) for j in (i, i + 1)] + [("v", i, "npm", x) for i in range(9) for x in ("all", f"p{i}")]
    assert rows(catalog.ambiguous(spark.createDataFrame(more, "key string, claimant int, space string, value string"))) == [("u",)]


def test_slugs_are_unique_and_the_strongest_keeps_its_own(spark):
    entries = [("k2", 1, "notion"), ("k1", 1, "notion"), ("k0", 0, "notion"), ("k3", 2, "x")]
    got = {k: g for k, _, g in rows(catalog.assign_slugs(spark.createDataFrame(entries, "key string, rank int, slug string")))}
    assert got["k0"] == "notion" and got["k3"] == "x" and len(set(got.values())) == 4 and got["k1"].startswith("notion_")


def test_slugs_go_out_as_if_one_by_one(spark):
    digest = lambda k: hashlib.sha256(k.encode()).hexdigest()

    def served(entries):
        taken, out = set(), {}
        for rank, key, slug in sorted((r, k, s) for k, r, s in entries):
            out[key] = next(x for x in (slug, f"{slug[:27]}_{digest(key)[:4]}", f"{slug[:23]}_{digest(key)[:8]}") if x not in taken)
            taken.add(out[key])
        return out

    chain = [("k0", 0, "notion"), ("k1", 0, "notion"), ("k9", 0, "notion_" + digest("k1")[:4])]
    many = [(f"m{i}", i % 3, f"s{i % 7}") for i in range(300)]
    early = [("z", 3, "notion_" + digest("k1")[:4])]
    for entries in (chain, many, chain + many + early):
        got = {k: g for k, _, g in rows(catalog.assign_slugs(spark.createDataFrame(entries, "key string, rank int, slug string")))}
        assert got == served(entries)
    blocked = [("k0", 0, "notion"), ("a", 0, "notion_" + digest("k5")[:4]), ("b", 0, "notion_" + digest("k5")[:8]), ("k5", 1, "notion")]
    with pytest.raises(ValueError):
        catalog.assign_slugs(spark.createDataFrame(blocked, "key string, rank int, slug string"))


def test_gate_is_strict(spark):
    before = spark.range(100).select(F.col("id").cast("string").alias("key"), F.lit("a").alias("line"))
    one = catalog.gate(catalog.diff(before, before.where("int(key) >= 6"))).first()
    assert (one.dropped, one.drop_fraction, one.passes) == (6, 0.06, False)
    changed = before.withColumn("line", F.when(F.col("key").cast("int") < 20, "b").otherwise("a"))
    assert catalog.gate(catalog.diff(before, changed)).first().passes
    assert catalog.gate(catalog.diff(before.limit(0), before)).first().drop_fraction == 0.0


def test_fuse_takes_the_first_informative(spark):
    df = spark.createDataFrame([(1, 1, "", None), (1, 2, "b", 0), (1, 3, "c", 5)], "g int, o int, s string, n int")
    got = catalog.fuse(df, ["g"], F.col("o"), {"s": F.col("s") != "", "n": F.col("n").isNotNull()}).first()
    assert (got.s, got.n) == ("b", 0)


def test_overlay_creates_and_corrects(spark):
    e = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, f string")
    o = spark.createDataFrame([("b", {"f": "x"}), ("z", {"f": "new"})], "key string, fields map<string,string>")
    assert rows(catalog.overlay(e, o, ["f"])) == [("a", "1", "", False), ("b", "x", "f", False), ("z", "new", "f", True)]
