import decimal

import duckdb
import pytest

import tessera.plans.build  # noqa: F401
from tessera.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    return float(f"{float(v):.9g}") if isinstance(v, (float, decimal.Decimal)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLE_SQL:
        assert got
        return
    relation = duck.sql(ORACLE_SQL[name])
    names = list(relation.columns)
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in relation.fetchall()), key=repr)
    assert got == want


def test_order_of_input_does_not_matter(spark, tmp_path, sf_dir):
    for t in ("customer", "orders", "lineitem", "events", "supplier", "part"):
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        df.orderBy(df.columns[0], ascending=False).repartition(5).write.parquet(f"{tmp_path}/{t}.parquet")
    for name in ("rank_topk", "merge_fields", "slugify_names", "first_wins_dedupe"):
        assert sorted(map(repr, QUERIES[name](spark, str(tmp_path)).collect())) == sorted(map(repr, QUERIES[name](spark, sf_dir).collect()))
