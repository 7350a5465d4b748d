import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import keys, lenient, scoring, text


def value(spark, column, **given):
    df = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'bigint'}" for k, v in given.items())) if given else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "want"),
    [("  a\t b\n\nc ", "a b c"), ("a\x00b", "a b"), ("a​b", "a b"), ("", ""), ("a  b", "a b"), ("x" * 30, "x" * 10)],
)
def test_collapse(spark, raw, want):
    assert value(spark, text.collapse(F.col("t"), 10), t=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("Hello, World!", "hello_world"), ("--", None), ("a__b", "a_b"), ("a" * 31 + " b", "a" * 31), ("É x", "x")])
def test_slugify(spark, raw, want):
    assert value(spark, text.slugify(F.col("t")), t=raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("**bold** and `code`", "bold and code"), ("# Title\n- [link](http://x) ![i](y)", "Title link i"), ("snake_case_name stays", "snake_case_name stays"), ("_one_ ~~two~~", "one two")],
)
def test_summarize_flattens(spark, raw, want):
    assert value(spark, text.summarize(F.col("t")), t=raw) == want


def test_summarize_cuts_at_a_word(spark):
    got = value(spark, text.summarize(F.col("t")), t="word, " * 60)
    assert got.endswith("word…") and len(got) <= 160


def test_title_words(spark):
    assert value(spark, text.title_words(F.col("t")), t="CRM and sales") == "CRM And Sales"


@pytest.mark.parametrize(("raw", "want"), [("/a//b/./c/", "a/b/c"), ("a/../b", ""), ("", ""), ("a\\b", "a/b")])
def test_relative_path(spark, raw, want):
    assert value(spark, text.relative_path(F.col("t"), 200), t=raw) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [("https://Brave.run.tools/", "mcp:url:brave.run.tools"), ("http://h:8080/a/?q#f", "mcp:url:h:8080/a"), ("https://h:443/A", "mcp:url:h/a"), ("no url", "mcp:url:no_url"), ("", None)],
)
def test_url_key(spark, url, want):
    assert value(spark, keys.url_key("mcp", F.col("u")), u=url) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("git+https://github.com/Owner/Repo.git", ("github.com", "owner", "repo", "")),
        ("https://www.gitlab.com/a/b/tree/main/x/y", ("gitlab.com", "a", "b", "x/y")),
        ("https://example.com/a/b", None),
        ("ssh://github.com/a/b", None),
        ("https://github.com/a", None),
    ],
)
def test_repo_of(spark, url, want):
    got = value(spark, keys.repo_of(F.col("u")), u=url)
    assert (tuple(got) if got else None) == want


def test_elect_takes_the_strongest_space(spark):
    ks = F.array(*[F.lit(k) for k in ("mcp:npm:a", "mcp:odd:0", "mcp:url:z:1", "mcp:smithery:b")])
    assert value(spark, keys.elect(ks)) == "mcp:url:z:1"


@pytest.mark.parametrize(
    ("stars", "downloads", "uses", "want"),
    [(1000, None, None, 0.5506), (1200, 50_000, None, 0.6209), (100_000, 10_000_000, 100_000, 1.0), (None, None, 87_579, 0.8699), (None, None, None, 0.0), (10**9, 10**9, 10**9, 1.0), (-5, None, None, 0.0)],
)
def test_popularity(spark, stars, downloads, uses, want):
    df = spark.createDataFrame([(stars, downloads, uses)], "github_stars bigint, npm_downloads_monthly bigint, smithery_use_count bigint")
    got = df.select(scoring.popularity([(F.col(n), c, w) for n, c, w in scoring.SIGNALS]).alias("p")).first().p
    assert got == want


@pytest.mark.parametrize(("raw", "want"), [('{"k": 3}', 3), ('{"k": "12"}', 12), ('{"k": "x"}', None), ('{"k": true}', None), ('{"k": -4}', 0), ('{"k": 2.9}', 2), ("{}", None), ("not json", None)])
def test_count(spark, raw, want):
    assert value(spark, lenient.count(lenient.parse(F.col("t")), "$.k"), t=raw) == want


def test_text_of_a_number_is_empty(spark):
    assert value(spark, lenient.text(lenient.parse(F.col("t")), "$.k"), t='{"k": 3}') == ""


@pytest.mark.parametrize(("url", "want"), [("https://a.b/c", True), ("http://a.b", False), ("https://a.b/{x}", False), ("https://u@a.b/", False), ("https://a.b/#f", False), (None, False)])
def test_dialable(spark, url, want):
    assert value(spark, keys.dialable(F.col("u")), u=url) is want


def test_rounding_is_python_s(spark):
    r = random.Random(0)
    values = [0.0, 1.0, 0.00015, 0.00025, 0.5, 0.99995, 0.00005] + [(2 * k + 1) / 20_000 for k in range(10_000)] + [r.random() for _ in range(50_000)]
    values += [x for k in range(0, 10_000) for x in (math.nextafter((2 * k + 1) / 20_000, 0), math.nextafter((2 * k + 1) / 20_000, 1), k / 10_000)]
    values += [(2 * k + 1) / 2**17 for k in range(2**15)]
    got = spark.createDataFrame(list(enumerate(values)), "i int, x double").select("i", scoring.rounded(F.col("x")).alias("y")).collect()
    assert len(values) > 100_000 and all(row.y == round(values[row.i], 4) for row in got)
