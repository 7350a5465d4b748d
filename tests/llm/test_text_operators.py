"""Mixing, quality, personal data, HTML, URLs."""

import re

import numpy as np
import pytest
from helpers import ODD, odd_documents, words
from pyspark.sql import functions as F

from tessera.llm import html, mixing, pii, quality, urls


def water_fill(sizes, cap=3.0):
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(i % 3 + 1) for i, s in enumerate(order)}
    total, capped = float(sum(sizes.values())), set()
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] if s in capped else weight[s] * left / sum(weight[r] for r in rest) for s in order}
        over = {s for s in rest if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("most", [mixing.BROADCAST_SOURCES, 0])
def test_mix_targets_and_copies(spark, most):
    rows = [(i, "w " * (i % 37), ["a", "b", "c", None, "tiny"][min(i % 5, 4)] if i % 50 else "rare") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.plan_mix(docs, broadcast_sources=most).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = water_fill(sizes)
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 3
        rate = want[r.source] / sizes[r.source]
        assert int(rate + 1e-9) <= r.copies <= int(rate + 1e-9) + 1
        taken[r.source] += r.size * r.copies
    assert all(abs(taken[s] - want[s]) <= 0.15 * want[s] + 40 for s in sizes)
    again = {(r.doc_id, r.copies) for r in mixing.plan_mix(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}
    assert mixing.mix(docs, broadcast_sources=most).count() == sum(r.copies for r in got)


def test_mix_comes_near_targets_with_long_texts(spark):
    """Sources of twenty texts, one of them a third of the source: single draws miss widely, chosen ones don't."""
    rows = [(i, "w " * (20 + i % 37 if i // 40 else 400), f"s{i % 40:02}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    off = []
    for trials in (1, mixing.TRIALS):
        got = mixing.plan_mix(docs, trials=trials).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
        off.append(max(abs(r.taken / r.target - 1) for r in got))
    assert len(got) == 40 and off[1] <= 0.05 < 0.2 < off[0]


def test_odd_documents_everywhere(spark):
    docs = odd_documents(spark)
    empty = docs.where("false")
    labels = spark.createDataFrame([(0, 1, None), (1, None, 1), (2, 0, 0), (2, 1, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert mixing.plan_mix(docs).count() == len(ODD) and mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert quality.judge(docs, labels).count() == len(ODD) and quality.judge(empty, labels.where("false")).count() == 0
    assert pii.find_pii(docs).count() == len(ODD) == pii.digest(docs).count() and pii.digest(empty).count() == 0


def plain_counts(text):
    text, w = text or "", words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    found = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(5)} if len(windows) < 3000 else set(range(len(w)))
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(found)]


def test_quality_counts(spark, sf_dir):
    docs = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ODD
    for t in docs:
        assert quality.statistics(t)[0] == plain_counts(t)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    got = quality.judge(docs, seen).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2


CLEAN = [
    "съешь же ещё этих мягких французских булок да выпей потом чаю на кухне у окна вечером",
    "η γρήγορη αλεπού πηδάει πάνω από τον τεμπέλη σκύλο και τρέχει μετά στο δάσος",
    "كتب الولد رسالة طويلة إلى صديقه في المدينة البعيدة وأرسلها مع أخيه في الصباح",
    "私 は 昨日 友達 と 一緒 に 新しい 本 を 買い に 行き ました",
    "zażółć gęślą jaźń mówi ćma źrebięciu śpiąc pod łóżkiem gdzieś między książkami i półką",
]


def test_quality_of_other_scripts(spark):
    assert all(quality.statistics(t)[1] == [0.0] * 6 for t in CLEAN)
    assert all(quality.statistics(t.upper())[1][3] > 0.2 for t in (*CLEAN[:2], CLEAN[4], "clean text in capital letters " * 2))
    assert quality.statistics("ÀÉÎÕÜŽŁŐĆŚ" * 9)[1][3] == quality.statistics("ABCDEFGHIJ" * 9)[1][3]
    # Where capitals are what marks junk, clean text in any script is kept and capitals in any are rejected.
    draw = np.random.default_rng(3)
    latin = [" ".join("".join(draw.choice(list("abcdefghij"), 5)) for _ in range(30)) for _ in range(430)]
    rows = [(i, t.upper() if i % 10 == 0 else t) for i, t in enumerate(latin)]
    mixed = lambda t: " ".join(draw.permutation([w + t[i] for i in (0, 2, 3) for w in t.split()]))
    long = [mixed(t) for t in CLEAN]
    rows += [(-1 - i, t) for i, t in enumerate([*long, *(long[i].upper() for i in (0, 1, 4))])]
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(400)], "doc_id bigint, quality int")
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string"), labels).where("doc_id < 0 OR doc_id >= 400").collect()}
    assert all(got[i] == (i % 10 > 0) for i in range(400, 430))
    assert [got[-1 - i] for i in range(8)] == [True] * 5 + [False] * 3


def plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and pii.luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_by_plain_patterns():
    draw = np.random.default_rng(1)
    parts = ["a", "B", "@", ".", "-", "+", "1", "2", "55", " ", "4111111111111111", "(", ")", "é", "\n", "%", "256", "a.b", "10.0.0.1"]
    for _ in range(4000):
        t = "".join(draw.choice(parts) for _ in range(draw.integers(0, 15)))
        assert sorted(pii.base_spans(t)) == plain_pii(t)
    for t in ("1" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "+1(" * 30_000):
        pii.base_spans(t)


def test_added_spans():
    trees, least = pii.model()
    find = lambda t: [t[a:b] for _, a, b in pii.all_spans(t, trees, least)[1]]
    assert find("mail me: jane.doe[at]site[dot]org please") == ["jane.doe[at]site[dot]org"]
    assert find("call (555) 123-4567 now") == ["(555) 123-4567"]
    assert find("on 2024-05-06 order 1234-5678-9012 version 1.2.3.4567") == []
    made = pii._examples(1500, 99)
    got = [bool(any(a < e and s < b for _, a, b in pii.all_spans(t, trees, least)[1])) for t, s, e, _, _ in made]
    truth = np.array([y for *_, y in made])
    assert np.mean(~truth[np.array(got)].astype(bool)) < 0.02 and np.mean(np.array(got)[truth == 1]) > 0.85
    assert pii.redacted("a b@c.de f", [("email", 2, 8)]) == "a [EMAIL] f"


@pytest.mark.parametrize("examples", [pii._examples, pii._further, pii._numbers, pii._wide, pii.planted])
def test_spans_held_out(examples):
    trees, least = pii.model()
    made = examples(1500, 4711)
    got = np.array([any(a < e and s < b for _, a, b in pii.all_spans(t, trees, least)[1]) for t, s, e, _, _ in made])
    truth = np.array([y for *_, y in made]) > 0
    assert np.mean(~truth[got]) < 0.02 and np.mean(got[truth]) > 0.85


def test_planted_in_documents(spark, sf_dir):
    """Personal data that base rules miss, put at line ends of the given documents: found, and nothing else is added."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lines = ["tel 030 1234567", "call 555-1234 now", "write to jane.doe at site dot com", "login from 2001:db8::1 today", "paid by card 378282246310005"]
    spans = ["030 1234567", "555-1234", "jane.doe at site dot com", "2001:db8::1", "378282246310005"]
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    more = spark.createDataFrame([(i, f"{t}\n{lines[i % 5]}" if i % 2 else t) for i, t in rows], "doc_id bigint, text string")
    before = {r.doc_id: r for r in pii.digest(docs).collect()}
    found = {r.doc_id: r for r in pii.digest(more).collect()}
    kept = lambda r: {x for x in r.spans.split(",") if x}
    for i, t in rows:
        added = kept(found[i]) - kept(before[i])
        assert {(t + "\n" + lines[i % 5])[int(a) : int(b)] for _, a, b in (x.split(":") for x in added)} == ({spans[i % 5]} if i % 2 else set())
        assert found[i].n_email == before[i].n_email and found[i].n_spans == len(kept(found[i]))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Call 1-800-555-0199 for details.", ["1-800-555-0199"]),
        ("Büro: 0171 / 2345678, bitte.", ["0171 / 2345678"]),
        ("Ruf mich an: 0171 2345678", ["0171 2345678"]),
        ("Erreichbar unter 0049 (0)30 901820", ["0049 (0)30 901820"]),
        ("Mein Handy: 01712345678", ["01712345678"]),
        ("Llámame al 612345678 por favor.", ["612345678"]),
        ("Appelez le 01 23 45 67 89 demain.", ["01 23 45 67 89"]),
        ("dial 1 (415) 555-2671", ["1 (415) 555-2671"]),
        ("mail jane.doe[at]site[dot]org. Then wait.", ["jane.doe[at]site[dot]org"]),
        ("contact me: ann(at)mill.de. Bis bald", ["ann(at)mill.de"]),
        *[(t, []) for t in ("phone 2024-05-06", "call on 06.05.2024", "order 1-800-555-0199", "Ticket 8005550199", "version 1.200.3000", "ISBN 978-3-16-148410-0", "between 1990-1995", "account 0123456789", "In total 1.234.567 Euro", "We stayed at home. Then we left.", "look at site.com. Then go")],
    ],
)
def test_spans_in_lines_by_hand(text, want):
    trees, least = pii.model()
    assert [text[a:b] for _, a, b in pii.all_spans(text, trees, least)[1]] == want


def test_plain_dots_and_compressed_addresses():
    trees, least = pii.model()
    find = lambda t: [t[a:b] for _, a, b in pii.all_spans(t, trees, least)[1]]
    assert find("please mail jane.doe at site.com today") == ["jane.doe at site.com"] == find("mail jane.doe at site.com today or the red dot here")
    for x in ("2001:db8::1", "fe80::1ff:fe23:4567:890a", "::1", "2a02:26f0::", "2001:db8:0:0:1:0:0:1"):
        for t in (f"login from {x} today", f"host {x}", f"host {x}, and", f"host:{x} up", f"[{x}]:443", f"ping {x}/64 now"):
            assert [t[a:b] for _, a, b in pii.candidates(t)] == [x]
        assert find(f"login from {x} today") == [x]
    assert pii.candidates("2001:db8::1: down") == [("ip", 0, 11)]
    for t in ("at 12:30:45 and 1:2:3", "mac 00:1a:2b:3c:4d:5e", "std::vector<int>::x", "1::2::3", "a:::b", "12345::1", ":" * 100_000, "1:" * 50_000):
        assert pii.candidates(t) == []
    for t in ("we stayed at home. Then we left.", "take a look at site.com today", "use add::face here"):
        assert find(t) == []
    made = pii._further(1500, 99)
    got = np.array([any(a < e and s < b for _, a, b in pii.all_spans(t, trees, least)[1]) for t, s, e, _, _ in made])
    truth = np.array([y for *_, y in made]) > 0
    assert np.mean(~truth[got]) < 0.02 and np.mean(got[truth]) > 0.85


def test_html_held_out_pages():
    field = html.trained()
    right = sum(html.main_text(page, field) == "\n\n".join(main) for page, main in (html.labelled_page(5_000_000 + i) for i in range(120)))
    assert right >= 114


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<article><h1>T</h1><p>One&nbsp;&amp; <b>two</b>\n three.<p>Four <a href='x>y'>five</a> six.</article><footer>&copy; x</footer>", "T\n\nOne & two three.\n\nFour five six."),
        ("<nav><a href=x>m</a></nav><article><p>Text <!-- no --> here.</p><script>var p='</p>';</script></article>", "Text here."),
    ],
)
def test_html_cases(page, want):
    assert html.main_text(page, html.trained()) == want


@pytest.mark.parametrize("size", [10, 5000, 200_000])
@pytest.mark.parametrize("quote", ["'", '"'])
def test_html_attributes_of_any_length(size, quote):
    other = "'" if quote == '"' else '"'
    text = "<p>The text of an article, which has a few words and ends.</p>"
    for fill in ("a>b ", f"<p>Not, the text {other}ad{other} here.</p> ", "{x} hidden display:none ", f"<div class={other}footer{other}>© rights</div>"):
        value = quote + (fill * (size // len(fill) + 1)) + quote
        for page in (f"<article data-props={value} class=story>{text}</article>", f"<article><iframe srcdoc={value}></iframe>{text}</article>", f"<nav class=menu data-x = {value}>a b</nav><article>{text}</article>"):
            short = page.replace(value, quote + "v" + quote)
            assert html.leaf_blocks(page) == html.leaf_blocks(short)
    page = f"<article><iframe srcdoc={quote}<iframe></iframe><p>Not text.</p>{quote}></iframe>{text}</article>"
    assert [t for t, _ in html.leaf_blocks(page)] == ["The text of an article, which has a few words and ends."]
    assert [t for t, _ in html.leaf_blocks(f"<p title=it{quote}s>One.</p><p>It{quote}s two.</p>")] == ["One.", f"It{quote}s two."]


ONE = "<p>One short sentence stands here.</p>"
TWO = "<p>A second one follows it, and it is somewhat longer than the first.</p>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article>{ONE}</article>", 1),
        *[(f'<article class="{c}">{ONE}{TWO}</article>', 2) for c in ("no-sidebar", "has-header", "page-with-nav", "article-body content-sidebar", "ads-free", "commentary", "")],
        *[(f'<body class="{c}"><article>{ONE}{TWO}</article></body>', 2) for c in ("no-sidebar has-header", "sidebar menu footer", "js ads")],
        (f"<html><body><main>{ONE}</main></body></html>", 1),
        (f"<body><h1>A title of words</h1>{ONE}{TWO}</body>", 3),
        (f"<nav><a href=x>Home</a></nav><article>{ONE}</article><footer>(c) 2020 Somebody</footer>", 1),
        (f"<div class=wrap><div class=sidebar><h3>Other</h3>{TWO}</div><div class=entry-content>{ONE}{TWO}</div></div><div class=comments>{ONE}</div>", 2),
        (f"<header class=site-header><h1>Site</h1></header><article><h1>A title of words</h1>{ONE}<aside class=widget>{TWO}</aside>{TWO}</article><div id=disqus>{ONE}</div><footer>{ONE}</footer>", 3),
        (f"<div class=cookie-notice>{TWO}</div><div id=main><div class=post>{ONE}{TWO}<div class=post-footer>Shared by many.</div></div></div>", 2),
    ],
)
def test_html_pages_that_no_composer_made(page, want):
    got = html.main_text(page, html.trained()).split("\n\n")
    said = ["A title of words", "One short sentence stands here.", "A second one follows it, and it is somewhat longer than the first."]
    assert got == {1: said[1:2], 2: said[1:], 3: said}[want]


LINKS = "<ul><li><a href=/a>First link</a></li><li><a href=/b>Second link</a></li></ul>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<nav><a href=/>Home</a></nav><div class='alert-article'><h1>Title here</h1>{ONE}{TWO}</div><footer>c</footer>", ["Title here", "1", "2"]),
        (f"<header>Site</header><article><header><h1>Title here</h1></header>{ONE}{TWO}</article><footer>&copy; x</footer>", ["Title here", "1", "2"]),
        (f"<div class=post><div class='post-header'><h1>Title here</h1></div>{ONE}{TWO}</div><div class=comments><p>Nice one.</p></div>", ["Title here", "1", "2"]),
        (f"<article><h1>Title here</h1>{ONE}{LINKS}{TWO}</article>", ["Title here", "1", "First link", "Second link", "2"]),
        (f"<main><header class='page-header'><h1>Title here</h1></header>{ONE}<aside class=related>{LINKS}</aside>{TWO}</main>", ["Title here", "1", "2"]),
        (f"<article><h1>Title here</h1><table class=infobox><tr><td>Born</td><td>1950</td></tr></table>{ONE}<table><tr><td>Cell</td></tr></table>{TWO}</article>", ["Title here", "1", "Cell", "2"]),
        (f"<div class='sponsored-post'><p>Buy this thing now.</p></div><article><h2>Title here</h2>{ONE}<nav class=toc>{LINKS}</nav>{TWO}<footer><p>Tags: a, b</p></footer></article>", ["Title here", "1", "2"]),
        (f"<header class=site-header><h1>Site</h1>{LINKS}</header><article>{ONE}{TWO}</article>", ["1", "2"]),
    ],
)
def test_html_titles_in_own_headers_and_links_in_text(page, want):
    full = {"1": "One short sentence stands here.", "2": "A second one follows it, and it is somewhat longer than the first."}
    assert html.main_text(f"<body>{page}</body>", html.trained()) == "\n\n".join(full.get(w, w) for w in want)


def test_html_rows(spark):
    rows = [(1, "u", f"<article>{ONE}</article>", 1), (1, "u", f"<article>{ONE}</article>", 2), (2, None, None, 3), (None, "v", "", 4), (3, "w", " \n ", 5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int").selectExpr("*", "'x' as text", "html as HTML2")
    got = sorted(map(tuple, html.extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", "One short sentence stands here.", 31)] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "", 0)], key=repr)
    assert html.extract(df.where("false")).count() == 0


def test_html_telling_words_anywhere_in_a_block():
    long = "Some words that say nothing come first here. " * 40
    for word, name in (("All rights reserved.", "rights"), ("Your privacy.", "cookies"), ("Sign up!", "sign"), ("A sponsor.", "sold")):
        assert f"says {name}" in html.told(long + word, 0, "div") and f"says {name}" not in html.told(long, 0, "div")


def test_html_tags_in_linear_time():
    for part in ('<a b="', "<a b='<a c=\"", "<a b=\"<a c='\" d='\"'", "<script ", "<!x ", "<a b= ", '<a b="" ', "<a ='=\"<", "<iframe a='"):
        html.leaf_blocks(part * 100_000)


def test_html_long_and_broken_pages():
    for page in ("<a " * 50_000, '<a "' * 50_000, "<div>" * 50_000 + "x", "<p>x" * 20_000, "<!--" * 20_000):
        html.main_text(page, html.trained())


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://a.example.net/en/1", ("example.net/en/", "allow")),
        ("https://a.example.net/fr/1", ("net/", "block")),
        ("https://example.com/de/x", ("example.com/de/", "block")),
        ("http://X.ORG/fr/", ("org/fr/", "allow")),
        ("http://notexample.com/de/", (None, "allow")),
        ("https://www.casino-win.example.com:8080/en/9?x#y", (None, "block")),
        ("https://net?x", (None, "allow")),
        ("no url", (None, "allow")),
        (None, (None, "allow")),
    ],
)
def test_urls(spark, url, want):
    listed = spark.createDataFrame([(x,) for x in (*urls.LISTED, None, " ")], "url string")
    pages = spark.createDataFrame([(1, url, 2), (1, url, 3)], "page_id bigint, url string, key int")
    got = urls.filter_urls(pages, listed, max_blocks=1).collect()
    assert [(r.rule, r.verdict) for r in got] == [want] * 2


def test_bloom_has_no_false_negatives_and_the_join_removes_false_positives(spark):
    listed = spark.range(3000).select(F.concat(F.lit("http://h/"), "id").alias("url"))
    pages = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id", F.lit("?utm_source=x")).alias("url"))
    got = {r.page_id: r.verdict for r in urls.filter_urls(pages, listed, rules=(), max_blocks=8).collect()}
    assert all(got[i] == ("block" if i < 3000 else "allow") for i in range(6000))
    assert urls.filter_urls(pages.where("false"), listed.where("false")).count() == 0
