"""Chat trees, BPE, token files, neighbours, near-duplicates, the pipeline."""

import hashlib
import random
import sys
import unicodedata
import zlib

import numpy as np
import pytest
from helpers import ODD, jaccard_components, odd_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import ann, bpe, chat, jaccard, tokenfiles, wordtable


def brute_digest(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda t: (t[0] is not None, t))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len("".join(chat.format_turn(r, t))) for _, r, t in turns))
    return out


def test_chat_tree_and_reading_back(spark):
    r = random.Random(2)
    texts = ["", "a", "\\", "###", "</turn>", "\\h", "x: y", "\n", "#" * 7, "<|endoftext|>", "é🙂", None, "\\### Assistant: </turn> ok"]
    rows, made = [], {}
    for c in range(90):
        base = list(made[r.choice(list(made))]) if made and r.random() < 0.8 else []
        base = base[: r.randint(0, len(base))] + [(r.choice(["user", "assistant", "system", None, "we: ird\n"]), r.choice(texts)) for _ in range(r.randint(0 if base else 1, 3))]
        made[c] = base = base or [("user", "a")]
        rows += [(c, i, a, b, 1) for i, (a, b) in enumerate(base)]
    rows += [(None, None, None, None, 2), (None, 1, "user", "x", 2), (None, 1, "user", "x", 2)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, node int").repartition(7)
    path = bpe.vocabulary("byte_bpe_50k.json")
    nodes, sequences, members = chat.format_tree(df, path)
    n = sorted(nodes.collect(), key=lambda x: x.start)
    prefixes = {tuple((a or "", b or "") for a, b in v[:k]) for v in [*made.values(), [(None, None), ("user", "x"), ("user", "x")]] for k in range(1, len(v) + 1)}
    assert len(n) == len(prefixes)
    at = 0
    for x in n:
        assert x.start == at
        at += x.n_tokens
    by = {x.start: x for x in n}
    for s in sequences.collect():
        place, above = 0, []
        for a in s.starts:
            assert by[a].position == place and [tuple(i) for i in by[a].attends] == chat._join(above)
            place += by[a].n_tokens
            above.append((a, a + by[a].n_tokens))
    got = {x.conv_id: tuple(x)[1:] for x in chat.read_back(nodes, sequences, members, path).collect()}
    assert got == brute_digest(rows)
    assert chat.read_back(*chat.format_tree(df.where("false"), path), path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoding_is_the_library_s(spark, sf_dir, name):
    path = bpe.vocabulary(name)
    how = wordtable.BYTE_LEVEL if name[0] == "b" else wordtable.WORD_END
    tk = Tokenizer.from_file(path)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ODD + ["  a  b", "a\n\nb \n c", "x y", "<|startoftext|>A", "a1b.2c,_x_[y]{z}`w~", " \n", "a \nb", "a\n b", "ΑΣ Σ ΑΣ\nǅ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    want = {i: tk.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in wordtable.encode(docs, path, how, chunk_bytes=100_000).collect()}
    assert got == want
    got = {r.doc_id: wordtable.unpack(r.packed).tolist() for r in wordtable.encode_within_chunks(docs, path, how, chunk_bytes=100_000).collect()}
    assert got == want
    if name[0] == "b":
        back = {r.doc_id: r.text for r in wordtable.decode_documents(wordtable.encode(docs, path), path).collect()}
        assert back == {i: t or "" for i, t in enumerate(texts)}


def test_capitals_before_marks_encode_as_the_library_does(spark):
    path = bpe.vocabulary("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    texts = ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a", "aJ\u030cb H\u0331AT", "J\u0323\u030c", "<|x"]
    want = [tk.encode(t, add_special_tokens=False).ids for t in texts]
    for some in (texts, texts[:-1]):
        docs = spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string").coalesce(1)
        got = {r.doc_id: wordtable.unpack(r.packed).tolist() for r in wordtable.encode_within_chunks(docs, path, wordtable.WORD_END).collect()}
        assert got == dict(enumerate(want[: len(some)]))
    beyond = [chr(c) for c in range(128, sys.maxunicode) if unicodedata.combining(chr(c))]
    every = [a + c for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in beyond]
    plain = [wordtable.plain(np.frombuffer(t.encode(), np.uint8)).tobytes().decode() for t in every]
    assert [e.ids for e in tk.encode_batch(plain, add_special_tokens=False)] == [e.ids for e in tk.encode_batch(every, add_special_tokens=False)]


def test_encoding_of_odd_rows(spark):
    docs, path = odd_documents(spark), bpe.vocabulary("byte_bpe_50k.json")
    assert bpe.digest(docs, path).count() == len(ODD) and bpe.digest(docs.where("false"), path).count() == 0


def test_blocks_round_trip():
    draw = np.random.default_rng(0)
    for _ in range(200):
        ids = draw.integers(0, 2 ** int(draw.integers(0, 33)), draw.integers(1, tokenfiles.BLOCK + 1), dtype=np.uint64).astype(np.uint32)
        ids[draw.integers(len(ids))] = 2**32 - 1
        assert (tokenfiles.unpack_block(b"xx" + tokenfiles.pack_block(ids), 2) == ids).all()


def test_token_files(spark, sf_dir):
    rows = tokenfiles.query(spark, sf_dir).collect()
    tk, start, want = Tokenizer.from_file(bpe.vocabulary("word_bpe_49k.json")), 0, set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*tk.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.add((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    docs, path = odd_documents(spark), bpe.vocabulary("word_bpe_49k.json")
    for some in (docs, docs.where("false")):
        got = tokenfiles.read_tokens(tokenfiles.write_tokens(wordtable.encode_within_chunks(some, path, wordtable.WORD_END), some)).collect()
        assert len(got) == some.count()
        got.sort(key=lambda r: r.start)
        assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
        assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got) or any(r.doc_id == 0 for r in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_neighbours(spark, sf):
    v = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in v.collect()]
    got = {}
    for r in ann.search(v).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids, x = np.array([i for i, _ in rows]), np.array([e for _, e in rows])
    hit = 0
    for q in ids[ids % 50 == 0]:
        s = ann.scores(np.repeat(x[ids == q], len(x), 0), x)
        s[ids == q] = -9
        best = np.lexsort((ids, -s))[:5]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert all(np.isclose(c, s[ids == i][0], atol=1e-12) for _, i, c in mine)
        hit += len({i for _, i, _ in mine} & set(ids[best]))
    assert hit >= 0.9 * 5 * len(got) and set(got) == set(ids[ids % 50 == 0])


def test_token_files_of_hot_ids_and_small_files(spark):
    """Most rows have one doc_id or none; files end after some ids; the reader seeks."""
    rows = [(7 if i % 3 else None if i % 2 else i, " ".join(f"w{(i * k) % 91}" for k in range(i % 40))) for i in range(6000)]
    docs, path = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), bpe.vocabulary("word_bpe_49k.json")
    files = tokenfiles.write_tokens(wordtable.encode_within_chunks(docs, path, wordtable.WORD_END), docs, slots=6, file_ids=9000)
    assert files.where("piece > 0").count() and files.groupBy("slot").count().count() > 6
    got = sorted(tokenfiles.read_tokens(files).collect(), key=lambda r: r.start)
    tk = Tokenizer.from_file(path)
    crc = lambda t: zlib.crc32(np.array([*tk.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids_crc32) for r in got) == sorted((d if d is not None else -1, crc(t)) for d, t in rows)
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()


def test_digests_are_the_library_s(spark, sf_dir):
    path = bpe.vocabulary("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ODD
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = {}
    for i, t in enumerate(texts):
        ids = tk.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digest(docs, path).collect()} == want


def test_neighbours_of_odd_vectors(spark):
    same = [(i, [1.0, 2.0]) for i in range(0, 400)]
    odd = [(1000, None), (1050, []), (1100, [0.0, 0.0]), (1150, [None, 1.0]), (1200, [float("nan"), 1.0]), (1250, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (1300, [float("inf"), 1.0])]
    odd += [(2000 + i, [1.0, float(i), 0.0]) for i in range(60)]
    df = spark.createDataFrame(same + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "vec_id as part")
    got = {}
    for r in ann.search(df, block_rows=50, chunk_queries=3).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {*range(0, 400, 50), 1250, 2000, 2050}
    assert all(sorted(got[q]) == [i for i in range(6) if i != q][:5] for q in range(0, 400, 50))
    assert sorted(got[2050]) == [2048, 2049, 2051, 2052, 2053] and len(got[1250]) == 5
    assert ann.search(df.where("false")).count() == 0 and ann.search(spark.createDataFrame([(0, [1.0])], "vec_id bigint, embedding array<double>")).count() == 0


def near_copies():
    r = random.Random(3)
    vocabulary, rows = [f"w{i}" for i in range(3000)], []
    for _ in range(45):
        base = [r.choice(vocabulary) for _ in range(r.choice([1, 2, 3, 4, 5, 7, 9, 12, 20, 40, 80, 150, 400]))]
        for _ in range(r.choice([1, 3, 12])):
            rate = r.random() * 0.06
            w = [r.choice(vocabulary) if r.random() < rate else t for t in base]
            rows.append((len(rows), " ".join(w[: max(1, int(len(w) * (1 - r.random() * 0.1)))] if r.random() < 0.3 else w)))
    return rows + [(len(rows) + i, t) for i, t in enumerate(["", None, "  \n", "A b", "a B", "a b C D", "A B C D"])]


@pytest.mark.parametrize(("n", "num", "den"), [(4, 85, 100), (2, 60, 100)])
def test_components_by_all_pairs(spark, n, num, den):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(df, n=n, num=num, den=den, chunk_bytes=20_000, block_members=8).collect()}
    assert got == jaccard_components(rows, n, num, den)


def test_sketches_never_rule_out_similar_sets():
    draw, bands = np.random.default_rng(4), jaccard.Bands(4, 5)
    for _ in range(400):
        a = np.unique(draw.integers(0, 2**63, draw.integers(1, 900), dtype=np.uint64))
        b = np.unique(np.append(a[draw.random(len(a)) > draw.random() * 0.2], draw.integers(0, 2**63, draw.integers(0, 1 + len(a) // 8), dtype=np.uint64)))
        if not len(b):
            continue
        sizes = np.array([len(a), len(b)])
        d = jaccard._near([jaccard.sketch(a, bands), jaccard.sketch(b, bands)], sizes, 4, 5, slice(0, 1), slice(1, 2))[0, 0]
        both = len(np.intersect1d(a, b))
        if 5 * both >= 4 * (sizes.sum() - both):
            assert 0 <= d <= sizes.sum() - 2 * both
            sig, owner = jaccard.signatures([a, b], bands)
            assert sizes[0] == sizes[1] == both or set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist())


def test_one_group_of_many_near_copies(spark):
    """3000 copies of one text, each with a few words of its own: many pairs link, and many lie just beyond."""
    r = random.Random(5)
    base = [f"v{i}" for i in range(60)]
    texts = [" ".join(w if r.random() > 0.01 else f"x{r.randrange(10**6)}" for w in base) for _ in range(3000)]
    sets = [jaccard.shingles(t, 4, jaccard._Hashes()) for t in texts]
    column = {h: i for i, h in enumerate(np.unique(np.concatenate(sets)).tolist())}
    x = np.zeros((len(sets), len(column)), np.float32)
    for i, s in enumerate(sets):
        x[i, [column[h] for h in s.tolist()]] = 1
    both, size = (x @ x.T).astype(np.int64), np.array([len(s) for s in sets])
    linked = 100 * both >= 85 * (size[:, None] + size[None, :] - both)
    label = np.arange(len(sets))
    while (new := np.where(linked, label[None, :], len(sets)).min(axis=1)).tolist() != label.tolist():
        label = new
    rows = list(enumerate(texts)) + [(5000 + i, " ".join(base[::-1])) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {g.doc_id: g.component_id for g in jaccard.link_components(df, 4, 85, 100, block_members=300).collect()}
    assert got == {**dict(enumerate(label.tolist())), **{5000 + i: 5000 for i in range(900)}}
    assert 2 < len(set(label.tolist())) < 2500 and not linked.all()


def test_large_groups_make_rows_in_proportion(spark):
    """A group of 5000 in blocks of 100: as stars, and when all but three members lie in one component."""
    members = spark.range(5000).select(F.lit(7).cast("bigint").alias("sig"), F.col("id").alias("key"), F.lit(5000).cast("bigint").alias("members"), F.lit(0).cast("bigint").alias("least"))
    stars = jaccard._stars(members, 100)
    assert stars.count() == 4999 + 50 and stars.groupBy("low").agg(F.min("block").alias("b"), F.min("key").alias("k")).where("b = -1 AND k = 0").count() == 50
    labels = spark.range(4997).select(F.col("id").alias("node"), F.lit(0).cast("bigint").alias("label"))
    rest = jaccard._rest(members, labels, 100)
    assert rest.count() == 4997 + 3 * 51 and rest.where("key < 4997").select("key").distinct().count() == 4997
    pairs = rest.groupBy("low", "high").agg(F.sum(F.when(F.col("key") < 4997, 1).otherwise(0)).alias("common"), F.count("*").alias("n"))
    assert pairs.where("n - common = 3").count() == pairs.count() == 51 and pairs.agg(F.sum("common")).first()[0] == 4997


def test_odd_near_duplicates(spark):
    docs = odd_documents(spark)
    assert jaccard.link_components(docs).count() == len(ODD) and jaccard.link_components(docs.where("false")).count() == 0
    kept = jaccard.keep_first(docs)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and kept.where("text is null or trim(text) = ''").count() >= 2
    assert kept.where("text like 'a b c%'").count() == 1


def test_pipeline(spark, sf_dir):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, docs, sf_dir)
    first = stages["near duplicates"](spark, kept, sf_dir)
    assert first.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    want = jaccard_components(rows, 5, 80, 100)
    assert {r.doc_id for r in first.collect()} == {c for _, c in want.values()}
    clean = stages["personal data"](spark, first, sf_dir)
    assert clean.count() == first.count() and clean.where("text rlike '[a-z0-9]@[a-z0-9]+[.]example'").count() == 0
    mixed = stages["mixing sources"](spark, clean, sf_dir)
    assert mixed.columns == docs.columns
    assert stages["bpe encoding"](spark, mixed, sf_dir).count() == mixed.count()


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    """Every stage by itself: null columns, blank and very long texts, repeated and null ids, clashing names, no rows."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = odd_documents(spark)
    columns, counts = ["doc_id", "text", "lang", "source", "n_chars"], {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        counts[name] = out.count()
        assert name == "bpe encoding" or out.columns == columns
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
    assert counts["quality rules"] < len(ODD) and counts["near duplicates"] == len(ODD) - 1
    assert counts["personal data"] == len(ODD) == counts["bpe encoding"]
