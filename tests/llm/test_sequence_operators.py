"""Conversation tries, periodic runs, packing."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from helpers import ODD, odd_documents, words
from tokenizers import Tokenizer

from tessera.llm import packing, runs, trie
from tessera.llm.bpe import vocabulary
from tessera.llm.wordtable import BYTE_LEVEL, encode_within_chunks


def brute_trie(convs):
    """{(smallest member, depth): the other columns} of {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        return [path, *[x for c in children[path] for x in below(c)]]

    size = lambda path: len(path[-1][1].encode()) if path else 0
    out = set()
    for path, own in members.items():
        under = below(path)
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(path))
        out.add((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]), sum(not children[p] for p in under),
            sum((len(members[p]) - 1) * size(p) for p in under), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), role, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32], text))
    turns = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, x in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + x[h:]
    return out


def test_trie_by_brute_force(spark):
    r = random.Random(4)
    rows, made = [], []
    for c in range(400):
        base = list(r.choice(made)) if made and r.random() < 0.8 else []
        base = base[: r.randint(0, len(base))] + [(r.choice(["user", "assistant", None]), r.choice(["", "a", "é🙂", None, "b" * 50])) for _ in range(r.randint(1, 4))]
        made.append(base)
        c = c * 3 + r.randint(0, 1)
        rows += [(c, i if r.random() < 0.95 else None, a, b) for i, (a, b) in enumerate(base)]
    hot = [("user", "hello"), ("assistant", "yes?"), ("user", "bye")]
    rows += [(c, i, a, b) for c in range(5000, 5900) for i, (a, b) in enumerate(hot)]
    rows += [(None, 0, "user", "x"), (9999, None, None, None), (9999, None, None, None)]
    df = spark.createDataFrame([(*x, 1, "k") for x in rows], "conv_id bigint, turn bigint, role string, text string, depth int, n_convs string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = trie.build_trie(trie.rebuild(trie.turns_of(df))).collect()
        plain = trie.build_trie(trie.turns_of(df)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    convs = brute_rebuilt(rows)
    assert len(got) == len({tuple(x) for x in got}) and {tuple(x) for x in got} == brute_trie(convs)
    assert sum(x.depth == 0 for x in plain) == 1 and max(x.n_convs for x in plain) == len(convs)
    assert trie.build_trie(trie.rebuild(trie.turns_of(df.where("false")))).count() == 0


def test_trie_of_one_turnless_conversation(spark):
    """Conversation 1 takes all its turns from conversation 0, which isn't there."""
    c = next(c for c in range(1, 5) if zlib.crc32(str(c).encode()) % 9 > 0)
    df = spark.createDataFrame([(c, 0, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    (row,) = trie.build_trie(trie.rebuild(trie.turns_of(df))).collect()
    assert tuple(row) == (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())


def test_trie_by_sql(spark, sf_dir):
    want = duckdb.sql(trie.SQL.replace("FROM conversations", f"FROM '{sf_dir}/conversations.parquet'")).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in trie.query(spark, sf_dir).collect())


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(w[i : i + n - d] == w[i + d : i + n] for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(doc_id, text, change):
    w = words(text)
    take = change(doc_id, len(w)) if change else None
    w = w if take is None else [w[i] for i in take.tolist()]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-(r[1] * 10**9 // r[2]), r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(),
    )


def test_runs_by_brute_force():
    r = random.Random(1)
    n = 0
    for _ in range(150):
        docs = []
        for _ in range(r.randint(1, 8)):
            k = r.choice([1, 2, 2, 3, 5, 50])
            w = [r.randrange(k) for _ in range(r.choice([0, 1, 5, 6, 8, 20, 60, 150]))]
            for _ in range(r.randint(0, 3)):
                p = r.randint(1, 12)
                at = r.randint(0, len(w))
                w[at:at] = [r.randrange(k) for _ in range(p)] * r.randint(2, 9)
            docs.append(w)
        want = [(d, *x) for d, w in enumerate(docs) for x in brute_runs(w)]
        got = runs.find_runs(np.array([c for w in docs for c in w], np.int64), np.cumsum([0, *map(len, docs)]))
        assert [tuple(x) for x in got.tolist()] == want
        n += len(want)
    assert n > 500


def test_long_periods_in_one_document():
    for n, p in ((20_000, 1), (20_000, 4999), (12_000, 2999)):
        assert runs.find_runs(np.arange(n) % p, np.array([0, n])).tolist() == [[0, 0, n, p]]
    assert runs.find_runs(np.arange(12_000) % 3001, np.array([0, 12_000])).tolist() == []


def test_which_documents_repeat_a_part():
    for d in range(300):
        h = zlib.crc32(str(d).encode())
        assert runs.repeat_parts(d, 0) is None and (runs.repeat_parts(d, 100) is None) == (h % 10 > 0)
        if h % 10 == 0:
            a = h // 10 % 100
            p = 1 + (100 - a) // (3 + h // 10 % 8)
            assert runs.repeat_parts(d, 100).tolist() == [i if i < a else a + (i - a) % p for i in range(100)]
    assert runs.repeat_parts(None, 5) is None


def test_runs_of_documents(spark, sf_dir):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(words(r.text)) < 1500}
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string").repartition(3)
    got = {tuple(r)[: len(runs.DIGEST)] for r in runs.collapse_runs(docs, runs.repeat_parts, chunk_bytes=50_000).collect()}
    assert got == {brute_collapse(d, t, runs.repeat_parts) for d, t in rows.items()}
    assert sum(r[1] > 0 for r in got) > 5
    assert runs.query(spark, sf_dir).columns == runs.DIGEST


def test_runs_of_odd_rows(spark):
    docs = odd_documents(spark)
    got = [tuple(r)[: len(runs.DIGEST)] for r in runs.collapse_runs(docs.where("length(text) < 100000 or text is null")).collect()]
    want = [brute_collapse(i % 9 if i % 11 else None, t, None) for i, t in enumerate(ODD) if len(t or "") < 100_000]
    assert sorted(map(str, got)) == sorted(map(str, want))
    long = runs.collapse_runs(docs.where("length(text) >= 100000")).collect()
    assert [(r.n_runs, r.length, r.period, r.collapsed) for r in long] == [(1, 30_000, 1, "word")]
    assert runs.collapse_runs(docs.where("false")).count() == 0


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_documents(spark, sf_dir):
    path = vocabulary("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    rows = packing.query(spark, sf_dir, path).collect()
    want, total = set(), 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = np.array([*tk.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        low, piece = 0, 0
        for high in range(len(ids) % 2048 or 2048, len(ids) + 1, 2048):
            want.add((r.doc_id, piece, low, high - low, zlib.crc32(ids[low:high].tobytes())))
            low, piece = high, piece + 1
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    assert check_packed(rows, 2048) <= -(-total // 2048) + 1


def test_packed_sequences_and_odd_rows(spark):
    path = vocabulary("byte_bpe_50k.json")
    docs = odd_documents(spark)
    pieces = packing.cut_pieces(encode_within_chunks(docs, path, BYTE_LEVEL), capacity=64)
    placed = packing.place(pieces, 64)
    n = check_packed(placed.collect(), 64)
    whole = packing.sequences(pieces, placed).collect()
    assert len(whole) == n and pieces.count() == placed.count() and pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    crc = {(r.sequence_id, r.offset): (r.length, r.ids_crc32) for r in placed.collect()}
    for r in whole:
        ids = np.frombuffer(r.ids, "<u4")
        for at, nxt in zip(r.offsets, [*r.offsets[1:], len(ids)], strict=True):
            assert crc[r.sequence_id, at] == (nxt - at, zlib.crc32(ids[at:nxt].tobytes()))
    assert packing.place(packing.cut_pieces(encode_within_chunks(docs.where("false"), path, BYTE_LEVEL))).count() == 0


@pytest.mark.parametrize("kind", ["long", "short", "mid", "one length"])
def test_plans_hold_and_need_no_more_than_best_fit(kind):
    draw = np.random.default_rng(0)
    lengths = {"long": draw.integers(700, 2049, 20_000), "short": draw.integers(1, 60, 30_000), "mid": draw.integers(600, 1100, 20_000), "one length": np.full(10_001, 513)}[kind]
    counts = np.bincount(lengths, minlength=2049)
    plan = packing.Plan(counts, 2048)
    used = np.zeros(plan.sequences, int)
    for n in np.flatnonzero(counts).tolist():
        sequence, offset = plan.place(n, np.arange(counts[n]))
        np.add.at(used, sequence, n)
        assert (offset + n <= 2048).all() and len(set(zip(sequence.tolist(), offset.tolist(), strict=True))) == counts[n]
    assert used.max() <= 2048 and used.min() > 0
    assert plan.sequences <= sum(n for _, n in packing.best_fit(counts, 2048)) * 1.002 + 1
