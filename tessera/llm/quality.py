"""Quality rules: base rules on every document, then an isolation forest on rule statistics.

The forest is grown on a bounded sample of labelled rows, taken by smallest hash; each tree splits 256 of them at
random, of which at most BAD_SHARE are labelled bad: were junk as common there as in the corpus, it would not be
isolated early. A document whose mean path over the trees is short is anomalous. The threshold on the anomaly score
comes from the labels of the same sample, without rows that the base rules reject: the one that separates good from
bad rows best among those that reject at most `max_loss` of the good ones, or one. Statistics are rates of what
exceeds a small allowance, so neither long nor short documents are anomalous for their length, and ordinary ones
lie close together.

Defined results: null or blank text has no words, fails the base rules and isn't kept; without any labelled rows of
both kinds nothing but the base rules rejects; a label that is null or belongs to no document is passed over, and
of several labels for a document the lowest quality counts; repeated rows are judged alike.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import DOCUMENT, made, pick, ship, small_batches, table

#: Labelled rows that the forest and its threshold are fitted on.
SAMPLE_ROWS = 4096
TREES, SUBSAMPLE, MAX_LOSS, BAD_SHARE = 128, 256, 0.003, 0.04
MIN_WORDS, MAX_REPEAT = 10, 20
SYMBOLS = "[#*$%&|<>]"
SPACE = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATES = ("symbols", "dup_lines", "repeats", "upper", "bangs", "top_word")

_BANG = re.compile(r"[!?]")
_UPPER = re.compile("[A-Z]")
_BEYOND = re.compile(r"[^\x00-\x7f]")


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five base counts and the rates of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split on exactly the six white-space characters that end a word
    n = len(words)
    if not n:
        return [0] * 5, [0.0] * len(RATES)
    chars = len(text) - sum(text.count(c) for c in SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS[1:-1])
    lines, seen, dup = [x for x in raw.split(b"\n") if x.strip(b" \t\x0b\x0c\r")], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    repeat = 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    if len(first := set(windows)) < len(windows):
        again, once = set(), set()
        for w in windows:
            (again if w in once else once).add(w)
        end = 0
        for i, w in enumerate(windows):
            if w in again:
                repeat += i + 5 - max(end, i)
                end = i + 5
    most: dict[bytes, int] = {}
    for w in words:
        most[w] = most.get(w, 0) + 1
    upper = len(_UPPER.findall(text))
    if not text.isascii():
        upper += sum(map(str.isupper, _BEYOND.findall(text)))
    rates = [
        max(0.0, symbols - 3) / (n + 20), max(0.0, dup - 1) / (len(lines) + 10), max(0.0, repeat - n / 5 - 10) / (n + 20),
        max(0.0, upper - 0.3 * chars) / (chars + 60), max(0.0, len(_BANG.findall(text)) - n / 20) / (n + 20), max(0.0, max(most.values()) - n / 10 - 4) / (n + 20),
    ]
    return [n, chars, symbols, dup, repeat], rates


class Forest:
    """Isolation trees as flat arrays; a row's depth is the mean over trees, with the usual mend for leaf sizes."""

    def __init__(self, rows: np.ndarray, good: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 5):
        draw = np.random.default_rng(seed)
        ok, bad = np.flatnonzero(good), np.flatnonzero(~good)
        take = min(subsample, len(rows))
        n_bad = min(len(bad), max(int(take * BAD_SHARE), take - len(ok)))
        n_ok = min(len(ok), take - n_bad)
        self.size = n_ok + n_bad
        self.limit = max(1, int(np.ceil(np.log2(max(2, self.size)))))
        self.nodes = [self._grow(rows[np.concatenate([draw.choice(ok, n_ok, replace=False), draw.choice(bad, n_bad, replace=False)])], draw) for _ in range(trees)]

    @staticmethod
    def mend(n: float) -> float:
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, draw) -> tuple[np.ndarray, ...]:
        column, cut, left, right, path = [], [], [], [], []

        def node(part: np.ndarray, depth: int) -> int:
            at = len(column)
            for x in (column, left, right):
                x.append(-1)
            cut.append(0.0)
            path.append(depth + self.mend(len(part)))
            low, high = part.min(axis=0), part.max(axis=0)
            live = np.flatnonzero(high > low)
            if depth < self.limit and len(part) > 1 and len(live):
                j = int(draw.choice(live))
                c = draw.uniform(low[j], high[j])
                column[at], cut[at] = j, c
                left[at] = node(part[part[:, j] <= c], depth + 1)
                right[at] = node(part[part[:, j] > c], depth + 1)
            return at

        node(rows, 0)
        return np.array(column), np.array(cut), np.array(left), np.array(right), np.array(path)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Near 1: isolated at once; near or under 0.5: like the rest."""
        total = np.zeros(len(rows))
        line = np.arange(len(rows))
        for column, cut, left, right, path in self.nodes:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.limit):
                j = column[at]
                inner = j >= 0
                if not inner.any():
                    break
                to = np.where(rows[line, j] <= cut[at], left[at], right[at])
                at = np.where(inner, to, at)
            total += path[at]
        return 2.0 ** (-total / len(self.nodes) / max(self.mend(self.size), 1e-9))


def threshold(scores: np.ndarray, good: np.ndarray, max_loss: float = MAX_LOSS) -> float:
    """The score above which a row is rejected; infinite unless both kinds are there."""
    if not good.any() or good.all():
        return float("inf")
    ok, bad = np.sort(scores[good]), np.sort(scores[~good])
    lowest = ok[max(0, len(ok) - 1 - max(1, int(len(ok) * max_loss)))]
    cuts = np.unique(scores[scores >= lowest])
    gain = [np.mean(bad > c) - np.mean(ok > c) for c in cuts]
    best = int(np.argmax(gain))
    return float(cuts[best : best + 2].mean())  # halfway to the next score, for scores not seen here


SCHEMA = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, rates array<double>"


def rule_statistics(docs: DataFrame) -> DataFrame:
    """Base counts and rates of each document, in one pass without a shuffle."""
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("rates", pa.list_(pa.float64()))])

    def run(batches):
        for b in small_batches(batches):
            each = [statistics(t) for t in b.column("text").to_pylist()]
            counts = np.array([x for x, _ in each], np.int64).reshape(-1, 5)
            yield made({"doc_id": b.column("doc_id"), **{c: counts[:, i] for i, c in enumerate(COUNTS)}, "rates": [x for _, x in each]}, schema)

    return pick(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, SCHEMA)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_loss: float = MAX_LOSS) -> tuple[Forest | None, float]:
    """A forest and its threshold, from at most sample_rows labelled documents."""
    good = pick(labels, {"doc_id": "bigint", "quality": "int"}).dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    some = pick(docs, {"doc_id": "bigint", "text": "string"}).join(F.broadcast(good.select("doc_id")), "doc_id")
    # Of rows with one doc_id the least rates count: at most sample_rows rows reach the driver.
    fine = rule_statistics(some.select("doc_id", "text")).where(f"n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {MAX_REPEAT} * n_words")
    rows = {r.doc_id: tuple(r.rates) for r in fine.groupBy("doc_id").agg(F.min("rates").alias("rates")).collect()}
    quality = {r.doc_id: r.quality for r in good.collect()}
    if len(rows) < 8:
        return None, float("inf")
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids])
    good_rows = np.array([quality[i] > 0 for i in ids])
    forest = Forest(x, good_rows)
    return forest, threshold(forest.score(x), good_rows, max_loss)


def judge(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Each document's columns, base counts, base_failed, anomaly score and kept."""
    docs = pick(docs, DOCUMENT)
    forest, most = fit(docs, labels, **how)
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([*[(c, kinds[k]) for c, k in DOCUMENT.items()], *[(c, pa.int64()) for c in COUNTS], ("base_failed", pa.bool_()), ("anomaly", pa.float64()), ("kept", pa.bool_())])

    def run(batches):
        for b in small_batches(batches):
            each = [statistics(t) for t in b.column("text").to_pylist()]
            counts = np.array([x for x, _ in each], np.int64).reshape(-1, 5)
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT * counts[:, 0])
            score = forest.score(np.array([x for _, x in each])) if forest and len(each) else np.zeros(len(each))
            yield made({**{c: b.column(c) for c in DOCUMENT}, **{c: counts[:, i] for i, c in enumerate(COUNTS)}, "base_failed": failed, "anomaly": score, "kept": ~failed & (score <= most)}, schema)

    ship(docs.sparkSession)
    out = ", ".join([*[f"{c} {k}" for c, k in DOCUMENT.items()], *[f"{c} bigint" for c in COUNTS], "base_failed boolean", "anomaly double", "kept boolean"])
    return docs.mapInArrow(run, out)


def query(spark, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")
