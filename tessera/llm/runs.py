"""Periodic runs of words, by Crochemore's partition refinement.

Positions of a document are classed by the k words from there on, for k = 1, 2, 3, ... Classes of length k + 1 come from
those of length k by splitting: a position leaves its class by the class of the position after it, and only classes that
are not the largest part of a split before have to be looked at, so a position moves O(log n) times. Neighbours in a
class at a distance of exactly k are squares of period k, and only those with a primitive root, as a shorter root
would lie between. Squares at consecutive positions are one run.

Runs need four periods, so any square of one has at least three members in its class. Smaller classes are dead, and with
them what precedes them one step later; a document ends at a quarter of its length. All documents of a chunk are refined
together, their classes apart. Nothing is shuffled, and a document is one row.

Defined results: null and empty text have no words and no runs; white space other than the six ASCII characters is part
of a word; rows with a null doc_id are taken as they are; repeated rows give the same; an empty table gives no rows. A
run's smallest period counts, so `a a a a a a a a` is one run of period 1.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.common import give_back, pick, ship, small_batches, table

#: Bytes of text after which a chunk ends; a longer document is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: A run is as long as so many periods, and so many words, at least.
LEAST_PERIODS, LEAST_WORDS = 4, 6
#: Members without which a class holds no square of a run.
_LEAST_MEMBERS = LEAST_PERIODS - 1
_BLOCK = 64


class _Distances:
    """Positions by the distance at which they are to be looked at, for distances that come in ascending order."""

    def __init__(self):
        self.levels = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(4)]
        self.until = [0, 0, 0]  # distances below are at this level or below
        self.fresh: list[list[tuple[np.ndarray, np.ndarray]]] = [[], [], [], []]

    def _level(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        if self.fresh[level]:
            parts = [self.levels[level], *self.fresh[level]]
            self.levels[level], self.fresh[level] = (np.concatenate([d for d, _ in parts]), np.concatenate([i for _, i in parts])), []
        return self.levels[level]

    def put(self, distances: np.ndarray, positions: np.ndarray) -> None:
        rest = np.ones(len(distances), bool)
        for level, until in enumerate(self.until):
            if not rest.any():
                return
            here = rest & (distances < until)
            if here.any():
                self.fresh[level].append((distances[here], positions[here]))
                rest &= ~here
        if rest.any():
            self.fresh[3].append((distances[rest], positions[rest]))

    def take(self, distance: int) -> np.ndarray:
        for level in (2, 1, 0):
            if distance >= self.until[level]:
                width = _BLOCK ** (level + 1)
                self.until[level] = (distance // width + 1) * width
                d, i = self._level(level + 1)
                here = d < self.until[level]
                self.levels[level + 1] = d[~here], i[~here]
                self.fresh[level].append((d[here], i[here]))
        d, i = self._level(0)
        if not len(d):
            return i
        here = d == distance
        if not here.any():
            return i[:0]
        self.levels[0] = d[~here], i[~here]
        return i[here]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class _Partition:
    """Classes of positions. Members of a class lie together in `order`, and are linked by position in `next` and `last`."""

    def __init__(self, labels: np.ndarray):
        """labels: a class for each position, below 0 for none."""
        n = len(labels)
        self.order = np.argsort(labels, kind="stable")
        sorted_ = labels[self.order]
        begins = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if n else np.zeros(0, int)
        sizes = np.diff(np.append(begins, n))
        live = (sizes >= _LEAST_MEMBERS) & (sorted_[begins] >= 0) if n else np.zeros(0, bool)
        number = np.where(live, np.cumsum(live) - 1, -1)
        self.cls = np.empty(n, np.int64)
        self.cls[self.order] = np.repeat(number, sizes)
        self.place = np.empty(n, np.int64)
        self.place[self.order] = np.arange(n)
        self.start, self.size = _Grown(begins[live]), _Grown(sizes[live])
        self.next, self.last = np.full(n, -1), np.full(n, -1)
        a, b = self.order[:-1], self.order[1:]
        same = (self.cls[a] == self.cls[b]) & (self.cls[a] >= 0) if n else np.zeros(0, bool)
        self.next[a[same]], self.last[b[same]] = b[same], a[same]

    def members(self, classes: np.ndarray) -> np.ndarray:
        return self.order[_spread(self.start.a[classes], self.size.a[classes])]

    def _unlink(self, gone: np.ndarray) -> np.ndarray:
        """Take members, sorted by class and position, out of their lists; the positions whose next one is another now."""
        follows = np.append(False, self.next[gone[:-1]] == gone[1:])
        first, final = gone[~follows], gone[np.append(~follows[1:], True)]
        left, right = self.last[first], self.next[final]
        has, had = left >= 0, right >= 0
        self.next[left[has]], self.last[right[had]] = right[has], left[had]
        return left[has & had]

    def _kill(self, classes: np.ndarray) -> np.ndarray:
        dead = self.members(classes)
        self.cls[dead] = -1
        self.next[dead] = self.last[dead] = -1
        self.size.a[classes] = 0
        return dead

    def split(self, moved: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Move members out of their classes, into one new class for each old class and value of `by`; below 0: they die.

        (classes to look at next, positions that died, positions with a new next one).
        """
        own = self.cls[moved]
        at = np.lexsort((moved, own))
        changed = [self._unlink(moved[at])]
        # Swap so that what is moved fills the end of its class's stretch of `order`.
        sorted_own = own[at]
        begins = np.flatnonzero(np.append(True, sorted_own[1:] != sorted_own[:-1]))
        classes, counts = sorted_own[begins], np.diff(np.append(begins, len(at)))
        keeps = self.size.a[classes] - counts
        tail = _spread(self.start.a[classes] + keeps, counts)
        in_tail = self.place[moved[at]] >= np.repeat(self.start.a[classes] + keeps, counts)
        self.cls[moved] = -2
        stays = self.order[tail]
        stays = stays[self.cls[stays] != -2]
        holes = self.place[moved[at][~in_tail]]
        self.order[holes], self.place[stays] = stays, holes
        at = np.lexsort((moved, by, own))
        moved, own, by = moved[at], own[at], by[at]
        self.order[tail], self.place[moved] = moved, tail
        self.size.a[classes] = keeps
        # New classes.
        begins = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (by[1:] != by[:-1])))
        sizes = np.diff(np.append(begins, len(moved)))
        live = (sizes >= _LEAST_MEMBERS) & (by[begins] >= 0)
        number = np.where(live, len(self.start.a) + np.cumsum(live) - 1, -1)
        self.cls[moved] = np.repeat(number, sizes)
        parents = own[begins]
        self.start.add(tail[begins][live])
        self.size.add(sizes[live])
        inner = np.append(self.cls[moved[1:]] == self.cls[moved[:-1]], False) & (self.cls[moved] >= 0)
        self.next[moved] = self.last[moved] = -1
        a, b = moved[inner], moved[1:][inner[:-1]]
        self.next[a], self.last[b] = b, a
        changed.append(a)
        died = [moved[self.cls[moved] < 0]]
        small = (keeps > 0) & (keeps < _LEAST_MEMBERS)
        if small.any():
            died.append(self._kill(classes[small]))
        # All parts of a split but the largest are looked at next.
        rests = classes[keeps >= _LEAST_MEMBERS]
        parts, origin = np.append(number[live], rests), np.append(parents[live], rests)
        at = np.lexsort((self.size.a[parts], origin))
        parts, origin = parts[at], origin[at]
        largest = np.append(origin[1:] != origin[:-1], True) if len(origin) else np.zeros(0, bool)
        return parts[~largest], np.concatenate(died), np.concatenate(changed)


class _Grown:
    """An array that grows."""

    def __init__(self, a: np.ndarray):
        self.held, self.n = a.astype(np.int64), len(a)

    @property
    def a(self) -> np.ndarray:
        return self.held[: self.n]

    def add(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self.held):
            self.held = np.concatenate([self.held[: self.n], np.zeros(max(need, 1024), np.int64)])
        self.held[self.n : need] = more
        self.n = need


def find_runs(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(document, start, length, period) of every run, sorted by document, start and period.

    codes: words as numbers, documents end to end; offsets: where each begins, and the end.
    """
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    n = len(codes)
    limit = np.append(np.repeat(sizes // LEAST_PERIODS, sizes), 0)  # the longest period that a run can have here
    label = doc * (int(codes.max(initial=0)) + 1) + codes
    p = _Partition(np.append(np.where(limit[:-1] > 0, label, -1), -1))
    distances = _Distances()
    seen = np.flatnonzero(p.next >= 0)
    gap = p.next[seen] - seen
    distances.put(*(x[gap <= limit[seen]] for x in (gap, seen)))
    queue, found, k = np.flatnonzero(p.cls[:n] >= 0), [], 1
    dead = np.append(np.flatnonzero(p.cls[:n] < 0), n)
    ends = np.unique(offsets[1:][sizes > 0])
    most = int(limit.max(initial=0))
    while k <= most:
        squares = distances.take(k)
        squares = squares[(p.next[squares] - squares == k) & (p.cls[squares] >= 0)]
        if len(squares):
            squares = np.unique(squares)
            begins = np.flatnonzero(np.append(True, (squares[1:] != squares[:-1] + 1) | (doc[squares[1:]] != doc[squares[:-1]])))
            counts = np.diff(np.append(begins, len(squares)))
            lengths = counts - 1 + 2 * k
            long = lengths >= max(LEAST_WORDS, LEAST_PERIODS * k)
            starts = squares[begins[long]]
            found.append(np.stack([doc[starts], starts - offsets[doc[starts]], lengths[long], np.full(len(starts), k)], axis=1))
        # From k to k + 1: what precedes a member of the queue leaves its class by that member's, and what precedes the dead dies.
        after = np.concatenate([queue, dead])
        before = after - 1
        ok = before >= 0
        before, after = before[ok], after[ok]
        label = p.cls[after]
        if k == 1:
            label = np.where(np.isin(after, ends), -1, label)  # a document's last word is followed by none of its own
        ok = (p.cls[before] >= 0) & (limit[before] > k)
        before, label = before[ok], label[ok]
        if len(before):
            classes, died, changed = p.split(before, label)
            queue = p.members(classes) if len(classes) else before[:0]
            changed = changed[p.cls[changed] >= 0]
            gap = p.next[changed] - changed
            ok = (gap > k) & (gap <= limit[changed])
            if ok.any():
                distances.put(gap[ok], changed[ok])
            dead = died
        else:
            queue = dead = before
        if not len(queue) and not len(dead) and not any(len(d) for d, _ in distances.levels) and not any(distances.fresh):
            break
        k += 1
    if not found:
        return np.zeros((0, 4), np.int64)
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def split_words(text: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Texts (large_binary, no nulls) as numbers of their words, the distinct words, and offsets of texts in the numbers."""
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[firsts] = solid[firsts]
    starts = np.flatnonzero(begins)
    before = np.append(0, np.cumsum(solid))  # solid bytes before each place
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(before[starts], before[-1])), pa.py_buffer(data[solid])])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, np.searchsorted(starts, offsets)


def repeat_parts(doc_id: int | None, n: int) -> np.ndarray | None:
    """For one document in ten by its id's hash: which of its n words each place takes, a stretch from some word on repeated; else None."""
    h = zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
    ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string()),
])
_OUT_SQL = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
DIGEST = _OUT.names[:8]


def _strongest(runs: list[list[int]]) -> list[int] | None:
    """The run with the most periods; the first of equals."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _chunk(batches: list, change, texts: bool) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches).combine_chunks()
    column = pc.fill_null(rows.column("text"), "").cast(pa.large_binary())
    codes, words, offsets = split_words(pa.concat_arrays([c for c in column.chunks if len(c)] or [pa.array([], pa.large_binary())]))
    ids, words = rows.column("doc_id").to_pylist(), words.to_pylist()
    if change:
        for doc_id, low, high in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            take = change(doc_id, high - low)
            if take is not None:
                codes[low:high] = codes[low:high][take]
    runs = find_runs(codes, offsets)
    at = np.searchsorted(runs[:, 0], np.arange(len(ids) + 1))
    out: dict[str, list] = {name: [] for name in _OUT.names}
    for d, doc_id in enumerate(ids):
        own, low, high = runs[at[d] : at[d + 1], 1:].tolist(), offsets[d], offsets[d + 1]
        kept = codes[low:high]
        if own:
            stays = np.ones(high - low, bool)
            for start, length, period in own:
                stays[start + period : start + length] = False
            kept = kept[stays]
        text = b" ".join([words[c] for c in kept.tolist()])
        best = _strongest(own)
        out["doc_id"].append(doc_id)
        out["n_runs"].append(len(own))
        for name, value in zip(("start", "length", "period"), best or (None, None, None), strict=True):
            out[name].append(value)
        out["exponent_milli"].append(1000 * best[1] // best[2] if best else None)
        out["runs_sha256"].append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest())
        out["collapsed_sha256"].append(hashlib.sha256(text).hexdigest())
        out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in own] if texts else None)
        out["collapsed"].append(text.decode() if texts else None)
    return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _OUT], schema=_OUT)


def collapse_runs(docs: DataFrame, change=None, texts: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each document's runs and its text with each run cut to its first period; words joined by one space.

    change, if given, is a function of (doc_id, number of words) that says which word each place takes. Without
    texts, the runs and the text are null and only their digests are there.
    """
    ship(docs.sparkSession)

    def run(batches):
        held, size = [], 0
        for batch in small_batches(batches, 4096, chunk_bytes // 4):
            held.append(batch)
            size += batch.nbytes
            if size >= chunk_bytes:
                yield _chunk(held, change, texts)
                held, size = [], 0
                give_back()
        if held:
            yield _chunk(held, change, texts)
            held.clear()
            give_back()

    return pick(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, _OUT_SQL)


def query(spark, sf_dir: str) -> DataFrame:
    return collapse_runs(table(spark, sf_dir, "documents"), repeat_parts, texts=False).select(*DIGEST)
