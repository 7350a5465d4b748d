"""Best-fit packing of documents into sequences, by patterns of lengths and non-negative least squares.

Documents are cut into pieces of at most CAPACITY tokens; the first piece of a longer one holds what whole pieces leave
over. A plan is made from the histogram of lengths alone, which has CAPACITY counts whatever the corpus: patterns of two
and three lengths that fill a sequence exactly are enumerated, how often each is used is fitted to the histogram by
non-negative least squares (accelerated projected gradients; a length weighs as its tokens do), rounded, and what is
left over goes into open sequences by best fit, longest first, many equal ones at once. The plan says which ranks of each
length go to which sequences and offsets.

Pieces get their rank among pieces of their length from a count within their partition and the counts of the partitions
before, so neither the ranks nor the placing gather a length in one task, however many pieces share it.

Defined results: null and empty text are a document of the end id alone, so each row has a piece; rows with equal or
null doc_id stay apart; of equal lengths, which piece lies where follows the order of partitions and rows; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import vocabulary
from tessera.llm.common import keep, ship, small_batches, table
from tessera.llm.wordtable import BYTE_LEVEL, encode_within_chunks, pack, unpack

CAPACITY, END_ID = 2048, 0
#: Steps of the fit; triples of lengths enumerated at most, by those whose rarest length is most frequent.
STEPS, MOST_TRIPLES = 200, 400_000


def patterns(counts: np.ndarray, capacity: int, most: int = MOST_TRIPLES) -> np.ndarray:
    """Lengths a >= b >= c >= 0 of which there are some each, with a + b + c equal to the capacity; counts: by length."""
    have = np.flatnonzero(counts[:capacity])
    have = have[have > 0]
    there = counts > 0
    pairs = [(capacity - b, b, 0) for b in have.tolist() if 2 * b <= capacity and there[capacity - b]]
    out = [np.array(pairs, np.int64).reshape(-1, 3)]
    for c in have[3 * have <= capacity].tolist():
        b = have[(have >= c) & (have <= (capacity - c) // 2)]
        b = b[there[capacity - c - b]]
        out.append(np.stack([capacity - c - b, b, np.full(len(b), c)], axis=1))
    found = np.concatenate(out)
    if len(found) > most:
        rare = np.where(found > 0, counts[found], counts.max()).min(axis=1)
        found = found[np.sort(np.argsort(-rare, kind="stable")[:most])]
    return found


def fit(found: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """How often to use each pattern: x >= 0 with the least weighted squares of counts minus what x uses."""
    if not len(found):
        return np.zeros(0)
    size = len(counts)
    weight = np.arange(size, dtype=float) / (size - 1)
    weight[0] = 0
    target, flat = counts * weight, found.T.ravel()

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, np.tile(x, 3), size) * weight

    def back(r: np.ndarray) -> np.ndarray:
        r = r * weight
        return r[found[:, 0]] + r[found[:, 1]] + r[found[:, 2]]

    x = np.ones(len(found))
    for _ in range(12):  # the largest singular value, for the step
        x = back(used(x))
        norm = np.linalg.norm(x)
        x /= norm
    x, y, t = np.zeros(len(found)), np.zeros(len(found)), 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(used(y) - target) / (1.05 * norm))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def round_uses(found: np.ndarray, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole uses of the patterns that the counts allow, and the counts left over: whole parts first, then large fractions."""
    left, uses = counts.astype(np.int64).copy(), np.zeros(len(found), np.int64)
    left[0] = 0
    whole = np.floor(x).astype(np.int64)
    for want, order in ((whole, np.argsort(-x, kind="stable")), (np.ones(len(x), np.int64), np.argsort(whole - x, kind="stable"))):
        for i in order[(want[order] > 0) & (x[order] > 0.01)].tolist():
            need = Counter(n for n in found[i].tolist() if n)
            most = min(int(want[i]), *(int(left[n]) // k for n, k in need.items()))
            if most > 0:
                uses[i] += most
                for n, k in need.items():
                    left[n] -= most * k
    return uses, left


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, uses): what is left over, longest first, each into the fullest open sequences that have room."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []  # a heap of rooms that open_ may have

    def add(lengths: tuple[int, ...], room: int, uses: int) -> None:
        if not open_[room]:
            heappush(rooms, room)
        open_[room].append((lengths, uses))

    for n in range(len(left) - 1, 0, -1):
        todo, passed = int(left[n]), []
        while todo and rooms:
            room = heappop(rooms)
            if not open_[room]:
                continue
            if room < n:
                passed.append(room)
                continue
            fits = room // n
            lengths, uses = open_[room].pop()
            if open_[room]:
                heappush(rooms, room)
            # As many as fit into each of these sequences; one that would be filled in part only, by itself.
            full = min(uses, todo // fits)
            if full:
                add(lengths + (n,) * fits, room - fits * n, full)
                todo, uses = todo - full * fits, uses - full
            if uses and todo:
                part = min(todo, fits)
                add(lengths + (n,) * part, room - part * n, 1)
                todo, uses = todo - part, uses - 1
            if uses:
                add(lengths, room, uses)
        for room in passed:
            heappush(rooms, room)
        if len(rooms) > 4 * capacity:
            rooms = [r for r in set(rooms) if open_[r]]
            heapify(rooms)
        if todo:
            fits = capacity // n
            if todo // fits:
                add((n,) * fits, capacity - fits * n, todo // fits)
            if todo % fits:
                add((n,) * (todo % fits), capacity - todo % fits * n, 1)
    merged: Counter = Counter()
    for groups in open_.values():
        for lengths, uses in groups:
            merged[lengths] += uses
    return sorted(merged.items())


class Plan:
    """Where the pieces of each length go: ranks from `first` on, `each` of them to a sequence, from `sequence` on, `step`
    of a pattern's equal lengths lying one after another from `offset`."""

    def __init__(self, counts: np.ndarray, capacity: int):
        found = patterns(counts, capacity)
        uses, left = round_uses(found, fit(found, counts), counts)
        some = [(tuple(n for n in found[i].tolist() if n), int(uses[i])) for i in np.flatnonzero(uses).tolist()]
        some += best_fit(left, capacity)
        rows, done, sequence = defaultdict(list), Counter(), 0
        for lengths, n in some:
            offset = 0
            for length, each in sorted(Counter(lengths).items(), reverse=True):
                rows[length].append((done[length], each, sequence, offset))
                done[length] += each * n
                offset += each * length
            sequence += n
        self.sequences = sequence
        self.rows = {length: np.array(r, np.int64).T for length, r in rows.items()}

    def place(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, each, sequence, offset = self.rows[length]
        at = np.searchsorted(first, ranks, side="right") - 1
        within = ranks - first[at]
        return sequence[at] + within // each[at], offset[at] + within % each[at] * length


_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64()), ("packed", pa.binary()),
])
_PIECE_SQL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint, packed binary"


def cut_pieces(encoded: DataFrame, capacity: int = CAPACITY, end_id: int | None = END_ID, with_ids: bool = True) -> DataFrame:
    """(doc_id, packed) to pieces, kept: doc_id, piece, start, length, ids_crc32, part and rank (among pieces of its length in
    that partition), packed (the piece's ids; null without with_ids). A document without any ids has no piece."""

    def run(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in small_batches(batches, 1024, 4 << 20):
            out: dict[str, list] = {f.name: [] for f in _PIECE}
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("packed"), strict=True):
                ids = unpack(raw.as_py())
                ids = ids if end_id is None else np.append(ids, np.uint32(end_id))
                bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) else [0]
                for piece, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    own = np.ascontiguousarray(ids[low:high], "<u4")
                    for name, value in zip(_PIECE.names, (doc_id, piece, low, high - low, zlib.crc32(own.tobytes()), part, int(seen[high - low]), pack(own) if with_ids else None), strict=True):
                        out[name].append(value)
                    seen[high - low] += 1
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _PIECE], schema=_PIECE)

    ship(encoded.sparkSession)
    return keep(encoded.select("doc_id", "packed").mapInArrow(run, _PIECE_SQL), "pieces")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset: doc_id, piece, start, length, ids_crc32, sequence_id, offset, part, rank."""
    spark = pieces.sparkSession
    ship(spark)
    by_part = keep(pieces.groupBy("part", "length").count(), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("count").alias("n")).collect():  # a row a length
        counts[r.length] = r.n
    plan = spark.sparkContext.broadcast(Plan(counts, capacity))
    # A row for each partition and length: how many pieces of that length the partitions before have.
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_part.select(F.col("part").alias("_part"), F.col("length").alias("_length"), F.coalesce(before, F.lit(0)).alias("base"))
    ranked = pieces.drop("packed").join(bases, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length"))).withColumn("whole_rank", F.col("rank") + F.col("base"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            lengths, ranks = b.column("length").to_numpy(zero_copy_only=False), b.column("whole_rank").to_numpy(zero_copy_only=False)
            at = np.argsort(lengths, kind="stable")
            sequence, offset = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for own in np.split(at, np.flatnonzero(np.diff(lengths[at])) + 1):
                sequence[own], offset[own] = plan.value.place(int(lengths[own[0]]), ranks[own])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    placed = ranked.select(*columns, "whole_rank").mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint, sequence_id bigint, offset bigint")
    return placed


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): the packed sequences themselves, ids as little-endian unsigned 32-bit integers."""
    both = pieces.select("part", "length", "rank", "packed").join(placed.select("part", "length", "rank", "doc_id", "sequence_id", "offset"), ["part", "length", "rank"])
    each = both.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "packed"))).alias("p"))

    def run(batches):
        for b in small_batches(batches, 1024, 4 << 20):
            rows = b.column("p").to_pylist()
            ids = [b"".join(np.ascontiguousarray(unpack(x["packed"]), "<u4").tobytes() for x in r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("sequence_id"), pa.array(ids, pa.binary()), pa.array([[x["doc_id"] for x in r] for r in rows], pa.list_(pa.int64())), pa.array([[x["offset"] for x in r] for r in rows], pa.list_(pa.int64()))],
                names=["sequence_id", "ids", "doc_ids", "offsets"],
            )

    return each.mapInArrow(run, "sequence_id bigint, ids binary, doc_ids array<bigint>, offsets array<bigint>")


def query(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    encoded = encode_within_chunks(table(spark, sf_dir, "documents"), path or vocabulary("byte_bpe_50k.json"), BYTE_LEVEL)
    return place(cut_pieces(encoded, with_ids=False)).drop("part", "rank")
