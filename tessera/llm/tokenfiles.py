"""Token files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents, cut into blocks of BLOCK ids. A block stores its minimum, the offsets
from it packed at the width that a percentile of them fits in, and the wider ones in a list of exceptions
(place, offset). The footer indexes documents (id and number of ids) and block starts, so that any range of ids can
be read without the rest.

    file   = "PFR1" block* footer footer_size:u64 "PFR1"
    block  = count:u32 minimum:u32 width:u8 exceptions:u32 packed place:u16* offset:u32*
    footer = documents:u32 blocks:u32 doc_id:i64* is_null:u8* ids:u64* block_start:u64*

Documents go to slots by ranges of doc_id, bounded by quantiles; a doc_id with very many rows has several slots. The
task that sorts a slot writes it to one file, or to several in a row beyond FILE_IDS ids. Readers seek by the footer. A file's name carries the task attempt, and only files in the table that the job returns count, so an
attempt that was lost leaves nothing in the result.

Defined results: null and empty text give the end id alone; null doc_id comes before all others; rows with equal
doc_id stay apart, in an order that their ids fix (and for very many of them, a hash of the ids); an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import vocabulary
from tessera.llm.common import keep, made, pick, shared_dir, ship, store, table
from tessera.llm.wordtable import WORD_END, encode_within_chunks, unpack

MAGIC, BLOCK, PERCENTILE, END_ID = b"PFR1", 4096, 95, 2
MAX_SLOTS = 5000
#: A slot's next file begins after so many ids; slots of one heavy doc_id at most, and rows that make one heavy at least.
FILE_IDS, SALTS, HEAVY_ROWS = 1 << 26, 1024, 1000
_HEAD = struct.Struct("<IIBI")


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    width = int(np.percentile(rest, percentile, method="higher")).bit_length()
    wide = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, int)
    bits = ((rest[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    packed = np.packbits(bits.ravel(), bitorder="little").tobytes()
    return _HEAD.pack(len(ids), low, width, len(wide)) + packed + wide.astype("<u2").tobytes() + rest[wide].astype("<u4").tobytes()


def unpack_block(raw: bytes, at: int) -> np.ndarray:
    n, low, width, wide = _HEAD.unpack_from(raw, at)
    at += _HEAD.size
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), bitorder="little")[: n * width].reshape(n, width)
    rest = bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32)) if width else np.zeros(n, np.uint32)
    at += size
    places = np.frombuffer(raw, "<u2", wide, at)
    rest[places] = np.frombuffer(raw, "<u4", wide, at + 2 * wide)
    return rest + np.uint32(low)


class Writer:
    """Takes documents in order; writes each block as soon as it is full."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.docs, self.counts, self.starts, self.held, self.n = [], [], [], [], 0
        self._put(MAGIC)

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= 64 * BLOCK:
            self._blocks(self.n // BLOCK * BLOCK)

    def _blocks(self, upto: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for i in range(0, upto, BLOCK):
            self.starts.append(self.at)
            self._put(pack_block(ids[i : min(i + BLOCK, upto)]))
        self.held, self.n = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self._blocks(self.n)
        foot = struct.pack("<II", len(self.docs), len(self.starts)) + np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array([d is None for d in self.docs], np.uint8).tobytes()
        foot += np.array(self.counts, "<u8").tobytes() + np.array(self.starts, "<u8").tobytes()
        self._put(foot + struct.pack("<Q", len(foot)) + MAGIC)
        self.out.close()


class Reader:
    """One file's index; ids are read by range, and only the blocks that hold them. file is opened for seeking."""

    def __init__(self, file):
        file.seek(0)
        head = file.read(4)
        end = file.seek(0, 2)
        file.seek(max(0, end - 12))
        tail = file.read(12)
        if head != MAGIC or tail[-4:] != MAGIC:
            raise ValueError("not a token file")
        (size,) = struct.unpack("<Q", tail[:8])
        self.file, self.end = file, end - 12 - size
        file.seek(self.end)
        raw = file.read(size)
        docs, blocks = struct.unpack_from("<II", raw, 0)
        null = np.frombuffer(raw, np.uint8, docs, 8 + 8 * docs)
        self.doc_ids = [None if z else d for d, z in zip(np.frombuffer(raw, "<i8", docs, 8).tolist(), null.tolist(), strict=True)]
        at = 8 + 9 * docs
        self.counts = np.frombuffer(raw, "<u8", docs, at).astype(np.int64)
        self.starts = np.frombuffer(raw, "<u8", blocks, at + 8 * docs).astype(np.int64)

    def ids(self, start: int, count: int) -> np.ndarray:
        if not count:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (start + count - 1) // BLOCK
        low = int(self.starts[first])
        high = int(self.starts[last + 1]) if last + 1 < len(self.starts) else self.end
        self.file.seek(low)
        raw = self.file.read(high - low)
        part = np.concatenate([unpack_block(raw, int(self.starts[b]) - low) for b in range(first, last + 1)])
        return part[start - first * BLOCK : start - first * BLOCK + count]

    def documents(self):
        """(doc_id, place of its first id in the file, ids), in order; some blocks at a time."""
        start, have, low, total = 0, np.zeros(0, np.uint32), 0, int(self.counts.sum())
        for doc_id, n in zip(self.doc_ids, self.counts.tolist(), strict=True):
            if start + n > low + len(have):
                low = start
                have = self.ids(start, min(total - start, max(n, 64 * BLOCK)))
            yield doc_id, start, have[start - low : start - low + n]
            start += n


class Slots:
    """Where documents go: slots by ranges of doc_id, null first; a doc_id with very many rows has slots of its own, by
    a hash of the ids. bounds are sorted; heavy gives such a doc_id's number of slots, and its place is after those below."""

    def __init__(self, bounds: list[int], heavy: dict[int | None, int]):
        self.bounds, self.heavy = np.array(bounds, np.int64), heavy

    def of(self, doc_ids: list, packed: list[bytes]) -> np.ndarray:
        """Slot numbers, in order of (doc_id, hash for heavy ones)."""
        plain = np.array([d or 0 for d in doc_ids], np.int64)
        # Two for each range, since a heavy doc_id is a bound and comes between those below and those above.
        at = 2 * np.searchsorted(self.bounds, plain, side="left") + 2
        at[np.isin(plain, [d for d in self.heavy if d is not None])] += 1
        out = at * SALTS
        for i, d in enumerate(doc_ids):
            if d is None:
                out[i] = 0
            if d in self.heavy:
                out[i] += xxhash.xxh3_64_intdigest(packed[i]) % self.heavy[d]
        return out


def write_tokens(encoded: DataFrame, ids_of: DataFrame, end_id: int | None = END_ID, slots: int | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write (doc_id, packed) in order of doc_id; the table of files: slot, piece, path, documents, ids, and ids before it.

    ids_of has the doc_id column of the same rows; slot bounds are quantiles of it.
    """
    spark = encoded.sparkSession
    ship(spark)
    root = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    slots = slots or min(MAX_SLOTS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = pick(ids_of, {"doc_id": "bigint"})
    bounds = own.select(F.percentile_approx("doc_id", [i / slots for i in range(1, slots)], 20 * slots)).first()[0] if slots > 1 else []
    share = max(HEAVY_ROWS, own.count() // slots)
    # A doc_id is heavy with more rows than a slot's share: at most as many as there are slots.
    heavy = {r.doc_id: min(SALTS, 1 + r["count"] // share) for r in own.groupBy("doc_id").count().where(F.col("count") > share).collect()}
    where = Slots(sorted({*(bounds or []), *(d for d in heavy if d is not None)}), heavy)
    slotted = pa.schema([("doc_id", pa.int64()), ("packed", pa.binary()), ("slot", pa.int64())])

    def deal(batches):
        for b in batches:
            packed = b.column("packed").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("packed"), pa.array(where.of(b.column("doc_id").to_pylist(), packed))], schema=slotted)

    schema = pa.schema([("slot", pa.int64()), ("piece", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        files, base = store(root)
        files.create_dir(base, recursive=True)
        at, piece, writer, path, n = None, 0, None, "", 0

        def done():
            writer.close()
            return made({"slot": [at], "piece": [piece], "path": [path], "documents": [len(writer.docs)], "ids": [n]}, schema)

        for b in batches:
            for s, doc_id, ids in zip(b.column("slot").to_pylist(), b.column("doc_id").to_pylist(), b.column("packed"), strict=True):
                if s != at or n >= file_ids:
                    if writer:
                        yield done()
                    at, piece, n = s, piece + 1 if s == at else 0, 0
                    name = f"slot-{s:08d}-{piece:04d}-{attempt}.pfr"
                    path = f"{root}/{name}"
                    writer = Writer(files.open_output_stream(f"{base}/{name}"))
                own = unpack(ids.as_py())
                own = own if end_id is None else np.append(own, np.uint32(end_id))
                writer.add(doc_id, own)
                n += len(own)
        if writer:
            yield done()

    dealt = encoded.select("doc_id", "packed").mapInArrow(deal, "doc_id bigint, packed binary, slot bigint").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slot")
    written = keep(dealt.sortWithinPartitions("slot", "doc_id", "packed").mapInArrow(run, "slot bigint, piece int, path string, documents bigint, ids bigint"), "token-files")
    before = Window.orderBy("slot", "piece").rowsBetween(Window.unboundedPreceding, -1)  # over files
    return written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    ship(files.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                files, base = store(path)
                with files.open_input_file(base) as f:
                    each = Reader(f).documents()
                    while out := [(d, start + at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())) for d, at, ids in islice(each, 4096)]:
                        yield made(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)

    spread = files.select("path", "start").repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def query(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    encoded = encode_within_chunks(docs, path or vocabulary("word_bpe_49k.json"), WORD_END)
    return read_tokens(write_tokens(encoded, docs))
