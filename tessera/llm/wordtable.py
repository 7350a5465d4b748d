"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

Tasks split each text at places where no token of the vocabulary can reach across, and read documents in chunks of
bounded size. A chunk keeps each document as numbers of its words, most frequent first, in a file of the shared
folder (one a task), and deals its distinct words out by hash into buckets; a row holds one chunk's words of one
bucket, packed. A bucket's task puts the words of all chunks together, encodes each distinct one once with the
tokenizers library, and answers each chunk; the answers meet the chunk's documents again by position. So what is
shuffled is distinct words by chunk, not occurrences or texts, a frequent word counts once a chunk, and nothing is
broadcast but the vocabulary's pieces. File names carry the task attempt, and only those in the written table of
words count, so a lost attempt leaves nothing in the result.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import estimated_bytes, give_back, keep, pick, shared_dir, ship, small_batches, store

#: Bytes of text after which a chunk ends; a longer document is a chunk of its own.
CHUNK_BYTES = 16 << 20
ENCODE_AT_ONCE = 8192
#: Bytes of input for each bucket of distinct words.
BUCKET_BYTES = 64 << 20

#: How texts may be split. Byte-level BPE always breaks before a single space or line end between solid characters,
#: and after such a line end; BPE with word ends always breaks before white space, which it drops, and between a
#: Latin letter and a mark other than an apostrophe. (<, | and > don't count as marks: special tokens hold them.)
BYTE_LEVEL, WORD_END = "byte level", "word end"
_SOLID = r"[^\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff]"
_BREAK = re.compile(rf"(?<={_SOLID})(?=[ \n]{_SOLID})|(?<={_SOLID}\n)(?={_SOLID})")


_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[c for c in [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)] if chr(c) not in "'<|>"]] = 2


def plain(data: np.ndarray) -> np.ndarray:
    """Bytes of texts for BPE with word ends, alike where it makes no difference: white space, and capital letters.

    Capitals stay where a special token may be written in them, and before any byte beyond ASCII: a mark there may
    compose with the small letter and not with the capital, and the tokenizer composes first.
    """
    out = data.copy()
    out[(data >= 9) & (data <= 13)] = 32
    if not ((data[:-1] == 60) & (data[1:] == 124)).any():
        capital = (data >= 65) & (data <= 90)
        capital[:-1] &= data[1:] < 128
        out[capital] += 32
    return out


def word_starts(data: np.ndarray, offsets: np.ndarray, how: str) -> np.ndarray:
    """Where words begin in UTF-8 texts that lie end to end; a text's first byte is always one."""
    if how == WORD_END:
        space = (data == 32) | ((data >= 9) & (data <= 13))
        starts = space.copy()
        starts[1:] &= ~space[:-1]
        kind = _KIND[data]
        starts[1:] |= kind[1:] + kind[:-1] == 3
    else:
        line = data == 10
        gap = line | (data == 32)
        starts = gap.copy()
        starts[1:] |= line[:-1]
        # Texts in which white space is anything but single spaces and line ends inside are split by the pattern.
        odd = ((data >= 9) & (data <= 13) & ~line) | ((data >= 28) & (data <= 31))
        odd[1:] |= gap[1:] & gap[:-1]
        a, b, c = data[:-2], data[1:-1], data[2:]
        if (data >= 0xC2).any():
            two = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
            odd[:-1] |= two
            three = ((a == 0xE1) & ((b == 0x9A) | (b == 0xA0))) | ((a == 0xE2) & (((b == 0x80) & ((c <= 0x8F) | (c >= 0xA8))) | (b == 0x81))) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xEF) & (b == 0xBB))
            odd[:-2] |= three
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        ends = gap[offsets[full]] | gap[offsets[full + 1] - 1]
        strange = set(full[ends].tolist()) | set((np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1).tolist())
        for i in sorted(strange):
            low, high = int(offsets[i]), int(offsets[i + 1])
            starts[low:high] = False
            sizes = [len(x.encode()) for x in _BREAK.split(data[low:high].tobytes().decode())]
            starts[low + np.cumsum([0, *sizes[:-1]])] = True
    starts[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(starts)


@cache
def tokenizer(path: str):
    """The tokenizer as its file has it, but without truncation and padding; one thread, since tasks share the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


@cache
def pieces(path: str) -> list[bytes]:
    """Each id's bytes, for a byte-level vocabulary; an id without piece has none."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(printable))}
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for piece, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
    return out


def pack(a: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, their bytes apart by place and compressed."""
    a = np.ascontiguousarray(a, "<u4")
    return len(a).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    flat = pa.decompress(raw[4:], 4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(4, n).T).view("<u4").ravel()


def pack_words(words: pa.Array) -> bytes:
    words = words.cast(pa.large_binary())
    sizes = pack(pc.binary_length(words).to_numpy(zero_copy_only=False))
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    blob = words.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if len(words) and words.buffers()[2] else b""
    return len(sizes).to_bytes(4, "little") + sizes + len(blob).to_bytes(8, "little") + pa.compress(blob, codec="zstd", asbytes=True)


def unpack_words(raw: bytes) -> pa.Array:
    n = int.from_bytes(raw[:4], "little")
    sizes = unpack(raw[4 : 4 + n])
    size = int.from_bytes(raw[4 + n : 12 + n], "little")
    blob = pa.decompress(raw[12 + n :], size, codec="zstd") if size else pa.py_buffer(b"")
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), blob])


def gather(starts: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """flat[start : start + count] of each, end to end."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)] if total else flat[:0]


_WORDS = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("words", pa.binary()), ("path", pa.string()), ("place", pa.int64()), ("size", pa.int64())])


def _split(batches: list, how: str) -> tuple[pa.ChunkedArray, np.ndarray, pa.DictionaryArray]:
    """One chunk's doc_ids, its texts' numbers of words, and all its words."""
    texts = pa.Table.from_batches(batches).combine_chunks()
    column = pc.fill_null(texts.column("text"), "").cast(pa.large_binary())
    text = pa.concat_arrays([c for c in column.chunks if len(c)] or [pa.array([], pa.large_binary())])
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data = plain(data) if how == WORD_END else data
    starts = word_starts(data, offsets, how)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
    return texts.column("doc_id"), np.diff(np.searchsorted(starts, offsets)), words.dictionary_encode()


def _chunk(batches: list, buckets: int, how: str) -> tuple[bytes, list[tuple[int, bytes]]]:
    """One chunk: its documents, packed, and its distinct words by bucket."""
    ids, sizes, coded = _split(batches, how)
    ids = ids.to_pylist()
    numbers, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    words = words.take(pa.array(order))
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words.to_pylist()), np.int64, len(words))
    parts = [np.array([i or 0 for i in ids], "<i8").tobytes(), np.array([i is None for i in ids], np.uint8).tobytes(), pack(sizes), pack(rank[numbers]), pack(bucket)]
    packed = np.array([len(p) for p in parts], "<u8").tobytes() + b"".join(parts)
    by = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[by], np.arange(buckets + 1))
    words = words.take(pa.array(by))
    rows = [(b, pack_words(words.slice(ends[b], ends[b + 1] - ends[b]))) for b in range(buckets) if ends[b + 1] > ends[b]]
    return packed, rows or [(0, pack_words(words))]


def _encode_words(distinct: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Each word's number of ids, and all ids end to end."""
    model, counts, flat = tokenizer(path), np.zeros(len(distinct), np.int64), []
    for i in range(0, len(distinct), ENCODE_AT_ONCE):
        some = [w.decode("utf-8", "replace") for w in distinct.slice(i, ENCODE_AT_ONCE).to_pylist()]
        found = [e.ids for e in model.encode_batch(some, add_special_tokens=False)]
        counts[i : i + len(found)] = [len(x) for x in found]
        flat.append(np.fromiter((t for x in found for t in x), np.uint32))
    return counts, np.concatenate(flat) if flat else np.zeros(0, np.uint32)


#: Words that a worker remembers from chunk to chunk, with their ids, by vocabulary; its processes outlive tasks.
MOST_KNOWN = 600_000
_known: dict[str, tuple[pa.Array, np.ndarray, np.ndarray]] = {}


def _encode_unknown(distinct: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """As _encode_words, but words of the worker's last chunks aren't encoded again."""
    distinct = distinct.cast(pa.large_binary())
    words, counts, flat = _known.get(path, (distinct[:0], np.zeros(0, np.int64), np.zeros(0, np.uint32)))
    at = pc.index_in(distinct, value_set=words)
    new = distinct.filter(pc.is_null(at))
    new_counts, new_flat = _encode_words(new, path)
    index = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    index[index < 0] = len(words) + np.arange(len(new))
    counts, flat = np.concatenate([counts, new_counts]), np.concatenate([flat, new_flat])
    starts = np.cumsum(counts) - counts
    own, ids = counts[index], gather(starts[index], counts[index], flat)
    _known[path] = (pa.concat_arrays([words, new]), counts, flat) if len(counts) <= MOST_KNOWN else (distinct, own, ids)
    return own, ids


def _encode_bucket(path: str, rows: pa.Table) -> pa.Table:
    """All chunks' words of one bucket: each distinct word encoded once, and every chunk answered."""
    each = [unpack_words(x.as_py()) for x in rows.column("words")]
    coded = pa.concat_arrays(each).dictionary_encode()
    counts, flat = _encode_words(coded.dictionary, path)
    starts, at, lengths, ids = np.cumsum(counts) - counts, 0, [], []
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    for words in each:
        own = numbers[at : at + len(words)]
        at += len(words)
        lengths.append(pack(counts[own]))
        ids.append(pack(gather(starts[own], counts[own], flat)))
    kept = {c: rows.column(c) for c in ("chunk", "bucket", "path", "place", "size")}
    return pa.table(kept | {"lengths": pa.array(lengths, pa.binary()), "ids": pa.array(ids, pa.binary())}).select(["chunk", "bucket", "lengths", "ids", "path", "place", "size"])


def _assemble(answers: pa.Table) -> pa.Table:
    """One chunk's documents as ids, from its answers and its packed documents."""
    first = answers.slice(0, 1).to_pylist()[0]
    answers = answers.sort_by("bucket")
    files, base = store(first["path"])
    with files.open_input_file(base) as f:
        f.seek(first["place"])
        raw = f.read(first["size"])
    ends = np.cumsum(np.append(np.uint64(40), np.frombuffer(raw, "<u8", 5))).astype(int)
    doc_ids, nulls, sizes, numbers, bucket = (raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
    sizes, numbers, bucket = unpack(sizes), unpack(numbers), unpack(bucket)
    by = np.argsort(bucket, kind="stable")
    flat = np.concatenate([unpack(x) for x in answers.column("ids").to_pylist()])
    counts, starts = np.zeros(len(bucket), np.int64), np.zeros(len(bucket), np.int64)
    counts[by] = np.concatenate([unpack(x) for x in answers.column("lengths").to_pylist()])
    starts[by] = np.cumsum(counts[by]) - counts[by]
    at, out = 0, []
    for size in sizes.tolist():
        own = numbers[at : at + size]
        at += size
        out.append(np.ascontiguousarray(gather(starts[own], counts[own], flat), "<u4").tobytes())
    return pa.table({"doc_id": pa.array(np.frombuffer(doc_ids, "<i8"), pa.int64(), mask=np.frombuffer(nulls, np.uint8).astype(bool)), "ids": pa.array(out, pa.binary())})


def encode(docs: DataFrame, path: str, how: str = BYTE_LEVEL, chunk_bytes: int = CHUNK_BYTES, buckets: int | None = None, then=None) -> DataFrame:
    """(doc_id, ids), a row for each row of docs; ids is binary, little-endian unsigned 32-bit integers.

    then, if given, is (function of such a table, schema of what it returns), and runs where the ids are made.
    Null and empty text give no ids; rows with equal or null doc_id stay apart.
    """
    spark = docs.sparkSession
    ship(spark)
    # More input has more distinct words: a bucket for each BUCKET_BYTES of it, so that none outgrows a task.
    buckets = buckets or max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(docs) // BUCKET_BYTES)
    root = f"{shared_dir(spark)}/encoding-{uuid.uuid4().hex}"

    def run(batches):
        from pyspark import TaskContext

        task, n, at, held, size = TaskContext.get(), 0, 0, [], 0
        name = f"{root}/{task.partitionId()}-{task.taskAttemptId()}.docs"
        files, base = store(name)
        files.create_dir(os.path.dirname(base), recursive=True)
        out = None

        def rows():
            packed, words = _chunk(held, buckets, how)
            out.write(packed)
            for b, raw in words:
                yield pa.RecordBatch.from_pylist([{"chunk": f"{task.partitionId()}-{n}", "bucket": b, "words": raw, "path": name, "place": at, "size": len(packed)}], schema=_WORDS)

        for batch in small_batches(batches, 4096, chunk_bytes // 4):
            out = out or files.open_output_stream(base)
            held.append(batch)
            size += batch.nbytes
            if size >= chunk_bytes:
                for row in rows():
                    yield row
                n, at, held, size = n + 1, at + row.column("size")[0].as_py(), [], 0
                give_back()
        if held:
            yield from rows()
            held.clear()
            give_back()
        if out:
            out.close()

    some = pick(docs, {"doc_id": "bigint", "text": "string"})
    words = keep(some.mapInArrow(run, "chunk string, bucket int, words binary, path string, place bigint, size bigint"), "words")
    finish, schema = then or (lambda out: out, "doc_id bigint, ids binary")

    def answer(rows: pa.Table) -> pa.Table:
        out = _encode_bucket(path, rows)
        give_back()
        return out

    def assemble(rows: pa.Table) -> pa.Table:
        out = finish(_assemble(rows))
        give_back()
        return out

    answers = words.groupBy("bucket").applyInArrow(answer, "chunk string, bucket int, lengths binary, ids binary, path string, place bigint, size bigint")
    return answers.groupBy("chunk").applyInArrow(assemble, schema)


def encode_within_chunks(docs: DataFrame, path: str, how: str = BYTE_LEVEL, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, packed), without a shuffle: each chunk encodes its own distinct words once, and `unpack` gives ids.

    A word is encoded again by each worker, and by one that has met too many others since; that takes more CPU than
    `encode`, and no disk.
    """
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("packed", pa.binary())])

    def chunk(held: list) -> pa.RecordBatch:
        ids, sizes, coded = _split(held, how)
        counts, flat = _encode_unknown(coded.dictionary, path)
        starts, numbers, at, out = np.cumsum(counts) - counts, coded.indices.to_numpy(zero_copy_only=False), 0, []
        for size in sizes.tolist():
            own = numbers[at : at + size]
            at += size
            out.append(pack(gather(starts[own], counts[own], flat)))
        return pa.RecordBatch.from_arrays([ids.combine_chunks(), pa.array(out, pa.binary())], schema=schema)

    def run(batches):
        held, size = [], 0
        for batch in small_batches(batches, 4096, chunk_bytes // 4):
            held.append(batch)
            size += batch.nbytes
            if size >= chunk_bytes:
                yield chunk(held)
                held, size = [], 0
                give_back()
        if held:
            yield chunk(held)
            held.clear()
            give_back()

    return pick(docs, {"doc_id": "bigint", "text": "string"}).mapInArrow(run, "doc_id bigint, packed binary")


@cache
def _piece_table(path: str) -> pa.Array:
    return pa.array(pieces(path), pa.large_binary())


def _text(raw: bytes) -> bytes:
    """UTF-8, with what isn't replaced as the library does."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def decode(ids: bytes, path: str) -> bytes:
    """The text of ids, in UTF-8: ids are the positions of their pieces, so the join with the pieces is one take."""
    found = _piece_table(path).take(pa.array(np.frombuffer(ids, "<u4").astype(np.int64)))
    if not len(found):
        return b""
    ends = np.frombuffer(found.buffers()[1], np.int64)
    return _text(found.buffers()[2].slice(ends[0], ends[len(found)] - ends[0]).to_pybytes() if found.buffers()[2] else b"")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids), by a join of every id with the table of pieces, which a vocabulary bounds.

    The pieces of a document come together again in order of position; rows with equal doc_id stay apart.
    """
    spark = encoded.sparkSession
    ship(spark)
    rows = keep(encoded.select("doc_id", "ids").withColumn("row", F.monotonically_increasing_id()), "encoded")
    known = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(pieces(path))], "id bigint, piece binary")

    def spread(batches):
        for b in small_batches(batches, 256):
            each = [np.frombuffer(x or b"", "<u4").astype(np.int64) for x in b.column("ids").to_pylist()]
            sizes = [len(x) for x in each]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("row").to_numpy(), sizes)), pa.array(np.concatenate([np.arange(n) for n in sizes])), pa.array(np.concatenate(each))], names=["row", "at", "id"])

    tokens = rows.select("row", "ids").mapInArrow(spread, "row bigint, at bigint, id bigint")
    found = tokens.join(F.broadcast(known), "id").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("found"))
    whole = rows.select("row", "doc_id").join(found, "row", "left").select("doc_id", F.unhex(F.array_join(F.transform("found", lambda x: F.hex(x["piece"])), "")).alias("raw"))

    def texts(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([_text(x or b"").decode() for x in b.column("raw").to_pylist()], pa.string())], names=["doc_id", "text"])

    return whole.mapInArrow(texts, "doc_id bigint, text string")
