"""N-gram Jaccard join by PartEnum signatures.

A text is the set of its distinct n-word shingles, as 64-bit hashes; equal sets are one class. Sizes fall into bands
so wide that sets similar enough lie in the same or in neighbouring bands, and instance i serves the pairs within
band i-1 and between it and band i. There, similar sets differ in at most k features.

Signatures have two levels. The domain of features is dealt into k // 2 + 1 + e first-level parts, so that similar sets
differ by at most one feature in at least 1 + e of these. Each is dealt into three second-level parts, and every
subset of two of them is enumerated: its signature is a hash of the set's features there. One feature can spoil only
one second-level part, so in each of those 1 + e parts one subset agrees. Subsets without features give no signature:
a set that has such in at most e first-level parts shares a signature with every set similar to it. The few that
have more are dealt again by other hashes, up to LEVELS times, and at the last their empty subsets sign as well. So no
similar pair is missed.

Groups of classes with one signature are gathered in chunks first, and only one member of each goes on to meet the
others, so a frequent signature is no large group; groups of the same classes are one. Within a group, in blocks of
bounded size, classes are compared by parity sketches: the parities of their features dealt into some bits differ in at
most as many bits as the sets differ in features, so a sketch rules pairs out and never wrongly. What it leaves is
verified on the sets: first each class's nearest, twice, and then all that still lie in different components. A group of
several blocks is a star at first: its members meet its least only. Later the members of its commonest component don't
meet each other, so a group of near copies costs time linear in it, and only what isn't like its least costs more.

Defined results: null and blank text is the empty set, linked with nothing; shorter texts are one shingle; rows with
equal sets are linked; component_id is the least doc_id, null only if all in it are null. Class keys have 64 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import DOCUMENT, estimated_bytes, give_back, keep, made, pick, settle, ship, small_batches, table
from tessera.operators.components import connected

#: Bytes of sets after which a chunk ends; a larger set is a chunk of its own.
CHUNK_BYTES = 24 << 20
#: A filter has at most so many blocks of 64 bytes; beyond 5 million keys it lets more pass, and a join takes those out.
MAX_BLOOM_BLOCKS = 1 << 17
MEMBERS_A_SALT = 2000
#: Bytes of the tables read that make a part of the signatures; a part is met in one worker's memory.
PART_BYTES = 32 << 20
#: Members of a group that are compared at once with each other, or with so many others.
BLOCK_MEMBERS = 1024
#: How often a set with too many empty subsets is dealt anew.
LEVELS = 8
SUBSETS = ((0, 1), (0, 2), (1, 2))
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_P, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _seed(*numbers: int) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(repr(numbers).encode()))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, n: int, hashes: dict) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = out * _P + h[i : len(h) - size + 1 + i]
    return np.unique(_mix(out))


def class_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


class Bands:
    """Size bands; for each instance the distance of similar sets, its first-level parts, and how many may be empty."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.low, self.high, self._parts = num, den, [1], [den // num], {}

    def of(self, size: int) -> int:
        while self.high[-1] < size:
            self.low.append(self.high[-1] + 1)
            self.high.append(self.low[-1] * self.den // self.num)
        return int(np.searchsorted(np.array(self.high), size))

    def distance(self, instance: int) -> int:
        while len(self.high) <= instance:
            self.of(self.high[-1] + 1)
        most = self.high[instance] + (self.high[instance - 1] if instance else self.high[instance])
        return most * (self.den - self.num) // (self.den + self.num)

    def parts(self, instance: int) -> tuple[int, int]:
        """(first-level parts, e): e so that few of the smallest sets have more empty parts; any e is exact."""
        if instance not in self._parts:
            k, smallest = self.distance(instance), self.low[max(0, instance - 1)]
            best = None
            for e in range(0, 60 + k // 8):
                n = k // 2 + 1 + e
                mean = n * min(1.0, 3 * (1 - 2 / (3 * n)) ** smallest)
                term, more = math.exp(-mean), 1.0
                for i in range(e + 1):
                    more -= term
                    term *= mean / (i + 1)
                if best is None or more < best[0] - 1e-12:
                    best = (more, n, e)
                if more < 0.02:
                    break
            self._parts[instance] = best[1:]
        return self._parts[instance]

    def bits(self, size: int) -> int:
        """Bits of a sketch: a power of two, about 16 for each feature that similar sets may differ in."""
        k = self.distance(self.of(size) + 1)
        return 1 << max(6, (16 * k - 1).bit_length())


def sketch(s: np.ndarray, bands: Bands) -> bytes:
    """Parities of the features dealt into bits; halves of it, put together by exclusive or, are a shorter sketch."""
    bits = bands.bits(len(s))
    odd = np.bincount((_mix(s ^ _A) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _signed(sets: list[np.ndarray], instance: int, level: int, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sets of bands that the instance serves: signatures, whose each is, and which sets have to be dealt anew."""
    parts, empty = bands.parts(instance)
    sizes = [len(s) for s in sets]
    h = _mix(np.concatenate(sets) + _seed(instance, level))
    at = np.repeat(np.arange(len(sets)), sizes) * parts
    at += ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    at *= 3
    at += (h % np.uint64(3)).astype(np.int64)
    total = np.zeros(len(sets) * parts * 3, np.uint64)
    np.add.at(total, at, h)
    count = np.bincount(at, minlength=len(total)).reshape(len(sets), parts, 3)
    total = _mix(total ^ _B).reshape(len(sets), parts, 3)
    place = np.arange(1, parts + 1, dtype=np.uint64) * _A
    some_empty, out, owner, last = np.zeros((len(sets), parts), bool), [], [], level == LEVELS - 1
    for i, (a, b) in enumerate(SUBSETS):
        full = (count[:, :, a] + count[:, :, b]) > 0
        some_empty |= ~full
        sig = _mix(total[:, :, a] * np.uint64(3) + total[:, :, b] * np.uint64(5) + place + _seed(instance, level, i))
        given = np.ones_like(full) if last else full
        out.append(sig[given])
        owner.append(np.nonzero(given)[0])
    again = np.zeros(len(sets), bool) if last else some_empty.sum(axis=1) > empty
    return np.concatenate(out), np.concatenate(owner), np.flatnonzero(again)


def signatures(sets: list[np.ndarray], bands: Bands, at_once: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """All sets' signatures for both of their instances, and whose each is. Pairs that must be equal need none."""
    by_instance: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        band = bands.of(len(s))
        for instance in (band, band + 1):
            if bands.distance(instance):
                by_instance.setdefault(instance, []).append(i)
    out, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for instance, every in by_instance.items():
        start = 0
        while start < len(every):
            end, size = start, 0
            while end < len(every) and (end == start or size + len(sets[every[end]]) <= at_once):
                size += len(sets[every[end]])
                end += 1
            some, level = np.array(every[start:end]), 0
            while len(some):
                sig, whose, again = _signed([sets[i] for i in some], instance, level, bands)
                out.append(sig)
                owner.append(some[whose])
                some, level = some[again], level + 1
            start = end
    return np.concatenate(out), np.concatenate(owner)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]) if len(keys) else np.zeros(1, int)


def _grouped(sig: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (sig, key), sorted; the least key of each one's group; whether it is that."""
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
    sig, key = sig[fresh], key[fresh]
    runs = _runs(sig)
    least = np.repeat(key[runs[:-1]], np.diff(runs)) if len(sig) else key
    return sig, key, least, key == least


_PART = pa.schema([("part", pa.int32()), ("sig", pa.binary()), ("at", pa.binary()), ("known", pa.binary()), ("tree", pa.binary()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("sketches", pa.list_(pa.binary()))])
_GROUP = "sig bigint, least bigint, key bigint, size int, sketch binary"
#: A signature is shipped as so many bits; its part of the shuffle is told apart by more. A chance agreement does no harm.
SHIPPED_BITS = 40


def _packed_chunk(sets: dict[int, np.ndarray], number: int, parts: int, bands: Bands):
    """A chunk's rows by part: its signatures, each with its class; groups within the chunk; its classes' sketches."""
    every = np.fromiter(sets, np.int64, len(sets))
    sig, owner = signatures(list(sets.values()), bands)
    sig, key, least, first = _grouped(sig, every[owner])
    full = lambda s: (((s % np.uint64(parts)) << np.uint64(SHIPPED_BITS)) | (s >> np.uint64(64 - SHIPPED_BITS))).view(np.int64)
    tree = np.stack([full(sig[~first]), least[~first], key[~first]])
    sig, key = sig[first], key[first]
    part = (sig % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    home = np.argsort(every % parts, kind="stable")
    homes = np.searchsorted((every % parts)[home], np.arange(parts + 1))
    for p in range(parts):
        own, classes = order[ends[p] : ends[p + 1]], every[home[homes[p] : homes[p + 1]]]
        inner = tree[:, (number + p) % parts :: parts]  # dealt out evenly, whatever the signature
        if not (len(own) or inner.shape[1] or len(classes)):
            continue
        known, at = np.unique(key[own], return_inverse=True)
        width = 2 if len(known) <= 1 << 16 else 4
        shipped = np.ascontiguousarray((sig[own] >> np.uint64(64 - SHIPPED_BITS)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : SHIPPED_BITS // 8])
        row = [p, shipped.tobytes(), at.astype(f"<u{width}").tobytes(), known.tobytes(), np.ascontiguousarray(inner).tobytes(), classes, [len(sets[c]) for c in classes.tolist()], [sketch(sets[c], bands) for c in classes.tolist()]]
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PART, strict=True)], schema=_PART)


def _meet(rows: pa.Table) -> pa.Table:
    """Groups of a part over all chunks, and each class that is at home there once."""
    part, sigs, keys = rows.column("part")[0].as_py(), [], []
    for sig, at, known in zip(*[rows.column(c).to_pylist() for c in ("sig", "at", "known")], strict=True):
        size = SHIPPED_BITS // 8
        wide = np.zeros((len(sig) // size, 8), np.uint8)
        wide[:, :size] = np.frombuffer(sig, np.uint8).reshape(-1, size)
        sigs.append(wide.view("<u8").ravel())
        known = np.frombuffer(known, np.int64)
        keys.append(known[np.frombuffer(at, "<u2" if len(known) <= 1 << 16 else "<u4")])
    sig, key, least, first = _grouped(np.concatenate(sigs), np.concatenate(keys))
    sig = (sig | (np.uint64(part) << np.uint64(SHIPPED_BITS))).view(np.int64)
    inner = [np.frombuffer(x, np.int64).reshape(3, -1) for x in rows.column("tree").to_pylist()]
    groups = np.concatenate([np.stack([sig[~first], least[~first], key[~first]]), *inner], axis=1)
    flat = lambda c: np.array([x for c_ in rows.column(c).to_pylist() for x in c_], np.int64)
    classes, place = np.unique(flat("keys"), return_index=True)
    sketches = [x for s in rows.column("sketches").to_pylist() for x in s]
    none, empty = pa.nulls(groups.shape[1], pa.int32()), pa.nulls(groups.shape[1], pa.binary())
    out = [pa.table({"sig": groups[0].copy(), "least": groups[1].copy(), "key": groups[2].copy(), "size": none, "sketch": empty})]
    gone = pa.nulls(len(classes), pa.int64())
    out.append(pa.table({"sig": gone, "least": gone, "key": classes, "size": pa.array(flat("sizes")[place], pa.int32()), "sketch": pa.array([sketches[i] for i in place.tolist()], pa.binary())}))
    give_back()
    return pa.concat_tables(out)


def candidate_groups(docs: DataFrame, n: int, bands: Bands, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(sig, least, key) of every group of several classes, each other member with a lesser one of its group, and
    (null, null, key, size, sketch) of every class. The rows of a group form a tree: members of a chunk hang on the
    chunk's least, these on the least of all."""
    parts = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(docs) // PART_BYTES)

    def run(batches):
        hashes, sets, size, number = _Hashes(), {}, 0, 0
        for b in small_batches(batches):
            for text in b.column("text").to_pylist():
                s = shingles(text, n, hashes)
                if len(s) and (k := class_key(s)) not in sets:
                    sets[k] = s
                    size += s.nbytes
            if size >= chunk_bytes:
                yield from _packed_chunk(sets, number, parts, bands)
                sets, size, number = {}, 0, number + 1
                give_back()
        if sets:
            yield from _packed_chunk(sets, number, parts, bands)
        sets = {}
        give_back()

    packed = docs.select("text").mapInArrow(run, "part int, sig binary, at binary, known binary, tree binary, keys array<bigint>, sizes array<int>, sketches array<binary>")
    return packed.groupBy("part").applyInArrow(_meet, _GROUP)


def distinct_members(groups: DataFrame) -> DataFrame:
    """(sig, key, members, least) of all members; of groups of the same classes, one is left."""
    tree = groups.where("sig IS NOT NULL")
    members = tree.select("sig", "key").union(tree.select("sig", F.col("least").alias("key"))).distinct()
    about = members.groupBy("sig").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("h"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("g"), F.min("key").alias("least"))
    one = about.groupBy("n", "h", "g").agg(F.min(F.struct("sig", "least")).alias("m")).select("m.sig", "n", "m.least")
    return members.join(one, "sig").select("sig", "key", F.col("n").alias("members"), "least")


def _stars(members: DataFrame, block_members: int) -> DataFrame:
    """Members with block, low and high: a group of one block meets as a whole; of a larger one, each block meets the
    group's least, which goes to all of them, so there are as many rows as members and blocks."""
    blocks = F.ceil(F.col("members") / block_members).cast("int")
    own = F.pmod(F.xxhash64("key", "sig"), blocks).cast("int")
    center, large = F.col("key") == F.col("least"), blocks > 1
    rows = members.withColumn("label", F.col("key")).withColumn("at", F.explode(F.when(center, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))))
    low, block = F.when(large, -1 - F.col("at")).otherwise(0), F.when(large & center, -1).otherwise(0)
    return rows.select("sig", "key", "label", block.alias("block"), low.alias("low"), F.lit(0).alias("high"))


def _rest(members: DataFrame, labels: DataFrame, block_members: int) -> DataFrame:
    """Members of groups of several components, with block, low and high.

    The members of a group's commonest component are dealt into blocks of their own, which meet the blocks of all
    others; these also meet each other.
    """
    named = labels.select(F.col("node").alias("_node"), "label")
    members = members.join(named, F.col("key") == F.col("_node"), "left").select("sig", "key", F.coalesce("label", "key").alias("label"))
    sizes = members.groupBy("sig", "label").agg(F.count("*").alias("n"))
    about = sizes.groupBy("sig").agg(F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("m")).where("all > m.n")
    blocks = lambda n: F.ceil(n / block_members).cast("int")
    about = about.select("sig", F.col("m.label").alias("common"), blocks(F.col("all") - F.col("m.n")).alias("others"), blocks(F.col("m.n")).alias("commons"))
    rows = members.join(about, "sig").withColumn("is_common", F.col("label") == F.col("common"))
    h = F.xxhash64("key", "sig")
    block = F.when(F.col("is_common"), F.col("others") + F.pmod(h, F.col("commons"))).otherwise(F.pmod(h, F.col("others"))).cast("int")
    last = F.col("others") + F.when(F.col("is_common"), 0).otherwise(F.col("commons")) - 1
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.select("sig", "key", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def _near(sketches: list[bytes], sizes: np.ndarray, num: int, den: int, rows: slice, columns: slice) -> np.ndarray:
    """Distances of sketches, rows by columns; -1 where sets can't be similar."""
    width = min(map(len, sketches)) // 8
    x = np.stack([np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, width), axis=0) for s in sketches])
    a, b, la, lb = x[rows], x[columns], sizes[rows], sizes[columns]
    most = (den - num) * (la[:, None] + lb[None, :]) // (den + num)
    out = np.empty(most.shape, np.int64)
    step = max(1, (4 << 20) // max(1, 8 * width * len(b)))
    for i in range(0, len(a), step):
        out[i : i + step] = np.bitwise_count(a[i : i + step, None, :] ^ b[None, :, :]).sum(axis=2)
    low, high = np.minimum(la[:, None], lb[None, :]), np.maximum(la[:, None], lb[None, :])
    return np.where((out <= most) & (den * low >= num * high), out, -1)


def near_pairs(members: DataFrame, classes: DataFrame, labels: DataFrame | None, num: int, den: int, nearest: bool, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Pairs of a group that sketches don't rule out, between different components: (a, b, d), d the sketches' distance.

    With nearest, each member's nearest of its group only, as (key, other, distance); else all, once for each group.
    Without labels every class is a component of its own, and large groups are stars.
    """
    rows = _stars(members, block_members) if labels is None else _rest(members, labels, block_members)
    rows = rows.join(classes.select(F.col("key").alias("_key"), "size", "sketch"), F.col("key") == F.col("_key")).drop("_key")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("d", pa.int64())])

    def compare(rows: pa.Table, low: int, high: int) -> pa.RecordBatch | None:
        key, label, size = (rows.column(c).to_numpy() for c in ("key", "label", "size"))
        if len(key) < 2 or (label == label[0]).all():
            return None
        split = int(np.searchsorted(rows.column("block").to_numpy(), high)) if low != high else 0
        first, second = (slice(0, split), slice(split, None)) if low != high else (slice(None), slice(None))
        if low != high and not 0 < split < len(key):
            return None
        d = _near(rows.column("sketch").to_pylist(), size.astype(np.int64), num, den, first, second)
        d[label[first][:, None] == label[second][None, :]] = -1
        if nearest:
            far = np.where(d < 0, np.iinfo(np.int64).max, d)
            i, j = np.arange(len(far)), far.argmin(axis=1)
            ok = d[i, j] >= 0
            a, b, at = key[first][i[ok]], key[second][j[ok]], d[i[ok], j[ok]]
            if low != high:
                j, i = np.arange(far.shape[1]), far.argmin(axis=0)
                ok = d[i, j] >= 0
                a, b, at = np.append(a, key[second][j[ok]]), np.append(b, key[first][i[ok]]), np.append(at, d[i[ok], j[ok]])
        else:
            i, j = np.nonzero(np.triu(d >= 0, 1) if low == high else d >= 0)
            a, b, at = key[first][i], key[second][j], d[i, j]
            a, b = np.minimum(a, b), np.maximum(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(at)], schema=schema) if len(a) else None

    def run(batches):
        held = None
        for batch in batches:
            one = pa.Table.from_batches([batch])
            held = one if held is None else pa.concat_tables([held, one])
            sig, low, high = (held.column(c).to_numpy() for c in ("sig", "low", "high"))
            starts = np.flatnonzero((sig[1:] != sig[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            if not len(starts):
                continue
            for a, b in zip([0, *starts[:-1].tolist()], starts.tolist(), strict=True):
                if (out := compare(held.slice(a, b - a), low[a], high[a])) is not None:
                    yield out
            held = held.slice(int(starts[-1]))
        if held is not None and held.num_rows and (out := compare(held, held.column("low")[0].as_py(), held.column("high")[0].as_py())) is not None:
            yield out

    together = rows.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sig", "low", "high")
    return together.sortWithinPartitions("sig", "low", "high", "block", "key").mapInArrow(run, "a bigint, b bigint, d bigint")


def _bloom(keys: DataFrame, most_blocks: int = MAX_BLOOM_BLOCKS) -> np.ndarray:
    """A blocked Bloom filter over a bigint column, of at most most_blocks * 64 bytes whatever the number of keys."""
    blocks = int(min(most_blocks, max(1, keys.count() * 12 // 512 + 1)))
    h = F.xxhash64("key")
    rows = keys.select(F.pmod(h, F.lit(blocks)).alias("block"), *[F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(key), {6 * i + 4}) & 63 as int))").alias(f"w{i}") for i in range(8)])
    out = np.zeros((blocks, 8), np.int64)
    for r in rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)]).toLocalIterator():
        out[r[0]] = r[1:]
    return out


def _xxhash64(x: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of bigints, seed 42."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda v, r: (v << np.uint64(r)) | (v >> np.uint64(64 - r))
    h = (np.uint64(42) + p5 + np.uint64(8)) ^ (turn(x.view(np.uint64) * p2, 31) * p1)
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def _holds(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    h = _xxhash64(keys)
    words = filter_[np.mod(h.view(np.int64), len(filter_))].view(np.uint64)
    return np.all([(words[:, i] >> ((h >> np.uint64(6 * i + 4)) & np.uint64(63))) & np.uint64(1) for i in range(8)], axis=0)


def classes_of(docs: DataFrame, n: int, wanted: DataFrame | None = None) -> DataFrame:
    """(doc_id, mark, n_shingles, key, features) for each row (doc_id, text, mark); key is null for the empty set.

    features, the set, stand once a task for the classes that a Bloom filter of wanted (key) lets pass.
    """
    held = docs.sparkSession.sparkContext.broadcast(_bloom(wanted)) if wanted is not None else None
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.int64()), ("features", pa.binary())])

    def run(batches):
        hashes, given = _Hashes(), set()
        for b in small_batches(batches):
            sets = [shingles(t, n, hashes) for t in b.column("text").to_pylist()]
            keys = [class_key(s) if len(s) else None for s in sets]
            features: list = [None] * len(sets)
            if held is not None:
                fresh = [i for i, k in enumerate(keys) if k is not None and k not in given]
                ok = _holds(held.value, np.array([keys[i] for i in fresh], np.int64)).tolist() if fresh else []
                if len(given) > 1_000_000:
                    given.clear()
                for i, yes in zip(fresh, ok, strict=True):
                    if yes and keys[i] not in given:
                        given.add(keys[i])
                        features[i] = sets[i].tobytes()
            yield made({"doc_id": b.column("doc_id"), "mark": b.column("mark"), "n_shingles": [len(s) for s in sets], "key": keys, "features": features}, schema)

    return docs.mapInArrow(run, "doc_id bigint, mark bigint, n_shingles bigint, key bigint, features binary")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v): those of the distinct pairs (a, b) whose sets are similar enough, exactly.

    b's set goes to a; a with very many partners is dealt out over salts, to each of which its own set goes too.
    """
    load = pairs.groupBy("a").count().select(F.col("a").alias("a0"), F.ceil(F.col("count") / MEMBERS_A_SALT).cast("int").alias("salts"))
    pairs = pairs.join(load, F.col("a") == F.col("a0")).select("a", "b", F.pmod(F.hash("b"), "salts").alias("salt"))
    theirs = pairs.join(sets, F.col("b") == F.col("key")).select("a", "salt", "b", "features")
    own = load.join(sets, F.col("a0") == F.col("key")).select(F.col("a0").alias("a"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("b"), "features")

    def run(batches):
        at, mine = None, None
        for batch in batches:
            a_out, b_out = [], []
            for a, salt, b, raw in zip(batch.column("a").to_pylist(), batch.column("salt").to_pylist(), batch.column("b").to_pylist(), batch.column("features"), strict=True):
                s = np.frombuffer(raw.as_buffer(), np.uint64)
                if b is None:
                    at, mine = (a, salt), s
                    continue
                if at != (a, salt):
                    raise RuntimeError("a set is missing")
                low, high = sorted((len(mine), len(s)))
                if den * low < num * high:
                    continue
                place = np.searchsorted(mine, s)
                place[place == len(mine)] = 0
                both = int(np.count_nonzero(mine[place] == s))
                if den * both >= num * (low + high - both):
                    a_out.append(a)
                    b_out.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["u", "v"])

    together = own.unionByName(theirs).repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "salt")
    return together.sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).mapInArrow(run, "u bigint, v bigint")


def _nearest(found: DataFrame) -> DataFrame:
    """Each class's nearest partner, as distinct pairs (a, b)."""
    best = found.groupBy("a").agg(F.min(F.struct("d", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labelled(docs: DataFrame, n: int, num: int, den: int, chunk_bytes: int, block_members: int) -> DataFrame:
    """(doc_id, mark, n_shingles, key, label) for each row (doc_id, text, mark); label is the class's component."""
    spark, bands = docs.sparkSession, Bands(num, den)
    groups = keep(candidate_groups(docs, n, bands, chunk_bytes), "groups")
    settle(spark)
    members = keep(distinct_members(groups), "members")
    found = None
    if not members.isEmpty():
        classes = groups.where("sig IS NULL").select("key", "size", "sketch")
        found = keep(near_pairs(members, classes, None, num, den, True, block_members), "near")
        large = members.where(F.col("members") > block_members).select("key")
        found = None if found.isEmpty() and large.isEmpty() else found
    if found is None:
        return classes_of(docs, n).select("doc_id", "mark", "n_shingles", "key", F.col("key").alias("label"))
    pairs = keep(_nearest(found), "pairs")
    # A member of a star that isn't like its least may still be like others.
    rows = keep(classes_of(docs, n, found.select(F.col("a").alias("key")).union(large).distinct()), "rows")
    sets = keep(rows.where("features IS NOT NULL").groupBy("key").agg(F.max("features").alias("features")), "sets")
    edges = keep(verified(pairs, sets, num, den), "edges")
    settle(spark)
    for nearest in (True, False):
        labels = keep(connected(edges), "labels")
        more = near_pairs(members, classes, labels, num, den, nearest, block_members)
        more = _nearest(more) if nearest else more.select("a", "b").distinct()
        more = keep(more.join(pairs, ["a", "b"], "left_anti"), "more")
        if more.isEmpty() and not nearest:
            break
        edges = keep(edges.union(verified(more, sets, num, den)), "edges")
        pairs = pairs.union(more)
        settle(spark)
    else:
        labels = keep(connected(edges), "labels")
    some = rows.select("doc_id", "mark", "n_shingles", "key")
    return some.join(labels.select("node", "label"), F.col("key") == F.col("node"), "left").select(*some.columns, F.coalesce("label", "key").alias("label"))


def link_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, chunk_bytes: int = CHUNK_BYTES, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """(doc_id, n_shingles, key, component_id) for each row of docs."""
    ship(docs.sparkSession)
    docs = pick(docs, {"doc_id": "bigint", "text": "string"}).withColumn("mark", F.lit(0).cast("bigint"))
    rows = keep(_labelled(docs, n, num, den, chunk_bytes, block_members), "labelled")
    least = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    # Components of one row need no join.
    several = least.where("n > 1").select(F.col("label").alias("l"), "component_id")
    joined = rows.join(several, F.col("label") == F.col("l"), "left")
    return joined.select("doc_id", "n_shingles", "key", F.when(F.col("l").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, chunk_bytes: int = CHUNK_BYTES, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Documents without near-duplicates: of each component the row with the least doc_id (null last); empty texts stay.

    Of rows of one doc_id that differ in text, that whose text has the least 64-bit hash stays; of repeated rows, one,
    with the least (lang, source, n_chars), nulls first.
    """
    ship(docs.sparkSession)
    docs = pick(docs, DOCUMENT)
    marked = docs.withColumn("mark", F.xxhash64("text"))
    rows = keep(_labelled(marked.select("doc_id", "text", "mark"), n, num, den, chunk_bytes, block_members), "labelled")
    full = rows.where("label IS NOT NULL")
    first = full.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("f"))
    chosen = first.select(F.coalesce("f.doc_id", F.lit(0)).alias("d"), F.col("f.none").alias("z"), F.col("f.mark").alias("m"))
    keyed = marked.select("*", F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("z"), F.col("mark").alias("m"), F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("full"))
    stay = keyed.where("full").join(chosen, ["d", "z", "m"])
    one = stay.withColumn("at", F.row_number().over(Window.partitionBy("d", "z", "m").orderBy("lang", "source", "n_chars"))).where("at = 1")
    return one.select(*DOCUMENT).unionByName(keyed.where("NOT full").select(*DOCUMENT))


def query(spark, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")
