"""The prefix trie of conversations: sorted turn arrays, common prefixes of neighbours, a stack sweep, stitched seams.

A turn is a key of 128 bits of its role and text, and a conversation the string of its turns' keys (its path). Paths are sorted over the
whole table by range partitions, so that a trie node is an interval of neighbours. Each partition sweeps once: what a
conversation doesn't share with the one before it leaves the stack, and a node that leaves is finished, unless its
interval goes on beyond the partition. Such open nodes are prefixes of a partition's first or last path; how long
they reach is known from the common prefixes at the seams, one number a partition. Their partial counts, a row for each
partition and open depth, are added up; all other nodes are written by the sweep itself, and take the key of a parent that
is open by a join with those few.

Copies of one conversation are told apart by conv_id in the sort, so a conversation that makes a third of all rows
is dealt to many tasks; only the hash of its members is made in one task, from strings of ids, a block at a time.

Defined results: null role or text is empty; turns with an equal number follow by role, then by their key, and
repeated rows are turns of their own; rows with null conv_id belong to no conversation; an empty table gives no rows,
not even a root. A conversation's keys (32 bytes a turn) have to fit in a row; its texts needn't.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, estimated_bytes, keep, pick, ship, table

_KEY = 16
#: Bytes of input for each range partition; a string of member ids ends after BLOCK_BYTES; finished nodes written at once.
PART_BYTES, BLOCK_BYTES, NODES_AT_ONCE = 128 << 20, 1 << 20, 16384
#: Turns borrowed from the conversation that ids are rebuilt on: fewer than MOST_BORROWED, from the first of each GROUP ids.
MOST_BORROWED, GROUP = 9, 5


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, keys, sizes): each conversation's turns in order, as keys (hex) and as bytes of their texts."""
    rows = pick(conversations, {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}).where("conv_id is not null").fillna({"role": "", "text": ""})
    key = F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256), 1, 2 * _KEY)
    one = rows.select("conv_id", F.struct("turn", "role", key.alias("key"), F.octet_length("text").cast("bigint").alias("size")).alias("t"))
    return one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv_id", F.col("t.key").alias("keys"), F.col("t.size").alias("sizes"))


def rebuild(turns: DataFrame) -> DataFrame:
    """Each conversation with its first h turns taken from the first conversation of its group of ids, h by a hash of its own id."""
    heads = turns.select(F.col("conv_id").alias("head_id"), *[F.slice(c, 1, MOST_BORROWED - 1).alias(f"head_{c}") for c in ("keys", "sizes")])
    own = turns.withColumns({"head_id": F.col("conv_id") - F.col("conv_id") % GROUP, "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_BORROWED).cast("int")})
    both = own.join(heads, "head_id", "left")
    none = {"keys": "array<string>", "sizes": "array<bigint>"}
    made = {c: F.concat(F.slice(F.coalesce(f"head_{c}", F.array().cast(kind)), F.lit(1), F.col("h")), F.slice(c, F.col("h") + 1, F.size(c))) for c, kind in none.items()}
    return both.select("conv_id", *[x.alias(c) for c, x in made.items()])


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    n = min(len(a), len(b)) // _KEY
    if a[: n * _KEY] == b[: n * _KEY]:
        return n
    x, y = np.frombuffer(a, np.uint8, n * _KEY), np.frombuffer(b, np.uint8, n * _KEY)
    return int(np.argmax(x != y)) // _KEY


class Seams:
    """What neighbouring partitions share, for each partition that has rows.

    shared: the common prefix of its first path with the path before it, -1 for the first partition; through: the
    common prefix of its first and its last path.
    """

    def __init__(self, shared: dict[int, int], through: dict[int, int]):
        order = sorted(shared)
        self.shared, self.through = shared, through
        self.before, self.after = dict(zip(order[1:], order, strict=False)), dict(zip(order, order[1:], strict=False))

    def right(self, part: int) -> int:
        return self.shared[self.after[part]] if part in self.after else -1

    def of_first(self, part: int, depth: int) -> int:
        """The partition in which the node of this depth on part's first path begins."""
        while depth <= self.shared[part]:
            part = self.before[part]
            if depth > self.through[part]:
                break
        return part

    def of_last(self, part: int, depth: int) -> int:
        """The same for part's last path."""
        return part if depth > self.through[part] else self.of_first(part, depth)


def _seams(ordered: DataFrame) -> Seams:
    def ends(batches):
        from pyspark import TaskContext

        first = last = None
        for b in batches:
            if b.num_rows:
                first = first if first is not None else b.column("path")[0].as_py()
                last = b.column("path")[-1].as_py()
        if first is not None:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "first": first, "last": last}])

    shared, through, before = {}, {}, None
    for r in sorted(ordered.select("path").mapInArrow(ends, "part bigint, first binary, last binary").collect()):
        first, last = bytes(r.first), bytes(r.last)
        shared[r.part], through[r.part] = -1 if before is None else _shared(before, first), _shared(first, last)
        before = last
    return Seams(shared, through)


_DONE = np.dtype([("serial", "<i8"), ("parent", "<i8"), ("depth", "<i4"), ("conv_id", "<i8"), ("n_convs", "<i8"), ("n_children", "<i8"), ("n_leaves", "<i8"), ("saved", "<i8"), ("hash", "V32")])
#: kind 0: a finished node; its parent's conv_id, or where its parent begins if that is open. kind 1: an open node's part
#: in one partition, counting what hangs on it without another open node between. kind 2: a block of an open node's member ids.
_SWEPT = pa.schema([
    ("kind", pa.int8()), ("start", pa.int32()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("size", pa.int64()), ("ends", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()),
])
_SWEPT_SQL = "kind tinyint, start int, depth int, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, size bigint, ends string, part int, block int, ids binary"


class _Node:
    __slots__ = ("serial", "size", "first", "n", "least", "children", "leaves", "saved", "hash", "ids", "held", "blocks")

    def __init__(self, serial: int, size: int, first: bool):
        self.serial, self.size, self.first = serial, size, first
        self.n = self.children = self.leaves = self.saved = self.held = self.blocks = 0
        self.least = self.hash = None
        self.ids: list[bytes] = []


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in _SWEPT], schema=_SWEPT)


class _Sweep:
    """One partition's pass over its sorted conversations."""

    def __init__(self, part: int, seams: Seams, spool):
        self.part, self.seams, self.spool = part, seams, spool
        self.left, self.right = seams.shared[part], seams.right(part)
        self.stack: list[_Node] = []
        self.prev: bytes | None = None
        self.conv_of, self.done, self.open_serials, self.out = array("q"), [], {}, []

    def _push(self, size: int, first: bool) -> None:
        self.stack.append(_Node(len(self.conv_of), size, first))
        self.conv_of.append(0)

    def _start(self, node: _Node, depth: int) -> int:
        return self.seams.of_first(self.part, depth) if node.first else self.part

    def _block(self, node: _Node, depth: int) -> None:
        if node.ids:
            self.out.append(_rows(kind=[2], start=[self._start(node, depth)], depth=[depth], part=[self.part], block=[node.blocks], ids=[b",".join(node.ids)]))
            node.blocks, node.held, node.ids = node.blocks + 1, 0, []

    def _pop(self, ended: bool) -> None:
        """ended: no conversation of this partition follows."""
        depth, node = len(self.stack) - 1, self.stack.pop()
        above = self.stack[-1] if self.stack else None
        goes_on = (node.first and depth <= self.left) or (ended and depth <= self.right)
        if above:
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
        if goes_on:
            start = self._start(node, depth)
            self.open_serials[node.serial] = start
            self._block(node, depth)
            self.out.append(_rows(kind=[1], start=[start], depth=[depth], conv_id=[node.least], n_convs=[node.n], n_children=[node.children], n_leaves=[node.leaves], saved=[node.saved], size=[node.size]))
            return
        if node.ids:
            node.hash = hashlib.sha256(b",".join(node.ids)) if node.hash is None else node.hash
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.size
        if above:
            above.children += 1
            above.leaves += leaves
            above.saved += saved
        self.conv_of[node.serial] = node.least
        self.done.append((node.serial, above.serial if above else -1, depth, node.least, node.n, node.children, leaves, saved, (node.hash or hashlib.sha256()).digest()))
        if len(self.done) >= NODES_AT_ONCE:
            self.flush()

    def flush(self) -> None:
        self.spool.write(np.array(self.done, _DONE).tobytes())
        self.done = []

    def add(self, path: bytes, conv_id: int, sizes: list[int]) -> None:
        first = self.prev is None
        if first:
            self._push(0, True)
        shared = 0 if first else _shared(self.prev, path)
        while len(self.stack) > shared + 1:
            self._pop(False)
        for size in sizes[shared:]:
            self._push(size, first)
        node, depth, raw = self.stack[-1], len(self.stack) - 1, b"%d" % conv_id
        node.n += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        if (node.first and depth <= self.left) or depth <= self.right or node.hash is None and not node.ids:
            node.ids.append(raw)  # perhaps open, or the only member
            node.held += len(raw) + 1
            if node.held >= BLOCK_BYTES and node.first and depth <= self.left:
                self._block(node, depth)
        else:
            if node.hash is None:
                node.hash, node.ids = hashlib.sha256(b",".join(node.ids)), []
            node.hash.update(b"," + raw)
        self.prev = path

    def end(self) -> None:
        while self.stack:
            self._pop(True)
        self.flush()

    def finished(self):
        """Finished nodes, with their parents' keys."""
        self.spool.seek(0)
        conv_of = np.frombuffer(self.conv_of, np.int64)
        opened = np.array(sorted(self.open_serials), np.int64)
        starts = np.array([self.open_serials[s] for s in opened.tolist()], np.int64)
        while raw := self.spool.read(_DONE.itemsize * NODES_AT_ONCE):
            x = np.frombuffer(raw, _DONE)
            parent, n = x["parent"], len(x)
            at = np.minimum(np.searchsorted(opened, parent), max(0, len(opened) - 1))
            is_open = opened[at] == parent if len(opened) else np.zeros(n, bool)
            start = starts[at] if len(opened) else np.zeros(n, np.int64)
            columns = {name: pa.array(x[name].astype(np.int64)) for name in ("conv_id", "n_convs", "n_children", "n_leaves", "saved")}
            columns |= {"kind": np.zeros(n, np.int8), "depth": x["depth"].astype(np.int32), "start": pa.array(start.astype(np.int32), mask=~is_open)}
            columns |= {"parent_conv_id": pa.array(conv_of[np.maximum(parent, 0)], mask=is_open | (parent < 0)), "ends": [h.tobytes().hex() for h in x["hash"]]}
            yield _rows(**columns)


def _resolve(parts: list, seams: Seams) -> list[dict]:
    """Open nodes, from their sums over partitions: what hangs on open nodes below is added from the deepest upwards."""
    nodes = {(r.start, r.depth): r.asDict() | {"parent": None} for r in parts}
    for start, depth in sorted(nodes, key=lambda k: -k[1]):
        node = nodes[start, depth]
        node["n_leaves"] = node["n_leaves"] or 1
        node["saved"] += (node["n_convs"] - 1) * node["size"]
        if depth:
            above = nodes[seams.of_last(start, depth - 1), depth - 1]
            node["parent"] = above["conv_id"]
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved"] += node["saved"]
    return list(nodes.values())


def build_trie(paths: DataFrame) -> DataFrame:
    """The nodes of (conv_id, keys, sizes), a row for each conversation: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = paths.sparkSession
    ship(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(paths) // PART_BYTES)
    packed = paths.select(F.unhex(F.array_join("keys", "")).alias("path"), "conv_id", "sizes")
    ordered = cut(packed.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id"))
    seams = _seams(ordered)

    def sweep(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        if part not in seams.shared:
            return
        with tempfile.TemporaryFile() as spool:
            pass_ = _Sweep(part, seams, spool)
            for b in batches:
                for path, conv_id, sizes in zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist(), b.column("sizes").to_pylist(), strict=True):
                    pass_.add(path, conv_id, sizes)
                yield from pass_.out
                pass_.out = []
            pass_.end()
            yield from pass_.out
            yield from pass_.finished()

    swept = keep(ordered.mapInArrow(sweep, _SWEPT_SQL), "trie")
    sums = {"n_convs": F.sum, "n_children": F.sum, "n_leaves": F.sum, "saved": F.sum, "conv_id": F.min, "size": F.max}
    opened = _resolve(swept.where("kind = 1").groupBy("start", "depth").agg(*[f(c).alias(c) for c, f in sums.items()]).collect(), seams)

    def hashes(batches):
        at, hashed = None, None
        for b in batches:
            for start, depth, ids in zip(b.column("start").to_pylist(), b.column("depth").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if (start, depth) == at:
                    hashed.update(b"," + ids)
                else:
                    if at:
                        yield pa.RecordBatch.from_pylist([{"start": at[0], "depth": at[1], "ends": hashed.hexdigest()}], schema=hash_schema)
                    at, hashed = (start, depth), hashlib.sha256(ids)
        if at:
            yield pa.RecordBatch.from_pylist([{"start": at[0], "depth": at[1], "ends": hashed.hexdigest()}], schema=hash_schema)

    hash_schema = pa.schema([("start", pa.int32()), ("depth", pa.int32()), ("ends", pa.string())])
    blocks = swept.where("kind = 2").select("start", "depth", "part", "block", "ids").repartition(parts, "start", "depth").sortWithinPartitions("start", "depth", "part", "block")
    ends = blocks.mapInArrow(hashes, "start int, depth int, ends string")
    some = spark.createDataFrame(
        [(o["start"], o["depth"], o["conv_id"], o["parent"], o["n_convs"], o["n_children"], o["n_leaves"], o["saved"]) for o in opened],
        "start int, depth int, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint",
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    whole = some.join(ends, ["start", "depth"], "left").withColumn("ends", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)))
    above = some.select(F.col("start").alias("a"), (F.col("depth") + 1).alias("b"), F.col("conv_id").alias("above"))
    done = swept.where("kind = 0").join(F.broadcast(above), (F.col("start") == F.col("a")) & (F.col("depth") == F.col("b")), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    every = done.select(*columns).union(whole.select(*columns))
    return every.select("conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return build_trie(rebuild(keep(turns_of(table(spark, sf_dir, "conversations")), "turns")))


SQL = r"""
WITH turns AS (
  SELECT conv_id, list(struct_pack(key := strlen(role) || ':' || role || text, size := strlen(text)) ORDER BY turn NULLS FIRST, role, substr(sha256(strlen(role) || ':' || role || text), 1, 32)) AS t
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
), crc AS (
  SELECT conv_id, t, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
    lambda a, x: list_reduce(list_prepend(xor(a, x), list_transform(range(8), lambda i: CAST(0 AS UBIGINT))), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS UBIGINT)) ELSE c // 2 END))) % 9 AS h
  FROM turns
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.t, c.t[1:0])[1:c.h], c.t[c.h + 1:]) AS t FROM crc c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
  SELECT conv_id, len(t) AS n, d AS depth, list_transform(t[1:d], lambda x: x.key) AS path, CASE WHEN d > 0 THEN t[d].size ELSE 0 END AS size
  FROM rebuilt, unnest(range(0, len(t) + 1)) AS u(d)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY path, depth
), children AS (
  SELECT p.path, p.depth, count(c.path) AS n_children FROM nodes p LEFT JOIN nodes c ON c.depth = p.depth + 1 AND c.path[1:p.depth] = p.path GROUP BY p.path, p.depth
), up AS (
  SELECT n.path[1:d] AS path, d AS depth, sum((n.n_convs - 1) * n.size) AS saved_tokens, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM nodes n JOIN children k ON k.path = n.path AND k.depth = n.depth, unnest(range(0, n.depth + 1)) AS u(d) GROUP BY 1, 2
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, k.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
  CAST(u.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN children k ON k.path = n.path AND k.depth = n.depth JOIN up u ON u.path = n.path AND u.depth = n.depth
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""
