"""Approximate nearest neighbours by learned partitions.

On a bounded sample, a neighbour graph is cut into balanced parts (label propagation under a capacity), and a
softmax classifier learns to tell a vector's part. Every row is indexed in its most probable part; a query is routed
to its most probable parts, as many as reach TARGET_RECALL on the sample, and their rows are reranked by the exact
cosine. Parts are cut into blocks of bounded size by a hash, and a part's queries into chunks, so no task holds a
whole part, however many rows fall into one. Of equal vectors in a block only those with the smallest ids can be
among the nearest, so the others aren't scored.

The parts are learned for vectors of the commonest length. Those of each other length are a part of their own, which
their queries search whole.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite component takes no part, nor does a
null vec_id; a query's candidates are the vectors of its length; rows with the query's vec_id are the query's own; fewer
candidates than k give fewer rows; ties go to the smaller vec_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import keep, made, pick, ship, small_batches, table

#: Vectors that the parts are fitted on; neighbours in the graph; rows a block and queries a chunk at most, about.
SAMPLE_ROWS, NEIGHBOURS = 4096, 12
BLOCK_ROWS, CHUNK_QUERIES = 4096, 1024
#: Parts grow with the rows, a part for each ROWS_A_PART, between these bounds.
PARTS, MOST_PARTS, ROWS_A_PART, TARGET_RECALL = 64, 256, 1 << 16, 0.93


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def balanced_parts(x: np.ndarray, parts: int, neighbours: int = NEIGHBOURS, slack: float = 1.1, rounds: int = 20, seed: int = 3) -> np.ndarray:
    """A part for each unit vector: neighbours mostly together, no part over slack times its share."""
    n, draw = len(x), np.random.default_rng(seed)
    room = int(np.ceil(slack * n / parts))
    near = np.empty((n, min(neighbours, n - 1)), np.int64)
    for i in range(0, n, 1024):
        s = x[i : i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -2
        near[i : i + 1024] = np.argpartition(-s, near.shape[1] - 1, axis=1)[:, : near.shape[1]] if near.shape[1] else near[i : i + 1024]
    centres = x[draw.choice(n, parts, replace=False)]
    for _ in range(6):
        part = np.argmax(x @ centres.T, axis=1)
        centres = unit(np.stack([x[part == p].sum(axis=0) if (part == p).any() else x[draw.integers(n)] for p in range(parts)]) + 1e-12)
    # First by nearest centre with room, then by the votes of neighbours.
    likes, part, load = x @ centres.T, np.full(n, -1), np.zeros(parts, int)
    for i in np.argsort(-likes.max(axis=1), kind="stable"):
        p = next(p for p in np.argsort(-likes[i], kind="stable") if load[p] < room)
        part[i], load[p] = p, load[p] + 1
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), near.shape[1]), part[near].ravel()), 1)
        np.add.at(votes, (near.ravel(), np.repeat(part, near.shape[1])), 1)
        gain = votes.max(axis=1) - votes[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            p = int(np.argmax(votes[i]))
            if load[p] < room and p != part[i]:
                load[part[i]] -= 1
                load[p] += 1
                part[i] = p
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A softmax over unit vectors that gives each part's probability."""

    def __init__(self, x: np.ndarray, part: np.ndarray, parts: int, steps: int = 200, rate: float = 0.3):
        self.w = np.zeros((x.shape[1] + 1, parts))
        x, y = np.hstack([x, np.ones((len(x), 1))]), np.eye(parts)[part]
        mean, square = np.zeros_like(self.w), np.zeros_like(self.w)
        for i in range(1, steps + 1):
            g = x.T @ (y - self._soft(x @ self.w)) / len(x) - 1e-5 * self.w
            mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
            self.w += rate * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-9)

    @staticmethod
    def _soft(s: np.ndarray) -> np.ndarray:
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each unit vector, most probable first."""
        return np.argsort(-(x @ self.w[:-1] + self.w[-1]), axis=1, kind="stable")


def fit(x: np.ndarray, parts: int, k: int, target: float) -> tuple[Router, int]:
    """A router, and how many parts a query has to probe for the target recall on the sample."""
    x = unit(np.unique(x, axis=0))
    parts = max(1, min(parts, len(x) // 8))
    router = Router(x, balanced_parts(x, parts) if parts > 1 else np.zeros(len(x), int), parts)
    order = router.order(x)
    some = np.arange(0, len(x), max(1, len(x) // 512))
    s = x[some] @ x.T
    s[np.arange(len(some)), some] = -2
    near = np.argsort(-s, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    if not near.size:
        return router, parts
    place = np.array([[int(np.flatnonzero(order[q] == order[c, 0])[0]) for c in cs] for q, cs in zip(some, near, strict=True)])
    return router, next(m for m in range(1, parts + 1) if (place < m).mean() >= target or m == parts)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The cosine of rows of q with rows of c, pair by pair, each computed alike wherever it stands."""
    return (q * c).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((c * c).sum(axis=1)))


def nearest(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """Each query's k nearest in one block."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], np.ascontiguousarray(c[order])
    _, same = np.unique(c.view(np.dtype((np.void, c.dtype.itemsize * c.shape[1]))).ravel(), return_inverse=True)
    by = np.argsort(same.ravel(), kind="stable")
    s = same.ravel()[by]
    runs = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    place = np.arange(len(s)) - np.repeat(runs, np.diff(np.append(runs, len(s))))
    keep = np.sort(by[place <= k])  # k and one more of equal vectors, since one may be the query's own
    c_ids, c = c_ids[keep], c[keep]
    out, cu = [], unit(c)
    for i in range(0, len(q), 256):
        about = unit(q[i : i + 256]) @ cu.T
        about[q_ids[i : i + 256, None] == c_ids[None, :]] = -np.inf
        least = np.partition(about, -k, axis=1)[:, -k] if about.shape[1] > k else np.full(len(about), -2.0)
        rows, cols = np.nonzero(about >= np.maximum(least - 1e-9, -2.0)[:, None])
        exact = scores(q[i + rows], c[cols])
        best = np.lexsort((c_ids[cols], -exact, rows))
        rows, cols, exact = rows[best], cols[best], exact[best]
        starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, int)
        rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
        take = rank < k
        out += zip(q_ids[i + rows[take]].tolist(), c_ids[cols[take]].tolist(), exact[take].tolist(), strict=True)
    return out


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<f8").reshape(-1, dims)


def search(vectors: DataFrame, every: int = 50, k: int = 5, parts: int | None = None, target: float = TARGET_RECALL, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose vec_id is divisible by every."""
    spark = vectors.sparkSession
    ship(spark)
    v = pick(vectors, {"vec_id": "bigint", "embedding": "array<double>"})
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(fine)
    lengths = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if lengths is None:
        return none
    dims = lengths.n
    parts = parts or max(PARTS, min(MOST_PARTS, lengths["count"] // ROWS_A_PART))
    sample = v.where(F.size("embedding") == dims).orderBy(F.xxhash64("vec_id"), "vec_id").select("embedding").limit(sample_rows).collect()
    router, probes = fit(np.array([r.embedding for r in sample]), parts, k, target)
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary()), ("part", pa.int64()), ("probed", pa.list_(pa.int64()))])

    def assign(batches):
        for b in small_batches(batches, 4096):
            ids, lists = b.column("vec_id").to_numpy(zero_copy_only=False), b.column("embedding")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = np.array(lists.flatten().to_numpy(zero_copy_only=False), "<f8")
            ends = np.cumsum(sizes)
            # A part for each length but the commonest, numbered by it below zero.
            part, probed = -sizes.astype(np.int64), [[-int(n)] for n in sizes]
            usual = np.flatnonzero(sizes == dims)
            if len(usual):
                x = flat[(ends[usual] - dims)[:, None] + np.arange(dims)]
                order = router.order(unit(x))
                part[usual] = order[:, 0]
                for i, o in zip(usual.tolist(), order[:, :probes].tolist(), strict=True):
                    probed[i] = o
            yield made({"vec_id": ids, "vector": [flat[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], "part": part, "probed": [o if i % every == 0 else None for o, i in zip(probed, ids.tolist(), strict=True)]}, schema)

    indexed = keep(v.mapInArrow(assign, "vec_id bigint, vector binary, part bigint, probed array<bigint>"), "indexed")
    asking = indexed.where("probed is not null").select(F.col("vec_id").alias("query_id"), F.col("vector").alias("question"), F.explode("probed").alias("part"))
    # One row a part: how many blocks it has and how many chunks its queries make.
    counts = indexed.groupBy("part").count().select("part", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks"))
    asked = asking.groupBy("part").count().select("part", F.ceil(F.col("count") / chunk_queries).cast("int").alias("chunks"))
    plan = keep(counts.join(asked, "part"), "plan")  # a row for each part and length; broadcast where that is small
    rows = indexed.join(plan, "part").select("vec_id", "vector", "part", F.pmod(F.xxhash64("vec_id"), "blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1).cast("array<bigint>")).alias("chunk"))
    asking = asking.join(plan, "part").select("query_id", "question", F.col("part").alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1).cast("array<bigint>")).alias("block"), F.pmod(F.xxhash64("query_id"), "chunks").alias("chunk"))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def meet(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and queries.num_rows:
            dims = len(queries.column("question")[0].as_py()) // 8
            found = nearest(queries.column("query_id").to_numpy(), _matrix(queries.column("question"), dims), candidates.column("vec_id").to_numpy(), _matrix(candidates.column("vector"), dims), k)
        return pa.table(dict(zip(out.names, zip(*found, strict=True), strict=True)) if found else {f.name: [] for f in out}, schema=out)

    keys = ["part", "block", "chunk"]
    asking = asking.toDF("query_id", "question", "q_part", "q_block", "q_chunk")
    found = rows.groupBy(*keys).cogroup(asking.groupBy("q_part", "q_block", "q_chunk")).applyInArrow(meet, "query_id bigint, vec_id bigint, score double").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
