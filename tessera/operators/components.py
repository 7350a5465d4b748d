"""Connected components by contraction, on DataFrames.

Edges are reduced to forests where they lie, a chunk at a time. Then each round hangs every node on the neighbour that
a hash of the round ranks least, itself included, and goes on with the edges between what they hang on. Ranks are drawn
anew, so a path shrinks by half or so a round whatever its ids, and a star in one round; edges never grow in number.
The last LAST_EDGES edges are finished in one task, so a small graph takes no rounds at all.

A node with very many edges would make one task of a join on nodes. Such hubs, at most MOST_HUBS by the way their
least degree is set, are looked up by broadcast instead; the others have fewer edges than that degree. Minima are
combined before their shuffle. At the end each node follows what it hung on, through joins whose rows with one label
Spark can split, since nothing but the join needs them together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.shared import keep

#: Nodes of more than max(HUB_EDGES, edges / MOST_HUBS) edges are hubs: at most 2 * MOST_HUBS, of 16 bytes each.
HUB_EDGES, MOST_HUBS = 64, 20_000
#: Edges that a task holds at once when it drops those within what it has linked already; edges that one task finishes.
FOREST_EDGES, LAST_EDGES = 1 << 20, 1 << 18


def _keep(df: DataFrame) -> DataFrame:
    return keep(df, "components")


def _looked_up(rows: DataFrame, at: str, stars: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """rows with column at replaced by what that node hangs on; nodes that aren't in stars stay as they are."""
    others = [c for c in rows.columns if c != at]
    pairs = stars.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
    if hubs is None:
        return rows.join(pairs, F.col(at) == F.col("_node"), "left").select(*others, F.coalesce("_to", at).alias(at)).select(*rows.columns)
    known = F.broadcast(hubs.select(F.col("node").alias("_hub"), F.col("to").alias("_at_hub")))
    marked = rows.join(known, F.col(at) == F.col("_hub"), "left")
    done = marked.where("_hub IS NOT NULL").select(*others, F.col("_at_hub").alias(at))
    rest = marked.where("_hub IS NULL").join(pairs, F.col(at) == F.col("_node"), "left").select(*others, F.coalesce("_to", at).alias(at))
    return done.select(*rows.columns).union(rest.select(*rows.columns))


def _least_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges (u, v), and the least node that each can reach among them."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)  # a node's label stands for all that carry it
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _numbers(column) -> np.ndarray:
    """Node ids as numbers or, where they are text, as objects; both sort."""
    return column.to_numpy(zero_copy_only=False)


def forests(edges: DataFrame, most: int = FOREST_EDGES) -> DataFrame:
    """(u, v) of edges with the same components, at most one for each node of a task's chunk: each hangs on the least that it
    reaches there. Drops what a chunk says more than once, before anything is shuffled."""
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches):
        held, n = [], 0

        def hung():
            u, v = (np.concatenate([_numbers(b.column(c)) for b in held]) for c in ("u", "v"))
            nodes, least = _least_of(u, v)
            apart = nodes != least
            return pa.RecordBatch.from_arrays([pa.array(nodes[apart], held[0].schema.field("u").type), pa.array(least[apart], held[0].schema.field("u").type)], names=["u", "v"])

        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= most:
                yield hung()
                held, n = [], 0
        if n:
            yield hung()

    return edges.select("u", "v").mapInArrow(run, f"u {kind}, v {kind}")


def connected(edges: DataFrame, most_rounds: int = 60, hub_edges: int = HUB_EDGES, last_edges: int = LAST_EDGES) -> DataFrame:
    """(node, label) of all nodes in edges (u, v): label is the least node that can be reached.

    Null ends and edges from a node to itself make no node; edges may repeat and have either direction.
    """
    plain = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = _keep(forests(plain).distinct())
    steps = []
    for k in range(most_rounds):
        count = now.count()
        if not count:
            break
        if count <= last_edges:  # few enough for one task, whatever the corpus
            hung = forests(now.coalesce(1), last_edges + 1).select(F.col("u").alias("node"), F.col("v").alias("to"))
            steps.append((_keep(hung.union(hung.select("to", "to").distinct())), None))
            break
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("r"), F.col(c).alias("to"))  # noqa: B023, E731
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        stars = both.groupBy("u").agg(F.min(rank("v")).alias("m"), F.count("*").alias("degree"))
        stars = _keep(stars.select(F.col("u").alias("node"), F.least(rank("u"), "m")["to"].alias("to"), "degree"))
        least = max(hub_edges, count // MOST_HUBS)
        hubs = stars.where(F.col("degree") > least) if count > hub_edges else None
        hubs = None if hubs is None or hubs.isEmpty() else hubs
        steps.append((stars, hubs))
        moved = _looked_up(_looked_up(now, "u", stars, hubs), "v", stars, hubs)
        now = _keep(moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    if not steps:
        return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    hangs = None
    for i, (stars, _) in enumerate(reversed(steps)):  # from the last and smallest, so that most lookups are broadcast
        one = stars.select("node", F.col("to").alias("label"))
        if hangs is not None:
            one = one.join(hangs.select(F.col("node").alias("_node"), F.col("label").alias("_to")), F.col("label") == F.col("_node"), "left").select("node", F.coalesce("_to", "label").alias("label"))
        hangs = _keep(one) if i % 4 == 3 else one
    hangs = _keep(hangs)
    return hangs.join(hangs.groupBy("label").agg(F.min("node").alias("least")), "label").select("node", F.col("least").alias("label"))


def components_by_key(rows: DataFrame) -> DataFrame:
    """(id, component) of rows (id, key): ids that share a key, directly or through others, share a component.

    Each key hangs its ids on the least of them, so a key with very many ids makes as many edges, not their square.
    """
    rows = rows.select("id", "key").distinct()
    least = rows.groupBy("key").agg(F.min("id").alias("first"))
    edges = rows.join(least, "key").where("id <> first").select(F.col("id").alias("u"), F.col("first").alias("v"))
    found = connected(edges)
    ids = rows.select("id").distinct()
    return ids.join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("label", "id").alias("component"))
