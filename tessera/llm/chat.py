"""Chat formatting as a prefix tree: turns that conversations share from their start are emitted once, depth first.

A turn is written `### role: text</turn>` and a line end; backslashes and control strings inside roles and texts
are escaped, reversibly. Header, text and end are encoded apart, so the loss mask holds exactly the tokens of
assistant texts, and the vocabulary's special tokens in a text are ordinary text.

Distinct conversations are sorted by their paths, the chained hashes of their turns; in that order, what a
conversation doesn't share with the one before it are its new nodes, so a pass over each range partition emits
every node once, in preorder, with its first position id and the intervals of the layout that it attends to. What a
partition's first conversation shares with the partition before is folded in from one small row a partition.

The output is two tables: `nodes` (the layout) and `sequences` (for each distinct conversation, where its nodes
start). Conversations are read back from these alone.

Defined results: null text or role is empty; turns are ordered by turn (null first), then role, then text, and
repeated rows are turns of their own; rows with null conv_id are one conversation; an empty table gives no rows. A
conversation, like a document, has to fit in a row.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import vocabulary
from tessera.llm.common import cut, keep, made, pick, ship, small_batches, table
from tessera.llm.wordtable import decode, pack, unpack

ASSISTANT = "assistant"
HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
# Control strings and what stands for them; backslashes come first when escaping.
ESCAPES = (("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_ESCAPES = (*ESCAPES, (": ", "\\c"), ("\n", "\\n"))
_MARK = re.compile(r"\\(\\|h|t|c|n)")
_MEANS = {"\\": "\\", "h": "###", "t": "</turn>", "c": ": ", "n": "\n"}
_KEY = 16
#: The conversation that the query adds: its texts look like the template.
PROBE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def escape(text: str, rules=ESCAPES) -> str:
    for plain, safe in rules:
        text = text.replace(plain, safe)
    return text


def unescape(text: str) -> str:
    return _MARK.sub(lambda m: _MEANS[m[1]], text)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    return HEAD + escape(role, ROLE_ESCAPES) + MIDDLE, escape(text), END


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(HEAD).partition(MIDDLE)
        out.append((unescape(role), unescape(text)))
    return out


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    out.encode_special_tokens = True
    return out


def _path(turns: list[tuple[str, str]]) -> bytes:
    out, at = [], b""
    for role, text in turns:
        raw = role.encode()
        at = hashlib.blake2b(at + len(raw).to_bytes(8, "little") + raw + text.encode(), digest_size=_KEY).digest()
        out.append(at)
    return b"".join(out)


def _shared(a: bytes, b: bytes) -> int:
    """How many nodes two paths share from the start."""
    n = min(len(a), len(b)) // _KEY
    if a[: n * _KEY] == b[: n * _KEY]:
        return n
    low, high = 0, n
    while low < high:  # a chained hash agrees only if all before it do
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[(middle - 1) * _KEY : middle * _KEY] == b[(middle - 1) * _KEY : middle * _KEY] else (low, middle - 1)
    return low


def _join(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in intervals:
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


TURNS = "array<struct<role: string, text: string>>"
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_ROW = pa.schema(
    [("part", pa.int32()), ("path", pa.binary()), ("inherited", pa.int32()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("first_new", pa.int32()), ("positions", pa.list_(pa.int64()))]
    + [("packed", pa.list_(pa.binary())), ("loss_from", pa.list_(pa.int64())), ("loss_to", pa.list_(pa.int64()))]
)
_ROW_SQL = "part int, path binary, inherited int, starts array<bigint>, ends array<bigint>, first_new int, positions array<bigint>, packed array<binary>, loss_from array<bigint>, loss_to array<bigint>"


def format_tree(conversations: DataFrame, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, sequences, members): the layout, each distinct conversation's nodes, and each conversation's leaf.

    nodes: leaf key of the node, start and n_tokens in the layout, position (of its first token), packed ids,
    loss_from and loss_to (tokens of the node under the loss mask), attends (intervals of its ancestors).
    sequences: leaf, starts. members: conv_id, leaf.
    """
    spark = conversations.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pick(conversations, {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}).fillna({"role": "", "text": ""})
    whole = rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"))

    def paths(batches):
        for b in small_batches(batches):
            found = [_path([(t["role"], t["text"]) for t in turns]) for turns in b.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array([p[-_KEY:] for p in found], pa.binary()), pa.array(found, pa.binary()), b.column("turns").cast(_TURNS)], names=["conv_id", "leaf", "path", "turns"])

    keyed = keep(whole.mapInArrow(paths, f"conv_id bigint, leaf binary, path binary, turns {TURNS}"), "conversations")
    distinct = keyed.groupBy("leaf").agg(F.first("path").alias("path"), F.first("turns").alias("turns"))
    ordered = cut(distinct.select("path", "turns").repartitionByRange(parts, "path").sortWithinPartitions("path"))

    def ends(batches):
        from pyspark import TaskContext

        last = None
        for b in batches:
            last = b.column("path")[-1].as_py() if b.num_rows else last
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "last": last}])

    before, last = {}, b""
    for r in sorted(ordered.select("path").mapInArrow(ends, "part bigint, last binary").collect()):
        before[r.part], last = last, bytes(r.last)

    def emit(batches):
        from pyspark import TaskContext

        part, model = TaskContext.get().partitionId(), _tokenizer(path)
        prev, offset, inherited = before.get(part, b""), 0, None
        stack: list[list[int]] = []  # start, end, tokens before, for each node of the path before; start -1: another partition's
        for b in small_batches(batches, 256):
            todo = []
            for p, turns in zip(b.column("path").to_pylist(), b.column("turns").to_pylist(), strict=True):
                n = _shared(prev, p)
                todo.append((p, turns, n))
                prev = p
            texts = []
            for i, (_, turns, n) in enumerate(todo):
                for t in turns[0 if inherited is None and i == 0 else n :]:
                    texts += format_turn(t["role"], t["text"])
            codes = iter([e.ids for e in model.encode_batch(texts, add_special_tokens=False)])
            out = []
            for p, turns, n in todo:
                if inherited is None:
                    inherited = n
                    for _ in range(n):  # counted again, not emitted again
                        size = sum(len(next(codes)) for _ in range(3))
                        at = stack[-1][2] + stack[-1][3] if stack else 0
                        stack.append([-1, -1, at, size])
                del stack[n:]
                inherited = min(inherited, n)
                packed, low, high = [], [], []
                for t in turns[n:]:
                    head, body, tail = (next(codes) for _ in range(3))
                    size = len(head) + len(body) + len(tail)
                    at = stack[-1][2] + stack[-1][3] if stack else 0
                    stack.append([offset, offset + size, at, size])
                    offset += size
                    packed.append(pack(np.array(head + body + tail, np.uint32)))
                    mine = t["role"] == ASSISTANT
                    low.append(len(head) if mine else 0)
                    high.append(len(head) + len(body) if mine else 0)
                own = stack[inherited:]
                out.append((part, p, inherited, [s[0] for s in own], [s[1] for s in own], n, [s[2] for s in stack[n:]], packed, low, high))
            yield made(dict(zip(_ROW.names, zip(*out, strict=True), strict=True)), _ROW)

    local = keep(ordered.mapInArrow(emit, _ROW_SQL), "tree")
    # One row a partition: how many tokens it emitted, and the nodes of its last path.
    tails = local.groupBy("part").agg(F.max(F.element_at("ends", -1)).alias("size"), F.max_by(F.struct("inherited", "starts", "ends"), "path").alias("last")).collect()
    base, carried, chain, total = {}, {}, [], 0
    for r in sorted(tails):
        base[r.part], carried[r.part] = total, list(chain)
        chain = [*chain[: r.last.inherited], *[(total + a, total + z) for a, z in zip(r.last.starts, r.last.ends, strict=True)]]
        total += r.size or 0

    nodes_schema = pa.schema([("node", pa.binary()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("position", pa.int64()), ("packed", pa.binary()), ("loss_from", pa.int64()), ("loss_to", pa.int64()), ("attends", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def chain_of(r: dict) -> list[tuple[int, int]]:
        at = base[r["part"]]
        return [*carried[r["part"]][: r["inherited"]], *[(at + a, at + z) for a, z in zip(r["starts"], r["ends"], strict=True)]]

    def finish_nodes(batches):
        for b in small_batches(batches, 256):
            out = []
            for r in b.to_pylist():
                whole_chain, above = chain_of(r), []
                for d, (a, z) in enumerate(whole_chain):
                    if d >= r["first_new"]:
                        i = d - r["first_new"]
                        out.append((r["path"][d * _KEY : (d + 1) * _KEY], a, z - a, r["positions"][i], r["packed"][i], r["loss_from"][i], r["loss_to"][i], [{"start": x, "end": y} for x, y in above]))
                    above = [*above[:-1], (above[-1][0], z)] if above and above[-1][1] == a else [*above, (a, z)]
            if out:
                yield made(dict(zip(nodes_schema.names, zip(*out, strict=True), strict=True)), nodes_schema)

    def finish_sequences(batches):
        for b in small_batches(batches, 1024):
            rows_ = b.to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([r["path"][-_KEY:] for r in rows_], pa.binary()), pa.array([[a for a, _ in chain_of(r)] for r in rows_], pa.list_(pa.int64()))], names=["leaf", "starts"])

    nodes = local.mapInArrow(finish_nodes, "node binary, start bigint, n_tokens bigint, position bigint, packed binary, loss_from bigint, loss_to bigint, attends array<struct<start: bigint, end: bigint>>")
    sequences = local.select("part", "path", "inherited", "starts", "ends").mapInArrow(finish_sequences, "leaf binary, starts array<bigint>")
    return nodes, sequences, keyed.select("conv_id", "leaf")


def read_back(nodes: DataFrame, sequences: DataFrame, members: DataFrame, path: str) -> DataFrame:
    """Digests of each conversation, from the layout."""
    spark = nodes.sparkSession
    schema = pa.schema([("leaf", pa.binary()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    wanted = sequences.select("leaf", F.posexplode("starts").alias("place", "at"))
    found = wanted.join(nodes.select("start", "packed", "loss_from", "loss_to"), F.col("at") == F.col("start")).select("leaf", "place", "packed", "loss_from", "loss_to")
    found = found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "leaf").sortWithinPartitions("leaf", "place")

    def digest(leaf: bytes, texts: list[str], losses: list[str]):
        formatted, loss = "".join(texts), "".join(losses)
        turns = parse(formatted)
        return leaf, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)

    def run(batches):
        at, texts, losses = None, [], []
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["leaf"] != at:
                    if at is not None:
                        out.append(digest(at, texts, losses))
                    at, texts, losses = r["leaf"], [], []
                ids = unpack(r["packed"])
                texts.append(decode(ids.tobytes(), path).decode())
                if r["loss_to"] > r["loss_from"]:
                    losses.append(unescape(decode(ids[r["loss_from"] : r["loss_to"]].tobytes(), path).decode()))
            if out:
                yield made(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)
        if at is not None:
            yield made(dict(zip(schema.names, ([x] for x in digest(at, texts, losses)), strict=True)), schema)

    read = found.mapInArrow(run, "leaf binary, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return members.join(read, "leaf").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def query(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or vocabulary("byte_bpe_50k.json")
    rows = pick(table(spark, sf_dir, "conversations"), {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"})
    rows = rows.union(spark.createDataFrame(PROBE, "conv_id bigint, turn bigint, role string, text string"))
    return read_back(*format_tree(rows, path), path)


SQL = r"""
WITH all_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
  SELECT *, 6 + 8
    + length(replace(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ': ', '\c'), chr(10), '\n'))
    + length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t')) AS size
  FROM all_rows
), joined AS (
  SELECT conv_id, count(*) AS n_turns, sum(size) AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM written GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""
