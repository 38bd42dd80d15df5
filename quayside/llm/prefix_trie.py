"""Conversation prefix trie: member intervals from a sparse table over sorted LCPs.

Every conversation becomes a row of 16-byte turn marks. The rows are sorted by
their marks over range partitions, so the members of any prefix lie side by
side. In each part a sparse table of range minima over the LCPs of neighbours
lets every candidate prefix (row, depth) binary-search its left and its right
extent independently of all others; no stack is kept. Range sums and minima
over the interval give the figures of a node.

Intervals that reach the edge of a part go on in the next one. A second sparse
table, over one minimum for each part, is searched in the same way for the part
in which such an interval starts; its pieces are added under that part and the
depth. What the driver holds is three integers for each part, at most MAX_PARTS.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from quayside.llm.text import WORD
from quayside.session import materialise

#: Conversations share the beginning of the first of so many ids; a hash gives its length, below the second.
FAMILY, HEADS = 20, 4
#: Bytes of a turn's mark (the first half of its SHA-256).
MARK = 16
#: Turns of a part, and parts at most: more turns make larger parts.
PART_TURNS, MAX_PARTS = 16_000, 50_000
#: Candidates searched at a time.
SLICE = 500_000

RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
PIECE = (
    "part int, depth int, n long, conv_id long, leaves long, shared long, before long, through long, branches long, "
    "n_ends long, ends string, ends_sha256 string, left_edge boolean, right_edge boolean, parent_left boolean, "
    "parent_right boolean, parent_conv_id long, first_key binary, last_key binary, inner_min int, last_len int"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, key (the marks of its rebuilt turns, joined) and words (of each turn's text).

    Texts are reduced to marks and word counts before anything moves. A
    conversation and the one it borrows from share the partition key, so both
    meet after one exchange.
    """
    c = conversations
    role, text = F.coalesce(c["role"].cast("string"), F.lit("")), F.coalesce(c["text"].cast("string"), F.lit(""))
    conv = c["conv_id"].cast("long")
    mark = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * MARK)
    own = c.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("family"), conv.alias("conv_id"), c["turn"].cast("long").alias("turn"),
        mark.alias("mark"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    whole = own.repartition("family").groupBy("family", "conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "mark", "words"))).alias("turns"))
    none = F.slice("turns", 1, 0)
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, HEADS - 1))).over(Window.partitionBy("family"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    rows = whole.withColumn("head", F.coalesce(head, none)).withColumn("h", h).select("conv_id", F.concat(
        F.slice("head", F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns"))
    return rows.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["mark"]), "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"))


def minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: entry i of level k is the least of the 2^k values from i on."""
    table = [values]
    while len(values) >> len(table):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def least(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least value from `left` to `right`, both included, for many ranges at once."""
    level = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.empty(len(left), table[0].dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][left[at]], table[k][right[at] - (1 << int(k)) + 1])
    return out


def reach_left(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Smallest l such that all values of l + 1 .. at are at least `depth`, by binary search."""
    pos = at.copy()
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        can = pos >= step
        ok = can & (table[k][np.where(can, pos - step + 1, 0)] >= depth)
        pos = np.where(ok, pos - step, pos)
    return pos


def reach_right(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Largest r such that all values of at + 1 .. r are at least `depth`, by binary search."""
    pos, last = at.copy(), len(table[0]) - 1
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        can = pos + step <= last
        ok = can & (table[k][np.where(can, pos + 1, 0)] >= depth)
        pos = np.where(ok, pos + step, pos)
    return pos


def ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of the given sizes: the row and the place in it of every cell."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def common(marks: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Turns that each row has in common with the row before it; -1 for the first."""
    m = np.minimum(size[1:], size[:-1])
    row, place = ragged(m)
    unlike = np.flatnonzero((marks[start[row + 1] + place] != marks[start[row] + place]).any(axis=1))
    first, at = np.unique(row[unlike], return_index=True)
    m = m.copy()
    m[first] = place[unlike[at]]
    return np.concatenate([[-1], m])


def between(codes: np.ndarray, n: int, value: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many rows after `left` up to `right` have `value`; `codes` are sorted value * n + row."""
    return np.searchsorted(codes, value * n + right, "right") - np.searchsorted(codes, value * n + left, "right")


class Part:
    """Sorted neighbours of one range partition, with the sparse tables over them."""

    def __init__(self, conv: np.ndarray, keys: pa.BinaryArray, words: pa.ListArray):
        self.n = n = len(conv)
        self.conv = conv
        offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + n + 1].astype(np.int64)
        data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        self.size = np.diff(offsets) // MARK
        self.start = (offsets[:-1] - offsets[0]) // MARK
        self.lcp = common(np.frombuffer(data.tobytes(), np.uint64).reshape(-1, MARK // 8), self.start, self.size)
        self.words = np.concatenate([[0], np.cumsum(words.flatten().to_numpy(zero_copy_only=False).astype(np.int64))])
        self.lcps, self.convs = minima(self.lcp), minima(conv)
        rows = np.arange(n)
        shared = self.upto(rows, np.maximum(self.lcp, 0))
        self.shared = np.cumsum(shared)
        # rows that nothing extends; the last one is judged once the next part is known
        self.leaves = np.concatenate([[0], np.cumsum(self.lcp[1:] < self.size[:-1])])
        self.lcp_codes = np.sort(self.lcp * n + rows)
        self.size_codes = np.sort(self.size * n + rows)

    def upto(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Words of the first `depth` turns of `row`."""
        return self.words[self.start[row] + depth] - self.words[self.start[row]]

    def slices(self) -> Iterator[np.ndarray]:
        group = np.cumsum(self.size + 1) // SLICE
        for g in np.unique(group):
            yield np.flatnonzero(group == g)

    def pieces(self, part: int) -> Iterator[pd.DataFrame]:
        """One row for each unlike prefix in the part: its interval's figures."""
        last = self.n - 1
        for rows in self.slices():
            at, depth = ragged(self.size[rows] + 1)
            at = rows[at]
            left, right = reach_left(self.lcps, at, depth), reach_right(self.lcps, at, depth)
            own = left == at  # every member searched the same interval; the first one reports it
            left, right, depth = left[own], right[own], depth[own]
            up = np.maximum(depth - 1, 0)
            p_left, p_right = reach_left(self.lcps, left, up), reach_right(self.lcps, left, up)
            n_ends = between(self.size_codes, self.n, depth, left - 1, right)
            left_edge, right_edge = left == 0, right == last
            ends, digests = [], []
            for l, e, edge in zip(left.tolist(), n_ends.tolist(), (left_edge | right_edge).tolist()):
                ids = ",".join(map(str, self.conv[l:l + e].tolist())) if e else ""
                ends.append(ids if edge else None)
                digests.append(None if edge else hashlib.sha256(ids.encode()).hexdigest() if e else NO_ENDS)
            yield pd.DataFrame({
                "part": np.int32(part), "depth": depth.astype(np.int32), "n": right - left + 1,
                "conv_id": least(self.convs, left, right), "leaves": self.leaves[right + (right < last)] - self.leaves[left],
                "shared": self.shared[right] - self.shared[left], "before": self.upto(left, up), "through": self.upto(left, depth),
                "branches": between(self.lcp_codes, self.n, depth, left, right), "n_ends": n_ends, "ends": ends,
                "ends_sha256": digests, "left_edge": left_edge, "right_edge": right_edge,
                "parent_left": p_left == 0, "parent_right": p_right == last, "parent_conv_id": least(self.convs, p_left, p_right),
            })


def part_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of one sorted partition, then one row of depth -1 with its edges."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    keys, words = (table.column(c).chunk(0) for c in ("key", "words"))
    number = TaskContext.get().partitionId()
    part = Part(table.column("conv_id").to_numpy().astype(np.int64), keys, words)
    edge = pd.DataFrame({
        "part": [number], "depth": [-1], "first_key": [keys[0].as_py()], "last_key": [keys[part.n - 1].as_py()],
        "inner_min": [int(part.lcp[1:].min()) if part.n > 1 else 1 << 30], "last_len": [int(part.size[-1])]})
    for rows in [*part.pieces(number), edge]:
        yield pa.RecordBatch.from_arrays([
            pa.array(rows[f.name], f.type, from_pandas=True) if f.name in rows else pa.nulls(len(rows), f.type) for f in ARROW
        ], schema=ARROW)


def _arrow() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in PIECE.split(", "))])


ARROW = _arrow()


def _same_turns(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in pairs:
        out = []
        for a, b in zip(rows["last_key"], rows["first_key"]):
            m = min(len(a), len(b))
            unlike = np.flatnonzero(np.frombuffer(a[:m], np.uint8) != np.frombuffer(b[:m], np.uint8))
            out.append((int(unlike[0]) if len(unlike) else m) // MARK)
        yield pd.DataFrame({"part": rows["part"], "lcp": out})


class Edges:
    """What the driver knows of the parts: LCP with the part before, least LCP, length of the last row."""

    def __init__(self, pieces: DataFrame):
        spark = pieces.sparkSession
        edges = pieces.where("depth = -1")
        own = sorted(edges.select("part", "inner_min", "last_len").collect())
        self.parts = np.array([r.part for r in own])
        pairs = spark.createDataFrame(
            [(int(a), int(b)) for a, b in zip(self.parts[1:], self.parts[:-1])], "part int, prev int")
        met = (
            pairs.join(edges.select("part", "first_key"), "part")
            .join(edges.select(F.col("part").alias("prev"), "last_key"), "prev")
            .select("part", "first_key", "last_key").mapInPandas(_same_turns, "part int, lcp int"))
        lcp = {r.part: r.lcp for r in met.collect()} if len(own) > 1 else {}
        self.lcp = np.array([lcp.get(int(p), -1) for p in self.parts])
        self.least = np.minimum(self.lcp, [r.inner_min for r in own])
        after = [*self.lcp[1:].tolist(), -1]
        self.rows = spark.createDataFrame(
            [(int(p), k, int(a), int(b), b < r.last_len) for k, (p, a, b, r) in enumerate(zip(self.parts, self.lcp, after, own))],
            "part int, place int, lcp int, next_lcp int, last_is_leaf boolean")

    def start(self):
        """A column function: the part where the interval of `depth` that enters `place` from the left starts."""
        table = minima(self.least)

        def search(place: pd.Series, depth: pd.Series) -> pd.Series:
            before = place.to_numpy(np.int64) - 1
            # an interval goes on to the left while the whole part keeps the depth
            return pd.Series(reach_left(table, np.maximum(before, 0), depth.to_numpy(np.int64)))

        return F.pandas_udf(search, LongType())


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 over the pieces of each node, in order, one piece at a time."""
    key, state = None, None
    for rows in batches:
        out = []
        for start, depth, ids in zip(rows["start"], rows["depth"], rows["ends"]):
            if (start, depth) != key:
                if state:
                    out.append((*key, state.hexdigest()))
                key, state = (start, depth), hashlib.sha256(ids.encode())
            else:
                state.update(("," + ids).encode())
        yield pd.DataFrame(out, columns=["start", "depth", "ends_sha256"])
    if state:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["start", "depth", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Rows without a
    conv_id are left out; null roles and texts count as empty; turns with the
    same number (repeated rows too, which count each) are ordered by the
    SHA-256 of role and text; a conversation without turns is a member of the
    root only. Negative ids borrow from the next multiple of 20 towards 0. An
    empty table gives no rows, not even a root. Further columns are ignored.

    A conversation must fit a row as 16 bytes for each turn. SHA-256 can't be
    merged, so the ids of one node are hashed in order by one task, which holds
    one piece of them at a time.
    """
    spark = conversations.sparkSession
    rows = materialise(rebuilt(conversations), "trie-conversations")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("words") + 1).alias("cells")).first()
    if not total.n:
        return spark.createDataFrame([], RESULT)
    parts = max(1, min(MAX_PARTS, -(-total.cells // PART_TURNS)))
    ordered = rows.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = materialise(ordered.mapInArrow(part_pieces, PIECE), "trie-pieces")
    edges = Edges(pieces)
    start = edges.start()

    # at most MAX_PARTS rows of five small values
    own = pieces.where("depth >= 0").drop("first_key", "last_key", "inner_min", "last_len").join(F.broadcast(edges.rows), "part")
    into = F.col("left_edge") & (F.col("depth") <= F.col("lcp"))
    onward = F.col("right_edge") & (F.col("depth") <= F.col("next_lcp"))
    p_into = (F.col("depth") > 0) & F.col("parent_left") & (F.col("depth") - 1 <= F.col("lcp"))
    p_onward = (F.col("depth") > 0) & F.col("parent_right") & (F.col("depth") - 1 <= F.col("next_lcp"))
    own = own.withColumns({
        "into": into, "open": into | onward, "p_into": p_into, "p_open": p_into | p_onward,
        "leaves": F.col("leaves") + (F.col("right_edge") & F.col("last_is_leaf")).cast("long")})
    closed = own.where("NOT open").select(
        "place", "depth", "conv_id", F.col("n").alias("n_convs"), "branches", "n_ends", F.col("leaves").alias("n_leaves"),
        "shared", "before", F.coalesce("ends_sha256", F.sha2("ends", 256)).alias("ends_sha256"), "p_into", "p_open", "parent_conv_id")

    entered = Window.partitionBy("place")
    pieces_of = own.where("open").withColumn(
        "start", F.when(F.col("into"), start("place", "depth")).otherwise(F.col("place").cast("long"))
    ).withColumn("first_shared", F.max(F.when(F.col("into"), F.col("through"))).over(entered))
    pieces_of = materialise(pieces_of, "trie-open")
    ends = pieces_of.where("n_ends > 0").select("start", "depth", "place", "ends").repartition("start", "depth")
    ends = ends.sortWithinPartitions("start", "depth", "place").drop("place").mapInPandas(
        _digests, "start long, depth int, ends_sha256 string")
    nodes = pieces_of.groupBy("start", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.sum(F.col("branches") + (F.col("into") & (F.col("depth") == F.col("lcp"))).cast("long")).alias("branches"),
        F.sum("n_ends").alias("n_ends"), F.sum("leaves").alias("n_leaves"),
        F.sum(F.col("shared") + F.when(F.col("into"), F.col("first_shared")).otherwise(F.lit(0))).alias("shared"),
        F.max("before").alias("before"), F.max("place").alias("place"), F.max("p_into").alias("p_into"))
    nodes = nodes.join(ends, ["start", "depth"], "left").select(
        "place", "depth", "conv_id", "n_convs", "branches", "n_ends", "n_leaves", "shared", "before",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "start")
    nodes = materialise(nodes, "trie-nodes")
    # a parent that goes over an edge is looked up by the part of the child, so no key is hot
    parents = pieces_of.select("place", "into", "depth", "start").join(
        nodes.select("start", "depth", F.col("conv_id").alias("found")), ["start", "depth"]
    ).select("place", F.col("into").alias("p_into"), (F.col("depth") + 1).alias("depth"), "found")
    last_piece = pieces_of.select("place", "depth", "start", "p_into")
    open_nodes = nodes.join(last_piece, ["place", "depth", "start"]).select(
        "place", "depth", "conv_id", "n_convs", "branches", "n_ends", "n_leaves", "shared", "before", "ends_sha256", "p_into",
        (F.col("depth") > 0).alias("p_open"), F.lit(None).cast("long").alias("parent_conv_id"))
    every = closed.unionByName(open_nodes)
    found = every.where("p_open").join(parents, ["place", "p_into", "depth"]).withColumn("parent_conv_id", F.col("found")).drop("found")
    return every.where("NOT p_open").unionByName(found).select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        (F.col("branches") - F.greatest(F.col("n_ends") - 1, F.lit(0)) + (F.col("n_ends") == 0).cast("long")).alias("n_children"),
        "n_leaves", (F.col("shared") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"), "ends_sha256")
