"""N-gram Jaccard join with a token-group matrix.

Texts become sets of five-word shingles. Equal sets are one node. Similar
nodes are put into groups: sketches propose a pivot, the exact similarity with
it confirms. The matrix holds, for each token of a group's union, the group.
A node is a query against the groups it is not in: shared prefix tokens name
the groups that can qualify, the overlap of the query with the group's union
bounds every member's, and only groups that reach the least overlap are opened
and compared member by member, best member first, until the query is connected
with the group. Links inside a group need no comparing, as its members are
connected already.

Near copies that do not link would meet in pairs all the same. Each set has a
row of bits that tell whether an even or odd number of its tokens fall there;
the bits in which two sets differ bound their symmetric difference from below.
Where many sets share a token, that bound is part of the join's condition.

The join is exact: sketches only steer the grouping. Tokens are 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.session import BROADCAST_ROWS, materialise, small

SHINGLE = 5
#: Similarity of a link, as 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Token counts are gathered in so many buckets; they only decide which tokens come first in a prefix.
BUCKETS, SLICES = 1 << 22, 64
#: Least values of a sketch, and how many of them name a group's possible pivots.
SKETCH, PIVOTS = 32, 6
#: Least estimate for a pivot to be tried, and how many pivots a node tries at most before the exact search.
TRY, ROUNDS = 0.5, 3
#: Longs of 64 parity bits for each set, and rows of a token from which on they come along.
PARITY, CROWDED = 8, 32
#: Members of a group that a query is compared with before the group is opened, and members of an opened group that one task holds, about.
TRIED_MEMBERS, CHUNK = 1, 2000
#: Tokens of a group's union that one row holds, about.
UNION_PART = 4096

_RNG = np.random.default_rng(20)
_MIX = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SKETCH = _RNG.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None) -> np.ndarray:
    """Hashes of all runs of five words, repeats included; of the whole sequence where there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, and blanks as \\x20 \\x09-\\x0D
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    if n < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=n)], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    m = n - SHINGLE + 1
    s = h[:m] * _MIX[0]
    for k in range(1, SHINGLE):
        s += h[k:k + m] * _MIX[k]
    s ^= s >> np.uint64(33)
    s *= np.uint64(0xFF51AFD7ED558CCD)
    s ^= s >> np.uint64(29)
    return s


def token_set(text: str | None) -> np.ndarray:
    return np.unique(shingle_hashes(text))


def prefix_length(n: int) -> int:
    """Two sets that reach the similarity share one of so many first tokens, in any order common to both."""
    return n - -(-PERCENT * n // 100) + 1


def parity(tokens: np.ndarray) -> np.ndarray:
    """For each place, whether an odd number of the tokens falls there."""
    odd = np.bincount((tokens >> np.uint64(32)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def token_counts(docs: DataFrame) -> np.ndarray:
    """How often tokens fall in each bucket, over all documents. Tasks send one row per slice of the buckets."""
    width = BUCKETS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                at = (shingle_hashes(text.as_py()) & np.uint64(BUCKETS - 1)).astype(np.int64)
                if len(at) > BUCKETS // 16:
                    total += np.bincount(at, minlength=BUCKETS)
                else:
                    own, n = np.unique(at, return_counts=True)
                    total[own] += n
        parts = total.reshape(SLICES, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], ["slice", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for c in rows["counts"]:
            total += np.frombuffer(zlib.decompress(c), np.int64)
        return pd.DataFrame({"slice": rows["slice"][:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "slice int, counts binary"
    got = docs.select("text").mapInArrow(count, schema).groupBy("slice").applyInPandas(add, schema).collect()  # SLICES rows
    out = np.zeros((SLICES, width), np.int64)
    for r in got:
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out.reshape(-1)


def levels(counts: np.ndarray) -> np.ndarray:
    """Bucket counts as 0 to 255, by how far they stand above the mean."""
    mean = counts.mean()
    above = np.maximum(counts - mean, 0) / max(np.sqrt(mean), 1)
    return np.minimum(8 * np.log2(1 + above), 255).astype(np.uint8)


def _lists(values: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(v) for v in values])].astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind)))


def described(docs: DataFrame) -> DataFrame:
    """row, doc_id, key (digest of the set), n (its size), sketch, parity, prefix (least frequent tokens first), written."""
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    level = levels(token_counts(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, sketches, odd, prefixes = [], [], [], [], []
            for text in batch.column(2):
                s = token_set(text.as_py())
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                odd.append(parity(s))
                if not len(s):
                    sketches.append(np.zeros(0, np.int32))
                    prefixes.append(np.zeros(0, np.int64))
                    continue
                least = np.array([(s * m).min() for m in _SKETCH], np.uint64)
                sketches.append((least >> np.uint64(24)).astype(np.uint32).view(np.int32))
                order = np.lexsort((s, level[(s & np.uint64(BUCKETS - 1)).astype(np.int64)]))
                prefixes.append(s[order[:prefix_length(len(s))]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 _lists(sketches, np.int32), _lists(odd, np.int64), _lists(prefixes, np.int64)],
                ["row", "doc_id", "key", "n", "sketch", "parity", "prefix"])

    numbered = own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return materialise(numbered.mapInArrow(
        run, "row long, doc_id long, key binary, n long, sketch array<int>, parity array<long>, prefix array<long>"), "described")


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, tokens of the named nodes (node, doc_id, key), made again from their whole texts; written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [token_set(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 _lists([s.view(np.int64) for s in sets], np.int64)], ["key", "tokens"])

    wanted = materialise(nodes.select("node", F.col("doc_id").alias("__id"), "key"), "wanted")
    ids = wanted.select("__id").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    texts = texts.join(ids, texts["doc_id"].eqNullSafe(F.col("__id")), "left_semi").select("text")
    made = texts.mapInArrow(run, "key binary, tokens array<long>")
    return materialise(made.join(wanted.select("node", "key"), "key").dropDuplicates(["key", "node"]).select("node", "tokens"), "sets")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity exactly."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    got = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("both", both)
    return got.where(100 * F.col("both") >= PERCENT * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b")


def _sizes_fit(x: Column, y: Column) -> Column:
    return (100 * x >= PERCENT * y) & (100 * y >= PERCENT * x)


def odd_columns(rows: DataFrame, prefix: str) -> DataFrame:
    """The parity array as plain columns, which a join's condition compares in compiled code."""
    return rows.select(*[c for c in rows.columns if c != "parity"], *[F.get("parity", k).alias(f"{prefix}{k}") for k in range(PARITY)])


def unlike_bits(x: str, y: str) -> Column:
    """In how many places two sets differ: their symmetric difference has at least as many tokens."""
    return sum((F.bit_count(F.col(f"{x}{k}").bitwiseXOR(F.col(f"{y}{k}"))) for k in range(1, PARITY)),
               F.bit_count(F.col(f"{x}0").bitwiseXOR(F.col(f"{y}0"))))


def _differ_little(bits: Column, n: Column, m: Column) -> Column:
    """A link leaves room for so many tokens that are in one set only."""
    return (100 + PERCENT) * bits <= (100 - PERCENT) * (n + m)


def pivots(described_nodes: DataFrame) -> DataFrame:
    """node, pivot, tried (1 for the best): up to ROUNDS pivots of each node, by estimated similarity.

    Nodes that agree in one of the first least values share a bucket, whose
    pivot is one of them chosen by hash. A bucket sends one row per task to
    find its pivot, and its members meet that one row.
    """
    keyed = described_nodes.select("node", "n", F.posexplode(F.slice("sketch", 1, PIVOTS)).alias("r", "least"))
    chosen = keyed.groupBy("r", "least").agg(
        F.min(F.struct(F.xxhash64("node", "r").alias("h"), "node", "n")).alias("p"), F.count(F.lit(1)).alias("members"))
    chosen = materialise(chosen.where("members > 1").select("r", "least", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n")), "pivots")
    pairs = keyed.join(chosen, ["r", "least"]).where((F.col("node") != F.col("pivot")) & _sizes_fit(F.col("n"), F.col("pivot_n")))
    pairs = materialise(pairs.select("node", "pivot").distinct(), "tries")
    sketch = described_nodes.select("node", "sketch")
    theirs = sketch.select(F.col("node").alias("pivot"), F.col("sketch").alias("theirs"))
    same = F.aggregate(F.zip_with("sketch", "theirs", lambda x, y: (x == y).cast("int")), F.lit(0), lambda a, x: a + x)
    rated = pairs.join(sketch, "node").join(theirs, "pivot").select("node", "pivot", same.alias("same")).where(F.col("same") >= TRY * SKETCH)
    best = rated.groupBy("node").agg(F.sort_array(F.collect_list(F.struct((-F.col("same")).alias("worse"), "pivot"))).alias("p"))  # PIVOTS at most
    return materialise(best.select("node", F.posexplode(F.slice("p.pivot", 1, ROUNDS)).alias("tried", "pivot")), "rated")


def first_groups(docs: DataFrame, nodes: DataFrame, described_nodes: DataFrame) -> DataFrame:
    """Exact links (a, b) of nodes with pivots: the best pivot first, the next for those it does not take."""
    tries = pivots(described_nodes)
    named = tries.select("node").unionByName(tries.select(F.col("pivot").alias("node"))).distinct()
    sets = sets_of(docs, nodes.join(named, "node"))
    found = []
    for tried in range(ROUNDS):
        now = tries.where(F.col("tried") == tried)
        for links in found:
            now = now.join(links.select(F.col("a").alias("node")), "node", "left_anti")
        found.append(materialise(linked(now.select(F.col("node").alias("a"), F.col("pivot").alias("b")), sets), "links"))
    return reduce(DataFrame.unionByName, found)


def members_of(described_nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """token, node, n, at, root, size (of the group), parity bits x0 ...: the prefix tokens that nodes of two groups or more have; written.

    All steps share one exchange by token. The bits are there for tokens of
    CROWDED rows or more only, which are few and make most pairs; else null.
    """
    sized = groups.join(small(materialise(groups.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "sizes")), "root")
    rows = described_nodes.select("node", "n", F.posexplode("prefix").alias("at", "token"))
    rows = rows.select("token", "node", F.col("n").cast("int").alias("n"), "at").repartition("token")
    rows = rows.join(small(materialise(sized, "sized")), "node", "left").withColumns(
        {"root": F.coalesce("root", "node"), "size": F.coalesce("size", F.lit(1))})
    wide = rows.groupBy("token").agg(
        F.min("root").alias("a"), F.max("root").alias("b"), (F.count(F.lit(1)) >= CROWDED).alias("crowded")).where("a < b").drop("a", "b")
    met = materialise(rows.join(wide, "token"), "met")
    crowded = met.where("crowded").drop("crowded")
    bits = odd_columns(described_nodes.select("node", "parity"), "x")
    named = small(materialise(crowded.select("node").distinct(), "crowd"))
    crowded = materialise(crowded.join(bits.join(named, "node", "left_semi"), "node"), "crowded")
    none = {f"x{k}": F.lit(None).cast("long") for k in range(PARITY)}
    return met.where("NOT crowded").drop("crowded").withColumns(none).unionByName(crowded)


def overlaps(asked: DataFrame, tokens: DataFrame, union: DataFrame) -> DataFrame:
    """node, other, both: how many tokens of a node (node, tokens) the union of a group (other, token) holds, for the asked pairs.

    A union is laid out in rows of about UNION_PART tokens chosen by hash, and
    a pair meets each of them once. A group that many nodes ask is repeated, so
    that one task gets about CHUNK of them. A pair without a common token is missing.
    """
    pairs = materialise(asked.select("node", "other").distinct(), "asked")
    asks = pairs.groupBy("other").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("lots"))
    parts = union.groupBy("other").agg(F.ceil(F.count(F.lit(1)) / UNION_PART).cast("int").alias("parts"))
    spread = small(materialise(asks.join(parts, "other"), "spread"))
    theirs = union.join(spread, "other").groupBy(
        "other", "lots", F.pmod(F.xxhash64("token"), F.col("parts")).cast("int").alias("part")).agg(F.collect_list("token").alias("theirs"))
    theirs = theirs.select("other", "part", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), "theirs")
    mine = pairs.join(spread, "other").select(
        "node", "other", F.pmod(F.xxhash64("node"), F.col("lots")).cast("int").alias("lot"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = mine.join(tokens, "node").join(theirs, ["other", "part", "lot"])
    both = met.select("node", "other", F.size(F.array_intersect("tokens", "theirs")).cast("long").alias("both"))
    return both.groupBy("node", "other").agg(F.sum("both").alias("both")).where("both > 0")


def candidate_groups(member: DataFrame) -> DataFrame:
    """node, n, root, other, size (of other): the groups that may hold a link of a node, by the matrix of prefix tokens; written.

    A link is found from either side, so only members of the smaller group ask, at a tie those of the smaller number.
    """
    matrix = member.groupBy("token", "root", "size").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("at").alias("first"),
        *[F.max(F.when(F.col("size") == 1, F.col(f"x{k}"))).alias(f"y{k}") for k in range(PARITY)])
    odd = [f"y{k}" for k in range(PARITY)]
    other = matrix.select("token", F.col("root").alias("other"), F.col("size").alias("other_size"), "least", "most", "first", *odd)
    asks = F.struct("size", "root") < F.struct("other_size", "other")
    fit = (100 * F.col("most") >= PERCENT * F.col("n")) & (100 * F.col("n") >= PERCENT * F.col("least"))
    # the first token that two sets share stands early enough in both for the overlap that a link needs
    reach = (100 + PERCENT) * F.least(F.col("n") - F.col("at"), F.col("most") - F.col("first")) >= PERCENT * (F.col("n") + F.col("least"))
    # a group of one has bits of its own to compare with
    like = F.coalesce(_differ_little(unlike_bits("x", "y"), F.col("n"), F.col("least")), F.lit(True))
    near = member.join(other, "token").where(asks & fit & reach & like)
    # a member that links has its size between those of the tokens that let the group through
    near = near.groupBy("node", "n", "root", "other", F.col("other_size").alias("size")).agg(F.min("least").alias("least"), F.max("most").alias("most"))
    near = materialise(near, "near")
    # of two sets, the one whose prefix ends first has all its shared prefix tokens counted; the rest of it may be shared
    tokens = member.join(small(materialise(near.select("node").distinct(), "askers")), "node", "left_semi")
    tokens = tokens.groupBy("node").agg(F.collect_list("token").alias("tokens"))  # of one text
    wide = small(materialise(near.select("other").distinct(), "others"))
    union = materialise(matrix.select("token", F.col("root").alias("other")).join(wide, "other", "left_semi"), "union")
    seen = near.join(overlaps(near, tokens, union), ["node", "other"])
    behind = F.ceil(PERCENT * F.greatest("n", "most") / 100) - 1
    enough = (100 + PERCENT) * (F.col("both") + behind) >= PERCENT * (F.col("n") + F.col("least"))
    return materialise(seen.where(enough).select("node", "n", "root", "other", "size"), "wanted")


def apart(wanted: DataFrame, links: DataFrame) -> DataFrame:
    """The candidates whose two groups the links (a, b between groups) do not connect; written."""
    joined = components(links)
    mine = small(joined.select(F.col("node").alias("root"), F.col("root").alias("mine")))
    theirs = small(joined.select(F.col("node").alias("other"), F.col("root").alias("theirs")))
    got = wanted.join(mine, "root", "left").join(theirs, "other", "left")
    return materialise(got.where(F.coalesce("mine", "root") != F.coalesce("theirs", "other")).select(*wanted.columns), "apart")


def later_links(docs: DataFrame, nodes: DataFrame, member: DataFrame, bits: DataFrame) -> DataFrame:
    """Links between groups (a, b), enough to connect all groups that exact links between nodes connect; written."""
    wanted = candidate_groups(member)
    if wanted.isEmpty():
        return wanted.select(F.col("root").alias("a"), F.col("other").alias("b"))
    inside = member.select("node", F.col("root").alias("other")).distinct().join(wanted.select("other").distinct(), "other", "left_semi")
    inside = materialise(inside, "inside")
    named = wanted.select("node").unionByName(inside.select("node")).distinct()
    sets = sets_of(docs, nodes.join(named, "node"))

    def links_of(pairs: DataFrame) -> DataFrame:
        """Groups linked by pairs (node, root, b, other)."""
        pairs = materialise(pairs, "pairs")
        found = linked(pairs.select(F.col("node").alias("a"), "b").distinct(), sets)
        named = pairs.join(found.withColumnRenamed("a", "node"), ["node", "b"])
        return materialise(named.select(F.col("root").alias("a"), F.col("other").alias("b")).distinct(), "links")

    # A group is first tried by a few members, with one comparison a query, so that a large group of near copies
    # comes together without being opened. Then come groups of one, where the comparison is the bound.
    links: list[DataFrame] = []
    for k in range(TRIED_MEMBERS + 1):
        chosen = inside.groupBy("other").agg(F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node")).alias("m"))
        now = wanted.where("size > 1" if k < TRIED_MEMBERS else "size = 1")
        found = links_of(now.join(chosen.select("other", F.col("m.node").alias("b")), "other").select("node", "root", "b", "other"))
        links.append(found)
        if not found.isEmpty():
            wanted = apart(wanted, reduce(DataFrame.unionByName, links))
    wanted = wanted.where("size > 1")
    if wanted.isEmpty():
        return reduce(DataFrame.unionByName, links)
    # the query's overlap with the union of a group's tokens bounds the overlap with each member
    union = inside.join(wanted.select("other").distinct(), "other").join(sets, "node").select("other", F.explode("tokens").alias("token")).distinct()
    bound = wanted.join(overlaps(wanted, sets, materialise(union, "union")), ["node", "other"])
    opened = materialise(bound.where(100 * F.col("both") >= PERCENT * F.col("n")).select("node", "root", "other"), "opened")
    # opened groups: members of a like size that differ in few bits, a chunk of a large group at a time
    facts = member.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("root").alias("other")).distinct()
    facts = materialise(facts.join(opened.select("other").distinct(), "other", "left_semi"), "opened-members")
    chunks = facts.groupBy("other").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    theirs = facts.join(chunks, "other").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int")).drop("chunks")
    theirs = theirs.join(odd_columns(bits.withColumnRenamed("node", "b"), "y"), "b")
    mine = opened.join(member.select("node", "n").distinct(), "node").join(chunks, "other")
    mine = mine.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks").join(odd_columns(bits, "x"), "node")
    far = unlike_bits("x", "y")
    near = _sizes_fit(F.col("n"), F.col("b_n")) & _differ_little(far, F.col("n"), F.col("b_n"))
    pairs = materialise(mine.join(theirs, ["other", "chunk"]).where(near).select("node", "root", "b", "other", far.alias("far")), "opened-pairs")
    # the member that differs least goes first; a query that it connects with the group needs no other
    best = pairs.groupBy("node", "root", "other").agg(F.min(F.struct("far", "b")).alias("m"))
    found = links_of(best.select("node", "root", F.col("m.b").alias("b"), "other"))
    links.append(found)
    if not found.isEmpty():
        pairs = apart(pairs, reduce(DataFrame.unionByName, links))
    return reduce(DataFrame.unionByName, [*links, links_of(pairs.drop("far"))])


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_shingles (size of its set), component_id.

    component_id is the smallest doc_id that links reach, the document's own
    included. A text without words is linked with nothing. Repeated rows each
    come back; rows with equal sets are linked; a null doc_id is larger than
    any other, so a component is null only when all its ids are. Further
    columns are ignored; an empty table gives no rows.
    """
    made = described(docs)
    nodes = made.where("n > 0").groupBy("key", "n").agg(
        F.min(F.struct("row", "doc_id")).alias("first"), F.min("doc_id").alias("least_id"))
    nodes = materialise(nodes.select(
        F.col("first.row").alias("node"), F.col("first.doc_id").alias("doc_id"), "key", "n", "least_id"), "nodes")
    copies = materialise(made.select("row").where("n > 0").join(nodes.select(F.col("node").alias("row")), "row", "left_anti"), "copies")
    own = made.where("n > 0").join(small(copies), "row", "left_anti").withColumnRenamed("row", "node")
    first = first_groups(docs, nodes, materialise(own.select("node", "n", "sketch"), "sketches"))
    groups = components(first)
    later = later_links(docs, nodes, members_of(own, groups), materialise(own.select("node", "parity"), "bits"))
    if not later.isEmpty():
        groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(later))
    placed = nodes.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = materialise(placed.select("key", "n", "root", "least_id"), "placed")
    least = materialise(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    by_set = materialise(placed.join(least, "root").select("key", "n", "component_id"), "by_set")
    out = made.select("doc_id", "key", "n").join(by_set, ["key", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, with one document of each component: that with the smallest doc_id.

    Rows that repeat an id stand or fall together; a row without id stays only
    in a component without ids, with all of its kind.
    """
    verdict = near_groups(docs).groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"))
    lost = materialise(verdict.where("NOT kept").select(F.col("doc_id").alias("__id")), "lost")
    return docs.join(small(lost), docs["doc_id"].cast("long").eqNullSafe(F.col("__id")), "left_anti")
