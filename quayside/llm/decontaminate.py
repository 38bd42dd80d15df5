"""Benchmark decontamination by SimHash windows, in DataFrame operations only.

For every benchmark item, the windows of a document that have the item's
number of words are compared with it. A window that shares no word shingle
with any item has similarity 0, so windows are laid out only where one is
shared, aligned to the item's own place of that shingle. Each window gets a
SimHash of its words; a multi-index over blocks of the fingerprint finds every
item within the radius; exact weighted-shingle similarity decides.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import materialise

SHINGLE = 5
LEAST = 0.75
#: Fingerprints of 64 bits in 8 blocks. Within a radius of 23 bits one block differs in 2 bits at most.
BLOCKS, RADIUS = 8, 23
#: Shingles of a benchmark that are sent to every executor; beyond, the join shuffles.
BROADCAST_ROWS = 2_000_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words in order: runs of letters and digits, lower case."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def grams(hashes: str, size: str) -> Column:
    """Hashes of the runs of `size` neighbouring words; with fewer words the whole is one."""
    return F.expr(f"""CASE WHEN size({hashes}) = 0 THEN array()
        ELSE transform(sequence(1, greatest(size({hashes}) - {size} + 1, 1)), i -> xxhash64(slice({hashes}, i, {size}))) END""")


def counted(shingles: Column) -> Column:
    """The k-th occurrence of a shingle as a sign of its own, so that set overlap is weighted overlap."""
    ordered = F.sort_array(shingles)
    return F.transform(ordered, lambda x, i: F.xxhash64(x, i - F.array_position(ordered, x).cast("int")))


def fingerprint(hashes: str) -> Column:
    """64-bit SimHash of the words, each weighted by its count."""
    return F.expr(f"""aggregate(
        transform(sequence(0, 63), b -> 2 * aggregate({hashes}, 0, (a, h) -> a + int(shiftrightunsigned(h, b) & 1)) > size({hashes})),
        struct(0L AS v, 0 AS b), (a, on) -> struct(a.v | if(on, shiftleft(1L, a.b), 0L) AS v, a.b + 1 AS b), a -> a.v)""")


def block_keys(mark: str, flips: int) -> Column:
    """(block, key) of each block of a fingerprint, with up to `flips` of its bits changed."""
    width = 64 // BLOCKS
    masks = sorted(sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(range(width), k))
    return F.expr(f"""flatten(transform(sequence(0, {BLOCKS - 1}), b -> transform(array({", ".join(map(str, masks))}),
        m -> struct(b AS block, int(shiftrightunsigned({mark}, b * {width}) & {2**width - 1}) ^ m AS key))))""")


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, words (their number), hashes, shingle size, shingles counted, mark; items without words can't be found."""
    own = benchmark.select(benchmark["item_id"].alias("item_id"), word_hashes(benchmark["text"]).alias("hashes"))
    own = own.where(F.size("hashes") > 0).withColumn("words", F.size("hashes"))
    own = own.withColumn("gram", F.least("words", F.lit(SHINGLE)))
    return own.withColumns({"grams": grams("hashes", "gram"), "mark": fingerprint("hashes")})


def _neighbours(own: DataFrame, size: int) -> DataFrame:
    """One row per run of `size` words of a document: row, doc_id, hashes, at (from 0) and the run's hash `gram_hash`."""
    length = F.greatest(F.size("hashes"), F.lit(1))
    zipped = F.arrays_zip(*[F.slice("hashes", k + 1, length) for k in range(size)])  # the run at each place; null beyond the end
    fields = [f"h{k}" for k in range(size)]
    rows = own.where(F.size("hashes") >= size).select("row", "doc_id", "hashes", F.posexplode(zipped).alias("at", "n"))
    rows = rows.select("row", "doc_id", "hashes", "at", "n.*").toDF("row", "doc_id", "hashes", "at", *fields)
    return rows.where(F.col(fields[-1]).isNotNull()).select(
        "row", "doc_id", "hashes", "at", F.xxhash64(F.array(*fields)).alias("gram_hash"))


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """row, doc_id, words, start, hashes of each item-sized window that shares a shingle with an item of that size.

    A document with fewer words than the item is one window of all its words.
    """
    own = docs.select(
        F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"), word_hashes(docs["text"]).alias("hashes"))
    places = materialise(items.select(
        "words", "gram", F.posexplode("grams").alias("offset", "gram_hash")).distinct(), "places")
    rows = places.count()
    sizes = sorted(r["gram"] for r in places.select("gram").distinct().collect())  # from 1 to SHINGLE
    found = None
    for size in sizes:
        these = places.where(F.col("gram") == size).drop("gram")
        if rows <= BROADCAST_ROWS:
            these = F.broadcast(these)
        last = F.greatest(F.size("hashes") - F.col("words"), F.lit(0))
        start = F.greatest(F.least(F.col("at") - F.col("offset"), last), F.lit(0))
        hit = _neighbours(own, size).join(these, "gram_hash").select(
            "row", "doc_id", "words", start.alias("start"), F.slice("hashes", start + 1, F.col("words")).alias("hashes"))
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        found = own.select("row", "doc_id", F.lit(0).alias("words"), F.lit(0).alias("start"), "hashes").where(F.lit(False))
    return found.groupBy("row", "doc_id", "words", "start").agg(F.first("hashes").alias("hashes"))


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per document row and benchmark item found in it: doc_id, item_id, start (word, from 0), words, distance, similarity.

    Of an item's windows the most similar one counts, at a tie the first. The
    similarity is the weighted Jaccard of five-word shingles (of the whole
    sequence where the item has fewer words). Null and empty texts hold
    nothing; repeated documents and items each give their rows; null ids are
    kept; further columns are ignored; an empty table gives no rows.
    """
    items = materialise(items_of(benchmark), "items")
    got = windows(docs, items).withColumn("gram", F.least("words", F.lit(SHINGLE)))
    got = materialise(got.withColumns({"mark": fingerprint("hashes"), "grams": grams("hashes", "gram")}), "windows")
    flips = RADIUS // BLOCKS
    left = got.select("row", "words", "start", "mark", F.explode(block_keys("mark", 0)).alias("k")).select("row", "words", "start", "mark", "k.*")
    numbered = materialise(items.withColumn("item", F.monotonically_increasing_id()), "numbered")
    right = numbered.select("item", "words", F.col("mark").alias("item_mark"), F.explode(block_keys("mark", flips)).alias("k")).select(
        "item", "words", "item_mark", "k.*")
    distance = F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark")))
    near = left.join(right, ["words", "block", "key"]).withColumn("distance", distance).where(F.col("distance") <= RADIUS)
    near = near.groupBy("row", "words", "start", "item").agg(F.first("distance").alias("distance"))
    theirs = numbered.select("item", "item_id", counted(F.col("grams")).alias("theirs"))
    ours = got.select("row", "doc_id", "words", "start", counted(F.col("grams")).alias("ours"))
    pairs = near.join(ours, ["row", "words", "start"]).join(theirs, "item")
    both = F.size(F.array_intersect("ours", "theirs"))
    pairs = pairs.withColumn("similarity", both / (F.size("ours") + F.size("theirs") - both)).where(F.col("similarity") >= least)
    best = pairs.groupBy("row", "item").agg(F.max(F.struct(
        "similarity", (-F.col("start")).alias("back"), (-F.col("distance")).alias("closer"), "doc_id", "item_id", "words")).alias("b"))
    return best.select(
        "b.doc_id", "b.item_id", (-F.col("b.back")).alias("start"), "b.words", (-F.col("b.closer")).alias("distance"), "b.similarity")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, in whose id no benchmark item was found; a null id is looked at by itself."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")), "left_anti")
