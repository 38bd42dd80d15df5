"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

Each text is cut, in place, where its own content says so. Every distinct
chunk digest gets one verified identifier; a text's recipe is the ordered list
of its identifiers, and two texts are equal when their recipes are. The texts
themselves never move: digests do, about 1/25 of the text's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import ascii_lower
from quayside.session import materialise

#: A chunk ends behind a line feed, or a blank that follows one of these letters, at the first such
#: place beyond the least length, and anywhere at the most.
CUT = r"(?s).{1024,8191}?(?:\n|[aeimq] )|.{1,8192}"


def chunk_digests(docs: DataFrame, cut: str = CUT) -> DataFrame:
    """row, doc_id, sha (of the normalised text) and parts: its chunks' digests, check hashes and lengths, written."""
    base = docs.select(
        F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
        ascii_lower(F.coalesce(docs["text"], F.lit(""))).alias("norm"),
    )
    part = lambda c: F.struct(
        F.unhex(F.sha2(c, 256)).alias("digest"), F.xxhash64(c).alias("mark"), F.char_length(c).alias("length"))
    return materialise(base.select(
        "row", "doc_id", F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.transform(F.regexp_extract_all("norm", F.lit(cut), 0), part).alias("parts"),
    ), "chunks")


def chunk_identifiers(parts: DataFrame) -> DataFrame:
    """digest, id: one number for each distinct chunk.

    A digest is verified when all its chunks agree in length and in a second,
    independent hash; a digest that fails is an error, as its chunks would be
    taken for equal though they differ.
    """
    seen = parts.groupBy("digest").agg(
        F.min("mark").alias("a"), F.max("mark").alias("b"), F.min("length").alias("c"), F.max("length").alias("d"))
    checked = F.when((F.col("a") == F.col("b")) & (F.col("c") == F.col("d")), F.monotonically_increasing_id())
    return materialise(seen.select(
        "digest", F.coalesce(checked, F.raise_error(F.lit("two chunks share a digest")).cast("long")).alias("id")), "ids")


def recipes(digests: DataFrame) -> DataFrame:
    """row, doc_id, sha and recipe (array of identifiers in order; empty for an empty text), written."""
    parts = digests.select("row", F.posexplode("parts").alias("at", "part")).select("row", "at", "part.*")
    ids = chunk_identifiers(parts)
    lists = (
        parts.select("row", "at", "digest").join(ids, "digest")
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("placed"))
        .select("row", F.col("placed.id").alias("recipe"))
    )
    none = F.array().cast("array<bigint>")
    return materialise(
        digests.drop("parts").join(lists, "row", "left").withColumn("recipe", F.coalesce("recipe", none)), "recipes")


def copies(docs: DataFrame, cut: str = CUT) -> DataFrame:
    """Group equal texts, where equal means identical after lower-casing A-Z only.

    One row per document row: doc_id, keep_id (the largest doc_id of its
    group), group_size, kept, text_sha256. Null texts count as empty, and all
    empty texts form one group. Repeated rows are counted, each comes back, and
    one of them stays. A null doc_id loses against any other; a group of null
    ids only keeps one row, with a null keep_id. Further columns are ignored;
    an empty table gives no rows.
    """
    made = recipes(chunk_digests(docs, cut))
    # summed before the shuffle, so a hot group is one row per task; then its many rows meet that one row,
    # and as the sums are written first, adaptive execution can split them
    group = made.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("n"))
    group = materialise(group, "groups")
    return made.join(group, "recipe").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, cut: str = CUT) -> DataFrame:
    """The rows of `docs`, all columns, without copies; see `copies` for which row of a group stays.

    Kept rows are found again by doc_id and text hash. Rows that repeat both
    are the only ones reduced by a further step.
    """
    verdict = materialise(copies(docs, cut), "verdict")
    key = ["__id", "__sha"]
    named = verdict.select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha"), "kept")
    stays = named.groupBy(*key).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("kept")
    own = docs.withColumns({
        "__id": docs["doc_id"].cast("long"),
        "__sha": F.unhex(F.sha2(ascii_lower(F.coalesce(docs["text"], F.lit(""))), 256)),
    })

    def having(rows: DataFrame) -> DataFrame:
        r = rows.select(F.col("__id").alias("__id2"), F.col("__sha").alias("__sha2"))
        on = F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__sha") == F.col("__sha2"))
        return own.join(r, on, "left_semi")

    once = having(stays.where("n = 1"))
    repeated = stays.where("n > 1")
    if not repeated.isEmpty():
        once = once.unionByName(having(repeated).dropDuplicates(key))
    return once.select(*[once[c] for c in docs.columns])
