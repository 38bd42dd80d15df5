"""Places of pattern matches in texts, in DataFrame operations only.

SQL functions give the matches of a pattern but not where they are. Splitting
by the same pattern gives the stretches between them; a running sum of both
lengths gives each place, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points kept of the stretches before and behind a match, for context words.
CONTEXT, BEHIND = 48, 24


@dataclass(frozen=True)
class Kind:
    """A kind of span: `pattern` never matches the empty text; `needs` tells texts that can't match, cheaply."""

    name: str
    pattern: str
    needs: str


def _placed(text: Column, hits: Column, kind: int, pattern: str) -> Column:
    """Array of (kind, at, gap, before, behind, hit); both arrays enter as arguments, so each is made once a text.

    The first element holds the first stretch, and each hit the stretch behind it.
    """
    pairs = F.zip_with(
        F.split(text, pattern, -1), hits,
        lambda g, h: F.struct(
            F.char_length(g).alias("gap"), F.right(g, F.lit(CONTEXT)).alias("before"), F.left(g, F.lit(BEHIND)).alias("behind"), h.alias("hit")),
    )
    numbered = F.transform(pairs, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("at"), x["gap"].alias("gap"), x["before"].alias("before"), x["behind"].alias("behind"),
        x["hit"].alias("hit")))
    return numbered


def matches(docs: DataFrame, kinds: list[Kind]) -> DataFrame:
    """Every leftmost non-overlapping match of each kind: row, doc_id, kind (its number), start, end, before, behind, hit.

    A text without matches (also a null or empty one) gives one row with a null
    kind. `row` numbers the rows of `docs`, so repeated and null ids stay apart.
    """
    d = docs.select(
        F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    d = d.withColumns({
        f"hits{k}": F.when(F.col("text").rlike(kind.needs), F.regexp_extract_all("text", F.lit(kind.pattern), 0)).otherwise(none)
        for k, kind in enumerate(kinds)
    })
    empty = F.array().cast("array<struct<kind:int,at:int,gap:int,before:string,behind:string,hit:string>>")
    parts = [
        F.when(F.size(f"hits{k}") > 0, _placed(F.col("text"), F.col(f"hits{k}"), k, kind.pattern)).otherwise(empty)
        for k, kind in enumerate(kinds)
    ]
    rows = d.select("row", "doc_id", F.explode_outer(F.concat(*parts)).alias("m"))
    rows = rows.select("row", "doc_id", "m.*").repartition("row")
    along = Window.partitionBy("row", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.char_length("hit")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    # behind a match stands the beginning of the next stretch
    rows = rows.withColumns({"end": end.cast("int"), "behind": F.lead("behind").over(along)})
    return rows.where(F.col("hit").isNotNull() | F.col("kind").isNull()).select(
        "row", "doc_id", "kind", (F.col("end") - F.char_length("hit")).alias("start"), "end", "before", "behind", "hit")


def digest(found: DataFrame, names: list[str], base: int, valid: Column, by_start: bool) -> DataFrame:
    """One row per document row: doc_id, n_<name> of the first `base` kinds, base_sha256 and spans.

    Spans are written kind:start:end and joined by commas, in the order of
    (start, kind) or (kind, start).
    """
    order = ["start", "kind", "end"] if by_start else ["kind", "start", "end"]
    one = F.struct(*order)
    got = found.groupBy("row", "doc_id").agg(
        *[F.count(F.when(valid & (F.col("kind") == k), 1)).alias(f"n_{names[k]}") for k in range(base)],
        F.sort_array(F.collect_list(F.when(valid, one))).alias("all"),
    )
    label = F.array(*[F.lit(n) for n in names])

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(label, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return got.select(
        "doc_id", *[f"n_{names[k]}" for k in range(base)],
        F.sha2(text(F.filter("all", lambda s: s["kind"] < base)), 256).alias("base_sha256"),
        text(F.col("all")).alias("spans"),
    )
