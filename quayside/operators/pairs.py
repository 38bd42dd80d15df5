"""Pairs of items that share baskets, and bounded cross products."""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quayside.operators.ordered import with_position
from quayside.session import materialise

BIG_BASKET = 1000
#: Baskets of one bitmap, items that meet in one task, ranges of baskets whose counts bound a pair.
STRIPE, GROUP, RANGES = 32_768, 256, 64
#: An intersection of two bitmaps costs about as much as so many pair rows; fewer rows than that are not worth the turn.
AND_COST, LEAST_MADE = 3, 100_000_000
#: Pair rows that one task of the join lays out and counts, which bounds its memory; tasks of the join.
MADE_A_TASK, MOST_TASKS = 1_000_000, 10_000


def frequent_pairs(
    df: DataFrame, basket: str, item: str, min_support: int = 3, big_basket: int = BIG_BASKET,
) -> DataFrame:
    """(item_a, item_b, support) for item_a < item_b found together in >= min_support baskets.

    Exact, and built so that no giant basket is expanded in one place:

    * (basket, item) is made distinct first, and items found in fewer than
      `min_support` baskets are dropped, since no pair of theirs can qualify;
    * the `min_support` - 1 largest baskets are set aside when they are big. A
      pair that qualifies must also occur in some other basket, so the other
      baskets yield every candidate; for the baskets set aside it is then only
      looked up whether they hold both items;
    * should big baskets remain, their items are dealt into chunks, and each
      chunk meets the basket's items in a task of its own;
    * the join is dealt to as many tasks as its counted pairs ask for. Its
      input is small beside the pairs, so tasks planned by bytes read would
      hold more pairs the larger the table.

    All that lays out the pairs of every basket. Where baskets are dense, so
    that they hold many more pairs than there are pairs of items, the layout is
    turned: see `_by_bitmaps`. The rows are the same either way.
    """
    held = df.select(F.col(basket).alias("_b"), F.col(item).alias("_i")).dropna().distinct()
    often = held.groupBy("_i").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_support)
    # Read several times below, and much smaller than the input: written once.
    held = materialise(held.join(often.select("_i"), "_i", "left_semi"), "baskets")
    sizes = held.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    made, baskets = sizes.agg(F.sum(F.col("_n") * (F.col("_n") - 1) / 2), F.count(F.lit(1))).first()
    n_items = held.select("_i").distinct().count()
    if max(LEAST_MADE, AND_COST * n_items * (n_items - 1) / 2 * ceil(baskets / STRIPE)) < (made or 0):
        return _by_bitmaps(held.join(sizes.select("_b"), "_b", "left_semi"), min_support, n_items)
    largest = sizes.orderBy(F.col("_n").desc(), "_b").limit(min_support).collect()
    giants = [r["_b"] for r in largest[: min_support - 1] if r["_n"] > big_basket]
    usual = held.filter(~F.col("_b").isin(giants)) if giants else held
    left, right, on = usual, usual, ["_b"]
    laid_out = (made or 0) - sum(r["_n"] * (r["_n"] - 1) / 2 for r in largest if r["_b"] in giants)
    tasks = min(ceil(laid_out / MADE_A_TASK), MOST_TASKS)
    if len(largest) == min_support and largest[-1]["_n"] > big_basket:
        usual = usual.join(sizes, "_b")
        chunks = F.ceil(F.col("_n") / big_basket).cast("int")
        left = usual.withColumn("_c", F.pmod(F.hash("_i"), chunks))
        right = usual.withColumn("_c", F.explode(F.sequence(F.lit(0), chunks - 1)))
        on = ["_b", "_c"]
    if tasks > 1:
        tasks = max(tasks, df.sparkSession.sparkContext.defaultParallelism)
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    pairs = (
        left.select(*on, F.col("_i").alias("item_a"))
        .join(right.select(*on, F.col("_i").alias("item_b")), on)
        .filter(F.col("item_a") < F.col("item_b"))
        .groupBy("item_a", "item_b")
        .agg(F.count(F.lit(1)).alias("support"))
    )
    if giants:
        pairs = pairs.filter(F.col("support") >= min_support - len(giants))
        # Each item with those of the baskets set aside that hold it, fewer than `min_support`.
        inside = held.filter(F.col("_b").isin(giants)).groupBy("_i").agg(F.collect_list("_b").alias("_in"))
        for end in ("item_a", "item_b"):
            pairs = pairs.join(inside.select(F.col("_i").alias(end), F.col("_in").alias(f"_{end}")), end, "left")
        found = F.coalesce(F.size(F.array_intersect("_item_a", "_item_b")).cast("long"), F.lit(0))
        found = F.when(F.col("_item_a").isNull() | F.col("_item_b").isNull(), 0).otherwise(found)
        pairs = pairs.select("item_a", "item_b", (F.col("support") + found).alias("support"))
    return pairs.filter(F.col("support") >= min_support).select("item_a", "item_b", "support")


def _by_bitmaps(held: DataFrame, min_support: int, n_items: int) -> DataFrame:
    """Frequent pairs from one bitmap of baskets per item and stripe of baskets.

    Items and baskets are numbered; groups of items meet pairwise for each
    stripe, in tasks of at most 2 * GROUP bitmaps of 4 KB. A pair is
    intersected only if an upper bound lets it through: over ranges of all
    baskets, the sum of the lesser of both items' counts.
    """
    items = materialise(with_position(held.select("_i").distinct(), "_i", name="_no"), "pair-items")
    baskets = with_position(held.select("_b").distinct(), "_b", name="_at")
    rows = held.join(items, "_i").join(baskets, "_b").select((F.col("_no") - 1).alias("_no"), "_at")
    rows = rows.withColumns({"_stripe": F.bitmap_bucket_number("_at"), "_place": F.bitmap_bit_position("_at")})
    bits = materialise(rows.groupBy("_no", "_stripe").agg(
        F.bitmap_construct_agg("_place").alias("_bits"), F.count(F.lit(1)).alias("_n")), "pair-bitmaps")
    small = materialise(rows.groupBy("_no", (F.pmod(F.xxhash64("_at"), F.lit(RANGES))).cast("int").alias("_r")).agg(
        F.count(F.lit(1)).alias("_n")), "pair-counts")
    bounds = small.groupBy("_no").agg(*[F.coalesce(F.sum(F.when(F.col("_r") == r, F.col("_n"))), F.lit(0)).alias(f"_{r}") for r in range(RANGES)])
    bounds = bounds.select("_no", F.array(*[F.col(f"_{r}") for r in range(RANGES)]).alias("_bound"))
    groups = ceil(n_items / GROUP)
    own = F.floor(F.col("_no") / GROUP).cast("int")
    dealt = bits.join(bounds, "_no").withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = dealt.select("_no", "_stripe", "_bits", "_bound", F.least(own, "_other").alias("_g"), F.greatest(own, "_other").alias("_h"))

    def meet(block: pd.DataFrame) -> pd.DataFrame:
        no = block["_no"].to_numpy()
        bits = np.frombuffer(b"".join(block["_bits"]), np.uint64).reshape(len(no), -1)
        bound = np.stack(block["_bound"].to_numpy())
        left, right = (np.flatnonzero(no // GROUP == block[c].iloc[0]) for c in ("_g", "_h"))
        most = np.zeros((len(left), len(right)), np.int64)
        for r in range(RANGES):
            most += np.minimum.outer(bound[left, r], bound[right, r])
        a, b = np.nonzero((most >= min_support) & (no[left][:, None] < no[right]))
        out = []
        for at in range(0, len(a), 4096):
            x, y = left[a[at:at + 4096]], right[b[at:at + 4096]]
            both = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64)
            out.append(pd.DataFrame({"a": no[x], "b": no[y], "n": both})[both > 0])
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "n": []})

    met = dealt.groupBy("_g", "_h", "_stripe").applyInPandas(meet, "a long, b long, n long")
    found = met.groupBy("a", "b").agg(F.sum("n").alias("support")).filter(F.col("support") >= min_support)
    first = items.select(F.col("_i").alias("item_a"), (F.col("_no") - 1).alias("a"))
    second = items.select(F.col("_i").alias("item_b"), (F.col("_no") - 1).alias("b"))
    return found.join(first, "a").join(second, "b").select("item_a", "item_b", "support")


def every_combination(df: DataFrame, small: DataFrame, packed_rows: int = 10_000) -> DataFrame:
    """Each row of `df` with each row of `small`, however many there are.

    `small` is counted first. Up to `packed_rows` rows it reaches each task as
    one array value, which each row of `df` unfolds in place, so there is
    neither a join nor a shuffle. A larger side is left to the planner's cross
    product; the rows are the same.
    """
    if small.limit(packed_rows + 1).count() > packed_rows:
        return df.crossJoin(small)
    packed = small.agg(F.collect_list(F.struct(*small.columns)).alias("all"))
    return df.select(*df.columns, F.inline(packed.scalar()))
