"""Star schema, saved results and their readers.

Inputs are customers, products, orders and order items with the columns of
`queries.commerce`; amounts are decimals, so sums do not depend on row order.
Results that are ranked as a whole are first written to the shared folder: the
ordered windows read them several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quayside.functions import dates, numbers
from quayside.functions.exact import round_half_up
from quayside.operators.ordered import with_ntile, with_rank
from quayside.operators.pairs import frequent_pairs
from quayside.session import materialise
from quayside.sources.catalog import publish

# Score limits, best first.
RECENCY_LIMITS = ((30, 5), (60, 4), (90, 3), (180, 2))
FREQUENCY_LIMITS = ((10, 5), (7, 4), (5, 3), (3, 2))
RFM_CLASSES = ((13, "Champions"), (10, "Loyal"), (7, "Potential"))
# Order states that count as delivered, in words and as a code.
DELIVERED = ("Delivered", "F")
PRICE_TIERS = ((1000, 10000, 50000), ("Budget", "Mid-Range", "Premium", "Luxury"))


def recency_score(days: Column) -> Column:
    out = F
    for limit, score in RECENCY_LIMITS:
        out = out.when(days <= limit, score)
    return out.otherwise(1)


def frequency_score(orders: Column) -> Column:
    out = F
    for limit, score in FREQUENCY_LIMITS:
        out = out.when(orders >= limit, score)
    return out.otherwise(1)


def rfm_class(score: Column) -> Column:
    out = F
    for limit, name in RFM_CLASSES:
        out = out.when(score >= limit, name)
    return out.otherwise("At Risk")


def delivered(orders: DataFrame) -> DataFrame:
    """A plain test on the stored column, so that it reaches the file scan."""
    return orders.filter(F.col("order_status").isin(*DELIVERED))


def fact_orders(orders: DataFrame, items: DataFrame, products: DataFrame, *carried: str) -> DataFrame:
    """Delivered order lines with date parts, cost and profit, and the `carried` columns of the product."""
    cost = products.select("product_id", F.col("cost").alias("unit_cost"), *carried)
    rows = delivered(orders).join(items, "order_id").join(cost, "product_id")
    day = F.col("order_date")
    line_cost = F.col("quantity") * F.col("unit_cost")
    return rows.select(
        "order_id", "customer_id", "product_id", "order_date",
        F.year(day).cast("bigint").alias("order_year"),
        F.quarter(day).cast("bigint").alias("order_quarter"),
        F.month(day).cast("bigint").alias("order_month"),
        dates.day_of_week(day).alias("order_day_of_week"),
        "order_status", "payment_method", "quantity", "unit_price", "discount_percent", "line_total",
        "unit_cost", line_cost.alias("line_cost"), (F.col("line_total") - line_cost).alias("line_profit"), *carried,
    )


def dim_customers(customers: DataFrame, as_of: Column) -> DataFrame:
    return customers.withColumns({
        "registration_year": F.year("registration_date").cast("bigint"),
        "customer_age_years": dates.age_years(as_of, F.col("registration_date")),
    })


def dim_products(products: DataFrame, tiers=PRICE_TIERS) -> DataFrame:
    margin = F.col("price") - F.col("cost")
    pct = F.try_divide(margin.cast("double"), F.col("price").cast("double")) * 100
    return products.withColumns({
        "profit_per_unit": margin,
        "profit_margin_pct": round_half_up(pct),
        "price_tier": numbers.tiers("price", *tiers),
    })


def revenue_by_month_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """One pass over the fact: the distinct orders are counted by first grouping
    on (month, category, order), which spreads a hot month or category. A fact
    that carries the category is not joined with the products again."""
    keys = ["order_year", "order_month", "category_name"]
    rows = fact if "category_name" in fact.columns else fact.join(products.select("product_id", "category_name"), "product_id")
    rows = rows.groupBy(*keys).agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
        F.sum("line_total").alias("revenue"), F.sum("line_profit").alias("profit"), F.count(F.lit(1)).alias("_n"),
    )
    average = round_half_up(F.col("revenue").cast("double") / F.col("_n"))
    return rows.withColumn("avg_order_line_value", average).drop("_n")


def customer_spend(orders: DataFrame) -> DataFrame:
    """Delivered orders per customer: count, revenue, first and last date."""
    return delivered(orders).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("total_amount").alias("total_revenue"),
        F.max("order_date").alias("last_order_date"), F.min("order_date").alias("first_order_date"),
    )


def customer_summary(customers: DataFrame, orders: DataFrame, as_of: Column) -> DataFrame:
    """One row per customer with scores. Customers without orders have no
    revenue; nulls lead the descending order, so they fall in bucket 1."""
    rows = customers.join(customer_spend(orders), "customer_id", "left")
    rows = rows.withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))
    days = dates.days_since("last_order_date", as_of)
    rows = rows.withColumns({
        "avg_order_value": F.try_divide(F.col("total_revenue").cast("double"), F.col("total_orders")),
        "days_since_last_order": days,
        "recency_score": recency_score(days),
        "frequency_score": frequency_score(F.col("total_orders")),
    })
    rows = materialise(rows, "customer-summary")
    return with_ntile(rows, 5, ["-total_revenue", "customer_id"], name="monetary_score")


def rfm(customers: DataFrame, orders: DataFrame, as_of: Column) -> DataFrame:
    """Lifetime value and recency / frequency / monetary classes of customers with orders."""
    rows = customers.join(customer_spend(orders), "customer_id")
    months = dates.age_month_part("last_order_date", "first_order_date")
    revenue = F.col("total_revenue").cast("double")
    # Whole-number division, as both sides are integers; 0 months gives null.
    extra = F.floor(F.try_divide(F.col("total_orders").cast("double"), F.nullif(months, F.lit(0)).cast("double")))
    days = dates.days_since("last_order_date", as_of)
    rows = rows.withColumns({
        "days_since_last_order": days,
        "estimated_clv": round_half_up(revenue * (1 + extra)),
        "recency_score": recency_score(days),
        "frequency_score": frequency_score(F.col("total_orders")),
    })
    rows = materialise(rows, "customer-value")
    rows = with_ntile(rows, 5, ["-total_revenue", "customer_id"], name="monetary_score")
    score = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return rows.select(
        "customer_id", "customer_name", "customer_segment", "total_orders",
        F.round("total_revenue", 2).cast("double").alias("total_revenue"),
        round_half_up(revenue / F.col("total_orders")).alias("avg_order_value"),
        "days_since_last_order", "estimated_clv", "recency_score", "frequency_score", "monetary_score",
        score.alias("rfm_score"), rfm_class(score).alias("customer_category"),
    )


def product_sales(products: DataFrame, items: DataFrame) -> DataFrame:
    """Units, revenue, cost and profit per product.

    All lines count, whatever their order's status: in the result this follows,
    the status only restricts an outer join that adds no column.
    """
    sales = items.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
        F.sum("line_total").alias("total_revenue"),
        F.sum(F.col("discount_percent").cast("decimal(7,2)")).alias("_d"),
        F.count("discount_percent").alias("_n"),
    )
    margin = F.col("price") - F.col("cost")
    return products.join(sales, "product_id", "left").withColumns({
        "total_orders": F.coalesce("total_orders", F.lit(0)),
        "profit_per_unit": margin,
        "profit_margin_pct": round_half_up(margin.cast("double") / F.col("price").cast("double") * 100),
        "total_cost": F.col("units_sold") * F.col("cost"),
        "avg_discount_pct": F.try_divide(F.col("_d").cast("double"), F.col("_n")),
    }).withColumn("total_profit", F.col("total_revenue") - F.col("total_cost")).drop("_d", "_n")


def product_performance(products: DataFrame, items: DataFrame) -> DataFrame:
    """Sales per product with overall and category ranks."""
    rows = materialise(product_sales(products, items), "product-sales")
    # Category first: the overall rank's statistics pass then drops that window unused.
    rows = with_rank(rows, "-total_revenue", ["category_name"], rank="category_rank")
    return with_rank(rows, "-total_revenue", rank="revenue_rank")


def daily_totals(orders: DataFrame) -> DataFrame:
    """One row per day; `order_id` is unique, so orders are counted as rows."""
    return delivered(orders).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("order_count"), F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("total_amount").alias("daily_revenue"),
    )


#: Grain of the daily state: a day's customers in groups of 32,768 numbers.
STATE_KEY = ("order_date", "bucket")


def daily_state(orders: DataFrame) -> DataFrame:
    """What can be added up to daily totals: per day and customer group the orders, revenue and a bitmap of customers.

    Customer ids are whole numbers (others can be numbered by a level table).
    The rows are dealt by day and group first, so a 4 KB bitmap is built once
    for each and none is shuffled.
    """
    customer = F.col("customer_id").cast("bigint")
    rows = delivered(orders).select(
        "order_date", F.bitmap_bucket_number(customer).alias("bucket"), F.bitmap_bit_position(customer).alias("place"), "total_amount")
    return rows.repartition(*STATE_KEY).groupBy(*STATE_KEY).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("revenue"), F.bitmap_construct_agg("place").alias("customers"))


def merged_state(state: DataFrame) -> DataFrame:
    """States added up: counts and revenue by sum, customers by the union of their bitmaps."""
    kind = state.schema["revenue"].dataType
    return state.repartition(*STATE_KEY).groupBy(*STATE_KEY).agg(
        F.sum("order_count").alias("order_count"), F.sum("revenue").cast(kind).alias("revenue"),
        F.bitmap_or_agg("customers").alias("customers"))


def totals_of(state: DataFrame) -> DataFrame:
    """`daily_totals` from a merged state: the groups of a day hold different customers, so their counts add up."""
    kind = state.schema["revenue"].dataType
    return state.groupBy("order_date").agg(
        F.sum("order_count").alias("order_count"), F.sum(F.bitmap_count("customers")).alias("unique_customers"),
        F.sum("revenue").cast(kind).alias("daily_revenue"))


def with_trends(daily: DataFrame) -> DataFrame:
    """Averages and running total over one row per day: at most 366 rows a year
    at any data size, so a single ordered window is bounded."""
    w = Window.orderBy("order_date")
    revenue = F.col("daily_revenue")

    def average(days: int) -> Column:
        frame = w.rowsBetween(-(days - 1), Window.currentRow)
        return F.sum(revenue).over(frame).cast("double") / F.count(F.lit(1)).over(frame)

    return daily.withColumns({
        "avg_order_value": revenue.cast("double") / F.col("order_count"),
        "moving_avg_7day": average(7),
        "moving_avg_30day": average(30),
        "cumulative_revenue": F.sum(revenue).over(w.rowsBetween(Window.unboundedPreceding, 0)),
    })


def daily_revenue(orders: DataFrame) -> DataFrame:
    return with_trends(daily_totals(orders))


def recent_trend(daily: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """The dashboard's rows: the last `days` days, newest first."""
    return daily.filter(F.col("order_date") >= F.date_sub(as_of, days)).select(
        "order_date", "daily_revenue", "moving_avg_7day",
        (F.col("daily_revenue").cast("double") - F.col("moving_avg_7day")).alias("deviation_from_avg"),
        "cumulative_revenue",
    ).orderBy(F.col("order_date").desc())


def cohort_activity(fact: DataFrame, customers: DataFrame, month_part_only: bool = True) -> DataFrame:
    """Active customers and revenue per cohort and order month.

    `month_part_only` counts months modulo a year, as the mart query it follows
    does; switch it off for the true distance.
    """
    spend = fact.groupBy("customer_id", dates.month_start("order_date").alias("order_month")).agg(
        F.sum("line_total").alias("r")
    )
    cohorts = customers.select("customer_id", dates.month_start("registration_date").alias("cohort_month"))
    rows = cohorts.join(spend, "customer_id").groupBy("cohort_month", "order_month").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("r").alias("revenue")
    )
    return rows.withColumn("months_since_cohort", dates.months_since("order_month", "cohort_month", month_part_only))


def cohort_retention(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Cohort size, active customers, retention rate and revenue per head by month."""
    cohorts = customers.select("customer_id", dates.month_start("registration_date").alias("cohort_month"))
    spend = delivered(orders).groupBy("customer_id", dates.month_start("order_date").alias("order_month")).agg(
        F.sum("total_amount").alias("r")
    )
    metrics = cohorts.join(spend, "customer_id").groupBy("cohort_month", "order_month").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("r").alias("revenue")
    )
    sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    active = F.col("active_customers")
    return metrics.join(sizes, "cohort_month").select(
        "cohort_month",
        dates.months_since("order_month", "cohort_month").alias("months_since_cohort"),
        "active_customers", "cohort_size",
        round_half_up(active.cast("double") / F.col("cohort_size") * 100).alias("retention_rate"),
        "revenue",
        round_half_up(F.col("revenue").cast("double") / active).alias("revenue_per_customer"),
    )


def affinity(fact: DataFrame, products: DataFrame, min_support: int = 3, top: int = 20) -> DataFrame:
    """Products bought together in at least `min_support` orders, the `top` most frequent pairs.

    The rank of a pair counts the more frequent pairs of the same first item.
    Those all come before it in the report, so the rank is taken over the
    report's rows alone.
    """
    pairs = frequent_pairs(fact, "order_id", "product_id", min_support)
    best = pairs.orderBy(F.col("support").desc(), "item_a", "item_b").limit(top)
    rank = F.rank().over(Window.partitionBy("item_a").orderBy(F.col("support").desc()))
    best = best.withColumn("affinity_rank", rank.cast("bigint"))
    a = products.select(F.col("product_id").alias("item_a"), F.col("product_name").alias("product_a_name"))
    b = products.select(F.col("product_id").alias("item_b"), F.col("product_name").alias("product_b_name"))
    return best.join(a, "item_a").join(b, "item_b").select(
        "item_a", "item_b", "product_a_name", "product_b_name",
        F.col("support").alias("co_occurrence_count"), "affinity_rank",
    )


def high_value_customers(orders: DataFrame, customers: DataFrame, threshold: float, since: Column) -> DataFrame:
    """Customers whose delivered spend since a date is above the threshold."""
    spent = (
        delivered(orders).filter(F.col("order_date") >= since).groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("total_orders"), F.sum("total_amount").alias("total_spent"))
        .filter(F.col("total_spent") > threshold)
    )
    return spent.join(customers.select("customer_id", "customer_name"), "customer_id").orderBy(
        F.col("total_spent").desc(), "customer_id"
    )


def publish_mart(
    customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, as_of: Column,
    prefix: str = "mart", tiers=PRICE_TIERS,
) -> dict[str, int]:
    """Save the fact (by year and month), the dimensions and the summaries; name -> version.

    The fact is published first and the later results read the saved tables,
    so the order-line join runs once. Run it again to refresh: readers keep the
    version they started on.
    """
    spark = orders.sparkSession
    name = lambda table: f"{prefix}_{table}"
    done = {}

    def save(table: str, df: DataFrame, partition_by=()) -> DataFrame:
        done[name(table)] = publish(df, name(table), partition_by)
        return spark.table(name(table))

    fact = save("fact_orders", fact_orders(orders, items, products), ("order_year", "order_month"))
    people = save("dim_customers", dim_customers(customers, as_of))
    goods = save("dim_products", dim_products(products, tiers))
    save("customer_summary", customer_summary(people.select(*customers.columns), orders, as_of))
    save("product_performance", product_performance(goods.select(*products.columns), items))
    save("daily_revenue", daily_revenue(orders))
    save("revenue_by_month_category", revenue_by_month_category(fact, goods))
    save("cohort_activity", cohort_activity(fact, people))
    return done
