"""Validation runs on the small sales fixtures."""

import pytest
from pyspark.sql import functions as F

from quayside.operators import quality as Q
from quayside.operators.columns import columns_like, missing_columns, numeric_columns, required_columns
from quayside.operators.relations import Role, Source, picked, relations
from quayside.plans import quarantine, records
from quayside.queries import QUERIES

SALES = [
    (1, "Laptop", 75000, 2, "C001", "West"),
    (2, "Mouse", -500, 5, "C002", "East"),
    (3, None, 1500, 0, "C003", "North"),
    (4, "Monitor", 25000, 1, "INVALID", "South"),
    (5, "Keyboard", 1500, 3, "C005", "InvalidRegion"),
    (6, "Headphones", 2000, 4, "C006", "West"),
    (7, "Webcam", 3500, 2, "C007", "East"),
    (8, "Speaker", 5000, 15000, "C008", "North"),
    (9, "Tablet", 45000, 1, "C009", "South"),
    (10, "Phone", 1200000, 2, "C010", "West"),
]
SCHEMA = "record_num long, product string, price long, quantity long, customer_id string, region string"


@pytest.fixture(scope="module")
def checked(spark):
    df = spark.createDataFrame(SALES, SCHEMA)
    return Q.check(df, Q.sales_rules(df)).cache()


def test_golden_run(checked):
    assert tuple(Q.totals(checked).first()) == (10, 5, 5, 2)
    errors = {r["record_num"]: r["errors"] for r in Q.invalid(checked).collect()}
    # "INVALID" is long enough but does not start with the prefix.
    assert errors == {
        2: ["Price below minimum: ₹-500"],
        3: ["Missing required field: product"],
        4: ["Invalid customer ID format: INVALID"],
        5: ["Invalid region: InvalidRegion"],
        10: ["Price above maximum: ₹1,200,000"],
    }
    warnings = {r["record_num"]: r["warnings"] for r in Q.valid(checked).collect() if r["warnings"]}
    assert warnings == {8: ["Unusually high quantity: 15000", "High-value order: ₹75,000,000 - Requires approval"]}


def test_empty_text_counts_as_missing(spark):
    df = spark.createDataFrame([(1, "", 5, 1, "C001", "West")], SCHEMA)
    row = Q.check(df, Q.sales_rules(df)).first()
    assert row["errors"] == ["Missing required field: product"] and row["warnings"] == []


def test_valid_and_invalid_make_the_input(checked):
    assert Q.valid(checked).count() + Q.invalid(checked).count() == checked.count()
    assert {r["n"] for r in Q.message_counts(checked).collect()} == {1}


def test_quarantine_write(spark, checked, tmp_path):
    quarantine.write_quarantine(checked, str(tmp_path / "q"), "r1", "record_num")
    saved = spark.read.parquet(str(tmp_path / "q/run_id=r1/records"))
    assert saved.filter("is_valid = 'true'").count() == 5 and saved.count() == 10
    lines = [r[0] for r in spark.read.text(str(tmp_path / "q/run_id=r1/report")).collect()]
    assert set(lines) == {
        "Total Records: 10", "Valid Records: 5", "Invalid Records: 5", "Warnings: 2",
        "Record #2: Price below minimum: ₹-500", "Record #3: Missing required field: product",
        "Record #4: Invalid customer ID format: INVALID", "Record #5: Invalid region: InvalidRegion",
        "Record #10: Price above maximum: ₹1,200,000",
    }
    quarantine.write_sides(checked, str(tmp_path / "sides"))
    bad = spark.read.csv(str(tmp_path / "sides/invalid"), header=True)
    assert bad.count() == 5 and "errors" in bad.columns


def test_basic_rules_and_file_check(spark):
    rows = [
        (1, "Laptop", 75000, 2, "C001", "West"), (2, "Mouse", -500, 5, "C002", "East"), (3, None, 1500, 0, "C003", "North"),
        (4, "Monitor", 25000, 1, None, "South"), (5, "Keyboard", 1500, 3, "C005", "West"), (6, "TV", 600000, 2, "C006", "Center"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["record_num"]: r["errors"] for r in Q.check(df, Q.basic_rules(df)).collect()}
    assert got == {
        1: [], 2: ["Invalid price: -500"], 3: ["Invalid quantity: 0", "Invalid product name"], 4: ["Missing customer_id"], 5: [],
        6: ["Invalid region: Center", "High value order: ₹1,200,000 - Needs approval"],
    }
    got = Q.file_check(df.filter("record_num <= 5")).first()
    assert tuple(got) == (5, 2, 40.0, 3, 60.0, 154500.0)


def test_validate_and_measure(spark):
    rows = [("Laptop", 75000, 3, "C001"), ("Mouse", -500, 10, "C002"), ("Monitor", 25000, 5, "INVALID"), ("Keyboard", 1500, 2, "C003")]
    df = spark.createDataFrame(rows, "product string, price long, quantity long, customer_id string")
    out = {r["product"]: r for r in records.process_sales(df).collect()}
    assert out["Laptop"]["final_revenue"] == 202500.0 and out["Laptop"]["discount_amount"] == 22500.0
    assert out["Keyboard"]["final_revenue"] == 3000.0 and not out["Keyboard"]["discount_applied"]
    assert out["Mouse"]["errors"] == ["Price cannot be negative"]
    assert out["Monitor"]["errors"] == ["Customer ID must start with 'C'"]
    assert tuple(records.sales_totals(records.process_sales(df)).first()) == (4, 2, 2, 0.5, 205500.0)


def test_error_classes(spark):
    rows = [("1000", "2", "c001"), ("1000", "2", None), (None, "2", "c1"), ("abc", "2", "c1"), ("1", "2", "77")]
    df = spark.createDataFrame(rows, "p string, q string, c string")
    got = [r[0] for r in df.select(Q.error_class(df, "p", "q", "c")).collect()]
    assert got == ["OK", "Missing field: customer_id", "Missing field: price", "Type error: price", "Attribute error: customer_id"]


def test_column_checks(spark):
    df = spark.createDataFrame(SALES, SCHEMA)
    assert missing_columns(df, ["product", "cost"]) == ["cost"] and missing_columns(df, ["price"]) == []
    assert numeric_columns(df) == ["record_num", "price", "quantity"]
    assert columns_like(df, "ID") == ["customer_id"]


def test_required_columns(spark):
    df = spark.createDataFrame(SALES, SCHEMA)
    got = [tuple(r) for r in required_columns(df, ["product", "cost", "price"]).collect()]
    assert got == [("product", True, df.filter("product is not null").count()), ("cost", False, None), ("price", True, len(SALES))]
    assert required_columns(df.limit(0), ["price"]).first()["filled"] == 0


def test_constraints(spark):
    a = spark.createDataFrame([(1, 10), (1, 20), (2, None), (3, 30)], "id int, ref int")
    b = spark.createDataFrame([(10,), (20,)], "key int")
    assert [tuple(r) for r in Q.key_violations(a, ["id"]).collect()] == [(1, 2)]
    assert [r["ref"] for r in Q.foreign_key_violations(a, "ref", b, "key").collect()] == [30]
    assert Q.not_null_violations(a, "ref").count() == 1


def test_relations_against_single_checks(spark):
    """Missing partners, repeated keys and parts, wrong totals, from one aggregate."""
    parents = spark.createDataFrame([(1, 10, 3.0), (2, 10, 5.0), (2, 11, 5.0), (3, None, 1.0), (4, 99, 0.0), (None, 10, 2.0)], "id int, who int, total double")
    children = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (2, 1, 5.02), (2, 1, 0.0), (3, 1, 1.01), (7, 1, 9.0), (7, 2, 9.0), (None, 1, 4.0)], "id int, line int, amount double")
    people = spark.createDataFrame([(10,), (11,), (12,)], "who int")
    amount = lambda c: F.col(c).cast("decimal(12,2)")
    report = relations([
        Source(parents, [Role("lines", "id", True, amount("total")), Role("people", "who")], {"free": F.col("total") == 0}),
        Source(children, [Role("lines", "id", amount=amount("amount"), part="line")]),
        Source(people, [Role("people", "who", True)], {"none": F.col("who") < 0}),
    ])
    got = {r.relation: tuple(r)[1:] for r in report.collect()}
    # missing_parent, without_children, repeated_keys, repeated_parts, wrong_totals, rows
    assert got == {"lines": (2, 2, 1, 1, 1, 6), "people": (1, 1, 0, 0, 0, 3), "free": (0, 1, 0, 0, 0, 1), "none": (0, 0, 0, 0, 0, 0)}
    wanted = {"a": ("lines", "wrong_totals"), "b": ("none", "rows"), "c": ("lines", "missing_parent")}
    assert dict(map(tuple, picked(report, wanted).collect())) == {"a": 1, "b": 0, "c": 2}


def test_checks_read_each_table_once(spark):
    for name in ("d_dq_suite", "d_constraints"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        for table in ("orders", "lineitem", "customer"):
            assert plan.count(f"{table}.parquet") == 1, (name, table)
