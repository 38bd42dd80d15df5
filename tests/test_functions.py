"""Unit cases of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.functions import dates as D, nested as J, numbers as N, rules as R, text as X


def one(spark, **cols):
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first().asDict()
    return row if len(row) > 1 else next(iter(row.values()))


def each(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


L = F.lit


@pytest.mark.parametrize("price,qty,want", [(100.0, 10, 1000.0), (50.5, 20, 1010.0), (0.0, 10, 0.0), (100.0, 0, 0.0)])
def test_revenue(spark, price, qty, want):
    assert one(spark, r=N.revenue(L(price), L(qty))) == want


def test_profit_margin_roi(spark):
    assert one(spark, a=N.profit(L(1000), L(600)), b=N.profit(L(500), L(300))) == {"a": 400.0, "b": 200.0}
    assert one(spark, a=N.profit_margin(L(1000), L(600)), b=N.profit_margin(L(500), L(400)), c=N.profit_margin(L(0), L(100))) == {
        "a": 0.4, "b": 0.2, "c": 0.0}
    assert one(spark, a=N.roi(L(100.0), L(150.0)), b=N.roi(L(0.0), L(5.0))) == {"a": 50.0, "b": 0.0}


@pytest.mark.parametrize("price,pct,want", [(1000.0, 10, (900.0, 100.0)), (500.0, 20, (400.0, 100.0)), (1000.0, 50, (500.0, 500.0))])
def test_discount(spark, price, pct, want):
    assert tuple(one(spark, d=N.discount(L(price), L(pct)))) == want


def test_tax(spark):
    assert tuple(one(spark, d=N.tax(L(100.0), L(0.25)))) == (125.0, 25.0)


def test_growth(spark):
    got = one(spark, a=N.growth_rate(L(100), L(150)), b=N.growth_rate(L(100), L(80)), c=N.growth_rate(L(100), L(100)),
              d=N.growth_rate(L(0), L(0)), e=N.growth_rate(L(0), L(5)))
    assert got == {"a": 50.0, "b": -20.0, "c": 0.0, "d": 0.0, "e": float("inf")}


def test_metrics(spark):
    df = spark.createDataFrame([(float(x),) for x in (10, 20, 30, 40, 50)], "v double")
    assert tuple(df.agg(*N.metrics("v")).first()) == (150.0, 30.0, 10.0, 50.0, 5)
    assert tuple(df.limit(0).agg(*N.metrics("v")).first()) == (0.0, 0.0, 0.0, 0.0, 0)


def test_skewness_is_bias_corrected(spark):
    values = [1.0, 2.0, 2.5, 9.0, 4.0, 30.0]
    import pandas as pd

    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(N.skewness("v")).first()[0] == pytest.approx(pd.Series(values).skew())
    assert df.limit(2).agg(N.skewness("v")).first()[0] is None


def test_amounts_and_booleans(spark):
    got = each(spark, ["1200000", "1.5M", "800K", "₹1,20,000", "unknown", None, "  ₹95,000 "], N.parse_amount)
    assert got == [1200000.0, 1500000.0, 800000.0, 120000.0, None, None, 95000.0]
    assert each(spark, ["Yes", "No", "True", "1", "0", "maybe", None], N.parse_bool) == [True, False, True, True, False, None, None]
    assert each(spark, ["28", "unknown", "4.5", "N/A"], N.to_number) == [28.0, None, 4.5, None]


def test_bins_are_right_closed(spark):
    band = lambda c: N.bins(c, [0, 25, 35, 45, 100], ["Young", "Adult", "Middle-aged", "Senior"])
    assert each(spark, [0, 1, 25, 26, 35, 100, 101, None], band, "int") == [
        None, "Young", "Young", "Adult", "Adult", "Senior", None, None]


def test_number_text(spark):
    got = one(spark, a=N.format_currency(L(1234567.891)), b=N.format_number(L(1234.5)), c=N.format_percentage(L(0.256)),
              d=N.format_percentage(L(25.6)), e=N.format_file_size(L(1536)), f=N.format_file_size(L(5)), g=N.format_percentage(L(1)))
    assert got == {"a": "₹1,234,567.89", "b": f"{1234.5:,.0f}", "c": "25.6%", "d": "25.6%", "e": "1.50 KB", "f": "5.00 B", "g": "100.0%"}


def test_durations_and_dates(spark):
    got = one(spark, a=D.format_duration(L(45.678)), b=D.format_duration(L(90)), c=D.format_duration(L(7200)),
              d=D.format_date(L("2025-01-05").cast("date")))
    assert got == {"a": "45.68 seconds", "b": "1.50 minutes", "c": "2.00 hours", "d": "2025-01-05"}
    got = each(spark, ["2023-01-15", "15/02/2023", "2023.03.20", "2023-04-25", "Apr 30, 2023", "2023/05/06", "soon", None], D.parse_date)
    assert got == [dt.date(2023, 1, 15), dt.date(2023, 2, 15), dt.date(2023, 3, 20), dt.date(2023, 4, 25), dt.date(2023, 4, 30),
                   dt.date(2023, 5, 6), None, None]
    assert each(spark, ["2025-01-15", "2025-13-01", "x", None], D.is_valid_date) == [True, False, False, False]


def test_ages(spark):
    day = lambda s: L(s).cast("date")
    got = one(spark, a=D.age_years(day("2025-03-01"), day("2020-03-02")), b=D.age_month_part(day("2025-03-01"), day("2020-03-02")),
              c=D.months_since(day("2025-03-01"), day("2023-01-01")), d=D.months_since(day("2025-03-01"), day("2023-01-01"), True),
              e=D.day_of_week(day("2025-01-05")), f=D.season(day("2025-10-05")))
    assert got == {"a": 4, "b": 11, "c": 26, "d": 2, "e": 0, "f": "Autumn"}


NAMES = ["  asha   rao ", "o'neil-smith", "RAHUL sharma 3rd", "élan straße", "", None, "ß"]


def test_names_match_title_case(spark):
    want = [None if n is None else " ".join(n.split()).title() for n in NAMES]
    assert each(spark, NAMES, X.clean_name) == want
    assert each(spark, NAMES, lambda c: X.first_word(X.clean_name(c))) == [
        None if w is None else (w.split() or [None])[0] for w in want]
    assert each(spark, NAMES, lambda c: X.last_word(X.clean_name(c))) == [
        None if w is None else (w.split() or [None])[-1] for w in want]


def test_emails_and_phones(spark):
    assert each(spark, [" A@X.com\n", None], X.clean_email) == ["a@x.com", None]
    assert each(spark, ["a@x.com", "none"], X.email_domain) == ["x.com", None]
    phones = ["+91-9876543210", "98765 43210", "(987) 654-3210", "12345", None, "919876543210", "9198765432"]
    assert each(spark, phones, X.clean_phone) == ["9876543210", "9876543210", "9876543210", None, None, "9876543210", "9198765432"]
    assert each(spark, ["9876543210", None], X.show_phone) == ["+91 98765 43210", None]
    assert each(spark, ["98765-43210", "123"], X.format_phone) == ["+91 98765 43210", "123"]


def test_comments_and_addresses(spark):
    texts = ["great product!!!  😀 loved it...", "ok", "", None, "wait?! really", "a—b “c”"]
    assert each(spark, texts, X.clean_comment) == ["Great product! loved it.", "Ok", "", None, "Wait! really", "Ab c"]
    assert each(spark, ["12 main  st, pune, india", "nowhere"], lambda c: X.address_city(X.clean_address(c))) == ["Pune", None]
    assert each(spark, ['Laptop (15")', "Keyboard & Mouse Combo", "Headphones [Noise]"], X.strip_special) == [
        "Laptop 15", "Keyboard Mouse Combo", "Headphones Noise"]
    assert each(spark, ["  a b  c ", "", None], X.word_count) == [3, 0, None]


def test_padding_and_ids(spark):
    assert each(spark, ["123", "12345678901", None], X.zero_pad) == ["0000000123", "12345678901", None]
    assert each(spark, [" c001 ", "C2"], X.clean_id) == ["C001", "C2"]


def test_nested(spark):
    got = one(spark, a=J.lookup(L("b"), {"a": 1, "b": 2}), b=J.lookup(L("z"), {"a": 1}),
              c=F.size(J.json_records(L('{"k": 1}'), "struct<k:int>")), d=F.size(J.json_records(L('[{"k": 1}, {"k": 2}]'), "struct<k:int>")))
    assert got == {"a": 2, "b": None, "c": 1, "d": 2}
    m = one(spark, m=J.with_entry(J.zip_to_map(F.array(L("a"), L("b")), F.array(L(1), L(2))), "a", L(9)))
    assert m == {"a": 9, "b": 2}


def verdicts(spark, values, rule):
    return [tuple(r) for r in each(spark, values, rule)]


def test_email_and_phone_rules(spark):
    good = ["asha@example.com", "first.last@firm.co.in", "root@two-words.com", "agent007@example.org"]
    bad = ["plain", "user@host", "@nothing.com", "two words@mail.com", "", None]
    assert [v[0] for v in verdicts(spark, good + bad, R.email)] == [True] * 4 + [False] * 6
    good = ["9123456780", "8123456780", "7123456780", "6123456780"]
    bad = ["456", "98765", "1123456780", "5123456780", "", None]
    assert [v[0] for v in verdicts(spark, good + bad, R.phone)] == [True] * 4 + [False] * 6
    assert verdicts(spark, ["98765 432-10"], R.phone)[0][0]


def test_price_rules(spark):
    assert verdicts(spark, ["100", "1000.50", "0"], R.price) == [(True, None)] * 3
    assert verdicts(spark, ["-100", "x", None], R.price) == [
        (False, "Price cannot be negative"), (False, "Invalid price format"), (False, "Invalid price format")]
    assert not verdicts(spark, ["50"], lambda c: R.price(c, low=100))[0][0]
    assert not verdicts(spark, ["1000"], lambda c: R.price(c, high=500))[0][0]


def test_other_rules(spark):
    assert [v[0] for v in verdicts(spark, ["C007", "C4321", "C888888", " c0012 "], R.customer_id)] == [True] * 4
    assert [v[0] for v in verdicts(spark, ["X007", "C", "C77B", "", None], R.customer_id)] == [False] * 5
    assert verdicts(spark, ["0", "10001", "5", "x"], R.quantity) == [
        (False, "Quantity below minimum: 1"), (False, "Quantity above maximum: 10000"), (True, None), (False, "Invalid quantity format")]
    assert [v[0] for v in verdicts(spark, ["North", "Center", None], R.region)] == [True, False, False]
    assert [v[0] for v in verdicts(spark, ["2025-01-15", "15/01/2025", None], R.date)] == [True, False, False]
