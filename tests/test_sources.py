"""Files, catalog tables, payloads, ingest, workbooks."""

import datetime as dt
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F, types as T

from quayside import session
from quayside.functions import nested as J
from quayside.operators.pairs import every_combination
from quayside.queries.commerce import as_doubles
from quayside.sources import catalog, files, ingest, payloads, workbook
from quayside.functions.numbers import revenue

SALES_SMALL = [
    ("2025-01-01", "Laptop", "Electronics", 75000, 2, "C001", "West"),
    ("2025-01-02", "Mouse", "Electronics", 500, 10, "C002", "East"),
    ("2025-01-03", "Keyboard", "Electronics", 1500, 5, "C003", "North"),
    ("2025-01-04", "Monitor", "Electronics", 25000, 1, "C004", "South"),
    ("2025-01-05", "Headphones", "Electronics", 2000, 4, "C005", "West"),
]
SALES_SCHEMA = "date string, product string, category string, price int, quantity int, customer_id string, region string"
SALES = [  # product, quantity, price
    ("Laptop", 2, 75000), ("Mouse", 5, 500), ("Keyboard", 3, 1500), ("Monitor", 1, 25000), ("Laptop", 1, 75000),
    ("Headphones", 4, 2000), ("Mouse", 10, 500), ("Laptop", 3, 75000), ("Monitor", 2, 25000), ("Keyboard", 5, 1500),
]


def test_csv_roundtrip_and_inference(spark, tmp_path):
    path = str(tmp_path / "sales")
    df = spark.createDataFrame(SALES_SMALL, SALES_SCHEMA)
    files.write_csv(df, path)
    back = files.read_csv(spark, path)
    assert dict(back.dtypes)["price"] == "int" and dict(back.dtypes)["date"] == "date"
    typed = files.read_csv(spark, path, SALES_SCHEMA)
    assert sorted(map(tuple, typed.collect())) == sorted(SALES_SMALL)
    rev = {r["product"]: r["r"] for r in typed.select("product", revenue("price", "quantity").alias("r")).collect()}
    assert rev == {"Laptop": 150000.0, "Mouse": 5000.0, "Keyboard": 7500.0, "Monitor": 25000.0, "Headphones": 8000.0}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_csv(spark, str(tmp_path / "none"))


def test_product_summary_golden(spark):
    df = spark.createDataFrame(SALES, "product string, quantity int, price int")
    out = df.groupBy("product").agg(
        F.sum("quantity").alias("q"), F.sum(F.col("price") * F.col("quantity")).alias("rev"), F.count(F.lit(1)).alias("n")
    ).withColumn("avg", F.col("rev") / F.col("n")).orderBy(F.col("rev").desc())
    assert [tuple(r) for r in out.collect()] == [
        ("Laptop", 6, 450000, 3, 150000.0), ("Monitor", 3, 75000, 2, 37500.0), ("Keyboard", 8, 12000, 2, 6000.0),
        ("Headphones", 4, 8000, 1, 8000.0), ("Mouse", 15, 7500, 2, 3750.0)]


def test_csv_options(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id;name;score;day;extra\n1;Ana;NA;01/02/2024;x\n2;NULL;4.5;bad;y\n3;;x;03/02/2024;z\n", encoding="latin-1")
    out = files.read_csv_advanced(
        spark, str(path), ["id", "name", "score", "day"], {"id": "int", "score": "double"}, {"day": "dd/MM/yyyy"}, sep=";", encoding="ISO-8859-1")
    assert sorted(map(tuple, out.collect())) == [
        (1, "Ana", None, dt.date(2024, 2, 1)), (2, None, 4.5, None), (3, None, None, dt.date(2024, 2, 3))]
    raw = files.read_csv_records(spark, str(path), sep=";")
    assert {t for _, t in raw.dtypes} == {"string"}


def test_special_characters(spark, tmp_path):
    rows = [("José", "São Paulo", 'He said "hi", 😀'), ("Müller", "Köln", "line one\nline two"), ("Asha", "पुणे", "ok; fine")]
    df = spark.createDataFrame(rows, "name string, city string, comment string")
    files.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), df.schema, multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    files.write_jsonl(df, str(tmp_path / "j"))
    assert sorted(map(tuple, files.read_jsonl(spark, str(tmp_path / "j"), df.schema).collect())) == sorted(rows)


PRODUCT = "id int, name string, price int, category string, in_stock boolean, tags array<string>"


def test_json_documents(spark, tmp_path):
    products = [
        {"id": 1, "name": "Laptop", "price": 75000, "category": "Electronics", "in_stock": True, "tags": ["computer", "portable", "work"]},
        {"id": 2, "name": "Mouse", "price": 500, "category": "Electronics", "in_stock": True, "tags": ["computer", "accessory"]},
        {"id": 3, "name": "Keyboard", "price": 1500, "category": "Electronics", "in_stock": False, "tags": ["computer", "accessory", "mechanical"]},
    ]
    (tmp_path / "p.json").write_text(json.dumps(products, indent=2))
    df = files.read_json(spark, str(tmp_path / "p.json"), PRODUCT)
    assert df.count() == 3 and df.select(F.explode("tags").alias("t")).filter("t = 'computer'").count() == 3
    assert [r[0] for r in df.orderBy("id").select(J.joined("tags")).collect()][1] == "computer,accessory"
    first = df.orderBy("id").select(*[c.alias(n) for n, c in J.unpack("tags", ["a", "b", "c"]).items()]).collect()[1]
    assert tuple(first) == ("computer", "accessory", None)
    (tmp_path / "config.json").write_text('{"database": {"host": "h", "port": 1}, "features": {"on": true}}')
    cfg = files.read_json(spark, str(tmp_path / "config.json"))
    assert tuple(cfg.select("database.port", "features.on").first()) == (1, True)


def test_json_lines_skip_malformed(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text(
        '{"timestamp": "2025-01-01T10:00:00", "event": "login", "user_id": "U001"}\n'
        '{"timestamp": "2025-01-01T10:05:00", "event": "purchase", "user_id": "U001", "amount": 1500}\n'
        "not json at all\n"
        '{"timestamp": "2025-01-01T10:10:00", "event": "logout", "user_id": "U001"}\n')
    schema = T.StructType.fromDDL("timestamp string, event string, user_id string, amount int")
    out = files.read_jsonl(spark, str(tmp_path / "e.jsonl"), schema)
    assert sorted((r["event"], r["amount"]) for r in out.collect()) == [("login", None), ("logout", None), ("purchase", 1500)]
    assert [r[0] for r in files.malformed_lines(spark, str(tmp_path / "e.jsonl"), schema).collect()] == ["not json at all"]


def test_format_dispatch_and_listing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    for fmt in files.FORMATS:
        files.write_frame(df, f"file://{tmp_path}/{fmt}", fmt)
        assert sorted(map(tuple, files.read_frame(spark, f"file://{tmp_path}/{fmt}", fmt, df.schema).collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="unsupported"):
        files.read_frame(spark, "x", "xml")
    with pytest.raises(ValueError, match="unsupported"):
        files.write_frame(df, "x", "pickle")
    found = files.list_objects(spark, f"{tmp_path}/parquet")
    assert found.columns == ["path", "size", "modificationTime"] and found.filter("size > 0").count() >= 1


def test_bundle(spark, tmp_path):
    frames = {"a": spark.range(3), "b": spark.range(5)}
    files.write_bundle(frames, str(tmp_path / "bundle"))
    back = files.read_bundle(spark, str(tmp_path / "bundle"), ["a", "b"])
    assert {k: v.count() for k, v in back.items()} == {"a": 3, "b": 5}


def test_catalog_tables(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("price", T.DecimalType(10, 2))])
    spark.sql("DROP TABLE IF EXISTS items")
    assert catalog.create_table(spark, "items", schema) and not catalog.create_table(spark, "items", schema)
    assert catalog.table_exists(spark, "items") and not catalog.table_exists(spark, "nothing_here")
    rows = spark.range(4).select("id", F.lit("1.50").cast("decimal(10,2)").alias("price"))
    catalog.write_table(rows, "items", "append")
    assert catalog.read_table(spark, "items").count() == 4 and catalog.read_table(spark, "items", 2).count() == 2
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        catalog.write_table(rows, "items", "fail")
    catalog.write_table(rows.limit(1), "items", "replace")
    assert catalog.read_table(spark, "items").count() == 1
    with pytest.raises(ValueError):
        catalog.write_table(rows, "items", "sometimes")
    out = catalog.run_sql(spark, "SELECT * FROM items WHERE id >= :low", low=0)
    assert out.count() == 1
    catalog.analyze(spark, "items")
    assert "1 rows" in spark.sql("DESCRIBE EXTENDED items").filter("col_name = 'Statistics'").first()["data_type"]


def test_publish_keeps_old_readers(spark):
    old = spark.range(3)
    assert catalog.publish(old, "daily") == 1
    reading = catalog.read_table(spark, "daily__v1")
    assert catalog.publish(spark.range(10), "daily") == 2
    assert catalog.read_table(spark, "daily").count() == 10 and reading.count() == 3
    assert catalog.publish(spark.range(11), "daily") == 3
    assert catalog.versions(spark, "daily") == [2, 3]
    assert catalog.read_table(spark, "daily").count() == 11


def test_scope_removes_what_it_wrote(spark):
    outer = session.materialise(spark.range(3), "outer")
    with session.scope(spark):
        inner = session.materialise(spark.range(4), "inner")
        with session.scope(spark):
            deeper = session.materialise(spark.range(5), "deeper").inputFiles()[0]
        assert inner.count() == 4 and not os.path.exists(deeper.removeprefix("file://"))
        kept = inner.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(kept)
    assert not os.path.exists(kept) and outer.count() == 3


def test_jdbc_arguments(spark):
    with pytest.raises(ValueError):
        catalog.read_jdbc(spark, "jdbc:x")
    with pytest.raises(ValueError):
        catalog.read_jdbc(spark, "jdbc:x", table="t", partition_column="id")


def test_payloads(spark):
    prices = '{"bitcoin": {"usd": 105097, "usd_24h_change": 1.5, "inr": 9324500, "inr_24h_change": 1.6}, "cardano": {"usd": 0.58, "inr": 51.88}}'
    df = spark.createDataFrame([(prices,)], "body string")
    out = payloads.entity_rows(df, "body", F.lit("2025-01-01").cast("date"))
    got = {r["entity"]: (r["usd"], r["inr"], r["usd_24h_change"]) for r in out.collect()}
    assert got == {"bitcoin": (105097.0, 9324500.0, 1.5), "cardano": (0.58, 51.88, None)}
    people = '[{"name": {"first": "Ann", "last": "Lee"}, "email": "ann@x.com", "location": {"city": "Oslo", "state": "O", "country": "Norway"}}]'
    schema = "array<struct<name:struct<first:string,last:string>,email:string,location:struct<city:string,state:string,country:string>>>"
    df = spark.createDataFrame([(people,)], "b string").select(F.from_json("b", schema).alias("people"))
    assert tuple(payloads.person_rows(df, "people").first()) == ("Ann Lee", "ann@x.com", "Oslo", "O", "Norway")
    w = spark.createDataFrame([('{"current_weather": {"temperature": 21.5, "windspeed": 3.2}, "latitude": 18.5}',)], "b string")
    w = w.select(F.from_json("b", "struct<current_weather:struct<temperature:double,windspeed:double>,latitude:double>").alias("w"))
    assert tuple(payloads.nested_fields(w, "w", {"temp": "current_weather.temperature", "lat": "latitude"}).first()) == (21.5, 18.5)


def test_ingest_isolates_failures(spark, tmp_path):
    def broken(s):
        raise RuntimeError("no network")

    at = F.lit("2025-01-01 00:00:00").cast("timestamp")
    status = ingest.ingest(spark, {
        "good": lambda s: s.range(7), "broken": broken,
        "late": lambda s: s.range(3).select(F.raise_error(F.lit("bad row")).cast("int").alias("x")),
        "empty": lambda s: s.range(0),
    }, str(tmp_path / "run"), "r1", ingested_at=at)
    got = {r["source"]: (r["status"], r["records"]) for r in status.collect()}
    assert got == {"good": ("success", 7), "broken": ("failed", 0), "late": ("failed", 0), "empty": ("success", 0)}
    assert "no network" in status.filter("source = 'broken'").first()["error"]
    saved = spark.read.parquet(str(tmp_path / "run/run_id=r1/good"))
    assert saved.count() == 7 and saved.select("data_source").distinct().first()[0] == "good"
    assert spark.read.json(str(tmp_path / "run/run_id=r1/_results")).count() == 4


def make_workbook(path, sheets):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared, index = [], {}
    with zipfile.ZipFile(path, "w") as z:
        for n, (_, rows) in enumerate(sheets.items(), 1):
            body = ""
            for i, row in enumerate(rows, 1):
                cells = ""
                for letter, v in zip("ABCDEF", row):
                    if v is None:
                        continue
                    if isinstance(v, str):
                        at = index.setdefault(v, len(index))
                        if at == len(shared):
                            shared.append(v)
                        cells += f'<c r="{letter}{i}" t="s"><v>{at}</v></c>'
                    else:
                        cells += f'<c r="{letter}{i}"><v>{v}</v></c>'
                body += f'<row r="{i}">{cells}</row>'
            z.writestr(f"xl/worksheets/sheet{n}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        tags = "".join(f'<sheet name="{s}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets>{tags}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>' for n, _ in enumerate(sheets, 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')


def test_workbooks(spark, tmp_path):
    make_workbook(tmp_path / "a.xlsx", {"Sales": [["product", "price"], ["Laptop", 75000], ["Mouse", None]], "Notes": [["hello"]]})
    make_workbook(tmp_path / "b.xlsx", {"Sales": [["product", "price"], ["Desk", 100.5]]})
    rows = workbook.read_workbooks(spark, str(tmp_path))
    assert rows.groupBy("sheet").count().orderBy("sheet").collect()[1]["count"] == 5
    named = workbook.with_header(workbook.read_workbooks(spark, str(tmp_path), "Sales"), {"A": "product", "B": "price"})
    assert sorted((r["product"], r["price"]) for r in named.collect()) == [("Desk", "100.5"), ("Laptop", "75000"), ("Mouse", None)]


def test_every_combination(spark):
    out = every_combination(spark.range(3), spark.createDataFrame([("x",), ("y",)], "s string"))
    assert sorted(map(tuple, out.collect())) == [(i, s) for i in range(3) for s in "xy"]
    wide = every_combination(spark.range(3), spark.range(20).toDF("j"), packed_rows=10)
    assert sorted(map(tuple, wide.collect())) == [(i, j) for i in range(3) for j in range(20)]


def test_limit_without_order(spark):
    assert spark.range(100).limit(5).count() == 5


def test_as_doubles(spark):
    df = spark.range(1).select(F.lit("1.25").cast("decimal(5,2)").alias("d"), "id")
    assert as_doubles(df).dtypes == [("d", "double"), ("id", "bigint")]
