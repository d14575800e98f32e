from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feedwright.operators import build
from feedwright.schemas import TABLES, required_columns
from feedwright.sources import contracts, csv, tables

from helpers import JOB_FAILURES, SPEC, plan, table, tuples

CUSTOMERS = "customer_id,email,hashed_email,zip_code,opt_out_flag,created_date"


def write(path, *lines, end="\n"):
    path.write_bytes((end.join(lines) + end).encode())
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_declared_types(spark, tmp_path, end):
    path = write(tmp_path / "c.csv", CUSTOMERS, "C1,a@b.com,,02108,0,2024-01-18", 'C2,"","h",,1,', end=end)
    df = csv.read_table(spark, "customers", path)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TABLES["customers"]]
    first, second = df.collect()
    assert tuple(first) == ("C1", "a@b.com", None, "02108", 0, date(2024, 1, 18))
    assert second["email"] in (None, "") and second["created_date"] is None


def test_every_table_reads(spark, tmp_path):
    lines = {
        "events": ("event_id,customer_id,event_type,event_date,product_id,session_id", "E1,,purchase,2026-01-02,P1,S1"),
        "products": ("product_id,product_name,category,price,premium_flag", 'P1,"Cream, rich ""new""",Skincare,9.50,1'),
        "orders": ("order_id,customer_id,order_date,order_value,product_id", "O1,C1,2026-01-02,10.00,P1"),
    }
    rows = {n: csv.read_table(spark, n, write(tmp_path / f"{n}.csv", *text)).first() for n, text in lines.items()}
    assert tuple(rows["events"]) == ("E1", None, "purchase", date(2026, 1, 2), "P1", "S1")
    assert tuple(rows["products"]) == ("P1", 'Cream, rich "new"', "Skincare", Decimal("9.50"), 1)
    assert tuple(rows["orders"]) == ("O1", "C1", date(2026, 1, 2), Decimal("10.00"), "P1")


def test_columns_are_matched_by_name(spark, tmp_path):
    path = write(tmp_path / "c.csv", "zip_code,customer_id,created_date,hashed_email,email,opt_out_flag", "02108,C1,2024-01-18,h,e,1")
    assert tuples(csv.read_table(spark, "customers", path)) == [("C1", "e", "h", "02108", 1, date(2024, 1, 18))]


def test_default_of_an_absent_flag(spark, tmp_path):
    path = write(tmp_path / "c.csv", "customer_id,email,hashed_email,zip_code,created_date", "C1,e,h,1,2024-01-18")
    assert csv.read_table(spark, "customers", path).first()["opt_out_flag"] == 0
    # A null in a present column is no default.
    path = write(tmp_path / "d.csv", CUSTOMERS, "C1,e,h,1,,2024-01-18")
    assert csv.read_table(spark, "customers", path).first()["opt_out_flag"] is None


@pytest.mark.parametrize("header", [CUSTOMERS + ",age", CUSTOMERS.replace("email,", "", 1)])
def test_other_headers_are_refused(spark, tmp_path, header):
    path = write(tmp_path / "c.csv", header, ",".join("1" for _ in header.split(",")))
    with pytest.raises(ValueError, match="columns"):
        csv.read_table(spark, "customers", path)


def test_files_with_differing_headers_are_refused(spark, tmp_path):
    write(tmp_path / "1.csv", CUSTOMERS, "C1,e,h,1,0,2024-01-18")
    write(tmp_path / "2.csv", CUSTOMERS.replace("email,hashed_email", "hashed_email,email"), "C1,h,e,1,0,2024-01-18")
    with pytest.raises(JOB_FAILURES):
        csv.read_table(spark, "customers", str(tmp_path)).collect()


@pytest.mark.parametrize("row", ["C1,e,h,1,0,2024-13-01", "C1,e,h,1,zero,2024-01-18", "C1,e,h"])
def test_bad_values_fail_the_load(spark, tmp_path, row):
    path = write(tmp_path / "c.csv", CUSTOMERS, row)
    with pytest.raises(JOB_FAILURES):
        csv.read_table(spark, "customers", path).collect()


def test_line_break_in_quotes(spark, tmp_path):
    path = write(tmp_path / "c.csv", CUSTOMERS, 'C1,"a\nb",h,1,0,2024-01-18')
    assert csv.read_table(spark, "customers", path, multiline=True).first()["email"] == "a\nb"
    with pytest.raises(JOB_FAILURES):
        csv.read_table(spark, "customers", path).collect()


def test_round_trip_keeps_every_value(spark, tmp_path):
    values = ["plain", " padded ", "a,b", 'say "x"', "back\\slash", "\\", "é　", "02108", None]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "i string, v string").repartition(3)
    csv.write_csv(df, str(tmp_path / "out"))
    back = csv.read_text(spark, str(tmp_path / "out"))
    assert [row["v"] for row in back.orderBy("i").collect()] == values
    csv.write_csv(spark.createDataFrame([("1", "")], "i string, v string"), str(tmp_path / "out"))
    lines = {line for p in (tmp_path / "out").glob("*.csv") for line in p.read_text().splitlines()}
    assert lines == {"i,v", "1,"}


def test_missing_path(spark, tmp_path):
    with pytest.raises(JOB_FAILURES) as error:
        csv.read_text(spark, str(tmp_path / "nowhere"))
    assert csv.is_missing_path(error.value)


def test_mandatory_columns():
    assert {name: required_columns(schema) for name, schema in TABLES.items()} == {
        "customers": ["customer_id", "opt_out_flag"],
        "events": ["event_id", "event_type", "event_date"],
        "products": ["product_id", "product_name", "category", "price", "premium_flag"],
        "orders": ["order_id", "order_date", "order_value"],
    }


def test_contract(spark):
    events = table(
        spark,
        "events",
        [{"customer_id": None}, {"event_type": None, "event_date": None}, {"event_type": None}, {"event_id": ""}],
    )
    assert tuples(contracts.contract_violations(events, "events")) == [
        ("events", "event_id", 0), ("events", "event_type", 2), ("events", "event_date", 1),
    ]
    kept, rejected = contracts.split_by_contract(events, "events")
    assert kept.count() == 2
    assert sorted(row["violations"] for row in rejected.collect()) == ["event_type", "event_type;event_date"]
    assert sorted(tuples(contracts.enforce_contract(kept, "events")), key=repr) == sorted(tuples(kept), key=repr)
    with pytest.raises(JOB_FAILURES, match="events.event_type is null"):
        contracts.enforce_contract(events, "events").collect()


def test_store_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.store(spark.range(10), path)
    assert sorted(tuples(tables.store(spark.range(3), path))) == [(0,), (1,), (2,)]


def test_store_by_date_prunes(spark, tmp_path):
    day = F.when(F.col("id") % 3 < 2, F.lit(date(2026, 1, 1))).otherwise(F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") % 5).cast("int")))
    events = spark.range(0, 3000, numPartitions=12).select(F.col("id").cast("string").alias("event_id"), day.alias("event_date"), "id")
    stored = tables.store(events, str(tmp_path / "e"), "event_date")
    assert stored.columns == events.columns and stored.dtypes == events.dtypes
    assert sorted(tuples(stored)) == sorted(tuples(events))
    files = list((tmp_path / "e").rglob("*.parquet"))
    assert len(files) < 12 * 5
    window = stored.filter(F.col("event_date") >= F.lit(date(2026, 1, 4)))
    assert "PartitionFilters: [isnotnull(event_date" in plan(window)


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    events = spark.range(0, 300_000, numPartitions=16).select(
        F.col("id").cast("string").alias("event_id"), F.lit(date(2026, 1, 1)).alias("event_date")
    )
    spark.conf.set(key, "100k")
    try:
        stored = tables.store(events, str(tmp_path / "e"), "event_date")
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "e").rglob("*.parquet"))) > 3
    assert stored.count() == 300_000


def test_views(spark):
    sources = build.Sources(
        customers=table(spark, "customers", [{"customer_id": "C1", "email": "a@b.com"}]),
        events=table(spark, "events", [{"customer_id": "C1"}, {"customer_id": "C2"}]),
        products=table(spark, "products", [{"product_id": "P1"}]),
        orders=table(spark, "orders", [{"customer_id": "C1"}]),
    )
    tables.register_views(sources, build.build(sources, SPEC), SPEC)
    counts = {
        name: spark.table(name).count()
        for name in (
            "customers", "events", "products", "orders", "deduped_customers", "category_events",
            "customer_engagement", "customer_orders", "audience_feed",
        )
    }
    assert counts == {
        "customers": 1, "events": 2, "products": 1, "orders": 1, "deduped_customers": 1, "category_events": 2,
        "customer_engagement": 2, "customer_orders": 1, "audience_feed": 1,
    }
    found = spark.sql("SELECT customer_id FROM audience_feed ORDER BY engagement_score DESC LIMIT 20")
    assert tuples(found) == [("C1",)]


def test_work_folder_is_the_configured_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = tables.work_folder(spark), tables.work_folder(spark)
    assert one.startswith(shared) and two.startswith(shared) and one != two
