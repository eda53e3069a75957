"""CSV loading and the shared folder."""

import pytest
from pyspark.sql import functions as F

from ordertide.operators import checks
from ordertide.schema import RAW_ORDERS
from ordertide.sources.orders import load_csv
from ordertide.sources.scratch import settle, shared_folder
from ordertide.sources.tables import Table
from tests.fixtures import A, as_set, raw_orders

HEADER = "order_id,customer_id,order_date,amount,status,country\n"


def csv(tmp_path, text):
    path = tmp_path / "orders.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_load(spark, tmp_path):
    lines = [",".join(map(str, row)) for row in A]
    rows = load_csv(spark, csv(tmp_path, HEADER + "\n".join(lines) + "\n"))
    assert rows.schema.simpleString() == RAW_ORDERS.simpleString()
    assert as_set(rows) == as_set(raw_orders(spark, A))
    table = Table(spark, str(tmp_path / "raw"))
    assert table.replace(rows) == 5
    assert table.replace(rows.limit(2)) == 2                     # a reload starts from nothing
    assert table.read().count() == 2


def test_columns_are_found_by_name(spark, tmp_path):
    text = "country,extra,amount,order_id,status,order_date,customer_id\nFR,x,1.5,7,completed,2025-01-01,Zoé\n"
    rows = load_csv(spark, csv(tmp_path, text))
    assert [tuple(r) for r in rows.collect()] == [(7, "Zoé", rows.first()["order_date"], 1.5, "completed", "FR")]


def test_quotes_and_empty_text(spark, tmp_path):
    text = HEADER + '1,"a ""b"", c",2025-01-01,1e2,,"F,R"\n'
    assert as_set(load_csv(spark, csv(tmp_path, text)), "customer_id", "amount", "status", "country") == {
        ('a "b", c', 100.0, "", "F,R")}


@pytest.mark.parametrize("line", [
    "x,C,2025-01-01,1.0,completed,FR", "1.5,C,2025-01-01,1.0,completed,FR",
    ",C,2025-01-01,1.0,completed,FR", "1,C,2025-01-01,ten,completed,FR",
    "1,C,2025-01-01,,completed,FR", "1,C,someday,1.0,completed,FR",
    "1,C,2024,1.0,completed,FR", "1,C,2024-01-05 xyz,1.0,completed,FR", "1,C,2024-01,1.0,completed,FR",
    "1,C,2025-01-01,12d,completed,FR", "1,C,2025-01-01,0x1p3,completed,FR", "1,C,2025-02-30,1.0,completed,FR",
    "9223372036854775808,C,2025-01-01,1.0,completed,FR",
])
def test_bad_values_fail_the_load(spark, tmp_path, line):
    rows = load_csv(spark, csv(tmp_path, HEADER + line + "\n"))
    with pytest.raises(Exception, match="raw orders: bad"):
        rows.collect()


def test_large_ids_special_amounts_and_line_breaks(spark, tmp_path):
    text = HEADER + '3000000000,"a\nb",2025-1-05, +1.5e3 ,completed,FR\n-1,C,2025-01-01,NaN,,FR\n2,C,2025-01-01,-inf,,FR\n'
    rows = load_csv(spark, csv(tmp_path, text), multiline=True).collect()
    assert [(r.order_id, r.customer_id, str(r.order_date)) for r in rows] == [
        (3_000_000_000, "a\nb", "2025-01-05"), (-1, "C", "2025-01-01"), (2, "C", "2025-01-01")]
    assert rows[0].amount == 1500.0 and rows[1].amount != rows[1].amount and rows[2].amount == -float("inf")


def test_files_with_another_header_fail_the_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,C,2025-01-01,1.0,completed,FR\n" * 50)
    (tmp_path / "b.csv").write_text("customer_id,order_id,order_date,amount,status,country\n9,2,2025-01-01,1,x,FR\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, str(tmp_path)).collect()


def test_missing_column_fails_the_load(spark, tmp_path):
    with pytest.raises(Exception, match="country"):
        load_csv(spark, csv(tmp_path, "order_id,customer_id,order_date,amount,status\n1,C,2025-01-01,1,x\n"))


def test_settled_rows_live_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    rows = settle(spark.range(10).withColumn("v", F.lit(None).cast("date")))
    assert rows.count() == 10 and rows.dtypes == [("id", "bigint"), ("v", "date")]
    assert all(folder in f for f in rows.inputFiles())


def test_column_types(spark):
    found = checks.column_types(raw_orders(spark, A), {"order_date": "date", "amount": "date", "nothing": "int"})
    assert as_set(found) == {("order_date", "date", "date", 0), ("amount", "date", "double", 5),
                             ("nothing", "int", None, 5)}
