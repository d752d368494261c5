"""The mapping of the benchmark tables to transactions."""

from datetime import datetime
from decimal import Decimal

from conftest import plan_of

from suretygraph.schemas import MONEY
from suretygraph.sources import tables


def lines_of(spark, root, *lines):
    """One order of one customer with lines of (number, quantity, price, tax)."""
    rows = {"customer": [(1, "c", 0, "m")], "orders": [(7, 1, "F", datetime(1998, 5, 6))], "lineitem": [(7, 3, *line) for line in lines]}
    for name, data in rows.items():
        spark.createDataFrame(data, tables.COLUMNS[name]).write.parquet(f"{root}/{name}.parquet")
    return tables.transactions(spark, str(root))


def test_ids_and_amounts_of_every_kind_of_line(spark, tmp_path):
    found = lines_of(
        spark, tmp_path, (1, 1.0, 10.0, 0.05), (2, 2.0, 10.0, 0.05), (3, 3.0, 10.0, 0.05), (4, 4.0, 10.0, 0.05), (5, 5.0, 10.0, 0.05),
        (6, 6.0, 10.005, 0.05), (7, 45.0, 10.25, 0.05), (8, 7.0, None, 0.05), (9, None, 10.0, None), (None, 8.0, 10.0, 0.0))
    assert found.schema["guarantee_amount_usd"].dataType == MONEY and found.schema["fee_amount_usd"].dataType == MONEY
    rows = [(r.transaction_id, r.guarantee_amount_usd, r.fee_amount_usd) for r in found.collect()]
    d = Decimal
    assert sorted(rows, key=str) == sorted([
        ("TX_7_1", None, d("0.50")), ("TX_7_2", d("0.00"), d("0.50")), ("TX_7_3", d("-10.00"), d("0.50")), ("TX_7_4", d("10.00"), None),
        (None, d("10.00"), d("0.50")), ("TX_7_6", d("10.01"), d("-1.00")), ("TX_7_7", d("51.25"), d("0.51")), ("TX_7_8", None, None),
        (None, d("10.00"), None), ("TX_7", d("10.00"), d("0.00"))], key=str)


def test_the_price_is_cast_once(spark, tmp_path):
    assert plan_of(lines_of(spark, tmp_path, (1, 9.0, 10.0, 0.05))).count("cast(l_extendedprice") == 1
