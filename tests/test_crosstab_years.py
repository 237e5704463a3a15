import datetime

import pytest

from textloom.catalog import QUERIES


def orders(spark, at, *years):
    rows = [("1-URGENT", datetime.datetime(y, 3, 4)) for y in years] + [("1-URGENT", None)]
    spark.createDataFrame(rows, "o_orderpriority string, o_orderdate timestamp").write.parquet(f"{at}/orders.parquet")
    return QUERIES["crosstab_wide"](spark, str(at))


def test_years_of_the_table_are_counted(spark, tmp_path):
    row = orders(spark, tmp_path, 1992, 2002, 2002).first()
    assert (row["1992"], row["2002"], row["1999"]) == (1, 2, 0)


def test_a_year_without_a_column_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="no column for the year 2003"):
        orders(spark, tmp_path, 1992, 2003).collect()
