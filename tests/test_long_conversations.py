"""A long conversation's text, page by page."""

import re

from pyspark.sql import functions as F

from textloom.catalog import QUERIES
from textloom.functions import turns as T


def test_text_by_group_is_the_text_of_its_turns(spark):
    rows = [(c, n, r, t) for c in "ab" for n, (r, t) in enumerate([("user", "x"), (None, "y"), ("tool", None), ("user", ""), ("user", "é\nz")] * 7) if (n + ord(c)) % 5]
    df = spark.createDataFrame(rows, "k string, turn long, role string, text string").repartition(5)
    whole = T.turns_by_group(df, "k", "turn", page_turns=4)
    want = whole.select("k", F.size("messages").alias("turns"), T.flatten_turns(T.Typed(F.col("messages"), whole.schema["messages"].dataType)).alias("text"))
    assert sorted(T.text_by_group(df, "k", "turn", page_turns=4).collect()) == sorted(want.collect())


def test_no_list_of_all_turns(spark, data):
    """Turns meet in lists of a page; over a whole conversation only pages' texts are collected."""
    plan = QUERIES["flatten_long"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "flatten(" not in plan and len(re.findall(r"collect_list\(", plan)) == 2
