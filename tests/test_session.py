import os
import time

from pyspark.sql import functions as F
from textloom.session import DROPS_SHUFFLES, materialize, scratch_path, scratch_tables, shared_root, write


def test_scratch_tables_go_and_results_stay(spark):
    path = scratch_path(spark, "result")
    before = set(os.listdir(shared_root(spark)))
    with scratch_tables(spark):
        first = materialize(spark.range(10), "first")
        with scratch_tables(spark):
            assert materialize(spark.range(3), "inner").count() == 3
            inner = set(os.listdir(shared_root(spark))) - before
            assert len(inner) == 2
        assert first.count() == 10
        first.write.parquet(path)
    assert set(os.listdir(shared_root(spark))) - before == {path.split("/")[-2]}
    assert spark.read.parquet(path).count() == 10
    assert materialize(spark.range(2), "outside").count() == 2


def test_shuffle_files_go_with_the_write(spark):
    """A later step does not find the disk full of what earlier ones have shuffled."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    kept = spark.conf.get(DROPS_SHUFFLES)
    before = files()
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    path = scratch_path(spark, "counts")
    write(counts, path)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(DROPS_SHUFFLES) == kept
    assert spark.read.parquet(path).count() == 7
    counts.write.parquet(scratch_path(spark, "counts"))
    assert files() - before
