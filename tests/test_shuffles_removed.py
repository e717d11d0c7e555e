"""Writes leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from haulgrain.plans.layers import Layers
from haulgrain.session import shuffles_removed
from haulgrain.sources.publish import export_table, write_report

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_by(spark, write):
    """Shuffle files that ``write`` left; they are removed in the background."""
    before = shuffle_files(spark)
    write()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_writes_remove_their_shuffles(spark, tmp_path):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    t = Layers(spark, None, str(tmp_path / "t"))
    before = spark.conf.get(SETTING, None)
    for write in (lambda: t._write("stg_shipments", df), lambda: export_table(df, str(tmp_path / "out")),
                  lambda: write_report(df, str(tmp_path / "report"), ["k", "n"])):
        assert left_by(spark, write) == set()
    assert spark.conf.get(SETTING, None) == before
    assert sorted(map(tuple, spark.read.parquet(t.path("stg_shipments")).collect())) == sorted(map(tuple, df.collect()))


def test_the_setting_is_put_back_after_a_failure(spark):
    before = spark.conf.get(SETTING, None)
    spark.conf.set(SETTING, "false")
    try:
        with shuffles_removed(spark):
            assert spark.conf.get(SETTING) == "true"
            raise ValueError
    except ValueError:
        assert spark.conf.get(SETTING) == "false"
    finally:
        spark.conf.unset(SETTING) if before is None else spark.conf.set(SETTING, before)
