"""Scans are dealt over all cores by the rows of their splits."""

import pyarrow as pa
import pyarrow.parquet as pq

from haulgrain.sources import scans


def test_a_file_whose_rows_lie_in_one_row_group_is_dealt_however_many_splits_it_has(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    table = pa.table({"k": list(range(40_000)), "v": [f"value {i * 7919 % 40_009}" for i in range(40_000)]})
    pq.write_table(table, tmp_path / "one.parquet", row_group_size=40_000)
    pq.write_table(table, tmp_path / "even.parquet", row_group_size=40_000 // (2 * cores))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        one, even = (spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in ("one", "even"))
        assert one.rdd.getNumPartitions() > cores and even.rdd.getNumPartitions() > cores
        dealt, left = scans.spread(one), scans.spread(even)
        assert max(len(p) for p in dealt.rdd.glom().collect()) < 40_000 / cores * 1.2
        assert dealt.count() == 40_000 and dealt.select("k").distinct().count() == 40_000
        assert left is even
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fullest_core():
    assert scans.fullest([], 4) == 0
    assert scans.fullest([5, 5, 5, 5], 4) == 1
    assert scans.fullest([10, 0, 0, 0, 0], 4) == 4
    assert scans.fullest([3, 3, 2, 2, 2], 2) == 7 / 6
