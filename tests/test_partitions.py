"""Results do not depend on how the data is partitioned."""

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["daily_features", "upsample_ffill", "regrid_10_to_15", "mad_outliers", "ecdf", "learning_curve", "permutation_importance", "to_utc"]


@pytest.mark.parametrize("name", NAMES)
def test_partition_count(spark, name):
    def rows(partitions, split_bytes):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        return sorted(map(repr, entry.queries()[name](spark, SF_DIR).collect()))

    try:
        assert rows("3", "128m") == rows("17", "8k")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
