from __future__ import annotations

from daystrata.settings import MB, cluster_conf


def test_partitions_follow_the_input():
    small, large = cluster_conf(10 * MB, 8), cluster_conf(100 * 10**12, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert cluster_conf(10**12, 8)["spark.sql.shuffle.partitions"] == "3726"
    assert large["spark.sql.shuffle.partitions"] == "50000"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * MB)
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 954 * MB


def test_settings_are_known_to_spark(spark):
    for name in cluster_conf(10**12, 100):
        assert spark.conf.get(name) is not None
