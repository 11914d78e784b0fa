from liqspark.session import scale_conf


def test_scale_conf_sizes_partitions():
    small = scale_conf(1 << 30)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = scale_conf(100 * (1 << 40))
    assert big["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) // (128 << 20))  # no cap of its own
    assert scale_conf(100 * (1 << 40), max_partitions=50_000)["spark.sql.shuffle.partitions"] == "50000"
    mid = scale_conf(1 << 40)
    assert mid["spark.sql.shuffle.partitions"] == str((1 << 40) // (128 << 20))
    assert mid["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(128 << 20)


def test_session_settings_win_over_defaults(spark):
    from liqspark.session import apply_conf

    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "33554432")
    apply_conf(spark, {key: "134217728"})
    try:
        assert spark.conf.get(key) == "33554432"
    finally:
        spark.conf.unset(key)


def test_checkpoint_folder_must_be_named_on_a_cluster():
    import pytest

    from liqspark.session import ensure_checkpoint_dir, is_local

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    assert not is_local(Cluster)
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Cluster)
