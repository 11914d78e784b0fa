"""Book and market table stored in equal buckets, and the LCR in one pass."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import D0, SF_SMALL, book, market
from liqspark.operators import cashflow as cf
from liqspark.operators import regulatory as reg
from liqspark.operators import risk as rk
from liqspark.plans.models import Lineage
from liqspark.sources import seeds, sinks

D1 = D0 + dt.timedelta(days=1)
SCHEMA = "k string, v int, source_system string, partition_date date"
BY = ("partition_date", "source_system")


def rows(df):
    return sorted(map(str, df.collect()))


def exchanges_below_joins(df):
    """Names of the exchanges under any join of the plan before AQE runs it."""
    found = []

    def walk(n, below):
        kind = n.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(n.initialPlan(), below)
        if below and kind in ("ShuffleExchangeExec", "BroadcastExchangeExec"):
            found.append(kind)
        children = n.children().iterator()
        while children.hasNext():
            walk(children.next(), below or "Join" in kind)

    walk(df._jdf.queryExecution().executedPlan(), False)
    return found


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_joins_of_bucketed_tables_need_no_exchange(spark, tmp_dir, no_broadcast):
    plain = Lineage.from_testdata(spark, SF_SMALL)
    L = Lineage.from_testdata(spark, SF_SMALL, store=f"{tmp_dir}/wh", buckets=4)
    for build in (rk.liquidity_risk, cf.cashflow_forecast):
        df = build(L.mart_positions, L.stg_market_data)
        assert exchanges_below_joins(df) == []
        want = build(plain.mart_positions, plain.stg_market_data)
        assert exchanges_below_joins(want)
        assert rows(df) == rows(want)


def test_a_rerun_replaces_only_its_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")  # a cluster's own setting
    try:
        first = [("a", 1, "x", D0), ("b", 2, "x", D0), (None, 3, "y", D0), ("a", 4, "x", D1), ("c", 5, None, None)]
        sinks.write_bucketed(spark.createDataFrame(first, SCHEMA), path, ["k"], 4, BY)
        sinks.write_bucketed(spark.createDataFrame([("z", 9, "x", D0)], SCHEMA), path, ["k"], 4, BY)
        sinks.write_bucketed(spark.createDataFrame([], SCHEMA), path, ["k"], 4, BY)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    want = [(None, 3), ("a", 4), ("c", 5), ("z", 9)]
    for df in (sinks.read_bucketed(spark, path, 99), sinks.read_table(spark, path)):
        assert sorted((r.k or "", r.v) for r in df.collect()) == sorted((k or "", v) for k, v in want)
    # another session, whose catalog doesn't know the table
    other = spark.newSession()
    spark.sql(f"DROP TABLE {sinks._bucket_table(spark, path)}")
    assert sinks.read_bucketed(other, path, 99).count() == 4


def test_empty_first_write_is_readable(spark, tmp_dir):
    sinks.write_bucketed(spark.createDataFrame([], SCHEMA), f"{tmp_dir}/t", ["k"], 4, BY)
    assert sinks.read_bucketed(spark, f"{tmp_dir}/t").count() == 0


def test_a_hot_bucket_is_left_to_the_exchange(spark, tmp_dir, no_broadcast):
    path = f"{tmp_dir}/t"
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                    F.col("id").cast("int").alias("v"), F.lit("x").alias("source_system"),
                                    F.lit(D0).alias("partition_date"))
    sinks.write_bucketed(df, path, ["k"], 16, BY)
    assert sum(sinks.bucket_bytes(spark, path).values()) > 0 and len(sinks.bucket_bytes(spark, path)) == 16
    joined = lambda share: (lambda t: t.join(t.select("k", F.col("v").alias("w")).groupBy("k").agg(F.max("w")), "k"))(
        sinks.read_bucketed(spark, path, share))
    assert exchanges_below_joins(joined(99)) == [] and exchanges_below_joins(joined(1.5))
    assert rows(joined(99)) == rows(joined(1.5))


def test_other_writers_and_other_layouts_are_refused(spark, tmp_dir):
    path, df = f"{tmp_dir}/t", spark.createDataFrame([("a", 1, "x", D0)], SCHEMA)
    sinks.write_bucketed(df, path, ["k"], 4, BY)
    for write in (lambda: sinks.write_partitioned(df, path, BY), lambda: sinks.replace_day(df, path, D0, BY),
                  lambda: sinks.upsert(spark, df, path, ["k"], BY), lambda: sinks.compact_partition(spark, path, D0),
                  lambda: sinks.write_bucketed(df, path, ["k"], 8, BY),
                  lambda: sinks.write_bucketed(df.withColumn("more", F.lit(1)), path, ["k"], 4, BY)):
        with pytest.raises(ValueError):
            write()
    sinks.write_partitioned(df, f"{tmp_dir}/plain", BY)
    with pytest.raises(ValueError):
        sinks.write_bucketed(df, f"{tmp_dir}/plain", ["k"], 4, BY)
    assert sinks.read_bucketed(spark, path, 99).count() == 1


def both_forms(spark, b, m, classify=reg.default_hqla_type):
    hqla = seeds.load_seed(spark, "seed_hqla_classification")
    return (rows(reg.lcr_one_pass(b, m, hqla, classify)),
            rows(reg.lcr(b, cf.cashflow_forecast(b, m), hqla, classify)))


def test_lcr_in_one_pass_equals_the_two_step_form(spark):
    loans = [dict(portfolio_id=p, instrument_id=f"INS{i}", notional_value=n, position_qty=D(q), partition_date=d)
             for p, d in (("P1", D0), ("P2", D0), ("P1", D1))
             for i, n, q in ((1, D("1000.00"), 5), (2, D("333.33"), -5), (3, D("-70.00"), 2), (4, None, 1))]
    loans += [dict(portfolio_id="NEG", instrument_id="INS1", notional_value=D("-5.00"))]  # no position counts
    b = book(spark, loans, [dict(portfolio_id="P3", instrument_id="INS77", notional_value=D("10.00"))])
    last = b.where("portfolio_id = 'P3'")
    b = (b.unionByName(last.withColumn("portfolio_id", F.lit(None).cast("string")))
         .unionByName(last.withColumn("partition_date", F.lit(None).cast("date"))))
    m = market(spark, [dict(instrument_id=f"INS{i}", partition_date=d, yield_rate=y)
                       for d in (D0, D1) for i, y in ((1, D("0.05")), (2, D("0.03")), (3, None), (1, D("0.02")))])
    classify = reg.hqla_type_by_instrument([r[0] for r in seeds.HQLA_CLASSIFICATION])
    for how in (reg.default_hqla_type, classify):
        one, two = both_forms(spark, b, m, how)
        assert one == two and len(one) == 6
    assert both_forms(spark, b.limit(0), m) == ([], [])
    one, two = both_forms(spark, b, m.limit(0), classify)
    assert one == two and one


def test_lazy_lcr_reads_the_book_once(spark):
    lcr = Lineage.from_testdata(spark, SF_SMALL).rpt_lcr
    book = Lineage.from_testdata(spark, SF_SMALL).mart_positions
    quotes = Lineage.from_testdata(spark, SF_SMALL).stg_market_data
    scans = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("FileScan")
    assert scans(lcr) == scans(book) + scans(quotes)
