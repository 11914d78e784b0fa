import datetime as dt
import hashlib

from pyspark.sql import functions as F

from liqspark.operators import checks as ck
from liqspark.operators import publish as pub

D = dt.date(2024, 3, 29)


def df(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0, D), (2, "a", None, D), (3, "z", -1.0, D - dt.timedelta(days=5)), (None, None, 2.0, D)],
        "id int, k string, v double, partition_date date")


def test_row_checks(spark):
    t = df(spark)
    assert ck.not_null(t, "v").count() == 1
    assert [tuple(r) for r in ck.unique(t, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in ck.accepted_values(t, "k", ["a"]).collect()] == [("z", 1)]
    assert ck.between(t, "v", 0, 4).count() == 2  # -1 and 5; null passes
    assert ck.between(t, "v", min_value=0).count() == 1
    assert ck.positive_when_not_null(t, "v").count() == 1
    assert ck.expression_is_true(t, "v > 0", "k = 'a'").count() == 0
    assert ck.row_count_between(t, 1, 3).collect()[0].row_count == 4


def test_relationships_and_recency(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "pid string")
    parent = spark.createDataFrame([("a",)], "portfolio_id string")
    assert [r.from_field for r in ck.relationships(child, "pid", parent, "portfolio_id").collect()] == ["b"]
    t = df(spark)
    assert ck.recency(t, "partition_date", 2, dt.datetime(2024, 3, 30)).count() == 0
    assert ck.recency(t, "partition_date", 2, dt.datetime(2024, 4, 1)).count() == 1


def test_freshness_levels(spark):
    t = spark.createDataFrame([(dt.datetime(2024, 3, 29, 0, 0),)], "_ingestion_ts timestamp")
    status = lambda h: ck.freshness(t, "_ingestion_ts", dt.datetime(2024, 3, 29) + dt.timedelta(hours=h)) \
        .collect()[0].status
    assert (status(1), status(30), status(50)) == ("pass", "warn", "error")


def test_both_sources(spark):
    book = spark.createDataFrame([(D, "LOANS"), (D - dt.timedelta(days=1), "LOANS"),
                                  (D - dt.timedelta(days=1), "DEPOSITS")],
                                 "partition_date date, source_system string")
    assert [r.missing_source_system for r in ck.both_sources(book, D).collect()] == ["DEPOSITS"]
    rows = ck.both_sources(book).collect()
    assert [(r.partition_date, r.missing_source_system) for r in rows] == [(D, "DEPOSITS")]


def test_run_checks_fuses_row_checks_and_statuses(spark):
    t = df(spark)
    checks = [ck.row_check("nn_v", "t", t, F.col("v").isNull()),
              ck.row_check("nn_id", "t", t, F.col("id").isNull(), "error"),
              ck.row_check("nn_k", "t", t, F.col("k").isNull() & F.lit(False)),
              ck.Check("uniq_k", "t", ck.unique(t, "k"), "error")]
    res = {r.check_id: r for r in ck.run_checks(spark, checks).collect()}
    assert (res["nn_v"].failures, res["nn_v"].status) == (1, "warn")
    assert res["nn_id"].status == "fail" and res["nn_k"].status == "pass" and res["uniq_k"].failures == 1
    s = pub.dq_summary(ck.run_checks(spark, checks)).collect()[0]
    assert (s.total_tests, s.passed, s.failed, s.warned) == (4, 1, 2, 1)


def test_rule_event_ids(spark):
    m = spark.createDataFrame([("rule one", '{"a":"x"}', D, True)],
                              "rule_name string, dims_json string, partition_date date, is_outlier boolean")
    for c in pub.NATIVE_FIELDS:
        m = m.withColumn(c, F.lit(None).cast("string"))
    e = pub.rule_events(m, "run1", D).collect()[0]
    h = hashlib.sha1(b'{"a":"x"}').hexdigest()[:12]
    assert e.assertion_id == f"dq_rule_one__{h}" and e.run_id == f"run1::dq::rule one::{h}"
    assert e.result_type == "FAILURE"


def test_check_messages_and_event_file(spark, tmp_dir):
    t = df(spark)
    res = ck.run_checks(spark, [ck.row_check("nn_v", "t", t, F.col("v").isNull()),
                                ck.row_check("nn_k", "t", t, F.lit(False))])
    msgs = {r.check_id: r.message for r in res.collect()}
    assert msgs == {"nn_v": "Got 1 result, configured to warn if != 0", "nn_k": None}
    ev = pub.check_events(res, "run1", D)
    pub.write_events(ev, tmp_dir + "/events")
    back = spark.read.json(tmp_dir + "/events")
    assert back.count() == 2 and set(r.result_type for r in back.collect()) == {"SUCCESS", "FAILURE"}


def test_seed_from_csv_matches_builtin(spark, tmp_dir):
    from liqspark.sources import seeds

    name = "seed_fr2052a_product_mapping"
    builtin = seeds.load_seed(spark, name)
    builtin.coalesce(1).write.option("header", True).csv(tmp_dir + "/seed")
    from_csv = seeds.load_seed(spark, name, tmp_dir + "/seed")
    assert from_csv.schema == builtin.schema
    assert sorted(map(tuple, from_csv.collect())) == sorted(map(tuple, builtin.collect()))
