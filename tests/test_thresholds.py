import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from liqspark.operators import thresholds as th

AS_OF = dt.date(2024, 3, 29)  # a Friday
SCHEMA = T.StructType([T.StructField("partition_date", T.DateType()), T.StructField("source_system", T.StringType()),
                       T.StructField("notional_value", T.DecimalType(18, 2))])


def business_days_before(day, n):
    out, d = [], day
    while len(out) < n:
        d -= dt.timedelta(days=1)
        if d.weekday() < 5:
            out.append(d)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


RULE = th.AggRule("r", "sum(notional_value)", ("source_system",), "notional_value is not null", 3, 60, 20)


def test_trailing_business_dates_skip_weekends_and_today(spark):
    days = [AS_OF - dt.timedelta(days=i) for i in range(0, 15)]
    df = frame(spark, [(d, "L", Decimal(1)) for d in days])
    got = [r.partition_date for r in th.trailing_business_dates(df, AS_OF, 5).orderBy("rnk").collect()]
    assert got == business_days_before(AS_OF, 5)


def test_min_history_19_vs_20(spark):
    for n, flagged in ((19, False), (20, True)):
        hist = [(d, "L", Decimal(100 + (i % 2))) for i, d in enumerate(business_days_before(AS_OF, n))]
        df = frame(spark, hist + [(AS_OF, "L", Decimal(1000))])
        r = th.agg_threshold_metrics(df, AS_OF, [RULE]).collect()[0]
        assert r.hist_n == n and r.is_outlier is flagged


def test_zero_sigma_any_difference_is_outlier(spark):
    hist = [(d, "L", Decimal(100)) for d in business_days_before(AS_OF, 25)]
    r = th.agg_threshold_metrics(frame(spark, hist + [(AS_OF, "L", Decimal(101))]), AS_OF, [RULE]).collect()[0]
    assert r.hist_stddev == 0 and r.zscore is None and r.is_outlier is True
    r2 = th.agg_threshold_metrics(frame(spark, hist + [(AS_OF, "L", Decimal(100))]), AS_OF, [RULE]).collect()[0]
    assert r2.is_outlier is False


def test_empty_current_partition_gives_no_row(spark):
    hist = [(d, "L", Decimal(100)) for d in business_days_before(AS_OF, 25)]
    count_rule = th.AggRule("c", "count(*)", (), "1=1", 4, 60, 20)
    assert th.agg_threshold_metrics(frame(spark, hist), AS_OF, [count_rule, RULE]).count() == 0


def test_group_without_history_has_null_stats_and_null_dims_group_together(spark):
    hist = [(d, "L", Decimal(100)) for d in business_days_before(AS_OF, 3)]
    hist += [(d, None, Decimal(5)) for d in business_days_before(AS_OF, 3)]
    today = [(AS_OF, "NEW", Decimal(1)), (AS_OF, None, Decimal(7)), (AS_OF, None, Decimal(8))]
    rows = {r.dims_json: r for r in th.agg_threshold_metrics(frame(spark, hist + today), AS_OF, [RULE]).collect()}
    assert rows['{"source_system":"NEW"}'].hist_n is None and rows['{"source_system":"NEW"}'].is_outlier is False
    assert rows["{}"].current_value == 15.0 and rows["{}"].hist_n == 3  # null dim: to_json drops the field


def test_lookback_limits_history(spark):
    hist = [(d, "L", Decimal(i)) for i, d in enumerate(business_days_before(AS_OF, 30))]
    rule = th.AggRule("r", "sum(notional_value)", ("source_system",), "1=1", 3, 10, 5)
    r = th.agg_threshold_metrics(frame(spark, hist + [(AS_OF, "L", Decimal(1))]), AS_OF, [rule]).collect()[0]
    assert r.hist_n == 10 and r.hist_mean == 4.5  # the 10 latest days carry values 0..9


def test_all_dates_backfill_equals_single_date_runs(spark):
    days = [AS_OF - dt.timedelta(days=i) for i in range(0, 40)]
    rows = [(d, s, Decimal(100 + (i * 7 + len(s)) % 13)) for i, d in enumerate(days) for s in ("L", "D")]
    df = frame(spark, rows)
    rules = [RULE, th.AggRule("c", "count(*)", (), "1=1", 4, 10, 5)]
    allm = {(r.rule_name, r.dims_json, r.partition_date): r for r in th.agg_threshold_metrics_all_dates(df, rules).collect()}
    for d in (AS_OF, AS_OF - dt.timedelta(days=1), AS_OF - dt.timedelta(days=20)):  # Friday, Thursday, Saturday
        for r in th.agg_threshold_metrics(df, d, rules).collect():
            b = allm[(r.rule_name, r.dims_json, d)]
            assert (b.hist_n, b.current_value, b.is_outlier, b.dq_record_id) == \
                (r.hist_n, r.current_value, r.is_outlier, r.dq_record_id)
            assert (b.hist_mean is None and r.hist_mean is None) or abs(b.hist_mean - r.hist_mean) < 1e-9


def test_metrics_from_stored_daily_values_equal_direct(spark):
    days = [AS_OF - dt.timedelta(days=i) for i in range(0, 40)]
    rows = [(d, s, Decimal(100 + (i * 7 + len(s or "")) % 13)) for i, d in enumerate(days) for s in ("L", "D", None)]
    df = frame(spark, rows)
    rules = [RULE, th.AggRule("c", "count(*)", (), "1=1", 4, 10, 5)]
    daily = th.daily_rule_values(df, rules)
    via_daily = {(r.rule_name, r.dims_json): r for r in th.agg_threshold_metrics_from_daily(daily, df, AS_OF, rules).collect()}
    direct = {(r.rule_name, r.dims_json): r for r in th.agg_threshold_metrics(df, AS_OF, rules).collect()}
    assert via_daily.keys() == direct.keys()
    for k, r in direct.items():
        b = via_daily[k]
        assert (b.hist_n, b.current_value, b.is_outlier, b.dq_record_id) == \
            (r.hist_n, r.current_value, r.is_outlier, r.dq_record_id)
        assert abs(b.hist_mean - r.hist_mean) < 1e-9 and abs(b.hist_stddev - r.hist_stddev) < 1e-6


def same_rules(via_daily, direct):
    key = lambda r: (r.rule_name, r.dims_json or "")
    pick = lambda r: (r.dq_record_id, r.hist_n, r.current_value, r.is_outlier, round(r.hist_mean or 0, 9))
    assert [pick(r) for r in sorted(via_daily, key=key)] == [pick(r) for r in sorted(direct, key=key)]


def test_history_counts_days_without_a_value(spark):
    """Days with rows but a null metric count as history; the mean leaves them out."""
    days = [AS_OF, *business_days_before(AS_OF, 32)]
    df = frame(spark, [(d, "L", Decimal(100 + i) if i == 0 or i > 11 else None) for i, d in enumerate(days)])
    rule = th.AggRule("nulls", "sum(notional_value)", ("source_system",), "1=1", 3, 60, 25)
    direct = th.agg_threshold_metrics(df, AS_OF, [rule]).collect()
    assert [r.hist_n for r in direct] == [32] and abs(direct[0].hist_mean - sum(range(112, 133)) / 21) < 1e-9
    daily = th.daily_rule_values(df, [rule])
    same_rules(th.agg_threshold_metrics_from_daily(daily, df, AS_OF, [rule]).collect(), direct)
    every = [r for r in th.agg_threshold_metrics_all_dates(df, [rule]).collect() if r.partition_date == AS_OF]
    same_rules(every, direct)


def test_changed_and_new_rules_get_their_own_history(spark):
    days = [AS_OF, *business_days_before(AS_OF, 32)]
    df = frame(spark, [(d, s, Decimal(100 + i % 7)) for i, d in enumerate(days) for s in ("L", "D")])
    old = th.AggRule("r", "sum(notional_value)", ("source_system",), "1=1", 3, 60, 20)
    changed = th.AggRule("r", "sum(notional_value) * 10", ("source_system",), "1=1", 3, 60, 20)
    new = th.AggRule("n", "count(*)", (), "1=1", 3, 60, 20)
    daily = th.daily_rule_values(df, [old])
    assert th.missing_daily_values(daily, df, df, AS_OF, [old]) is None
    missing = th.missing_daily_values(daily, df, df, AS_OF, [changed, new])
    daily = daily.unionByName(missing)
    rules = [changed, new]
    got = th.agg_threshold_metrics_from_daily(daily, df, AS_OF, rules).collect()
    same_rules(got, th.agg_threshold_metrics(df, AS_OF, rules).collect())
    assert {r.hist_n for r in got} == {32} and not any(r.is_outlier for r in got)


def test_many_decimals_are_kept(spark):
    df = frame(spark, [(d, "L", Decimal(1)) for d in [AS_OF, *business_days_before(AS_OF, 25)]])
    rule = th.AggRule("tiny", "sum(cast(notional_value as decimal(20,2)) / 3000000000000)", ("source_system",), "1=1", 3, 60, 20)
    direct = th.agg_threshold_metrics(df, AS_OF, [rule]).collect()
    got = th.agg_threshold_metrics_from_daily(th.daily_rule_values(df, [rule]), df, AS_OF, [rule]).collect()
    assert got[0].hist_mean > 0 and abs(got[0].hist_mean / direct[0].hist_mean - 1) < 1e-9


def test_all_dates_of_double_values_with_gaps_and_odd_values(spark):
    import random

    r = random.Random(4)
    days = [AS_OF - dt.timedelta(days=i) for i in range(120)]
    rows = [(d, g, None if r.random() < 0.1 else 1e9 + r.random() * 100) for d in days for g in ("L", "M", None) if r.random() < 0.8]
    rows += [(days[90], "N", float("nan")), *[(d, "N", 5.0) for d in days[:90]]]
    df = spark.createDataFrame(rows, "partition_date date, source_system string, x double")
    rules = [th.AggRule("sum", "sum(x)", ("source_system",), "1=1", 3, n, 2) for n in (1, 7, 60)] + [
        th.AggRule("count", "count(x)", (), "1=1", 3, 20, 2)]
    index = th.business_day_index(df)
    for rule in rules:
        got = {(x.dims_json, x.partition_date): x for x in th.rule_metrics_all_dates(df, rule, index).collect()}
        for day in (days[0], days[3], days[30], days[100], days[119]):
            want = th.agg_threshold_metrics(df, day, [rule]).collect()
            assert {x.dims_json for x in want} == {k for k, d in got if d == day}
            for w in want:
                g = got[w.dims_json, day]
                assert (g.hist_n, g.current_value) == (w.hist_n, w.current_value)
                for c in ("hist_mean", "hist_stddev"):
                    assert g[c] == w[c] or g[c] != g[c] and w[c] != w[c] or abs(g[c] - w[c]) < 1e-6 * max(1, abs(w[c])) ** 0.5, c


def test_sums_of_all_dates_are_exact_decimals(spark):
    day = dt.timedelta(days=1)
    rows = [(AS_OF - i * day, "L", Decimal("99999999999999.99") - Decimal(i) / 100) for i in range(60)]
    df = spark.createDataFrame(rows, "partition_date date, source_system string, notional_value decimal(18,2)")
    rule = th.AggRule("sum", "sum(notional_value)", ("source_system",), "1=1", 3, 40, 2)
    got = {r.partition_date: r for r in th.agg_threshold_metrics_all_dates(df, [rule]).collect()}[AS_OF]
    back = [v for d, _, v in rows if d < AS_OF and d.weekday() < 5][:40]
    mean = sum(back) / len(back)
    assert got.hist_mean == float(sum(back)) / len(back)
    assert abs(got.hist_stddev - float(sum((v - mean) ** 2 for v in back) / (len(back) - 1)) ** 0.5) < 1e-9
    frames = th.agg_threshold_metrics_all_dates(df, [rule])._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding" in frames and "-79" not in frames  # running sums only
