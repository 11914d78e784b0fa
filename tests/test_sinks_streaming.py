import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import D0, positions
from liqspark.operators.staging import stage_positions
from liqspark.schemas import POSITION_KEYS, RAW_POSITIONS_SCHEMA
from liqspark.sources import sinks
from liqspark.streaming.ingest import batch_merger, ingest_available, merge_available


def test_upsert_replaces_by_key_and_is_idempotent(spark, tmp_dir):
    path = tmp_dir + "/t"
    v1 = stage_positions(positions(spark, [dict(instrument_id=f"INS{i}") for i in range(5)]))
    sinks.upsert(spark, v1, path, ["position_id"])
    v2 = stage_positions(positions(spark, [dict(instrument_id="INS1", notional_value=Decimal("7.00")),
                                           dict(instrument_id="INS9")]))
    sinks.upsert(spark, v2, path, ["position_id"])
    sinks.upsert(spark, v2, path, ["position_id"])
    t = sinks.read_table(spark, path)
    assert t.count() == 6
    assert t.where(F.col("instrument_id") == "INS1").collect()[0].notional_value == Decimal("7.00")


def test_upsert_leaves_other_partitions(spark, tmp_dir):
    path = tmp_dir + "/t"
    other = D0 - dt.timedelta(days=1)
    sinks.upsert(spark, stage_positions(positions(spark, [dict(partition_date=other), {}])), path, ["position_id"])
    sinks.upsert(spark, stage_positions(positions(spark, [dict(instrument_id="INS2")])), path, ["position_id"])
    assert sinks.read_table(spark, path).count() == 3


def test_upsert_rejects_duplicate_source_keys(spark, tmp_dir):
    dup = stage_positions(positions(spark, [{}])).unionByName(stage_positions(positions(spark, [{}])))
    with pytest.raises(ValueError):
        sinks.upsert(spark, dup, tmp_dir + "/t", ["position_id"])


def test_sync_columns(spark):
    old = spark.createDataFrame([(1, "x")], "a int, gone string")
    new = spark.createDataFrame([(2, 1.5)], "a long, added double")
    out = sinks.sync_columns(old, new)
    assert out.dtypes == [("a", "bigint"), ("added", "double")] and out.collect()[0].added is None


def test_compact_partition(spark, tmp_dir):
    path = tmp_dir + "/t"
    df = stage_positions(positions(spark, [dict(instrument_id=f"INS{i}") for i in range(40)]))
    df.repartition(8).write.partitionBy("partition_date").parquet(path)
    sinks.compact_partition(spark, path, D0, 1)
    files = glob.glob(f"{path}/partition_date={D0.isoformat()}/*.parquet")
    assert len(files) == 1 and sinks.read_table(spark, path).count() == 40


def test_ingest_raw_rerun_replaces_day(spark, tmp_dir):
    src = tmp_dir + "/src"
    positions(spark, [dict(instrument_id=f"INS{i}") for i in range(3)]).drop("_ingestion_ts") \
        .write.parquet(src)
    for _ in range(2):
        out = sinks.ingest_raw(spark, src, D0, RAW_POSITIONS_SCHEMA, tmp_dir + "/raw", source_system="LMS")
    assert out.count() == 3 and out.select("source_system").distinct().collect()[0][0] == "LMS"


def test_streaming_ingest_is_exactly_once(spark, tmp_dir):
    src, target, ckpt = tmp_dir + "/drop", tmp_dir + "/raw", tmp_dir + "/ckpt"
    raw = positions(spark, [dict(instrument_id=f"INS{i}") for i in range(4)]).drop("_ingestion_ts")
    source_schema = raw.schema
    raw.write.mode("append").parquet(src)
    ingest_available(spark, src, source_schema, RAW_POSITIONS_SCHEMA, target, ckpt)
    ingest_available(spark, src, source_schema, RAW_POSITIONS_SCHEMA, target, ckpt)  # nothing new
    assert spark.read.parquet(target).count() == 4
    raw.limit(2).write.mode("append").parquet(src)  # a second drop
    ingest_available(spark, src, source_schema, RAW_POSITIONS_SCHEMA, target, ckpt)
    t = spark.read.parquet(target)
    assert t.count() == 6
    # staging keeps the latest copy per key
    assert stage_positions(t.select(*RAW_POSITIONS_SCHEMA.fieldNames())).count() == 4


def test_upsert_with_added_and_removed_columns(spark, tmp_dir):
    path = tmp_dir + "/t"
    old = stage_positions(positions(spark, [dict(instrument_id="INS1"), dict(instrument_id="INS2")]))
    sinks.upsert(spark, old.drop("interest_rate").withColumn("legacy", F.lit(1)), path, ["position_id"])
    other_day = stage_positions(positions(spark, [dict(partition_date=D0 - dt.timedelta(days=1))]))
    sinks.upsert(spark, other_day.drop("interest_rate").withColumn("legacy", F.lit(1)), path, ["position_id"])
    new = stage_positions(positions(spark, [dict(instrument_id="INS2", notional_value=Decimal("9.00"))]))
    sinks.upsert(spark, new, path, ["position_id"])
    t = sinks.read_table(spark, path, new.schema)
    assert t.count() == 3 and "legacy" not in t.columns
    today = {r.instrument_id: r for r in t.where(F.col("partition_date") == F.lit(D0)).collect()}
    assert today["INS2"].notional_value == Decimal("9.00") and today["INS1"].interest_rate is None


def test_merge_sql_for_merge_capable_tables(spark):
    sql = sinks.merge_sql("cat.marts.rpt_lcr", "src", ["lcr_record_id"], ["lcr_record_id", "lcr_pct"])
    assert sql == ("MERGE INTO cat.marts.rpt_lcr t USING src s ON t.`lcr_record_id` = s.`lcr_record_id` "
                   "WHEN MATCHED THEN UPDATE SET t.`lcr_record_id` = s.`lcr_record_id`, t.`lcr_pct` = s.`lcr_pct` "
                   "WHEN NOT MATCHED THEN INSERT (`lcr_record_id`, `lcr_pct`) VALUES (s.`lcr_record_id`, s.`lcr_pct`)")
    # a plain (non row-level) table refuses MERGE with an analysis error; the Parquet path is `upsert`
    spark.createDataFrame([(1, 2.0)], "lcr_record_id int, lcr_pct double").write.mode("overwrite") \
        .saveAsTable("merge_probe")
    with pytest.raises(Exception):
        sinks.merge_into(spark, spark.createDataFrame([(1, 3.0)], "lcr_record_id int, lcr_pct double"),
                         "merge_probe", ["lcr_record_id"])
    spark.sql("DROP TABLE IF EXISTS merge_probe")


def test_ingest_csv_feed_with_malformed_values(spark, tmp_dir):
    src = tmp_dir + "/drop.csv"
    with open(src, "w") as f:
        f.write("portfolio_id,instrument_id,position_qty,notional_value,position_type,currency,maturity_date,"
                "interest_rate\n")
        f.write("PF1,INS1,10.5,1000.00,LONG,USD,2024-06-30,0.05\n")
        f.write("PF1,INS2,abc,2000.00,SHORT,EUR,not-a-date,0.04\n")
    out = sinks.ingest_raw(spark, src, D0, RAW_POSITIONS_SCHEMA, tmp_dir + "/raw", fmt="csv",
                           source_system="CBS")
    rows = {r.instrument_id: r for r in out.collect()}
    assert rows["INS1"].position_qty == Decimal("10.5000") and rows["INS1"].maturity_date == dt.date(2024, 6, 30)
    assert rows["INS2"].position_qty is None and rows["INS2"].maturity_date is None  # try_cast, no failure
    assert rows["INS2"].notional_value == Decimal("2000.00")
    assert stage_positions(out.select(*RAW_POSITIONS_SCHEMA.fieldNames())).count() == 2


def _keyed(spark, rows, schema="k string, v int, partition_date date"):
    return spark.createDataFrame(rows, schema)


def test_upsert_keeps_rows_of_null_partitions(spark, tmp_dir):
    path = tmp_dir + "/t"
    sinks.upsert(spark, _keyed(spark, [("k1", 1, None), ("k2", 2, D0)]), path, ["k"])
    sinks.upsert(spark, _keyed(spark, [("k3", 3, None)]), path, ["k"])
    sinks.upsert(spark, _keyed(spark, [("k1", 9, None)]), path, ["k"])
    got = sorted((r.k, r.v, r.partition_date) for r in sinks.read_table(spark, path).collect())
    assert got == [("k1", 9, None), ("k2", 2, D0), ("k3", 3, None)]


def test_upsert_with_null_sub_partition_and_null_key(spark, tmp_dir):
    path, cols = tmp_dir + "/t", "k string, v int, partition_date date, source_system string"
    by = ["partition_date", "source_system"]
    sinks.upsert(spark, _keyed(spark, [("a", 1, D0, None), (None, 2, D0, "X")], cols), path, ["k"], by)
    sinks.upsert(spark, _keyed(spark, [("b", 3, D0, None), (None, 4, D0, "X")], cols), path, ["k"], by)
    got = sorted(((r.k, r.v) for r in sinks.read_table(spark, path).collect()), key=str)
    assert got == [("a", 1), ("b", 3), (None, 4)]


def test_upsert_of_many_partition_values_needs_no_static_filter(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sinks, "MAX_STATIC_VALUES", 1)
    path, day = tmp_dir + "/t", dt.timedelta(days=1)
    sinks.upsert(spark, _keyed(spark, [("a", 1, D0), ("b", 1, D0 - day), ("c", 1, D0 - 2 * day)]), path, ["k"])
    sinks.upsert(spark, _keyed(spark, [("a", 2, D0), ("d", 2, D0 - day)]), path, ["k"])
    assert sorted((r.k, r.v) for r in sinks.read_table(spark, path).collect()) == [("a", 2), ("b", 1), ("c", 1), ("d", 2)]


def test_added_column_is_read_and_survives_compaction(spark, tmp_dir):
    path, day2 = tmp_dir + "/t", D0 + dt.timedelta(days=1)
    sinks.upsert(spark, _keyed(spark, [("k1", 1, D0)]), path, ["k"])
    sinks.upsert(spark, _keyed(spark, [("k2", 2, "new", day2)], "k string, v int, added string, partition_date date"),
                 path, ["k"])
    for _ in range(2):
        got = {r.k: r.added for r in sinks.read_table(spark, path).collect()}
        assert got == {"k1": None, "k2": "new"}
        sinks.compact_partition(spark, path, day2)


def test_empty_first_write_is_readable(spark, tmp_dir):
    path = tmp_dir + "/t"
    sinks.upsert(spark, _keyed(spark, []), path, ["k"])
    t = sinks.read_table(spark, path)
    assert t.count() == 0 and t.columns == ["k", "v", "partition_date"]
    sinks.upsert(spark, _keyed(spark, [("k1", 1, D0)]), path, ["k"])
    assert sinks.read_table(spark, path).count() == 1


def test_empty_rerun_empties_the_day(spark, tmp_dir):
    target, other = tmp_dir + "/raw", D0 - dt.timedelta(days=1)
    feed = positions(spark, [dict(instrument_id=f"INS{i}") for i in range(3)]).drop("_ingestion_ts")
    for day in (other, D0):
        sinks.ingest_raw(spark, feed, day, RAW_POSITIONS_SCHEMA, target)
    assert sinks.ingest_raw(spark, feed.limit(0), D0, RAW_POSITIONS_SCHEMA, target).count() == 0
    left = sinks.read_table(spark, target)
    assert left.count() == 3 and [r[0] for r in left.select("partition_date").distinct().collect()] == [other]


def test_replace_day_removes_sub_partitions_that_went(spark, tmp_dir):
    path, cols, by = tmp_dir + "/t", "k string, v int, partition_date date, source_system string", ["partition_date", "source_system"]
    sinks.replace_day(_keyed(spark, [("a", 1, D0, "X"), ("b", 2, D0, "Y")], cols), path, D0, by)
    sinks.replace_day(_keyed(spark, [("c", 3, D0, "Y")], cols), path, D0, by)
    assert [(r.k, r.source_system) for r in sinks.read_table(spark, path).collect()] == [("c", "Y")]


def test_stream_and_batch_writes_refuse_each_other(spark, tmp_dir):
    src, target, ckpt = tmp_dir + "/drop", tmp_dir + "/raw", tmp_dir + "/ckpt"
    raw = positions(spark, [{}]).drop("_ingestion_ts")
    raw.write.parquet(src)
    ingest_available(spark, src, raw.schema, RAW_POSITIONS_SCHEMA, target, ckpt)
    with pytest.raises(ValueError):
        sinks.ingest_raw(spark, raw, D0, RAW_POSITIONS_SCHEMA, target)
    sinks.ingest_raw(spark, raw, D0, RAW_POSITIONS_SCHEMA, tmp_dir + "/batch")
    with pytest.raises(ValueError):
        ingest_available(spark, src, raw.schema, RAW_POSITIONS_SCHEMA, tmp_dir + "/batch", tmp_dir + "/ckpt2")


def test_compaction_derives_files_from_bytes(spark, tmp_dir):
    path = tmp_dir + "/t"
    df = stage_positions(positions(spark, [dict(instrument_id=f"INS{i}") for i in range(400)]))
    df.repartition(8).write.partitionBy("partition_date").parquet(path)
    files = lambda: glob.glob(f"{path}/partition_date={D0.isoformat()}/*.parquet")
    size = sum(len(open(f, "rb").read()) for f in files())
    sinks.compact_partition(spark, path, D0, file_bytes=size // 3)
    assert 3 <= len(files()) <= 4
    sinks.compact_partition(spark, path, D0)
    assert len(files()) == 1 and sinks.read_table(spark, path).count() == 400


def test_declared_scan_checks_names_and_types(spark, tmp_dir):
    good, bad = tmp_dir + "/good", tmp_dir + "/bad"
    feed = positions(spark, [{}]).drop("_ingestion_ts")
    sinks.ingest_raw(spark, feed, D0, RAW_POSITIONS_SCHEMA, good, source_system="LMS")
    assert sinks.read_declared(spark, good, RAW_POSITIONS_SCHEMA).columns == RAW_POSITIONS_SCHEMA.names
    sinks.write_partitioned(sinks.read_table(spark, good).withColumn("currency", F.lit(1)).drop("maturity_date"), bad)
    with pytest.raises(ValueError, match="currency: int, declared string") as e:
        sinks.read_declared(spark, bad, RAW_POSITIONS_SCHEMA)
    assert "maturity_date: missing" in str(e.value)


def test_first_daily_run_with_an_empty_feed(spark, tmp_dir):
    from liqspark.plans.pipeline import Warehouse, run_daily
    from liqspark.schemas import RAW_MARKET_SCHEMA
    from helpers import market

    raw = {"market_data": market(spark, [{}]).select(*RAW_MARKET_SCHEMA.names),
           "positions_loans": positions(spark, [{}]).limit(0), "positions_deposits": positions(spark, [{}])}
    root = tmp_dir + "/wh"
    results = {r.check_id: r.failures for r in run_daily(spark, raw, D0, root, now=dt.datetime(2024, 3, 30)).collect()}
    wh = Warehouse(spark, root)
    assert results["both_sources__mart_positions"] == 1
    assert wh.read("stg_positions_loans").count() == 0 and wh.read("mart_positions").count() == 1
    assert wh.read("rpt_fr2052a_inflows").count() == 0 and wh.read("rpt_lcr").count() == 1


# --- staged replacement -----------------------------------------------------------

def test_interrupted_swap_is_finished_by_the_next_writer(spark, tmp_dir, monkeypatch):
    path, day2, by = tmp_dir + "/t", D0 + dt.timedelta(days=1), ["partition_date"]
    sinks.upsert(spark, _keyed(spark, [("a", 1, D0), ("b", 1, day2)]), path, ["k"])
    finish = sinks.finish_swap

    def dies(s, p):  # between the plan and its first rename
        if sinks.path_exists(s, f"{p}/{sinks.SWAP_FILE}"):
            raise OSError("gone")

    monkeypatch.setattr(sinks, "finish_swap", dies)
    with pytest.raises(OSError):
        sinks.upsert(spark, _keyed(spark, [("a", 2, D0), ("c", 2, day2)]), path, ["k"])
    rows = lambda: sorted((r.k, r.v) for r in sinks.read_table(spark, path).collect())
    assert rows() == [("a", 1), ("b", 1)]  # staged rows aren't read
    monkeypatch.setattr(sinks, "finish_swap", finish)
    # half of the plan was carried out before
    plan = sinks.json.loads(open(f"{path}/_swap").read())
    first = plan["add"][0]
    hpath, fs = sinks._hadoop(spark, f"{path}/{first}")
    fs.delete(hpath, True)
    fs.rename(sinks._hadoop(spark, f"{path}/{plan['staging']}/{first}")[0], hpath)
    sinks.upsert(spark, _keyed(spark, [("d", 3, D0)]), path, ["k"])
    assert rows() == [("a", 2), ("b", 1), ("c", 2), ("d", 3)]
    assert not glob.glob(f"{path}/_s*g*") and not sinks.path_exists(spark, f"{path}/_swap")


def test_a_day_is_written_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda k: (seen.add(1), k)[1], "string").asNondeterministic()
    df = _keyed(spark, [(f"k{i}", i, D0) for i in range(20)]).withColumn("k", counted("k"))
    sinks.replace_day(df, tmp_dir + "/t", D0)
    assert seen.value == 20 and sinks.read_table(spark, tmp_dir + "/t").count() == 20


def test_compaction_packs_small_files_and_leaves_large_ones(spark, tmp_dir):
    assert sinks.pack_files([("a", 100), ("b", 40), ("c", 50), ("d", 60), ("e", 99)], 100) == [["d", "b"]]
    assert sinks.pack_files([("a", 70), ("b", 60), ("c", 51)], 100) == [] == sinks.pack_files([], 100)
    path, by = tmp_dir + "/t", ["partition_date", "source_system"]
    day = f"{path}/partition_date={D0.isoformat()}"
    row = ["concat('key', id) as k", "cast(id as int) as v"]
    spark.range(20000).selectExpr(*row).repartition(1).write.parquet(f"{day}/source_system=X")
    spark.range(300).selectExpr(*row).repartition(5).write.mode("append").parquet(f"{day}/source_system=X")
    spark.range(200).selectExpr(*row).repartition(1).write.parquet(f"{day}/source_system=Y")
    before = dict(sinks.data_files(spark, f"{day}/source_system=X"))
    large = max(before, key=before.get)
    only = sinks.data_files(spark, f"{day}/source_system=Y")
    assert sinks.compact_partition(spark, path, D0, partition_by=by, file_bytes=before[large]) == 5
    after = dict(sinks.data_files(spark, f"{day}/source_system=X"))
    assert len(after) == 2 and after[large] == before[large]
    assert sinks.data_files(spark, f"{day}/source_system=Y") == only
    assert sinks.compact_partition(spark, path, D0, partition_by=by, file_bytes=before[large]) == 0
    assert dict(sinks.data_files(spark, f"{day}/source_system=X")) == after
    t = sinks.read_table(spark, path)
    assert t.count() == 20500 and t.where("source_system = 'X'").select("v").distinct().count() == 20000
    assert sinks.compact_partition(spark, path, D0 + dt.timedelta(days=1), partition_by=by) == 0


# --- streaming merge ------------------------------------------------------------------

def _drops(spark):
    at = lambda h: dt.datetime(2024, 3, 29, h)
    row = lambda i, n, h, **kw: dict(instrument_id=i, notional_value=Decimal(n), _ingestion_ts=at(h), **kw)
    old = D0 - dt.timedelta(days=1)
    return [positions(spark, rows) for rows in (
        [row("INS1", "1.00", 1), row("INS2", "2.00", 1), row("INS2", "9.00", 1)],
        [row("INS1", "5.00", 5), row("INS3", "3.00", 2), row("INS1", "7.00", 3, partition_date=old)],
        [row("INS1", "4.00", 4), row("INS3", "6.00", 3, position_qty=None)])]


def _merged(spark, path):
    return sorted((str(r.partition_date), r.instrument_id, str(r.notional_value))
                  for r in sinks.read_table(spark, path).collect())


def test_streamed_drops_merge_in_any_order_and_number(spark, tmp_dir):
    want = [("2024-03-28", "INS1", "7.00"), ("2024-03-29", "INS1", "5.00"), ("2024-03-29", "INS2", "9.00"),
            ("2024-03-29", "INS3", "6.00")]
    drops = _drops(spark)
    for n, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 1, 0, 2, 0)]):
        src, target, ckpt = (f"{tmp_dir}/{n}/{x}" for x in ("drop", "raw", "ckpt"))
        for i in order:
            drops[i].coalesce(1).write.mode("append").parquet(src)
            merge_available(spark, src, RAW_POSITIONS_SCHEMA, RAW_POSITIONS_SCHEMA, POSITION_KEYS, target, ckpt)
        assert _merged(spark, target) == want
        merge_available(spark, src, RAW_POSITIONS_SCHEMA, RAW_POSITIONS_SCHEMA, POSITION_KEYS, target, ckpt)  # nothing new
        merge_available(spark, src, RAW_POSITIONS_SCHEMA, RAW_POSITIONS_SCHEMA, POSITION_KEYS, target, ckpt + "2",
                        max_files_per_trigger=1)  # all files again, one a batch
        assert _merged(spark, target) == want


def test_batch_is_merged_again_after_a_failure_but_not_after_its_note(spark, tmp_dir, monkeypatch):
    target, (first, second, third) = tmp_dir + "/raw", _drops(spark)
    merge = batch_merger(target, POSITION_KEYS, tmp_dir + "/ckpt")
    merge(first, 0)
    note = sinks.write_note
    monkeypatch.setattr(sinks, "write_note", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        merge(second, 1)
    monkeypatch.setattr(sinks, "write_note", note)
    state = _merged(spark, target)
    merge(second, 1)
    assert _merged(spark, target) == state
    monkeypatch.setattr(sinks, "merge_latest", lambda *a, **k: pytest.fail("merged a noted batch"))
    merge(third, 1)


def test_streamed_merge_needs_a_load_time_and_partition_keys(spark, tmp_dir):
    raw = _drops(spark)[0]
    with pytest.raises(ValueError, match="_ingestion_ts"):
        merge_available(spark, tmp_dir, raw.drop("_ingestion_ts").schema, RAW_POSITIONS_SCHEMA, POSITION_KEYS,
                        tmp_dir + "/raw", tmp_dir + "/ckpt")
    with pytest.raises(ValueError, match="partition_date"):
        sinks.merge_latest(spark, raw, tmp_dir + "/raw", ["instrument_id"], ["_ingestion_ts"])
