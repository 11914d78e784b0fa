"""The scheduled-job command line end to end on the sf0.001 feeds: ingest two
days of each raw feed, run the day, compact it, re-run it."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from helpers import SF_SMALL
from liqspark.plans import cli
from liqspark.sources import fixtures

DAYS = [dt.date(2024, 3, 28), dt.date(2024, 3, 29)]


def test_cli_ingest_run_optimize(spark, tmp_dir):
    raw = fixtures.raw_feeds(spark, SF_SMALL)
    tags = {"market_data": None, "positions_loans": "LMS", "positions_deposits": "CBS"}
    for name, df in raw.items():
        for day in DAYS:
            drop = f"{tmp_dir}/drops/{name}/{day}"
            df.where(F.col("partition_date") == F.lit(day)).drop("partition_date", "_ingestion_ts") \
                .write.parquet(drop)
            args = ["ingest", "--partition-date", day.isoformat(), "--source-path", drop,
                    "--target-table", f"{tmp_dir}/raw/{name}", "--feed", name]
            if tags[name]:
                args += ["--source-system", tags[name]]
            assert cli.main(args, spark) == 0
    wh, out = f"{tmp_dir}/wh", f"{tmp_dir}/out"
    run = ["run", "--partition-date", DAYS[1].isoformat(), "--raw-root", f"{tmp_dir}/raw",
           "--warehouse", wh, "--output", out, "--run-id", "r1"]
    assert cli.main(run, spark) == 0
    book = spark.read.parquet(f"{wh}/mart_positions")
    n_book = book.count()
    assert n_book > 0 and book.select("partition_date").distinct().count() == 1
    # audit stamps are added when models are stored
    assert "_unified_at" in book.columns and book.where(F.col("_unified_at").isNull()).count() == 0
    assert "_loaded_at" in spark.read.parquet(f"{wh}/stg_market_data").columns
    assert "_computed_at" in spark.read.parquet(f"{wh}/rpt_lcr").columns
    summary = spark.read.json(f"{out}/summary/{DAYS[1]}").collect()[0]
    assert summary.total_tests == 105 and summary.passed + summary.failed + summary.warned == 105
    assert spark.read.json(f"{out}/events").count() > 105
    assert cli.main(["optimize", "--warehouse", wh, "--tables", "mart_liquidity_risk,rpt_lcr,mart_positions",
                     "--partition-date", DAYS[1].isoformat()], spark) == 0
    assert len(glob.glob(f"{wh}/rpt_lcr/partition_date={DAYS[1]}/*.parquet")) == 1
    # the book keeps its two-level layout: one file per source system of the day
    assert len(glob.glob(f"{wh}/mart_positions/partition_date={DAYS[1]}/source_system=*/*.parquet")) == 2
    assert spark.read.parquet(f"{wh}/mart_positions").count() == n_book
    assert cli.main(run, spark) == 0  # re-run of the same day replaces, never appends
    assert spark.read.parquet(f"{wh}/mart_positions").count() == n_book
