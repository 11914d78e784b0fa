"""Independent DuckDB formulation of every registered query.

Written directly from the model semantics (not generated from the Spark
plans) over the driver's views. Decimal arithmetic is kept exact where the
models are exact; where DuckDB has no exact decimal division the documented
double recipes are used (SURVEY §7.4). Seeds are inlined as VALUES.
"""

from __future__ import annotations

from ..functions.keys import NULL_TOKEN, SEPARATOR
from ..operators.regulatory import SUPPLEMENTAL_ITEMS
from ..operators.thresholds import METRIC_COLUMNS, POSITION_RULES, AggRule
from ..sources import fixtures as fx
from ..sources import seeds
from .queries import (AS_OF, FRESHNESS_CLOCK, LARGE_NOTIONAL, NULL_DATE_INSTRUMENT, NULL_DAY_RULES, RECENCY_CLOCK,
                      RUN_ID, SHORT_HORIZON, TIGHT_RULES, UPSERT_FROM)
from .suite import DECLARED, CheckSpec

D = f"DATE '{AS_OF.isoformat()}'"


def sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '{NULL_TOKEN}')" for e in exprs)
    return f"md5(concat_ws('{SEPARATOR}', {parts}))"


def dround(expr: str, places: int) -> str:
    """Round a double the way Spark's ``round`` does: HALF_UP on the value's
    shortest decimal string (DuckDB's double ``round`` scales in floating point
    and can flip exact decimal ties)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,12)), {places}) AS DOUBLE)"


def q(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def _values(rows, cols, types=None) -> str:
    out = []
    for r in rows:
        vals = []
        for i, v in enumerate(r):
            t = (types or {}).get(cols[i])
            lit = q(v) if isinstance(v, str) else str(v)
            vals.append(f"CAST({lit} AS {t})" if t else lit)
        out.append("(" + ", ".join(vals) + ")")
    return f"(VALUES {', '.join(out)}) AS t({', '.join(cols)})"


SEED_SQL = {
    "instrument_reference": "SELECT * FROM " + _values(
        seeds.INSTRUMENT_REFERENCE, ["instrument_id", "instrument_name", "asset_class", "currency", "exchange"]),
    "seed_hqla_classification": "SELECT * FROM " + _values(
        seeds.HQLA_CLASSIFICATION, ["instrument_type", "hqla_level", "haircut_pct", "description"],
        {"haircut_pct": "DECIMAL(5,2)"}),
    "seed_nsfr_factors": "SELECT * FROM " + _values(
        seeds.NSFR_FACTORS, ["instrument_type", "maturity_bucket", "asf_factor_pct", "rsf_factor_pct", "description"],
        {"asf_factor_pct": "BIGINT", "rsf_factor_pct": "BIGINT"}),
    "seed_fr2052a_product_mapping": "SELECT * FROM " + _values(
        seeds.FR2052A_PRODUCT_MAPPING, ["product_category", "product_code", "schedule", "sub_schedule",
                                        "maturity_bucket", "run_off_rate_pct", "description"],
        {"run_off_rate_pct": "BIGINT"}),
}


def _raw_pos(status: str) -> str:
    return f"""
    SELECT 'PF' || CAST(l_suppkey % 10 AS VARCHAR) AS portfolio_id,
           'INS' || CAST(l_partkey % 40 AS VARCHAR) AS instrument_id,
           CASE WHEN l_returnflag = 'N' THEN -l_quantity ELSE l_quantity END AS position_qty,
           l_extendedprice * 12 AS notional_value,
           CASE l_returnflag WHEN 'A' THEN 'LONG' WHEN 'N' THEN 'SHORT' ELSE 'HEDGE' END AS position_type,
           CASE l_suppkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE pd + CAST(l_partkey % 400 AS INTEGER) - 10 END AS maturity_date,
           l_discount AS interest_rate, pd AS partition_date, l_shipdate AS _ingestion_ts
    FROM li WHERE l_linestatus = '{status}'"""


def _stg_pos(raw: str) -> str:
    keys = ["portfolio_id", "instrument_id", "position_type", "partition_date"]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in
                      ["_ingestion_ts", "position_qty", "notional_value", "currency", "maturity_date", "interest_rate"])
    return f"""
    SELECT {sk(*keys)} AS position_id, portfolio_id, instrument_id,
           TRY_CAST(position_qty AS DECIMAL(18,4)) AS position_qty,
           TRY_CAST(notional_value AS DECIMAL(18,2)) AS notional_value,
           position_type, currency, maturity_date,
           TRY_CAST(interest_rate AS DECIMAL(10,6)) AS interest_rate, partition_date
    FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn FROM {raw}) s
    WHERE rn = 1"""


_MKT_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in [
    "_ingestion_ts", "close_price", "bid_price", "ask_price", "volume", "yield_rate", "spread_bps", "partition_date"])

FR_BUCKET = """CASE WHEN {m} IS NULL THEN 'OPEN'
        WHEN date_diff('day', {d}, {m}) < 30 THEN 'LT_30D'
        WHEN date_diff('day', {d}, {m}) < 60 THEN 'GTE_30D_LT_60D'
        WHEN date_diff('day', {d}, {m}) < 90 THEN 'GTE_60D_LT_90D'
        ELSE 'GTE_90D' END"""
NSFR_BUCKET = """CASE WHEN {m} IS NULL THEN 'ANY'
        WHEN date_diff('day', {d}, {m}) < 180 THEN 'LT_6M'
        WHEN date_diff('day', {d}, {m}) < 365 THEN 'GTE_6M_LT_1Y'
        ELSE 'GTE_1Y' END"""
BUCKET_ORDER = ("CASE {b} WHEN 'OPEN' THEN 1 WHEN 'LT_30D' THEN 2 WHEN 'GTE_30D_LT_60D' THEN 3 "
                "WHEN 'GTE_60D_LT_90D' THEN 4 WHEN 'GTE_90D' THEN 5 END")


def _fr(m="maturity_date", d="partition_date"):
    return FR_BUCKET.format(m=m, d=d)


# CTEs in dependency order; a query pulls in only what it needs (transitively).
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name, deps, sql):
    CTES[name] = (deps, sql)


cte("li", [], f"SELECT *, DATE '{fx.BASE_DATE.isoformat()}' + CAST(l_orderkey % 90 AS INTEGER) AS pd FROM lineitem")
cte("raw_loans", ["li"], _raw_pos("O"))
cte("raw_deposits", ["li"], _raw_pos("F"))
cte("raw_market", ["li"], """
    SELECT 'INS' || CAST(l_partkey % 40 AS VARCHAR) AS instrument_id, pd AS as_of_date,
           l_extendedprice / 100 AS close_price, l_extendedprice / 100 - 0.05 AS bid_price,
           l_extendedprice / 100 + 0.05 AS ask_price, CAST(l_quantity * 50000 AS BIGINT) AS volume,
           l_tax AS yield_rate, l_discount * 600 AS spread_bps, pd AS partition_date, l_shipdate AS _ingestion_ts
    FROM li WHERE l_partkey % 40 <> 13""")
cte("stg_loans", ["raw_loans"], _stg_pos("raw_loans"))
cte("stg_deposits", ["raw_deposits"], _stg_pos("raw_deposits"))
cte("stg_mkt", ["raw_market"], f"""
    SELECT {sk('instrument_id', 'as_of_date')} AS market_data_id, instrument_id, as_of_date,
           TRY_CAST(close_price AS DECIMAL(18,6)) AS close_price, TRY_CAST(bid_price AS DECIMAL(18,6)) AS bid_price,
           TRY_CAST(ask_price AS DECIMAL(18,6)) AS ask_price, TRY_CAST(volume AS BIGINT) AS volume,
           TRY_CAST(yield_rate AS DECIMAL(10,6)) AS yield_rate, TRY_CAST(spread_bps AS DECIMAL(10,2)) AS spread_bps,
           partition_date
    FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, as_of_date ORDER BY {_MKT_ORDER}) AS rn
          FROM raw_market) s WHERE rn = 1""")
cte("book", ["stg_loans", "stg_deposits"], f"""
    SELECT {sk('portfolio_id', 'instrument_id', 'position_type', 'source_system', 'partition_date')} AS position_id,
           portfolio_id, instrument_id, position_qty, notional_value, position_type, currency, maturity_date,
           interest_rate, source_system, partition_date
    FROM (SELECT * EXCLUDE (position_id), 'LOANS' AS source_system FROM stg_loans
          UNION ALL SELECT * EXCLUDE (position_id), 'DEPOSITS' AS source_system FROM stg_deposits) u""")
cte("risk", ["book", "stg_mkt"], f"""
    SELECT {sk('p.portfolio_id', 'p.instrument_id', 'p.partition_date')} AS risk_record_id,
           p.portfolio_id, p.instrument_id, p.position_qty, p.notional_value, m.close_price, m.bid_price,
           m.ask_price, m.volume, m.spread_bps, m.yield_rate,
           CASE WHEN m.volume > 1000000 AND m.spread_bps < 10 THEN 'HIGH'
                WHEN m.volume > 100000 AND m.spread_bps < 50 THEN 'MEDIUM' ELSE 'LOW' END AS liquidity_tier,
           CASE WHEN m.volume > 0 THEN CAST(ceil(abs(p.position_qty) / (m.volume * 0.1)) AS BIGINT)
                ELSE 999 END AS est_days_to_liquidate,
           CAST(p.position_qty AS DECIMAL(38,4)) * m.close_price AS market_value,
           p.partition_date
    FROM book p LEFT JOIN stg_mkt m ON p.instrument_id = m.instrument_id AND p.partition_date = m.partition_date""")
cte("cash_summary", ["book", "stg_mkt"], """
    SELECT p.portfolio_id, p.partition_date,
           CAST(sum(CASE WHEN m.yield_rate > 0 THEN CAST(p.notional_value AS DECIMAL(24,2)) * m.yield_rate
                    ELSE 0 END) AS DOUBLE) / 365 AS coupon,
           sum(CASE WHEN p.position_qty < 0 THEN abs(p.notional_value) * 0.001 ELSE 0 END) AS margin
    FROM book p LEFT JOIN stg_mkt m ON p.instrument_id = m.instrument_id AND p.partition_date = m.partition_date
    GROUP BY p.portfolio_id, p.partition_date""")
cte("cashflow", ["cash_summary"], f"""
    SELECT {sk('portfolio_id', 'forecast_date', 'partition_date')} AS forecast_id, portfolio_id, forecast_date,
           projected_inflow, projected_outflow, net_cashflow,
           sum(net_cashflow) OVER (PARTITION BY portfolio_id, partition_date ORDER BY forecast_date
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_cashflow,
           partition_date
    FROM (SELECT s.portfolio_id, s.partition_date + CAST(r.i AS INTEGER) AS forecast_date,
                 CAST(round(s.coupon, 2) AS DECIMAL(38,2)) AS projected_inflow,
                 round(s.margin, 2) AS projected_outflow,
                 CAST(round(s.coupon - CAST(s.margin AS DOUBLE), 2) AS DECIMAL(38,2)) AS net_cashflow,
                 s.partition_date
          FROM cash_summary s CROSS JOIN range(0, 30) AS r(i)) f""")
for _name, _sql in SEED_SQL.items():
    cte(_name, [], _sql)


# Category and range tables: the reports look their classes up in these.
FR_BOUNDS = "(VALUES ('LT_30D', -1000000, 30, 2), ('GTE_30D_LT_60D', 30, 60, 3), ('GTE_60D_LT_90D', 60, 90, 4), " \
            "('GTE_90D', 90, 1000000, 5)) AS mb(bucket, from_day, to_day, place)"
NSFR_BOUNDS = "(VALUES ('LT_6M', -1000000, 180), ('GTE_6M_LT_1Y', 180, 365), ('GTE_1Y', 365, 1000000)) " \
              "AS mb(bucket, from_day, to_day)"
IN_BOUNDS = "maturity_date - partition_date >= mb.from_day AND maturity_date - partition_date < mb.to_day"
ANY_AMOUNT = (-10 ** 15, 10 ** 15)
OUTFLOW_CLASSES = (("DEPOSITS", "LONG", ANY_AMOUNT[0], 250_000, "RETAIL_STABLE"),
                   ("DEPOSITS", "LONG", 250_000, ANY_AMOUNT[1], "RETAIL_LESS_STABLE"),
                   ("DEPOSITS", "SHORT", *ANY_AMOUNT, "WHOLESALE_NON_OP_UNSECURED"),
                   ("DEPOSITS", "HEDGE", *ANY_AMOUNT, "WHOLESALE_NON_OP_UNSECURED"),
                   ("LOANS", "HEDGE", *ANY_AMOUNT, "CREDIT_FACILITY_CORP"))
INFLOW_CLASSES = (("LOANS", "LONG", ANY_AMOUNT[0], 1_000_000, "INFLOW_RETAIL_LOAN"),
                  ("LOANS", "LONG", 1_000_000, ANY_AMOUNT[1], "INFLOW_WHOLESALE"))
DEFAULT_HQLA_TYPE = "map {'DEPOSITS': 'DEMAND_DEPOSIT', 'LOANS': 'LOAN'}[source_system]"
_HQLA_LIST = "[" + ", ".join(q(r[0]) for r in seeds.HQLA_CLASSIFICATION) + "]"
_INS = "CAST(substr(instrument_id, 4) AS INTEGER)"
MASTER_HQLA_TYPE = f"{_HQLA_LIST}[{_INS} % {len(seeds.HQLA_CLASSIFICATION)} + 1]"


def _two(expr: str) -> str:
    return f"CAST(round({expr}, 2) AS DOUBLE)"


def _lcr_sql(type_expr: str) -> str:
    """Assets and flows as one stream of (portfolio, date, what, amount), summed per kind."""
    return f"""
    SELECT {sk('portfolio_id', 'partition_date')} AS lcr_record_id, portfolio_id, partition_date,
      {_two('one')} AS hqla_level_1, {_two('two_a')} AS hqla_level_2a, {_two('two_b')} AS hqla_level_2b,
      {dround('hqla', 2)} AS total_hqla, {_two('paid')} AS total_outflows_30d,
      {_two('got')} AS total_inflows_30d, {_two('offset_by')} AS capped_inflows_30d, {_two('net')} AS net_cash_outflows_30d,
      if(net > 0, {dround('hqla / CAST(net AS DOUBLE) * 100', 2)}, 999.99) AS lcr_pct,
      coalesce(net <= 0 OR hqla >= CAST(net AS DOUBLE), false) AS is_lcr_compliant
    FROM (SELECT *, CAST(least(got, paid * 0.75) AS DECIMAL(38,2)) AS offset_by,  -- flows are in cents
                 paid - CAST(least(got, paid * 0.75) AS DECIMAL(38,2)) AS net,
                 CAST(one AS DOUBLE) + least(CAST(two_a AS DOUBLE) + CAST(two_b AS DOUBLE), CAST(one AS DOUBLE) * 0.4 / 0.6) AS hqla
          FROM (SELECT portfolio_id, partition_date, coalesce(sum(amount) FILTER (what = '1'), 0) AS one,
                       coalesce(sum(amount) FILTER (what = '2A'), 0) AS two_a,
                       coalesce(sum(amount) FILTER (what = '2B'), 0) AS two_b,
                       CAST(coalesce(sum(amount) FILTER (what = 'paid'), 0) AS DECIMAL(38,2)) AS paid,
                       CAST(coalesce(sum(amount) FILTER (what = 'got'), 0) AS DECIMAL(38,2)) AS got
                FROM (SELECT b.portfolio_id, b.partition_date, seed.hqla_level AS what, CAST(
                        CAST(notional_value AS DECIMAL(24,2)) * (100 - seed.haircut_pct) * 0.01 AS DECIMAL(38,6)) AS amount
                      FROM (SELECT *, {type_expr} AS kind FROM book WHERE notional_value > 0) b
                      LEFT JOIN seed_hqla_classification seed ON seed.instrument_type = b.kind
                      UNION ALL
                      SELECT portfolio_id, partition_date, unnest(['paid', 'got']),
                             unnest([CAST(greatest(projected_outflow, 0) AS DECIMAL(38,6)),
                                     CAST(greatest(projected_inflow, 0) AS DECIMAL(38,6))])
                      FROM cashflow WHERE forecast_date - partition_date <= 30) stream
                GROUP BY ALL
                -- a portfolio counts if it holds a positive position that day
                HAVING count(*) FILTER (coalesce(what, '') NOT IN ('paid', 'got')) > 0) sums) net_of"""


NSFR_SQL = f"""
    SELECT {sk('portfolio_id', 'partition_date')} AS nsfr_record_id, portfolio_id, partition_date,
      {_two('r')} AS asf_retail_deposits, {_two('w')} AS asf_wholesale_funding, {_two('available')} AS total_asf,
      {_two('l')} AS rsf_loans, {_two('h')} AS rsf_hqla, {_two('o')} AS rsf_other_assets, {_two('required')} AS total_rsf,
      if(required > 0, CAST(round(CAST(ratio AS DECIMAL(18,6)) * 100, 2) AS DOUBLE), 999.99) AS nsfr_pct,
      coalesce(required <= 0 OR ratio >= 1.0, false) AS is_nsfr_compliant,
      {_two('available - required')} AS nsfr_surplus_deficit
    FROM (SELECT *, round(CAST(available AS DOUBLE) / nullif(CAST(required AS DOUBLE), 0), 6) AS ratio
          FROM (SELECT portfolio_id, partition_date,
                       coalesce(sum(a) FILTER (starts_with(kind, 'RETAIL_DEPOSIT')), 0) AS r,
                       coalesce(sum(a) FILTER (starts_with(kind, 'WHOLESALE')), 0) AS w, sum(a) AS available,
                       coalesce(sum(n) FILTER (starts_with(kind, 'LOAN')), 0) AS l,
                       coalesce(sum(n) FILTER (starts_with(kind, 'HQLA')), 0) AS h,
                       coalesce(sum(n) FILTER (starts_with(kind, 'OTHER')), 0) AS o, sum(n) AS required
                FROM (SELECT b.portfolio_id, b.partition_date, c.kind,
                             CAST(b.notional_value AS DECIMAL(24,2)) * (coalesce(f.asf_factor_pct, 0) * c.funds) * 0.01 AS a,
                             CAST(b.notional_value AS DECIMAL(24,2)) * (coalesce(f.rsf_factor_pct, 50) * (1 - c.funds)) * 0.01 AS n
                      FROM book b
                      JOIN (VALUES ('DEPOSITS', true, 'RETAIL_DEPOSIT_STABLE', 1), ('DEPOSITS', false, 'RETAIL_DEPOSIT_LESS_STABLE', 1),
                                   ('LOANS', true, 'LOAN_RETAIL', 0), ('LOANS', false, 'LOAN_RETAIL', 0))
                           AS c(source_system, is_long, kind, funds)
                        ON c.source_system = b.source_system AND c.is_long = coalesce(b.position_type = 'LONG', false)
                      LEFT JOIN {NSFR_BOUNDS} ON {IN_BOUNDS}
                      LEFT JOIN seed_nsfr_factors f
                        ON f.instrument_type = c.kind AND f.maturity_bucket IN (coalesce(mb.bucket, 'ANY'), 'ANY')) weighted
                GROUP BY ALL) sums) ratios"""


def _schedule_sql(schedule: str, classes, wildcards, default_rate: int, amount: str, names: tuple[str, str, str]) -> str:
    """An FR 2052a schedule: class by range table, rate by seed, one grouping."""
    key, rate, total = names
    table = "(VALUES " + ", ".join(f"({q(s)}, {q(t)}, {lo}, {hi}, {q(c)})" for s, t, lo, hi, c in classes) \
        + ") AS c(source_system, position_type, low, high, category)"
    return f"""
    SELECT {sk('portfolio_id', 'code', 'bucket', 'partition_date')} AS {key}, portfolio_id, partition_date,
      {q(schedule)} AS schedule, sub AS sub_schedule, code AS product_code, label AS product_description,
      bucket AS maturity_bucket, pct AS {rate}, count(*) AS position_count, {_two('sum(notional_value)')} AS gross_amount,
      {_two('sum(amount)')} AS {total}, place AS maturity_bucket_order
    FROM (SELECT *, {amount} AS amount
          FROM (SELECT b.portfolio_id, b.partition_date, b.notional_value, b.interest_rate, coalesce(mb.bucket, 'OPEN') AS bucket,
                       coalesce(mb.place, 1) AS place, m.product_code AS code, m.sub_schedule AS sub, m.description AS label,
                       coalesce(m.run_off_rate_pct, {default_rate}) AS pct
                FROM book b
                JOIN {table} ON c.source_system = b.source_system AND c.position_type = b.position_type
                  AND b.notional_value >= c.low AND b.notional_value < c.high
                LEFT JOIN {FR_BOUNDS} ON {IN_BOUNDS}
                LEFT JOIN seed_fr2052a_product_mapping m ON m.schedule = {q(schedule)} AND m.product_category = c.category
                  AND m.maturity_bucket IN (coalesce(mb.bucket, 'OPEN'), {", ".join(map(q, wildcards))})) rated) priced
    GROUP BY ALL"""


OUTFLOWS_SQL = _schedule_sql("O", OUTFLOW_CLASSES, ("OPEN", "ANY"), 100,
                             "CAST(notional_value AS DECIMAL(24,2)) * pct * 0.01",
                             ("outflow_record_id", "run_off_rate_pct", "stressed_outflow_amount"))
INFLOWS_SQL = _schedule_sql("I", INFLOW_CLASSES, ("ANY",), 50,
                            "CAST((CAST(notional_value AS DOUBLE) + CAST(notional_value AS DOUBLE) "
                            "* CAST(coalesce(interest_rate, 0) AS DOUBLE) * 30 / 365) * pct / 100 AS DECIMAL(38,6))",
                            ("inflow_record_id", "inflow_rate_pct", "expected_inflow_amount"))
SUPPLEMENTAL_TEXTS = "(VALUES " + ", ".join(f"({q(c)}, {q(t)}, {q(d)})" for c, (t, d) in SUPPLEMENTAL_ITEMS.items()) \
    + ") AS texts(item_code, item_type, item_description)"


def _supplemental_sql(level: str = "'NON_HQLA'", book: str = "book") -> str:
    """All items of a position or risk row as (code, reported, haircut, net) shares, summed once."""
    amount = "CAST(notional_value AS DECIMAL(38,10))"
    draw = "CAST(abs(notional_value) * 0.05 AS DECIMAL(38,10))"
    zero = "CAST(0 AS DECIMAL(38,10))"
    return f"""
    SELECT {sk('portfolio_id', 'item_code', 'partition_date')} AS supplemental_record_id, portfolio_id, partition_date,
      'S' AS schedule, item_code, item_type, item_description, {_two('reported')} AS reported_amount,
      {_two('cut')} AS haircut_amount, {_two('net')} AS net_amount
    FROM (SELECT portfolio_id, partition_date, item_code, part, sum(reported) AS reported, sum(cut) AS cut, sum(net) AS net
          FROM (SELECT portfolio_id, partition_date, 'S.H.1' AS item_code, {level} AS part, {amount} AS reported,
                       {zero} AS cut, {amount} AS net
                FROM {book} WHERE {level} <> 'NON_HQLA'
                UNION ALL
                SELECT portfolio_id, partition_date, if(position_type = 'HEDGE', 'S.E.1', 'S.O.1'), NULL,
                       if(position_type = 'HEDGE', {amount}, abs({amount})), if(position_type = 'HEDGE', {amount}, {draw}),
                       if(position_type = 'HEDGE', {zero}, {draw})
                FROM {book} WHERE position_type IN ('HEDGE', 'SHORT')
                UNION ALL
                SELECT portfolio_id, partition_date, 'S.L.1', NULL, CAST(market_value AS DECIMAL(38,10)), {zero},
                       CAST(if(liquidity_tier = 'HIGH', market_value, 0) AS DECIMAL(38,10))
                FROM risk) shares
          GROUP BY ALL) items
    JOIN {SUPPLEMENTAL_TEXTS} USING (item_code)
    WHERE reported <> 0"""


def dq_dates_sql(n: int) -> str:
    """Counted back from the number of business dates before the run date."""
    return f"""
    SELECT partition_date, CAST(before.k + 1 - idx AS INTEGER) AS rnk
    FROM bdx, (SELECT count(*) AS k FROM bdx WHERE partition_date < {D}) before
    WHERE idx BETWEEN before.k + 1 - {n} AND before.k"""


def _rule_all_dates_sql(rule: AggRule) -> str:
    dims = list(rule.group_by)
    k = float(rule.stddev_multiplier)
    L = int(rule.lookback_business_days)
    sel = "".join(f"{c}, " for c in dims)
    grp = "partition_date" + "".join(f", {c}" for c in dims)
    dj = ("CAST(json_object(" + ", ".join(f"'{c}', c.{c}" for c in dims) + ") AS VARCHAR)") if dims else "'{}'"
    on = "".join(f"c.{c} IS NOT DISTINCT FROM h.{c} AND " for c in dims)
    cdims = "".join(f", c.{c}" for c in dims)
    cur, mean, sd, n = "cur", "hist_mean", "hist_stddev", "hist_n"
    return f"""
    SELECT {q(rule.name)} AS rule_name, dims_json, partition_date, {cur} AS current_value, {n} AS hist_n,
      {mean} AS hist_mean, {sd} AS hist_stddev, {mean} - {k} * {sd} AS lower_threshold,
      {mean} + {k} * {sd} AS upper_threshold,
      CASE WHEN {sd} IS NULL OR {sd} = 0 THEN NULL ELSE ({cur} - {mean}) / {sd} END AS zscore,
      CAST({k} AS DOUBLE) AS stddev_multiplier, CAST({L} AS INTEGER) AS lookback_business_days,
      CAST({rule.min_history_days} AS INTEGER) AS min_history_days, {q(rule.metric_expr)} AS metric_expr,
      {q(rule.where)} AS filter_sql, {q(','.join(dims))} AS group_by_cols,
      CASE WHEN {n} IS NULL OR {n} < {rule.min_history_days} THEN false WHEN {sd} IS NULL THEN false
           WHEN {sd} = 0 THEN ({cur} <> {mean}) ELSE abs(({cur} - {mean}) / {sd}) > {k} END AS is_outlier
    FROM (
      SELECT {dj} AS dims_json, c.partition_date, CAST(c.v AS DOUBLE) AS cur,
             nullif(count(h.idx), 0) AS hist_n, CAST(sum(h.v) AS DOUBLE) / nullif(count(h.v), 0) AS hist_mean,
             stddev_samp(CAST(h.v AS DOUBLE)) AS hist_stddev
      FROM (SELECT d.*, x.k FROM (SELECT {sel}partition_date, {rule.metric_expr} AS v FROM book
                                  WHERE ({rule.where}) GROUP BY {grp}) d JOIN dkx x USING (partition_date)) c
      LEFT JOIN (SELECT d.*, b.idx FROM (SELECT {sel}partition_date, {rule.metric_expr} AS v FROM book
                                         WHERE ({rule.where}) GROUP BY {grp}) d JOIN bdx b USING (partition_date)) h
        ON {on}h.idx BETWEEN c.k - {L} + 1 AND c.k
      GROUP BY c.partition_date, c.v{cdims}) r"""


cte("bdx", ["book"], """
    SELECT partition_date, row_number() OVER (ORDER BY partition_date) AS idx
    FROM (SELECT DISTINCT partition_date FROM book WHERE isodow(partition_date) BETWEEN 1 AND 5) x""")
cte("dkx", ["book", "bdx"], """
    SELECT d.partition_date, (SELECT count(*) FROM bdx WHERE bdx.partition_date < d.partition_date) AS k
    FROM (SELECT DISTINCT partition_date FROM book) d""")


def metrics_sql(rules) -> str:
    return f"""
    SELECT {sk('rule_name', 'dims_json', 'CAST(partition_date AS VARCHAR)')} AS dq_record_id, *
    FROM ({' UNION ALL '.join(_rule_all_dates_sql(r) for r in rules)}) u"""


cte("dq_metrics_all", ["book", "bdx", "dkx"], metrics_sql(POSITION_RULES))
cte("dq_metrics", ["dq_metrics_all"], f"SELECT * FROM dq_metrics_all WHERE partition_date = {D}")
cte("rpt_lcr", ["book", "cashflow", "seed_hqla_classification"], _lcr_sql(DEFAULT_HQLA_TYPE))
cte("rpt_nsfr", ["book", "seed_nsfr_factors"], NSFR_SQL)
cte("rpt_out", ["book", "seed_fr2052a_product_mapping"], OUTFLOWS_SQL)
cte("rpt_in", ["book", "seed_fr2052a_product_mapping"], INFLOWS_SQL)
cte("rpt_sup", ["book", "risk"], _supplemental_sql())



R4 = {"hist_stddev": dround("hist_stddev", 4), "zscore": dround("zscore", 4),
      "lower_threshold": dround("lower_threshold", 2), "upper_threshold": dround("upper_threshold", 2)}
METRIC_OUT = ", ".join(f"{R4[c]} AS {c}" if c in R4 else c for c in METRIC_COLUMNS)
LATE = f"partition_date >= DATE '{UPSERT_FROM.isoformat()}'"

BOOK_OUT = ("position_id, portfolio_id, instrument_id, CAST(position_qty AS DOUBLE) AS position_qty, "
            "CAST(notional_value AS DOUBLE) AS notional_value, position_type, currency, maturity_date, "
            "CAST(interest_rate AS DOUBLE) AS interest_rate, source_system, partition_date")
RISK_OUT = ("risk_record_id, portfolio_id, instrument_id, CAST(position_qty AS DOUBLE) AS position_qty, "
            "CAST(notional_value AS DOUBLE) AS notional_value, CAST(close_price AS DOUBLE) AS close_price, "
            "CAST(bid_price AS DOUBLE) AS bid_price, CAST(ask_price AS DOUBLE) AS ask_price, volume, "
            "CAST(spread_bps AS DOUBLE) AS spread_bps, CAST(yield_rate AS DOUBLE) AS yield_rate, liquidity_tier, "
            "est_days_to_liquidate, CAST(market_value AS DOUBLE) AS market_value, partition_date")
MKT_OUT = ("market_data_id, instrument_id, as_of_date, CAST(close_price AS DOUBLE) AS close_price, "
           "CAST(bid_price AS DOUBLE) AS bid_price, CAST(ask_price AS DOUBLE) AS ask_price, volume, "
           "CAST(yield_rate AS DOUBLE) AS yield_rate, CAST(spread_bps AS DOUBLE) AS spread_bps, partition_date")
STG_POS_OUT = ("position_id, portfolio_id, instrument_id, CAST(position_qty AS DOUBLE) AS position_qty, "
               "CAST(notional_value AS DOUBLE) AS notional_value, position_type, currency, maturity_date, "
               "CAST(interest_rate AS DOUBLE) AS interest_rate, partition_date")

def _definition(rule: AggRule) -> str:
    return "md5(concat_ws(chr(31), " + ", ".join(map(q, [rule.metric_expr, rule.where, *rule.group_by])) + "))"


# --- the check suite in SQL ------------------------------------------------

SUITE_TABLES = {
    "raw_market_data": "raw_market", "raw_positions_loans": "raw_loans", "raw_positions_deposits": "raw_deposits",
    "stg_market_data": "stg_mkt", "stg_positions_loans": "stg_loans", "stg_positions_deposits": "stg_deposits",
    "mart_positions": "book", "mart_liquidity_risk": "risk", "mart_cashflow_forecast": "cashflow",
    "rpt_lcr": "rpt_lcr", "rpt_nsfr": "rpt_nsfr", "rpt_fr2052a_outflows": "rpt_out", "rpt_fr2052a_inflows": "rpt_in",
    "rpt_fr2052a_supplemental": "rpt_sup", "mart_positions_dq_metrics": "dq_metrics",
    **{s: s for s in SEED_SQL},
}


def failing_sql(spec: CheckSpec) -> tuple[str, list[str]]:
    t = SUITE_TABLES[spec.table]
    c, p, k = spec.column, spec.params, spec.kind
    deps = [t]
    if k == "not_null":
        s = f"SELECT * FROM {t} WHERE {c} IS NULL"
    elif k == "unique":
        s = f"SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    elif k == "accepted_values":
        s = f"SELECT {c} FROM {t} WHERE {c} NOT IN ({', '.join(q(v) for v in p['values'])}) GROUP BY {c}"
    elif k == "between":
        conds = []
        if p.get("min_value") is not None:
            conds.append(f"{c} < {p['min_value']}")
        if p.get("max_value") is not None:
            conds.append(f"{c} > {p['max_value']}")
        s = f"SELECT * FROM {t} WHERE {' OR '.join(conds)}"
    elif k == "row_count_between":
        s = f"SELECT n FROM (SELECT count(*) AS n FROM {t}) x WHERE n < {p['min_value']}"
    elif k == "recency":
        s = (f"SELECT m FROM (SELECT max({c}) AS m FROM {t}) x WHERE m IS NULL OR CAST(m AS TIMESTAMP) < "
             f"TIMESTAMP '{RECENCY_CLOCK.isoformat(sep=' ')}' - INTERVAL {p['interval_days']} DAY")
    elif k == "relationships":
        pt = SUITE_TABLES[p["to"]]
        deps.append(pt)
        s = (f"SELECT {c} FROM {t} x WHERE {c} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {pt} y WHERE y.{p['field']} = x.{c})")
    elif k == "expression_is_true":
        s = f"SELECT * FROM {t} WHERE partition_date = {D} AND NOT ({p['expression']})"
    elif k == "forecast_has_30_days":
        s = (f"SELECT portfolio_id FROM {t} WHERE partition_date = {D} "
             f"GROUP BY portfolio_id, partition_date HAVING count(*) != 30")
    elif k == "both_sources":
        s = (f"SELECT e FROM (VALUES ('LOANS'), ('DEPOSITS')) AS v(e) WHERE NOT EXISTS "
             f"(SELECT 1 FROM {t} WHERE partition_date = {D} AND source_system = e)")
    elif k == "market_data_present":
        deps.append("stg_mkt")
        s = (f"SELECT * FROM {t} r WHERE r.partition_date = {D} AND NOT EXISTS (SELECT 1 FROM stg_mkt m "
             f"WHERE m.instrument_id = r.instrument_id AND m.partition_date = r.partition_date)")
    elif k == "no_outliers":
        s = f"SELECT * FROM {t} WHERE partition_date = {D} AND is_outlier"
    else:
        raise ValueError(k)
    return s, deps


def suite_results_sql() -> tuple[str, list[str]]:
    parts, deps = [], []
    for spec in DECLARED:
        s, d = failing_sql(spec)
        deps += d
        parts.append(f"SELECT {q(spec.check_id)} AS check_id, {q(spec.table)} AS table_name, "
                     f"{q(spec.severity)} AS severity, count(*) AS failures, "
                     f"CASE WHEN count(*) = 0 THEN 'pass' ELSE "
                     f"{q('fail' if spec.severity == 'error' else 'warn')} END AS status, "
                     f"CASE WHEN count(*) > 0 THEN 'Got ' || CAST(count(*) AS VARCHAR) || "
                     f"CASE WHEN count(*) = 1 THEN ' result' ELSE ' results' END || "
                     f"', configured to {spec.severity} if != 0' END AS message FROM ({s}) f")
    return " UNION ALL ".join(parts), deps


_SUITE_SQL, _SUITE_DEPS = suite_results_sql()
cte("check_results", _SUITE_DEPS, _SUITE_SQL)

# --- per-query SQL ------------------------------------------------------------

_REF_IDS = "[" + ", ".join(q(r[0]) for r in seeds.INSTRUMENT_REFERENCE) + "]"

QUERY_SQL: dict[str, tuple[list[str], str]] = {
    "stage_market_data": (["stg_mkt"], f"SELECT {MKT_OUT} FROM stg_mkt"),
    "stage_positions_loans": (["stg_loans"], f"SELECT {STG_POS_OUT} FROM stg_loans"),
    "stage_positions_deposits": (["stg_deposits"], f"SELECT {STG_POS_OUT} FROM stg_deposits"),
    "unify_positions": (["book"], f"SELECT {BOOK_OUT} FROM book"),
    "liquidity_risk": (["risk"], f"SELECT {RISK_OUT} FROM risk"),
    "liquidity_tier_summary": (["risk"], """
        SELECT portfolio_id, partition_date, liquidity_tier, count(*) AS position_count,
               CAST(sum(notional_value) AS DOUBLE) AS total_notional,
               CAST(sum(market_value) AS DOUBLE) AS total_market_value,
               max(est_days_to_liquidate) AS max_days_to_liquidate
        FROM risk GROUP BY portfolio_id, partition_date, liquidity_tier"""),
    "cashflow_forecast": (["cashflow"], """
        SELECT forecast_id, portfolio_id, forecast_date, CAST(projected_inflow AS DOUBLE) AS projected_inflow,
               CAST(projected_outflow AS DOUBLE) AS projected_outflow, CAST(net_cashflow AS DOUBLE) AS net_cashflow,
               CAST(cumulative_cashflow AS DOUBLE) AS cumulative_cashflow, partition_date FROM cashflow"""),
    "lcr": (["rpt_lcr"], "SELECT * FROM rpt_lcr"),
    "lcr_instrument_master": (["book", "cashflow", "seed_hqla_classification"], _lcr_sql(MASTER_HQLA_TYPE)),
    "nsfr": (["rpt_nsfr"], "SELECT * FROM rpt_nsfr"),
    "fr2052a_outflows": (["rpt_out"], "SELECT * FROM rpt_out"),
    "fr2052a_inflows": (["rpt_in"], "SELECT * FROM rpt_in"),
    "fr2052a_supplemental": (["rpt_sup"], "SELECT * FROM rpt_sup"),
    "trailing_business_dates": (["bdx"], dq_dates_sql(60)),
    "agg_threshold_metrics": (["dq_metrics"], f"SELECT {METRIC_OUT} FROM dq_metrics"),
    "agg_threshold_metrics_all_dates": (["dq_metrics_all"], f"SELECT {METRIC_OUT} FROM dq_metrics_all"),
    "dq_daily_values": (["book"], " UNION ALL ".join(
        f"""SELECT {sk(q(r.name), _definition(r), 'dims_json', 'CAST(partition_date AS VARCHAR)')} AS dq_daily_id,
               {q(r.name)} AS rule_name, {_definition(r)} AS definition, dims_json, partition_date,
               CAST(CAST(v AS DECIMAL(38,10)) AS DOUBLE) AS metric_decimal, CAST(NULL AS DOUBLE) AS metric_double
        FROM (SELECT partition_date, {("CAST(json_object(" + ", ".join(f"'{c}', {c}" for c in r.group_by)
                                         + ") AS VARCHAR)") if r.group_by else "'{}'"} AS dims_json,
                     {r.metric_expr} AS v
              FROM book WHERE ({r.where}) GROUP BY partition_date{"".join(", " + c for c in r.group_by)}) d"""
        for r in POSITION_RULES)),
    "surrogate_key": (["book"], f"""
        SELECT position_id, {sk('portfolio_id', 'instrument_id', 'maturity_date')} AS maturity_key,
               {sk('currency', 'interest_rate')} AS rate_key FROM book"""),
    "cents_to_dollars": ([], """
        SELECT l_orderkey, l_linenumber,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01, 2) AS DOUBLE) AS extendedprice_dollars,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * 0.01, 4) AS DOUBLE) AS extendedprice_dollars_4
        FROM lineitem"""),
    "maturity_bucket": (["book"], f"""
        SELECT position_id, {_fr()} AS fr2052a_bucket,
               {NSFR_BUCKET.format(m='maturity_date', d='partition_date')} AS nsfr_bucket,
               {BUCKET_ORDER.format(b=_fr())} AS bucket_order FROM book"""),
    "seed_lookup": (["book", "instrument_reference"], f"""
        SELECT r.asset_class, r.exchange, b.partition_date, count(*) AS position_count,
               CAST(sum(b.notional_value) AS DOUBLE) AS total_notional
        FROM book b LEFT JOIN instrument_reference r ON r.instrument_id =
             list_extract({_REF_IDS}, CAST(regexp_extract(b.instrument_id, '(\\d+)$', 1) AS INTEGER) % 10 + 1)
        GROUP BY r.asset_class, r.exchange, b.partition_date"""),
    "check_not_null": (["risk"], """
        SELECT risk_record_id, portfolio_id, instrument_id, partition_date FROM risk WHERE market_value IS NULL"""),
    "check_unique": (["risk"], """
        SELECT risk_record_id AS unique_field, count(*) AS n_records FROM risk WHERE risk_record_id IS NOT NULL
        GROUP BY risk_record_id HAVING count(*) > 1"""),
    "check_unique_digest": (["risk"], """
        SELECT risk_record_id AS unique_field, count(*) AS n_records FROM risk WHERE risk_record_id IS NOT NULL
        GROUP BY risk_record_id HAVING count(*) > 1"""),
    "quarantine": (["raw_loans"], """
        WITH marked AS (
          SELECT partition_date, CAST(notional_value AS DECIMAL(18,2)) AS amount,
                 instrument_id = 'INS9' AS bad_qty, instrument_id = 'INS5' AND position_type = 'LONG' AS long_amount,
                 instrument_id = 'INS6' AND position_type = 'LONG' AS no_amount,
                 portfolio_id IN ('PF3', 'PF4') AND instrument_id IN ('INS5', 'INS7') AS bad_date,
                 instrument_id = 'INS8' AND position_type <> 'SHORT' AS no_currency
          FROM raw_loans),
        rows_of AS (SELECT *, if(bad_qty OR long_amount OR no_amount OR bad_date OR no_currency, 'quarantine', 'kept') AS part,
                           if(long_amount OR no_amount, NULL, amount) AS read_amount FROM marked)
        SELECT partition_date, part, NULL::VARCHAR AS column_name, NULL::VARCHAR AS value, NULL::VARCHAR AS reason,
               count(*) AS n, CAST(sum(read_amount) AS DOUBLE) AS notional FROM rows_of GROUP BY partition_date, part
        UNION ALL
        SELECT partition_date, 'value', c, v, r, count(*), NULL FROM (
          SELECT partition_date, 'position_qty' AS c, 'n/a' AS v, 'not_a_number' AS r FROM marked WHERE bad_qty
          UNION ALL SELECT partition_date, 'notional_value', repeat('9', 25), 'does_not_fit' FROM marked WHERE long_amount
          UNION ALL SELECT partition_date, 'notional_value', ' ', 'blank' FROM marked WHERE no_amount
          UNION ALL SELECT partition_date, 'maturity_date', '31/12/2024', 'not_a_date' FROM marked WHERE bad_date
          UNION ALL SELECT partition_date, 'currency', NULL, 'missing' FROM marked WHERE no_currency) x
        GROUP BY partition_date, c, v, r"""),
    "declared_scan": (["raw_loans"], """
        SELECT CAST(partition_date AS VARCHAR) AS what, count(*) AS n_rows,
               CAST(sum(CAST(notional_value AS DECIMAL(18,2))) AS DOUBLE) AS notional FROM raw_loans GROUP BY partition_date
        UNION ALL SELECT 'maturity_date: date, declared string', NULL, NULL
        UNION ALL SELECT 'desk: missing, declared string', NULL, NULL"""),
    "check_accepted_values": (["book"], """
        SELECT position_type AS value_field, count(*) AS n_records FROM book
        WHERE position_type NOT IN ('LONG', 'SHORT', 'HEDGE') GROUP BY position_type"""),
    "check_relationships": (["cashflow", "book"], """
        SELECT c.portfolio_id AS from_field FROM cashflow c WHERE c.portfolio_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM book p WHERE p.portfolio_id = c.portfolio_id)"""),
    "check_between": (["stg_mkt"], f"SELECT {MKT_OUT} FROM stg_mkt WHERE spread_bps < 0 OR spread_bps > 10000"),
    "check_row_count": (["book"], "SELECT row_count FROM (SELECT count(*) AS row_count FROM book) x WHERE row_count < 1"),
    "check_recency": (["risk"], f"""
        SELECT most_recent, strftime(threshold, '%Y-%m-%d %H:%M:%S') AS threshold FROM (
          SELECT max(partition_date) AS most_recent,
                 TIMESTAMP '{RECENCY_CLOCK.isoformat(sep=' ')}' - INTERVAL 2 DAY AS threshold FROM risk) x
        WHERE most_recent IS NULL OR CAST(most_recent AS TIMESTAMP) < threshold"""),
    "check_expression": (["dq_metrics"], f"""
        SELECT dq_record_id, rule_name, dims_json FROM dq_metrics
        WHERE partition_date = {D} AND NOT (NOT is_outlier)"""),
    "check_positive_when_not_null": (["book"], """
        SELECT CAST(position_qty AS DOUBLE) AS value_field FROM book
        WHERE position_qty IS NOT NULL AND position_qty <= 0"""),
    "check_freshness": (["raw_market", "raw_loans", "raw_deposits"], " UNION ALL ".join(f"""
        SELECT '{name}' AS source_table, strftime(m, '%Y-%m-%d %H:%M:%S') AS max_loaded_at,
               CAST(epoch(TIMESTAMP '{FRESHNESS_CLOCK.isoformat(sep=' ')}') - epoch(m) AS BIGINT) AS age_seconds,
               CASE WHEN m IS NULL THEN 'error'
                    WHEN epoch(TIMESTAMP '{FRESHNESS_CLOCK.isoformat(sep=' ')}') - epoch(m) > 48 * 3600 THEN 'error'
                    WHEN epoch(TIMESTAMP '{FRESHNESS_CLOCK.isoformat(sep=' ')}') - epoch(m) > 24 * 3600 THEN 'warn'
                    ELSE 'pass' END AS status
        FROM (SELECT max(_ingestion_ts) AS m FROM {t}) x"""
        for name, t in (("market_data", "raw_market"), ("positions_loans", "raw_loans"),
                        ("positions_deposits", "raw_deposits")))),
    "assert_forecast_30_days": (["cashflow"], """
        SELECT portfolio_id, partition_date, count(*) AS forecast_days FROM cashflow
        GROUP BY portfolio_id, partition_date HAVING count(*) != 30"""),
    "assert_both_sources": (["book"], """
        SELECT d.partition_date, e.s AS missing_source_system
        FROM (SELECT DISTINCT partition_date FROM book) d CROSS JOIN (VALUES ('LOANS'), ('DEPOSITS')) AS e(s)
        WHERE NOT EXISTS (SELECT 1 FROM book b WHERE b.partition_date = d.partition_date AND b.source_system = e.s)"""),
    "assert_market_data_present": (["risk", "stg_mkt"], """
        SELECT r.risk_record_id, r.instrument_id, r.partition_date FROM risk r WHERE NOT EXISTS (
          SELECT 1 FROM stg_mkt m WHERE m.instrument_id = r.instrument_id AND m.partition_date = r.partition_date)"""),
    "assert_no_outliers": (["dq_metrics"], "SELECT " + ", ".join(
        f"{R4[c]} AS {c}" if c in R4 else c for c in [
            "partition_date", "rule_name", "dims_json", "current_value", "hist_n", "hist_mean", "hist_stddev",
            "lower_threshold", "upper_threshold", "zscore", "stddev_multiplier", "lookback_business_days",
            "min_history_days", "metric_expr", "filter_sql", "group_by_cols"])
        + f" FROM dq_metrics WHERE partition_date = {D} AND is_outlier"),
    "dq_check_results": (["check_results"], "SELECT * FROM check_results"),
    "dq_summary": (["check_results"], """
        SELECT count(*) AS total_tests, count(*) FILTER (WHERE status = 'pass') AS passed,
               count(*) FILTER (WHERE status = 'fail') AS failed, count(*) FILTER (WHERE status = 'warn') AS warned
        FROM check_results"""),
    "assertion_events": (["check_results", "dq_metrics"], f"""
        SELECT 'dbt_' || replace(check_id, '.', '_') AS assertion_id,
               '{RUN_ID}::' || 'dbt_' || replace(check_id, '.', '_') AS run_id, table_name AS assertee_table,
               CASE WHEN status = 'pass' THEN 'SUCCESS' ELSE 'FAILURE' END AS result_type, {D} AS partition_date,
               CAST(NULL AS VARCHAR) AS rule_name, CAST(NULL AS VARCHAR) AS dims_json,
               CAST({D} AS VARCHAR) AS native_partition_date, CAST(NULL AS VARCHAR) AS native_rule_name,
               CAST(NULL AS VARCHAR) AS native_dims_json, coalesce(message, '') AS native_message,
               CAST(failures AS VARCHAR) AS native_failures, status AS native_status,
               CAST(NULL AS VARCHAR) AS native_group_by_cols, CAST(NULL AS VARCHAR) AS native_filter_sql,
               CAST(NULL AS VARCHAR) AS native_metric_expr, CAST(NULL AS VARCHAR) AS native_hist_n,
               CAST(NULL AS VARCHAR) AS native_lookback_business_days, CAST(NULL AS VARCHAR) AS native_min_history_days,
               CAST(NULL AS VARCHAR) AS native_is_outlier
        FROM check_results
        UNION ALL
        SELECT 'dq_' || replace(rule_name, ' ', '_') || '__' || substr(sha1(coalesce(dims_json, '{{}}')), 1, 12),
               '{RUN_ID}::dq::' || rule_name || '::' || substr(sha1(coalesce(dims_json, '{{}}')), 1, 12),
               'mart_positions', CASE WHEN is_outlier THEN 'FAILURE' ELSE 'SUCCESS' END, partition_date,
               rule_name, coalesce(dims_json, '{{}}'), CAST(partition_date AS VARCHAR), rule_name,
               coalesce(dims_json, '{{}}'), NULL, NULL, NULL, group_by_cols, filter_sql, metric_expr,
               CAST(hist_n AS VARCHAR), CAST(lookback_business_days AS VARCHAR), CAST(min_history_days AS VARCHAR),
               if(is_outlier, 'True', 'False')
        FROM dq_metrics WHERE partition_date = {D}"""),
    "upsert": (["book"], f"""
        SELECT {BOOK_OUT} FROM book WHERE source_system = 'LOANS' AND partition_date < DATE '{UPSERT_FROM.isoformat()}'
        UNION ALL SELECT {BOOK_OUT} FROM book WHERE partition_date >= DATE '{UPSERT_FROM.isoformat()}'"""),
    "ingest_raw": (["raw_loans"], f"""
        SELECT portfolio_id, instrument_id, CAST(CAST(position_qty AS DECIMAL(18,4)) AS DOUBLE) AS position_qty,
               CAST(CAST(notional_value AS DECIMAL(18,2)) AS DOUBLE) AS notional_value, position_type, currency,
               maturity_date, CAST(CAST(interest_rate AS DECIMAL(10,6)) AS DOUBLE) AS interest_rate,
               partition_date, 'LMS' AS source_system
        FROM raw_loans WHERE partition_date = {D}"""),
    "stream_ingest": (["raw_loans"], """
        SELECT portfolio_id, instrument_id, CAST(CAST(position_qty AS DECIMAL(18,4)) AS DOUBLE) AS position_qty,
               CAST(CAST(notional_value AS DECIMAL(18,2)) AS DOUBLE) AS notional_value, position_type, currency,
               maturity_date, CAST(CAST(interest_rate AS DECIMAL(10,6)) AS DOUBLE) AS interest_rate,
               partition_date, 'LMS' AS source_system
        FROM raw_loans"""),
    "stream_merge": (["raw_loans"], """
        SELECT portfolio_id, instrument_id, CAST(CAST(position_qty AS DECIMAL(18,4)) AS DOUBLE) AS position_qty,
               CAST(CAST(notional_value AS DECIMAL(18,2)) AS DOUBLE) AS notional_value, position_type, currency,
               maturity_date, CAST(CAST(interest_rate AS DECIMAL(10,6)) AS DOUBLE) AS interest_rate,
               partition_date, CAST(_ingestion_ts AS DATE) AS _ingestion_ts
        FROM raw_loans QUALIFY row_number() OVER (
            PARTITION BY portfolio_id, instrument_id, position_type, partition_date
            ORDER BY _ingestion_ts DESC NULLS LAST, position_qty DESC NULLS LAST, notional_value DESC NULLS LAST,
                     currency DESC NULLS LAST, maturity_date DESC NULLS LAST, interest_rate DESC NULLS LAST) = 1"""),
    "compact_small_files": (["book"], """
        SELECT source_system, CAST(count(*) AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS files, CAST(1 AS BIGINT) AS kept_files,
               CAST(4 AS BIGINT) AS rewritten, CAST(0 AS BIGINT) AS rewritten_again
        FROM book GROUP BY source_system"""),
    "footer_checks": (["book"], """
        SELECT 'row_count' AS check_name, CAST(count(*) AS VARCHAR) AS value FROM book
        UNION ALL SELECT 'recency', CAST(max(partition_date) AS VARCHAR) FROM book
            HAVING max(partition_date) < TIMESTAMP '2024-03-31 12:00:00'
        UNION ALL SELECT 'min_maturity_date', CAST(min(maturity_date) AS VARCHAR) FROM book
        UNION ALL SELECT 'max_maturity_date', CAST(max(maturity_date) AS VARCHAR) FROM book"""),
    "sync_columns": (["book"], """
        SELECT position_id, portfolio_id, instrument_id, CAST(position_qty AS DOUBLE) AS position_qty,
               CAST(notional_value AS DOUBLE) AS notional_value, position_type, currency, maturity_date,
               CAST(NULL AS DOUBLE) AS interest_rate, source_system, partition_date FROM book"""),
    "compact_partition": (["book"], f"SELECT {BOOK_OUT}, CASE WHEN partition_date = {D} THEN 1 END AS files_of_day FROM book"),
    "stored_failures": (["risk"], f"SELECT {RISK_OUT} FROM risk WHERE market_value IS NULL"),
    "upsert_update": (["book"], f"""
        SELECT {BOOK_OUT.replace('CAST(notional_value AS DOUBLE)', f"CAST(notional_value * if(source_system = 'LOANS' AND {LATE}, 2, 1) AS DOUBLE)")}
        FROM book"""),
    "upsert_null_partition": (["book"], f"""
        SELECT {BOOK_OUT.replace('source_system, partition_date', f"source_system, nullif(partition_date, if(instrument_id = {q(NULL_DATE_INSTRUMENT)}, partition_date, NULL)) AS partition_date")}
        FROM book"""),
    "schema_evolution": (["book"], f"""
        SELECT {BOOK_OUT.replace('CAST(interest_rate AS DOUBLE)', f"if({LATE}, CAST(interest_rate AS DOUBLE), NULL)")} FROM book"""),
    "ingest_deposits": (["raw_deposits"], f"""
        SELECT portfolio_id, instrument_id, CAST(CAST(position_qty AS DECIMAL(18,4)) AS DOUBLE) AS position_qty,
               CAST(CAST(notional_value AS DECIMAL(18,2)) AS DOUBLE) AS notional_value, position_type, currency,
               maturity_date, CAST(CAST(interest_rate AS DECIMAL(10,6)) AS DOUBLE) AS interest_rate,
               partition_date, 'CBS' AS source_system
        FROM raw_deposits WHERE partition_date = {D}"""),
    "ingest_market": (["raw_market"], f"""
        SELECT instrument_id, as_of_date, CAST(CAST(close_price AS DECIMAL(18,6)) AS DOUBLE) AS close_price,
               CAST(CAST(bid_price AS DECIMAL(18,6)) AS DOUBLE) AS bid_price,
               CAST(CAST(ask_price AS DECIMAL(18,6)) AS DOUBLE) AS ask_price, volume,
               CAST(CAST(yield_rate AS DECIMAL(10,6)) AS DOUBLE) AS yield_rate,
               CAST(CAST(spread_bps AS DECIMAL(10,2)) AS DOUBLE) AS spread_bps, partition_date
        FROM raw_market WHERE partition_date = {D}"""),
    "accepted_values_failing": (["book"], """
        SELECT position_type AS value_field, count(*) AS n_records FROM book WHERE position_type = 'HEDGE' GROUP BY ALL"""),
    "relationships_failing": (["book", "stg_mkt"], """
        SELECT instrument_id AS from_field FROM book WHERE instrument_id NOT IN (SELECT instrument_id FROM stg_mkt)"""),
    "between_failing": (["stg_mkt"], f"SELECT {MKT_OUT} FROM stg_mkt WHERE NOT spread_bps BETWEEN 5 AND 20"),
    "row_count_failing": (["book"], "SELECT count(*) AS row_count FROM book"),
    "expression_failing": (["book"], f"""
        SELECT position_id, CAST(notional_value AS DOUBLE) AS notional_value, partition_date FROM book
        WHERE {LATE} AND notional_value > {LARGE_NOTIONAL}"""),
    "forecast_days_failing": (["cashflow"], f"""
        SELECT portfolio_id, partition_date, count(*) AS forecast_days FROM cashflow GROUP BY ALL
        HAVING count(*) <> {SHORT_HORIZON}"""),
    "both_sources_failing": (["book"], """
        SELECT partition_date, s AS missing_source_system
        FROM (SELECT partition_date, unnest(['LOANS', 'DEPOSITS']) AS s,
                     unnest([bool_or(source_system = 'LOANS'),
                             bool_or(source_system = 'DEPOSITS' AND isodow(partition_date) < 6)]) AS there
              FROM (SELECT * FROM book WHERE source_system = 'LOANS' OR isodow(partition_date) < 6) left_over
              GROUP BY partition_date) d
        WHERE NOT there"""),
    "no_outliers_failing": (["book", "bdx", "dkx"], "SELECT " + ", ".join(
        f"{R4[c]} AS {c}" if c in R4 else c for c in METRIC_COLUMNS if c not in ("dq_record_id", "is_outlier"))
        + f" FROM ({metrics_sql(TIGHT_RULES)}) m WHERE partition_date = {D} AND is_outlier"),
    "threshold_null_days": (["book", "bdx", "dkx"],
                            f"SELECT {METRIC_OUT} FROM ({metrics_sql(NULL_DAY_RULES)}) m WHERE partition_date = {D}"),
    "threshold_null_days_all_dates": (["book", "bdx", "dkx"], f"SELECT {METRIC_OUT} FROM ({metrics_sql(NULL_DAY_RULES)}) m"),
    "agg_threshold_metrics_from_daily": (["dq_metrics"], f"SELECT {METRIC_OUT} FROM dq_metrics"),
    "stage_market_incremental": (["stg_mkt"], f"SELECT {MKT_OUT} FROM stg_mkt WHERE partition_date = {D}"),
    "stage_loans_incremental": (["stg_loans"], f"SELECT {STG_POS_OUT} FROM stg_loans WHERE partition_date = {D}"),
    "stage_loans_stamped": (["stg_loans"], f"SELECT {STG_POS_OUT.replace(', partition_date', '')}, {D} AS partition_date FROM stg_loans"),
    "daily_run": (["rpt_lcr", "rpt_nsfr", "rpt_out", "rpt_in", "rpt_sup"], " UNION ALL ".join(
        f"SELECT {q(t)} AS report, portfolio_id, partition_date, {k} AS record_id, CAST({v} AS DOUBLE) AS amount "
        f"FROM {c} WHERE partition_date = {D}" for t, c, k, v in (
            ("rpt_lcr", "rpt_lcr", "lcr_record_id", "total_hqla"), ("rpt_nsfr", "rpt_nsfr", "nsfr_record_id", "total_asf"),
            ("rpt_fr2052a_outflows", "rpt_out", "outflow_record_id", "gross_amount"),
            ("rpt_fr2052a_inflows", "rpt_in", "inflow_record_id", "gross_amount"),
            ("rpt_fr2052a_supplemental", "rpt_sup", "supplemental_record_id", "reported_amount")))),
    "supplemental_levels": (["book", "risk"], _supplemental_sql(
        f"(CASE {_INS} % 4 WHEN 0 THEN '1' WHEN 1 THEN '2A' ELSE 'NON_HQLA' END)",
        f"(SELECT * REPLACE (if({_INS} % 3 = 0, 0, notional_value) AS notional_value) FROM book)")),
}


def _closure(deps: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for d in deps:
        visit(d)
    return seen


def build(name: str) -> str:
    deps, body = QUERY_SQL[name]
    names = _closure(deps)
    body = body.strip()
    if body.upper().startswith("WITH"):
        body = f"SELECT * FROM ({body}) q"
    if not names:
        return body
    with_ = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in names)
    return f"WITH {with_}\n{body}"


# Stored in another way, with the same rows.
for _name in ("liquidity_risk", "cashflow_forecast"):
    QUERY_SQL[f"bucketed_{_name}"] = QUERY_SQL[_name]


def oracle_sql() -> dict[str, str]:
    return {name: build(name) for name in QUERY_SQL}
