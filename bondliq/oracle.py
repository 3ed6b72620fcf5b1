"""DuckDB SQL text for the correctness check of every registered query.

The text is independent of the Spark code: plain SQL over the driver's
tables (pre-registered views), built as one CTE chain. DuckDB notes:
``quantile_disc(x, 0.5)`` is the lower median; ``x / nullif(mid, 0)``
mirrors ``try_divide``; decimal literals are cast to DOUBLE.
"""

from __future__ import annotations

from bondliq.sources.fixtures import ANCHOR_DATE, FIXTURE_SQL, WEIGHTS


def _metrics(x: str) -> str:
    return f"""
{x}_s AS (SELECT bond, prov, "date", (ask - bid) / nullif((ask + bid) / 2, 0) AS ba_spread FROM {x}),
{x}_day AS (SELECT bond, "date", quantile_disc(ba_spread, 0.5) AS median_of_tgs FROM {x}_s GROUP BY bond, "date"),
{x}_med AS (SELECT bond, quantile_disc(median_of_tgs, 0.5) AS bid_ask_spread_relative_median
            FROM {x}_day GROUP BY bond),
{x}_cnt AS (SELECT bond, count(DISTINCT prov) AS providers_cnt, count(DISTINCT "date") AS qdays_cnt
            FROM {x}_s GROUP BY bond),
{x}_metrics AS (SELECT b.id, b.isin, m.bid_ask_spread_relative_median, c.providers_cnt, c.qdays_cnt
                FROM bonds b JOIN {x}_cnt c ON c.bond = b.id LEFT JOIN {x}_med m ON m.bond = b.id)"""


def _liquidity(anchor: str, sfx: str = "") -> str:
    w = {k: f"CAST({v!r} AS DOUBLE)" for k, v in WEIGHTS.items()}
    a = f"DATE '{anchor}'"
    return f"""
merged{sfx} AS (
  SELECT b.id, t.id AS tsq_id, b.isin, b.usd_volume, b.date_of_end_placing, b.maturity_date,
    t.bid_ask_spread_relative_median AS tsq_baspread_rel_median, t.providers_cnt AS tsq_providers_cnt,
    t.qdays_cnt AS tsq_qdays_cnt,
    o.bid_ask_spread_relative_median AS otc_baspread_rel_median, o.providers_cnt AS otc_providers_cnt,
    o.qdays_cnt AS otc_qdays_cnt
  FROM bonds b LEFT JOIN ex_metrics t ON t.id = b.id LEFT JOIN otc_metrics o ON o.id = b.id
  WHERE t.id IS NOT NULL OR o.id IS NOT NULL),
mm{sfx} AS (
  SELECT merged{sfx}.*, {a} AS anchor_date,
    CASE WHEN tsq_baspread_rel_median IS NOT NULL AND otc_baspread_rel_median IS NOT NULL
           THEN (tsq_baspread_rel_median + otc_baspread_rel_median) / 2
         WHEN tsq_baspread_rel_median IS NOT NULL THEN tsq_baspread_rel_median
         ELSE otc_baspread_rel_median END AS baspread_rel_median,
    coalesce(tsq_providers_cnt + otc_providers_cnt, tsq_providers_cnt, otc_providers_cnt) AS providers_cnt,
    coalesce(tsq_qdays_cnt, otc_qdays_cnt) AS qdays_cnt,
    CASE WHEN tsq_id IS NOT NULL THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS exchange_indicator_rank,
    CAST(datediff('day', date_of_end_placing, {a}) AS BIGINT) AS days_since_issue,
    CAST(datediff('day', {a}, maturity_date) AS BIGINT) AS days_to_maturity
  FROM merged{sfx}),
aggs{sfx} AS (
  SELECT anchor_date, CAST(max(providers_cnt) AS BIGINT) AS max_providers_cnt,
    CAST(max(qdays_cnt) AS BIGINT) AS max_qdays_cnt, CAST(count(id) AS BIGINT) AS total_bonds
  FROM mm{sfx} GROUP BY anchor_date),
mga{sfx} AS (
  SELECT mm{sfx}.*, g.max_providers_cnt, g.max_qdays_cnt, g.total_bonds
  FROM mm{sfx} JOIN aggs{sfx} g ON g.anchor_date = mm{sfx}.anchor_date),
pos{sfx} AS (
  SELECT mga{sfx}.*,
    CAST(row_number() OVER (ORDER BY baspread_rel_median DESC NULLS LAST, id ASC) AS BIGINT)
      AS pos_by_baspread_rel_median,
    CAST(row_number() OVER (ORDER BY usd_volume ASC NULLS FIRST, id ASC) AS BIGINT) AS pos_by_usd_volume
  FROM mga{sfx}),
rk{sfx} AS (
  SELECT pos{sfx}.*,
    CAST(pos_by_baspread_rel_median AS DOUBLE) / CAST(total_bonds AS DOUBLE) AS baspread_rel_rank,
    CAST(providers_cnt AS DOUBLE) / CAST(max_providers_cnt AS DOUBLE) AS providers_cnt_rank,
    CAST(pos_by_usd_volume AS DOUBLE) / CAST(total_bonds AS DOUBLE) AS usd_volume_rank,
    CASE WHEN qdays_cnt < 19 THEN CAST(0 AS DOUBLE)
         ELSE CAST(qdays_cnt AS DOUBLE) / CAST(max_qdays_cnt AS DOUBLE) END AS qdays_cnt_rank,
    {w['baspread_rel_rank_w']} AS baspread_rel_rank_w,
    {w['providers_cnt_rank_w']} AS providers_cnt_rank_w,
    {w['usd_volume_rank_w']} AS usd_volume_rank_w,
    {w['qdays_cnt_rank_w']} AS qdays_cnt_rank_w,
    {w['exchange_indicator_rank_w']} AS exchange_indicator_rank_w
  FROM pos{sfx}),
lt{sfx} AS (
  SELECT rk{sfx}.*,
    round(pow(pow(baspread_rel_rank, baspread_rel_rank_w) * pow(providers_cnt_rank, providers_cnt_rank_w)
        * pow(usd_volume_rank, usd_volume_rank_w) * pow(qdays_cnt_rank, qdays_cnt_rank_w)
        * pow(exchange_indicator_rank, exchange_indicator_rank_w),
        pow(baspread_rel_rank_w + providers_cnt_rank_w + usd_volume_rank_w + qdays_cnt_rank_w
            + exchange_indicator_rank_w, -1)), 9) AS liq_index,
    round(exp(pow(baspread_rel_rank_w + providers_cnt_rank_w + usd_volume_rank_w + qdays_cnt_rank_w
            + exchange_indicator_rank_w, -1)
        * (CASE WHEN baspread_rel_rank <> 0 THEN baspread_rel_rank_w * ln(baspread_rel_rank) ELSE 0 END
         + CASE WHEN providers_cnt_rank <> 0 THEN providers_cnt_rank_w * ln(providers_cnt_rank) ELSE 0 END
         + CASE WHEN usd_volume_rank <> 0 THEN usd_volume_rank_w * ln(usd_volume_rank) ELSE 0 END
         + CASE WHEN qdays_cnt_rank <> 0 THEN qdays_cnt_rank_w * ln(qdays_cnt_rank) ELSE 0 END
         + CASE WHEN exchange_indicator_rank <> 0
                THEN exchange_indicator_rank_w * ln(exchange_indicator_rank) ELSE 0 END)), 9) AS liq_index_skip_zero
  FROM rk{sfx})"""


LIQUIDITY_SELECT = """id, isin, date_of_end_placing, maturity_date, anchor_date, days_since_issue,
  days_to_maturity, total_bonds, tsq_baspread_rel_median, otc_baspread_rel_median, baspread_rel_median,
  pos_by_baspread_rel_median, baspread_rel_rank, baspread_rel_rank_w, tsq_providers_cnt, otc_providers_cnt,
  max_providers_cnt, providers_cnt, providers_cnt_rank, providers_cnt_rank_w, usd_volume, pos_by_usd_volume,
  usd_volume_rank, usd_volume_rank_w, tsq_qdays_cnt, otc_qdays_cnt, max_qdays_cnt, qdays_cnt, qdays_cnt_rank,
  qdays_cnt_rank_w, exchange_indicator_rank, exchange_indicator_rank_w, liq_index"""

SECOND_ANCHOR = "2001-10-31"


def base() -> str:
    views = ",\n".join(f"{name} AS ({body})" for name, body in FIXTURE_SQL.items())
    return f"""WITH {views},
bonds AS (
  SELECT CAST(id AS BIGINT) AS id, CAST(isin_code AS VARCHAR) AS isin, CAST(usd_volume AS DOUBLE) AS usd_volume,
    CAST(date_of_end_placing AS DATE) AS date_of_end_placing, CAST(maturity_date AS DATE) AS maturity_date
  FROM bonds_raw WHERE id IS NOT NULL AND isin_code IS NOT NULL),
ex_clean AS (
  SELECT CAST(bond AS BIGINT) AS bond, CAST(tg AS BIGINT) AS prov, CAST("date" AS DATE) AS "date",
    CAST(bid AS DOUBLE) AS bid, CAST(ask AS DOUBLE) AS ask
  FROM exchange_quotes_raw
  WHERE bond IS NOT NULL AND tg IS NOT NULL AND "date" IS NOT NULL AND bid IS NOT NULL AND ask IS NOT NULL
    AND tg NOT IN (327, 381)),
ex AS (SELECT q.* FROM ex_clean q JOIN bonds b ON b.id = q.bond),
otc_clean AS (
  SELECT CAST(bond AS BIGINT) AS bond, CAST(org AS BIGINT) AS prov, CAST("date" AS DATE) AS "date",
    quote_type, CAST(price AS DOUBLE) AS price
  FROM otc_quotes_raw
  WHERE bond IS NOT NULL AND org IS NOT NULL AND "date" IS NOT NULL AND price IS NOT NULL AND price > 0),
otc_listed AS (SELECT q.* FROM otc_clean q JOIN bonds b ON b.id = q.bond),
otc AS (
  SELECT bq.bond, bq.prov, bq."date", bq.price AS bid, aq.price AS ask
  FROM otc_listed bq JOIN otc_listed aq ON aq.bond = bq.bond AND aq.prov = bq.prov AND aq."date" = bq."date"
  WHERE bq.quote_type = 1 AND aq.quote_type = 2),
dense AS (SELECT * FROM exchange_quotes_dense),
{_metrics('ex')},
{_metrics('otc')},
{_metrics('dense')},
{_liquidity(ANCHOR_DATE)},
{_liquidity(SECOND_ANCHOR, '_b')}
"""


def queries() -> dict[str, str]:
    b = base()
    q = {
        "bonds_strict": "SELECT * FROM bonds",
        "strict_rejects": """SELECT CAST(id AS BIGINT) AS id, isin_code AS isin, usd_volume, date_of_end_placing,
            maturity_date FROM bonds_raw WHERE id IS NULL OR isin_code IS NULL""",
        "bond_age_days": f"""SELECT id, CAST(datediff('day', date_of_end_placing, DATE '{ANCHOR_DATE}') AS BIGINT)
            AS days_since_issue, CAST(datediff('day', DATE '{ANCHOR_DATE}', maturity_date) AS BIGINT)
            AS days_to_maturity FROM bonds""",
        "clamp_dates": """SELECT id,
            CASE WHEN date_of_end_placing > DATE '2037-12-30' THEN DATE '1970-01-01' ELSE date_of_end_placing END
              AS date_of_end_placing,
            CASE WHEN maturity_date > DATE '2037-12-30' THEN DATE '1970-01-01' ELSE maturity_date END
              AS maturity_date FROM bonds""",
        "exchange_clean": "SELECT * FROM ex_clean",
        "quotes_for_listed_bonds": "SELECT * FROM ex",
        "dedupe_by_key": """SELECT bond, prov, "date", bid, ask FROM (
            SELECT *, row_number() OVER (PARTITION BY bond, prov, "date" ORDER BY bid, ask) AS rn FROM ex)
            WHERE rn = 1""",
        "relative_spread": "SELECT * FROM ex_s",
        "median_by_bond_date": "SELECT * FROM ex_day",
        "median_by_bond_date_dense": "SELECT * FROM dense_day",
        "median_by_bond_date_otc": "SELECT * FROM otc_day",
        "median_by_bond_date_hot": """SELECT bond, "date", quantile_disc((ask - bid) / nullif((ask + bid) / 2, 0), 0.5)
            AS median_of_tgs FROM hot_rows GROUP BY bond, "date\"""",
        "median_by_bond_date_otc_hot": """SELECT b.bond, b."date",
            quantile_disc((a.ask - b.bid) / ((a.ask + b.bid) / 2), 0.5) AS median_of_tgs
            FROM hot_rows b JOIN hot_rows a ON a.bond = b.bond AND a.prov = b.prov AND a."date" = b."date"
            WHERE b.side = 0 AND a.side = 1 GROUP BY b.bond, b."date\"""",
        "csv_rejects": """SELECT l_partkey AS bond, CAST(count(*) AS BIGINT) AS bad_rows FROM lineitem
            WHERE l_orderkey % 61 = 0 GROUP BY l_partkey""",
        "median_of_medians": "SELECT * FROM ex_med",
        "median_via_sql": "SELECT * FROM ex_med",
        "quote_counts": "SELECT * FROM ex_cnt",
        "exchange_metrics": "SELECT * FROM ex_metrics",
        "otc_clean": "SELECT * FROM otc_clean",
        "otc_sides": """SELECT bond, prov, "date", 'bid' AS side, price FROM otc_listed WHERE quote_type = 1
            UNION ALL SELECT bond, prov, "date", 'ask' AS side, price FROM otc_listed WHERE quote_type = 2""",
        "otc_paired": "SELECT * FROM otc",
        "otc_metrics": "SELECT * FROM otc_metrics",
        "coverage_merge": """SELECT id, isin, usd_volume, date_of_end_placing, maturity_date,
            tsq_baspread_rel_median, tsq_providers_cnt, tsq_qdays_cnt,
            otc_baspread_rel_median, otc_providers_cnt, otc_qdays_cnt FROM merged""",
        "merge_metrics": """SELECT id, isin, anchor_date, baspread_rel_median, providers_cnt, qdays_cnt,
            exchange_indicator_rank, days_since_issue, days_to_maturity FROM mm""",
        "global_aggs": "SELECT * FROM aggs",
        "with_global_aggs": "SELECT id, anchor_date, max_providers_cnt, max_qdays_cnt, total_bonds FROM mga",
        "pos_by_spread": "SELECT id, baspread_rel_median, pos_by_baspread_rel_median FROM pos",
        "pos_by_usd_volume": "SELECT id, usd_volume, pos_by_usd_volume FROM pos",
        "ratio_ranks": "SELECT id, baspread_rel_rank, providers_cnt_rank, usd_volume_rank FROM rk",
        "qdays_rank": "SELECT id, qdays_cnt, qdays_cnt_rank FROM rk",
        "liq_index": "SELECT id, liq_index FROM lt",
        "liq_index_skip_zero": "SELECT id, liq_index_skip_zero FROM lt",
        "liquidity_table": f"SELECT {LIQUIDITY_SELECT} FROM lt",
        "daily_run": f"SELECT {LIQUIDITY_SELECT} FROM lt",
        "business_date": """SELECT event_id, CAST(ts + INTERVAL 3 HOUR - INTERVAL 10 HOUR AS DATE) AS business_date
            FROM events""",
        "anchor_date_format": """SELECT event_id, strftime(CAST(ts AS DATE), '%Y%m%d') AS anchor FROM events""",
        "scan_bonds_csv": "SELECT * FROM bonds_raw",
        "scan_exchange_csv": "SELECT * FROM exchange_quotes_raw",
        "scan_otc_csv": "SELECT * FROM otc_quotes_raw",
        "sink_full_refresh": "SELECT * FROM ex_metrics",
        "sink_parquet_csv": "SELECT * FROM otc_metrics",
        "sink_replace_date": f"""SELECT {LIQUIDITY_SELECT} FROM lt
            UNION ALL SELECT {LIQUIDITY_SELECT} FROM lt_b""",
    }
    return {k: b + v for k, v in q.items()}
