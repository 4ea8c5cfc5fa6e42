"""DuckDB SQL for every registered query (the correctness oracle).

Each statement starts from the pre-registered tables (events, customer,
nation, region) and rebuilds what it needs with CTEs. The formulation is
deliberately different from the Spark plans (window-based de-duplication,
``quantile_cont``, plain ``lag``), so agreement is evidence, not an echo.
"""

from __future__ import annotations

from paylake.plans.staging import STAGING_COLUMNS
from paylake.schemas import ALERT_REASONS, FACT_COLUMNS, NULL_TOKENS, RAW_COLUMNS, TOPIC_NAME, TYPE_LABELS

WS = r"'^\s+|\s+$'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pad(n: str, width: int) -> str:
    """At least ``width`` digits; longer numbers keep all of theirs."""
    return f"(CASE WHEN length(CAST({n} AS VARCHAR)) >= {width} THEN CAST({n} AS VARCHAR) ELSE lpad(CAST({n} AS VARCHAR), {width}, '0') END)"


NULL_LIST = ", ".join(_q(t) for t in NULL_TOKENS)


def hu(num: str, den: str, digits: int = 2, scale: int = 1) -> str:
    """Exact half-away-from-zero ``round(num/den*scale, digits)`` as DOUBLE."""
    p = 10 ** digits
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {d} <> 0 THEN CAST((abs({n}) * {2 * p * scale} + abs({d})) // (2 * abs({d})) AS DOUBLE)"
            f" / {p}.0 * sign({n}) * sign({d}) END)")


def cents(x: str) -> str:
    return f"CAST({x} * 100 AS HUGEINT)"


def avg_money(total: str, count: str) -> str:
    return hu(cents(total), f"({count}) * 100", 2)


_LABEL_CASE = "CASE " + " ".join(f"WHEN transaction_type = {_q(k)} THEN {_q(v)}" for k, v in TYPE_LABELS.items()) \
    + " ELSE 'Unknown' END"

_norm = ",\n    ".join(f"CASE WHEN {c} IN ({NULL_LIST}) THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS)

BASE = f"""
geo AS (
  SELECT c.c_custkey, r.r_name
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
         CASE WHEN g.r_name = 'MIDDLE EAST' THEN 'Brong-Ahafo' ELSE g.r_name END AS region_name,
         CAST(e.value AS DECIMAL(12,2)) * 10 AS amt
  FROM events e LEFT JOIN geo g ON e.user_id = g.c_custkey
),
raw0 AS (
  SELECT event_id * 2 AS ingest_seq,
    CASE WHEN event_id % 101 = 7 THEN NULL ELSE 'TXN' || {pad('event_id', 8)} END AS transaction_id,
    CASE WHEN event_id % 103 = 5 THEN 'invalid_date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp,
    CASE WHEN event_id % 89 = 3 THEN NULL ELSE '024' || {pad('user_id', 7)} END AS sender_msisdn,
    '055' || {pad('(user_id * 7919 + event_id * 31) % 500', 7)} AS receiver_msisdn,
    CASE WHEN event_id % 97 = 11 THEN 'N/A' WHEN event_id % 109 = 13 THEN '-5.00'
         WHEN event_id % 113 = 17 THEN 'NaN' ELSE CAST(amt AS VARCHAR) END AS amount,
    CASE WHEN event_id % 37 = 0 THEN 'USD' ELSE 'GHS' END AS currency,
    CASE event_type WHEN 'click' THEN 'P2P' WHEN 'view' THEN 'mbp ' WHEN 'purchase' THEN 'WDR'
         WHEN 'signup' THEN 'DEP' WHEN 'error' THEN 'XYZ' END AS transaction_type,
    CASE user_id % 3 WHEN 0 THEN 'MTN' WHEN 1 THEN ' Vodafone' ELSE 'AirtelTigo' END AS operator,
    CASE event_id % 25 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'REVERSED'
         WHEN 3 THEN 'failed ' ELSE 'SUCCESS' END AS status,
    region_name AS region,
    CASE WHEN event_id % 61 = 0 THEN 'N/A'
         ELSE CAST(CAST(round(amt * 0.01, 2) AS DECIMAL(18,2)) AS VARCHAR) END AS fee
  FROM ev
),
raw_unnormalised AS (
  SELECT * FROM raw0
  UNION ALL
  SELECT * REPLACE (ingest_seq + 1 AS ingest_seq) FROM raw0 WHERE (ingest_seq // 2) % 107 = 19
),
raw AS (
  SELECT ingest_seq,
    {_norm}
  FROM raw_unnormalised
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_seq) AS rn,
         count(*) OVER (PARTITION BY transaction_id) AS copies
  FROM raw
),
survivors AS (
  SELECT * EXCLUDE (rn, copies) FROM numbered WHERE transaction_id IS NOT NULL AND rn = 1
),
parsed AS (
  SELECT transaction_id, ingest_seq, sender_msisdn, receiver_msisdn, currency, transaction_type,
         operator, status, region,
         try_strptime(timestamp, ['%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S']) AS ts,
         TRY_CAST(regexp_replace(amount, {WS}, '', 'g') AS DECIMAL(12,2)) AS amount,
         coalesce(TRY_CAST(regexp_replace(fee, {WS}, '', 'g') AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2))) AS fee
  FROM survivors
),
classified AS (
  SELECT *, CASE WHEN ts IS NULL THEN 'invalid_timestamps'
                 WHEN amount IS NULL THEN 'invalid_amounts'
                 WHEN amount <= 0 THEN 'non_positive_amounts' END AS reject_reason
  FROM parsed
),
valid AS (
  SELECT * EXCLUDE (reject_reason) FROM classified WHERE reject_reason IS NULL
),
std AS (
  SELECT * REPLACE (
      upper(regexp_replace(transaction_type, {WS}, '', 'g')) AS transaction_type,
      upper(regexp_replace(status, {WS}, '', 'g')) AS status,
      upper(regexp_replace(operator, {WS}, '', 'g')) AS operator,
      upper(regexp_replace(currency, {WS}, '', 'g')) AS currency,
      upper(regexp_replace(region, {WS}, '', 'g')) AS region)
  FROM valid
),
p95 AS (
  SELECT quantile_cont(CAST(amount AS DOUBLE), 0.95) AS th FROM std
),
enriched AS (
  SELECT s.*,
    {_LABEL_CASE} AS transaction_type_label,
    CAST(ts AS DATE) AS txn_date,
    CAST(hour(ts) AS INTEGER) AS txn_hour,
    dayname(ts) AS txn_day_of_week,
    CAST(month(ts) AS INTEGER) AS txn_month,
    CAST(quarter(ts) AS INTEGER) AS txn_quarter,
    isodow(ts) >= 6 AS is_weekend,
    CASE WHEN amount <= 50 THEN 'Micro (<50)' WHEN amount <= 200 THEN 'Small (50-200)'
         WHEN amount <= 500 THEN 'Medium (200-500)' WHEN amount <= 1000 THEN 'Large (500-1k)'
         WHEN amount > 1000 THEN 'High Value (1k+)' END AS amount_bucket,
    coalesce(CAST(amount AS DOUBLE) >= (SELECT th FROM p95), false) AS is_high_value,
    CASE WHEN sender_msisdn IS NOT NULL THEN
      lag(ts) OVER (PARTITION BY sender_msisdn ORDER BY ts, transaction_id) END AS prev_ts,
    CAST(amount + fee AS DECIMAL(20,2)) AS total_debit
  FROM std s
),
clean AS (
  SELECT * EXCLUDE (prev_ts, ts),
    ts AS timestamp,
    (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 AS time_since_last_txn_sec,
    coalesce((epoch_us(ts) - epoch_us(prev_ts)) / 1e6 < 120, false) AS is_rapid_succession,
    CASE WHEN prev_ts IS NOT NULL THEN
      sign(epoch_us(ts) - epoch_us(prev_ts)) * ((2 * abs(epoch_us(ts) - epoch_us(prev_ts)) + 10000) // 20000)
    END AS gap_cents
  FROM enriched
),
fact AS (
  SELECT transaction_id, timestamp, txn_date, txn_hour, txn_day_of_week, txn_month, txn_quarter,
         is_weekend, sender_msisdn, receiver_msisdn, amount, fee, total_debit, currency,
         transaction_type, transaction_type_label, amount_bucket, operator, status, region,
         is_high_value, is_rapid_succession, gap_cents / 100.0 AS time_since_last_txn_sec, ingest_seq
  FROM clean
),
stg AS (
  SELECT transaction_id,
    timestamp AS transaction_timestamp, txn_date AS transaction_date, txn_hour AS transaction_hour,
    txn_day_of_week AS day_of_week, txn_month AS transaction_month, txn_quarter AS transaction_quarter,
    is_weekend,
    upper(trim(sender_msisdn)) AS sender_msisdn, upper(trim(receiver_msisdn)) AS receiver_msisdn,
    amount AS transaction_amount_ghs, fee AS transaction_fee_ghs, total_debit AS total_debit_ghs,
    {hu(cents('fee'), cents('amount'), 4, 100)} AS fee_rate_pct,
    upper(transaction_type) AS transaction_type_code, transaction_type_label,
    upper(currency) AS currency, amount_bucket, upper(operator) AS operator,
    upper(status) AS transaction_status,
    CASE WHEN region IS NULL THEN NULL ELSE array_to_string(list_transform(
        regexp_extract_all(region, '([A-Za-z0-9]+|[^A-Za-z0-9]+)', 1),
        lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '') END AS region,
    is_high_value, is_rapid_succession,
    coalesce(time_since_last_txn_sec, 0) AS secs_since_last_txn
  FROM fact
  WHERE transaction_id IS NOT NULL AND amount > 0 AND status IN ('SUCCESS', 'FAILED', 'PENDING', 'REVERSED')
),
live AS (
  SELECT 'TRANSACTION' AS event_type, {_q(TOPIC_NAME)} AS topic,
    CAST((event_id + 1) % 3 AS INTEGER) AS partition,
    CAST(event_id + 1 AS BIGINT) AS "offset",
    CASE WHEN event_id % 79 = 7 THEN 'garbage' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp,
    CASE WHEN event_id % 79 <> 7 THEN ts END AS event_ts,
    'TXN-LIVE-' || {pad('event_id + 1', 8)} AS transaction_id,
    CASE WHEN event_id % 83 <> 5 THEN '024' || {pad('user_id % 10', 7)} END AS sender_msisdn,
    '055' || {pad('(user_id * 7919 + event_id * 31) % 500', 7)} AS receiver_msisdn,
    CAST(amt AS DOUBLE) AS amount_ghs,
    CAST(CAST(round(amt * 0.01, 2) AS DECIMAL(18,2)) AS DOUBLE) AS fee_ghs,
    CASE event_type WHEN 'click' THEN 'P2P' WHEN 'view' THEN 'MBP' WHEN 'purchase' THEN 'WDR'
         WHEN 'signup' THEN 'DEP' WHEN 'error' THEN 'AIRTIME' END AS transaction_type,
    CASE user_id % 3 WHEN 0 THEN 'MTN' WHEN 1 THEN 'Vodafone' ELSE 'AirtelTigo' END AS operator,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'SUCCESS' END AS status,
    region_name AS region,
    amt >= 500 AS is_high_value
  FROM ev
)
"""


def q(select: str, *ctes: str) -> str:
    """``WITH <base CTEs>, <extra CTEs> <select>``."""
    parts = [BASE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


def _dbl(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


FACT_COLS = FACT_COLUMNS
MONEY = {"amount", "fee", "total_debit", "time_since_last_txn_sec"}
FACT_SELECT = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in MONEY else c for c in FACT_COLS)

STG_MONEY = {"transaction_amount_ghs", "transaction_fee_ghs", "total_debit_ghs", "secs_since_last_txn"}
STG_COLS = STAGING_COLUMNS
STG_SELECT = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in STG_MONEY else c for c in STG_COLS)

RISK = ("CASE WHEN is_high_value AND is_rapid_succession THEN 'CRITICAL' WHEN is_high_value THEN 'HIGH' "
        "WHEN is_rapid_succession THEN 'MEDIUM' ELSE 'LOW' END")
REASON = ("CASE WHEN is_high_value AND is_rapid_succession THEN " + _q(ALERT_REASONS["CRITICAL"]) +
          " WHEN is_high_value THEN " + _q(ALERT_REASONS["HIGH"]) +
          " WHEN is_rapid_succession THEN " + _q(ALERT_REASONS["MEDIUM"]) + " ELSE " + _q(ALERT_REASONS["LOW"]) + " END")

FUNNEL = """
funnel AS (
  SELECT 'duplicate_or_null_ids' AS reject_reason,
         CAST(count(*) - count(*) FILTER (WHERE transaction_id IS NOT NULL AND rn = 1) AS BIGINT) AS rows
  FROM numbered
  UNION ALL
  SELECT coalesce(reject_reason, 'clean'), CAST(count(*) AS BIGINT) FROM classified GROUP BY 1
)"""

REPORT = f"""
fagg AS (
  SELECT CAST(coalesce(sum(rows), 0) AS BIGINT) AS raw_count,
         CAST(coalesce(sum(rows) FILTER (WHERE reject_reason = 'duplicate_or_null_ids'), 0) AS BIGINT) AS duplicate_or_null_ids,
         CAST(coalesce(sum(rows) FILTER (WHERE reject_reason = 'invalid_timestamps'), 0) AS BIGINT) AS invalid_timestamps,
         CAST(coalesce(sum(rows) FILTER (WHERE reject_reason = 'invalid_amounts'), 0) AS BIGINT) AS invalid_amounts
  FROM funnel
),
cagg AS (
  SELECT count(*) AS clean_count, count(*) FILTER (WHERE is_high_value) AS high_value_flagged,
         count(*) FILTER (WHERE is_rapid_succession) AS rapid_succession_flagged,
         count(*) FILTER (WHERE status = 'SUCCESS') AS succ
  FROM clean
),
report AS (
  SELECT (SELECT raw_count FROM fagg) AS raw_count, clean_count,
         (SELECT raw_count FROM fagg) - clean_count AS records_dropped,
         high_value_flagged, rapid_succession_flagged,
         {hu('succ', 'clean_count', 2, 100)} AS success_rate_pct,
         (SELECT duplicate_or_null_ids FROM fagg) AS duplicate_or_null_ids,
         (SELECT invalid_timestamps FROM fagg) AS invalid_timestamps,
         (SELECT invalid_amounts FROM fagg) AS invalid_amounts
  FROM cagg
)"""

OPERATOR_MART = f"""
op AS (
  SELECT operator, count(transaction_id) AS total_transactions,
    count(DISTINCT sender_msisdn) AS unique_senders, count(DISTINCT receiver_msisdn) AS unique_receivers,
    sum(transaction_amount_ghs) AS s, count(transaction_amount_ghs) AS n_amt,
    min(transaction_amount_ghs) AS mn, max(transaction_amount_ghs) AS mx, sum(transaction_fee_ghs) AS fees,
    count(*) FILTER (WHERE transaction_type_code = 'P2P') AS p2p_count,
    count(*) FILTER (WHERE transaction_type_code = 'MBP') AS merchant_payment_count,
    count(*) FILTER (WHERE transaction_type_code = 'WDR') AS withdrawal_count,
    count(*) FILTER (WHERE transaction_type_code = 'DEP') AS deposit_count,
    count(*) FILTER (WHERE transaction_status = 'SUCCESS') AS succ,
    count(*) FILTER (WHERE transaction_status = 'FAILED') AS fail,
    count(*) FILTER (WHERE is_high_value) AS high_value_transactions,
    count(*) FILTER (WHERE is_rapid_succession) AS rapid_succession_flags
  FROM stg GROUP BY operator
),
op_mart AS (
  SELECT operator, total_transactions, unique_senders, unique_receivers,
    CAST(round(s, 2) AS DOUBLE) AS total_volume_ghs,
    {avg_money('s', 'n_amt')} AS avg_transaction_ghs,
    CAST(mn AS DOUBLE) AS min_transaction_ghs, CAST(mx AS DOUBLE) AS max_transaction_ghs,
    CAST(fees AS DOUBLE) AS total_fees_collected_ghs,
    p2p_count, merchant_payment_count, withdrawal_count, deposit_count,
    {hu('succ', 'total_transactions', 2, 100)} AS success_rate_pct,
    {hu('fail', 'total_transactions', 2, 100)} AS failure_rate_pct,
    high_value_transactions, rapid_succession_flags,
    {hu('total_transactions', 'sum(total_transactions) OVER ()', 2, 100)} AS market_share_by_volume_pct,
    {hu(cents('s'), cents('sum(s) OVER ()'), 2, 100)} AS market_share_by_value_pct
  FROM op
)"""

REGION_MART = f"""
hours AS (
  SELECT region, transaction_hour, row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, transaction_hour) AS r
  FROM stg GROUP BY region, transaction_hour
),
rg AS (
  SELECT region, count(transaction_id) AS total_transactions, count(DISTINCT sender_msisdn) AS unique_customers,
    sum(transaction_amount_ghs) AS s, count(transaction_amount_ghs) AS n_amt, sum(transaction_fee_ghs) AS fees,
    count(*) FILTER (WHERE transaction_status = 'SUCCESS') AS succ,
    count(*) FILTER (WHERE is_weekend) AS weekend_transactions,
    count(*) FILTER (WHERE is_high_value) AS high_value_count,
    sum(CASE WHEN is_high_value THEN transaction_amount_ghs ELSE 0 END) AS hv
  FROM stg GROUP BY region
),
rg_mart AS (
  SELECT rg.region, total_transactions, unique_customers,
    CAST(s AS DOUBLE) AS total_volume_ghs, {avg_money('s', 'n_amt')} AS avg_transaction_ghs,
    CAST(fees AS DOUBLE) AS total_fees_ghs,
    {hu('succ', 'total_transactions', 2, 100)} AS success_rate_pct,
    CAST(h.transaction_hour AS INTEGER) AS peak_hour,
    weekend_transactions, {hu('weekend_transactions', 'total_transactions', 2, 100)} AS weekend_pct,
    high_value_count, CAST(hv AS DOUBLE) AS high_value_volume_ghs,
    {hu(cents('s'), cents('sum(s) OVER ()'), 2, 100)} AS revenue_share_pct
  FROM rg LEFT JOIN hours h ON h.region IS NOT DISTINCT FROM rg.region AND h.r = 1
)"""

GAPS = """
gaps AS (
  SELECT *, (epoch_us(event_ts) - epoch_us(lag(event_ts) OVER (PARTITION BY sender_msisdn, event_ts IS NULL ORDER BY "offset"))) / 1e6 AS gap_sec
  FROM live WHERE sender_msisdn IS NOT NULL
  UNION ALL SELECT *, NULL FROM live WHERE sender_msisdn IS NULL
),
alerts AS (
  SELECT transaction_id, amount_ghs, operator, region,
    list_filter([
      CASE WHEN is_high_value THEN 'HIGH_VALUE: GHS ' || format('{:,.2f}', amount_ghs) END,
      CASE WHEN gap_sec < 10 THEN 'RAPID_SUCCESSION: ' || format('{:.1f}', gap_sec) || 's since last txn' END,
      CASE WHEN status = 'FAILED' AND amount_ghs > 200 THEN 'FAILED_HIGH_AMOUNT: GHS ' || format('{:,.2f}', amount_ghs) END
    ], lambda x: x IS NOT NULL) AS alerts
  FROM gaps
)"""

BY_KEY = """
by_key AS (
  SELECT dimension, key, CAST(sum(amt) AS DOUBLE) AS volume_ghs, count(*) AS transactions FROM (
    SELECT 'operator' AS dimension, operator AS key, CAST(amount_ghs AS DECIMAL(12,2)) AS amt FROM live
    UNION ALL SELECT 'region', region, CAST(amount_ghs AS DECIMAL(12,2)) FROM live
    UNION ALL SELECT 'type', transaction_type, CAST(amount_ghs AS DECIMAL(12,2)) FROM live
  ) GROUP BY dimension, key
),
totals AS (
  SELECT count(*) AS total_transactions,
    CAST(coalesce(sum(CAST(amount_ghs AS DECIMAL(12,2))), 0) AS DOUBLE) AS total_volume_ghs,
    CAST(coalesce(sum(CAST(fee_ghs AS DECIMAL(12,2))), 0) AS DOUBLE) AS total_fees_ghs,
    count(*) FILTER (WHERE status = 'SUCCESS') AS successful,
    count(*) FILTER (WHERE status = 'FAILED') AS failed,
    count(*) FILTER (WHERE coalesce(is_high_value, false)) AS high_value_count
  FROM live
)"""


UPSERT = """
existing AS (
  SELECT transaction_id, timestamp, amount, fee, status, is_high_value, is_rapid_succession
  FROM clean WHERE ingest_seq % 3 <> 0
),
incoming AS (
  SELECT transaction_id, timestamp, CAST(amount + 1 AS DECIMAL(12,2)) AS amount, fee,
         'REVERSED' AS status, is_high_value, is_rapid_succession
  FROM clean WHERE ingest_seq % 3 <> 1
)"""


UPSERT_FACT = """
existing AS (SELECT * FROM fact WHERE ingest_seq % 3 <> 0),
incoming AS (
  SELECT * REPLACE (CAST(amount + 1 AS DECIMAL(12,2)) AS amount, 'REVERSED' AS status) FROM fact WHERE ingest_seq % 3 <> 1
)"""


def _sql() -> dict[str, str]:
    text_cols = ["transaction_type", "status", "operator", "currency", "region"]
    type_values = ", ".join(_q(v) for v in list(TYPE_LABELS.values()) + ["Unknown"])
    keep = lambda a, b, c: f"CASE WHEN e.transaction_id IS NOT NULL THEN e.{c} ELSE i.{c} END"
    return {
        "scan_raw": q("SELECT * FROM raw"),
        "scan_clean": q("SELECT * EXCLUDE (ingest_seq, gap_cents) REPLACE (CAST(amount AS DOUBLE) AS amount, "
                        "CAST(fee AS DOUBLE) AS fee, CAST(total_debit AS DOUBLE) AS total_debit) FROM clean"),
        "scan_fact": q(f"SELECT {FACT_SELECT} FROM fact"),
        "fact_rows": q("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, CAST(fee AS DOUBLE) AS fee, "
                       "CAST(total_debit AS DOUBLE) AS total_debit, "
                       "CAST(time_since_last_txn_sec AS DOUBLE) AS time_since_last_txn_sec, txn_hour, status "
                       "FROM fact"),
        "dedup_first": q("SELECT transaction_id, ingest_seq, "
                         + ", ".join(c for c in RAW_COLUMNS if c != "transaction_id") + " FROM survivors"),
        "reject_funnel": q("SELECT * FROM funnel", FUNNEL),
        "parse_timestamp": q("SELECT s.transaction_id, s.timestamp AS timestamp_text, p.ts AS timestamp "
                             "FROM survivors s JOIN parsed p USING (transaction_id)"),
        "parse_amount": q("SELECT s.transaction_id, s.amount AS amount_text, s.fee AS fee_text, "
                          "CAST(p.amount AS DOUBLE) AS amount, CAST(p.fee AS DOUBLE) AS fee "
                          "FROM survivors s JOIN parsed p USING (transaction_id)"),
        "standardise_text": q("SELECT transaction_id, " + ", ".join(
            f"upper(regexp_replace({c}, {WS}, '', 'g')) AS {c}" for c in text_cols) + " FROM survivors"),
        "initcap_region": q("""
SELECT region, CASE WHEN region IS NULL THEN NULL ELSE array_to_string(list_transform(
    regexp_extract_all(region, '([A-Za-z0-9]+|[^A-Za-z0-9]+)', 1),
    lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '') END AS region_title, count(*) AS rows
FROM clean GROUP BY region"""),
        "type_label": q("SELECT transaction_type, transaction_type_label, count(*) AS rows FROM clean GROUP BY 1, 2"),
        "time_dims": q("SELECT transaction_id, timestamp, txn_date, txn_hour, txn_day_of_week, txn_month, "
                       "txn_quarter, is_weekend FROM clean"),
        "amount_bucket": q("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, amount_bucket FROM clean"),
        "total_debit": q("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, CAST(fee AS DOUBLE) AS fee, "
                         "CAST(total_debit AS DOUBLE) AS total_debit FROM clean"),
        "fee_rate": q("SELECT transaction_id, fee_rate_pct FROM stg"),
        "p95_threshold": q("SELECT round(th, 6) AS p95_amount FROM p95"),
        "high_value_flag": q("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, is_high_value FROM clean"),
        "rapid_succession": q("SELECT transaction_id, sender_msisdn, timestamp, time_since_last_txn_sec, "
                              "is_rapid_succession FROM clean"),
        "quality_report": q("SELECT * FROM report", FUNNEL, REPORT),
        "summary_by_type": q("SELECT transaction_type_label, count(amount) AS txn_count, "
                             "CAST(sum(amount) AS DOUBLE) AS total_ghs FROM clean GROUP BY 1"),
        "top_regions": q("SELECT region, CAST(sum(amount) AS DOUBLE) AS total_ghs FROM clean "
                         "WHERE region IS NOT NULL GROUP BY 1 ORDER BY total_ghs DESC, region LIMIT 5"),
        "audit_row": q("""
SELECT raw_count, clean_count, high_value_flagged, rapid_succession_flagged, success_rate_pct,
  'SUCCESS' AS status,
  '{"duplicate_or_null_ids":' || duplicate_or_null_ids || ',"invalid_timestamps":' || invalid_timestamps
    || ',"invalid_amounts":' || invalid_amounts || '}' AS issues
FROM report""", FUNNEL, REPORT),
        "stg_transactions": q(f"SELECT {STG_SELECT} FROM stg"),
        "mart_daily": q(f"""
SELECT transaction_date, CAST(year(transaction_date) AS INTEGER) AS year,
  CAST(month(transaction_date) AS INTEGER) AS month, CAST(quarter(transaction_date) AS INTEGER) AS quarter,
  rpad(strftime(transaction_date, '%B'), 9, ' ') AS month_name,
  rpad(strftime(transaction_date, '%A'), 9, ' ') AS day_name,
  is_weekend, total_transactions, successful_transactions, failed_transactions, reversed_transactions,
  CAST(gross AS DOUBLE) AS gross_revenue_ghs, CAST(net AS DOUBLE) AS net_revenue_ghs,
  CAST(fees AS DOUBLE) AS total_fees_ghs, {avg_money('gross', 'n_amt')} AS avg_transaction_ghs,
  high_value_count, CAST(hv AS DOUBLE) AS high_value_revenue_ghs,
  {hu('successful_transactions', 'total_transactions', 2, 100)} AS success_rate_pct
FROM (
  SELECT transaction_date, is_weekend, count(transaction_id) AS total_transactions,
    count(*) FILTER (WHERE transaction_status = 'SUCCESS') AS successful_transactions,
    count(*) FILTER (WHERE transaction_status = 'FAILED') AS failed_transactions,
    count(*) FILTER (WHERE transaction_status = 'REVERSED') AS reversed_transactions,
    sum(transaction_amount_ghs) AS gross,
    sum(CASE WHEN transaction_status = 'SUCCESS' THEN transaction_amount_ghs ELSE 0 END) AS net,
    sum(transaction_fee_ghs) AS fees, count(transaction_amount_ghs) AS n_amt,
    count(*) FILTER (WHERE is_high_value) AS high_value_count,
    sum(CASE WHEN is_high_value THEN transaction_amount_ghs ELSE 0 END) AS hv
  FROM stg GROUP BY transaction_date, is_weekend
) d ORDER BY transaction_date"""),
        "mart_operator": q("SELECT * FROM op_mart", OPERATOR_MART),
        "mart_region": q("SELECT * FROM rg_mart", REGION_MART),
        "mart_high_value": q(f"""
SELECT transaction_id, transaction_date, transaction_hour, day_of_week, is_weekend, sender_msisdn,
  receiver_msisdn, operator, region, CAST(transaction_amount_ghs AS DOUBLE) AS transaction_amount_ghs,
  CAST(transaction_fee_ghs AS DOUBLE) AS transaction_fee_ghs, CAST(total_debit_ghs AS DOUBLE) AS total_debit_ghs,
  transaction_type_label, transaction_status, amount_bucket, currency, is_high_value, is_rapid_succession,
  CAST(secs_since_last_txn AS DOUBLE) AS secs_since_last_txn, {RISK} AS risk_level, {REASON} AS alert_reason
FROM stg WHERE is_high_value = true OR is_rapid_succession = true"""),
        "market_share": q(f"""
SELECT 'operator' AS dimension, operator AS member, market_share_by_volume_pct AS share_by_volume_pct,
       market_share_by_value_pct AS share_by_value_pct FROM op_mart
UNION ALL
SELECT 'region', region, {hu('total_transactions', 'sum(total_transactions) OVER ()', 2, 100)},
       revenue_share_pct FROM rg_mart""", OPERATOR_MART, REGION_MART),
        "peak_hour": q("SELECT region, peak_hour FROM rg_mart", REGION_MART),
        "risk_level": q(f"SELECT transaction_id, {RISK} AS risk_level, {REASON} AS alert_reason FROM stg"),
        "dq_unique": q("SELECT transaction_id, count(*) AS occurrences FROM stg WHERE transaction_id IS NOT NULL "
                       "GROUP BY 1 HAVING count(*) > 1"),
        "dq_not_null": q("""
SELECT column_name, null_rows FROM (
  SELECT 'transaction_id' AS column_name, count(*) FILTER (WHERE transaction_id IS NULL) AS null_rows FROM stg
  UNION ALL SELECT 'transaction_amount_ghs', count(*) FILTER (WHERE transaction_amount_ghs IS NULL) FROM stg
  UNION ALL SELECT 'transaction_timestamp', count(*) FILTER (WHERE transaction_timestamp IS NULL) FROM stg
  UNION ALL SELECT 'amount_bucket', count(*) FILTER (WHERE amount_bucket IS NULL) FROM stg)"""),
        "dq_accepted_operator": q("SELECT operator, count(*) AS rows FROM stg WHERE operator IS NOT NULL "
                                  "AND operator NOT IN ('MTN', 'VODAFONE', 'AIRTELTIGO') GROUP BY 1"),
        "dq_accepted_status": q("SELECT transaction_status, count(*) AS rows FROM stg "
                                "WHERE transaction_status IS NOT NULL AND transaction_status NOT IN "
                                "('SUCCESS', 'FAILED', 'PENDING', 'REVERSED') GROUP BY 1"),
        "dq_type_labels": q("SELECT transaction_type_label, count(*) AS rows FROM clean "
                            f"WHERE transaction_type_label IS NOT NULL AND transaction_type_label NOT IN ({type_values}) "
                            "GROUP BY 1"),
        "dq_positive_amount": q("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount FROM clean WHERE amount <= 0"),
        "dq_total_debit": q("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, CAST(fee AS DOUBLE) AS fee, "
                            "CAST(total_debit AS DOUBLE) AS total_debit FROM clean "
                            "WHERE total_debit IS DISTINCT FROM CAST(amount + fee AS DECIMAL(20,2))"),
        "dq_report_bounds": q("""
SELECT rule FROM (
  SELECT 'counts_add_up' AS rule, coalesce(raw_count = clean_count + records_dropped, false) AS ok FROM report
  UNION ALL SELECT 'clean_not_above_raw', coalesce(clean_count <= raw_count, false) FROM report
  UNION ALL SELECT 'rate_in_range', coalesce(success_rate_pct IS NULL OR success_rate_pct BETWEEN 0 AND 100, false)
  FROM report
) WHERE NOT ok""", FUNNEL, REPORT),
        "dq_unique_dirty": q("SELECT transaction_id, count(*) AS occurrences FROM raw WHERE transaction_id IS NOT NULL "
                             "GROUP BY 1 HAVING count(*) > 1"),
        "dq_accepted_operator_dirty": q("SELECT operator, count(*) AS rows FROM raw WHERE operator NOT IN "
                                        "('MTN', 'VODAFONE', 'AIRTELTIGO') GROUP BY 1"),
        "dq_accepted_status_dirty": q("SELECT status AS transaction_status, count(*) AS rows FROM raw WHERE status NOT IN "
                                      "('SUCCESS', 'FAILED', 'PENDING', 'REVERSED') GROUP BY 1"),
        "dq_type_labels_dirty": q("SELECT transaction_type AS transaction_type_label, count(*) AS rows FROM clean "
                                  f"WHERE ingest_seq % 5 = 0 AND transaction_type NOT IN ({type_values}) GROUP BY 1"),
        "dq_positive_amount_dirty": q("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount FROM classified WHERE amount <= 0"),
        "dq_total_debit_dirty": q("SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, CAST(fee AS DOUBLE) AS fee, "
                                  "CASE WHEN ingest_seq % 11 <> 0 THEN CAST(amount AS DOUBLE) END AS total_debit FROM clean "
                                  "WHERE ingest_seq % 11 = 0 OR (ingest_seq % 7 = 0 AND fee <> 0)"),
        "dq_report_bounds_dirty": q("SELECT unnest(['counts_add_up', 'clean_not_above_raw', 'rate_in_range']) AS rule"),
        "dirty_profile": q("""
SELECT count(*) AS raw_rows, count(*) FILTER (WHERE transaction_id IS NULL) AS null_ids,
  count(*) FILTER (WHERE amount = 'N/A') AS na_amounts, count(*) FILTER (WHERE amount = 'NaN') AS nan_amounts,
  count(*) FILTER (WHERE timestamp = 'invalid_date') AS invalid_dates,
  count(*) FILTER (WHERE sender_msisdn IS NULL) AS null_senders, count(*) FILTER (WHERE fee = 'N/A') AS na_fees,
  count(*) - count(DISTINCT transaction_id) - count(*) FILTER (WHERE transaction_id IS NULL) AS duplicate_copies
FROM raw_unnormalised"""),
        "distinct_operators": q("SELECT operator, count(*) AS rows FROM stg GROUP BY 1"),
        "fact_upsert": q(f"""
SELECT coalesce(e.transaction_id, i.transaction_id) AS transaction_id,
  {keep('e', 'i', 'timestamp')} AS timestamp,
  CAST({keep('e', 'i', 'amount')} AS DOUBLE) AS amount,
  CAST({keep('e', 'i', 'fee')} AS DOUBLE) AS fee,
  CASE WHEN i.transaction_id IS NOT NULL THEN i.status ELSE e.status END AS status,
  {keep('e', 'i', 'is_high_value')} AS is_high_value,
  {keep('e', 'i', 'is_rapid_succession')} AS is_rapid_succession
FROM existing e FULL OUTER JOIN incoming i ON e.transaction_id = i.transaction_id""", UPSERT),
        "fact_publish": q("SELECT " + ", ".join(
            (f"CAST({e} AS DOUBLE)" if c in MONEY else e) + f" AS {c}"
            for c, e in ((c, "CASE WHEN i.transaction_id IS NOT NULL THEN i.status ELSE e.status END" if c == "status"
                          else keep("e", "i", c)) for c in FACT_COLS))
            + " FROM existing e FULL OUTER JOIN incoming i ON e.transaction_id = i.transaction_id", UPSERT_FACT),
        "partition_slice": q("""
SELECT CAST(("offset" - 1) % 3 AS INTEGER) AS queue_partition, count(*) AS events,
  min("offset") AS first_offset, max("offset") AS last_offset FROM live GROUP BY 1"""),
        "fraud_alerts": q("""
SELECT transaction_id, amount_ghs, operator, region, CAST(len(alerts) AS INTEGER) AS n_alerts,
  array_to_string(alerts, ' + ') AS alerts_text
FROM alerts WHERE len(alerts) > 0""", GAPS),
        "metrics_totals": q("SELECT * FROM totals", BY_KEY),
        "metrics_by_key": q("SELECT * FROM by_key", BY_KEY),
        "metrics_snapshot": q(f"""
SELECT t.total_transactions, round(t.total_volume_ghs, 2) AS total_volume_ghs,
  round(t.total_fees_ghs, 2) AS total_fees_ghs,
  coalesce({hu('t.successful', 'greatest(t.total_transactions, 1)', 1, 100)}, 0.0) AS success_rate_pct,
  t.high_value_count,
  coalesce((SELECT key FROM by_key WHERE dimension = 'operator' AND key IS NOT NULL
            ORDER BY volume_ghs DESC, key LIMIT 1), 'N/A') AS top_operator,
  coalesce((SELECT key FROM by_key WHERE dimension = 'region' AND key IS NOT NULL
            ORDER BY volume_ghs DESC, key LIMIT 1), 'N/A') AS top_region
FROM totals t""", BY_KEY),
    }


#: The fact after two publications, the second of which brings the incoming rows of odd days.
UPSERTED = UPSERT_FACT.strip() + """,
upserted AS (
  SELECT """ + ", ".join(("CASE WHEN i.transaction_id IS NOT NULL THEN i.status ELSE e.status END" if c == "status" else
                          f"CASE WHEN e.transaction_id IS NOT NULL THEN e.{c} ELSE i.{c} END") + f" AS {c}" for c in FACT_COLUMNS) + """
  FROM existing e FULL OUTER JOIN (SELECT * FROM incoming WHERE day(txn_date) % 2 = 1) i ON e.transaction_id = i.transaction_id
)"""


def _incremental_sql(base: dict[str, str]) -> dict[str, str]:
    """The marts' SQL over the upserted fact."""
    def over_upserted(sql: str) -> str:
        out = sql.replace("\nstg AS (", "\n" + UPSERTED + ",\nstg AS (").replace("FROM fact\n  WHERE transaction_id", "FROM upserted\n  WHERE transaction_id")
        assert out.count("upserted") == 2
        return out

    out = {f"{k}_incremental": over_upserted(base[k]) for k in ("mart_daily", "mart_operator", "mart_region", "mart_high_value")}
    counts = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {m} AS member, count(DISTINCT {v}) AS n, true AS sketch_close FROM stg WHERE {v} IS NOT NULL GROUP BY {m}"
        for d, m, v in (("operator_senders", "operator", "sender_msisdn"), ("operator_receivers", "operator", "receiver_msisdn"),
                        ("region_senders", "region", "sender_msisdn")))
    return out | {"subscriber_counts": over_upserted(q(counts))}


def _stream_sql(base: dict[str, str]) -> dict[str, str]:
    live_cols = ", ".join(f'"{f}"' for f in ["event_type", "topic", "partition", "offset", "timestamp",
                                             "transaction_id", "sender_msisdn", "receiver_msisdn", "amount_ghs",
                                             "fee_ghs", "transaction_type", "operator", "status", "region",
                                             "is_high_value"])
    return {
        "stream_scan": q(f"SELECT {live_cols} FROM live"),
        "stream_log": q(f"SELECT {live_cols} FROM live"),
        "stream_rapid": q('SELECT transaction_id, "offset", sender_msisdn, gap_sec FROM gaps', GAPS),
        "stream_alerts": base["fraud_alerts"],
        "stream_alert_csv": q("""
SELECT transaction_id, amount_ghs, operator, region, array_to_string(alerts, ' + ') AS alerts
FROM alerts WHERE len(alerts) > 0""", GAPS),
        "stream_metrics": base["metrics_snapshot"],
        "stream_snapshots": q("""
SELECT CAST(g.b AS INTEGER) AS batch_id, count(*) AS total_transactions,
  round(CAST(sum(CAST(l.amount_ghs AS DECIMAL(12,2))) AS DOUBLE), 2) AS total_volume_ghs,
  count(*) FILTER (WHERE l.is_high_value) AS high_value_count
FROM (SELECT unnest([0, 1, 2, 3]) AS b) g
JOIN (SELECT min("offset") AS lo, greatest(1, (max("offset") - min("offset") + 4) // 4) AS step FROM live) s ON true
JOIN live l ON l."offset" < s.lo + (g.b + 1) * s.step
GROUP BY g.b"""),
        "stream_throughput": q("SELECT c AS consumer, count(*) AS input_rows FROM live, (SELECT unnest(['log', 'alerts', 'metrics']) AS c) GROUP BY c"),
        "csv_funnel": base["reject_funnel"],
        "csv_scan": q("SELECT " + ", ".join(
            "'Zone \"' || u.region || '\",' || chr(10) || u.transaction_type AS region" if c == "region" else f"r.{c}"
            for c in RAW_COLUMNS) + " FROM raw r JOIN raw_unnormalised u USING (ingest_seq)"),
    }


ORACLE_SQL: dict[str, str] = _sql()
ORACLE_SQL.update(_stream_sql(ORACLE_SQL))
ORACLE_SQL.update(_incremental_sql(ORACLE_SQL))
