"""Layer definitions in plain SQL, used as the prefix of every DuckDB check."""

BASE = """
base AS (
  SELECT event_id, user_id, value, event_type, ts,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
    event_id % 10 AS h,
    CAST(floor(event_id / 10) AS BIGINT) % 20 AS m,
    CASE WHEN c_custkey IS NULL THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'High-Risk'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Standard' ELSE 'Premium' END AS cseg,
    300 + CAST(floor((c_acctbal + 1000) * 600 / 11000) AS INT) AS cscore
  FROM events LEFT JOIN customer ON user_id = c_custkey),
raw_tx_once AS (
  SELECT event_id AS transaction_id,
    CASE WHEN event_id % 809 = 0 THEN NULL WHEN event_id % 1200 = 7 THEN user_id + 1000000
         ELSE user_id END AS customer_id,
    CAST(CASE WHEN event_id % 401 = 0 THEN -1 ELSE 10 END * CAST(value AS DECIMAL(18,2)) AS DOUBLE)
      AS amount,
    CASE event_type WHEN 'purchase' THEN 'compra' WHEN 'signup' THEN 'saque'
         WHEN 'click' THEN 'transferencia' ELSE 'pagamento' END AS transaction_type,
    CASE WHEN h < 4 THEN 'app' WHEN h < 7 THEN 'web' WHEN h < 9 THEN 'pos' ELSE 'atm' END AS channel,
    CASE WHEN m < 6 THEN 'varejo' WHEN m < 10 THEN 'alimentacao' WHEN m < 13 THEN 'eletronico'
         WHEN m < 16 THEN 'servicos' WHEN m < 18 THEN 'viagem' ELSE 'saude' END AS merchant_category,
    ts AS timestamp,
    CASE WHEN event_id % 503 = 0 THEN 'pending' WHEN k % 12 = 0 THEN 'declined'
         ELSE 'approved' END AS status,
    CAST(CASE WHEN event_id % 601 = 0 THEN 150 ELSE k END AS DOUBLE) AS risk_score,
    CASE WHEN k = 13 THEN 'Standard' ELSE cseg END AS segment,
    CAST(CASE WHEN event_id % 701 = 0 THEN 950 WHEN cscore IS NULL THEN NULL ELSE greatest(300, cscore - k % 5) END AS INT)
      AS credit_score,
    (k >= 99 OR (cseg = 'High-Risk' AND k >= 94) OR (h < 4 AND k = 50)
      OR (m IN (16, 17) AND k BETWEEN 60 AND 62)) AS is_fraud
  FROM base),
raw_transactions AS (
  SELECT * FROM raw_tx_once
  UNION ALL SELECT * FROM raw_tx_once WHERE transaction_id % 250 = 3),
raw_cust_once AS (
  SELECT c_custkey AS customer_id, c_name AS name,
    lpad(CAST(c_custkey AS STRING), 11, '0') AS cpf,
    concat('user', CAST(c_custkey AS STRING), '@example.com') AS email,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'High-Risk'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Standard' ELSE 'Premium' END AS segment,
    CAST(CASE WHEN c_custkey % 97 = 5 THEN 950
         ELSE 300 + CAST(floor((c_acctbal + 1000) * 600 / 11000) AS INT) END AS INT) AS credit_score,
    DATE '2021-01-01' + CAST(c_custkey * 7 % 1460 AS INT) AS created_at
  FROM customer),
raw_customers AS (
  SELECT * FROM raw_cust_once
  UNION ALL SELECT * FROM raw_cust_once WHERE customer_id % 100 = 1),
raw_parts AS (
  SELECT *, CAST(year("timestamp") AS INT) AS year, CAST(month("timestamp") AS INT) AS month,
    CAST(day("timestamp") AS INT) AS day
  FROM raw_transactions),
bronze_raw AS (
  SELECT * FROM raw_transactions
  WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND amount > 0
    AND risk_score BETWEEN 0 AND 100 AND credit_score BETWEEN 300 AND 900
    AND status IN ('approved', 'declined')),
bronze AS (
  SELECT DISTINCT transaction_id, customer_id, amount, transaction_type, channel,
    merchant_category, "timestamp" AS ts, status, risk_score, segment, credit_score, is_fraud
  FROM bronze_raw),
bronze_lab AS (
  SELECT DISTINCT transaction_id, customer_id, amount, transaction_type, status, risk_score,
    is_fraud, "timestamp" AS ts
  FROM raw_transactions WHERE amount > 0 AND customer_id IS NOT NULL),
bronze_cust AS (
  SELECT DISTINCT * FROM raw_customers
  WHERE customer_id IS NOT NULL AND credit_score BETWEEN 300 AND 900),
silver AS (
  SELECT b.*, c.created_at AS customer_created_at,
    CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
    CAST(dayofweek(ts) AS INT) AS day_of_week, CAST(hour(ts) AS INT) AS hour,
    CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'manha' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'tarde'
         WHEN hour(ts) BETWEEN 18 AND 23 THEN 'noite' ELSE 'madrugada' END AS time_period,
    CASE WHEN amount < 100 THEN 'baixo' WHEN amount < 1000 THEN 'medio'
         ELSE 'alto' END AS amount_band
  FROM bronze b INNER JOIN bronze_cust c ON b.customer_id = c.customer_id),
silver_lab AS (
  SELECT b.*, c.segment, c.credit_score,
    CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
    CAST(dayofweek(ts) AS INT) AS day_of_week,
    CASE WHEN amount < 100 THEN 'baixo' WHEN amount < 1000 THEN 'medio'
         ELSE 'alto' END AS amount_band
  FROM bronze_lab b INNER JOIN bronze_cust c ON b.customer_id = c.customer_id),
facts AS (
  SELECT *, CAST(amount AS DECIMAL(18,4)) AS money,
    CASE WHEN is_fraud THEN 1 ELSE 0 END AS f,
    CASE WHEN is_fraud THEN CAST(amount AS DECIMAL(18,4)) ELSE 0 END AS lost
  FROM silver)
"""


def with_layers(query: str, *more: str) -> str:
    """``query`` after the layer definitions and any ``more`` of its own."""
    return "WITH " + ",\n".join([BASE.strip(), *more]) + "\n" + query
