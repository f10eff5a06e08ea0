"""DuckDB SQL for each query with an exact answer."""

from oracles.base import with_layers

N = "COUNT(*)"
FRAUD = "CAST(SUM(f) AS BIGINT)"
RATE = "ROUND(100.0 * CAST(SUM(f) AS DOUBLE) / COUNT(*), 2)"
MONEY = "CAST(SUM(money) AS DOUBLE)"
LOST = "CAST(SUM(lost) AS DOUBLE)"
TICKET = "ROUND(CAST(SUM(money) AS DOUBLE) / COUNT(*), 2)"
SCORE = "ROUND(CAST(SUM(credit_score) AS DOUBLE) / COUNT(credit_score), 1)"
RATED = f"{N} AS total, {FRAUD} AS fraudes, {RATE} AS taxa_fraude_pct"
GOLD_RATED = f"{N} AS total_transacoes, {FRAUD} AS qtd_fraudes, {RATE} AS taxa_fraude_pct"


def by(keys: str, measures: str, source: str = "facts", tail: str = "") -> str:
    names = ", ".join(k.split(" AS ")[-1] for k in keys.split(", "))
    return f"SELECT {keys}, {measures} FROM {source} GROUP BY {names} {tail}"


GOLD_FRAUD_RISK = by("segment", (
    f"{N} AS total_transacoes, {MONEY} AS valor_total, {TICKET} AS ticket_medio, "
    f"{FRAUD} AS qtd_fraudes, {RATE} AS taxa_fraude_pct, {LOST} AS valor_em_risco"))
GOLD_CHANNEL = by("channel, merchant_category", f"{GOLD_RATED}, {MONEY} AS valor_total")
GOLD_CATEGORY = by("merchant_category", f"{GOLD_RATED}, {LOST} AS valor_em_risco")
GOLD_DAILY = by("CAST(ts AS DATE) AS data",
                f"{N} AS transacoes, {FRAUD} AS fraudes, {RATE} AS taxa_fraude_pct")
DAILY_YMD = by("year, month, day", f"{N} AS transacoes, {FRAUD} AS fraudes")
SEGMENT = by("segment", (
    f"{SCORE} AS score_medio, COUNT(DISTINCT customer_id) AS clientes, {N} AS transacoes, "
    f"{FRAUD} AS fraudes, {RATE} AS taxa_fraude_pct"))
CHANNEL = by("channel", RATED)
CATEGORY = by("merchant_category", f"{RATED}, {LOST} AS valor_em_risco")
DAILY = by("CAST(ts AS DATE) AS dia", RATED)
PERIOD = by("time_period AS periodo", RATED)
PIVOT = """
SELECT amount_band,
  ROUND(100.0 * SUM(f) FILTER (segment = 'High-Risk')
    / NULLIF(COUNT(*) FILTER (segment = 'High-Risk'), 0), 2) AS "High-Risk",
  ROUND(100.0 * SUM(f) FILTER (segment = 'Premium')
    / NULLIF(COUNT(*) FILTER (segment = 'Premium'), 0), 2) AS "Premium",
  ROUND(100.0 * SUM(f) FILTER (segment = 'Standard')
    / NULLIF(COUNT(*) FILTER (segment = 'Standard'), 0), 2) AS "Standard"
FROM (VALUES ('baixo'), ('medio'), ('alto')) b(amount_band) LEFT JOIN facts USING (amount_band)
GROUP BY amount_band"""
KPIS = f"""
SELECT 'recebidas' AS kpi, CAST((SELECT COUNT(*) FROM raw_transactions) AS DOUBLE) AS valor
UNION ALL SELECT 'válidas analisadas', CAST(COUNT(*) AS DOUBLE) FROM facts
UNION ALL SELECT 'fraudes', CAST(SUM(f) AS DOUBLE) FROM facts
UNION ALL SELECT 'taxa_fraude_pct', {RATE} FROM facts
UNION ALL SELECT 'valor_em_risco', {LOST} FROM facts"""

REASONS = """
SELECT transaction_id, unnest([
  CASE WHEN transaction_id IS NULL OR customer_id IS NULL THEN 'not_null_ids' END,
  CASE WHEN NOT COALESCE(amount > 0, FALSE) THEN 'positive_amount' END,
  CASE WHEN NOT COALESCE(risk_score BETWEEN 0 AND 100, FALSE) THEN 'risk_range' END,
  CASE WHEN NOT COALESCE(credit_score BETWEEN 300 AND 900, FALSE) THEN 'credit_range' END,
  CASE WHEN NOT COALESCE(status IN ('approved', 'declined'), FALSE) THEN 'status_in' END
]) AS reason, rid
FROM (SELECT *, row_number() OVER () AS rid FROM raw_transactions)"""
REJECT_ROWS = f"""SELECT transaction_id, string_agg(reason, ',' ORDER BY reason) AS reasons
    FROM ({REASONS}) WHERE reason IS NOT NULL GROUP BY rid, transaction_id"""

FEATURES = """features AS (
  SELECT transaction_id, amount, risk_score, credit_score, segment, channel, merchant_category,
    is_fraud, CAST(f AS DOUBLE) AS label,
    CAST(dense_rank() OVER (ORDER BY segment) - 1 AS DOUBLE) AS segment_idx,
    CAST(dense_rank() OVER (ORDER BY channel) - 1 AS DOUBLE) AS channel_idx,
    CAST(dense_rank() OVER (ORDER BY merchant_category) - 1 AS DOUBLE) AS merchant_idx,
    ('0x' || substr(md5('42:' || CAST(transaction_id AS VARCHAR)), 1, 8))::BIGINT % 10000 < 2500
      AS is_test
  FROM facts)"""
MODEL_INPUTS = ["amount", "risk_score", "credit_score", "segment_idx", "channel_idx", "merchant_idx"]
SCALER = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS std FROM features WHERE NOT is_test"
    for c in MODEL_INPUTS)

AUC = """
SELECT ROUND(SUM(p * (below + q / 2.0)) / (SUM(p) * SUM(q)), 6) AS auc
FROM (SELECT p, q, COALESCE(SUM(q) OVER (
        ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT risk_score AS s, CAST(SUM(f) AS DOUBLE) AS p, CAST(SUM(1 - f) AS DOUBLE) AS q
            FROM facts GROUP BY risk_score))"""

SWEEP = """
SELECT threshold, COUNT(*) FILTER (risk_score >= threshold) AS alerts,
  COUNT(*) FILTER (risk_score >= threshold AND f = 1) AS hits,
  ROUND(CAST(COUNT(*) FILTER (risk_score >= threshold AND f = 1) AS DOUBLE)
    / NULLIF(COUNT(*) FILTER (risk_score >= threshold), 0), 6) AS precision,
  ROUND(CAST(COUNT(*) FILTER (risk_score >= threshold AND f = 1) AS DOUBLE) / SUM(f), 6) AS recall
FROM facts, (SELECT unnest([10.0, 25.0, 50.0, 75.0, 90.0, 99.0, 120.0])::DOUBLE AS threshold)
GROUP BY threshold"""

PANEL_DETAIL = " UNION ALL ".join(
    f"SELECT '{block}' AS bloco, segment, '{m}' AS metrica, CAST({m} AS DOUBLE) AS valor FROM gold"
    for block, m in [("composicao", "taxa_fraude_pct")] + [("detalhe", c) for c in (
        "total_transacoes", "valor_total", "ticket_medio", "qtd_fraudes", "taxa_fraude_pct",
        "valor_em_risco")])
PANEL = f"""
SELECT 'kpi' AS bloco, CAST(NULL AS VARCHAR) AS segment, 'total_transacoes' AS metrica,
  CAST(COUNT(*) AS DOUBLE) AS valor FROM facts
UNION ALL SELECT 'kpi', NULL, 'taxa_geral', {RATE} FROM facts
UNION ALL {PANEL_DETAIL}"""

ALERT = """
SELECT data, total, fraudes, ROUND(rate, 2) AS taxa_fraude_pct, ROUND(usual, 4) AS taxa_media,
  ROUND(usual + 3.0 * spread, 4) AS limite, ROUND(total / usual_volume, 4) AS volume_relativo,
  COALESCE(rate > usual + 3.0 * spread, FALSE) AS alerta
FROM (SELECT *, AVG(rate) OVER w AS usual, STDDEV_SAMP(rate) OVER w AS spread,
        AVG(CAST(total AS DOUBLE)) OVER w AS usual_volume
      FROM (SELECT CAST(ts AS DATE) AS data, COUNT(*) AS total, CAST(SUM(f) AS BIGINT) AS fraudes,
              100.0 * CAST(SUM(f) AS DOUBLE) / COUNT(*) AS rate
            FROM facts GROUP BY CAST(ts AS DATE))
      WINDOW w AS (ORDER BY data ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))"""

MIX = f"""
SELECT *,
  ROUND(100.0 * total / (SELECT COUNT(*) FROM facts), 4) AS participacao_transacoes_pct,
  ROUND(100.0 * fraudes / (SELECT CAST(SUM(f) AS DOUBLE) FROM facts), 4) AS participacao_fraudes_pct,
  ROUND(100.0 * valor_em_risco / (SELECT {LOST} FROM facts), 4) AS participacao_valor_pct
FROM ({by("channel", f"{RATED}, {LOST} AS valor_em_risco")})"""

CUBE_DIMS = ["data", "segment", "channel", "merchant_category", "time_period", "amount_band",
             "transaction_type"]
CUBE_NAME = ", ".join(f"CASE WHEN GROUPING({d}) = 0 THEN '{d}' END" for d in CUBE_DIMS)
CUBE = f"""
SELECT {", ".join(CUBE_DIMS)}, concat_ws(',', {CUBE_NAME}) AS grouping_set,
  {RATED}, {MONEY} AS valor_total, {LOST} AS valor_em_risco
FROM (SELECT *, CAST(ts AS DATE) AS data FROM facts)
GROUP BY GROUPING SETS ((segment), (channel), (merchant_category), (channel, merchant_category),
  (data), (time_period), (time_period, amount_band), (segment, amount_band), (transaction_type), ())"""

DAILY_SEGMENT = by("CAST(ts AS DATE) AS data, segment",
                   f"{RATED}, {MONEY} AS valor_total, {LOST} AS valor_em_risco")

WINDOWS = f"""
SELECT inicio, inicio + INTERVAL 1 DAY AS fim, segment, {N} AS transacoes, {FRAUD} AS fraudes,
  {RATE} AS taxa_fraude_pct
FROM (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS inicio FROM facts) GROUP BY inicio, segment"""
SLIDING = f"""
SELECT inicio, inicio + INTERVAL 12 HOUR AS fim, segment, {N} AS transacoes, {FRAUD} AS fraudes,
  {RATE} AS taxa_fraude_pct
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) - back * INTERVAL 6 HOUR AS inicio
      FROM facts, (SELECT unnest([0, 1]) AS back)) GROUP BY inicio, segment"""

RAW = "SELECT * FROM raw_transactions"
DIM_JOIN = ("SELECT b.*, c.name, c.created_at FROM bronze b "
            "JOIN bronze_cust c ON b.customer_id = c.customer_id")
LEFT_JOIN = ("SELECT b.transaction_id, b.customer_id, c.segment AS customer_segment, "
             "c.customer_id IS NOT NULL AS matched FROM bronze b "
             "LEFT JOIN bronze_cust c ON b.customer_id = c.customer_id")
ORPHANS = ("SELECT * FROM bronze WHERE customer_id NOT IN (SELECT customer_id FROM bronze_cust)")


def _labelled(query: str) -> str:
    return f"SELECT *, printf('%.2f%%', taxa_fraude_pct) AS rotulo FROM ({query})"


MONITOR = """SELECT p.year, p.month, COUNT(*) AS rows,
        CAST(SUM(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS rejected,
        ROUND(100.0 * SUM(CASE WHEN ok THEN 0 ELSE 1 END) / COUNT(*), 4) AS rejected_pct,
        MAX("timestamp") AS newest
        FROM (SELECT *, COALESCE(customer_id IS NOT NULL AND transaction_id IS NOT NULL
          AND amount > 0 AND risk_score BETWEEN 0 AND 100 AND credit_score BETWEEN 300 AND 900
          AND status IN ('approved', 'declined'), FALSE) AS ok FROM raw_parts) p
        GROUP BY p.year, p.month"""

_QUERIES: dict[str, str] = {
    # Sources and sinks
    "scan_tx_csv": RAW,
    "scan_customer_csv": "SELECT * FROM raw_customers",
    "scan_csv_quarantine": """SELECT transaction_id,
        CASE WHEN transaction_id % 97 = 0 OR transaction_id % 89 = 1 THEN 'bad' ELSE 'good' END AS kind
        FROM raw_transactions""",
    "scan_layer_parquet": "SELECT * FROM silver",
    "scan_silver_columns": """SELECT amount, risk_score, credit_score, segment, channel,
        merchant_category, is_fraud FROM silver""",
    "scan_gold_csv": GOLD_FRAUD_RISK,
    "sink_parquet_zstd": "SELECT * FROM bronze",
    "sink_csv": GOLD_CHANNEL,
    "sink_partitioned": "SELECT * FROM raw_parts",
    "scan_month_pruned": """SELECT year, month, COUNT(*) AS total,
        COUNT(*) FILTER (is_fraud) AS fraudes,
        ROUND(100.0 * COUNT(*) FILTER (is_fraud) / COUNT(*), 2) AS taxa_fraude_pct
        FROM raw_parts WHERE year = 2024 AND month = 1 GROUP BY year, month""",
    "table_replace": "SELECT * FROM bronze_cust",
    "ctas_parquet": GOLD_FRAUD_RISK,
    "scan_orders_quarter": """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
        COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total
        FROM orders WHERE quarter(o_orderdate) = 2 GROUP BY ALL""",
    "scan_orders_days": """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, COUNT(*) AS orders
        FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-11-20' AND DATE '1996-02-10' GROUP BY ALL""",
    "layer_counts": """SELECT 'raw' AS layer, COUNT(*) AS rows FROM raw_transactions
        UNION ALL SELECT 'bronze', COUNT(*) FROM bronze
        UNION ALL SELECT 'silver', COUNT(*) FROM silver""",
    # Projections and derived columns
    "raw_date_parts": "SELECT * FROM raw_parts",
    "bronze_project": """SELECT transaction_id, customer_id, amount, transaction_type, channel,
        merchant_category, "timestamp" AS ts, status, risk_score, segment, credit_score, is_fraud
        FROM raw_transactions""",
    "customer_project": "SELECT * FROM raw_customers",
    "normalize_bool": """SELECT transaction_id,
        CASE WHEN is_fraud THEN 'True' ELSE 'False' END AS is_fraud_text, is_fraud
        FROM raw_transactions""",
    "silver_date_parts": """SELECT transaction_id, ts, CAST(year(ts) AS INT) AS year,
        CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
        CAST(dayofweek(ts) AS INT) AS day_of_week, CAST(hour(ts) AS INT) AS hour FROM bronze""",
    "date_parts_legacy": """SELECT transaction_id, ts, strftime(ts, '%Y') AS year_text,
        CAST(isodow(ts) AS INT) AS iso_weekday FROM bronze""",
    "time_period": """SELECT transaction_id, CAST(hour(ts) AS INT) AS hour,
        CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'manha' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'tarde'
        WHEN hour(ts) BETWEEN 18 AND 23 THEN 'noite' ELSE 'madrugada' END AS time_period
        FROM bronze""",
    "amount_band": """SELECT transaction_id, amount,
        CASE WHEN amount < 100 THEN 'baixo' WHEN amount < 1000 THEN 'medio' ELSE 'alto' END
        AS amount_band FROM bronze""",
    "silver_star": """SELECT b.*, c.created_at AS customer_created_at
        FROM bronze b JOIN bronze_cust c ON b.customer_id = c.customer_id""",
    "cohort_label": """SELECT customer_id, created_at,
        CASE WHEN DATE '2024-02-01' - created_at > 365 THEN 'cliente antigo'
             ELSE 'cliente novo' END AS cohort FROM bronze_cust""",
    "preview_columns": """SELECT transaction_id, amount, amount_band, year, month, day, day_of_week
        FROM silver ORDER BY transaction_id LIMIT 10""",
    # Filters
    "f_not_null_ids": f"{RAW} WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL",
    "f_positive_amount": f"{RAW} WHERE amount > 0",
    "f_risk_range": f"{RAW} WHERE risk_score BETWEEN 0 AND 100",
    "f_credit_range": f"{RAW} WHERE credit_score BETWEEN 300 AND 900",
    "f_status_in": f"{RAW} WHERE status IN ('approved', 'declined')",
    "f_segment_type": """SELECT * FROM silver
        WHERE segment = 'Premium' AND transaction_type = 'compra'""",
    "f_is_null": f"""SELECT transaction_id, customer_id, customer_segment FROM ({LEFT_JOIN})
        WHERE customer_segment IS NULL""",
    "bronze_rejects": f"""SELECT reason, COUNT(*) AS rows FROM ({REASONS})
        WHERE reason IS NOT NULL GROUP BY reason""",
    "bronze_reject_rows": REJECT_ROWS,
    # Layers
    "bronze_transactions": "SELECT * FROM bronze",
    "bronze_tx_lab": "SELECT * FROM bronze_lab",
    "bronze_customers": "SELECT * FROM bronze_cust",
    "silver_transactions": "SELECT * FROM silver",
    "silver_bucketed": "SELECT * FROM silver",
    "silver_lab": "SELECT * FROM silver_lab",
    "distinct_rows": "SELECT DISTINCT * FROM raw_transactions",
    # Joins
    "join_inner_using": DIM_JOIN,
    "join_broadcast": DIM_JOIN,
    "join_cohort_back": """SELECT s.transaction_id, s.customer_id, c.created_at
        FROM silver s JOIN bronze_cust c ON s.customer_id = c.customer_id""",
    "join_left_diagnose": LEFT_JOIN,
    "orphan_transactions": ORPHANS,
    "dim_key_duplicates": """SELECT customer_id, COUNT(*) AS rows FROM raw_customers
        GROUP BY customer_id HAVING COUNT(*) > 1""",
    # Aggregations
    "gold_fraud_risk": GOLD_FRAUD_RISK,
    "gold_channel_risk": GOLD_CHANNEL,
    "gold_category_risk": GOLD_CATEGORY,
    "gold_daily_metrics": GOLD_DAILY,
    "gold_daily_ymd": DAILY_YMD,
    "analysis_segment": SEGMENT,
    "analysis_channel": CHANNEL,
    "analysis_category": CATEGORY,
    "analysis_daily": DAILY,
    "analysis_period": PERIOD,
    "analysis_period_band": by("time_period, amount_band", RATED),
    "analysis_segment_band": by("segment, amount_band", RATED),
    "kpi_global": f"SELECT {N} AS n, {FRAUD} AS fraud, {MONEY} AS volume, {LOST} AS risk FROM facts",
    "kpi_long": KPIS,
    "eda_score_by_segment": by(
        "segment", f"{SCORE} AS score_medio, COUNT(DISTINCT customer_id) AS clientes"),
    "eda_risk_by_type": by(
        "transaction_type", f"{FRAUD} AS fraudes, {N} AS total, {RATE} AS taxa_pct"),
    "eda_day_of_month": by("day", f"{N} AS total_transacoes, {FRAUD} AS fraudes",
                           tail="ORDER BY fraudes DESC, day LIMIT 10"),
    "eda_cohort": f"""SELECT CASE WHEN date_diff('day', c.created_at, DATE '2024-02-01') > 365
        THEN 'cliente antigo' ELSE 'cliente novo' END AS cohort,
        {TICKET} AS ticket_medio, {N} AS transacoes
        FROM facts s JOIN bronze_cust c ON s.customer_id = c.customer_id GROUP BY 1""",
    "eda_cross_sell": """SELECT customer_id, COUNT(*) AS compras FROM silver
        WHERE segment = 'Premium' AND transaction_type = 'compra' GROUP BY customer_id
        HAVING COUNT(*) > 2 ORDER BY compras DESC, customer_id LIMIT 10""",
    "profile_amount": """SELECT MIN(amount) AS min_amount, MAX(amount) AS max_amount,
        COUNT(*) AS total FROM bronze_lab""",
    "profile_fraud": "SELECT is_fraud, COUNT(*) AS total FROM bronze_lab GROUP BY is_fraud",
    "duplicate_ids": """SELECT transaction_id, COUNT(*) AS rows FROM raw_transactions
        GROUP BY transaction_id HAVING COUNT(*) > 1""",
    "silver_vs_bronze": """SELECT COUNT(*) AS silver, (SELECT COUNT(*) FROM bronze) AS bronze
        FROM silver""",
    "null_segment_count": "SELECT COUNT(*) AS sem_segmento FROM silver WHERE segment IS NULL",
    "segment_preview": """SELECT segment, COUNT(*) AS transacoes,
        ROUND(100.0 * COUNT(*) FILTER (is_fraud) / COUNT(*), 2) AS taxa_fraude_pct
        FROM silver_lab GROUP BY segment""",
    "gold_rollup_kpis": f"""SELECT {N} AS total_transacoes, {FRAUD} AS qtd_fraudes,
        {RATE} AS taxa_geral FROM facts""",
    "pivot_band_segment": PIVOT,
    "gold_daily_top_fraud": f"""SELECT year, month, day, fraudes FROM ({DAILY_YMD})
        ORDER BY fraudes DESC, year, month, day LIMIT 5""",
    "quality_indicators": """SELECT COUNT(*) AS rows, 12 AS columns,
        COUNT(*) * 12 - COUNT(transaction_id) - COUNT(customer_id) - COUNT(amount)
          - COUNT(transaction_type) - COUNT(channel) - COUNT(merchant_category) - COUNT("timestamp")
          - COUNT(status) - COUNT(risk_score) - COUNT(segment) - COUNT(credit_score)
          - COUNT(is_fraud) AS null_cells,
        (SELECT COUNT(*) FROM (SELECT transaction_id FROM raw_transactions
          WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING COUNT(*) > 1))
          AS duplicate_ids,
        MIN(amount) AS min_amount, MIN(risk_score) AS min_risk_score,
        MAX(risk_score) AS max_risk_score, MIN(credit_score) AS min_credit_score,
        MAX(credit_score) AS max_credit_score FROM raw_transactions""",
    "risk_cube": CUBE,
    # Sorts and top-k
    "order_rate_desc": f"{GOLD_FRAUD_RISK} ORDER BY taxa_fraude_pct DESC",
    "order_custom": """SELECT channel, COUNT(*) AS total, CAST(CASE channel WHEN 'app' THEN 1
        WHEN 'atm' THEN 2 WHEN 'web' THEN 3 WHEN 'pos' THEN 4 ELSE 5 END AS INT) AS posicao
        FROM silver GROUP BY channel ORDER BY posicao""",
    "order_date": f"{GOLD_DAILY} ORDER BY data",
    "order_multi": """SELECT segment, amount_band, COUNT(*) AS total, MAX(amount) AS maior
        FROM silver GROUP BY segment, amount_band ORDER BY segment, amount_band""",
    "top_k": "SELECT transaction_id, amount FROM silver ORDER BY amount DESC, transaction_id LIMIT 5",
    "limit_sample": """SELECT transaction_id, segment, amount FROM silver
        ORDER BY transaction_id LIMIT 10""",
    # Models
    "ml_features": """SELECT transaction_id, amount, risk_score, credit_score, segment, channel,
        merchant_category, is_fraud, label FROM features""",
    "ml_category_index": """SELECT transaction_id, segment, channel, merchant_category,
        segment_idx, channel_idx, merchant_idx FROM features""",
    "ml_split": "SELECT is_fraud, is_test, COUNT(*) AS rows FROM features GROUP BY is_fraud, is_test",
    "ml_scaler": SCALER,
    "ml_class_weights": """SELECT label, COUNT(*) AS rows,
        CAST((SELECT COUNT(*) FROM features WHERE NOT is_test) AS DOUBLE) / (2 * COUNT(*)) AS weight
        FROM features WHERE NOT is_test GROUP BY label""",
    "ml_logistic_facts": "SELECT transaction_id, label, TRUE AS probability FROM features WHERE is_test",
    "ml_threshold_facts": "SELECT transaction_id, TRUE AS by_threshold FROM features WHERE is_test",
    "ml_random_forest_facts": "SELECT transaction_id, label, TRUE AS probability FROM features WHERE is_test",
    "lr_coefficients_facts": f"SELECT unnest({[*MODEL_INPUTS, 'intercept']}) AS feature, TRUE AS at_optimum",
    "rf_importances_facts": f"SELECT CAST({len(MODEL_INPUTS)} AS BIGINT) AS features, CAST(1.0 AS DOUBLE) AS total, TRUE AS none_negative",
    "model_metrics_facts": "SELECT unnest(['Regressão Logística', 'Random Forest (numTrees=30)']) AS modelo, TRUE AS equal",
    "batch_score_facts": "SELECT transaction_id, COUNT(*) AS rows, TRUE AS same_alone FROM features GROUP BY transaction_id",
    "feed_models_facts": """SELECT CASE WHEN is_fraud THEN 'Real 1 — fraude' ELSE 'Real 0 — não fraude' END AS item,
        COUNT(*) AS rows FROM features WHERE is_test GROUP BY is_fraud""",
    "roc_auc": AUC,
    "confusion_matrix": """
        SELECT 'Real 0 — não fraude' AS classe,
          COUNT(*) FILTER (risk_score < 50) AS "Predito 0",
          COUNT(*) FILTER (risk_score >= 50) AS "Predito 1" FROM silver WHERE NOT is_fraud
        UNION ALL SELECT 'Real 1 — fraude', COUNT(*) FILTER (risk_score < 50),
          COUNT(*) FILTER (risk_score >= 50) FROM silver WHERE is_fraud""",
    "threshold_sweep": SWEEP,
    # Dashboard feeds
    "feed_kpis": KPIS,
    "feed_channel": _labelled(CHANNEL),
    "feed_period": _labelled(PERIOD),
    "feed_category": _labelled(CATEGORY),
    "feed_segment": _labelled(SEGMENT),
    "feed_heatmap": PIVOT,
    "feed_trend": f"SELECT dia, fraudes FROM ({DAILY})",
    "feed_gold_panel": PANEL,
    "feed_segment_filter": f"SELECT * FROM ({GOLD_FRAUD_RISK}) WHERE segment <> 'Premium'",
    # Risk insights
    "relative_risk": f"""SELECT segment, {RATED}, ROUND(
        (CAST(SUM(f) AS DOUBLE) / COUNT(*))
          / (SELECT CAST(SUM(f) AS DOUBLE) / COUNT(*) FROM facts WHERE segment = 'Premium'), 4)
        AS risco_relativo FROM facts GROUP BY segment""",
    "min_volume_guard": by("time_period, amount_band", RATED, tail="HAVING COUNT(*) >= 300"),
    "value_at_risk_rank": f"{CATEGORY} ORDER BY valor_em_risco DESC",
    "risk_mix": MIX,
    "daily_rate_alert": ALERT,
    "partition_monitor": MONITOR,
    "partition_latency_facts": f"SELECT year, month, rows, rejected, newest, TRUE AS rising FROM ({MONITOR})",
    # Exports
    "export_analise_segmento": SEGMENT,
    "export_analise_canal": CHANNEL,
    "export_analise_categoria": CATEGORY,
    "export_analise_temporal": DAILY,
    "export_analise_periodo": PERIOD,
    "export_analise_pergunta_negocio": by("time_period, amount_band", RATED),
    "export_analise_heatmap": by("segment, amount_band", RATED),
    "export_kpis": KPIS,
    "export_models_facts": """SELECT * FROM (VALUES ('metricas_modelos', 2::BIGINT), ('matriz_confusao_logistica', 2),
        ('coeficientes_logistica', 6), ('importancias_random_forest', 6)) t(tabela, linhas)""",
    # Streams
    "stream_bronze": "SELECT * FROM bronze",
    "stream_silver": "SELECT * FROM silver",
    "stream_risk_windows": WINDOWS,
    "stream_risk_windows_sliding": SLIDING,
    "stream_rejects": REJECT_ROWS,
    "stream_decision": """SELECT transaction_id, ts, risk_score AS score,
        CASE WHEN risk_score >= 90 THEN 'deny' WHEN risk_score >= 60 THEN 'review'
             ELSE 'approve' END AS decisao FROM silver""",
    "stream_model_decision_facts": "SELECT transaction_id, ts, TRUE AS by_cuts FROM silver",
    "stream_gold_upsert": DAILY_SEGMENT,
    # Incremental maintenance
    "incremental_gold": DAILY_SEGMENT,
    "gold_fraud_risk_from_base": GOLD_FRAUD_RISK,
    "gold_channel_risk_from_base": GOLD_CHANNEL,
    "gold_category_risk_from_base": GOLD_CATEGORY,
    "gold_daily_metrics_from_base": GOLD_DAILY,
    "analysis_segment_from_base": SEGMENT,
    "compact_batches": "SELECT * FROM silver",
    "incremental_ingest": "SELECT * FROM raw_parts",
    "compact_partition": "SELECT * FROM raw_parts",
}

_OWN = {
    "ml_features", "ml_category_index", "ml_split", "ml_scaler", "ml_class_weights", "ml_logistic_facts",
    "ml_threshold_facts", "ml_random_forest_facts", "batch_score_facts", "feed_models_facts",
}


def _full(name: str, query: str) -> str:
    if name in _OWN:
        return with_layers(query, FEATURES)
    if name == "feed_gold_panel":
        return with_layers(query, f"gold AS ({GOLD_FRAUD_RISK})")
    return with_layers(query)


ORACLES: dict[str, str] = {name: _full(name, query) for name, query in _QUERIES.items()}
