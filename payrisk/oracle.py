"""The queries of the catalog as SQL for a second engine, over the same input tables.

Written apart from the Spark code: frames are plain RANGE frames with DISTINCT counts, components
are a recursive query. Only the fixture projection is shared by definition (see FIXTURES.md).
"""

from __future__ import annotations

EVENT = (
    "payment_id, customer_id, card_id, merchant_id, device_id, ip, country, amount, currency, "
    "status, mcc"
)
FEATURES = (
    "tx_by_card_5m, distinct_merchants_10m, distinct_countries_1h, distinct_cards_per_device, "
    "declined_ratio_1h"
)
ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
DAY = "1704067200000000"

BASE = """
b AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id // 3 AS card
  FROM events)"""


def _payments(name: str, event_us: str) -> str:
    return f"""
{name} AS (
  SELECT {event_us} AS event_us, event_id,
    'PAY-' || CAST(CASE WHEN event_id % 20 = 19 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS payment_id,
    'CUST-' || CAST(user_id AS VARCHAR) AS customer_id,
    'CARD-' || CAST(card AS VARCHAR) AS card_id,
    'MERCH-' || CAST(k % 20 AS VARCHAR) AS merchant_id,
    CASE WHEN k % 10 = 0 THEN 'DEV-S' || CAST(card % 4 AS VARCHAR)
         ELSE 'DEV-' || CAST(card AS VARCHAR) END AS device_id,
    '192.168.1.' || CAST(user_id % 255 + 1 AS VARCHAR) AS ip,
    CASE WHEN k < 94 THEN 'ES' WHEN k < 96 THEN 'US' WHEN k < 98 THEN 'FR' ELSE 'DE' END AS country,
    value * 10 AS amount, 'EUR' AS currency,
    CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS status,
    CASE k % 3 WHEN 0 THEN '5411' WHEN 1 THEN '5812' ELSE '5311' END AS mcc
  FROM b)"""


def _first(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY event_us, event_id) AS rn FROM {source})
  WHERE rn = 1)"""


FEED = BASE + "," + _payments("feed", f"{DAY} + (us - {DAY}) // 60")
TYPED = FEED + "," + _first("typed", "feed")


def _frame(seconds: int) -> str:
    return (
        "OVER (PARTITION BY card_id ORDER BY event_us // 1000000 "
        f"RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)"
    )


FEATURES_CTE = f""",
silver AS (
  SELECT event_us, {EVENT},
    count(payment_id) {_frame(300)} AS tx_by_card_5m,
    count(DISTINCT merchant_id) {_frame(600)} AS distinct_merchants_10m,
    count(DISTINCT country) {_frame(3600)} AS distinct_countries_1h,
    count(DISTINCT card_id) OVER (PARTITION BY device_id) AS distinct_cards_per_device,
    round(avg(CASE WHEN status = 'declined' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) {_frame(3600)}, 4)
      AS declined_ratio_1h
  FROM typed)"""
SILVER = TYPED + FEATURES_CTE
RELATIONS = (
    SILVER
    + """,
relations AS (
  SELECT *, CAST(
      CASE WHEN tx_by_card_5m >= 5 THEN 24 ELSE 0 END
    + CASE WHEN distinct_merchants_10m >= 4 THEN 18 ELSE 0 END
    + CASE WHEN distinct_countries_1h >= 3 THEN 18 ELSE 0 END
    + CASE WHEN distinct_cards_per_device >= 4 THEN 16 ELSE 0 END
    + CASE WHEN declined_ratio_1h >= 0.45::DOUBLE THEN 12 ELSE 0 END
    + CASE WHEN amount >= 1200 THEN 12 ELSE 0 END AS BIGINT) AS risk_score,
    concat_ws(', ',
      CASE WHEN tx_by_card_5m >= 5 THEN 'high_card_velocity_5m' END,
      CASE WHEN distinct_merchants_10m >= 4 THEN 'many_merchants_10m' END,
      CASE WHEN distinct_countries_1h >= 3 THEN 'many_countries_1h' END,
      CASE WHEN distinct_cards_per_device >= 4 THEN 'device_shared_by_cards' END,
      CASE WHEN declined_ratio_1h >= 0.45::DOUBLE THEN 'high_declined_ratio_1h' END,
      CASE WHEN amount >= 1200 THEN 'high_amount' END) AS reasons_text
  FROM silver)"""
)

CLEANED = f""",
dirty AS (
  SELECT event_id, {DAY} + (us - {DAY}) // 60 AS event_us,
    trim(CASE WHEN event_id % 7 = 0 THEN '  PAY-' || CAST(event_id AS VARCHAR) || ' '
         WHEN event_id % 20 = 19 THEN 'PAY-' || CAST(event_id - 1 AS VARCHAR)
         ELSE 'PAY-' || CAST(event_id AS VARCHAR) END) AS payment_id,
    'CUST-' || CAST(user_id AS VARCHAR) AS customer_id,
    upper(trim(CASE WHEN event_id % 53 = 0 THEN NULL
         WHEN event_id % 5 = 0 THEN ' card-' || CAST(k AS VARCHAR)
         ELSE 'CARD-' || CAST(k AS VARCHAR) END)) AS card_id,
    'MERCH-' || CAST(k % 20 AS VARCHAR) AS merchant_id,
    CASE WHEN k % 10 = 0 THEN 'DEV-S' || CAST(card % 4 AS VARCHAR)
         ELSE 'DEV-' || CAST(card AS VARCHAR) END AS device_id,
    '192.168.1.' || CAST(user_id % 255 + 1 AS VARCHAR) AS ip,
    CASE WHEN k < 70 THEN 'ES' WHEN k < 80 THEN NULL ELSE 'FR' END AS country,
    TRY_CAST(CASE WHEN event_id % 50 = 1 THEN 'abc' WHEN event_id % 41 = 0 THEN '-5.0'
         WHEN event_id % 43 = 0 THEN NULL ELSE CAST(k + 0.5 AS VARCHAR) END AS DOUBLE) AS amount,
    'EUR' AS currency,
    CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS status,
    CASE k % 3 WHEN 0 THEN '5411' WHEN 1 THEN '5812' ELSE '5311' END AS mcc
  FROM b),
cleaned AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY event_id) AS rn FROM dirty)
  WHERE rn = 1 AND card_id IS NOT NULL AND amount > 0)"""


def _feature_rows(name: str, source: str, ratio: str) -> str:
    return f""",
{name} AS (
  SELECT payment_id AS transaction_id, customer_id AS user_id, amount,
    CAST(CASE WHEN status = 'declined' THEN 1 ELSE 0 END AS BIGINT) AS is_fraud,
    {ratio} AS risk_score, event_us // 1000000 * 1000000 AS event_us,
    coalesce(country, 'unknown') AS country, device_id AS device_type,
    epoch_us(TIMESTAMP '2024-01-02 00:00:00') AS ingestion_us
  FROM {source})"""


BATCH = _feature_rows("batch", "silver", "declined_ratio_1h")
# The feed one row after the other: the first of an id inserts it, later ones change two columns.
REPEATS = _feature_rows("all_rows", "feed", "0.0::DOUBLE") + """,
batch AS (
  SELECT transaction_id, min_by(user_id, o) AS user_id, max_by(amount, o) AS amount,
    min_by(is_fraud, o) AS is_fraud, min_by(risk_score, o) AS risk_score,
    min_by(event_us, o) AS event_us, max_by(country, o) AS country,
    min_by(device_type, o) AS device_type, min(ingestion_us) AS ingestion_us
  FROM (SELECT *, row_number() OVER (
    ORDER BY event_us, user_id, amount, is_fraud, risk_score, country, device_type) AS o FROM all_rows)
  GROUP BY transaction_id)"""
LOADED = CLEANED + _feature_rows("loaded", "cleaned", "0.0::DOUBLE")
FUSED = (
    RELATIONS
    + LOADED
    + f""",
fused AS (
  SELECT r.event_us, {", ".join("r." + c.strip() for c in EVENT.split(","))},
    {FEATURES}, reasons_text, r.risk_score AS puntuacion_riesgo, l.device_type,
    CAST(r.risk_score AS DOUBLE) AS risk_score
  FROM relations r JOIN loaded l ON r.payment_id = l.transaction_id
  WHERE r.card_id IS NOT NULL AND r.amount > 0),
suspicious AS (
  SELECT * FROM fused
  WHERE risk_score > 10 OR status = 'declined' OR tx_by_card_5m > 1
     OR country <> 'ES' OR country IS NULL)"""
)
TIME_TEXT = "strftime(make_timestamp(event_us), '%Y-%m-%d %H:%M:%S.%f')"


def _with(ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes.strip()}\n{body.strip()}"


def _activity(key: str, ctes: str = FUSED, source: str = "suspicious") -> str:
    return _with(
        ctes,
        f"""SELECT {key}, count(payment_id) AS total_transacciones,
  round(avg(amount), 9) AS monto_promedio,
  CAST(sum(CASE WHEN status = 'declined' THEN 1 ELSE 0 END) AS BIGINT) AS alertas_confirmadas,
  max(puntuacion_riesgo) AS max_puntuacion
FROM {source} GROUP BY {key}
HAVING count(payment_id) > 1 OR max(puntuacion_riesgo) > 10
ORDER BY alertas_confirmadas DESC, total_transacciones DESC, {key}""",
    )


def _top_risk(key: str, ctes: str = RELATIONS) -> str:
    return _with(
        ctes,
        f"""SELECT {key}, count(*) FILTER (WHERE risk_score >= 20) AS alerts,
  round(avg(risk_score), 9) AS mean_score, max(risk_score) AS max_score, count(*) AS transactions
FROM relations GROUP BY {key} ORDER BY alerts DESC, avg(risk_score) DESC, {key} LIMIT 10""",
    )


def _export(ctes: str, source: str, parts: dict[str, str]) -> str:
    columns = ", ".join(f"strftime(make_timestamp(event_us), '{f}') AS {n}" for n, f in parts.items())
    return _with(ctes, f"SELECT *, {columns} FROM {source}")


DAY_PARTS = {"year": "%Y", "month": "%m", "day": "%d"}
MINUTE_PARTS = {**DAY_PARTS, "hour": "%H", "minute": "%M"}
TOTALS = """SELECT count(*) AS transactions, count(*) FILTER (WHERE risk_score >= 20) AS alerts
FROM relations"""
TIMELINE = """SELECT event_us // 3600000000 * 3600000000 AS bucket_start, count(*) AS transactions,
  count(*) FILTER (WHERE risk_score >= 20) AS alerts,
  count(*) FILTER (WHERE status = 'declined') AS declined
FROM relations GROUP BY 1 ORDER BY 1"""
MONTH_FEED = BASE + "," + _payments("feed", "us") + "," + _first("typed", "feed")

MONTH_RELATIONS = MONTH_FEED + RELATIONS.removeprefix(TYPED)
MONTH_SCORED = MONTH_RELATIONS + ", scored AS (SELECT *, risk_score AS puntuacion_riesgo FROM relations)"

RULE_LIST = "replace(reasons_text, ', ', '|')"
BRONZE = _with(
    FEED, f"SELECT strftime(make_timestamp(event_us), {ISO}) AS event_time, {EVENT} FROM feed"
)
TEXT = (
    "'Transaction from country ' || country || ' with amount ' || CAST(amount AS VARCHAR) || "
    "' EUR. Status: ' || status || '. Risk score evaluation: ' || "
    "CAST(puntuacion_riesgo AS VARCHAR) || '.'"
)

LABEL = "CAST(CASE WHEN status = 'declined' OR puntuacion_riesgo > 10 THEN 1 ELSE 0 END AS BIGINT)"
PART = "CASE WHEN substr(md5(payment_id), 1, 2) < 'cd' THEN 'train' ELSE 'validation' END"

COMPONENTS = (
    RELATIONS
    + """,
link AS (
  SELECT DISTINCT 'card:' || card_id AS a, 'device:' || device_id AS z
  FROM relations WHERE risk_score >= 20 AND card_id IS NOT NULL AND device_id IS NOT NULL),
step AS (SELECT a AS x, z AS y FROM link UNION SELECT z, a FROM link),
reach AS (
  SELECT x AS node, x AS other FROM step
  UNION
  SELECT r.node, s.y FROM reach r JOIN step s ON r.other = s.x)"""
)

CLUSTERS = _with(
    COMPONENTS, "SELECT node, min(other) AS component FROM reach GROUP BY node", recursive=True
)
UPSERT = """SELECT * FROM batch WHERE transaction_id NOT IN (SELECT transaction_id FROM loaded)
UNION ALL
SELECT l.transaction_id, l.user_id,
  CASE WHEN n.transaction_id IS NULL THEN l.amount ELSE n.amount END, l.is_fraud, l.risk_score,
  l.event_us, CASE WHEN n.transaction_id IS NULL THEN l.country ELSE n.country END,
  l.device_type, l.ingestion_us
FROM loaded l LEFT JOIN batch n ON n.transaction_id = l.transaction_id"""

ORACLE: dict[str, str] = {
    "bronze_parse": BRONZE,
    "stream_bronze": BRONZE,
    "publish_json": _with(
        FEED,
        f"""SELECT payment_id AS key, CAST(to_json({{
  'event_time': strftime(make_timestamp(event_us), {ISO}),
  {", ".join(f"'{c.strip()}': {c.strip()}" for c in EVENT.split(","))}}}) AS VARCHAR) AS value
FROM feed""",
    ),
    "publish_typed": _with(
        RELATIONS,
        f"""SELECT payment_id AS key, CAST(to_json({{
  'event_time': strftime(make_timestamp(event_us), {ISO}) || 'Z',
  {", ".join(f"'{c.strip()}': {c.strip()}" for c in (EVENT + ", " + FEATURES).split(","))},
  'risk_score': risk_score, 'reasons_text': reasons_text}}) AS VARCHAR) AS value
FROM relations""",
    ),
    "silver_typed": _with(TYPED, f"SELECT event_us, {EVENT} FROM typed"),
    "tx_by_card_5m": _with(SILVER, "SELECT payment_id, tx_by_card_5m FROM silver"),
    "distinct_merchants_10m": _with(
        SILVER, "SELECT payment_id, distinct_merchants_10m FROM silver"
    ),
    "distinct_countries_1h": _with(SILVER, "SELECT payment_id, distinct_countries_1h FROM silver"),
    "declined_ratio_1h": _with(SILVER, "SELECT payment_id, declined_ratio_1h FROM silver"),
    "cards_per_device": _with(SILVER, "SELECT payment_id, distinct_cards_per_device FROM silver"),
    "silver": _with(SILVER, "SELECT * FROM silver"),
    "reasons": _with(
        RELATIONS,
        f"""SELECT payment_id, {RULE_LIST} AS reasons,
  CAST(CASE WHEN reasons_text = '' THEN 0 ELSE len(string_split(reasons_text, ', ')) END AS BIGINT)
    AS n_reasons, reasons_text FROM relations""",
    ),
    "risk_score": _with(RELATIONS, "SELECT payment_id, risk_score FROM relations"),
    "alerts": _with(RELATIONS, "SELECT * FROM relations WHERE risk_score >= 20"),
    "relations": _with(RELATIONS, "SELECT * FROM relations"),
    "recompute_risk": _with(
        RELATIONS,
        """SELECT payment_id,
  CASE WHEN status = 'declined' THEN 0::BIGINT ELSE risk_score END AS score_or_zero,
  risk_score AS score_recomputed FROM relations""",
    ),
    "time_slice": _with(
        RELATIONS,
        """SELECT * FROM relations
WHERE event_us >= epoch_us(TIMESTAMP '2024-01-01 01:00:00')
  AND event_us < epoch_us(TIMESTAMP '2024-01-01 03:00:00')""",
    ),
    "export_counts": _with(
        RELATIONS,
        "SELECT "
        + ", ".join(f"strftime(make_timestamp(event_us), '{f}') AS {n}" for n, f in MINUTE_PARTS.items())
        + ", count(*) AS n_rows FROM relations WHERE risk_score >= 20 GROUP BY ALL",
    ),
    "export_minute": _export(RELATIONS, "relations", MINUTE_PARTS),
    "export_day": _export(MONTH_FEED + FEATURES_CTE, "silver", DAY_PARTS),
    "features_map": _with(SILVER + BATCH, "SELECT * FROM batch"),
    "features_upsert": _with(
        SILVER + BATCH + LOADED,
        UPSERT,
    ),
    "features_upsert_repeats": _with(
        FEED + REPEATS + LOADED,
        UPSERT,
    ),
    "features_upsert_batches": _with(
        SILVER + BATCH + LOADED + f", merged AS ({UPSERT})",
        """SELECT transaction_id, user_id,
  CASE WHEN again THEN new_amount * 2 ELSE amount END AS amount, is_fraud, risk_score, event_us,
  CASE WHEN again THEN 'DE' ELSE country END AS country, device_type, ingestion_us
FROM (SELECT m.*, n.transaction_id IS NOT NULL AS again, n.amount AS new_amount
      FROM merged m LEFT JOIN batch n ON n.transaction_id = m.transaction_id AND n.country = 'FR')
UNION ALL
SELECT * REPLACE ('REFUND-' || transaction_id AS transaction_id) FROM batch WHERE country = 'FR'""",
    ),
    "silver_increments": _with(MONTH_FEED + FEATURES_CTE, "SELECT * FROM silver"),
    "device_counts_increments": _with(
        MONTH_FEED,
        "SELECT device_id, count(DISTINCT card_id) AS n_cards FROM typed GROUP BY device_id",
    ),
    "csv_round_trip": _with(
        BASE,
        """SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN '  PAY-' || CAST(event_id AS VARCHAR) || ' '
    WHEN event_id % 20 = 19 THEN 'PAY-' || CAST(event_id - 1 AS VARCHAR)
    ELSE 'PAY-' || CAST(event_id AS VARCHAR) END AS payment_id,
  CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 5 = 0 THEN ' card-' || CAST(k AS VARCHAR)
    ELSE 'CARD-' || CAST(k AS VARCHAR) END AS card_id,
  CASE WHEN event_id % 50 = 1 THEN 'abc' WHEN event_id % 41 = 0 THEN '-5.0'
    WHEN event_id % 43 = 0 THEN NULL ELSE CAST(k + 0.5 AS VARCHAR) END AS amount,
  CASE WHEN k < 40 THEN 'ES' WHEN k < 55 THEN 'es' WHEN k < 65 THEN ' España '
    WHEN k < 70 THEN 'Spain' WHEN k < 75 THEN 'unknown' WHEN k < 80 THEN NULL ELSE 'FR' END
    AS country,
  CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'a,b' ELSE ' ' END AS currency,
  CASE WHEN event_id % 3 = 0 THEN ' "' || s || '" ' ELSE s END AS status,
  md5(CASE k % 3 WHEN 0 THEN '5411' WHEN 1 THEN '5812' ELSE '5311' END || chr(10) ||
    CASE WHEN event_id % 2 = 0 THEN 'x' || chr(92) || 'ny' ELSE 'z' || chr(13) || chr(92) END)
    AS mcc_md5,
  CAST(1 AS BIGINT) AS line_breaks
FROM (SELECT *, CASE WHEN event_type = 'error' THEN ' Declined ' ELSE 'APPROVED' END AS s FROM b)""",
    ),
    "compaction": _with(RELATIONS, "SELECT * FROM relations"),
    "compaction_in_place": _with(RELATIONS, "SELECT * FROM relations"),
    "mixed_source_union": _with(
        FEED,
        f"""SELECT strftime(make_timestamp(event_us), {ISO}) AS event_time, payment_id, customer_id,
  card_id, merchant_id, device_id, CASE WHEN status = 'approved' THEN ip END AS ip, country, amount,
  currency, status, mcc FROM feed""",
    ),
    "json_arrays": f"""SELECT * REPLACE (
  CASE mcc WHEN '5411' THEN '{{"a": [}}' WHEN '5812' THEN repeat(chr(92), 2) || '"}}{{' ELSE ip END AS ip,
  CASE WHEN mcc <> '5311' THEN currency END AS currency)
FROM ({BRONZE})""",
    "clean": _with(BASE + CLEANED, f"SELECT event_us, {EVENT} FROM cleaned"),
    "fused_join": _with(FUSED, "SELECT * FROM fused"),
    "suspicious": _with(FUSED, "SELECT * FROM suspicious"),
    "insights_report": _with(
        FUSED,
        f"""SELECT payment_id, {TIME_TEXT} AS event_time, customer_id, card_id, merchant_id, device_id,
  country, amount, currency, status, mcc, {FEATURES}, puntuacion_riesgo,
  reasons_text AS reasons, reasons_text, device_type, risk_score
FROM suspicious""",
    ),
    "high_risk_top50": _with(
        FUSED,
        f"""SELECT payment_id, customer_id, amount, puntuacion_riesgo, country,
  {TIME_TEXT} AS event_time
FROM suspicious WHERE puntuacion_riesgo > 10 OR status = 'declined'
ORDER BY amount DESC, puntuacion_riesgo DESC, payment_id LIMIT 50""",
    ),
    "customer_activity": _activity("customer_id"),
    "card_activity": _activity("card_id"),
    "geo_patterns": _with(
        FUSED,
        """SELECT country, count(payment_id) AS volumen, round(sum(amount), 2) AS capital_en_riesgo,
  round(avg(puntuacion_riesgo), 9) AS riesgo_medio,
  round(sum(CASE WHEN status = 'declined' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
    / count(payment_id) * 100, 2) AS tasa_fraude_pct
FROM suspicious GROUP BY country ORDER BY capital_en_riesgo DESC, tasa_fraude_pct DESC, country""",
    ),
    "dashboard_totals": _with(RELATIONS, TOTALS),
    "alerts_timeline": _with(RELATIONS, TIMELINE),
    "timeline_increments": _with(MONTH_RELATIONS, TIMELINE),
    "top_merchants_increments": _top_risk("merchant_id", MONTH_RELATIONS),
    "card_activity_increments": _activity("card_id", MONTH_SCORED, "scored"),
    "top_risk_merchants": _top_risk("merchant_id"),
    "top_risk_cards": _top_risk("card_id"),
    "graph_nodes": _with(
        TYPED,
        """SELECT 'customer' AS kind, customer_id AS id FROM typed
UNION SELECT 'card', card_id FROM typed
UNION SELECT 'device', device_id FROM typed
UNION SELECT 'merchant', merchant_id FROM typed
UNION SELECT 'payment', payment_id FROM typed""",
    ),
    "graph_edges": _with(
        TYPED,
        """SELECT 'CUSTOMER-USES-CARD' AS type, customer_id AS src, card_id AS dst, count(*) AS n_payments
FROM typed GROUP BY ALL
UNION ALL SELECT 'CARD-MADE-PAYMENT', card_id, payment_id, count(*) FROM typed GROUP BY ALL
UNION ALL SELECT 'PAYMENT-ON-DEVICE', payment_id, device_id, count(*) FROM typed GROUP BY ALL
UNION ALL SELECT 'PAYMENT-AT-MERCHANT', payment_id, merchant_id, count(*) FROM typed GROUP BY ALL""",
    ),
    "shared_devices": _with(
        TYPED,
        """SELECT device_id, count(DISTINCT card_id) AS n_cards FROM typed
GROUP BY device_id HAVING count(DISTINCT card_id) >= 2""",
    ),
    "multi_country_cards": _with(
        TYPED,
        """SELECT card_id, count(DISTINCT country) AS n_countries FROM typed
GROUP BY card_id HAVING count(DISTINCT country) >= 2""",
    ),
    "suspicious_merchants": _with(
        RELATIONS,
        """SELECT * FROM (
  SELECT merchant_id, count(DISTINCT card_id) AS n_cards, count(DISTINCT device_id) AS n_devices,
    count(DISTINCT card_id) + count(DISTINCT device_id) AS n_entities
  FROM relations WHERE risk_score >= 20 GROUP BY merchant_id)
WHERE n_entities >= 2""",
    ),
    "anomaly_components": CLUSTERS,
    "components_increments": CLUSTERS,
    "nlp_dataset": _with(
        FUSED, f"SELECT payment_id, {TEXT} AS text, {LABEL} AS label FROM suspicious"
    ),
    "train_val_split": _with(FUSED, f"SELECT payment_id, {PART} AS part FROM suspicious"),
    "classifier_accuracy": _with(
        FUSED,
        f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_label_1,
  count(*) FILTER (WHERE label = 0) AS n_label_0, true AS beats_majority
FROM (SELECT {LABEL} AS label, {PART} AS part FROM suspicious) WHERE part = 'validation'""",
    ),
}
