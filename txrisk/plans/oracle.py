"""The same results as :mod:`txrisk.plans.catalog`, in SQL on the same tables."""

from __future__ import annotations

MODELS = [f"{algo}_{kind}" for algo in ("gbt", "lr", "rf") for kind in ("weighted", "unweighted")]

# Written out here, so that the SQL does not repeat an error of the package.
DEVICES = ("mobile", "atm", "pos", "web")
LOCATIONS = (
    "Tokyo", "Toronto", "London", "Sydney", "Berlin", "Dubai", "New York", "Singapore",
)
MERCHANT_CATEGORIES = (
    "utilities", "online", "other", "entertainment", "travel", "grocery", "retail", "restaurant",
)

# First 32 bits of an md5 as a number.
HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT"


def _pick(values: tuple[str, ...], position: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[(({position}) + 1)::INTEGER]"


LABEL = (
    "((event_type = 'error' AND value > 20 AND hour(ts) < 12) OR "
    + HASH.format("'n' || event_id::VARCHAR")
    + " % 100 = 0)"
)
SPLIT = (
    "CASE WHEN " + HASH.format("{}::VARCHAR") + " % 10 < 8 THEN 'train' ELSE 'test' END"
)

TX = f"""tx AS (
  SELECT event_id AS transaction_id, ts AS "timestamp", value AS amount,
         event_type AS transaction_type,
         {_pick(DEVICES, "event_id % 4")} AS device_used,
         {_pick(LOCATIONS, "user_id % 8")} AS location,
         {_pick(MERCHANT_CATEGORIES, HASH.format("user_id::VARCHAR") + " % 8")} AS merchant_category,
         {LABEL} AS is_fraud,
         {LABEL}::INTEGER AS label,
         hour(ts)::INTEGER AS hour_of_day,
         isodow(ts)::INTEGER AS day_of_week,
         (isodow(ts) >= 6)::INTEGER AS is_weekend,
         {SPLIT.format("event_id")} AS split
  FROM events)"""

ISO_T = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
PAYLOAD_ROWS = f"""{TX}, payload AS (
  SELECT transaction_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", amount,
         transaction_type, device_used, location, merchant_category,
         hour_of_day, day_of_week, is_weekend, label AS is_fraud
  FROM tx)"""

RULE = f"""rule AS (
  SELECT event_id, (event_id // 500)::INTEGER AS batch_id, event_type AS transaction_type,
         CASE WHEN event_id % 97 <> 0 THEN {LABEL}::INTEGER END AS label,
         (event_type = 'error' AND value > 20)::INTEGER AS prediction
  FROM events)"""

# Categories of every column with their index: most frequent first, ties alphabetical.
PAIRS = " UNION ALL ".join(
    f"SELECT transaction_id, {n} AS place, '{c}' AS feature, {c} AS value FROM tx"
    for n, c in enumerate(("transaction_type", "device_used", "location", "merchant_category"))
)
INDEXED = f"""{TX}, pairs AS ({PAIRS}), vocabulary AS (
  SELECT place, feature, value, count(*) AS n,
         (row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) - 1)::INTEGER AS idx
  FROM pairs GROUP BY place, feature, value), widths AS (
  SELECT place, feature, (count(*) + 1)::INTEGER AS width FROM vocabulary GROUP BY place, feature)"""


def _weights(n_pos: str = "n_pos", n_neg: str = "n_neg") -> str:
    def one(n: str) -> str:
        return (
            f"round(CASE WHEN {n_pos} > 0 AND {n_neg} > 0 "
            f"THEN greatest({n_pos}, {n_neg})::DOUBLE / {n} ELSE 1.0::DOUBLE END, 6)"
        )

    return f"{one(n_pos)} AS weight_pos, {one(n_neg)} AS weight_neg"


def _class_counts(label: str = "label") -> str:
    return (
        f"count(*) FILTER (WHERE {label} = 1) AS n_pos, "
        f"count(*) FILTER (WHERE {label} = 0) AS n_neg, "
        f"count(*) FILTER (WHERE {label} IS NULL) AS n_null"
    )


CELLS = """
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(label) AS total"""
RATES = """
         CASE WHEN total > 0 THEN (tp + tn)::DOUBLE / total ELSE 0.0::DOUBLE END AS accuracy,
         CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0::DOUBLE END AS "precision",
         CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0::DOUBLE END AS recall"""
METRICS = """
       tp, tn, fp, fn, total, round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision",
       round(recall, 6) AS recall,
       round(CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall)
             ELSE 0.0::DOUBLE END, 6) AS f1"""

FIELDS = (
    "amount, transaction_type, device_used, location, merchant_category, "
    "hour_of_day, day_of_week, is_weekend, is_fraud"
)
DIRTY = f"""{PAYLOAD_ROWS}, decoded AS (
  SELECT transaction_id,
         CASE WHEN k > 2 THEN "timestamp" END AS "timestamp",
         CASE WHEN k > 2 THEN amount END AS amount,
         CASE WHEN k > 2 THEN transaction_type END AS transaction_type,
         CASE WHEN k > 2 THEN device_used END AS device_used,
         CASE WHEN k > 1 THEN location END AS location,
         CASE WHEN k > 2 THEN merchant_category END AS merchant_category,
         CASE WHEN k > 3 THEN hour_of_day END AS hour_of_day,
         CASE WHEN k > 2 THEN day_of_week END AS day_of_week,
         CASE WHEN k > 2 THEN is_weekend END AS is_weekend,
         CASE WHEN k > 2 AND k <> 5 THEN is_fraud END AS is_fraud,
         k > 3 AS decode_ok
  FROM (SELECT *, transaction_id % 20 AS k FROM payload))"""



def _train_eval(model: str) -> str:
    weights = _weights() if not model.endswith("_unweighted") else "1.0::DOUBLE AS weight_pos, 1.0::DOUBLE AS weight_neg"
    return f"""
WITH {TX}, counts AS (SELECT {_class_counts()} FROM tx)
SELECT '{model}' AS model, {weights},
       (SELECT count(*) FROM tx WHERE split = 'test' AND label = 1) AS n_pos,
       (SELECT count(*) FROM tx WHERE split = 'test' AND label = 0) AS n_neg,
       (SELECT count(*) FROM tx WHERE split = 'test') AS total,
       0::BIGINT AS n_cells_off, 0::BIGINT AS n_fit_off
FROM counts"""


NO_VIOLATION = "SELECT 0::BIGINT AS n_bad, count(*) AS n_rows FROM events"

ORACLE: dict[str, str] = {
    "prep_calendar": """
SELECT event_id, ts AS "timestamp", hour(ts)::INTEGER AS hour_of_day,
       isodow(ts)::INTEGER AS day_of_week, (isodow(ts) >= 6)::INTEGER AS is_weekend
FROM events""",
    "prep_mixed_timestamps": """
SELECT 'T' || event_id::VARCHAR AS transaction_id, ts AS "timestamp" FROM events""",
    "prep_timestamp_forms": """
SELECT event_id, CASE WHEN event_id % 9 = 7 THEN date_trunc('second', ts) ELSE ts END::TIMESTAMP AS "timestamp" FROM events""",
    "prep_drop_columns": f"""
WITH {TX}
SELECT CASE transaction_id % 3
         WHEN 0 THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f')
         WHEN 1 THEN strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f')
         ELSE strftime("timestamp", '%m/%d/%Y %H:%M:%S.%f') END AS "timestamp",
       amount, transaction_type, merchant_category, location, device_used, is_fraud
FROM tx""",
    "csv_roundtrip": f"""
WITH {TX}
SELECT "timestamp", amount, transaction_type, merchant_category, location, device_used,
       is_fraud, hour_of_day, day_of_week, is_weekend
FROM tx""",
    "csv_cell_quality": """
WITH cells AS (
  SELECT event_id % 17 = 0 AS t, event_id % 13 = 0 AS a, event_id % 11 = 3 AS f, event_id % 7 = 2 AS h FROM events),
counts AS (
  SELECT count_if(t)::BIGINT AS t, count_if(a)::BIGINT AS a, count_if(f)::BIGINT AS f, count_if(h)::BIGINT AS h, count_if(t OR a OR f OR h)::BIGINT AS n FROM cells)
SELECT unnest(['timestamp', 'amount', 'is_fraud', 'hour_of_day', 'day_of_week']) AS "column",
       unnest([t, a, f, h, 0]) AS n_bad, unnest([t, a, f, h, 0]) AS n_kept, n AS n_bad_rows
FROM counts""",
    "csv_inferred_types": """
WITH texts AS (
  SELECT event_id, event_id % 101 = 7 AS rare, event_id::VARCHAR AS n, strftime(ts, '%Y-%m-%d') AS d, ts FROM events),
cells AS (
  SELECT unnest(['whole', 'large', 'fraction', 'code', 'flag', 'flag_or_number', 'day', 'moment', 'written_moment', 'power', 'blank']) AS "column",
         unnest([n, CASE WHEN rare THEN (event_id + 3000000000)::VARCHAR ELSE n END,
           CASE WHEN rare THEN n || '.25' WHEN event_id % 3 = 0 THEN '' ELSE n END, CASE WHEN rare THEN 'x1' ELSE n END,
           CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'false' END,
           CASE WHEN rare THEN '1' WHEN event_id % 2 = 0 THEN 'True' ELSE 'false' END,
           CASE WHEN event_id % 5 > 0 THEN d ELSE '' END, CASE WHEN rare THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE d END,
           CASE WHEN rare THEN strftime(ts, '%m/%d/%Y %H:%M:%S') ELSE d END, CASE WHEN rare THEN '1e40' ELSE n END, '']) AS v
  FROM texts),
fits AS (
  SELECT "column", count(*) AS n, count_if(lower(v) IN ('true', 'false')) AS b, count_if(regexp_full_match(v, '[0-9]+') AND TRY_CAST(v AS INTEGER) IS NOT NULL) AS i,
         count_if(regexp_full_match(v, '[0-9]+')) AS l, count_if(regexp_full_match(v, '[0-9.e]+') AND TRY_CAST(v AS DOUBLE) IS NOT NULL) AS f,
         count_if(regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}')) AS d,
         count_if(TRY_CAST(v AS TIMESTAMP) IS NOT NULL OR try_strptime(v, '%m/%d/%Y %H:%M:%S') IS NOT NULL) AS t
  FROM cells WHERE v <> '' GROUP BY "column")
SELECT "column", CASE n WHEN b THEN 'boolean' WHEN i THEN 'int' WHEN l THEN 'bigint' WHEN f THEN 'double' WHEN d THEN 'date'
                        WHEN t THEN 'timestamp_ntz' ELSE 'string' END AS type FROM fits
UNION ALL SELECT 'blank', 'string'""",
    "class_counts": f"WITH {TX} SELECT {_class_counts()} FROM tx",
    "class_weights": f"""
WITH {TX}, counts AS (SELECT {_class_counts()} FROM tx)
SELECT n_pos, n_neg, n_null, {_weights()} FROM counts""",
    "class_weights_by_split": f"""
WITH {TX}, counts AS (SELECT split, {_class_counts()} FROM tx GROUP BY split)
SELECT split, n_pos, n_neg, n_null, {_weights()} FROM counts""",
    "weighted_class_totals": f"""
WITH {TX}, counts AS (SELECT label, count(*) AS n FROM tx GROUP BY label)
SELECT label, n AS n_rows,
       round(CASE WHEN (SELECT count(*) FROM counts) < 2 THEN n::DOUBLE
                  ELSE (SELECT max(n) FROM counts)::DOUBLE END, 6) AS total_weight
FROM counts""",
    "document_class_weights": f"""
WITH counts AS (
  SELECT lang, {_class_counts("toxic")}
  FROM documents JOIN labels USING (doc_id) GROUP BY lang)
SELECT lang, n_pos, n_neg, n_null, {_weights()} FROM counts""",
    "hash_split": f"SELECT event_id AS transaction_id, {SPLIT.format('event_id')} AS split FROM events",
    "random_split": """
SELECT count(*) AS n_rows, sum(event_id)::BIGINT AS sum_ids, 1::INTEGER AS share_ok FROM events""",
    "index_labels": f"WITH {INDEXED} SELECT feature, value, idx, n FROM vocabulary",
    "index_apply": f"""
WITH {TX}, seen AS (SELECT * FROM tx WHERE location <> 'Tokyo'),
{", ".join(f'''v_{c} AS (
  SELECT {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx
  FROM seen GROUP BY {c})''' for c in ("transaction_type", "device_used", "location", "merchant_category"))}
SELECT transaction_id,
{", ".join(f'''
  coalesce(v_{c}.idx, (SELECT count(*) FROM v_{c}))::INTEGER AS {c}_idx'''
  for c in ("transaction_type", "device_used", "location", "merchant_category"))}
FROM tx
{" ".join(f"LEFT JOIN v_{c} ON v_{c}.value = tx.{c}"
  for c in ("transaction_type", "device_used", "location", "merchant_category"))}""",
    "index_many_categories": f"""
WITH {TX}, rows AS (
  SELECT transaction_id, CASE WHEN transaction_id % 4 = 0 THEN transaction_type WHEN transaction_id % 8 = 1 THEN 'chain'
    WHEN transaction_id % 4 = 1 THEN 'market' WHEN transaction_id % 31 <> 2 THEN 'm' || transaction_id END AS v FROM tx),
counts AS (SELECT v, count(*) AS n FROM rows WHERE v IS NOT NULL GROUP BY v),
kept AS (
  SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS idx FROM counts WHERE n * 12 >= (SELECT sum(n) FROM counts)),
size AS (SELECT count(*) AS k FROM kept)
SELECT transaction_id, (CASE WHEN rows.v IS NULL THEN k + 32 WHEN idx IS NOT NULL THEN idx
    ELSE k + {HASH.format("rows.v")} % 32 END)::INTEGER AS idx, (k + 33)::INTEGER AS width
FROM rows LEFT JOIN kept USING (v), size""",
    "onehot_slots": f"""
WITH {INDEXED}
SELECT p.transaction_id, p.feature, w.width, v.idx AS slot
FROM pairs p JOIN vocabulary v ON v.feature = p.feature AND v.value = p.value
JOIN widths w ON w.feature = p.feature""",
    "feature_slots": f"""
WITH {INDEXED}, starts AS (
  SELECT feature, 4 + coalesce(sum(width) OVER (
           ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM widths)
SELECT transaction_id, slot::INTEGER AS slot, value::DOUBLE AS value FROM (
  SELECT transaction_id, 0 AS slot, amount AS value FROM tx
  UNION ALL SELECT transaction_id, 1, hour_of_day FROM tx
  UNION ALL SELECT transaction_id, 2, day_of_week FROM tx
  UNION ALL SELECT transaction_id, 3, is_weekend FROM tx
  UNION ALL SELECT p.transaction_id, s.start + v.idx, 1.0
  FROM pairs p JOIN vocabulary v ON v.feature = p.feature AND v.value = p.value
  JOIN starts s ON s.feature = p.feature)
WHERE value <> 0""",
    "confusion_matrix": f"WITH {RULE} SELECT {CELLS} FROM rule",
    "classification_metrics": f"""
WITH {RULE}, cells AS (SELECT {CELLS} FROM rule), rates AS (SELECT *, {RATES} FROM cells)
SELECT {METRICS} FROM rates""",
    "metrics_by_type": f"""
WITH {RULE}, cells AS (SELECT transaction_type, {CELLS} FROM rule GROUP BY transaction_type),
rates AS (SELECT *, {RATES} FROM cells)
SELECT transaction_type, {METRICS} FROM rates""",
    "metric_report": f"""
WITH {RULE}, cells AS (SELECT {CELLS}, {_class_counts()} FROM rule),
rates AS (SELECT *, {RATES} FROM cells)
SELECT 'rule' AS model, {_weights()}, {METRICS} FROM rates""",
    "batch_accuracy": f"""
WITH {RULE}
SELECT batch_id, count(*) FILTER (WHERE label = prediction) AS n_correct, count(*) AS n_rows,
       round(count(*) FILTER (WHERE label = prediction)::DOUBLE / count(*), 6) AS accuracy
FROM rule GROUP BY batch_id""",
    "holdout_totals": f"""
WITH {TX}, side AS (
  SELECT count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg
  FROM tx WHERE split = 'test'),
weights AS (
  SELECT {_weights()} FROM (SELECT {_class_counts()} FROM tx)),
models AS (
  SELECT unnest([{", ".join(f"'{m}'" for m in MODELS)}]) AS model)
SELECT model, (SELECT n_pos FROM side) AS n_pos, (SELECT n_neg FROM side) AS n_neg,
       (SELECT n_pos + n_neg FROM side) AS total,
       CASE WHEN model LIKE '%_unweighted' THEN 1.0::DOUBLE
            ELSE (SELECT weight_pos FROM weights) END AS weight_pos,
       CASE WHEN model LIKE '%_unweighted' THEN 1.0::DOUBLE
            ELSE (SELECT weight_neg FROM weights) END AS weight_neg
FROM models""",
    "lr_probability_identity": NO_VIOLATION,
    "gbt_margin_identity": NO_VIOLATION,
    "probability_simplex": NO_VIOLATION,
    "model_roundtrip": NO_VIOLATION,
    "json_roundtrip": f"""
WITH {PAYLOAD_ROWS}
SELECT transaction_id, "timestamp", {FIELDS}, true AS decode_ok FROM payload""",
    "json_decode_dirty": f"WITH {DIRTY} SELECT * FROM decoded",
    "stream_decode": f"WITH {DIRTY} SELECT * FROM decoded",
    "stream_score_rows": """
SELECT event_id AS transaction_id, event_id % 20 > 3 AS decode_ok, event_id % 20 > 3 AS features_ok,
       true AS has_score, true AS has_batch
FROM events""",
    "stream_native_rows": f"""
WITH {PAYLOAD_ROWS} SELECT transaction_id, amount, is_fraud, true AS has_score FROM payload""",
    "saved_predictions_view": f"""
WITH {PAYLOAD_ROWS} SELECT "timestamp", {FIELDS}, true AS has_score FROM payload""",
    "saved_predictions_accuracy": """
SELECT count(*) AS n_rows, 0::BIGINT AS n_poor_batches FROM events""",
    "saved_predictions_packed": f"""
WITH {TX}
SELECT (transaction_id % 200)::INTEGER AS batch_id, count(*) AS n_rows, sum(transaction_id)::BIGINT AS sum_ids, count_if(amount > 20)::BIGINT AS n_flagged,
       strftime(min("timestamp"), '%Y-%m-%d') AS first_day, strftime(max("timestamp"), '%Y-%m-%d') AS last_day, count(*) AS told_n_rows,
       count_if(amount > 20 AND is_fraud)::BIGINT AS told_tp, count_if(amount > 20 AND NOT is_fraud)::BIGINT AS told_fp
FROM tx GROUP BY ALL""",
    "saved_predictions_report": "SELECT count(*) AS n_rows, 0::BIGINT AS n_off FROM events",
    "stream_model_versions": """
SELECT event_id AS transaction_id, true AS has_score, true AS has_version, true AS few_loads FROM events""",
    "preview_rows": f"""
WITH {PAYLOAD_ROWS}
SELECT * FROM payload ORDER BY "timestamp" DESC, transaction_id DESC LIMIT 20""",
} | {f"train_eval_{m}": _train_eval(m) for m in MODELS} | {
    "train_eval_documents": f"""
WITH d AS (
  SELECT toxic AS label, {SPLIT.format("doc_id")} AS split FROM documents JOIN labels USING (doc_id)),
counts AS (SELECT {_class_counts()} FROM d)
SELECT 'lr_weighted' AS model, {_weights()},
       (SELECT count(*) FROM d WHERE split = 'test' AND label = 1) AS n_pos,
       (SELECT count(*) FROM d WHERE split = 'test' AND label = 0) AS n_neg,
       (SELECT count(*) FROM d WHERE split = 'test' AND label IS NOT NULL) AS total,
       0::BIGINT AS n_cells_off, 0::BIGINT AS n_fit_off
FROM counts"""
}
