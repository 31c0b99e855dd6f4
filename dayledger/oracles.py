"""The same results as plain SQL over the same tables, for checking."""

from __future__ import annotations

from dayledger.functions.hashing import HIGH_STEP, ID_STEP, PRIME, SEED_STEP, STREAM_STEP

RAW_COLUMNS = (
    "tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, "
    "tx_time_days, tx_fraud, tx_fraud_scenario"
)
FEATURES = (
    "tranaction_id", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds",
    "tx_time_days", "tx_fraud_scenario",
)

TX = """tx AS (
  SELECT CAST(event_id AS INT) AS tranaction_id,
    CASE WHEN event_id % 13 = 0 THEN NULL
         ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS tx_datetime,
    CAST(user_id AS INT) AS customer_id,
    CAST(event_id % 11 AS INT) AS terminal_id,
    CASE WHEN event_id % 17 = 0 THEN -value ELSE value END AS tx_amount,
    CAST(floor(epoch(ts)) - epoch(TIMESTAMP '2024-01-01 00:00:00') AS INT) AS tx_time_seconds,
    CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS tx_time_days,
    CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_type = 'error' THEN 1 ELSE 0 END AS tx_fraud,
    CASE WHEN event_type = 'error' THEN CAST(1 + event_id % 3 AS INT) ELSE 0 END AS tx_fraud_scenario,
    CAST(ts AS DATE) AS src_date
  FROM events)"""
IS_CLEAN = "tx_amount > 0 AND customer_id > 0 AND terminal_id > 0 AND tx_datetime IS NOT NULL"
CLEAN = f"{TX}, c AS (SELECT * FROM tx WHERE {IS_CLEAN})"
DAILY = f"""{TX}, days AS (
  SELECT src_date, count(*) AS n_raw,
    CAST(sum(CASE WHEN {IS_CLEAN} THEN 1 ELSE 0 END) AS BIGINT) AS n_clean,
    count(*) FILTER (WHERE {IS_CLEAN} AND tx_fraud IS NOT NULL) AS n_labelled
  FROM tx GROUP BY src_date)"""
WEEKDAYS = "days AS (SELECT DISTINCT CAST(ts AS DATE) AS src_date FROM events WHERE isodow(ts) <= 5)"
ALL_RAW = f"{RAW_COLUMNS}, src_date"


def h31(key: str, stream: int = 0, seed: int = 42) -> str:
    shift = (stream * STREAM_STEP * SEED_STEP + seed * SEED_STEP + STREAM_STEP) % PRIME
    k = f"CAST({key} AS BIGINT)"
    x = f"((({k} % {PRIME}) * {ID_STEP} + (({k} >> 31) % {PRIME}) * {HIGH_STEP} + {shift}) % {PRIME})"
    square = f"(({x} * {x}) % {PRIME})"
    return f"(((({square} * {square}) % {PRIME}) * {x}) % {PRIME})"


def uniform(key: str, stream: int) -> str:
    return f"((CAST({h31(key, stream)} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({PRIME} AS DOUBLE))"


def normal(key: str, stream: int) -> str:
    return (
        f"(sqrt(CAST(-2 AS DOUBLE) * ln({uniform(key, stream)})) "
        f"* cos(CAST(2 AS DOUBLE) * pi() * {uniform(key, stream + 1)}))"
    )


def uniform_int(key: str, stream: int, low: int, high: int) -> str:
    return f"CAST(floor({uniform(key, stream)} * CAST({high - low} AS DOUBLE)) + {low} AS INT)"


def by_class(normal_value: float, fraud_value: float) -> str:
    return f"CASE WHEN fraud = 1 THEN CAST({fraud_value} AS DOUBLE) ELSE CAST({normal_value} AS DOUBLE) END"


def flag(key: str, stream: int, normal_p: float, fraud_p: float) -> str:
    return f"CASE WHEN {uniform(key, stream)} < {by_class(normal_p, fraud_p)} THEN 1 ELSE 0 END"


def by_priority(*values: str) -> str:
    tests = " ".join(
        f"WHEN o_orderpriority LIKE '{i}%' THEN {value}" for i, value in enumerate(values, 1)
    )
    return f"CASE {tests} END"


ORDER_DAY = "CAST(o_orderdate AS DATE)"
PADDED = f"strftime({ORDER_DAY}, '%Y-%m-%d')"
UNPADDED = f"concat(year({ORDER_DAY}), '-', month({ORDER_DAY}), '-', day({ORDER_DAY}))"

POSITIONED = f"""p AS (
  SELECT *, row_number() OVER (ORDER BY {h31('tranaction_id')}, tranaction_id) AS position FROM tx)"""
SAMPLED = f"""{TX}, {POSITIONED},
train AS (SELECT * FROM p WHERE position <= (SELECT round(count(*) * 0.8) FROM tx))"""

DOCUMENTS = """j AS (
  SELECT CAST(quality AS DOUBLE) AS label, CASE WHEN n_chars > 500 THEN 1.0 ELSE 0.0 END AS prediction,
    CAST(n_chars AS DOUBLE) AS score
  FROM labels JOIN documents USING (doc_id))"""
TRANSACTIONS = f"""{CLEAN}, j AS (
  SELECT CAST(tx_fraud AS DOUBLE) AS label, CASE WHEN tx_amount > 100 THEN 1.0 ELSE 0.0 END AS prediction,
    tx_amount AS score
  FROM c WHERE tx_fraud IS NOT NULL)"""
F1_PARTS = """classes AS (
  SELECT s.label, s.support, coalesce(h.hits, 0) AS hits, coalesce(q.predicted, 0) AS predicted
  FROM (SELECT label, count(*) AS support FROM j GROUP BY label) s
  LEFT JOIN (SELECT prediction AS label, count(*) AS predicted FROM j GROUP BY prediction) q USING (label)
  LEFT JOIN (SELECT label, count(*) AS hits FROM j WHERE label = prediction GROUP BY label) h USING (label))"""
F1 = """(SELECT round(CAST(sum(CAST(2 * hits AS DOUBLE) / (support + predicted) * support) AS DOUBLE)
  / sum(support), 6) FROM classes)"""
ACCURACY = """(SELECT round(CAST(sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS DOUBLE)
  / count(*), 6) FROM j)"""
AUC_PARTS = """scores AS (
  SELECT score, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos,
    sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS neg
  FROM j GROUP BY score),
ranked AS (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS lower FROM scores)"""
AUC = """(SELECT round(CAST(sum(pos * (2 * lower + neg)) AS DOUBLE)
  / CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 6) FROM ranked)"""

FOLDS = f"""folds AS (
  SELECT event_type, {h31('event_id')} % 3 AS fold, avg(value) AS metric FROM events GROUP BY 1, 2),
means AS (SELECT event_type, avg(metric) AS mean_metric, count(*) AS n_folds FROM folds GROUP BY event_type)"""

RUNS = """measured AS (
  SELECT event_type AS model_name, CAST(ts AS DATE) AS day,
    round(avg(value) / 500, 4) AS auc,
    round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 4) AS accuracy,
    round(avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END), 4) AS f1
  FROM events GROUP BY 1, 2),
runs AS (
  SELECT model_name, concat('fraud_rf_', strftime(day, '%Y%m%d'), '_000000_', model_name) AS run_id,
    day, CASE WHEN isodow(day) <> 7 THEN auc END AS auc, accuracy, f1 FROM measured),
logged AS (
  SELECT run_id, 'auc' AS key, auc AS value FROM runs WHERE auc IS NOT NULL
  UNION ALL SELECT run_id, 'accuracy', accuracy FROM runs
  UNION ALL SELECT run_id, 'f1', f1 FROM runs),
versions AS (
  SELECT model_name, CAST(row_number() OVER (PARTITION BY model_name ORDER BY day, run_id) AS INT) AS version,
    run_id FROM runs),
measured_versions AS (
  SELECT v.run_id, v.model_name, v.version, m.value AS metric
  FROM versions v LEFT JOIN (SELECT * FROM logged WHERE key = 'auc') m USING (run_id)),
segments AS (
  SELECT *, sum(CASE WHEN metric IS NULL THEN 1 ELSE 0 END)
    OVER (PARTITION BY model_name ORDER BY version) AS segment FROM measured_versions),
best AS (
  SELECT *, max(metric) OVER (PARTITION BY model_name, segment ORDER BY version
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM segments),
history AS (
  SELECT run_id, model_name, version, metric, best,
    CASE WHEN metric IS NULL OR best IS NULL OR metric > best THEN 'champion' ELSE 'challenger' END AS alias
  FROM best)"""


def newest(alias: str) -> str:
    return f"""newest AS (
  SELECT model_name, version, run_id FROM (
    SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC) AS r
    FROM history WHERE alias = '{alias}') WHERE r = 1)"""


def long_features(value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT tranaction_id, CAST({i} AS INT) AS idx, {value.format(c=c)} AS value FROM c CROSS JOIN s"
        if "{c}_mean" in value
        else f"SELECT tranaction_id, CAST({i} AS INT) AS idx, {value.format(c=c)} AS value FROM c"
        for i, c in enumerate(FEATURES)
    )


def z_scores() -> str:
    stats = ", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_sd" for c in FEATURES)
    # Adding zero turns a rounded -0.0 into 0.0.
    value = (
        "CASE WHEN {c}_sd = 0 THEN 0.0 "
        "ELSE round((CAST({c} AS DOUBLE) - {c}_mean) / {c}_sd, 4) + CAST(0 AS DOUBLE) END"
    )
    return f"WITH {CLEAN}, s AS (SELECT {stats} FROM c) {long_features(value)}"


def synth() -> str:
    i = "id"
    return f"""WITH ids AS (
  SELECT event_id AS id,
    CASE WHEN event_id >= floor((SELECT count(*) FROM events) * (CAST(1 AS DOUBLE) - CAST(0.05 AS DOUBLE)))
      THEN 1 ELSE 0 END AS fraud FROM events),
placed AS (SELECT *, row_number() OVER (ORDER BY {h31(i)}, id) AS position FROM ids)
SELECT printf('tx_%08d', position - 1) AS transaction_id,
  TIMESTAMP '2024-01-31 00:00:00' - to_minutes({uniform_int(i, 13, 1, 43200)}) AS "timestamp",
  round(exp({by_class(5.0, 6.0)} + {by_class(1.0, 2.0)} * {normal(i, 1)}), 4) AS amount,
  {uniform_int(i, 3, 0, 24)} AS hour_of_day,
  {uniform_int(i, 4, 0, 7)} AS day_of_week,
  round(-({by_class(30.0, 100.0)}) * ln({uniform(i, 5)}), 4) AS distance_from_home,
  round(-({by_class(20.0, 100.0)}) * ln({uniform(i, 6)}), 4) AS distance_from_last_transaction,
  round({by_class(1.0, 3.0)} + {by_class(0.5, 1.0)} * {normal(i, 7)}, 4) AS ratio_to_median_purchase_price,
  {flag(i, 9, 0.5, 0.2)} AS repeat_retailer,
  {flag(i, 10, 0.9, 0.2)} AS used_chip,
  {flag(i, 11, 0.8, 0.2)} AS used_pin_number,
  {flag(i, 12, 0.4, 0.8)} AS online_order,
  fraud
FROM placed"""


def oracles() -> dict[str, str]:
    all_raw = f"WITH {TX} SELECT {ALL_RAW} FROM tx"
    all_clean = f"WITH {CLEAN} SELECT {ALL_RAW} FROM c"
    return {
        "scan_typed_csv": all_raw,
        "rejected_cells": f"""WITH {TX}
SELECT src_date, CAST(tranaction_id AS VARCHAR) AS "row", 'tx_datetime' AS "column", 'no time' AS text FROM tx WHERE tranaction_id % 11 = 0
UNION ALL SELECT src_date, CAST(tranaction_id AS VARCHAR), 'terminal_id', '1.5' FROM tx WHERE tranaction_id % 23 = 0
UNION ALL SELECT src_date, CAST(tranaction_id AS VARCHAR), 'tx_amount', 'n/a, "free"' FROM tx WHERE tranaction_id % 7 = 0
UNION ALL SELECT src_date, CAST(tranaction_id AS VARCHAR), 'tx_fraud', 'yes' FROM tx WHERE tranaction_id % 29 = 0""",
        "csv_round_trip": f"WITH {TX} SELECT {RAW_COLUMNS} FROM tx",
        "source_exists": f"""WITH {WEEKDAYS},
cal AS (SELECT CAST(DATE '2023-12-31' + CAST(i AS INT) AS DATE) AS src_date FROM range(1, 41) t(i))
SELECT cal.src_date, strftime(cal.src_date, '%Y-%m-%d') || '.txt' AS source_key,
  days.src_date IS NOT NULL AS file_exists
FROM cal LEFT JOIN days ON cal.src_date = days.src_date""",
        "next_source_files": f"""WITH {WEEKDAYS}
SELECT src_date, strftime(src_date, '%Y-%m-%d') || '.txt' AS source_key FROM days
WHERE src_date > DATE '2024-01-05' AND src_date <= DATE '2024-01-05' + 30 ORDER BY src_date LIMIT 3""",
        "parse_watermark": f"""WITH t AS (SELECT o_orderkey, {by_priority(
            f"{PADDED} || chr(10)", f"'  ' || {PADDED} || '.txt' || chr(9)", UNPADDED,
            "' ' || chr(13) || chr(10)", "NULL")} AS text FROM orders)
SELECT o_orderkey, coalesce(CAST(nullif(regexp_replace(trim(text, concat(' ', chr(9), chr(10), chr(13))),
  '\\.txt$', ''), '') AS DATE), DATE '2023-12-31') AS watermark FROM t""",
        "advance_watermark": f"""WITH {DAILY}
SELECT DATE '2023-12-31' AS watermark_before, max(src_date) AS watermark_after, count(*) AS n_days,
  CAST(sum(n_raw) AS BIGINT) AS n_raw, CAST(sum(n_clean) AS BIGINT) AS n_clean FROM days""",
        "ledger_rows": f"""WITH {DAILY}
SELECT src_date, strftime(src_date, '%Y-%m-%d') || '.txt' AS source_key,
  'clean_20240131_000000' AS run_id, n_raw, n_clean, n_labelled FROM days""",
        "clean_transactions": all_clean,
        "lineage_columns": f"""WITH {CLEAN}
SELECT tranaction_id, strftime(src_date, '%Y-%m-%d') || '.txt' AS _source_key,
  'clean_20240131_000000' AS _ingest_run_id FROM c""",
        "clean_counts_per_day": f"WITH {DAILY} SELECT src_date, n_raw, n_clean FROM days",
        "clean_summary": f"""WITH {DAILY}
SELECT CAST(sum(n_raw) AS BIGINT) AS n_raw, CAST(sum(n_clean) AS BIGINT) AS n_clean FROM days""",
        "clean_mixed_landing": f"WITH {DAILY} SELECT * FROM days",
        "stream_mixed_landing": all_clean,
        "compacted_days": f"""WITH {DAILY}
SELECT src_date, n_clean AS n_rows, n_labelled, CAST(1 AS BIGINT) AS n_folders, true AS files_fit FROM days WHERE n_clean > 0""",
        "ledger_commits": f"""WITH {DAILY},
placed AS (SELECT *, (row_number() OVER (ORDER BY src_date) + 11) // 12 AS version FROM days)
SELECT version, count(*) AS n_days, min(src_date) AS first_day, CAST(sum(n_raw) AS BIGINT) AS n_raw,
  CAST(sum(n_clean) AS BIGINT) AS n_clean FROM placed GROUP BY version""",
        "committed_history": all_clean,
        "changed_source_days": f"""WITH {TX},
parts AS (SELECT DISTINCT src_date, CASE WHEN day(src_date) % 4 = 0 THEN 'late'
    WHEN day(src_date) % 5 = 1 AND tranaction_id % 3 = 0 THEN 'changed' END AS status FROM tx)
SELECT src_date, strftime(src_date, '%Y-%m-%d') || '.txt' AS source_key, status FROM parts
WHERE status IS NOT NULL AND src_date <= (SELECT max(src_date) FROM parts WHERE status IS NULL)""",
        "reconciled_ledger": f"WITH {DAILY} SELECT * FROM days",
        "stream_ingest": all_clean,
        "write_day_partitions": all_clean,
        "write_days_four_files": all_clean,
        "scan_history": all_clean,
        "preview": f"{all_clean} ORDER BY tranaction_id LIMIT 20",
        "latest_n_partitions": f"WITH {DAILY} SELECT src_date FROM days ORDER BY src_date DESC LIMIT 5",
        "date_name_filter": f"""WITH n AS (SELECT {by_priority(
            PADDED, f"strftime({ORDER_DAY}, '%Y%m%d')", UNPADDED,
            f"concat(strftime({ORDER_DAY}, '%Y'), '-xx-', strftime({ORDER_DAY}, '%d'))",
            f"{PADDED} || '.txt'")} AS name FROM orders)
SELECT name, count(*) AS n FROM n
WHERE length(name) = 10 AND substr(name, 5, 1) = '-' AND substr(name, 8, 1) = '-' GROUP BY name""",
        "training_window": f"""WITH {CLEAN},
latest AS (SELECT DISTINCT src_date FROM tx ORDER BY src_date DESC LIMIT 5)
SELECT {ALL_RAW} FROM c WHERE tx_fraud IS NOT NULL AND src_date IN (SELECT src_date FROM latest)""",
        "stream_training_window": f"""WITH {CLEAN},
latest AS (SELECT DISTINCT src_date FROM c ORDER BY src_date DESC LIMIT 5)
SELECT {ALL_RAW} FROM c WHERE tx_fraud IS NOT NULL AND src_date IN (SELECT src_date FROM latest)""",
        "labelled_rows": f"{all_clean} WHERE tx_fraud IS NOT NULL",
        "labelled_rows_count": f"WITH {CLEAN} SELECT count(*) AS n_rows FROM c WHERE tx_fraud IS NOT NULL",
        "training_rows_per_cycle": f"""WITH {DAILY}
SELECT src_date, CAST(sum(n_labelled) OVER (ORDER BY src_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT)
  AS train_rows FROM days""",
        "date_parse_format": f"""SELECT o_orderkey, CAST({UNPADDED} AS DATE) AS parsed,
  TRY_CAST({by_priority(PADDED, UNPADDED, "'2019-02-30'", "'none'", UNPADDED)} AS DATE) AS tolerant,
  strftime({ORDER_DAY} + 1, '%Y-%m-%d') AS next_name FROM orders""",
        "object_key_compose": """WITH d AS (SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
  CASE event_type WHEN 'view' THEN 'store/clean/history' WHEN 'click' THEN 'store/clean/history/'
    ELSE 'store/clean/history///' END AS root FROM events)
SELECT event_id, day || '.txt' AS source_key, concat_ws('/', regexp_replace(root, '/+$', ''), 'by_file', day)
    AS day_path,
  concat_ws('/', regexp_replace(root, '/+$', ''), '_watermark/last_date.txt') AS watermark_path,
  day AS day_name FROM d""",
        "run_id_format": """SELECT event_id, strftime(ts, 'clean_%Y%m%d_%H%M%S') AS clean_run,
  strftime(ts, 'fraud_rf_%Y%m%d_%H%M%S') AS train_run FROM events""",
        "split_uri": """SELECT page_id,
  CASE WHEN url ~ '^https?://.*' THEN regexp_extract(url, '^https?://([^/?#]*)', 1) END AS bucket,
  CASE WHEN url ~ '^https?://.*' THEN regexp_extract(url, '^https?://[^/?#]*/*([^?#]*)', 1) END AS key
FROM pages""",
        "numeric_feature_columns": f"WITH {CLEAN} "
        + " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n_values FROM c" for c in FEATURES),
        "assemble_features": f"WITH {CLEAN} {long_features('CAST({c} AS DOUBLE)')}",
        "scaler_stats": f"WITH {CLEAN} "
        + " UNION ALL ".join(
            f"SELECT CAST({i} AS INT) AS idx, '{c}' AS feature, count({c}) AS n, "
            f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std FROM c"
            for i, c in enumerate(FEATURES)
        ),
        "scaler_stats_window": f"""WITH {CLEAN}, d AS (
  SELECT src_date, row_number() OVER (ORDER BY src_date) AS at FROM (SELECT DISTINCT src_date FROM tx)),
w AS (SELECT e.src_date AS window_end, c.* FROM d e JOIN d b ON b.at BETWEEN e.at - 4 AND e.at JOIN c ON c.src_date = b.src_date) """
        + " UNION ALL ".join(
            f"SELECT window_end, '{c}' AS feature, count({c}) AS n, round(avg({c}), 4) AS mean, "
            f"round(stddev_samp({c}), 3) AS std FROM w GROUP BY window_end"
            for c in FEATURES
        ),
        "standardize": z_scores(),
        "random_split_rows": all_clean,
        "hash_split": f"""WITH {CLEAN}
SELECT tranaction_id, CASE WHEN {h31('tranaction_id')} % 10 < 8 THEN 'train' ELSE 'test' END AS part FROM c""",
        "hash_split_null_keys": f"""WITH {CLEAN}, k AS (
  SELECT tranaction_id, CASE WHEN tranaction_id % 5 <> 0 THEN tranaction_id END AS key FROM c)
SELECT key, tranaction_id, CASE WHEN key IS NOT NULL AND {h31('key')} % 10 < 8 THEN 'train' ELSE 'test' END AS part
FROM k""",
        "random_split_shares": f"WITH {CLEAN} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_in_both, true AS share_fits FROM c",
        "share_split": f"""WITH {CLEAN}
SELECT tranaction_id, CASE WHEN {h31('tranaction_id')} < {int(0.8375 * PRIME)} THEN 'train' ELSE 'test' END AS part FROM c""",
        "exact_split": f"""WITH {SAMPLED}
SELECT {ALL_RAW}, CASE WHEN position <= (SELECT round(count(*) * 0.8) FROM tx) THEN 'train' ELSE 'test' END AS part FROM p""",
        "exact_split_any_keys": f"""WITH {TX}, n AS (SELECT count(*) AS n, CAST(round(count(*) * 0.8) AS BIGINT) AS k FROM tx)
SELECT 'train' AS part, k AS n_rows, k AS n_ids, CAST(0 AS BIGINT) AS n_lost FROM n
UNION ALL SELECT 'test', n - k, n - k, 0 FROM n""",
        "kfold_assign": f"""WITH {CLEAN}
SELECT tranaction_id, CAST({h31('tranaction_id')} % 3 AS INT) AS fold FROM c""",
        "exact_sample": f"WITH {SAMPLED} SELECT {ALL_RAW} FROM train",
        "holdout_anti_join": f"""WITH {SAMPLED}
SELECT {ALL_RAW} FROM tx WHERE NOT EXISTS (
  SELECT 1 FROM train WHERE train.tranaction_id = tx.tranaction_id)""",
        "shuffle_rows": f"WITH {TX}, {POSITIONED} SELECT tranaction_id, position FROM p",
        "confusion_matrix": f"""WITH {TRANSACTIONS}
SELECT label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n FROM j GROUP BY 1, 2""",
        "metric_accuracy": f"WITH {DOCUMENTS} SELECT {ACCURACY} AS accuracy",
        "metric_f1": f"WITH {DOCUMENTS}, {F1_PARTS} SELECT {F1} AS f1",
        "metric_auc": f"WITH {DOCUMENTS}, {AUC_PARTS} SELECT {AUC} AS auc",
        "auc_per_window": f"""WITH {CLEAN}, l AS (SELECT * FROM c WHERE tx_fraud IS NOT NULL), d AS (
  SELECT src_date, row_number() OVER (ORDER BY src_date) AS at FROM (SELECT DISTINCT src_date FROM l)),
scores AS (
  SELECT e.src_date AS window_end, tx_amount AS score, sum(tx_fraud) AS pos, sum(1 - tx_fraud) AS neg
  FROM d e JOIN d b ON b.at BETWEEN e.at - 4 AND e.at JOIN l ON l.src_date = b.src_date GROUP BY 1, 2),
ranked AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY window_end ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower
  FROM scores)
SELECT window_end, coalesce(round(CAST(sum(pos * (2 * lower + neg)) AS DOUBLE)
  / nullif(CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 0), 6), 0) AS auc FROM ranked GROUP BY window_end""",
        "eval_metrics": f"""WITH {TRANSACTIONS}, {F1_PARTS}, {AUC_PARTS}
SELECT {AUC} AS auc, {ACCURACY} AS accuracy, {F1} AS f1""",
        "label_rate": f"""WITH {CLEAN}
SELECT count(*) AS n_rows, CAST(sum(tx_fraud) AS BIGINT) AS n_fraud,
  round(avg(CAST(tx_fraud AS DOUBLE)) * 100, 2) AS fraud_pct FROM c WHERE tx_fraud IS NOT NULL""",
        "cv_mean_metric": f"""WITH {FOLDS}
SELECT event_type, round(mean_metric, 6) AS mean_metric, n_folds FROM means""",
        "cv_best_params": f"""WITH {FOLDS}
SELECT event_type, round(mean_metric, 6) AS mean_metric, n_folds FROM means
ORDER BY means.mean_metric DESC, event_type LIMIT 1""",
        "log_metrics_long": f"WITH {RUNS} SELECT run_id, key, value FROM logged",
        "model_versions": f"WITH {RUNS} SELECT model_name, version, run_id FROM versions",
        "champion_history": f"WITH {RUNS} SELECT * FROM history",
        "stream_promotion": f"WITH {RUNS} SELECT * FROM history",
        "current_champion": f"WITH {RUNS}, {newest('champion')} SELECT * FROM newest",
        "current_challenger": f"WITH {RUNS}, {newest('challenger')} SELECT * FROM newest",
        "champion_lookup": f"""WITH {RUNS}, {newest('champion')}
SELECT model_name, version, run_id, key, value FROM newest JOIN logged USING (run_id) WHERE key = 'f1'""",
        "union_classes": f"""WITH {CLEAN}
SELECT tranaction_id, tx_amount, tx_fraud FROM c WHERE tx_fraud = 0
UNION ALL SELECT tranaction_id, tx_amount, tx_fraud FROM c WHERE tx_fraud = 1""",
        "synth_transactions": synth(),
        "rf_grid_search": """SELECT CAST(grid_id AS INT) AS grid_id, CAST(num_trees AS INT) AS num_trees,
  CAST(max_depth AS INT) AS max_depth, CAST(1 AS DOUBLE) AS mean_auc
FROM (VALUES (0, 20, 5), (1, 20, 10), (2, 50, 5), (3, 50, 10)) g(grid_id, num_trees, max_depth)""",
        "rf_grid_search_by_day": f"""WITH {CLEAN}
SELECT CAST({h31("date_diff('day', DATE '1970-01-01', src_date)")} % 3 AS INT) AS fold, count(DISTINCT src_date) AS n_days,
  count(*) AS n_rows, CAST(1 AS DOUBLE) AS best_auc FROM c WHERE tx_fraud IS NOT NULL GROUP BY 1""",
        "empty_guards": f"""WITH {CLEAN}
SELECT 'no_days' AS guard, CAST(0 AS BIGINT) AS n_rows, 'no day with rows' AS raised
UNION ALL SELECT 'no_labels', count(*), 'no labelled rows to train on' FROM c
UNION ALL SELECT 'no_features', count(*), 'no numeric feature column' FROM c""",
        "rf_predict": f"""WITH {CLEAN}
SELECT tranaction_id, CAST(tx_fraud AS DOUBLE) AS label, CAST(tx_fraud AS DOUBLE) AS prediction FROM c
WHERE tx_fraud IS NOT NULL AND {h31('tranaction_id')} % 10 >= 8""",
        "rf_run_log": """SELECT key, value FROM (VALUES ('label_col', 'tx_fraud'), ('features_count', '7'),
  ('numTrees_grid', '20,50'), ('maxDepth_grid', '5,10'), ('best_maxDepth', '5'), ('best_numTrees', '20'),
  ('auc', '1.0'), ('accuracy', '1.0'), ('f1', '1.0')) l(key, value)""",
        "rf_promotion": "SELECT 'fraud_model' AS model_name, CAST(1 AS INT) AS version, 'champion' AS alias",
    }
