"""Split, scaling, resampling and selection queries (T*, A25), with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import round_doubles
from ..operators import features as FE
from ..operators import prep as P
from ..operators.smote import smote
from ..sources.fixture import transactions
from .features import matrix_cte, matrix_features, older_variant
from .registry import query, txn_sql

FEATS = matrix_features()
CONT = [c for c in S.CONTINUOUS_FEATURES if c in FEATS]


def matrix(spark, sf):
    return FE.feature_matrix(transactions(spark, sf))[0]


def train_test(spark, sf):
    return P.temporal_split(matrix(spark, sf), 0.8, "step_raw")


# DuckDB pieces: feature matrix, 80 % step cut, train / test folds
_FOLDS = matrix_cte() + """,
cut AS (SELECT quantile_cont(step_raw, 0.8) AS c FROM fm),
tr AS (SELECT fm.* FROM fm, cut WHERE step_raw <= cut.c),
te AS (SELECT fm.* FROM fm, cut WHERE step_raw > cut.c)"""


def _md5_key(seed: int, col: str = "txn_id") -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({col} AS VARCHAR)), 1, 15))::BIGINT"


@query("temporal_split", txn_sql("""
SELECT split, rows, fraud_rows, round(rate * 100.0, 6) AS fraud_rate_pct, (SELECT c FROM cut) AS cut
FROM (SELECT 'train' AS split, count(*) AS rows, CAST(coalesce(sum(isFraud), 0) AS BIGINT) AS fraud_rows, avg(isFraud) AS rate FROM tr
      UNION ALL SELECT 'test', count(*), CAST(coalesce(sum(isFraud), 0) AS BIGINT), avg(isFraud) FROM te)""", ctes=_FOLDS))
def temporal_split(spark, sf):
    """T1 + A25: 80 % step-quantile split of the universe, fold summary and the cut."""
    tr, te, cut = train_test(spark, sf)
    return P.fold_summary({"train": tr, "test": te}).withColumn("cut", F.lit(cut))


@query("fold_prevalence_ratio", txn_sql("""
SELECT round(t.r / greatest(a.r, 1e-9), 6) AS ratio,
       round(t.r / greatest(a.r, 1e-9), 6) > 1.5 OR round(t.r / greatest(a.r, 1e-9), 6) < 0.67 AS alert
FROM (SELECT avg(isFraud) AS r FROM tr) a, (SELECT avg(isFraud) AS r FROM te) t""", ctes=_FOLDS))
def fold_prevalence_ratio(spark, sf):
    """test/train prevalence ratio with the 1.5 / 0.67 alert."""
    tr, te, _ = train_test(spark, sf)
    return P.prevalence_ratio(tr, te)


_INNER = _FOLDS + """,
icut AS (SELECT quantile_cont(step_raw, 0.85) AS c FROM tr),
itr AS (SELECT tr.* FROM tr, icut WHERE step_raw <= icut.c),
iva AS (SELECT tr.* FROM tr, icut WHERE step_raw > icut.c)"""


@query("inner_split", txn_sql("""
SELECT split, rows, fraud_rows, round(rate * 100.0, 6) AS fraud_rate_pct FROM (
  SELECT 'inner_train_85_raw' AS split, count(*) AS rows, CAST(sum(isFraud) AS BIGINT) AS fraud_rows, avg(isFraud) AS rate FROM itr
  UNION ALL SELECT 'inner_train_85_sample_used_for_tuning', count(*), CAST(sum(isFraud) AS BIGINT), avg(isFraud) FROM itr
  UNION ALL SELECT 'validation_15_untouched', count(*), CAST(sum(isFraud) AS BIGINT), avg(isFraud) FROM iva)""", ctes=_INNER))
def inner_split(spark, sf):
    """T2 + T4: inner 85/15 split by step (stratified fallback) and the 250k stratified cap."""
    tr, _, _ = train_test(spark, sf)
    itr, iva, _method = P.inner_split(tr)
    capped = P.stratified_cap(itr, 250_000)
    return P.fold_summary({"inner_train_85_raw": itr, "inner_train_85_sample_used_for_tuning": capped,
                           "validation_15_untouched": iva})


@query("stratified_split", txn_sql(f"""
SELECT CASE WHEN pos < round(n * 0.25) THEN 'test' ELSE 'train' END AS split, isFraud, count(*) AS rows
FROM (SELECT isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY {_md5_key(42)}, txn_id) - 1 AS pos,
             count(*) OVER (PARTITION BY isFraud) AS n FROM fm)
GROUP BY 1, 2""", ctes=matrix_cte()))
def stratified_split(spark, sf):
    """Stratified 75/25 split in a repeatable hash order (rows per fold and class)."""
    tr, te = P.stratified_split(matrix(spark, sf), 0.25, 42)
    return (tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))
            .groupBy("split", "isFraud").agg(F.count(F.lit(1)).alias("rows")))


@query("ref_current_split", txn_sql("""
SELECT CASE WHEN step_raw <= 354 THEN 'reference' ELSE 'current' END AS side, count(*) AS rows,
       CAST(sum(isFraud) AS BIGINT) AS fraud_rows FROM fm GROUP BY 1""", ctes=matrix_cte()))
def ref_current_split(spark, sf):
    """T5: reference (step <= 354) vs current split; fails if a side is empty."""
    ref, cur = P.reference_current(matrix(spark, sf), S.REFERENCE_MAX_STEP, "step_raw")
    return P.fold_summary({"reference": ref, "current": cur}, ).select(
        F.col("split").alias("side"), "rows", "fraud_rows")


def _robust_stats_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, quantile_cont({c}, 0.5) AS center, "
        f"CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 "
        f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS scale FROM tr" for c in CONT)
    return f"rstats AS ({parts})"


@query("robust_stats", txn_sql("SELECT feature, round(center, 6) AS center, round(scale, 6) AS scale FROM rstats",
                               ctes=_FOLDS + ",\n" + _robust_stats_sql()))
def robust_stats(spark, sf):
    """Median / IQR scaler statistics fitted on the train fold only."""
    tr, _, _ = train_test(spark, sf)
    return round_doubles(P.robust_stats(tr, CONT))


def _scaled_select(src: str) -> str:
    cols = []
    for c in FEATS:
        if c in CONT:
            cols.append(f"({c} - (SELECT center FROM rstats WHERE feature = '{c}')) / (SELECT scale FROM rstats WHERE feature = '{c}') AS {c}")
        else:
            cols.append(c)
    return f"SELECT txn_id, {', '.join(cols)}, isFraud, amount_raw, step_raw FROM {src}"


@query("robust_scaled", txn_sql(
    "SELECT txn_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in CONT) + " FROM (" + _scaled_select("fm") + ")",
    ctes=_FOLDS + ",\n" + _robust_stats_sql()))
def robust_scaled(spark, sf):
    """Train-fold statistics applied to every universe row."""
    m = matrix(spark, sf)
    tr, _, _ = P.temporal_split(m, 0.8, "step_raw")
    stats = P.stats_dict(P.robust_stats(tr, CONT), "center", "scale")
    return round_doubles(P.apply_scaler(m, stats).select("txn_id", *CONT))


OLD_NUMERIC = ["amount", "log_amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
               "errorBalanceOrig", "errorBalanceDest", "amount_to_oldbalanceOrg", "account_age_days",
               "failed_payment_attempts", "ip_billing_distance_km", "hour_of_day", "orig_prior_txn_count",
               "orig_time_since_last", "dest_prior_txn_count", "dest_prior_amount_sum"]


def _standard_sql() -> str:
    from .features import _older_sql

    ctes = _older_sql() + f""",
ou AS (SELECT * FROM older WHERE type IN ('TRANSFER','CASH_OUT')),
otr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY {_md5_key(42)}, txn_id) - 1 AS pos,
             count(*) OVER (PARTITION BY isFraud) AS n FROM ou) WHERE pos >= round(n * 0.25))"""
    body = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END, 6) AS std FROM otr"
        for c in OLD_NUMERIC)
    return txn_sql(body, ctes=ctes)


@query("standard_scaled", _standard_sql())
def standard_scaled(spark, sf):
    """T8 (older variant): mean / population-std statistics on the stratified 75 % train side."""
    o = older_variant(spark, sf).where(F.col("type").isin(S.FRAUD_TYPES))
    tr, _ = P.stratified_split(o, 0.25, 42)
    return round_doubles(P.standard_stats(tr, OLD_NUMERIC))


@query("class_weights", txn_sql("""
SELECT isFraud, count(*) AS n_c, round((SELECT count(*) FROM tr) / (2.0 * count(*)), 4) AS weight FROM tr GROUP BY isFraud""",
                                ctes=_FOLDS))
def class_weights(spark, sf):
    """Balanced class weights n / (2 n_c) on the train fold."""
    tr, _, _ = train_test(spark, sf)
    return P.class_weights(tr)


@query("scale_pos_weight", txn_sql("""
SELECT CAST(sum(CASE WHEN isFraud = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg, CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
       round(sum(CASE WHEN isFraud = 0 THEN 1 ELSE 0 END) / greatest(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END), 1), 6) AS scale_pos_weight
FROM itr""", ctes=_INNER))
def scale_pos_weight(spark, sf):
    """Neg / max(pos, 1) on the inner training split."""
    tr, _, _ = train_test(spark, sf)
    itr, _, _ = P.inner_split(tr)
    return P.scale_pos_weight(itr)


def _under_sql(ratio: float) -> str:
    return f"""us AS (
SELECT txn_id, isFraud FROM tr WHERE isFraud = (SELECT CASE WHEN sum(isFraud) <= count(*) - sum(isFraud) THEN 1 ELSE 0 END FROM tr)
UNION ALL
SELECT txn_id, isFraud FROM (
  SELECT txn_id, isFraud, row_number() OVER (ORDER BY {_md5_key(42)}, txn_id) - 1 AS pos FROM tr
  WHERE isFraud <> (SELECT CASE WHEN sum(isFraud) <= count(*) - sum(isFraud) THEN 1 ELSE 0 END FROM tr))
WHERE pos < (SELECT CAST(floor(CAST(least(sum(isFraud), count(*) - sum(isFraud)) AS DOUBLE) / CAST({ratio} AS DOUBLE)) AS BIGINT) FROM tr))"""


@query("undersample", txn_sql("SELECT txn_id, isFraud FROM us", ctes=_FOLDS + ",\n" + _under_sql(1.0)))
def undersample(spark, sf):
    """Random undersampling of the train fold to 1:1 (hash order, repeatable)."""
    tr, _, _ = train_test(spark, sf)
    return P.undersample(tr.select("txn_id", "isFraud", "step_raw"), 1.0).select("txn_id", "isFraud")


@query("imbalance_summary", txn_sql("""
SELECT strategy, train_rows, train_fraud, round(train_fraud / train_rows * 100.0, 3) AS train_fraud_pct FROM (
  SELECT 'original (weights)' AS strategy, count(*) AS train_rows, CAST(sum(isFraud) AS BIGINT) AS train_fraud FROM tr
  UNION ALL SELECT 'undersample', count(*), CAST(sum(isFraud) AS BIGINT) FROM us
  UNION ALL SELECT 'undersample 0.05', count(*), CAST(sum(isFraud) AS BIGINT) FROM us05
  UNION ALL SELECT 'smote', CAST(count(*) + greatest(count(*) - 2 * sum(isFraud), 0) AS BIGINT),
                   CAST(sum(isFraud) + greatest(count(*) - 2 * sum(isFraud), 0) AS BIGINT) FROM tr)""",
    ctes=_FOLDS + ",\n" + _under_sql(1.0) + ",\n" + _under_sql(0.05).replace("us AS (", "us05 AS (", 1)))
def imbalance_summary(spark, sf):
    """Rows / fraud / fraud % of the train fold under the resampling strategies."""
    tr, _, _ = train_test(spark, sf)
    base = tr.select("txn_id", "isFraud", "step_raw")
    scaled = P.apply_scaler(tr, P.stats_dict(P.robust_stats(tr, CONT), "center", "scale"))
    parts = {"original (weights)": base, "undersample": P.undersample(base, 1.0), "undersample 0.05": P.undersample(base, 0.05),
             "smote": smote(scaled, FEATS, ratio=1.0)}
    out = None
    for name, d in parts.items():
        a = d.agg(F.count(F.lit(1)).alias("train_rows"), F.sum("isFraud").cast("long").alias("train_fraud")).select(
            F.lit(name).alias("strategy"), "train_rows", "train_fraud",
            F.round(F.col("train_fraud") / F.col("train_rows") * 100.0, 3).alias("train_fraud_pct"))
        out = a if out is None else out.unionByName(a)
    return out


def _trs_cte() -> str:
    return _FOLDS + ",\n" + _robust_stats_sql() + ",\ntrs AS (" + _scaled_select("tr") + ")"


@query("low_variance", txn_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS idx, round(var_pop(CAST({c} AS DOUBLE)), 6) AS variance, var_pop(CAST({c} AS DOUBLE)) <= 1e-6 AS dropped FROM trs"
    for i, c in enumerate(FEATS)), ctes=_trs_cte()))
def low_variance(spark, sf):
    """Near-zero-variance screen (population variance <= 1e-6) on the scaled train fold."""
    m = matrix(spark, sf)
    tr, _, _ = P.temporal_split(m, 0.8, "step_raw")
    trs = P.apply_scaler(tr, P.stats_dict(P.robust_stats(tr, CONT), "center", "scale"))
    v = P.variance_filter(trs, FEATS)
    return v.select("feature", "idx", F.round("variance", 6).alias("variance"), "dropped")


def _corr_prune_sql() -> str:
    lng = " UNION ALL ".join(f"SELECT txn_id, {i} AS idx, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM tr" for i, c in enumerate(FEATS))
    varsq = " UNION ALL ".join(f"SELECT {i} AS idx, var_pop(CAST({c} AS DOUBLE)) AS var FROM trs" for i, c in enumerate(FEATS))
    ctes = _trs_cte() + f""",
keep AS (SELECT idx FROM ({varsq}) WHERE var > 1e-6),
lng AS (SELECT * FROM ({lng}) WHERE idx IN (SELECT idx FROM keep)),
pc AS (SELECT a.idx AS ia, b.idx AS ib, b.feature AS fb, corr(a.v, b.v) AS r FROM lng a JOIN lng b ON a.txn_id = b.txn_id AND a.idx < b.idx GROUP BY ALL),
firsts AS (SELECT idx, feature FROM lng GROUP BY ALL)"""
    return txn_sql("""
SELECT f.feature, round(m.best, 6) AS max_abs_corr_earlier, coalesce(m.best > 0.95, false) AS redundant
FROM firsts f LEFT JOIN (SELECT ib, max(abs(r)) AS best FROM pc WHERE NOT isnan(r) GROUP BY ib) m ON f.idx = m.ib""", ctes=ctes)


@query("corr_prune", _corr_prune_sql())
def corr_prune(spark, sf):
    """Drop the later column of any |corr| > 0.95 pair among the columns kept by T14."""
    m = matrix(spark, sf)
    tr, _, _ = P.temporal_split(m, 0.8, "step_raw")
    trs = P.apply_scaler(tr, P.stats_dict(P.robust_stats(tr, CONT), "center", "scale"))
    kept = [r["feature"] for r in P.variance_filter(trs, FEATS).where(~F.col("dropped")).orderBy("idx").collect()]
    rows = P.correlation_prune(trs, kept)
    out = spark.createDataFrame(rows, "feature string, max_abs_corr_earlier double, redundant boolean")
    return out.select("feature", F.round("max_abs_corr_earlier", 6).alias("max_abs_corr_earlier"), "redundant")


def _mi_sql() -> str:
    lng = " UNION ALL ".join(f"SELECT txn_id, isFraud, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM tr" for c in FEATS)
    ctes = _FOLDS + f""",
lng AS ({lng}),
rk AS (SELECT feature, isFraud, row_number() OVER (PARTITION BY feature ORDER BY v, txn_id) - 1 AS pos,
              count(*) OVER (PARTITION BY feature) AS n FROM lng WHERE v IS NOT NULL),
bn AS (SELECT feature, isFraud, n, CAST(greatest(CASE WHEN n > 1 THEN (pos * 10 + n - 2) // (n - 1) ELSE 1 END, 1) - 1 AS INTEGER) AS bin FROM rk),
cell AS (SELECT feature, bin, isFraud, count(*) AS c, first(n) AS n FROM bn GROUP BY ALL),
pj AS (SELECT *, c / n AS pj, sum(c) OVER (PARTITION BY feature, bin) / n AS pb, sum(c) OVER (PARTITION BY feature, isFraud) / n AS py FROM cell)"""
    return txn_sql("SELECT feature, round(sum(pj * ln(pj / (pb * py))), 6) AS mutual_info FROM pj GROUP BY feature", ctes=ctes)


@query("mutual_info", _mi_sql())
def mutual_info(spark, sf):
    """T17 (re-aimed): mutual information of rank-decile bins with the label, train fold."""
    tr, _, _ = train_test(spark, sf)
    return P.mutual_information(tr, FEATS)


@query("sample_rows", txn_sql(f"""
SELECT txn_id, type, amount, isFraud FROM (
  SELECT *, row_number() OVER (ORDER BY {_md5_key(42)}, txn_id) - 1 AS pos FROM transactions) WHERE pos < 1000"""))
def sample_rows(spark, sf):
    """A repeatable random sample of exactly 1000 transactions (hash order, seed 42)."""
    t = transactions(spark, sf).select("txn_id", "type", "amount", "isFraud")
    return P.sample_rows(t, 1000, 42)


@query("dashboard_sample", txn_sql(f"""
SELECT side, txn_id, step_raw, isFraud FROM (
  SELECT CASE WHEN step_raw <= 354 THEN 'reference' ELSE 'current' END AS side, txn_id, step_raw, isFraud,
         row_number() OVER (PARTITION BY CASE WHEN step_raw <= 354 THEN 'reference' ELSE 'current' END
                            ORDER BY {_md5_key(42)}, txn_id) - 1 AS pos FROM fm)
WHERE pos < 100000""", ctes=matrix_cte()))
def dashboard_sample(spark, sf):
    """MN10: reference and current sides each capped at 100 000 rows for a dashboard (seeded sample)."""
    m = matrix(spark, sf).select("txn_id", "step_raw", "isFraud")
    side = F.when(F.col("step_raw") <= S.REFERENCE_MAX_STEP, F.lit("reference")).otherwise(F.lit("current"))
    return P.sample_rows(m.withColumn("side", side), 100_000, 42, group_cols=["side"])


@query("stratified_cap", txn_sql(f"""
SELECT txn_id, isFraud FROM (
  SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY {_md5_key(42)}, txn_id) - 1 AS pos,
         count(*) OVER (PARTITION BY isFraud) AS n_c, count(*) OVER () AS n FROM itr)
WHERE n <= 250000 OR pos < round(n_c * (250000.0 / n))""", ctes=_INNER))
def stratified_cap(spark, sf):
    """T4: inner training split capped at 250 000 rows, every class keeping the same fraction (hash order)."""
    tr, _, _ = train_test(spark, sf)
    itr, _, _ = P.inner_split(tr)
    return P.stratified_cap(itr.select("txn_id", "isFraud"), 250_000, 42)
