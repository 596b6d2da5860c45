"""Data-quality and enrichment queries (Q*, J*, E*), with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import one_row
from ..operators import enrich as E
from ..operators import quality as Q
from ..sources.fixture import transactions
from .registry import query, txn_sql

DOUBLES = {"amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "ip_billing_distance_km"}


def enriched(spark, sf):
    """The 23-column enriched table (no id), as the cleaning stage reads it."""
    return transactions(spark, sf).select(*S.ENRICHED_COLUMNS)


def _miss(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))" if c in DOUBLES else f"{c} IS NULL"


@query("column_profile", txn_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {_miss(c)} THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, "
    f"count(DISTINCT {c}) AS n_unique FROM transactions" for c in S.ENRICHED_COLUMNS)))
def column_profile(spark, sf):
    """Q2: per-column missing and distinct counts."""
    return Q.column_profile(enriched(spark, sf))


@query("null_counts", txn_sql(
    "SELECT column_name, n_missing FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {_miss(c)} THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM transactions"
        for c in S.ENRICHED_COLUMNS) + ") UNION ALL SELECT 'ALL', CAST(sum(" + " + ".join(
        f"CASE WHEN {_miss(c)} THEN 1 ELSE 0 END" for c in S.ENRICHED_COLUMNS) + ") AS BIGINT) FROM transactions"))
def null_counts(spark, sf):
    """Q3: null count per column and total missing cells."""
    return Q.null_counts(enriched(spark, sf))


_ENR = ", ".join(S.ENRICHED_COLUMNS)


@query("duplicate_count", txn_sql(f"""
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS distinct_rows, CAST(sum(c) - count(*) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS c FROM transactions GROUP BY {_ENR})"""))
def duplicate_count(spark, sf):
    """Q4: duplicate rows (copies beyond the first)."""
    return Q.duplicate_count(enriched(spark, sf))


@query("dedup", txn_sql(f"SELECT DISTINCT {_ENR} FROM transactions"))
def dedup(spark, sf):
    """Q5: drop exact duplicate rows."""
    return Q.dedup(enriched(spark, sf))


def _norm_sql(c: str) -> str:
    return f"coalesce(upper(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), 'NAN')"


@query("category_normalise", txn_sql(
    "SELECT txn_id, " + ", ".join(f"{_norm_sql(c)} AS {c}" for c in Q.CATEGORICAL) + " FROM transactions"))
def category_normalise(spark, sf):
    """Q6: strip + upper of type and country columns."""
    return Q.normalise_categoricals(transactions(spark, sf).select("txn_id", *Q.CATEGORICAL))


def _vocab_sql() -> str:
    allowed = " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{v}' AS value" for c, vs in Q.VOCAB.items() for v in vs)
    long = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM transactions" for c in Q.VOCAB)
    return txn_sql(f"""
SELECT column_name, value, count(*) AS n_rows FROM ({long}) l
WHERE NOT EXISTS (SELECT 1 FROM ({allowed}) a WHERE a.column_name = l.column_name AND a.value = l.value)
GROUP BY column_name, value""")


@query("vocab_violations", _vocab_sql())
def vocab_violations(spark, sf):
    """Q7: out-of-vocabulary categorical values (left-anti join on the allowed set)."""
    return Q.vocab_violations(Q.normalise_categoricals(enriched(spark, sf)))


def _range_sql() -> str:
    parts = []
    for c, lo, hi in Q.RANGE_CHECKS:
        above = f"CAST(sum(CASE WHEN CAST({c} AS DOUBLE) > {hi} THEN 1 ELSE 0 END) AS BIGINT)" if hi is not None else "CAST(0 AS BIGINT)"
        hi_s = f"CAST({hi} AS DOUBLE)" if hi is not None else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST({lo} AS DOUBLE) AS min_allowed, {hi_s} AS max_allowed, "
            f"CAST(sum(CASE WHEN CAST({c} AS DOUBLE) < {lo} THEN 1 ELSE 0 END) AS BIGINT) AS n_below, {above} AS n_above, "
            f"min(CAST({c} AS DOUBLE)) AS observed_min, max(CAST({c} AS DOUBLE)) AS observed_max FROM transactions")
    return txn_sql(" UNION ALL ".join(parts))


@query("range_report", _range_sql())
def range_report(spark, sf):
    """Q8/Q10: two-sided range checks (distance soft ceiling counted, kept)."""
    return Q.range_report(enriched(spark, sf))


@query("binary_report", txn_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(0 AS DOUBLE) AS min_allowed, CAST(1 AS DOUBLE) AS max_allowed, "
    f"CAST(sum(CASE WHEN {c} IS NULL OR {c} NOT IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) AS n_below, CAST(0 AS BIGINT) AS n_above, "
    f"min(CAST({c} AS DOUBLE)) AS observed_min, max(CAST({c} AS DOUBLE)) AS observed_max FROM transactions"
    for c in Q.BINARY_COLUMNS)))
def binary_report(spark, sf):
    """Q9: binary-domain checks."""
    return Q.binary_report(enriched(spark, sf))


@query("quality_flags", txn_sql("""
SELECT txn_id, CAST(amount = 0 AS INTEGER) AS amount_zero_flag, CAST(amount < 0 AS INTEGER) AS invalid_amount_flag,
       CAST(ip_billing_distance_km < 0 AS INTEGER) AS invalid_ip_distance_flag, CAST(account_age_days < 1 AS INTEGER) AS invalid_account_age_flag,
       CAST(starts_with(nameDest, 'M') AS INTEGER) AS dest_is_merchant,
       CAST(oldbalanceDest = 0 AND newbalanceDest = 0 AND amount > 0 AS INTEGER) AS dest_balance_unknown,
       CAST(oldbalanceOrg = 0 AND newbalanceOrig = 0 AND amount > 0 AS INTEGER) AS orig_balance_unknown,
       CAST(amount = 0 AS INTEGER) AS amount_is_zero
FROM transactions"""))
def quality_flags(spark, sf):
    """Q13-Q16: row-level quality flags."""
    t = transactions(spark, sf)
    flagged = Q.quality_flags(t)
    return flagged.select("txn_id", *[c for c in flagged.columns if c not in t.columns])


_CLEAN_KEPT = "step IS NOT NULL AND type IS NOT NULL AND amount IS NOT NULL AND isFraud IS NOT NULL AND amount >= 0 AND step BETWEEN 1 AND 743"


@query("clean_report", txn_sql(f"""
SELECT (SELECT count(*) FROM transactions) AS rows_in,
       (SELECT count(*) FROM transactions) - count(*) AS duplicates_removed,
       CAST(sum(CASE WHEN NOT (step IS NOT NULL AND type IS NOT NULL AND amount IS NOT NULL AND isFraud IS NOT NULL) THEN 1 ELSE 0 END) AS BIGINT) AS missing_core_removed,
       CAST(sum(CASE WHEN step IS NOT NULL AND type IS NOT NULL AND amount IS NOT NULL AND isFraud IS NOT NULL AND amount < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_amount_removed,
       CAST(sum(CASE WHEN step IS NOT NULL AND type IS NOT NULL AND amount IS NOT NULL AND isFraud IS NOT NULL AND amount >= 0 AND amount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS amount_is_zero_flagged,
       CAST(sum(CASE WHEN step IS NOT NULL AND type IS NOT NULL AND amount IS NOT NULL AND isFraud IS NOT NULL AND amount >= 0 AND NOT (step BETWEEN 1 AND 743) THEN 1 ELSE 0 END) AS BIGINT) AS invalid_step_removed,
       CAST(sum(CASE WHEN {_CLEAN_KEPT} AND oldbalanceDest = 0 AND newbalanceDest = 0 AND amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS dest_balance_unknown,
       CAST(sum(CASE WHEN {_CLEAN_KEPT} AND oldbalanceOrg = 0 AND newbalanceOrig = 0 AND amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS orig_balance_unknown,
       CAST(sum(CASE WHEN {_CLEAN_KEPT} AND type NOT IN ('TRANSFER','CASH_OUT') THEN 1 ELSE 0 END) AS BIGINT) AS rows_dropped_by_type_scope,
       CAST(sum(CASE WHEN {_CLEAN_KEPT} AND type IN ('TRANSFER','CASH_OUT') THEN 1 ELSE 0 END) AS BIGINT) AS rows_out,
       CAST(sum(CASE WHEN {_CLEAN_KEPT} AND type IN ('TRANSFER','CASH_OUT') THEN isFraud END) AS BIGINT) AS fraud_out,
       round(avg(CASE WHEN {_CLEAN_KEPT} AND type IN ('TRANSFER','CASH_OUT') THEN isFraud END) * 100.0, 4) AS fraud_rate_out_pct
FROM (SELECT DISTINCT {_ENR} FROM transactions)"""))
def clean_report(spark, sf):
    """Q17-Q21: one-row report of the configurable cleaning step."""
    return Q.clean(enriched(spark, sf))[1]


_CLEANED_COLS = [c for c in S.ENRICHED_COLUMNS if c != "isFlaggedFraud"]


@query("cleaned", txn_sql(f"""
SELECT {", ".join(_CLEANED_COLS)},
       CAST(oldbalanceDest = 0 AND newbalanceDest = 0 AND amount > 0 AS INTEGER) AS dest_balance_unknown,
       CAST(oldbalanceOrg = 0 AND newbalanceOrig = 0 AND amount > 0 AS INTEGER) AS orig_balance_unknown,
       CAST(amount = 0 AS INTEGER) AS amount_is_zero
FROM (SELECT DISTINCT {_ENR} FROM transactions) WHERE {_CLEAN_KEPT} AND type IN ('TRANSFER','CASH_OUT')"""))
def cleaned(spark, sf):
    """Q21: cleaned rows (scoped to the universe, leakage column dropped)."""
    return Q.clean(enriched(spark, sf))[0]


def _summary_sql(src: str) -> str:
    miss = " + ".join(f"CASE WHEN {_miss(c)} THEN c ELSE 0 END" for c in S.ENRICHED_COLUMNS)
    return f"""SELECT CAST(sum(c) AS DOUBLE) AS rows, CAST({len(S.ENRICHED_COLUMNS)} AS DOUBLE) AS columns,
       CAST(sum({miss}) AS DOUBLE) AS missing_cells, CAST(sum(c) - count(*) AS DOUBLE) AS duplicate_rows,
       CAST(sum(isFraud * c) AS DOUBLE) AS fraud_count, round(sum(isFraud * c) / sum(c) * 100.0, 4) AS fraud_rate_pct
FROM (SELECT {_ENR}, count(*) AS c FROM ({src}) GROUP BY ALL)"""


def _before_after_sql() -> str:
    norm = ", ".join(
        f"{_norm_sql(c)} AS {c}" if c in Q.CATEGORICAL else c for c in S.ENRICHED_COLUMNS
    )
    after_src = f"SELECT {norm} FROM (SELECT DISTINCT {_ENR} FROM transactions WHERE amount >= 0)"
    metrics = ["rows", "columns", "missing_cells", "duplicate_rows", "fraud_count", "fraud_rate_pct"]

    def long(alias: str, src: str) -> str:
        return " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS {alias} FROM ({_summary_sql(src)})" for m in metrics)

    return txn_sql(f"""
SELECT b.metric, b.before, a.after, NOT (b.before IS NOT DISTINCT FROM a.after) AS changed
FROM ({long('before', 'SELECT * FROM transactions')}) b JOIN ({long('after', after_src)}) a USING (metric)""")


@query("before_after", _before_after_sql())
def before_after(spark, sf):
    """Q22: before/after summary of cleaning (dedup, then normalise, then amount filter)."""
    before = enriched(spark, sf)
    after = Q.amount_filter(Q.normalise_categoricals(Q.dedup(before)))
    return Q.before_after(before, after)


@query("reconciliation", txn_sql("""
SELECT 'orig not reconciling' AS metric, round(avg(CASE WHEN abs((oldbalanceOrg - amount - newbalanceOrig) - 0.0) <= 1e-8 + 1e-5 * abs(0.0) THEN 0 ELSE 1 END) * 100.0, 1) AS pct_of_rows FROM transactions
UNION ALL SELECT 'dest not reconciling', round(avg(CASE WHEN abs((oldbalanceDest + amount - newbalanceDest) - 0.0) <= 1e-8 + 1e-5 * abs(0.0) THEN 0 ELSE 1 END) * 100.0, 1) FROM transactions
UNION ALL SELECT 'dest balances both zero (masked)', round(avg(CAST(coalesce(oldbalanceDest = 0 AND newbalanceDest = 0, false) AS INTEGER)) * 100.0, 1) FROM transactions"""))
def reconciliation(spark, sf):
    """Q23: ledger reconciliation summary."""
    return Q.reconciliation(enriched(spark, sf))


@query("masked_by_dest", txn_sql("""
SELECT CASE WHEN starts_with(nameDest, 'M') THEN 'merchant (M)' ELSE 'customer (C)' END AS dest_kind,
       round(avg(CAST(oldbalanceDest = 0 AND newbalanceDest = 0 AS INTEGER)) * 100.0, 1) AS masked_pct
FROM transactions GROUP BY 1"""))
def masked_by_dest(spark, sf):
    """Q24: masked-destination rate by destination kind."""
    return Q.masked_by_dest(enriched(spark, sf))


_BASE = ", ".join(["txn_id"] + S.BASE_COLUMNS)
_PROFILE_SQL = """profiles AS (SELECT nameOrig, max(isFraud) AS account_ever_fraud, min(account_age_days) AS account_age_days,
       min(home_billing_country) AS home_billing_country, min(home_device_id) AS home_device_id FROM transactions GROUP BY nameOrig)"""


@query("profile_join", txn_sql(f"SELECT t.{_BASE.replace(', ', ', t.')}, p.account_ever_fraud, p.account_age_days, p.home_billing_country, p.home_device_id "
                               "FROM transactions t LEFT JOIN profiles p USING (nameOrig)", ctes=_PROFILE_SQL))
def profile_join(spark, sf):
    """E1 + J1: account roll-up joined back onto every base transaction."""
    t = transactions(spark, sf)
    base = t.select("txn_id", *S.BASE_COLUMNS)
    return E.join_profiles(base, E.account_profiles(t))


@query("merge_integrity", txn_sql(f"""
SELECT 4 AS added_columns, (SELECT count(*) FROM transactions) AS base_rows, count(*) AS enriched_rows,
       count(*) = (SELECT count(*) FROM transactions) AS row_count_preserved,
       CAST(sum(CASE WHEN p.account_ever_fraud IS NULL THEN 1 ELSE 0 END + CASE WHEN p.account_age_days IS NULL THEN 1 ELSE 0 END
              + CASE WHEN p.home_billing_country IS NULL THEN 1 ELSE 0 END + CASE WHEN p.home_device_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS new_null_cells
FROM transactions t LEFT JOIN profiles p USING (nameOrig)""", ctes=_PROFILE_SQL))
def merge_integrity(spark, sf):
    """Q25: added columns, row count preserved, nulls introduced by the join."""
    t = transactions(spark, sf)
    base = t.select("txn_id", *S.BASE_COLUMNS)
    enr = E.join_profiles(base, E.account_profiles(t))
    added = [c for c in enr.columns if c not in base.columns]
    base_rows = base.agg(F.count(F.lit(1)).alias("base_rows"))
    stats = enr.agg(
        F.count(F.lit(1)).alias("enriched_rows"),
        sum((F.sum(F.col(c).isNull().cast("int")) for c in added), F.lit(0)).cast("long").alias("new_null_cells"),
    )
    return one_row(base_rows, stats).select(
        F.lit(len(added)).alias("added_columns"), "base_rows", "enriched_rows",
        (F.col("enriched_rows") == F.col("base_rows")).alias("row_count_preserved"), "new_null_cells",
    )


@query("key_stability", txn_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE k > 1) AS n_unstable_keys FROM "
    f"(SELECT nameOrig, count(DISTINCT {c}) AS k FROM transactions GROUP BY nameOrig)" for c in E.ACCOUNT_FIELDS)))
def key_stability(spark, sf):
    """Q26: accounts whose account-level field takes more than one value."""
    t = transactions(spark, sf)
    per = t.groupBy("nameOrig").agg(*[(F.min(c) != F.max(c)).alias(c) for c in E.ACCOUNT_FIELDS])
    row = per.agg(*[F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in E.ACCOUNT_FIELDS])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_unstable_keys")) for c in E.ACCOUNT_FIELDS
    ])).alias("s")).select("s.*")


@query("fingerprint", txn_sql("""
SELECT txn_id, 'fp_' || substr(md5(device_id), 1, 10) AS fingerprint,
       CASE WHEN is_new_device = 1 THEN device_id ELSE home_device_id END AS effective_device,
       printf('dev_%08x', CAST(('0x' || substr(md5('home:' || nameOrig), 1, 8)) AS BIGINT)) AS home_device_formatted,
       CAST(step % 24 AS INTEGER) AS hour_of_day, CAST(step % 24 BETWEEN 0 AND 5 AS INTEGER) AS is_night,
       round(CASE WHEN ip_country = home_billing_country THEN ip_billing_distance_km ELSE ip_billing_distance_km - 300.0 + 300.0 END, 1) AS distance_1dp
FROM transactions"""))
def fingerprint(spark, sf):
    """Derived context columns (hour/night, md5 fingerprint, effective device, hex id, distance regime)."""
    t = transactions(spark, sf)
    hn = E.hour_and_night("step")
    dev_int = F.conv(F.substring(F.md5(F.concat(F.lit("home:"), F.col("nameOrig"))), 1, 8), 16, 10).cast("long")
    return t.select(
        "txn_id",
        E.fingerprint("device_id").alias("fingerprint"),
        E.effective_device("is_new_device", "device_id", "home_device_id").alias("effective_device"),
        E.device_id_of(dev_int).alias("home_device_formatted"),
        hn["hour_of_day"].alias("hour_of_day"), hn["is_night"].alias("is_night"),
        E.distance_regime("ip_country", "home_billing_country", F.col("ip_billing_distance_km"),
                          F.col("ip_billing_distance_km") - F.lit(300.0)).alias("distance_1dp"),
    )
