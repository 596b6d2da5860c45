"""Data-quality operators (Q1-Q31): gates, profiles, validity reports, cleaning.

Reports come from one conditional aggregate over the input (one scan, partial
aggregation on the map side), never from one action per check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.exprs import count_if, flag, isclose, number, pct, strip_upper


class SchemaError(ValueError):
    pass


def require_columns(df: DataFrame, required: list[str] = S.ENRICHED_COLUMNS) -> DataFrame:
    """Q1: fail before any action when a required column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"Missing required columns: {missing}")
    return df


def same_columns(before: DataFrame, after: DataFrame) -> bool:
    """Q27: column-list invariance check."""
    return list(before.columns) == list(after.columns)


def _is_missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def column_profile(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Q2: per column n_missing and n_unique (NULL/NaN excluded).

    Each row gives one slim (column, value hash) pair a column; pairs are counted
    with map-side partials in one shuffle, so no row is copied whole for each column and a value that
    fills a column is no hot group. Two independent hashes (96 bits) stand for a value.
    `approx=True` uses HyperLogLog (`approx_count_distinct`) instead of exact distinct counts.
    """
    cols = cols or df.columns
    names = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name")) for i, c in enumerate(cols)])).alias("x")
    if approx:
        row = df.agg(*[F.struct(count_if(_is_missing(df, c)).alias("m"), F.approx_count_distinct(F.when(~_is_missing(df, c), F.col(c))).alias("u")).alias(c) for c in cols])
        s = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("d")) for c in cols])).alias("s")
        return row.select(s).select("s.column_name", F.col("s.d.m").alias("n_missing"), F.col("s.d.u").alias("n_unique"))

    def value(c: str) -> Column:
        # 0.0 and -0.0 are one value
        return F.col(c) + F.lit(0.0) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)

    pair = lambda i, c: F.struct(
        F.lit(i).alias("i"), F.when(~_is_missing(df, c), F.xxhash64(value(c))).alias("h"), F.when(~_is_missing(df, c), F.hash(value(c))).alias("g"))
    pairs = df.select(F.explode(F.array(*[pair(i, c) for i, c in enumerate(cols)])).alias("p")).select("p.*")
    values = pairs.groupBy("i", "h", "g").agg(F.count(F.lit(1)).alias("n"))
    per = values.groupBy("i").agg(F.sum(F.when(F.col("h").isNull(), F.col("n")).otherwise(0)).alias("n_missing"), F.count("h").alias("n_unique"))
    # every column once, also of an empty table
    every = df.sparkSession.range(1).select(names).select("x.*")
    return every.join(per, "i", "left").select("column_name", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_missing", "n_unique")])


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Q3: missing cells per column plus an `ALL` row with the total."""
    cols = cols or df.columns
    row = df.agg(*[count_if(_is_missing(df, c)).alias(c) for c in cols])
    s = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_missing")) for c in cols]))
    per = row.select(s.alias("s")).select("s.column_name", "s.n_missing")
    total = row.select(F.lit("ALL").alias("column_name"), sum((F.col(f"`{c}`") for c in cols), F.lit(0)).cast("long").alias("n_missing"))
    return per.unionByName(total)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Q4: rows, distinct rows and copies beyond the first, in one shuffle."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(
        F.sum("__c").cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("duplicate_rows", F.col("n_rows") - F.col("distinct_rows"))


def dedup(df: DataFrame) -> DataFrame:
    """Q5: drop exact duplicate rows (NULLs compare equal, like pandas)."""
    return df.dropDuplicates()


CATEGORICAL = ["type", "home_billing_country", "ip_country"]


def normalise_categoricals(df: DataFrame, cols: list[str] = CATEGORICAL) -> DataFrame:
    """Q6: strip + upper; a missing value becomes the text 'NAN' (fails vocab checks)."""
    return df.withColumns({c: F.coalesce(strip_upper(c), F.lit("NAN")) for c in cols if c in df.columns})


VOCAB = {"type": S.ALL_TYPES, "home_billing_country": S.COUNTRIES, "ip_country": S.COUNTRIES}


def vocab_violations(df: DataFrame, vocab: dict[str, list[str]] = VOCAB) -> DataFrame:
    """Distinct values outside the allowed set, with their row counts.

    Set difference as a left-anti join; the allowed side is a fixed list of at
    most ten values, so it is broadcast.
    """
    spark = df.sparkSession
    allowed = spark.createDataFrame(
        [(c, v) for c, vs in vocab.items() for v in vs], "column_name string, value string"
    )
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in vocab
    ])).alias("s")).select("s.column_name", "s.value")
    counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(F.broadcast(allowed), ["column_name", "value"], "left_anti")


# fixed values: documented valid ranges (None = unbounded)
RANGE_CHECKS = [
    ("step", 1.0, 743.0),
    ("hour_of_day", 0.0, 23.0),
    ("account_age_days", 1.0, 3650.0),
    ("failed_payment_attempts", 0.0, 12.0),
    ("ip_billing_distance_km", 0.0, 23000.0),
    ("amount", 0.0, None),
]
BINARY_COLUMNS = ["isFraud", "isFlaggedFraud", "is_new_device", "shipping_billing_mismatch", "is_night"]


def range_report(df: DataFrame, checks=RANGE_CHECKS) -> DataFrame:
    """Q8/Q10: n_below, n_above, observed min/max per numeric column, one pass."""
    aggs = []
    for c, lo, hi in checks:
        x = number(c)
        aggs.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(lo).cast("double").alias("min_allowed"),
            F.lit(hi).cast("double").alias("max_allowed"),
            count_if(x < F.lit(lo)).alias("n_below"),
            (count_if(x > F.lit(hi)) if hi is not None else F.lit(0).cast("long")).alias("n_above"),
            F.min(x).alias("observed_min"), F.max(x).alias("observed_max"),
        ).alias(c))
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[F.col(c) for c, _, _ in checks])).alias("s")).select("s.*")


def binary_report(df: DataFrame, cols: list[str] = BINARY_COLUMNS) -> DataFrame:
    """Q9: binary-domain check; NULL or a value outside {0,1} counts in n_below."""
    aggs = [F.struct(
        F.lit(c).alias("column_name"), F.lit(0.0).alias("min_allowed"), F.lit(1.0).alias("max_allowed"),
        count_if(F.col(c).isNull() | ~F.col(c).isin(0, 1)).alias("n_below"), F.lit(0).cast("long").alias("n_above"),
        F.min(F.col(c).cast("double")).alias("observed_min"), F.max(F.col(c).cast("double")).alias("observed_max"),
    ).alias(c) for c in cols]
    return df.agg(*aggs).select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select("s.*")


def amount_filter(df: DataFrame) -> DataFrame:
    """Q11: drop negative (and missing) amounts; zero amounts are kept."""
    # NaN passes `>= 0` in Spark; the plain comparison still reaches the scan
    return df.where((F.col("amount") >= 0) & ~F.isnan(F.col("amount").cast("double")))


def coerce_numeric(c: str | Column, to: str = "double") -> Column:
    """Q12: numeric coercion, unparseable -> NULL (never an error)."""
    return F.expr(f"try_cast({c} AS {to})") if isinstance(c, str) else c.try_cast(to)


def quality_flags(df: DataFrame) -> DataFrame:
    """Q13-Q16: row-level quality flags and Q14 merchant flag."""
    amt = number("amount")
    return df.withColumns({
        "amount_zero_flag": flag(amt == 0),
        "invalid_amount_flag": flag(amt < 0),
        "invalid_ip_distance_flag": flag(F.col("ip_billing_distance_km") < 0),
        "invalid_account_age_flag": flag(F.col("account_age_days") < 1),
        "dest_is_merchant": flag(F.col("nameDest").startswith("M")),
        "dest_balance_unknown": flag((F.col("oldbalanceDest") == 0) & (F.col("newbalanceDest") == 0) & (amt > 0)),
        "orig_balance_unknown": flag((F.col("oldbalanceOrg") == 0) & (F.col("newbalanceOrig") == 0) & (amt > 0)),
        "amount_is_zero": flag(amt == 0),
    })


CORE_FIELDS = ["step", "type", "amount", "isFraud"]


def clean(df: DataFrame, scope_types: bool = True, drop_leakage: bool = True, leakage: tuple[str, ...] = ("isFlaggedFraud",),
          scratch: tuple[str, ...] = ("amount_decile", "log_amount")) -> tuple[DataFrame, DataFrame]:
    """Q21: configurable cleaning -> (cleaned rows, one-row report).

    Steps: dedup (Q5), drop rows missing a core field (Q17), drop negative
    amounts (Q11), flag zero amounts (Q16), step range 1..743 (Q18), balance
    flags (Q15), type scope (Q19), drop leakage/scratch columns (Q20). The
    report is one conditional aggregate over the deduplicated input, so the
    counts per step equal the sequential definition without one action each.
    """
    core_ok = F.lit(True)
    for c in CORE_FIELDS:
        core_ok = core_ok & ~_is_missing(df, c)
    amt = number("amount")
    amt_ok = amt >= 0
    step_ok = F.col("step").between(S.MIN_STEP, S.MAX_STEP)
    in_scope = F.col("type").isin(S.FRAUD_TYPES)
    # core_ok rules out missing values, so these conditions are never NULL where they count
    kept = core_ok & amt_ok & step_ok
    out = quality_flags(amount_filter(dedup(df)).where(kept))
    if scope_types:
        out = out.where(in_scope)
    drop = [c for c in (leakage if drop_leakage else ()) + scratch if c in out.columns]
    out = out.drop(*drop)
    # optional quality-flag columns not in the sequential definition are dropped
    out = out.drop("amount_zero_flag", "invalid_amount_flag", "invalid_ip_distance_flag", "invalid_account_age_flag", "dest_is_merchant")
    # one shuffle: distinct rows with their copy counts; every report figure is one aggregate over them
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    scoped = kept & (in_scope if scope_types else F.lit(True))
    report = g.agg(
        F.sum("__copies").cast("long").alias("rows_in"),
        (F.sum("__copies") - F.count(F.lit(1))).cast("long").alias("duplicates_removed"),
        count_if(~core_ok).alias("missing_core_removed"),
        count_if(core_ok & (amt < 0)).alias("negative_amount_removed"),
        count_if(core_ok & amt_ok & (amt == 0)).alias("amount_is_zero_flagged"),
        count_if(core_ok & amt_ok & ~step_ok).alias("invalid_step_removed"),
        count_if(kept & (F.col("oldbalanceDest") == 0) & (F.col("newbalanceDest") == 0) & (amt > 0)).alias("dest_balance_unknown"),
        count_if(kept & (F.col("oldbalanceOrg") == 0) & (F.col("newbalanceOrig") == 0) & (amt > 0)).alias("orig_balance_unknown"),
        (count_if(kept & ~in_scope) if scope_types else F.lit(0).cast("long")).alias("rows_dropped_by_type_scope"),
        count_if(scoped).alias("rows_out"),
        F.sum(F.when(scoped, F.col("isFraud"))).cast("long").alias("fraud_out"),
        F.round(pct(F.avg(F.when(scoped, F.col("isFraud")))), 4).alias("fraud_rate_out_pct"),
    )
    return out, report


def table_summary(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Q22 half: rows, columns, missing cells, duplicate rows, fraud count and rate, one row."""
    ncols = len(df.columns)
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    # missing cells and fraud are re-aggregated from the grouped rows, so one shuffle serves all
    miss_g = sum((F.when(_is_missing(df, c), F.col("__c")).otherwise(F.lit(0)) for c in df.columns), F.lit(0))
    return g.agg(
        F.sum("__c").cast("long").alias("rows"),
        F.lit(ncols).cast("long").alias("columns"),
        F.sum(miss_g).cast("long").alias("missing_cells"),
        (F.sum("__c") - F.count(F.lit(1))).cast("long").alias("duplicate_rows"),
        F.sum(F.col(label) * F.col("__c")).cast("long").alias("fraud_count"),
        F.round(pct(F.sum(F.col(label) * F.col("__c")) / F.sum("__c")), 4).alias("fraud_rate_pct"),
    )


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Q22: metric, before, after, changed (NULL-safe comparison)."""
    metrics = ["rows", "columns", "missing_cells", "duplicate_rows", "fraud_count", "fraud_rate_pct"]

    def longify(t: DataFrame, name: str) -> DataFrame:
        return t.select(F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(name)) for m in metrics
        ])).alias("s")).select("s.metric", f"s.{name}")

    b, a = longify(table_summary(before), "before"), longify(table_summary(after), "after")
    return b.join(a, "metric").withColumn("changed", ~F.col("before").eqNullSafe(F.col("after")))


def reconciliation(df: DataFrame) -> DataFrame:
    """Q23: % rows whose origin / destination ledger does not reconcile; % masked dest."""
    orig_err = F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig")
    dest_err = F.col("oldbalanceDest") + F.col("amount") - F.col("newbalanceDest")
    masked = (F.col("oldbalanceDest") == 0) & (F.col("newbalanceDest") == 0)
    not_ok = lambda e: F.when(isclose(e, 0.0), F.lit(0)).otherwise(F.lit(1))
    row = df.agg(
        F.round(pct(F.avg(not_ok(orig_err))), 1).alias("a"),
        F.round(pct(F.avg(not_ok(dest_err))), 1).alias("b"),
        F.round(pct(F.avg(F.coalesce(masked, F.lit(False)).cast("int"))), 1).alias("c"),
    )
    return row.select(F.explode(F.array(
        F.struct(F.lit("orig not reconciling").alias("metric"), F.col("a").alias("pct_of_rows")),
        F.struct(F.lit("dest not reconciling").alias("metric"), F.col("b").alias("pct_of_rows")),
        F.struct(F.lit("dest balances both zero (masked)").alias("metric"), F.col("c").alias("pct_of_rows")),
    )).alias("s")).select("s.*")


def masked_by_dest(df: DataFrame) -> DataFrame:
    """Q24: masked destination-balance rate by destination kind."""
    masked = flag((F.col("oldbalanceDest") == 0) & (F.col("newbalanceDest") == 0))
    kind = F.when(F.col("nameDest").startswith("M"), F.lit("merchant (M)")).otherwise(F.lit("customer (C)"))
    return df.groupBy(kind.alias("dest_kind")).agg(F.round(pct(F.avg(masked)), 1).alias("masked_pct"))


def contract_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q29/Q30: split scoring requests into valid rows and rejected rows with reasons.

    Contract: known type and countries, amount > 0, age 0..3650, attempts
    0..12, distance >= 0, step >= 1 (if given), hour 0..23 (if given),
    balances >= 0 (if given), prior count >= 0 (if given).
    """
    def opt(c: str) -> Column:
        return F.col(c) if c in df.columns else F.lit(None)

    checks = [
        ("unknown type", F.col("type").isin(S.ALL_TYPES)),
        ("unknown home_billing_country", F.col("home_billing_country").isin(S.COUNTRIES)),
        ("unknown ip_country", F.col("ip_country").isin(S.COUNTRIES)),
        ("amount must be > 0", F.col("amount") > 0),
        ("account_age_days out of 0..3650", F.col("account_age_days").between(0, 3650)),
        ("failed_payment_attempts out of 0..12", F.col("failed_payment_attempts").between(0, 12)),
        ("ip_billing_distance_km must be >= 0", F.col("ip_billing_distance_km") >= 0),
        ("step must be >= 1", opt("step").isNull() | (opt("step") >= 1)),
        ("hour_of_day out of 0..23", opt("hour_of_day").isNull() | opt("hour_of_day").between(0, 23)),
        ("oldbalanceOrg must be >= 0", opt("oldbalanceOrg").isNull() | (opt("oldbalanceOrg") >= 0)),
        ("newbalanceOrig must be >= 0", opt("newbalanceOrig").isNull() | (opt("newbalanceOrig") >= 0)),
        ("oldbalanceDest must be >= 0", opt("oldbalanceDest").isNull() | (opt("oldbalanceDest") >= 0)),
        ("newbalanceDest must be >= 0", opt("newbalanceDest").isNull() | (opt("newbalanceDest") >= 0)),
        ("dest_prior_count must be >= 0", opt("dest_prior_count").isNull() | (opt("dest_prior_count") >= 0)),
    ]
    reasons = F.filter(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(msg)) for msg, ok in checks]),
        lambda x: x.isNotNull(),
    )
    tagged = df.withColumn("reject_reasons", reasons)
    valid = tagged.where(F.size("reject_reasons") == 0).drop("reject_reasons")
    rejected = tagged.where(F.size("reject_reasons") > 0)
    return valid, rejected


def fill_transaction_id(df: DataFrame, id_col: str = "transaction_id") -> DataFrame:
    """Q31: fill a missing id with 'txn_' + 12 hex chars of a hash of the row (replayable)."""
    h = F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns if c != id_col])), 256)
    gen = F.concat(F.lit("txn_"), F.substring(h, 1, 12))
    if id_col not in df.columns:
        return df.withColumn(id_col, gen)
    return df.withColumn(id_col, F.coalesce(F.col(id_col), gen))


__all__ = [
    "SchemaError", "require_columns", "same_columns", "column_profile", "null_counts", "duplicate_count", "dedup",
    "normalise_categoricals", "vocab_violations", "range_report", "binary_report", "amount_filter",
    "coerce_numeric", "quality_flags", "clean", "table_summary", "before_after", "reconciliation",
    "masked_by_dest", "contract_split", "fill_transaction_id",
]
