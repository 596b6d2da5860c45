"""Exploratory aggregates over the transaction table.

Every function is one lazy plan; global figures come from a single aggregate
pass (map-side partial aggregation), never one action per statistic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import count_if, isclose, pct, r6, safe_div
from . import ranks


def fraud_rate_by(df: DataFrame, key: str | Column, name: str | None = None) -> DataFrame:
    """A1: rows, fraud count and fraud rate % per key (NULL keys dropped, as pandas)."""
    k = F.col(key) if isinstance(key, str) else key
    name = name or (key if isinstance(key, str) else "key")
    return (
        df.select(k.alias(name), "isFraud")
        .where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(
            F.count("isFraud").alias("n"),
            F.sum("isFraud").cast("long").alias("fraud"),
            r6(pct(F.avg("isFraud"))).alias("fraud_rate_pct"),
        )
    )


def dest_kind(c: str = "nameDest") -> Column:
    return F.when(F.col(c).startswith("M"), F.lit("merchant (M)")).otherwise(F.lit("customer (C)"))


def value_at_risk(df: DataFrame) -> DataFrame:
    """A2: imbalance and value at risk in one pass."""
    a = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("isFraud").cast("long").alias("fraud"),
        F.avg("isFraud").alias("_prev"),
        F.sum(F.when(F.col("isFraud") == 1, F.col("amount"))).alias("_fv"),
        F.sum("amount").alias("_tv"),
    )
    return a.select(
        "n", "fraud",
        r6(pct("_prev")).alias("prevalence_pct"),
        F.bround(safe_div(F.lit(1.0), F.col("_prev")), 0).cast("long").alias("one_in_k"),
        r6(F.coalesce("_fv", F.lit(0.0))).alias("fraud_value"),
        r6("_tv").alias("total_value"),
        r6(pct(safe_div(F.coalesce("_fv", F.lit(0.0)), F.col("_tv")))).alias("value_share_pct"),
    )


def universe_prevalence(df: DataFrame, universe: list[str] = S.FRAUD_TYPES) -> DataFrame:
    """A3: prevalence overall vs inside the fraud-bearing types."""
    inu = F.col("type").isin(universe)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        r6(pct(F.avg("isFraud"))).alias("overall_rate_pct"),
        count_if(inu).alias("universe_rows"),
        F.sum(F.when(inu, F.col("isFraud"))).cast("long").alias("universe_fraud"),
        r6(pct(F.avg(F.when(inu, F.col("isFraud"))))).alias("universe_rate_pct"),
    )


def amount_describe_by_class(df: DataFrame) -> DataFrame:
    """A4: mean, p50, p90, p99, max of amount per class (exact quantiles)."""
    probs = [0.5, 0.9, 0.99]
    q = ranks.exact_quantiles(df, ["isFraud"], ["amount"], probs)
    qw = q.groupBy("isFraud").pivot("p", probs).agg(F.first("value"))
    qw = qw.toDF("isFraud", "p50", "p90", "p99")
    basic = df.groupBy("isFraud").agg(F.avg("amount").alias("mean"), F.max("amount").alias("max"))
    return basic.join(qw, "isFraud").select(
        "isFraud", r6("mean").alias("mean"), r6("p50").alias("p50"), r6("p90").alias("p90"),
        r6("p99").alias("p99"), r6("max").alias("max"),
    )


def amount_hist(df: DataFrame, bins: int = 60) -> DataFrame:
    """A5: per-class density histogram of log10(amount), amount > 0.

    Each class has its own [min, max] range split into `bins` equal bins, the
    last closed on the right; density = n / (N * width). A degenerate range
    (min == max) uses [min - 0.5, max + 0.5] like NumPy.
    """
    x = df.where(F.col("amount") > 0).select("isFraud", F.log10("amount").alias("x"))
    rng = x.groupBy("isFraud").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("N"))
    rng = rng.select(
        "isFraud", "N",
        F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"),
        F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("hi") + 0.5).alias("hi"),
    ).withColumn("w", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    b = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("w")), F.lit(bins - 1)).cast("int")
    # one row per class (binary label): broadcast, so no shuffle on a 2-value key
    h = x.join(F.broadcast(rng), "isFraud").select("isFraud", b.alias("bin"), "lo", "w", "N")
    return h.groupBy("isFraud", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.first("lo") + F.col("bin") * F.first("w")).alias("bin_lo"),
        r6(F.count(F.lit(1)) / (F.first("N") * F.first("w"))).alias("density"),
    )


def class_counts(df: DataFrame) -> DataFrame:
    """Rows per class and their share of all rows."""
    g = df.groupBy("isFraud").agg(F.count(F.lit(1)).alias("n"))
    # tiny window over the aggregated (<= 2 row) table
    return g.select("isFraud", "n", r6(F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def balance_mechanics(df: DataFrame) -> DataFrame:
    """Drained-fraud count and share, share of rows with non-zero origin error."""
    orig_err = F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig")
    fraud = F.col("isFraud") == 1
    return df.agg(
        count_if(fraud).alias("n_fraud"),
        count_if(fraud & isclose("newbalanceOrig", 0.0)).alias("drained_fraud"),
        r6(pct(safe_div(count_if(fraud & isclose("newbalanceOrig", 0.0)).cast("double"), F.greatest(count_if(fraud), F.lit(1))))).alias("drained_pct"),
        r6(pct(F.avg(F.when(isclose(orig_err, 0.0), F.lit(0)).otherwise(F.lit(1))))).alias("orig_err_nonzero_pct"),
    )


def ledger_errors_by_class(df: DataFrame) -> DataFrame:
    """Mean ledger errors and origin-emptied rate by class."""
    orig_err = F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig")
    dest_err = F.col("oldbalanceDest") + F.col("amount") - F.col("newbalanceDest")
    emptied = ((F.col("newbalanceOrig") == 0) & isclose("oldbalanceOrg", "amount")).cast("int")
    return df.groupBy("isFraud").agg(
        r6(F.avg(orig_err)).alias("mean_orig_err"),
        r6(F.avg(dest_err)).alias("mean_dest_err"),
        r6(F.avg(emptied)).alias("origin_emptied_rate"),
    )


def rule_effectiveness(df: DataFrame) -> DataFrame:
    """A10: existing-rule fires, catches, total fraud and recall %."""
    fires = F.col("isFlaggedFraud") == 1
    return df.agg(
        count_if(fires).alias("fires"),
        count_if(fires & (F.col("isFraud") == 1)).alias("caught"),
        count_if(F.col("isFraud") == 1).alias("total_fraud"),
    ).withColumn("recall_pct", r6(pct(F.col("caught") / F.greatest(F.col("total_fraud"), F.lit(1)))))


BASE_NUMERIC = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "isFraud"]


def corr_matrix(df: DataFrame, cols: list[str] = BASE_NUMERIC) -> DataFrame:
    """Pearson correlation of every column pair (upper triangle), one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    stack = F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("corr")) for a, b in pairs
    ])).alias("s")
    return row.select(stack).select("s.col_a", "s.col_b", r6("s.corr").alias("corr"))


CONTEXT_FLAGS = ["is_new_device", "shipping_billing_mismatch", "is_night"]
CONTEXT_NUMBERS = ["account_age_days", "failed_payment_attempts", "ip_billing_distance_km"]


def flag_lift(df: DataFrame, flags: list[str] = CONTEXT_FLAGS) -> DataFrame:
    """Fraud rate when flag = 1 vs 0, and their ratio (NULL if base 0)."""
    long = df.select("isFraud", F.explode(F.array(*[
        F.struct(F.lit(f).alias("signal"), F.col(f).alias("v")) for f in flags
    ])).alias("s")).select("isFraud", "s.signal", "s.v")
    g = long.groupBy("signal").agg(
        (pct(F.avg(F.when(F.col("v") == 1, F.col("isFraud"))))).alias("r1"),
        (pct(F.avg(F.when(F.col("v") == 0, F.col("isFraud"))))).alias("r0"),
    )
    return g.select(
        "signal", r6("r1").alias("rate_1_pct"), r6("r0").alias("rate_0_pct"),
        r6(F.when(F.col("r0") != 0, F.col("r1") / F.col("r0"))).alias("lift_x"),
    )


def decile_of_rank(pos: Column, n: Column) -> Column:
    """pandas `qcut(rank, 10, labels=False)` for 1-based rank r = pos + 1 of n rows.

    decile = max(ceil((r-1)*10/(n-1)), 1) - 1, with integer ceiling.
    """
    num = pos * 10 + n - 2
    d = F.when(n > 1, F.floor(num / (n - 1))).otherwise(F.lit(1))
    return (F.greatest(d, F.lit(1)) - 1).cast("int")


def rank_deciles(df: DataFrame, cols: list[str] = CONTEXT_NUMBERS, id_col: str = "txn_id") -> DataFrame:
    """Fraud rate by rank decile of each column (ties broken by id)."""
    long = df.select(id_col, "isFraud", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("s")).select(id_col, "isFraud", "s.feature", "s.v").where(F.col("v").isNotNull())
    pos = ranks.row_positions(long, ["feature"], "v", id_col)
    sizes = long.groupBy("feature").agg(F.count(F.lit(1)).alias("__n"))
    # one row per listed column: a bounded side, broadcast
    d = pos.join(F.broadcast(sizes), "feature").withColumn("decile", decile_of_rank(F.col("pos"), F.col("__n")))
    return d.groupBy("feature", "decile").agg(
        F.count(F.lit(1)).alias("n"), r6(pct(F.avg("isFraud"))).alias("fraud_rate_pct")
    )


def label_corr(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of each column with the label, with its absolute value."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col("isFraud").cast("double")).alias(c) for c in cols])
    s = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in cols])).alias("s")
    return row.select(s).select("s.feature", r6("s.corr").alias("corr_with_isFraud"), r6(F.abs("s.corr")).alias("abs_corr"))


def flag_stack(df: DataFrame, flags: list[str] = CONTEXT_FLAGS) -> DataFrame:
    """Fraud rate by number of active risk flags."""
    nf = sum((F.col(f) for f in flags[1:]), F.col(flags[0]))
    return (
        df.groupBy(nf.alias("n_flags"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("isFraud").cast("long").alias("fraud"), r6(pct(F.avg("isFraud"))).alias("fraud_rate_pct"))
    )


def type_summary_shares(df: DataFrame) -> DataFrame:
    """Per type totals with transaction and fraud shares (window over <= 5 rows)."""
    g = df.groupBy("type").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("isFraud").cast("long").alias("fraud_count"),
        F.avg("isFraud").alias("_rate"),
        F.sum("amount").alias("_amt"),
    )
    allw = Window.partitionBy()
    return g.select(
        "type", "total_transactions", "fraud_count",
        r6("_amt").alias("total_amount"),
        r6(pct("_rate")).alias("fraud_rate_pct"),
        r6(pct(F.col("total_transactions") / F.sum("total_transactions").over(allw))).alias("transaction_share_pct"),
        r6(pct(safe_div(F.col("fraud_count"), F.sum("fraud_count").over(allw)))).alias("fraud_share_pct"),
    )


DESCRIBE_PROBS = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999]


def amount_percentiles(df: DataFrame, column: str = "amount", probs: list[float] = DESCRIBE_PROBS) -> DataFrame:
    """Describe with percentiles, long form (stat, value); std is sample std."""
    q = ranks.exact_quantiles(df, [], [column], probs).select(
        F.format_string("p%s", F.round(F.col("p") * 1000).cast("int").cast("string")).alias("stat"), "value"
    )
    b = df.agg(
        F.count(column).cast("double").alias("count"), F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"), F.min(column).cast("double").alias("min"), F.max(column).cast("double").alias("max"),
    )
    basic = b.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in ["count", "mean", "std", "min", "max"]
    ])).alias("s")).select("s.stat", "s.value")
    return basic.unionByName(q).select("stat", r6("value").alias("value"))


def qcut_edges(df: DataFrame, column: str, q: int = 10) -> list[float]:
    """Value-quantile edges, duplicates dropped (pandas `duplicates='drop'`)."""
    edges = ranks.quantile_row(df.select(column), column, [i / q for i in range(q + 1)])
    out: list[float] = []
    for e in edges:
        if e is None:
            continue
        if not out or e != out[-1]:
            out.append(e)
    return out


def bin_right_closed(c: Column, edges: list[float]) -> Column:
    """Index of the right-closed bin (e_i, e_{i+1}]; the first bin also takes e_0."""
    expr = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        lo, hi = edges[i - 1], edges[i]
        cond = (c > F.lit(lo)) & (c <= F.lit(hi)) if i > 1 else (c >= F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(i - 1)).otherwise(expr)
    return expr


def amount_value_deciles(df: DataFrame, column: str = "amount") -> DataFrame:
    """Fraud rate by value-quantile decile of amount."""
    edges = qcut_edges(df, column)
    b = bin_right_closed(F.col(column), edges)
    return (
        df.select(b.alias("bin"), "isFraud").where(F.col("bin").isNotNull())
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), r6(pct(F.avg("isFraud"))).alias("fraud_rate_pct"))
    )


# fixed values: right-closed bin edges and labels
DISTANCE_EDGES = [-1.0, 100.0, 500.0, 1500.0, 5000.0, 1e9]
DISTANCE_LABELS = ["<100", "100-500", "500-1.5k", "1.5k-5k", "5k+"]
RATIO_EDGES = [-0.01, 0.5, 0.95, 1.05, 1e9]
RATIO_LABELS = ["<0.5", "0.5-0.95", "~1.0", ">1.05"]


def fixed_bins(c: Column, edges: list[float], labels: list[str]) -> Column:
    """Pandas `cut` with right-closed bins (first bin open on the left too)."""
    expr = F.lit(None).cast("string")
    for i in range(len(edges) - 1, 0, -1):
        expr = F.when((c > F.lit(edges[i - 1])) & (c <= F.lit(edges[i])), F.lit(labels[i - 1])).otherwise(expr)
    return expr


def rate_by_bins(df: DataFrame, c: Column, edges: list[float], labels: list[str]) -> DataFrame:
    return (
        df.select(fixed_bins(c, edges, labels).alias("bucket"), "isFraud").where(F.col("bucket").isNotNull())
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), r6(pct(F.avg("isFraud"))).alias("fraud_rate_pct"))
    )


def feature_describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, sample std, min, max per column, one pass, long form."""
    row = df.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
        for c in cols
    ])
    s = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("d")) for c in cols])).alias("s")
    return row.select(s).select(
        "s.feature", r6("s.d.mean").alias("mean"), r6("s.d.std").alias("std"), r6("s.d.min").alias("min"), r6("s.d.max").alias("max")
    )


def scoping_retention(df: DataFrame, universe: list[str] = S.FRAUD_TYPES) -> DataFrame:
    """Rows, fraud and fraud rate before and after scoping to the universe."""
    inu = F.col("type").isin(universe)
    a = df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.sum("isFraud").cast("long").alias("fraud_before"),
        count_if(inu).alias("rows_after"), F.sum(F.when(inu, F.col("isFraud"))).cast("long").alias("fraud_after"),
    )
    return a.select(
        "*",
        r6(pct(F.col("fraud_before") / F.col("rows_before"))).alias("rate_before_pct"),
        r6(pct(safe_div(F.col("fraud_after"), F.col("rows_after")))).alias("rate_after_pct"),
        r6(pct(safe_div(F.col("fraud_after"), F.col("fraud_before")))).alias("fraud_retained_pct"),
    )
