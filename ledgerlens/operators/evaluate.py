"""Evaluation and threshold policy.

Inputs are scored frames with a probability column, the 0/1 label and the
amount at risk. Nothing here sorts all rows in one task:

* the threshold sweep bins every row to the largest grid threshold <= score
  (binary search on the JVM), aggregates per bin and takes a reverse running
  sum over at most 291 bin rows;
* average precision and ROC-AUC aggregate to distinct scores and use the
  distributed running sums of `ranks.cumulative`;
* top-k review budgets use distributed per-row positions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import div0, r6
from . import ranks


def threshold_grid() -> list[float]:
    """M7: 0.0005..0.05 step 0.0005 (100) then 0.055..1.0 step 0.005 (190), from integers."""
    return [i / 2000 for i in range(1, 101)] + [i / 200 for i in range(11, 201)]


def _bin(df: DataFrame, score: str, grid: list[float], out: str = "__bin") -> DataFrame:
    # bin k (1-based) = number of grid thresholds <= score; 0 when below all of them
    return ranks.with_bucket(df, score, grid, out).withColumn(out, F.col(out).cast("int"))


def sweep_bins(df: DataFrame, score: str = "score", label: str = S.LABEL, amount: str = "amount_raw",
               grid: list[float] | None = None) -> DataFrame:
    """Per-bin counts: bin, n_pos, n_neg, pos_amount (one partial aggregate)."""
    grid = grid or threshold_grid()
    b = _bin(df.where(F.col(score).isNotNull()), score, grid)
    return b.groupBy("__bin").agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("n_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("n_neg"),
        F.sum(F.when(F.col(label) == 1, F.col(amount)).otherwise(0.0)).alias("pos_amount"),
    )


def threshold_sweep(df: DataFrame, score: str = "score", label: str = S.LABEL, amount: str = "amount_raw",
                    c_fp: float = S.C_FP, grid: list[float] | None = None) -> DataFrame:
    """M6: net_cost and its parts for every grid threshold (predict positive iff score >= t)."""
    return _sweep(df, score, label, amount, c_fp, grid).drop("n_rows")


def _sweep(df: DataFrame, score: str, label: str, amount: str, c_fp: float, grid: list[float] | None) -> DataFrame:
    grid = grid or threshold_grid()
    spark = df.sparkSession
    bins = sweep_bins(df, score, label, amount, grid)
    # bin 0 (below every threshold) keeps its rows in the totals
    g = spark.createDataFrame([(0, None)] + [(i + 1, t) for i, t in enumerate(grid)], "__bin int, threshold double")
    # grid (<= 291 rows) left-joined with the per-bin totals; windows over that bounded table
    w = Window.orderBy(F.col("__bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    x = g.join(bins, "__bin", "left").na.fill(0, ["n_pos", "n_neg"]).na.fill(0.0, ["pos_amount"])
    x = x.withColumns({
        "n_tp": F.sum("n_pos").over(w), "n_fp": F.sum("n_neg").over(w), "caught": F.sum("pos_amount").over(w),
        "P": F.sum("n_pos").over(whole), "PA": F.sum("pos_amount").over(whole),
        "n_rows": F.sum(F.col("n_pos") + F.col("n_neg")).over(whole),
    }).where(F.col("__bin") > 0)
    missed = F.coalesce(F.col("PA"), F.lit(0.0)) - F.col("caught")
    return x.select(
        "threshold",
        r6(missed + F.lit(c_fp) * F.col("n_fp")).alias("net_cost"),
        r6(missed).alias("missed_fraud_amount"),
        r6(F.col("caught")).alias("fraud_amount_caught"),
        F.col("n_fp").cast("long").alias("n_fp"), F.col("n_tp").cast("long").alias("n_tp"),
        (F.coalesce(F.col("P"), F.lit(0)) - F.col("n_tp")).cast("long").alias("n_fn"),
        F.col("n_rows").cast("long").alias("n_rows"),
    )


def best_threshold(sweep: DataFrame, n_rows: int, min_threshold: float = S.MIN_OPERATING_THRESHOLD) -> DataFrame:
    """M8: admissible thresholds (t >= min, not everything flagged); min net_cost, then n_fp, then t."""
    adm = sweep.where((F.col("threshold") >= min_threshold) & ((F.col("n_fp") + F.col("n_tp")) < n_rows))
    return adm.orderBy("net_cost", "n_fp", "threshold").limit(1)


def choose_threshold(df: DataFrame, score: str = "score", label: str = S.LABEL, amount: str = "amount_raw",
                     c_fp: float = S.C_FP) -> float:
    """Sweep + admissible choice; raise if no admissible threshold exists."""
    sw = _sweep(df, score, label, amount, c_fp, None)
    adm = sw.where((F.col("threshold") >= S.MIN_OPERATING_THRESHOLD) & ((F.col("n_fp") + F.col("n_tp")) < F.col("n_rows")))
    row = adm.orderBy("net_cost", "n_fp", "threshold").limit(1).first()
    if row is None:
        raise ValueError("every threshold of the sweep would send all rows to review")
    return float(row["threshold"])


def score_table(df: DataFrame, score: str = "score", label: str = S.LABEL, group_cols: list[str] | None = None) -> DataFrame:
    """(group, score) -> n_pos, n_neg: the sufficient statistic of every ranking metric."""
    group_cols = group_cols or []
    return df.where(F.col(score).isNotNull()).groupBy(*group_cols, F.col(score).alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("n_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("n_neg"),
    )


def average_precision_from(table: DataFrame, group_cols: list[str]) -> DataFrame:
    """M9 over a (group, s, n_pos, n_neg) table: step-wise AP, no interpolation; NULL without positives."""
    t = table.withColumn("__ns", -F.col("s"))
    c = ranks.cumulative(t, group_cols, ["__ns"], ["n_pos", "n_neg"], prefix="cum_", inclusive=True, totals=True)
    c = c.withColumnsRenamed({"cum_total_n_pos": "__P", "cum_total_n_neg": "__N"})
    prec = F.col("cum_n_pos") / (F.col("cum_n_pos") + F.col("cum_n_neg"))
    return c.groupBy(*group_cols).agg(
        F.when(F.first("__P") > 0, F.sum(F.try_divide(F.col("n_pos"), F.col("__P")) * prec)).alias("average_precision"),
        F.first("__P").alias("n_pos"), F.first("__N").alias("n_neg"),
    )


def average_precision(df: DataFrame, score: str = "score", label: str = S.LABEL, group_cols: list[str] | None = None) -> DataFrame:
    """M9: average precision (sklearn definition) per group."""
    group_cols = group_cols or []
    return average_precision_from(score_table(df, score, label, group_cols), group_cols)


def roc_auc_from(table: DataFrame, group_cols: list[str]) -> DataFrame:
    """M10 over a (group, s, n_pos, n_neg) table; NULL unless both classes occur."""
    c = ranks.cumulative(table, group_cols, ["s"], ["n_pos", "n_neg"], prefix="below_", totals=True)
    c = c.withColumnsRenamed({"below_total_n_pos": "__P", "below_total_n_neg": "__N"})
    u = F.sum(F.col("n_pos") * (F.col("below_n_neg") + F.lit(0.5) * F.col("n_neg")))
    return c.groupBy(*group_cols).agg(
        F.when((F.first("__P") > 0) & (F.first("__N") > 0), u / (F.first("__P") * F.first("__N"))).alias("roc_auc"))


def roc_auc(df: DataFrame, score: str = "score", label: str = S.LABEL, group_cols: list[str] | None = None) -> DataFrame:
    """ROC-AUC as the Mann-Whitney statistic with mid-ranks for ties."""
    group_cols = group_cols or []
    return roc_auc_from(score_table(df, score, label, group_cols), group_cols)


def confusion(df: DataFrame, threshold: float, score: str = "score", label: str = S.LABEL,
              amount: str = "amount_raw", c_fp: float = S.C_FP) -> DataFrame:
    """Confusion counts, precision / recall / F1 (0 on zero division),
    review queue, FPR, caught / missed amount and net cost at a fixed threshold."""
    pred = F.col(score) >= F.lit(threshold)
    pos = F.col(label) == 1
    a = df.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.sum(pos.cast("int")).cast("long").alias("test_fraud_rows"),
        F.sum((pos & pred).cast("int")).cast("long").alias("test_tp"),
        F.sum((pos & ~pred).cast("int")).cast("long").alias("test_fn"),
        F.sum((~pos & pred).cast("int")).cast("long").alias("test_fp"),
        F.sum((~pos & ~pred).cast("int")).cast("long").alias("test_tn"),
        F.coalesce(F.sum(F.when(pos & pred, F.col(amount))), F.lit(0.0)).alias("caught"),
        F.coalesce(F.sum(F.when(pos & ~pred, F.col(amount))), F.lit(0.0)).alias("missed"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("test_tp", "test_fp", "test_fn", "test_tn"))
    precision = div0(tp, tp + fp)
    recall = div0(tp, tp + fn)
    return a.select(
        F.lit(threshold).alias("threshold"), "test_rows", "test_fraud_rows",
        r6(F.col("test_fraud_rows") / F.col("test_rows") * 100.0).alias("test_prevalence_pct"),
        r6(precision).alias("test_precision"), r6(recall).alias("test_recall"),
        r6(div0(F.lit(2.0) * precision * recall, precision + recall)).alias("test_f1"),
        "test_tp", "test_fn", "test_fp", "test_tn",
        (tp + fp).alias("test_review_queue"),
        r6((tp + fp) / F.col("test_rows") * 100.0).alias("test_review_rate_pct"),
        r6(div0(fp, fp + tn)).alias("test_fpr"),
        r6("caught").alias("test_fraud_amount_caught"), r6("missed").alias("test_fraud_amount_missed"),
        F.lit(c_fp).alias("c_fp_assumption"),
        r6(F.col("missed") + F.lit(c_fp) * fp).alias("test_net_cost"),
    )


REVIEW_BUDGETS = [0.001, 0.002, 0.005, 0.010, 0.020, 0.050]
POLICY_BUDGETS = [0.001, 0.002, 0.005, 0.010, 0.020]


def budget_k(n: int, budget: float) -> int:
    return max(1, int(math.ceil(n * budget)))


def top_positions(df: DataFrame, score: str = "score", id_col: str = "txn_id") -> DataFrame:
    """Distributed rank by score descending (ties: id ascending)."""
    return ranks.row_positions(df, [], score, id_col, descending=True)


def review_budget(df: DataFrame, budgets: list[float] = REVIEW_BUDGETS, score: str = "score", label: str = S.LABEL,
                  id_col: str = "txn_id") -> DataFrame:
    """Top-k review queues for each budget, one conditional aggregate over ranked rows."""
    n = df.count()
    pos = top_positions(df.select(id_col, score, label), score, id_col)
    ks = [budget_k(n, b) for b in budgets]
    row = pos.agg(
        F.sum(F.col(label)).alias("__P"),
        *[F.sum(F.when(F.col("pos") < k, F.col(label)).otherwise(0)).alias(f"c{i}") for i, k in enumerate(ks)],
    )
    parts = [F.struct(F.lit(b * 100).alias("review_budget_pct"), F.lit(k).cast("long").alias("flagged_rows"),
                      F.col(f"c{i}").cast("long").alias("fraud_caught")) for i, (b, k) in enumerate(zip(budgets, ks))]
    long = row.select("__P", F.explode(F.array(*parts)).alias("s")).select("__P", "s.*")
    return long.select(
        r6("review_budget_pct").alias("review_budget_pct"), "flagged_rows", "fraud_caught",
        (F.col("flagged_rows") - F.col("fraud_caught")).alias("false_positive_normals"),
        r6(F.col("fraud_caught") / F.col("flagged_rows")).alias("precision"),
        r6(F.col("fraud_caught") / F.col("__P")).alias("fraud_recall"),
    )


def policy_queue(df: DataFrame, budgets: list[float] = POLICY_BUDGETS, score: str = "score", label: str = S.LABEL,
                 amount: str = "amount_raw", id_col: str = "txn_id") -> DataFrame:
    """precision@k, recall@k and fraud-amount recall@k per review rate."""
    n = df.count()
    pos = top_positions(df.select(id_col, score, label, amount), score, id_col)
    ks = [budget_k(n, b) for b in budgets]
    fraud_amt = F.when(F.col(label) == 1, F.col(amount)).otherwise(0.0)
    row = pos.agg(
        F.sum(F.col(label)).alias("__P"), F.sum(fraud_amt).alias("__PA"),
        *[F.sum(F.when(F.col("pos") < k, F.col(label)).otherwise(0)).alias(f"c{i}") for i, k in enumerate(ks)],
        *[F.sum(F.when(F.col("pos") < k, fraud_amt).otherwise(0.0)).alias(f"a{i}") for i, k in enumerate(ks)],
    )
    parts = [F.struct(F.lit(b * 100).alias("review_rate_pct"), F.lit(k).cast("long").alias("k_transactions"),
                      F.col(f"c{i}").cast("long").alias("c"), F.col(f"a{i}").alias("a")) for i, (b, k) in enumerate(zip(budgets, ks))]
    long = row.select("__P", "__PA", F.explode(F.array(*parts)).alias("s")).select("__P", "__PA", "s.*")
    return long.select(
        r6("review_rate_pct").alias("review_rate_pct"), "k_transactions",
        r6(F.col("c") / F.col("k_transactions")).alias("precision_at_k"),
        r6(div0(F.col("c"), F.col("__P"))).alias("recall_at_k"),
        r6(div0(F.col("a"), F.col("__PA"))).alias("fraud_amount_recall_at_k"),
        F.col("c").alias("fraud_cases_caught_at_k"),
        (F.col("k_transactions") - F.col("c")).alias("normal_false_alerts_at_k"),
    )


COST_GRID = [5.0, 10.0, 15.0, 20.0, 25.0]


def cost_sensitivity(df: DataFrame, costs: list[float] = COST_GRID, score: str = "score", label: str = S.LABEL,
                     amount: str = "amount_raw") -> DataFrame:
    """Best admissible threshold for each false-positive cost, from one bin aggregate."""
    n = df.count()
    base = threshold_sweep(df, score, label, amount, c_fp=0.0)
    # 5 costs x 290 thresholds: explode a literal cost array, no join needed
    x = base.withColumn("c_fp", F.explode(F.array(*[F.lit(c) for c in costs])))
    x = x.withColumn("net_cost", r6(F.col("missed_fraud_amount") + F.col("c_fp") * F.col("n_fp")))
    adm = x.where((F.col("threshold") >= S.MIN_OPERATING_THRESHOLD) & ((F.col("n_fp") + F.col("n_tp")) < n))
    w = Window.partitionBy("c_fp").orderBy("net_cost", "n_fp", "threshold")
    return adm.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).select(
        "c_fp", "threshold", "net_cost", "n_fp", "n_tp", "n_fn")


def savings(df: DataFrame, threshold: float, score: str = "score", label: str = S.LABEL, amount: str = "amount_raw",
            c_fp: float = S.C_FP) -> DataFrame:
    """Savings vs approve-all = total fraud amount - net cost at the threshold."""
    c = confusion(df, threshold, score, label, amount, c_fp)
    tot = F.col("test_fraud_amount_caught") + F.col("test_fraud_amount_missed")
    return c.select(F.lit(threshold).alias("threshold"), r6(tot).alias("total_fraud_amount"), "test_net_cost",
                    r6(tot - F.col("test_net_cost")).alias("savings"))


ERFC_COEFFS = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def with_erfc(df: DataFrame, x: str, out: str) -> DataFrame:
    """Add `out` = erfc(x) (Chebyshev fit, fractional error < 1.2e-7).

    Intermediate values are staged as columns so the expression tree stays
    linear (a Column reused in Python would be copied into the plan each time).
    """
    z, t = f"__{out}_z", f"__{out}_t"
    d = df.withColumn(z, F.abs(F.col(x)))
    d = d.withColumn(t, F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * F.col(z)))
    poly = F.lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(c) + F.col(t) * poly
    ans = F.col(t) * F.exp(-F.col(z) * F.col(z) + poly)
    return d.withColumn(out, F.when(F.col(x) >= 0, ans).otherwise(F.lit(2.0) - ans)).drop(z, t)


def erfc(x: Column) -> Column:
    """erfc as a single expression (for a plain input column; see `with_erfc` for derived inputs)."""
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = F.lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)
