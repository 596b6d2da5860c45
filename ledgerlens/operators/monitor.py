"""Monitoring: drift, rolling performance and retraining triggers (MN1-MN9).

All statistics come from aggregates over the scored reference and current
sets: 2x2 counts per binary feature (chi-square), per-value counts with
distributed running sums per numeric feature (KS), per-step aggregates with a
range frame over the small step table (rolling metrics), and counts cumulated over
scores and steps inside buckets of scores (rolling average precision).
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import one_row
from ..session import stored
from . import ranks
from .evaluate import average_precision_from, erfc, with_erfc  # noqa: F401


def _sides(ref: DataFrame, cur: DataFrame, features: list[str]) -> DataFrame:
    """Both sides under one another: `side` and the features as doubles (NaN as NULL)."""
    def side(d: DataFrame, name: str) -> DataFrame:
        return d.select(F.lit(name).alias("side"), *[F.nanvl(F.col(f).cast("double"), F.lit(None)).alias(f) for f in features])
    return side(ref, "ref").unionByName(side(cur, "cur"))


def _stats(sides: DataFrame, features: list[str]) -> DataFrame:
    """Per feature: counts, means per side, and whether it is binary (MN3), from one aggregate of two rows."""
    per = sides.groupBy("side").agg(*[
        F.struct(F.count(f).alias("n"), F.sum(f).alias("total"), *[F.coalesce(F.sum((F.col(f) == v).cast("long")), F.lit(0)).cast("long").alias(c) for v, c in ((0, "zeros"), (1, "ones"))]).alias(f)
        for f in features])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("s")) for f in features])).alias("x")
    long = per.select("side", each).select("side", "x.feature", "x.s.*")
    of = lambda side, c: F.coalesce(F.max(F.when(F.col("side") == side, F.col(c))), F.lit(0))
    mean = lambda side: F.max(F.when((F.col("side") == side) & (F.col("n") > 0), F.col("total") / F.col("n")))
    return long.groupBy("feature").agg(
        of("ref", "n").alias("n_ref"), of("cur", "n").alias("n_cur"), mean("ref").alias("reference_mean"), mean("cur").alias("current_mean"),
        of("ref", "zeros").alias("ref0"), of("ref", "ones").alias("ref1"), of("cur", "zeros").alias("cur0"), of("cur", "ones").alias("cur1"),
        (F.sum(F.col("n") - F.col("zeros") - F.col("ones")) == 0).alias("is_binary"))


def feature_stats(ref: DataFrame, cur: DataFrame, features: list[str]) -> DataFrame:
    """MN3 statistics of every feature; a feature without values has counts of 0."""
    return _stats(_sides(ref, cur, features), features)


def with_chi2_yates(df: DataFrame, cells: list[str], out: str) -> DataFrame:
    """Add `out` = chi-square of the 2x2 table [[a, b], [c, d]] with Yates' correction.

    NULL when an expected count is 0 (a zero row or column). Staged columns
    keep the plan linear.
    """
    a, b, c, d = (F.col(x).cast("double") for x in cells)
    x = df.withColumns({"__r0": a + b, "__r1": c + d, "__c0": a + c, "__c1": b + d})
    x = x.withColumn("__n", F.col("__r0") + F.col("__r1"))
    spec = [(cells[0], "__r0", "__c0"), (cells[1], "__r0", "__c1"), (cells[2], "__r1", "__c0"), (cells[3], "__r1", "__c1")]
    x = x.withColumns({f"__e{i}": F.col(r) * F.col(cc) / F.col("__n") for i, (_, r, cc) in enumerate(spec)})
    x = x.withColumns({f"__d{i}": F.col(f"__e{i}") - F.col(o).cast("double") for i, (o, _, _) in enumerate(spec)})
    x = x.withColumns({f"__a{i}": F.col(o).cast("double") + F.signum(f"__d{i}") * F.least(F.lit(0.5), F.abs(f"__d{i}"))
                       for i, (o, _, _) in enumerate(spec)})
    terms = [(F.col(f"__a{i}") - F.col(f"__e{i}")) * (F.col(f"__a{i}") - F.col(f"__e{i}")) / F.col(f"__e{i}") for i in range(4)]
    ok = (F.col("__r0") * F.col("__c0") > 0) & (F.col("__r0") * F.col("__c1") > 0) & (F.col("__r1") * F.col("__c0") > 0) & (F.col("__r1") * F.col("__c1") > 0)
    x = x.withColumn(out, F.when(ok, terms[0] + terms[1] + terms[2] + terms[3]))
    return x.drop("__r0", "__r1", "__c0", "__c1", "__n", *[f"__{p}{i}" for p in "eda" for i in range(4)])


def with_ks_pvalue(df: DataFrame, d: str, n: str, m: str, out: str) -> DataFrame:
    """Add `out` = asymptotic two-sample KS p-value with n_e = round(n m / (n + m)).

    lambda = (sqrt(n_e) + 0.12 + 0.11 / sqrt(n_e)) * D; Q(lambda) from the
    series that converges fast on each side of 1.18 (8 terms each).
    """
    x = df.withColumn("__sq", F.sqrt(F.round(F.col(n).cast("double") * F.col(m) / (F.col(n) + F.col(m)))))
    x = x.withColumn("__lam", (F.col("__sq") + F.lit(0.12) + F.lit(0.11) / F.col("__sq")) * F.col(d))
    x = x.withColumn("__l2", F.col("__lam") * F.col("__lam"))
    small = F.lit(0.0)
    for k in range(1, 9):
        small = small + F.exp(-F.lit(float((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / F.col("__l2"))
    big = F.lit(0.0)
    for k in range(1, 9):
        big = big + F.lit(float((-1) ** (k - 1))) * F.exp(F.lit(-2.0 * k * k) * F.col("__l2"))
    q = (F.when(F.col("__lam") <= 0, F.lit(1.0))
         .when(F.col("__lam") < 1.18, F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / F.col("__lam") * small)
         .otherwise(F.lit(2.0) * big))
    return x.withColumn(out, F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))).drop("__sq", "__lam", "__l2")


def chi2_yates(o: list[Column]) -> Column:
    """Single-expression form of `with_chi2_yates` for plain input columns (tests, small tables)."""
    a, b, c, d = o
    n = a + b + c + d
    rows = [a + b, a + b, c + d, c + d]
    cols = [a + c, b + d, a + c, b + d]
    terms = []
    for obs, rr, cc in zip(o, rows, cols):
        e = rr * cc / n
        diff = e - obs
        adj = obs + F.signum(diff) * F.least(F.lit(0.5), F.abs(diff))
        terms.append((adj - e) * (adj - e) / e)
    ok = F.lit(True)
    for rr, cc in zip(rows, cols):
        ok = ok & (rr * cc > 0)
    return F.when(ok, terms[0] + terms[1] + terms[2] + terms[3])


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Single-expression form of `with_ks_pvalue` for plain input columns."""
    ne = F.round(n * m / (n + m))
    sq = F.sqrt(ne)
    lam = (sq + F.lit(0.12) + F.lit(0.11) / sq) * d
    small = F.lit(0.0)
    for k in range(1, 9):
        small = small + F.exp(-F.lit(float((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (lam * lam))
    big = F.lit(0.0)
    for k in range(1, 9):
        big = big + F.lit(float((-1) ** (k - 1))) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
    q = F.when(lam <= 0, F.lit(1.0)).when(lam < 1.18, F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * small).otherwise(F.lit(2.0) * big)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


def drift_chi2(stats: DataFrame, alpha: float = 0.05) -> DataFrame:
    """MN4a: chi-square (Yates) drift for binary features; score = |mean difference|."""
    b = stats.where(F.col("is_binary") & (F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    b = with_chi2_yates(b, ["ref0", "ref1", "cur0", "cur1"], "statistic")
    b = b.withColumn("__x", F.sqrt(F.col("statistic") / 2.0))
    b = with_erfc(b, "__x", "__p")
    p = F.when(F.col("statistic").isNull(), F.lit(1.0)).otherwise(F.col("__p"))
    return b.select(
        "feature", F.lit("chi2_binary").alias("method"),
        F.abs(F.col("current_mean") - F.col("reference_mean")).alias("score"),
        "statistic", p.alias("p_value"), "reference_mean", "current_mean",
    ).withColumn("drifted", F.col("p_value") < alpha)


def _ks_of(sides: DataFrame, stats: DataFrame, numeric: list[str], alpha: float) -> DataFrame | None:
    """MN4b of the listed features: each feature's value counts come from a scan of its own column."""
    if not numeric:
        return None
    is_ref = F.col("side") == "ref"
    counts = reduce(DataFrame.unionByName, [
        sides.where(F.col(f).isNotNull()).groupBy(F.col(f).alias("value")).agg(
            F.sum(is_ref.cast("long")).alias("c_ref"), F.sum((~is_ref).cast("long")).alias("c_cur")).select(F.lit(f).alias("feature"), "value", "c_ref", "c_cur")
        for f in numeric])
    # the bounds of the running sums and the sums themselves read the counts
    counts = stored(counts, "drift-values")
    cum = ranks.cumulative(counts, ["feature"], ["value"], ["c_ref", "c_cur"], prefix="cum_", inclusive=True)
    st = stats.select("feature", "n_ref", "n_cur", "reference_mean", "current_mean")
    cum = cum.join(F.broadcast(st), "feature")  # one row per listed feature
    gap = F.abs(F.col("cum_c_ref") / F.col("n_ref") - F.col("cum_c_cur") / F.col("n_cur"))
    d = cum.groupBy("feature", "n_ref", "n_cur", "reference_mean", "current_mean").agg(F.max(gap).alias("D"))
    d = with_ks_pvalue(d, "D", "n_ref", "n_cur", "p_value")
    return d.select(
        "feature", F.lit("ks_numeric").alias("method"), F.col("D").alias("score"), F.col("D").alias("statistic"),
        "p_value", "reference_mean", "current_mean",
    ).withColumn("drifted", F.col("p_value") < alpha)


def _summary(ref: DataFrame, cur: DataFrame, features: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """The stored sides, their statistics as a local table (one row a feature), and the numeric features to compare."""
    sides = stored(_sides(ref, cur, features), "drift-sides")
    stats = _stats(sides, features)
    rows = stats.collect()
    numeric = [r["feature"] for r in rows if not r["is_binary"] and r["n_ref"] > 0 and r["n_cur"] > 0]
    return sides, sides.sparkSession.createDataFrame(rows, stats.schema), numeric


def drift_ks(ref: DataFrame, cur: DataFrame, features: list[str], alpha: float = 0.05) -> DataFrame | None:
    """MN4b: two-sample KS drift for non-binary features; score = D. None if no feature is numeric."""
    sides, stats, numeric = _summary(ref, cur, features)
    return _ks_of(sides, stats, numeric, alpha)


def drift_summary(ref: DataFrame, cur: DataFrame, features: list[str], alpha: float = 0.05) -> DataFrame:
    """MN4c: one row per non-empty feature: method, score, statistic, p-value, means, drifted.

    Both sides are computed and stored once, aggregated once for all features,
    and read once more by column for the numeric ones.
    """
    sides, stats, numeric = _summary(ref, cur, features)
    chi, ks = drift_chi2(stats, alpha), _ks_of(sides, stats, numeric, alpha)
    return chi if ks is None else chi.unionByName(ks)


def rolling_metrics(current: DataFrame, window: int = S.ROLLING_WINDOW_STEPS, step: str = "step", target: str = "target",
                    pred: str = "prediction") -> DataFrame:
    """MN5: one row per distinct labelled step, metrics over steps [end - window + 1, end].

    Rows are first aggregated per step; the range frame then runs over the
    per-step table (one row per hour), never over transactions.
    """
    lab = current.where(F.col(target).isNotNull())
    per = lab.groupBy(step).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target)).cast("long").alias("fraud"),
        F.sum(F.col(pred)).cast("long").alias("flagged"),
        F.sum(((F.col(target) == 1) & (F.col(pred) == 1)).cast("long")).alias("tp"),
    )
    # per-step table: one row per labelled hour, so an unpartitioned frame is bounded
    w = Window.orderBy(step).rangeBetween(-(window - 1), 0)
    r = per.select(
        step, *[F.sum(c).over(w).alias(c) for c in ("n", "fraud", "flagged", "tp")],
    )
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("flagged")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("fraud")), F.lit(0.0))
    return r.select(
        (F.col(step) - window + 1).alias("window_start_step"), F.col(step).alias("window_end_step"),
        F.col("n").alias("n_transactions"), F.col("fraud").alias("n_fraud"), F.col("flagged").alias("n_flagged"),
        prec.alias("precision"), rec.alias("recall"),
        F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1"),
        (F.col("fraud") / F.col("n")).alias("fraud_rate"),
    )


# Distinct scores of positives in one bucket of the rolling average precision.
POSITIVES_PER_BUCKET = 2000


def rolling_average_precision(current: DataFrame, window: int = S.ROLLING_WINDOW_STEPS, step: str = "step",
                              target: str = "target", score: str = "prediction_proba",
                              positives_per_bucket: int = POSITIVES_PER_BUCKET) -> DataFrame:
    """MN6: average precision per rolling window; NULL when the window holds one class only.

    Precision is wanted at the scores of positives alone. These are cut into
    buckets; what a window holds above a bucket comes from a (bucket, step) table, and inside a bucket counts are
    cumulated over scores and steps, so a (score, step) cell is read once and not once for each window it lies in.
    """
    lab = current.where(F.col(target).isNotNull() & F.col(score).isNotNull())
    cells = lab.groupBy(F.col(step).cast("long").alias("step"), F.col(score).cast("double").alias("s")).agg(
        F.sum((F.col(target) == 1).cast("long")).alias("n_pos"), F.count(F.lit(1)).alias("n_all"))
    cells = stored(cells, "rolling-cells")
    _, bounds = ranks.count_and_bounds(cells.where("n_pos > 0").select("s").distinct(), "s", positives_per_bucket)
    cells = ranks.with_bucket(cells, "s", bounds, "bucket").withColumn("bucket", F.col("bucket").cast("int"))
    per = cells.groupBy("bucket", "step").agg(F.sum("n_pos").alias("n_pos"), F.sum("n_all").alias("n_all"))
    # every labelled step in every bucket, with what lies in the buckets above
    grid = cells.select("step").distinct().withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(len(bounds)))))
    higher = Window.partitionBy("step").orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = grid.join(per, ["bucket", "step"], "left").select(
        F.col("bucket").alias("below"), F.col("step").alias("at"), *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"over_{c}") for c in ("n_pos", "n_all")])
    parts = cells.groupBy("bucket").cogroup(above.groupBy("below")).applyInPandas(
        _bucket_precision(window), "window_end_step long, gained double, positives long, rows long")
    total = parts.groupBy("window_end_step").agg(*[F.sum(c).alias(c) for c in ("gained", "positives", "rows")])
    both = (F.col("positives") > 0) & (F.col("rows") > F.col("positives"))
    return total.select("window_end_step", F.when(both, F.col("gained") / F.col("positives")).alias("average_precision"))


def _bucket_precision(window: int, rows_at_once: int = 64):
    """A bucket's share of every window: sum of positives times precision at their scores, positives, rows."""
    def run(cells: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        above = above.sort_values("at")
        steps = above["at"].to_numpy()
        first = np.searchsorted(steps, steps - window + 1)

        def in_windows(per_step: np.ndarray) -> np.ndarray:
            run = np.concatenate([np.zeros((len(per_step), 1), np.int64), np.cumsum(per_step, axis=1)], axis=1)
            return run[:, 1:] - run[:, first]

        over_pos, over_all = (in_windows(above[f"over_{c}"].to_numpy(dtype=np.int64)[None, :])[0] for c in ("n_pos", "n_all"))
        gained = np.zeros(len(steps))
        own_pos, own_all = (np.zeros(len(steps), np.int64) for _ in range(2))
        if len(cells):
            s, pos, every = cells["s"].to_numpy(), cells["n_pos"].to_numpy(dtype=np.int64), cells["n_all"].to_numpy(dtype=np.int64)
            at = np.searchsorted(steps, cells["step"].to_numpy())
            # scores of positives, falling; a cell counts from the first of them that is not above it
            marks = np.unique(s[pos > 0])[::-1]
            level = np.searchsorted(-marks, -s, side="left")
            order = np.argsort(level, kind="stable")
            for lo in range(0, len(marks), rows_at_once):
                hi = min(lo + rows_at_once, len(marks))
                here = order[np.searchsorted(level[order], lo) : np.searchsorted(level[order], hi)]
                grid = np.zeros((2, hi - lo, len(steps)), np.int64)
                np.add.at(grid[0], (level[here] - lo, at[here]), pos[here])
                np.add.at(grid[1], (level[here] - lo, at[here]), every[here])
                new_pos, new_all = in_windows(grid[0]), in_windows(grid[1])
                cum_pos, cum_all = own_pos + np.cumsum(new_pos, axis=0), own_all + np.cumsum(new_all, axis=0)
                gained += (new_pos * ((over_pos + cum_pos) / np.maximum(over_all + cum_all, 1))).sum(axis=0)
                own_pos, own_all = cum_pos[-1], cum_all[-1]
            rest = order[np.searchsorted(level[order], len(marks)) :]
            left = np.zeros((1, len(steps)), np.int64)
            np.add.at(left[0], at[rest], every[rest])
            own_all = own_all + in_windows(left)[0]
        return pd.DataFrame({"window_end_step": steps, "gained": gained, "positives": own_pos, "rows": own_all})

    return run


def labelled_screen(current: DataFrame, target: str = "target") -> DataFrame:
    """MN9: labelled rows, class counts and whether both classes are present."""
    return current.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(target).alias("labelled_rows"),
        F.sum((F.col(target) == 1).cast("long")).alias("n_fraud"),
        F.sum((F.col(target) == 0).cast("long")).alias("n_legit"),
    ).na.fill(0, ["n_fraud", "n_legit"]).withColumn("classes_sufficient", (F.col("n_fraud") > 0) & (F.col("n_legit") > 0))


def triggers(drift: DataFrame, rolling: DataFrame, baseline_precision: float, baseline_recall: float,
             drift_fraction: float = 0.30, precision_multiplier: float = 0.70, recall_drop: float = 0.15) -> DataFrame:
    """MN7: drift-fraction, precision-drop and recall-drop triggers -> should_retrain.

    Comparisons are strict; without labelled performance the two performance
    triggers stay inactive; a missing value never breaches.
    """
    d = drift.agg(F.coalesce(F.avg(F.col("drifted").cast("double")), F.lit(0.0)).alias("drift_fraction"))
    last = rolling.agg(F.max_by(F.struct("precision", "recall"), F.col("window_end_step")).alias("l"),
                       (F.count(F.lit(1)) > 0).alias("has_labelled_performance"))
    x = one_row(d, last)
    p_thr, r_thr = baseline_precision * precision_multiplier, baseline_recall - recall_drop
    lp, lr = F.col("l.precision"), F.col("l.recall")
    out = x.select(
        "drift_fraction", F.lit(drift_fraction).alias("drift_threshold"),
        (F.col("drift_fraction") > drift_fraction).alias("drift_breached"),
        lp.alias("latest_precision"), F.lit(p_thr).alias("precision_threshold"),
        F.coalesce(F.col("has_labelled_performance") & (lp < p_thr), F.lit(False)).alias("precision_breached"),
        lr.alias("latest_recall"), F.lit(r_thr).alias("recall_threshold"),
        F.coalesce(F.col("has_labelled_performance") & (lr < r_thr), F.lit(False)).alias("recall_breached"),
        "has_labelled_performance",
    )
    return out.withColumn("should_retrain", F.col("drift_breached") | F.col("precision_breached") | F.col("recall_breached"))
