"""Splits, scaling, resampling and feature selection.

Scalars that parameterise a later plan (a split cut, scaler statistics, a
sample size) are computed by one bounded aggregate and passed as literals.
Row selection "at random" is a repeatable hash order on the row id: counts of
hash ranges decide nearly all rows, so that no class (the majority class holds
nearly all rows) is ever sorted.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exprs import one_row, pct
from . import ranks


def md5_order(seed: int, id_col: str = "txn_id") -> Column:
    """Repeatable random order key: first 15 hex digits of md5(seed:id) as a long."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def step_cut(df: DataFrame, q: float, step_col: str = "step") -> float:
    """Exact interpolated quantile of the step column in one aggregate.

    `percentile` keeps a value -> count map per group; the step domain is the
    hours of the horizon, so that map stays small at any row count. Use
    `ranks.exact_quantiles` for high-cardinality columns.
    """
    v = df.agg(F.percentile(F.col(step_col), F.lit(q)).alias("q")).first()["q"]
    if v is None:
        raise ValueError("cannot split an empty frame")
    return float(v)


def temporal_split(df: DataFrame, q: float = 0.8, step_col: str = "step") -> tuple[DataFrame, DataFrame, float]:
    """train = step <= cut, test = step > cut, cut = q-quantile of step.

    For an integral step column the bound is the integer floor(cut) (same
    rows), so the range filter keeps the column's type and is pushed to the scan.
    """
    from pyspark.sql.types import IntegralType

    cut = step_cut(df, q, step_col)
    bound = F.lit(int(math.floor(cut))) if isinstance(df.schema[step_col].dataType, IntegralType) else F.lit(cut)
    return df.where(F.col(step_col) <= bound), df.where(F.col(step_col) > bound), cut


def fold_summary(folds: dict[str, DataFrame], label: str = S.LABEL) -> DataFrame:
    """Rows, fraud rows and fraud rate per named fold."""
    out = None
    for name, d in folds.items():
        a = d.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("fraud_rows"),
                  F.round(pct(F.avg(label)), 6).alias("fraud_rate_pct")).select(F.lit(name).alias("split"), "*")
        out = a if out is None else out.unionByName(a)
    return out


def prevalence_ratio(train: DataFrame, test: DataFrame, label: str = S.LABEL) -> DataFrame:
    """test/train prevalence ratio with the 1.5 / 0.67 alert."""
    tr = train.agg(F.avg(label).alias("train_rate"))
    te = test.agg(F.avg(label).alias("test_rate"))
    r = one_row(tr, te).select(
        F.round(F.col("test_rate") / F.greatest(F.col("train_rate"), F.lit(1e-9)), 6).alias("ratio"))
    return r.withColumn("alert", (F.col("ratio") > 1.5) | (F.col("ratio") < 0.67))


def class_counts(df: DataFrame, label: str = S.LABEL) -> dict[int, int]:
    return {int(r[0]): int(r[1]) for r in df.groupBy(label).count().collect()}


def hash_positions(df: DataFrame, seed: int, group_cols: list[str], id_col: str = "txn_id", out: str = "pos") -> DataFrame:
    """Per-group position in a repeatable random order (distributed, skew-safe)."""
    keyed = df.withColumn("__h", md5_order(seed, id_col))
    return ranks.row_positions(keyed, group_cols, "__h", id_col, out=out).drop("__h")


# the hash range is counted in 2 ** HASH_BITS equal buckets
HASH_BITS = 12


def first_by_hash(df: DataFrame, quota: Callable[[dict[tuple, int]], dict[tuple, int]], seed: int, group_cols: list[str] | None = None,
                  id_col: str = "txn_id", out: str = "taken") -> DataFrame:
    """Add `out`: whether the row is among the first rows of its group in hash order.

    `quota` gets the size of each group and returns how many rows each gives
    (none where it names no number). One job counts the rows of every hash
    bucket, so the bucket in which a group's quota ends is known; rows in the
    buckets before and after it are decided by their hash alone, and only the
    rows of that bucket are ranked (ties by id). The groups are few (classes,
    sides of a split): the counts are 4096 numbers for each.
    """
    groups = group_cols or []
    h = F.coalesce(md5_order(seed, id_col), F.lit(-1))  # rows without an id come first
    bucket = F.shiftright(h, 60 - HASH_BITS)
    sizes: dict[tuple, int] = {}
    cells: dict[tuple, list[tuple[int, int]]] = {}
    for *g, b, n in df.groupBy(*groups, bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__n")).collect():
        sizes[tuple(g)] = sizes.get(tuple(g), 0) + n
        cells.setdefault(tuple(g), []).append((b, n))
    sure, edge, left, most = F.lit(False), F.lit(False), F.lit(None).cast("long"), 0
    for g, want in quota(sizes).items():
        mine = F.lit(True)
        for c, v in zip(groups, g):
            mine = mine & F.col(c).eqNullSafe(F.lit(v))
        for b, n in sorted(cells.get(g, [])):
            if want < n:
                sure = sure | (mine & (bucket < b))
                if want > 0:
                    edge, left, most = edge | (mine & (bucket == b)), F.when(mine, F.lit(want)).otherwise(left), max(most, n)
                break
            want -= n
        else:
            sure = sure | mine
    if most == 0:
        return df.withColumn(out, sure)
    rows = df.where(edge).withColumn("__h", h)
    if most <= ranks.rows_per_bucket_for(df):
        ranked = rows.withColumn("__pos", F.row_number().over(Window.partitionBy(*groups).orderBy("__h", id_col)) - 1)
    else:
        ranked = ranks.row_positions(rows, groups, "__h", id_col, out="__pos")
    return df.where(~edge).withColumn(out, sure).unionByName(ranked.withColumn(out, F.col("__pos") < left).drop("__h", "__pos"))


def stratified_split(df: DataFrame, test_frac: float = 0.25, seed: int = 42, label: str = S.LABEL,
                     id_col: str = "txn_id") -> tuple[DataFrame, DataFrame]:
    """Per class, the first round(test_frac * n_c) rows of a hash order go to test; rows without a label to neither."""
    p = first_by_hash(df.where(F.col(label).isNotNull()), lambda n: {g: math.floor(k * test_frac + 0.5) for g, k in n.items()},
                      seed, [label], id_col, "__test")
    return p.where(~F.col("__test")).drop("__test"), p.where(F.col("__test")).drop("__test")


def inner_split(train: DataFrame, val_frac: float = 0.15, seed: int = 42, label: str = S.LABEL,
                step_col: str = "step_raw") -> tuple[DataFrame, DataFrame, str]:
    """Temporal 85/15 on step; fall back to stratified random when a side lacks a class."""
    tr, va, cut = temporal_split(train, 1 - val_frac, step_col)
    from pyspark.sql.types import IntegralType

    integral = isinstance(train.schema[step_col].dataType, IntegralType)
    early = F.col(step_col) <= (F.lit(int(math.floor(cut))) if integral else F.lit(cut))
    k = train.agg(F.count_distinct(F.when(early, F.col(label))).alias("a"),
                  F.count_distinct(F.when(~early, F.col(label))).alias("b")).first()
    if k["a"] == 2 and k["b"] == 2:
        return tr, va, "by_time"
    tr, va = stratified_split(train, val_frac, seed, label)
    return tr, va, "by_class"


def stratified_cap(df: DataFrame, max_rows: int, seed: int = 42, label: str = S.LABEL, id_col: str = "txn_id") -> DataFrame:
    """T4: keep frac = max_rows / n of every class (round(frac * n_c) rows in hash order)."""
    if not max_rows:
        return df

    def quota(n: dict[tuple, int]) -> dict[tuple, int]:
        share = min(1.0, max_rows / max(1, sum(n.values())))
        return {g: math.floor(k * share + 0.5) for g, k in n.items() if share == 1.0 or g != (None,)}

    return first_by_hash(df, quota, seed, [label], id_col, "__kept").where("__kept").drop("__kept")


def reference_current(df: DataFrame, max_step: int = S.REFERENCE_MAX_STEP, step_col: str = "step") -> tuple[DataFrame, DataFrame]:
    """T5: reference = step <= max_step, current = later; fail if either side is empty."""
    ref = df.where(F.col(step_col) <= max_step)
    cur = df.where(F.col(step_col) > max_step)
    sides = df.agg(F.count_if(F.col(step_col) <= max_step).alias("r"), F.count_if(F.col(step_col) > max_step).alias("c")).first()
    if sides["r"] == 0 or sides["c"] == 0:
        raise ValueError(f"no rows on one side of step {max_step}: {sides.asDict()}")
    return ref, cur


def robust_stats(train: DataFrame, cols: list[str] = S.CONTINUOUS_FEATURES) -> DataFrame:
    """Median and IQR (25-75, linear interpolation) per column; IQR 0 -> scale 1."""
    q = ranks.exact_quantiles(train, [], cols, [0.25, 0.5, 0.75])
    w = q.groupBy("feature").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value")).toDF("feature", "q25", "q50", "q75")
    iqr = F.col("q75") - F.col("q25")
    return w.select("feature", F.col("q50").alias("center"), F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def stats_dict(stats: DataFrame, a: str, b: str) -> dict[str, tuple[float, float]]:
    """Collect per-feature scaler statistics (one row per feature: a bounded result)."""
    return {r["feature"]: (float(r[a]), float(r[b])) for r in stats.collect()}


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - center) / scale with persisted statistics as literals."""
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items() if c in df.columns})


def standard_stats(train: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population std per column (std 0 -> scale 1)."""
    row = train.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("d")) for c in cols])).alias("x"))
    return long.select("x.feature", F.col("x.d.m").alias("mean"),
                       F.when(F.col("x.d.s") == 0, F.lit(1.0)).otherwise(F.col("x.d.s")).alias("std"))


def class_weights(train: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Balanced weights n / (2 * n_c), rounded to 4 places."""
    g = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    # window over the per-class table (two rows)
    n = F.sum("n_c").over(Window.partitionBy())
    return g.select(label, "n_c", F.round(n / (F.lit(2.0) * F.col("n_c")), 4).alias("weight"))


def scale_pos_weight(train: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Neg / max(pos, 1)."""
    return train.agg(
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("long").alias("neg"),
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
    ).withColumn("scale_pos_weight", F.round(F.col("neg") / F.greatest(F.col("pos"), F.lit(1)), 6))


def undersample(df: DataFrame, ratio: float = 1.0, seed: int = 42, label: str = S.LABEL, id_col: str = "txn_id") -> DataFrame:
    """Keep every minority row and the first int(n_min / ratio) majority rows in hash order."""
    def quota(n: dict[tuple, int]) -> dict[tuple, int]:
        sizes = {c: n.get((c,), 0) for c in (0, 1)}
        rare = 1 if sizes[1] <= sizes[0] else 0
        return {(rare,): sizes[rare], (1 - rare,): int(sizes[rare] / ratio)}

    return first_by_hash(df, quota, seed, [label], id_col, "__kept").where("__kept").drop("__kept")


def variance_filter(train: DataFrame, cols: list[str], threshold: float = 1e-6) -> DataFrame:
    """Population variance per column and whether it falls at or under the threshold."""
    row = train.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in cols])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("idx"), F.col(c).alias("variance"))
                                           for i, c in enumerate(cols)])).alias("x")).select("x.*")
    return long.withColumn("dropped", F.col("variance") <= threshold)


def correlation_prune(train: DataFrame, cols: list[str], threshold: float = 0.95) -> list[tuple[str, float | None, bool]]:
    """Drop the later column of any pair with |corr| > threshold (upper triangle).

    The k x k matrix comes from one distributed pass (`Correlation.corr`); the
    triangle scan is over k columns on the driver. Returns, per column, the
    largest |corr| with an earlier column and whether it is dropped.
    """
    vec = VectorAssembler(inputCols=cols, outputCol="__v", handleInvalid="keep").transform(train.select(*cols))
    m = Correlation.corr(vec, "__v").first()[0].toArray()
    out = []
    for j, c in enumerate(cols):
        vals = [abs(m[i][j]) for i in range(j) if not math.isnan(m[i][j])]
        best = max(vals) if vals else None
        out.append((c, None if best is None else float(best), bool(best is not None and best > threshold)))
    return out


def mutual_information(train: DataFrame, cols: list[str], bins: int = 10, label: str = S.LABEL,
                       id_col: str = "txn_id") -> DataFrame:
    """T17 (re-aimed): MI between each column's rank-quantile bin and the label, in nats.

    Each column is cut into `bins` equal-count bins by rank (ties by id), then
    MI = sum p(b,y) ln(p(b,y) / (p(b) p(y))) from one grouped count.
    """
    from .explore import decile_of_rank

    long = train.select(id_col, label, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("s")).select(id_col, label, "s.feature", "s.value").where(F.col("value").isNotNull())
    pos = ranks.row_positions(long, ["feature"], "value", id_col)
    n = long.groupBy("feature").agg(F.count(F.lit(1)).alias("__n"))
    if bins != 10:
        raise ValueError("rank bins are deciles")
    b = pos.join(F.broadcast(n), "feature").withColumn("bin", decile_of_rank(F.col("pos"), F.col("__n")))
    cell = b.groupBy("feature", "bin", label).agg(F.count(F.lit(1)).alias("c"), F.first("__n").alias("n"))
    wb = Window.partitionBy("feature", "bin")
    wy = Window.partitionBy("feature", label)
    cell = cell.withColumns({"pb": F.sum("c").over(wb) / F.col("n"), "py": F.sum("c").over(wy) / F.col("n"), "pj": F.col("c") / F.col("n")})
    return cell.groupBy("feature").agg(F.round(F.sum(F.col("pj") * F.log(F.col("pj") / (F.col("pb") * F.col("py")))), 6).alias("mutual_info"))


def sample_rows(df: DataFrame, n: int, seed: int = 42, id_col: str = "txn_id", group_cols: list[str] | None = None) -> DataFrame:
    """S11/MN10: exactly min(n, rows) rows per group, repeatable (first n of a hash order).

    A sampling operator: the row cap is the feature. The groups are few.
    """
    kept = first_by_hash(df, lambda sizes: {g: n for g in sizes}, seed, group_cols, id_col, "__kept")
    return kept.where("__kept").drop("__kept")


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """S11 (approximate size): Bernoulli sample with a fixed seed."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
