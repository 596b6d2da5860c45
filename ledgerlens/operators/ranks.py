"""Distributed ranks, prefix sums and exact quantiles.

A window without `partitionBy` moves every row into one task, so ordered
statistics over a whole fact table (ranks, running sums, exact quantiles,
area under curves) are built here from three scalable steps:

1. range-bucket the ordering key with boundaries from approximate quantiles
   (`percentile_approx`, computed in the same job as the row count; a bounded
   list on the driver); equal keys always share a bucket, so the result is
   exact whatever the quality of the boundaries;
2. per-bucket totals -> exclusive running offsets over the small bucket table;
3. a window partitioned by (group, bucket) adds the within-bucket running sum.

Quantiles (`quantile_values`) need no rank of all rows: approximate quantiles
enclose every wanted rank, counts prove it, and only values inside are ordered.

Hot keys: per-row positions (`row_positions`) order by (value, id) and split
each value further by id-range buckets, so a value holding a third of all rows
is spread over many tasks instead of one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


# Rows per bucket targeted by the within-bucket windows; bounds task size.
ROWS_PER_BUCKET = 2_000_000


def n_buckets(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return int(max(1, math.ceil(n_rows / max(1, rows_per_bucket))))


PROBE_BUCKETS = 1024


def rows_per_bucket_for(df: DataFrame) -> int:
    """Target rows per bucket: `spark.ledgerlens.ranks.rowsPerBucket` if set, else ROWS_PER_BUCKET."""
    from ..session import conf_int

    return conf_int(df.sparkSession, "spark.ledgerlens.ranks.rowsPerBucket", ROWS_PER_BUCKET)


def count_and_bounds(df: DataFrame, column: str, rows_per_bucket: int | None = None) -> tuple[int, list[float]]:
    """Row count and range boundaries for about n / rows_per_bucket buckets.

    One job computes the count together with 1023 approximate quantiles; only
    inputs needing more than 1024 buckets pay a second, finer quantile job.
    """
    rows_per_bucket = rows_per_bucket or rows_per_bucket_for(df)
    probs = [i / PROBE_BUCKETS for i in range(1, PROBE_BUCKETS)]
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.percentile_approx(F.col(column).cast("double"), probs, 4 * PROBE_BUCKETS).alias("q")).first()
    n = int(row["n"])
    want = n_buckets(n, rows_per_bucket)
    if want <= 1 or not row["q"]:
        return n, []
    if want > PROBE_BUCKETS:
        return n, range_bounds(df, column, want)
    step = PROBE_BUCKETS / want
    picked = [row["q"][int(round(i * step)) - 1] for i in range(1, want)]
    return n, sorted({float(x) for x in picked if x is not None and not math.isnan(x)})


def range_bounds(df: DataFrame, column: str, buckets: int) -> list[float]:
    """Sorted distinct split points giving about `buckets` equal-count ranges."""
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    got = df.approxQuantile(column, probs, 1.0 / (4 * buckets))
    return sorted({float(x) for x in got if x is not None and not math.isnan(x)})


def with_bucket(df: DataFrame, column: str, bounds: list[float], out: str) -> DataFrame:
    """Add `out` = index of the left-closed range of `column` (binary search, JVM side)."""
    if not bounds:
        return df.withColumn(out, F.lit(0.0))
    splits = [-math.inf] + bounds + [math.inf]
    tmp = f"__{out}_in"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    # NULL sorts first in a window, so it belongs to the first bucket
    return b.transform(df.withColumn(tmp, F.coalesce(F.col(column).cast("double"), F.lit(-1.7e308)))).drop(tmp)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on `on` in which NULL equals NULL; columns of `left`, then the others of `right`."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(r, cond).drop(*[f"__r_{c}" for c in on])


def order_number(df: DataFrame, column: str) -> Column:
    """A number that never falls as the column rises, for range buckets: the column itself, or 6 bytes of a text.

    Texts are taken from behind the prefix that all of them share (one pass for
    the smallest and largest value), so ids like `txn_000123` spread over the buckets.
    """
    if not isinstance(df.schema[column].dataType, StringType):
        return F.col(column).cast("double")
    row = df.agg(F.min(column).alias("a"), F.max(column).alias("b")).first()
    a, b = ((row[k] or "").encode() for k in "ab")
    shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    part = F.hex(F.substring(F.col(column).cast("binary"), shared + 1, 6))
    return F.conv(F.rpad(part, 12, "0"), 16, 10).cast("double")


def cumulative(
    agg: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    measures: list[str],
    prefix: str = "cum_",
    inclusive: bool = False,
    n_rows: int | None = None,
    totals: bool = False,
) -> DataFrame:
    """Running sums of `measures` per group in `order_cols` order (ascending).

    `agg` must have one row per (group_cols, order_cols) key. Adds
    `{prefix}{m}` = sum of m over earlier keys (or up to and including this
    key when `inclusive`), and with `totals` also `{prefix}total_{m}` = the
    group's total (taken from the small bucket table, no extra pass).
    Bucketing is on `order_cols[0]`.
    """
    if not group_cols:
        res = cumulative(agg.withColumn("__g", F.lit(0)), ["__g"], order_cols, measures, prefix, inclusive, n_rows, totals)
        return res.drop("__g")
    key = order_cols[0]
    if n_rows is None:
        n_rows, bounds = count_and_bounds(agg, key)
    else:
        bounds = range_bounds(agg, key, n_buckets(n_rows, rows_per_bucket_for(agg)))
    if not bounds:
        # at most ROWS_PER_BUCKET rows per group: one window per group is bounded
        frame_end = 0 if inclusive else -1
        w = Window.partitionBy(*group_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
        whole = Window.partitionBy(*group_cols)
        tot = [F.sum(m).over(whole).alias(f"{prefix}total_{m}") for m in measures] if totals else []
        return agg.select(*agg.columns, *[F.coalesce(F.sum(m).over(w), F.lit(0)).alias(f"{prefix}{m}") for m in measures], *tot)
    b = "__bkt"
    x = with_bucket(agg, key, bounds, b)
    totals_t = x.groupBy(*group_cols, b).agg(*[F.sum(m).alias(f"__tot_{m}") for m in measures])
    wb = Window.partitionBy(*group_cols).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy(*group_cols)
    offsets = totals_t.select(
        *group_cols, b, *[F.coalesce(F.sum(f"__tot_{m}").over(wb), F.lit(0)).alias(f"__off_{m}") for m in measures],
        *[F.sum(f"__tot_{m}").over(wg).alias(f"{prefix}total_{m}") for m in measures],
    )
    frame_end = 0 if inclusive else -1
    w = Window.partitionBy(*group_cols, b).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
    x = null_safe_join(x, offsets, [*group_cols, b])
    return x.select(
        *[c for c in agg.columns],
        *[(F.col(f"__off_{m}") + F.coalesce(F.sum(m).over(w), F.lit(0))).alias(f"{prefix}{m}") for m in measures],
        *([F.col(f"{prefix}total_{m}") for m in measures] if totals else []),
    )


def row_positions(
    df: DataFrame,
    group_cols: list[str],
    value_col: str,
    id_col: str,
    descending: bool = False,
    out: str = "pos",
    sums: dict[str, str] | None = None,
) -> DataFrame:
    """0-based position of every row in (value, id) order within its group.

    Ties on value are broken by `id_col` ascending; `descending` orders values
    from high to low. Equivalent to `row_number() over (partition by group
    order by value, id) - 1` but never puts a whole group, or a whole value of
    one, into one task. `sums` {column: name} adds the sums over the rows before.
    NULL groups, values and ids are kept, in the window's order.
    """
    sums = sums or {}
    if not group_cols:
        return row_positions(df.withColumn("__g", F.lit(0)), ["__g"], value_col, id_col, descending, out, sums).drop("__g")
    sk = "__sk"
    ib = "__ib"
    base = df.withColumn(sk, -F.col(value_col) if descending else F.col(value_col))
    base = base.withColumn("__idn", order_number(base, id_col))
    _, id_bounds = count_and_bounds(base, "__idn", max(1, rows_per_bucket_for(base) // 4))
    base = with_bucket(base, "__idn", id_bounds, ib).drop("__idn")
    totals = {f"__s_{i}": c for i, c in enumerate(sums)}
    cells = base.groupBy(*group_cols, sk, ib).agg(F.count(F.lit(1)).alias("__c"), *[F.sum(c).alias(s) for s, c in totals.items()])
    cells = cumulative(cells, group_cols, [sk, ib], ["__c", *totals], prefix="__cum").drop("__c", *totals)
    w = Window.partitionBy(*group_cols, sk, ib).orderBy(id_col)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    res = null_safe_join(base, cells, [*group_cols, sk, ib])
    res = res.withColumn(out, (F.col("__cum__c") + F.row_number().over(w) - 1).cast("long"))
    for s, c in totals.items():
        res = res.withColumn(sums[c], F.col(f"__cum{s}") + F.coalesce(F.sum(c).over(before), F.lit(0)))
    return res.drop(sk, ib, "__cum__c", *[f"__cum{s}" for s in totals])


# relative rank error asked of approximate quantiles; an exact quantile is searched within twice this share of its rank
SKETCH_ACCURACY = 10_000


def quantile_values(df: DataFrame, cols: list[str], probs: list[float], group_cols: list[str] | None = None) -> dict[tuple, float]:
    """Exact linear-interpolated quantiles of many columns: {(group values, column, p): value}.

    Selection by refinement, three passes for any number of columns and no
    shuffle of the rows:

    1. approximate quantiles on both sides of every wanted rank enclose it;
    2. one aggregate counts the rows below and inside each enclosure, which
       proves that the rank lies inside (else the enclosure is widened to the
       whole column);
    3. the few values inside enclosures (about 0.06 % of the rows each) are
       counted and cumulated. An enclosure of one value needs no third pass.

    NULL values do not count, NaN is the largest value, a group without values
    has no entry. The groups are few (classes); the result is a bounded list.
    """
    groups = group_cols or []
    num = df.select(*groups, *[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in cols])
    slack = 2.0 / SKETCH_ACCURACY
    lows, highs = [max(0.0, p - slack) for p in probs], [min(1.0, p + slack) for p in probs]
    sketch = num.groupBy(*groups).agg(*[
        F.struct(F.count(c).alias("n"), F.percentile_approx(c, lows + highs, SKETCH_ACCURACY).alias("q")).alias(f"__{i}")
        for i, c in enumerate(cols)]).collect()
    todo = [dict(group=tuple(r[g] for g in groups), col=c, p=float(p), n=r[f"__{i}"]["n"],
                 lo=r[f"__{i}"]["q"][j] if p - slack > 0 else None,
                 hi=r[f"__{i}"]["q"][len(probs) + j] if p + slack < 1 else None)
            for r in sketch for i, c in enumerate(cols) for j, p in enumerate(probs) if r[f"__{i}"]["n"]]
    if not todo:
        return {}

    def of_group(t: dict, cond: Column) -> Column:
        for g, v in zip(groups, t["group"]):
            cond = F.col(g).eqNullSafe(F.lit(v)) & cond
        return cond

    def inside(t: dict) -> Column:
        x, lo, hi = F.col(t["col"]), t["lo"], t["hi"]
        if lo is not None and hi is not None:
            return of_group(t, x.between(lo, hi))
        return of_group(t, x >= lo if lo is not None else x <= hi if hi is not None else x.isNotNull())

    ends = {}  # rows under the lower end, rows up to the upper end
    for k, t in enumerate(todo):
        if t["lo"] is not None:
            ends[f"a{k}"] = F.count_if(of_group(t, F.col(t["col"]) < t["lo"]))
        if t["hi"] is not None:
            ends[f"b{k}"] = F.count_if(of_group(t, F.col(t["col"]) <= t["hi"]))
    counts = num.agg(*[c.alias(name) for name, c in ends.items()]).first().asDict() if ends else {}
    found: dict[tuple, float] = {}
    wide = []
    for k, t in enumerate(todo):
        t["rank"] = math.floor((t["n"] - 1) * t["p"])
        t["next"] = min(t["rank"] + 1, t["n"] - 1)
        t["below"] = counts.get(f"a{k}", 0)
        t["inside"] = counts.get(f"b{k}", t["n"]) - t["below"]
        if not (t["below"] <= t["rank"] and t["next"] < t["below"] + t["inside"]):
            t.update(lo=None, hi=None, below=0, inside=t["n"])
        if t["lo"] is not None and t["lo"] == t["hi"]:
            found[(t["group"], t["col"], t["p"])] = t["lo"]
        else:
            wide.append(t)
    if not wide:
        return found
    conds = [inside(t) for t in wide]
    entries = F.array(*[F.when(c, F.struct(F.lit(k).alias("k"), F.col(t["col"]).alias("v"))) for k, (c, t) in enumerate(zip(conds, wide))])
    values = (num.where(reduce(Column.__or__, conds)).select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).select("e.k", "e.v")
              .groupBy("k", "v").agg(F.count(F.lit(1)).alias("c")))
    placed = cumulative(values, ["k"], ["v"], ["c"], prefix="before_", n_rows=sum(t["inside"] for t in wide))

    def at(name: str) -> Column:
        rank = F.array(*[F.lit(t[name] - t["below"]) for t in wide])[F.col("k")]
        return F.max(F.when((F.col("before_c") <= rank) & (rank < F.col("before_c") + F.col("c")), F.col("v")))

    for r in placed.groupBy("k").agg(at("rank").alias("a"), at("next").alias("b")).collect():
        t = wide[r["k"]]
        part = (t["n"] - 1) * t["p"] - t["rank"]
        found[(t["group"], t["col"], t["p"])] = r["a"] + (r["b"] - r["a"]) * part if part else r["a"]
    return found


def exact_quantiles(df: DataFrame, group_cols: list[str], value_cols: list[str], probs: list[float]) -> DataFrame:
    """`quantile_values` as a table: one row (group columns, feature, p, value) per group, column and p."""
    got = quantile_values(df, value_cols, probs, group_cols)
    schema = StructType([df.schema[g] for g in group_cols] + [StructField("feature", StringType()), StructField("p", DoubleType()),
                                                             StructField("value", DoubleType())])
    return df.sparkSession.createDataFrame([(*g, c, p, v) for (g, c, p), v in got.items()], schema)


def quantile_row(df: DataFrame, value_col: str, probs: list[float]) -> list[float]:
    """Exact quantiles of a column as Python floats (a bounded result)."""
    got = quantile_values(df, [value_col], probs)
    return [got.get(((), value_col, float(p))) for p in probs]
