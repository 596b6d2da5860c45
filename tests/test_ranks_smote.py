"""Distributed ranks and exact SMOTE neighbours against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ranks
from ledgerlens.operators.smote import nearest_neighbours, smote


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 16)


def test_positions_with_hot_value(spark, small_buckets):
    # a third of the rows share one value
    vals = [5] * 100 + list(range(200))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, v double")
    got = {r.id: r.pos for r in ranks.row_positions(df, [], "v", "id").collect()}
    order = sorted(range(len(vals)), key=lambda i: (vals[i], i))
    assert got == {i: p for p, i in enumerate(order)}


def test_exact_quantiles(spark, small_buckets):
    rng = np.random.default_rng(0)
    x = np.round(rng.exponential(10, 500), 1)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = ranks.quantile_row(df, "v", probs)
    assert got == pytest.approx(list(np.quantile(x, probs)), abs=1e-9)


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_quantiles_of_many_columns_by_group(spark, small_buckets, monkeypatch, accuracy):
    monkeypatch.setattr(ranks, "SKETCH_ACCURACY", accuracy)
    rng = np.random.default_rng(1)
    n = 3000
    x = pd.DataFrame({"g": rng.integers(0, 2, n), "a": rng.normal(size=n), "b": np.where(rng.random(n) < 0.7, 0.0, rng.integers(0, 9, n)),
                      "c": np.full(n, 4.0), "d": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n))})
    rows = [(None if i % 97 == 0 else int(r.g), float(r.a), float(r.b), float(r.c), None if np.isnan(r.d) else float(r.d), None)
            for i, r in enumerate(x.itertuples())]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, d double, e double").repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = ranks.quantile_values(df, list("abcde"), probs, ["g"])
    x["g"] = [r[0] for r in rows]
    exp = {((g,), c, p): np.quantile(part[c].dropna(), p)
           for g, part in ((0, x[x.g == 0]), (1, x[x.g == 1]), (None, x[x.g.isna()])) for c in "abcd" for p in probs}
    assert set(got) == set(exp)
    assert all(got[k] == pytest.approx(exp[k], abs=1e-12) for k in exp)


def test_quantiles_of_an_empty_table_and_of_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    assert ranks.quantile_row(df, "v", [0.0, 0.5]) == [1.0, 3.0]
    assert np.isnan(ranks.quantile_row(df, "v", [1.0])[0])
    assert ranks.quantile_row(df.where("v < 0"), "v", [0.5]) == [None]
    assert ranks.exact_quantiles(df.where("v < 0"), [], ["v"], [0.5]).count() == 0


@pytest.mark.parametrize("bits", [12, 3])
def test_first_rows_in_hash_order_equal_a_full_rank(spark, monkeypatch, bits):
    from ledgerlens.operators import prep as P

    monkeypatch.setattr(P, "HASH_BITS", bits)
    rows = [(None if i % 41 == 0 else i // 2, [0, 0, 0, 1, None][i % 5]) for i in range(900)]  # ids repeat or miss
    df = spark.createDataFrame(rows, "txn_id long, isFraud int").repartition(5)
    want = {(0,): 200, (1,): 0, (None,): 10**6}
    got = P.first_by_hash(df, lambda sizes: want, 7, ["isFraud"])
    full = P.hash_positions(df, 7, ["isFraud"])
    assert got.count() == 900
    key = lambda d: sorted(map(repr, d.select("txn_id", "isFraud").collect()))
    assert key(got.where("taken")) == key(full.where("isFraud is null or (isFraud = 0 and pos < 200)"))
    assert P.first_by_hash(df.where("false"), lambda sizes: want, 7, ["isFraud"]).count() == 0


def test_knn_is_exact(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(150, 4))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(X)], "id long, v array<double>")
    nn = nearest_neighbours(df, "id", "v", k=5, block_rows=32)
    got = {}
    for r in nn.collect():
        got.setdefault(r.id, []).append((r.rank, r.nn_id))
    d = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    for i in range(len(X)):
        exp = list(np.lexsort((np.arange(len(X)), d[i]))[:5])
        assert [n for _, n in sorted(got[i])] == exp


def _brute(X, ids, k):
    out = {}
    for i, x in enumerate(X):
        d = np.sqrt(((X - x) ** 2).sum(-1))
        d[i] = np.inf
        out[ids[i]] = [int(ids[j]) for j in np.lexsort((ids, d))[:k]]
    return out


def _found(nn):
    got = {}
    for r in nn.collect():
        got.setdefault(r.id, []).append((r.rank, r.nn_id))
    return {i: [n for _, n in sorted(x)] for i, x in got.items()}


def test_knn_with_copies_and_split_cells(spark, monkeypatch):
    from ledgerlens.operators import smote as SM

    monkeypatch.setattr(SM, "VISIT_ROWS", 50)
    rng = np.random.default_rng(3)
    # a third of the rows are one vector; grid points give many equal distances
    X = np.concatenate([np.tile([1.0, 2.0, 3.0], (100, 1)), rng.integers(0, 4, (200, 3)).astype(float)])
    ids = rng.permutation(len(X)) * 7
    df = spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, X)], "id long, v array<double>").repartition(4)
    assert _found(nearest_neighbours(df, "id", "v", k=5, block_rows=10, pivots=6)) == _brute(X, ids, 5)


def test_visits_leave_in_bounded_parts_without_vectors(spark, monkeypatch):
    from ledgerlens.operators import smote as SM

    monkeypatch.setattr(SM, "VISIT_ROWS", 40)
    monkeypatch.setattr(SM, "CHUNK", 500)
    rng = np.random.default_rng(9)
    X = rng.normal(size=(240, 9))  # far from any cluster: a point visits nearly every cell
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, v array<double>")
    placed, centres, regions = SM.in_regions(SM.distinct_points(df, "id", "v", 4), 16, 12)
    inside = placed.groupBy("region", "cell").applyInPandas(
        SM._inside(4), f"vid long, v array<double>, region long, cell long, r double, bound double, best array<{SM.PAIR}>").cache()
    visits = SM.visits_of(inside, centres, regions)
    assert visits.columns == ["vid", "bound", "region", "cell"]
    assert visits.count() == visits.distinct().count() > 10 * len(X)
    assert visits.join(inside, ["vid", "region", "cell"]).count() == 0
    assert _found(nearest_neighbours(df, "id", "v", k=3, block_rows=16, pivots=12)) == _brute(X, np.arange(len(X)), 3)


def test_knn_of_few_rows(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [5.0])], "id long, v array<double>")
    assert _found(nearest_neighbours(df, "id", "v", k=5)) == {1: [2, 3], 2: [1, 3], 3: [2, 1]}
    assert nearest_neighbours(df.limit(0), "id", "v").count() == 0


def test_knn_compares_few_pairs_of_fifty_thousand_rows(spark):
    from ledgerlens.operators import smote as SM

    n = 50_000
    rng = np.random.default_rng(11)
    # clusters in 12 dimensions, as scaled transactions form them
    X = rng.normal(size=(60, 12))[rng.integers(0, 60, n)] * 4 + rng.normal(size=(n, 12)) * rng.choice([0.05, 0.3], (n, 1))
    ids = np.arange(n)
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "v": list(X)}), "id long, v array<double>")
    points = SM.distinct_points(df, "id", "v", 6)
    placed, centres, regions = SM.in_regions(points, 2048)
    inside = placed.groupBy("region", "cell").applyInPandas(
        SM._inside(6), f"vid long, v array<double>, region long, cell long, r double, bound double, best array<{SM.PAIR}>")
    visits = SM.visits_of(inside.cache(), centres, regions)
    sizes = placed.groupBy("region", "cell").agg(F.count("*").alias("n"))
    compared = visits.join(sizes, ["region", "cell"]).agg(F.sum("n")).first()[0] + sizes.agg(F.sum(F.col("n") * F.col("n"))).first()[0]
    assert compared < 0.1 * n * n
    got = _found(nearest_neighbours(df, "id", "v", k=5))
    assert len(got) == n
    for i in rng.choice(n, 300, replace=False):
        d = np.sqrt(((X - X[i]) ** 2).sum(-1))
        d[i] = np.inf
        assert got[i] == list(np.lexsort((ids, d))[:5])


def test_smote_counts_and_convexity(spark):
    rng = np.random.default_rng(7)
    rows = [(i, float(a), float(b), int(i < 12)) for i, (a, b) in enumerate(rng.normal(size=(80, 2)))]
    df = spark.createDataFrame(rows, "txn_id long, f1 double, f2 double, isFraud int")
    out = smote(df, ["f1", "f2"], ratio=1.0)
    counts = {(r.isFraud, r.synthetic): r.n for r in out.groupBy("isFraud", "synthetic").agg(F.count("*").alias("n")).collect()}
    assert counts == {(0, 0): 68, (1, 0): 12, (1, 1): 56}
    mino = np.array([[a, b] for i, a, b, y in rows if y == 1])
    lo, hi = mino.min(0), mino.max(0)
    syn = np.array([[r.f1, r.f2] for r in out.where("synthetic = 1").collect()])
    assert ((syn >= lo - 1e-12) & (syn <= hi + 1e-12)).all()
