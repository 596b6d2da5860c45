"""The scale paths (many range buckets, hot-key split) give the same answers as SQL.

Small test data normally takes the single-bucket / no-hot-key paths; these
settings force the paths a large cluster takes.
"""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare

QUERIES = ["age_deciles", "amount_describe_by_class", "amount_percentiles", "review_budget", "dest_velocity",
           "dest_prior_amount", "average_precision", "roc_auc", "drift_ks", "robust_stats", "stratified_split",
           "undersample", "decisions", "rolling_ap", "event_drift", "event_rolling", "sample_rows", "dashboard_sample",
           "stratified_cap", "amount_value_deciles"]


@pytest.fixture
def forced_scale_paths(spark, monkeypatch):
    from ledgerlens.operators import prep

    monkeypatch.setattr(prep, "HASH_BITS", 2)
    spark.conf.set("spark.ledgerlens.ranks.rowsPerBucket", "23")
    spark.conf.set("spark.ledgerlens.velocity.hotKeyRows", "5")
    yield
    spark.conf.unset("spark.ledgerlens.ranks.rowsPerBucket")
    spark.conf.unset("spark.ledgerlens.velocity.hotKeyRows")


@pytest.mark.parametrize("name", QUERIES)
def test_forced_scale_path_matches_oracle(spark, duck_small, forced_scale_paths, name):
    ok, msg = compare(E.queries()[name](spark, SF_SMALL), E.oracle_sql()[name], duck_small)
    assert ok, msg


def _odd_requests(spark):
    """Rows with NULL steps, a NULL key, string ids and busy (key, step) cells."""
    rows = []
    for i in range(120):
        key = [None, "C1", "C1", "C2"][i % 4]
        step = None if i % 11 == 0 else (i * 7) % 5 + 1
        rows.append((f"txn_{(i * 37) % 120:04d}", key, step, float(i)))
    return spark.createDataFrame(rows, "tid string, nameDest string, step long, amount double").repartition(4)


@pytest.mark.parametrize("amount", [None, "amount"])
def test_hot_and_cold_velocity_agree_on_odd_rows(spark, forced_scale_paths, amount):
    from ledgerlens.operators.features import causal_velocity

    df = _odd_requests(spark)
    run = lambda hot: causal_velocity(df, "nameDest", "d", id_col="tid", amount_col=amount, hot_threshold=hot)
    cold, hot = run(10**9), run(5)
    assert cold.columns == hot.columns or set(cold.columns) == set(hot.columns)
    a, b = (sorted(map(repr, x.select(*cold.columns).collect())) for x in (cold, hot))
    assert len(a) == 120 and a == b
