"""Sources and sinks: CSV base scan with projection, parquet / CSV sinks, feature usage, score fill."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens import schema as S
from ledgerlens.plans.ml import feature_usage
from ledgerlens.sources import events as EV
from ledgerlens.sources import tables as TB
from ledgerlens.sources.fixture import transactions


def test_csv_scan_with_schema_and_projection(spark, tmp_path):
    t = transactions(spark, SF_SMALL).select(*S.BASE_COLUMNS)
    path = str(tmp_path / "base_csv")
    t.write.option("header", True).csv(path)
    back = TB.read_base_csv(spark, path)
    assert back.schema == S.BASE_SCHEMA
    assert back.exceptAll(t).count() == 0 and t.exceptAll(back).count() == 0
    proj = TB.read_base_csv(spark, path, ["step", "amount", "isFraud"])
    assert proj.columns == ["step", "amount", "isFraud"] and proj.count() == t.count()


def test_parquet_and_result_sinks(spark, tmp_path):
    t = transactions(spark, SF_SMALL)
    p = str(tmp_path / "enriched")
    TB.write_parquet(t.select(*S.ENRICHED_COLUMNS), p, partition_by=["type"])
    back = TB.read_enriched(spark, p, ["type", "amount"])
    assert back.count() == t.count()
    assert back.where(F.col("type") == "TRANSFER").count() == t.where(F.col("type") == "TRANSFER").count()
    r = str(tmp_path / "result_csv")
    TB.write_result_csv(t.groupBy("type").count(), r)
    assert spark.read.option("header", True).csv(r).count() == 5


def test_feature_usage_table(spark):
    fu = {r.feature: r.used_for_training for r in feature_usage(spark, SF_SMALL).collect()}
    assert len(fu) == 48 and sum(fu.values()) == 37
    assert fu["dest_prior_count"] and not fu["amount"]


def test_logged_probability_wins(spark):
    frame = spark.createDataFrame([("t1", 0.2), ("t2", None)], "transaction_id string, prediction_proba double")
    model = spark.createDataFrame([("t1", 0.9), ("t2", 0.7)], "transaction_id string, proba double")
    got = {r.transaction_id: r.prediction_proba for r in EV.fill_missing_scores(frame, model).collect()}
    assert got == {"t1": 0.2, "t2": 0.7}


def test_event_sink_roundtrip(spark, tmp_path):
    from ledgerlens.plans.score import scored

    s, _ = scored(spark, SF_SMALL)
    rec = EV.event_records(s)
    path = str(tmp_path / "events")
    EV.write_event_log(rec, path)
    EV.write_event_log(rec.limit(10), path)  # append
    good, summary = EV.read_event_log(spark, path)
    r = summary.first()
    assert r.malformed_lines == 0 and r.parsed_events == rec.count() + 10
    assert good.select("transaction_id").distinct().count() == rec.count()
    assert EV.count_logged_events(spark, path) == rec.count() + 10


def test_approximate_profile_close_to_exact(spark):
    from ledgerlens.operators import quality as Q

    t = transactions(spark, SF_SMALL).select(*S.ENRICHED_COLUMNS)
    exact = {r.column_name: r.n_unique for r in Q.column_profile(t).collect()}
    approx = {r.column_name: r.n_unique for r in Q.column_profile(t, approx=True).collect()}
    for c, v in exact.items():
        assert abs(approx[c] - v) <= max(2, 0.1 * v), c


def test_one_row_group_is_mapped_by_many_tasks(spark, tmp_path):
    """Events in one row group are dealt to tasks by their number; the rows are those of the plain mapping."""
    from ledgerlens.sources.fixture import MIN_ROWS_PER_TASK, ROWS_PER_TASK, map_tasks, transactions_from_events

    n = 2 * MIN_ROWS_PER_TASK + 1000
    ids = F.when(F.col("id") % 1000 == 7, F.lit(None)).when(F.col("id") % 50 == 3, 3).otherwise(F.col("id"))
    events = spark.range(n).coalesce(1).select(
        ids.cast("long").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 700 as int))").alias("ts"),
        (F.col("id") % 97).alias("user_id"), F.element_at(F.array(*map(F.lit, ("purchase", "click", "view"))), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 1000 / 7).alias("value"), F.lit("{}").alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    t = transactions(spark, str(tmp_path))
    tasks = map_tasks(n, spark.sparkContext.defaultParallelism)
    assert tasks > 1 and len(t.inputFiles()) == tasks
    plain = transactions_from_events(spark.read.parquet(str(tmp_path / "events.parquet")))
    assert t.dtypes == plain.dtypes and t.exceptAll(plain).count() == 0 and plain.exceptAll(t).count() == 0
    assert map_tasks(36_000_000, 12) * ROWS_PER_TASK >= 36_000_000 and map_tasks(10, 12) == 1


def test_event_draws_are_the_documented_ones(spark):
    """FIXTURES.md B1: the draw of a tag is the first 8 hex digits of md5(tag:id)."""
    import hashlib

    from ledgerlens.sources.fixture import EVENT_DRAWS, _u

    row = spark.range(41, 42).select(*[_u(t, F.col("id")).alias(t) for t in EVENT_DRAWS]).first()
    assert all(row[t] == int(hashlib.md5(f"{t}:41".encode()).hexdigest()[:8], 16) / 2**32 for t in EVENT_DRAWS)


def test_draws_pass_through_whole_numbers(spark):
    """A draw is a whole number before it is a double: no double is read from text; a null id has no draw."""
    from ledgerlens.sources.fixture import _draw, _u

    ids = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    got = ids.select("id", _u("fraud", F.col("id")).alias("u"))
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "as bigint) as double)" in plan
    rows = got.collect()
    assert [r["u"] for r in rows if r["id"] is None] == [None] and all(0 <= r["u"] < 1 for r in rows if r["id"])
    old = F.conv(F.substring(F.md5(F.concat(F.lit("fraud"), F.lit(":"), F.col("id").cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    assert ids.where(~_draw(F.lit("fraud"), F.col("id").cast("string")).eqNullSafe(old)).isEmpty()
