"""Stream equals batch; dedup drops re-deliveries; availableNow ingests only new files."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlens.operators import score as SC
from ledgerlens.sources.fixture import transactions


def test_stream_velocity_equals_batch(spark):
    stream = E.queries()["stream_velocity"](spark, SF_SMALL)
    t = transactions(spark, SF_SMALL)
    batch = SC.scoring_velocity(t.select("txn_id", "type", "step", "nameDest"))
    u = F.col("type").isin("TRANSFER", "CASH_OUT")
    b = {r.txn_id: (r.dest_prior_count, r.dest_steps_since_last, r.dest_first_seen)
         for r in batch.join(t.select("txn_id", "type"), ["txn_id", "type"]).where(u).collect()}
    s = {r.txn_id: (r.dest_prior_count, r.dest_steps_since_last, r.dest_first_seen) for r in stream.collect()}
    assert len(s) == t.count()
    assert all(s[k] == v for k, v in b.items())


def test_stream_dedup_and_ingest(spark):
    d = E.queries()["stream_dedup"](spark, SF_SMALL)
    assert d.count() == d.select("transaction_id").distinct().count()
    ing = E.queries()["stream_ingest"](spark, SF_SMALL)
    assert ing.count() == d.count()
    assert ing.select("transaction_id").distinct().count() == ing.count()


def test_event_log_roundtrip_through_files(spark, tmp_path):
    from ledgerlens.plans.score import scored
    from ledgerlens.sources import events as EV

    s, _ = scored(spark, SF_SMALL)
    rec = EV.event_records(s)
    path = str(tmp_path / "log")
    EV.stand_in_lines(rec).write.mode("overwrite").text(path)
    good, summary = EV.read_event_log(spark, path)
    parsed = EV.tolerant_summary(EV.parse_lines(EV.stand_in_lines(rec))).first()
    assert good.count() == parsed.parsed_events
    assert summary.first().malformed_lines == parsed.malformed_lines
    assert summary.first().blank_lines == parsed.blank_lines
    assert EV.count_logged_events(spark, path) == parsed.n_lines - parsed.blank_lines
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "value string").write.mode("overwrite").text(empty)
    g2, _ = EV.read_event_log(spark, empty)
    assert g2.count() == 0


def test_stream_scoring_equals_batch_decisions(spark):
    cols = ["txn_id", "decision", "fraud_probability", "risk_signals", "reason",
            "dest_prior_count", "dest_steps_since_last", "dest_first_seen"]
    s = E.queries()["stream_scoring"](spark, SF_SMALL).select(*cols)
    b = E.queries()["decisions"](spark, SF_SMALL).select(*cols)
    assert s.count() == b.count()
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def _hot_requests(spark, n=600):
    # a third of the rows have no destination, another third share one
    return spark.range(n).selectExpr(
        "id + 1 as txn_id", "if(id % 5 = 0, 'PAYMENT', 'TRANSFER') as type", "id div 20 + 1 as step",
        "case id % 3 when 0 then null when 1 then 'C_hot' else concat('C', id % 17) end as nameDest")


def _run(spark, tmp_path, req, hot_rows, cuts=(7, 15, 23)):
    from ledgerlens.streaming.velocity import stream_velocity

    src, out, state, ckpt = (str(tmp_path / x) for x in ("src", "out", "state", "ckpt"))
    for lo, hi in zip((0, *cuts), (*cuts, 10_000)):
        req.where((F.col("step") > lo) & (F.col("step") <= hi)).write.mode("append").parquet(src)
        stream_velocity(spark.readStream.schema(req.schema).parquet(src), out, state, ckpt, hot_rows)
    return out, state


def test_hot_destinations_on_a_stream_equal_one_batch(spark, tmp_path):
    from ledgerlens.streaming.velocity import batch_velocity

    req = _hot_requests(spark)
    spark.conf.set("spark.ledgerlens.ranks.rowsPerBucket", "40")
    try:
        out, _ = _run(spark, tmp_path, req, hot_rows=25)
        got = spark.read.parquet(out).drop("epoch")
        want = batch_velocity(req)
        assert got.count() == 600 and got.exceptAll(want.select(*got.columns)).count() == 0
        # brute force over the rows in order
        seen, rows = {}, sorted(req.collect(), key=lambda r: (r.step, r.txn_id))
        expect = {}
        for r in rows:
            k = r.nameDest or "UNKNOWN_DEST"
            n, last = seen.get(k, (0, None))
            expect[r.txn_id] = (n, -1.0 if last is None else float(r.step - last), int(last is None))
            if r.type == "TRANSFER":
                seen[k] = (n + 1, r.step)
        assert {r.txn_id: (r.dest_prior_count, r.dest_steps_since_last, r.dest_first_seen) for r in got.collect()} == expect
    finally:
        spark.conf.unset("spark.ledgerlens.ranks.rowsPerBucket")


def test_replayed_epoch_adds_nothing_and_bases_hold_the_state(spark, tmp_path):
    from ledgerlens.streaming.velocity import VelocityState

    req = _hot_requests(spark)
    state = VelocityState(spark, str(tmp_path / "state"), compact_epochs=2)
    for epoch in range(5):
        part = req.where((F.col("step") > 6 * epoch) & (F.col("step") <= 6 * epoch + 6))
        state.add(part, epoch)
        state.add(part, epoch)
    total = {r.nameDest: (r.state_count, r.state_step) for r in state.before(5).collect()}
    want = req.where("type = 'TRANSFER'").groupBy(F.coalesce("nameDest", F.lit("UNKNOWN_DEST")).alias("d")).agg(F.count("*").alias("n"), F.max("step").alias("s"))
    assert total == {r.d: (r.n, r.s) for r in want.collect()}
    assert state._numbers("base") == [1, 3] and state.before(0) is None
    assert sum(r.state_count for r in state.before(2).collect()) == req.where("type = 'TRANSFER' and step <= 12").count()


def test_one_row_places_aggregates_side_by_side(spark):
    from ledgerlens.functions.exprs import one_row

    a = spark.createDataFrame([(1,)], "x long")
    b = spark.createDataFrame([("k", 2.5)], "y string, z double")
    r = one_row(a, b).collect()
    assert len(r) == 1 and (r[0].x, r[0].y, r[0].z) == (1, "k", 2.5)


def test_stream_scoring_with_caller_overrides_equals_batch(spark, tmp_path):
    from ledgerlens.plans.streams import _arrivals
    from ledgerlens.streaming.scorer import score_stream

    t = transactions(spark, SF_SMALL)
    req = t.withColumns({
        "dest_prior_count": F.when(F.col("txn_id") % 7 == 0, F.lit(3)).cast("long"),
        "dest_steps_since_last": F.when(F.col("txn_id") % 7 == 0, F.lit(2.0)),
    })
    src, out, state, ckpt = (str(tmp_path / x) for x in ("src", "out", "state", "ckpt"))
    for part in _arrivals(req):
        part.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 1).parquet(src)
    score_stream(stream, "score", 0.05, out, state, ckpt)
    cols = ["txn_id", "decision", "risk_signals", "dest_prior_count", "dest_steps_since_last", "dest_first_seen"]
    s = spark.read.parquet(out).select(*cols)
    b = SC.score_batch(req, "score", 0.05).select(*cols)
    assert s.count() == b.count() == t.count()
    assert s.exceptAll(b).count() == 0
    over = {r.txn_id: r.dest_prior_count for r in s.where(F.col("txn_id") % 7 == 0).collect()}
    assert set(over.values()) == {3}
