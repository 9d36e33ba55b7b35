from conftest import SF

from upshot.sources.tables import read_table
from upshot.streaming import events as st


def test_stream_monitor_equals_batch(spark):
    import pyspark.sql.functions as F
    out = st.stream_monitor(spark, SF).toPandas().sort_values("window_start")
    ev = st.event_columns(read_table(spark, SF, "events"))
    batch = (ev.groupBy(F.window("ts", "7 days").alias("w")).agg(*st.monitor_aggs(10.0, 0.1))
             .select(F.unix_seconds("w.start").alias("window_start"), "n_events").toPandas().sort_values("window_start"))
    assert list(out.window_start) == list(batch.window_start)
    assert list(out.n_events) == list(batch.n_events)


def test_stream_srm_counts(spark):
    out = st.stream_srm(spark, SF).toPandas()
    assert (out.n_control + out.n_treatment).sum() == read_table(spark, SF, "events").count()


def test_stream_psi_reference_window_is_stable(spark):
    from upshot.plans.q_stream import _event_reference
    ref = _event_reference(spark, SF)
    edges = st.with_ref_counts(ref, st.reference_edges(ref))
    out = st.stream_psi(spark, SF, edges).toPandas()
    first = out[out.window_start == out.window_start.min()]
    assert len(first) == 2 and (first.psi.abs() < 1e-9).all()
    assert set(out.rag_status) <= {"GREEN", "AMBER", "RED"}


def test_late_rows_beyond_watermark_are_dropped(spark, tmp_path):
    """Three micro-batches: weeks 1-4, then week 5, then late week-1 rows.

    Spark filters late rows against the watermark in force when the batch
    starts (max event time of the earlier batches minus the delay), so the
    third batch's week-1 rows are dropped and the closed window keeps its count.
    """
    import datetime as dt
    import os

    import pandas as pd

    start = dt.datetime(2024, 1, 1)

    def frame(ids, days):
        return pd.DataFrame({"event_id": ids, "ts": [start + dt.timedelta(days=d) for d in days], "user_id": ids,
                             "event_type": ["purchase"] * len(ids), "value": [10.0] * len(ids),
                             "props": ["{}"] * len(ids)})

    d = tmp_path / "ev"
    d.mkdir()
    parts = [("a", list(range(0, 40)), [i % 28 for i in range(40)]),
             ("b", list(range(100, 105)), [31] * 5),
             ("c", list(range(200, 205)), [1] * 5)]
    for k, (name, ids, days) in enumerate(parts):
        f = d / f"{name}_events.parquet"
        frame(ids, days).to_parquet(f, coerce_timestamps="us")
        os.utime(f, (1_700_000_000 + k * 100, 1_700_000_000 + k * 100))   # file order = batch order
    out = st.stream_monitor(spark, str(d), glob="*_events.parquet").toPandas().sort_values("window_start")
    first_window = sum(1 for i in range(40) if (start + dt.timedelta(days=i % 28)).date() < dt.date(2024, 1, 4))
    assert out.n_events.iloc[0] == first_window       # the late rows never reached the closed window
    assert out.n_events.sum() == 40 + 5               # week-5 rows counted, late rows dropped


def test_stream_linucb_first_round_picks_control(spark):
    """One micro-batch: both arms start equal, ties pick arm 0, so matches = control events."""
    out = st.stream_linucb(spark, SF).toPandas()
    ev = st.event_columns(read_table(spark, SF, "events"))
    n_control = ev.where("treatment = 0").count()
    assert len(out) == 1 and out.matched.iloc[0] == n_control


def test_stream_linucb_equals_batched_rounds(spark, tmp_path):
    """Three files = three micro-batches = three rounds of the batched replay with the same features."""
    import os

    import numpy as np
    import pandas as pd

    from upshot.operators import bandit

    ev = read_table(spark, SF, "events").orderBy("event_id").toPandas()
    cuts = np.linspace(0, len(ev), 4).astype(int)
    parts = [ev.iloc[cuts[k]:cuts[k + 1]] for k in range(3)]
    d = tmp_path / "ev"
    d.mkdir()
    for k, part in enumerate(parts):
        f = d / f"p{k}_events.parquet"
        part.to_parquet(f, coerce_timestamps="us")
        os.utime(f, (1_700_000_000 + 100 * k, 1_700_000_000 + 100 * k))
    out = st.stream_linucb(spark, str(d), glob="*_events.parquet").toPandas().sort_values("batch_id")
    assert len(out) == 3

    cols = st.event_columns(spark.createDataFrame(pd.concat(
        [p.assign(_b=k) for k, p in enumerate(parts)]))).toPandas()
    cols["_b"] = np.concatenate([[k] * len(p) for k, p in enumerate(parts)])
    cols["xv"], cols["xh"] = cols.x_value / 100.0, cols.x_hour / 10.0
    agent = bandit.BatchedLinUCB(["xv", "xh"], alpha=1.0, value=10.0, cost=0.10)
    agent.run(agent.prepare(spark.createDataFrame(cols[["event_id", "xv", "xh", "treatment", "conversion", "_b"]]),
                            unit="event_id", order_col="_b", batch_size=1))
    s = agent.summary(spark).first()
    assert out.matched.iloc[-1] == s["aligned_events"]
    assert abs(out.reward.iloc[-1] - s["cumulative_reward"]) < 1e-6


def test_directory_table_and_file_table_are_both_streams(spark, tmp_path):
    ev = read_table(spark, SF, "events")
    ev.repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    a = st.stream_srm(spark, str(tmp_path)).toPandas().sort_values("window_start").reset_index(drop=True)
    b = st.stream_srm(spark, SF).toPandas().sort_values("window_start").reset_index(drop=True)
    assert len(a) and a.equals(b[a.columns])


def test_arrivals_are_batches_and_rows_sent_again_are_accounted_for(spark):
    import pyspark.sql.functions as F
    ev = read_table(spark, SF, "events")
    again = ev.where("event_id % 5 = 0")
    source = st.Arrivals(ev, 4, again)
    rows, dropped = st.stream_ingest(spark, source.folder, feed=source)
    assert rows.count() == ev.count() == rows.select("event_id").distinct().count()
    last = ev.agg(F.max("ts")).first()[0]
    late = again.where(F.col("ts") <= F.lit(last) - F.expr("INTERVAL 1 DAY")).count()
    assert dropped == {"late": late, "duplicate": again.count() - late} and late > 0


def test_score_stream_with_a_tree_equals_batch(spark):
    from upshot.operators.learners import Distiller
    ev = st.event_columns(read_table(spark, SF, "events"))
    student = Distiller(st.EVENT_FEATURES, "tree", max_depth=3).fit(ev, "score")
    source = st.Arrivals(read_table(spark, SF, "events"), 3)
    out = st.stream_score(spark, source.folder, lambda df: student.predict(df, "uplift_score"), feed=source)
    want = {r.event_id: r.uplift_score for r in student.predict(ev, "uplift_score").collect()}
    got = {r.event_id: r.uplift_score for r in out.collect()}
    assert got == want and out.count() == len(want)


def test_bandit_state_survives_a_replay_and_refuses_damage(spark, tmp_path):
    import shutil

    import pytest
    path = str(tmp_path / "bandit")
    source = st.Arrivals(read_table(spark, SF, "events"), 3)
    first = st.stream_linucb(spark, source.folder, path=path, feed=source).orderBy("batch_id").collect()
    shutil.rmtree(f"{path}/checkpoint/commits")           # the last batches count as not finished: they run again
    again = st.stream_linucb(spark, source.folder, path=path).orderBy("batch_id").collect()
    assert again == first and len(first) == 3
    more = read_table(spark, SF, "events").limit(5)
    shutil.rmtree(f"{path}/state/batch_id=2")
    more.write.mode("append").parquet(f"{source.folder}/events.parquet")
    with pytest.raises(Exception, match="batch_id=2|PATH_NOT_FOUND|damaged"):
        st.stream_linucb(spark, source.folder, path=path)
