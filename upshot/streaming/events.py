"""Streaming operators over an event stream (file source, event-time windows, watermarks).

Sinks are ``foreachBatch`` writers that put each micro-batch under its own
``batch_id`` folder with overwrite, so a replayed batch after a failure
rewrites the same files (idempotent); readers keep the latest batch per key.
Stateful bandit state lives in a small Parquet table with a version for each
batch. A static table becomes a stream by arriving in spans (``Arrivals``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upshot.functions.columns import bid_decision, psi_rag
from upshot.functions.dist import chi2_1dof_critical
from upshot.operators.monitor import PSI_EPS, histogram_bin
from upshot.session import scratch_path

WEEK = 7 * 86400
EVENT_FEATURES = ["x_value", "x_hour"]


def utc_instant(ts) -> Column:
    """TIMESTAMP for a wall-clock value read as UTC (works for TIMESTAMP_NTZ, independent of the session zone)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def event_columns(df: DataFrame) -> DataFrame:
    """Arm, outcome, features and a deterministic score for each event (stateless)."""
    ts = utc_instant("ts") if dict(df.dtypes).get("ts") == "timestamp_ntz" else F.col("ts")
    return df.select(
        "event_id", ts.alias("ts"), "user_id",
        F.when((F.col("event_id") * 48271 + 11) % 10007 < 8506, 1).otherwise(0).alias("treatment"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("conversion"),
        F.col("value").alias("x_value"), F.hour("ts").cast("double").alias("x_hour"),
        (F.col("value") / F.lit(1000.0) - F.lit(0.02)).alias("score"))


EVENT_COLUMNS_SQL = """
SELECT event_id, ts, user_id,
  CASE WHEN (event_id * 48271 + 11) % 10007 < 8506 THEN 1 ELSE 0 END AS treatment,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS conversion,
  value AS x_value, CAST(hour(ts) AS DOUBLE) AS x_hour, value / 1000.0 - 0.02 AS score
FROM events
"""


def event_stream(spark: SparkSession, sf_dir: str, table: str = "events", files_per_trigger: int | None = None,
                 glob: str | None = None) -> DataFrame:
    """``readStream`` of the table with the batch schema (no inference); the table is a Parquet file or a folder of them.

    A micro-batch takes all files that have arrived, or ``files_per_trigger``
    of them. ``glob`` selects files inside ``sf_dir`` instead of the table, one
    in a micro-batch unless told otherwise.
    """
    if glob is not None:
        schema = spark.read.option("pathGlobFilter", glob).parquet(sf_dir).schema
        return (spark.readStream.schema(schema).option("pathGlobFilter", glob)
                .option("maxFilesPerTrigger", files_per_trigger or 1).parquet(sf_dir))
    path = f"{sf_dir}/{table}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path[:-1] + "[t]")      # a pattern may name one file or a folder, a plain path only a folder


class Arrivals:
    """A table that arrives bit by bit: ``folder``/events.parquet receives its rows in equal spans of event time.

    Each step of the iteration appends one span (a distributed write, any
    number of files) and, at the end, the ``late`` rows. A stream over the
    folder is run after each step from its checkpoint, so a step is a
    micro-batch, and what decides their order is when rows arrive, not file times.
    """

    def __init__(self, events: DataFrame, spans: int, late: DataFrame | None = None) -> None:
        self.events, self.spans, self.late = events, spans, late
        self.folder = scratch_path(events.sparkSession, f"arrivals-{uuid.uuid4().hex}")

    def __iter__(self) -> Iterator[int]:
        ts = utc_instant("ts") if dict(self.events.dtypes)["ts"] == "timestamp_ntz" else F.col("ts")
        timed = self.events.withColumn("_t", F.unix_micros(ts))
        lo, hi = timed.agg(F.min("_t"), F.max("_t")).first()
        at = F.floor((F.col("_t") - F.lit(lo)) * F.lit(self.spans) / F.lit((hi or 0) - (lo or 0) + 1))
        for k in range(self.spans):
            span = timed.where(F.coalesce(at, F.lit(0)) == k).drop("_t")
            span.write.mode("append").parquet(f"{self.folder}/events.parquet")
            yield k
        if self.late is not None:
            self.late.write.mode("append").parquet(f"{self.folder}/events.parquet")
            yield self.spans


def _sink(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # the folder name carries batch_id (partition discovery); overwrite makes a replayed batch idempotent
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def _drain(query_of, writer_of, feed) -> list[dict]:
    """Runs a query until it has read what is there, after each step of ``feed`` (once without); its progress reports.

    The query is built after the first step, when the source exists, and
    started again from its checkpoint each time.
    """
    reports, query = [], None
    for _ in feed if feed is not None else (0,):
        query = query if query is not None else query_of()
        q = writer_of(query).trigger(availableNow=True).start()
        q.awaitTermination()
        reports += list(q.recentProgress)
    return reports


def _run(query_of, path: str, feed=None, mode: str = "update") -> list[dict]:
    return _drain(query_of, lambda df: df.writeStream.outputMode(mode).foreachBatch(_sink(f"{path}/out"))
                  .option("checkpointLocation", f"{path}/checkpoint"), feed)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest version of every key across the batch folders."""
    df = spark.read.parquet(f"{path}/out")
    w = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", "batch_id")


def windowed(df: DataFrame, watermark: str = "1 day", width: str = "7 days") -> DataFrame:
    return df.withWatermark("ts", watermark).withColumn("w", F.window("ts", width))


def monitor_aggs(value: float, cost: float) -> list[Column]:
    s = F.col("score")
    bid = bid_decision(s, value, cost)
    return [F.count(F.lit(1)).alias("n_events"), (F.avg(bid.cast("double")) * 100).alias("bid_rate_pct"),
            F.avg(s).alias("avg_uplift_score"), F.avg(F.col("conversion").cast("double")).alias("avg_conversion_rate"),
            F.avg(F.when(bid, s * value - cost).otherwise(F.lit(0.0))).alias("expected_profit_per_user")]


def stream_monitor(spark: SparkSession, sf_dir: str, value: float = 10.0, cost: float = 0.10,
                   path: str | None = None, glob: str | None = None, watermark: str = "1 day", feed=None) -> DataFrame:
    """Per 7-day event-time window: events, bid rate, mean score, conversion, expected profit.

    Rows arriving after the watermark has passed their window's end are dropped.
    """
    path = path or scratch_path(spark, f"stream-monitor-{uuid.uuid4().hex}")

    def query() -> DataFrame:
        ev = windowed(event_columns(event_stream(spark, sf_dir, glob=glob)), watermark=watermark)
        return ev.groupBy("w").agg(*monitor_aggs(value, cost)).select(
            F.unix_seconds("w.start").alias("window_start"), "*").drop("w")

    _run(query, path, feed)
    return latest(spark, path, ["window_start"])


def stream_srm(spark: SparkSession, sf_dir: str, expected_ratio: float = 0.85, alpha: float = 0.001,
               path: str | None = None, glob: str | None = None, feed=None) -> DataFrame:
    """Per window: arm counts, chi-square against the expected split and the verdict."""
    path = path or scratch_path(spark, f"stream-srm-{uuid.uuid4().hex}")

    def query() -> DataFrame:
        ev = windowed(event_columns(event_stream(spark, sf_dir, glob=glob)))
        return ev.groupBy("w").agg(F.count(F.when(F.col("treatment") == 0, 1)).alias("n_control"),
                                   F.count(F.when(F.col("treatment") == 1, 1)).alias("n_treatment")).select(
            F.unix_seconds("w.start").alias("window_start"), "n_control", "n_treatment")

    _run(query, path, feed)
    out = latest(spark, path, ["window_start"])
    n = (F.col("n_control") + F.col("n_treatment")).cast("double")
    e_c, e_t = n * (1 - expected_ratio), n * expected_ratio
    chi2 = F.pow(F.col("n_control") - e_c, 2) / e_c + F.pow(F.col("n_treatment") - e_t, 2) / e_t
    return out.withColumn("chi2", chi2).withColumn("valid", F.col("chi2") < F.lit(chi2_1dof_critical(alpha)))


def reference_edges(reference: DataFrame, n_bins: int = 10) -> DataFrame:
    """Frozen PSI edges per event feature from a batch reference frame."""
    from upshot.operators.monitor import psi_edges
    return psi_edges(reference, EVENT_FEATURES, n_bins)


def stream_psi(spark: SparkSession, sf_dir: str, edges: DataFrame, n_bins: int = 10,
               path: str | None = None, glob: str | None = None, feed=None) -> DataFrame:
    """Windowed bin counts per feature against frozen reference edges; PSI from the counts."""
    path = path or scratch_path(spark, f"stream-psi-{uuid.uuid4().hex}")
    e = edges.collect()  # one row per feature: bounded

    def query() -> DataFrame:
        ev = windowed(event_columns(event_stream(spark, sf_dir, glob=glob)))
        long = ev.select("w", F.explode(F.array(*[
            F.struct(F.lit(r["feature"]).alias("feature"), F.col(r["feature"]).alias("value"),
                     F.array(*[F.lit(float(x)) for x in r["edges"]]).alias("edges")) for r in e])).alias("r"))
        binned = long.select("w", "r.feature", histogram_bin(F.col("r.value"), F.col("r.edges"), n_bins).alias("bin"))
        return binned.groupBy("w", "feature", "bin").agg(F.count(F.lit(1)).alias("cur_c")).select(
            F.unix_seconds("w.start").alias("window_start"), "feature", "bin", "cur_c")

    _run(query, path + "/counts", feed)   # one stream: out-of-range values keep a null bin
    allc = latest(spark, path + "/counts", ["window_start", "feature", "bin"])
    first = e[0]["feature"]
    tot = (allc.where(F.col("feature") == first).groupBy("window_start")
           .agg(F.sum("cur_c").alias("n_cur")))   # every event has exactly one bin (maybe null) per feature
    cur = allc.where(F.col("bin").isNotNull())
    return psi_from_counts(cur, tot, edges, n_bins)


def psi_from_counts(cur: DataFrame, tot: DataFrame, edges: DataFrame, n_bins: int) -> DataFrame:
    spark = cur.sparkSession
    ref = edges.select("feature", "n_ref", "ref_counts")
    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    grid = tot.crossJoin(ref).crossJoin(bins).withColumn("ref_c", F.col("ref_counts")[F.col("bin")])
    full = grid.join(cur, ["window_start", "feature", "bin"], "left").fillna(0, ["cur_c"])
    rp = (F.col("ref_c") + PSI_EPS) / (F.col("n_ref") + PSI_EPS * n_bins)
    cp = (F.col("cur_c") + PSI_EPS) / (F.col("n_cur") + PSI_EPS * n_bins)
    out = full.groupBy("window_start", "feature").agg(F.sum((cp - rp) * F.log(cp / rp)).alias("psi"))
    return out.withColumn("rag_status", psi_rag(F.bround("psi", 6)))


def with_ref_counts(reference: DataFrame, edges: DataFrame, n_bins: int = 10) -> DataFrame:
    """Attach the reference's own bin counts (array by bin) to the edges table."""
    from upshot.operators.monitor import unpivot
    long = unpivot(reference, EVENT_FEATURES, []).join(edges, "feature")
    c = (long.withColumn("bin", histogram_bin(F.col("value"), F.col("edges"), n_bins)).where(F.col("bin").isNotNull())
         .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("c")))
    bins = reference.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    full = edges.select("feature").crossJoin(bins).join(c, ["feature", "bin"], "left").fillna(0, ["c"])
    arr = full.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("bin", "c"))).alias("_s"))
    return edges.join(arr.select("feature", F.transform("_s", lambda s: s["c"]).alias("ref_counts")), "feature")


def stream_score(spark: SparkSession, sf_dir: str, scorer, value: float = 10.0, cost: float = 0.10,
                 path: str | None = None, glob: str | None = None, feed=None) -> DataFrame:
    """Stateless scoring + BID decision appended to a Parquet sink (``scorer``: DataFrame -> DataFrame)."""
    path = path or scratch_path(spark, f"stream-score-{uuid.uuid4().hex}")

    def query() -> DataFrame:
        ev = scorer(event_columns(event_stream(spark, sf_dir, glob=glob)))
        return ev.select("event_id", "ts", "uplift_score",
                         (F.col("uplift_score") * value - cost).alias("expected_profit"),
                         F.when(F.col("uplift_score") * value - cost > 0, "BID").otherwise("NO BID").alias("decision"))

    _drain(query, lambda df: _to_files(df, path), feed)
    return spark.read.parquet(f"{path}/out")


def _to_files(df: DataFrame, path: str):
    return (df.writeStream.format("parquet").option("path", f"{path}/out")
            .option("checkpointLocation", f"{path}/checkpoint"))


def stream_ingest(spark: SparkSession, sf_dir: str, path: str | None = None, glob: str | None = None,
                  watermark: str = "1 day", feed=None) -> tuple[DataFrame, dict[str, int]]:
    """Each event once: the rows that were let in, and how many were not, by reason.

    An event sent again is dropped: as ``late`` if the watermark has passed its
    time, else as ``duplicate`` by its id, which the state holds until then.
    Both counts come from the progress reports of the state operator, which
    sees single rows here (a windowed count would see groups).
    """
    path = path or scratch_path(spark, f"stream-ingest-{uuid.uuid4().hex}")

    def query() -> DataFrame:
        ev = event_columns(event_stream(spark, sf_dir, glob=glob))
        return ev.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])

    operators = [op for r in _drain(query, lambda df: _to_files(df, path), feed) for op in r["stateOperators"]]
    return spark.read.parquet(f"{path}/out"), {
        "late": sum(op["numRowsDroppedByWatermark"] for op in operators),
        "duplicate": sum(op["customMetrics"].get("numDroppedDuplicateRows", 0) for op in operators)}


#: A bandit round's state: the arms' matrices and vectors after it, and the running totals.
STATE = ("A0 array<double>, A1 array<double>, b0 array<double>, b1 array<double>, matched long, reward double")


def stream_linucb(spark: SparkSession, sf_dir: str, alpha: float = 1.0, value: float = 10.0, cost: float = 0.10,
                  scales=(100.0, 10.0), path: str | None = None, glob: str | None = None, feed=None) -> DataFrame:
    """Batched LinUCB with one round per micro-batch.

    State is a table with one version for each batch: batch k reads version
    k - 1, by name and with its schema, and overwrites version k, so a batch
    run again after a failure gives the same version, and a missing or damaged
    version fails the batch instead of starting anew. The sums of a round are
    combined in each task before they meet, so an arm with most rows costs no more.
    """
    from upshot.functions.columns import realised_profit
    from upshot.operators.bandit import _solve, _ucb_coefs, _ucb_expr
    path = path or scratch_path(spark, f"stream-linucb-{uuid.uuid4().hex}")
    d = len(EVENT_FEATURES)

    def version(batch_id: int) -> str:
        return f"{path}/state/batch_id={batch_id}"

    def load_state(batch_id: int):
        if batch_id == 0:
            return [np.identity(d), np.identity(d)], [np.zeros(d), np.zeros(d)], 0, 0.0
        rows = spark.read.schema(STATE).parquet(version(batch_id - 1)).collect()    # one row
        if len(rows) != 1 or any(v is None for v in rows[0]):
            raise RuntimeError(f"bandit state of batch {batch_id - 1} is damaged: {len(rows)} row(s) in {version(batch_id - 1)}")
        row = rows[0]
        A = [np.array(row["A0"]).reshape(d, d), np.array(row["A1"]).reshape(d, d)]
        b = [np.array(row["b0"]), np.array(row["b1"])]
        return A, b, row["matched"], row["reward"]

    def step(batch: DataFrame, batch_id: int) -> None:
        A, b, matched, reward = load_state(batch_id)
        xs = [F.col(f) / F.lit(s) for f, s in zip(EVENT_FEATURES, scales)]
        c0, c1 = [_ucb_coefs(_solve(A[a], b[a]), np.linalg.pinv(A[a])) for a in (0, 1)]
        u0 = _ucb_expr(xs, c0[0], c0[1], alpha)
        u1 = _ucb_expr(xs, c1[0], c1[1], alpha)
        rows = batch.select(*[x.alias(f"x{i}") for i, x in enumerate(xs)], F.col("treatment").alias("arm"),
                            realised_profit(F.col("conversion"), F.col("treatment"), value, cost).alias("r"),
                            F.when(u1 > u0, 1).otherwise(0).alias("chosen"))
        aggs = [F.count(F.lit(1)).alias("n"), F.sum("r").alias("rs")]
        aggs += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"xx{i}{j}") for i in range(d) for j in range(d)]
        aggs += [F.sum(F.col("r") * F.col(f"x{i}")).alias(f"rx{i}") for i in range(d)]
        for s in rows.where(F.col("chosen") == F.col("arm")).groupBy("arm").agg(*aggs).collect():  # <= 2 rows
            a = int(s["arm"])
            A[a] += np.array([[s[f"xx{i}{j}"] for j in range(d)] for i in range(d)])
            b[a] += np.array([s[f"rx{i}"] for i in range(d)])
            matched += s["n"]
            reward += s["rs"]
        spark.createDataFrame([(A[0].ravel().tolist(), A[1].ravel().tolist(), b[0].tolist(), b[1].tolist(),
                                int(matched), float(reward))], STATE).write.mode("overwrite").parquet(version(batch_id))

    _drain(lambda: event_columns(event_stream(spark, sf_dir, glob=glob)),
           lambda df: df.writeStream.foreachBatch(step).option("checkpointLocation", f"{path}/checkpoint"), feed)
    st = spark.read.schema(STATE + ", batch_id long").parquet(f"{path}/state")
    return st.select("batch_id", "matched", "reward",
                     F.when(F.col("matched") > 0, F.col("reward") / F.col("matched")).otherwise(0.0).alias("avg_profit"))
