"""Batched disjoint LinUCB replay on Spark.

The reference replays events one by one on a driver loop. Here the events
are cut into rounds (by a uniform hash of the unit, or by an explicit event
index and batch size). Within a round every event is scored with the round's
frozen parameters (literal coefficients, so scoring stays JVM-side), events
whose chosen arm equals the logged arm are kept, and their sufficient
statistics (sum x x^T and sum r x per arm, d(d+1)/2 + d numbers) are
aggregated on the executors. The driver only solves two d x d systems per
round. With a batch size of 1 this is exactly the sequential algorithm.

Rounds read a Parquet table partitioned by round and written once under the
shared checkpoint folder, so each round scans only its own partition and the
loop carries no lineage.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upshot.functions.columns import realised_profit, unit_uniform
from upshot.functions.materialize import checkpointed
from upshot.session import scratch_path


def _ucb_coefs(theta: np.ndarray, a_inv: np.ndarray) -> tuple[list[float], list[float]]:
    """Mean coefficients and the upper-triangle quadratic-form coefficients (off-diagonal doubled)."""
    d = len(theta)
    quad = [float(a_inv[i, j] * (1.0 if i == j else 2.0)) for i in range(d) for j in range(i, d)]
    return [float(t) for t in theta], quad


def _ucb_expr(xs: list[Column], mean_c, quad_c, alpha: float) -> Column:
    """theta.x + alpha * sqrt(x' A^-1 x) from coefficient literals (lists of floats) or array columns.

    The same expression shape is used both ways, so a replay round and the later
    decision pass compute bit-identical scores.
    """
    d = len(xs)
    at = (lambda c, k: F.lit(c[k])) if isinstance(mean_c, list) else (lambda c, k: c.getItem(k))
    mean = F.lit(0.0)
    for i in range(d):
        mean = mean + at(mean_c, i) * xs[i]
    quad, k = F.lit(0.0), 0
    for i in range(d):
        for j in range(i, d):
            quad = quad + at(quad_c, k) * xs[i] * xs[j]
            k += 1
    return mean + F.lit(float(alpha)) * F.sqrt(F.greatest(quad, F.lit(0.0)))


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.pinv(a) @ b


class BatchedLinUCB:
    """Disjoint LinUCB with two arms (0 = control, 1 = treatment) over a logged experiment."""

    def __init__(self, features: list[str], alpha: float = 1.0, value: float = 10.0, cost: float = 0.10):
        self.features, self.alpha, self.value, self.cost = list(features), alpha, value, cost
        d = len(features)
        self.A = [np.identity(d), np.identity(d)]
        self.b = [np.zeros(d), np.zeros(d)]
        self.rounds: list[dict] = []
        self.params: list[tuple] = []   # (round, theta0, theta1, Ainv0, Ainv1)
        self.means = np.zeros(d)
        self.scales = np.ones(d)

    # -- data preparation -------------------------------------------------------
    def prepare(self, df: DataFrame, treatment: str = "treatment", outcome: str = "conversion",
                unit: str = "unit_id", n_rounds: int = 10, seed: int = 42, order_col: str | None = None,
                batch_size: int | None = None, standardize: bool = False, path: str | None = None,
                hash_kind: str = "xxhash", files_per_round: int = 8) -> DataFrame:
        """Write the replay stream (features, arm, reward, round, order key) partitioned by round.

        Rows are dealt by (round, hash of the unit), so a round has
        ``files_per_round`` files, not one from every task.
        """
        xs = [F.col(f).cast("double") for f in self.features]
        if standardize:
            row = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
                         *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(xs)]).first()
            self.means = np.array([row[f"m{i}"] or 0.0 for i in range(len(xs))])
            self.scales = np.array([row[f"s{i}"] or 1.0 for i in range(len(xs))])
            self.scales[self.scales == 0] = 1.0
        xs = [(x - F.lit(float(m))) / F.lit(float(s)) for x, m, s in zip(xs, self.means, self.scales)]
        if order_col is not None:
            order = F.col(order_col).cast("double")
            rnd = F.floor(F.col(order_col) / F.lit(int(batch_size or 1))).cast("int")
        else:
            order = unit_uniform(unit, seed, hash_kind)
            rnd = F.least(F.floor(order * n_rounds), F.lit(n_rounds - 1)).cast("int")
        stream = df.select(F.col(unit).alias("unit"), *[x.alias(f"x{i}") for i, x in enumerate(xs)],
                           F.col(treatment).cast("int").alias("arm"),
                           realised_profit(F.col(outcome).cast("double"), F.col(treatment), self.value, self.cost)
                           .alias("reward"),
                           order.alias("order_key"), rnd.alias("round"))
        path = path or scratch_path(df.sparkSession, f"linucb-{uuid.uuid4().hex}")
        dealt = stream.repartition("round", F.pmod(F.xxhash64("unit"), F.lit(files_per_round)))
        dealt.write.mode("overwrite").partitionBy("round").parquet(path)
        return df.sparkSession.read.parquet(path)

    # -- replay -------------------------------------------------------------------
    def _choice(self, c0, c1) -> Column:
        """Arm with the larger UCB (ties pick arm 0, as argmax); c0/c1 = (mean, quad) coefficients."""
        xs = [F.col(f"x{i}") for i in range(len(self.features))]
        u0 = _ucb_expr(xs, c0[0], c0[1], self.alpha)
        u1 = _ucb_expr(xs, c1[0], c1[1], self.alpha)
        return F.when(u1 > u0, F.lit(1)).otherwise(F.lit(0))

    def run(self, stream: DataFrame) -> "BatchedLinUCB":
        d = len(self.features)
        rounds = sorted(r[0] for r in stream.select("round").distinct().collect())  # bounded by n_rounds
        xs = [F.col(f"x{i}") for i in range(d)]
        for r in rounds:
            coefs = [_ucb_coefs(_solve(self.A[a], self.b[a]), np.linalg.pinv(self.A[a])) for a in (0, 1)]
            self.params.append((int(r), coefs))
            rows = stream.where(F.col("round") == r).withColumn("chosen", self._choice(coefs[0], coefs[1]))
            aggs = [F.count(F.lit(1)).alias("n"), F.sum("reward").alias("rsum")]
            aggs += [F.sum(xs[i] * xs[j]).alias(f"xx{i}_{j}") for i in range(d) for j in range(i, d)]
            aggs += [F.sum(F.col("reward") * xs[i]).alias(f"rx{i}") for i in range(d)]
            stats = rows.where(F.col("chosen") == F.col("arm")).groupBy("arm").agg(*aggs).collect()  # <= 2 rows
            info = {"round": r, "matched": 0, "reward": 0.0}
            for s in stats:
                a = int(s["arm"])
                for i in range(d):
                    for j in range(i, d):
                        v = s[f"xx{i}_{j}"]
                        self.A[a][i, j] += v
                        if i != j:
                            self.A[a][j, i] += v
                    self.b[a][i] += s[f"rx{i}"]
                info["matched"] += s["n"]
                info["reward"] += s["rsum"]
                info[f"matched_arm{a}"] = s["n"]
            self.rounds.append(info)
        return self

    def choose(self, x) -> int:
        """Arm for one (already scaled) context with the current state; ties pick arm 0.

        For a single request (d numbers): uses the same UCB rule as the replay.
        """
        x = np.asarray(x, dtype=float)
        ucb = []
        for a in (0, 1):
            theta = _solve(self.A[a], self.b[a])
            ucb.append(theta @ x + self.alpha * np.sqrt(max(x @ np.linalg.pinv(self.A[a]) @ x, 0.0)))
        return int(np.argmax(ucb))

    # -- results --------------------------------------------------------------------
    def summary(self, spark) -> DataFrame:
        matched = sum(r["matched"] for r in self.rounds)
        reward = sum(r["reward"] for r in self.rounds)
        return spark.createDataFrame(
            [(int(matched), float(reward), float(reward / matched) if matched else 0.0, len(self.rounds))],
            "aligned_events long, cumulative_reward double, avg_profit double, n_rounds int")

    def policy_row(self, stream: DataFrame, policy_id: int, name: str, description: str) -> DataFrame:
        """The replay as a row of the policy table: mean reward of matched events and share of treated choices."""
        hit = F.col("chosen") == F.col("arm")
        return self.decisions(stream).agg(
            F.avg(F.when(hit, F.col("reward"))).alias("p"), F.avg(F.col("chosen").cast("double")).alias("b")).select(
            F.lit(policy_id).alias("policy_id"), F.lit(name).alias("policy_name"),
            F.coalesce("p", F.lit(0.0)).alias("avg_profit_per_user"), (F.col("b") * 100).alias("bid_rate_pct"),
            F.lit(description).alias("description"))

    def round_table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(int(r["round"]), int(r["matched"]), float(r["reward"]), int(r.get("matched_arm1", 0)))
             for r in self.rounds], "round int, matched long, reward double, matched_treatment long")

    def decisions(self, stream: DataFrame) -> DataFrame:
        """Every event with the arm chosen by its round's parameters.

        The parameters are a small table (one row per round) joined on the round;
        the UCB expression reads them by position, so its size does not grow with
        the number of rounds.
        """
        spark = stream.sparkSession
        params = spark.createDataFrame(
            [(r, c[0][0], c[0][1], c[1][0], c[1][1]) for r, c in self.params],
            "round int, m0 array<double>, q0 array<double>, m1 array<double>, q1 array<double>")
        joined = stream.join(F.broadcast(params), "round")   # one row per round
        chosen = self._choice((F.col("m0"), F.col("q0")), (F.col("m1"), F.col("q1")))
        return joined.withColumn("chosen", chosen).drop("m0", "q0", "m1", "q1")

    def trajectory(self, stream: DataFrame, baseline_profit: float, n_points: int = 2000,
                   buckets: int = 16, rows_per_bucket: int = 2_000_000) -> DataFrame:
        """Cumulative profit of matched events in replay order, downsampled to ``n_points``.

        Replay order is (round, order_key, unit). The order is cut into ranges
        of about ``rows_per_bucket`` rows (at least ``buckets`` of them), which
        are stored with their ids; running sums run inside each range on top
        of the totals of the ranges before it.
        """
        m = self.decisions(stream).where(F.col("chosen") == F.col("arm")).select("round", "order_key", "unit", "reward")
        ranges = max(1, buckets, -(-sum(r["matched"] for r in self.rounds) // rows_per_bucket))
        m = checkpointed(m.repartitionByRange(ranges, "round", "order_key", "unit").withColumn("_bk", F.spark_partition_id()))
        tot = m.groupBy("_bk").agg(F.count(F.lit(1)).alias("_n"), F.sum("reward").alias("_r"))
        prior = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        off = tot.select("_bk", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_n0"),
                         F.coalesce(F.sum("_r").over(prior), F.lit(0.0)).alias("_r0"))
        inside = Window.partitionBy("_bk").orderBy("round", "order_key", "unit")
        run = inside.rowsBetween(Window.unboundedPreceding, 0)
        rows = (m.join(off, "_bk")
                .select((F.row_number().over(inside) + F.col("_n0") - 1).alias("idx"),
                        (F.sum("reward").over(run) + F.col("_r0")).alias("cum")))
        n = tot.agg(F.sum("_n").alias("n"))
        grid = n.select("n", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(n_points - 1)),
            lambda k: F.floor(k.cast("long") * (F.col("n") - 1) / F.lit(max(n_points - 1, 1))).cast("long")))
            .alias("point", "idx"))
        # truncating linspace repeats indices when n < n_points; keep each index once
        pts = rows.join(F.broadcast(grid.dropDuplicates(["idx"])), "idx")
        base = (F.col("idx") + 1) * F.lit(float(baseline_profit))
        return pts.select(F.col("idx").cast("int").alias("impression_index"),
                          F.col("cum").alias("cumulative_profit_bandit"), base.alias("cumulative_profit_baseline"),
                          (F.col("cum") - base).alias("profit_delta"))
