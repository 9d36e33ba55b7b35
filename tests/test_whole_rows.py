"""Registered queries that judge no trained model read all rows; learners have the surveyed size; the stream has rounds."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from upshot.plans import q_models, q_stream
from upshot.plans.registry import scored
from upshot.sources.tables import read_table
from upshot.streaming import events as st


def test_score_and_bid_counts_all_rows(spark):
    out = q_models.q_score_bid(spark, SF)
    assert out.agg(F.sum("n")).first()[0] == scored(spark, SF).count()


def test_learners_have_the_surveyed_size(spark, monkeypatch):
    sizes = []

    class Seen(Exception):
        pass

    def learner(features, n_estimators, max_depth):
        sizes.append((n_estimators, max_depth))
        raise Seen

    monkeypatch.setattr(q_models.learners, "TLearner", learner)
    monkeypatch.setattr(q_models.learners, "PropensityModel", learner)
    for query in (q_models.q_tlearner, q_models.q_propensity):
        with pytest.raises(Seen):
            query(spark, SF)
    assert sizes == [(100, 5)] * 2


def test_stream_linucb_learns_over_rounds(spark):
    out = q_stream.q_stream_linucb(spark, SF).toPandas().sort_values("batch_id")
    assert len(out) == q_stream.ROUNDS and out.matched.is_monotonic_increasing
    ev = read_table(spark, SF, "events")
    source, spans, seen = st.Arrivals(ev, 4), [], 0
    for _ in source:
        landed = spark.read.parquet(f"{source.folder}/events.parquet")
        n, hi = landed.agg(F.count("*"), F.max("ts")).first()
        assert n > seen and (not spans or hi > spans[-1])
        if spans:       # what arrives is later than all that was there
            assert landed.where(F.col("ts") > F.lit(spans[-1])).count() == n - seen
        spans.append(hi)
        seen = n
    assert len(spans) == 4 and seen == ev.count()
