from conftest import SF

import __spark_entry__ as E
from upshot.plans import all_queries as catalog


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["n_c"] + rows[0]["n_t"] == 1500


def test_registry_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50


def test_experiment_fixture_counts(spark):
    from upshot.sources.experiment import experiment
    import pyspark.sql.functions as F
    r = experiment(spark, SF).groupBy("treatment").agg(F.count("*").alias("n"), F.sum("conversion").alias("c"))
    got = {x["treatment"]: (x["n"], x["c"]) for x in r.collect()}
    assert got == {0: (225, 14), 1: (1275, 161)}


# Queries SQL cannot express (learners, trees, bandit, bootstrap, p-values, model-based streams, report):
ROWS_ONLY = {
    "tlearner_deciles", "xlearner_deciles",
    "propensity_by_arm", "surrogate_tree_rules", "feature_importance", "segment_rules_text", "distillation_fidelity",
    "score_and_bid", "linucb_replay", "bandit_trajectory", "uplift_archetypes_model", "segment_dim",
    "experiment_summary", "report_export_validation",
}


def test_every_sql_expressible_query_has_an_oracle():
    missing = set(catalog.QUERIES) - set(catalog.ORACLE)     # the corpus queries have tests of their own
    assert missing == ROWS_ONLY
