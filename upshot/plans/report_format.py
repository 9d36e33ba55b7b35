"""Presentation of the report tables: rounding (half-even), narrow types and column order.

Applied only when a table is written; all computation upstream keeps doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Decimals per column, narrow types and column order of the report tables.
FORMATS: dict[str, dict] = {
    "experiment_summary": {
        "round": {"control_cr": 6, "treatment_cr": 6, "ate_absolute": 6, "ate_relative": 6, "ate_ci_lower": 6,
                  "ate_ci_upper": 6, "ate_p_value": 8, "ate_std_error": 8, "cuped_ate_absolute": 6,
                  "cuped_ci_lower": 6, "cuped_ci_upper": 6, "cuped_std_error": 8, "cuped_p_value": 8,
                  "srm_p_value": 6, "max_smd": 6, "baseline_profit_per_user": 6, "bandit_profit_per_user": 6,
                  "student_r2": 4},
        "order": ["run_date", "n_control", "n_treatment", "n_total", "traffic_split_expected", "control_cr",
                  "treatment_cr", "ate_absolute", "ate_relative", "ate_ci_lower", "ate_ci_upper", "ate_p_value",
                  "ate_std_error", "cuped_ate_absolute", "cuped_ci_lower", "cuped_ci_upper", "cuped_std_error",
                  "cuped_p_value", "srm_p_value", "srm_valid", "max_smd", "conversion_value", "cost_per_ad",
                  "baseline_profit_per_user", "bandit_profit_per_user", "bandit_aligned_events", "student_r2"],
    },
    "bandit_trajectory": {
        "round": {"cumulative_profit_bandit": 4, "cumulative_profit_baseline": 4, "profit_delta": 4},
        "cast": {"impression_index": "int"},
    },
    "uplift_sample": {
        "round": {"uplift_score": 6, "baseline_conversion_prob": 6},
        "cast": {"uplift_score": "float", "baseline_conversion_prob": "float", "treatment": "tinyint",
                 "conversion": "tinyint", "visit": "tinyint", "persuadable_flag": "tinyint", "row_id": "int"},
        "order": ["row_id", "treatment", "conversion", "visit"],
    },
    "decile_stats": {
        "round": {"mean_pred_uplift": 6, "mean_y_control": 6, "mean_y_treatment": 6, "actual_lift": 6},
        "cast": {"mean_pred_uplift": "float", "mean_y_control": "float", "mean_y_treatment": "float",
                 "actual_lift": "float", "n_obs": "int", "n_control": "int", "n_treatment": "int"},
        "order": ["decile", "n_obs", "n_control", "n_treatment", "mean_pred_uplift", "mean_y_control",
                  "mean_y_treatment", "actual_lift"],
    },
    "covariate_balance": {
        "round": {"smd": 6, "abs_smd": 6},
        "cast": {"smd": "float", "abs_smd": "float", "is_balanced": "tinyint"},
        "order": ["feature", "smd", "abs_smd", "is_balanced"],
    },
    "statistics_results": {
        "round": {"control_mean": 6, "treatment_mean": 6, "absolute_effect": 6, "relative_effect": 6,
                  "ci_lower": 6, "ci_upper": 6, "ci_width": 6, "p_value": 8, "std_error": 8},
        "order": ["method", "control_mean", "treatment_mean", "absolute_effect", "relative_effect", "ci_lower",
                  "ci_upper", "ci_width", "p_value", "std_error"],
    },
    "qini_curve_data": {
        "round": {"population_pct": 4, "y_mean": 4, "y_lower_95ci": 4, "y_upper_95ci": 4, "auuc_mean": 4,
                  "auuc_std": 4},
        "order": ["population_pct", "y_mean", "y_lower_95ci", "y_upper_95ci", "auuc_mean", "auuc_std"],
    },
    "feature_importance": {
        "round": {"importance": 6, "threshold_value": 4},
        "cast": {"rank": "tinyint"},
        "order": ["feature", "importance", "threshold_value", "threshold_direction", "rank"],
    },
    "segment_profile": {
        "round": {"persuadable_mean": 4, "other_mean": 4, "diff_pct": 2},
        "cast": {"persuadable_mean": "float", "other_mean": "float", "diff_pct": "float", "feature_rank": "tinyint"},
        "order": ["feature", "persuadable_mean", "other_mean", "diff_pct", "feature_rank"],
    },
    "policy_comparison": {
        "round": {"avg_profit_per_user": 4, "bid_rate_pct": 1},
        "order": ["policy_id", "policy_name", "avg_profit_per_user", "bid_rate_pct", "description"],
    },
    "archetype_summary": {
        "round": {"pct_of_total": 2, "avg_uplift_score": 6, "avg_baseline_conv_prob": 6,
                  "avg_actual_conversion_rate": 6, "expected_profit_per_user": 4},
        "order": ["archetype_label", "count", "pct_of_total", "avg_uplift_score", "avg_baseline_conv_prob",
                  "avg_actual_conversion_rate", "expected_profit_per_user", "bid_recommendation"],
    },
    "tree_rules": {"round": {"predicted_uplift": 6}},
    "distillation_benchmark": {"round": {"fidelity_r2": 4}},
    "monitoring_timeseries": {
        "round": {"bid_rate_pct": 2, "avg_uplift_score": 6, "avg_conversion_rate": 6, "expected_profit_per_user": 4},
    },
    "psi_scores": {"round": {"psi": 6}, "cast": {"psi": "float"}, "order": ["week", "feature", "psi", "rag_status"]},
    "drift_simulation": {"round": {"uplift_score": 6}},
}


def format_table(name: str, df: DataFrame) -> DataFrame:
    """Round (half-even), cast and order the columns of one report table; unknown tables pass through."""
    spec = FORMATS.get(name)
    if not spec:
        return df
    rnd, cast = spec.get("round", {}), spec.get("cast", {})
    cols = []
    for c in df.columns:
        e = F.col(c)
        if c in rnd:
            e = F.bround(e.cast("double"), rnd[c])
        if c in cast:
            e = e.cast(cast[c])
        cols.append(e.alias(c))
    out = df.select(*cols)
    order = [c for c in spec.get("order", []) if c in out.columns]
    return out.select(*order, *[c for c in out.columns if c not in order])
