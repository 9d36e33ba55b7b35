"""upshot: experiment and uplift analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus small parameters) and returns a
DataFrame. Base rows never pass through the driver; the driver only sees
results whose size is bounded by a parameter (bins, grid points, features).

Modules:
    sources.experiment / loader / sinks    scans, schema contract, report sinks
    functions.quantiles / sampling         exact distributed quantiles, exact hash sampling
    functions.columns / dist / materialize column expressions, p-values, lineage helpers
    operators.validation / effects         SRM, balance, ATE, CUPED
    operators.ranking / segments / policy  deciles, Qini, bootstrap, audiences, replay and planning grids
    operators.monitor / learners / bandit  PSI and periods, T-/X-learners and trees, batched LinUCB
    streaming.events                       Structured Streaming monitor, SRM, PSI, scoring, LinUCB
    plans.report / run_report / *_cli      the end-to-end report and commands
"""

__version__ = "0.1.0"
