"""Import every query family so that the registry is complete."""

from upshot.plans import catalog, q_bandit, q_extra, q_loader, q_models, q_monitor, q_policy, q_report, q_segments, q_stream  # noqa: F401
from upshot.plans.registry import ORACLE, QUERIES  # noqa: F401
