"""Baseline A/B analysis command: per-arm counts, conversion rates with 95% intervals, ATE and relative lift.

    python -m upshot.plans.baseline_cli PATH [--outcome conversion]

Reads the table without narrowing (raw scan); one grouped aggregate over the whole table.
"""

from __future__ import annotations

import argparse

from upshot.operators import effects
from upshot.session import local_session
from upshot.sources.loader import read_experiment


def run(spark, path: str, outcome: str = "conversion"):
    df = read_experiment(spark, path, required=["treatment", outcome], narrow=False)
    return effects.baseline_ab(df, outcome).orderBy("treatment")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("path")
    ap.add_argument("--outcome", default="conversion")
    a = ap.parse_args(argv)
    rows = run(local_session(), a.path, a.outcome).collect()
    for r in rows:
        arm = "Treatment" if r["treatment"] == 1 else "Control"
        print(f"{arm:9s} n={r['n_obs']:,} conversions={int(r['conversions']):,} "
              f"rate={r['conversion_rate']:.4%} (95% CI {r['ci_lower']:.4%} .. {r['ci_upper']:.4%})")
    if rows:
        print(f"ATE={rows[0]['ate']:.6f}  relative lift={rows[0]['relative_lift_pct']:.2f}%")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
