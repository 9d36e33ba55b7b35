"""Validation-only command: SRM verdict and the worst imbalanced features of an experiment table.

    python -m upshot.plans.validate_cli PATH [--ratio 0.85] [--alpha 0.001] [--master local[*]]

Needs only the ``treatment`` column (features are the columns starting with ``f``).
One fused aggregate (one scan) for both checks; output is a handful of rows.
"""

from __future__ import annotations

import argparse

from upshot.operators import validation
from upshot.session import local_session
from upshot.sources.loader import read_experiment


def run(spark, path: str, ratio: float = 0.85, alpha: float = 0.001, top: int = 5):
    df = read_experiment(spark, path, required=["treatment"])
    feats = validation.discover_features(df)
    if not feats:
        return validation.check_srm(df, expected_ratio=ratio, alpha=alpha, with_p=True), None, None
    srm, balance = validation.integrity(df, feats, expected_ratio=ratio, alpha=alpha)   # one scan for both
    return srm, balance, validation.imbalanced_features(balance, top)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("path")
    ap.add_argument("--ratio", type=float, default=0.85)
    ap.add_argument("--alpha", type=float, default=0.001)
    ap.add_argument("--master", default="*")
    a = ap.parse_args(argv)
    spark = local_session(a.master.strip("local[]") or "*")
    srm, balance, worst = run(spark, a.path, a.ratio, a.alpha)
    r = srm.first()
    print(f"SRM: control={r['n_control']} treatment={r['n_treatment']} chi2={r['chi2']:.4f} "
          f"p={r['p_value']:.6g} -> {'PASS' if r['valid'] else 'FAIL'}")
    if worst is None:
        print("No feature columns found.")
    elif worst.count() == 0:
        print("All features are balanced (|SMD| < 0.1)")
    else:
        worst.show(truncate=False)
    return 0 if r["valid"] else 1


if __name__ == "__main__":
    raise SystemExit(main())
