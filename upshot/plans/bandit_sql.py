"""LinUCB of two features as SQL: 2 x 2 systems in closed form, each round's state from the one before."""

from __future__ import annotations

STATE = [f"{n}{a}{k}" for a in (0, 1) for n, k in (("a", "11"), ("a", "12"), ("a", "22"), ("b", "1"), ("b", "2"))]


def ucb(a: int, alpha: float) -> str:
    """Upper bound of arm ``a`` for features x0, x1."""
    d = f"(a{a}11 * a{a}22 - a{a}12 * a{a}12)"
    mean = f"((a{a}22 * b{a}1 - a{a}12 * b{a}2) * x0 + (a{a}11 * b{a}2 - a{a}12 * b{a}1) * x1) / {d}"
    quad = f"(a{a}22 * x0 * x0 - 2 * a{a}12 * x0 * x1 + a{a}11 * x1 * x1) / {d}"
    return f"{mean} + {alpha} * sqrt(greatest({quad}, 0.0))"


def choice(alpha: float = 1.0) -> str:
    return f"CASE WHEN {ucb(1, alpha)} > {ucb(0, alpha)} THEN 1 ELSE 0 END"


def rounds_cte(rounds: int, alpha: float = 1.0) -> str:
    """``s``: state after each round (-1: before the first), over a table ``e`` (round, arm, x0, x1, r); needs WITH RECURSIVE."""
    sums = []
    for a in (0, 1):
        for name, what in ((f"a{a}11", "x0 * x0"), (f"a{a}12", "x0 * x1"), (f"a{a}22", "x1 * x1"), (f"b{a}1", "r * x0"), (f"b{a}2", "r * x1")):
            sums.append(f"any_value({name}) + coalesce(sum({what}) FILTER (hit AND arm = {a}), 0.0)")
    return f"""
, s(round, {', '.join(STATE)}, matched, reward) AS (
    SELECT -1, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE,
      1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0::BIGINT, 0.0::DOUBLE
    UNION ALL
    SELECT round + 1, {', '.join(sums)}, any_value(matched) + count(*) FILTER (hit),
      any_value(reward) + coalesce(sum(r) FILTER (hit), 0.0)
    FROM (SELECT s.*, e.x0, e.x1, e.arm, e.r, {choice(alpha)} = e.arm AS hit FROM s LEFT JOIN e ON e.round = s.round + 1) j
    WHERE round < {rounds - 1} GROUP BY round)
"""
