"""Conversation repair against a plain search over edit sequences."""

import hashlib
import heapq
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from upshot.llm import conversation_repair as cr

SHAPE = "conv_id long, turn long, role string, text string, conv string, cid long, symbols string, audit string, cost long"
GOOD = re.compile(r"(s?(ua)+)?\Z")
VIABLE = re.compile(r"s?(ua)*u?\Z")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "s", "a", 9) for r in rows], SHAPE)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], " " if r[3] is None else r[3]))


def search(faulty):
    """Cheapest edits by a uniform-cost search over (rows consumed, roles so far reduced to their end)."""
    heap, best = [(0, "", 0, "", ())], None
    seen = {}
    while heap:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if i == len(faulty) and GOOD.match(roles):
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, out)
            continue
        state = (i, "" if not roles else roles[-1])
        if seen.get(state, (cost, audit)) < (cost, audit):
            continue
        seen[state] = (cost, audit)
        options = [(3, "I", c, i, (n, "")) for c, n in (("u", "user"), ("a", "assistant"))]
        if i < len(faulty):
            role, text, fault = faulty[i]
            extra = 3 if fault == "t" else 0
            options.append((4, "D", "", i + 1, None))
            if fault in ("", "t"):
                options.append((extra, "K", role[:1] or "?", i + 1, (role, text)))
                options += [(3 + extra, "R", c, i + 1, (n, text)) for c, n in (("u", "user"), ("a", "assistant"))]
        for add, letter, c, j, line in options:
            if VIABLE.match(roles + c) and len(audit) < 2 * len(faulty) + 4:
                heapq.heappush(heap, (cost + add, audit + letter, j, roles + c, out + ((line,) if line else ())))
    return best


def brute(rows):
    for conv, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: r[0]):
        mine, seen, faulty = in_order(group), set(), []
        for _, _, role, text in mine:
            role, text = " " if role is None else role, " " if text is None else text
            shown = text.strip(" \t\n\v\f\r")
            fault = "b" if not shown else "d" if (role, text) in seen else "" if shown[-1] in ".!?" else "t"
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [r[1] for r in mine if r[1] is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in {"su", "ua", "au"} for a, b in itertools.pairwise(faulty))
        cost, audit, out = search(faulty)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        counts = [sum(f[2] == k for f in faulty) for k in "bdt"]
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, illegal, cost, audit, digest)


def found(spark, rows):
    got = cr.Repair(frame(spark, rows), *[F.col(c) for c in ("conv_id", "turn", "role", "text")])
    order = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return got, [tuple(r[c] for c in order) for r in got.conversations().collect()]


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    say = ["Yes.", "No", "", " \t", None, "Why?", "é!", "ends.\n", "again."]
    roles = ["user", "assistant", "system", "tool", None, "", "unicorn"]
    out = [(c, t, rng.choice(roles[:3] if c % 2 else roles), rng.choice(say) if rng.random() < 0.5 else f"t{t}{rng.choice(['.', ''])}")
           for c in range(60) for t in range(rng.randint(1, 7)) if rng.random() < 0.9]
    out += [(None, t, "user", f"{t}.") for t in range(3)]
    out += [(100, None, "user", "a."), (100, None, "assistant", "b."), (100, 5, "user", "a."), (100, 9, "user", "a.")]
    out += [(101, 1, "user", "tie."), (101, 1, "user", "tie."), (101, 1, "assistant", "x."), (102, 7, "assistant", "long " * 50_000 + ".")]
    return out


def test_equals_a_plain_search(spark, rows):
    same(found(spark, rows)[1], brute(rows))


@pytest.mark.parametrize(("chunk", "rounds"), [(1, 0), (2, 1), (3, 4)])
def test_conversations_over_many_chunks(spark, rows, monkeypatch, chunk, rounds):
    monkeypatch.setattr(cr, "CHUNK_ROWS", chunk)
    plain = cr.learn
    monkeypatch.setattr(cr, "learn", lambda strings: plain(strings, rounds, 4))
    shuffled = random.Random(1).sample(rows, len(rows))
    same(found(spark, shuffled)[1], brute(rows))


def test_grammar_changes_no_result():
    rng = random.Random(4)
    plain, ruled = cr.Grammar(), cr.Grammar()
    for pair in ("ua", "uA", "DD", chr(0xE000) * 2, "a" + chr(0xE002), "oS"):
        ruled.add(pair)
    for n in range(200):
        text = "".join(rng.choices("sSuUaAoOD", k=n % 40))
        assert plain.solve(text) == ruled.solve(text)
        cut = rng.randint(0, len(text))
        one = cr._matrix({(i, i): (0, "") for i in range(4)})
        halves = cr.product(ruled.start, cr.product(ruled.multiply(one, text[:cut]), ruled.multiply(one, text[cut:])))
        assert cr.best(halves) == plain.solve(text)


def test_one_long_conversation_is_dealt_over_tasks(spark):
    rows = [(1, t, "assistant" if t % 3 else "user", f"{t % 400}.") for t in range(4000)]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        repair, got = found(spark, rows)
    finally:
        spark.conf.set(name, before)
    assert repair.multi.select(F.shiftright("cid", 33)).distinct().count() > 1
    conv, gaps, blank, duplicate, truncated, illegal, cost, audit, digest = got[0]
    first = {}
    for t, r in enumerate(rows):
        first.setdefault(r[2:], t)
    symbols = "".join(("D" if first[r[2:]] != t else r[2][0]) for t, r in enumerate(rows))
    assert (cost, audit) == cr.Grammar().solve(symbols) and duplicate == symbols.count("D")
    turns = [x for r in repair.turns().orderBy("conv", "cid").collect() for x in r.turns]
    assert digest == hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in turns).encode()).hexdigest()
    assert GOOD.match("".join(x.role[0] for x in turns))


def test_empty_table(spark):
    assert found(spark, [])[1] == []
