"""Merkle manifest against a plain tree, with nulls, ties, repeated rows and clashing names."""

import hashlib
import zlib
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from upshot.llm import merkle, queries

SHAPE = ("doc_id long, text string, lang string, source string, n_chars long, "
         "g string, node string, rank long, part long, `at` long, top string, path string, levels int")
WORK = ("g", "n", 1, 2, 3, "t", "p", 4)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return sha(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i:i + arity]) for i in range(0, len(last), arity)])
    return levels


def siblings(levels, i, arity):
    path = []
    for level in levels[:-1]:
        start = i - i % arity
        path.append(("".join(level[start:i]), "".join(level[i + 1:start + arity])))
        i //= arity
    return path


def plain(rows, arity=2):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row by lists."""
    groups = {}
    for r in rows:
        i, text, lang, source, n = r
        whole = leaf(i, source, lang, n, text)
        bad = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
        groups.setdefault(lang, []).append(((i is not None, i or 0), whole, leaf(i, source, lang, n + 1, text) if bad else whole, i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[1] for x in sorted(groups[g], key=lambda x: x[:2])], arity) for g in names}
    upper = tree([trees[g][-1][0] for g in names], arity)
    for place, g in enumerate(names):
        for pos, (_, whole, claim, i) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            path = siblings(trees[g], pos, arity) + siblings(upper, place, arity)
            node = claim
            for left, right in path:
                node = sha(left, node, right)
            yield (i, whole, trees[g][-1][0], upper[-1][0], sha(*[a + b for a, b in path]), node, node == upper[-1][0])


def found(spark, rows, arity=2):
    docs = spark.createDataFrame([(*r, *WORK) for r in rows], SHAPE)
    fields = lambda n: (F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    bad = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    docs = docs.withColumn("claim", F.when(bad, merkle.leaf(*fields(F.col("n_chars") + 1))))
    got = merkle.manifest(docs, merkle.leaf(*fields(F.col("n_chars"))), F.col("lang"), F.col("doc_id"),
                          ["doc_id", "claim", "g", "node"], arity)
    return got.select("doc_id", "__proof.leaf", "__proof.subroot", "__proof.root",
                      merkle.path_digest(F.col("__proof.path")).alias("proof"),
                      merkle.fold(F.coalesce("claim", "__proof.leaf"), F.col("__proof.path")).alias("folded"),
                      "g", "node")


@pytest.mark.parametrize(("arity", "levels", "digits"), [(2, 1, 2), (3, 2, 1), (2, 4, 3)])
def test_equals_a_plain_tree(spark, monkeypatch, arity, levels, digits):
    monkeypatch.setattr(merkle, "DIGIT_LEVELS", levels)
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = [(i, f"text {i} é", ["en", "fr", "é", None, "z"][0 if i % 3 else i % 5], None if i % 4 else "s", None if i % 6 == 5 else i)
            for i in range(70)]
    rows += [(None, "a", "en", "s", 1), (None, "b", "en", "s", 1), (7, "tie", "en", "s", 1), (7, "tie", "en", "s", 1),
             (500, None, "only", None, None), (501, "", "", "s", 0), (502, "long " * 100_000, "en", "s", 9)]
    got = found(spark, rows, arity).collect()
    want = list(plain(rows, arity))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded, r.folded == r.root) for r in got), key=key) == sorted(want, key=key)
    assert {(r.g, r.node) for r in got} == {("g", "n")}
    assert 0 < sum(not r[-1] for r in want) < len(want)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_small_tables(spark, n):
    rows = [(i, f"{i}", "en", "s", 1) for i in range(n)]
    got = found(spark, rows).collect()
    assert sorted((r.doc_id, r.proof, r.folded) for r in got) == sorted((w[0], w[4], w[5]) for w in plain(rows))


def test_proofs_need_no_join_and_no_python(spark, capsys):
    queries.QUERIES["op11_merkle"](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan


def test_any_change_breaks_the_proof(spark):
    rows = [(i, f"t{i}", "en" if i % 2 else "fr", "s", 1) for i in range(9)]
    roots = {found(spark, rows[:k] + [(rows[k][0], "other", *rows[k][2:])] + rows[k + 1:]).first().root for k in range(2)}
    roots.add(found(spark, rows).first().root)
    assert len(roots) == 3 and all(a != b for a, b in pairwise(sorted(roots)))
