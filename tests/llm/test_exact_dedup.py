"""Exact dedup against brute force, with collisions forced, long texts, nulls, ties and clashing names."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from upshot.llm import exact_dedup
from upshot.llm.bytesarr import text_bytes

SHAPE = "doc_id long, text string, row string, id long, body string, n long, fp long, gid long, __exact string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, "b", 2, 3, 4, "e") for i, t in rows], SHAPE)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").encode(), []).append(i)
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(ids):
            yield i, ids[-1], len(ids), k == len(ids) - 1, hashlib.sha256(text).hexdigest()


def found(spark, rows):
    docs = frame(spark, rows).withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    keep = ["doc_id", "sha", "row", "id", "body", "n", "fp", "gid"]
    out = exact_dedup.exact_groups(docs, F.col("text"), "doc_id", keep)
    got = out.select("doc_id", "__exact.*", "sha", "row", "fp").collect()
    assert all((r.row, r.fp) == ("r", 3) for r in got)
    return [(r.doc_id, r.keep_id, r.group_size, r.kept, r.sha) for r in got]


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    some = ["".join(rng.choices("abé \n", k=rng.randint(1, 90))) for _ in range(25)]
    out = [(i, rng.choice(some)) for i in range(150)] + [(1000 + i, "the hot text") for i in range(90)]
    out += [(3, None), (4, ""), (None, ""), (None, "x"), (None, "x"), (5, "tie"), (5, "tie"), (5, "tie"), (6, "\x00"), (7, "\x00\x00")]
    long = "".join(rng.choices("abcdefgh", k=70_000))
    return out + [(2000, long), (2001, long), (2002, long[:-1] + "z"), (2003, "z" + long[1:]), (2004, long + long)]


def test_equals_brute_force(spark, rows):
    same(found(spark, rows), brute(rows))


def test_long_texts_hashed_in_many_tasks(spark, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SPREAD", 50)
    docs = frame(spark, rows).select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    docs = docs.withColumn("n", F.octet_length("body").cast("long"))
    spread = {(r.doc_id, r.body): r.fp for r in exact_dedup.keyed(docs).collect()}
    monkeypatch.setattr(exact_dedup, "SPREAD", 1 << 40)
    assert spread == {(r.doc_id, r.body): r.fp for r in exact_dedup.keyed(docs).collect()}


def test_collisions_are_told_apart(spark, rows, monkeypatch):
    """Every text of one length has one fingerprint, the bitmap is full, and chunks are tiny."""
    monkeypatch.setattr(exact_dedup, "FIELDS", ((1, 1), (1, 1)))
    monkeypatch.setattr(exact_dedup, "CHUNK", 7)
    monkeypatch.setattr(exact_dedup, "FILTER_BITS", 1 << 15)
    few = [r for r in rows if len(r[1] or "") < 100]
    same(found(spark, few), brute(few))


def test_polynomial_composes(rows):
    import pyarrow as pa
    texts = [t.encode() if t else b"" for _, t in rows]
    raw, off = text_bytes(pa.array(texts, pa.binary()))
    for prime, base in exact_dedup.FIELDS:
        got = exact_dedup.polynomial(raw, off, prime, base)
        for text, value in list(zip(texts, got.tolist(), strict=True))[-12:]:
            want, power = 0, 1
            for b in text:
                want, power = (want + (b + 1) * power) % prime, power * base % prime
            assert value == want
        left, right = texts[0], texts[-1]
        whole = exact_dedup.polynomial(np.frombuffer(left + right, np.uint8), np.array([0, len(left) + len(right)]), prime, base)
        assert whole[0] == (got[0] + got[-1] * pow(base, len(left), prime)) % prime


def test_empty_table_and_kept_rows(spark, rows):
    assert exact_dedup.drop_copies(frame(spark, [])).count() == 0
    kept = exact_dedup.drop_copies(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    want = sorted((i or -1, t or "") for i, t in {t or "": (i, t) for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))}.values())
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == want
