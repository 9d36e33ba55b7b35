"""Corpus operators against brute force on small tables, with nulls, empty texts, repeated rows and clashing names."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from upshot.llm import (decontaminate, html_text, mixing, neighbours, passages, queries, simhash, suffix_dedup,
                        token_counts, toxicity, url_filter)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, name string, id long, body string, v string"


def frame(spark, rows, extra=True):
    """documents with extra columns whose names clash with working names."""
    return spark.createDataFrame([(i, t, "en", s, len(t) if t else None, "x", 1, "b", "v") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijé", k=rng.randint(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    shared, base = say(70), say(160)
    near = base.split()
    near[40] = "changed"
    rows = [(i, say(rng.randint(1, 200)), f"s{i % 3}") for i in range(30)]
    rows += [(100, say(30) + " " + shared + " " + say(20), "s0"), (101, say(10) + " " + shared, "s1"),
             (102, shared[:len(shared) // 2] + " " + say(5), None), (103, base, "s0"), (104, " ".join(near), "s0"),
             (105, base, "s1"), (105, base, "s1"), (106, None, "s2"), (107, "", "s2"), (108, " \t\n", None),
             (None, say(60), "s0"), (109, "a" * 900, "s1"), (110, say(3000), "s2")]
    return rows


def brute_repeats(rows, length):
    seen = {}
    for _, t, _ in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]] = seen.get(b[p:p + length], 0) + 1
    for i, t, _ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        yield i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def test_suffix_dedup_equals_brute_force(spark, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 5000)
    got = suffix_dedup.remove_repeats(frame(spark, texts), keep_text=True)
    rows = got.select("doc_id", "__removed.*").collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted(
        (i or -1, *rest) for i, *rest in brute_repeats(texts, 200))
    assert sum(r.n_removed for r in rows) > 0
    for r in rows:
        assert len(r.kept_text.encode()) >= r.n_bytes - r.n_removed
    assert got.columns[:9] == frame(spark, texts).columns
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_hot_buckets_are_dealt_over_tasks(spark, texts, monkeypatch):
    """Every bucket counts as hot; results stay those of brute force."""
    monkeypatch.setattr(suffix_dedup, "HOT", 10**9)
    monkeypatch.setattr(suffix_dedup, "SALTS", 3)
    hot = texts + [(500 + i, texts[5][1] + " " + str(i), "s1") for i in range(12)]
    rows = suffix_dedup.remove_repeats(frame(spark, hot), keep_text=False).select("doc_id", "__removed.*").collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted(
        (i or -1, *rest) for i, *rest in brute_repeats(hot, 200))


def brute_hits(text, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    doc, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(13, len(w))
        for p in range(len(w) - n + 1) if n else ():
            for q in range(len(doc) - n + 1):
                if doc[q:q + n] == w[p:p + n]:
                    hit.update(range(q, q + n))
                    found.add(item)
    return len(doc), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [10**7, 60])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choices(["the", "of", "Ähre", "x1", "and"], k=n))
    items = [(1, say(20)), (2, say(4)), (3, None), (4, "..."), (5, say(40)), (6, say(13))]
    items.append((7, items[0][1]))
    rows = [(i, say(60) + ", " + rng.choice([t for _, t in items[:1] + items[4:]])[:90] + "! " + say(10), "s") for i in range(12)]
    rows += [(50, None, "s"), (51, "", "s"), (52, items[5][1].upper().replace("Ä", "Ä"), "s"), (52, items[4][1], "s")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(frame(spark, rows), bench, block_bytes=block_bytes)
    seen = [(r.doc_id, r.text, r["__match"]) for r in got.collect()]
    assert len(seen) == len(rows)
    for _, text, m in seen:
        words, hit, found = brute_hits(text, items)
        assert (m.n_words, sum(x.hi - x.lo for x in m.runs), list(m["items"])) == (words, hit, found)
        assert (m.longest is None) == (not found)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(frame(spark, rows), empty).where(decontaminate.contaminated(F.col("__match"))).count() == 0


def test_longest_match_uses_all_places_of_a_window(spark):
    _, say = word_maker(11)
    shared, own = say(30), say(20)
    item = own + shared + say(20)
    items = [(1, say(8) + shared), (2, item), (3, shared + say(9))]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    docs = frame(spark, [(1, " ".join(say(5) + item + say(5)), "s")])
    found = decontaminate.matches(docs, bench).first()["__match"].longest
    assert (found.words, found.doc_word, found.item, found.item_word) == (70, 5, 2, 0)


def brute_simhash(text):
    import xxhash
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(spark, texts, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 8)
    monkeypatch.setattr(simhash, "BLOCK", 4)
    got = simhash.near_duplicates(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    prints = {(i, t): brute_simhash(t) for i, t, _ in texts}
    ids = list(prints)
    label = {k: k[0] if k[0] is not None else 10**9 for k in ids}
    for _ in ids:
        for a, b in itertools.combinations(ids, 2):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                label[a] = label[b] = min(label[a], label[b])
    want = sorted((i if i is not None else -1, prints[i, t], label[i, t]) for i, t, _ in texts)
    assert sorted((r.id if r.id is not None else -1, r.fp % 2**64, 10**9 if r.component is None else r.component) for r in got) == want
    kept = simhash.keep_one(frame(spark, texts)).collect()
    assert len(kept) == len(set(label.values()))
    assert simhash.keep_one(frame(spark, [])).count() == 0


def test_vantage_shards_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300, dtype=np.int64)
    near = base[:150] ^ (np.int64(1) << rng.integers(0, 62, 150)) ^ (np.int64(1) << rng.integers(0, 62, 150))
    points = np.unique(np.r_[base, near]).view(np.uint64)
    tree = simhash.VantageTree(points[::3], 5, 3)
    shard, at = tree.route(points)
    where = {}
    for s, i in zip(shard, at, strict=True):
        where.setdefault(int(i), set()).add(int(s))
    for i, j in zip(*np.nonzero(np.triu(simhash._distance(points[:, None], points[None]) <= 3, 1)), strict=True):
        assert where[int(i)] & where[int(j)]


def test_mix_meets_targets(spark, texts):
    rows = mixing.mix(frame(spark, texts), rows_per_bucket=4).collect()
    assert len(rows) == len(texts)
    size = {}
    for _, t, s in texts:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    taken = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and len(r.positions) * r.size == r.taken
        assert all(0 <= p <= 1 for p in r.positions)
        taken.setdefault(r.source_size, [0, r.target])[0] += r.taken
    assert abs(sum(t for _, t in taken.values()) - 1.5 * sum(size.values())) < 1e-6
    largest = max(r.size for r in rows)
    assert all(abs(a - t) <= largest for a, t in taken.values())
    known = [r.position for r in rows if r.position is not None]
    assert known == sorted(known)
    assert mixing.mix(frame(spark, [])).count() == 0


def test_buckets_change_no_position(spark, texts):
    docs = frame(spark, texts + [(None, "other words", "s1"), (None, None, "s1")])
    few, many = (sorted((repr(tuple(r)) for r in mixing.mix(docs, rows_per_bucket=n).collect())) for n in (1_000_000, 1))
    assert few == many


def test_training_order_lists_every_pass(spark, texts):
    docs = frame(spark, texts)
    order = mixing.training_order(docs).collect()
    taken = {}
    for r in order:
        taken.setdefault(r.doc_id, []).append(r.position)
    assert [r.position for r in order] == sorted(r.position for r in order)
    for r in mixing.mix(docs).collect():
        if r.doc_id not in (None, 105):             # ids of several rows
            assert sorted(taken.get(r.doc_id, [])) == sorted(r.positions)


def test_targets_are_filled_to_a_level(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), (None, 10)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 200 and got[None] == 20 and abs(got["b"] - (1665 - 220)) < 1e-9


def test_token_counts_equal_the_library(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = [(200, "a <|endoftext|> b", "s"), (201, "日本語 text x  \n y", "s"), (202, "it's we'll  DON'T 12ab²", "s")]
    odd += [(300 + k, " ".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(k, k + 40)), "s") for k in range(32, 600, 40)]
    rows = texts + odd
    docs = frame(spark, rows)
    got = docs.select("text", token_counts.token_counts(docs, path, F.col("text")).alias("n")).collect()
    tool = Tokenizer.from_file(path)
    for r in got:
        assert r.n == len(tool.encode(r.text or "", add_special_tokens=False)), r.text


def test_url_rules_and_trust(spark):
    link = lambda *hosts: " ".join(f'<a href="https://{h}/x">l</a>' for h in hosts)
    pages = [(1, "http://A.Example.org/en/12?q", link("good.net")), (2, "http://a.example.org/fr/", None),
             (3, "http://bad.com/de/1", link("good.net")), (4, "http://spam.net/x", link("bad.com")),
             (5, "http://good.net", ""), (6, None, "x"), (7, "no-scheme/x", "y"), (8, "http://q.com/fr/a#b", None),
             (8, "http://q.com/fr/a#b", None)]
    df = spark.createDataFrame([(*p, "h", "r") for p in pages], "page_id long, url string, html string, host string, rule string")
    got = {r.page_id: (r["__url_host"], r["__url_path"], r["__url_rule"], r["__url_verdict"]) for r in url_filter.judge(df).collect()}
    assert got[1] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("a.example.org", "/fr/", "org/", "allow")
    assert got[3][2:] == ("com/de/", "block") and got[8] == ("q.com", "/fr/a", "com/fr/", "allow")
    assert got[4][2:] == (None, "block")        # links to a blocked host
    assert got[5] == ("good.net", "", None, "allow")
    assert got[6] == ("", "", None, "allow") and got[7] == ("", "", None, "allow")
    assert url_filter.judge(df.limit(0)).count() == 0


def test_trust_equals_the_closed_form(spark):
    hosts = ["a.org", "b.net", "c.net", "d.net"]
    edges = [("a.org", "b.net"), ("b.net", "c.net"), ("b.net", "a.org"), ("d.net", "b.net"), ("a.org", "b.net")]
    pages = [(i, f"http://{s}/", f'<a href="http://{d}/">x</a>') for i, (s, d) in enumerate(edges)]
    got = {r.host: r.trust for r in url_filter.host_trust(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    m = np.zeros((4, 4))
    for s, d in edges:
        m[hosts.index(d), hosts.index(s)] += 1
    m /= np.maximum(m.sum(axis=0), 1)
    seed = np.array([1.0, 0, 0, 0])
    lost = m.sum(axis=0) == 0                       # hosts without links give their mass back to the seeds
    whole = m + np.outer(seed, lost)
    rank = np.linalg.solve(np.eye(4) - 0.85 * whole, 0.15 * seed)
    assert abs(sum(got.values()) - 1) < 1e-9 and abs(rank.sum() - 1) < 1e-9
    assert np.allclose([got[h] for h in hosts], rank, atol=2 * url_filter.TOLERANCE)


def test_html_main_text(spark):
    chrome = ('<html><head><title>T</title><script>x("<p>no</p>")</script></head><body><header>Site</header><nav><ul><li>'
              '<a href="/">Home</a></ul></nav><div class="cookie-notice">We use</div>{}<aside>side</aside>'
              '<div class="comments"><p>first!</p></div><form><p>mail</p></form><footer>&copy;</footer></body></html>')
    pages = [(i, "http://h.net/1", chrome.format(f"<div id=story><p>One &amp; <b>t</b>wo<br>lines {i}<p>Next\n\n para.<!-- c --></div>"))
             for i in range(3)]
    pages += [(10, "http://art.net/", "<body><p>menu</p><article><h1>Title</h1><p>Body text</article><p>end</p>"),
              (11, None, None), (12, "http://e.net", ""), (12, "http://e.net", "")]
    got = [(r.page_id, r["__text"]) for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()]
    assert sorted(got) == [*[(i, f"One & two lines {i}\nNext para.") for i in range(3)], (10, "Title\nBody text"), (11, ""),
                           (12, ""), (12, "")]


PAGES = "page_id long, url string, html string"


def main_text(spark, pages):
    return {r.page_id: r["__text"] for r in html_text.extract(spark.createDataFrame(pages, PAGES)).collect()}


def test_html_templates_of_one_host(spark, monkeypatch):
    monkeypatch.setattr(html_text, "FOLD", 2)
    extra = lambda i: "".join(f"<h{k}>Head {k}</h{k}>" for k in range(2, 2 + i % 5))
    pages = [(i, "http://h.net/a", f"<body><article>{extra(i)}<p>Article {i}</article></body>") for i in range(10)]
    pages += [(20, "http://h.net/b", "<body><main><p>In main</main></body>"), (21, None, "<body><div id=x><p>Plain text</div>"),
              (22, "none", "<body><article><p>Other</article>"), (23, "http://h.net/c", "<body><div id=y><p>Div text</div>")]
    # one slot name at two places of the expression: the first is links, the second text
    pages += [(30 + i, "http://l.net/", f"<body><div><p><a href=x>Home of all pages</a></p><h2>Title</h2><p>Long text of page {i}</p></div>")
              for i in range(3)]
    got = main_text(spark, pages)
    assert all(got[i].split("\n")[-1] == f"Article {i}" and len(got[i].split("\n")) == 1 + i % 5 for i in range(10))
    assert (got[20], got[21], got[22], got[23]) == ("In main", "Plain text", "Other", "Div text")
    assert all(got[30 + i] == f"Title\nLong text of page {i}" for i in range(3))


def test_html_layout_names_and_skipped_elements(spark):
    pages = [(1, "http://a.net/", "<body class='page right-sidebar'><div id=wrap class=has-sidebar><article><p>One</article></div>"),
             (2, "http://b.net/", "<body class=comments><div class=content-with-comments><p>Two</div><div class=comments><p>no</div>"),
             (3, "http://c.net/", "<body><div class=comments><article><p>Three</article></div>"),
             (4, "http://d.net/", "<body><article><svg viewBox='0' /><p>Four<video-player src=x></video-player></p><canvas><p>end</article>"),
             (5, "http://e.net/", "<body><div class=comments><article><p>no</article></div><article><p>Five</article>")]
    assert main_text(spark, pages) == {1: "One", 2: "Two", 3: "Three", 4: "Four\nend", 5: "Five"}


def test_wrapper_alignment():
    a = html_text.collapse(["h", "p", "p", "f"])
    b = html_text.collapse(["h", "x", "p", "f"])
    assert html_text.align(a, b) == [("", "h"), ("?", "x"), ("+", "p"), ("", "f")]
    assert html_text.collapse(["d", "t", "d", "t", "d", "t"]) == [("+", "d", "t")]


def test_neighbours_recall_and_edges(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 16)).astype(np.float32)
    x[40:80] = x[40]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] * 16), (5080, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(df, F.col("id") % 20 == 0).toPandas()
    assert got.groupby("query_id").size().eq(20).all() and got.query_id.nunique() == 150
    y = x.astype(np.float64)
    hits = 0
    for q, own in got.sort_values("rank").groupby("query_id"):
        s = y @ y[q]
        assert np.allclose(own.score, s[own.id], atol=1e-9) and q not in set(own.id)
        s[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(3000), -s))[:20]) & set(own.id))
    assert hits / (150 * 20) >= 0.9
    few = neighbours.nearest(df.where("vec_id < 5"), F.col("id") == 0).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2, 3, 4]
    assert neighbours.nearest(df.limit(0), F.col("id") == 0).count() == 0


def test_passages(spark, texts):
    got = {r.id: r for r in passages.repeated(frame(spark, texts)).collect()}
    assert got[100].n_repeated >= 60 and got[101].n_repeated >= 60 and got[101].class_id == got[100].class_id
    assert got[104].class_id == 103 and got[105].n_repeated >= 155
    assert all(got[i].n_repeated == 0 and got[i].class_id == i for i in (0, 1, 106, 107, 109, 110))
    assert passages.repeated(frame(spark, [])).count() == 0


def word_maker(seed):
    rng = random.Random(seed)
    return rng, lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]


def changed(rng, words, at):
    return [f"x{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(words)]


def test_passages_of_texts_whose_smallest_holder_is_another(spark):
    rng, say = word_maker(8)
    p, q, line = say(60), say(60), say(6)
    rows = [(1, say(20) + p[:45] + say(20)), (5, say(30) + p + say(10)), (9, p + say(25))]
    # 21 ~ 22 and 22 ~ 23 or 21 ~ 23 at 0.8, 21 against 23 below it
    rows += [(21, say(5) + changed(rng, q, set(range(3, 60, 10))) + say(9)), (22, say(9) + q + say(8)),
             (23, say(7) + changed(rng, q, set(range(8, 60, 10)) | {15, 35}) + say(6))]
    rows += [(40 + i, say(30) + line + say(30)) for i in range(30)]     # a line in unlike surroundings, one of them shared
    both = say(25) + line + say(25)
    rows += [(80, say(12) + both + say(12)), (81, say(3) + both), (90, both + say(1)), (91, both + say(1))]
    rows += [(92, " ".join(rows[-1][1]).split())]
    got = {r.id: r for r in passages.repeated(frame(spark, [(i, " ".join(w), "s") for i, w in rows])).collect()}
    assert got[1].n_repeated == 0 and got[5].n_repeated == got[9].n_repeated == 60 and got[9].class_id == 5
    assert got[22].class_id == got[23].class_id == got[21].class_id == 21 and got[23].n_repeated >= 50
    assert all(got[40 + i].n_repeated == 0 for i in range(30))
    assert {got[i].class_id for i in (80, 81, 90, 91, 92)} == {80} and got[81].n_repeated == 56
    assert got[92].n_repeated == 57 and got[92].n_links == 4


def test_passages_with_many_changes_are_found(spark):
    rng, say = word_maker(9)
    rows, want = [], []
    for k in range(60):
        p = say(60)
        at = set(rng.sample(range(5, 55), 9 if k % 2 else 6))
        same = np.array([i not in at for i in range(60)])
        rows += [(2 * k, say(20) + p + say(20)), (2 * k + 1, say(9) + changed(rng, p, at) + say(9))]
        want.append(any(same[i:i + 5].all() for i in range(56)))
    single = say(55)        # a single seed is common, the other words agree in runs of four
    rows += [(200, single), (201, changed(rng, single, {4, 9, 14, 19, 24, 30, 35, 40, 45, 50}))]
    got = {r.id: r for r in passages.repeated(frame(spark, [(i, " ".join(w), "s") for i, w in rows])).collect()}
    found = [got[2 * k + 1].class_id == 2 * k for k in range(60)]
    assert all(want) and sum(found) >= 58
    assert got[201].class_id == got[200].class_id == 200


def test_passages_at_several_places_of_a_text(spark):
    _, say = word_maker(10)
    p, q = say(60), say(55)
    rows = [(3, p + say(80) + p + say(70) + p), (4, say(10) + p + say(5)), (6, say(4) + q), (7, q + say(90) + q + say(8))]
    rows += [(8, ["la"] * 400), (9, say(3) + ["la"] * 90 + say(3))]
    got = {r.id: r for r in passages.repeated(frame(spark, [(i, " ".join(w), "s") for i, w in rows])).collect()}
    assert (got[3].n_repeated, got[3].n_spans) == (180, 3) and got[4].n_repeated == 60
    assert (got[7].n_repeated, got[7].n_spans) == (110, 2) and (got[6].n_repeated, got[6].class_id) == (55, 6)
    assert (got[8].n_repeated, got[9].n_repeated) == (400, 90)


def test_chain_equals_quadratic_search():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = int(rng.integers(2, 25))
        a, b = rng.integers(0, 40, n), rng.integers(0, 40, n)
        order = np.lexsort((b, a))
        score = {}
        for i in order:
            score[i] = passages.K + max([0.0] + [score[j] - passages.GAP_COST * (a[i] - a[j] + b[i] - b[j])
                                                 for j in score if a[j] < a[i] and b[j] < b[i]])
        best = passages.chains(a, b)[0]
        gaps = passages.GAP_COST * (a[best[-1]] - a[best[0]] + b[best[-1]] - b[best[0]])
        assert abs(passages.K * len(best) - gaps - max(score.values())) < 1e-9
        assert (np.diff(a[best]) > 0).all() and (np.diff(b[best]) > 0).all()


def test_toxicity_learns_and_scores_all(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words = rng.choices([f"w{k}" for k in range(80)], k=30)
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["idiot", "scum"])
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, None, "s"), (901, "", "s"), (None, "x", "s")]
    labels += [(None, 1), (900, None)]
    docs, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known.where(~toxicity.held_out(F.col("doc_id"))))
    got = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"), toxicity.score(model, F.col("text"), docs).alias("s")).collect()
    assert len(got) == len(rows) and all(0 < r.s < 1 for r in got)
    fresh = [(r.s >= 0.5) == (r.doc_id % 4 == 0) for r in got if r.h and r.doc_id is not None and r.doc_id < 600]
    assert sum(fresh) >= 0.95 * len(fresh)
    none = toxicity.fit(docs, known.limit(0))
    assert docs.select(toxicity.score(none, F.col("text"), docs).alias("s")).where("s >= 0.5").count() == 0


def test_no_table_reaches_the_driver_row_by_row(spark, texts, monkeypatch):
    """Labels stay on the executors; model states, samples and benchmark blocks come as Arrow columns."""
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int("changed" in (t or ""))) for i, t, _ in texts if i], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, texts[5][1]), (2, None), (None, "x")], "item_id long, text string")

    def rows(*_, **__):
        raise AssertionError("rows in the driver")

    monkeypatch.setattr(type(docs), "toPandas", rows)
    monkeypatch.setattr(type(spark), "createDataFrame", rows)
    model = toxicity.fit(docs, labels)
    prints = docs.select(simhash.fingerprint(F.col("text")).alias("fp")).distinct()
    linked = simhash.links(prints)
    found = decontaminate.matches(docs, items).where(F.size("__match.items") > 0)
    monkeypatch.undo()
    assert len(model.slots) == len(model.weights) and model.offset < 0
    assert linked.where("a <= b").count() == 0
    assert 5 in {r.doc_id for r in found.collect()}


def test_pipeline_stages(spark):
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), before.schema)
        assert 0 < docs.count() <= before.count()
        if name == "simhash_near_dedup":
            groups = {r.id: r.component for r in simhash.near_duplicates(before).collect()}
            assert sorted(r.doc_id for r in docs.collect()) == sorted(set(groups.values()))
        if name == "suffix_array_dedup":
            want = {i: n - gone for i, n, gone, _, _ in brute_repeats([(r.doc_id, r.text, "") for r in before.collect()], 200)}
            assert docs.count() == before.count()
            assert all(want[r.doc_id] <= len(r.text.encode()) <= want[r.doc_id] + 12 for r in docs.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()
