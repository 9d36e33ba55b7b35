"""URL filter: rules first, then trust that travels along links between hosts.

Pages are reduced to one row for each (host, linked host) with a count before
anything iterates. Personalised PageRank runs twice over these edges, in
Spark: trust from the hosts that allow-rules name, along the links; distrust
from the hosts that block-rules name, against the links (who links to a
blocked host is suspect). A page without a rule is judged by its host: blocked
if distrust outweighs trust. Both walks' ranks sum to 1 (a walk without seeds:
to 0), so the threshold on their ratio does not depend on the number of hosts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upshot.llm.common import cut, prepare

#: (host, path, verdict): a rule fits its host and all subdomains, and paths that start with its path.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DAMPING, TOLERANCE, ROUNDS_PER_TABLE, THRESHOLD = 0.85, 1e-4, 5, 1.0
HOT, SALTS = 1000, 64            # a host with more than 1 in HOT of the pages is dealt over SALTS tasks
_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: tuple) -> Column:
    return ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ordered):
        found = F.when(_fits(host, path, r), F.struct(F.lit(r[0] + r[1]).alias("rule"), F.lit(r[2]).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts. Relative links stay on their host and are left out."""
    linked = F.regexp_extract_all(F.coalesce(F.col(html_col).cast("string"), F.lit("")), F.lit(_LINK), F.lit(1))
    return (pages.select(host_of(F.col(url_col)).alias("src"), F.explode(linked).alias("dst"))
            .select("src", _ascii_lower(F.col("dst")).alias("dst")).where("src <> dst and src <> ''")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def _walk(hosts: DataFrame, edges: DataFrame, seed: str, tolerance: float, damping: float, name: str) -> DataFrame:
    """Personalised PageRank: (host, rank), of sum 1. ``hosts`` has a seed share; edges (src, dst, share) are normalised.

    Hosts without edges give their mass back to the seeds. That walk's ranks
    are the ranks of the walk that loses this mass, divided by their sum, so
    the mass need not be collected in each round. A round moves at most
    ``damping`` times what the round before moved; rounds go on until that
    falls below ``tolerance`` of the mass, which the change between two written
    tables mostly shows earlier.
    """
    rank = before = hosts.select("host", F.col(seed).alias("rank"))
    for i in range(math.ceil(math.log(tolerance) / math.log(damping))):
        # contributions are summed by host before the join back, so a host with many links is no single group
        sent = (edges.join(rank, edges.src == rank.host).select("dst", (F.col("rank") * F.col("share")).alias("r"))
                .groupBy("dst").agg(F.sum("r").alias("r")))
        rank = hosts.join(sent, hosts.host == sent.dst, "left").select(
            "host", ((1 - damping) * F.col(seed) + damping * F.coalesce("r", F.lit(0.0))).alias("rank"))
        if (i + 1) % ROUNDS_PER_TABLE == 0:
            rank = cut(rank, name)
            moved = rank.join(before.withColumnRenamed("rank", "old"), "host").agg(
                F.sum(F.abs(F.col("rank") - F.col("old"))).alias("moved"), F.sum("rank").alias("mass")).first()
            if not moved.mass or moved.moved <= tolerance * moved.mass:
                break
            before = rank
    mass = rank.agg(F.sum("rank").alias("mass"))     # one row
    return rank.crossJoin(F.broadcast(mass)).select(
        "host", F.when(F.col("mass") > 0, F.col("rank") / F.col("mass")).otherwise(F.lit(0.0)).alias("rank"))


def host_trust(pages: DataFrame, rules: tuple = RULES, url_col: str = "url", html_col: str = "html",
               tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) for every host of a page or a link.

    A host is a trusted seed if an allow-rule for whole hosts (path ``/``)
    names it, a blocked seed if more of its pages fall under block-rules than
    under allow-rules. Seeds share the restart mass evenly.
    """
    links = cut(host_links(pages, url_col, html_col), "links")
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    voted = pages.select(host.alias("host"), rule_of(host, path, rules).alias("r")).where("host <> ''").groupBy("host").agg(
        F.sum(F.when(F.col("r.verdict") == "allow", 1).otherwise(0)).alias("up"),
        F.sum(F.when(F.col("r.verdict") == "block", 1).otherwise(0)).alias("down"))
    names = voted.unionByName(links.select(F.explode(F.array("src", "dst")).alias("host")).distinct().select(
        "host", F.lit(0).cast("long").alias("up"), F.lit(0).cast("long").alias("down")))
    hosts = names.groupBy("host").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    whole = F.lit(False)
    for r in rules:
        if r[2] == "allow" and r[1] == "/":
            whole |= _fits(F.col("host"), F.lit("/"), r)
    blocked = F.col("down") > F.col("up")
    hosts = hosts.withColumn("good", ((whole | (F.col("up") > F.col("down"))) & ~blocked).cast("double")).withColumn(
        "bad", blocked.cast("double"))
    sums = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("good").alias("g"), F.sum("bad").alias("b"))
    hosts = cut(hosts.crossJoin(F.broadcast(sums)).select(          # one row of sums
        "host", F.when(F.col("g") > 0, F.col("good") / F.col("g")).otherwise(F.lit(0.0)).alias("good"),
        F.when(F.col("b") > 0, F.col("bad") / F.col("b")).otherwise(F.lit(0.0)).alias("bad")), "hosts")
    out = links.groupBy(F.col("src").alias("s")).agg(F.sum("n").alias("t"))
    ahead = cut(links.join(out, links.src == out.s).select("src", "dst", (F.col("n") / F.col("t")).alias("share")), "ahead")
    into = links.groupBy(F.col("dst").alias("s")).agg(F.sum("n").alias("t"))
    back = cut(links.join(into, links.dst == into.s).select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("n") / F.col("t")).alias("share")), "back")
    good = _walk(hosts, ahead, "good", tolerance, damping, "trust")
    bad = _walk(hosts, back, "bad", tolerance, damping, "distrust")
    return good.withColumnRenamed("rank", "trust").join(bad.withColumnRenamed("rank", "distrust"), "host")


def _with_scores(pages: DataFrame, scores: DataFrame) -> DataFrame:
    """``pages`` with the scores (__h, ...) of their host; the pages of hot hosts are dealt over ``SALTS`` tasks.

    A host is hot if it has more than one in ``HOT`` of the pages, so there are
    fewer than ``HOT`` hot hosts, whatever the data; their scores are repeated for each salt.
    """
    sizes = cut(pages.groupBy("__url_host").agg(F.count(F.lit(1)).alias("n")), "host-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = [r["__url_host"] for r in sizes.where(F.col("n") * F.lit(HOT) > F.lit(total)).select("__url_host").collect()]
    if not hot:
        return pages.join(scores, F.col("__url_host") == F.col("__h"), "left").drop("__h")
    every = F.when(F.col("__h").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")
    scores = scores.withColumn("__hs", F.explode(every))
    salt = F.when(F.col("__url_host").isin(hot), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(F.lit(0))
    salted = pages.withColumn("__salt", salt)
    same = (F.col("__url_host") == F.col("__h")) & (F.col("__salt") == F.col("__hs"))
    return salted.join(scores, same, "left").drop("__h", "__hs", "__salt")


def judge(pages: DataFrame, rules: tuple = RULES, url_col: str = "url", html_col: str = "html",
          threshold: float = THRESHOLD, **options) -> DataFrame:
    """``pages`` with columns host, path, rule, verdict, trust, distrust (prefixed ``__url_``).

    The longest rule that fits decides. Else the page is blocked if its host's
    distrust is above ``threshold`` times its trust. Null urls and urls without
    ``://`` have empty host and path, fit no rule and carry no distrust, so
    they are allowed. Repeated rows stay; null html has no links.
    """
    prepare(pages.sparkSession)
    scores = host_trust(pages, rules, url_col, html_col, **options).select(
        F.col("host").alias("__h"), F.col("trust").alias("__url_trust"), F.col("distrust").alias("__url_distrust"))
    out = pages.withColumn("__url_host", host_of(F.col(url_col))).withColumn("__url_path", path_of(F.col(url_col)))
    out = out.withColumn("__url_rule", rule_of(F.col("__url_host"), F.col("__url_path"), rules))
    out = _with_scores(out, scores)
    suspect = F.coalesce(F.col("__url_distrust") > threshold * F.col("__url_trust"), F.lit(False))
    return out.withColumn("__url_verdict", F.coalesce(F.col("__url_rule.verdict"),
                                                      F.when(suspect, "block").otherwise("allow"))).withColumn(
        "__url_rule", F.col("__url_rule.rule"))
