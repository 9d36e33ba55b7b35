"""Merkle manifest of a table: rank digits are grouped away inside bounded blocks, proofs come from the nesting.

Rows of a group are ranked in their order; the rank is written in digits, each
worth ``DIGIT_LEVELS`` tree levels. Rows are dealt once by (group, block), a
block being ``arity ** (DIGITS * DIGIT_LEVELS)`` consecutive ranks. Grouping by
all digits but the lowest nests the rows of a digit run with the run's hashes
in one struct; the next grouping nests these structs, until a block is one
struct. Blocks of a group are rows of the same kind one storey up, and so on
until a group is one hash (its subroot); subroots are the rows of the last
tree. Proofs are then read downwards: transforms and explodes of the nested
structs append each child's siblings to the path of its parent. A block meets
its own path by a grouping, so no proof needs a join.

Defined cases: null groups come first and form a group; null order values come
first; rows equal in the order columns are ordered by leaf, repeated rows by
their place in the input (they are interchangeable); an empty table gives no
rows; a group of one row has that leaf as subroot. Working columns are
qualified by a prefix, so names of the input cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upshot.llm.common import cut, prepare

DIGIT_LEVELS, DIGITS = 4, 3
_LOW = (1 << 33) - 1            # row number inside a task, as numbered by monotonically_increasing_id


def sha(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' concatenation (strings as UTF-8)."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*fields: Column) -> Column:
    """Leaf hash: each field as its UTF-8 byte count, a colon and its text, or ``-`` if null."""
    def coded(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return sha(*[coded(c) for c in fields])


def fold(start: Column, path: Column) -> Column:
    """Root that a leaf and its path (array of struct(left, right)) lead to."""
    return F.aggregate(path, start, lambda node, step: sha(step["left"], node, step["right"]))


def path_digest(path: Column) -> Column:
    """Hash of all siblings on a path, leaf to root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _group_key(group: Column) -> Column:
    """Group as a string that is never null and sorts null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def _ranked(rows: DataFrame, order: list[str], arity: int) -> DataFrame:
    """Rows (g, node, order columns) with their rank in g and the number of levels of g's tree.

    Rows are dealt by ranges of (g, order), so a hot group spreads over many
    tasks, and numbered inside each; totals of (g, range), one row each, give the offsets.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn("at", F.monotonically_increasing_id())
                 .select("g", "node", "at", F.shiftright("at", 33).alias("part")), "merkle-ranked")
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    totals = placed.groupBy("g", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    totals = totals.select(
        "g", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("size"))
    reaches, reach = [], 1
    while reach < 1 << 62:
        reaches.append(f"{reach}L")
        reach *= arity
    totals = totals.withColumn("levels", F.expr(f"size(filter(array({', '.join(reaches)}), r -> size > r))"))
    return placed.join(totals, ["g", "part"]).select(
        "g", "levels", (F.col("at") + F.col("shift")).alias("rank"), "node")


def _up(nodes: Column, arity: int) -> Column:
    """Hashes one level up: one for each run of ``arity`` nodes."""
    return F.transform(F.sequence(F.lit(1), F.size(nodes), F.lit(arity)),
                       lambda i: F.sha2(F.array_join(F.slice(nodes, i, F.lit(arity)), ""), 256))


def _hashes(kids: Column) -> Column:
    return F.transform(kids, lambda k: k["node"]["hash"])


def _blocks(rows: DataFrame, base: int, arity: int) -> DataFrame:
    """(g, levels, rank, node) nested to one row (g, levels, block, tree) for each block of ranks; written.

    ``base`` is the tree level the rows stand on. A level is hashed only while
    the group's tree still has several nodes there; above its root, nodes pass unchanged.
    """
    per = arity ** DIGIT_LEVELS
    digits = [F.expr(f"rank div {per ** d} % {per}").cast("int").alias(f"d{d}") for d in range(DIGITS)]
    rows = rows.select("g", "levels", F.expr(f"rank div {per ** DIGITS}").alias("block"), *digits, "node")
    rows = rows.repartition("g", "block")
    for d in range(DIGITS):
        keys = ["g", "levels", "block"] + [f"d{k}" for k in range(d + 1, DIGITS)]
        rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(f"d{d}", "node"))).alias("kids"))
        rows = rows.withColumn("l0", _hashes(F.col("kids")))
        for j in range(DIGIT_LEVELS):
            live = F.col("levels") > base + d * DIGIT_LEVELS + j
            rows = rows.withColumn(f"l{j + 1}", F.when(live, _up(F.col(f"l{j}"), arity)).otherwise(F.col(f"l{j}")))
        runs = F.array(*[F.col(f"l{j}") for j in range(1, DIGIT_LEVELS)])
        rows = rows.select(*keys, F.struct(F.col(f"l{DIGIT_LEVELS}")[0].alias("hash"), runs.alias("runs"), "kids").alias("node"))
    return cut(rows.withColumnRenamed("node", "tree"), "merkle-blocks")


def _storeys(rows: DataFrame, arity: int) -> list[DataFrame]:
    """Block tables from the rows up to the one where each group is a single block."""
    top = rows.agg(F.max("rank")).first()[0] or 0
    block, found = arity ** (DIGIT_LEVELS * DIGITS), []
    while True:
        found.append(_blocks(rows, len(found) * DIGIT_LEVELS * DIGITS, arity))
        if top < block:
            return found
        top //= block
        rows = found[-1].select("g", "levels", F.col("block").alias("rank"), F.struct(F.col("tree.hash").alias("hash")).alias("node"))


def _siblings(level: Column, i: Column, reach: int, arity: int) -> Column:
    """struct(left, right): the hashes before and after node ``i // reach`` in its run."""
    at = F.floor(i / F.lit(reach)).cast("int")
    start = at - at % arity
    return F.struct(F.array_join(F.slice(level, start + 1, at - start), "").alias("left"),
                    F.array_join(F.slice(level, at + 2, start + arity - at - 1), "").alias("right"))


def _down(blocks: DataFrame, paths: DataFrame, base: int, arity: int) -> DataFrame:
    """(g, rank, node, path, top) of all rows under ``blocks``, given (g, block, path, top) of each block.

    ``paths`` and ``blocks`` have one row for each block; they meet in a grouping.
    """
    shape = blocks.schema["tree"].dataType, paths.schema["path"].dataType, paths.schema["top"].dataType
    both = blocks.select("g", "block", "tree", "levels", F.lit(None).cast(shape[1]).alias("path"),
                         F.lit(None).cast(shape[2]).alias("top"))
    both = both.unionByName(paths.select("g", "block", F.lit(None).cast(shape[0]).alias("tree"),
                                         F.lit(None).cast("int").alias("levels"), "path", "top"))
    one = both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("tree", "levels", "path", "top")])
    one = one.withColumnRenamed("block", "rank")
    for d in reversed(range(DIGITS)):
        one = one.select("g", "rank", "levels", "path", "top", F.col("tree.runs").alias("runs"), F.col("tree.kids").alias("kids"))
        one = one.select("g", "rank", "levels", "path", "top", "runs", _hashes(F.col("kids")).alias("l0"),
                         F.posexplode("kids").alias("i", "kid"))
        steps = [F.when(F.col("levels") > base + d * DIGIT_LEVELS + j,
                        _siblings(F.col("l0") if j == 0 else F.col("runs")[j - 1], F.col("i"), arity ** j, arity))
                 for j in range(DIGIT_LEVELS)]
        one = one.select("g", (F.col("rank") * arity ** DIGIT_LEVELS + F.col("i")).alias("rank"), "levels", "top",
                         F.concat(F.array_compact(F.array(*steps)), "path").alias("path"), F.col("kid.node").alias("tree"))
    return one.withColumnRenamed("tree", "node")


def _proofs(storeys: list[DataFrame], starts: DataFrame, arity: int) -> DataFrame:
    """Rows of the lowest storey with their paths; ``starts`` has (g, path, top) for each group."""
    paths = starts.withColumn("block", F.lit(0).cast("long"))
    for k in reversed(range(len(storeys))):
        rows = _down(storeys[k], paths, k * DIGIT_LEVELS * DIGITS, arity)
        paths = rows.select("g", F.col("rank").alias("block"), "path", "top")
    return rows


def manifest(rows: DataFrame, leaf: Column, group: Column, order: Column, keep: Iterable[str], arity: int = 2) -> DataFrame:
    """Columns ``keep`` of every row and ``__proof``: struct(leaf, subroot, root, path).

    ``path`` lists a step for each level, leaf to root, as struct(left, right):
    the concatenated hashes of the run's other nodes. ``keep`` may hold any
    columns that can be ordered (no maps); they are carried inside the nesting.
    """
    prepare(rows.sparkSession)
    if arity < 2:
        raise ValueError("arity must be 2 or more")
    leaves = rows.select(_group_key(group).alias("g"), order.alias("o"),
                         F.struct(leaf.alias("hash"), F.struct(F.lit(0).alias("__"), *keep).alias("row")).alias("node"))
    leaves = leaves.withColumn("h", F.col("node.hash")).withColumn("s", F.monotonically_increasing_id())
    storeys = _storeys(_ranked(cut(leaves, "merkle-leaves"), ["o", "h", "s"], arity), arity)
    subroots = storeys[-1].select(F.lit("").alias("g"), F.col("g").alias("o"), F.struct(
        F.col("tree.hash").alias("hash"), F.struct("g").alias("row")).alias("node"))
    upper = _storeys(_ranked(subroots, ["o"], arity), arity)
    step = "array<struct<left:string,right:string>>"
    roots = upper[-1].select("g", F.array().cast(step).alias("path"), F.col("tree.hash").alias("top"))
    groups = _proofs(upper, roots, arity).select(
        F.col("node.row.g").alias("g"), "path",
        F.struct(F.col("node.hash").alias("subroot"), F.col("top").alias("root")).alias("top"))
    found = _proofs(storeys, cut(groups, "merkle-groups"), arity)
    return found.select(*[F.col("node.row")[c].alias(c) for c in keep], F.struct(
        F.col("node.hash").alias("leaf"), F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"),
        F.col("path").alias("path")).alias("__proof"))
