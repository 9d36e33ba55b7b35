"""Boosted trees for the learners: Spark ML's method over blocks of binned rows.

``fit`` takes a ``GBTClassifier`` or ``GBTRegressor`` and returns its Spark ML
model. Candidate cuts, variance gain, losses and step are Spark ML's, and sums
are taken in its order. What differs is how rows are held and counted: each is
binned once and kept as one byte a feature in blocks of ``BLOCK`` rows, and one
pass over the blocks makes a level's histogram (feature, node, bin), whose size
depth and bins bound. Spark ML keeps every row as objects and walks them one
by one. Up to ``ONE_TASK_ROWS`` rows are boosted inside one task, without a job
for each level, and up to ``SPARK_ML_ROWS`` rows by Spark ML itself.
"""

from __future__ import annotations

import json
import pickle
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upshot.session import prepare, scratch_path

BLOCK = 32_768
#: So many rows fit in one partition, where Spark ML's sums have one order. It fits them itself: in its nodes of a few rows
#: cuts tie but for the last bit, and NumPy's exponential differs from the JVM's there.
SPARK_ML_ROWS = 50_000
#: So many training rows are boosted by one task: a level of them takes less than starting a job.
ONE_TASK_ROWS = 2_500_000
#: Above, a task takes so many rows at least (fewer take less than starting it) and at most.
LEAST_ROWS, MOST_ROWS = 2_000_000, 5_000_000
#: Predictions are written to the checkpoint folder after so many trees, which cuts their lineage.
CHECKPOINT_TREES = 25
_STAY = 65_535   # the cut of a node that is not split: all its rows go left
_EPSILON = float(np.finfo(float).eps)
_NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
          "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def _cuts(sample: np.ndarray, expected: float, n_cuts: int) -> np.ndarray:
    """Candidate cuts of one feature, as Spark ML chooses them: midpoints of its values, or every ``stride`` rows."""
    values, counts = np.unique(sample[sample != 0.0], return_counts=True)
    counts = counts.astype(float)
    zeros = expected - counts.sum()
    if zeros > _EPSILON * expected * 100:
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= n_cuts:
        return middles
    stride, seen = expected / (n_cuts + 1), counts.cumsum()
    found, target = [], stride
    for i in range(1, len(values)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def candidate_cuts(rows: DataFrame, features: list[str], n: int, max_bins: int, seed: int) -> list[np.ndarray]:
    """Cuts of each feature from the sample that Spark ML draws of the same rows (about 10,000, all if there are fewer)."""
    spark, wanted = rows.sparkSession, max(max_bins * max_bins, 10_000)
    picked, fraction = rows.select(*features), 1.0
    if wanted < n:
        fraction = wanted / n
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        jdf = picked._jdf
        picked = DataFrame(spark._jsparkSession.createDataFrame(jdf.javaRDD().sample(False, fraction, draw), jdf.schema()), spark)
    sample = picked.toPandas().to_numpy(float)
    return [_cuts(sample[:, j], fraction * n, min(max_bins, n) - 1) for j in range(len(features))]


def _blocks(batches: Iterable[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(label, features...) rows as blocks of (bins by feature, labels)."""
    def block(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        y, *x = [c.to_numpy() for c in table.columns]
        kind = np.uint8 if max(map(len, cuts)) < 256 else np.uint16
        return np.stack([np.searchsorted(c, v).astype(kind) for c, v in zip(cuts, x, strict=True)]), y

    held, n = [], 0
    for batch in batches:
        while n + batch.num_rows >= BLOCK:
            held.append(batch.slice(0, BLOCK - n))
            yield block(pa.Table.from_batches(held))
            batch, held, n = batch.slice(BLOCK - n), [], 0
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
    if n:
        yield block(pa.Table.from_batches(held))


class Tree:
    """One tree with nodes numbered level by level: split feature and bin, and (rows, sum, squares), impurity and gain."""

    def __init__(self, depth: int):
        n = 2 ** (depth + 1) - 1
        self.depth, self.feature, self.cut = depth, np.zeros(n, np.int64), np.full(n, _STAY)
        self.stats, self.impurity, self.gain = np.zeros((n, 3)), np.zeros(n), np.full(n, -1.0)
        self.open = np.zeros(n, bool)       # nodes whose split is to be looked for
        self.open[0] = depth > 0

    def leaves(self, weight: float) -> np.ndarray:
        """The weighted predictions of the last level's places, of which a leaf further up takes the leftmost below it."""
        value = self.predictions()
        for i in range(2 ** self.depth - 1):
            if self.cut[i] == _STAY:
                value[2 * i + 1] = value[i]
        return value[2 ** self.depth - 1:] * weight

    def predictions(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.stats[:, 0] > 0, self.stats[:, 1] / self.stats[:, 0], 0.0)


def _descend(bins: np.ndarray, tree: Tree, levels: int) -> np.ndarray:
    """Each row's place (from the left) after so many levels of a tree.

    Places are narrow integers and each split is one comparison over the block, much cheaper than looking up each row's split.
    """
    node = np.zeros(bins.shape[1], np.uint8 if levels <= 8 else np.uint32)
    for level in range(levels):
        first, right = 2 ** level - 1, np.zeros(bins.shape[1], bool)
        for k in range(2 ** level):
            if tree.cut[first + k] != _STAY:
                right |= (node == k) & (bins[tree.feature[first + k]] > tree.cut[first + k])
        node += node
        node += right
    return node


def _targets(y: np.ndarray, f: np.ndarray | None, logistic: bool) -> np.ndarray:
    """What a tree is fitted to: the labels at first, then minus the gradient of log loss (labels -1, 1) or squared error."""
    if f is None:
        return y.astype(float)
    with np.errstate(over="ignore"):
        return 4.0 * y / (1.0 + np.exp(2.0 * y * f)) if logistic else 2.0 * (y - f)


def _counted(blocks: Iterable[tuple], tree: Tree, level: int, n_bins: int, logistic: bool) -> Iterator[np.ndarray]:
    """The rows, sums and sums of squares of what the tree is fitted to, by feature, node and bin (nothing of no blocks)."""
    size, total = 2 ** level * n_bins, None
    for bins, y, f in blocks:
        target = _targets(y, f, logistic)
        squares, own = target * target, _descend(bins, tree, level).astype(np.intp) * n_bins
        found = np.empty((3, len(bins), size))
        for j, column in enumerate(bins):
            cell = own + column
            found[0, j] = np.bincount(cell, minlength=size)
            found[1, j] = np.bincount(cell, target, size)
            found[2, j] = np.bincount(cell, squares, size)
        total = found if total is None else total + found
    if total is not None:
        yield total


def _advanced(block: tuple, tree: Tree, leaves: np.ndarray) -> tuple:
    bins, y, f = block
    add = leaves[_descend(bins, tree, tree.depth)]
    return bins, y, add if f is None else f + add


def _variance(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (q - s * s / n) / n


def _split(tree: Tree, level: int, histogram: np.ndarray, n_cuts: list[int]) -> None:
    """Give the open nodes of a level their best cuts, written out as in Spark ML, so that near ties fall alike."""
    nodes = slice(2 ** level - 1, 2 ** (level + 1) - 1)
    sums = histogram.reshape(3, len(n_cuts), 2 ** level, -1).cumsum(axis=3)
    left = sums[..., :-1]
    right = sums[..., -1:] - left
    cuttable = [j for j, c in enumerate(n_cuts) if c]
    if level == 0:
        tree.stats[0] = left[:, cuttable[0], 0, 0] + right[:, cuttable[0], 0, 0] if cuttable else sums[:, 0, 0, -1]
        tree.impurity[0] = _variance(*tree.stats[0])
    if not cuttable:
        tree.open[:] = False
        return
    with np.errstate(divide="ignore", invalid="ignore"):
        unlike = np.stack([_variance(*left), _variance(*right)])
        rows = left[0] + right[0]
        gain = tree.impurity[nodes][:, None] - left[0] / rows * unlike[0] - right[0] / rows * unlike[1]
    exists = np.arange(left.shape[3]) < np.array(n_cuts)[:, None, None]
    gain = np.where((left[0] >= 1) & (right[0] >= 1) & exists, gain, -np.inf).transpose(1, 0, 2)
    best = gain.reshape(len(gain), -1).argmax(axis=1)
    for k in range(2 ** level):
        i = 2 ** level - 1 + k
        j, c = divmod(int(best[k]), left.shape[3])
        if not (tree.open[i] and gain[k, j, c] > 0):
            continue
        tree.feature[i], tree.cut[i], tree.gain[i] = j, c, gain[k, j, c]
        for child, side, impurity in ((2 * i + 1, left, unlike[0]), (2 * i + 2, right, unlike[1])):
            tree.stats[child], tree.impurity[child] = side[:, j, k, c], impurity[j, k, c]
            tree.open[child] = level + 1 < tree.depth and abs(tree.impurity[child]) >= _EPSILON


def _grown(count: Callable[[Tree, int], np.ndarray], depth: int, n_cuts: list[int]) -> Tree:
    tree = Tree(depth)
    for level in range(max(depth, 1)):
        if level == 0 or tree.open[2 ** level - 1:].any():
            _split(tree, level, count(tree, level), n_cuts)
    return tree


def _boosted_here(blocks: list[tuple], n_trees: int, depth: int, step: float, n_cuts: list[int], logistic: bool) -> list[Tree]:
    """The trees, grown in this process."""
    n_bins, trees = max(n_cuts) + 1, []
    for m in range(n_trees):
        trees.append(_grown(lambda tree, level: next(_counted(blocks, tree, level, n_bins, logistic)), depth, n_cuts))
        leaves = trees[-1].leaves(step if m else 1.0)
        blocks = [_advanced(b, trees[-1], leaves) for b in blocks]
    return trees


def _boosted(state: RDD, n_trees: int, depth: int, step: float, n_cuts: list[int], logistic: bool) -> list[Tree]:
    """The trees, grown with one job a level over blocks on the executors."""
    n_bins, trees, spent, saved = max(n_cuts) + 1, [], None, []

    def count(tree: Tree, level: int) -> np.ndarray:
        nonlocal spent
        found = sum(state.mapPartitions(lambda blocks: _counted(blocks, tree, level, n_bins, logistic)).collect())
        if spent is not None:       # the first pass has stored the blocks with the tree before
            spent.unpersist()
            spent = None
        return found

    def advance(tree: Tree, leaves: np.ndarray) -> RDD:
        return state.map(lambda b: _advanced(b, tree, leaves)).persist(StorageLevel.MEMORY_AND_DISK_DESER)

    try:
        for m in range(n_trees):
            trees.append(_grown(count, depth, n_cuts))
            while len(saved) > 1:
                _delete(saved.pop(0))
            if m + 1 < n_trees:
                spent, state = state, advance(trees[-1], trees[-1].leaves(step if m else 1.0))
                if (m + 1) % CHECKPOINT_TREES == 0:
                    state.checkpoint()
                    saved.append(state)
    finally:
        for blocks in (spent, state):
            if blocks is not None:
                blocks.unpersist()
        for blocks in saved:
            _delete(blocks)
    return trees


def _delete(state: RDD) -> None:
    file = state.getCheckpointFile()
    if file:
        path = state.ctx._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(state.ctx._jsc.hadoopConfiguration()).delete(path, True)


def fit(estimator: GBTClassifier | GBTRegressor, rows: DataFrame, features: list[str]) -> GBTClassificationModel | GBTRegressionModel:
    """The estimator's model of ``rows`` (its label column and the features; read several times, so persist them)."""
    logistic, get, label = isinstance(estimator, GBTClassifier), estimator.getOrDefault, estimator.getLabelCol()
    n = rows.count()
    if n <= SPARK_ML_ROWS:
        vectors = VectorAssembler(inputCols=features, outputCol=estimator.getFeaturesCol(), handleInvalid="keep")
        return estimator.fit(vectors.transform(rows))
    x = [F.col(f).cast("double").alias(f) for f in features]
    rows = rows.select(F.col(label).cast("double").alias("__label"), *x)
    bad = [F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf")) for c in rows.columns]
    off = ~F.col("__label").isin(0.0, 1.0) if logistic else F.lit(False)
    n_bad, n_off = rows.agg(F.count(F.when(F.greatest(*bad), 1)), F.count(F.when(F.coalesce(off, F.lit(True)), 1))).first()
    if n_bad or n_off:
        raise ValueError(f"{n} training rows, {n_bad} of them with a null or non-finite value, {n_off} with a label not 0 or 1")
    cuts = candidate_cuts(rows, features, n, get("maxBins"), get("seed"))
    if logistic:
        rows = rows.withColumn("__label", F.col("__label") * 2 - 1)
    spark, n_cuts, kind = rows.sparkSession, [len(c) for c in cuts], np.int8 if logistic else np.float64
    prepare(spark)
    how = get("maxIter"), get("maxDepth"), get("stepSize"), n_cuts, logistic

    if n <= ONE_TASK_ROWS:
        def boost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = [(bins, y.astype(kind), None) for bins, y in _blocks(batches, cuts)]
            yield pa.record_batch([pa.array([pickle.dumps(_boosted_here(blocks, *how))], pa.binary())], names=["trees"])

        trees = pickle.loads(rows.coalesce(1).mapInArrow(boost, "trees binary").first()[0])
    else:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, y in _blocks(batches, cuts):
                yield pa.record_batch([pa.array([pickle.dumps((bins, y.astype(kind), None), 5)], pa.binary())], names=["block"])

        parts = max(min(-(-n // LEAST_ROWS), spark.sparkContext.defaultParallelism), -(-n // MOST_ROWS))
        blocks = rows.mapInArrow(pack, "block binary").repartition(parts).rdd.map(lambda r: pickle.loads(r[0]))
        trees = _boosted(blocks.persist(StorageLevel.MEMORY_AND_DISK_DESER), *how)
    return _model(spark, estimator, trees, cuts)


def _nodes(tree: Tree, cuts: list[np.ndarray]) -> list[tuple]:
    """A tree's nodes as Spark ML saves them: in preorder, a split whose two leaves predict the same being one leaf."""
    prediction = tree.predictions()
    out: list[tuple] = []

    def put(i: int) -> bool:
        """Whether the node has become a leaf."""
        at = len(out)
        own = (float(prediction[i]), float(tree.impurity[i]), tree.stats[i].tolist(), int(tree.stats[i, 0]))
        leaf = (at, *own, -1.0, -1, -1, (-1, [], -1))
        out.append(leaf)
        if tree.cut[i] == _STAY:
            return True
        a, right = put(2 * i + 1), len(out)
        b = put(2 * i + 2)
        if a and b and prediction[2 * i + 1] == prediction[2 * i + 2]:
            out[at:] = [leaf]
            return True
        j = int(tree.feature[i])
        out[at] = (at, *own, float(tree.gain[i]), at + 1, right, (j, [float(cuts[j][tree.cut[i]])], -1))
        return False

    put(0)
    return out


def _model(spark: SparkSession, estimator: GBTClassifier | GBTRegressor, trees: list[Tree],
           cuts: list[np.ndarray]) -> GBTClassificationModel | GBTRegressionModel:
    """The trees written as Spark ML saves a model and read by its reader."""
    kind, step = (GBTClassificationModel, "classification") if isinstance(estimator, GBTClassifier) else (
        GBTRegressionModel, "regression"), estimator.getOrDefault("stepSize")
    given, default = ({p.name: v for p, v in params.items()} for params in (estimator._paramMap, estimator._defaultParamMap))
    common = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    own = common | {"class": f"org.apache.spark.ml.{kind[1]}.{kind[0].__name__}", "uid": estimator.uid, "paramMap": given,
                    "defaultParamMap": default, "numFeatures": len(cuts), "numTrees": len(trees)}
    of_tree = {"featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "seed", "impurity"}
    part = common | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "defaultParamMap": {},
                     "paramMap": {k: v for k, v in (default | given).items() if k in of_tree}}
    path = scratch_path(spark, f"boosted-{uuid.uuid4().hex}")
    weights = [(i, json.dumps(part | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"}), step if i else 1.0) for i in range(len(trees))]
    nodes = [(i, node) for i, tree in enumerate(trees) for node in _nodes(tree, cuts)]
    spark.createDataFrame([(json.dumps(own),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(weights, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.parquet(f"{path}/data")
    return kind[0].load(path)
