"""Random forest from grouped histograms: the same trees for every layout.

``pyspark.ml`` draws its bootstrap samples by partition number and row order, so
its forest is another one whenever the input is laid out otherwise. Here every
random choice is a digest: a row's weight in a tree (Poisson with mean 1, the
bootstrap's limit) comes from its key, the features that a node may split on
from the tree's and node's numbers. All sums are of integers. The forest thus
depends on the rows alone - not on files, partitions, cluster size or a task
that runs twice.

One grouped aggregate a level grows all nodes of all trees: rows are kept as a
few bytes (label, bins, weight in every tree); tasks walk blocks of them down the
trees with numpy and sum the (tree, node, feature, bin, label) weights, so what a
task hands over is bounded by trees x nodes x features x bins x labels whatever
the number of rows; Spark sums the tasks' counts by key. The best
split of a node maximises sum(left**2) / left + sum(right**2) / right over the
labels' weights (the Gini gain), found by window sums over the histogram; equal
splits go to the lower feature, then the lower bin. The driver gets one row for
a split node and one for a label in a leaf.

Bins are cut at the values where the cumulative count passes k / bins, on all
training rows or, beyond ``SAMPLE_ROWS``, on the rows whose digest falls into
that share of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.plans.workers import ship_package

TREES = 20
DEPTH = 5
BINS = 32
SAMPLE_ROWS = 100_000
#: A leaf's label shares are held as integers of this unit, so that the trees'
#: votes add up exactly.
UNIT = 1_000_000_000
#: Rows that a task walks down the trees together.
BLOCK_ROWS = 1 << 15


def poisson_cuts() -> list[str]:
    """Eight hex digits from which a uniform digest counts one more draw."""
    cuts, term, total = [], math.exp(-1), math.exp(-1)
    for k in range(1, 8):
        cuts.append(f"{math.floor(total * 2**32):08x}")
        term /= k
        total += term
    return cuts


def row_weights(key: Column, trees: int, seed: int) -> Column:
    """array<int>: how often each tree's sample holds the row. Four trees share
    a digest of the key, as text compared with text."""
    weights = []
    for t in range(trees):
        digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}:{t // 4}")))
        part = F.substring(digest, 1 + 8 * (t % 4), 8)
        weights.append(sum((part >= cut).cast("int") for cut in poisson_cuts()))
    return F.array(*weights)


def packed_weights(key: Column, trees: int, seed: int) -> Column:
    """binary: ``row_weights``, a byte a tree, from the same digests."""
    n_digests = -(-trees // 4)
    digests = [F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}:{k}"))) for k in range(n_digests)]
    cuts = np.array([int(c, 16) for c in poisson_cuts()], np.uint32)

    @F.arrow_udf("binary")
    def passed(digest: pa.Array) -> pa.Array:
        draws = _matrix(digest, 16 * n_digests).view(">u4")[:, :trees].astype(np.uint32)
        return _binary(np.searchsorted(cuts, draws, side="right").astype(np.uint8))

    return passed(F.unhex(F.concat(*digests)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width) bytes of binary values that all have ``width``."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.zeros((0, width), np.uint8)
    start = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
    return np.frombuffer(column.buffers()[2], np.uint8, len(column) * width, start).reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """Matrices of about BLOCK_ROWS rows from batches of one binary column."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(_matrix(batch.column(0), width))
        if sum(map(len, held)) >= BLOCK_ROWS:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def _cell_batches(names: Sequence[str], columns: Sequence[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(columns[0]), 1 << 16):
        types = [pa.int32()] * (len(names) - 1) + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c[a : a + (1 << 16)].astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types, strict=True)], list(names))


def node_features(tree: int, node: int, n_features: int, seed: int) -> list[int]:
    """The features a node may split on: the first ceil(sqrt(n)) by digest."""
    import hashlib

    order = sorted(range(n_features), key=lambda f: (hashlib.md5(f"{seed}:{tree}:{node}:{f}".encode()).hexdigest(), f))
    return sorted(order[: math.ceil(math.sqrt(n_features))])


@dataclass
class Forest:
    inputs: tuple[str, ...]
    classes: int
    trees: int
    depth: int
    cuts: list[list[float]]
    splits: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)
    leaves: dict[tuple[int, int], dict[int, int]] = field(default_factory=dict)

    @property
    def width(self) -> int:
        """Places for one tree's nodes (heap numbers from 1)."""
        return 1 << (self.depth + 1)

    def bin(self, f: int, values: np.ndarray) -> np.ndarray:
        """How many cuts of input ``f`` lie below each value (NaN: all)."""
        return np.searchsorted(np.array(self.cuts[f], np.float64), values, side="left")

    def walk(self, tree: int, bins: Sequence[np.ndarray], levels: int) -> np.ndarray:
        """Each row's node of a tree after ``levels`` steps, from the bins of
        each input; rows stay in unsplit nodes."""
        node = np.ones(len(bins[0]), np.uint8 if self.width <= 256 else np.int32)
        for level in range(levels):
            split, right = np.zeros(len(node), bool), np.zeros(len(node), bool)
            for n in range(1 << level, 2 << level):
                if (tree, n) in self.splits:
                    f, b = self.splits[tree, n]
                    here = node == n
                    split |= here
                    right |= here & (bins[f] > b)
            node += (node + right) * split
        return node

    def shares(self) -> np.ndarray:
        """(trees, nodes, classes): the labels' shares in each leaf, in UNITs."""
        out = np.zeros((self.trees, self.width, self.classes), np.int64)
        for (tree, node), found in self.leaves.items():
            total = sum(found.values())
            out[tree, node] = [UNIT * found.get(c, 0) // total for c in range(self.classes)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (vector) and ``prediction`` (0-based label with
        most votes, ties to the lower one). A row that lacks an input on its
        way has no prediction."""
        ship_package(df.sparkSession)
        forest, shares = self, self.shares()

        @F.arrow_udf("struct<probability: array<double>, prediction: double>")
        def vote(inputs: pa.Array) -> pa.Array:
            values = [inputs.field(f) for f in range(len(forest.inputs))]
            bins = [forest.bin(f, x.to_numpy(zero_copy_only=False).astype(np.float64)) for f, x in enumerate(values)]
            lacks = {f: x.is_null().to_numpy(zero_copy_only=False) for f, x in enumerate(values) if x.null_count}
            votes = np.zeros((len(inputs), forest.classes), np.int64)
            lost = np.zeros(len(inputs), bool)
            for tree in range(forest.trees):
                node = forest.walk(tree, bins, forest.depth)
                votes += shares[tree][node]
                for (t, n), (f, _) in forest.splits.items() if lacks else ():
                    if t == tree and f in lacks:
                        lost |= lacks[f] & (forest.walk(tree, bins, n.bit_length() - 1) == n)
            probability = pa.ListArray.from_arrays(pa.array(np.arange(len(votes) + 1, dtype=np.int32) * forest.classes), pa.array((votes / float(UNIT * forest.trees)).ravel()))
            return pa.StructArray.from_arrays([probability, pa.array(votes.argmax(1).astype(np.float64))], ["probability", "prediction"], mask=pa.array(lost))

        voted = df.withColumn("__votes", vote(F.struct(*[F.col(c).cast("double").alias(f"x{f}") for f, c in enumerate(self.inputs)])))
        return voted.withColumns({"probability": array_to_vector("__votes.probability"), "prediction": F.col("__votes.prediction")}).drop("__votes")

    def nodes(self) -> list[tuple[int, int, int | None, float | None]]:
        """(tree, node, feature, threshold): splits go left up to the threshold;
        leaves have neither."""
        found = [(t, n, f, self.cuts[f][b]) for (t, n), (f, b) in self.splits.items()]
        return sorted(found + [(t, n, None, None) for t, n in self.leaves], key=lambda x: x[:2])


def sample_digest(key: Column) -> Column:
    """Eight hex digits that place a row in the sample its bins come from."""
    return F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":bins"))), 1, 8)


def bin_cuts(train: DataFrame, inputs: Sequence[str], key: str, bins: int = BINS, sample_rows: int = SAMPLE_ROWS, digest: Column | None = None) -> list[list[float]]:
    """The cuts of each input (at most bins - 1 numbers each, collected)."""
    rows = train.count()
    if rows > sample_rows:
        digest = sample_digest(F.col(key)) if digest is None else digest
        train = train.where(digest < f"{sample_rows * 2**32 // rows:08x}")
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("x")) for i, c in enumerate(inputs)])
    counts = train.select(F.explode(pairs).alias("p")).groupBy("p.f", "p.x").count()
    upto = Window.partitionBy("f").orderBy("x")
    whole = Window.partitionBy("f")
    # a value is the cut of every k with cumulative >= k * n / bins > cumulative before
    passed = counts.select("f", "x", "count", F.sum("count").over(upto).alias("c"), F.sum("count").over(whole).alias("n"))
    after = F.floor(F.col("c") * bins / F.col("n"))
    before = F.floor((F.col("c") - F.col("count")) * bins / F.col("n"))
    found = passed.where((after > before) & (F.col("c") < F.col("n"))).select("f", "x").collect()
    return [sorted(r.x for r in found if r.f == i) for i in range(len(inputs))]


def _best_splits(cells: DataFrame) -> DataFrame:
    """(tree, node, feature, bin) of nodes that gain by a split, from (tree,
    node, feature, bin, label, w)."""
    of_label = Window.partitionBy("tree", "node", "feature", "label").orderBy("bin")
    of_feature = Window.partitionBy("tree", "node", "feature")
    w = F.col("w")
    left = F.sum("w").over(of_label) - w  # the label's weight in lower bins
    right = F.sum("w").over(of_label.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - left
    squares = cells.repartition("tree", "node").select("tree", "node", "feature", "bin", w, (2 * left * w + w * w).alias("dl"), (w * w - 2 * right * w).alias("dr"))
    by_bin = squares.groupBy("tree", "node", "feature", "bin").agg(F.sum("w").alias("w"), F.sum("dl").alias("dl"), F.sum("dr").alias("dr"))
    along = of_feature.orderBy("bin")
    all_squares = F.sum("dl").over(of_feature)
    sums = by_bin.select(
        "tree", "node", "feature", "bin",
        F.sum("w").over(along).alias("l"),
        F.sum("w").over(of_feature).alias("n"),
        F.sum("dl").over(along).alias("sl"),
        (all_squares + F.sum("dr").over(along)).alias("sr"),
        all_squares.alias("s"),
    )
    d = lambda c: F.col(c).cast("double")
    scored = sums.where(F.col("l") < F.col("n")).select("tree", "node", "feature", "bin", (d("sl") / d("l") + d("sr") / (d("n") - d("l"))).alias("score"), (d("s") / d("n")).alias("whole"))
    first = Window.partitionBy("tree", "node").orderBy(F.col("score").desc(), "feature", "bin")
    return scored.where("score > whole").withColumn("rank", F.row_number().over(first)).where("rank = 1").select("tree", "node", "feature", "bin")


def fit(
    train: DataFrame,
    inputs: Sequence[str],
    label: str,
    classes: int,
    key: str,
    trees: int = TREES,
    depth: int = DEPTH,
    bins: int = BINS,
    seed: int = 1,
    weights: Column | None = None,
    digest: Column | None = None,
) -> Forest:
    """Grow a forest on ``train`` (complete rows; ``label`` 0-based below
    ``classes``). Without rows there is no tree: every label gets no vote and the
    prediction is the first one. Rows of one key share their weights. Where
    several forests grow on the same rows, ``weights`` and ``digest`` are columns
    that hold ``packed_weights`` and ``sample_digest`` already."""
    ship_package(train.sparkSession)
    forest = Forest(tuple(inputs), classes, trees, depth, bin_cuts(train, inputs, key, bins, digest=digest))
    weights = packed_weights(F.col(key), trees, seed) if weights is None else weights
    kind = np.uint8 if max(classes, bins) <= 256 else np.uint16
    n_inputs, tries = len(forest.inputs), math.ceil(math.sqrt(len(forest.inputs)))
    fields = 1 + n_inputs + trees
    width = fields * np.dtype(kind).itemsize
    n_bins = 1 + max(map(len, forest.cuts))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.empty((batch.num_rows, fields), kind)
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            if len(labels) and not (labels.min() >= 0 and labels.max() < classes):
                raise ValueError(f"labels must lie between 0 and {classes - 1}")
            rows[:, 0] = labels
            for f in range(n_inputs):
                rows[:, 1 + f] = forest.bin(f, batch.column(2 + f).to_numpy(zero_copy_only=False).astype(np.float64))
            rows[:, 1 + n_inputs :] = _matrix(batch.column(1), trees)
            yield pa.RecordBatch.from_arrays([_binary(rows)], ["row"])

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        """Label, bins of each input, weight in each tree."""
        for block in _blocks(batches, width):
            yield np.ascontiguousarray(block.view(kind).T)

    rows = train.select(F.col(label).cast("int").alias("label"), weights.alias("weights"), *[F.col(c).cast("double").alias(f"x{f}") for f, c in enumerate(forest.inputs)])
    rows = rows.mapInArrow(pack, "row binary").persist()  # a few bytes a row
    try:
        for level in range(depth):
            open_nodes = [(t, n) for t in range(trees) for n in range(1 << level, 2 << level) if level == 0 or (t, n // 2) in forest.splits]
            if not open_nodes:
                break
            first, places = 1 << level, n_bins * classes
            chosen = np.zeros((trees, tries, first), np.int64)
            for t, n in open_nodes:
                chosen[t, :, n - first] = node_features(t, n, n_inputs, seed)

            def count(batches: Iterator[pa.RecordBatch], level: int = level, first: int = first, places: int = places, chosen: np.ndarray = chosen) -> Iterator[pa.RecordBatch]:
                sums = np.zeros((trees, tries, first * places))
                for c in columns(batches):
                    n = c.shape[1]
                    cell = (c[1 : 1 + n_inputs].astype(np.int64) * classes + c[0]).ravel()  # of each input and row
                    for t in range(trees):
                        node, w = forest.walk(t, c[1 : 1 + n_inputs], level), c[1 + n_inputs + t]
                        at = np.flatnonzero((node >= first) & (w > 0))
                        inside, w = node[at].astype(np.int64) - first, w[at].astype(np.float64)
                        for j in range(tries):
                            sums[t, j] += np.bincount(cell[chosen[t, j][inside] * n + at] + inside * places, w, first * places)
                tree, j, node, b, y = np.nonzero(sums.reshape(trees, tries, first, n_bins, classes))
                yield from _cell_batches(("tree", "node", "feature", "bin", "label", "w"), (tree, node + first, chosen[tree, j, node], b, y, sums[sums != 0]))

            counted = rows.mapInArrow(count, "tree int, node int, feature int, bin int, label int, w long")
            cells = counted.groupBy("tree", "node", "feature", "bin", "label").agg(F.sum("w").alias("w"))
            for r in _best_splits(cells).collect():  # a row a node
                forest.splits[r.tree, r.node] = (r.feature, r.bin)

        def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((trees, forest.width * classes))
            for c in columns(batches):
                for t in range(trees):
                    node = forest.walk(t, c[1 : 1 + n_inputs], depth).astype(np.int64)
                    sums[t] += np.bincount(node * classes + c[0], c[1 + n_inputs + t], forest.width * classes)
            tree, node, y = np.nonzero(sums.reshape(trees, forest.width, classes))
            yield from _cell_batches(("tree", "node", "label", "w"), (tree, node, y, sums[sums != 0]))

        for r in rows.mapInArrow(leaves, "tree int, node int, label int, w long").groupBy("tree", "node", "label").agg(F.sum("w").alias("w")).collect():
            forest.leaves.setdefault((r.tree, r.node), {})[r.label] = r.w
        return forest
    finally:
        rows.unpersist()
