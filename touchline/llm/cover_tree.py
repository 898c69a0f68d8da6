"""Exact cosine threshold pairs by a dual traversal of a cover tree.

On unit vectors, cosine >= c means a chord of at most sqrt(2 - 2c). The tree's
nodes come from a bounded sample (``SAMPLE`` vectors, least in hash order, at
most ``LEAVES`` leaves): levels of radius 1, 1/2, 1/4, nested (a node goes on as
its own child), every sampled vector within the radius of its node. All vectors
then descend to the nearest child, level by level, and each node's true covering
radius is the greatest distance of any vector below it. The traversal starts at
the pair (root, root) and drops node pairs whose centres are further apart than
both covering radii and the chord; what is left are leaf pairs that may hold
links. Nothing is lost: the bounds use all vectors.

Leaves are packed into blocks of about ``BLOCK`` vectors; a leaf with more is
dealt over several blocks. One task compares the surviving leaf pairs of one
pair of blocks with matrix products and returns link counts and, for each
product, edges that span its components: never the pairs themselves.

Vectors of different lengths have no cosine: every length has its own sample,
tree and blocks, and all lengths go through the same steps together.

Defined results: vectors that are null, zero or hold null or non-finite
components link with nothing; identical vectors are one class with a
multiplicity; repeated rows come back as often as they came; rows of null id are
compared like others, take the smallest id of their group as component and are
kept only where the group has none; an id with several vectors joins their groups; an empty table gives no rows. Only the
id and vector columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import map_batches, ship_package, stored
from touchline.llm.components import connected_components

SAMPLE = 1024
LEAVES = 256
BLOCK = 8192
RADII = (1.0, 0.5, 0.25)
_SLACK = 1e-7  # rounding of centre distances


class Tree:
    """Nodes by level; level 0 is the root."""

    def __init__(self, sample: np.ndarray) -> None:
        self.centers = [sample[:1]]
        self.parent = [np.zeros(1, np.int64)]
        at = np.zeros(len(sample), np.int64)
        for radius in RADII:
            chosen: list[int] = []
            parents: list[int] = []
            below = np.full(len(sample), -1)
            # a node goes on as its own child
            for k, c in enumerate(self.centers[-1]):
                chosen.append(int(np.argmin(((sample - c) ** 2).sum(1))))
                parents.append(k)
            for i, c in enumerate(chosen):
                near = (at == parents[i]) & (below < 0) & (np.sqrt(np.maximum(2 - 2 * sample @ sample[c], 0)) <= radius)
                below[near] = i
            while (below < 0).any() and len(chosen) < LEAVES:
                c = int(np.argmax(below < 0))
                near = (at == at[c]) & (below < 0) & (np.sqrt(np.maximum(2 - 2 * sample @ sample[c], 0)) <= radius)
                near[c] = True
                below[near] = len(chosen)
                chosen.append(c)
                parents.append(int(at[c]))
            centers = sample[chosen]
            self.centers.append(centers)
            self.parent.append(np.array(parents))
            at = self._nearest(sample, at, len(self.centers) - 1)[0]

    def _nearest(self, v: np.ndarray, at: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Child nodes of ``at`` nearest to v, and their distances."""
        d = np.sqrt(np.maximum(2 - 2 * v @ self.centers[level].T, 0))
        d[self.parent[level][None, :] != at[:, None]] = np.inf
        node = d.argmin(1)
        return node, d[np.arange(len(v)), node]

    def descend(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node, distance) at every level, as (levels, vectors)."""
        at = np.zeros(len(v), np.int64)
        nodes, distances = [at], [np.sqrt(np.maximum(2 - 2 * v @ self.centers[0][0], 0))]
        for level in range(1, len(self.centers)):
            at, d = self._nearest(v, at, level)
            nodes.append(at)
            distances.append(d)
        return np.array(nodes), np.array(distances)

    def leaf_pairs(self, radius: list[np.ndarray], chord: float) -> np.ndarray:
        """Dual traversal; radius[level][node] < 0 marks empty nodes."""
        pairs = np.zeros((1, 2), np.int64)
        for level in range(1, len(self.centers)):
            children = [np.flatnonzero((self.parent[level] == k) & (radius[level] >= 0)) for k in range(len(self.centers[level - 1]))]
            found = []
            for a, b in pairs:
                x, y = children[a], children[b]
                d = np.sqrt(np.maximum(2 - 2 * self.centers[level][x] @ self.centers[level][y].T, 0))
                i, j = np.nonzero(d <= radius[level][x][:, None] + radius[level][y][None, :] + chord + _SLACK)
                both = np.stack((x[i], y[j]), 1)
                found.append(both[both[:, 0] <= both[:, 1]] if a == b else np.sort(both, 1))
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pairs


def _links(u: np.ndarray, w: np.ndarray, least: float) -> np.ndarray:
    """Boolean matrix of cosine >= least. Products in single precision decide
    all but a narrow band, which is computed again in double precision."""
    g = u.astype(np.float32) @ w.astype(np.float32).T
    linked = g >= least
    i, j = np.nonzero(np.abs(g - np.float32(least)) < 1e-5)
    if len(i):
        linked[i, j] = np.einsum("ij,ij->i", u[i], w[j]) >= least
    return linked


def compare_blocks(v: np.ndarray, leaf: np.ndarray, block: np.ndarray, copies: np.ndarray, a: int, b: int, allowed: dict[int, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links within block ``a`` (if a == b) or between blocks a and b:
    (number of linked vectors, copies counted, of each row; edge ends x, y)."""
    count = np.zeros(len(v), np.int64)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    own, other = np.flatnonzero(block == a), np.flatnonzero(block == b)
    for k in np.unique(leaf[own]):
        rows = own[leaf[own] == k]
        near = allowed.get(int(k))
        if near is None:
            continue
        columns = other[np.isin(leaf[other], near)]
        for part in np.array_split(rows, -(-len(rows) // 512)):
            if not len(columns):
                continue
            linked = _links(v[part], v[columns], least)
            linked &= part[:, None] != columns[None, :]
            if not linked.any():
                continue
            count[part] += linked @ copies[columns]
            if a != b:
                count[columns] += copies[part] @ linked
            r, c = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
            m = linked[np.ix_(r, c)]
            low_r, low_c = np.arange(len(r)), np.full(len(c), len(r))
            while True:  # least row reachable, spread until nothing changes
                new_c = np.minimum(low_c, np.where(m, low_r[:, None], len(r)).min(0))
                new_r = np.minimum(low_r, np.where(m, new_c[None, :], len(r)).min(1))
                if (new_c == low_c).all() and (new_r == low_r).all():
                    break
                low_r, low_c = new_r, new_c
            ends.append((part[r][low_r], part[r]))
            ends.append((part[r][low_c], columns[c]))
    if not ends:
        return count, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return count, np.concatenate([x for x, _ in ends]), np.concatenate([y for _, y in ends])


def near_vectors(vectors: DataFrame, least: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    ship_package(spark)
    chord = math.sqrt(max(2 - 2 * least, 0))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    good = F.size("v") > 0
    good = good & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    rows = stored(rows.withColumn("good", F.coalesce(good, F.lit(False))), "vectors")

    # identical vectors are one class
    classes = rows.where("good").groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")  # numbered when written
    order = Window.partitionBy(F.size("v")).orderBy(F.xxhash64("v"), "id")
    picked = classes.select("v", F.row_number().over(order).alias("k")).where(F.col("k") <= SAMPLE).orderBy("k").select("v").toPandas()
    if not len(picked):
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    trees = {int(d): Tree(_unit(np.array(same.v.tolist(), np.float64))) for d, same in picked.groupby(picked.v.map(len))}

    def place(batch: pa.RecordBatch):
        lengths = pc.list_value_length(batch.column(2)).to_numpy()
        for d in np.unique(lengths).tolist():
            part = batch.filter(pa.array(lengths == d))
            v = _unit(part.column(2).flatten().to_numpy().reshape(-1, d))
            nodes, distances = trees[d].descend(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), d), pa.int32()), part.column(0), part.column(1), pa.array([x.tobytes() for x in v], pa.binary()), pa.array(nodes.T.tolist(), pa.list_(pa.int32())), pa.array(distances.T.tolist(), pa.list_(pa.float64()))], ["d", "id", "copies", "u", "nodes", "far"])

    placed = stored(map_batches(classes.select("id", "copies", "v"), place, "d int, id long, copies long, u binary, nodes array<int>, far array<double>"), "placed")
    # one row a node: at most LEAVES a level and length
    stats = placed.select("d", F.posexplode("nodes").alias("level", "node"), "far").groupBy("d", "level", "node").agg(F.max(F.get("far", F.col("level"))).alias("r"), F.count("*").alias("n")).collect()
    radius = {d: [np.full(len(c), -1.0) for c in tree.centers] for d, tree in trees.items()}
    size = {d: np.zeros(len(tree.centers[-1]), np.int64) for d, tree in trees.items()}
    for s in stats:
        radius[s["d"]][s["level"]][s["node"]] = s["r"]
        if s["level"] == len(trees[s["d"]].centers) - 1:
            size[s["d"]][s["node"]] = s["n"]
    pairs = {d: tree.leaf_pairs(radius[d], chord) for d, tree in trees.items()}
    allowed: dict[int, dict[int, np.ndarray]] = {d: {} for d in trees}
    for d, found in pairs.items():
        for k in np.unique(found):
            allowed[d][int(k)] = np.unique(np.concatenate((found[found[:, 0] == k, 1], found[found[:, 1] == k, 0])))

    # leaves (in tree order) to blocks: first block and number of blocks of each
    first, parts, block = {}, {}, -1
    for d, tree in trees.items():
        block, room = block + 1, BLOCK  # no block holds two lengths
        for k in np.argsort(tree.parent[-1], kind="stable").tolist():
            n = int(size[d][k])
            if not n:
                continue
            if n > room and room < BLOCK:
                block, room = block + 1, BLOCK
            first[d, k], parts[d, k] = block, -(-n // BLOCK)
            if parts[d, k] > 1:
                block, room = block + parts[d, k], BLOCK
            else:
                room -= n
    leaves = spark.createDataFrame([(d, k, first[d, k], parts[d, k]) for d, k in first], "d int, leaf int, first int, parts int")
    # leaf pairs, at most LEAVES squared a length; their blocks are dealt out by Spark
    table = spark.createDataFrame([(first[d, a], parts[d, a], first[d, b], parts[d, b]) for d in pairs for a, b in pairs[d].tolist()], "fa int, pa int, fb int, pb int")
    spread = lambda f, p: F.explode(F.sequence(F.col(f), F.col(f) + F.col(p) - 1))
    jobs = table.select("fb", "pb", spread("fa", "pa").alias("x")).select("x", spread("fb", "pb").alias("y")).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    sides = jobs.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    dealt = placed.select("d", "id", "copies", "u", F.element_at("nodes", -1).alias("leaf")).join(F.broadcast(leaves), ["d", "leaf"])
    dealt = dealt.select("d", "id", "copies", "u", "leaf", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("block"))

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        d = int(group.d.iloc[0])
        u = np.frombuffer(b"".join(group.u), np.float64).reshape(-1, d)
        ids = group.id.to_numpy()
        n, x, y = compare_blocks(u, group.leaf.to_numpy(), group.block.to_numpy(), group.copies.to_numpy(), int(key[0]), int(key[1]), allowed[d], least)
        has = np.flatnonzero(n)
        return pd.DataFrame({"d": np.full(len(has) + len(y), d), "id": np.concatenate((ids[has], ids[y])), "n": np.concatenate((n[has], np.zeros(len(y), np.int64))), "to": np.concatenate((ids[has], ids[x]))})

    found = stored(dealt.join(sides, "block").groupBy("x", "y").applyInPandas(compare, "d int, id long, n long, to long"), "vector-links")
    counts = found.where("n > 0").groupBy("d", "id").agg(F.sum("n").alias("n"))
    several = rows.where("good and vec_id is not null").groupBy("vec_id").agg(F.min(F.xxhash64("v")).alias("low"), F.max(F.xxhash64("v")).alias("high")).where("low <> high").select("vec_id")
    theirs = rows.where("good").join(several, "vec_id", "left_semi").select("vec_id", "v").distinct().join(classes.select("v", "id"), "v").select("vec_id", "id")
    theirs = stored(theirs, "several-vectors")
    same_id = theirs.join(theirs.groupBy("vec_id").agg(F.min("id").alias("to")), "vec_id").select("id", "to")
    parts_of = connected_components(found.where("id <> to").select("id", "to").unionByName(same_id), "id", "to")
    by_class = classes.withColumn("d", F.size("v")).join(counts, ["d", "id"], "left").join(parts_of, F.col("id") == F.col("vertex"), "left")
    by_class = by_class.select(F.col("v").alias("cv"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "vec_id", F.coalesce("component", "id").alias("group"))
    smallest = by_class.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    by_class = by_class.drop("vec_id").join(smallest, "group")
    out = rows.join(by_class, F.when(F.col("good"), F.col("v")) == F.col("cv"), "left")
    component = F.coalesce("component_id", "vec_id")
    kept = F.when(F.col("vec_id").isNull(), component.isNull()).otherwise(F.col("vec_id") == component)
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), kept.alias("kept"))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)  # no overflow
    return v / np.sqrt((v * v).sum(1, keepdims=True))
