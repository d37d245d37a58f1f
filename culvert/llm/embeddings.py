"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the vectors again and again along random directions; vectors near a
split spill over to both sides. The splits are fitted on a sample of bounded size, and
below the nodes that the sample fills, medians of the node's own sample go on, so any
number of vectors is parted into leaves of about ``LEAF``. The number of trees follows
from the depth: two vectors exactly at the threshold share a leaf with probability
``RECALL``, closer ones with more. Spark deals the leaves to tasks, where all vectors
of a leaf are compared exactly. A pair is counted in the first leaf that it shares
only, so no list of pairs has to be made distinct.

A large group of near copies is known from the sample as a ball so narrow that any two
vectors in it are linked: its members are counted, not compared with each other. Leaves
with more vectors than a task compares are cut into blocks, and pairs of blocks dealt.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culvert.llm.components import components
from culvert.llm.frames import stored

COSINE = 0.9
#: Vectors in a leaf, about, and in a block of a leaf that has more.
LEAF, BLOCK = 512, 2048
#: Chance that two vectors with just the least cosine share a leaf of some tree.
RECALL = 0.95
#: Half width of the spill, in standard deviations of a node's projections.
SPILL = 0.1
#: Bytes of the sample that the splits are fitted on, at most, as float32.
SAMPLE_BYTES = 8 << 20
#: Fewest sampled vectors that a node is split by.
LEAST_FIT = 16
#: Part of the sample that makes a ball, and vectors tried as centres.
BALL_SHARE, PROBES = 1 / 200, 1024
_SEED = 13
_TREE_BITS = 48


def _stay(cosine: float, spill: float) -> float:
    """Chance that a median split leaves two such vectors together: they part if they
    lie beyond the spill on both sides, taken as normal with correlation ``cosine``."""
    mean, half = math.sqrt((1 + cosine) / 2), math.sqrt((1 - cosine) / 2)
    a = spill / half
    tail = math.exp(-a * a / 2) / math.sqrt(2 * math.pi) - a * math.erfc(a / math.sqrt(2)) / 2
    return 1 - 4 * half / (mean * math.sqrt(2 * math.pi)) * tail


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision, safe for very large and small ones."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dims: int, kind: type) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled up with 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), kind)
    out[np.arange(dims) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


@dataclass
class Tree:
    """Directions per level; per node its splits by level and its children."""

    directions: np.ndarray  # dims x depth
    at: np.ndarray  # nodes x depth
    margin: np.ndarray  # nodes x depth
    left: np.ndarray
    right: np.ndarray

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and path of each vector in each of its leaves."""
        projected = x @ self.directions
        row, node, path = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for level in range(self.at.shape[1]):
            value, at, margin = projected[row, level], self.at[node, level], self.margin[node, level]
            lower, upper = value < at + margin, value >= at - margin
            row, path = np.concatenate([row[lower], row[upper]]), np.concatenate([2 * path[lower], 2 * path[upper] + 1])
            node = np.concatenate([self.left[node[lower]], self.right[node[upper]]])
        return row, path


def _split(values: np.ndarray) -> float:
    """Where the sorted values lie thinnest, weighed by how even the parts are."""
    n = len(values)
    wide = max(1, n // 64)
    k = np.arange(wide, n - wide)
    if not len(k):
        return float(np.median(values))
    share = k / n
    best = k[np.argmax((values[k + wide] - values[k - wide]) * np.minimum(share, 1 - share))]
    return float(values[best - 1] + values[best]) / 2


def _grow(x: np.ndarray, depth: int, cosine: float, rng: np.random.Generator) -> Tree:
    directions = rng.normal(size=(x.shape[1], depth))
    directions /= np.sqrt((directions**2).sum(axis=0))
    projected = x @ directions
    narrow = math.cos(math.acos(cosine) / 2)
    at, margin, left, right = [], [], [], []

    def node() -> int:
        for part, value in ((at, np.full(depth, np.inf)), (margin, np.zeros(depth)), (left, len(left)), (right, len(right))):
            part.append(value)
        return len(left) - 1

    level_nodes = [(node(), np.arange(len(x)))]
    for level in range(depth):
        following = []
        for k, rows in level_nodes:
            mean = x[rows].sum(axis=0)
            length = math.sqrt(float(mean @ mean))
            if len(rows) >= LEAST_FIT and length and float((x[rows] @ mean).min()) >= narrow * length:
                continue  # all linked to each other: not split further
            if len(rows) < 2 * LEAST_FIT:
                if len(rows):  # too few to fit on: medians for all levels that are left
                    rest = projected[rows, level:]
                    at[k][level:], margin[k][level:] = np.median(rest, axis=0), SPILL * rest.std(axis=0)
                continue
            values = projected[rows, level]
            at[k][level], margin[k][level] = _split(np.sort(values)), SPILL * values.std()
            lower = values < at[k][level]
            left[k], right[k] = node(), node()
            following += [(left[k], rows[lower]), (right[k], rows[~lower])]
        level_nodes = following
    return Tree(directions, np.array(at), np.array(margin), np.array(left), np.array(right))


def _balls(x: np.ndarray, cosine: float, rng: np.random.Generator) -> np.ndarray:
    """Centres, at least ``BALL_SHARE`` of the sample around each, any two of it linked."""
    narrow = math.cos(math.acos(cosine) / 2) + 1e-9
    tried = x[rng.permutation(len(x))[:PROBES]]
    count = np.concatenate([(tried[k : k + 64] @ x.T >= narrow).sum(axis=1) for k in range(0, len(tried), 64)] or [np.zeros(0)])
    centres: list[np.ndarray] = []
    for k in np.argsort(-count, kind="stable"):
        if count[k] < max(2, BALL_SHARE * len(x)):
            break
        if not centres or (np.array(centres) @ tried[k]).max() < narrow:
            centres.append(tried[k])
    return np.array(centres).reshape(-1, x.shape[1])


@dataclass
class Forest:
    trees: list[Tree]
    centres: np.ndarray
    narrow: float

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and leaf of each vector in each of its leaves, by row and leaf."""
        found = [tree.leaves(x) for tree in self.trees]
        row = np.concatenate([r for r, _ in found])
        leaf = np.concatenate([p + (t << _TREE_BITS) for t, (_, p) in enumerate(found)])
        order = np.lexsort((leaf, row))
        return row[order], leaf[order]

    def ball(self, x: np.ndarray) -> np.ndarray:
        """The ball of each vector, -1 for none."""
        if not len(self.centres):
            return np.full(len(x), -1)
        near = x @ self.centres.T >= self.narrow
        return np.where(near.any(axis=1), near.argmax(axis=1), -1)


def fit(sample: np.ndarray, rows: int, cosine: float = COSINE) -> Forest:
    """A forest for ``rows`` vectors like those of the sample."""
    rng = np.random.default_rng(_SEED)
    shrink = (1 + math.erf(SPILL / math.sqrt(2))) / 2
    depth = min(40, max(0, math.ceil(math.log(max(1, rows / LEAF)) / -math.log(shrink))))
    chance = _stay(cosine, SPILL) ** depth
    trees = 1 if chance >= RECALL else math.ceil(math.log(1 - RECALL) / math.log1p(-chance))
    narrow = math.cos(math.acos(cosine) / 2) + 1e-9
    return Forest([_grow(sample, depth, cosine, rng) for _ in range(trees)], _balls(sample, cosine, rng), narrow)


def _earlier(codes: np.ndarray, i: np.ndarray, j: np.ndarray, leaf: int) -> np.ndarray:
    """Do two vectors also share a leaf before this one?"""
    before = np.where((codes >= 0) & (codes < leaf), codes, -1)
    out = np.zeros(len(i), bool)
    step = max(1, (1 << 22) // max(1, codes.shape[1]) ** 2)
    for k in range(0, len(i), step):
        a, b = before[i[k : k + step]], before[j[k : k + step]]
        out[k : k + step] = ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=(1, 2))
    return out


def _group_roots(i: np.ndarray, j: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place the one with the least ``order`` that links reach."""
    root = order.copy()
    while True:
        new = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if np.array_equal(new, root):
            return root
        root = new


def compare(
    x: np.ndarray, weight: np.ndarray, ball: np.ndarray, codes: np.ndarray, block: np.ndarray, uid: np.ndarray, leaf: int, cross: bool, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Per vector of a leaf the vectors it is linked to, those of its own ball and pairs
    that share an earlier leaf left out, and the least ``uid`` that these links reach."""
    found_i, found_j = [], []
    step = max(1, (1 << 21) // max(1, len(x)))
    places = np.arange(len(x))
    for k in range(0, len(x), step):
        rows = places[k : k + step]
        wanted = rows[:, None] < places[None, :]
        wanted &= (ball[rows][:, None] != ball[None, :]) | (ball[rows][:, None] < 0)
        if cross:
            wanted &= block[rows][:, None] != block[None, :]
        if wanted.any():
            i, j = np.nonzero(wanted & (x[rows] @ x.T >= cosine))
            first = ~_earlier(codes, rows[i], j, leaf)
            found_i.append(rows[i][first])
            found_j.append(j[first])
    i, j = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_i, found_j))
    links = np.zeros(len(x), np.int64)
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])
    return links, _group_roots(i, j, uid)


def _valid(vector: Column) -> Column:
    """Can the vector be compared: no part missing or without bounds, one not 0?"""
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda v: v != 0), F.lit(False))


def _units(rows: DataFrame) -> DataFrame:
    """Distinct vectors ``(uid, h1, h2, vec, n, least)``: their number of rows and least id."""
    distinct = rows.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("vec").alias("vec"), F.count("*").alias("n"), F.min("id").alias("least")
    )
    return stored(distinct.withColumn("uid", F.monotonically_increasing_id()), "vectors")


def _sample(units: DataFrame, rows: int, dims: int, kind: type) -> np.ndarray:
    share = min(1.0, SAMPLE_BYTES / (4 * dims) / max(1, rows))
    part = units.where(F.pmod(F.xxhash64(F.lit(_SEED), "h1", "h2"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return _unit(_matrix(part.select("vec").toArrow()["vec"], dims, kind)) if rows else np.zeros((0, dims))


def _layout(counts: DataFrame) -> DataFrame:
    """``(leaf, classes, blocks)`` of leaves with more vectors than a block: the first
    block and the number of blocks of each large ball, and of all other vectors."""
    whole = Window.partitionBy("leaf")  # a row per ball at most
    hot = counts.withColumn("all", F.sum("n").over(whole)).where(F.col("all") > BLOCK)
    large = F.when(F.col("n") > BLOCK / 4, F.col("ball")).otherwise(-1)
    classes = hot.groupBy("leaf", large.alias("ball")).agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("parts"))
    placed = classes.withColumn("first", F.sum("parts").over(whole.orderBy("ball")) - F.col("parts"))
    return placed.groupBy("leaf").agg(F.collect_list(F.struct("ball", "first", "parts")).alias("classes"), F.sum("parts").alias("blocks"))


def _dealt(entries: DataFrame, layout: DataFrame) -> DataFrame:
    """The entries in each pair of blocks ``(leaf, i, j)`` that they are compared in."""
    joined = entries.join(layout, "leaf", "left")

    def of(ball: Column) -> Column:
        return F.get(F.filter("classes", lambda c: c["ball"] == ball), 0)

    own = F.coalesce(of(F.col("ball")), of(F.lit(-1)))
    part = F.pmod(F.xxhash64("uid"), F.col("own.parts"))
    partners = F.filter(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: (F.col("own.ball") < 0) | (b < F.col("own.first")) | (b >= F.col("own.first") + F.col("own.parts")),
    )
    hot = F.col("blocks").isNotNull()
    placed = joined.withColumn("own", own).withColumns(
        {
            "block": F.when(hot, F.col("own.first") + part).otherwise(0),
            "other": F.explode(F.when(hot, partners).otherwise(F.array(F.lit(0).cast("long")))),
        }
    )
    return placed.drop("classes", "blocks", "own").withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Two vectors are linked if the forest brings them together and their cosine, in
    double precision, is ``cosine`` or more: ``n_links`` counts the other rows linked to
    a row, ``component_id`` is the smallest id that links reach, its own included, and
    ``kept`` says that it is its own. Vectors that are NULL, empty, zero, or hold
    missing or non-finite numbers are linked to nothing. Of vectors of different length
    the shorter is taken to end in zeros. Equal vectors are linked; rows without an id
    are compared like all others, ``component_id`` is NULL only if no member has an id,
    and only then are such rows kept. An empty table gives no rows.
    """
    spark, vec = vectors.sparkSession, vectors[vector_col]
    kind = np.float32 if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else np.float64
    item = "float" if kind is np.float32 else "double"
    valid = _valid(vec)
    marked = vectors.select(
        vectors[id_col].cast("long").alias("id"),
        F.when(valid, vec).cast(f"array<{item}>").alias("vec"),
        F.when(valid, F.xxhash64(vec)).alias("h1"),
        F.when(valid, F.xxhash64(F.lit(_SEED), vec)).alias("h2"),
    )
    units = _units(marked)
    rows, dims = units.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
    forest = spark.sparkContext.broadcast(fit(_sample(units, rows, dims, kind), rows, cosine))

    def leaf_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_matrix(batch.column(0), dims, kind))
            row, leaf = forest.value.codes(x)
            both, n = np.unique(np.stack([leaf, forest.value.ball(x)[row]]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1].astype(np.int32)), pa.array(n.astype(np.int64))], ["leaf", "ball", "n"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = _matrix(batch.column(2), dims, kind)
            x = _unit(raw)
            row, leaf = forest.value.codes(x)
            ends = np.cumsum(np.bincount(row, minlength=len(x)))
            codes = [leaf[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            held = [r.tobytes() for r in raw]
            take = pa.array(row)
            columns = [batch.column(0), batch.column(1), pa.array(forest.value.ball(x).astype(np.int32)), pa.array(codes, pa.binary()), pa.array(held, pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *(c.take(take) for c in columns)], ["leaf", "uid", "n", "ball", "codes", "raw"])

    def in_leaf(table: pa.Table) -> pa.Table:
        listed = [np.frombuffer(c, np.int64) for c in table["codes"].to_pylist()]
        codes = np.full((len(listed), max(map(len, listed))), -1)
        for k, c in enumerate(listed):
            codes[k, : len(c)] = c
        x = _unit(np.frombuffer(b"".join(table["raw"].to_pylist()), kind).reshape(-1, dims))
        uid, n, ball, block = (table[c].to_numpy() for c in ("uid", "n", "ball", "block"))
        leaf, i, j = (table[c][0].as_py() for c in ("leaf", "i", "j"))
        links, root = compare(x, n, ball, codes, block, uid, leaf, i != j, cosine)
        some = links > 0
        return pa.table({"uid": uid[some], "links": links[some], "root": root[some]})

    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ball = forest.value.ball(_unit(_matrix(batch.column(5), dims, kind)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(5)), pa.array(ball.astype(np.int32))], [*names, "ball"])

    counts = units.select("vec").mapInArrow(leaf_counts, "leaf long, ball int, n long").groupBy("leaf", "ball").agg(F.sum("n").alias("n"))
    entries = units.select("uid", "n", "vec").mapInArrow(placed, "leaf long, uid long, n long, ball int, codes binary, raw binary")
    found = _dealt(entries, stored(_layout(counts), "layout")).groupBy("leaf", "i", "j").applyInArrow(in_leaf, "uid long, links long, root long")
    found = stored(found, "links")
    names = ["uid", "h1", "h2", "n", "least"]
    known = stored(units.select(*names, "vec").mapInArrow(balls, "uid long, h1 long, h2 long, n long, least long, ball int"), "known")
    members = known.where("ball >= 0")
    ball = members.groupBy("ball").agg(F.sum("n").alias("all"), F.min("uid").alias("first"))  # 1 / BALL_SHARE rows, about
    edges = found.select(F.col("uid").alias("a"), F.col("root").alias("b")).unionByName(
        members.join(ball, "ball").select(F.col("uid").alias("a"), F.col("first").alias("b"))
    )
    roots = components(edges).withColumnsRenamed({"node": "uid"})
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    each = known.join(links, "uid", "left").join(ball, "ball", "left").join(roots, "uid", "left").select(
        "h1", "h2", "least", F.coalesce("root", "uid").alias("root"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0)) + F.coalesce(F.col("all") - F.col("n"), F.lit(0))).alias("n_links"),
    )
    each = stored(each, "groups")
    smallest = stored(each.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    # Stored, so Spark can split the rows of a large group in the joins.
    results = stored(each.join(smallest, "root").select("h1", "h2", "n_links", "component_id"), "results")
    linked = marked.where("h1 IS NOT NULL").select("id", "h1", "h2").join(results, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = marked.where("h1 IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
