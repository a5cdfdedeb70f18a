"""Hard negatives from an R-tree packed by sort-tile-recursion.

Spark cuts the rows into ranges of label and of the two coordinates that vary most, which are the
first slabs; tasks tile their range further into leaves of near vectors and box them, level by level.
A row of the index is one such tree, of one label and of bounded size. A box bounds the inner product
with any anchor: each coordinate adds the larger, or the smaller, of two products. A queue opens
the box of the highest bound first, and drops boxes strictly below the last place of a result and boxes
outside its window of scores. Anchors visit all trees in slices of bounded size. What they find in the
tree that holds them is the bound they start from.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.guards import insist
from ..sources.workspace import fresh_folder, stage

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  #: per cent of the positive's score
LEAF, FAN = 64, 16  #: vectors of a leaf, children of a box
TILE = 8192  #: vectors of a tree
TILE_BYTES = 8 << 20
CUTS = 4  #: coordinates a tree is tiled by
SLICE_BYTES = 32 << 20  #: of anchors that go to all executors at once
AT_ONCE = 1024  #: anchors bounded against a tree by one product
LIMIT = 1 << 25  #: of a component
_TREE = "label long, dim int, ids binary, anchors binary, points binary, leaves binary"


def whole_numbers(vector: Column) -> Column:
    """Each component x as floor(256 * x), or NULL where the vector, or one of them, is NULL or not finite."""
    good = F.forall(vector, lambda x: (x.cast("double") > float("-inf")) & (x.cast("double") < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long")))


def sort_tiles(points: np.ndarray, coordinates: list[int], leaf: int = LEAF) -> list[np.ndarray]:
    """The rows of each leaf: slabs by the first coordinate, those again by the next, and so on."""

    def cut(rows: np.ndarray, left: list[int]) -> list[np.ndarray]:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or not left:
            return [rows[i : i + leaf] for i in range(0, len(rows), leaf)]
        rows = rows[np.argsort(points[rows, left[0]], kind="stable")]
        size = -(-pages // int(np.ceil(pages ** (1 / len(left))))) * leaf
        return [part for i in range(0, len(rows), size) for part in cut(rows[i : i + size], left[1:])]

    return cut(np.arange(len(points)), coordinates)


class Tree:
    """Boxes over the leaves of one tile. Node 0 is the root; nodes from ``first_leaf`` on are leaves."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaves: np.ndarray) -> None:
        self.ids, self.points, self.leaves = ids, points, leaves  # leaf i holds rows leaves[i] to leaves[i + 1]
        low, high = np.minimum.reduceat(points, leaves[:-1]), np.maximum.reduceat(points, leaves[:-1])
        levels = [(low, high)]
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            levels.append((low, high))
        levels.reverse()
        self.low, self.high = (np.concatenate([level[i] for level in levels]) for i in (0, 1))
        self.children: list[range] = []
        start = 0
        for level, below in zip(levels, levels[1:], strict=False):
            start += len(level[0])
            n = len(below[0])
            self.children += [range(start + i, start + min(i + FAN, n)) for i in range(0, n, FAN)]
        self.first_leaf = len(self.children)

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest inner product each anchor can have in each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def rows(self, node: int) -> slice:
        leaf = node - self.first_leaf
        return slice(self.leaves[leaf], self.leaves[leaf + 1])


class Best:
    """The first ``size`` of what was offered: higher scores first, then smaller ids."""

    def __init__(self, size: int, kind: type, low: float = -np.inf, high: float = np.inf) -> None:
        self.size, self.low, self.high = size, low, high
        self.scores, self.ids = np.zeros(0, kind), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = scores >= self.low
        if self.high < np.inf:
            fits &= scores <= self.high
        if fits.any():
            scores, ids = np.append(self.scores, scores[fits]), np.append(self.ids, ids[fits])
            first = np.lexsort((ids, -scores))[: self.size]
            self.scores, self.ids = scores[first], ids[first]
            if len(first) == self.size:
                self.low = max(self.low, self.scores[-1])


def search(tree: Tree, anchor: np.ndarray, least: np.ndarray, most: np.ndarray, wanted: list[Best], but: int | None = None) -> None:
    """Offers ``wanted`` the vectors of ``tree``, without the id ``but``; ``least`` and ``most`` bound its boxes."""

    def worth(node: int) -> bool:
        return any(most[node] >= best.low and least[node] <= best.high for best in wanted)

    queue = [(-most[0], 0)] if worth(0) else []
    while queue:
        _, node = heapq.heappop(queue)
        if not worth(node):
            continue
        if node < tree.first_leaf:
            for child in tree.children[node]:
                if worth(child):
                    heapq.heappush(queue, (-most[child], child))
            continue
        rows = tree.rows(node)
        scores, ids = tree.points[rows] @ anchor, tree.ids[rows]
        if but is not None:
            other = ids != but
            scores, ids = scores[other], ids[other]
        for best in wanted:
            best.offer(scores, ids)


def _matrix(column: pa.ListArray, dim: int, kind: type) -> np.ndarray:
    """Vectors as rows; short ones are filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dim), kind)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _spread(rows: DataFrame, dim: int) -> list[int]:
    """The coordinates, those of the widest spread first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, dim))
        for batch in batches:
            points = _matrix(batch.column("vec"), dim, np.float64)
            total += [np.full(dim, len(points)), points.sum(0), (points**2).sum(0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), *map(pa.array, total)], ["c", "n", "s", "q"])

    sums = rows.select("vec").mapInArrow(run, "c long, n double, s double, q double").groupBy("c")
    spread = sums.agg((F.sum("q") - F.sum("s") * F.sum("s") / F.sum("n")).alias("v"))
    return [r["c"] for r in spread.orderBy(F.desc("v"), "c").collect()]  # one row per coordinate


def packed_trees(rows: DataFrame, dim: int, count: int) -> DataFrame:
    """The index over ``id, label, vec, anchor``: one row per tree."""
    coordinates = _spread(rows, dim)[:CUTS]
    most = max(LEAF, min(TILE, TILE_BYTES // (8 * max(dim, 1))))

    def tree_row(label: int, ids: np.ndarray, anchors: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
        leaves = sort_tiles(points, coordinates)
        order = np.concatenate(leaves)
        ends = np.cumsum([0, *map(len, leaves)]).astype(np.int32)
        raw = [a.tobytes() for a in (ids[order], anchors[order], points[order], ends)]
        return pa.RecordBatch.from_arrays(
            [pa.array([label], pa.int64()), pa.array([dim], pa.int32()), *[pa.array([r], pa.binary()) for r in raw]],
            ["label", "dim", "ids", "anchors", "points", "leaves"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                yield tree_row(label, *(np.concatenate([part[i] for part in held]) for i in range(3)))
                held.clear()

        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            ids, anchors = batch.column("id").to_numpy(), batch.column("anchor").to_numpy(zero_copy_only=False)
            points = _matrix(batch.column("vec"), dim, np.int32)
            a = 0
            while a < len(labels):
                if label != labels[a]:
                    yield from flush()
                    label = int(labels[a])
                room = most - sum(len(part[0]) for part in held)
                same = int(np.argmax(labels[a:] != label)) or len(labels) - a
                b = a + min(room, same)
                held.append((ids[a:b], anchors[a:b], points[a:b]))
                if b - a == room:
                    yield from flush()
                a = b
        yield from flush()

    order = [F.col("label"), *[F.get("vec", F.lit(c)) for c in coordinates[:2]], F.col("id")]
    ranges = max(4 * rows.sparkSession.sparkContext.defaultParallelism, count // (8 * TILE))
    cut = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return stage(cut.mapInArrow(run, _TREE), "trees")


def _trees(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[int, Tree, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            points = np.frombuffer(row["points"], np.int32).reshape(-1, row["dim"]).astype(kind)
            tree = Tree(np.frombuffer(row["ids"], np.int64), points, np.frombuffer(row["leaves"], np.int32))
            yield row["label"], tree, np.frombuffer(row["anchors"], np.bool_)


def _home_bounds(trees: DataFrame, kind: type, size: int) -> DataFrame:
    """``anchor_id, label, vec, bound``: what each anchor finds in the tree that holds it, or NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, tree, marked in _trees(batches, kind):
            at = np.flatnonzero(marked)
            bounds: list[int | None] = []
            for a in range(0, len(at), AT_ONCE):
                anchors = tree.points[at[a : a + AT_ONCE]]
                least, most = tree.intervals(anchors)
                for i, anchor in enumerate(anchors):
                    best = Best(size, kind)
                    search(tree, anchor, least[i], most[i], [best], int(tree.ids[at[a + i]]))
                    bounds.append(int(best.low) if len(best.ids) == size else None)
            vecs = [v.astype(np.int32).tobytes() for v in tree.points[at]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.ids[at]), pa.array(np.full(len(at), label)), pa.array(vecs, pa.binary()), pa.array(bounds, pa.int64())],
                ["anchor_id", "label", "vec", "bound"],
            )

    return trees.mapInArrow(run, "anchor_id long, label long, vec binary, bound long")


_FOUND = "anchor_id long, place int, id long, score long"


def _found(anchors: list[dict], kind: type, trees: DataFrame, same_label: bool, size: int) -> DataFrame:
    """``anchor_id, place, id, score``: the best of each task for every anchor and window (``low, high``)."""
    shared = trees.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        labels = np.array([a["label"] for a in asked])
        points = np.vstack([np.frombuffer(a["vec"], np.int32) for a in asked]).astype(kind)
        best = [[Best(size, kind, low, high) for low, high in a["windows"]] for a in asked]
        for label, tree, _ in _trees(batches, kind):
            at = np.flatnonzero((labels == label) == same_label)
            for a in range(0, len(at), AT_ONCE):
                some = at[a : a + AT_ONCE]
                least, most = tree.intervals(points[some])
                for i, n in enumerate(some):
                    search(tree, points[n], least[i], most[i], best[n], asked[n]["anchor_id"])
        rows = [(asked[n]["anchor_id"], place, b) for n, every in enumerate(best) for place, b in enumerate(every) if len(b.ids)]
        sizes = [len(b.ids) for _, _, b in rows]
        columns = [np.repeat(np.array([r[i] for r in rows], np.int64), sizes) for i in (0, 1)]
        ids, scores = (np.concatenate([np.zeros(0, np.int64), *[getattr(b, name).astype(np.int64) for _, _, b in rows]]) for name in ("scores", "ids"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0]), pa.array(columns[1].astype(np.int32)), pa.array(scores), pa.array(ids)], ["anchor_id", "place", "id", "score"]
        )

    return trees.mapInArrow(run, _FOUND)


def _first(found: DataFrame, size: int) -> DataFrame:
    """``found`` cut to the first ``size`` of each place, with their ``rank``; Spark limits each task's part first."""
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(
    rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``id, label, vec, anchor``.

    Scores are inner products of whole numbers. The positives of an anchor are its first rows of the
    same label, itself excepted; the negatives of each are the first rows of other labels with a score of
    ``low`` to ``high`` per cent of the positive's. Of equal scores the smaller id comes first. Rows with a
    NULL id, label, vector or component take no part; of rows with one id the one with the least label and vector does.
    Vectors of different lengths are filled up with zeros. A component of 2^25 or more stops the job, as
    scores could leave 64 bits. An empty table, or one without anchors, gives an empty result.
    """
    spark = rows.sparkSession
    given = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("vec").cast("array<bigint>"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    given = given.where("id is not null and label is not null and vec is not null")
    given = given.where(F.forall("vec", lambda x: x.isNotNull()))
    given = insist(given, F.forall("vec", lambda x: F.abs(x) < LIMIT), "a component is too large")
    once = given.groupBy("id").agg(F.min(F.struct("label", "vec", "anchor")).alias("r")).select("id", "r.*")
    ready = stage(once, "vectors")
    shape = ready.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim"), F.max(F.array_max(F.transform("vec", F.abs))).alias("top")).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not shape["n"]:
        return spark.createDataFrame([], out)
    dim, top = max(shape["dim"], 1), shape["top"] or 0
    # sums below 2^53 are exact as floats
    kind = np.float64 if dim * top * top < 1 << 52 else np.int64
    trees = packed_trees(ready, dim, shape["n"])
    anchors = stage(_home_bounds(trees, kind, positives), "anchors")
    slices = -(-anchors.count() * (4 * dim + 200) // SLICE_BYTES)
    part = F.pmod(F.xxhash64("anchor_id"), F.lit(max(slices, 1)))
    folder = fresh_folder(spark, "negatives")
    names = "anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long, rank int"
    written = False
    for i in range(slices):
        # a slice holds SLICE_BYTES of anchors at most, about
        asked = [r.asDict() | {"windows": [(-np.inf if r["bound"] is None else r["bound"], np.inf)]} for r in anchors.where(part == i).collect()]
        if not asked:
            continue
        near = _first(_found(asked, kind, trees, True, positives), positives).collect()  # a few rows for each of them
        chosen: dict[int, list] = {}
        for r in sorted(near, key=lambda r: r["rank"]):
            chosen.setdefault(r["anchor_id"], []).append((r["id"], r["score"]))
        asked = [a | {"windows": [(-(-low * s // 100), high * s // 100) for _, s in chosen[a["anchor_id"]]]} for a in asked if a["anchor_id"] in chosen]
        if not asked:
            continue
        far = _first(_found(asked, kind, trees, False, negatives), negatives)
        picked = [(a, place, p, s) for a, every in chosen.items() for place, (p, s) in enumerate(every)]
        told = spark.createDataFrame(picked, "anchor_id long, place int, positive_id long, positive_score long")
        joined = far.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(F.broadcast(told), ["anchor_id", "place"])
        joined.select(*[n.split()[0] for n in names.split(", ")]).write.mode("append").parquet(folder)
        written = True
    if not written:
        return spark.createDataFrame([], out)
    found = spark.read.schema(names).parquet(folder)
    return found.select(*[n.split()[0] for n in out.split(", ")])


def oracle() -> str:
    """The query in SQL."""
    return f"""
    WITH vectors AS (
      SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, vec_id % 50 = 0 AS anchor,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), scored AS (
      SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM vectors a JOIN vectors b ON a.id <> b.id WHERE a.anchor
    ), positives AS (
      SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
    )
    SELECT p.anchor_id, p.id AS positive_id, row_number() OVER near AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
    WINDOW near AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
    QUALIFY row_number() OVER near <= {NEGATIVES}
    """
