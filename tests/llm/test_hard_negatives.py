import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from siltstone.llm import hard_negatives as module
from siltstone.llm.hard_negatives import Best, Tree, hard_negatives, search, sort_tiles, whole_numbers

SCHEMA = "id long, label long, vec array<bigint>, anchor boolean"


def plain(rows, positives=5, negatives=3, low=50, high=95):
    once = {}
    for i, label, vec, anchor in rows:
        if i is not None and label is not None and vec is not None and None not in vec:
            once[i] = min(once.get(i, (label, vec, bool(anchor))), (label, vec, bool(anchor)))
    out = []
    for a, (label, vec, anchor) in once.items():
        if not anchor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vec, v, strict=False)), i, m) for i, (m, v, _) in once.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a, p, rank + 1, n, -s, -t) for rank, (t, n, _) in enumerate(fits)]
    return Counter(out)


def made(seed, n, dim, labels=4, size=40):
    rng = random.Random(seed)
    centres = [[rng.randrange(-size, size) for _ in range(dim)] for _ in range(6)]
    return [(i, rng.randrange(labels), [c + rng.randrange(-size // 2, size // 2) for c in rng.choice(centres)], i % 7 == 0) for i in range(n)]


def found(spark, rows, **more):
    return Counter(tuple(r) for r in hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), **more).collect())


def test_like_brute_force(spark):
    rows = made(1, 700, 8)
    rows += [rows[0], rows[0], (14, 0, [1, 2], True), (5000, None, [1] * 8, True), (None, 1, [1] * 8, True), (5001, 1, None, True), (5002, 1, [1, None], True)]
    rows += [(6000 + i, 9, [7] * 8, i == 0) for i in range(3)] + [(7000 + i, i % 2, [30] * 8, i % 40 == 0) for i in range(200)] + [(8000, 1, [], True), (8001, 77, [1] * 8, None)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, made(2, 200, 3, labels=2), positives=2, negatives=9, low=10, high=100) == plain(made(2, 200, 3, labels=2), 2, 9, 10, 100)


def test_slices_and_large_components(spark, monkeypatch):
    rows = made(3, 300, 5, labels=3, size=1 << 24)
    rows = [(i, m, [x // 2 for x in v], a) for i, m, v, a in rows]
    monkeypatch.setattr(module, "SLICE_BYTES", 2000)
    assert found(spark, rows) == plain(rows)


def test_nothing_to_find(spark):
    assert found(spark, made(1, 0, 2)) == Counter()
    assert found(spark, [(1, 1, [1, 2], False), (2, 2, [1, 2], False)]) == Counter()
    assert found(spark, [(1, 1, [1, 2], True)]) == Counter()
    assert found(spark, [(i, i % 2, [], i == 0) for i in range(6)]) == plain([(i, i % 2, [], i == 0) for i in range(6)])


def test_whole_numbers(spark):
    vectors = [[0.5, -0.001], [math.nan], [math.inf], [1.0, None], None, []]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, v array<float>")
    got = {r["i"]: r["w"] for r in df.select("i", whole_numbers(F.col("v")).alias("w")).collect()}
    assert got == {0: [128, -1], 1: None, 2: None, 3: None, 4: None, 5: []}


def test_boxes_bound_and_the_queue_skips():
    rng = np.random.default_rng(4)
    centres = rng.integers(-300, 300, (40, 6))
    points = (centres[rng.integers(0, 40, 4000)] + rng.integers(-9, 9, (4000, 6))).astype(float)
    leaves = sort_tiles(points, [0, 1, 2, 3])
    order = np.concatenate(leaves)
    assert sorted(order) == list(range(4000)) and max(map(len, leaves)) <= 64
    tree = Tree(order.astype(np.int64), points[order], np.cumsum([0, *map(len, leaves)]))
    least, most = tree.intervals(points[:50])
    for node in range(tree.first_leaf, len(tree.low)):
        scores = points[:50] @ tree.points[tree.rows(node)].T
        assert (scores.min(1) >= least[:, node]).all() and (scores.max(1) <= most[:, node]).all()
    assert (least[:, 0] <= least.min(1)).all() and (most[:, 0] >= most.max(1)).all()

    class Counting(Best):
        seen = 0

        def offer(self, scores, ids):
            Counting.seen += len(ids)
            super().offer(scores, ids)

    for i in range(50):
        best = Counting(5, np.float64)
        search(tree, points[i], least[i], most[i], [best], None)
        exact = sorted((-s, n) for n, s in enumerate(points @ points[i]))[:5]
        assert [(-s, n) for s, n in zip(best.scores, best.ids, strict=True)] == exact
    assert Counting.seen < 50 * 4000 / 4
