import hashlib
import zlib
from collections import Counter, defaultdict

from siltstone.llm.merkle import manifest

from .conftest import SCHEMA

NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def proofs(digests):
    """The root of ``digests`` and for each of them its steps (left, right)."""
    level, steps, at = digests, [[] for _ in digests], list(range(len(digests)))
    while len(level) > 1:
        runs = [level[i : i + 16] for i in range(0, len(level), 16)]
        for i, a in enumerate(at):
            run = runs[a // 16]
            steps[i].append((run[: a % 16], run[a % 16 + 1 :]))
        at, level = [a // 16 for a in at], [h(*run) for run in runs]
    return level[0], steps


def plain(rows):
    """Rows of ``NAMES``."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for source in order:
        mine = sorted(trees[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        tops[source] = (mine, *proofs([leaf(r) for r in mine]))
    root, above = proofs([tops[s][1] for s in order])
    out = []
    for at, source in enumerate(order):
        mine, subroot, steps = tops[source]
        for row, own in zip(mine, steps, strict=True):
            path = own + above[at]
            digest = leaf(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                digest = leaf((*row[:4], row[4].translate({c: c + 32 for c in range(65, 91)})))
            for left, right in path:
                digest = h(*left, digest, *right)
            out.append((row[0], leaf(row), subroot, root, h(*[x for left, right in path for x in left + right]), digest, digest == root))
    return Counter(out)


def found(docs):
    return Counter(tuple(r) for r in manifest(docs).drop("path").collect())


def test_like_the_definition(spark, docs, table_rows, none):
    assert found(docs) == plain([(r[0], r[3], r[2], r[4], r[1]) for r in table_rows])
    assert found(docs.selectExpr("*", "1 as tree", "2 as rank", "3 as digest", "4 as item", "5 as block", "6 as total", "7 as path")) == found(docs)
    assert manifest(none).count() == 0


def test_small_trees(spark):
    for sizes in ([1], [16], [17, 1], [1, 2, 256, 257]):
        rows = [(i, f"s{s}", "en", 3, f"Text {i}") for s, n in enumerate(sizes) for i in range(1000 * s, 1000 * s + n)]
        docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "x", 0.0) for r in rows], SCHEMA)
        assert found(docs) == plain(rows)


def test_more_than_a_block_of_rows_and_of_sources(spark):
    rows = [(i, "hot" if i % 2 else f"host{i}", None, i, f"Page {i % 7} É") for i in range(9000)]
    rows += [(5, "hot", "en", 1, "the same row")] * 300 + [(None, None, None, None, None)] * 40
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "x", 0.0) for r in rows], SCHEMA).repartition(8)
    got = found(docs)
    assert got == plain(rows)
    tampered = sum(n for r, n in got.items() if not r[6])
    assert 0.1 * len(rows) < tampered < 0.3 * len(rows)
