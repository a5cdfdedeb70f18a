import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from siltstone.llm.line_dedup import _Stream, dedup_lines, keep_bitmaps, key_of, packed, unpacked


def plain(rows):
    """``doc_id, n_lines, n_dropped, kept`` by the definition."""
    holders = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                key = line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
                if len(key) >= 20:
                    holders[key].add(doc)
    top = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for line in lines]
        stay = [line for line, key in zip(lines, keys, strict=True) if doc is None or top.get(key, doc) == doc]
        out.append((doc, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return Counter(out)


def made(seed, n):
    rng = random.Random(seed)
    common = [f"This line number {i} is shared by many" for i in range(12)] + ["é" * 20, "é" * 19, "short", "", "exactly twenty chars", "日本語の行はここにあります二十文字以上です。"]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randrange(0, 8)):
            line = rng.choice(common) if rng.random() < 0.7 else f"unique line of document {i} {rng.random()}"
            line = rng.choice([line, line.upper(), f" {line}\t", f"\x0b{line}\x0c\r", line])
            lines.append(line)
        rows.append((i, "\n".join(lines)))
    return rows


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return Counter(tuple(r) for r in dedup_lines(docs, **more).collect())


def test_like_the_definition(spark, table_rows):
    rows = made(1, 150) + [(r[0], r[1]) for r in table_rows]
    rows += [(None, rows[0][1]), (7, "This line number 3 is shared by many\nother"), rows[5], rows[5], (9001, None), (9002, ""), (9003, "\n\n")]
    rows += [(9100 + i, "\n".join(["the only line of these documents"] * 3)) for i in range(5)]
    assert found(spark, rows) == plain(rows)


def test_one_line_in_all_documents_and_very_long_texts(spark):
    boiler = "Click here to accept all cookies"
    rows = [(i, f"{boiler}\nown text of document number {i}\n{boiler}") for i in range(400)]
    rows.append((1000, "\n".join([boiler] * 30000 + [f"line {i} of a long document" for i in range(30000)])))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain(rows)
    assert sum(n * r[2] for r, n in got.items()) == 800


def test_ranges_cut_anywhere_give_the_same(spark):
    """The stream of every cut of sorted rows, its open rows decided by the summaries."""
    rng = random.Random(3)
    rows = sorted({(rng.randrange(6), 0, rng.randrange(5), 0, rng.randrange(4)) for _ in range(60)}, key=lambda r: (r[0], r[1], -r[2], r[3], r[4]))
    docs = defaultdict(set)
    for r in rows:
        docs[r[:2]].add(r[2])
    expected = {r for r in rows if len(docs[r[:2]]) >= 3 and r[2] != max(docs[r[:2]])}
    for _ in range(300):
        cuts = sorted(rng.sample(range(1, len(rows)), rng.randrange(0, 12)))
        gone, opened, seen = set(), [], defaultdict(set)
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            stream, at = _Stream(3), a
            while at < b:
                step = min(rng.randrange(1, 9), b - at)
                stream.push(np.array(rows[at : at + step], np.int64))
                at += step
            stream.finish()
            gone |= {tuple(r) for part in stream.dropped for r in part.tolist()}
            opened += [tuple(r) for part in stream.open for r in part.tolist()]
            for h1, h2, doc in stream.summary:
                seen[h1, h2].add(doc)
        gone |= {r for r in opened if len(seen[r[:2]]) >= 3 and r[2] != max(seen[r[:2]])}
        assert gone == expected


def test_bitmaps(spark, none):
    for gone, n in (([0], 1), ([3, 9], 10), ([7], 8), ([0, 1, 2], 300)):
        assert np.flatnonzero(~unpacked(packed(gone), n)).tolist() == gone
    assert key_of(" \tAbÉ\r".encode()) == "abÉ".encode()
    assert dedup_lines(none).count() == 0
    rows = [(i, "a line that is held by three documents\nx") for i in range(3)]
    maps = keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], unpacked(r["keep"], 2).tolist()) for r in maps) == [(0, [False, True]), (1, [False, True])]


def test_clashing_columns(spark, docs):
    extra = docs.selectExpr("*", "1 as mark", "2 as pos", "3 as keep", "4 as h1", "5 as kind", "6 as top")
    assert Counter(map(tuple, dedup_lines(extra).collect())) == Counter(map(tuple, dedup_lines(docs).collect()))


def test_texts_and_bitmaps_are_joined_the_same_way_at_every_size(spark):
    rows = [(i, f"a line that is held by all documents\nown line of document {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (3, 60):
        result = dedup_lines(docs.where(f"doc_id < {n}"))
        assert Counter(map(tuple, result.collect())) == plain(rows[:n])
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
