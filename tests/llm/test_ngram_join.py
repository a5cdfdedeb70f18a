import pickle
import random
import re

import numpy as np
import pytest

from siltstone.llm import common, ngram_join
from siltstone.llm.ngram_join import jaccard_components, one_of_each

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(pairs):
    """(doc_id, set) rows to components; rows without id link by equal sets only."""
    sets = [(i, shingles(t)) for i, t in pairs]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if not x or not y:
                continue
            both = len(x & y)
            if x == y or None not in (sets[a][0], sets[b][0]) and 100 * both >= 75 * (len(x) + len(y) - both):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    return sorted(((i, len(s), least.get(root(a), i) if s else i) for a, (i, s) in enumerate(sets)), key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect()), key=str)


def test_all_kinds_of_rows(docs, table_rows):
    assert found(docs) == brute([(r[0], r[1]) for r in table_rows])


def variants(n, edits, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("heavy, chunk", [(64, 512), (3, 8)])
def test_groups_of_near_copies(spark, monkeypatch, heavy, chunk):
    """Counted pair by pair, and in dense blocks of which a cluster fills several."""
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    texts = variants(40, 8) + variants(30, 3, seed=2) + variants(10, 1, seed=3)
    pairs = list(enumerate(texts))
    assert found(spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)) == brute(pairs)


def test_one_of_each_keeps_the_smallest_and_all_columns(docs, table_rows):
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    parts = {i: c for i, _, c in brute([(r[0], r[1]) for r in table_rows]) if i is not None}
    assert sorted(i for i in ids if i is not None) == sorted({i for i in parts if parts[i] == i})
    assert ids.count(None) == 2


def test_empty_table(none):
    assert jaccard_components(none).count() == 0 and one_of_each(none).count() == 0


def test_no_table_is_sent_through_the_driver(spark, monkeypatch):
    """Small files hold many packed ids, so joins are merges whatever the threshold; with clusters of heavy columns too."""
    monkeypatch.setattr(ngram_join, "HEAVY", 3)
    plans = []

    def noted(df, *args, staged=common.stage):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, *args)

    for module in (common, ngram_join):
        monkeypatch.setattr(module, "stage", noted)
    docs = spark.createDataFrame(list(enumerate(variants(20, 5))), "doc_id long, text string").repartition(3)
    noted(one_of_each(docs), "kept")
    assert sum("SortMergeJoin" in p for p in plans) > 5
    assert not [p for p in plans if "Broadcast" in p]


@pytest.mark.parametrize("bits", [6, 14])
def test_sketch_counts_all_ngrams(spark, bits):
    texts = [None, "", "one", *variants(300, 4)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    hashes = np.concatenate(list(ngram_join._sets([t and t.encode() for t in texts], 5)))
    counted = pickle.loads(pickle.dumps(ngram_join._sketch(docs, 5, bits)))  # as a task gets it
    assert (counted == np.bincount(ngram_join._bucket(hashes, bits), minlength=1 << bits)).all()


def test_few_ngrams_share_a_counter(spark):
    """Else common n-grams hide among the others, and rows without likeness meet in them."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(1500)) for _ in range(40)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    counts = pickle.loads(pickle.dumps(ngram_join._sketch(docs, 5, ngram_join.SKETCH_BITS)))
    assert counts[counts > 1].sum() < 0.05 * counts.sum()


def test_counters_are_packed():
    counts = np.random.default_rng(1).poisson(1, ngram_join.COUNTERS).astype(np.uint32)
    counts[7] = 2**32 - 1
    packed = ngram_join._packed(counts)
    assert len(packed) < len(counts) / 2 and (ngram_join._unpacked(packed, len(counts)) == counts).all()


def test_filter_holds_all_places_and_no_others(spark):
    places = [0, 5, 7, 8, 8, 4097, ngram_join.FILTER_BITS - 1, *random.Random(3).sample(range(ngram_join.FILTER_BITS), 2000)]
    held = ngram_join._filter(spark.createDataFrame([(p,) for p in places], "at long").repartition(3))
    assert np.flatnonzero(np.unpackbits(held, bitorder="little")).tolist() == sorted(set(places))
