"""The pipeline next to plain versions of its stages, each on what the one before it kept."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from siltstone.llm import decontamination
from siltstone.llm.language_id import MARGIN, NONE, Classifier, learn, learning_rows
from siltstone.llm.mixing import mixed

from .conftest import SCHEMA, prose, rows

EXTRA = ("_id", "_mark", "key", "times", "found_items", "part", "ids")
CLASHING = f"{SCHEMA}, {', '.join(f'{name} string' for name in EXTRA)}"


def corpus():
    """The usual rows, near copies, and passages of two benchmark items."""
    out = [(*r, *EXTRA) for r in rows()]
    items = [prose(501, 40), prose(502, 30)]
    for i, item in enumerate([*items, items[0]]):
        text = f"{prose(600 + i, 80)} {item} {prose(700 + i, 80)}"
        out.append((300 + i, text, "en", f"src{i}", len(text), "x", 0.1, *EXTRA))
    return out, items


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near_copies(docs):
    docs = list(dict.fromkeys(docs))
    sets, group = [shingles(d[1] or "") for d in docs], list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            linked = sets[i] and (sets[i] == sets[j] if None in (docs[i][0], docs[j][0]) else 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]))
            if linked:
                group[find(i)] = find(j)
    first = {}
    for i, d in enumerate(docs):
        order = (d[0] is None, d[0] or 0)
        if find(i) not in first or order < first[find(i)][0]:
            first[find(i)] = (order, d)
    return Counter(d for _, d in first.values())


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_stages_like_plain_versions(spark, tmp_path):
    made, items = corpus()
    folder = str(tmp_path)
    docs = spark.createDataFrame(made, CLASHING)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = docs
    stages = dict(corpus_pipeline.STAGES)

    classifier = Classifier(learn(learning_rows(docs)))
    found = [(r, classifier.language((r[1] or "").encode())) for r in made]
    language = bag(stages["language"](spark, kept, folder))
    assert language == Counter(r for r, (name, gap) in found if name != NONE and gap >= MARGIN)
    assert not any(r[0] in (104, 105, 106, 109) for r in language)

    kept = spark.createDataFrame(list(language.elements()), CLASHING)
    single = bag(stages["near_copies"](spark, kept, folder))
    assert single == plain_near_copies(list(language.elements()))

    kept = spark.createDataFrame(list(single.elements()), CLASHING)
    clean = bag(stages["benchmark"](spark, kept, folder))
    whole = [decontamination.plain(item) for item in items]
    assert clean == Counter({r: n for r, n in single.items() if not any(item in decontamination.plain(r[1]) for item in whole)})
    assert single.total() - clean.total() == 3

    kept = spark.createDataFrame(list(clean.elements()), CLASHING)
    taken = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixed(kept).where("size > 0").collect()}
    mix = bag(stages["mix"](spark, kept, folder))
    assert mix == Counter({r: n * taken[r[0]] for r, n in clean.items() if taken.get(r[0])})

    ran = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=lambda r: r[1])
    tokenizer, start, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for r in sorted(mix.elements(), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(r[1], add_special_tokens=False).ids, 1]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert ran == want


def test_no_documents(spark, tmp_path, none):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_text_and_an_item_that_repeat_themselves(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ENTRIES", 500)
    monkeypatch.setattr(decontamination, "WINDOW", 900)
    docs = spark.createDataFrame([(1, "0" * 6000), (2, "no digits " * 200), (3, None), (4, prose(9, 900) + " " + "0" * 400)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "0" * 300), (8, prose(9, 60)), (9, None)], "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in decontamination.contamination(docs, items).collect()}
    assert got == {1: "7", 2: "", 3: "", 4: "7,8"}


def test_slices_of_a_benchmark_are_stages_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SLICE", 300)
    items = [(i, prose(800 + i, 30)) for i in range(8)]
    docs = spark.createDataFrame([(i, prose(i, 50) + " " + items[i][1]) for i in range(8)], "doc_id long, text string")
    found = decontamination.tagged(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["doc_id"]: r["found_items"] for r in found.collect()} == {i: [i] for i in range(8)}


def test_near_copies_sends_no_table_through_the_driver(spark, docs):
    plan = corpus_pipeline.near_copies(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
