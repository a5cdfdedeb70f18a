import random
import re
import zlib
from collections import Counter
from pathlib import Path

import zstandard

from siltstone.llm import compression_bands as bands
from siltstone.llm import language_id
from siltstone.llm.compression_bands import judge_quality
from siltstone.llm.language_id import classify, identify, learn, learning_rows, letters, recognised
from siltstone.llm.mixing import apportion, mixed, mixture, targets

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered |= {i, i + 1, i + 2}
    lines, seen = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


def test_quality_counts(spark, docs, table_rows):
    rng = random.Random(4)
    odd = [(1000 + i, "".join(rng.choice(["a", "b", "a b c", "\n", " ", "\t", "#", "é", "\x0b", " ", "\r"]) for _ in range(rng.randrange(90)))) for i in range(300)]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    got = Counter()
    for r in judge_quality(every).collect():
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        got[r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]] += 1
    assert got == Counter((i, *plain_counts(t)) for i, t in [(r[0], r[1]) for r in table_rows] + odd)


def test_bands_reject_repeats_and_noise_but_not_prose(spark):
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(9)) for _ in range(900))
    english = (
        "It was a bright cold day in April, and the clocks were striking thirteen. The hallway smelt of boiled cabbage and old rag mats. "
        "At one end of it a coloured poster, too large for indoor display, had been tacked to the wall. She walked slowly to the window and looked out. "
    )
    spread = " ".join(f"{w} {i}" for i, w in enumerate(english.split()))
    half_bad = prose(3, 400) + " " + " ".join(f"{i % 7}aaaaaaaaaaaaaaaaaaaaaaaaaaaa{i}" for i in range(600))
    rows = {r["doc_id"]: r for r in judge_quality(spark.createDataFrame([(1, noise), (2, english), (3, spread), (4, half_bad)], "doc_id long, text string")).collect()}
    assert not rows[1]["kept"] and not rows[1]["base_failed"]
    assert rows[2]["kept"] and rows[3]["kept"]
    assert not rows[4]["kept"] and rows[4]["bad_share"] > bands.BAD_SHARE


def test_bands_keep_long_formal_prose_but_not_its_copies(spark):
    texts = {f.name: f.read_text() for f in sorted((Path(bands.__file__).parent / "licenses").iterdir()) if f.name in ("Apache-2.0", "GFDL-1.3", "GPL-3", "LGPL-2.1", "MPL-1.1")}
    rows = [(i, text) for i, text in enumerate(texts.values())] + [(10 + i, text[:1500] * 6) for i, text in enumerate(texts.values())]
    rows.append((20, " | ".join(prose(7, 900).split())))
    got = {r["doc_id"]: r for r in judge_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(texts) == 5 and all(got[i]["kept"] for i in range(5))
    assert not any(bands.usual(text.encode(), got[i]["ratio"]) or got[i]["kept"] for i, text in rows[5:])


def test_language_by_plain_compression(docs, table_rows):
    found = identify(docs).collect()
    assert len(found) == len(table_rows)
    dictionaries = learn(learning_rows(docs.select("doc_id", "text", "lang")))
    assert set(dictionaries) == {"en", "fr"}
    right = total = 0
    for i, text, lang, *_ in table_rows:
        r = next(x for x in found if x["doc_id"] == i)
        if i is None:
            continue
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        if not any(map(str.isalpha, text or "")):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        raw = letters(text).encode()
        params = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=False, write_checksum=False, write_dict_id=False)
        sums = {}
        for name, content in dictionaries.items():
            press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)
            sums[name] = sum(len(press.compress(raw[k : k + 1024])) for k in range(0, len(raw), 1024))
        assert abs(sums[r["lang_pred"]] - min(sums.values())) <= 0.02 * min(sums.values())
        if i < 60:
            total += 1
            right += r["lang_pred"] == lang
    assert right / total >= 0.95


def test_language_of_empty_tables_and_without_labels(docs, none):
    assert identify(none).count() == 0 and recognised(none).count() == 0
    assert {r["lang_pred"] for r in classify(docs, {}).collect()} == {"und"}
    kept = recognised(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_sainte_lague_against_the_rule(spark):
    rng = random.Random(2)
    for _ in range(4):
        groups = {g: [(k, rng.choice([0, 1, 5, 5, 17, 400])) for k in range(rng.randrange(1, 9))] for g in range(6)}
        seats = {g: rng.randrange(0, 60) for g in groups}
        cells = [(g, k, w, seats[g]) for g, members in groups.items() for k, w in members]
        got = {(r["g"], r["k"]): r["quota"] for r in apportion(spark.createDataFrame(cells, "g int, k int, w long, seats long"), "g", "k", "w", "seats").collect()}
        for g, members in groups.items():
            quotients = sorted(((-w / (2 * s + 1), k) for k, w in members if w for s in range(seats[g])))[: seats[g]]
            assert {k: got[g, k] for k, _ in members} == {k: sum(1 for _, x in quotients if x == k) for k, _ in members}


def plain_targets(sizes):
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [n for n in names if n not in capped]
        rest = total - sum(3 * sizes[n] for n in capped)
        share = {n: rest * weight[n] / sum(weight[x] for x in free) for n in free}
        over = {n for n in free if share[n] > 3 * sizes[n]}
        if not over:
            return {n: 3.0 * sizes[n] if n in capped else share[n] for n in names}
        capped |= over


def test_targets_are_reshared(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 1, None: 50}, {"a": 0, "b": 0}, {"é": 5, "z": 7, "Z": 100}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        for r in targets(df).collect():
            assert abs(r["target"] - plain_targets(sizes)[r["source"]]) < 1e-6


def test_mix(docs, none, table_rows):
    found = mixed(docs).collect()
    sizes = Counter()
    for i, text, _, source, *_ in table_rows:
        sizes[source] += len(WORD.findall(text or ""))
    taken = Counter()
    for r in found:
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - plain_targets(sizes)[r["source"]]) < 1e-6
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 32
    assert sorted(map(str, found)) == sorted(map(str, mixed(docs.repartition(5)).collect()))
    again = mixture(docs)
    assert again.columns == docs.columns and again.count() > 0
    assert mixed(none).count() == 0 and mixture(none).count() == 0


def test_signs_that_are_no_letters_have_no_language(spark, docs):
    dictionaries = learn(learning_rows(docs))
    rows = [(1, "½ ² ① 12 ٣ _"), (2, "日本語"), (3, "the morning ½ water")]
    got = {r["doc_id"]: r["lang_pred"] for r in classify(spark.createDataFrame(rows, "doc_id long, text string"), dictionaries).collect()}
    assert got[1] == "und" and got[2] in dictionaries and got[3] in dictionaries


def test_the_most_frequent_languages_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    rows = [(i, "words of a text", f"l{i % 7}") for i in range(70)] + [(100 + i, "more words", "l5") for i in range(3)]
    assert sorted(learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))) == ["l0", "l1", "l5"]
