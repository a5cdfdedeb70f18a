"""Small tables that hold what tables may hold: nulls, empty and long texts, ties, repeated rows."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double"
WORDS = {
    "en": "the and ing tion of that ther with was hand land water house over under little morning".split(),
    "fr": "le la des que une dans pour avec eau matin petit maison sur rouge être voilà cœur".split(),
}


def prose(seed: int, n: int, lang: str = "en") -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(WORDS[lang]) for _ in range(n))


def rows() -> list[tuple]:
    """``doc_id, text, lang, source, n_chars`` and two columns whose names operators use themselves."""
    texts = [(i, prose(i, 60 + i, "en" if i % 3 else "fr"), "en" if i % 3 else "fr", f"src{i % 4}") for i in range(60)]
    base = prose(1000, 200)
    words = base.split()
    texts += [(100, base, "en", "src0"), (101, base, "en", "src1"), (102, " ".join([*words[:-1], "changed"]), "en", "src0")]
    texts += [(103, base.upper(), None, None), (104, None, "en", "src1"), (105, "", "fr", None), (106, " \t\n ", "en", "src2")]
    texts += [(107, "one two", "en", "src2"), (108, "ONE  two", "en", "src2"), (109, "1234 %% 5678", None, "src3")]
    texts += [(110, prose(7, 20000), "en", "src0"), (None, prose(8, 80), "en", "src1"), (None, None, None, None)]
    texts += [texts[0], texts[0], (200, "日本語 テキスト é à́ ß", "en", "src3")]
    return [(*t, len(t[1]) if t[1] is not None else None, "x", 0.5) for t in texts]


@pytest.fixture(scope="session")
def table_rows():
    return rows()


@pytest.fixture()
def docs(spark, table_rows):
    return spark.createDataFrame(table_rows, SCHEMA).repartition(3)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)
