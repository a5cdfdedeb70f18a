"""Language identification by compression: the dictionary that presses a text smallest names it.

Each language has one zstandard dictionary of raw content, joined from labelled texts. A text is cut
into pieces of ``PIECE`` bytes, every piece of it is pressed with every dictionary, and the sizes of
all pieces are added up, so the length of a text does not wear the dictionaries down. The margin to
the second smallest sum is the score; a narrow one rejects the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8

SAMPLE = 256  #: labelled texts a language learns from at most; the choice is seeded
CONTENT = 96 << 10  #: bytes of a dictionary at most
SHARE = 2048  #: bytes that one text adds to a dictionary at most
LANGUAGES = 256  #: languages at most, those with most rows; with SAMPLE and SHARE it bounds what the driver gathers, by 128 MiB
PIECE = 1024
LEVEL = 3
MARGIN = 0.002  #: relative distance of the two smallest sums below which a text is rejected
NONE = "und"
SEED = 20240229
_NO_LETTERS = regex.compile(r"\P{L}+")


def letters(text: str) -> str:
    """The words of a text in lower case; case, digits and signs say little about its language."""
    return _NO_LETTERS.sub(" ", text.lower()).strip()


def learning_rows(docs: DataFrame) -> DataFrame:
    """Labelled rows that are not held out: crc32 of the id as text, modulo 4, is not 2."""
    return docs.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out() & F.col("doc_id").isNotNull())


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, sample: int = SAMPLE, content: int = CONTENT) -> dict[str, bytes]:
    """One dictionary per language from ``sample`` of its rows, chosen by a seeded hash.

    Only ids are ranked, and each task keeps its first ``sample`` before the exchange. The ``LANGUAGES`` with
    most rows are learnt, of equal ones the first by name.
    """
    counted = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(LANGUAGES)
    names = [r["lang"] for r in counted.collect()]  # LANGUAGES at most
    if not names:
        return {}
    labelled = labelled.where(F.col("lang").isin(names))
    first = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
    chosen = labelled.select("lang", "doc_id").withColumn("place", F.row_number().over(first)).where(F.col("place") <= sample)
    chosen = chosen.select("lang", "doc_id").distinct()
    piece = F.substring("text", 1, SHARE).alias("text")
    # LANGUAGES * sample ids at most
    rows = labelled.join(F.broadcast(chosen), ["lang", "doc_id"]).select("lang", "doc_id", piece).dropDuplicates(["lang", "doc_id"])
    found: dict[str, list[tuple[int, str]]] = {}
    for row in rows.collect():
        found.setdefault(row["lang"], []).append((row["doc_id"], row["text"]))
    return {lang: " ".join(letters(t) for _, t in sorted(texts)).encode()[:content] for lang, texts in sorted(found.items())}


class Classifier:
    """The pressing dictionaries of one task."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.names = sorted(dictionaries)
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.presses = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=params)
            self.presses.append(zstandard.ZstdCompressor(dict_data=content, compression_params=params))

    def language(self, raw: bytes | None) -> tuple[str, float]:
        """The language and the relative distance of the second smallest sum."""
        raw = letters((raw or b"").decode()).encode()
        if not self.presses or not raw:
            return NONE, 0.0
        pieces = [raw[at : at + PIECE] for at in range(0, len(raw), PIECE)]
        sums = np.array([sum(len(press.compress(piece)) for piece in pieces) for press in self.presses])
        at = int(sums.argmin())
        others = np.delete(sums, at)
        return self.names[at], float((others.min() - sums[at]) / others.min()) if len(others) else 1.0


def classify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row of ``docs`` (``doc_id, text``).

    ``score`` grows from 0 (all sums equal) to 1. A NULL text or one without a letter is ``und`` with
    score 0 and rejected, and so is every text when nothing was learnt. Of equal sums the first
    language by name is named. Only the text decides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries)
        for batch in batches:
            found = [classifier.language(raw) for raw in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([name for name, _ in found], pa.string()),
                    pa.array([min(1.0, 4 * gap) for _, gap in found], pa.float64()),
                    pa.array([name == NONE or gap < margin for name, gap in found], pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def recognised(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not rejected."""
    dictionaries = learn(learning_rows(docs.select("doc_id", "text", "lang")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries)
        for batch in batches:
            found = [classifier.language(raw) for raw in utf8(batch.column("text"))]
            yield batch.filter(pa.array([name != NONE and gap >= margin for name, gap in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the labelled rows of ``docs`` and names the language of all of them.

    Returns ``doc_id, held_out, lang_pred, score, rejected``. Rows without a label or id are not
    learnt from; a NULL ``doc_id`` counts as not held out. Repeated rows are classified one by one.
    An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    found = classify(docs, learn(learning_rows(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
