"""Quality rules: how well a text compresses, as a whole and piece by piece.

Repeated text compresses too well and noise too badly. What is usual depends on the length, so the
limits are given per band of lengths, and closer for texts with many symbols. They hold for the whole
text and for each of its pieces of ``CHUNK`` bytes, which show a bad part that the rest of a long text
would hide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

LEVEL = 3
CHUNK = 4096
#: Bytes up to which a band reaches, lowest usual ratio, and the highest with many symbols and with few.
#: That with few symbols is a twentieth above the 99th percentile of formal English, which compresses best
#: of clean prose: windows as long as the band reaches, a quarter of their length (64 bytes at least) apart,
#: over the 16 texts in ``licenses/``. For 128 to 16,384 bytes the percentiles are 1.43, 1.77, 2.09, 2.38,
#: 2.64, 2.86, 2.98 and 3.10. Whole texts of 16 to 35 KB reach 3.00; for the last two bands there are no
#: such windows, and the limits go on rising. Tables and scattered symbols have the ratios of formal prose,
#: so with many symbols the limit is closer.
BANDS = (
    (128, 0.60, 1.40, 1.50), (256, 0.90, 1.66, 1.86), (512, 1.10, 1.98, 2.20), (1024, 1.20, 2.10, 2.50), (2048, 1.35, 2.25, 2.78),
    (4096, 1.45, 2.36, 3.00), (8192, 1.50, 2.46, 3.13), (16384, 1.55, 2.56, 3.26), (65536, 1.60, 2.72, 3.40), (float("inf"), 1.60, 2.90, 3.60),
)
MANY_SYMBOLS = 20  #: symbols per hundred words above which they are many; of the formal texts all but MPL-2.0 (15) have less than one
BAD_SHARE = 0.25  #: of the bytes, in pieces outside their band, above which a text is rejected
FEWEST_WORDS = 50
MOST_REPEATED = (50, 100)  #: repeated words per hundred above which the base rules fail
SYMBOLS = "#*$%&|<>"
_SYMBOLS = [c.encode() for c in SYMBOLS]
SPACES = " \t\n\v\f\r"
_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, bad_share double"
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) < 1 << 20:
        windows = (ids[:-2] * len(known) + ids[1:-1]) * len(known) + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(known) + ids[2:]
    by = np.argsort(windows, kind="stable")
    same = windows[by[1:]] == windows[by[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[by[1:][same]] = twice[by[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def usual(raw: bytes, ratio: float) -> bool:
    many = 100 * sum(map(raw.count, _SYMBOLS)) > MANY_SYMBOLS * len(raw.split())
    for most, low, high, clean in BANDS:
        if len(raw) <= most:
            return low <= ratio <= (high if many else clean)
    return True


def _measure(raw: bytes, press: zstandard.ZstdCompressor) -> tuple[float, float]:
    """The ratio of a whole text, and the share of its bytes in pieces outside their band."""
    if not raw:
        return 1.0, 0.0
    ratio = len(raw) / len(press.compress(raw))
    if len(raw) <= CHUNK:
        return ratio, 0.0 if usual(raw, ratio) else 1.0
    bad = 0
    for at in range(0, len(raw), CHUNK):
        piece = raw[at : at + CHUNK]
        if not usual(piece, len(piece) / len(press.compress(piece))):
            bad += len(piece)
    return ratio, bad / len(raw)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
    names = [part.split()[0] for part in _SCHEMA.split(", ")]
    for batch in batches:
        out = []
        for raw in utf8(batch.column("text")):
            raw = raw or b""
            text = raw.decode()
            words = raw.split()  # bytes divide at the six ASCII spaces and no others
            n = len(words)
            again = repeated_words(words)
            failed = n < FEWEST_WORDS or MOST_REPEATED[1] * again > MOST_REPEATED[0] * n
            ratio, bad = _measure(raw, press)
            out.append(
                (
                    n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), repeated_lines(text), again,
                    failed, not failed and usual(raw, ratio) and bad <= BAD_SHARE, ratio, bad,
                )
            )
        columns = [pa.array(c) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 5 + [pa.array([], pa.bool_())] * 2 + [pa.array([], pa.float64())] * 2
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def judge_quality(docs: DataFrame) -> DataFrame:
    """Counts, base rules and the verdict of the compression bands for every row of ``docs``.

    A NULL text counts as an empty one: no words, so the base rules fail it. Repeated rows and rows
    with a NULL ``doc_id`` are judged one by one; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_judge, _SCHEMA)
