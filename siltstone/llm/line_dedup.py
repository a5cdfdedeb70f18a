"""Lines that many documents hold stay in one of them; what stays is a bitmap per document.

Every line long enough becomes a row of a 128-bit hash, its document and its position. The rows are
cut into ranges of (hash, document, position) and sorted, so that one task streams the documents of a
hash from the largest id down and knows at the second and third whether a line goes. A range may begin
or end inside a hash, however frequent that is: only the rows of two documents there stay open, and they
are decided by a summary of at most six rows per range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage
from .common import utf8

LEAST = 20  #: code points of a key
DOCUMENTS = 3  #: that hold a key before it goes
SPACE = b" \t\n\x0b\x0c\r"
_FOUND = "kind string, h1 long, h2 long, doc_id long, mark long, pos int"


def key_of(line: bytes) -> bytes:
    """``line`` without white space at its ends and with small A-Z."""
    return line.strip(SPACE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or sum(b & 0xC0 != 0x80 for b in key) >= least)


def _identified(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, text``: the mark tells texts of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _line_rows(docs: DataFrame, least: int) -> DataFrame:
    """``h1, h2, doc_id, mark, pos`` of every line that may go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, positions, sizes = [], [], []
            for text in utf8(batch.column("text")):
                before = len(digests)
                for at, line in enumerate(text.split(b"\n")):
                    key = key_of(line)
                    if _long_enough(key, least):
                        digests.append(xxhash.xxh3_128_digest(key))
                        positions.append(at)
                sizes.append(len(digests) - before)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])),
                    batch.column("doc_id").take(rows), batch.column("mark").take(rows), pa.array(positions, pa.int32()),
                ],
                ["h1", "h2", "doc_id", "mark", "pos"],
            )

    return docs.where("doc_id is not null").mapInArrow(run, "h1 long, h2 long, doc_id long, mark long, pos int")


class _Stream:
    """One sorted range: documents of a hash come from the largest id down.

    ``nth`` counts the documents of the hash of a row, from 0, as far as this range shows them. In the
    first hash of a range earlier ones may be missing, in its last one later ones. Rows are
    ``h1, h2, doc_id, mark, pos``.
    """

    def __init__(self, documents: int) -> None:
        self.documents = documents
        self.before: np.ndarray | None = None  # hash and document of the last row
        self.nth = -1
        self.hash = (0, 0)  # the present one
        self.border = True  # whether the present hash began the range
        self.seen: list[int] = []  # the first documents of the present hash
        self.held: list[np.ndarray] = []  # its rows whose fate other documents decide: those of two documents
        self.dropped: list[np.ndarray] = []
        self.open: list[np.ndarray] = []
        self.summary: list[tuple[int, int, int]] = []

    def push(self, rows: np.ndarray) -> None:
        before = rows[:1, :3] if self.before is None else self.before
        change = rows[:, :3] != np.vstack([before, rows[:-1, :3]])
        new_hash = change[:, 0] | change[:, 1]
        new_doc = new_hash | change[:, 2]
        new_doc[0] |= self.before is None
        count = np.cumsum(new_doc)
        starts = np.flatnonzero(new_hash)
        nth = count - np.concatenate([[-self.nth], count[starts]])[np.cumsum(new_hash)]
        first = starts[0] if len(starts) else len(rows)
        self._extend(rows[:first], nth[:first], new_doc[:first])
        if len(starts):
            self._close(self.border)
            self.border = False
            last = starts[-1]
            # hashes that begin and end in here
            whole, number = rows[first:last], nth[first:last]
            ends = np.append(starts[1:], last)[: len(starts) - 1] - 1 - first
            documents = np.repeat(number[ends] + 1, np.diff(starts)) if len(starts) > 1 else number
            gone = (number > 0) & (documents >= self.documents)
            if gone.any():
                self.dropped.append(whole[gone])
            self._extend(rows[last:], nth[last:], new_doc[last:])
        self.before = rows[-1:, :3]
        self.nth = int(nth[-1])

    def _extend(self, rows: np.ndarray, nth: np.ndarray, new_doc: np.ndarray) -> None:
        """More rows of the present hash."""
        if not len(rows):
            return
        self.hash = (int(rows[0, 0]), int(rows[0, 1]))
        self.seen += rows[new_doc, 2][: self.documents - len(self.seen)].tolist()
        late = nth >= self.documents - 1
        if late.any():
            self.dropped.append(rows[late])
        wait = ~late & (self.border | (nth > 0))
        if wait.any():
            self.held.append(rows[wait])

    def _close(self, border: bool) -> None:
        """The present hash is over, in this range at least."""
        if border:
            self.summary += [(*self.hash, doc) for doc in self.seen]
            self.open += self.held
        elif len(self.seen) >= self.documents:
            self.dropped += self.held
        self.held, self.seen = [], []

    def finish(self) -> None:
        self._close(border=True)


def _streamed(rows: DataFrame, documents: int) -> DataFrame:
    """``kind, h1, h2, doc_id, mark, pos``: lines to drop, open lines, and summaries of border hashes."""
    names = ["h1", "h2", "doc_id", "mark", "pos"]

    def batch_of(kind: str, rows: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(4)]
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(rows)), *columns, pa.array(rows[:, 4].astype(np.int32))], ["kind", *names]
        )

    def told(stream: _Stream) -> Iterator[pa.RecordBatch]:
        for kind, parts in (("drop", stream.dropped), ("open", stream.open)):
            if parts:
                yield batch_of(kind, np.concatenate(parts))
        if stream.summary:
            yield batch_of("seen", np.array([(*s, 0, 0) for s in stream.summary], np.int64))
        stream.dropped, stream.open, stream.summary = [], [], []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(documents)
        for batch in batches:
            if batch.num_rows:
                stream.push(np.column_stack([batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in names]))
                yield from told(stream)
        if stream.before is not None:
            stream.finish()
            yield from told(stream)

    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc(), F.col("mark"), F.col("pos")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _FOUND)


def packed(gone: list[int]) -> bytes:
    """The keep bitmap of a text that loses the lines at ``gone``; lines beyond its end stay."""
    keep = np.ones(max(gone) // 8 * 8 + 8, bool)
    keep[gone] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpacked(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Which of ``n_lines`` lines stay."""
    keep = np.ones(n_lines, bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
    keep[: len(bits)] = bits
    return keep


def keep_bitmaps(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """``doc_id, mark, keep`` for every document of ``docs`` (``doc_id, text``) that loses a line.

    ``mark`` is ``xxhash64`` of the text, ``keep`` a zlib-compressed bitmap of its lines, read by
    ``unpacked``. Lines of a text are divided by line feeds; one whose key (``key_of``) has ``least``
    code points and occurs in ``documents`` documents stays only in the largest ``doc_id`` holding it.
    Rows of one ``doc_id`` are one document. Rows without ``doc_id`` keep all lines and do not count.
    """
    lines = stage(_line_rows(_identified(docs), least), "lines")
    found = stage(_streamed(lines, documents), "found")
    seen = found.where("kind = 'seen'").groupBy("h1", "h2")
    # at most six rows of each range come in here
    borders = seen.agg(F.max("doc_id").alias("top"), F.countDistinct("doc_id").alias("n")).where(F.col("n") >= documents)
    opened = found.where("kind = 'open'").join(borders, ["h1", "h2"]).where("doc_id <> top")
    gone = found.where("kind = 'drop'").select("doc_id", "mark", "pos").unionByName(opened.select("doc_id", "mark", "pos"))
    # no more positions than the text of the document has lines
    positions = gone.groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bitmaps = [packed(at) for at in batch.column("gone").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(bitmaps, pa.binary())], ["doc_id", "mark", "keep"])

    return stage(positions.mapInArrow(run, "doc_id long, mark long, keep binary"), "bitmaps")


def kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` of each row of ``docs``; ``kept`` are its lines joined again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, dropped, kept = [], [], []
            for text, bitmap in zip(utf8(batch.column("text")), batch.column("keep").to_pylist(), strict=True):
                lines = text.split(b"\n")
                n.append(len(lines))
                if bitmap is None:
                    dropped.append(0)
                    kept.append(text)
                    continue
                keep = unpacked(bitmap, len(lines))
                dropped.append(len(lines) - int(keep.sum()))
                kept.append(b"\n".join(lines[i] for i in np.flatnonzero(keep)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.large_binary()).cast(pa.binary())],
                ["doc_id", "n_lines", "n_dropped", "kept"],
            )

    # texts meet the bitmaps in an exchange at every size: a copy of all bitmaps in each executor grows with the table
    joined = _identified(docs).join(bitmaps.hint("merge"), ["doc_id", "mark"], "left").select("doc_id", "text", "keep")
    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept binary")


def dedup_lines(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_lines, n_dropped, kept_sha256`` (see ``keep_bitmaps``).

    A NULL or empty text is one empty line. A text that loses all its lines becomes the empty text.
    Repeated rows get equal results, other columns are not read, an empty table gives an empty result.
    """
    kept = kept_lines(docs, keep_bitmaps(docs, least, documents))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def oracle() -> str:
    """The same in SQL."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
    WITH texts AS (
      SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
    ), lines AS (
      SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM texts
    ), keyed AS (
      SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{capitals}', '{capitals.lower()}') AS k FROM lines
    ), frequent AS (
      SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= {LEAST} GROUP BY k HAVING count(DISTINCT doc_id) >= {DOCUMENTS}
    ), judged AS (
      SELECT keyed.*, coalesce(doc_id <> top, false) AS gone FROM keyed LEFT JOIN frequent USING (k)
    )
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY r
    """
