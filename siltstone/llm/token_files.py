"""Token ids in files of canonical, length-limited Huffman codes.

Ids are made once, in ascending ``doc_id`` order, and staged. Their counts over the whole corpus give
the lengths of the codes; the lengths alone are stored. A file holds rows of independent blocks: the
documents of the block, the bits, and the bit offset of every ``STEP``-th id. From those offsets a
block is decoded by table, side by side, one array operation per step.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.workspace import fresh_folder
from .common import portions

END = 1  #: the id that ends a document
MOST_BITS = 20  #: of a code
STEP = 512  #: ids between two bit offsets
BLOCK = 1 << 18  #: ids after which a block ends; a document is never divided
PORTION = 1 << 23
KNOWN = 400_000  #: words whose ids a worker remembers; some 200 bytes each
_ENDING = r"([a-z\x{df}-\x{f6}\x{f8}-\x{ff}])([.,])"
#: Fixed value: how the tokenizer that divides words cuts them.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "[a-z\xdf-\xf6\xf8-\xff]+"
_SIGNS = r"[!-&(-/:-@\[-`{-~]+"  #: of ASCII but the apostrophe, which may begin an ending
_PLAIN = re.compile(f"(?:{_LETTERS[:-1]}|[0-9]|{_SIGNS[:-1]})+")
_RUNS = re.compile(f"{_LETTERS}|[0-9]|{_SIGNS}")
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: How byte-level models write a byte as a character: visible ones as they are, others from 256 on.
_AS_CHARACTER = {b: chr(b) for b in _VISIBLE} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_VISIBLE)))}
_AS_CHARACTERS = {c: "".join(_AS_CHARACTER[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


def divides_words(path: str) -> bool:
    """Whether the tokenizer of a file lower-cases, drops white space and ends words, as ``Encoder`` relies on."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    norms = (told.get("normalizer") or {}).get("normalizers", [])
    pieces = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [n["type"] for n in norms] == ["NFC", "Replace", "Lowercase"]
        and norms[1]["pattern"] == {"Regex": r"\s+"} and norms[1]["content"] == " "
        and [p["type"] for p in pieces] == ["Split", "ByteLevel"]
        and pieces[0]["behavior"] == "Removed" and pieces[0]["invert"]
        and pieces[0]["pattern"] == {"Regex": _PIECES}
        and not pieces[1]["add_prefix_space"] and not pieces[1]["use_regex"]
        and bool(told["model"].get("end_of_word_suffix"))
        and all(t["content"].startswith("<|") for t in told.get("added_tokens", []))
    )


class Encoder:
    """Ids of texts, equal to those of the tokenizer in the file at ``path``.

    Where that lower-cases, divides at white space and ends words (``divides_words``), no token reaches over
    ASCII white space or from a letter to a full stop or comma: every distinct word is encoded once and
    remembered. Words of plain small letters, digits and signs then go to the model of the tokenizer, all others through
    the whole tokenizer, and so do texts with a special token. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.by_word = divides_words(path)
        self.kind = np.uint32 if self.tokenizer.get_vocab_size() > 1 << 16 else np.uint16
        self.tokenize = self.tokenizer.model.tokenize
        self.code = np.dtype(self.kind).char
        # kept on the module, so that it outlives a task as long as its worker does
        self.known: dict[str, bytes] = vars(tokenizers).setdefault("_known_words", {}).setdefault(path, {})

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> bytes:
        return array(self.code, [t.id for t in self.tokenize(piece)]).tobytes()

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self._piece(word)
        if not _PLAIN.fullmatch(word):
            return array(self.code, self.whole(word)).tobytes()
        if word.isalpha():
            return self._piece(word.translate(_AS_CHARACTERS))
        # the tokenizer cuts such words into these runs, each of which goes to its model
        return b"".join([self.known.get(run) or self._piece(run.translate(_AS_CHARACTERS)) for run in _RUNS.findall(word)])

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, in bytes. Once ``KNOWN`` words are remembered, the older half is forgotten."""
        out = list(map(self.known.get, words))
        new = [i for i, ids in enumerate(out) if ids is None]
        for i in new:
            out[i] = self.word(words[i])
        for a in range(0, len(new), KNOWN // 2):
            if len(self.known) + KNOWN // 2 > KNOWN:
                for word in list(islice(self.known, KNOWN // 2)):
                    del self.known[word]
            self.known.update((words[i], out[i]) for i in new[a : a + KNOWN // 2])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each with ``END``, and how many each has."""
        if not self.by_word:
            ids = [np.array([*e.ids, END], self.kind) for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, self.kind), *ids]), np.array([len(i) for i in ids], np.int64)
        special = pc.match_substring(texts, "<|")
        lowered = pc.replace_substring_regex(pc.ascii_lower(pc.if_else(special, "", texts)), _ENDING, r"\1 \2")
        split = pc.ascii_split_whitespace(lowered)
        found = split.flatten().dictionary_encode()
        ids = self.words(found.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // np.dtype(self.kind).itemsize
        pool = pa.array(np.frombuffer(b"".join(ids), self.kind))
        known = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(size))), pool)
        taken = known.take(found.indices)
        flat = taken.flatten().to_numpy()
        word_ends = taken.offsets.to_numpy() - taken.offsets[0].as_py()
        bounds = word_ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        at = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        if len(at):  # texts with a special token were left out, and come in whole
            own = [np.array(self.whole(texts[int(i)].as_py()), self.kind) for i in at]
            flat = np.insert(flat, np.repeat(bounds[at], [len(o) for o in own]), np.concatenate(own))
            more = np.zeros(len(bounds), np.int64)
            more[at + 1] = [len(o) for o in own]
            bounds = bounds + np.cumsum(more)
        return np.insert(flat, bounds[1:], END), np.diff(bounds) + 1


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """The lengths of the best codes of at most ``most`` bits, by merging packages; 0 for no count."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    level, leaves = weights, [np.ones(len(weights), bool)]
    for _ in range(most - 1):
        even = len(level) // 2 * 2
        both = np.concatenate([weights, level[0:even:2] + level[1:even:2]])
        by = np.argsort(both, kind="stable")
        level = both[by]
        leaves.append(by < len(weights))
    taken = 2 * len(weights) - 2
    for leaf in reversed(leaves):
        single = int(leaf[:taken].sum())
        out[used[:single]] += 1
        taken = 2 * (taken - single)
    return out


class Codes:
    """Canonical codes: by length and then by id, so lengths are all there is to know."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        self.bits = int(self.lengths.max(initial=1))
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[self.lengths[order] > 0]
        span = np.int64(1) << (self.bits - self.lengths[order])
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = (np.cumsum(span) - span) >> (self.bits - self.lengths[order])
        self._id = np.repeat(order, span).astype(np.uint32)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of ``ids``, and the offset of every ``STEP``-th."""
        length = self.lengths[ids]
        end = np.cumsum(length)
        start = end - length
        word, shift = start >> 5, start & 31
        wide = self.codes[ids].astype(np.uint64) << (64 - shift - length).astype(np.uint64)
        out = np.zeros((int(end[-1]) >> 5) + 2 if len(ids) else 2, np.uint64)
        new = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(ids) else np.zeros(0, np.int64)
        if len(ids):
            out[word[new]] += np.add.reduceat(wide >> np.uint64(32), new)
            out[word[new] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), new)
        return out.astype(">u4").tobytes(), start[::STEP]

    def unpack(self, bits: bytes, offsets: np.ndarray, total: int) -> np.ndarray:
        """The ``total`` ids that were packed."""
        words = np.frombuffer(bits, ">u4").astype(np.uint64)
        wide = (words[:-1] << np.uint64(32)) | words[1:]
        out = np.empty(total, np.uint32)
        at = offsets.astype(np.int64)
        drop = np.uint64(64 - self.bits)
        size = np.minimum(STEP, total - np.arange(len(at)) * STEP)
        for step in range(int(size.max(initial=0))):
            n = len(at) if step < size[-1] else len(at) - 1
            where = at[:n]
            ids = self._id[(wide[where >> 5] << (where & 31).astype(np.uint64)) >> drop]
            out[step : (n - 1) * STEP + step + 1 : STEP] = ids
            at[:n] += self.lengths[ids]
        return out


def _packed(flat: np.ndarray, n: np.ndarray) -> pa.Array:
    """``flat`` in rows of ``n`` numbers each, as bytes."""
    ends = np.append(0, np.cumsum(n)) * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def _flat(column: pa.Array, n: int) -> np.ndarray:
    """All numbers of the rows of ``column``, of which there are ``n``."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(column) and n else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), np.uint16 if len(raw) == 2 * n else np.uint32)


def _tokenize(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``part, before, doc_id, n, ids``: the parts are in ascending order, and the rows in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        before = 0
        for batch in batches:
            texts = pc.fill_null(batch.column("text").cast(pa.string()), "")
            sizes = pc.binary_length(texts).to_pylist()
            for a, b in portions(sizes, PORTION):
                flat, n = encoder.encode(pa.concat_arrays([texts.slice(a, b - a)]))
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part").slice(a, b - a), pa.array(starts), batch.column("doc_id").slice(a, b - a), pa.array(n), _packed(flat, n)],
                    ["part", "before", "doc_id", "n", "ids"],
                )
        pa.default_memory_pool().release_unused()

    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    return ordered.mapInArrow(run, "part int, before long, doc_id long, n long, ids binary")


def _counts(staged: DataFrame) -> np.ndarray:
    """How often each id occurs: one row per id and task, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(_flat(batch.column("ids"), pc.sum(batch.column("n")).as_py() or 0))
            if len(found) > len(total):
                total = np.append(total, np.zeros(len(found) - len(total), np.int64))
            total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    rows = staged.select("n", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy()  # at most one row per id of the vocabulary
    out = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    out[ids] = n
    return out


_BLOCK = "part int, before long, doc_ids array<bigint>, sizes array<bigint>, offsets array<bigint>, bits binary"


def _blocks(staged: DataFrame, lengths: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(lengths)
        for batch in batches:
            sizes = batch.column("n").to_pylist()
            flat, ends = _flat(batch.column("ids"), sum(sizes)), np.append(0, np.cumsum(sizes))
            part, before = batch.column("part").to_pylist(), batch.column("before").to_pylist()
            first = 0
            while first < len(sizes):
                last, total = first, 0
                # a block goes on while the rows follow one another in one part
                while last < len(sizes) and total < BLOCK and part[last] == part[first] and before[last] == before[first] + total:
                    total += sizes[last]
                    last += 1
                bits, offsets = codes.pack(flat[ends[first] : ends[last]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part[first]], pa.int32()), pa.array([before[first]], pa.int64()),
                        pa.array([batch.column("doc_id").slice(first, last - first).to_pylist()], pa.list_(pa.int64())),
                        pa.array([sizes[first:last]], pa.list_(pa.int64())), pa.array([offsets], pa.list_(pa.int64())),
                        pa.array([bits], pa.binary()),
                    ],
                    ["part", "before", "doc_ids", "sizes", "offsets", "bits"],
                )
                first = last

    return staged.mapInArrow(run, _BLOCK)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str) -> None:
    """Encodes the texts of ``docs`` (``doc_id, text``) and writes them under ``folder``.

    ``blocks`` holds the rows of blocks, ``lengths`` one row with the code lengths by id, and
    ``parts`` the ids that stand before each part. A NULL text is an empty one and has only the end.
    A NULL ``doc_id`` stands before all others; repeated ids stand side by side, ordered by text.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = fresh_folder(spark, "ids")
    _tokenize(docs, vocabulary).write.option("compression", "zstd").parquet(held)
    staged = spark.read.parquet(held)
    lengths = code_lengths(_counts(staged))
    _blocks(staged, lengths).write.option("compression", "none").parquet(f"{folder}/blocks")
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/lengths")
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged.groupBy("part").agg(F.sum("n").alias("n"))  # one row per task that wrote ids
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    parts.write.parquet(f"{folder}/parts")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the files; ``ids`` as 32-bit numbers."""
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{folder}/lengths").first()["lengths"]), np.uint8)
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                sizes = np.array(batch.column("sizes")[row].as_py(), np.int64)
                offsets = batch.column("offsets")[row].values.to_numpy()
                ids = codes.unpack(batch.column("bits")[row].as_py(), offsets, int(sizes.sum()))
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), batch.column("part")[row].as_py(), np.int32)),
                        pa.array(batch.column("before")[row].as_py() + ends - sizes),
                        batch.column("doc_ids")[row].values,
                        _packed(ids.astype("<u4"), sizes),
                    ],
                    ["part", "before", "doc_id", "ids"],
                )

    rows = blocks.mapInArrow(run, "part int, before long, doc_id long, ids binary")
    parts = spark.read.parquet(f"{folder}/parts")
    return rows.join(parts, "part").select("doc_id", (F.col("part_start") + F.col("before")).alias("start"), "ids")


def digested(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what was read."""
    return rows.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def token_files(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Writes ``docs`` to token files in the shared folder and reads them back, one row per document.

    Returns ``doc_id, start, n_tokens, ids_crc32``. An empty table gives an empty result.
    """
    folder = fresh_folder(docs.sparkSession, "tokens")
    write_token_files(docs, folder, vocabulary)
    return digested(read_token_files(docs.sparkSession, folder))
