"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Documents with the same set of word n-grams are one row of the matrix. The columns of each row are
put into one global order, rare columns first, by a sketch of fixed size that counts all n-grams of
all documents. A pair at or above the similarity has to share one of the first columns of both rows,
so only those enter the product. They are dealt into blocks of columns; each block multiplies its
part, the counts of a pair are added up over the blocks, and pairs whose count is below the bound
that their sizes give are discarded. The rest is decided by whole sets.

A column with more than ``HEAVY`` rows is not multiplied out as pairs. Rows that such columns
connect form a cluster, and clusters are multiplied in dense square blocks of ``CHUNK`` rows, whose
results leave as a spanning forest and not as pairs.

All joins are merges, at every size: none sends a table that grows with the input through the driver
because its packed files are small.

Hashes have 64 bits. An overlap is wrong only where two different n-grams of the same pair collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage
from .common import components, portions, utf8
from .hashing import LOWER, Rolling, mix, word_bounds, word_shingles

WORDS = 5  #: words of an n-gram
ALIKE = (75, 100)  #: the similarity, as a fraction
SKETCH_BITS = 22  #: the sketch has 2**22 counters whatever the input; more sharpen the order
COUNTERS = 1 << 12  #: counters of the sketch that travel together
HEAVY = 64  #: rows of a column up to which its pairs are counted one by one
CHUNK = 512  #: rows on either side of a dense block
ENTRIES = 1 << 20  #: entries of a block of columns
FILTER_BITS = 1 << 24  #: bits of the filter that spares most texts the second reading
PORTION = 1 << 19  #: bytes hashed at once; some twenty arrays of eight bytes each stand beside them


def _sets(texts: list[bytes | None], size: int) -> Iterator[np.ndarray]:
    """The sorted n-gram hashes of every text."""
    rolling = Rolling()
    for start, end in portions([len(t or b"") for t in texts], PORTION):
        part = [t or b"" for t in texts[start:end]]
        data = LOWER[np.frombuffer(b"\n".join(part) + b"\n", np.uint8)]
        first, last = word_bounds(data)
        words = rolling.spans(data, first, last)
        edges = np.cumsum([0, *(len(t) + 1 for t in part)])
        at = np.searchsorted(first, edges)
        grams = word_shingles(words, size) if len(words) >= size else words[:0]
        for i in range(len(part)):
            n = at[i + 1] - at[i]
            found = grams[at[i] : at[i + 1] - size + 1] if n >= size else word_shingles(words[at[i] : at[i + 1]], size)
            found = np.sort(found)
            yield found[np.append(True, found[1:] != found[:-1])] if len(found) else found


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _least(n: np.ndarray | int) -> np.ndarray | int:
    """The smallest overlap a set of ``n`` has with any set that is alike."""
    return -(-ALIKE[0] * n // ALIKE[1])


def _alike(overlap, n, m):
    return ALIKE[1] * overlap >= ALIKE[0] * (n + m - overlap)


def _gathered(sets: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Several sets at a time."""
    held, size = [], 0
    for found in sets:
        held.append(found)
        size += len(found)
        if size >= PORTION:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def _packed(counts: np.ndarray) -> bytes:
    """Counters byte by byte, all lowest bytes first: most are small, so the others take no room."""
    return pa.compress(np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _counters(parts: dict[int, bytes], bits: int) -> np.ndarray:
    """All counters of a sketch."""
    width = min(COUNTERS, 1 << bits)
    out = np.zeros(1 << bits, np.uint32)
    for part, counts in parts.items():
        out[part * width : (part + 1) * width] = np.minimum(_unpacked(counts, width), 2**32 - 1)
    return out


class _Sketch:
    """Counters as the driver holds them, packed; whoever unpickles them gets the array."""

    def __init__(self, parts: dict[int, bytes], bits: int) -> None:
        self.parts, self.bits = parts, bits

    def __reduce__(self) -> tuple:
        return _counters, (self.parts, self.bits)


def _sketch(docs: DataFrame, size: int, bits: int) -> _Sketch:
    """How often the n-grams of each counter occur in all documents together."""
    width = min(COUNTERS, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint32)  # of one task
        for batch in batches:
            for found in _gathered(_sets(utf8(batch.column("text")), size)):
                np.add.at(total, _bucket(found, bits), np.uint32(1))
        parts = total.reshape(-1, width)
        at = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([_packed(parts[i]) for i in at], pa.binary())], ["part", "counts"])
        pa.default_memory_pool().release_unused()

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(width, np.uint64)
        for counts in group.column("counts").to_pylist():
            total += _unpacked(counts, width)
        return pa.table({"part": group.column("part")[:1], "counts": pa.array([_packed(total)], pa.binary())})

    kind = "part long, counts binary"
    counted = docs.select("text").mapInArrow(count, kind).groupBy("part").applyInArrow(add, kind).toArrow()  # at most 2**bits counters
    return _Sketch(dict(zip(counted.column("part").to_pylist(), counted.column("counts").to_pylist(), strict=True)), bits)


def _rows(docs: DataFrame, size: int, bits: int, order) -> DataFrame:
    """``doc_id, mark, n, digest, head``: hash of the text, set size, name of the set, its first columns in order."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = order.value
        for batch in batches:
            n, digest, head = [], [], []
            for found in _sets(utf8(batch.column("text")), size):
                n.append(len(found))
                digest.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                kept = np.lexsort((found, counts[_bucket(found, bits)]))[: len(found) - _least(len(found)) + 1]
                head.append(found[kept].tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(head, pa.binary())],
                ["doc_id", "mark", "n", "digest", "head"],
            )
        pa.default_memory_pool().release_unused()

    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return marked.mapInArrow(compute, "doc_id long, mark long, n long, digest binary, head binary")


def _deal(classes: DataFrame, blocks: int, bits: int, order) -> DataFrame:
    """``block, payload``: the entries of the first columns, packed by block of columns.

    Columns that the sketch shows to be frequent are dealt at random instead, as their entries need
    not meet: they are heavy without being counted.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = order.value
        frequent = 2 * int(counts.mean()) + 4096
        for batch in batches:
            heads = [np.frombuffer(h, np.uint64) for h in batch.column("head").to_pylist()]
            if not heads:
                continue
            lengths = [len(h) for h in heads]
            entry = np.empty(sum(lengths), dtype=ENTRY)
            entry["col"] = np.concatenate(heads)
            entry["row"] = np.repeat(batch.column("row").to_numpy(), lengths)
            entry["n"] = np.repeat(batch.column("n").to_numpy(), lengths)
            hot = counts[_bucket(entry["col"], bits)] > frequent
            block = np.where(
                hot,
                -1 - (mix(entry["row"].astype(np.uint64)) % np.uint64(blocks)).astype(np.int64),
                (mix(entry["col"]) % np.uint64(blocks)).astype(np.int64),
            )
            by = np.argsort(block, kind="stable")
            names, starts = np.unique(block[by], return_index=True)
            parts = np.split(entry[by], starts[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([p.tobytes() for p in parts], pa.binary())], ["block", "payload"]
            )

    return classes.select("row", "n", "head").mapInArrow(pack, "block long, payload binary")


ENTRY = np.dtype([("col", "<u8"), ("row", "<i8"), ("n", "<u4")])
_PARTIAL = "heavy boolean, a long, b long, n_a long, n_b long, shared long"


def _multiply(group: pa.Table) -> pa.Table:
    """The product of one block: ``a, b, shared`` for pairs, or ``a`` in the heavy column ``b``."""
    entry = np.frombuffer(b"".join(group.column("payload").to_pylist()), ENTRY)
    frequent = group.column("block")[0].as_py() < 0
    entry = entry[np.lexsort((entry["row"], entry["n"], entry["col"]))]
    start = np.flatnonzero(np.append(True, entry["col"][1:] != entry["col"][:-1]))
    count = np.diff(np.append(start, len(entry)))
    heavy = np.repeat((count > HEAVY) | frequent, count)
    columns = [entry["row"][heavy], entry["col"][heavy].astype(np.int64)]
    light = (count > 1) & (count <= HEAVY) & (not frequent)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in np.unique(count[light]):
        i, j = np.triu_indices(size, 1)
        first = start[light & (count == size)][:, None]
        left.append((first + i).ravel())
        right.append((first + j).ravel())
    i, j = np.concatenate(left), np.concatenate(right)
    close = ALIKE[1] * entry["n"][i].astype(np.int64) >= ALIKE[0] * entry["n"][j].astype(np.int64)
    i, j = i[close], j[close]
    pair = np.stack([entry["row"][i], entry["row"][j]], 1)
    by = np.lexsort((pair[:, 1], pair[:, 0]))
    pair, i, j = pair[by], i[by], j[by]
    new = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]).any(1))) if len(pair) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(pair)))
    k = len(columns[0])
    zeros = np.zeros(k, np.int64)
    return pa.table(
        {
            "heavy": np.append(np.ones(k, bool), np.zeros(len(new), bool)),
            "a": np.append(columns[0], pair[new, 0]),
            "b": np.append(columns[1], pair[new, 1]),
            "n_a": np.append(zeros, entry["n"][i[new]].astype(np.int64)),
            "n_b": np.append(zeros, entry["n"][j[new]].astype(np.int64)),
            "shared": np.append(zeros, times.astype(np.int64)),
        }
    )


def _filter(at: DataFrame) -> np.ndarray:
    """Bits that stand at the places ``at`` of all rows."""
    width = FILTER_BITS // 8 // 512

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            at = batch.column("at").to_numpy(zero_copy_only=False)
            np.bitwise_or.at(filled, at >> 3, (1 << (at & 7)).astype(np.uint8))
        parts = filled.reshape(-1, width)
        used = np.flatnonzero(parts.any(1))
        packed = [pa.compress(parts[i], codec="zstd", asbytes=True) for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(packed, pa.binary())], ["part", "bits"])

    def unite(group: pa.Table) -> pa.Table:
        bits = np.zeros(width, np.uint8)
        for packed in group.column("bits").to_pylist():
            bits |= np.frombuffer(pa.decompress(packed, width, codec="zstd", asbytes=True), np.uint8)
        return pa.table({"part": group.column("part")[:1], "bits": pa.array([bits.tobytes()], pa.binary())})

    kind = "part long, bits binary"
    united = at.mapInArrow(mark, kind).groupBy("part").applyInArrow(unite, kind).toArrow()  # the filter at most
    out = np.zeros((512, width), np.uint8)
    for part, bits in zip(united.column("part").to_pylist(), united.column("bits").to_pylist(), strict=True):
        out[part] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def _whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``row, set`` of the ``wanted`` classes (``row, doc_id, digest``), from their texts.

    A filter of fixed size, built by the tasks that read them, spares other texts; what passes it by
    chance falls out in the join.
    """
    at = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    known = docs.sparkSession.sparkContext.broadcast(_filter(wanted.select(at.alias("at"))))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = batch.column("at").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((known.value[where >> 3] >> (where & 7)) & 1 == 1))
            sets = [s.tobytes() for s in _sets(utf8(batch.column("text")), size)]
            names = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(names, pa.binary()), pa.array(sets, pa.binary())], ["doc_id", "digest", "grams"]
            )

    read = docs.where("doc_id IS NOT NULL").select("doc_id", "text", at.alias("at")).where("at IS NOT NULL")
    found = read.mapInArrow(compute, "doc_id long, digest binary, grams binary")
    # the same document may stand in the table more than once
    return found.join(wanted.hint("merge"), ["doc_id", "digest"]).select("row", "grams").dropDuplicates(["row"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for i, (x, y) in enumerate(zip(batch.column("grams_u").to_pylist(), batch.column("grams_v").to_pylist(), strict=True)):
            n, m = len(x) // 8, len(y) // 8
            both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]))
            if _alike(int((both[1:] == both[:-1]).sum()), n, m):
                kept.append(i)
        yield pa.RecordBatch.from_arrays([batch.column("u").take(kept), batch.column("v").take(kept)], ["u", "v"])


def _dense(group: pa.Table) -> pa.Table:
    """The links of one square block, as a spanning forest."""
    rows = group.column("row").to_numpy()
    side = group.column("side").to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in group.column("grams").to_pylist()]
    n = np.array([len(s) for s in sets])
    names, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), n)
    shared = np.flatnonzero(np.bincount(column, minlength=len(names)) > 1)
    place = np.full(len(names), -1)
    place[shared] = np.arange(len(shared))
    column = place[column]
    owner, column = owner[column >= 0], column[column >= 0]
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(two):
        two = one
    overlap = np.zeros((len(one), len(two)), np.float32)
    width = 4096
    edges = np.searchsorted(column, np.arange(0, len(shared) + width, width))
    for k in range(len(edges) - 1):
        part = np.zeros((len(sets), width), np.float32)
        part[owner[edges[k] : edges[k + 1]], column[edges[k] : edges[k + 1]] - k * width] = 1
        overlap += part[one] @ part[two].T
    linked = _alike(overlap.astype(np.int64), n[one][:, None], n[two][None, :])
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    u, v = [], []
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = root(one[i]), root(two[j])
        if a != b:
            parent[b] = a
            u.append(rows[one[i]])
            v.append(rows[two[j]])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _heavy_links(sets_of, members: DataFrame) -> DataFrame:
    """The links inside clusters of rows (``row, col``) that heavy columns connect."""
    centre = members.groupBy("col").agg(F.min("row").alias("centre"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    edges = members.join(centre.hint("merge"), "col").select(F.col("row").alias("u"), F.col("centre").alias("v"))
    cluster = stage(components(edges, "clusters"), "clusters")
    # chunks are cut by hash: no ordering of a whole cluster in one task
    sized = cluster.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("chunks"))
    placed = cluster.join(sized.hint("merge"), "root").select(
        F.col("node").alias("row"), "root", "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")
    )
    sided = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "row", "root",
        F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        (F.col("chunk") > F.col("other")).cast("int").alias("side"),
    )
    return sided.join(sets_of.hint("merge"), "row").groupBy("root", "i", "j").applyInArrow(_dense, "u long, v long")


def jaccard_components(docs: DataFrame, words: int = WORDS, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """``doc_id, n_shingles, component_id, root, mark`` for every row of ``docs`` (``doc_id, text``).

    Two rows link when their sets of lower-cased word n-grams have a Jaccard similarity of 0.75 or
    more; ``component_id`` is the smallest ``doc_id`` reached by links. A text with fewer words than
    an n-gram is one n-gram; an empty or NULL text has no set, links with nothing and keeps its own
    id. Repeated rows link with each other and all come back. A row with a NULL ``doc_id`` comes back
    and links with rows of the very same set only; without such a row its component is NULL. An empty
    table gives an empty result. Other columns are not read. ``root`` numbers the components of this
    run, NULL for an empty set, and ``mark`` is a hash of the text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(_sketch(docs, words, sketch_bits))
    rows = stage(_rows(docs, words, sketch_bits, order), "sets")
    grouped = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("head").alias("head")
    )
    classes = stage(grouped.withColumn("row", F.monotonically_increasing_id()), "classes")
    total = classes.agg(F.sum(F.length("head"))).first()[0] or 0
    blocks = max(1, total // 8 // ENTRIES + 1) * 4
    dealt = _deal(classes, blocks, sketch_bits, order)
    partial = stage(dealt.groupBy("block").applyInArrow(_multiply, _PARTIAL), "partial")
    order.destroy()

    least_a, least_b = (F.ceil(F.lit(ALIKE[0]) * F.col(c) / F.lit(ALIKE[1])) for c in ("n_a", "n_b"))
    needed = F.ceil(F.lit(ALIKE[0]) * (F.col("n_a") + F.col("n_b")) / F.lit(sum(ALIKE)))
    pairs = (
        partial.where("NOT heavy").groupBy("a", "b")
        .agg(F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"), F.sum("shared").alias("shared"))
        .where(F.col("shared") + F.greatest(least_a, least_b) - 1 >= needed)
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )
    pairs = stage(pairs, "pairs")
    members = partial.where("heavy").select(F.col("a").alias("row"), F.col("b").alias("col"))
    taking_part = pairs.select(F.col("u").alias("row")).unionByName(pairs.select(F.col("v").alias("row")))
    taking_part = taking_part.unionByName(members.select("row")).distinct()
    wanted = classes.where("doc_id IS NOT NULL").select("row", "doc_id", "digest").join(taking_part.hint("merge"), "row")
    sets = stage(_whole_sets(docs, stage(wanted, "wanted"), words), "whole")
    whole = pairs.join(sets.select(F.col("row").alias("u"), F.col("grams").alias("grams_u")).hint("merge"), "u")
    whole = whole.join(sets.select(F.col("row").alias("v"), F.col("grams").alias("grams_v")).hint("merge"), "v")
    links = whole.mapInArrow(_decide, "u long, v long").unionByName(_heavy_links(sets, members))
    reached = components(links)
    named = classes.select("row", "digest", "doc_id").join(reached.hint("merge"), classes["row"] == reached["node"], "left")
    named = named.select("digest", "doc_id", F.coalesce("root", "row").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = named.join(least.hint("merge"), "root").select("digest", "component_id", "root")
    return rows.drop("head").join(labels.hint("merge"), "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "root", "mark"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every component, all columns kept.

    It is the row with the smallest ``doc_id``, NULL last, and of rows with that id the one with the
    smallest hash of the text; of rows alike in both any one stays. Empty texts link with nothing, so
    all of them stay but repeated rows.
    """
    linked = jaccard_components(docs)
    known = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    first = linked.where("root IS NOT NULL").groupBy("root").agg(F.min(known).alias("kept")).select("kept.doc_id", "kept.mark")
    first = first.unionByName(linked.where("root IS NULL").select("doc_id", "mark")).select(F.struct("doc_id", "mark").alias("key"))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("mark"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))  # whole rows, so that no names meet
    return rows.join(first.hint("merge"), "key", "left_semi").dropDuplicates(["key"]).select("row.*")
