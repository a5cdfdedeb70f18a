"""Benchmark decontamination: regions of a text that are a few edits away from a benchmark passage.

Items are cut into tiles of about ``TILE`` characters. A tile with ``w`` characters and ``e`` edits
keeps at least ``w - q + 1 - q * e`` of its q-grams, all of them within ``e`` diagonals. So shared
q-grams are counted in overlapping bands of diagonals, bands that reach the bound are regions, and a
banded alignment decides about each region. An item is in a text when tiles that hold at least half
of it are.

Long tiles allow for edits all over an item, but trimmed ends or replaced words break them. So items
are cut a second time, into tiles of ``PIECE`` characters that may have one edit: the first or the last
q-gram of such a tile is unchanged, and each of these found is a region. An item is also in a text
when such tiles that lie together hold at least half of it, and ``LEAST`` bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..sources.workspace import stage
from .common import portions, unused, utf8
from .hashing import Rolling

GRAM = 10  #: bytes of a q-gram
TILE = 128
EDITS = 16  #: bytes of a tile for each edit it may have
BAND = 16  #: diagonals from one band to the next
PIECE = 16  #: bytes of a short tile, at least
PIECE_GRAM = 8  #: half a short tile: one edit cannot change both of its ends
LEAST = 48  #: bytes of an item that short tiles have to find; shorter items are looked for in long tiles only
COVERED = 0.5  #: share of an item that has to be found
SLICE = 8 << 20  #: characters of items that are looked for in one pass over the texts
PORTION = 1 << 19
WINDOW = 1 << 17  #: bytes looked at together for tiles that lie together
ENTRIES = 1 << 20  #: q-grams in common with items that are held at once
_SIGNS = re.compile(r"[\W_]+")


def plain(text: str) -> bytes:
    """Words in lower case with single spaces between them."""
    return _SIGNS.sub(" ", text.lower()).strip().encode()


@dataclass(frozen=True)
class Index:
    """The q-grams of a slice of items, sorted, with the tiles and places they come from."""

    item: np.ndarray  #: of each tile
    tiles: tuple[bytes, ...]
    edits: np.ndarray
    bound: np.ndarray  #: shared q-grams that a region needs
    grams: np.ndarray
    tile: np.ndarray  #: of each q-gram
    place: np.ndarray
    seen: np.ndarray  #: bits of the q-grams, to pass over most of a text
    short: tuple[tuple[int, bytes], ...]  #: items shorter than a q-gram, looked for as they are
    gram: int = GRAM
    band: int = BAND
    offset: np.ndarray | None = None  #: of each tile in its item, if tiles have to lie together


def _hashed(tiles: list[bytes], first: np.ndarray, tile: np.ndarray, place: np.ndarray, gram: int) -> tuple[np.ndarray, ...]:
    """The sorted q-grams at ``place`` of each ``tile``, both in their order, and the bits of the q-grams."""
    data = np.frombuffer(b"".join(tiles), np.uint8)
    start = first[tile] + place
    grams = Rolling().spans(data, start, start + gram) if len(start) else np.zeros(0, np.uint64)
    by = np.argsort(grams, kind="stable")
    bits = 1 << max(16, int(8 * max(1, len(grams))).bit_length())
    seen = np.zeros(bits, bool)
    seen[(grams & np.uint64(bits - 1)).astype(np.int64)] = True
    return grams[by], tile[by], place[by], seen


def build_index(items: list[bytes]) -> Index:
    item, tiles, short = [], [], []
    for number, text in enumerate(items):
        if len(text) < GRAM:
            if text:
                short.append((number, b" " + text + b" "))
            continue
        count = max(1, round(len(text) / TILE))
        cuts = [len(text) * k // count for k in range(count + 1)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            item.append(number)
            tiles.append(text[a:b])
    size = np.array([len(t) for t in tiles], np.int64)
    # no more edits than leave a q-gram in common
    edits = np.minimum(size // EDITS, np.maximum(0, (size - GRAM) // GRAM))
    first = np.cumsum(size) - size
    n = np.maximum(size - GRAM + 1, 0)
    tile = np.repeat(np.arange(len(tiles)), n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    hashed = _hashed(tiles, first, tile, place, GRAM)
    return Index(np.array(item, np.int64), tuple(tiles), edits, np.maximum(1, size - GRAM + 1 - GRAM * edits), *hashed, tuple(short))


def build_pieces(items: list[bytes]) -> Index:
    """The ends of the short tiles of all items of ``LEAST`` bytes or more."""
    item, tiles, offset = [], [], []
    for number, text in enumerate(items):
        if len(text) < LEAST:
            continue
        count = len(text) // PIECE
        cuts = [len(text) * k // count for k in range(count + 1)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            item.append(number)
            tiles.append(text[a:b])
            offset.append(a)
    size = np.array([len(t) for t in tiles], np.int64)
    tile = np.repeat(np.arange(len(tiles)), 2)
    place = np.stack([np.zeros(len(tiles), np.int64), size - PIECE_GRAM], axis=1).ravel()
    hashed = _hashed(tiles, np.cumsum(size) - size, tile, place, PIECE_GRAM)
    one = np.ones(len(tiles), np.int64)
    return Index(np.array(item, np.int64), tuple(tiles), one, one, *hashed, (), PIECE_GRAM, 1, np.array(offset, np.int64))


def _aligned(index: Index, data: np.ndarray, tile: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which regions hold their tile within its edits.

    Region ``r`` is the band of diagonals from ``first[r]`` on, inside ``data[low[r]:high[r]]``.
    """
    size = np.array([len(index.tiles[t]) for t in tile])
    edits = index.edits[tile]
    width = index.band + 3 * int(edits.max()) + 1
    pattern = np.zeros((len(tile), int(size.max())), np.uint8)
    for row, t in enumerate(tile):
        pattern[row, : size[row]] = np.frombuffer(index.tiles[t], np.uint8)
    column = np.arange(width)
    cost = np.zeros((len(tile), width), np.int32)
    best = np.full(len(tile), 1 << 20)
    begin = (first - edits)[:, None] + column
    for i in range(pattern.shape[1]):
        at = begin + i
        there = (at >= low[:, None]) & (at < high[:, None])
        differs = np.where(there, data[np.where(there, at, 0)] != pattern[:, i : i + 1], True)
        step = cost + differs
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - column, axis=1) + column
        done = size == i + 1
        best[done] = cost[done].min(1)
    return best <= edits


def _likely(index: Index, sizes: np.ndarray, whole: np.ndarray, text: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Which regions are of an item that would be found if all regions of the text held their tiles."""
    if not len(tile):
        return np.zeros(0, bool)
    pairs = np.unique(text * len(sizes) + tile)
    of = pairs // len(sizes) * len(whole) + index.item[pairs % len(sizes)]
    names, group = np.unique(of, return_inverse=True)
    good = names[np.bincount(group, sizes[pairs % len(sizes)]) >= COVERED * whole[names % len(whole)]]
    return np.isin(text * len(whole) + index.item[tile], good)


def _together(index: Index, whole: np.ndarray, text: np.ndarray, tile: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Each text with its tiles, once each; where tiles have to lie together, those of the fullest stretch."""
    if index.offset is None or not len(tile):
        return np.unique(np.stack([text, tile]), axis=1)
    item, shift = index.item[tile], band * index.band - index.offset[tile]
    by = np.lexsort([shift, item, text])
    text, tile, item, shift = text[by], tile[by], item[by], shift[by]
    first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1])))
    kept: list[tuple[int, int]] = []
    for a, b in zip(first, np.append(first[1:], len(tile)), strict=True):
        most = whole[item[a]]
        if sum(len(index.tiles[t]) for t in set(tile[a:b])) < max(LEAST, COVERED * most):
            continue
        best, size, have, begin = 0, 0, {}, a
        fullest: list[int] = []
        for end in range(a, b):  # all tiles whose shifts are at most the item's length apart
            have[tile[end]] = have.get(tile[end], 0) + 1
            size += len(index.tiles[tile[end]]) * (have[tile[end]] == 1)
            while shift[end] - shift[begin] > most:
                have[tile[begin]] -= 1
                size -= len(index.tiles[tile[begin]]) * (have[tile[begin]] == 0)
                begin += 1
            if size > best:
                best, fullest = size, [t for t, n in have.items() if n]
        if best >= LEAST:
            kept += [(int(text[a]), int(t)) for t in fullest]
    return np.array(kept, np.int64).reshape(-1, 2).T


def _counted(index: Index, rolling: Rolling, data: np.ndarray, edges: np.ndarray, done: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``text, tile, band`` of the bands with q-grams in common, and how many; not of pairs of text and item in ``done``.

    Places are gone through in runs of about ``ENTRIES`` q-grams in common, so a text and an item that repeat themselves
    cost time and not memory.
    """
    start = np.arange(len(data) - index.gram + 1)
    hashes = rolling.spans(data, start, start + index.gram)
    at = np.flatnonzero(index.seen[(hashes & np.uint64(len(index.seen) - 1)).astype(np.int64)])
    left = np.searchsorted(index.grams, hashes[at], "left")
    n = np.searchsorted(index.grams, hashes[at], "right") - left
    at, left, n = at[n > 0], left[n > 0], n[n > 0]
    items = int(index.item.max(initial=0)) + 1
    keys, counts = np.zeros((3, 0), np.int64), np.zeros(0, np.int64)
    runs = np.unique(np.searchsorted(np.cumsum(n), np.arange(ENTRIES, int(n.sum()) + ENTRIES, ENTRIES)))
    for a, b in zip(np.append(0, runs[:-1] + 1), np.minimum(runs + 1, len(at)), strict=True) if len(runs) else ():
        m = n[a:b]
        entry = np.repeat(left[a:b], m) + np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        where, tile = np.repeat(at[a:b], m), index.tile[entry]
        text = np.searchsorted(edges, where, "right") - 1
        diagonal = where - index.place[entry]
        if len(done):
            new = ~np.isin(text * items + index.item[tile], done)
            tile, text, diagonal = tile[new], text[new], diagonal[new]
        band = diagonal // index.band
        # in the overlap with the band before; a band of one diagonal is aligned on both sides
        also = (diagonal - band * index.band < index.edits[tile]) & (index.band > 1)
        more = np.stack([np.append(text, text[also]), np.append(tile, tile[also]), np.append(band, band[also] - 1)])
        keys, counts = _summed(np.append(keys, more, axis=1), np.append(counts, np.ones(more.shape[1], np.int64)))
    return keys, counts


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each column of ``keys`` once, with the sum of its ``counts``."""
    if not keys.shape[1]:
        return keys, counts
    by = np.lexsort(keys)
    keys, counts = keys[:, by], counts[by]
    new = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
    return keys[:, new], np.add.reduceat(counts, new)


def _windows(index: Index, whole: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Where to look at ``size`` bytes at a time: in overlapping windows, if what lies together is looked for."""
    if index.offset is None:
        return [(0, size)]
    # a stretch of tiles has shifts no further apart than the item is long, and lies in twice its length
    reach = 2 * int(whole.max(initial=0)) + 4 * PIECE
    step = max(WINDOW, reach)
    return [(a, min(size, a + step + reach)) for a in range(0, max(1, size - reach), step)]


def _without(index: Index, items: set[int]) -> Index:
    """The index of the other items; numbers stay what they are."""
    if not items:
        return index
    other = ~np.isin(index.item[index.tile], sorted(items))
    return replace(index, grams=index.grams[other], tile=index.tile[other], place=index.place[other])


def find_items(texts: list[bytes], index: Index, known: list[set[int]] | None = None, rolling: Rolling | None = None) -> list[list[int]]:
    """The numbers of the items that are in each (plain) text; those that are ``known`` to be are not looked for."""
    known, rolling = known or [set() for _ in texts], rolling or Rolling()
    out: list[list[int]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in index.tiles], np.int64)
    whole = np.bincount(index.item, sizes) if len(index.item) else np.zeros(0)
    items = int(index.item.max(initial=0)) + 1
    # a text with known items is a portion of its own
    for a, b in portions([len(t) + PORTION * bool(k) for t, k in zip(texts, known, strict=True)], PORTION):
        data = np.frombuffer(b"\n".join(texts[a:b]) + b"\n", np.uint8)
        edges = np.cumsum([0, *(len(t) + 1 for t in texts[a:b])])
        there: set[int] = set()  # text and item
        own = _without(index, known[a]) if b == a + 1 else index
        for low, high in _windows(index, whole, len(data)) if len(index.grams) else ():
            if high - low < index.gram:
                continue
            part, ends = data[low:high], np.clip(edges - low, 0, high - low)
            left = own
            if there and (at := int(np.searchsorted(edges, low, "right"))) == int(np.searchsorted(edges, high - 1, "right")):
                left = _without(own, {pair % items for pair in there if pair // items == at - 1})  # all of it in one text
            if not len(left.grams):
                continue
            keys, shared = _counted(left, rolling, part, ends, np.array(sorted(there), np.int64))
            text, tile, band = keys[:, shared >= index.bound[keys[1]]]
            likely = _likely(index, sizes, whole, text, tile)
            text, tile, band = text[likely], tile[likely], band[likely]
            found = np.zeros(len(tile), bool)
            for k in range(0, len(tile), 2048):
                some = slice(k, k + 2048)
                found[some] = _aligned(index, part, tile[some], band[some] * index.band, ends[text[some]], ends[text[some] + 1] - (ends[text[some] + 1] < high - low) - (edges[text[some] + 1] == high))
            covered: dict[tuple[int, int], int] = {}
            for row, t in _together(index, whole, text[found], tile[found], band[found]).T:
                name = (int(row), int(index.item[t]))
                covered[name] = covered.get(name, 0) + len(index.tiles[t])
            there |= {row * items + number for (row, number), size in covered.items() if size >= COVERED * whole[number]}
        for row, number in sorted(divmod(pair, items) for pair in there):
            out[a + row].append(number)
        for number, short in index.short:
            for row in range(a, b):
                if short in b" " + texts[row] + b" ":
                    out[row].append(number)
    return out


def find_all(texts: list[bytes], indexes: tuple[Index, ...]) -> list[list[int]]:
    """The numbers of the items that any of the indexes finds in each (plain) text; the last, of short tiles, goes first."""
    found: list[set[int]] = [set() for _ in texts]
    rolling = Rolling()
    for index in reversed(indexes):
        found = [old | set(new) for old, new in zip(found, find_items(texts, index, found, rolling), strict=True)]
    return [sorted(numbers) for numbers in found]


def tagged(docs: DataFrame, benchmark: DataFrame, into: str = "found_items") -> DataFrame:
    """``docs`` with ``into``: the ``item_id`` of every benchmark item that its text holds.

    ``docs`` needs ``text`` and ``benchmark`` ``item_id, text``; all columns of ``docs`` are kept, and
    one called ``into`` is replaced. Items are gathered in slices of at most ``SLICE`` characters
    by a hash of their id, and the texts are gone through once per slice, each time from a
    staged table, so a large benchmark costs passes and not memory. A NULL or empty text holds nothing, a NULL or empty item is
    nowhere; an item without id is listed as NULL, and copies of an item are listed once each.
    """
    docs = docs.drop(into)
    kinds = docs.schema
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = total // SLICE + 1
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    names = kinds.fieldNames()
    schema = StructType([*kinds.fields, StructField(into, ArrayType(LongType()))])
    out = docs.withColumn(into, F.array().cast("array<bigint>"))
    for k in range(slices):
        rows = sorted(items.where(number == k).collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        ids = [r["item_id"] for r in rows]
        plains = [plain(r["text"]) for r in rows]
        index = docs.sparkSession.sparkContext.broadcast([vars(build_index(plains)), vars(build_pieces(plains))])

        def run(batches: Iterator[pa.RecordBatch], ids=ids, index=index) -> Iterator[pa.RecordBatch]:
            known = tuple(Index(**fields) for fields in index.value)
            for batch in batches:
                texts = [plain((t or b"").decode()) for t in utf8(batch.column("text"))]
                found = [[ids[i] for i in numbers] for numbers in find_all(texts, known)]
                earlier = batch.column(into).to_pylist()
                both = pa.array([e + f for e, f in zip(earlier, found, strict=True)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), both], [*names, into])

        out = out.mapInArrow(run, schema)
        if k < slices - 1:
            out = stage(out, "tagged")
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns."""
    into = unused(docs, "found_items")
    return tagged(docs, benchmark, into).where(F.size(into) == 0).drop(into)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, n_items, items`` for every row of ``docs``; ``items`` joins the ids."""
    found = tagged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark)
    listed = F.concat_ws(",", F.transform(F.array_sort("found_items"), lambda i: F.coalesce(i.cast("string"), F.lit("null"))))
    n = F.size("found_items")
    return found.select("doc_id", (n > 0).alias("contaminated"), n.cast("long").alias("n_items"), listed.alias("items"))
