"""A manifest of digests: one tree per source, one tree over the sources, and a proof for every row.

Rows get their rank in a source by ranges and counts. The digits of the rank, to base 16, are grouped
away one after the other, and each grouping nests the structs of the one before: three digits make a
block, one row of at most 4096 nodes, so all three groupings follow a single exchange and no row grows
with the source. Blocks are the nodes of the next round, until each source is one block; then the
sources are. Going down again, each block is opened by ``transform`` and ``explode``, and takes with
it the siblings of its own digest above: these come to it by a union and a grouping, not by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import stage

BITS = 4  #: of a digit
WIDTH = 1 << BITS
DIGITS = 3  #: in a block
BLOCK = 1 << BITS * DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STEPS = "array<struct<left: string, right: string>>"


def sealed(*texts: Column) -> Column:
    """Small hex SHA-256 of the texts one after the other."""
    return F.sha2(F.concat(*texts), 256)


def framed(value: Column) -> Column:
    """``-`` for NULL, else the bytes of the value as text, a colon, and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_rows(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, bent``: the digest of each row, and of its tampered copy if it has one.

    ``tree`` is the source in a form that sorts NULL first. The copies whose id has a CRC-32 that
    5 divides have small A-Z in their text.
    """
    text = F.col("text").cast("string")
    leaf = sealed(*[framed(F.col(name)) for name in FIELDS])
    small = sealed(*[framed(F.col(name)) for name in FIELDS[:-1]], framed(F.translate(text, CAPITALS, CAPITALS.lower())))
    marked = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf.alias("leaf"),
        F.when(marked & text.isNotNull(), small).alias("bent"),
    )


def ranked(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``rank``, from 0 within their ``tree``, and ``total``, the rows of the tree.

    ``order`` begins with the tree. Rows are ranged and sorted, and each range has one count per tree,
    so a tree with any share of the rows is divided.
    """
    at = F.monotonically_increasing_id()
    held = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at), label)
    held = held.withColumn("part", F.shiftright("at", 33))
    runs = held.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # as many rows of a tree as there are ranges
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    return held.join(runs, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _hashed(level: int) -> Column:
    """Whether nodes of this level are made: as long as there is more than one node below."""
    return F.col("total") > WIDTH ** (level - 1)


def _node(kids: Column, level: int) -> Column:
    every = F.array_join(F.transform(kids, lambda kid: kid["digest"]), "")
    return F.when(_hashed(level), F.sha2(every, 256)).otherwise(kids[0]["digest"])


def nested(nodes: DataFrame) -> DataFrame:
    """``tree, block, total, digest, kids`` of ``nodes`` (``tree, rank, total, digest, item``)."""
    digits = [F.shiftright("rank", BITS * i).bitwiseAND(WIDTH - 1).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    rows = nodes.select("tree", F.shiftright("rank", BITS * DIGITS).alias("block"), "total", "digest", "item", *digits)
    rows = rows.repartition("tree", "block")
    inside = F.struct("d0", "digest", "item")
    for level in range(1, DIGITS + 1):
        key = ["tree", "block", "total", *[f"d{i}" for i in range(level, DIGITS)]]
        rows = rows.groupBy(*key).agg(F.sort_array(F.collect_list(inside)).alias("kids"))
        rows = rows.withColumn("digest", _node(F.col("kids"), level))
        if level < DIGITS:
            inside = F.struct(f"d{level}", "digest", "kids")
    return rows


def rolled_up(nodes: DataFrame, label: str) -> list[DataFrame]:
    """The blocks of every round, the last of which has one block per tree."""
    rounds = []
    while True:
        blocks = stage(nested(nodes), label)
        rounds.append(blocks)
        if (blocks.agg(F.max("total")).first()[0] or 0) <= BLOCK:
            return rounds
        total = F.ceil(F.col("total") / BLOCK).cast("long")
        nodes = blocks.select("tree", F.col("block").alias("rank"), total.alias("total"), "digest", F.lit(None).cast("string").alias("item"))


def _beside(kids: str) -> Column:
    """Each of the kids with the digests to its left and right."""
    digests = F.transform(kids, lambda kid: kid["digest"])
    return F.transform(
        kids,
        lambda kid, i: F.struct(
            kid.alias("kid"),
            F.array_join(F.slice(digests, 1, i), "").alias("left"),
            F.array_join(F.slice(digests, i + 2, WIDTH), "").alias("right"),
        ),
    )


def _opened(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
    """``tree, rank, digest, item, path, subroot`` of the nodes in ``blocks``.

    ``above`` has ``tree, block, path, subroot`` for every block; without it they are at the top.
    """
    none = F.lit(None)
    own = blocks.select("tree", "block", "total", "kids", none.cast(_STEPS).alias("path"), none.cast("string").alias("subroot"))
    if above is None:
        rows = own.withColumn("path", F.array().cast(_STEPS))
    else:
        kinds = {f.name: f.dataType for f in own.schema.fields}
        theirs = above.select("tree", "block", none.cast("long").alias("total"), none.cast(kinds["kids"]).alias("kids"), "path", "subroot")
        both = own.unionByName(theirs).groupBy("tree", "block")  # two rows each
        rows = both.agg(*[F.first(name, ignorenulls=True).alias(name) for name in ("total", "kids", "path", "subroot")])
    kept = ["tree", "block", "total", "path", "subroot"]
    for level in range(DIGITS, 0, -1):
        rows = rows.select(*kept, F.explode(_beside("kids")).alias("row"))
        step = F.when(_hashed(level), F.array(F.struct("row.left", "row.right"))).otherwise(F.array().cast(_STEPS))
        inner = ["row.kid.kids"] if level > 1 else ["row.kid.digest", "row.kid.item"]
        path = F.concat(step, F.col("path")).alias("path")
        place = (F.col("block") * WIDTH + F.col(f"row.kid.d{level - 1}")).alias("block")
        rows = rows.select("tree", place, "total", path, "subroot", *inner)
    return rows.withColumnRenamed("block", "rank").drop("total")


def _paths(rounds: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """The nodes of the first round, each with its path to the top."""
    rows = None
    for blocks in reversed(rounds):
        if rows is not None:
            above = rows.select("tree", F.col("rank").alias("block"), "path", "subroot")
        rows = _opened(blocks, above)
    return rows


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``."""
    return F.aggregate(path, leaf, lambda below, step: sealed(step["left"], below, step["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """A proof for each row of ``docs`` (``doc_id, source, lang, n_chars, text``).

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, and ``path``: the
    digests to the left and right on every level, from the leaf up. ``folded_root`` starts from the
    tampered leaf where there is one (see ``leaf_rows``). NULL ids stand before all others, rows of one
    id are ordered by leaf, and repeated rows are leaves of their own. One row of all is its own root, with an
    empty path. An empty table gives an empty result. Other columns are not read.
    """
    leaves = stage(leaf_rows(docs), "leaves")
    copy = F.col("_metadata.row_index").alias("copy")  # divides even a range of equal rows
    order = [F.col("tree"), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("copy")]
    nodes = ranked(leaves.select("*", copy), order, "ranked")
    item = F.struct("doc_id", "bent").alias("item")
    sources = rolled_up(nodes.select("tree", "rank", "total", F.col("leaf").alias("digest"), item), "blocks")
    tops = sources[-1].select(F.lit("").alias("tree"), F.col("tree").alias("item"), "digest")
    tops = ranked(tops, [F.col("tree"), F.col("item")], "sources")
    whole = rolled_up(tops.select("tree", "rank", "total", "digest", "item"), "tops")
    root = whole[-1].select("digest").first()
    subroots = _paths(whole, None).select(F.col("item").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("digest").alias("subroot"))
    rows = _paths(sources, subroots).select(F.col("item.doc_id").alias("doc_id"), F.col("digest").alias("leaf"), "item.bent", "subroot", "path")
    top = F.lit(root["digest"] if root else None).cast("string")
    beside = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    rows = rows.withColumn("folded_root", folded(F.coalesce("bent", "leaf"), F.col("path")))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        top.alias("root"),
        F.sha2(beside, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == top).alias("verified"),
        "path",
    )


def oracle() -> str:
    """The digests of the query in SQL."""

    def framed_sql(value: str) -> str:
        return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"

    def tree(name: str, of: str, key: str) -> str:
        return f"""{name} AS (
          SELECT 0 AS level, {key}, i, digest, n FROM {of}
          UNION ALL
          SELECT level + 1, {key}, i // {WIDTH}, sha256(string_agg(digest, '' ORDER BY i)), (any_value(n) + {WIDTH - 1}) // {WIDTH}
          FROM {name} WHERE n > 1 GROUP BY level, {key}, i // {WIDTH}
        ), {name}_steps AS (
          SELECT level, {key}, i,
            coalesce(string_agg(digest, '') OVER (PARTITION BY level, {key}, i // {WIDTH} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '|' ||
            coalesce(string_agg(digest, '') OVER (PARTITION BY level, {key}, i // {WIDTH} ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS step
          FROM {name} WHERE n > 1
        ), {name}_paths AS (
          SELECT b.{key}, b.i, list(s.step ORDER BY s.level) AS path
          FROM {of} b JOIN {name}_steps s ON s.{key} = b.{key} AND s.i = b.i // ({WIDTH} ** s.level)::BIGINT GROUP BY b.{key}, b.i
        )"""

    fields = " || ".join(framed_sql(name) for name in FIELDS)
    small = " || ".join([*map(framed_sql, FIELDS[:-1]), framed_sql(f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')")])
    round_ = "list_reduce([xor(c, b)] || repeat([0::BIGINT], 8), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)"
    crc = f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda c, b: {round_}), 4294967295::BIGINT)"
    walk = "list_reduce([{start}] || path, lambda below, step: sha256(split_part(step, '|', 1) || below || split_part(step, '|', 2)))"
    return f"""
    WITH RECURSIVE digests AS (
      SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({fields}) AS digest,
        CASE WHEN text IS NOT NULL AND {crc} % 5 = 0 THEN sha256({small}) END AS bent
      FROM documents
    ), leaves AS (
      SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM digests
    ), {tree("below", "leaves", "tree")}, subroots AS (
      SELECT 0 AS whole, tree, digest, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM below WHERE n = 1
    ), {tree("above", "subroots", "whole")}, paths AS (
      SELECT l.doc_id, l.digest AS leaf, l.bent, s.digest AS subroot, (SELECT digest FROM above WHERE n = 1) AS root,
        coalesce(b.path, []) || coalesce(a.path, []) AS path
      FROM leaves l JOIN subroots s USING (tree) LEFT JOIN below_paths b ON b.tree = l.tree AND b.i = l.i LEFT JOIN above_paths a ON a.i = s.i
    ), walked AS (
      SELECT *, {walk.format(start="coalesce(bent, leaf)")} AS folded_root FROM paths
    )
    SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM walked
    """
