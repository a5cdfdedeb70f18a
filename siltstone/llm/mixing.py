"""Mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame functions only.

All targets together are cut into blocks of ``BLOCK`` words. Seats for blocks go to the sources with
the highest quotients ``target / (2k + 1)``, and the seats of a source to its shards in the same way.
A shard is a line of documents in seeded order; its quota is taken as a run of blocks that starts at
a seeded block and goes round, so documents stay whole but for the two at the ends of the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import stage

WEIGHTS = (5, 2, 1)
MOST = 3  #: times a source may be repeated
BLOCK = 32  #: words of a block
SHARD = 1 << 16  #: words a shard aims at
MOST_SHARDS = 4096  #: of a source; so many rows, and not its documents, meet in one task
SEED = 20240229
WORD = r"[^\x20\x09-\x0D]+"


def apportion(cells: DataFrame, group: str, key: str, weight: str, seats: str) -> DataFrame:
    """``cells`` with ``quota``: the ``seats`` of each ``group`` by the highest quotients.

    ``weight / (2k + 1)`` is the quotient of the seat after the first ``k``. A divisor that gives
    surely no more than all seats hands out the first of them, one that gives surely enough ends the
    list of candidates, so at most two candidates per cell are ranked on average. Equal quotients go
    to the smaller ``key``. Cells without weight get no seat.
    """
    whole = Window.partitionBy(group)
    some = F.col(weight) > 0
    count = F.sum(some.cast("int")).over(whole)
    share = F.try_divide(F.col(weight).cast("double"), F.sum(F.col(weight).cast("double")).over(whole))  # NULL without any weight
    near = 1e-9
    ranged = cells.withColumns({"_share": share, "_half": count / 2.0}).withColumns(
        {
            "_sure": F.when(some, F.greatest(F.lit(0), F.floor(F.col("_share") * (F.col(seats) - F.col("_half")) + 0.5 - near))).otherwise(0),
            "_most": F.when(some, F.floor(F.col("_share") * (F.col(seats) + F.col("_half")) + 0.5 + near) + 1).otherwise(0),
        }
    ).withColumn("_left", F.col(seats) - F.sum("_sure").over(whole))
    tried = ranged.where("_most > _sure").select(
        group, key, "_left", weight, F.explode(F.sequence(F.col("_sure"), F.col("_most") - 1)).alias("_k")
    )
    ranked = Window.partitionBy(group).orderBy(F.desc(F.col(weight) / (2 * F.col("_k") + 1)), key, "_k")
    won = tried.withColumn("_place", F.row_number().over(ranked)).where("_place <= _left")
    won = won.groupBy(group, key).agg(F.count(F.lit(1)).alias("_won"))
    return (
        ranged.join(won, [group, key], "left")
        .withColumn("quota", (F.col("_sure") + F.coalesce("_won", F.lit(0))).cast("long"))
        .drop("_share", "_half", "_sure", "_most", "_left", "_won")
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size`` with ``place, weight, target``.

    Sources by code point, NULL last, weigh ``weights`` in turn and share the sum of all sizes. A
    target stops at ``MOST`` times its source; in the order in which sources reach that stop, the
    level of the others follows from the sums of those before.
    """
    one = Window.partitionBy(F.lit(0))  # one row per source meets here
    by_name = one.orderBy(F.col("source").asc_nulls_last())
    named = sources.withColumn("place", F.row_number().over(by_name))
    turn = F.array(*[F.lit(w) for w in weights])
    named = named.withColumn("weight", F.element_at(turn, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    named = named.withColumn("_stop", F.col("source_size") * MOST)
    filling = one.orderBy(F.col("_stop") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(one) - F.coalesce(F.sum("_stop").over(filling), F.lit(0))
    weight = F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(filling), F.lit(0))
    named = named.withColumn("_level", rest.cast("double") / weight.cast("double"))
    named = named.withColumn("_stops", F.col("_stop") <= F.col("_level") * F.col("weight"))
    level = F.min_by("_level", F.when(~F.col("_stops"), F.col("_stop") / F.col("weight"))).over(one)
    target = F.when(F.col("_stops"), F.col("_stop").cast("double")).otherwise(level * F.col("weight"))
    return named.withColumn("target", target).select("source", "source_size", "place", "weight", "target")


def _overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def mixed(docs: DataFrame, seed: int = SEED, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``mark, source`` for every row of ``docs``.

    ``size`` counts words and ``taken`` the words that the mix takes of the row, repeats included;
    it is at most ``MOST`` times the size. ``mark`` is a hash of the row by which a caller finds it
    again. A NULL or empty text has size 0 and nothing of it is taken; a NULL source is a source of
    its own, after the others. Repeated rows are rows of their own; which of them is taken is not
    defined, as they are alike. A NULL ``doc_id`` is carried along. An empty table gives an empty
    result. Columns other than ``doc_id``, ``text`` and ``source`` are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    measured = docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_mark(seed).alias("mark"),
    )
    measured = stage(measured, "measured")
    sources = targets(measured.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = sources.withColumn("_all", F.lit(0)).withColumn(
        "seats", F.round(F.sum("source_size").over(Window.partitionBy(F.lit(0))) / block).cast("long")
    )
    shards = F.greatest(F.lit(1), F.least(F.lit(MOST_SHARDS), F.ceil(F.col("source_size") / shard)))
    sources = apportion(sources, "_all", "place", "target", "seats").withColumn("shards", shards)
    sources = stage(sources.select("source", "source_size", "target", "place", "quota", "shards"), "sources")

    placed = measured.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    placed = placed.drop("_source").withColumn("shard", F.pmod("mark", "shards"))
    cells = placed.groupBy("place", "shard").agg(F.sum("size").alias("line"), F.first("quota").alias("seats"))
    cells = apportion(cells, "place", "shard", "line", "seats")
    take = F.least(F.col("quota") * block, F.col("line") * MOST)
    begin = F.pmod(F.xxhash64("place", "shard", F.lit(seed)), F.greatest(F.lit(1), F.ceil(F.col("line") / block))) * block
    cells = cells.select(
        "place", "shard", "line",
        F.when(F.col("line") > 0, F.floor(take / F.col("line"))).otherwise(0).alias("rounds"),
        F.when(F.col("line") > 0, take % F.col("line")).otherwise(0).alias("run"),
        begin.alias("begin"),
    )
    along = Window.partitionBy("place", "shard").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    lined = placed.withColumn("_end", F.sum("size").over(along)).withColumn("_start", F.col("_end") - F.col("size"))
    lined = lined.join(cells, ["place", "shard"])
    last = F.col("begin") + F.col("run")
    part = _overlap(F.col("_start"), F.col("_end"), F.col("begin"), F.least(last, F.col("line")))
    again = _overlap(F.col("_start"), F.col("_end"), F.lit(0), last - F.col("line"))
    taken = (F.col("rounds") * F.col("size") + part + again).cast("long")
    return lined.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "mark", "source")


def mixture(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: every row as often as whole texts come nearest to its words.

    Only the two documents at the ends of a run are taken in part; they come once more if at least
    half of their words are taken. Texts without a word are not taken. All columns are kept.
    """
    plan = mixed(docs, seed).where("size > 0").groupBy("doc_id", "mark")
    times = F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int")
    plan = plan.agg(times.alias("times")).where("times > 0").select(F.struct("doc_id", "mark").alias("key"), "times")
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), row_mark(seed).alias("mark"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))  # whole rows, so that no names meet
    again = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("again")
    return rows.join(plan, "key").select("row", again).select("row.*")


def row_mark(seed: int = SEED) -> Column:
    """A seeded hash of a row's id and text: the order of the mix, whatever the partitions."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("text").cast("string"))
