"""Personal data: fixed shapes, and identifiers that the words around them give away.

Matches of the base shapes are the seeds. The word before and the word after a whole seed, however many
tokens it has, are patterns; a number in groups that no shape matched is one token likewise. A
pattern is as reliable as the share of known identifiers among all that look like one on its side of
the word, and the word has to stand there often enough not to be one that stands anywhere. Patterns
and the tokens beside them form a graph that Spark scores in rounds: patterns are taken from the seeds
and all tokens accepted so far, tokens from their patterns, until a round accepts no other. Tokens
beside reliable patterns that no shape matched are added as spans of the kind ``context``. Everything
is DataFrame functions.

Each base shape is written so that Java's matcher needs neither recursion nor a second look at a
text, however long a run of digits or letters is; what it matches is what the plain shape matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.star import BROADCAST_BYTES, measured_bytes
from ..sources.workspace import stage

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: kind, shape and what a text has to contain for it; in the order in which spans are listed
BASE = (
    ("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])", ""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)
FOUND = "context"
#: A token that may be an identifier: between white space, with an @ or a digit.
TOKEN = r"(?<!\S)(?=[^\s0-9@]*+[0-9@])\S++"
FEWEST_DIGITS = 4  #: of a token without an @
MOST_DIGITS = 34  #: of neighbouring tokens that are taken as one, as many as the longest account numbers have
SUPPORT = 5  #: different known identifiers that a pattern needs
RELIABLE = 0.8  #: share of known identifiers among a pattern's neighbours that look like one
SPECIFIC = 0.1  #: share of all occurrences of a pattern's word that stand beside known identifiers
CERTAIN = 0.8  #: score a token needs
NEAR = 64  #: characters beside a token in which the next word is looked for
_PART = "array<struct<gap:int,hit:string,left:string,right:string,follows:boolean>>"


def _parts(text: Column, shape: str) -> Column:
    """Every match with the length of what lies before it, the words beside it and whether only spaces
    of its line lie before it.

    ``split`` gives what lies between the matches and ``regexp_extract_all`` the matches. What a match
    shares its first or last word with is not beside it.
    """
    gaps, hits = F.split(text, shape, -1), F.regexp_extract_all(text, F.lit(shape), F.lit(0))
    after = F.slice(gaps, 2, F.size(gaps))
    parts = F.slice(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), after.alias("next")), 1, F.size(hits))
    left = r"(\S+)\s+\S*\z"
    right = r"^\S*\s+(\S+)"
    return F.transform(
        parts,
        lambda p: F.struct(
            F.length(p["gap"]).alias("gap"),
            p["hit"].alias("hit"),
            F.lower(F.regexp_extract(F.substring(p["gap"], -NEAR, NEAR), left, 1)).alias("left"),
            F.lower(F.regexp_extract(F.substring(p["next"], 1, NEAR), right, 1)).alias("right"),
            p["gap"].rlike(r"^[^\S\r\n]+$").alias("follows"),
        ),
    ).cast(_PART)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = "^0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(part))
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _searched(docs: DataFrame) -> DataFrame:
    """``row, doc_id`` and the matches of each kind, of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("digit", F.col("text").rlike("[0-9]"))
    found = {}
    for kind, shape, sign in BASE:
        needed = F.col("text").contains(sign) if sign else F.lit(True)
        if kind != "email":
            needed = F.col("digit") & needed
        found[kind] = F.when(needed, _parts(F.col("text"), shape))
    found["token"] = F.when(F.col("digit") | F.col("text").contains("@"), _parts(F.col("text"), TOKEN))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", *[c.alias(k) for k, c in found.items()])


def _placed(rows: DataFrame) -> DataFrame:
    """``row, kind, start, end, value, left, right, follows`` of every valid match; tokens come after the kinds.

    The places of one text are running sums, so no more than one text meets in a group.
    """
    names = [kind for kind, _, _ in BASE] + ["token"]
    lists = F.array(*[F.struct(F.lit(n).alias("kind"), F.col(name).alias("parts")) for n, name in enumerate(names)])
    each = rows.select("row", F.explode(lists).alias("k")).select("row", "k.kind", F.posexplode("k.parts").alias("at", "part"))
    along = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("part.hit")
    each = each.repartition("row").withColumn("end", F.sum(F.col("part.gap") + size).over(along))
    each = each.select("row", "kind", (F.col("end") - size).alias("start"), "end", F.col("part.hit").alias("value"), "part.left", "part.right", "part.follows")
    valid = F.lit(True)
    for n, (kind, _, _) in enumerate(BASE):
        valid = F.when(F.col("kind") == n, _valid(kind, F.col("value"))).otherwise(valid)
    return each.where(valid)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind, _, _ in BASE], F.lit(FOUND))
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    )


def _beside(placed: DataFrame) -> DataFrame:
    """``row, start, end, token, seed, side, word``: every seed and every other token with each of its patterns.

    Seeds are spans of the base shapes, the first of those that overlap, with the words beside the
    whole span. Other tokens are one if they follow each other in a line and have digits and no small
    letters, as in a number written in groups; runs of more than ``MOST_DIGITS`` stay apart.
    """
    is_token = F.col("kind") == len(BASE)
    # a token is part of a seed if, of the spans that begin before its end, one ends after its start
    order = Window.partitionBy("row").orderBy(F.when(is_token, F.col("end") - 1).otherwise(F.col("start")), is_token)
    reach = F.max(F.when(~is_token, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    one = placed.withColumn("seed", F.coalesce(reach > F.col("start"), F.lit(False))).where(is_token)
    along = Window.partitionBy("row").orderBy("start")
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    one = one.withColumn("digits", digits).withColumn("group", ~F.col("seed") & (F.col("digits") > 0) & ~F.col("value").rlike(r"[\p{Ll}@]"))
    goes_on = F.col("group") & F.col("follows") & F.coalesce(F.lag("group").over(along), F.lit(False))
    one = one.withColumn("run", F.count_if(~goes_on).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    many = F.sum("digits").over(Window.partitionBy("row", "run")) > MOST_DIGITS
    one = one.withColumn("apart", F.when(many, F.col("start"))).where(~F.col("seed"))
    parts = F.array_sort(F.collect_list(F.struct("start", "value")))  # of one run
    one = one.groupBy("row", "run", "apart").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.array_join(F.transform(parts, lambda p: p["value"]), " ").alias("value"),
        F.min_by("left", "start").alias("left"), F.max_by("right", "start").alias("right"), F.sum("digits").alias("digits"),
    )
    one = one.where((F.col("digits") >= FEWEST_DIGITS) | F.col("value").contains("@")).withColumn("seed", F.lit(False))
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    seeds = placed.where(~is_token).withColumn("reach", F.max("end").over(before))
    seeds = seeds.where(F.col("reach").isNull() | (F.col("reach") <= F.col("start"))).withColumn("seed", F.lit(True))
    columns = ["row", "start", "end", "value", "left", "right", "seed"]
    one = one.select(columns).unionByName(seeds.select(columns))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("word")) for s in ("left", "right")])
    one = one.select("row", "start", "end", F.lower("value").alias("token"), "seed", F.explode(sides).alias("p"))
    return one.select("row", "start", "end", "token", "seed", "p.side", "p.word").where("word <> ''")


def _occurrences(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``word, total``: how often each of ``words`` stands in all texts.

    The words are sent to the texts if their measured size allows it, so that no other word leaves
    its task; if not, all words are counted in their tasks and the counts are joined.
    """
    said = docs.select(F.explode(F.split(F.lower(F.col("text").cast("string")), r"\s+")).alias("word"))
    count = F.count(F.lit(1)).alias("total")
    if measured_bytes(words) <= BROADCAST_BYTES:
        return said.join(F.broadcast(words), "word", "left_semi").groupBy("word").agg(count)
    return said.groupBy("word").agg(count).join(words, "word", "left_semi")


def _reliable(beside: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``beside`` with tokens that reliable patterns give away.

    A round that accepts another token is followed by one more, so the number of rounds is that of the
    generations of patterns there are. An accepted token counts like a seed from then on.
    """
    edges = beside.groupBy("side", "word", "token").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    edges = stage(edges, "edges")
    # whatever is accepted, no word with fewer neighbours becomes a pattern
    possible = edges.groupBy("side", "word").agg(F.count(F.lit(1)).alias("tokens")).where(F.col("tokens") >= SUPPORT)
    possible = stage(possible.select("side", "word"), "possible")
    totals = stage(_occurrences(docs, possible.select("word").distinct()), "totals")
    graph = stage(edges.join(possible, ["side", "word"], "left_semi"), "graph")
    accepted = stage(graph.where("seed").select("token", F.lit(True).alias("seed")).distinct(), "accepted")
    known, before = accepted.count(), -1
    while known != before:
        held = F.sum(F.when(F.col("seed").isNotNull(), F.col("n")))
        trust = graph.drop("seed").join(accepted, "token", "left").groupBy("side", "word").agg(
            F.count("seed").alias("known"), held.alias("held"), F.sum("n").alias("all")
        )
        trust = trust.where((F.col("known") >= SUPPORT) & (F.col("held") >= RELIABLE * F.col("all"))).join(totals, "word")
        trust = trust.where(F.col("held") >= SPECIFIC * F.col("total")).select("side", "word", (F.col("held") / F.col("all")).alias("trust"))
        trusted = stage(trust, "trusted")
        given = graph.join(trusted, ["side", "word"]).groupBy("token").agg((1 - F.product(1 - F.col("trust"))).alias("score"))
        given = given.where(F.col("score") >= CERTAIN).select("token", F.lit(False).alias("seed"))
        accepted = stage(accepted.unionByName(given).groupBy("token").agg(F.max("seed").alias("seed")), "accepted")
        before, known = known, accepted.count()
    certain = accepted.where(~F.col("seed")).select("token")
    return beside.where(~F.col("seed")).join(trusted, ["side", "word"], "left_semi").join(certain, "token", "left_semi")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts per base kind, ``base_sha256`` and ``spans`` for every row of ``docs``.

    Places are in code points, ends exclusive. A NULL text counts as an empty one and has no span;
    rows with a NULL ``doc_id`` and repeated rows are searched one by one, and what repeated rows
    hold counts once per row as evidence. An empty table gives an empty result. Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    docs = docs.select("doc_id", "text")
    rows = stage(_searched(docs), "searched")
    placed = stage(_placed(rows), "placed")
    beside = stage(_beside(placed), "beside")
    added = _reliable(beside, docs).select("row", "start", "end").distinct()
    spans = placed.where(F.col("kind") < len(BASE)).select("row", "start", "kind", "end")
    spans = spans.unionByName(added.withColumn("kind", F.lit(len(BASE))))
    spans = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("every"))  # of one text
    both = rows.select("row", "doc_id").join(spans, "row", "left")
    both = both.withColumn("every", F.coalesce("every", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))

    def count(number: int) -> Column:
        return F.size(F.filter("every", lambda s: s["kind"] == number)).cast("long")

    counts = [count(n).alias(f"n_{kind}") for n, (kind, _, _) in enumerate(BASE)]
    base = F.filter("every", lambda s: s["kind"] < len(BASE))
    return both.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("every")).alias("spans"))
