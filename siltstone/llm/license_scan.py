"""License scans: canonical digests of entire texts, joined with those of known licences.

A text is brought to a canonical form as published matching guidelines ask: lower case, no copyright
lines, one spelling of each word that has several, words with single spaces between them. Two texts
are the same licence if the digests of these forms are equal. The texts are whole documents and, for
notices inside of them, whole lines. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import stage
from .license_texts import KNOWN

#: A line that only says who holds the rights. Lines are in lower case by then.
COPYRIGHT_LINE = r"^[ \t/*#;%-]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|by )|\(c\)[ \t]*(copyright|[0-9]{4})|©|all rights reserved).*$"
#: Spellings that count as one, as the SPDX matching guidelines list them. Fixed values.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("licencing", "licensing"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("catalogue", "catalog"), ("centre", "center"), ("colour", "color"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"),
    ("fulfil", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"), ("merchantibility", "merchantability"),
    ("non-commercial", "noncommercial"), ("non-infringement", "noninfringement"), ("optimise", "optimize"), ("organisation", "organization"),
    ("owner", "holder"), ("per cent", "percent"), ("practice", "practise"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("utilisation", "utilization"), ("while", "whilst"), ("wilful", "willful"), ("https", "http"),
)
SIGNS = r"[^\p{L}\p{N}]+"


def _lines(text: Column) -> Column:
    """The words of each line in lower case with single spaces; a copyright line is empty."""

    def words(line: Column) -> Column:
        low = F.lower(line)
        return F.when(low.rlike(COPYRIGHT_LINE), "").otherwise(F.trim(F.regexp_replace(low, SIGNS, " ")))

    return F.filter(F.transform(F.split(text, "\n"), words), lambda line: line != "")


def _spelt(words: Column) -> Column:
    out = F.concat(F.lit(" "), words, F.lit(" "))
    for spelling, standard in SPELLINGS:  # in words, as signs are gone
        out = F.replace(out, F.lit(f" {spelling.replace('-', ' ')} "), F.lit(f" {standard} "))
    return F.trim(out)


def canonical(text: Column) -> Column:
    """The canonical form of a whole text; empty if nothing of it is left."""
    return _spelt(F.array_join(_lines(text), " "))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``digest, license, size``: one row per known text; of texts alike the first name."""
    rows = spark.createDataFrame(list(known), "license string, text string").select("license", canonical(F.col("text")).alias("form"))
    rows = rows.where("form <> ''").groupBy("form").agg(F.min("license").alias("license"))
    return rows.select(F.sha2("form", 256).alias("digest"), "license", F.length("form").alias("size"))


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, license, n_notices, notices`` for every row of ``docs``.

    ``license`` is what the whole text is, ``notices`` the names of all licences that a line is, in
    order and once each, ``n_notices`` the number of such lines. A NULL or empty text has no licence
    and no notice (NULL, 0 and an empty text). Repeated rows and rows with a NULL ``doc_id`` are
    scanned one by one; other columns are not read. Which side of the join is sent is left to Spark.

    Every text is brought to its words. Only what has more than twice as many characters as the
    longest known text is not spelt and digested: one spelling of a word never halves it.
    """
    longest = 2 * (known.agg(F.max("size")).first()[0] or 0)

    def digest(words: Column) -> Column:
        return F.when(F.length(words) <= longest, F.sha2(_spelt(words), 256))

    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(_lines(F.col("text").cast("string")), F.array().cast("array<string>")).alias("lines"))
    units = lines.select("doc_id", digest(F.array_join("lines", " ")).alias("whole"), F.array_compact(F.transform("lines", digest)).alias("parts"))
    rows = stage(units.withColumn("row", F.monotonically_increasing_id()), "units")
    each = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("whole").alias("digest"))), F.transform("parts", lambda d: F.struct(F.lit(False).alias("whole"), d.alias("digest"))))
    each = rows.select("row", F.explode(each).alias("u")).select("row", "u.whole", "u.digest").where("digest IS NOT NULL")
    found = each.join(known, "digest").groupBy("row").agg(
        F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
        F.count_if(~F.col("whole")).alias("n_notices"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license"))))).alias("notices"),
    )
    return rows.select("row", "doc_id").join(found, "row", "left").select(
        "doc_id", "license", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices")
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle(known: tuple[tuple[str, str], ...] = KNOWN) -> str:
    """The same as SQL."""

    def form(text: str) -> str:
        out = f"regexp_replace(lower({text}), {_quoted("(?m)" + COPYRIGHT_LINE)}, '', 'g')"
        out = f"' ' || trim(regexp_replace({out}, {_quoted(SIGNS)}, ' ', 'g')) || ' '"
        for spelling, standard in SPELLINGS:
            out = f"replace({out}, ' {spelling.replace('-', ' ')} ', ' {standard} ')"
        return f"trim({out})"

    values = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known)
    return f"""
    WITH named(license, text) AS (VALUES {values}),
    known AS (SELECT {form('text')} AS form, min(license) AS license FROM named GROUP BY 1),
    wholes AS (SELECT d.doc_id, k.license FROM documents d LEFT JOIN known k ON {form('d.text')} = k.form AND k.form <> ''),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    noticed AS (
        SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS notices
        FROM lines JOIN known k ON {form('line')} = k.form AND k.form <> '' GROUP BY doc_id)
    SELECT w.doc_id, w.license, coalesce(n.n_notices, 0) AS n_notices, coalesce(n.notices, '') AS notices
    FROM wholes w LEFT JOIN noticed n USING (doc_id)"""
