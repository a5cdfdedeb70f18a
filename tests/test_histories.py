import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators.history import scd2_history, scd2_merge
from siltstone.sources import histories, tables
from siltstone.sources.histories import load_versions, read_versions

LOADS = {
    "2024-01-01": [(1, "A"), (2, "B"), (3, None), (5, "E")],
    "2024-02-01": [(1, "A2"), (2, "B"), (3, None), (4, "D")],
    "2024-03-01": [(1, "A"), (2, "B3"), (3, "C"), (4, "D"), (5, "E")],
    "2024-04-01": [(1, "A"), (2, "B3"), (4, "D4")],
}


def load(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def plain(loads):
    """``k, v, from, to`` by walking through each member's loads."""
    out = set()
    for k in {k for rows in loads.values() for k, _ in rows}:
        seen = [(day, dict(rows)[k]) for day, rows in sorted(loads.items()) if k in dict(rows)]
        versions = [(day, v) for i, (day, v) in enumerate(seen) if i == 0 or seen[i - 1][1] != v]
        for i, (day, v) in enumerate(versions):
            out.add((k, v, "1900-01-01" if i == 0 else day, versions[i + 1][0] if i + 1 < len(versions) else None))
    return out


def versions(spark, table):
    rows = read_versions(spark, table).withColumn("following", F.when(~F.col("is_current"), F.date_add("effective_to", 1))).collect()
    assert all(r["is_current"] == (str(r["effective_to"]) == "9999-12-31") for r in rows)
    assert len({r["sk"] for r in rows}) == len(rows)
    return {(r["k"], r["v"], str(r["effective_from"]), str(r["following"]) if r["following"] else None) for r in rows}


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1)])
def test_loads_in_any_order_give_one_history(spark, database, order):
    name, days, done = f"{database}.h", list(LOADS), {}
    for i in order:
        done[days[i]] = LOADS[days[i]]
        load_versions(load(spark, LOADS[days[i]]), name, ["k"], ["v"], days[i], "sk", buckets=3)
        assert versions(spark, name) == plain(done)
    # again, in full and in part, changes nothing
    assert load_versions(load(spark, LOADS[days[1]]), name, ["k"], ["v"], days[1], "sk") == []
    assert load_versions(load(spark, LOADS[days[3]][:1]), name, ["k"], ["v"], days[3], "sk") == []
    # a day that is loaded anew with other attributes
    load_versions(load(spark, [(1, "new"), (9, "Z")]), name, ["k"], ["v"], days[1], "sk")
    again = {**LOADS, days[1]: [(1, "new"), (9, "Z"), *LOADS[days[1]][1:]]}
    assert versions(spark, name) == plain(again)


def test_the_whole_history_at_once(spark):
    rng = random.Random(5)
    loads = {f"2024-{m:02d}-01": [(k, rng.choice("ABC")) for k in range(40) if rng.random() < 0.7] for m in range(1, 13)}
    rows = [(k, v, day) for day, some in loads.items() for k, v in some]
    rng.shuffle(rows)
    whole = scd2_history(spark.createDataFrame(rows, "k int, v string, day string"), ["k"], ["v"], "day", "sk")
    merged = None
    for day, some in loads.items():
        merged = scd2_merge(merged, load(spark, some), ["k"], ["v"], day, "sk")
        merged = spark.createDataFrame(merged.collect(), merged.schema)
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in merged.select(*whole.columns).collect()}
    with pytest.raises(Exception, match="repeated or NULL key"):
        scd2_history(spark.createDataFrame([rows[0], rows[0]], "k int, v string, day string"), ["k"], ["v"], "day").collect()


def places(spark, name):
    return {key: tables.partition_location(spark, name, **values) for key, values in tables.partitions(spark, name).items()}


def test_a_load_writes_what_it_changes(spark, database):
    name = f"{database}.w"
    first = spark.range(400).selectExpr("int(id) AS k", "'a' AS v")
    load_versions(first, name, ["k"], ["v"], "2024-01-01", "sk", buckets=8)
    before = places(spark, name)
    assert len(before) == 8
    moved = first.withColumn("v", F.when(F.col("k") == 17, F.lit("b")).otherwise(F.col("v")))
    written = load_versions(moved, name, ["k"], ["v"], "2024-02-01", "sk")
    assert len(written) == 2 and written[0] == "closed/2024-02-01" and written[1].startswith("open/")
    after = places(spark, name)
    assert sum(after[key] == place for key, place in before.items()) == 7
    assert spark.table(name).count() == 401
    assert load_versions(moved, name, ["k"], ["v"], "2024-03-01", "sk") == []
    assert places(spark, name) == after
    late = moved.where("k = 17").withColumn("v", F.lit("c"))
    assert load_versions(late, name, ["k"], ["v"], "2024-01-15", "sk") == ["closed/2024-01-15", "closed/2024-02-01"]
    rows = read_versions(spark, name).where("k = 17").orderBy("effective_from").collect()
    assert [r["v"] for r in rows] == ["a", "c", "b"]


def test_a_load_that_stops_between_partitions_is_repeated(spark, database, monkeypatch):
    name, days = f"{database}.s", list(LOADS)
    load_versions(load(spark, LOADS[days[0]]), name, ["k"], ["v"], days[0], "sk", buckets=2)
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        point = tables.point_partitions

        def half(session, table, place, written, empty=()):
            point(session, table, place, written[: 1 if table == name else None], ())
            if table == name:
                raise RuntimeError

        m.setattr(histories.tables, "point_partitions", half)
        load_versions(load(spark, LOADS[days[1]]), name, ["k"], ["v"], days[1], "sk")
    load_versions(load(spark, LOADS[days[1]]), name, ["k"], ["v"], days[1], "sk")
    assert versions(spark, name) == plain({d: LOADS[d] for d in days[:2]})


def test_new_columns_and_bad_loads(spark, database):
    name = f"{database}.c"
    load_versions(load(spark, [(1, "A"), (2, "B")]), name, ["k"], ["v"], "2024-01-01", "sk")
    wider = spark.createDataFrame([(1, "A2", "x")], "k int, v string, note string")
    load_versions(wider, name, ["k"], ["v"], "2024-02-01", "sk")
    assert {(r["k"], r["v"], r["note"]) for r in read_versions(spark, name).collect()} == {(1, "A", None), (1, "A2", "x"), (2, "B", None)}
    with pytest.raises(ValueError, match="lacks note"):
        load_versions(load(spark, [(1, "A3")]), name, ["k"], ["v"], "2024-03-01", "sk")
    for bad in ([(1, "A"), (1, "B")], [(None, "A")]):
        with pytest.raises(Exception, match="repeated or NULL key"):
            load_versions(load(spark, bad).withColumn("note", F.lit("n")), name, ["k"], ["v"], "2024-04-01", "sk")
    tables.full_overwrite(load(spark, [(1, "A")]), f"{database}.plain")
    with pytest.raises(ValueError, match="not a table of open and closed"):
        load_versions(load(spark, [(1, "A")]), f"{database}.plain", ["k"], ["v"], "2024-01-01", "sk")
