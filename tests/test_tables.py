import pytest
from pyspark.sql import functions as F

from siltstone.sources import tables
from siltstone.sources.workspace import shared_folder, stage


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, load_month string")


def content(spark, table):
    return sorted((r["id"], r["load_month"]) for r in spark.table(table).collect())


@pytest.fixture()
def table(spark, database):
    name = f"{database}.t"
    tables.replace_partitions(
        rows(spark, (1, "2024-01"), (2, "2024-01"), (3, "2024-02")), name, ["2024-01", "2024-02"]
    )
    return name


@pytest.mark.parametrize("rebalance", [True, False])
def test_reload_touches_only_its_month(spark, table, rebalance):
    for _ in range(3):
        n = tables.replace_partitions(rows(spark, (1, "2024-01")), table, ["2024-01"], rebalance=rebalance)
        assert n == 1
    assert content(spark, table) == [(1, "2024-01"), (3, "2024-02")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_reload_with_nothing_empties_the_month(spark, table):
    assert tables.replace_partitions(rows(spark), table, ["2024-01"]) == 0
    assert content(spark, table) == [(3, "2024-02")]


@pytest.mark.parametrize("stray", ["2024-02", None])
def test_row_outside_the_scope_fails_before_anything_changes(spark, table, stray):
    before = content(spark, table)
    with pytest.raises(Exception, match="row outside the replaced partitions"):
        tables.replace_partitions(rows(spark, (9, "2024-01"), (8, stray)), table, ["2024-01"])
    assert content(spark, table) == before


def test_a_month_read_from_a_larger_table_is_in_scope(spark, table, database):
    """The month filter of the input must hold before the scope is checked."""
    copy = f"{database}.copy"
    part = spark.table(table).where(F.col("load_month").isin("2024-02"))
    assert tables.replace_partitions(part, copy, ["2024-02"], rebalance=False) == 1
    joined = spark.table(table).where("load_month = '2024-01'").join(spark.range(5).toDF("id"), "id")
    assert tables.replace_partitions(joined, copy, ["2024-01"], rebalance=False) == 2
    assert content(spark, copy) == content(spark, table)


def test_a_table_may_be_rewritten_from_itself(spark, table):
    part = spark.table(table).where("load_month = '2024-01'").withColumn("id", F.col("id") + 10)
    tables.replace_partitions(part, table, ["2024-01"])
    assert content(spark, table) == [(3, "2024-02"), (11, "2024-01"), (12, "2024-01")]


def test_columns_are_matched_by_name(spark, table):
    swapped = spark.createDataFrame([("2024-01", 7)], "load_month string, id int")
    tables.replace_partitions(swapped, table, ["2024-01"])
    assert content(spark, table) == [(3, "2024-02"), (7, "2024-01")]


def test_clustered_rewrite_keeps_the_rows_and_sorts_them(spark, database):
    name = f"{database}.c"
    df = spark.range(2000).selectExpr(
        "int(id) AS id", "int(id * 7919 % 13) AS place", "concat('2024-0', 1 + id % 2) AS load_month"
    )
    months = ["2024-01", "2024-02"]
    tables.replace_partitions(df.repartition(6), name, months)
    before = {tuple(r) for r in spark.table(name).collect()}
    tables.clustered_rewrite(spark, name, ["place"], ["2024-01"])
    assert {tuple(r) for r in spark.table(name).collect()} == before
    files = (
        spark.table(name)
        .where("load_month = '2024-01'")
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("place").alias("low"), F.max("place").alias("high"))
        .orderBy("low", "high")
        .collect()
    )
    for left, right in zip(files, files[1:]):
        assert left["high"] <= right["low"]


def test_one_frequent_place_is_divided(spark):
    df = spark.range(4000).selectExpr("id", "1 AS place", "'2024-01' AS load_month")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = tables.cluster_rows(df, ["place"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2000


def test_full_overwrite_from_itself_and_failed_overwrite(spark, database):
    name = f"{database}.o"
    tables.full_overwrite(spark.range(3).toDF("id"), name, "it's small")
    tables.full_overwrite(spark.table(name).where("id > 0"), name)
    assert spark.table(name).count() == 2
    with pytest.raises(Exception):
        tables.full_overwrite(spark.table(name).selectExpr("raise_error('no') AS id"), name)
    assert spark.table(name).count() == 2


def test_append(spark, database):
    name = f"{database}.a"
    tables.append(rows(spark, (1, "a")), name, ["load_month"])
    tables.append(rows(spark, (2, "b")), name, ["load_month"])
    assert content(spark, name) == [(1, "a"), (2, "b")]


def test_upserts_on_tables(spark, database):
    one, two = f"{database}.one", f"{database}.two"
    first = spark.createDataFrame([(1, "A"), (2, "B")], "k int, v string")
    later = spark.createDataFrame([(2, "B2"), (3, "C")], "k int, v string")
    for load in (first, later, later):
        tables.upsert_scd1(load, one, ["k"])
    assert {tuple(r) for r in spark.table(one).collect()} == {(1, "A"), (2, "B2"), (3, "C")}
    for day, load in (("2024-01-01", first), ("2024-02-01", later), ("2024-02-01", later)):
        tables.upsert_scd2(load, two, ["k"], ["v"], day, "sk")
    assert spark.table(two).count() == 4 and spark.table(two).where("is_current").count() == 3


def test_staging_uses_the_folder_the_cluster_names(spark):
    staged = stage(spark.range(3), "x")
    assert all(shared_folder(spark) in path for path in staged.inputFiles())
    assert staged.count() == 3


def test_a_new_column_widens_the_table_and_others_raise(spark, table):
    wider = spark.createDataFrame([(9, "2024-02", 2.5)], "id int, load_month string, fee double")
    assert tables.replace_partitions(wider, table, ["2024-02"]) == 1
    assert {tuple(r) for r in spark.table(table).select("id", "fee", "load_month").collect()} == {
        (1, None, "2024-01"), (2, None, "2024-01"), (9, 2.5, "2024-02"),
    }
    with pytest.raises(ValueError, match="fee is missing"):
        tables.replace_partitions(rows(spark, (1, "2024-01")), table, ["2024-01"])
    with pytest.raises(ValueError, match="fee is string, not double"):
        tables.replace_partitions(wider.withColumn("fee", F.lit("x")), table, ["2024-02"])
    assert spark.table(table).count() == 3


def test_overwrite_that_fails_while_writing_leaves_the_old_content(spark, database):
    name = f"{database}.w"
    tables.full_overwrite(spark.range(3).toDF("id"), name, "kept")
    place = spark.table(name).inputFiles()[0]
    late = F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("late")).cast("bigint"))
    with pytest.raises(Exception, match="late"):
        tables.full_overwrite(spark.range(0, 100, 1, 4).select(late.alias("id")), name)
    assert spark.table(name).count() == 3 and spark.table(name).inputFiles()[0] == place


def test_overwrite_with_other_columns_keeps_the_comment(spark, database):
    name = f"{database}.x"
    tables.full_overwrite(spark.range(3).toDF("id"), name, "it's kept")
    tables.full_overwrite(spark.table(name).withColumn("more", F.lit("m")), name)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 3
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert told["Comment"] == "it's kept"
    assert [t.name for t in spark.catalog.listTables(database)] == ["x"]


def test_upserts_keep_columns_they_do_not_know(spark, database):
    one, two = f"{database}.u1", f"{database}.u2"
    first = spark.createDataFrame([(1, "A"), (2, "B")], "k int, v string")
    wider = spark.createDataFrame([(2, "B", 7)], "k int, v string, extra int")
    for load in (first, wider):
        tables.upsert_scd1(load, one, ["k"])
    assert {tuple(r) for r in spark.table(one).select("k", "v", "extra").collect()} == {(1, "A", None), (2, "B", 7)}
    with pytest.raises(ValueError, match="lacks extra"):
        tables.upsert_scd1(first, one, ["k"])
    tables.upsert_scd2(first.withColumn("note", F.lit("n")), two, ["k"], ["v"], "2024-01-01", "sk")
    changed = spark.createDataFrame([(2, "B2", "m")], "k int, v string, note string")
    tables.upsert_scd2(changed, two, ["k"], ["v"], "2024-02-01", "sk")
    assert {tuple(r) for r in spark.table(two).select("k", "v", "note").collect()} == {(1, "A", "n"), (2, "B", "n"), (2, "B2", "m")}


def test_a_reader_that_has_begun_goes_on_and_vacuum_takes_what_is_left(spark, table):
    begun = spark.read.parquet(tables.partition_location(spark, table, load_month="2024-01"))
    old = begun.inputFiles()
    tables.replace_partitions(rows(spark, (5, "2024-01")), table, ["2024-01"])
    assert sorted(r["id"] for r in begun.collect()) == [1, 2]
    assert content(spark, table) == [(3, "2024-02"), (5, "2024-01")]
    assert tables.vacuum(spark, table) == []  # February is still read from the first load
    tables.replace_partitions(rows(spark, (6, "2024-02")), table, ["2024-02"])
    kept = tables.vacuum(spark, table, keep=[old[0].rpartition("/")[0]])
    assert kept == [] and len(tables.vacuum(spark, table)) == 1
    assert content(spark, table) == [(5, "2024-01"), (6, "2024-02")]
    assert tables.vacuum(spark, table) == []


def test_a_refused_load_leaves_no_column_behind(spark, table):
    stray = spark.createDataFrame([(9, "2024-07", 2.5)], "id int, load_month string, fee double")
    with pytest.raises(Exception, match="row outside"):
        tables.replace_partitions(stray, table, ["2024-01"])
    assert spark.table(table).columns == ["id", "load_month"]
    assert content(spark, table) == [(1, "2024-01"), (2, "2024-01"), (3, "2024-02")]


def test_odd_partition_values(spark, table):
    odd = ["a b", "x=y/z", "it's", "50%", "1:2", "[q]"]
    tables.replace_partitions(rows(spark, *[(i, v) for i, v in enumerate(odd)]), table, odd)
    tables.replace_partitions(rows(spark, (7, "it's")), table, ["it's", "x=y/z"])
    assert {(7, "it's"), (3, "50%"), (0, "a b")} < set(content(spark, table))
    assert len(content(spark, table)) == 3 + 5


def test_every_column_of_a_layout_skips(spark, database):
    name = f"{database}.z"
    df = spark.range(8000).selectExpr(
        "int(id * 7919 % 1000) AS a", "concat('n', lpad(string(id * 104729 % 997), 4, '0')) AS b",
        "date_add(date'2024-01-01', int(id * 31 % 365)) AS c", "IF(id % 10 = 0, NULL, id % 3 = 0) AS d", "'2024-01' AS load_month",
    )
    tables.replace_partitions(df, name, ["2024-01"])
    tables.clustered_rewrite(spark, name, ["a", "b"], ["2024-01"], files=16)
    bounds = spark.table(name).groupBy(F.input_file_name()).agg(*[F.struct(F.min(c), F.max(c)).alias(c) for c in ("a", "b")]).collect()
    assert len(bounds) == 16
    for column, value in (("a", 100), ("a", 871), ("b", "n0100"), ("b", "n0900")):
        assert sum(r[column][0] <= value <= r[column][1] for r in bounds) <= 16 // 3
    tables.clustered_rewrite(spark, name, ["b", "c", "d"], ["2024-01"], files=4)
    assert {tuple(r) for r in spark.table(name).select(*df.columns).collect()} == {tuple(r) for r in df.collect()}


def test_ranks_and_hot_values(spark):
    from siltstone.sources.tables import _rank

    values = [None, -5.0, 0.0, 1.0, 2.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(_rank(F.col("v"), [0.0, 1.0, 2.0])).collect()] == [0, 0, 1, 2, 3, 3]
    hot = spark.range(6000).selectExpr("id", "IF(id % 3 = 0, id, 7) AS a", "IF(id % 2 = 0, id, 1) AS b", "'m' AS load_month")
    parts = tables.cluster_rows(hot, ["a", "b"], files=8).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 2 * 6000 / 8
    nothing = spark.createDataFrame([], "a int, b string, load_month string")
    assert tables.cluster_rows(nothing, ["a", "b"]).count() == 0
    same = spark.range(100).selectExpr("id % 50 AS a", "1 AS b", "'x' AS c", "id % 7 AS d", "'m' AS load_month")
    assert tables.cluster_rows(same, ["a", "b"]).count() == tables.cluster_rows(same, ["b", "c"]).count() == 100
    assert tables.cluster_rows(same, ["c", "d", "b", "a"]).distinct().count() == same.distinct().count()


@pytest.mark.parametrize("count", [2, 3])
def test_the_curve_goes_from_neighbour_to_neighbour(spark, count):
    """Every cell once, and one step of one column at a time."""
    side = 2**tables.RANK_BITS if count == 2 else 8
    names, axes = [f"c{i}" for i in range(count)], [f"x{i}" for i in range(count)]
    cells = spark.range(side**count).select(*[F.expr(f"int(floor(id / {side**i}) % {side})").alias(n) for i, n in enumerate(names)])
    placed = tables.hilbert(cells.withColumns({a: F.col(n) for a, n in zip(axes, names)}), axes, "place")
    rows = placed.orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(side**count))
    assert {sum(abs(a[n] - b[n]) for n in names) for a, b in zip(rows, rows[1:])} == {1}
