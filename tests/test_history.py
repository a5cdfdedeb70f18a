from datetime import date

import pytest

from siltstone.operators.history import scd1_merge, scd2_merge, snapshot_diff

KEYS, TRACKED = ["location_id"], ["zone", "service_zone"]
SCHEMA = "location_id int, zone string, service_zone string"


def load(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def merge(target, incoming, day, **more):
    return scd2_merge(target, incoming, KEYS, TRACKED, day, **more)


def rows(df):
    names = ["location_id", "zone", "service_zone", "effective_from", "effective_to", "is_current"]
    return sorted(tuple(r) for r in df.select(*names).collect())


LOW, HIGH = date(1900, 1, 1), date(9999, 12, 31)


def test_three_loads(spark):
    first = merge(None, load(spark, (142, "East", "y")), "2024-01-01")
    same = merge(first, load(spark, (142, "East", "y")), "2024-02-01")
    assert rows(same) == rows(first) == [(142, "East", "y", LOW, HIGH, True)]
    renamed = merge(same, load(spark, (142, "West", "y")), "2024-03-01")
    assert rows(renamed) == [
        (142, "East", "y", LOW, date(2024, 2, 29), False),
        (142, "West", "y", date(2024, 3, 1), HIGH, True),
    ]
    assert renamed.select("location_key").distinct().count() == 2
    again = merge(renamed, load(spark, (142, "West", "y")), "2024-03-01")
    assert rows(again) == rows(renamed)


def test_members_come_stay_and_keep_their_key(spark):
    first = merge(None, load(spark, (1, "A", "y"), (2, "B", "y")), "2024-01-01")
    second = merge(first, load(spark, (2, "B2", "y"), (3, "C", "y")), "2024-02-01")
    assert rows(second) == [
        (1, "A", "y", LOW, HIGH, True),
        (2, "B", "y", LOW, date(2024, 1, 31), False),
        (2, "B2", "y", date(2024, 2, 1), HIGH, True),
        (3, "C", "y", LOW, HIGH, True),
    ]
    key = {(r["location_id"], r["effective_from"]): r["location_key"] for r in first.collect()}
    for r in second.where("effective_from = date'1900-01-01' AND location_id < 3").collect():
        assert key[(r["location_id"], r["effective_from"])] == r["location_key"]


def test_first_version_may_start_on_the_load_date(spark):
    first = merge(None, load(spark, (1, "A", "y")), "2024-01-01", open_from=None)
    assert rows(first)[0][3] == date(2024, 1, 1)


def test_change_on_the_same_day_replaces(spark):
    first = merge(None, load(spark, (1, "A", "y")), "2024-01-01", open_from=None)
    fixed = merge(first, load(spark, (1, "B", "y")), "2024-01-01", open_from=None)
    assert rows(fixed) == [(1, "B", "y", date(2024, 1, 1), HIGH, True)]
    assert fixed.first()["location_key"] == first.first()["location_key"]


def test_earlier_change_is_refused(spark):
    first = merge(None, load(spark, (1, "A", "y")), "2024-01-01")
    second = merge(first, load(spark, (1, "B", "y")), "2024-03-01")
    with pytest.raises(Exception, match="precedes the current version"):
        merge(second, load(spark, (1, "C", "y")), "2024-02-01").collect()
    assert rows(merge(second, load(spark, (1, "B", "y")), "2024-02-01")) == rows(second)


@pytest.mark.parametrize("bad", [[(1, "A", "y"), (1, "B", "y")], [(None, "A", "y")]])
def test_bad_keys_are_refused(spark, bad):
    with pytest.raises(Exception, match="repeated or NULL key"):
        merge(None, load(spark, *bad), "2024-01-01").collect()


def test_null_and_blank_differ(spark):
    first = merge(None, load(spark, (1, "A", None)), "2024-01-01")
    assert merge(first, load(spark, (1, "A", None)), "2024-02-01").count() == 1
    assert merge(first, load(spark, (1, "A", "")), "2024-02-01").count() == 2


def test_scd1(spark):
    target = load(spark, (1, "A", "y"), (2, "B", "y"))
    out = scd1_merge(target, load(spark, (2, "B2", None), (3, "C", "y")), KEYS)
    assert {tuple(r) for r in out.collect()} == {(1, "A", "y"), (2, "B2", None), (3, "C", "y")}
    with pytest.raises(Exception, match="repeated or NULL key"):
        scd1_merge(target, load(spark, (2, "x", "y"), (2, "z", "y")), KEYS).collect()


def test_snapshot_diff(spark):
    old = load(spark, (1, "A", "y"), (2, "B", None), (3, "C", "y"), (4, "x", None))
    new = load(spark, (1, "A", "y"), (2, "B2", None), (5, "E", "y"), (4, None, "x"))
    found = {tuple(r) for r in snapshot_diff(old, new, KEYS).collect()}
    assert found == {(2, "changed"), (3, "removed"), (5, "added"), (4, "changed")}
    assert snapshot_diff(old, old, KEYS).count() == 0


def test_snapshot_diff_counts_copies(spark):
    old = load(spark, (1, "A", "y"), (1, "B", "y"))
    assert snapshot_diff(old, load(spark, (1, "B", "y"), (1, "A", "y")), KEYS).count() == 0
    assert snapshot_diff(old, load(spark, (1, "A", "y"), (1, "A", "y")), KEYS).first()["change"] == "changed"
    assert snapshot_diff(old, load(spark, (1, "A", "y")), KEYS).first()["change"] == "changed"
