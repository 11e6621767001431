"""Stores survive lost runs, keep their columns, and know which weeks changed."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import roles as R
from kpiloom.operators import changes
from kpiloom.sources import snapshots
from kpiloom.sources.tables import Tables
from kpiloom.sources.versions import Part, Store, layout_changes
from kpiloom.streaming import weekly
from tests.conftest import rows


class Lost(Exception):
    """The run ends here."""


def lose(monkeypatch, name, times=1):
    """The store's method fails at its n-th call, as if the driver were gone."""
    own, calls = getattr(Store, name), []

    def method(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == times:
            raise Lost
        return own(self, *args, **kwargs)

    monkeypatch.setattr(Store, name, method)


@pytest.fixture
def metric(spark):
    return lambda n: spark.createDataFrame([("x", n)], "k string, n long")


def state(spark, path):
    return {k: rows(snapshots.read_snapshot(spark, path, k)) for k in snapshots.snapshot_keys(spark, path)}


@pytest.mark.parametrize("method", ["stage", "publish"])
def test_a_lost_refresh_leaves_the_old_snapshot(spark, metric, tmp_path, monkeypatch, method):
    path = str(tmp_path / "s")
    snapshots.write_snapshot({"a": metric(1), "b": metric(2), "c": metric(3)}, path)
    before = state(spark, path)
    lose(monkeypatch, method)
    with pytest.raises(Lost):
        snapshots.refresh_snapshot({"a": metric(10), "b": metric(20)}, path)
    assert state(spark, path) == before
    folders = set((Path(path) / "data").iterdir())
    snapshots.refresh_snapshot({"a": metric(10), "b": metric(20)}, path)
    assert state(spark, path) == {"a": [("x", 10)], "b": [("x", 20)], "c": [("x", 3)]}
    left = set((Path(path) / "data").iterdir())
    assert len(left) == 2 and (method == "stage" or len(folders - left) == 1)  # what no pointer named is gone


def test_a_build_lost_between_two_metrics_leaves_the_old_snapshot(spark, metric, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    builders = {k: (lambda n=n: metric(n)) for n, k in enumerate("abc")}
    assert set(snapshots.write_each(builders, path).values()) == {"ok"}
    before = state(spark, path)

    def killed():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        snapshots.write_each({"a": lambda: metric(10), "b": killed, "c": lambda: metric(30)}, path)
    assert state(spark, path) == before


def test_a_half_written_pointer_is_passed_over(spark, metric, tmp_path):
    path = str(tmp_path / "s")
    snapshots.write_snapshot({"a": metric(1)}, path)
    whole = next(p for p in (Path(path) / "pointers").iterdir() if not p.name.endswith(".crc")).read_text()
    (Path(path) / "pointers" / "000000000002").write_text(whole[: len(whole) // 2])
    assert state(spark, path) == {"a": [("x", 1)]}
    snapshots.refresh_snapshot({"a": metric(2)}, path)
    assert state(spark, path) == {"a": [("x", 2)]}


def test_an_open_reader_finishes_after_a_refresh(spark, metric, tmp_path):
    path = str(tmp_path / "s")
    snapshots.write_snapshot({"a": metric(1)}, path)
    opened = snapshots.read_snapshot(spark, path, "a")
    snapshots.refresh_snapshot({"a": metric(2)}, path)
    assert rows(opened) == [("x", 1)] and state(spark, path) == {"a": [("x", 2)]}
    for n in range(4):
        snapshots.refresh_snapshot({"a": metric(n)}, path)
    assert len(list((Path(path) / "data").iterdir())) <= 3


def test_two_writers(spark, metric, tmp_path):
    path = str(tmp_path / "s")
    first, second = Store(spark, path), Store(spark, path)
    staged = first.stage(metric(1), F.col("k"), ["x"])
    second.publish(second.stage(metric(2), F.col("k"), ["x"]))  # drops what the first one has staged
    with pytest.raises(ValueError, match="another refresh"):
        first.publish(staged)
    assert rows(Store(spark, path).read("x")) == [("x", 2)]
    with pytest.raises(ValueError, match="other keys"):
        first.stage(metric(1), F.col("k"), ["y"])


def test_columns_belong_to_the_stored_result(spark, metric, tmp_path):
    path = str(tmp_path / "s")
    kinds = "s string, n long, d decimal(9,2), day date, at timestamp, l array<struct<a:int,b:string>>, m map<string,double>, `odd name.x` int"
    given = spark.createDataFrame([("x", 5, None, date(2026, 1, 2), None, [(1, "y")], {"k": 1.5}, 7)], kinds)
    snapshots.write_snapshot({"a": given, "b": metric(1), "none": given.limit(0)}, path)
    back = snapshots.read_snapshot(spark, path, "a")
    assert back.dtypes == snapshots.json_native(given).dtypes and back.collect() == snapshots.json_native(given).collect()
    assert snapshots.read_snapshot(spark, path, "none").dtypes == back.dtypes
    assert rows(snapshots.read_snapshot(spark, path, "b")) == [("x", 1)]
    with pytest.raises(ValueError, match=r"b\.n: bigint became string; b\.more: new|b\.more: new; b\.n: bigint became string"):
        snapshots.refresh_snapshot({"b": spark.createDataFrame([("x", "1", 2)], "k string, n string, more int")}, path)
    with pytest.raises(ValueError, match=r"b\.k: gone"):
        snapshots.refresh_snapshot({"b": metric(1).drop("k")}, path)
    assert rows(snapshots.read_snapshot(spark, path, "b")) == [("x", 1)]
    snapshots.refresh_snapshot({"b": metric(1).drop("k")}, path, new_layout=True)
    assert snapshots.read_snapshot(spark, path, "b").columns == ["n"]
    assert layout_changes(given.schema, given.select("n", "s", *given.columns[2:-1], "`odd name.x`").schema) == []


def test_a_failed_metric_keeps_its_columns_and_its_error(spark, metric, tmp_path):
    path = str(tmp_path / "s")
    snapshots.write_snapshot({"a": metric(1)}, path)
    status = snapshots.write_each({"a": lambda: metric(1).select("absent"), "new": lambda: 1 / 0}, path)
    assert snapshots.read_snapshot(spark, path, "a").dtypes == metric(1).dtypes and state(spark, path)["a"] == []
    assert Store(spark, path).parts()["new"] == Part(None, None, {"error": status["new"]})


@pytest.fixture(scope="module")
def tables(spark):
    return R.roles(spark, "/root/testdata/sf0.001")


def test_a_lost_weekly_refresh_leaves_the_old_weeks(spark, tables, tmp_path, monkeypatch):
    from dataclasses import replace

    path = str(tmp_path / "w")
    weekly.refresh(spark, tables, replace(R.CLICKS, as_of=date(2024, 1, 20)), path)
    before = rows(weekly.stored(spark, path))
    for method in ("stage", "publish"):
        with monkeypatch.context() as m:
            lose(m, method)
            with pytest.raises(Lost):
                weekly.refresh(spark, tables, R.CLICKS, path, recompute=2)
        assert rows(weekly.stored(spark, path)) == before
    assert weekly.refresh(spark, tables, R.CLICKS, path)
    assert len(Store(spark, path).parts()) == 3


def test_weeks_of_other_columns_are_refused(spark, tables, tmp_path):
    path = str(tmp_path / "w")
    weekly.refresh(spark, tables, R.CLICKS, path)
    other = weekly.stored(spark, path).withColumn("visits", F.col("visits").cast("string"))
    with pytest.raises(ValueError, match="visits: bigint became string"):
        snapshots.refresh_weeks(Store(spark, path), other, [date(2024, 1, 5)])


def test_a_late_row_in_an_old_week_is_found_and_only_that_week_is_computed(spark, tables, tmp_path, monkeypatch):
    path = str(tmp_path / "w")
    late = (F.col("date").between("2024-01-05", "2024-01-11")) & (F.xxhash64("visit") % 3 == 0)
    early = Tables(lambda role: tables.traffic.where(~late) if role == "traffic" else getattr(tables, role))
    computed = []
    own = weekly.increment
    monkeypatch.setattr(weekly, "increment", lambda t, s, weeks: computed.append(list(weeks)) or own(t, s, weeks))
    assert weekly.refresh(spark, early, R.CLICKS, path, changed=True)
    assert not weekly.refresh(spark, early, R.CLICKS, path, changed=True)
    assert not weekly.refresh(spark, tables, R.CLICKS, path)  # unseen without marks
    assert weekly.refresh(spark, tables, R.CLICKS, path, changed=True)
    assert computed == [[date(2024, 1, 5), date(2024, 1, 12), date(2024, 1, 19)], [date(2024, 1, 5)]]
    fresh = str(tmp_path / "fresh")
    weekly.refresh(spark, tables, R.CLICKS, fresh)
    assert rows(weekly.stored(spark, path)) == rows(weekly.stored(spark, fresh))
    assert weekly.refresh(spark, tables, R.CLICKS, fresh, changed=True)  # stored without marks: all again
    assert not weekly.refresh(spark, tables, R.CLICKS, fresh, changed=True)


def test_marks_do_not_depend_on_order_and_count_copies(spark):
    given = spark.createDataFrame([(1, "a", {"x": [1]}), (1, "b", None), (2, None, {}), (2, None, {})], "p int, s string, m map<string,array<int>>")
    marks = {r.period: (r.n, r.mark) for r in changes.period_marks(given, F.col("p"), ["s", "m"]).collect()}
    again = {r.period: (r.n, r.mark) for r in changes.period_marks(given.orderBy(F.desc("s")).repartition(3), F.col("p"), ["s", "m"]).collect()}
    assert marks == again
    fewer = {r.period: (r.n, r.mark) for r in changes.period_marks(given.limit(3), F.col("p"), ["s", "m"]).collect()}
    assert fewer[2] != marks[2] and fewer[1] == marks[1]
    assert json.loads(json.dumps([1, str(marks[1][1])])) == [1, str(marks[1][1])]
