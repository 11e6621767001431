from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpiloom.plans import registry
from kpiloom.sources import snapshots
from kpiloom.sources.tables import Tables, conform, open_tables, read_sheet
from kpiloom.streaming import weekly
from tests.conftest import d, rows


@pytest.fixture
def results(spark):
    return {
        "kr11": spark.createDataFrame([("2026-10", Decimal("1.50"), d("2026-10-05")), ("2026-11", None, None)], "mes string, gb decimal(10,2), w date"),
        "kr21": spark.createDataFrame([(7375, 98.3)], "n long, pct double"),
    }


def test_refresh_replaces_only_the_given_metric(spark, results, tmp_path):
    path = str(tmp_path / "snapshot")
    snapshots.write_snapshot(results, path)
    assert rows(snapshots.read_snapshot(spark, path, "kr11")) == [("2026-10", 1.5, "2026-10-05"), ("2026-11", None, None)]
    snapshots.refresh_snapshot({"kr21": spark.createDataFrame([(7419, 96.1)], "n long, pct double")}, path)
    assert rows(snapshots.read_snapshot(spark, path, "kr21")) == [(7419, 96.1)]
    assert snapshots.read_snapshot(spark, path, "kr11").count() == 2
    snapshots.write_snapshot({"kr21": results["kr21"]}, path)
    assert snapshots.snapshot_keys(spark, path) == ["kr21"]
    with pytest.raises(KeyError, match="kr11"):
        snapshots.read_snapshot(spark, path, "kr11")


def test_failing_metric_is_left_empty(spark, results, tmp_path):
    path = str(tmp_path / "snapshot")

    def broken():
        return results["kr11"].select("absent")

    status = snapshots.write_each({"bad": broken, "kr21": lambda: results["kr21"]}, path)
    assert status["kr21"] == "ok" and "AnalysisException" in status["bad"]
    assert snapshots.read_snapshot(spark, path, "bad").count() == 0
    assert rows(snapshots.read_snapshot(spark, path, "kr21")) == [(7375, 98.3)]


def test_null_numbers_become_zero_on_request(spark):
    df = spark.createDataFrame([(None, Decimal("2.5"), None)], "n long, gb decimal(9,2), s string")
    assert rows(snapshots.json_native(df, zero_nulls=True)) == [(0, 2.5, None)]


def test_upsert_replaces_and_appends_weeks(spark):
    schema = "product string, country string, week_start date, visits long"
    store = spark.createDataFrame([("H", "AR", d("2026-08-28"), 1), ("H", "BR", d("2026-09-04"), 2)], schema)
    new = spark.createDataFrame([("H", "AR", d("2026-09-04"), 9), ("V", "PE", d("2026-09-11"), 4)], schema)
    assert rows(snapshots.upsert_weeks(store, new)) == [("H", "AR", d("2026-08-28"), 1), ("H", "AR", d("2026-09-04"), 9), ("V", "PE", d("2026-09-11"), 4)]


def test_retention_keeps_26_of_27_weeks(spark):
    store = spark.range(54).select(F.date_add(F.lit(d("2026-01-02")), (F.col("id") % 27 * 7).cast("int")).alias("week_start"), "id")
    kept = snapshots.retain_last(store)
    assert kept.select("week_start").distinct().count() == 26 and kept.agg(F.min("week_start")).first()[0] == d("2026-01-09")
    assert tuple(snapshots.week_window(kept).first()) == (26, d("2026-01-09"), d("2026-01-02") + timedelta(days=26 * 7 + 6))


def test_every_product_and_country_has_a_row(spark):
    rows_ = spark.createDataFrame([("H", "AR", d("2026-08-28"), 5, "price", 2, 1)], "product string, country string, week_start date, visits long, filter_name string, clicks long, thanks long")
    got = snapshots.zero_filled(rows_, ["H", "V"], ["AR", "OT"])
    assert {(r.product, r.country): r.visits for r in got.collect()} == {("H", "AR"): 5, ("H", "OT"): 0, ("V", "AR"): 0, ("V", "OT"): 0}


def test_cadences_cover_all_second_half_metrics():
    assert sorted(registry.keys_of("todo")) == sorted(registry.SECOND_HALF) == sorted(registry.keys_of("auto"))
    assert registry.keys_of("semanal") == ["kr21_sem", "kr22_sem"]


def test_second_half_refresh_end_to_end(spark, tmp_path):
    from checks import roles as R

    path = str(tmp_path / "board")
    registry.refresh("mensual", R.roles(spark, "/root/testdata/sf0.001"), R.SECOND, path)
    registry.refresh("semanal", R.roles(spark, "/root/testdata/sf0.001"), R.SECOND, path)
    assert set(snapshots.snapshot_keys(spark, path)) == {"kr11", "kr21", "kr22", "kr21_sem", "kr22_sem"}
    monthly = {r.mes: r.agencias_cotizadoras for r in snapshots.read_snapshot(spark, path, "kr21").collect()}
    last = {}
    for r in snapshots.read_snapshot(spark, path, "kr21_sem").collect():
        last[r.mes] = max(last.get(r.mes, ("", 0)), (r.semana_inicio, r.agencias_acum_mes))
    assert last and all(monthly[mes] == n for mes, (_, n) in last.items())


def test_weekly_store_is_brought_up_to_date(spark, tmp_path):
    from dataclasses import replace

    from checks import roles as R

    path, tables = str(tmp_path / "weeks"), R.roles(spark, "/root/testdata/sf0.01")
    early = replace(R.CLICKS, as_of=date(2024, 1, 20))
    assert weekly.refresh(spark, tables, early, path)
    assert {r.week_start for r in weekly.stored(spark, path).collect()} == {date(2024, 1, 5), date(2024, 1, 12)}
    assert not weekly.refresh(spark, tables, early, path)
    assert weekly.refresh(spark, tables, R.CLICKS, path)
    stored = weekly.current(spark, path)
    assert {r.week_start for r in stored.collect()} == {date(2024, 1, 5), date(2024, 1, 12), date(2024, 1, 19)}
    before = rows(stored.select(sorted(stored.columns)))
    assert weekly.refresh(spark, tables, R.CLICKS, path, recompute=2)
    after = weekly.current(spark, path)
    assert rows(after.select(sorted(after.columns))) == before


def test_tables_conform_to_their_role(spark, tmp_path):
    path = str(tmp_path / "cancel")
    spark.createDataFrame([("R1", 5, "TIMEOUT_CLIENT")], "reservation_id string, extra int, type string").write.parquet(path)
    assert open_tables(spark, {"cancellations": path}).cancellations.columns == ["reservation_id", "type"]
    with pytest.raises(ValueError, match="lacks"):
        conform(spark.read.parquet(path), "deferred")
    junk = conform(spark.createDataFrame([("12", "x", "10")], "product_id string, transaction_code string, net_revenues_usd string")
                   .withColumns({"affiliates_usd": F.lit(1.5), "line_of_business": F.lit("B2B"), "date_reservation_year_month": F.lit("2026-01")}), "profit").first()
    assert junk.product_id == 12 and junk.transaction_code is None
    with pytest.raises(KeyError):
        Tables(lambda name: {}[name]).sales


def test_text_sheets_stay_text(spark, tmp_path):
    file = tmp_path / "sheet.csv"
    file.write_text("fecha,no_mes_proyectado,producto,pais,lob_canal,net_revenue\n5/3/2026,3,Hotels,Mexico,B2B-MIN,10.5\n")
    sheet = read_sheet(spark, str(file))
    assert dict(sheet.dtypes) == {c: "string" for c in sheet.columns} and sheet.first().net_revenue == "10.5"


def test_report_order(spark):
    df = spark.createDataFrame([("2026-11", 1), ("2026-10", 2)], "mes string, n int")
    assert [r.mes for r in registry.ordered("h2.kr11_prog", df).collect()] == ["2026-10", "2026-11"]
    assert registry.ordered("pp_m", df) is df
    assert all(k.removeprefix("h1.") in registry.FIRST_HALF for k in registry.ORDER if k.startswith("h1."))


def test_shared_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    from kpiloom.session import scratch_path, shared_folder

    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))


def test_refresh_with_no_rows_leaves_none(spark, results, tmp_path):
    path = str(tmp_path / "snapshot")
    snapshots.write_snapshot(results, path)
    snapshots.refresh_snapshot({"kr21": results["kr21"].limit(0)}, path)
    assert snapshots.read_snapshot(spark, path, "kr21").count() == 0
    assert snapshots.read_snapshot(spark, path, "kr11").count() == 2
    with pytest.raises(Exception, match="absent|DIVIDE"):
        broken = results["kr21"].select((F.lit(1) / (F.col("n") - F.col("n"))).cast("long").alias("n"), "pct")
        snapshots.refresh_snapshot({"kr11": results["kr11"].limit(0), "kr21": broken}, path)
    assert snapshots.read_snapshot(spark, path, "kr11").count() == 2


def test_errors_are_kept_whole_and_in_other_threads(spark, results, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def broken():
        raise ValueError("x" * 1000)

    with ThreadPoolExecutor(1) as pool:
        status = pool.submit(snapshots.write_each, {"bad": broken, "kr21": lambda: results["kr21"]}, str(tmp_path / "s")).result()
    assert status == {"bad": f"ValueError: {'x' * 1000}", "kr21": "ok"}


def test_weekly_store_keeps_empty_weeks_and_drops_old_ones(spark, tmp_path, monkeypatch):
    from dataclasses import replace

    from checks import roles as R

    path, tables = str(tmp_path / "weeks"), R.roles(spark, "/root/testdata/sf0.001")
    empty = Tables(lambda role: getattr(tables, role).limit(0))
    pairs = len(weekly.PRODUCTS) * len(weekly.COUNTRIES)
    assert weekly.refresh(spark, empty, R.CLICKS, path)
    stored = weekly.current(spark, path)
    assert stored.count() == 3 * pairs and stored.agg(F.sum("visits")).first()[0] == 0
    assert not weekly.refresh(spark, tables, R.CLICKS, path)  # an empty week is known
    assert weekly.refresh(spark, tables, R.CLICKS, path, recompute=1)
    full = {r.week_start: r.n for r in weekly.current(spark, path).groupBy("week_start").agg(F.sum("visits").alias("n")).collect()}
    assert full[date(2024, 1, 5)] == full[date(2024, 1, 12)] == 0 < full[date(2024, 1, 19)]
    assert weekly.refresh(spark, empty, R.CLICKS, path, recompute=1)  # a week that became empty is replaced
    assert weekly.current(spark, path).agg(F.sum("visits")).first()[0] == 0
    monkeypatch.setattr(snapshots.refresh_weeks, "__defaults__", (None, 2, "week_start"))
    monkeypatch.setattr(weekly.closed_weeks, "__defaults__", (2,))
    later = replace(R.CLICKS, as_of=date(2024, 2, 3))
    assert weekly.refresh(spark, tables, later, path)
    assert {r.week_start for r in weekly.stored(spark, path).collect()} == {date(2024, 1, 19), date(2024, 1, 26)}
    assert not weekly.refresh(spark, tables, later, path)
