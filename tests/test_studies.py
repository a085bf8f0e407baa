import json

from barloom.operators import studies
from barloom.sources import sinks, tables


def test_daily_files_are_written_once(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = lambda v, *days: spark.createDataFrame([("A", f"2024-01-0{d} 10:00:00", v) for d in days], "symbol string, t string, close double").selectExpr("symbol", "to_timestamp_ntz(t) AS open_time", "close")
    sinks.write_daily_files(rows(1.0, 1, 2), path, "5m")
    sinks.write_daily_files(rows(2.0, 2, 3), path, "5m")
    found = spark.read.parquet(path)
    assert sorted((r.date.day, r.interval, r.close) for r in found.collect()) == [(1, "5m", 1.0), (2, "5m", 1.0), (3, "5m", 2.0)]
    assert len(list((tmp_path / "days" / "symbol=A" / "interval=5m").glob("date=*"))) == 3


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1.5), (None, None)], "symbol string, score double")
    for kind in ("csv", "json", "csv"):
        sinks.write_report(rows, str(tmp_path / kind), kind)
    [file] = (tmp_path / "csv").glob("*.csv")
    lines = file.read_text().splitlines()
    assert lines[0] == "symbol,score" and "A,1.5" in lines and len(lines) == 3
    [file] = (tmp_path / "json").glob("*.json")
    assert {"symbol": None, "score": None} in [json.loads(line) for line in file.read_text().splitlines()]


def test_available_datasets(spark, tmp_path):
    for name in ("2023/BTC_2023", "2023/BTC_2023_months_01_02", "2023/quality_report", "2024/A_B_2024", "other/X_2024", "2024/plain"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.parquet").touch()
    assert tables.available_datasets(spark, str(tmp_path)) == [("BTC", 2023), ("A_B", 2024)]
    assert tables.available_datasets(spark, str(tmp_path / "none")) == []


def test_store_scans(spark):
    store = spark.createDataFrame([("A", "2024-01", "2024-01-01 00:00:00"), ("A", "2024-02", "2024-02-01 00:00:00"), ("B", "2024-01", "2024-01-02 00:00:00"), (None, None, None)], "symbol string, period string, t string")
    assert tables.of_period(store, "A", "2024-01").count() == 1 and tables.of_period(store, "A").count() == 2 and tables.of_period(store).count() == 4
    timed = store.selectExpr("symbol", "to_timestamp_ntz(t) AS funding_time")
    assert tables.positioning_between(timed, "A", "2024-01-01", "2024-02-01").count() == 2


def test_diagnosis_and_search_edges(spark):
    rows = [("a", d, c > d) for d in range(1, 5) for c in range(5)] + [("b", 1, None)]
    tests = spark.createDataFrame(rows, "period string, day int, succeeded boolean")
    found = {r.period: r for r in studies.diagnose(tests, ["period"]).collect()}
    assert (found["a"].successes, found["a"].failed_days, found["a"].assessment, found["a"].demand) == (6, 4, "POOR", 0.8)
    assert (found["b"].success_rate, found["b"].failed_day_ratio) == (0.0, 1.0)
    assert studies.diagnose(tests.limit(0), ["period"]).collect() == []


def test_overview_without_complete_trials(spark):
    trials = spark.createDataFrame([("s", 1, "FAIL", None), ("s", 2, "PRUNED", 5.0), ("t", 3, "COMPLETE", 1.0), ("t", 4, "COMPLETE", 1.0)], "study string, trial int, state string, value double")
    found = {r.study: tuple(r)[1:] for r in studies.overview(trials, ["study"]).collect()}
    assert found == {"s": (2, 0, 1, 1, None, None), "t": (2, 2, 0, 0, 3, 1.0)}
    assert [(r.trial, r["rank"]) for r in studies.top_trials(trials.where("study = 's'"), ["study"]).collect()] == [(2, 1), (1, 2)]
