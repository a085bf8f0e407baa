import datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import joins, quality, search
from barloom.plans import builds, catalog, pipelines
from barloom.sources import tables

DAY = datetime.date(2024, 1, 1)


def test_failed_days_with_details(spark):
    rows = [(DAY, "few", "a"), (DAY, "few", "b"), (DAY, "error", "b"), (DAY + datetime.timedelta(1), "few", None)]
    df = spark.createDataFrame(rows, "day date, reason string, details string")
    found = [tuple(r) for r in search.failed_day_tally(df).collect()]
    assert found == [(DAY, 3, "error:1,few:2", ["a", "b"]), (DAY + datetime.timedelta(1), 1, "few:1", [])]
    assert search.failed_day_tally(df.drop("details"), 1).columns == ["day", "failures", "reasons"]


def test_sides_of_two_sets_of_days(spark):
    days = lambda *rows: spark.createDataFrame([(s, DAY + datetime.timedelta(d)) for s, d in rows], "symbol string, day date")
    found = {(r.symbol, (r.day - DAY).days): r.side for r in quality.date_sets(days(("a", 0), ("a", 0), ("a", 1)), days(("a", 1), ("b", 1))).collect()}
    assert found == {("a", 0): "wanted", ("a", 1): "both", ("b", 1): "there"}


def test_a_sound_dataset_fails_nothing(spark):
    at = F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id * 3600)")
    sound = spark.range(8784).select(F.lit("a").alias("symbol"), at.alias("open_time"), *[F.lit(float(v)).alias(c) for c, v in (("open", 2), ("high", 3), ("low", 1), ("close", 2), ("rsi", 50))], F.lit(0.5).alias("sample_weight"))
    [r] = quality.integrity_report(sound, 2024).collect()
    assert (r.bars, r.copies, r.shared_times, r.worst_null, r.failed) == (8784, 0, 0, 0.0, [])
    assert quality.integrity_report(sound, 2023).collect()[0].failed == ["dates"]
    broken = sound.withColumns({"low": F.lit(2.5), "sample_weight": F.lit(None).cast("double"), "rsi": F.lit(101.0)}).limit(7000)
    assert quality.integrity_report(broken, 2024).collect()[0].failed[0] == "bars"
    assert set(quality.integrity_report(broken, 2024).collect()[0].failed) >= {"nulls", "weights", "ohlc", "range of rsi"}
    assert quality.integrity_report(sound.limit(0), 2024).collect() == []


def test_defaults_of_symbols_without_a_study(spark):
    targets = spark.createDataFrame([("BTCUSDT", "2024-02"), ("SOLUSDT", "2024-02"), ("XYZ", "2024-02"), ("ETHUSDT", "2024-02")], "symbol string, period string")
    studies = spark.createDataFrame([("ETHUSDT", "2024-01", 0.9, 7.0), ("BTCUSDT", "2024-02", 0.9, 7.0)], "symbol string, period string, exp_lambda double, init_exp_t double")
    found = {r.symbol: (r.exp_lambda, r.init_exp_t, r.source) for r in joins.param_lookup(targets, studies, pipelines.symbol_defaults()).collect()}
    assert found == {"BTCUSDT": (0.9975, 14738.0, "default"), "SOLUSDT": (0.9975, 2000.0, "default"), "XYZ": (0.9975, 2000.0, "default"), "ETHUSDT": (0.9, 7.0, "2024-01")}


def test_funding_files_that_overlap(spark, tmp_path):
    at = lambda h: datetime.datetime(2024, 1, 31, h)
    for month, hours in (("01", (0, 8, 16)), ("02", (16, 23))):
        spark.createDataFrame([("a", at(h), h / 1e4) for h in hours] + [("a", None, 1.0)], "symbol string, funding_time timestamp_ntz, funding_rate double").write.parquet(f"{tmp_path}/f/month={month}")
    found = tables.read_funding_files(spark, f"{tmp_path}/f")
    assert sorted(r.funding_time.hour for r in found.collect()) == [0, 8, 16, 23]
    part = tables.read_funding_files(spark, f"{tmp_path}/f", "2024-01-31 08:00:00", "2024-01-31 16:00:00")
    assert sorted(r.funding_time.hour for r in part.collect()) == [8, 16]
    assert "GreaterThanOrEqual(funding_time" in part._jdf.queryExecution().executedPlan().toString()


def test_migration_can_run_again(spark, tmp_path):
    bars = catalog.hourly(spark, "/root/testdata/sf0.001")
    studies = spark.createDataFrame([("a", "2024-01", 0.9, 5.0, ["2024-01-03", "2024-01-03", "2024-01-04"]), ("b", "2024-01", None, 5.0, [])], "symbol string, period string, exp_lambda double, init_exp_t double, failed_dates array<string>")
    store = f"{tmp_path}/store"
    first = builds.migrate(bars, studies, store)
    assert first == {"bars": bars.count(), "studies": 1, "failed_days": 2} == builds.migrate(bars, studies, store)
    assert spark.read.parquet(f"{store}/bars").count() == bars.count()
    builds.migrate(bars, studies.where("symbol = 'a'").withColumn("exp_lambda", F.lit(0.8)), store)
    assert [r.exp_lambda for r in spark.read.parquet(f"{store}/studies").collect()] == [0.8]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from barloom.sources import sinks

    class Unset:
        isDefined = staticmethod(lambda: False)

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "spark://somewhere"

            class _jsc:
                sc = staticmethod(lambda: type("Context", (), {"getCheckpointDir": staticmethod(Unset)}))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.scratch(Cluster, "x")
    assert sinks.scratch(spark, "x") != sinks.scratch(spark, "x")


def test_a_text_report(spark, tmp_path):
    from barloom.sources import sinks

    df = spark.createDataFrame([("a", 1.5, None), ("b", None, "x")], "name string, score double, note string").orderBy("name")
    sinks.write_report(df, f"{tmp_path}/r", "text")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/r", lineSep="\n\n").collect()) == ["name: a\nscore: 1.5\nnote: ", "name: b\nscore: \nnote: x"]
    with pytest.raises(ValueError, match="no writer"):
        sinks.write_report(df, f"{tmp_path}/r", "pdf")


def test_failed_days_of_text_analyses(spark, tmp_path):
    head = "=====\nX - FAILED DAYS ANALYSIS\n=====\n\nPeriod: 2023-01\nDays with failures: 2\n\n=====\nDAYS THAT CONSISTENTLY FAIL:\n=====\n\n"
    days = "DATE: 2023-01-05\n  Failed 3 times across all trials\n  Reasons:\n    - Insufficient bars: 2\n    - Errors: 1\n  Details: Generated < 50 bars, lost\n\nDATE: 2023-01-09\n  Failed 1 times across all trials\n  Reasons:\n    - Insufficient bars: 1\n    - Errors: 0\n  Details: \n\n"
    (tmp_path / "a.txt").write_text(head + days + "\n=====\nSUMMARY:\n=====\n\nMost problematic days (top 5):\n  - 2023-01-05: Failed 3 times\n")
    (tmp_path / "b.txt").write_text("Period: 2023-02\n\nNo consistent failures detected.\n")
    found = sorted(tuple(r)[1:] for r in tables.parse_failed_days(spark, str(tmp_path)).collect())
    assert found == [("2023-01", "2023-01-05", 3, 2, 1, ["Generated < 50 bars", "lost"]), ("2023-01", "2023-01-09", 1, 1, 0, [])]


def test_copies_of_ticks_without_an_id(spark):
    from barloom.operators import ticks

    at = datetime.datetime(2024, 1, 1)
    rows = [("a", at, 1.0, 2.0, "y"), ("a", at, 1.0, 2.0, "x"), ("a", at, 1.0, 3.0, "x"), ("b", at, 1.0, 2.0, "x")]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price double, quantity double, note string")
    assert sorted(tuple(r) for r in ticks.deduplicate(df).collect()) == sorted(rows[1:])
    assert ticks.deduplicate(df.drop("note")).count() == 3
