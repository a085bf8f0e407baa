import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom import cli
from barloom.operators import features, quality
from barloom.plans import builds, catalog, pipelines
from barloom.sources import sinks

SCHEMA = "symbol string, id long, ts timestamp_ntz, price double, quantity double"


def market(spark, days, n=400, symbols="a", seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for s in symbols:
        for d in days:
            at = datetime.datetime.combine(d, datetime.time())
            price = 100 + np.cumsum(rng.normal(size=n)).round(1) / 10
            rows += [(s, d.toordinal() * 10_000 + i, at + datetime.timedelta(seconds=i), float(p), float(q)) for i, (p, q) in enumerate(zip(price, rng.integers(1, 9, n), strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


JAN = [datetime.date(2024, 1, d) for d in range(1, 6)]


def params(spark, *rows):
    return spark.createDataFrame(list(rows), "symbol string, period string, exp_lambda double, init_exp_t double")


def test_days_keep_their_provenance_and_short_months_are_left_out(spark):
    raw = market(spark, [*JAN, datetime.date(2024, 2, 1)], symbols="ab").where("symbol = 'a' or day(ts) < 5")
    short = raw.where("not (symbol = 'a' and day(ts) = 2 and month(ts) = 1 and id % 10000 > 60)")
    wanted = params(spark, ("a", "2024-01", 0.9, 10.0), ("a", "2024-02", 0.9, 10.0))
    made, audit = builds.month_days(short, wanted, min_days=5, min_bars=12, min_ticks=5)
    rows = made.select("symbol", "day", "bar_date", "base_failed_day", "recovered_bar").distinct().collect()
    assert {(r.symbol, r.day.day, r.base_failed_day) for r in rows} == {("a", 1, 0), ("a", 2, 1), ("a", 3, 0), ("a", 4, 0), ("a", 5, 0)}
    assert all(r.bar_date == r.day and r.recovered_bar is False for r in rows)  # b has four days, February one
    counts = audit.collect()
    assert len(counts) == 5 and all(r.received == r.invalid + r.mad_removed + r.clean and r.clean == r.consumed + r.residual for r in counts)
    assert builds.month_days(short, wanted, min_days=6)[0].isEmpty() and builds.month_days(short, wanted, min_days=6)[1].isEmpty()


def test_counts_of_broken_ticks(spark):
    raw = market(spark, JAN[:1], n=200)
    broken = raw.unionByName(raw.where("id % 10000 < 5")).unionByName(raw.where("id % 10000 < 7").withColumns({"price": -F.col("price"), "id": F.col("id") + 5000}))
    audit = builds.month_days(broken, params(spark, ("a", "2024-01", 0.9, 10.0)), 1, 1, 5, 20)[1].collect()
    assert [(r.received, r.invalid) for r in audit] == [(212, 7)] and audit[0].mad_removed >= 5
    only_bad = raw.withColumn("price", F.lit(-1.0))
    [r] = builds.month_days(only_bad, params(spark, ("a", "2024-01", 0.9, 10.0)), 1)[1].collect()
    assert (r.clean, r.bars, r.errors) == (0, 0, "empty_after_clean")


def test_a_period_is_one_fold_over_its_days(spark):
    raw = market(spark, JAN)
    made = builds.whole_periods(raw, params(spark, ("a", "2024-01", 0.9, 10.0)), 5, 5)
    assert made.where(F.to_date("open_time") < F.to_date("close_time")).count() > 0  # bars run through midnight
    assert made.select("exp_lambda", "init_exp_t").distinct().collect() == [(0.9, 10.0)]


def test_appending_a_range_twice_adds_nothing(spark, tmp_path):
    raw = market(spark, JAN, symbols="ab").where("not (symbol = 'b' and day(ts) = 4 and id % 10000 > 8)")
    store = catalog.hourly(spark, "/root/testdata/sf0.001").where("symbol = 'click'").withColumns({"symbol": F.lit("a"), "day": F.to_date("open_time") - F.expr("interval 40 days")})
    store = store.withColumns({c: F.col(c) - F.expr("interval 40 days") for c in ("open_time", "close_time")}).withColumn("day", F.to_date("day"))
    none = params(spark).where("false")
    options = dict(n=4, min_bars=12, min_ticks=5, defaults={"exp_lambda": 0.9, "init_exp_t": 60.0}, least_t=4.0, clipped=["log_return"])
    rows = sinks.kept(builds.append_range(raw, store, "2024-01-02", "2024-01-05", none, **options), "appended")
    status = {(r.symbol, r.day.day): r.recovery_status for r in rows.select("symbol", "day", "recovery_status").distinct().collect()}
    assert {d for _, d in status} == {2, 3, 4, 5} and ("b", 4) not in status  # too few ticks for any bar
    asked = raw.select("symbol", F.to_date("ts").alias("day")).where("day >= date'2024-01-02'")
    report = {r.symbol: r for r in builds.append_report(rows, asked, store).collect()}
    assert (report["a"].asked, report["a"].appended, report["a"].empty) == (4, 4, 0) and (report["b"].appended, report["b"].empty) == (3, 1)
    for s in "ab":
        own = [v for (symbol, _), v in status.items() if symbol == s]
        assert report[s].recovered == own.count("recovered") and report[s].failed == own.count("failed_irrecoverable")
    shared = ["symbol", "day", "open_time", "close_time", "open", "high", "low", "close", "n_ticks", "volume", "dollar"]
    grown = store.select(shared).unionByName(rows.select(shared))
    again = builds.append_range(raw.where("symbol = 'a'"), grown, "2024-01-02", "2024-01-05", none, **options)
    assert again.isEmpty()
    first = rows.where("symbol = 'a'").orderBy("open_time").first()
    last = store.orderBy(F.desc("open_time")).first()
    assert first.log_return is not None and last.close > 0  # the first new bar looks back on the store's last


def test_recovered_days_are_normal_weight_and_the_others_half(spark):
    raw = market(spark, JAN)
    none = params(spark).where("false")
    clean = pipelines.clean_ticks(raw)
    options = dict(n=6, min_bars=12, min_ticks=5, defaults={"exp_lambda": 0.99, "init_exp_t": 40.0}, least_t=5.0)
    days = clean.select("symbol", "day").distinct()
    few = builds.bars_with_recovery(clean, days, none, min_failed=6, **options)  # five failed days are too few to search
    assert {(r.failed_day, r.sample_weight, r.recovered) for r in few.select("failed_day", "sample_weight", "recovered").distinct().collect()} == {(1, 0.5, False)}
    found = builds.bars_with_recovery(clean, days, none, min_failed=3, **options)
    per = {r.day.day: r for r in found.groupBy("day").agg(F.count("*").alias("n"), F.max("failed_day").alias("failed"), F.max("recovery_status").alias("status"), F.min("sample_weight").alias("weight")).collect()}
    assert any(r.status == "recovered" for r in per.values())
    sources = {(r.recovered, r.study_source) for r in found.select("recovered", "study_source").distinct().collect()}
    assert sources <= {(True, "failed_days_2024_01"), (False, "default")} and (True, "failed_days_2024_01") in sources
    assert all((r.n >= 12, r.failed, r.weight) == ((True, 0, 1.0) if r.status == "recovered" else (False, 1, 0.5)) for r in per.values())


def test_a_frame_without_rows_or_columns_has_a_verdict(spark):
    frame = catalog.returns(spark, "/root/testdata/sf0.001")
    [r] = quality.validate_frame(frame.limit(0), ["log_return"], 2024, symbol="x").collect()
    assert (r.symbol, r.bars, r.errors, r.valid) == ("x", 0, ["frame is empty"], False)
    for r in quality.validate_frame(frame.drop("close", "open_time"), ["log_return", "rsi"], 2024).collect():
        assert "missing columns: open_time, close, rsi" in r.errors and "null open_time" not in r.errors and not r.valid
    [r] = quality.validate_frame(frame.select("high"), [], 2024).collect()
    assert r.symbol is None and r.errors[0].startswith("missing columns: open_time, close_time, open, low")


def test_an_empty_year_is_not_published_and_leaves_nothing_behind(spark, tmp_path):
    path = f"{tmp_path}/year"
    frame = catalog.hourly(spark, "/root/testdata/sf0.001").withColumn("log_return", F.col("close"))
    pipelines.build_year(frame, path, 2024, ["log_return"])
    with pytest.raises(ValueError, match="frame is empty"):
        pipelines.build_year(frame, path, 2023, ["log_return"])
    with pytest.raises(Exception, match="boom"):
        sinks.publish(frame.select(F.raise_error(F.lit("boom")).alias("x")), path, lambda df: [])
    assert spark.read.parquet(path).count() == frame.count() and sorted(os.listdir(tmp_path)) == ["year"]


def test_value_sets_of_nothing_and_of_null(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "s string, n int")
    found = {r.column: (r["values"], r.unexpected) for r in quality.value_sets(df, {"s": ["a"], "n": None}).collect()}
    assert found == {"s": (["a", "null"], ["null"]), "n": (["1", "2", "null"], [])}
    assert quality.value_sets(df.limit(0), {"s": ["a"]}).collect() == []


def test_health_check(spark, capsys):
    assert cli.health("/root/testdata/sf0.001") == []
    assert cli.health("/nowhere")[0].startswith("table events cannot be read")
    assert cli.main(["check", "/root/testdata/sf0.001"]) == 0 and capsys.readouterr().out == "OK\n"
    assert features.BAR_FEATURES  # the frame that a build writes


def test_historic_files_without_the_mad_filter(spark, tmp_path):
    """A day long enough for the filter's windows: with ``width`` None its spike stays."""
    rows = [("s", i, 1e6 if i == 250 else 100.0 + i % 7, 1.0) for i in range(300)]
    raw = spark.createDataFrame(rows, "symbol string, id long, price double, quantity double").selectExpr("*", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as ts")
    for width, n in ((None, 300), (100, 299)):
        files = builds.historic_files(raw, str(tmp_path / f"files-{width}"), (60,), width=width)
        assert [r.n_ticks for r in files.collect()] == [n]
