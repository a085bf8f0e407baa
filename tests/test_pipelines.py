import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import stats
from barloom.operators import features, quality
from barloom.plans import catalog, pipelines
from barloom.sources import tables


def test_training_frame_ignores_the_future(spark):
    sf = "/root/testdata/sf0.01"
    studies = spark.createDataFrame([("click", "2023-12", 0.9, 1.5)], "symbol string, period string, exp_lambda double, init_exp_t double")
    build = lambda rows: pipelines.training_frame(rows, tables.funding(spark, sf), studies, 2, 10, defaults={"exp_lambda": 0.95, "init_exp_t": 1.5})
    raw = tables.ticks(spark, sf).where("symbol = 'click'")
    cut = "timestamp_ntz'2024-01-26'"
    columns = ["open_time", "close_time", *features.BAR_FEATURES]
    whole = build(raw).where(f"day < date({cut})").select(columns).orderBy(columns).collect()
    early = build(raw.where(f"ts < {cut}")).select(columns).orderBy(columns).collect()
    assert whole == early and len(early) > 50


def test_training_build_and_publish(spark, tmp_path):
    frame = catalog.queries()["training_build"](spark, "/root/testdata/sf0.01")
    rows = frame.collect()
    assert {r.study_source for r in rows} == {"2023-12", "default"} and {r.sample_weight for r in rows} <= {0.5, 1.0}
    full = catalog.hourly(spark, "/root/testdata/sf0.001").withColumn("log_return", F.lit(1.0) * F.col("close"))
    pipelines.build_year(full, f"{tmp_path}/year", 2024, ["log_return"])
    assert spark.read.parquet(f"{tmp_path}/year").count() == full.count()
    with pytest.raises(ValueError):
        pipelines.build_year(full.withColumn("log_return", F.lit(1.0)), f"{tmp_path}/year", 2024, ["log_return"])


def test_fallback_levels(spark, sf_dir):
    day = catalog.clean(spark, "/root/testdata/sf0.01").where("to_date(ts) = date'2024-01-20'")
    none = pipelines.fallback_day(day, [(0.9, 8.0)], 3, 10_000)
    assert {r.level for r in none.collect()} == {1}  # the whole-day bar when no level suffices
    single = pipelines.fallback_day(day, [(0.9, 1e9)], 3, 5)
    rows = single.collect()
    assert {r.level for r in rows} == {1} and len(rows) == len({r.symbol for r in rows})


def test_daily_inference_keeps_order_and_size(spark):
    rows = catalog.queries()["daily_inference"](spark, "/root/testdata/sf0.01").collect()
    assert max(sum(r.symbol == s for r in rows) for s in {r.symbol for r in rows}) <= 300
    assert any(str(r.day) == "2024-01-20" for r in rows)


def test_context_falls_back_to_the_first_bar(spark):
    stored = catalog.hourly(spark, "/root/testdata/sf0.001").withColumn("day", F.to_date("open_time"))
    tail = pipelines.latest_context(stored, "2024-01-10", 5).groupBy("symbol").agg(F.count("*").alias("n"), F.max("day").alias("d")).collect()
    assert all(r.n == 5 and str(r.d) < "2024-01-10" for r in tail)
    assert all(r.n == 1 for r in pipelines.latest_context(stored, "2020-01-01", 5).groupBy("symbol").agg(F.count("*").alias("n")).collect())


def test_gate_reports_before_it_raises(spark, tmp_path):
    audit = spark.createDataFrame([("s", 100, 0, 0, 50, 50)], "symbol string, received long, invalid long, duplicates long, mad_removed long, clean long")
    gate = lambda df: quality.gate_daily_audit(quality.daily_audit(df))
    with pytest.raises(ValueError):
        pipelines.run_checked(audit, gate, f"{tmp_path}/report")
    assert spark.read.parquet(f"{tmp_path}/report").count() == 1


def test_times(spark):
    make = lambda v, t: spark.createDataFrame([(v,)], f"ts {t}")
    for v, t in ((1704067200000, "long"), (1704067200000000, "long"), ("2024-01-01 00:00:00", "string")):
        assert str(tables.normalise_times(make(v, t)).first().ts) == "2024-01-01 00:00:00"
    with pytest.raises(ValueError):
        tables.normalise_times(make(1, "long"), "time")


def test_f_survival_and_legacy_score():
    assert stats.f_survival(1.0, 5, 5) == pytest.approx(0.5)
    assert stats.f_survival(2.0, 2, 10) == pytest.approx((1 + 2 * 2.0 / 10) ** -5)
    noise = np.random.default_rng(0).normal(size=3000)
    assert 60 < stats.legacy_quality_score(noise, np.full(3000, 9.0)) <= 100
