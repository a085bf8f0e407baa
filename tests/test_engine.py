import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barloom.functions import stats
from barloom.operators import features, joins, quality, search, winsor
from barloom.plans import catalog
from barloom.sources import sinks, tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_and_keys(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_features_do_not_look_ahead(spark, sf_dir):
    rows = catalog.hourly(spark, sf_dir)
    cut = "timestamp_ntz'2024-01-20'"
    early = features.bar_features(rows.where(f"open_time < {cut}")).orderBy("symbol", "open_time").collect()
    changed = rows.withColumn("close", F.when(F.expr(f"open_time >= {cut}"), 1e6).otherwise(F.col("close")))
    late = features.bar_features(changed).where(f"open_time < {cut}").orderBy("symbol", "open_time").collect()
    assert early == late


def test_accumulating_winsorizer_ignores_the_future(spark):
    rows = [("s", p, float(v)) for p in range(4) for v in range(50)] + [("s", 3, 999.0)]
    df = spark.createDataFrame(rows, "symbol string, period int, x double")
    out = winsor.clip_accumulating(df, ["x"], "period")
    assert out.where("period = 0").agg(F.max("x")).first()[0] == 49
    assert out.where("period = 3").agg(F.max("x")).first()[0] == pytest.approx(np.quantile(np.tile(np.arange(50.0), 3), 0.99))


def test_strict_and_backward_asof(spark):
    left = spark.createDataFrame([("a", 5), ("a", 7), ("b", 5)], "k string, t int")
    right = spark.createDataFrame([("a", 5, 1.0), ("a", 6, 2.0)], "k string, u int, v double")
    back = {tuple(r) for r in joins.asof_backward(left, right, "t", "u", ["k"], ["v"]).collect()}
    strict = {tuple(r) for r in joins.asof_backward(left, right, "t", "u", ["k"], ["v"], strict=True).collect()}
    assert back == {("a", 5, 1.0), ("a", 7, 2.0), ("b", 5, None)}
    assert strict == {("a", 5, None), ("a", 7, 2.0), ("b", 5, None)}


def test_quality_score_ranks_series():
    rng = np.random.default_rng(0)
    noise = rng.normal(size=4000)
    ar = np.zeros(4000)
    for i in range(1, 4000):
        ar[i] = 0.5 * ar[i - 1] + noise[i]
    uneven = noise * np.where(np.arange(4000) < 2000, 1, 4)
    steady = np.full(4000, 50.0)
    score = lambda x: stats.quality_score(x, steady)
    assert score(noise) >= 70 and score(ar) < 50 and score(uneven) < 60 and 0 <= score(ar) <= 90
    walk = np.cumsum(noise)
    assert stats.adf_statistic(noise)[0] < stats.adf_statistic(noise)[1] < stats.adf_statistic(walk)[0]
    assert stats.adf_best_lag(noise)[0] < -10


def test_publish_keeps_the_old_file_when_a_check_fails(spark, tmp_path):
    path = f"{tmp_path}/set"
    good = spark.createDataFrame([(1,), (2,)], "x int")
    check = lambda df: ["negative"] if df.where("x < 0").count() else []
    sinks.publish(good, path, check)
    with pytest.raises(ValueError):
        sinks.publish(spark.createDataFrame([(-1,)], "x int"), path, check)
    sinks.publish(spark.createDataFrame([(3,)], "x int"), path, check)
    assert [r.x for r in spark.read.parquet(path).collect()] == [3]
    assert sorted(os.listdir(tmp_path)) == ["set"]


def test_writes_are_idempotent(spark, tmp_path, sf_dir):
    path = f"{tmp_path}/bars"
    rows = catalog.hourly(spark, sf_dir).select("symbol", F.date_format("open_time", "yyyy-MM-dd").alias("day"), "open_time", "close")
    some = rows.where("day <= '2024-01-10'")
    for _ in range(2):
        sinks.replace_days(some, path)
        assert spark.read.parquet(path).count() == some.count()
    for _ in range(2):
        sinks.append_missing_days(rows, path)
        assert spark.read.parquet(path).count() == rows.count()
    sinks.replace_days(some.withColumn("close", F.lit(1.0)), path)
    back = spark.read.parquet(path)
    assert back.count() == rows.count() and back.where("close = 1.0").count() == some.count()
    assert sinks.dataset_name("X", 2024, [1, 2]) != sinks.dataset_name("X", 2024)


def test_sinks_on_frames(spark):
    old = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 1.0)], "symbol string, open_time int, v double")
    new = spark.createDataFrame([("a", 2, 9.0), ("a", 3, 9.0)], old.schema)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(sinks.upsert(old, new, ["symbol", "open_time"])) == [("a", 1, 1.0), ("a", 2, 9.0), ("a", 3, 9.0), ("b", 1, 1.0)]
    assert rows(sinks.insert_new(old, new, ["symbol", "open_time"])) == [("a", 1, 1.0), ("a", 2, 1.0), ("a", 3, 9.0), ("b", 1, 1.0)]
    assert rows(sinks.replace_window(old, new)) == rows(sinks.upsert(old, new, ["symbol", "open_time"]))


def test_trade_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,price,qty,quote_qty,time,is_buyer_maker,is_best_match\n1,10.5,2,21,1704067200000,True,True\n2,11,1,11,,False,True\n")
    (tmp_path / "b.csv").write_text("3,12.5,2,25,1704067200000000,false,True\n")
    a = tables.read_trade_csv(spark, f"{tmp_path}/a.csv").collect()
    b = tables.read_trade_csv(spark, f"{tmp_path}/b.csv").collect()
    assert [(r.id, r.price, r.quantity, r.is_buyer_maker, r.download_date) for r in a] == [(1, 10.5, 2.0, True, "2024-01-01")]
    assert str(b[0].ts) == "2024-01-01 00:00:00" and b[0].is_buyer_maker is False


def test_study_reports(spark, tmp_path):
    for period, lam in (("2023_01", 0.9975), ("2023_03", 0.9989)):
        folder = tmp_path / f"bayesian_{period}_w2m"
        folder.mkdir()
        (folder / "report.txt").write_text(f"exp_lambda: {lam}\ninit_exp_T: 6057\nCompletion Rate: 87.5%\nDATE: 2023-01-04\nDATE: 2023-01-09\n")
    found = tables.parse_study_reports(spark, f"{tmp_path}/*").collect()
    assert [(r.period, r.exp_lambda, r.completion_pct, len(r.failed_dates)) for r in found] == [("2023-01", 0.9975, 87.5, 2), ("2023-03", 0.9989, 87.5, 2)]


def test_dated_files_and_partitions(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        spark.createDataFrame([(day,)], "d string").coalesce(1).toPandas().to_parquet(tmp_path / f"bars_{day}.parquet")
    assert sorted(r.d for r in tables.read_dated_files(spark, str(tmp_path), "2024-01-02", "2024-01-03").collect()) == ["2024-01-02", "2024-01-03"]


def test_splits_exclude_each_other(spark):
    spec = search.WindowSpec("2024-01-01", "2024-01-03", "2024-01-03", "2024-01-05", "2024-01-05", "2024-01-06", 2, 1)
    rows = spark.range(0, 150).selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id) as open_time").selectExpr("*", "open_time + interval 30 minutes as close_time")
    counts = {r.split: r["count"] for r in search.assign_splits(rows, spec).groupBy("split").count().collect()}
    assert counts == {"train": 45, "validation": 45, "purged": 6, "test": 24, "outside": 30}


def test_conform_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "init_exp_t int, atr double")
    out = quality.conform(df, {"init_exp_T": "int", "atr_pct": "float", "symbol": "string"})
    assert out.columns == ["init_exp_T", "atr_pct", "symbol"] and tuple(out.first()) == (1, 2.0, None)
    assert quality.missing_columns(df, ["atr", "close"]) == ["close"]
    assert dict(quality.compact(df).dtypes)["atr"] == "float"


def test_synthetic_ticks_make_bars(spark):
    from barloom.operators import bars, ticks

    rows = tables.synthetic_ticks(spark, 20_000)
    rows = ticks.normalise(rows)
    assert bars.run_bars(ticks.with_direction(rows, ["symbol"]), ["symbol"], 0.9975, 500, 100).count() > 5


def test_plans_push_down_and_prune(spark, sf_dir):
    plan = catalog.hourly(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,0.0)" in plan and "CartesianProduct" not in plan
    read = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "user_id" not in read


def test_rest_works_without_training_data_operators(tmp_path):
    """On a copy without ``barloom/llm`` and ``tests/llm`` the entry still loads, with and without the pipeline's file."""
    import shutil
    import subprocess

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'run_bars' in q and 'pipeline' not in q and not set(e.oracle_sql()) - set(q)"
    for gone in (None, "corpus_pipeline.py"):
        if gone and (copy / gone).exists():
            (copy / gone).unlink()
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
