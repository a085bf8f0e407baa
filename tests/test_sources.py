import datetime

import pyarrow as pa
import pytest

from barloom.sources import acquire, tables

HEADER = "id,price,qty,quote_qty,time,is_buyer_maker,is_best_match\n"


def test_a_folder_of_mixed_trade_files(spark, tmp_path):
    (tmp_path / "ms.csv").write_text(HEADER + "1,10.5,2,21,1704067200000,True,True\n2,11,1,11,,False,True\n")
    (tmp_path / "us.csv").write_text("3,12.5,2,25,1704067200000001,false,True\r\n\r\n 4 , 1 , 2 , 2 , 1704067201000000 , TRUE , True\r\n")
    (tmp_path / "latin.csv").write_bytes("identité,price\n5,1,1,1,1704067202000,true,déjà\n".encode("latin-1"))
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbf6,1,1,1,1704067203000,true,true\n\xff\xfe,broken\n7,x,1,1,1704067204000,yes,true\n")
    (tmp_path / "empty.csv").write_text("")
    df = tables.read_trade_csv(spark, str(tmp_path))
    found = {r.id: r for r in df.collect()}
    assert sorted(found) == [1, 3, 4, 5, 6, 7]
    assert [str(found[i].ts) for i in (1, 3, 4, 5, 6)] == ["2024-01-01 00:00:00", "2024-01-01 00:00:00.000001", "2024-01-01 00:00:01", "2024-01-01 00:00:02", "2024-01-01 00:00:03"]
    assert [found[i].is_buyer_maker for i in (1, 3, 4, 5, 7)] == [True, False, True, True, False]
    assert found[7].price is None and {r.download_date for r in found.values()} == {"2024-01-01"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_epochs_of_both_units_in_one_frame(spark):
    rows = spark.createDataFrame([(1704067200000,), (1704067200000000,), (None,), (0,)], "ts long")
    assert [str(r.ts) for r in tables.normalise_times(rows).collect()] == ["2024-01-01 00:00:00"] * 2 + ["None", "1970-01-01 00:00:00"]


def answer(n):
    at = datetime.datetime(2024, 1, 1)
    return pa.table({"id": list(range(n)), "ts": [at] * n, "price": [1] * n, "quantity": [2.0] * n, "is_buyer_maker": [True] * n, "more": ["x"] * n})


def test_attempts_and_delays():
    for outcomes, waits, rows in (([answer(1)], [], 1), ([None, answer(0), answer(2)], [300.0, 600.0], 2), ([OSError("x"), answer(3)], [300.0], 3), ([None] * 3, [300.0, 600.0], None)):
        calls, waited = list(outcomes), []

        def fetch(symbol, day, calls=calls):
            got = calls.pop(0)
            if isinstance(got, Exception):
                raise got
            return got

        found = acquire.attempted(fetch, "A", "2024-01-01", acquire.RETRY_DELAYS, waited.append)
        assert (None if found is None else found.num_rows, waited) == (rows, waits)
    asked = []
    assert acquire.attempted(lambda s, d: asked.append(d), "A", "2024-01-01", (), pytest.fail) is None and asked == ["2024-01-01"]


def test_local_first_then_the_fallback(spark):
    day = lambda d: datetime.date(2024, 1, d)
    local = spark.createDataFrame([("A", day(1), 7, datetime.datetime(2024, 1, 1), 1.0, 1.0, None, 9), ("B", day(1), 8, datetime.datetime(2024, 1, 1), 1.0, 1.0, None, 9)], acquire.FETCHED + ", extra int")
    wanted = spark.createDataFrame([("A", day(1)), ("A", day(2)), ("A", day(2)), ("A", day(3)), ("B", day(3)), ("A", None), (None, day(1))], "symbol string, day date")

    def fetch(symbol, asked, table=answer(3)):
        if symbol == "B":
            raise OSError("down")
        return table if asked == "2024-01-02" else None

    acquire.register_fallback(spark, "test_fallback", fetch)
    counts = lambda df: {tuple(r)[:3]: r["count"] for r in df.groupBy("symbol", "day", "source").count().collect()}
    auto = acquire.acquire_days(local, wanted, "test_fallback", delays=())
    assert counts(auto) == {("A", day(1), "local"): 1, ("A", day(2), "test_fallback"): 3}
    assert auto.where("source <> 'local'").rdd.getNumPartitions() == 3  # a partition a missing day
    assert counts(acquire.acquire_days(local, wanted, mode="local")) == {("A", day(1), "local"): 1}
    assert counts(acquire.acquire_days(local, wanted, "test_fallback", "remote", ())) == {("A", day(2), "test_fallback"): 3}
    assert acquire.acquire_days(local, wanted.limit(0), "test_fallback", "remote").collect() == []
    with pytest.raises(ValueError, match="mode"):
        acquire.acquire_days(local, wanted, "test_fallback", "cloud")
    with pytest.raises(ValueError, match="fallback"):
        acquire.acquire_days(local, wanted)


def test_a_fallback_answer_with_emptied_chunks():
    """A filter over a file of several row groups leaves chunks without rows."""
    column = lambda values, kind: pa.chunked_array([[], values[:2], [], values[2:]], kind)
    at = [datetime.datetime(2024, 1, 2, h) for h in range(3)]
    table = pa.table({"id": column([1, 2, 3], pa.int64()), "ts": column(at, pa.timestamp("us")), **{c: column([1.0, 2.0, 3.0], pa.float64()) for c in ("price", "quantity")}, "is_buyer_maker": column([True] * 3, pa.bool_())})
    reader = acquire._DayReader(lambda symbol, day: table, [["A", "2024-01-02"]], ())
    batches = list(reader.read(reader.partitions()[0]))
    assert {b.schema.field("symbol").type for b in batches} == {pa.string()}
    found = pa.Table.from_batches(batches).to_pylist()
    assert [(r["symbol"], r["day"], r["id"]) for r in found] == [("A", datetime.date(2024, 1, 2), i) for i in (1, 2, 3)]
