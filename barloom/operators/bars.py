"""Information-driven and clock bars.

A run or imbalance bar ends where all bars before it say, so a scope (symbol,
or symbol and day) is one sequential fold; scopes run in parallel.  The fold
streams sorted partitions with a state of fixed size.  Inside an Arrow batch
the end of a bar is found by searching the bar's running sums, not tick by tick.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ticks that a fold looks through at once at least; a bar that goes on doubles them.
STRETCH = 64
BAR = "open_time, close_time, open, high, low, close, n_ticks, volume, dollar"


class Ticks:
    """Ticks in order with the parts that every fold over them adds up.

    ``first``: whether the scope begins here; its first tick counts in a bar, not in the bar's run.
    ``parts``: dollars of buys and of sells for the runs, the same for the sums, signed dollars.
    """

    def __init__(self, ts, price, quantity, dollar, b, first: bool):
        self.ts, self.price, self.quantity, self.dollar, self.b = ts, price, quantity, dollar, b
        up = b == 1
        run = dollar.copy()
        if first and len(run):
            run[0] = 0.0
        self.parts = np.stack([np.where(up, run, 0.0), np.where(up, 0.0, run), np.where(up, dollar, 0.0), np.where(up, 0.0, dollar), np.where(up, run, -run)])
        self.buys = np.concatenate([[0], np.cumsum(up)])

    def __len__(self) -> int:
        return len(self.ts)


#: Columns of a fold's snapshot.
SNAPSHOT = (
    "e_t double, p double, e_buy double, e_sell double, e_v double, buy_run double, sell_run double, buys long, sells long, buy_sum double, sell_sum double, ticks long, "
    "volume double, dollar double, high double, low double, first_at long, first_price double, last_at long, last_price double, seen long, number long"
)


def _plain(tick: tuple) -> tuple:
    return (None, None) if tick[0] is None else (int(tick[0]), float(tick[1]))


class _Fold:
    """Bars of one scope from its ticks in order; ``feed`` takes any number at a time."""

    def __init__(self, kind: str, n: int, lam: float, t0: float, min_ticks: int):
        self.kind, self.lam, self.min_ticks = kind, lam, max(min_ticks, 1)
        self.warm = min(100, n // 10)
        self.e_t, self.ready = float(t0), False
        self.held: list[tuple] = []
        self.seen = 0  # ticks of the scope taken in so far
        self.bars: list[tuple] = []
        self.number = 0
        self._open_bar()

    def _open_bar(self) -> None:
        self.runs = np.zeros(2)  # what the bar's buys and sells weigh against the threshold
        self.count = np.zeros(2, dtype=np.int64)
        self.sums = np.zeros(2)
        self.ticks, self.volume, self.dollar = 0, 0.0, 0.0
        self.high, self.low, self.first, self.last = -np.inf, np.inf, None, None

    def feed(self, ts, price, quantity, dollar, b) -> None:
        if self.warm == 0:  # fewer than ten ticks: no estimate, no bar
            return
        if not self.ready:
            self.held.append((ts, price, quantity, dollar, b))
            if sum(len(x[0]) for x in self.held) < self.warm:
                return
            ts, price, quantity, dollar, b = (np.concatenate(x) for x in zip(*self.held, strict=True))
            self.held = []
        self.take(Ticks(ts, price, quantity, dollar, b, self.seen == 0))

    def take(self, ticks: Ticks) -> None:
        """Like ``feed``, for sums that other folds share; the first ones must fill the warm-up."""
        if self.warm == 0:
            return
        if not self.ready:
            self.ready = True
            d, up = ticks.dollar[: self.warm], ticks.b[: self.warm] == 1
            mean = lambda x: np.cumsum(x)[-1] / len(x)
            self.p = up.sum() / self.warm
            self.e_side = [mean(d[s]) if s.any() else mean(d) for s in (up, ~up)]
            self.e_v = mean(d)
        self._scan(ticks)

    def snapshot(self) -> tuple:
        """All that a fold past its warm-up knows, as plain numbers; ``restore`` takes it back."""
        first, last = self.first or (None, None), self.last or (None, None)
        return (
            float(self.e_t), float(self.p), *map(float, self.e_side), float(self.e_v), *map(float, self.runs), *map(int, self.count), *map(float, self.sums), int(self.ticks),
            float(self.volume), float(self.dollar), float(self.high), float(self.low), *_plain(first), *_plain(last), int(self.seen), int(self.number),
        )

    def restore(self, kept: tuple) -> None:
        self.ready = True
        self.e_t, self.p, e_buy, e_sell, self.e_v, *rest = kept
        self.e_side, self.runs, self.count, self.sums = [e_buy, e_sell], np.array(rest[:2], dtype=float), np.array(rest[2:4], dtype=np.int64), np.array(rest[4:6], dtype=float)
        self.ticks, self.volume, self.dollar, self.high, self.low = rest[6:11]
        self.first, self.last = (tuple(x) if x[0] is not None else None for x in (rest[11:13], rest[13:15]))
        self.seen, self.number = rest[15:]

    def _threshold(self) -> float:
        if self.kind == "run":
            return self.e_t * max(self.p * self.e_side[0], (1 - self.p) * self.e_side[1])
        return self.e_t * self.e_v * abs(2 * self.p - 1)

    def _scan(self, ticks: Ticks) -> None:
        """Takes stretches of ticks: up to the end of the bar, or as many as it may still need.

        Sums start at zero with each bar and take in one tick after the other,
        whatever the stretches and batches: a run that meets the threshold
        exactly, as in copies of a tick, ends its bar in every cut alike.
        """
        ts, price, quantity, dollar, buys = ticks.ts, ticks.price, ticks.quantity, ticks.dollar, ticks.buys
        rows = slice(0, 4) if self.kind == "run" else slice(2, 5)
        parts, at, n, step, want = ticks.parts[rows], 0, len(ticks), 0, self._threshold()
        while at < n:
            if not step:  # a new bar, or one that goes on from the batch before
                step = max(STRETCH, self.min_ticks - self.ticks, min(int(self.e_t), 8 * STRETCH))
            stop = min(at + step, n)
            sums = np.empty((len(parts), stop - at + 1))
            sums[:, 0] = [*self.runs, *self.sums] if self.kind == "run" else [*self.sums, self.runs[0]]
            sums[:, 1:] = parts[:, at:stop]
            sums = np.add.accumulate(sums, axis=1, out=sums)[:, 1:]
            earliest = max(self.min_ticks - self.ticks - 1, 0, 1 - self.seen - at)
            if self.kind == "run":  # both runs only grow
                end = max(earliest, min(int(sums[0].searchsorted(want)), int(sums[1].searchsorted(want))))
            else:
                found = np.flatnonzero(np.abs(sums[2, earliest:]) >= want)
                end = earliest + int(found[0]) if len(found) else stop - at
            closed = end < stop - at
            stop = at + end + 1 if closed else stop
            last = sums[:, stop - at - 1]
            if self.kind == "run":
                self.runs, self.sums = last[:2].copy(), last[2:].copy()
            else:
                self.sums, self.runs = last[:2].copy(), np.array([last[2], 0.0])
            if self.first is None:
                self.first = (ts[at], price[at])
            self.last = (ts[stop - 1], price[stop - 1])
            self.high, self.low = max(self.high, price[at:stop].max()), min(self.low, price[at:stop].min())
            self.ticks += stop - at
            self.volume += quantity[at:stop].sum()
            self.dollar += dollar[at:stop].sum()
            got = buys[stop] - buys[at]
            self.count += (got, stop - at - got)
            step = 0 if closed else 2 * step
            if closed:
                self._close()
                want = self._threshold()
            at = stop
        self.seen += n

    def _close(self) -> None:
        self.bars.append((self.number, self.first[0], self.last[0], self.first[1], self.high, self.low, self.last[1], self.ticks, self.volume, self.dollar))
        self.number += 1
        keep, new = self.lam, 1 - self.lam
        self.e_t = new * self.ticks + keep * self.e_t
        self.p = new * self.count[0] / self.ticks + keep * self.p
        if self.kind == "run":
            for s in (0, 1):
                if self.count[s]:
                    self.e_side[s] = new * self.sums[s] / self.count[s] + keep * self.e_side[s]
        else:
            self.e_v = new * self.sums.sum() / self.ticks + keep * self.e_v
        self._open_bar()


def tick_directions(price: np.ndarray, last_price: float | None, last_b: float = 1.0) -> np.ndarray:
    """Sign of the price change, carried over unchanged prices; +1 before any change.  ``last_*``: of the tick before."""
    moves = np.sign(np.diff(price, prepend=price[:1] if last_price is None else last_price))
    at = np.maximum.accumulate(np.where(moves != 0, np.arange(len(moves)), -1))
    return np.where(at >= 0, moves[at], last_b)


#: A scope warms up over a tenth of its ticks, 100 at most: once so many are there its length does not matter.
KNOWN = 1000

CANDIDATES = "array<struct<param_id:int,exp_lambda:double,init_exp_t:double>>"


class Scope:
    """All candidates' folds over one scope; ticks are held until the length of the warm-up is known.

    ``least``: scopes of fewer ticks have no folds.
    """

    def __init__(self, kind: str, candidates: list[tuple[int, float, float]], min_ticks: int, least: int = 0):
        self.kind, self.candidates, self.min_ticks, self.least = kind, candidates, min_ticks, least
        self.folds: list[_Fold] | None = None
        self.held: list[tuple] = []
        self.size = 0
        self.last_price, self.last_b = None, 1.0

    def feed(self, ts, price, quantity, dollar, b=None) -> None:
        if not len(ts):
            return
        if b is None:
            b = tick_directions(price, self.last_price, self.last_b)
            self.last_price, self.last_b = price[-1], b[-1]
        if self.folds is not None:
            part = Ticks(ts, price, quantity, dollar, b, False)
            for fold in self.folds:
                fold.take(part)
            return
        self.held.append((ts, price, quantity, dollar, b))
        self.size += len(ts)
        if self.size >= max(KNOWN, self.least):
            self._start()

    def _start(self) -> None:
        self.folds = [_Fold(self.kind, self.size, lam, t0, self.min_ticks) for _, lam, t0 in self.candidates]
        part = Ticks(*(np.concatenate(x) for x in zip(*self.held, strict=True)), True)
        self.held = []
        for fold in self.folds:
            fold.take(part)

    def finish(self) -> list[_Fold]:
        """The folds, none where the scope is too short."""
        if self.folds is None and self.held and self.size >= self.least:
            self._start()
        return self.folds or []


def laid_out(ticks: DataFrame, scope: list[str], candidates: DataFrame | None = None) -> DataFrame:
    """Ticks dealt by scope and sorted, in one exchange: the scope, ``ts, price, quantity, dollar, b``, and ``candidates`` if they are given.

    Candidate lists of their own (``scope``, ``candidates``) come as one row a
    scope before its ticks, so no tick carries them; as JSON, since a nested
    column costs every batch that goes to Python.  Without a column ``b``
    it is null, and the fold applies the tick rule within the scope.  A null
    key is no scope.
    """
    kinds = dict(ticks.dtypes)
    b = F.col("b").cast("double") if "b" in kinds else F.lit(None).cast("double")
    rows = ticks.select(*scope, F.lit(1).alias("_kind"), "ts", "price", "quantity", "dollar", b.alias("b"), "id")
    if candidates is not None:
        blank = [F.lit(None).cast(kinds[c]).alias(c) for c in ("ts", "price", "quantity", "dollar")]
        listed = F.to_json(F.col("candidates").cast(CANDIDATES)).alias("candidates")
        heads = candidates.where(F.col("candidates").isNotNull()).select(*scope, F.lit(0).alias("_kind"), *blank, F.lit(None).cast("double").alias("b"), F.lit(None).cast(kinds["id"]).alias("id"), listed)
        rows = rows.withColumn("candidates", F.lit(None).cast("string")).unionByName(heads)
    rows = rows.dropna(subset=scope)
    return rows.repartition(*scope).sortWithinPartitions(*scope, "_kind", "ts", "id").drop("_kind", "id")


def scopes_of(batches, keys: int, make):
    """``(own, scope, over)`` for each run of rows of one scope: its key, its ``Scope``, and whether it ends here.

    ``make(candidates)`` gives a scope its folds; ``candidates`` is the list of
    its head row, or None.  A scope without ticks yields nothing.
    """
    own, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        owners = list(zip(*(batch.column(i).to_pylist() for i in range(keys)), strict=True))
        cuts = [0, *[i for i in range(1, len(owners)) if owners[i] != owners[i - 1]], len(owners)]
        ts, price, quantity, dollar, b = (batch.column(keys + i).to_numpy(zero_copy_only=False) for i in range(5))
        head = batch.column(keys + 5).is_valid().to_numpy(zero_copy_only=False) if batch.num_columns > keys + 5 else np.zeros(len(ts), dtype=bool)
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if owners[lo] != own:
                if held is not None:
                    yield own, held, True
                own, given = owners[lo], None
                if head[lo]:
                    given = [(c["param_id"], c["exp_lambda"], c["init_exp_t"]) for c in json.loads(batch.column(keys + 5)[lo].as_py())]
                    lo += 1
                held = make(given)
            while lo < hi and head[lo]:  # a second list of the same scope
                lo += 1
            if lo < hi:
                held.feed(ts[lo:hi], price[lo:hi], quantity[lo:hi], dollar[lo:hi], None if np.isnan(b[lo]) else b[lo:hi])
                yield own, held, False
    if held is not None:
        yield own, held, True


def candidate_bars(ticks: DataFrame, scope: list[str], candidates: DataFrame | list[tuple[int, float, float]], min_ticks: int = 400, kind: str = "run") -> DataFrame:
    """Bars of every candidate in every scope: ``scope, param_id, exp_lambda, init_exp_t`` and the bar columns.

    ``candidates``: one list ``(param_id, exp_lambda, init_exp_t)`` for all
    scopes, or ``(scope, candidates)`` with a list for each; scopes without a
    list have no bars.  Ticks are shuffled once however many candidates there
    are, and their running sums are computed once for all of them.
    """
    per_scope = isinstance(candidates, DataFrame)
    shared = [] if per_scope else candidates
    kinds = dict(ticks.dtypes)
    names = [*scope, "param_id", "exp_lambda", "init_exp_t", "bar_id", *[c.strip() for c in BAR.split(",")]]

    def run(batches):
        types, stamp = [], None

        def noted(it):
            nonlocal types, stamp
            for batch in it:
                types, stamp = [batch.column(i).type for i in range(len(scope))], batch.column(len(scope)).type
                yield batch

        for own, held, over in scopes_of(noted(batches), len(scope), lambda given: Scope(kind, given or shared, min_ticks)):
            folds = held.finish() if over else held.folds or []
            rows = [(*c, *bar) for c, fold in zip(held.candidates, folds, strict=False) for bar in fold.bars]
            if rows:
                for fold in folds:
                    fold.bars = []
                yield _bar_batch(rows, own, types, stamp, names)

    ddl = ", ".join(f"{c} {kinds[c]}" for c in scope) + ", param_id int, exp_lambda double, init_exp_t double"
    ddl += f", bar_id long, open_time {kinds['ts']}, close_time {kinds['ts']}, open double, high double, low double, close double, n_ticks long, volume double, dollar double"
    return laid_out(ticks, scope, candidates if per_scope else None).mapInArrow(run, ddl)


def _bar_batch(rows: list[tuple], own: tuple, types: list, stamp, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array([v] * len(rows), type=t) for v, t in zip(own, types, strict=True)]
    arrays += [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.float64())]
    arrays += [pa.array(columns[3], pa.int64()), pa.array(columns[4], stamp), pa.array(columns[5], stamp)]
    arrays += [pa.array(columns[i], pa.float64()) for i in range(6, 10)]
    arrays += [pa.array(columns[10], pa.int64()), pa.array(columns[11], pa.float64()), pa.array(columns[12], pa.float64())]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _folded_bars(ticks: DataFrame, kind: str, scope: list[str], lam: float, t0: float, min_ticks: int) -> DataFrame:
    return candidate_bars(ticks, scope, [(0, float(lam), float(t0))], min_ticks, kind).drop("param_id", "exp_lambda", "init_exp_t")


def run_bars(ticks: DataFrame, scope: list[str], lam: float = 0.9975, t0: float = 2000, min_ticks: int = 400) -> DataFrame:
    """Dollar-run bars of ticks with ``b`` and ``dollar``; ticks after the last close stay residual.

    ``candidate_bars`` takes parameters that differ by scope.
    """
    return _folded_bars(ticks, "run", scope, lam, t0, min_ticks)


def imbalance_bars(ticks: DataFrame, scope: list[str], lam: float = 0.9975, t0: float = 2000, min_ticks: int = 400) -> DataFrame:
    return _folded_bars(ticks, "imbalance", scope, lam, t0, min_ticks)


def _ohlcv() -> list:
    at = F.struct("ts", "id")
    return [
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.count("*").alias("n_ticks"), F.sum("quantity").alias("volume"), F.sum("dollar").alias("dollar"),
    ]


def time_bars(ticks: DataFrame, minutes: int) -> DataFrame:
    """Clock bars, closed and labelled on the left; empty buckets have none; partial sums before the shuffle."""
    grouped = ticks.groupBy("symbol", F.window("ts", f"{minutes} minutes").alias("w")).agg(*_ohlcv())
    return grouped.select("symbol", F.col("w.start").alias("open_time"), F.col("w.end").alias("close_time"), "open", "high", "low", "close", "n_ticks", "volume", "dollar")


def threshold_bars(ticks: DataFrame, scope: list[str], threshold: float, column: str | None = None) -> DataFrame:
    """Bars of ``threshold`` ticks, or of so much of ``column``; the last bar of a scope may hold less.

    A tick belongs to the bar in which what came before it ends, so a tick that
    crosses a multiple closes its bar.  Null amounts count as nothing.
    """
    w = Window.partitionBy(*scope).orderBy("ts", "id")
    amount = F.coalesce(F.col(column), F.lit(0.0)) if column else F.lit(1.0)
    before = F.sum(amount).over(w) - amount
    cut = ticks.withColumn("bar", F.floor(before / threshold))
    return cut.groupBy(*scope, "bar").agg(F.min("ts").alias("open_time"), F.max("ts").alias("close_time"), *_ohlcv())


def day_bars(ticks: DataFrame) -> DataFrame:
    grouped = ticks.groupBy("symbol", F.to_date("ts").alias("day")).agg(F.min("ts").alias("open_time"), F.max("ts").alias("close_time"), *_ohlcv())
    return grouped


def audit_bars(ticks: DataFrame, bars: DataFrame, scope: list[str]) -> DataFrame:
    """clean = consumed + residual for every scope."""
    clean = ticks.groupBy(*scope).agg(F.count("*").alias("clean"))
    used = bars.groupBy(*scope).agg(F.sum("n_ticks").alias("consumed"), F.count("*").alias("bars"))
    return clean.join(used, scope, "left").na.fill(0, ["consumed", "bars"]).withColumn("residual", F.col("clean") - F.col("consumed"))


def invariants(bars: DataFrame, scope: list[str]) -> DataFrame:
    """Violations per scope of order, OHLC and activity."""
    w = Window.partitionBy(*scope).orderBy("open_time", "close_time")
    seen = bars.withColumn("next_open", F.lead("open_time").over(w))
    return seen.groupBy(*scope).agg(
        F.count("*").alias("bars"), F.count_if(F.col("close_time") < F.col("open_time")).alias("closes_early"),
        F.count_if(F.col("next_open") < F.col("close_time")).alias("overlaps"),
        F.count_if(F.col("high") < F.greatest("open", "close")).alias("high_low"), F.count_if(F.col("low") > F.least("open", "close")).alias("low_high"),
        F.count_if((F.col("volume") < 0) | (F.col("dollar") < 0)).alias("negative"), F.count_if(F.col("n_ticks") <= 0).alias("empty"),
    )


def merge_recovered(base: DataFrame, recovered: DataFrame, day: str = "day") -> DataFrame:
    """Base days that were recovered give way to their recovered bars."""
    left = base.join(recovered.select("symbol", day).distinct(), ["symbol", day], "left_anti")
    return left.unionByName(recovered, allowMissingColumns=True)
