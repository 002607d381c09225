"""Cell-based operators against brute force in Python, with dense ties and forced hot keys."""

import bisect
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from frames import at
from strikelake.functions.timeline import WEEK_SECONDS, epoch_seconds
from strikelake.operators import cells, flow
from strikelake.operators.asof import asof_join, previous_row
from strikelake.operators.cells import CELL, CELL_WIDTHS, cell_widths
from strikelake.operators.flow import trade_flow
from strikelake.operators.market import market_state
from strikelake.plans.silver import with_forward_price
from strikelake.schemas import TRADE_COLUMNS

START = at("2024-01-01")
LIMITS = [None, 400, 40]  # None: all keys cold


def tape(seed, n, keys, days):
    """(key, timestamp, seq, id, value): a third of the rows sit in one hour of the first key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        key = keys[0] if hot else rng.choice(keys)
        second = 5 * 86400 + rng.randrange(3600) if hot else rng.randrange(days * 86400)
        rows.append((key, second, i, f"t{i}", 100 + rng.randrange(1000) / 10))
    return rows


def to_frame(spark, rows, by, value="futures_price"):
    import datetime as dt
    data = [(k, START + dt.timedelta(seconds=s), seq, tid, v) for k, s, seq, tid, v in rows]
    return spark.createDataFrame(data, f"{by} string, timestamp timestamp_ntz, trade_seq bigint, trade_id string, {value} double")


def widths_of(frames, by, limit):
    return None if limit is None else cell_widths(frames, by, max_rows=limit)


def test_hot_keys_get_narrow_cells(spark):
    rows = to_frame(spark, tape(1, 1200, ["a", "b", "c"], 30), "currency")
    got = {r[0]: r[1] for r in cell_widths([rows], "currency", max_rows=500).collect()}
    assert set(got) == {"a"} and got["a"] in CELL_WIDTHS[2:]
    assert all(WEEK_SECONDS % w == 0 for w in CELL_WIDTHS)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("tolerance", [None, 3600])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof(spark, limit, tolerance, direction):
    left, right = tape(2, 900, ["a", "b", "c"], 20), tape(3, 700, ["a", "b"], 25)
    l, r = to_frame(spark, left, "k", "x"), to_frame(spark, right, "k", "y")
    out = asof_join(l, r, "k", "timestamp", "timestamp", {"y": "y", "trade_id": "rid"}, tie=["trade_seq"],
                    direction=direction, tolerance_seconds=tolerance, max_rows_per_cell=limit or 10**9)
    got = {row.trade_id: row.rid for row in out.collect()}
    by_key = {}
    for k, s, seq, tid, _ in right:
        by_key.setdefault(k, []).append((s, seq, tid))
    for rows in by_key.values():
        rows.sort()
    assert len(got) == len(left)
    for k, s, _, tid, _ in left:
        side = by_key.get(k, [])
        if direction == "backward":
            i = bisect.bisect_right(side, (s, math.inf, "")) - 1
            match = side[i] if i >= 0 else None
        else:
            i = bisect.bisect_left(side, (s, -1, ""))
            match = side[i] if i < len(side) else None
        if match and tolerance is not None and abs(match[0] - s) > tolerance:
            match = None
        assert got[tid] == (match[2] if match else None)


@pytest.mark.parametrize("limit", LIMITS)
def test_previous_row(spark, limit):
    rows = tape(4, 900, ["a", "b"], 40)
    df = to_frame(spark, rows, "currency")
    got = {r.trade_id: r.before for r in previous_row(
        df, "currency", ["timestamp", "trade_seq", "trade_id"], {"trade_id": "before"}, limit or 10**9).collect()}
    expected, last = {}, {}
    for k, _, _, tid, _ in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        expected[tid], last[k] = last.get(k), tid
    assert got == expected


@pytest.mark.parametrize("limit", LIMITS)
def test_market_state(spark, limit):
    rows, vol = tape(5, 900, ["A", "B"], 30), tape(6, 60, ["A", "B"], 20)
    df = to_frame(spark, rows, "currency")
    index = to_frame(spark, vol, "currency", "volatility_value").dropDuplicates(["currency", "timestamp"])
    got = {r.trade_id: r for r in market_state(df, index, widths_of([df], "currency", limit)).collect()}
    readings = sorted((r.currency, (r.timestamp - START).total_seconds(), r.volatility_value) for r in index.collect())
    assert len(got) == len(rows)
    for key in ("A", "B"):
        own = sorted(r[1:] for r in rows if r[0] == key)
        steps = [None] + [math.log(b[3] / a[3]) for a, b in zip(own, own[1:])]
        for i, (s, _, tid, _) in enumerate(own):
            row = got[tid]
            assert row.log_return == (pytest.approx(steps[i]) if steps[i] is not None else None)
            frame = [steps[j] for j, o in enumerate(own) if s - WEEK_SECONDS <= o[0] <= s and steps[j] is not None]
            if len(frame) < 2:
                assert row.realized_vol_7day is None
            else:
                mean = sum(frame) / len(frame)
                sd = math.sqrt(sum((x - mean) ** 2 for x in frame) / (len(frame) - 1))
                assert row.realized_vol_7day == pytest.approx(sd * math.sqrt(8760), rel=1e-9, abs=1e-12)
            ahead = next((o[3] for o in own if o[0] >= s + WEEK_SECONDS), None)
            assert row.forward_futures_price == ahead
            past = [v for k, t, v in readings if k == key and t <= s]
            assert row.exchange_realized_vol == (past[-1] if past else None)


@pytest.mark.parametrize("limit", LIMITS)
def test_trade_flow(spark, limit):
    rows = tape(7, 900, ["A", "B", "C"], 30)
    df = to_frame(spark, rows, "instrument_name", "price").withColumn("amount", (F.col("trade_seq") % 3 + 1).cast("double"))
    got = {r.trade_id: r for r in trade_flow(df, widths_of([df], "instrument_name", limit)).collect()}
    assert len(got) == len(rows)
    for key in ("A", "B", "C"):
        own = sorted(r[1:] for r in rows if r[0] == key)
        dp = [None] + [b[3] - a[3] for a, b in zip(own, own[1:])]
        for i, (s, seq, tid, price) in enumerate(own):
            row = got[tid]
            week = [o for o in own if s - WEEK_SECONDS <= o[0] <= s]
            assert row.trade_volume_7day == len(week)
            assert row.actual_premium_collected == pytest.approx(sum(o[3] * (o[1] % 3 + 1) for o in week))
            frame = range(max(0, i - 20), i + 1)
            pairs = [(dp[j], dp[j - 1]) for j in frame if j >= 1 and dp[j] is not None and dp[j - 1] is not None]
            n_obs = sum(dp[j] is not None for j in frame)
            cov = None
            if pairs:
                mx, my = (sum(p[c] for p in pairs) / len(pairs) for c in (0, 1))
                cov = sum((x - mx) * (y - my) for x, y in pairs) / len(pairs)
            if n_obs >= 5 and cov is not None and cov < -1e-12:
                assert row.bid_ask_spread_estimate == pytest.approx(2 * math.sqrt(-cov), rel=1e-6)
            else:
                assert row.bid_ask_spread_estimate is None or row.bid_ask_spread_estimate < 1e-5


@pytest.mark.parametrize("n,days", [(300, 400), (1500, 3), (40, 300)])
def test_prints_before_a_cell(spark, n, days):
    """The scan for the last prints before each cell, over hours and blocks of days."""
    rows = tape(8, n, ["A", "B", "C"], days)
    df = to_frame(spark, rows, "instrument_name", "price").withColumn(
        CELL, F.expr(f"floor({epoch_seconds('timestamp')} / 3600) * 3600"))
    got = {}
    for r in flow._halos(df).collect():
        got.setdefault((r["instrument_name"], r[CELL]), []).append((r["__at"], r["__seq"], r["__price"]))
    want = {}
    for key in ("A", "B", "C"):
        own = sorted((r["timestamp"], r["trade_seq"], r["price"], r[CELL]) for r in df.filter(F.col("instrument_name") == key).collect())
        for cell in {o[3] for o in own}:
            earlier = [o[:3] for o in own if o[3] < cell][-22:]
            if earlier:
                want[key, cell] = earlier
    assert {k: sorted(v) for k, v in got.items()} == want


def test_no_window_by_instrument_alone_but_at_the_root(spark):
    df = to_frame(spark, tape(9, 50, ["A"], 3), "instrument_name", "price").withColumn(
        CELL, F.expr(f"floor({epoch_seconds('timestamp')} / 60) * 60"))
    plan = flow._halos(df)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    alone = [d for d in dealt if d.count("#") == 1]
    assert len(alone) == 1 < len(dealt), "one exchange by instrument, of the last prints of blocks of 32 days"


@pytest.mark.parametrize("most,width", [(20, 3_600), (70, 21_600), (300, 86_400)])
def test_cells_stay_near_their_limit(spark, most, width):
    """Ten prints an hour: the steps between widths are small, so that a cell is neither far above nor far below its limit."""
    rows = to_frame(spark, [("a", s, s, f"t{s}", 1.0) for s in range(0, 5 * 86400, 360)], "currency")
    assert {r[0]: r[1] for r in cell_widths([rows], "currency", max_rows=most).collect()} == {"a": width}


def test_tasks_follow_the_rows(spark, monkeypatch):
    """Cells are dealt over as many tasks as the rows ask for, which Spark does not merge by their compressed size."""
    monkeypatch.setattr(cells, "ROWS_PER_TASK", 25)
    tape_rows = tape(10, 900, ["A", "B"], 30)
    prices = to_frame(spark, tape_rows, "currency")
    index = to_frame(spark, tape(6, 60, ["A", "B"], 20), "currency", "volatility_value")
    trades = to_frame(spark, tape_rows, "instrument_name", "price").withColumn("amount", F.lit(1.0))
    for state in (market_state(prices, index, widths_of([prices], "currency", 20)),
                  trade_flow(trades, widths_of([trades], "instrument_name", 20))):
        kept = state.select("trade_id", F.spark_partition_id().alias("task"))
        assert state.rdd.getNumPartitions() == 36, "900 rows, 25 a task"
        assert max(r["count"] for r in kept.groupBy("task").count().collect()) < 450


def test_prints_before_a_cell_stay_in_proportion(spark):
    """Sixty prints an hour, cells of at most 40: the rows carried into cells are fewer than the prints."""
    rows = to_frame(spark, [("A", s, s, f"t{s}", 1.0) for s in range(0, 2 * 86400, 60)], "instrument_name", "price")
    placed = cells.in_cells(rows, "instrument_name", "timestamp", widths_of([rows], "instrument_name", 40))
    assert flow._halos(placed).count() < rows.count()


def test_forward_prices_are_dealt_by_rows(spark, monkeypatch):
    """The cells of the as-of join are dealt over tasks by rows, which Spark does not merge by their compressed size."""
    monkeypatch.setattr(cells, "ROWS_PER_TASK", 25)
    left = to_frame(spark, tape(11, 900, ["BTC-12JAN24-40000-C", "ETH-12JAN24-40000-P"], 20), "instrument_name", "price")
    options = left.select(*[c if c in left.columns else F.lit(None).cast("double").alias(c) for c in TRADE_COLUMNS])
    right = to_frame(spark, tape(12, 100, ["BTC-12JAN24", "ETH-12JAN24"], 20), "instrument_name", "price")
    priced = with_forward_price(options, right, max_rows_per_cell=20)
    tasks = priced.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) > 10 and max(r["count"] for r in tasks) < 450, "1,000 rows, 25 a task"
