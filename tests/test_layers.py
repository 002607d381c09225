import datetime as dt
import json
import math
import os
import shutil

import pytest
from pyspark.sql import functions as F

from frames import SILVER, at, frame, future_row, option_row, silver_row
from strikelake import schemas
from strikelake.operators import quality
from strikelake.operators.asof import asof_join
from strikelake.operators.ivhist import with_iv_percentile, with_iv_rank
from strikelake.plans.gold import gold
from strikelake.plans.silver import silver, spot_greeks
from strikelake.sources import bronze, readers, writers
from strikelake.sources.bronze import split_trade_json
from strikelake.streaming.ingest import append_new_trades, stream_trades


# --- silver ---

@pytest.fixture(scope="module")
def silver_rows(spark):
    options = frame(spark, schemas.OPTION_TRADES, [
        option_row("t1", 1, "2024-06-01 00:10:00"),
        option_row("t2", 2, "2024-06-01 00:10:00", implied_volatility=0.0),
        option_row("t3", 3, "2024-06-01 03:00:00"),
        option_row("edge", 4, "2024-06-01 01:09:59"),
        option_row("late", 5, "2024-06-01 01:09:59.001"),
        option_row("no_iv", 6, "2024-06-01 00:10:00", implied_volatility=None),
        option_row("dead", 7, "2024-06-01 00:10:00", time_to_expiry_years=0.0),
        option_row("before", 8, "2024-06-01 00:04:59"),
        option_row("same", 9, "2024-06-01 00:05:00"),
        option_row("other", 10, "2024-06-01 00:10:00", instrument_name="ETH-1JUL24-50000-C"),
    ])
    futures = frame(spark, schemas.FUTURES_TRADES, [
        future_row("f1", 100, "2024-06-01 00:05:00", 54050.0),
        future_row("f3", 102, "2024-06-01 00:09:59", 54999.0),
        future_row("f2", 101, "2024-06-01 00:09:59", 54200.0),
    ])
    return {n: {r.trade_id: r for r in silver(options, futures, max_rows_per_cell=n).collect()} for n in (10**6, 2)}


@pytest.mark.parametrize("limit", [10**6, 2])
def test_silver_facts(silver_rows, limit):
    rows = silver_rows[limit]
    t1 = rows["t1"]
    assert t1.futures_price == 54999.0 and t1.is_valid is True
    assert 0 <= t1.delta <= 1 and t1.gamma > 0 and t1.vega > 0 and t1.theta < 0
    assert rows["t2"].futures_price == 54999.0 and rows["t2"].delta is None and rows["t2"].is_valid is False
    assert rows["t3"].futures_price is None and rows["t3"].delta is None and rows["t3"].is_valid is False
    assert rows["edge"].futures_price == 54999.0, "exactly one hour old still counts"
    assert rows["late"].futures_price is None
    assert rows["no_iv"].delta is None and rows["no_iv"].is_valid is None
    assert (rows["dead"].delta, rows["dead"].gamma, rows["dead"].is_valid) == (1.0, 0.0, False)
    assert rows["before"].futures_price is None and rows["same"].futures_price == 54050.0
    assert rows["other"].futures_price is None
    assert len(rows) == 10


def test_silver_without_futures_is_an_error(spark):
    out = silver(frame(spark, schemas.OPTION_TRADES, [option_row("t1", 1, "2024-06-01 00:10:00")]), None)
    assert out.columns == schemas.SILVER_COLUMNS
    with pytest.raises(quality.NoValidTradesError, match="0 valid trades out of 1"):
        quality.require_valid(out)


def test_spot_greeks_gates(spark):
    rows = [option_row("a", 1, "2024-06-01 00:00:00"), option_row("b", 2, "2024-06-01 00:00:00", time_to_expiry_years=0.0),
            option_row("c", 3, "2024-06-01 00:00:00", option_type=None)]
    got = {r.trade_id: r for r in spot_greeks(frame(spark, schemas.OPTION_TRADES, rows)).collect()}
    assert set(got) == {"a", "b"} and got["a"].delta > 0.5 and got["b"].delta is None


# --- gold ---

C, P, V = "BTC-1JAN24-50000-C", "BTC-1JAN24-50000-P", "BTC-1JAN24-66000-C"


def gold_input():
    def row(name, tid, seq, ts, price, amount, index, mark, iv, tte, fwd, delta):
        return silver_row(name, tid, seq, ts, price=price, amount=amount, index_price=index, mark_price=mark,
                          implied_volatility=iv, time_to_expiry_years=tte, futures_price=fwd, delta=delta)

    return [
        row(C, "t1", 1, "2023-12-25", 0.05, 1.0, 54000.0, 54100.0, 60.0, 0.02, 54000.0, 0.6),
        row(C, "t2", 2, "2023-12-27", 0.052, 1.0, 54500.0, 54600.0, 61.0, 0.014, 54500.0, 0.62),
        row(C, "t3", 3, "2023-12-30", 0.06, 2.0, 55000.0, 55100.0, 65.0, 0.003, 55000.0, 0.7),
        row(P, "u1", 4, "2023-12-25", 0.01, 1.0, 54000.0, 53900.0, 55.0, 0.02, 54000.0, -0.15),
        row(P, "u2", 5, "2023-12-28", 0.009, 1.0, 54800.0, 54700.0, 50.0, 0.009, 54800.0, -0.12),
        row(V, "v1", 6, "2023-12-31 23:59:55", 0.0001, 0.7, 65192.5, 65192.5, 6.84, 0.0000384784, 65192.5, 0.001),
    ]


@pytest.fixture(scope="module")
def gold_rows(spark):
    rows = frame(spark, SILVER, gold_input())
    settlements = frame(spark, schemas.SETTLEMENTS, [
        dict(index_name="btc_usd", date=d, delivery_price=p) for d, p in (("2024-01-01", 55000.0), ("2023-12-31", 54900.0))])
    vol = frame(spark, schemas.VOL_INDEX, [
        dict(currency="BTC", timestamp=at(d), volatility_value=v) for d, v in (("2023-12-24", 50.0), ("2023-12-26", 55.0), ("2023-12-29", 60.0))])
    full = gold(rows, settlements, vol)
    return full.columns, {r.trade_id: r for r in full.collect()}, {r.trade_id: r for r in gold(rows).collect()}


def test_gold_columns(gold_rows):
    columns, _, _ = gold_rows
    assert columns == schemas.GOLD_COLUMNS + ["currency"] and len(schemas.GOLD_COLUMNS) == 39
    assert [c for c in columns if c.startswith("outcome_")] == schemas.OUTCOME_COLUMNS


def test_gold_outcomes(gold_rows):
    _, rows, bare = gold_rows
    assert all(r.outcome_settlement_price == 55000.0 for r in rows.values())
    assert rows["t1"].outcome_assignment_inferred and not rows["u1"].outcome_assignment_inferred
    assert rows["t1"].outcome_days_to_assignment == rows["t1"].days_to_expiry == 7
    assert rows["u1"].outcome_days_to_assignment is None
    for r in bare.values():
        assert (r.outcome_settlement_price, r.outcome_assignment_inferred, r.outcome_days_to_assignment) == (None,) * 3


def test_gold_execution(gold_rows):
    _, rows, _ = gold_rows
    for tid in ("t1", "t2", "t3", "u1", "u2"):
        r = rows[tid]
        assert r.premium_collection_ratio == pytest.approx(r.price * r.amount / r.expected_premium)
        assert r.bid_ask_spread_estimate is None or r.bid_ask_spread_estimate >= 0
    assert rows["v1"].expected_premium is not None and rows["v1"].premium_collection_ratio is None
    assert (rows["t3"].trade_volume_7day, rows["t1"].trade_volume_7day) == (3, 1)
    assert rows["t3"].actual_premium_collected == pytest.approx(0.05 + 0.052 + 0.12)


def test_gold_market_state(gold_rows):
    _, rows, bare = gold_rows
    assert [rows[t].exchange_realized_vol for t in ("t1", "t2", "t3")] == [50.0, 55.0, 60.0]
    assert all(r.exchange_realized_vol is None for r in bare.values())
    assert all(r.iv_percentile_90day is None and r.vol_regime is None for r in rows.values())
    assert rows["t3"].iv_percentile_sample_size == 5  # IVs known by the end of its day
    steps = [math.log(b / a) for a, b in ((54000, 54000), (54000, 54500), (54500, 54800), (54800, 55000))]
    mean = sum(steps) / 4
    sd = math.sqrt(sum((x - mean) ** 2 for x in steps) / 3)
    assert rows["t3"].realized_vol_7day == pytest.approx(sd * math.sqrt(8760))
    assert rows["t1"].realized_vol_7day is None
    # 2023-12-25 plus seven days: nothing printed at or after 2024-01-01.
    assert all(r.outcome_forward_return_7day is None for r in rows.values())


def test_later_rows_do_not_change_entry_columns(spark):
    base = gold_input()
    more = base + [silver_row(C, "x", 9, "2024-01-09", futures_price=70000.0, delta=0.5, implied_volatility=80.0)]
    entry = [c for c in schemas.GOLD_COLUMNS if not c.startswith("outcome_")]
    before = {r.trade_id: tuple(r) for r in gold(frame(spark, SILVER, base)).select(*entry).collect()}
    after = {r.trade_id: tuple(r) for r in gold(frame(spark, SILVER, more)).select(*entry).collect()}
    # instrument_name is the first column, trade_id the second
    assert {t: v for t, v in after.items() if t != "x"} == before


# --- bronze, ingest, storage ---

def api_trade(seq, ts=1717200600000, name="BTC-1JUL24-50000-C", **over):
    t = dict(trade_seq=seq, trade_id=f"t{seq}", timestamp=ts, tick_direction=1, price=0.05, mark_price=0.049,
             instrument_name=name, index_price=54000.5, direction="buy", amount=1.0, iv=60.5)
    t.update(over)
    return {k: v for k, v in t.items() if v != "missing"}


def test_json_ingest(spark, tmp_path):
    lines = [json.dumps(api_trade(1)), json.dumps(api_trade(2, iv=None, mark_price="missing")),
             json.dumps(api_trade(3, direction="hold")), json.dumps(api_trade(4, price="missing")), "{broken", "",
             json.dumps(api_trade(5, price="abc"))]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    good, bad = bronze.ingest_trade_json(spark, str(tmp_path))
    assert sorted(r.trade_seq for r in good.collect()) == [1, 2]
    assert bad.count() == 4
    typed = {r.trade_seq: r for r in bronze.build_bronze_options(good).collect()}
    assert typed[1].timestamp == at("2024-06-01 00:10:00") and typed[1].strike == 50000.0
    assert typed[1].implied_volatility == 60.5 and typed[2].mark_price is None
    assert typed[1].time_to_expiry_years == pytest.approx((30 * 86400 + 7 * 3600 + 50 * 60) / (365.25 * 86400))
    assert bronze.rename_api_trade(good).columns[:5] == ["id", "instrumentName", "indexPrice", "markPrice", "impliedVolatility"]


def test_bronze_rejects_unknown_names(spark):
    raw = spark.createDataFrame([api_trade(1, name="BTC-WHAT")], schemas.API_TRADE)
    with pytest.raises(Exception, match="invalid instrument"):
        bronze.build_bronze_options(raw).collect()


def test_bronze_futures_terms_are_null(spark):
    raw = spark.createDataFrame([api_trade(1, name="BTC-1JUL24"), api_trade(2, name="BTC-PERPETUAL")], schemas.API_TRADE)
    rows = {r.instrument_name: r for r in bronze.build_bronze_options(raw).collect()}
    assert rows["BTC-1JUL24"].strike is None and rows["BTC-1JUL24"].expiration_timestamp == at("2024-07-01 08:00:00")
    assert rows["BTC-PERPETUAL"].time_to_expiry_years is None
    assert bronze.build_bronze_futures(raw).columns == [f.name for f in schemas.FUTURES_TRADES]


def test_reference_tables(spark):
    s = bronze.build_settlements(spark.createDataFrame([("2024-01-01", 42000)], "date string, delivery_price int"), "btc_usd").first()
    assert (s.index_name, s.timestamp, s.delivery_price) == ("btc_usd", at("2024-01-01"), 42000.0)
    v = bronze.build_vol_index(spark.createDataFrame([("[[1704067200000, 55.5], [1704070800000, 56]]",)], "result string"), "BTC").collect()
    assert [(r.timestamp, r.volatility_value) for r in v] == [(at("2024-01-01 00:00:00"), 55.5), (at("2024-01-01 01:00:00"), 56.0)]
    i = bronze.build_instruments(spark.createDataFrame([("BTC-PERPETUAL", "future", "BTC", True)],
                                 "instrument_name string, kind string, base_currency string, is_active boolean"))
    assert i.columns == [f.name for f in schemas.INSTRUMENTS] and i.first().strike is None


def test_merge_keeps_existing_and_new_duplicates(spark):
    cols = "instrument_name string, trade_seq bigint, src string"
    old = spark.createDataFrame([("a", 1, "old"), ("a", 2, "old")], cols)
    new = spark.createDataFrame([("a", 2, "new"), ("a", 3, "new"), ("a", 3, "new2"), ("b", 1, "new")], cols)
    got = sorted((r.instrument_name, r.trade_seq, r.src) for r in bronze.merge_trades(old, new).collect())
    assert got == [("a", 1, "old"), ("a", 2, "old"), ("a", 3, "new"), ("a", 3, "new2"), ("b", 1, "new")]


def test_files_name_the_instrument(spark, tmp_path):
    trades = frame(spark, schemas.OPTION_TRADES, [option_row("t1", 1, "2024-06-01 00:10:00", instrument_name="wrong")])
    source = tmp_path / "raw"
    trades.coalesce(1).write.parquet(str(source))
    part = next(f for f in os.listdir(source) if f.endswith(".parquet"))
    folder = tmp_path / "instruments" / "BTC"
    folder.mkdir(parents=True)
    os.rename(source / part, folder / "BTC-1JUL24-50000-C.parquet")
    read = readers.read_option_trades(spark, str(tmp_path / "instruments"))
    assert read.first().instrument_name == "BTC-1JUL24-50000-C"
    row = quality.tape_inventory(read, F.col("instrument_name"), F.col("instrument_name")).first()
    assert (row.file_count, row.trade_count, row.instrument_count) == (1, 1, 1)


def test_round_trip_and_optional_inputs(spark, tmp_path):
    rows = frame(spark, SILVER, gold_input())
    writers.write_silver(rows, str(tmp_path / "silver"))
    back = readers.read_silver(spark, str(tmp_path / "silver"), "BTC")
    assert back.count() == 6 and readers.read_silver(spark, str(tmp_path / "silver"), "ETH").count() == 0
    writers.write_gold(gold(back.drop("currency")), str(tmp_path / "gold"))
    assert readers.read_gold(spark, str(tmp_path / "gold")).count() == 6
    for path in (None, str(tmp_path / "nowhere")):
        none = readers.optional_input(spark, path, readers.read_settlements, schemas.SETTLEMENTS)
        assert none.count() == 0
    writers.write_table(frame(spark, schemas.SETTLEMENTS, [dict(index_name="btc_usd", date="2024-01-01", delivery_price=1.0)]),
                        str(tmp_path / "settlements"))
    assert readers.read_settlements(spark, str(tmp_path / "settlements")).first().delivery_date == dt.date(2024, 1, 1)


def test_stream_appends_only_new_trades(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "tape", "state"))
    os.mkdir(source)

    def run():
        good, _ = stream_trades(spark, source)
        q = (good.writeStream.foreachBatch(append_new_trades(target)).option("checkpointLocation", state)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    with open(f"{source}/1.jsonl", "w") as f:
        f.write("\n".join(json.dumps(api_trade(i)) for i in (1, 2, 2)))
    run()
    with open(f"{source}/2.jsonl", "w") as f:
        f.write("\n".join(json.dumps(api_trade(i)) for i in (2, 3)) + "\n{bad")
    run()
    assert sorted(r.trade_seq for r in spark.read.parquet(target).collect()) == [1, 2, 3]
    # a late trade, a correction under another date, an unknown name, and a repeat inside the batch
    day = 86_400_000
    first = api_trade(9)["timestamp"]
    late = [api_trade(4) | {"timestamp": first - 400 * day}, api_trade(3) | {"timestamp": first + 5 * day},
            api_trade(7) | {"instrument_name": "???"}, api_trade(5) | {"timestamp": first + 2, "trade_id": "b"},
            api_trade(5) | {"timestamp": first + 1, "trade_id": "a"}]
    with open(f"{source}/3.jsonl", "w") as f:
        f.write("\n".join(map(json.dumps, late)))
    run()
    got = {r.trade_seq: r for r in spark.read.parquet(target).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5] and got[5].trade_id == "a"
    assert [r.instrument_name for r in spark.read.parquet(f"{target}_rejected").collect()] == ["???"]
    # a batch replayed after a crash between the two writes
    shutil.rmtree(f"{target}_keys")
    good, _ = split_trade_json(spark.read.text(f"{source}/3.jsonl"))
    append_new_trades(target)(good.filter("trade_seq <> 3"), 2)
    assert spark.read.parquet(target).count() == 5


def test_spark_writes_one_folder_per_instrument(spark, tmp_path):
    rows = [option_row(f"t{i}", i, "2024-06-01 00:10:00", instrument_name=n)
            for i, n in enumerate(["BTC-1JUL24-50000-C", "ETH-1JUL24-3000-P", "BTC-1JUL24-50000-C"])]
    writers.write_instrument_files(frame(spark, schemas.OPTION_TRADES, rows), str(tmp_path / "tape"))
    read = readers.read_option_trades(spark, str(tmp_path / "tape"))
    assert sorted(r.instrument_name for r in read.collect()) == sorted(r["instrument_name"] for r in rows)
    row = quality.tape_inventory(read, readers.file_stem(), F.col("instrument_name")).first()
    assert (row.file_count, row.trade_count, row.instrument_count) == (2, 3, 2)


def test_strict_percentile_ranks_new_bins(spark):
    rows = [("BTC", dt.datetime(2024, 1, 1, 1), f"a{i}", 50.0 + i % 5 / 2) for i in range(30)]
    rows.append(("BTC", dt.datetime(2024, 1, 2, 1), "new", 80.0))
    df = spark.createDataFrame(rows, "currency string, timestamp timestamp_ntz, trade_id string, implied_volatility double")
    got = {r.trade_id: r for r in with_iv_percentile(df, strict_past=True).collect()}
    assert (got["new"].iv_percentile_90day, got["new"].iv_percentile_sample_size) == (1.0, 30)
    assert got["a0"].iv_percentile_90day is None and got["a0"].iv_percentile_sample_size is None


def test_iv_rank_is_per_currency(spark):
    rows = [("BTC", dt.datetime(2024, 1, 1, h), f"b{h}", 40.0 + h) for h in range(21)]
    rows += [("ETH", dt.datetime(2024, 1, 1, 5), "e", 200.0), ("BTC", dt.datetime(2024, 1, 3), "x", 60.0),
             ("BTC", dt.datetime(2024, 12, 30, 0), "y", 60.0), ("BTC", dt.datetime(2024, 12, 31, 10), "z", 50.0)]
    df = spark.createDataFrame(rows, "currency string, timestamp timestamp_ntz, trade_id string, implied_volatility double")
    got = {r.trade_id: r for r in with_iv_rank(df).collect()}
    assert got["x"].iv_rank_52w == 100.0 and (got["x"].iv_52w_low, got["x"].iv_52w_high) == (40.0, 60.0)
    # 364 days back from the hour itself
    assert got["y"].iv_52w_low == 40.0 and got["z"].iv_52w_low == 60.0 and got["e"].iv_52w_low is None


def test_prints_without_a_key_go_round_the_window(spark):
    left = spark.createDataFrame([(None, dt.datetime(2024, 1, 1), i) for i in range(200)] + [
        ("f", dt.datetime(2024, 1, 1, 0, 30), 500), ("f", dt.datetime(2024, 1, 1, 2), 501)],
        "k string, at timestamp_ntz, id int")
    right = spark.createDataFrame([("f", dt.datetime(2024, 1, 1), 1.0), (None, dt.datetime(2024, 1, 1), 2.0)],
                                  "k string, ts timestamp_ntz, v double")
    got = asof_join(left, right, "k", "at", "ts", {"v": "v"}, tolerance_seconds=3600, max_rows_per_cell=10)
    assert {r.id: r.v for r in got.collect()} == {i: None for i in range(200)} | {500: 1.0, 501: None}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(k" in plan and "isnull(k" in plan


# --- quality ---

def test_missing_instruments_are_named(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "instrument_name string")
    tape = spark.createDataFrame([("a",)], "instrument_name string")
    quality.require_complete(expected, tape.unionByName(expected))
    with pytest.raises(quality.MissingInstrumentsError, match="1 instruments without trades, first: b"):
        quality.require_complete(expected, tape)
    many = spark.range(50).selectExpr("concat('x', id) AS instrument_name")
    with pytest.raises(quality.MissingInstrumentsError) as error:
        quality.require_complete(many, tape)
    assert error.value.missing.count() == 50


def test_seq_gaps_across_blocks(spark):
    block = quality.SEQ_BLOCK
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 5), ("a", block + 3), ("b", 7)], "instrument_name string, trade_seq bigint")
    got = sorted((r.gap_start, r.gap_end, r.missing) for r in quality.seq_gaps(df).collect())
    assert got == [(3, 4, 2), (6, block + 2, block - 3)]


def test_filters(spark):
    with pytest.raises(ValueError, match="forward-looking"):
        quality.entry_filter(spark.range(1), equals={"outcome_assignment_inferred": True})
    df = spark.createDataFrame([("BTC", 0.2, "OTM"), ("BTC", 0.9, "ITM"), ("ETH", 0.2, "OTM")], "currency string, delta double, moneyness string")
    assert quality.risk_filter(df, "BTC", {"delta": (0.1, 0.5)}, ["OTM"]).count() == 1
    assert quality.fetch_list(df, df).count() == 6
    assert quality.options_only(df.withColumn("option_type", F.lit(None).cast("string"))).count() == 0
