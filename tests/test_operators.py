"""Edge cases of the table operators, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators import quality
from marketlake.operators.baselines import rolling_averages, trailing_baselines
from marketlake.operators.cleaning import drop_incomplete, one_per_key
from marketlake.operators.history import cumulative_prices, dim_daily
from marketlake.operators.latest import latest_per_key, ranked_latest, session_bars
from marketlake.operators.merge import merge_update, merge_upsert
from marketlake.plans import reports
from marketlake.plans.marts import init_current_day, init_metrics, on_date
from marketlake.plans.metrics import current_day_enriched, price_change_metrics, refresh_metrics
from marketlake.sources import inline, pages, payloads, wide

D = dt.date
T = dt.datetime


def fact(spark, rows):
    """(ticker, date, close) -> fact rows."""
    full = [(t, c, c, c, c, 1, d) for t, d, c in rows]
    return spark.createDataFrame(full, schemas.FACT)


def test_history_keeps_null_closes_and_puts_undated_rows_last(spark):
    df = fact(spark, [("A", D(2024, 1, 3), 3.0), ("A", None, 9.0), ("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 2), None)])
    row = cumulative_prices(df).first()
    assert row.price_history == [1.0, None, 3.0, 9.0] and row.last_updated == D(2024, 1, 3)
    dim = dim_daily(df).first()
    assert (dim.latest_price, dim.historic_low, dim.historic_high) == (3.0, 1.0, 9.0)
    assert dim.price_history == row.price_history


def test_latest_close_may_be_null(spark):
    df = fact(spark, [("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 2), None)])
    assert dim_daily(df).first().latest_price is None


def test_one_per_key_is_deterministic_and_keeps_every_key(spark):
    rows = [("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 1), 2.0), ("B", D(2024, 1, 1), None), ("B", D(2024, 1, 1), None)]
    df = fact(spark, rows)
    kept = [
        {tuple(r) for r in one_per_key(df.repartition(n), ["ticker", "trade_date"]).collect()} for n in (1, 2, 4)
    ]
    assert kept[0] == kept[1] == kept[2] and kept[0] < {tuple(r) for r in df.collect()}
    assert sorted(row[0] for row in kept[0]) == ["A", "B"]


@pytest.mark.parametrize("latest_of", [latest_per_key, ranked_latest])
def test_latest_per_key_ranks_missing_times_last(spark, latest_of):
    df = fact(spark, [("A", None, 1.0), ("A", D(2024, 1, 1), 2.0), ("B", None, 3.0)])
    got = {(r.ticker, r.close_price) for r in latest_of(df, ["ticker"], "trade_date").collect()}
    assert got == {("A", 2.0), ("B", 3.0)}


def test_latest_rows_stay_whole_when_times_tie(spark):
    at = dt.date(2024, 1, 1)
    df = spark.range(1000, numPartitions=8).select(
        (F.col("id") % 3).alias("k"), F.lit(at).alias("day"), F.col("id").alias("a"), (-F.col("id")).alias("b")
    )
    rows = latest_per_key(df, ["k"], "day").collect()
    assert len(rows) == 3 and all(r.a == -r.b and r.a % 3 == r.k for r in rows)


def test_drop_incomplete_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, x double")
    assert [r.id for r in drop_incomplete(df).collect()] == [1]


def test_session_bars(spark):
    at = lambda h: T(2024, 1, 5, h)
    day = D(2024, 1, 5)
    rows = [("A", day, 2.0, 1.0, 3.0, 0.5, 10, at(14)), ("A", day, 4.0, 2.0, 9.0, 1.5, 5, at(15))]
    row = session_bars(inline.current_day_values(spark, rows)).select(*schemas.CURRENT_DAY.fieldNames()).first()
    assert tuple(row) == ("A", day, 4.0, 1.0, 9.0, 0.5, 15, at(15))


def test_baseline_windows_end_at_the_as_of_date(spark):
    end = D(2024, 12, 31)
    df = fact(spark, [
        ("A", end, 10.0), ("A", end - dt.timedelta(days=89), 20.0), ("A", end - dt.timedelta(days=90), 60.0),
        ("A", end - dt.timedelta(days=365), 1000.0), ("B", end - dt.timedelta(days=400), 5.0),
    ])
    got = {r.ticker: tuple(r)[1:] for r in trailing_baselines(df).collect()}
    assert got == {"A": (10.0, 15.0, 30.0), "B": (5.0, None, None)}
    earlier = trailing_baselines(df, (90,), F.lit(end - dt.timedelta(days=1))).where("ticker = 'A'").first()
    assert tuple(earlier) == ("A", 20.0, 40.0)


def test_rolling_averages_against_brute_force(spark):
    start = D(2023, 1, 1)
    bars = [("A", start + dt.timedelta(days=i * i % 700), round(10 + (i * 37 % 101) / 7, 4)) for i in range(60)]
    bars = list({d: (t, d, c) for t, d, c in bars}.values()) + [("B", start, None), ("B", start + dt.timedelta(days=3), 4.0)]
    got = {(r.ticker, r.trade_date): (r.avg_90d, r.avg_365d) for r in rolling_averages(fact(spark, bars)).collect()}
    assert len(got) == len(bars)
    for ticker, day, _ in bars:
        for n, mean in zip((90, 365), got[ticker, day]):
            closes = [c for t, d, c in bars if t == ticker and c is not None and 0 <= (day - d).days < n]
            assert mean is None if not closes else mean == pytest.approx(sum(closes) / len(closes), abs=1e-4)


# --- merges --------------------------------------------------------------------------------


def test_update_only_drops_unmatched_and_writes_nulls(spark):
    target = spark.createDataFrame([("A", 1.0, "x"), ("B", 2.0, "y")], "k string, p double, other string")
    source = spark.createDataFrame([("A", None), ("C", 9.0)], "k string, p double")
    got = {tuple(r) for r in merge_update(target, source, ["k"]).collect()}
    assert got == {("A", None, "x"), ("B", 2.0, "y")}


def test_upsert_inserts_and_overwrites_with_null(spark):
    target = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "k string, d int, p double")
    source = spark.createDataFrame([("A", 1, None), ("A", 2, 7.0)], "k string, d int, p double")
    got = {tuple(r) for r in merge_upsert(target, source, ["k", "d"]).collect()}
    assert got == {("A", 1, None), ("B", 1, 2.0), ("A", 2, 7.0)}


@pytest.mark.parametrize("merge", [merge_update, merge_upsert])
def test_merge_rejects_a_repeated_source_key(spark, merge):
    target = spark.createDataFrame([("A", 1.0)], "k string, p double")
    source = spark.createDataFrame([("A", 2.0), ("A", 3.0)], "k string, p double")
    with pytest.raises(PySparkException, match="repeats key"):
        merge(target, source, ["k"]).collect()


def test_last_writer_wins_unless_newer_only(spark):
    target = spark.createDataFrame([("A", 1.0, 5), ("B", 1.0, None)], "k string, p double, ts int")
    older = spark.createDataFrame([("A", 9.0, 4), ("B", 9.0, 1)], "k string, p double, ts int")
    assert {tuple(r) for r in merge_upsert(target, older, ["k"]).collect()} == {("A", 9.0, 4), ("B", 9.0, 1)}
    kept = merge_upsert(target, older, ["k"], newer_only="ts").collect()
    assert {tuple(r) for r in kept} == {("A", 1.0, 5), ("B", 9.0, 1)}


# --- current day, metrics, reports -----------------------------------------------------------


def test_seeds_and_today(spark):
    df = fact(spark, [("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 2), 2.0), ("B", D(2024, 1, 1), 3.0)])
    seeds = init_current_day(df)
    assert {(r.ticker, r.last_price, r.last_updated_ts) for r in seeds.collect()} == {("A", 2.0, None), ("B", 3.0, None)}
    assert [r.ticker for r in on_date(seeds).collect()] == ["A"]
    assert seeds.schema.fieldNames() == schemas.CURRENT_DAY.fieldNames()


def baselines(spark):
    return spark.createDataFrame(
        [("A", 10.0, 8.0, 0.0), ("B", 10.0, None, 5.0)],
        "ticker string, close_price_last_day double, close_price_avg_last_90_days double,"
        " close_price_avg_last_365_days double",
    )


def prices(spark):
    return spark.createDataFrame([("A", 12.0), ("Z", 1.0)], "ticker string, current_price double").withColumn(
        "last_updated_ts", F.expr("TIMESTAMP_NTZ '2024-01-05 15:00:00'")
    )


def test_metrics_need_known_baselines(spark):
    row, = price_change_metrics(prices(spark), baselines(spark)).collect()
    assert tuple(row)[3:] == (2.0, 20.0, 4.0, 50.0, 12.0, None)


def test_refresh_updates_only_priced_tickers(spark):
    details = spark.createDataFrame([("A",) + (None,) * 4 + ("Mega Cap",) + (None,) * 2], schemas.DETAILS)
    table = init_metrics(baselines(spark), details)
    assert table.schema.fieldNames() == schemas.METRICS.fieldNames()
    rows = {r.ticker: r for r in refresh_metrics(table, prices(spark)).collect()}
    assert set(rows) == {"A", "B"}
    assert (rows["A"].m_price_change_last_day_pct, rows["A"].m_price_change_last_365_days_pct) == (20.0, None)
    assert rows["A"].market_cap_description == "Mega Cap"
    assert rows["B"].current_price is None and rows["B"].market_cap_description == "Not Provided"


def test_enriched_leaves_out_zero_opens_and_volumes(spark):
    day = D(2024, 1, 5)
    rows = [("A", day, 11.0, 10.0, 1.0, 1.0, 3, None), ("B", day, 1.0, 0.0, 1.0, 1.0, 3, None), ("C", day, 1.0, 1.0, 1.0, 1.0, 0, None)]
    row, = current_day_enriched(inline.current_day_values(spark, rows)).collect()
    assert (row.ticker, row.pct_change, row.dollar_volume) == ("A", 10.0, 33.0)


def test_first_last_close_needs_both_global_dates(spark):
    lo, mid, hi = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    df = fact(spark, [("A", lo, 1.0), ("A", mid, 5.0), ("A", hi, 2.0), ("B", lo, 1.0), ("C", hi, 1.0), ("N", lo, None), ("N", hi, 4.0)])
    got = {tuple(r) for r in reports.first_last_close(df).collect()}
    assert got == {("A", 1.0, 2.0), ("N", None, 4.0)}


def test_ranking_survives_a_zero_start_and_breaks_ties_by_ticker(spark):
    edges = spark.createDataFrame(
        [("B", 1.0, 2.0), ("A", 1.0, 2.0), ("Z", 0.0, 2.0)], "ticker string, earliest_close double, latest_close double"
    )
    details = spark.createDataFrame([(t, t, "S", None, None, None, None, None) for t in "ABZ"], schemas.DETAILS)
    rows = reports.stock_ranking(edges, details).collect()
    assert [(r.ticker, r.total_return_pct) for r in rows] == [("A", 100.0), ("B", 100.0), ("Z", None)]
    assert reports.sector_performance(edges, details).first().avg_return_pct == 100.0


def test_top_moves_and_changes_break_ties_by_ticker(spark):
    rows = spark.createDataFrame([("B", 1.0, 5.0), ("A", 1.0, 5.0), ("C", 1.0, 0.0), ("D", 1.0, -5.0)], "ticker string, current_price double, m double")
    assert [r.ticker for r in reports.top_moves(rows, "m", True, 1).collect()] == ["A"]
    assert [r.ticker for r in reports.top_moves(rows, "m", False).collect()] == ["D"]
    changes = rows.withColumnRenamed("m", "pct_change")
    assert [r.ticker for r in reports.top_change(changes, True, 2).collect()] == ["A", "B"]


# --- quality -------------------------------------------------------------------------------


def test_checks_report_and_raise(spark):
    df = fact(spark, [("A", D(2024, 1, 1), None), ("B", D(2024, 1, 1), 1.0)])
    flags = quality.null_checks(df, {"t": "ticker", "c": "close_price"}).first()
    assert tuple(flags) == (True, False)
    report = quality.quality_report(df, dim_daily(df.where("ticker = 'A'")))
    assert {r.check_name: r.passed for r in report.collect()} == {
        "ticker not null": True, "close_price not null": False, "trade_date not null": True,
        "dim rows match tickers": False,
    }
    with pytest.raises(ValueError, match="close_price"):
        quality.require(report)


def test_sanity_counts_one_date(spark):
    rows = [("A", D(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1, T(2024, 1, 2, 15)), ("B", D(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1, None)]
    verdict = quality.current_day_sanity(inline.current_day_values(spark, rows), min_rows=2)
    assert tuple(verdict.first()) == (1, "2024-01-02 15:00:00.000000", False)
    with pytest.raises(ValueError):
        quality.require(verdict)


# --- sources -------------------------------------------------------------------------------


def test_payloads(spark):
    docs = [
        '{"bars": {"BRK-B": {"c": 401, "t": "2024-01-05T15:30:00Z"}, "A": {"c": 1.5, "t": "2024-01-05T15:30:00.25Z"}}}',
        '{"bars": {}}', "{}", "not json", '{"bars": null}',
    ]
    df = spark.createDataFrame([(d,) for d in docs], "payload string")
    got = {tuple(r) for r in payloads.explode_bars(df).collect()}
    assert got == {("BRK.B", 401.0, T(2024, 1, 5, 15, 30)), ("A", 1.5, T(2024, 1, 5, 15, 30, 0, 250000))}


def test_company_defaults(spark):
    df = spark.createDataFrame([('{"symbol": "BF-B", "marketCap": 3000000000}',)], "payload string")
    assert tuple(payloads.flatten_company(df).first()) == ("BF.B", "", "", "", 3e9, "Mid Cap", "", "")


def test_wide_frames_drop_incomplete_bars_and_round(spark):
    columns = "Date date, " + ", ".join(
        f"`{s}_{f}` double" for s in ("BRK-B", "X") for f in ("Open", "High", "Low", "Close", "Volume")
    )
    rows = [(D(2024, 1, 5), 1.00004, 2.0, 0.5, 1.123456, 10.0, None, 2.0, 0.5, 1.0, 10.0)]
    out = wide.melt_bars(spark.createDataFrame(rows, columns))
    assert out.schema.simpleString() == schemas.STAGING.simpleString()
    assert [tuple(r) for r in out.collect()] == [("BRK.B", D(2024, 1, 5), 1.0, 2.0, 0.5, 1.1235, 10)]
    raw = wide.melt_bars(spark.createDataFrame(rows, columns), places=None).first()
    assert raw.close == 1.123456


def test_first_table_column(spark):
    html = [
        (1, "<p>x</p><TABLE id=a><tr><th>Name</th><th><b> Symbol </b></th></tr>"
            "<tr><td>Berk</td><td><a href='#'>BRK.B</a>\n</td></tr><tr><td>short</td></tr></TABLE>"
            "<table><tr><th>Symbol</th></tr><tr><td>no</td></tr></table>"),
        (2, "<table><tr><th>Other</th></tr><tr><td>no</td></tr></table>"),
        (3, "no table"), (4, None), (5, "<table></table>"),
    ]
    df = spark.createDataFrame(html, "page_id int, html string")
    assert [tuple(r) for r in pages.first_table_column(df, "Symbol").collect()] == [(1, "BRK.B")]


def test_wide_lines_melt_without_growing_plans(spark):
    def lines(symbols, *more):
        header = ",".join(["Date", *(f"{s}_{f}" for s in symbols for f in ("Open", "High", "Low", "Close", "Volume"))])
        rows = [header, *more]
        return spark.createDataFrame([(r,) for r in rows], "value string")

    frame = lines(["A", "BRK-B", "x_y"], "2024-01-05,1,2,0.5,1.23456,10,,,,,NaN,3,3,3,3,7.0", "bad,1,1,1,1,1", "2024-01-08,1,1,1,inf,3,4,5,4,4.5,6", "")
    got = wide.melt_bar_lines(frame.unionByName(frame.limit(1)))
    assert {(r.ticker, str(r.snapshot_date), r.close, r.volume) for r in got.collect()} == {
        ("A", "2024-01-05", 1.2346, 10), ("x_y", "2024-01-05", 3.0, 7), ("BRK.B", "2024-01-08", 4.5, 6),
    }
    assert wide.melt_bar_lines(frame.limit(0)).count() == 0
    assert wide.melt_bar_lines(lines([], "2024-01-05,1")).count() == 0
    sizes = [len(wide.melt_bar_lines(lines([f"S{n}" for n in range(k)]))._jdf.queryExecution().optimizedPlan().toString()) for k in (5, 500)]
    assert sizes[0] == sizes[1]
    clock = spark.createDataFrame([("Datetime,A_Open,A_High,A_Low,A_Close,A_Volume",), ("2024-07-05 09:30:00,1,2,1,2,5",)], "value string")
    row = wide.melt_intraday_lines(clock, "America/New_York").first()
    assert (str(row.last_updated_ts), str(row.trade_date), row.last_price) == ("2024-07-05 13:30:00", "2024-01-05".replace("-01-", "-07-"), 2.0)
