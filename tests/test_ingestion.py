"""Paths, conversions, flattening, landing, staging, audit and publication."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from bourse import contracts
from bourse.contracts import Contract, Field
from bourse.functions import paths
from bourse.functions.convert import convert, ms_to_date, ms_to_timestamp, scaled_units, text_to_date
from bourse.operators import checks as c
from bourse.operators.flatten import batch_key, flatten, route, zip_and_explode
from bourse.operators.loadplan import missing_loads, window_request
from bourse.plans.ingest import ingest, quality_result, source_freshness
from bourse.sources import landing, published

SAMPLE = Contract("test_source", "test_resource", (
    Field("price", "prices.current", "float"),
    Field("timestamp", "meta.ts", "timestamp_ms_to_datetime", partition_key=True),
    Field("id", "id", "string"),
))
DAY_MS = 86_400_000
DAY0 = 1_767_225_600_000  # 2026-01-01 UTC


def one(spark, text, contract):
    return landing.parse_responses(spark.createDataFrame([(text,)], "response string"), "response", contract)


def project(spark, payload, **wanted):
    schema = paths.payload_schema(wanted.pop("types"))
    df = spark.createDataFrame([(json.dumps(payload),)], "j string").select(F.from_json("j", schema).alias("p"))
    return df.select(*[paths.project(F.col("p"), schema, path).alias(n) for n, path in wanted.items()]).first()


def test_paths(spark):
    payload = {"prices": {"current": 100.5}, "items": [{"id": 1, "v": [1, 2]}, {"id": 2}], "text": "x"}
    types = {"prices.current": "double", "items[*].id": "bigint", "items[*].v[*]": "bigint", "items[1].id": "bigint",
             "none[*].id": "bigint"}
    row = project(spark, payload, types=types, dotted="prices.current", wild="items[*].id", nested="items[*].v[*]",
                  indexed="items[1].id", beyond="items[7].id", absent="prices.nothing", container="none[*].id")
    assert row.dotted == 100.5 and row.wild == [1, 2] and row.nested == [[1, 2], None]
    assert row.indexed == 2 and row.beyond is None and row.absent is None and row.container == []


def test_conversions(spark):
    df = spark.createDataFrame([(1609459200000, "2021-01-02"), (0, "2021/01/02"), (None, "02-01-2021"), (-1, "soon")],
                               "ms bigint, s string")
    out = df.select(ms_to_timestamp(F.col("ms")).alias("t"), ms_to_date(F.col("ms")).alias("d"),
                    text_to_date(F.col("s")).alias("s")).collect()
    assert out[0].t.year == 2021 and out[0].d == dt.date(2021, 1, 1)
    assert out[1].t is None and out[1].d is None and out[2].d is None
    assert out[3].d == dt.date(1969, 12, 31)
    assert [r.s for r in out] == [dt.date(2021, 1, 2)] * 3 + [None]


def test_conversion_of_arrays_and_bad_values(spark):
    df = spark.createDataFrame([(["1.5", "x", None],)], "a array<string>")
    assert df.select(convert(F.col("a"), "float", is_array=True)).first()[0] == [1.5, None, None]


def test_dates_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert spark.range(1).select(ms_to_date(F.lit(1609459200000))).first()[0] == dt.date(2021, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unit_scaling(spark):
    df = spark.createDataFrame([("1789724345320037", 18), ("5008826", 6), ("9" * 70, 6), ("no", 6)], "raw string, d int")
    got = [r[0] for r in df.select(scaled_units(F.col("raw"), F.col("d"))).collect()]
    assert got[0] == pytest.approx(0.001789724345320037) and got[1] == 5.008826
    assert got[2] == pytest.approx(1e64) and got[3] is None


def test_scalar_response_gives_one_row(spark):
    flat = flatten(one(spark, '{"prices":{"current":50000.0},"meta":{"ts":1609459200000},"id":"btc"}', SAMPLE), SAMPLE)
    row = flat.collect()
    assert len(row) == 1 and row[0].price == 50000.0 and row[0].id == "btc"
    assert row[0].timestamp is not None and row[0]["__batch_id"] and row[0]["__source_name"] == "test_source"
    assert row[0]["__schema_version"] == SAMPLE.schema_version


def test_zip_follows_the_first_array(spark):
    df = spark.createDataFrame([([1, 2, 3], [10], [7, 8, 9, 10], "s"), (None, [1], [1], "t"), ([], [1], [1], "u")],
                               "a array<int>, b array<int>, c array<int>, k string")
    got = [tuple(r) for r in zip_and_explode(df, ["a", "b", "c"], ["k"]).collect()]
    assert got == [("s", 1, 10, 7), ("s", 2, None, 8), ("s", 3, None, 9)]


def test_series_contract(spark):
    payload = {"prices": [[DAY0, 10.0], [DAY0 + DAY_MS, 11]], "market_caps": [[DAY0, 5.0]], "total_volumes": []}
    flat = flatten(one(spark, json.dumps(payload), contracts.CRYPTO_SERIES), contracts.CRYPTO_SERIES, batch_id="b")
    got = [(r.data_date.isoformat(), r.price_usd, r.market_cap_usd, r.volume_24h_usd) for r in flat.collect()]
    assert got == [("2026-01-01", 10.0, 5.0, None), ("2026-01-02", 11.0, None, None)]


def test_request_parameter_and_missing_arrays(spark):
    responses = one(spark, '{"other": 1}', contracts.STOCK_BARS)
    assert flatten(responses, contracts.STOCK_BARS, {"ticker": "AAPL"}, "b").count() == 0
    responses = one(spark, json.dumps({"results": [{"t": DAY0, "c": 3}]}), contracts.STOCK_BARS)
    row = flatten(responses, contracts.STOCK_BARS, {"ticker": "AAPL"}, "b").first()
    assert row.ticker == "AAPL" and row.close == 3.0 and row.open is None


def test_schema_version_follows_the_shape():
    base = contracts.RATE_BARS
    assert len(base.schema_version) == 8
    assert base.schema_version == Contract("x", "y", tuple(reversed(base.fields))).schema_version
    assert base.schema_version != contracts.STOCK_BARS.schema_version


def test_batch_key(spark):
    day = F.lit("2026-01-05").cast("date")
    row = spark.range(1).select(batch_key("massive", "forex", day, F.lit("C:EURUSD")), batch_key("s", "r", day)).first()
    assert tuple(row) == ("massive_forex_20260105_C_EURUSD", "s_r_20260105")


def test_route(spark, rows):
    df = spark.createDataFrame([("A", "2026-01-01"), ("", "2026-01-01"), (None, "2026-01-01"), ("A", None)],
                               "ticker string, d string").withColumn("data_date", F.col("d").cast("date"))
    kept, rejected = route(df, contracts.RATE_BARS)
    assert kept.count() == 1 and rejected.count() == 3
    with pytest.raises(ValueError):
        route(df, Contract("s", "r", (Field("a", "a"),)))


def test_landing_round_trip_and_overwrite(spark, tmp_path):
    root = str(tmp_path / "landing")

    def write(value):
        df = spark.createDataFrame([("s", "2026-01-01", "b1", json.dumps({"id": value}, indent=2), "T:1")],
                                   "source string, ingestion_date string, batch_id string, payload string, ticker string")
        landing.write_landing(df, root, parameters=("ticker",))

    write("one"), write("two")
    row = landing.read_landing(spark, root, SAMPLE, parameters={"ticker": "string"}, with_file=True).collect()
    assert len(row) == 1 and row[0].payload.id == "two" and row[0].ticker == "T:1"
    assert row[0].batch_id == "b1" and row[0].ingestion_date == "2026-01-01" and "batch_id=b1" in row[0].landing_file


def test_empty_response_keeps_its_parameters(spark, tmp_path):
    root = str(tmp_path / "landing")
    df = spark.createDataFrame([("s", "2026-01-01", "b1", " { } ", "T:1")],
                               "source string, ingestion_date string, batch_id string, payload string, ticker string")
    landing.write_landing(df, root, parameters=("ticker",))
    row = landing.read_landing(spark, root, SAMPLE, parameters={"ticker": "string"}).first()
    assert row.ticker == "T:1" and row.payload.id is None


def test_pretty_printed_file_is_read(spark, tmp_path):
    folder = tmp_path / "source=s" / "ingestion_date=2026-01-01" / "batch_id=b"
    folder.mkdir(parents=True)
    (folder / "raw.json").write_text(json.dumps({"id": "x", "prices": {"current": 2}}, indent=2))
    row = landing.read_landing(spark, str(tmp_path), SAMPLE, multi_line=True).first()
    assert row.payload.id == "x" and row.payload.prices.current == 2.0 and row.source == "s"


def bars(spark, *entries):
    text = {}
    for ticker, day, close in entries:
        text.setdefault(ticker, []).append(
            {"t": DAY0 + day * DAY_MS, "o": close, "h": close + 1, "l": close - 1, "c": close, "v": 5})
    df = spark.createDataFrame([(t, json.dumps({"results": r})) for t, r in text.items()], "ticker string, response string")
    return landing.parse_responses(df, "response", contracts.RATE_BARS)


def published_rows(spark, root):
    table = published.read_published(spark, root, contracts.RATE_BARS)
    return sorted((r.ticker, r.data_date.day, r.close) for r in table.collect())


def load(spark, root, batch, *entries):
    return ingest(bars(spark, *entries), root, contracts.RATE_BARS, batch, {"ticker": F.col("ticker")})


def test_publish_replaces_only_its_partitions(spark, tmp_path):
    root = str(tmp_path)
    outcome = load(spark, root, "b1", ("C:EURUSD", 0, 10.0), ("C:EURUSD", 1, 11.0), ("C:GBPUSD", 0, 12.0))
    assert outcome.published == 3 and outcome.rejected == 0 and outcome.audit.is_valid
    load(spark, root, "b2", ("C:EURUSD", 1, 99.0))
    expected = [("C:EURUSD", 1, 10.0), ("C:EURUSD", 2, 99.0), ("C:GBPUSD", 1, 12.0)]
    assert published_rows(spark, root) == expected
    load(spark, root, "b2", ("C:EURUSD", 1, 99.0))
    assert published_rows(spark, root) == expected
    assert not os.path.exists(published.staging_path(root, "b2"))


def test_failed_audit_leaves_the_table_unchanged(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, "b1", ("C:EURUSD", 0, 10.0))
    with pytest.raises(c.AuditFailed) as error:
        load(spark, root, "b2", ("C:EURUSD", 0, 20.0), ("C:EURUSD", 1, -5.0))
    assert {x["name"] for x in error.value.result.failed_checks} == {"open > 0", "high > 0", "low > 0", "close > 0"}
    assert published_rows(spark, root) == [("C:EURUSD", 1, 10.0)]
    assert not os.path.exists(published.staging_path(root, "b2"))


def test_rejects_are_counted(spark, tmp_path):
    outcome = load(spark, str(tmp_path), "b1", ("C:EURUSD", 0, 10.0), ("", 0, 10.0), ("", 1, 10.0))
    assert outcome.published == 1 and outcome.rejected == 2


def test_rejected_records_are_kept(spark, tmp_path):
    outcome = load(spark, str(tmp_path), "b1", ("C:EURUSD", 0, 10.0), ("", 0, 11.0))
    assert [(r.ticker, r.close) for r in outcome.rejects.collect()] == [("", 11.0)]
    assert outcome.unreadable == 0 and outcome.unreadable_responses is None


GOOD = json.dumps({"results": [{"t": DAY0, "o": 1.0, "h": 2.0, "l": 1.0, "c": 1.5, "v": 3}]})
FOLDER = "source=massive/ingestion_date=2026-01-01/batch_id=00123"


@pytest.mark.parametrize("text,lost", [
    (GOOD + "\n" + GOOD[:30], 1), ("<html>\n<body>busy</body>\n</html>", 3), (GOOD.replace("1.5", '"1.5"'), 1),
    (GOOD.replace("1.5", '"NaN"'), 1)])
def test_unreadable_responses_fail_the_audit(spark, tmp_path, text, lost):
    folder = tmp_path / "landing" / FOLDER
    folder.mkdir(parents=True)
    (folder / "raw.json").write_text(text)
    rows = landing.read_landing(spark, str(tmp_path / "landing"), contracts.RATE_BARS)
    assert {r.batch_id for r in rows.collect()} == {"00123"}
    with pytest.raises(c.AuditFailed) as error:
        ingest(rows, str(tmp_path), contracts.RATE_BARS, "b1", {"ticker": "C:EURUSD"})
    failed = {x["name"]: x["diagnostic"] for x in error.value.result.failed_checks}
    assert failed["unreadable_responses <= 0"] == f"value {lost} violates <= 0"
    assert error.value.kept_at == published.failed_path(str(tmp_path), "b1") and os.path.exists(error.value.kept_at)
    assert not os.path.exists(published.table_path(str(tmp_path), contracts.RATE_BARS))
    outcome = ingest(rows, str(tmp_path), contracts.RATE_BARS, "b1", {"ticker": "C:EURUSD"}, most_unreadable=None)
    assert outcome.unreadable == lost == outcome.unreadable_responses.count()
    assert outcome.published == (1 if text.startswith(GOOD) else 0)


def test_nan_fails_the_audit(spark, tmp_path):
    bad = bars(spark, ("C:EURUSD", 0, 10.0)).withColumn("payload", F.expr(
        "struct(transform(payload.results, b -> struct(b.t, b.o, b.h, b.l, double('NaN') as c, b.v)) as results)"))
    with pytest.raises(c.AuditFailed) as error:
        ingest(bad, str(tmp_path), contracts.RATE_BARS, "b1", {"ticker": F.col("ticker")})
    assert {x["name"] for x in error.value.result.failed_checks} == {"missing_count(close) = 0", "close > 0"}


def test_tickers_like_numbers_are_found_again(spark, tmp_path, rows):
    root = str(tmp_path)
    load(spark, root, "b1", ("0005", 0, 10.0), ("0700", 1, 11.0), ("A B+C", 0, 3.0))
    assert rows(published.existing_dates(spark, root, contracts.RATE_BARS), "ticker") == [("0005",), ("0700",), ("A B+C",)]
    assert published.existing_dates(spark, root, contracts.RATE_BARS, "0700").count() == 1


def test_whole_numbers_keep_their_digits(spark):
    contract = Contract("s", "r", (Field("id", "id", "integer"), Field("at", "meta.ts", "timestamp_ms_to_datetime")))
    row = flatten(one(spark, '{"id": 9007199254740993, "meta": {"ts": 1609459200001}}', contract), contract, batch_id="b").first()
    assert row.id == 9007199254740993
    assert contracts.CRYPTO_SERIES.payload_schema["prices"].dataType.simpleString() == "array<array<double>>"


def test_ingestion_keeps_its_books(spark, tmp_path, rows):
    from bourse.operators import ledger
    from bourse.plans.ingest import Books

    root, books = str(tmp_path), Books(str(tmp_path / "books"))
    days = window_request(spark, dt.date(2026, 1, 1), dt.date(2026, 1, 1), ["C:EURUSD"])

    def run(name, price, **options):
        return ingest(bars(spark, ("C:EURUSD", 0, price)), root, contracts.RATE_BARS, name, {"ticker": F.col("ticker")},
                      books=books, run_id=f"run-{name}", **options)

    assert run("b1", 10.0, requested=days).published == 1
    assert run("b2", 11.0, requested=days).skipped
    assert run("b3", 12.0, requested=days, force=True).published == 1
    with pytest.raises(c.AuditFailed):
        run("b4", -1.0)
    assert rows(ledger.run_state(spark.read.parquet(books.events)), "run_id", "status", "batch_id") == [
        ("run-b1", "SUCCESS", "b1"), ("run-b2", "SKIPPED", "b2"), ("run-b3", "SUCCESS", "b3"), ("run-b4", "FAILED", "b4")]
    rate = ledger.pass_rate(ledger.current_results(spark.read.parquet(books.results))).first()
    assert (rate.total_runs, rate.passed, rate.failed) == (3, 2, 1)
    assert published_rows(spark, root) == [("C:EURUSD", 1, 12.0)]


def test_staging_an_empty_batch_is_an_error(spark, tmp_path):
    empty = flatten(bars(spark, ("A", 0, 1.0)), contracts.RATE_BARS, {"ticker": "A"}, "b").filter("false")
    with pytest.raises(published.EmptyBatch):
        published.stage(empty, str(tmp_path), "b", contracts.RATE_BARS)
    assert not os.path.exists(published.staging_path(str(tmp_path), "b"))


def test_columns_missing_from_older_files_are_null(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, "b1", ("C:EURUSD", 0, 10.0))
    table = published.table_path(root, contracts.RATE_BARS)
    spark.createDataFrame([(1.0, 2.0)], "close double, extra double").write.parquet(
        f"{table}/ticker=C%3AEURUSD/data_date=2026-02-01")
    rows = published.read_published(spark, root, contracts.RATE_BARS, discover=True).orderBy("data_date").collect()
    assert [r.extra for r in rows] == [None, 2.0] and rows[1].open is None and rows[1].ticker == "C:EURUSD"
    plain = published.read_published(spark, root, contracts.RATE_BARS)
    assert plain.columns == list(contracts.RATE_BARS.record_types)
    assert [(r.open, r.close) for r in plain.orderBy("data_date").collect()] == [(10.0, 10.0), (None, 1.0)]


def test_partition_filters_prune_directories(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, "b1", *[("C:EURUSD", d, 10.0) for d in range(5)], ("C:GBPUSD", 0, 2.0))
    df = published.read_published(spark, root, contracts.RATE_BARS).filter("ticker = 'C:EURUSD' and data_date = '2026-01-02'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan and df.count() == 1


def test_source_freshness(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, "b1", ("C:EURUSD", 0, 10.0))
    table = published.read_published(spark, root, contracts.RATE_BARS)
    assert source_freshness(table, contracts.RATE_BARS).first().status == "pass"
    later = F.current_timestamp() + F.expr("INTERVAL 3 DAYS")
    assert source_freshness(table, contracts.RATE_BARS, later).first().status == "warn"


def test_existing_dates_and_load_plan(spark, tmp_path, rows):
    root = str(tmp_path)
    assert published.existing_dates(spark, root, contracts.RATE_BARS).count() == 0
    load(spark, root, "b1", ("C:EURUSD", 0, 10.0), ("C:EURUSD", 2, 10.0), ("C:GBPUSD", 0, 1.5))
    existing = published.existing_dates(spark, root, contracts.RATE_BARS)
    assert existing.count() == 3
    assert published.existing_dates(spark, root, contracts.RATE_BARS, "C:GBPUSD").count() == 1
    wanted = window_request(spark, dt.date(2026, 1, 1), dt.date(2026, 1, 3), ["C:EURUSD", "C:GBPUSD"])
    keys = ["ticker", "data_date"]
    plan = rows(missing_loads(wanted, existing, keys), "ticker", F.day("data_date"))
    assert plan == [("C:EURUSD", 2), ("C:GBPUSD", 2), ("C:GBPUSD", 3)]
    assert missing_loads(wanted, existing, keys, force=True).count() == 6
    assert missing_loads(window_request(spark, dt.date(2026, 1, 3), dt.date(2026, 1, 1)), existing, ["data_date"]).count() == 0


def test_quality_result_of_an_audit(spark):
    result = c.AuditResult(False, 2, 1, [{"name": "n", "outcome": "fail", "diagnostic": "d"}])
    row = quality_result(spark, contracts.RATE_BARS, "b", result).first()
    assert row.batch_id == "b" and row.resource == "forex" and row.failed_checks[0].name == "n"


def test_published_files_carry_contract_types(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, "b1", ("C:EURUSD", 0, 10))
    file = glob.glob(f"{published.table_path(root, contracts.RATE_BARS)}/*/*/*.parquet")[0]
    assert dict(spark.read.parquet(file).dtypes)["volume"] == "double"


def test_a_failed_move_aside_raises(spark, tmp_path):
    """A move that does not happen must not pass as kept, whether the file system says so by false or by an error."""
    root = str(tmp_path)
    staged = published.staging_path(root, "b1").removeprefix("file:")
    os.makedirs(staged)
    open(os.path.join(staged, "part-0.parquet"), "w").close()
    blocked = os.path.dirname(published.failed_path(root, "b1").removeprefix("file:"))
    os.makedirs(os.path.dirname(blocked), exist_ok=True)
    open(blocked, "w").close()  # a file where the folder of failed batches should be
    with pytest.raises(Exception):
        published.keep_failed(spark, root, "b1")
    assert os.path.exists(os.path.join(staged, "part-0.parquet"))
