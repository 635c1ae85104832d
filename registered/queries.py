"""One callable per registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse import contracts
from bourse.functions import paths
from bourse.functions.convert import ms_to_date, text_to_date
from bourse.operators import checks as c
from bourse.operators import ledger as ledgers
from bourse.operators.flatten import batch_key, flatten, route
from bourse.operators.loadplan import missing_loads
from bourse.operators.ranking import rank_descending
from bourse.plans import core, figures, market, reports, swaps
from bourse.plans.ingest import Books, ingest
from bourse.session import shared_folder
from bourse.sources import landing, published, reference_data
from registered import inputs
from registered.oracle import CLOSE_LIMIT

QUERIES = {}


def _shown(df: DataFrame) -> DataFrame:
    """Days and times as text: the same form in every engine."""
    forms = {"date": "date_format({0}, 'yyyy-MM-dd')", "timestamp": "date_format({0}, 'yyyy-MM-dd HH:mm:ss')",
             "timestamp_ntz": "date_format({0}, 'yyyy-MM-dd HH:mm:ss')", "int": "cast({0} as bigint)"}
    return df.selectExpr(*[forms.get(t, "{0}").format(f"`{c}`") + f" as `{c}`" for c, t in df.dtypes])


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Results whose last bits depend on the order of summation."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _listed(entries: str) -> F.Column:
    """Failed checks as text."""
    return F.concat_ws("; ", F.transform(entries, lambda e: F.concat_ws(": ", e["name"], e["outcome"], e["diagnostic"])))


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: _shown(fn(spark, sf_dir))
    return fn


# --- staging ------------------------------------------------------------------

@query
def stg_benchmark_series(spark, sf):
    return inputs.series(spark, sf)


@query
def stg_bars(spark, sf):
    return inputs.bars(spark, sf)


@query
def stg_rates(spark, sf):
    return inputs.rates(spark, sf)


@query
def stg_holidays(spark, sf):
    """Holidays written as one CSV per market and scanned back."""
    days = inputs.holidays(spark, sf)
    root = shared_folder(spark, "holidays")
    (days.withColumn("market", F.col("market_code")).drop("market_code")
         .write.partitionBy("market").csv(root, header=True))
    return reference_data.read_holidays(spark, {code: f"{root}/market={code}" for code in ("US", "UK", "EU")})


# --- common table and star schema ----------------------------------------------

@query
def unified_prices(spark, sf):
    return inputs.prices(spark, sf)


@query
def dim_assets(spark, sf):
    return reports.with_position(core.dim_assets(inputs.prices(spark, sf)), core.asset_order())


@query
def dim_dates(spark, sf):
    return inputs.dates(spark, sf)


@query
def daily_prices_locf(spark, sf):
    priced = inputs.prices(spark, sf)
    return core.daily_prices(priced, inputs.dates(spark, sf, priced))


@query
def daily_prices_named(spark, sf):
    """Filled prices that take their names from the asset dimension."""
    priced = inputs.prices(spark, sf)
    return core.daily_prices(priced, inputs.dates(spark, sf, priced), core.dim_assets(priced))


def _returns(spark, sf):
    return market.daily_returns(inputs.prices(spark, sf))


@query
def daily_returns(spark, sf):
    return _returns(spark, sf).withColumn("days_gap", F.coalesce(F.col("days_gap").cast("string"), F.lit("none")))


@query
def fct_daily_returns(spark, sf):
    return core.fct_daily_returns(_returns(spark, sf)).orderBy("asset_id", "data_date")


# --- market models -------------------------------------------------------------

@query
def benchmark_relative(spark, sf):
    return market.benchmark_relative(_returns(spark, sf))


_ROLLING = [f"{m}_{n}d" for m in ("avg_return", "volatility") for n in market.ROLLING_ROWS]


@query
def rolling_metrics(spark, sf):
    return _rounded(market.rolling_metrics(_returns(spark, sf)), 8, *_ROLLING)


@query
def fct_rolling_metrics(spark, sf):
    rolling = market.fct_rolling_metrics(market.rolling_metrics(_returns(spark, sf)))
    return _rounded(rolling, 8, *_ROLLING).orderBy("asset_id", "data_date")


def _gaps(spark, sf):
    priced = inputs.prices(spark, sf)
    return market.data_gaps(priced, inputs.dates(spark, sf, priced))


@query
def data_gaps(spark, sf):
    return _gaps(spark, sf)


@query
def critical_gaps(spark, sf):
    return market.critical_gaps(_gaps(spark, sf))


# --- reports -------------------------------------------------------------------

@query
def performance_summary(spark, sf):
    return reports.with_position(reports.performance_summary(inputs.prices(spark, sf)), reports.performance_order())


@query
def investment_comparison(spark, sf):
    return reports.investment_comparison(inputs.prices(spark, sf))


@query
def investment_benchmark_and_cash(spark, sf):
    report = reports.investment_comparison(inputs.prices(spark, sf), benchmark="BTC")
    return reports.with_position(report, reports.investment_order())


@query
def volatility_comparison(spark, sf):
    report = reports.volatility_comparison(core.fct_daily_returns(_returns(spark, sf)))
    return reports.with_position(report, reports.volatility_order())


@query
def rank_extremes(spark, sf):
    """Ranks of prices among which are NaN, infinities and nulls."""
    k, price = F.col("o_orderkey") % 50, F.col("o_totalprice")
    value = (F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).when(k == 2, F.lit(float("-inf")))
             .when(k != 3, F.round(price, -3)))
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", value.alias("v"))
    ranked = rank_descending(rank_descending(orders, "v", ("o_orderpriority",), "rank_in_class"), "v", (), "rank_overall")
    return ranked.drop("v")


@query
def return_correlation(spark, sf):
    report = _rounded(reports.return_correlation(_returns(spark, sf)), 8, "correlation")
    return reports.with_position(report, reports.correlation_order())


@query
def holiday_overlaps(spark, sf):
    return reference_data.holiday_overlaps(inputs.rates(spark, sf), inputs.holidays(spark, sf))


@query
def weekday_closures(spark, sf):
    return reference_data.weekday_closures(inputs.holidays(spark, sf))


# --- headline figures ----------------------------------------------------------

@query
def window_returns_observed(spark, sf):
    return figures.window_returns_observed(inputs.prices(spark, sf))


@query
def holding_value_curve(spark, sf):
    return figures.holding_value_curve(inputs.prices(spark, sf))


@query
def holding_value_summary(spark, sf):
    return figures.holding_value_summary(figures.holding_value_curve(inputs.prices(spark, sf)))


@query
def dca_value_curve(spark, sf):
    return _rounded(figures.dca_value_curve(inputs.prices(spark, sf)), 6, "dca_value")


@query
def dca_value_summary(spark, sf):
    summary = figures.dca_value_summary(figures.dca_value_curve(inputs.prices(spark, sf)))
    return _rounded(summary, 6, "final_dca", "dca_return", "margin")


@query
def annualised_volatility(spark, sf):
    return _rounded(figures.annualised_volatility(_returns(spark, sf)), 8, "annualized_volatility_pct")


@query
def volatility_ratio(spark, sf):
    return _rounded(figures.volatility_ratio(_returns(spark, sf)), 8, "benchmark_volatility", "compared_mean", "ratio")


# --- ingestion -----------------------------------------------------------------

def _series_responses(spark, sf):
    """Each order as one response of three price points, two caps, four volumes."""
    day_ms = 86_400_000
    ms = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * day_ms
    price = F.col("o_totalprice")

    def points(value, n):
        return F.array(*[F.array((ms + k * day_ms).cast("double"), value(k)) for k in range(n)])

    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate",
        F.to_json(F.struct(
            points(lambda k: price + k, 3).alias("prices"),
            points(lambda k: price * 1000, 2).alias("market_caps"),
            points(lambda k: F.col("o_custkey").cast("double") + k, 4).alias("total_volumes"),
        )).alias("response"))


@query
def flattened_series(spark, sf):
    """JSON text to flat records by the crypto contract."""
    parsed = landing.parse_responses(_series_responses(spark, sf), "response", contracts.CRYPTO_SERIES)
    key = batch_key("coingecko", "market_chart", F.to_date("o_orderdate"))
    flat = flatten(parsed, contracts.CRYPTO_SERIES, batch_id=key, ingested_at=F.col("o_orderdate"),
                   keep=("o_orderkey", "o_orderdate"))
    return flat.drop("o_orderdate").withColumn("data_timestamp", F.unix_millis("data_timestamp"))


@query
def projected_paths(spark, sf):
    """Scalar, indexed, wildcard and nested wildcard paths, present and missing."""
    body = F.concat(F.lit('{"meta":'), F.col("props"), F.lit(',"rows":[{"v":['), F.col("user_id").cast("string"),
                    F.lit(",7]},{\"v\":["), F.col("event_id").cast("string"), F.lit("]}]}"))
    wanted = {"meta.k": "bigint", "rows[0].v[1]": "bigint", "rows[9].v[0]": "bigint", "rows[*].v[0]": "bigint",
              "rows[*].v[*]": "bigint", "absent.key": "bigint", "none[*].x": "bigint"}
    schema = paths.payload_schema(wanted)
    parsed = inputs.table(spark, sf, "events").select("event_id", F.from_json(body, schema).alias("payload"))
    at = {p: paths.project(F.col("payload"), schema, p) for p in wanted}
    return parsed.select(
        "event_id",
        at["meta.k"].alias("k"),
        at["rows[0].v[1]"].alias("second"),
        at["rows[9].v[0]"].cast("double").alias("beyond"),
        F.to_json(at["rows[*].v[0]"]).alias("firsts"),
        F.to_json(at["rows[*].v[*]"]).alias("nested"),
        at["absent.key"].cast("double").alias("missing_key"),
        F.size(at["none[*].x"]).cast("bigint").alias("n_missing"),
    )


@query
def converted_dates(spark, sf):
    """Text dates in three forms, one unreadable form, and epoch milliseconds with zeros."""
    day, kind = F.to_date("o_orderdate"), F.col("o_orderpriority")
    text = (F.when(kind == "1-URGENT", F.date_format(day, "yyyy/MM/dd"))
             .when(kind == "2-HIGH", F.date_format(day, "dd-MM-yyyy"))
             .when(kind == "5-LOW", F.date_format(day, "MMMM d")).otherwise(F.date_format(day, "yyyy-MM-dd")))
    ms = F.when(kind == "5-LOW", F.lit(0)).otherwise(F.unix_date(day).cast("bigint") * 86_400_000)
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", text_to_date(text).alias("from_text"), ms_to_date(ms).alias("from_ms"))


@query
def batch_keys(spark, sf):
    """Rows per deterministic batch key of the currency trades."""
    rates = inputs.raw_rates(spark, sf)
    return rates.groupBy("__batch_id").agg(F.count(F.lit(1)).alias("n_bars"))


@query
def routed_records(spark, sf):
    """Trades with an empty ticker or no day are rejected; the rest is kept."""
    trades = inputs.table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(F.col("l_returnflag")).alias("ticker"),
        F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("data_date"))
    kept, rejected = route(trades, contracts.RATE_BARS)
    both = kept.withColumn("route", F.lit("kept")).unionByName(rejected.withColumn("route", F.lit("rejected")))
    return both.groupBy("route", "ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.count("data_date").alias("n_dated"))


@query
def load_plan(spark, sf):
    """Days between the first and last trade on which a coin has no point."""
    raw = inputs.raw_series(spark, sf)
    span = inputs.table(spark, sf, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("start_date"), F.to_date(F.max("l_shipdate")).alias("end_date"))
    coins = raw.select(F.col("coin").alias("ticker")).distinct()
    bounds = span.select(F.struct("start_date", "end_date")).scalar()
    requested = coins.select("ticker", bounds.getField("start_date").alias("start_date"),
                             bounds.getField("end_date").alias("end_date"))
    existing = raw.select(F.col("coin").alias("ticker"), "data_date")
    return missing_loads(requested, existing, ["ticker", "data_date"])


def _tickers():
    """Every event counts for a pair named by its type and for a code that looks like a number."""
    return F.explode(F.array(F.concat(F.lit("C:"), F.upper("event_type"), F.lit("USD")),
                             F.lpad((F.col("user_id") % 7).cast("string"), 4, "0"))).alias("ticker")


def _daily_bars(events, *keys):
    """Events as daily bars. Event values may be zero and prices may not, so a price is one plus the value."""
    return events.withColumn("price", F.col("value") + 1).groupBy(*keys, F.to_date("ts").alias("day")).agg(
        F.min_by("price", "event_id").alias("o"), F.max("price").alias("h"), F.min("price").alias("l"),
        F.max_by("price", "event_id").alias("c"), F.count(F.lit(1)).cast("double").alias("v"))


def _bar():
    return F.struct((F.unix_date("day").cast("bigint") * 86_400_000).alias("t"), "o", "h", "l", "c", "v")


def _event_responses(spark, sf):
    """Events as daily rate bars, one response per ticker and month (at most 31 bars)."""
    daily = _daily_bars(inputs.table(spark, sf, "events").select("*", _tickers()), "ticker")
    return (daily.groupBy("ticker", F.trunc("day", "month").alias("month"))
            .agg(F.collect_list(_bar()).alias("results"))
            .select("ticker", F.struct("results").alias("payload"), F.lit("massive").alias("source"),
                    F.col("month").alias("ingestion_date"),
                    batch_key("massive", "forex", F.col("month"), F.col("ticker")).alias("batch_id")))


def _landed(spark, sf, with_file=False):
    root = shared_folder(spark, "landing")
    landing.write_landing(_event_responses(spark, sf), root, parameters=("ticker",))
    return landing.read_landing(spark, root, contracts.RATE_BARS, parameters={"ticker": "string"}, with_file=with_file)


def _publish_events(spark, sf, responses=None):
    responses = _landed(spark, sf) if responses is None else responses
    root = shared_folder(spark, "lake")
    ingest(responses, root, contracts.RATE_BARS, "massive_forex_all", parameters={"ticker": F.col("ticker")},
           ingested_at=F.to_timestamp("ingestion_date"), row_batch_id=F.col("batch_id"))
    return root


@query
def landing_round_trip(spark, sf):
    """Responses written to the landing folders and scanned back."""
    rows = _landed(spark, sf)
    return rows.select("source", "ingestion_date", "batch_id", "ticker",
                       F.size("payload.results").cast("bigint").alias("n_bars"))


_IDS = contracts.Contract("events", "ids", (contracts.Field("id", "id", "integer"),))


@query
def landing_ids(spark, sf):
    """Batch names that look like numbers, and ids beyond what a double holds, written and scanned back."""
    big = F.col("event_id") + 9_007_199_254_740_992
    rows = inputs.table(spark, sf, "events").select(
        F.lit("events").alias("source"), F.to_date("ts").alias("ingestion_date"),
        F.lpad((F.col("user_id") % 9).cast("string"), 5, "0").alias("batch_id"), F.struct(big.alias("id")).alias("payload"))
    root = shared_folder(spark, "landing")
    landing.write_landing(rows, root)
    back = landing.read_landing(spark, root, _IDS)
    return back.select("ingestion_date", "batch_id", F.col("payload.id").cast("bigint").alias("id"))


@query
def published_bronze(spark, sf):
    """Landing JSON through flattening, audit and partition publish, scanned back."""
    return published.read_published(spark, _publish_events(spark, sf), contracts.RATE_BARS)


@query
def published_dates(spark, sf):
    """Days present in the published table, from its partition values."""
    return published.existing_dates(spark, _publish_events(spark, sf), contracts.RATE_BARS)


def _type_batches(spark, sf, broken):
    """Per event type, one JSON response a day; with ``broken`` every seventh day is cut short and every fifth has no ticker."""
    daily = _daily_bars(inputs.table(spark, sf, "events"), "event_type")
    text = F.to_json(F.struct(F.array(_bar()).alias("results")))
    day = F.dayofmonth("day")
    texts = daily.select(
        "event_type", F.when(F.lit(broken) & (day % 7 == 0), F.substring(text, 1, 40)).otherwise(text).alias("text"),
        F.when(F.lit(broken) & (day % 5 == 0), F.lit("")).otherwise(F.concat(F.lit("C:"), "event_type")).alias("ticker"))
    parsed = landing.parse_responses(texts, "text", contracts.RATE_BARS)
    types = sorted(r.event_type for r in daily.select("event_type").distinct().collect())
    return [(t, parsed.filter(F.col("event_type") == t)) for t in types]


@query
def ingest_outcomes(spark, sf):
    """What ingestion published, rejected and could not read, per event type as a source."""
    root = shared_folder(spark, "lake")
    rows = []
    for kind, responses in _type_batches(spark, sf, broken=True):
        contract = replace(contracts.RATE_BARS, source=kind)
        done = ingest(responses, root, contract, f"all_{kind}", {"ticker": F.col("ticker")}, most_unreadable=None)
        table = published.read_published(spark, root, contract)
        rows.append((kind, done.published, table.count(), done.rejected, done.rejects.count() if done.rejects else 0, done.unreadable,
                     done.unreadable_responses.count() if done.unreadable_responses else 0))
    return spark.createDataFrame(rows, "source string, published long, in_table long, rejected long, rejects_kept long, "
                                       "unreadable long, unreadable_kept long")


def _audited_types(spark, sf):
    """Books of an ingestion in which types with a dear closing price fail their audit, cut responses fail others, and a
    second call finds everything loaded."""
    root = shared_folder(spark, "lake")
    books = Books(shared_folder(spark, "books"))
    for broken in (False, True):
        for kind, responses in _type_batches(spark, sf, broken):
            contract = replace(contracts.RATE_BARS, source="events", resource=kind,
                               checks=(*contracts.RATE_BARS.checks, c.bound("close", "<=", CLOSE_LIMIT)))
            try:
                ingest(responses, root, contract, f"{kind}_{'cut' if broken else 'whole'}", {"ticker": F.col("ticker")}, books=books)
            except c.AuditFailed:
                pass
    return books


@query
def gate_verdicts(spark, sf):
    """Audit results and run states that ingestion itself wrote."""
    books = _audited_types(spark, sf)
    results = _ledger_at(spark, books.results).select(
        "batch_id", "resource", "is_valid", F.col("checks_passed").cast("bigint").alias("checks_passed"),
        F.col("checks_failed").cast("bigint").alias("checks_failed"), _listed("failed_checks").alias("failed_checks"))
    states = ledgers.run_state(spark.read.parquet(books.events)).select("batch_id", "status")
    return results.join(states, "batch_id")


@query
def ingested_pass_rate(spark, sf):
    """The pass rate over a ledger written by ingestion, failed batches included."""
    return ledgers.pass_rate(_ledger_at(spark, _audited_types(spark, sf).results)).drop("last_run")


def _ledger_at(spark, path):
    return ledgers.current_results(spark.read.parquet(path))


@query
def empty_batch_policy(spark, sf):
    """Audits of a batch without rows, as the policy allows or forbids it, per event type."""
    events = inputs.table(spark, sf, "events")
    rows = []
    for kind in sorted(r.event_type for r in events.select("event_type").distinct().collect()):
        none = events.filter((F.col("event_type") == kind) & (F.col("value") < 0))
        for strict in (False, True):
            result = c.audit(none, [c.row_count(">", 0)], fail_on_empty=strict)
            rows.append((kind, strict, result.is_valid, result.checks_passed, result.checks_failed,
                         "; ".join(f"{e['name']}: {e['outcome']}: {e['diagnostic']}" for e in result.failed_checks)))
    return spark.createDataFrame(rows, "event_type string, fail_on_empty boolean, is_valid boolean, checks_passed long, "
                                       "checks_failed long, failed_checks string")


@query
def materialised_rates(spark, sf):
    """A model written to its layer and read back."""
    return published.write_model(inputs.rates(spark, sf), shared_folder(spark, "models"), "staging", "rates",
                                 ("asset_id", "data_date"))


@query
def selected_assets(spark, sf):
    """Catalogue rows with all wanted tags, over the parts as a catalogue."""
    catalogue = inputs.table(spark, sf, "part").select(
        F.col("p_partkey").alias("ticker"), F.col("p_name").alias("name"), F.lower("p_type").alias("asset_type"),
        F.lit("massive").alias("source"), F.lit("stocks").alias("resource"), (F.col("p_size") > 5).alias("enabled"),
        F.array(F.split("p_name", " ")[0], F.when(F.col("p_size") > 25, "large").otherwise("small"),
                F.col("p_brand")).alias("tags"))
    chosen = reference_data.select_assets(catalogue, source="massive", tags=["large", "red"])
    return chosen.select("ticker", "name", "asset_type")


# --- quality -------------------------------------------------------------------

@query
def audit_report_bars(spark, sf):
    """Every kind of check on the raw trades; some fail."""
    trades = inputs.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("ticker"), F.to_date("l_shipdate").alias("data_date"),
        F.col("l_quantity").alias("low"), F.col("l_extendedprice").alias("high"), F.col("l_discount").alias("discount"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"))
    report = c.check_report(trades, [
        c.row_count(">", 0), c.missing("data_date"), c.missing("tax"), c.bound("low", ">", 0),
        c.bound("discount", ">", 0), c.bound("discount", "<", 0.5), c.bound("low", "<=", 10),
        c.count_where("high_lt_low", "high < low"), c.duplicates("no_duplicate_dates", ("ticker", "data_date")),
        c.sql_metric("days", "SELECT count(DISTINCT data_date) FROM {table}", ">", 10),
    ])
    return report.withColumn("diagnostic", F.coalesce("diagnostic", F.lit("")))


@query
def audit_summary_series(spark, sf):
    """The crypto contract's audit folded to one row."""
    raw = inputs.raw_series(spark, sf)
    folded = c.summarise(c.check_report(raw, contracts.CRYPTO_SERIES.checks))
    return folded.withColumn("failed_checks", _listed("failed_checks"))


@query
def duplicate_observations(spark, sf):
    return c.duplicate_keys(inputs.raw_series(spark, sf), ["coin", "data_date"])


@query
def null_violations(spark, sf):
    returns = _returns(spark, sf)
    return c.not_null_violations(returns, "asset_id", "daily_return").select("asset_id", "data_date", "close_price")


@query
def unique_violations(spark, sf):
    return c.unique_violations(inputs.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query
def accepted_value_violations(spark, sf):
    return c.accepted_values_violations(inputs.prices(spark, sf), "asset_type", ["crypto", "fiat", "stock", "index"])


@query
def relationship_violations(spark, sf):
    """Events whose user is no customer."""
    events = inputs.table(spark, sf, "events").select("event_id", "user_id")
    return c.relationship_violations(events, "user_id", inputs.table(spark, sf, "customer"), "c_custkey")


@query
def source_freshness(spark, sf):
    """Age of the newest point of each coin against limits of 2 and 3 days."""
    raw = inputs.raw_series(spark, sf).withColumn("loaded", F.col("data_date").cast("timestamp"))
    return c.freshness(raw, "loaded", 2, 3, F.lit("2001-08-04 12:00:00"), by=("coin",))


@query
def quality_pass_rate(spark, sf):
    return ledgers.pass_rate(inputs.ledger(spark, sf))


@query
def recent_failures(spark, sf):
    failures = ledgers.recent_failures(inputs.ledger(spark, sf))
    return failures.withColumn("failed_checks", _listed("failed_checks"))


@query
def ledger_upsert(spark, sf):
    """A later, stricter audit of the second half of the month over the first ledger."""
    first = inputs.ledger(spark, sf)
    again = inputs.ledger(spark, sf, limit=100.0).filter(F.col("data_interval_start") >= "2024-01-16")
    again = again.withColumn("source", F.lit("retry")).withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY"))
    merged = ledgers.upsert_results(first, again)
    return merged.withColumn("failed_checks", _listed("failed_checks"))


@query
def run_state(spark, sf):
    return ledgers.run_state(inputs.state_events(spark, sf))


@query
def step_state(spark, sf):
    return ledgers.step_state(inputs.state_events(spark, sf)).withColumn("metadata", F.coalesce("metadata", F.lit("")))


@query
def lineage_trace(spark, sf):
    """Priced rate rows with the last of the two runs of the batch they came from."""
    facts = inputs.rates(spark, sf).select("asset_id", "data_date", "close_price", "__batch_id")
    batch = F.col("__batch_id")
    final = F.when(F.col("volume") > 100, "SUCCESS").otherwise("FAILED")
    runs = inputs.raw_rates(spark, sf).select(batch.alias("batch_id"), F.inline(F.array(
        F.struct(F.concat(F.lit("second-"), batch).alias("run_id"), final.alias("status"),
                 F.date_add("data_date", 2).alias("start_time")),
        F.struct(F.concat(F.lit("z-first-"), batch).alias("run_id"), F.lit("FAILED").alias("status"),
                 F.date_add("data_date", 1).alias("start_time")))))
    return ledgers.trace(facts, runs)


@query
def landing_lineage(spark, sf):
    """Published rows with the landing file their batch came from."""
    landed = _landed(spark, sf, with_file=True)
    lake = _publish_events(spark, sf, landed)
    facts = published.read_published(spark, lake, contracts.RATE_BARS).select("ticker", "data_date", "__batch_id")
    files = ledgers.landing_files(landed).select("batch_id", "ingestion_date", "landing_file")
    runs = landed.select("batch_id", F.lit("SUCCESS").alias("status")).distinct()
    return ledgers.trace(facts, runs, files).withColumn(
        "landing_file", F.regexp_extract("landing_file", r"batch_id=([^/]+)/", 1))


# --- swaps ---------------------------------------------------------------------

@query
def swap_amounts(spark, sf):
    return swaps.swap_amounts(inputs.swaps(spark, sf))


@query
def unique_takers(spark, sf):
    return swaps.unique_takers(inputs.swaps(spark, sf), by=("event_type",))
