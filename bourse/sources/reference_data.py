"""Market holidays and the asset catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse import fixed_values as fv

_HOLIDAY_FILE = "holiday_date date, holiday_name string, market_status string"
_HOLIDAY = f"{_HOLIDAY_FILE}, market_code string"


def read_holidays(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Holiday CSVs with a header, one per market code, as one table."""
    return reduce(DataFrame.unionByName, [
        spark.read.csv(path, schema=_HOLIDAY_FILE, header=True).withColumn("market_code", F.lit(code))
        for code, path in files.items()])


def builtin_holidays(spark: SparkSession) -> DataFrame:
    rows = [(*day, code) for code, days in fv.HOLIDAYS.items() for day in days]
    text = spark.createDataFrame(rows, _HOLIDAY.replace(" date", " string", 1))
    return text.withColumn("holiday_date", F.col("holiday_date").cast("date"))


def weekday_closures(holidays: DataFrame) -> DataFrame:
    """Closed days that do not fall on a weekend, with the day's name."""
    date = F.col("holiday_date")
    return holidays.filter((F.col("market_status") == "closed") & ~F.dayofweek(date).isin(1, 7)).select(
        "holiday_date", "holiday_name", "market_code", F.date_format(date, "EEEE").alias("day_of_week"))


def holiday_overlaps(rates: DataFrame, holidays: DataFrame, markets: dict[str, str] | None = None) -> DataFrame:
    """Currencies priced on a holiday of their own market."""
    markets = fv.CURRENCY_MARKET if markets is None else markets
    own = reduce(lambda a, b: a | b, [
        (F.col("asset_id") == currency) & (F.col("market_code") == code) for currency, code in markets.items()])
    return (rates.join(holidays, rates["data_date"] == holidays["holiday_date"]).filter(own)
                 .select("asset_id", "data_date", "holiday_name", "market_code", "close_price"))


def builtin_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fv.CATALOGUE,
        "ticker string, name string, asset_type string, source string, resource string, enabled boolean, "
        "tags array<string>, params map<string,string>")


def select_assets(catalogue: DataFrame, source: str | None = None, resource: str | None = None,
                  asset_type: str | None = None, tags: list[str] | None = None,
                  enabled_only: bool = True) -> DataFrame:
    """Catalogue rows matching every given filter and carrying all given tags."""
    if enabled_only:
        catalogue = catalogue.filter("enabled")
    for column, wanted in (("source", source), ("resource", resource), ("asset_type", asset_type)):
        if wanted:
            catalogue = catalogue.filter(F.col(column) == wanted)
    if tags:
        catalogue = catalogue.filter(F.size(F.array_except(F.array(*map(F.lit, tags)), F.col("tags"))) == 0)
    return catalogue
