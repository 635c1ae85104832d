import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bourse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, sorted."""
    return lambda df, *columns: sorted(
        (tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture
def priced(spark):
    """A small common price table from (asset, type, day, price) tuples."""
    from pyspark.sql import functions as F

    def make(entries):
        df = spark.createDataFrame(entries, "asset_id string, asset_type string, d string, close_price double")
        return df.select(
            "asset_id", F.concat(F.lit("name "), "asset_id").alias("asset_name"), "asset_type",
            F.col("d").cast("date").alias("data_date"), "close_price",
            F.concat(F.lit("b"), "d").alias("__batch_id"), F.concat("d", F.lit("T06:00:00")).alias("__ingested_at"))

    return make
