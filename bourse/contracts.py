"""Resource contracts: what to extract from a response, and what must hold."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import types as T

from bourse.functions import paths
from bourse.functions.convert import spark_type
from bourse.operators import checks as c

AUDIT_COLUMNS = ("__batch_id", "__source_name", "__ingested_at", "__schema_version")


@dataclass(frozen=True)
class Field:
    """One output column: where it lies in the response and how it is typed."""

    name: str
    path: str
    type: str | None = None
    partition_key: bool = False


@dataclass(frozen=True)
class Contract:
    source: str
    resource: str
    fields: tuple[Field, ...]
    checks: tuple[c.Check, ...] = ()
    fail_on_empty: bool = False
    freshness_days: tuple[int, int] = field(default=(2, 4))
    required: tuple[str, ...] = ()

    @property
    def partition_keys(self) -> list[str]:
        return [f.name for f in self.fields if f.partition_key]

    @property
    def payload_schema(self) -> T.StructType:
        """Schema for the JSON scan.

        Whole numbers are read with all their digits; an array that mixes them with prices, as the series do, is
        read as doubles, in which milliseconds still fit exactly."""
        whole = "decimal(38,0)"
        leaf = {"string": "string", "string_to_date": "string", "bool": "boolean", "integer": whole, "int": whole,
                "timestamp_ms_to_datetime": whole, "timestamp_ms_to_date": whole}
        return paths.payload_schema({f.path: leaf.get(f.type, "double") for f in self.fields})

    @property
    def record_types(self) -> dict[str, str]:
        """Physical type of every flat column, audit columns included."""
        types = {f.name: spark_type(f.type) for f in self.fields}
        types.update({"__batch_id": "string", "__source_name": "string",
                      "__ingested_at": "timestamp", "__schema_version": "string"})
        return types

    @property
    def schema_version(self) -> str:
        """Eight hex digits that change when a field, its type or its role changes."""
        shape = {f.name: {"type": f.type, "partition_key": f.partition_key} for f in self.fields}
        return hashlib.md5(json.dumps(shape, sort_keys=True).encode()).hexdigest()[:8]


# --- fixed values: the three built-in resources ------------------------------
_BAR_CHECKS = (
    c.row_count(">", 0),
    c.missing("data_date"),
    c.missing("ticker"),
    c.missing("close"),
    c.bound("open", ">", 0),
    c.bound("high", ">", 0),
    c.bound("low", ">", 0),
    c.bound("close", ">", 0),
    c.count_where("high_lt_low", "high < low"),
    c.duplicates("no_duplicate_dates", ("ticker", "data_date")),
)

CRYPTO_SERIES = Contract(
    source="coingecko",
    resource="market_chart",
    fields=(
        Field("data_timestamp", "prices[*][0]", "timestamp_ms_to_datetime"),
        Field("data_date", "prices[*][0]", "timestamp_ms_to_date", partition_key=True),
        Field("price_usd", "prices[*][1]"),
        Field("market_cap_usd", "market_caps[*][1]"),
        Field("volume_24h_usd", "total_volumes[*][1]"),
    ),
    checks=(
        c.row_count(">", 0),
        c.missing("data_timestamp"),
        c.missing("data_date"),
        c.missing("price_usd"),
        c.missing("market_cap_usd"),
        c.missing("volume_24h_usd"),
        c.bound("price_usd", ">", 0),
        c.bound("market_cap_usd", ">", 0),
        c.bound("volume_24h_usd", ">", 0),
    ),
    freshness_days=(2, 3),
    required=("data_date", "price_usd"),
)

STOCK_BARS = Contract(
    source="massive",
    resource="stocks",
    fields=(
        Field("ticker", "_param.ticker", "string", partition_key=True),
        Field("data_date", "results[*].t", "timestamp_ms_to_date", partition_key=True),
        Field("open", "results[*].o"),
        Field("high", "results[*].h"),
        Field("low", "results[*].l"),
        Field("close", "results[*].c"),
        Field("volume", "results[*].v"),
        Field("vwap", "results[*].vw"),
    ),
    checks=_BAR_CHECKS,
    required=("ticker", "data_date", "close"),
)

RATE_BARS = Contract(
    source="massive",
    resource="forex",
    fields=tuple(f for f in STOCK_BARS.fields if f.name != "vwap"),
    checks=_BAR_CHECKS,
    required=STOCK_BARS.required,
)
