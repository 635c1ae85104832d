"""Nested responses to flat, typed, audited records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.contracts import Contract, Field
from bourse.functions import paths
from bourse.functions.convert import convert, spark_type


def _field_value(field: Field, payload: Column, schema, parameters: dict) -> Column:
    if field.path.startswith(paths.PARAMETER_PREFIX):
        return convert(paths.parameter(field.path, parameters), field.type)
    value = paths.project(payload, schema, field.path)
    return convert(value, field.type, is_array=paths.is_wildcard(field.path))


def zip_and_explode(df: DataFrame, arrays: list[str], scalars: list[str]) -> DataFrame:
    """One row per index of the first array.

    Shorter arrays give null, longer ones are cut, scalars repeat.
    """
    if not arrays:
        return df
    first = F.size(F.coalesce(F.col(arrays[0]), F.array()))
    rows = F.slice(F.arrays_zip(*[F.coalesce(F.col(a), F.array()).alias(a) for a in arrays]), 1, first)
    return df.select(*scalars, F.inline(rows))


def flatten(responses: DataFrame, contract: Contract, parameters: dict[str, Column | str] | None = None,
            batch_id: Column | str | None = None, ingested_at: Column | None = None,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of a ``payload`` struct column by the contract's rules, with the audit columns."""
    schema = responses.schema["payload"].dataType
    values = {f.name: _field_value(f, F.col("payload"), schema, parameters or {}) for f in contract.fields}
    arrays = [f.name for f in contract.fields if paths.is_wildcard(f.path)]
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    if batch_id is None:
        batch_id = F.uuid()
    audit = {
        "__batch_id": batch_id if isinstance(batch_id, Column) else F.lit(batch_id),
        "__source_name": F.lit(contract.source),
        "__ingested_at": stamp,
        "__schema_version": F.lit(contract.schema_version),
    }
    wide = responses.select(*keep, *[v.alias(n) for n, v in values.items()], *[v.alias(n) for n, v in audit.items()])
    scalars = [c for c in wide.columns if c not in arrays]
    flat = zip_and_explode(wide, arrays, scalars)
    types = {f.name: spark_type(f.type) for f in contract.fields}
    return flat.select(*keep, *[F.col(n).cast(t).alias(n) for n, t in types.items()], *audit)


def batch_key(source: Column | str, resource: Column | str, day: Column, ticker: Column | None = None) -> Column:
    """``source_resource_yyyymmdd[_ticker]`` with colons replaced: the same window gives the same key."""
    parts = [source if isinstance(source, Column) else F.lit(source),
             resource if isinstance(resource, Column) else F.lit(resource), F.date_format(day, "yyyyMMdd")]
    if ticker is not None:
        parts.append(F.replace(ticker, F.lit(":"), F.lit("_")))
    return F.concat_ws("_", *parts)


def has_keys(contract: Contract) -> Column:
    """Whether a record has every partition key."""
    keys = contract.partition_keys
    if not keys:
        raise ValueError("the contract names no partition key")
    whole = F.lit(True)
    for key in keys:
        # An empty text names no partition either.
        present = F.col(key).isNotNull()
        if contract.record_types[key] == "string":
            present = present & (F.col(key) != "")
        whole = whole & present
    return F.coalesce(whole, F.lit(False))


def route(records: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Records with every partition key, and the rejects lacking one."""
    whole = has_keys(contract)
    return records.filter(whole), records.filter(~whole)
