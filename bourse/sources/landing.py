"""Raw API responses as JSON, keyed by source, ingestion date and batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.contracts import Contract

KEYS = ("source", "ingestion_date", "batch_id")
UNREADABLE = "unreadable"


def write_landing(responses: DataFrame, root: str, payload: str = "payload", parameters: tuple[str, ...] = ()) -> None:
    """Store one response per line; a batch written again replaces itself.

    ``responses`` has the three key columns, the response (JSON text or a
    struct) and optional request parameters, kept beside it under ``_param``.
    """
    if responses.schema[payload].dataType.typeName() == "string":
        # One line per response: outside its strings JSON treats line breaks as blanks.
        body = F.regexp_replace(payload, r"[\r\n]+", " ")
        if parameters:
            request = F.to_json(F.struct(F.struct(*parameters).alias("_param")))
            empty = body.rlike(r"^\s*\{\s*\}\s*$")
            joined = F.concat(F.regexp_replace(body, r"\}\s*$", ","), F.regexp_replace(request, r"^\{", ""))
            body = F.when(empty, request).otherwise(joined)
    else:
        request = [F.struct(*parameters).alias("_param")] if parameters else []
        body = F.to_json(F.struct(f"{payload}.*", *request))
    (responses.select(*KEYS, body.alias("value"))
        .hint("rebalance", *KEYS)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*KEYS).text(root))


# A number is a number: "NaN" and "Infinity" in a response are no prices.
_JSON_OPTIONS = {"allowNonNumericNumbers": "false", "columnNameOfCorruptRecord": UNREADABLE}


def read_landing(spark: SparkSession, root: str, contract: Contract, multi_line: bool = False,
                 parameters: dict[str, str] | None = None, with_file: bool = False) -> DataFrame:
    """Responses of a contract as a ``payload`` struct plus the key columns.

    Only what the contract's paths mention is parsed. ``multi_line`` reads one
    pretty-printed object per file instead of one per line. ``parameters``
    names the request parameters stored with the response and their types;
    ``with_file`` adds the file each response came from. ``unreadable`` holds
    the text of a response that is no JSON or has a value that does not fit its
    type, else null. Key columns are text as they stand in the folder names.
    """
    schema = contract.payload_schema
    if parameters:
        request = ", ".join(f"{name} {data_type}" for name, data_type in parameters.items())
        schema = T.StructType([*schema.fields]).add("_param", T.StructType.fromDDL(request))
    schema = T.StructType([*schema.fields]).add(UNREADABLE, "string")
    for key in KEYS:
        schema = schema.add(key, "string")
    rows = spark.read.schema(schema).options(**_JSON_OPTIONS).option("multiLine", multi_line).json(root)
    fields = [f.name for f in contract.payload_schema.fields]
    extra = [F.col(f"_param.{p}").alias(p) for p in (parameters or {})]
    if with_file:
        extra.append(F.col("_metadata.file_path").alias("landing_file"))
    return rows.select(F.struct(*[F.col(f"`{f}`") for f in fields]).alias("payload"), *extra, *KEYS, UNREADABLE)


def parse_responses(df: DataFrame, column: str, contract: Contract) -> DataFrame:
    """JSON text in a column to the contract's ``payload`` struct, and ``unreadable`` as in `read_landing`."""
    fields = contract.payload_schema.fields
    schema = T.StructType([*fields]).add(UNREADABLE, "string")
    parsed = df.withColumn("payload", F.from_json(column, schema, _JSON_OPTIONS))
    lost = F.col("payload").isNull() & F.col(column).isNotNull()
    unreadable = F.when(lost, F.col(column)).otherwise(F.col(f"payload.{UNREADABLE}"))
    payload = F.when(F.col("payload").isNotNull(), F.struct(*[F.col(f"payload.`{f.name}`") for f in fields]))
    return parsed.withColumns({UNREADABLE: unreadable, "payload": payload})
