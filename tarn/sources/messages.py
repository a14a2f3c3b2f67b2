"""Message payloads (JSON text, change envelopes, binary records) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

START_MODES = {"earliest": "earliest", "latest": "latest", "earliest-offset": "earliest", "latest-offset": "latest"}


def stream_options(servers: str, topics: list[str] | str, start: str = "earliest",
                   group: str | None = None, per_trigger: int | None = None) -> dict[str, str]:
    """Reader options of a message stream.

    ``group-offsets`` has no reader option of its own: a restarted query
    resumes from its checkpoint, and only the first start falls back to earliest.
    """
    names = [topics] if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": "earliest" if start == "group-offsets" else START_MODES[start],
    }
    if group:
        options["groupIdPrefix"] = group
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def message_stream(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """A stream over any message connector on the class path (its jar is the user's)."""
    return spark.readStream.format(fmt).options(**options).load()


def parse_json(df: DataFrame, payload: str | Column, schema: StructType, keep: list[str] | None = None,
               drop_malformed: bool = True, corrupt: str = "_corrupt_record") -> DataFrame:
    """Typed rows out of JSON text: a missing field is NULL, a malformed row is dropped."""
    column = F.col(payload) if isinstance(payload, str) else payload
    wide = StructType([*schema.fields, StructField(corrupt, StringType())])
    parsed = F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    if drop_malformed:
        # A plain filter on the parsed row would be pushed below it and parse every payload a second time.
        good = F.filter(F.array(parsed), lambda row: row.isNotNull() & row[corrupt].isNull())
        rows = df.select(*(keep or []), F.explode(good).alias("_row"))
    else:
        rows = df.select(*(keep or []), parsed.alias("_row"))
    return rows.select(*(keep or []), *[F.col(f"_row.{f.name}").alias(f.name) for f in schema.fields])


def json_paths(df: DataFrame, payload: str, paths: dict[str, tuple[str, str]], keep: list[str] | None = None) -> DataFrame:
    """Extract dotted paths with casts, parsing each document once.

    ``paths`` maps an output column to (path such as ``metadata.fare``, type);
    a value that does not cast is NULL.
    """
    doc = F.try_parse_json(F.col(payload))
    columns = [F.try_variant_get(F.col("_doc"), f"$.{path}", kind).alias(name) for name, (path, kind) in paths.items()]
    return df.select(*(keep or []), doc.alias("_doc")).select(*(keep or []), *columns)


def parse_avro(df: DataFrame, payload: str, reader_schema: str) -> DataFrame:
    """Binary records with a reader schema; needs the external Avro package."""
    from pyspark.sql.avro.functions import from_avro

    return df.select(from_avro(F.col(payload), reader_schema).alias("_row")).select("_row.*")


def image_to_changes(df: DataFrame, old: str, new: str, order: str, event: str | None = None) -> DataFrame:
    """Old/new item images to change rows: both present is an update pair.

    Rows equal in both images still give the pair, as the source reported a change.
    """
    has_old, has_new = F.col(old).isNotNull(), F.col(new).isNotNull()

    def row(kind: Column, image: str) -> Column:
        return F.struct(kind.alias("_change_type"), F.col(image).alias("item"))

    before = F.when(has_old, row(F.when(has_new, F.lit("UPDATE_BEFORE")).otherwise(F.lit("DELETE")), old))
    after = F.when(has_new, row(F.when(has_old, F.lit("UPDATE_AFTER")).otherwise(F.lit("INSERT")), new))
    extra = [event] if event else []
    return (df.select(order, *extra, F.explode(F.array_compact(F.array(before, after))).alias("_c"))
            .select(order, *extra, "_c._change_type", "_c.item.*"))


def cdc_rows(df: DataFrame, payload: str, table_schema: StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Database change messages to rows with source metadata columns.

    The message holds ``op``, ``ts_ms``, ``source(db, schema, table)`` and the
    before/after images; the row of a delete is its before image.
    """
    envelope = StructType.fromDDL("op string, ts_ms bigint, source struct<db:string,schema:string,`table`:string>")
    envelope = (envelope.add("before", table_schema).add("after", table_schema))
    rows = parse_json(df, payload, envelope)
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    names = renames or {}
    return (rows.select("op", "ts_ms", "source", image.alias("_row")).where(F.col("_row").isNotNull())
            .select(*[F.col(f"_row.{f.name}").alias(names.get(f.name, f.name)) for f in table_schema.fields],
                    F.col("op").alias("op"),
                    F.timestamp_millis("ts_ms").alias("op_ts"),
                    F.col("source.db").alias("database_name"),
                    F.col("source.schema").alias("schema_name"),
                    F.col("source.table").alias("table_name")))
