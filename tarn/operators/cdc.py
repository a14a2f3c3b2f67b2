"""Flattening of change envelopes and message metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def target_name(pattern: str, db: Column, table: Column) -> Column:
    """Target table from a pattern with {db} and {table}; an empty pattern means db.table."""
    if not pattern:
        return F.concat_ws(".", db, table)
    return F.replace(F.replace(F.lit(pattern), F.lit("{db}"), db), F.lit("{table}"), table)


def debezium_flatten(df: DataFrame, pattern: str = "", key: str | None = None, offset: str | None = None) -> DataFrame:
    """Row image plus ``_cdc`` of change envelopes (op, ts_ms, source, before, after).

    A delete gives its before image, everything else its after image; updates
    are U, deletes D and all other codes I.  Empty payloads are dropped.
    """
    op = F.when(F.col("op") == "u", "U").when(F.col("op") == "d", "D").otherwise("I")
    db = F.coalesce(F.col("source.schema"), F.col("source.db"))
    table = F.col("source.table")
    cdc = F.struct(op.alias("op"), F.timestamp_millis("ts_ms").alias("ts"),
                   (F.col(offset) if offset else F.lit(None).cast("bigint")).alias("offset"),
                   F.concat_ws(".", db, table).alias("source"), target_name(pattern, db, table).alias("target"),
                   (F.col(key) if key else F.lit(None).cast("string")).alias("key"))
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return df.where(F.col("op").isNotNull()).select(image.alias("_row"), cdc.alias("_cdc")).where("_row IS NOT NULL") \
        .select("_row.*", "_cdc")


def dms_flatten(df: DataFrame) -> DataFrame:
    """Promoted ``data`` fields plus ``_cdc`` of (data, metadata) migration records."""
    operation = F.col("metadata.operation")
    op = F.when(operation == "update", "U").when(operation == "delete", "D").otherwise("I")
    source = F.concat_ws(".", F.col("metadata.schema-name"), F.col("metadata.table-name"))
    cdc = F.struct(op.alias("op"), F.col("metadata.timestamp").alias("ts"), source.alias("source"), source.alias("target"))
    return df.where("data IS NOT NULL AND metadata IS NOT NULL").select("data.*", cdc.alias("_cdc"))


def document_after(df: DataFrame, before: str, after: str, updated: str, removed: str, doc_id: str) -> DataFrame:
    """Whole document per change as map<string,string>.

    A full after image wins; a partial update is the before image plus updated
    minus removed fields, under its ``_id``; only a before image is a delete.
    An event with none of the three is an error.
    """
    old, new, changed = F.col(before), F.col(after), F.col(updated)
    base = F.coalesce(old, F.create_map().cast("map<string,string>"))
    gone = F.coalesce(F.col(removed), F.array().cast("array<string>"))
    with_id = F.create_map(F.lit("_id"), F.col(doc_id).cast("string"))
    known = F.map_filter(base, lambda k, _: ~F.map_contains_key(changed, k))
    patched = F.map_concat(known, changed)
    kept = F.map_filter(patched, lambda k, _: ~F.array_contains(gone, k) & (k != "_id"))
    document = (F.when(new.isNotNull(), new).when(changed.isNotNull(), F.map_concat(kept, with_id))
                .when(old.isNotNull(), old)
                .otherwise(F.raise_error(F.lit("change event without any image")).cast("map<string,string>")))
    return df.withColumn("document", document)


def attach_metadata(df: DataFrame, nested: bool = False, field: str = "_kafka_metadata",
                    external: tuple[str, str] | None = None) -> DataFrame:
    """Topic, partition, offset and time of each message, as prefixed columns or one struct."""
    parts = {"topic": F.col("topic"), "partition": F.col("partition"), "offset": F.col("offset"),
             "record_timestamp": F.col("timestamp")}
    if external:
        parts[external[0]] = F.lit(external[1])
    if nested:
        return df.withColumn(field, F.struct(*[c.alias(n) for n, c in parts.items()]))
    return df.withColumns({f"{field}_{n}": c for n, c in parts.items()})
