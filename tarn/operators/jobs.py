"""Jobs put together from configuration: source, named transforms, sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tarn.operators import events as ev
from tarn.sources.messages import parse_json

Transform = Callable[..., DataFrame]

TRANSFORMS: dict[str, Transform] = {}


def transform(name: str):
    """Make a function usable by name in job configurations."""

    def register(fn: Transform) -> Transform:
        TRANSFORMS[name] = fn
        return fn

    return register


@transform("with_event_time")
def _with_event_time(df: DataFrame, millis: str = "timestamp_ms", name: str = "event_time") -> DataFrame:
    return ev.with_event_time(df, millis, name)


@transform("user_enriched")
def _user_enriched(df: DataFrame, device: str = "device_type") -> DataFrame:
    return df.withColumn("is_mobile", ev.is_mobile(device))


@transform("date_and_hour")
def _date_and_hour(df: DataFrame, ts: str = "event_time") -> DataFrame:
    return ev.with_date_and_hour(df, ts)


@transform("select")
def _select(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.selectExpr(*columns)


@transform("where")
def _where(df: DataFrame, condition: str) -> DataFrame:
    return df.where(condition)


def fields_schema(fields: list[dict]) -> StructType:
    """Schema of ``[{name, type}, ...]`` entries."""
    return StructType.fromDDL(", ".join(f"`{f['name']}` {f['type']}" for f in fields))


def load_config(path: str) -> dict:
    """Job configuration from a YAML or JSON file; YAML needs its package installed."""
    import json

    with open(path) as handle:
        if path.endswith(".json"):
            return json.load(handle)
        import yaml

        return yaml.safe_load(handle)


def build_job(config: dict, source: DataFrame | None = None, spark: SparkSession | None = None) -> DataFrame:
    """DataFrame of a configured job, batch or streaming.

    ``source`` overrides the configured reader.  A source with ``fields`` parses
    its payload column as JSON into them.
    """
    src = config["source"]
    if source is None:
        reader = spark.readStream if src.get("streaming") else spark.read
        source = reader.format(src["format"]).options(**src.get("options", {})).load(*([src["path"]] if "path" in src else []))
    df = source
    if "fields" in src:
        df = parse_json(df.withColumn("_text", df[src.get("payload", "value")].cast("string")), "_text", fields_schema(src["fields"]))
    for step in config.get("transforms", []):
        name, args = (step, {}) if isinstance(step, str) else (step["name"], {k: v for k, v in step.items() if k != "name"})
        if name not in TRANSFORMS:
            raise ValueError(f"no transform named {name}; known: {sorted(TRANSFORMS)}")
        df = TRANSFORMS[name](df, **args)
    return df


def start_job(config: dict, df: DataFrame, checkpoint: str | None = None):
    """Write a configured job's rows; a stream returns its running query."""
    sink = config["sink"]
    partition = sink.get("partition_by", [])
    if df.isStreaming:
        writer = (df.writeStream.format(sink["format"]).outputMode(sink.get("mode", "append"))
                  .option("checkpointLocation", checkpoint or sink["checkpoint"]).options(**sink.get("options", {})))
        writer = writer.partitionBy(*partition) if partition else writer
        writer = writer.trigger(**sink.get("trigger", {"availableNow": True}))
        return writer.start(sink["path"]) if "path" in sink else writer.start()
    writer = df.write.format(sink["format"]).mode(sink.get("mode", "append")).options(**sink.get("options", {}))
    (writer.partitionBy(*partition) if partition else writer).save(sink["path"])
    return None
