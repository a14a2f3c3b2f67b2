"""Deterministic event generators over a sequence of ids.

A value is a function of (id, seed, field), so any executor can make any row,
a lost task makes the same rows again, and a run can be checked.  The sequence
comes from ``spark.range``, a rate stream or any id column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TICKERS = ("AAPL", "NVDA", "MSFT", "INTC", "TBV")  # fixed values
BID_EVENTS = ("bid_placed", "bid_won", "bid_lost")
PLATFORMS = ("ios", "android", "web")
CITIES = 10
RIDE_EVENTS = ("ride_request", "ride_start", "ride_end")
CURRENCIES = ("USD", "EUR", "GBP", "INR")

_M32 = 1 << 32


def noise(id: Column, seed: int) -> Column:
    """Well-mixed 32-bit number of an id: two multiply-and-shift rounds that fit 64-bit arithmetic."""
    x = F.pmod(F.pmod(id, F.lit(1 << 31)) * F.lit(2654435761) + F.lit(seed * 40503), F.lit(_M32))
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = F.pmod(x * F.lit(1540483477), F.lit(_M32))
    return x.bitwiseXOR(F.shiftright(x, 13))


@dataclass(frozen=True)
class Field:
    """How one generated column is made: ``sequence``, ``int``, ``decimal`` or ``choice``."""

    name: str
    kind: str
    low: int = 0
    high: int = 100
    digits: int = 2
    choices: tuple = ()

    def column(self, id: Column, seed: int) -> Column:
        n = noise(id, seed)
        if self.kind == "sequence":
            out = id + self.low
        elif self.kind == "int":
            out = F.pmod(n, F.lit(self.high - self.low + 1)) + self.low
        elif self.kind == "decimal":
            unit = 10**self.digits
            out = (F.pmod(n, F.lit((self.high - self.low) * unit + 1)) + self.low * unit) / F.lit(unit).cast("double")
        elif self.kind == "choice":
            out = F.element_at(F.array(*[F.lit(c) for c in self.choices]), (F.pmod(n, F.lit(len(self.choices))) + 1).cast("int"))
        else:
            raise ValueError(f"unknown kind {self.kind}")
        return out.alias(self.name)


def generate(ids: DataFrame, id: str, fields: list[Field], seed: int = 0, keep: list[str] = ()) -> DataFrame:
    """The declared columns for each id."""
    return ids.select(*keep, *[f.column(F.col(id), seed + i) for i, f in enumerate(fields)])


STOCK = [Field("ticker", "choice", choices=TICKERS), Field("price", "decimal", 0, 100)]
BID = [Field("event_name", "choice", choices=BID_EVENTS), Field("user_id", "int", 10000, 99999),
       Field("city_id", "int", 1, CITIES), Field("platform", "choice", choices=PLATFORMS), Field("session_no", "int", 1000, 9999)]
USER = [Field("event_type", "choice", choices=("page_view", "click", "login", "logout")), Field("user_id", "int", 10000, 99999),
        Field("page_no", "int", 1, 50), Field("device_type", "choice", choices=("desktop", "ios", "android", "mobile")),
        Field("session_no", "int", 1000, 9999)]
ORDER = [Field("order_no", "sequence"), Field("user_id", "int", 1, 10000), Field("order_amount", "decimal", 10, 5000),
         Field("currency", "choice", choices=CURRENCIES)]
RIDE = [Field("event_type", "choice", choices=RIDE_EVENTS), Field("user_no", "int", 1, 100), Field("ride_no", "int", 1, 50),
        Field("surge_multiplier", "decimal", 1, 3), Field("estimated_wait_minutes", "int", 2, 15),
        Field("fare_amount", "decimal", 10, 100), Field("driver_rating", "decimal", 3, 5)]


def ride_events(ids: DataFrame, id: str, millis: Column, seed: int = 0) -> DataFrame:
    """Ride events with nested metadata, as the JSON source carries them."""
    flat = generate(ids.withColumn("_ms", millis), id, RIDE, seed, keep=[id, "_ms"])

    def pad(prefix: str, name: str, width: int) -> Column:
        text = F.col(name).cast("string")
        return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))

    return flat.select(pad("evt_", id, 6).alias("event_id"), pad("user_", "user_no", 4).alias("user_id"), "event_type",
                       F.col("_ms").alias("timestamp"), pad("ride_", "ride_no", 5).alias("ride_id"),
                       F.struct("surge_multiplier", "estimated_wait_minutes", "fare_amount", "driver_rating").alias("metadata"))


def id_range(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    return spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)


def id_stream(spark: SparkSession, rows_per_second: int, partitions: int | None = None) -> DataFrame:
    """Unbounded ids at a rate: columns timestamp and value."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    return (reader.option("numPartitions", partitions) if partitions else reader).load()
