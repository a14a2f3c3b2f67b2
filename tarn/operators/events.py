"""Row transforms of click, bid, order and ride events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

MOBILE_DEVICES = ("ios", "android", "mobile")  # fixed values
ORDER_STATUSES = ("CREATED",)  # fixed values
PRICE_BANDS = ((100, "LOW"), (500, "MEDIUM"))  # fixed values: upper limit, label
TOP_BAND = "HIGH"
UUID_PATTERN = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


def with_event_time(df: DataFrame, millis: str, name: str = "event_time", ingestion: str | None = None) -> DataFrame:
    """Epoch milliseconds to a timestamp, with the time of ingestion where asked for."""
    out = df.withColumn(name, F.timestamp_millis(F.col(millis)))
    return out.withColumn(ingestion, F.current_timestamp()) if ingestion else out


def is_mobile(device: str) -> Column:
    return F.coalesce(F.lower(F.col(device)).isin(*MOBILE_DEVICES), F.lit(False))


def with_date_and_hour(df: DataFrame, ts: str, date: str = "event_date", hour: str = "event_hour") -> DataFrame:
    return df.withColumn(date, F.to_date(ts)).withColumn(hour, F.hour(ts))


def price_band(price: Column) -> Column:
    """The band by upper limits; a NULL price is below no limit and so gets the top band."""
    (low, low_name), (mid, mid_name) = PRICE_BANDS
    return F.when(price < low, low_name).when(price < mid, mid_name).otherwise(TOP_BAND)


def with_day_and_hour_text(df: DataFrame, ts: str, day: str = "dt", hour: str = "hr") -> DataFrame:
    return df.withColumn(day, F.date_format(ts, "yyyy-MM-dd")).withColumn(hour, F.date_format(ts, "HH"))


RIDE_DDL = (
    "event_id string, user_id string, event_type string, `timestamp` bigint, ride_id string, "
    "metadata struct<surge_multiplier:double,estimated_wait_minutes:int,fare_amount:double,driver_rating:double>")


def flatten_ride(df: DataFrame) -> DataFrame:
    """Nested ride event to flat columns, '' and 0 for missing values, and its UTC hour."""
    text = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    number = lambda name, zero: F.coalesce(F.col(f"metadata.{name}"), F.lit(zero)).alias(name)
    millis = F.coalesce(F.col("timestamp"), F.lit(0).cast("bigint"))
    return df.select(
        text("event_id"), text("user_id"), text("event_type"), millis.alias("event_timestamp"), text("ride_id"),
        number("surge_multiplier", 0.0), number("estimated_wait_minutes", 0),
        number("fare_amount", 0.0), number("driver_rating", 0.0),
        F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd-HH").alias("event_hour"))


def fraud_flag(surge: Column, wait: Column) -> Column:
    return (surge > 3.0) | (wait > 60)


def risk_score(surge: Column, wait: Column, fare: Column, rating: Column) -> Column:
    """Sum of four tiered factors, at most 1."""
    by_surge = F.when(surge > 2.5, 0.3).when(surge > 2.0, 0.2).when(surge > 1.5, 0.1).otherwise(0.0)
    by_wait = F.when(wait > 45, 0.3).when(wait > 30, 0.2).otherwise(0.0)
    by_fare = F.when(fare > 1000, 0.2).when(fare < 5, 0.1).otherwise(0.0)
    by_rating = F.when(rating < 3.0, 0.2).otherwise(0.0)
    return F.least(by_surge + by_wait + by_fare + by_rating, F.lit(1.0))


def ride_advice(fraud: Column, risk: Column, surge: Column, wait: Column, rating: Column) -> Column:
    advice = F.concat_ws(
        " | ",
        F.when(fraud, F.lit("ALERT: Manual review required")),
        F.when(risk > 0.7, F.lit("High risk - apply additional verification"))
         .when(risk > 0.4, F.lit("Moderate risk - monitor closely")),
        F.when(surge > 2.0, F.concat(F.lit("High surge pricing ("), surge.cast("string"), F.lit("x)"))),
        F.when(rating < 3.5, F.concat(F.lit("Low driver rating ("), rating.cast("string"), F.lit(")"))),
        F.when(wait > 30, F.concat(F.lit("Long wait time ("), wait.cast("string"), F.lit(" min)"))))
    return F.when(advice == "", F.lit("Normal")).otherwise(advice)


def adjusted_fare(fraud: Column, surge: Column, fare: Column) -> Column:
    return F.when(fraud & (fare > 500), F.lit(500.0)).when((surge > 3.0) & (fare > 200), fare * 0.9)


def with_ride_rules(df: DataFrame) -> DataFrame:
    """Fraud flag, risk score, advice text and fare adjustment of flat ride rows."""
    surge, wait, fare, rating = (F.col(c) for c in (
        "surge_multiplier", "estimated_wait_minutes", "fare_amount", "driver_rating"))
    scored = df.withColumns({"fraud_detected": fraud_flag(surge, wait),
                             "risk_score": risk_score(surge, wait, fare, rating)})
    fraud, risk = F.col("fraud_detected"), F.col("risk_score")
    return scored.withColumns({"recommendation": ride_advice(fraud, risk, surge, wait, rating),
                               "adjusted_fare": adjusted_fare(fraud, surge, fare)})


def with_fraud_check(df: DataFrame) -> DataFrame:
    """The four named indicators as a map, their OR and BLOCK/ALLOW."""
    surge, wait, fare, rating = (F.col(c) for c in (
        "surge_multiplier", "estimated_wait_minutes", "fare_amount", "driver_rating"))
    marks = {"high_surge": surge > 3.0, "long_wait": wait > 60,
             "unusual_fare": (fare > 1000) | (fare < 5), "low_driver_rating": rating < 3.0}
    any_mark = marks["high_surge"] | marks["long_wait"] | marks["unusual_fare"] | marks["low_driver_rating"]
    entries = [x for name, mark in marks.items() for x in (F.lit(name), mark)]
    return df.withColumns({"indicators": F.create_map(*entries), "fraud_detected": any_mark,
                           "recommendation": F.when(any_mark, F.lit("BLOCK")).otherwise(F.lit("ALLOW"))})


def nearest(x: Column, digits: int) -> Column:
    """Decimal rounding of the exact binary value, ties to even.

    ``round`` and ``bround`` look at the shortest decimal text of a double, so
    525.825, which is stored slightly above that, would count as a tie.  The
    fraction is taken as a count of 2^-52 steps instead, and for |x| < 1 the
    part of a step that is left; products with 10^digits are exact up to 3 digits.
    """
    if not 0 <= digits <= 3:
        raise ValueError("digits must be from 0 to 3")
    whole, ten = F.floor(F.abs(x)), F.lit(10**digits)
    scaled = (F.abs(x) - whole) * F.lit(float(1 << 52))
    steps = F.floor(scaled) * ten
    kept, rest = whole * ten + F.shiftright(steps, 52), steps % F.lit(1 << 52)
    over = (rest - F.lit(1 << 51)).cast("double") + (scaled - F.floor(scaled)) * ten
    up = F.when((over > 0) | ((over == 0) & (kept % 2 == 1)), 1).otherwise(0)
    return F.signum(x) * (kept + up) / F.lit(float(10**digits))


def with_optimal_fare(df: DataFrame) -> DataFrame:
    """Discounted fare, savings and discount percentage, rounded half to even."""
    fare = F.col("fare_amount")
    after_surge = F.when(F.col("surge_multiplier") > 2.5, fare * 0.95).otherwise(fare)
    optimal = F.when(F.col("estimated_wait_minutes") > 45, after_surge * 0.9).otherwise(after_surge)
    savings = fare - optimal
    return df.withColumns({
        "optimal_fare": nearest(optimal, 2), "savings": nearest(savings, 2),
        "discount_percent": F.when(fare > 0, nearest(F.try_divide(savings, fare) * 100, 1)).otherwise(F.lit(0.0))})


ORDER_EVENT_DDL = ("event_id string, event_time string, order_id string, user_id string, "
                   "order_amount string, currency string, order_status string")


def parse_order_events(df: DataFrame) -> DataFrame:
    """Typed order events; a row missing a field or holding an unparsable one is dropped."""
    required = [f.split()[0] for f in ORDER_EVENT_DDL.split(", ")]
    iso = F.when(F.col("event_time").rlike(r"^\d{4}-\d{2}-\d{2}"), F.col("event_time"))
    typed = df.withColumns({"event_time": F.try_to_timestamp(iso),
                            "order_amount": F.expr("try_cast(order_amount AS decimal(10,2))")})
    return typed.dropna(subset=required)


def order_violations(df: DataFrame) -> DataFrame:
    """Checked order rows: upper-cased currency, the names of broken rules, and validity.

    The two-decimal rule looks at the amount's text, as a cast would round it away.
    """
    amount = F.expr("try_cast(order_amount AS decimal(38,10))")
    decimals = F.length(F.regexp_extract(F.col("order_amount"), r"\.(\d+)$", 1))
    size = lambda name: F.length(F.col(name))
    rules = {
        "event_id": F.col("event_id").rlike(UUID_PATTERN),
        "order_id": size("order_id").between(1, 64),
        "user_id": size("user_id").between(1, 64),
        "order_amount": (amount > 0) & (decimals <= 2),
        "currency": size("currency") == 3,
        "order_status": F.col("order_status").isin(*ORDER_STATUSES),
    }
    broken = F.concat_ws(",", *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    return (df.withColumn("violations", broken)
            .withColumn("is_valid", F.col("violations") == "")
            .withColumn("currency", F.upper("currency")))


def tag_dead_letters(df: DataFrame, failed: Column, tag: str = "is_dead_letter") -> DataFrame:
    """Mark rows for the dead-letter side; a NULL verdict is a failure of the check, not of the row."""
    return df.withColumn(tag, F.coalesce(failed, F.lit(False)))


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the target schema in its order and types; an absent column is NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
