"""

Amounts are decimals with two places, so sums are exact and independent of their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions.calendar import ntz
from emberline.operators.rollups import hourly_sums
from emberline.sources.files import table

KEY = ["key"]
E_START, E_END = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
H_AS_OF = "2024-01-30 12:34:00"
O_AS_OF = "2001-07-15 12:00:00"
# When the watt limits changed, the high and the low limit.
THRESHOLDS = (
    ("2023-12-25 00:00:00", 60, 20),
    ("2024-01-10 06:30:00", 45, 15),
    ("2024-01-20 18:00:00", 70, 25),
)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"), "ts", F.col("event_id").alias("tie"),
        F.col("value").cast("decimal(10,2)").alias("watts"))


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "error"))
    return e.select(
        F.col("user_id").alias("key"), "ts", F.col("event_id").alias("tie"),
        F.when(F.col("event_type") == "signup", "ON").otherwise("OFF").alias("status"))


def thresholds(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"(TIMESTAMP_NTZ'{t}', {hi}, {lo})" for t, hi, lo in THRESHOLDS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(change_time, hi, lo)")


def one_device(df: DataFrame) -> DataFrame:
    """All readings as the series of a single meter."""
    return df.drop("key")


def event_hours(
    spark: SparkSession, sf_dir: str, live: bool = True, as_of: str | None = H_AS_OF, keys=(),
) -> DataFrame:
    """Hourly sums of the feed up to ``as_of``; without ``live`` only closed hours."""
    e = table(spark, sf_dir, "events").withColumn("key", F.col("user_id"))
    if as_of:
        e = e.where(F.col("ts") <= ntz(as_of)) if live else e.where(F.col("ts") < ntz(as_of[:13] + ":00:00"))
    return hourly_sums(e, F.to_date("ts"), F.hour("ts"), F.col("value").cast("decimal(10,2)"), keys)


def order_minutes():
    """Order price as runtime minutes with two places."""
    return (F.floor(F.col("o_totalprice") / 100).cast("decimal(10,0)") * F.lit("0.01").cast("decimal(3,2)"))


def order_hours(
    spark: SparkSession, sf_dir: str, live: bool = True, as_of: str | None = O_AS_OF, keys=(),
) -> DataFrame:
    """Hourly sums over many years up to ``as_of``; without ``live`` only closed hours."""
    o = table(spark, sf_dir, "orders").withColumns(
        {"_h": (F.col("o_orderkey") % 24).cast("int"), "key": F.col("o_custkey")})
    if as_of:
        day, hour = as_of[:10], int(as_of[11:13])
        today = ntz(day + " 00:00:00")
        open_hour = F.col("_h") <= hour if live else F.col("_h") < hour
        o = o.where((F.col("o_orderdate") < today) | ((F.col("o_orderdate") == today) & open_hour))
    return hourly_sums(o, F.to_date("o_orderdate"), F.col("_h"), order_minutes(), keys)


def deliveries(spark: SparkSession, sf_dir: str, as_of: str = O_AS_OF) -> DataFrame:
    """One delivery per date with an urgent order."""
    o = table(spark, sf_dir, "orders").where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") <= ntz(as_of[:10] + " 00:00:00")))
    return o.groupBy(F.to_date("o_orderdate").alias("delivery_date")).agg(
        F.max_by(F.col("o_orderstatus") == "F", "o_orderkey").alias("fill"),
        (F.sum(order_minutes()) * 5).cast("decimal(28,2)").alias("gallons"))


def climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean degree days per day of year: a seasonal part and a part that differs by order."""
    doy = F.dayofyear("o_orderdate")
    hdd = F.floor(F.abs(F.lit(183) - doy) * 40 / 183) + F.col("o_custkey") % 11
    return table(spark, sf_dir, "orders").groupBy(doy.alias("doy")).agg(
        (F.sum(hdd).cast("double") / F.count("*")).alias("hdd_avg"))


def forecast(spark: SparkSession, sf_dir: str, as_of: str = O_AS_OF) -> DataFrame:
    """Degree days of the ten days after ``as_of``."""
    d = F.to_date("o_orderdate")
    today = F.lit(as_of[:10]).cast("date")
    o = table(spark, sf_dir, "orders").where((d > today) & (d <= F.date_add(today, 10)))
    return o.groupBy(d.alias("forecast_date")).agg(
        F.round(F.sum(F.col("o_custkey") % 30).cast("double") / F.count("*"), 0).cast("int").alias("hdd"))


def astronomy(days: DataFrame) -> DataFrame:
    """Sunrise and sunset text for each date, moving by up to an hour over the year."""
    shift = F.dayofyear("date") % 60
    clock = lambda base: F.date_format(F.timestamp_add("MINUTE", shift, ntz(f"2000-01-01 {base}")), "HH:mm:ss")
    return days.select("date", clock("07:05:00").alias("sunrise"), clock("16:40:00").alias("sunset"))


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather history document per date, its figures drawn from that date's events."""
    e = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), F.from_json("props", "k INT")["k"].alias("k"))
    d = e.groupBy("date").agg(F.sum("k").alias("k"), F.count("*").alias("n"))
    k, n = F.col("k"), F.col("n")
    fields = {
        "heatingdegreedays": n % 40, "meandewpti": k % 50,
        "meanpressurei": F.concat(F.lit("29."), F.lpad((n % 100).cast("string"), 2, "0")),
        "meantempi": k % 80, "meanvisi": n % 10, "meanwdird": k % 360, "meanwindspdi": n % 25,
    }
    day = F.struct(*[v.cast("string").alias(name) for name, v in fields.items()])
    doc = F.to_json(F.struct(F.struct(F.array(day).alias("dailysummary")).alias("history")))
    return d.select("date", doc.alias("doc"))
