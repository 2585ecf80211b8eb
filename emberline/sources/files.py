"""File and text sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The seven fields of one day's weather history and their stored names.
DAILY_WEATHER = {
    "heatingdegreedays": ("hdd", "int"),
    "meandewpti": ("mean_dewpoint", "int"),
    "meanpressurei": ("mean_pressure", "decimal(10,2)"),
    "meantempi": ("mean_temperature", "int"),
    "meanvisi": ("mean_visibility", "int"),
    "meanwdird": ("mean_wind_direction", "int"),
    "meanwindspdi": ("mean_wind_speed", "int"),
}


# Columns of the given tables; a known schema spares the job that would read it from a file.
SCHEMAS = {
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


# How the tab-separated dump format writes characters inside a field.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
NULL_MARK = "\\N"


def write_tsv(df: DataFrame, path: str) -> None:
    r"""Tab-separated dump without header: ``\N`` is null, an empty field is an empty text."""
    def field(c):
        text = F.col(c).cast("string")
        for raw, written in ESCAPES:
            text = F.replace(text, F.lit(raw), F.lit(written))
        return F.coalesce(text, F.lit(NULL_MARK))

    df.select(F.concat_ws("\t", *[field(c) for c in df.columns])).write.text(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reads a dump; columns come in the order of ``schema``."""
    parts = F.split("value", "\t", -1)

    def field(i, kind):
        text = F.get(parts, F.lit(i))
        whole = text
        text = F.replace(text, F.lit("\\\\"), F.lit("\0"))
        for raw, written in ESCAPES[1:]:
            text = F.replace(text, F.lit(written), F.lit(raw))
        text = F.replace(text, F.lit("\0"), F.lit("\\"))
        return F.when(whole != NULL_MARK, text).cast(kind)

    fields = StructType.fromDDL(schema).fields
    return spark.read.text(path).select(*[field(i, f.dataType).alias(f.name) for i, f in enumerate(fields)])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with header. Without a schema the types are inferred, which reads the file twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_relation(spark: SparkSession, url: str, relation: str, column: str, lower, upper, parts: int) -> DataFrame:
    """A database table or query in ``parts`` parallel range scans (needs its driver jar)."""
    return spark.read.jdbc(url, relation, column, lower, upper, parts)


def parse_daily_weather(doc: Column) -> Column:
    """Struct of typed daily means from a weather history document; an unreadable figure is null."""
    fields = ", ".join(f"{name}: STRING" for name in DAILY_WEATHER)
    parsed = F.from_json(doc, f"history STRUCT<dailysummary: ARRAY<STRUCT<{fields}>>>")
    first = F.get(parsed["history"]["dailysummary"], F.lit(0))
    return F.struct(*[first[name].try_cast(kind).alias(to) for name, (to, kind) in DAILY_WEATHER.items()])


def export_chart(df: DataFrame, path: str, chart: str) -> None:
    """One tidy table per chart, next to the others."""
    (df.withColumn("chart", F.lit(chart)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("chart").parquet(path))
