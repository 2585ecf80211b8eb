"""Daily weather from history documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.tables import with_surrogate_key
from emberline.sources.files import parse_daily_weather


def ingest(docs: DataFrame) -> DataFrame:
    """(date, doc) to one typed row per date with an id."""
    rows = docs.select("date", parse_daily_weather(F.col("doc")).alias("w")).select("date", "w.*")
    return with_surrogate_key(rows, "id", F.trunc("date", "month"), ["date"])
