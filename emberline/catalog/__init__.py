"""Every query by name: the Spark form and, where SQL can say it, the same in SQL."""

from emberline.catalog import (  # noqa: F401
    aggregates, charts, closeouts, filters, functions, joins, models, reports, sources, streams, windows,
)
from emberline.catalog.registry import ORACLES, QUERIES  # noqa: F401
