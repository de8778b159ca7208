"""Report files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_json(report: DataFrame) -> DataFrame:
    """Each report row as pretty-printed JSON text."""
    return report.select(
        F.to_json(F.struct(*report.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")
    )


def report_sink(report: DataFrame, folder: str, stamp: str, prefix: str = "report") -> str:
    """Write a report as JSON text under a name made from ``stamp``; returns the path."""
    path = f"{folder}/{prefix}_{stamp}"
    report_json(report).write.mode("overwrite").text(path)
    return path
