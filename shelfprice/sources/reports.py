"""Report document: writing and reading JSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from shelfprice.operators.report import report_json, report_schema


def write_report(cleaned: DataFrame, path: str, generated_at: str | None = None) -> None:
    """Write the report as one JSON document below ``path``."""
    report_json(cleaned, generated_at).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The saved report as one row; no rows where none was saved."""
    try:
        return spark.read.schema(report_schema()).json(path, multiLine=True)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], report_schema())
