"""Destination records: dynamic cells kept as VARIANT."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger import model
from shiftledger.functions.cells import cell, cell_text
from shiftledger.operators.reconcile import destination_cells

# The cells each strategy needs.
STRATEGY_FIELDS = {
    model.PAYROLL: (model.FIELD_USER, model.FIELD_PROJECT, model.FIELD_MONTH, model.FIELD_ACTUAL_HOURS),
    model.ASSIGNMENT: (
        model.FIELD_PERSON, model.FIELD_PROJECT_ASSIGNMENT, model.FIELD_ACTUAL_HOURS, model.FIELD_ASSIGNED_HOURS,
    ),
    model.PROJECT_ASSIGNMENT: (model.FIELD_PROJECT, model.FIELD_MONTH),
}


def load_destination(spark: SparkSession, path: str) -> DataFrame:
    """(id, pos, fields) of pages ``{"page": n, "records": [{id, fields}]}``, one per line.

    ``pos`` orders records as delivered: page number, file, place in the page.
    """
    pages = spark.read.schema(model.DESTINATION_EXTRACT).option("mode", "FAILFAST").json(path)
    return shape_records(pages.withColumn("_file", F.col("_metadata.file_name")))


def shape_records(pages: DataFrame) -> DataFrame:
    """Records of pages; ``_file`` breaks ties between pages without a number."""
    return pages.select(
        F.coalesce("page", F.lit(0).cast("bigint")).alias("_page"),
        "_file",
        F.posexplode("records").alias("_at", "r"),
    ).select(F.col("r.id").alias("id"), F.struct("_page", "_file", "_at").alias("pos"), F.col("r.fields").alias("fields"))


def load_strategy_cells(spark: SparkSession, path: str, strategy: str) -> DataFrame:
    """Only the cells the strategy needs, typed."""
    if strategy not in model.STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}")
    return destination_cells(load_destination(spark, path), strategy)


def reference_records(records: DataFrame, name_field: str) -> DataFrame:
    """(id, name); records whose name cell is not text are dropped."""
    named = records.select("id", cell_text(F.col("fields"), name_field).alias("name"))
    return named.where(F.col("name").isNotNull())


def load_reference_records(spark: SparkSession, path: str, name_field: str) -> DataFrame:
    """(id, name) of destination reference records."""
    return reference_records(load_destination(spark, path), name_field)


def inspect_records(
    df: DataFrame, predicate: str | None = None, columns: list[str] | None = None, max_rows: int | None = None
) -> DataFrame:
    """Ad-hoc look at a table: SQL predicate, column list, row limit (1 to 100000)."""
    if max_rows is not None and (
        isinstance(max_rows, bool) or not isinstance(max_rows, int) or not 1 <= max_rows <= model.MAX_INSPECT_ROWS
    ):
        raise ValueError(f"max_rows must be between 1 and {model.MAX_INSPECT_ROWS}")
    if predicate:
        df = df.where(predicate)
    if columns:
        df = df.select(*columns)
    return df if max_rows is None else df.limit(max_rows)


def inspect_cells(
    records: DataFrame, fields: list[str], predicate: str | None = None, max_rows: int | None = None
) -> DataFrame:
    """The same over destination records: the named cells as VARIANT columns."""
    shown = records.select("id", *[cell(F.col("fields"), f).alias(f) for f in fields])
    return inspect_records(shown, predicate, None, max_rows)
