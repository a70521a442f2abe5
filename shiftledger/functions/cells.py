"""Cells of a destination record.

``fields`` is a VARIANT because three states must stay apart: the cell is
absent, holds JSON null, or holds a value. ``kind`` names the state.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = "absent"
NULL = "null"
NUMBER = "number"
OTHER = "other"

# Type names of a numeric cell; a whole number may arrive as any of them.
_NUMERIC = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")


def cell(fields: Column, name: str, as_type: str = "variant") -> Column:
    """One cell; SQL NULL when absent or not of the asked type."""
    return F.try_variant_get(fields, f"$['{name}']", as_type)


def cell_kind(fields: Column, name: str) -> Column:
    """absent, null, number or other."""
    held = F.schema_of_variant(cell(fields, name))
    return (
        F.when(held.isNull(), ABSENT)
        .when(held == "VOID", NULL)
        .when(held.isin(*_NUMERIC) | held.startswith("DECIMAL"), NUMBER)
        .otherwise(OTHER)
    )


def cell_number(fields: Column, name: str) -> Column:
    """Numeric value; text that merely looks like a number counts as none."""
    held = F.schema_of_variant(cell(fields, name))
    return F.when(held.isin(*_NUMERIC) | held.startswith("DECIMAL"), cell(fields, name, "double"))


def cell_text(fields: Column, name: str) -> Column:
    """Text value; other types count as none."""
    value = cell(fields, name)
    return F.when(F.schema_of_variant(value) == "STRING", cell(fields, name, "string"))


def cell_first_link(fields: Column, name: str) -> Column:
    """First id of a link cell; null when the list is absent, empty or blank."""
    return F.nullif(F.try_variant_get(fields, f"$['{name}'][0]", "string"), F.lit(""))
