"""Reports as rows (kind, title, section, text), one row per line. Putting lines into messages is the sender's part.

No list is collected, so a report of any length is spread over as many tasks as its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.functions.text import empty_to_null
from shiftledger.operators.references import CONFLICT, HEAL

SCHEMA = "kind STRING, title STRING, section STRING, text STRING"


def _lines(rows: DataFrame, kind: str, title: str, section: Column, text: Column) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("kind"), F.lit(title).alias("title"), section.alias("section"), text.alias("text")
    )


def sync_report_rows(report: DataFrame, changes: DataFrame, status: str = "SUCCESS") -> DataFrame:
    """What a run did: one line per changed name, and one per count.

    ``report`` is the one-row :func:`window_sync.sync_report`, ``changes`` the (table, kind, text) rows behind it.
    """
    kind, title = "sync_report", "What the last run did"
    names = _lines(changes, kind, title, F.concat_ws(" ", "table", "kind"), F.col("text"))
    facts = {"merged entries": "upserted", "removed entries": "deleted", "people looked at": "users_scanned"}
    counts = [F.concat(F.lit(f"{label}: "), F.col(column).cast("string")) for label, column in facts.items()]
    lines = report.select(F.explode(F.array(F.lit(f"outcome: {status}"), *counts)).alias("text"))
    return names.unionByName(_lines(lines, kind, title, F.lit("run"), F.col("text")))


def conflict_rows(resolved: DataFrame) -> DataFrame:
    """One line per name carried by several destination records."""
    text = F.lit("Several records answer to this name, so none was linked; one of them has to stay alone.")
    return _lines(resolved.where(F.col("action") == CONFLICT), "conflict", "Ambiguous name", F.col("name"), text)


def heal_rows(resolved: DataFrame, table: str) -> DataFrame:
    """One line per row that was linked to an existing record."""
    text = F.concat(F.col("name"), F.lit(" is linked to "), F.col("link_id"))
    return _lines(resolved.where(F.col("action") == HEAL), "auto_heal", "Links found again", F.lit(table), text)


def dead_link_rows(dead: DataFrame) -> DataFrame:
    """One line per link id the destination no longer has."""
    gone = dead.where(F.col("link_id").isNotNull()).select("link_id").distinct()
    text = F.lit("No record has this id any more. The link is dropped; the next run looks for the name.")
    return _lines(gone, "dead_link", "Link to nothing", F.col("link_id"), text)


def unmatched_rows(unmatched: DataFrame) -> DataFrame:
    """One line per person who could not be found in the roster."""
    email = F.coalesce(empty_to_null(F.col("user_email")), F.lit("address unknown"))
    return _lines(
        unmatched, "unmatched_people", "Not on the roster", F.lit("people"), F.concat_ws(", ", "user_name", email)
    )
