"""Schemas and fixed values of the data model.

Neutral names: *source id* is the tracker's key, *link id* the key of the same
thing in the destination base, *chat id* the person's key in the chat roster.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# They decide results, so they must stay exactly as they are.

DEFAULT_TZ = "Africa/Johannesburg"
DEFAULT_CYCLE_DAY = 23

SENTINEL_SOURCE_ID = "NO-PROJECT"
SENTINEL_NAME = "No Project"

UNKNOWN_USER = "Unknown User"
UNKNOWN_CLIENT = "Unknown Client"
UNKNOWN_PROJECT = "Unknown Project"
NO_DESCRIPTION = "(No description provided)"

NO_USER = "no_user"
NO_PROJECT = "no_project"

RENAME_ARROW = " ➔ "
SYSTEM_MEMBER_IDS = ("USLACKBOT",)

BATCH_SIZE = 10
TOLERANCE = 0.01
MAX_INSPECT_ROWS = 100_000
DEFAULT_LOOKBACK_DAYS = 1
FAST = "FAST"
DEEP = "DEEP"
DEFAULT_BACKFILL_START = "2026-01-01T00:00:00Z"

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)

# Destination cell names, spelled as in the destination ("AMount" included).
FIELD_NAME = "Name"
FIELD_FULL_NAME = "Full Name"
FIELD_PROJECT = "Project"
FIELD_MONTH = "Month"
FIELD_USER = "User"
FIELD_ACTUAL_HOURS = "Actual Hours"
FIELD_PERSON = "Person"
FIELD_PROJECT_ASSIGNMENT = "Project Assignment"
FIELD_ASSIGNED_HOURS = "Assigned Hours"
FIELD_COMMITMENT_HOURS = "Commitment Hours"
FIELD_HOURS_TO_BE_PAID = "Hours to be Paid"
FIELD_ORIGINAL_INVOICE_AMOUNT = "Original Invoice AMount"

# Destination error codes that mean "this record is gone", and its id pattern.
DEAD_LINK_CODES = ("INVALID_RECORD_ID", "ROW_DOES_NOT_EXIST", "RECORD_NOT_FOUND")
RECORD_ID_PATTERN = "rec[a-zA-Z0-9]{14}"

# Characters a Unicode-aware trim removes. Spark's own trim takes only spaces.
WHITESPACE = (
    "\t\n\u000b\u000c\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Accepted shapes of an e-mail address and of a UTC instant.
EMAIL_PATTERN = (
    r"^(?!\.)(?!.*\.\.)([A-Za-z0-9_'+\-\.]*)[A-Za-z0-9_+-]"
    r"@([A-Za-z0-9][A-Za-z0-9\-]*\.)+[A-Za-z]{2,}$"
)
INSTANT_PATTERN = (
    r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])"
    r"T([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?Z$"
)

# --- strategies -------------------------------------------------------------

PAYROLL = "PAYROLL"
ASSIGNMENT = "ASSIGNMENT"
PROJECT_ASSIGNMENT = "PROJECT_ASSIGNMENT"
STRATEGIES = (PAYROLL, ASSIGNMENT, PROJECT_ASSIGNMENT)


@dataclass(frozen=True)
class ReconcileJob:
    """One destination table and how it is kept in step."""

    name: str
    source: str  # "monthly" or "payroll"
    strategy: str
    allow_inserts: bool = True

    def __post_init__(self) -> None:
        if self.strategy not in (PAYROLL, ASSIGNMENT):
            raise ValueError(f"Unknown reconcile strategy: {self.strategy}")


RECONCILE_JOBS = (
    ReconcileJob("People Assignments Table", "monthly", ASSIGNMENT),
    ReconcileJob("Payroll Actuals Table", "payroll", PAYROLL),
)


def lookback_window(lookback_days: int | None) -> tuple[timedelta, str]:
    """Look-back length and mode: FAST up to one day, DEEP beyond."""
    days = DEFAULT_LOOKBACK_DAYS if lookback_days is None else lookback_days
    if isinstance(days, bool) or not isinstance(days, int) or days <= 0:
        raise ValueError("lookback_days must be a positive integer")
    return timedelta(days=days), (DEEP if days > 1 else FAST)


# --- stored tables ----------------------------------------------------------

CLIENTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("link_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

USERS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("email", T.StringType()),
    T.StructField("link_id", T.StringType()),
    T.StructField("chat_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

PROJECTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("client_id", T.StringType()),
    T.StructField("link_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

# Durations are whole microseconds; null means the timer is still running.
ENTRIES = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("description", T.StringType()),
    T.StructField("start_time", T.TimestampType(), False),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("duration_us", T.LongType()),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("project_id", T.StringType()),
    T.StructField("deleted_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# --- extracts ---------------------------------------------------------------

USER_EXTRACT = "id STRING, name STRING, email STRING, status STRING"
CLIENT_EXTRACT = "id STRING, name STRING"
PROJECT_EXTRACT = "id STRING, name STRING, clientId STRING"
ENTRY_EXTRACT = (
    "id STRING, description STRING, userId STRING, projectId STRING, "
    "timeInterval STRUCT<start: STRING, end: STRING, duration: STRING>"
)
ROSTER_EXTRACT = (
    "ok BOOLEAN, error STRING, members ARRAY<STRUCT<id: STRING, name: STRING, "
    "real_name: STRING, deleted: BOOLEAN, is_bot: BOOLEAN, profile: STRUCT<email: STRING>>>"
)
DESTINATION_EXTRACT = "page BIGINT, records ARRAY<STRUCT<id: STRING, fields: VARIANT>>"
