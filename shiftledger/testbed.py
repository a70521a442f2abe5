"""The data model filled from the shared benchmark tables.

Every table is read whole. Values the benchmark tables lack (links, e-mails,
projects of an order) are derived per row; which rows count as stored, as
extracted or as removed follows from columns of the row itself.

customer -> users, nation -> clients, part -> projects, orders -> entries,
lineitem with supplier -> a second, larger set of entries for the aggregates.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.model import SENTINEL_NAME, SENTINEL_SOURCE_ID

WINDOW_START = datetime(2000, 1, 1, tzinfo=UTC)
RUN_TS = datetime(2002, 1, 1, tzinfo=UTC)
LOOKBACK_TS = datetime(1998, 6, 1, 12, tzinfo=UTC)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(prefix: str, value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit(prefix), value.cast("string"))


def _instant(wall: Column) -> Column:
    """Benchmark timestamps have no zone; they are read as UTC."""
    return F.from_utc_timestamp(wall.cast("timestamp"), F.current_timezone())


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        _text("c", key).alias("id"),
        _text("sc", key).alias("source_id"),
        F.col("n_name").alias("name"),
        F.when(key % 4 != 0, _text("recC", key)).alias("link_id"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _text("u", key).alias("id"),
        _text("su", key).alias("source_id"),
        F.col("c_name").alias("name"),
        F.when(key % 7 != 0, F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email"),
        F.when(key % 11 != 3, _text("recU", key)).alias("link_id"),
        F.when(key % 13 == 5, _text("S", key)).alias("chat_id"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        _text("p", key).alias("id"),
        F.when(key == 0, SENTINEL_SOURCE_ID).otherwise(_text("sp", key)).alias("source_id"),
        F.when(key == 0, SENTINEL_NAME).otherwise(F.col("p_name")).alias("name"),
        _text("c", key % 25).alias("client_id"),
        F.when(key == 0, "recNOPROJ").when(key % 9 != 0, _text("recP", key)).alias("link_id"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


def _project_key() -> Column:
    """Project of an order: none, the sentinel, or one of the parts, whose keys reach beyond those of customers."""
    key = F.col("o_orderkey")
    return F.when(key % 23 == 0, None).when(key % 10 == 0, 0).otherwise(F.col("o_custkey") + key % 40)


def _order_start() -> Column:
    key = F.col("o_orderkey")
    return F.timestamp_seconds(F.unix_seconds(_instant(F.col("o_orderdate"))) + (key * 7919) % 86400)


def _order_seconds() -> Column:
    return F.when(F.col("o_orderkey") % 13 != 0, F.floor("o_totalprice").cast("bigint") % 36000)


def all_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an entry; ``priority`` and ``status`` are kept for the variants below."""
    key = F.col("o_orderkey")
    seconds = _order_seconds()
    return table(spark, sf_dir, "orders").select(
        _text("e", key).alias("id"),
        _text("se", key).alias("source_id"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("description"),
        _order_start().alias("start_time"),
        F.timestamp_seconds(F.unix_seconds(_order_start()) + seconds).alias("end_time"),
        (seconds * 1_000_000).alias("duration_us"),
        _text("u", "o_custkey").alias("user_id"),
        F.when(_project_key().isNotNull(), _text("p", _project_key())).alias("project_id"),
        F.when(key % 17 == 0, F.timestamp_seconds(F.lit(978307200))).alias("deleted_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a stored entry."""
    return all_entries(spark, sf_dir).drop("priority", "status")


def stored_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store before a sync: urgent orders have not arrived yet."""
    return all_entries(spark, sf_dir).where(F.col("priority") != "1-URGENT").drop("priority", "status")


def current_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after a sync: urgent orders have arrived, low-priority ones are gone."""
    return all_entries(spark, sf_dir).where(F.col("priority") != "5-LOW").drop("priority", "status")


def extract_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tracker returns: low-priority orders are gone, orders in state
    P were edited (ten minutes more, and half a year later). Some rows name an
    unknown user."""
    key = F.col("o_orderkey")
    edited = F.col("o_orderstatus") == "P"
    start = F.when(
        edited, F.timestamp_seconds(F.unix_seconds(_order_start()) + 180 * 86400)
    ).otherwise(_order_start())
    micros = (_order_seconds() + F.when(edited, 600).otherwise(0)) * 1_000_000
    project = _project_key()
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") != "5-LOW")
        .select(
            _text("se", key).alias("source_id"),
            F.when(key % 5 != 0, F.col("o_orderpriority")).alias("description"),
            start.alias("start_time"),
            F.timestamp_micros(F.unix_micros(start) + micros).alias("end_time"),
            micros.alias("duration_us"),
            F.when(key % 41 == 0, _text("gone", "o_custkey"))
            .otherwise(_text("su", "o_custkey"))
            .alias("user_source_id"),
            F.when(project == 0, SENTINEL_SOURCE_ID)
            .when(project.isNotNull(), _text("sp", project))
            .alias("project_source_id"),
        )
    )


def line_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as users of the line-item entries."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        _text("u", key).alias("id"),
        F.col("s_name").alias("name"),
        F.when(key % 11 != 3, _text("recU", key)).alias("link_id"),
    )


def line_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as entries. They have no unique key, so aggregates only."""
    shipped = F.unix_seconds(_instant(F.col("l_shipdate")))
    return table(spark, sf_dir, "lineitem").select(
        F.timestamp_seconds(shipped + F.col("l_linenumber") * 3600).alias("start_time"),
        (F.col("l_quantity") * 900).cast("bigint").alias("secs"),
        _text("u", "l_suppkey").alias("user_id"),
        _text("p", "l_partkey").alias("project_id"),
        F.lit(None).cast("timestamp").alias("deleted_at"),
    ).withColumn("duration_us", F.col("secs") * 1_000_000).drop("secs")


# --- destination, roster, errors --------------------------------------------


def _digest(*parts: str) -> Column:
    """Hash of a row's raw key; gives record ids and a stable order."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(p), F.lit("-")) for p in parts]))


def payroll_records(previous: DataFrame) -> DataFrame:
    """Destination records an earlier run left behind, from its payroll rows.

    Users without link give records without user; every seventh amount was never
    written (cell absent), every eleventh is text.
    """
    cents = (F.col("total_hours") * 100).cast("bigint")
    hours = F.col("total_hours").cast("double")
    digest = _digest("user_link", "user_name", "raw_project_link", "project_name", "month")
    keyed = previous.select(
        F.concat(F.lit("rec"), F.substring(digest, 1, 14)).alias("id"),
        digest.alias("pos"),
        F.when(F.col("user_link").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array("user_link"))
        .alias("u"),
        F.when(F.col("project_link").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array("project_link"))
        .alias("p"),
        "month",
        cents.alias("cents"),
        hours.alias("hours"),
    )
    links = [F.col("u").alias("User"), F.col("p").alias("Project"), F.col("month").alias("Month")]
    fields = (
        F.when(F.col("cents") % 7 == 0, F.to_variant_object(F.struct(*links)))
        .when(
            F.col("cents") % 11 == 0,
            F.to_variant_object(F.struct(*links, F.lit("n/a").alias("Actual Hours"))),
        )
        .otherwise(F.to_variant_object(F.struct(*links, F.col("hours").alias("Actual Hours"))))
    )
    return keyed.select("id", "pos", fields.alias("fields"))


def assignment_records(previous: DataFrame) -> DataFrame:
    """Project assignment records of an earlier run, from its monthly rows.

    One per project and month; the record id is a hash of that key.
    """
    pairs = previous.where(F.col("project_link").isNotNull()).select("project_link", "month").distinct()
    digest = _digest("project_link", "month")
    return pairs.select(
        F.concat(F.lit("rec"), F.substring(digest, 1, 14)).alias("id"),
        digest.alias("pos"),
        F.to_variant_object(
            F.struct(
                F.array("project_link").alias("Project"),
                F.date_format(F.to_date("month", "MMMM yyyy"), "yyyy-MM-dd").alias("Month"),
            )
        ).alias("fields"),
    )


def person_records(previous: DataFrame) -> DataFrame:
    """People assignment records of an earlier run, from its monthly rows.

    Every fifth lacks its assigned hours.
    """
    cents = (F.col("total_hours") * 100).cast("bigint")
    digest = _digest("user_link", "user_name", "raw_project_link", "project_name", "month")
    assignment = F.concat(F.lit("rec"), F.substring(_digest("project_link", "month"), 1, 14))
    cells = [
        F.array("user_link").alias("Person"),
        F.array(assignment).alias("Project Assignment"),
        F.col("total_hours").cast("double").alias("Actual Hours"),
    ]
    fields = F.when(cents % 5 == 0, F.to_variant_object(F.struct(*cells))).otherwise(
        F.to_variant_object(F.struct(*cells, F.lit(8.0).alias("Assigned Hours")))
    )
    return previous.where(F.col("project_link").isNotNull() & F.col("user_link").isNotNull()).select(
        F.concat(F.lit("rec"), F.substring(digest, 1, 14)).alias("id"), digest.alias("pos"), fields.alias("fields")
    )


def name_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destination reference records: customers' names in upper case with a
    blank behind, and parts by brand, type and size, several of which coincide."""
    customers = table(spark, sf_dir, "customer").select(
        _text("recU", "c_custkey").alias("id"),
        F.concat(F.upper("c_name"), F.lit(" ")).alias("name"),
    )
    parts = table(spark, sf_dir, "part").select(
        _text("recB", "p_partkey").alias("id"),
        F.concat(F.lit("\t"), F.upper("p_brand"), F.lit(" "), F.upper("p_type"), F.lit(" "), "p_size").alias("name"),
    )
    return customers.unionByName(parts)


def unlinked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows waiting for a link: every customer, and every part by brand,
    type and size. Parts give unknown, unique and repeated names."""
    customers = table(spark, sf_dir, "customer").select(_text("u", "c_custkey").alias("id"), F.col("c_name").alias("name"))
    parts = table(spark, sf_dir, "part").select(
        _text("b", "p_partkey").alias("id"),
        F.concat("p_brand", F.lit(" "), "p_type", F.lit(" "), (F.col("p_size") + 1).cast("string")).alias("name"),
    )
    return customers.unionByName(parts)


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat members: customers of three market segments; some without e-mail."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD")
    ).select(
        _text("S", key).alias("id"),
        F.upper("c_name").alias("name"),
        F.when(
            F.col("c_mktsegment") != "BUILDING", F.concat(F.lit(" "), F.upper("c_name"), F.lit("@EXAMPLE.COM"))
        ).alias("email"),
        key.alias("pos"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user as somebody to be found in the roster."""
    return users(spark, sf_dir).select(
        F.col("id").alias("user_id"), F.col("name").alias("user_name"), F.col("email").alias("user_email"), "chat_id"
    )


def destination_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error texts of a destination, one per order."""
    key = F.col("o_orderkey")
    code = F.element_at(
        F.array(
            *[F.lit(x) for x in ("INVALID_RECORD_ID", "ROW_DOES_NOT_EXIST", "RECORD_NOT_FOUND",
                                 "INVALID_PERMISSIONS", "TIMEOUT")]
        ),
        (key % 5 + 1).cast("int"),
    )
    return table(spark, sf_dir, "orders").select(
        _text("x", key).alias("error_id"),
        F.concat(
            code,
            F.lit(": record rec"),
            F.when(key % 3 != 0, F.lpad(key.cast("string"), 14, "0")).otherwise(F.lit("?")),
            F.lit(" failed"),
        ).alias("message"),
    )


# --- raw extracts -----------------------------------------------------------


def raw_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested tracker entries; some lack a user or have a broken duration."""
    key = F.col("o_orderkey")
    seconds = _order_seconds()
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    duration = F.when(key % 37 == 1, "1 hour").when(
        seconds.isNotNull(),
        F.concat(
            F.lit("PT"), F.floor(seconds / 3600).cast("string"),
            F.lit("H"), F.floor(seconds % 3600 / 60).cast("string"),
            F.lit("M"), (seconds % 60).cast("string"), F.lit("S"),
        ),
    )
    return table(spark, sf_dir, "orders").select(
        _text("se", key).alias("id"),
        F.col("o_orderpriority").alias("description"),
        F.when(key % 29 != 2, _text("su", "o_custkey")).alias("userId"),
        F.when(_project_key().isNotNull(), _text("sp", _project_key())).alias("projectId"),
        F.struct(
            F.date_format(F.to_utc_timestamp(_order_start(), F.current_timezone()), stamp).alias("start"),
            F.lit(None).cast("string").alias("end"),
            duration.alias("duration"),
        ).alias("timeInterval"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tracker users, some without name, some without e-mail too."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _text("su", key).alias("id"),
        F.when(key % 3 != 0, F.col("c_name")).when(key % 9 == 0, F.lit("")).alias("name"),
        F.when(
            key % 5 != 0, F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
        ).alias("email"),
        F.col("c_mktsegment").alias("status"),
    )


def raw_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as tracker clients, some without a name."""
    key = F.col("n_nationkey")
    name = F.when(key % 4 == 1, F.lit("")).when(key % 4 != 0, F.col("n_name"))
    return table(spark, sf_dir, "nation").select(_text("sc", key).alias("id"), name.alias("name"))


def raw_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tracker projects, some without a name or a client."""
    key = F.col("p_partkey")
    name = F.when(key % 6 == 1, F.lit("")).when(key % 6 != 0, F.col("p_name"))
    return table(spark, sf_dir, "part").select(
        _text("sp", key).alias("id"), name.alias("name"), F.when(key % 5 != 0, _text("sc", key % 25)).alias("clientId")
    )


def raw_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as roster pages of one member: leavers, bots, missing names."""
    key = F.col("c_custkey")
    member = F.struct(
        F.when(key == 1, "USLACKBOT").otherwise(_text("S", key)).alias("id"),
        F.lower("c_name").alias("name"),
        F.when(key % 4 != 0, F.col("c_name")).alias("real_name"),
        F.when(F.col("c_mktsegment") == "FURNITURE", True).alias("deleted"),
        (F.col("c_mktsegment") == "MACHINERY").alias("is_bot"),
        F.struct(F.when(key % 2 == 0, F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email")).alias("profile"),
    )
    return table(spark, sf_dir, "customer").select(
        F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"), F.array(member).alias("members"),
        key.alias("page"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as destination records: their JSON properties are the cells."""
    return table(spark, sf_dir, "events").select(
        _text("ev", "event_id").alias("id"), F.col("event_id").alias("pos"), F.parse_json("props").alias("fields")
    )


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as destination records whose name cell is text, a number or absent."""
    key = F.col("page_id")
    fields = (
        F.when(key % 3 == 0, F.to_variant_object(F.struct(F.col("url").alias("Name"))))
        .when(key % 3 == 1, F.to_variant_object(F.struct(key.alias("Name"))))
        .otherwise(F.to_variant_object(F.struct(F.col("url").alias("Title"))))
    )
    return table(spark, sf_dir, "pages").select(
        _text("pg", key).alias("id"), key.alias("pos"), fields.alias("fields")
    )


def dated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as project assignment cells: many records per project and month.

    The second of every seven lines has no project.
    """
    digest = F.md5(
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint"))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("rec"), F.substring(digest, 1, 14)).alias("id"),
        digest.alias("pos"),
        F.when(F.col("l_linenumber") == 2, "").otherwise(_text("recP", "l_partkey")).alias("project_link"),
        F.date_format(F.trunc(F.col("l_shipdate").cast("date"), "MM"), "yyyy-MM-dd").alias("month"),
    )


def mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as destination records whose hours cell is a number, null, text or absent."""
    key = F.col("event_id")
    text = (
        F.when(key % 4 == 0, F.format_string('{"Actual Hours":%d.25}', key))
        .when(key % 4 == 1, F.lit('{"Actual Hours":null}'))
        .when(key % 4 == 2, F.format_string('{"Actual Hours":"%d"}', key))
        .otherwise(F.lit('{"Month":"none"}'))
    )
    return table(spark, sf_dir, "events").select(
        _text("ev", key).alias("id"), key.alias("pos"), F.parse_json(text).alias("fields")
    )


def earlier_cells(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(payroll cells of an earlier delivery, those changed since, ids gone since) of today's ``cells``.

    By a hash of the id a third of the records is new, a third had other hours, and every fifth had a later double that is gone.
    """
    part = F.crc32("id") % 3
    was = F.struct(F.lit("number").alias("actual_kind"), F.lit(1.5).cast("double").alias("actual"))
    altered = cells.where(part == 1).withColumns({"actual_kind": was.actual_kind, "actual": was.actual})
    doubles = cells.where(F.crc32("id") % 5 == 0).withColumns({"id": F.concat("id", F.lit("x")), "pos": F.concat("pos", F.lit("x"))})
    earlier = cells.where(part == 2).unionByName(altered).unionByName(doubles)
    return earlier, cells.where(part < 2), doubles.select("id")
