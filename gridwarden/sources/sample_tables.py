"""Adapters: the provided sample tables as telemetry, visits, meter reads, master and reviews.

Each keeps every row of its source table. Defects and duplicates are added by rule, so that the
cleaning operators have something to do.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.weeks import mondays

# The Mondays with data before them in the sample events.
SAMPLE_WEEKS = tuple(mondays(date(2024, 1, 8), 4))
UNEVEN_WEEKS = tuple(date(2024, 1, 5) + timedelta(days=i + i * i // 9) for i in range(20))
# Texts that no date can be read from, among them some that begin like one.
BAD_TIMES = ("bad", "12:30", "T10:00", "2024-01", "2024-01-05 junk")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hex_id(c: Column) -> Column:
    return F.lpad(F.hex(c), 12, "0")


def day(c: Column) -> Column:
    return c.cast("date").cast("string")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as clean telemetry; ``event_id`` is the row order."""
    events = table(spark, sf_dir, "events")
    return events.select(
        hex_id(F.col("user_id")).alias("gateway_id"),
        F.col("ts").alias("ts_utc"),
        F.col("value").alias("offline_duration_sec"),
        (F.col("event_type") == "error").cast("int").alias("disconnection_cnt"),
        (F.col("event_type") == "signup").cast("int").alias("reboot_cnt"),
        F.get_json_object("props", "$.k").cast("int").alias("reboot_duration_sec"),
        "event_id",
    )


def repeated_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean telemetry in which some readings come twice, the second time with another value;
    ``sent`` is the row order."""
    raw = telemetry(spark, sf_dir)
    copies = F.explode(F.sequence(F.lit(0), (F.col("event_id") % 5 == 0).cast("int")))
    again = raw.withColumn("copy", copies)
    return again.withColumns(
        {
            "offline_duration_sec": F.col("offline_duration_sec") + F.col("copy") * 5000,
            "sent": F.col("event_id") * 2 + F.col("copy"),
        }
    ).drop("copy", "event_id")


def dirty_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as text, with colon ids, bad times, bad and negative numbers, and some readings
    sent twice with another value. ``event_id, copy`` is the row order."""
    events = table(spark, sf_dir, "events")
    e = F.col("event_id")
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(0), (e % 50 == 0).cast("int"))))
    bare = hex_id(F.col("user_id"))
    pairs = F.concat_ws(":", *[F.substring(F.lower(bare), i, 2) for i in range(1, 12, 2)])
    reading = F.round(F.col("value") * 100).cast("bigint") + F.col("copy") * 7
    return copies.select(
        F.when(e % 3 == 0, F.concat(F.lit(" "), pairs, F.lit("\t"))).otherwise(bare).alias("gateway_id"),
        F.when(e % 97 == 0, F.get(F.array(*map(F.lit, BAD_TIMES)), F.floor(e / 97) % len(BAD_TIMES)))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("ts_utc"),
        F.when(e % 11 == 0, F.lit("abc"))
        .when(e % 13 == 0, F.concat(F.lit("-"), reading.cast("string")))
        .otherwise(F.concat(F.lit(" "), reading.cast("string")))
        .alias("offline_duration_sec"),
        F.when(e % 17 == 0, F.lit("5d"))
        .otherwise((F.col("event_type") == "error").cast("int").cast("string"))
        .alias("disconnection_cnt"),
        F.when(F.col("event_type") == "signup", F.lit("1")).when(e % 7 == 0, F.lit("-1")).alias("reboot_cnt"),
        F.concat(F.lit("part-"), F.col("user_id") % 4).alias("source_file"),
        e.alias("event_id"),
        "copy",
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as field visits, dates and hours as text; the lines of some orders come twice."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    again = F.explode(F.sequence(F.lit(0), (F.col("l_orderkey") % 20 == 0).cast("int")))
    joined = joined.withColumn("copy", again)
    line = F.col("l_linenumber")
    ordered = day(F.col("o_orderdate"))
    bad = [F.lit("soon"), F.substring(ordered, 1, 7), F.concat(ordered, F.lit(" junk")), F.lit("12:30")]
    hours = F.col("l_quantity").cast("int").cast("string")
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string")).alias("visit_id"),
        hex_id(F.col("l_suppkey")).alias("gateway_id"),
        F.when(line == 5, F.get(F.array(*bad), F.col("l_orderkey") % 4)).otherwise(ordered).alias("requested_on"),
        day(F.col("l_shipdate")).alias("visited_on"),
        F.col("o_orderpriority").alias("reason_reported"),
        F.when(F.col("l_returnflag") == "R", F.lit(" Fehler  behöben "))
        .when(F.col("l_returnflag") == "A", F.lit("Kein Fehler gefunden"))
        .when(line == 1, F.lit("FIXED"))
        .otherwise(F.lit("sonstiges"))
        .alias("outcome"),
        F.when(line == 6, F.concat(F.lit("-"), hours)).when(line != 7, hours).alias("technician_hours"),
        F.when((F.col("l_linestatus") == "F") & (line == 2), F.lit(" N  A "))
        .when(F.col("l_linestatus") == "F", F.lit("Netzteil"))
        .alias("parts_replaced"),
    )


def meter_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        day(F.col("l_shipdate")).alias("week_start"),
        hex_id(F.col("l_suppkey")).alias("gateway_id"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("meters_expected"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("meters_read"),
    )


def gateway_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as gateways; some appear twice, ``copy`` is the row order. Some have ids that no
    other table knows, and nothing is known of retirements."""
    suppliers, nations = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    joined = suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"])
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("s_suppkey") % 10 == 0).cast("int"))))
    key = F.col("s_suppkey")
    return copies.select(
        hex_id(F.when(key % 11 == 5, key + 2_000_000).otherwise(key)).alias("gateway_id"),
        F.concat("s_name", F.when(F.col("copy") == 1, F.lit(" (moved)")).otherwise(F.lit(""))).alias("name"),
        F.col("s_acctbal").alias("balance"),
        F.col("n_name").alias("nation"),
        F.lit(None).cast("string").alias("retired"),
        "copy",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per supplier and a second, opposite one for some; ``copy`` is the row order."""
    key = F.col("s_suppkey")
    poor = (F.col("s_nationkey") % 3 == 0) != (F.col("copy") == 1)
    suppliers = table(spark, sf_dir, "supplier")
    copies = suppliers.withColumn("copy", F.explode(F.sequence(F.lit(0), (key % 10 == 0).cast("int"))))
    return copies.select(
        F.when(key % 3 == 0, F.lower(hex_id(key))).otherwise(hex_id(key)).alias("gateway_id"),
        F.when(key % 13 == 12, F.lit(None)).when(poor, F.lit(" Schlecht ")).otherwise(F.lit("gut")).alias("Kategorie"),
        F.when(key % 7 == 6, F.lit("n/a")).when(key % 7 == 5, F.lit("2026-2")).otherwise(F.lit("2026-02-15")).alias("reviewed_on"),
        "copy",
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as remarks with commas, quotes and line breaks."""
    line = F.col("l_linenumber")
    said = F.concat(F.lit("said \""), F.col("l_returnflag"), F.lit("\","), F.lit("\n\n"), F.col("l_linestatus"), F.lit(" \"\"\r\nend"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string"), F.col("l_partkey").cast("string")).alias("note_id"),
        hex_id(F.col("l_suppkey")).alias("gateway_id"),
        F.when(line == 1, said).when(line == 2, F.lit("a \"b\" c")).when(line == 3, F.lit("x,\ny")).when(line < 6, F.lit("plain")).alias("note"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
    )


def foreign_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as visits whose days are written month first, some of them otherwise;
    ``l_orderkey, line`` is the row order."""
    line, day_of = F.col("l_linenumber"), F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        hex_id(F.col("l_suppkey")).alias("gateway_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string"), F.col("l_partkey").cast("string")).alias("visit_id"),
        F.when(line == 5, F.date_format(day_of, "yyyy-MM-dd"))
        .when(line == 6, F.date_format(day_of, "dd/MM/yyyy"))
        .when(line == 7, F.lit("soon"))
        .otherwise(F.date_format(day_of, "MM/dd/yyyy"))
        .alias("visited_on"),
        F.concat(F.date_format(day_of, "d MMM yyyy"), F.lit(" 23:15")).alias("requested_on"),
        "l_orderkey",
        line.alias("line"),
    )
