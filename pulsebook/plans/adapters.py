"""The supplied tables seen as telemetry.

``events`` stands for polls, ``customer`` for the device registry. Devices are
numbered, and an address, a location and a station number are made from the number.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebook.operators.timeline import Timeline
from pulsebook.sources.registries import scan

AS_OF = datetime(2024, 1, 31)
EXEMPT = "loc-0"


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, folder, name, SCHEMAS[name])


def address(n: Column) -> Column:
    octets = [F.shiftright(n, 16), F.shiftright(n, 8).bitwiseAND(255), n.bitwiseAND(255)]
    return F.concat_ws(".", F.lit("10"), *[o.cast("string") for o in octets])


def location(n: Column) -> Column:
    return F.concat(F.lit("loc-"), n.cast("string"))


def controller(n: Column) -> Column:
    return F.concat(F.lit("ks"), (n % 4).cast("string"))


def polls_base(spark: SparkSession, folder: str) -> DataFrame:
    return with_base(table(spark, folder, "events"))


def with_base(events: DataFrame) -> DataFrame:
    u = F.col("user_id")
    return events.select(
        "event_id", F.col("ts").alias("time"), u.alias("u"), "event_type",
        F.floor("value").cast("int").alias("t"),
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"),
        address(u).alias("ip"), location(u).alias("location"), controller(u).alias("controller"),
    )


def is_type(name: str) -> Column:
    return F.col("event_type") == name


def ping(spark, folder) -> DataFrame:
    return polls_base(spark, folder).select("ip", "time", "event_id", (~is_type("error")).alias("state"))


def equipment(spark, folder) -> DataFrame:
    c = F.col("c_custkey")
    visio = F.when(c % 7 == 0, F.lit(None)).when(c % 7 == 1, "").otherwise(
        F.concat(F.lit("Sheet."), c.cast("string"))
    )
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, folder, "customer").join(nation, "c_nationkey").select(
        address(c).alias("ip"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description"),
        visio.alias("visio_name"), F.col("n_name").alias("location"),
    )


def temp(spark, folder) -> DataFrame:
    return polls_base(spark, folder).select("location", "time", "event_id", F.col("t").alias("temperature"))


def temp_gaps(spark, folder) -> DataFrame:
    return polls_base(spark, folder).select(
        "location", "time", "event_id", F.when(~is_type("signup"), F.col("t")).alias("temperature")
    )


def thresholds(spark, folder) -> DataFrame:
    c = F.col("c_custkey")
    n = c.cast("int")
    return table(spark, folder, "customer").select(
        n.alias("id"), address(c).alias("ip"), location(c).alias("location"),
        F.when(n % 2 == 0, 22).otherwise(11).alias("type"), (n % 28).alias("gpio"),
        (n % 5 + 5).alias("blue"), (n % 10 + 40).alias("yellow"), (n % 20 + 80).alias("red"),
        (n % 5 - 2).alias("correction"),
    )


def electro(spark, folder) -> DataFrame:
    t, k = F.col("t"), F.col("k")
    return polls_base(spark, folder).select(
        "location", "time", "event_id", (t % 60).alias("temp_sys"), (k % 45).alias("temp_akb"),
        F.when(is_type("error"), 1).when(is_type("signup"), 2).otherwise(0).alias("alarm_mains"),
        (t % 200 + 400).alias("out_volt"), (t % 90).alias("out_ampr"), t.alias("out_watt"),
        (t % 150 + 450).alias("battery1v"), (k + 450).alias("battery2v"),
    )


def power_sites(spark, folder) -> DataFrame:
    c = F.col("c_custkey")
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, folder, "customer").join(nation, "c_nationkey").select(
        address(c).alias("ip"), location(c).alias("location"), F.col("n_name").alias("own")
    )


def dehydrator(spark, folder) -> DataFrame:
    return dehydrator_line(spark, folder).rows()


def dehydrator_line(spark, folder) -> Timeline:
    """Five polls of an address make an hour; a busy one has more hours than a small integer holds."""
    base = Timeline.of(polls_base(spark, folder), "ip", "time", "event_id").running(n=F.lit(1))
    t, k = F.col("t"), F.col("k")

    def small(c: Column) -> Column:
        return c.cast("smallint")

    return base.select(
        (F.floor((F.col("n") - 1) / 5) + 1).alias("c_life"), small(t % 45).alias("c_temp"),
        small(t % 20).alias("c_high"), small(F.when(k % 10 != 0, t)).alias("c__low"), small(k).alias("c_humi"),
        "ip", "time", "event_id", is_type("error").alias("a_summ"), is_type("click").alias("a_exrt"),
        is_type("view").alias("a_high"), is_type("purchase").alias("a__low"), is_type("signup").alias("a_humi"),
        (t % 7 == 0).alias("a_faul"),
    )


WATCHED = ["c_life", "c__low", "c_humi", "a_summ", "a_exrt", "a_high", "a__low", "a_humi", "a_faul"]


def cell_log(spark, folder) -> DataFrame:
    return cell_lines(polls_base(spark, folder))


def cell_lines(base: DataFrame) -> DataFrame:
    word = F.when(is_type("error"), "off").when(is_type("view"), "on").when(is_type("click"), "busy")
    line = F.coalesce(F.concat(F.lit("cell "), F.col("u").cast("string"), F.lit("  "), word), F.lit("link ok"))
    return base.select(
        "controller", F.to_date("time").alias("log_date"), F.col("event_id").alias("line_no"), line.alias("line"),
        "time",
    )


def cell_registry(spark, folder) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        controller(c).alias("controller"), c.cast("int").alias("cell"),
        F.when(c % 9 == 0, "not").otherwise("do").alias("check"),
    )


WATCHED_SITES = 64


def site(n: Column) -> Column:
    """The controller that watches a station; few stations each, so that all are on at some polls."""
    return F.concat(F.lit("ks"), (n % WATCHED_SITES).cast("string"))


def watch_lines(base: DataFrame) -> DataFrame:
    return cell_lines(base.withColumn("controller", site(F.col("u"))))


def watch_log(spark, folder) -> DataFrame:
    return watch_lines(polls_base(spark, folder))


def watch_registry(spark, folder) -> DataFrame:
    """Stations in the order of their nations, which is not the order of their numbers."""
    c = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        site(c).alias("controller"), c.cast("int").alias("cell"), F.when(c % 9 == 0, "not").otherwise("do").alias("check"),
        (F.col("c_nationkey").cast("long") * 1_000_000_000 + c).alias("position"),
    )


def watch_polls(spark, folder) -> DataFrame:
    """A poll ten minutes before every full hour, from a controller's first line to its last."""
    hour = F.timestamp_add("HOUR", F.hour("time"), F.to_date("time").cast("timestamp_ntz"))
    span = watch_log(spark, folder).groupBy("controller").agg(F.min(hour).alias("first"), F.max(hour).alias("last"))
    hours = F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))
    return span.select("controller", F.explode(hours).alias("hour")).select(
        "controller", F.timestamp_add("MINUTE", F.lit(50), "hour").alias("time")
    )


# The commands of the ventilation page, in the order of its dispatch.
VENT_COMMANDS = ["auto_on", "auto_off", "v5_on", "v5_off", "v1_on", "v1_off"]


def vent_events(spark, folder) -> DataFrame:
    return vent_rows(polls_base(spark, folder))


def vent_rows(base: DataFrame) -> DataFrame:
    command = F.get(F.array(*[F.lit(c) for c in VENT_COMMANDS]), F.col("k") % 6)
    return base.select(
        "u", "time", "event_id", F.when(~is_type("signup"), F.col("t") % 50).alias("temp"),
        F.when(is_type("signup"), command).alias("cmd"),
    )
