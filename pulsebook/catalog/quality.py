"""Constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsebook.catalog import query
from pulsebook.operators import quality as q
from pulsebook.plans import adapters as a


@query("d1_duplicate_keys", "", """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""")
def d1(spark, d):
    return q.check_unique(a.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("d2_nulls", "temp_gaps", "SELECT * FROM temp_gaps WHERE temperature IS NULL")
def d2(spark, d):
    return q.check_not_null(a.temp_gaps(spark, d), ["location", "temperature"])


@query("d2_null_counts", "dehydrator", """SELECT count(*) FILTER (c__low IS NULL) AS c__low,
    count(*) FILTER (ip IS NULL) AS ip FROM dehydrator""")
def d2_counts(spark, d):
    return q.null_counts(a.dehydrator(spark, d), ["c__low", "ip"])


@query("d3_range", "", """SELECT * FROM customer WHERE NOT coalesce(c_acctbal >= 0 AND c_nationkey < 20, true)""")
def d3(spark, d):
    return q.check_range(a.table(spark, d, "customer"), F.col("c_acctbal") >= 0, F.col("c_nationkey") < 20)


@query("d4_orphans", "", "SELECT * FROM orders ANTI JOIN events ON o_custkey = user_id")
def d4(spark, d):
    return q.check_fk(a.table(spark, d, "orders"), a.table(spark, d, "events"), "o_custkey", "user_id")


@query("d5_defaults", "temp_gaps", "SELECT location, time, event_id, coalesce(temperature, 0) AS temperature FROM temp_gaps")
def d5(spark, d):
    return q.with_defaults(a.temp_gaps(spark, d), {"temperature": 0})


@query("d6_thresholds", "", """SELECT p_partkey, p_size AS blue, CAST(floor(p_retailprice / 50) AS INTEGER) AS yellow,
    CAST(p_partkey % 40 AS INTEGER) AS red FROM part
    WHERE NOT (p_size < floor(p_retailprice / 50) AND floor(p_retailprice / 50) < p_partkey % 40)""")
def d6(spark, d):
    sites = a.table(spark, d, "part").select(
        "p_partkey", F.col("p_size").alias("blue"), F.floor(F.col("p_retailprice") / 50).cast("int").alias("yellow"),
        (F.col("p_partkey") % 40).cast("int").alias("red"),
    )
    return q.check_thresholds(sites)
