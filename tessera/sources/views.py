"""Test views over the driver tables (FIXTURES.md part C), as DataFrames.

The sales table of the reference is played by ``trades``; stations by
``pois``; the district landmark table by ``landmarks``.  Nulls are injected by
fixed formulas so that the oracle SQL (``tessera.plans.sqltext``) builds the
very same rows.  Dimension tables ``nation`` (25 rows) and ``region`` (5 rows)
have a fixed size and are broadcast; ``orders`` x ``customer`` is a shuffle
join on the customer key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table


def _lon(key: Column) -> Column:
    return F.lit(126.5) + (key * 7919 % 10007) / F.lit(10007.0)


def _lat(key: Column) -> Column:
    return F.lit(37.0) + (key * 104729 % 10009) / F.lit(10009.0)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")))
    ok, ck, nk = F.col("o_orderkey"), F.col("c_custkey"), F.col("n_nationkey")
    no_coord = ck % 17 == 0
    return j.select(
        ok.alias("row_id"),
        F.concat(F.replace(F.col("r_name"), F.lit(" "), F.lit("_")), F.lit(" "), F.col("n_name"),
                 F.lit(" "), F.col("c_mktsegment")).alias("addr"),
        F.col("n_name").alias("district"),
        F.col("c_mktsegment").alias("hood"),
        F.col("c_name").alias("complex"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("contract_ym"),
        F.dayofmonth("o_orderdate").cast("bigint").alias("contract_day"),
        F.when(ck % 23 == 0, F.lit(None).cast("bigint"))
         .otherwise((F.lit(1980) + ck % 45).cast("bigint")).alias("built_year"),
        F.when((ok % 7 == 0) | (ck % 9 == 0) | (nk % 8 == 3), F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / F.lit(4321.0)).alias("area"),
        F.when(ok % 11 == 0, F.lit(None).cast("string"))
         .when(ok % 30 == 9, F.lit("NEW_A"))
         .when(ok % 30 == 19, F.lit("NEW_B"))
         .otherwise(F.col("o_orderpriority")).alias("heating"),
        F.when(ok % 13 == 0, F.lit(" ")).when(ok % 13 == 1, F.lit("-"))
         .otherwise(F.col("o_orderstatus")).alias("deal_type"),
        F.when(ok % 20 == 0, F.lit(1.0)).alias("mostly_null"),
        F.col("c_acctbal").alias("bal"),
        F.when(no_coord, F.lit(None).cast("double"))
         .when(ck % 97 == 0, F.lit(128.5)).otherwise(_lon(ck)).alias("lon"),
        F.when(no_coord, F.lit(None).cast("double")).otherwise(_lat(ck)).alias("lat"),
        F.col("o_totalprice").alias("target"),
        F.when(ok % 10 == 9, 1).otherwise(0).cast("int").alias("is_test"),
    )


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    k = F.col("s_suppkey") + 13
    return s.select(F.col("s_suppkey").alias("poi_id"), _lon(k).alias("lon"), _lat(k).alias("lat"))


def landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.where(F.col("n_nationkey") != 24).select(
        F.col("n_name").alias("district"),
        (F.lit(126.6) + F.col("n_nationkey") / F.lit(40.0)).alias("lead_lon"),
        (F.lit(37.2) + (F.col("n_nationkey") * 7 % 25) / F.lit(40.0)).alias("lead_lat"))


def address_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    ck = F.col("c_custkey")
    miss = ck % 5 == 0
    return c.select(
        F.col("c_name").alias("complex"),
        F.when(miss, F.lit(None).cast("double")).otherwise(_lon(ck)).alias("lon"),
        F.when(miss, F.lit(None).cast("double")).otherwise(_lat(ck)).alias("lat"))


def side_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return o.select(F.col("o_orderkey").alias("row_id"),
                    F.year("o_orderdate").cast("bigint").alias("f_year"),
                    F.lit(0.0).alias("bal"))


def cluster_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in loose clumps, one per customer (the whole table)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return c.select(
        F.col("c_custkey").alias("point_id"),
        ((F.col("c_nationkey") % 5) * F.lit(2.0) + F.col("c_acctbal") / F.lit(10000.0)).alias("x"),
        ((F.col("c_nationkey") % 3) * F.lit(2.0)
         + (F.col("c_custkey") * 7919 % 10007) / F.lit(10007.0)).alias("y"))


def bus_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, denser POI table (one stop per part) for the transport step."""
    p = table(spark, sf_dir, "part").select("p_partkey")
    k = F.col("p_partkey")
    return p.select(k.alias("poi_id"),
                    (F.lit(126.5) + (k * 31 % 10007) / F.lit(10007.0)).alias("lon"),
                    (F.lit(37.0) + (k * 61 % 10009) / F.lit(10009.0)).alias("lat"))
