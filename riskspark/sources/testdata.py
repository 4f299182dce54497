"""The transaction table derived from the event and customer tables of a data folder.

The folder holds no transaction table, so one is derived: events are the
transactions, customers and their nations give the categories.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.velocity import velocity_features
from riskspark.sources.scratch import scratch_path

_derived: dict[tuple[str, str], tuple[str, object]] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The 18 contract columns plus ``k`` (raw signal) and two SQL-reproducible scores."""
    events = table(spark, folder, "events")
    customer = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, folder, "region")
    day_zero = F.lit("2022-01-01").cast("date")
    # Rows move for the look-back columns with what the others are made of, which is less than those are.
    facts = (
        events.join(customer, events.user_id == customer.c_custkey, "left")
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(
            "event_id", "user_id", F.col("ts").alias("occurred_at"), "event_type", F.col("value").alias("amount"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            "c_acctbal", "c_mktsegment", "n_nationkey", "n_regionkey", "r_name",
        )
    )
    return (
        velocity_features(facts, customer="user_id")
        .withColumn("hour", F.hour("occurred_at"))
        .select(
            F.concat(F.lit("txn_"), F.col("event_id").cast("string")).alias("external_id"),
            F.concat(F.lit("customer_"), F.col("user_id").cast("string")).alias("customer_id"),
            "amount",
            F.when(F.col("r_name") == "AMERICA", "USD")
            .when(F.col("r_name") == "EUROPE", "EUR")
            .otherwise("BRL")
            .alias("currency"),
            F.col("c_mktsegment").alias("merchant_category"),
            F.concat(F.char(F.lit(65) + F.col("n_nationkey")), F.char(F.lit(65) + F.col("n_regionkey"))).alias("country"),
            F.concat(F.lit("device_"), (F.col("user_id") * 3 + F.col("event_id") % 3).cast("string")).alias("device_id"),
            "occurred_at",
            F.when(F.col("user_id") % 3 == 0, "purchase")
            .when(F.col("user_id") % 3 == 1, "transfer")
            .otherwise("withdrawal")
            .alias("transaction_type"),
            F.col("event_type").alias("channel"),
            (F.col("r_name") != "AMERICA").alias("is_international"),
            (F.datediff(F.col("occurred_at").cast("date"), day_zero) + F.col("user_id") % 365).cast("int").alias("account_age_days"),
            (F.col("event_id") % 700 + 1).cast("int").alias("device_age_days"),
            (F.abs("c_acctbal") / 100).alias("distance_from_home_km"),
            "hour",
            (F.col("k") >= 90).cast("int").alias("is_fraud"),
            "k",
            (F.floor(F.col("k") * 0.5 + F.col("hour") * 2).cast("double") / 100).alias("p"),
            (F.floor(F.col("k") * 0.3 + F.col("amount") % 50).cast("double") / 100).alias("p2"),
            "transactions_last_24h",
            "avg_amount_last_30d",
        )
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The derived table, written on first use in an application and read after that."""
    key = (spark.conf.get("spark.app.id", "local"), folder)
    if key in _derived:
        path, schema = _derived[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:
            # The scratch folder was emptied: derive the table again.
            del _derived[key]
    derived = derive_transactions(spark, folder)
    path = scratch_path(spark, "transactions")
    derived.write.parquet(path)
    _derived[key] = (path, derived.schema)
    return spark.read.schema(derived.schema).parquet(path)
