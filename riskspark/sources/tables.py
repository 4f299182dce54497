"""Reading and writing transaction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.contract import DEFAULT_CONTRACT, TRANSACTION_SCHEMA, Contract
from riskspark.operators.validate import require_contract
from riskspark.sources.scratch import stored

# Text form of a time, to the microsecond.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
STORED_COLUMNS = (
    "external_id", "amount", "currency", "merchant_category", "country", "device_id", "occurred_at",
)


def read_transactions(
    spark: SparkSession, path: str, *, format: str = "parquet", schema: T.StructType = TRANSACTION_SCHEMA,
    stream: bool = False, **options,
) -> DataFrame:
    """Read Parquet, CSV or JSON files with the declared schema, as a batch or a stream."""
    reader = spark.readStream if stream else spark.read
    if format == "csv":
        options = {"header": True, **options}
    return reader.schema(schema).options(**options).format(format).load(path)


def write_transactions(
    df: DataFrame, path: str, *, format: str = "csv", overwrite: bool = False,
    contract: Contract = DEFAULT_CONTRACT,
) -> str:
    """Check the contract, then write; an existing table is an error unless asked."""
    require_contract(df, contract)
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").format(format)
    if format == "csv":
        writer = writer.options(header=True, encoding="UTF-8", **CSV_TIMES)
    writer.save(path)
    return path


def store_projection(df: DataFrame) -> DataFrame:
    """The operational columns of a stored transaction: no label, decimal amount."""
    texts = {"external_id", "currency", "merchant_category", "country", "device_id"}
    columns = []
    for name in STORED_COLUMNS:
        column = F.col(name)
        if name == "amount":
            column = column.cast("decimal(18,2)")
        elif name in texts:
            column = column.cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


# Longest text each stored column takes.
STORED_LENGTHS = {
    "external_id": 64, "currency": 3, "merchant_category": 100, "country": 2, "device_id": 128,
}
STORED_REQUIRED = tuple(c for c in STORED_COLUMNS if c != "device_id")


def admit(batch: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Split a batch into rows the store accepts and rows it refuses with a ``reason``.

    Refused are rows that lack a required value or exceed a length, ids that
    are stored already, and copies of an id inside the batch beyond the first
    in the order (occurred_at, other columns). Equal copies are one refused row
    with their number in ``copies``, so a batch full of copies stays small.
    """
    missing = [F.col(c).isNull() for c in STORED_REQUIRED]
    too_long = [F.length(c) > n for c, n in STORED_LENGTHS.items()]
    bad = F.lit(False)
    for rule in (*missing, *too_long):
        bad = bad | F.coalesce(rule, F.lit(False))

    counted = (
        store_projection(batch)
        .groupBy(*STORED_COLUMNS)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("reason", F.when(bad, "invalid_value"))
    )
    known = F.lit(None).cast("string")
    if existing is not None:
        # Only the batch's ids are looked for; the rest of the store is not shuffled into distinct ids.
        asked = batch.select("external_id").distinct()
        ids = existing.select("external_id").join(asked, "external_id", "left_semi").distinct()
        ids = ids.withColumn("_known", F.lit("already_stored"))
        counted = counted.join(ids, "external_id", "left")
        known = F.col("_known")
    order = ("occurred_at", *[c for c in STORED_COLUMNS if c not in ("external_id", "occurred_at")])
    judged = stored(
        counted.withColumn("reason", F.coalesce("reason", known))
        .withColumn("_order", F.struct(*order))
        .select(*STORED_COLUMNS, "copies", "reason", "_order"),
        "admission",
    )
    # The first row per id is an aggregate, so an id with many rows needs no sort.
    firsts = (
        judged.filter("reason is null")
        .groupBy("external_id")
        .agg(F.min("_order").alias("_first"))
    )
    decided = judged.join(firsts, "external_id", "left").withColumn(
        "_is_first", F.col("reason").isNull() & F.col("_order").eqNullSafe(F.col("_first"))
    )
    accepted = decided.filter("_is_first").select(*STORED_COLUMNS)
    refused = (
        decided.withColumn("copies", F.col("copies") - F.col("_is_first").cast("long"))
        .filter("copies > 0")
        .select(*STORED_COLUMNS, "copies", F.coalesce("reason", F.lit("duplicate_id")).alias("reason"))
    )
    return accepted, refused


def write_report(sections: DataFrame, path: str, *, overwrite: bool = False) -> str:
    """Write report rows as JSON lines."""
    sections.write.mode("overwrite" if overwrite else "errorifexists").json(path)
    return path
