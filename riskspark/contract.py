"""Column roles and domains of a transaction table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns, roles and domains of the transaction table.
ID_COLUMN = "external_id"
TIME_COLUMN = "occurred_at"
TARGET_COLUMN = "is_fraud"
ENTITY_COLUMNS = ("customer_id", "device_id")
NUMERIC_FEATURES = (
    "amount",
    "account_age_days",
    "transactions_last_24h",
    "avg_amount_last_30d",
    "device_age_days",
    "distance_from_home_km",
    "hour",
)
CATEGORICAL_FEATURES = (
    "currency",
    "merchant_category",
    "country",
    "transaction_type",
    "channel",
    "is_international",
)
CURRENCIES = ("BRL", "EUR", "USD")
LEAKAGE_COLUMNS = (
    "fraud_probability",
    "fraud_reason",
    "label_source",
    "risk_score",
    "rule_triggered",
)

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("external_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("occurred_at", T.TimestampType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("is_international", T.BooleanType()),
        T.StructField("account_age_days", T.IntegerType()),
        T.StructField("transactions_last_24h", T.IntegerType()),
        T.StructField("avg_amount_last_30d", T.DoubleType()),
        T.StructField("device_age_days", T.IntegerType()),
        T.StructField("distance_from_home_km", T.DoubleType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)


class ContractError(ValueError):
    """The data, a parameter or a model does not meet its contract."""


@dataclass(frozen=True)
class Contract:
    """Which column plays which role; the default is the 18-column table."""

    id: str = ID_COLUMN
    time: str = TIME_COLUMN
    target: str = TARGET_COLUMN
    entities: tuple[str, ...] = ENTITY_COLUMNS
    numeric: tuple[str, ...] = NUMERIC_FEATURES
    categorical: tuple[str, ...] = CATEGORICAL_FEATURES
    amount: str = "amount"
    currency: str = "currency"
    country: str = "country"
    hour: str = "hour"
    currencies: tuple[str, ...] = CURRENCIES
    leakage: tuple[str, ...] = LEAKAGE_COLUMNS

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical)

    @property
    def excluded(self) -> tuple[str, ...]:
        return (self.id, *self.entities, self.time, self.target)

    @property
    def required(self) -> tuple[str, ...]:
        return (*self.excluded, *self.features)

    @property
    def non_negative(self) -> tuple[str, ...]:
        """Numeric features that may be zero but not negative."""
        return tuple(c for c in self.numeric if c not in (self.amount, self.hour))


DEFAULT_CONTRACT = Contract()


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN read as NULL, so that a missing value is one concept."""
    column = F.col(name)
    if is_floating(df, name):
        return F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    return column


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every floating column with NaN read as NULL."""
    floating = [f.name for f in df.schema.fields if is_floating(df, f.name)]
    return df.withColumns({c: present(df, c) for c in floating}) if floating else df
