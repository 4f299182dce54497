"""Contract rules over a table, row rules for scoring requests, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.contract import DEFAULT_CONTRACT, Contract, ContractError, is_floating, present
from riskspark.functions import is_infinite, stripped, texts_that_apply, to_rows
from riskspark.operators.profile import duplicate_ids, parsed_time

# Rule names in the order in which a failure is reported.
RULES = (
    "not_empty",
    "required_columns",
    "no_leakage_columns",
    "no_missing_values",
    "unique_id",
    "positive_amount",
    "allowed_currency",
    "country_code",
    "valid_timestamp",
    "binary_label",
    "both_classes",
)
COUNTRY_PATTERN = r"\A[A-Z]{2}\z"


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return sorted(set(wanted) - set(df.columns))


def leakage_columns(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> list[str]:
    return sorted(set(contract.leakage) & set(df.columns))


def _bad_label(df: DataFrame, target: str) -> Column:
    kind = df.schema[target].dataType
    if isinstance(kind, T.BooleanType):
        return F.col(target).isNull()
    if isinstance(kind, T.NumericType):
        return ~F.coalesce(F.col(target).isin(0, 1), F.lit(False))
    return F.lit(True)


def value_rules(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> list[Column]:
    """Violations of the rules that one aggregate over the rows can count, named by rule."""
    columns = set(df.columns)
    required = [c for c in contract.required if c in columns]

    def bad(name: str, rule: Column) -> Column:
        return F.coalesce(rule, F.lit(True)) if name in columns else rule

    def count_bad(name: str, rule) -> Column:
        if name not in columns:
            return F.lit(None).cast("long")
        return F.count_if(bad(name, rule()))

    missing = sum((F.count_if(present(df, c).isNull()) for c in required), F.lit(0).cast("long"))
    label = F.col(contract.target).try_cast("int") if contract.target in columns else F.lit(None)
    return [
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("not_empty"),
        missing.alias("no_missing_values"),
        # A missing amount is a missing value, not a non-positive one.
        (
            F.count_if(present(df, contract.amount) <= 0)
            if contract.amount in columns
            else F.lit(None).cast("long")
        ).alias("positive_amount"),
        count_bad(contract.currency, lambda: ~F.col(contract.currency).isin(*contract.currencies)).alias("allowed_currency"),
        count_bad(contract.country, lambda: ~F.col(contract.country).rlike(COUNTRY_PATTERN)).alias("country_code"),
        count_bad(contract.time, lambda: parsed_time(df, contract).isNull()).alias("valid_timestamp"),
        count_bad(contract.target, lambda: _bad_label(df, contract.target)).alias("binary_label"),
        (
            (F.lit(2) - F.max((label == 0).cast("int")) - F.max((label == 1).cast("int"))).cast("long")
            if contract.target in columns
            else F.lit(None).cast("long")
        ).alias("both_classes"),
    ]


def id_copies(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> Column:
    """Surplus rows of repeated ids; NULL without the id column."""
    if contract.id not in df.columns:
        return F.lit(None).cast("long")
    return duplicate_ids(df, [contract.id]).select("duplicates").scalar()


def contract_rules(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Rows ``(rule, ordinal, violations, passed)`` for every rule.

    The value rules are one aggregate over the table; only the id rule needs a
    shuffle, of the id column. A rule whose column is absent has NULL results.
    """
    return rule_rows(df.agg(*value_rules(df, contract)), df, id_copies(df, contract), contract)


def rule_rows(facts: DataFrame, df: DataFrame, duplicates: Column, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """The rows of ``contract_rules`` from the one row of ``value_rules``."""
    schema_facts = {
        "required_columns": F.lit(len(missing_columns(df, contract.required))).cast("long"),
        "no_leakage_columns": F.lit(len(leakage_columns(df, contract))).cast("long"),
        "unique_id": duplicates,
    }
    wide = facts.withColumns(schema_facts)
    return to_rows(
        wide,
        [(F.lit(rule), F.lit(i), F.col(rule), F.col(rule) == 0) for i, rule in enumerate(RULES, 1)],
        ["rule", "ordinal", "violations", "passed"],
    )


def require_contract(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Return ``df``, or raise on the first broken rule in rule order."""
    details = {
        "required_columns": missing_columns(df, contract.required),
        "no_leakage_columns": leakage_columns(df, contract),
    }
    for row in sorted(contract_rules(df, contract).collect(), key=lambda r: r["ordinal"]):
        if row["passed"] is False:
            named = details.get(row["rule"])
            extra = f": {', '.join(named)}" if named else f" ({row['violations']} violations)"
            raise ContractError(f"contract rule {row['rule']} failed{extra}")
    return df


def require_features(df: DataFrame, label: str, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Return ``df``, or raise with the features that it lacks."""
    missing = missing_columns(df, contract.features)
    if missing:
        raise ContractError(f"{label} data is missing required features: {', '.join(missing)}")
    return df


def feature_frame(df: DataFrame, contract: Contract = DEFAULT_CONTRACT, *, keep: Sequence[str] = ()) -> DataFrame:
    """Only the model features (and named extras); id, time and label are left out."""
    return df.select(*keep, *contract.features)


# -- scoring requests ---------------------------------------------------------


def trimmed(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Text features without surrounding white space."""
    texts = [
        c for c in contract.categorical if isinstance(df.schema[c].dataType, T.StringType)
    ]
    return df.withColumns({c: stripped(F.col(c)) for c in texts}) if texts else df


def request_rules(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> dict[str, Column]:
    """Rule code to failing condition, for every feature of a scoring request."""
    rules: dict[str, Column] = {}
    for name in contract.numeric:
        value = F.col(name)
        rules[f"{name}:missing"] = value.isNull()
        if is_floating(df, name):
            rules[f"{name}:not_finite"] = F.isnan(name) | is_infinite(value)
        number = present(df, name)
        if name == contract.amount:
            rules[f"{name}:not_positive"] = number <= 0
        elif name == contract.hour:
            rules[f"{name}:out_of_range"] = ~number.between(0, 23)
        else:
            rules[f"{name}:negative"] = number < 0
    lengths = {contract.currency: 3, contract.country: 2}
    for name in contract.categorical:
        rules[f"{name}:missing"] = F.col(name).isNull()
        if isinstance(df.schema[name].dataType, T.BooleanType):
            continue
        if name in lengths:
            rules[f"{name}:bad_length"] = F.length(name) != lengths[name]
        else:
            rules[f"{name}:blank"] = F.length(name) == 0
    return rules


def with_violations(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Trim the text features and add ``violations``, the codes of the broken rules."""
    clean = trimmed(require_features(df, "Request", contract), contract)
    rules = request_rules(clean, contract)
    return clean.withColumn("violations", texts_that_apply(list(rules.items())))


def split_valid(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with their ``violations``."""
    checked = with_violations(df, contract)
    broken = F.size("violations") > 0
    return checked.filter(~broken).drop("violations"), checked.filter(broken)
