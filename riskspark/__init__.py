"""Transaction-risk analytics on Spark DataFrames."""

from riskspark.contract import DEFAULT_CONTRACT, TRANSACTION_SCHEMA, Contract, ContractError

__version__ = "0.1.0"
__all__ = ["DEFAULT_CONTRACT", "TRANSACTION_SCHEMA", "Contract", "ContractError"]
