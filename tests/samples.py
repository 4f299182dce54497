"""Small literal tables for the tests."""

import datetime as dt

from riskspark import TRANSACTION_SCHEMA

REQUEST = {
    "amount": 215.5, "currency": "BRL", "merchant_category": "electronics", "country": "BR",
    "transaction_type": "purchase", "channel": "online", "is_international": False, "account_age_days": 730,
    "transactions_last_24h": 3, "avg_amount_last_30d": 95.2, "device_age_days": 180,
    "distance_from_home_km": 12.4, "hour": 14,
}


def transaction(i, **changes):
    row = {
        **REQUEST,
        "external_id": f"txn_{i:06d}",
        "customer_id": f"customer_{i % 7:05d}",
        "device_id": f"device_{i % 5:05d}",
        "occurred_at": dt.datetime(2025, 1, 1) + dt.timedelta(hours=i),
        "amount": 20.0 + (i * 37) % 200,
        "hour": i % 24,
        "account_age_days": 10 + (i * 13) % 900,
        "device_age_days": 1 + (i * 29) % 400,
        "transactions_last_24h": (i * 5) % 9,
        "avg_amount_last_30d": 40.0 + (i * 11) % 70,
        "distance_from_home_km": float((i * 17) % 130),
        "currency": ("BRL", "USD", "EUR")[i % 3],
        "country": ("BR", "US", "DE")[i % 3],
        "is_international": i % 3 != 0,
        "channel": ("online", "in_store", "atm")[(i // 3) % 3],
        "transaction_type": ("purchase", "transfer")[(i // 2) % 2],
        "merchant_category": ("grocery", "travel", "electronics")[(i // 5) % 3],
    }
    # A label that depends on the features, with some noise.
    row["is_fraud"] = int((row["amount"] > 120) == (i % 4 != 0) and row["device_age_days"] < 250)
    return {**row, **changes}


def transactions(spark, count=300, changes=None):
    changes = changes or {}
    rows = [transaction(i, **changes.get(i, {})) for i in range(count)]
    return spark.createDataFrame([tuple(r[c] for c in TRANSACTION_SCHEMA.fieldNames()) for r in rows], TRANSACTION_SCHEMA)
