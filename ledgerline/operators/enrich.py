"""Left joins that add customer details and the mapped transaction date.

Both are plain equi-joins declared to Catalyst.  Which physical join runs is
left to the planner and AQE: a side is broadcast only when its measured size
(file statistics, or the actual shuffle output under AQE) is below
``spark.sql.autoBroadcastJoinThreshold``; otherwise a sort-merge join runs, and
AQE's skew handling splits a hot account's partition on the ledger side.
Null keys never match; duplicate right-side keys multiply rows, as in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_mappings(spark) -> DataFrame:
    """A typed, empty mapping table (the mapping input is optional)."""
    schema = T.StructType(
        [
            T.StructField("account_number", T.StringType(), True),
            T.StructField("txn_date", T.DateType(), True),
            T.StructField("transaction_number", T.StringType(), True),
        ]
    )
    return spark.createDataFrame([], schema)


def add_customer(rows: DataFrame, customers: DataFrame, *also: str) -> DataFrame:
    """rows LEFT JOIN customers USING (account_number and the columns ``also``): customer_name, customer_amount."""
    keys = {"account_number": "_c_account", **{c: f"_c_{c}" for c in also}}
    right = customers.select(*(F.col(c).alias(as_) for c, as_ in keys.items()), "customer_name", "customer_amount")
    cond = [F.col(c) == F.col(as_) for c, as_ in keys.items()]
    return rows.join(right, cond, "left").drop(*keys.values())


def add_mapped_date(rows: DataFrame, mappings: DataFrame | None, number_col: str = "ledger_txn_no") -> DataFrame:
    """rows LEFT JOIN mappings ON account and ``number_col`` = transaction_number: txn_date."""
    if mappings is None:
        return rows.withColumn("txn_date", F.lit(None).cast(T.DateType()))
    right = mappings.select(
        F.col("account_number").alias("_m_account"),
        F.col("transaction_number").alias("_m_number"),
        "txn_date",
    )
    cond = (F.col("account_number") == F.col("_m_account")) & (F.col(number_col) == F.col("_m_number"))
    return rows.join(right, cond, "left").drop("_m_account", "_m_number")


def effective_date(rows: DataFrame) -> DataFrame:
    """``final_date``: the mapped date if present, else the ledger date."""
    return rows.withColumn("final_date", F.coalesce(F.col("txn_date"), F.col("date")))
