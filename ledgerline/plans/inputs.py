"""Prepared inputs for a test-data folder: the three reference inputs, typed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerline.config import DEFAULT_SPAN
from ledgerline.operators.prepare import prepare_customers, prepare_ledger, prepare_mappings
from ledgerline.sources import fixtures


@dataclass
class Inputs:
    customers: DataFrame
    ledger: DataFrame
    mappings: DataFrame


def fixture_inputs(
    spark: SparkSession, sf_dir: str, with_duplicates: bool = True, span: int = DEFAULT_SPAN
) -> Inputs:
    return Inputs(
        customers=prepare_customers(fixtures.fixture_customers(spark, sf_dir, with_duplicates)),
        ledger=prepare_ledger(fixtures.fixture_ledger(spark, sf_dir, span)),
        mappings=prepare_mappings(fixtures.fixture_mappings(spark, sf_dir)),
    )


def stored_inputs(spark: SparkSession, paths: dict[str, str]) -> Inputs:
    """Prepared inputs read from stored Parquet tables (see ``fixtures.materialize``)."""
    return Inputs(
        customers=prepare_customers(spark.read.parquet(paths["customers"])),
        ledger=prepare_ledger(spark.read.parquet(paths["ledger"])),
        mappings=prepare_mappings(spark.read.parquet(paths["mappings"])),
    )
