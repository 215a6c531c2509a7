"""Reference data kept as small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelflog.schemas import PRODUCT_CATALOG, PRODUCT_SEED, RETAILER_SEED


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Product catalog, one JSON array; category and store_id may be missing."""
    return spark.read.schema(PRODUCT_CATALOG).json(path, multiLine=True, mode="FAILFAST")


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False, mode="FAILFAST")


def read_product_seed(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, PRODUCT_SEED)


def read_retailer_seed(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, RETAILER_SEED)
