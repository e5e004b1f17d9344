"""Seed rows of the dimensions as DataFrames (7 hubs, 7 routes, 5 clients)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from parceltide import constants as K, schemas


def _local(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """Arrow tables become local relations: Spark knows their size and broadcasts them by itself."""
    table = pa.Table.from_pylist([dict(zip(schema.names, row)) for row in rows],
                                 schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def hubs(spark: SparkSession) -> DataFrame:
    return _local(spark, K.HUB_SEED, schemas.HUBS)


def routes(spark: SparkSession) -> DataFrame:
    return _local(spark, K.ROUTE_SEED, schemas.ROUTES)


def clients(spark: SparkSession) -> DataFrame:
    return _local(spark, K.CLIENT_SEED, schemas.CLIENTS)
