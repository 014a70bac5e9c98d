"""Database source (S6). Only the options are built here; the reader is the
standard JDBC source, partitioned on a numeric column for parallel reads."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

ENV_KEYS = {"database": "DB_NAME", "host": "DB_HOST", "user": "DB_USER", "password": "DB_PSWD"}


def _strip_comma(value: str) -> str:
    # The reference strips one trailing comma from each setting.
    return re.sub(r",$", "", value)


def jdbc_options(env: Mapping[str, str] | None = None, port: int = 3306, driver: str = "com.mysql.cj.jdbc.Driver") -> dict[str, str]:
    """JDBC options from the four connection settings."""
    env = os.environ if env is None else env
    vals = {k: _strip_comma(env.get(v, "")) for k, v in ENV_KEYS.items()}
    return {
        "url": f"jdbc:mysql://{vals['host']}:{port}/{vals['database']}",
        "user": vals["user"],
        "password": vals["password"],
        "driver": driver,
    }


def read_jdbc(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A table over JDBC; with ``partition_column`` the read is split into
    ``num_partitions`` range queries instead of one connection."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return reader.load()
