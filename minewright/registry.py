"""Registered queries: a key, a function over the tables and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


TEXT_TABLES = ("documents", "pages")


class Tables:
    """Lazy access to the parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._spread(df) if name in TEXT_TABLES else df

    def _spread(self, df: DataFrame) -> DataFrame:
        """Text is cheap to store and dear to split: a table of fewer files than cores is dealt out first."""
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class Plan:
    key: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


PLANS: dict[str, Plan] = {}


def plan(key: str, oracle: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if key in PLANS:
            raise ValueError(f"duplicate query key {key}")
        PLANS[key] = Plan(key, build, oracle)
        return build

    return register


def load_all() -> dict[str, Plan]:
    from minewright import plans

    plans.load()
    return PLANS
