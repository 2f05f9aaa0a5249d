"""The history model's settings, and the folder layout of a lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .constants import HISTORY_SEED
from .sources.tables import current


@dataclass(frozen=True)
class Settings:
    """The model that reconstructs history; jobs fill it from their options."""

    history_months: int = 6
    reconstruct: bool = True
    seed: int = HISTORY_SEED

    @property
    def history_days(self) -> int:
        return self.history_months * 30


@dataclass(frozen=True)
class Lake:
    """A raw zone and three table layers below one root folder."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.parquet(current(spark, self.path(layer, table)))

    def find(self, spark: SparkSession, layer: str, table: str) -> DataFrame | None:
        """The table, or None when nothing has been written there yet."""
        try:
            return self.read(spark, layer, table)
        except AnalysisException as err:
            if err.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
                return None
            raise
