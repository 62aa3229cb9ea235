"""A store of monthly products that grows by months.

A store has one provenance: what its months were made of and how. A run with another one is refused. Months lie in
partitions; new ones are composed from observations after the last one that is stored, which is a filter that the scan
takes, and rewriting some months replaces their partitions and no others.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_start
from ..operators import composite
from .runs import canonical, digest


class ProvenanceError(ValueError):
    """The store's months were made of something else, or in another way."""


class MonthlyStore:
    """Monthly products below a path that Spark writes; provenance: any JSON value, such as the source's name, the mode and the configuration's hash."""

    def __init__(self, spark: SparkSession, path: str, provenance: object, mode: str = "mode"):
        self.spark, self.path, self.mode = spark, path.rstrip("/"), mode
        self.key = digest({"provenance": provenance, "mode": mode})
        try:
            found = spark.read.text(f"{self.path}/provenance", wholetext=True).first()["value"]
        except AnalysisException:
            found = None
        if found is None:
            spark.createDataFrame([(canonical({"key": self.key, "provenance": provenance, "mode": mode}),)], "value string").coalesce(1).write.text(f"{self.path}/provenance")
        elif f'"key":"{self.key}"' not in found:
            raise ProvenanceError(f"the store at {self.path} has another provenance")

    def read(self) -> DataFrame | None:
        """aoi_id, month, y, x, water, valid, valid_count, water_count of all months, pruned by month; none for a store without months."""
        try:
            return self.spark.read.parquet(f"{self.path}/months").select("aoi_id", F.col("month").cast("date").alias("month"), "y", "x", "water", "valid", "valid_count", "water_count")
        except AnalysisException:
            return None

    def last(self) -> date | None:
        """The last stored month, by the names of the partitions."""
        kept = self.read()
        return None if kept is None else kept.agg(F.max("month")).first()[0]

    def _write(self, cells: DataFrame) -> None:
        rows = composite.monthly(cells, self.mode)
        rows.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{self.path}/months")

    def fresh(self, cells: DataFrame) -> DataFrame:
        """Observations of months after the last stored one."""
        last = self.last()
        return cells if last is None else cells.where(F.col("ts") >= F.add_months(F.lit(last), 1).cast("timestamp"))

    def append(self, cells: DataFrame) -> DataFrame | None:
        """Adds the months after the last one, and gives all."""
        self._write(self.fresh(cells))
        return self.read()

    def refresh(self, cells: DataFrame, months: list[date]) -> DataFrame | None:
        """Makes these months again, from all of their observations, and leaves the others as they are."""
        of = month_start("ts").isin(*months)
        first, last = F.lit(min(months)).cast("timestamp"), F.add_months(F.lit(max(months)), 1).cast("timestamp")
        self._write(cells.where((F.col("ts") >= first) & (F.col("ts") < last) & of))
        return self.read()
