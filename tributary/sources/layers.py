"""Raw, staging and mart layers under one root, as partitioned parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.schemas import ddl

# Calendar grains a table may be partitioned by.
GRAINS = {"day": None, "month": "MM", "year": "yyyy"}


def grain_column(date_col: str, grain: str) -> str:
    """Name of the partition column: the date itself for days, else a derived column."""
    return date_col if grain == "day" else f"{date_col}_{grain}"


def grain_start(date_col: Column, grain: str) -> Column:
    return date_col if grain == "day" else F.trunc(date_col, GRAINS[grain])


@dataclass(frozen=True)
class Layers:
    """Where the tables of one deployment live, their partition grain, and the index's buckets.

    The number of buckets is fixed with the first batch; history / buckets should fit an executor.
    """

    root: str
    raw: str = "raw"
    mart: str = "mart"
    landing: str = "landing"
    export: str = "export"
    grain: str = "day"
    buckets: int = 16

    def _path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def facts(self) -> str:
        return self._path(self.raw, "contributions")

    @property
    def ledger(self) -> str:
        """Which batches of raw facts are loaded, and the dates each of them brought."""
        return self._path(self.raw, "contributions_ledger")

    @property
    def fact_index(self) -> str:
        """Versions of all records, in buckets of the record id."""
        return self._path(self.raw, "contributions_index")

    @property
    def committees(self) -> str:
        return self._path(self.raw, "committees")

    @property
    def daily(self) -> str:
        return self._path(self.mart, "daily_contributions")

    @property
    def summary(self) -> str:
        return self._path(self.mart, "committee_summary")

    @property
    def summary_state(self) -> str:
        """Counted values of each committee, and the statistics that follow from them."""
        return self._path(self.mart, "committee_summary_state")

    @property
    def check_state(self) -> str:
        """Counted results of the assertions, by date, committee and mart partition."""
        return self._path(self.mart, "check_state")

    @property
    def landed_facts(self) -> str:
        return self._path(self.landing, "contributions")

    def export_path(self, name: str) -> str:
        return self._path(self.export, name)


def read_or_none(spark: SparkSession, path: str, schema: dict[str, str],
                 extra: dict[str, str] | None = None) -> DataFrame | None:
    """The table, or None when it does not exist yet."""
    try:
        return spark.read.schema(ddl({**schema, **(extra or {})})).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    return read_or_none(spark, path, {"_": "string"}) is not None


def read_by_date(spark: SparkSession, path: str, schema: dict[str, str], date_col: str,
                 grain: str = "day") -> DataFrame | None:
    """A date-partitioned table; a derived partition column stays available for pruning."""
    part = grain_column(date_col, grain)
    return read_or_none(spark, path, schema, {} if part == date_col else {part: "date"})


def arranged(df: DataFrame, date_col: str, grain: str = "day", cluster_by: Sequence[str] = ()) -> DataFrame:
    """Rows gathered per partition and sorted for tight min/max statistics.

    The rebalance hint lets adaptive execution split a hot date over many tasks and files and
    merge small dates into few tasks; a plain repartition would put a hot date in one task.
    """
    part = grain_column(date_col, grain)
    if part != date_col:
        df = df.withColumn(part, grain_start(F.col(date_col), grain))
    return df.hint("rebalance", part).sortWithinPartitions(part, *cluster_by)


def _by_date(df: DataFrame, date_col: str, grain: str, cluster_by: Sequence[str]):
    return arranged(df, date_col, grain, cluster_by).write.partitionBy(grain_column(date_col, grain))


def append_by_date(df: DataFrame, path: str, date_col: str, grain: str = "day",
                   cluster_by: Sequence[str] = ()) -> None:
    _by_date(df, date_col, grain, cluster_by).mode("append").parquet(path)


def overwrite_by_date(df: DataFrame, path: str, date_col: str, grain: str = "day",
                      cluster_by: Sequence[str] = ()) -> None:
    """Replace the whole table."""
    _by_date(df, date_col, grain, cluster_by).option("partitionOverwriteMode", "static") \
        .mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, date_col: str, grain: str = "day",
                       cluster_by: Sequence[str] = ()) -> None:
    """Replace only the partitions that ``df`` holds rows for.

    Old files go at the final commit, so ``df`` may be computed from the same table and lost
    tasks can run again.
    """
    _by_date(df, date_col, grain, cluster_by).option("partitionOverwriteMode", "dynamic") \
        .mode("overwrite").parquet(path)


def write_dimension(df: DataFrame, path: str, append: bool) -> None:
    df.write.mode("append" if append else "overwrite").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild of a table."""
    df.write.mode("overwrite").parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
