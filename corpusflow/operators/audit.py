"""Row counts of stages, taken while the stages run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageAudit:
    """Observes tables without extra passes: counts appear once an action has run.

    >>> audit = StageAudit(spark)
    >>> out = audit.stage("drop_invalid", df, lambda d: drop_invalid(d, ["id"]))
    >>> out.write.parquet(path); audit.table().show()
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._seen: list[tuple[str, Observation, Observation]] = []

    def stage(
        self, name: str, df: DataFrame, step: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """Apply ``step`` and observe the rows before and after it."""
        rows = F.count(F.lit(1)).alias("rows")
        before, after = Observation(f"{name}-in"), Observation(f"{name}-out")
        out = step(df.observe(before, rows)).observe(after, rows)
        self._seen.append((name, before, after))
        return out

    def table(self) -> DataFrame:
        """(stage, rows_in, rows_out, removed); waits for an action that covers the stages."""
        rows = []
        for name, before, after in self._seen:
            n_in, n_out = before.get["rows"], after.get["rows"]
            rows.append((name, n_in, n_out, n_in - n_out))
        schema = "stage string, rows_in long, rows_out long, removed long"
        return self._spark.createDataFrame(rows, schema)
