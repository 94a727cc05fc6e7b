"""A table as dated versions in one folder, of which a log says which is current.

A new version is written beside the others, and what decides about it (rows, the rounded total, NULLs where none may be) is
observed by the job that writes it, so no input is read a second time. Facts of the current version stand in the log. If a
version is refused the log keeps the one before in force; the earlier versions are the dated backups.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG = "version string, at timestamp, rows long, total_100m double, nulls long, accepted boolean, why string"


class Versions:
    """Versions of a table under `root`, a folder that Spark can write."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log(self) -> DataFrame:
        """Every version that was offered, in order of time."""
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.root}/log").orderBy("at", "version")
        except AnalysisException:  # nothing was offered yet
            return self.spark.createDataFrame([], LOG)

    def current(self) -> dict | None:
        """The log's row of the version in force."""
        last = self.log().where("accepted").orderBy(F.desc("at"), F.desc("version")).limit(1).collect()
        return last[0].asDict() if last else None

    def read(self, version: str | None = None) -> DataFrame:
        """The version in force, or an earlier one by name."""
        if version is None:
            now = self.current()
            if now is None:
                raise ValueError(f"no version of {self.root} is in force")
            version = now["version"]
        return self.spark.read.parquet(f"{self.root}/{version}")

    def publish(self, df: DataFrame, amount: str, required: list[str] | None = None, same: bool = True) -> bool:
        """Writes a version, and makes it the current one if its required columns hold no NULL and, with `same`, rows and the total
        in hundreds of millions are those of the version in force. Where there is none yet, any rows will do."""
        now, at = self.current(), datetime.now(UTC)
        version, seen = f"v{at:%Y%m%d_%H%M%S_%f}", Observation()
        nulls = [F.count_if(F.col(c).isNull()) for c in required or []]
        facts = [F.count(F.lit(1)).alias("rows"), F.sum(F.col(amount).cast("decimal(38,2)")).alias("total"), *(c.alias(f"null_{i}") for i, c in enumerate(nulls))]
        df.observe(seen, *facts).write.mode("errorifexists").parquet(f"{self.root}/{version}")
        got = seen.get
        total = float(round((got["total"] or 0) / 100_000_000))
        missing = sum(got[f"null_{i}"] for i in range(len(nulls)))
        why = [f"{missing} NULLs in required columns"] if missing else []
        if same and now is not None:
            why += [f"rows {now['rows']} -> {got['rows']}"] if now["rows"] != got["rows"] else []
            why += [f"total {now['total_100m']} -> {total}"] if now["total_100m"] != total else []
        row = (version, at.replace(tzinfo=None), got["rows"], total, missing, not why, "; ".join(why))
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return not why
