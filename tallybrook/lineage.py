"""Cutting the lineage of loops, in the folder that spark.checkpoint.dir names."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The rows as written files, so that a later round reads them instead of repeating the rounds before."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()
