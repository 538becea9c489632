"""Cutting lineage between rounds of an iterative operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the folder that the cluster names in spark.checkpoint.dir; a temporary one only where none is set, in local mode."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="strata-"))
    return df.checkpoint()
