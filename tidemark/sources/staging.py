"""Staging of rows that are costly to compute and read more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The same rows from a columnar copy in the shared folder that ``spark.checkpoint.dir`` names (or ``folder``);
    ``df`` itself if there is none.

    Each later pass reads only the columns it needs instead of computing the rows again, lineage is cut, and a lost executor
    costs no recomputation.  Used for parsed text, and between the steps of the hot-key plans.  The copy stays until the
    folder is cleaned.
    """
    spark = df.sparkSession
    folder = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not folder or df.isStreaming:
        return df
    path = f"{folder.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
