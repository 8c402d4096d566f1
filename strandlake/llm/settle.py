"""Tables written to the shared folder, so that later steps neither recompute nor lose what they start from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from strandlake.session import shared_folder


def settle(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet under the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
