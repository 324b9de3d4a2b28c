"""Writers for layers. A table is published as a whole: readers see its last complete version or the one before."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame

from premia.sources import commits
from premia.sources.readers import POINTERS

#: Versions that stay after a new one is published, for readers that have just looked up the one before.
KEPT_VERSIONS = 2


def _publish(df: DataFrame, path: str, *by: str) -> None:
    """Write a new folder, then point to it. A write that fails or is lost leaves the last version readable; of two
    writers at once the later commit counts, and neither mixes with the other."""
    spark = df.sparkSession
    folder = f"v-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{folder}")
    log = f"{path}/{POINTERS}"
    commits.commit(spark, log, lambda *_: json.dumps({"folder": folder}))
    for old in commits.names(spark, log)[:-KEPT_VERSIONS]:
        gone = json.loads(commits.read_text(spark, f"{log}/{old}"))["folder"]
        commits.delete(spark, f"{path}/{gone}")


def write_table(df: DataFrame, path: str) -> None:
    _publish(df, path)


def write_by_split(df: DataFrame, path: str) -> None:
    """All splits in one pass; readers prune on the ``split`` folder."""
    _publish(df, path, "split")
