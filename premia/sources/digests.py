"""Digests of stored files of any size, taken in the tasks and never through the driver.

``file_digests`` gives the plain SHA-256 of each file. It is sequential by nature, so a file is one task's work: small
ones go through Spark's own reader, larger ones are streamed in blocks. ``tree_digests`` reads the blocks of one file in
parallel and folds their digests into a root, so a single file of many terabytes is spread over the cluster.

Files beyond ``WHOLE`` bytes, and all files of ``tree_digests``, are opened in the Python workers by ``pyarrow.fs``
(local and mounted paths, ``hdfs``, ``s3``/``s3a``, ``gs``). A file that is shorter than when it was listed is
an error. Spark's listing leaves out empty files, so they give no row; a folder without files gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes hashed at once, and the size up to which a whole file may be one value of a row.
BLOCK, WHOLE = 8 << 20, 256 << 20
#: Digests that one node of a tree holds.
FANOUT = 1024
#: Bytes for each task that hashes blocks.
TASK_BYTES = 1 << 30


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Without the column of contents only the listing is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def _name() -> Column:
    return F.element_at(F.split("path", "/"), -1).alias("file")


def _opened(path: str) -> pa.NativeFile:
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem().open_input_file(path.removeprefix("file:"))
    scheme = "s3" if parts.scheme in ("s3a", "s3n") else parts.scheme
    system, inner = pafs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{quote(parts.path)}")
    return system.open_input_file(inner)


def _read(source: pa.NativeFile, path: str, start: int, size: int) -> bytes:
    data = source.read_at(size, start)
    if len(data) != size:
        raise OSError(f"{path} is shorter than when it was listed")
    return data


def file_digests(spark: SparkSession, path: str, block: int = BLOCK, whole: int = WHOLE) -> DataFrame:
    """``file``, ``bytes`` and ``file_sha256`` of every file below ``path``."""
    columns = [_name(), F.col("length").alias("bytes")]
    small = _files(spark, path).where(F.col("length") <= whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for name, length in zip(batch["path"].to_pylist(), batch["length"].to_pylist()):
                digest = hashlib.sha256()
                with _opened(name) as source:
                    for start in range(0, length, block):
                        digest.update(_read(source, name, start, min(block, length - start)))
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch["path"], batch["length"], pa.array(digests, pa.string())], names=["path", "length", "file_sha256"])

    large = _files(spark, path).where(F.col("length") > whole).select("path", "length")
    # A given number of partitions is kept, so that files are not gathered in one task for the few bytes of their names.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    streamed = large.repartition(tasks, "path").mapInArrow(run, "path string, length long, file_sha256 string")
    return small.select(*columns, F.sha2("content", 256).alias("file_sha256")).unionByName(streamed.select(*columns, "file_sha256"))


def tree_digests(spark: SparkSession, path: str, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """``file``, ``bytes``, ``n_blocks`` and ``tree_sha256`` of every file below ``path``.

    The leaves are the SHA-256 of blocks of ``block`` bytes. While a file has several nodes, each ``fanout``
    consecutive ones become the SHA-256 of their hex digests; a lone leaf is the root.
    """
    if block < 1 or fanout < 2:
        raise ValueError("a block holds at least one byte and a node at least two digests")
    listed = _files(spark, path).select("path", "length")
    listed = listed.withColumn("n_blocks", F.expr(f"(length + {block - 1}) DIV {block}"))
    size = listed.agg(F.max("n_blocks").alias("most"), F.sum("length").alias("bytes")).first()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size["bytes"] or 0) // TASK_BYTES)

    # Two steps, so that no row holds the numbers of all blocks of a large file.
    runs = listed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_blocks - 1) DIV {fanout}"))))
    last = F.least(F.col("n_blocks"), (F.col("run") + 1) * fanout) - 1
    blocks = runs.withColumn("node", F.explode(F.sequence(F.col("run") * fanout, last))).drop("run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, source = None, None
        try:
            for batch in batches:
                digests = []
                for name, length, node in zip(*(batch[c].to_pylist() for c in ("path", "length", "node"))):
                    if name != held:
                        if source:
                            source.close()
                        held, source = name, _opened(name)
                    start = node * block
                    digests.append(hashlib.sha256(_read(source, name, start, min(block, length - start))).hexdigest())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], names=[*batch.schema.names, "digest"])
        finally:
            if source:
                source.close()

    nodes = blocks.repartition(tasks, "path", "node").sortWithinPartitions("path", "node")
    nodes = nodes.mapInArrow(run, "path string, length long, n_blocks long, node long, digest string")
    nodes = nodes.withColumn("width", F.col("n_blocks"))
    width = size["most"] or 1
    while width > 1:
        width = -(-width // fanout)
        children = F.sort_array(F.collect_list(F.struct("node", "digest")))
        joined = F.concat_ws("", F.transform(children, lambda x: x["digest"]))
        folded = nodes.groupBy("path", "length", "n_blocks", "width", F.expr(f"node DIV {fanout}").alias("parent")).agg(
            F.when(F.col("width") == 1, F.first("digest")).otherwise(F.sha2(joined, 256)).alias("digest")
        )
        nodes = folded.select(
            "path", "length", "n_blocks", F.col("parent").alias("node"), "digest", F.expr(f"(width + {fanout - 1}) DIV {fanout}").alias("width")
        )
    return nodes.select(_name(), F.col("length").alias("bytes"), "n_blocks", F.col("digest").alias("tree_sha256"))
