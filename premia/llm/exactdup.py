"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of fixed size. Equal blocks get the same integer: blocks are sorted by their digest,
equal ones meet, and every digest is held against the bytes of all its blocks, so that a digest that stands for two
blocks is found and the naming repeated with a longer one. Then the names of adjacent blocks are paired, equal pairs get
the same integer, and so on until each document has one integer. Two documents have the same number of blocks and the
same integer if and only if their normalised texts are equal.

Everything is a DataFrame expression. A text passes one shuffle, as blocks; all that follows handles integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.llm.common import discard, stored, text_of

BLOCK_BYTES = 4096
SPACES = r"[\x20\x09-\x0D]+"
#: Digests of blocks, tried in this order until no two blocks share one.
DIGESTS = (F.md5, lambda block: F.sha2(block, 256), lambda block: F.sha2(block, 512))
#: Right half of a pair without one.
NONE = -1
#: Keys that are handled apart for each shuffle partition: a key that is not among them has a quarter of an even share.
HOT_PER_PARTITION = 4


def normalised(column: str) -> Column:
    """The text with each run of white space replaced by one space; null is empty."""
    return F.regexp_replace(text_of(column), SPACES, " ")


def _blocks(text: Column, block_bytes: int) -> Column:
    """The UTF-8 bytes of a text in blocks; an empty text has one empty block.

    The outer ``transform`` binds the bytes, so that they are not computed anew for every block.
    """

    def cut(data: Column) -> Column:
        last = F.greatest(F.octet_length(data) - 1, F.lit(0))
        starts = F.sequence(F.lit(0), F.floor(last / block_bytes).cast("int"))
        return F.transform(starts, lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)))

    return F.transform(F.array(text.cast("binary")), cut)[0]


def _digest(block: Column, attempt: int) -> Column:
    return F.unhex(DIGESTS[attempt](block))


def name_blocks(docs: DataFrame, text_col: str, block_bytes: int, attempt: int) -> DataFrame:
    """``digest, name, rows``: one row per different block, with an integer that no other block has."""
    blocks = docs.select(F.explode(_blocks(normalised(text_col), block_bytes)).alias("block"))
    found = blocks.select(_digest(F.col("block"), attempt).alias("digest"), "block").groupBy("digest", "block").agg(F.count(F.lit(1)).alias("rows"))
    return _numbered(found.select("digest", "rows"), ["digest"], "block-names")


def _numbered(found: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Sorted by ``keys`` in each partition and numbered; a task that runs again gives the same numbers."""
    return stored(found.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()), label)


def _looked_up(facts: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` with a table of one row per key whose ``rows`` tells how many facts have the key.

    Keys with many facts are a bounded number of rows and are broadcast, so that their facts stay where they are; only
    the other facts are shuffled.
    """
    spark = facts.sparkSession
    total = lookup.agg(F.sum("rows")).first()[0] or 0
    most = total // (HOT_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(lookup.filter(F.col("rows") > most).drop("rows"))
    cold = lookup.filter(F.col("rows") <= most).drop("rows")
    return facts.join(hot, keys).unionByName(facts.join(hot.select(*keys), keys, "left_anti").join(cold, keys))


def _name_pairs(pairs: DataFrame) -> DataFrame:
    """``left, right, name, rows``: equal pairs have one integer."""
    return _numbered(pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("rows")), ["left", "right"], "pair-names")


def _paired(named: DataFrame) -> DataFrame:
    """The names of adjacent blocks of a document side by side; ``n`` becomes the number of pairs."""
    return named.groupBy("row", F.shiftright(F.col("n") + 1, 1).alias("n"), F.shiftright("at", 1).alias("at")).agg(
        F.max(F.expr("IF(at % 2 = 0, name, null)")).alias("left"),
        F.coalesce(F.max(F.expr("IF(at % 2 = 1, name, null)")), F.lit(NONE)).alias("right"),
    )


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``row`` (a number of its own), ``doc_id``, ``n_blocks``, ``name`` and ``text_sha256``.

    Documents are equal exactly when ``n_blocks`` and ``name`` are.
    """
    for attempt in range(len(DIGESTS)):
        names = name_blocks(docs, text_col, block_bytes, attempt)
        if names.groupBy("digest").count().filter("count > 1").isEmpty():
            break
        discard(names)
    else:
        raise ValueError("different blocks share every digest")
    parts = F.transform(
        F.array(normalised(text_col)),
        lambda t: F.struct(F.sha2(t, 256).alias("sha"), F.transform(_blocks(t, block_bytes), lambda b: _digest(b, attempt)).alias("digests")),
    )
    base = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), parts[0].alias("found"))
    base = stored(base.select("row", "doc_id", F.col("found.sha").alias("text_sha256"), F.col("found.digests").alias("digests")), "block-digests")
    facts = base.select("row", F.size("digests").alias("n"), F.posexplode("digests").alias("at", "digest"))
    keys, ends = ["digest"], None
    longest = base.agg(F.max(F.size("digests"))).first()[0] or 1
    while True:
        # Each fact is joined once: here with its document complete, below on its way to the next level.
        last = _looked_up(facts.filter("n = 1"), names, keys).select("row", "name")
        ends = last if ends is None else ends.unionByName(last)
        if longest == 1:
            break
        facts = stored(_paired(_looked_up(facts.filter("n > 1"), names, keys)), "name-pairs")
        names, keys, longest = _name_pairs(facts), ["left", "right"], (longest + 1) // 2
    return stored(base.select("row", "doc_id", "text_sha256", F.size("digests").alias("n_blocks")).join(ends, "row"), "identities")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_blocks, name``.

    Of documents with equal normalised texts the one with the smallest id stays. Null texts are empty and equal to other
    texts without content. Rows without an id come after all others, so that one of them stays only in a group without
    ids (``keep_id`` null). Of rows that also share the smallest id the first in the input stays, and only that one.
    Other columns are not read, whatever their names; an empty table gives an empty result.
    """
    rows = identities(docs, id_col, text_col, block_bytes)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("first")
    groups = stored(rows.groupBy("n_blocks", "name").agg(first, F.count(F.lit(1)).alias("rows")), "duplicate-groups")
    # ``rows`` steers the join and goes there, so the size is carried under a name of its own.
    found = _looked_up(rows, groups.withColumn("group_size", F.col("rows")), ["n_blocks", "name"])
    return found.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
        "n_blocks",
        "name",
    )
