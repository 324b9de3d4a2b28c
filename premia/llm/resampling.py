"""Importance resampling: rows of the raw table, drawn so that they follow the distribution of a target.

Texts are bags of hashed n-grams (words and punctuation runs, alone and in pairs, in ``BUCKETS`` buckets). Two
generative models are fitted, one on the target texts and one on all raw texts; the log importance weight of a text is
the sum over its n-grams of the log ratio of the two. Rows are drawn without replacement with probabilities in
proportion to their weights by Gumbel top-k: each log weight gets independent Gumbel noise and the ``k`` largest sums
are kept. The noise follows from a hash of the seed and the id, so a lost task gives the same result again.

The raw model counts every text of the table. The target is what ``labels`` marks, about ``most_target`` rows at most,
chosen by a hash of the id. The k-th largest sum is found by counting in ever narrower bins; only counts and, at the
end, one value reach the driver.

Null texts count as empty and have weight 0. Rows that tie with the last one kept are kept too, so repeated rows share
their fate; rows without an id share one draw of noise. ``keep_share`` is the share of rows to keep, by default the
share of target rows among the labelled ones. Without target rows all weights are 0. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import byte_rows, mixed, run_hashes, slices, stored, text_of

BUCKETS = 1 << 16
SMOOTHING = 1.0
#: Bins of one round of the search for the k-th largest sum, and rounds after which ties alone can be left.
BINS, ROUNDS = 4096, 12

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: White space and control bytes, word bytes (letters, digits, underscore, beyond ASCII), and punctuation.
_CLASS = np.array([0 if b <= 32 else 1 if b >= 128 or b == 95 or chr(b).isalnum() else 2 for b in range(256)], np.uint8)


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram of the texts."""
    data, offsets = byte_rows(texts)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _CLASS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, stops = at[:-1], at[1:]
    token = kind[starts] != 0
    starts, stops = starts[token], stops[token]
    row = np.searchsorted(offsets, starts, side="right") - 1
    words = run_hashes(_FOLD[data], starts, stops)
    pairs = mixed(words[:-1] * np.uint64(0xBF58476D1CE4E5B9) + words[1:])
    inside = row[1:] == row[:-1]
    bucket = np.concatenate([words, pairs[inside]]) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate([row, row[1:][inside]])


def _target_ids(labels: DataFrame, id_col: str, label_col: str, most: int) -> tuple[DataFrame, float]:
    """Ids of the target rows (a bounded table) and the share of the target among labelled ids."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col) != 0).alias("target"))
    n, target = known.agg(F.count("*"), F.count(F.when(F.col("target"), 1))).first()
    ids = known.filter("target").select("id")
    if target > most:
        ids = ids.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * most / target))
    return ids.withColumn("target", F.lit(True)), target / n if n else 1.0


def log_ratios(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """For each bucket the log of its probability in the target over that in all texts (``id`` and ``text`` given)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                bucket, row = ngrams(part.column(0))
                chosen = part.column(1).to_numpy(zero_copy_only=False)[row]
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[chosen], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (seen, raw[seen], target[seen])], names=["bucket", "raw", "target"])

    marked = docs.join(F.broadcast(target_ids), "id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    counts = marked.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for r in counts:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    if not sum(r["target"] for r in counts):
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                bucket, row = ngrams(part.column(1))
                total = np.bincount(row, weights=ratios[bucket], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total.astype(float))], names=["id", "log_weight"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, log_weight double")


def kth_largest(rows: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column without nulls; None if there are no rows."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count("*")).first()
    if not n:
        return None
    k = min(max(k, 1), n)
    held = rows.select(F.col(column).alias("v"))
    for _ in range(ROUNDS):
        if low == high:
            break
        width = (high - low) / BINS
        if width == 0:
            break
        place = F.least(F.floor((F.col("v") - low) / width), F.lit(BINS - 1))
        inside = held.filter(F.col("v").between(low, high))
        bins = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
        for b in sorted(bins, key=lambda r: -r["bin"]):
            if k <= b["n"]:
                low, high = b["low"], b["high"]
                break
            k -= b["n"]
    return high


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep_share: float | None = None,
    most_target: int = 1_000_000,
    seed: int = 42,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``log_weight``, ``draw`` (log weight with noise) and ``kept``."""
    given = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    ids, share = _target_ids(labels, id_col, label_col, most_target)
    ratios = log_ratios(given, stored(ids, "resampling-target"))
    uniform = (F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    drawn = _weights(given, ratios).withColumn("draw", F.col("log_weight") - F.log(-F.log(uniform)))
    rows = stored(drawn, "resampling-draws")
    k = round((share if keep_share is None else keep_share) * rows.count())
    cut = kth_largest(rows, "draw", k)
    kept = F.col("draw") >= F.lit(cut) if k > 0 and cut is not None else F.lit(False)
    return rows.select(F.col("id").alias("doc_id"), "log_weight", "draw", kept.alias("kept"))
