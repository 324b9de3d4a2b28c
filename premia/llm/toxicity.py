"""Toxicity from class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary texts, are learned from labelled rows; a text's score follows from the difference
of its two log-likelihoods divided by its number of words.

Each model is interpolated: what absolute discounting takes from the counts of its own class goes to one backoff
distribution that both share, built from continuation counts, that is from how many different words an expression has
followed in either class. An expression whose split between the classes could as well be chance (below ``least_z``
standard deviations, by the number of documents that hold it) keeps no counts of its own and is left to the shared
backoff in both models. Without that, the many words seen once or twice would say only that ordinary texts are more
numerous. Models of word pairs were tried and were much worse on held-out rows (area under the curve 0.57 against 0.85
before pruning), so the models have order one above the continuation counts.

Counts come from all labelled documents that are used for learning, up to the documented bound ``most_labels`` (about
that many rows, chosen by a hash of their id); exact copies count once. They are gathered in Spark: the different pairs of
left neighbour and expression are counted exactly, whatever their number. All expressions that pass the test become the
model, or the ``most_expressions`` clearest if a caller asks for a bound. Texts are scored in passes over blocks of
``BLOCK`` expressions, so that a task holds one block; several passes store the texts in between. One fifth of the learning rows is left out of the counts and sets the cut and the slope of the score. Labels,
language, source and id are no inputs of a score.

Null texts count as empty; a text without words scores like one without any telling expression. Labels that are null or
lack an id are ignored; if an id is labelled more than once it is toxic if any of its labels is. Without toxic or
without ordinary learning rows every score is the share of toxic ones, or 0. Rows are scored one by one, so repeated
rows and null ids give rows. Extra columns are ignored unless they are named in ``keep``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.llm.common import run_hashes, slices, stored, text_of, word_runs
from premia.llm.decontaminate import _FOLD

FOLDS = 5
DISCOUNT = 0.75
#: Expressions of a model that a task holds at once, 16 bytes each.
BLOCK = 500_000


class Model(NamedTuple):
    words: np.ndarray
    ratios: np.ndarray
    other: float
    cut: float
    slope: float
    share: float | None

    def blocks(self) -> list[Model]:
        """The model in parts of ``BLOCK`` expressions; sums over the parts are those over the whole."""
        cuts = range(0, max(len(self.words), 1), BLOCK)
        return [self._replace(words=self.words[i : i + BLOCK], ratios=self.ratios[i : i + BLOCK]) for i in cuts]

    def sums(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, what its known words add to the difference of the log-likelihoods, and its number of words."""
        folded, starts, stops, rows = word_runs(texts, _FOLD)
        total = np.full(len(texts), 0.0)
        counts = np.bincount(rows, minlength=len(texts))
        if len(starts) and len(self.words):
            hashes = run_hashes(folded, starts, stops)
            place = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            known = self.words[place] == hashes
            total = np.bincount(rows[known], weights=self.ratios[place[known]] - self.other, minlength=len(texts))
        return total, counts

    def means(self, texts: pa.Array, before: np.ndarray | float = 0.0) -> np.ndarray:
        """Difference of the log-likelihoods per word of each text; ``before`` is what other blocks have added."""
        total, counts = self.sums(texts)
        return (total + before) / np.maximum(counts, 1) + self.other

    def scores(self, texts: pa.Array, before: np.ndarray | float = 0.0) -> np.ndarray:
        if self.share is not None:
            return np.full(len(texts), self.share)
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.means(texts, before) - self.cut), -500, 500)))


def fold_of(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows with 0 are never learned from, nor are rows without an id."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")), F.lit(FOLDS)).cast("int")


def _learning_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """Ids and labels to learn from, without exact copies: a table of about ``most`` rows at most."""
    usable = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max((F.col(label_col) != 0).cast("int")).alias("toxic"))
        .withColumn("fold", fold_of("id"))
        .filter("fold <> 0")
    )
    given = usable.count()
    if given > most:
        usable = usable.filter(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * most / given))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("h"))
    labelled = texts.join(F.broadcast(usable), "id")
    chosen = labelled.groupBy("h", "toxic").agg(F.min(F.struct("id", "fold")).alias("x"))
    return stored(chosen.select("x.id", "x.fold", "toxic").distinct(), "toxicity-labels")


def _counts(rows: DataFrame) -> DataFrame:
    """Word hash, occurrences and documents by class, and the number of different left neighbours, the start of a text
    among them (``text``, ``toxic`` given)."""
    names = ("word", "before", "n0", "n1", "d0", "d1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                folded, starts, stops, row = word_runs(part.column(0), _FOLD)
                if not len(starts):
                    continue
                toxic = part.column(1).to_numpy(zero_copy_only=False)[row]
                hashes = run_hashes(folded, starts, stops)
                before = np.roll(hashes, 1)
                before[np.append(True, row[1:] != row[:-1])] = 0
                # Documents are counted at the first place of a word in its text, whichever neighbour it has there.
                order = np.lexsort((row, hashes))
                first = np.zeros(len(hashes), bool)
                first[order] = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1]))
                order = np.lexsort((before, hashes))
                hashes, before, toxic, first = hashes[order], before[order], toxic[order], first[order]
                at = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (before[1:] != before[:-1])))
                sums = [np.add.reduceat(x.astype(np.int64), at) for x in (toxic == 0, toxic == 1, first & (toxic == 0), first & (toxic == 1))]
                arrays = [hashes[at].view(np.int64), before[at].view(np.int64), *sums]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=list(names))

    pairs = rows.select("text", "toxic").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    each = pairs.groupBy("word", "before").agg(*[F.sum(c).alias(c) for c in names[2:]])
    return each.groupBy("word").agg(*[F.sum(c).alias(c) for c in names[2:]], F.count("*").alias("followed"))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most_labels: int = 1_000_000,
    most_expressions: int | None = None,
    least_z: float = 4.5,
) -> Model:
    chosen = _learning_rows(docs, labels, id_col, text_col, label_col, most_labels)
    empty = np.zeros(0, np.uint64), np.zeros(0)
    sizes = chosen.groupBy().agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        F.count(F.when(F.col("fold") != FOLDS - 1, 1)).alias("counted"),
        F.coalesce(F.sum(F.when(F.col("fold") != FOLDS - 1, F.col("toxic"))), F.lit(0)).alias("counted_toxic"),
    ).first()
    if not 0 < sizes["counted_toxic"] < sizes["counted"]:
        return Model(*empty, 0.0, 0.0, 1.0, sizes["toxic"] / sizes["n"] if sizes["n"] else 0.0)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "id")
    counts = stored(_counts(rows.filter(F.col("fold") != FOLDS - 1)), "toxicity-counts")

    p = sizes["counted_toxic"] / sizes["counted"]
    expected = (F.col("d0") + F.col("d1")) * p
    z = F.abs(F.col("d1") - expected) / F.sqrt(F.greatest(expected * (1 - p), F.lit(0.25)))
    seen = counts.select("word", "n0", "n1", z.alias("z"), (F.col("followed") + 0.5).alias("followed"))
    total = seen.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("followed").alias("followed")).first()
    if not total["n0"] or not total["n1"]:
        return Model(*empty, 0.0, 0.0, 1.0, sizes["toxic"] / sizes["n"])
    telling = seen.filter(F.col("z") >= least_z)
    if most_expressions is not None:
        telling = telling.orderBy(F.desc("z"), "word").limit(most_expressions)
    kept = telling.select("word", "n0", "n1", "followed").toArrow()
    words, n0, n1, followed = (c.to_numpy() for c in kept.columns)
    words = words.astype(np.int64).view(np.uint64)
    order = np.argsort(words)
    words, counted, shared = words[order], {"n0": n0[order], "n1": n1[order]}, followed[order] / total["followed"]
    logs, others = [], []
    for c in ("n0", "n1"):
        own = np.maximum(counted[c] - DISCOUNT, 0) / total[c]
        freed = 1 - own.sum()
        logs.append(np.log(own + freed * shared))
        others.append(math.log(freed))
    model = Model(words, logs[1] - logs[0], others[1] - others[0], 0.0, 1.0, None)
    return _calibrated(model, rows.filter(F.col("fold") == FOLDS - 1))


def _passed(rows: DataFrame, model: Model) -> tuple[DataFrame, Model]:
    """``rows`` (texts in ``__text``) with what all but the last block of the model add, in ``__before``; that block."""
    *blocks, last = model.blocks()
    out = rows.withColumn("__before", F.lit(0.0))
    for block in blocks:
        out = stored(out.mapInArrow(_adding(block), out.schema), "toxicity-pass")
    return out, last


def _adding(block: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                *columns, before = part.columns
                added = block.sums(columns[-1])[0] + before.to_numpy()
                yield pa.RecordBatch.from_arrays([*columns, pa.array(added)], names=part.schema.names)

    return run


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Set the cut where most of the rows left out of the counts fall on the right side, and a slope to match."""
    given, last = _passed(rows.select("toxic", F.col("text").alias("__text")), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                means = last.means(part.column(1), part.column(2).to_numpy())
                place = np.rint(np.clip(means, -20, 20) * 1e4).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(place), part.column(0)], names=["place", "toxic"])

    placed = given.mapInArrow(run, "place long, toxic int")
    table = sorted(placed.groupBy("place").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect())
    n, toxic = sum(r["n"] for r in table), sum(r["toxic"] for r in table)
    if not 0 < toxic < n:
        return model._replace(cut=model.other + 0.01, slope=100.0)
    x = np.array([r["place"] for r in table]) / 1e4
    ordinary, bad = np.array([r["n"] - r["toxic"] for r in table], float), np.array([r["toxic"] for r in table], float)
    right = np.append(0, np.cumsum(ordinary)) + (toxic - np.append(0, np.cumsum(bad)))
    places = np.concatenate([[x[0] - 0.01], (x[1:] + x[:-1]) / 2, [x[-1] + 0.01]])
    cut = float(places[int(np.argmax(right))])
    slope, best = 1.0, -math.inf
    for power in np.arange(0, 12, 0.25):
        sided = np.clip(2**power * (x - cut), -500, 500)
        fit = -(bad * np.log1p(np.exp(-sided)) + ordinary * np.log1p(np.exp(sided))).sum()
        if fit > best:
            slope, best = float(2**power), fit
    return model._replace(cut=cut, slope=slope)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: its id, the columns of ``keep`` and ``toxicity`` from 0 to 1."""
    kept = [id_col, *[c for c in keep if c != id_col]]
    given = docs.select(*[docs[c] for c in kept], text_of(text_col).alias("__text"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("toxicity", T.DoubleType(), False)])
    given, last = _passed(given, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                *columns, texts, before = part.columns
                yield pa.RecordBatch.from_arrays([*columns, pa.array(last.scores(texts, before.to_numpy()))], names=[*kept, "toxicity"])

    return given.mapInArrow(run, schema)
