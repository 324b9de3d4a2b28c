"""Benchmark decontamination: a prefix-filtered set join between documents and benchmark items.

A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is one window. A document
word inside any occurrence of a window is hit.

An occurrence needs every word of the window, so its necessary prefix is one word: the rarest, by how often the
words occur in all documents. Document positions are joined with windows on that word alone; the bounds of the
document around the position (a window must fit between its first and last word) and then the words themselves, rarest
first, decide. Item words are looked up, never compared as strings in a loop over windows.

The benchmark is cut into segments and those into blocks of about ``block_bytes``, which bounds what a task and the
driver hold; every block is matched against all documents and what was found so far is carried along, so a benchmark of
any size gives the same result. No document leaves its task: there is no shuffle and no group to be skewed.

Null texts have no words. Rows are judged one by one, so repeated rows give repeated results and null ids stay. An item
without an id still marks words but is not listed. Items that share an id count once. Extra columns are ignored unless
named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premia.llm.common import slices, stored, text_of

#: Item bytes that one pass over the documents holds in memory.
BLOCK_BYTES = 8 << 20
#: Windows of an item that stay in one segment.
SEGMENT = 4096

#: Upper case A-Z becomes lower case; every other ASCII byte that is no digit or letter becomes a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case, as UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


def _segments(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Item words in overlapping runs that together hold each window of the item once."""
    given = items.select(F.col(id_col).cast("string").alias("item"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str | None, bytes]] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(text)
                for start in range(0, max(1, len(found) - window + 1), SEGMENT):
                    if run_of := found[start : start + SEGMENT + window - 1]:
                        out.append((item, b" ".join(run_of)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], names=["item", "words"])

    return given.mapInArrow(run, "item string, words binary")


class Block:
    """Distinct windows of some item segments, found again by their rarest word."""

    def __init__(self, segments: list[tuple[str | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], set[str]] = {}
        add = self.vocabulary.setdefault
        for item, text in segments:
            ids = [add(w, len(self.vocabulary)) for w in text.split(b" ")]
            for start in range(max(1, len(ids) - window + 1)):
                owners = self.windows.setdefault(tuple(ids[start : start + window]), set())
                if item is not None:
                    owners.add(item)
        self.by_prefix: dict[int, list[tuple[int, tuple[int, ...], tuple[int, ...], frozenset[str]]]] = {}
        self.is_prefix = np.zeros(len(self.vocabulary) + 1, bool)

    def order(self, counts: np.ndarray) -> Block:
        """File every window under its rarest word; ``counts`` holds the occurrences of each word in all documents."""
        for ids, owners in self.windows.items():
            rarest = sorted(range(len(ids)), key=lambda k: (counts[ids[k]], ids[k], k))
            prefix = ids[rarest[0]]
            self.is_prefix[prefix] = True
            self.by_prefix.setdefault(prefix, []).append((rarest[0], ids, tuple(rarest[1:]), frozenset(owners)))
        self.windows = {}
        return self

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of all texts in a row (the id behind the last for other words), and where each text ends."""
        get, other = self.vocabulary.get, repeat(len(self.vocabulary))
        found: list[int] = []
        ends = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found.extend(map(get, words(text), other))
            ends[i] = len(found)
        return np.array(found, np.int64), ends

    def match(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, int, frozenset[str]]]:
        """Places where a window starts, the window's length and its items."""
        if not len(ids):
            return
        places = np.flatnonzero(self.is_prefix[ids])
        row = np.searchsorted(ends, places, side="right")
        firsts = np.concatenate([[0], ends[:-1]])[row]
        lasts = ends[row]
        at = ids[places]
        order = np.argsort(at, kind="stable")
        places, firsts, lasts, at = places[order], firsts[order], lasts[order], at[order]
        cuts = np.flatnonzero(np.diff(at)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(at)], strict=True):
            if low == high:
                continue
            for offset, window, others, owners in self.by_prefix[int(at[low])]:
                starts = places[low:high] - offset
                starts = starts[(starts >= firsts[low:high]) & (starts + len(window) <= lasts[low:high])]
                for k in others:
                    if not len(starts):
                        break
                    starts = starts[ids[starts + k] == window[k]]
                if len(starts):
                    yield starts, len(window), owners


def _counts(docs: DataFrame, block: Block) -> np.ndarray:
    """How often each word of the block occurs in all documents."""
    size = len(block.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "__text"):
                ids, _ = block.ids(part.column(part.schema.get_field_index("__text")).to_pylist())
                total += np.bincount(ids, minlength=size + 1)
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["word", "n"])

    out = np.zeros(size, np.int64)
    for word, n in docs.select("__text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n")).collect():
        out[word] = n
    return out


def _apply(rows: DataFrame, block: Block) -> DataFrame:
    names = rows.columns
    text, spans, items = (names.index(c) for c in ("__text", "spans", "items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                ids, ends = block.ids(part.column(text).to_pylist())
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                change = np.zeros(len(ids) + 1, np.int64)
                owners_of: dict[int, set[str]] = {i: set(x) for i, x in enumerate(part.column(items).to_pylist()) if x}
                for row, had in enumerate(part.column(spans).to_pylist()):
                    for x in had:
                        change[begins[row] + x["start"]] += 1
                        change[begins[row] + x["end"]] -= 1
                for starts, length, owners in block.match(ids, ends):
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + length, -1)
                    for row in np.unique(np.searchsorted(ends, starts, side="right")):
                        owners_of.setdefault(int(row), set()).update(owners)
                hit = np.cumsum(change[:-1]) > 0
                row_of = np.repeat(np.arange(len(ends)), ends - begins)
                edge = np.ones(len(ids), bool)
                edge[1:] = (hit[1:] != hit[:-1]) | (row_of[1:] != row_of[:-1])
                firsts = np.flatnonzero(edge)
                stops = np.append(firsts[1:], len(ids))
                keep = hit[firsts] if len(firsts) else np.zeros(0, bool)
                firsts, stops = firsts[keep], stops[keep]
                rows_hit = row_of[firsts]
                found: list[list[dict]] = [[] for _ in ends]
                for row, a, b in zip(rows_hit.tolist(), (firsts - begins[rows_hit]).tolist(), (stops - begins[rows_hit]).tolist(), strict=True):
                    found[row].append({"start": a, "end": b})
                columns = list(part.columns)
                columns[spans] = pa.array(found, part.schema.field(spans).type)
                columns[items] = pa.array([sorted(owners_of.get(i, ())) for i in range(len(ends))], part.schema.field(items).type)
                columns[names.index("n_words")] = pa.array(ends - begins, pa.int64())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, rows.schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    keep: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document row: id, ``n_words``, ``spans`` (runs of hit words as start and end), ``n_hit``, ``items``
    (ids of items with an occurring window, as strings in order) and the columns of ``keep``."""
    kept = [id_col, *[c for c in keep if c != id_col]]
    rows = docs.select(
        *[docs[c] for c in kept],
        text_of(text_col).alias("__text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    rows = rows.select([F.col(f.name) for f in rows.schema])
    segments = stored(_segments(items, item_id, item_text, window), "benchmark-segments")
    size = segments.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n_blocks = -(-size // block_bytes) or 1
    numbered = segments.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(n_blocks)))
    for number in range(n_blocks):
        held = numbered.filter(F.col("block") == number).select("item", "words").collect()
        block = Block([(r.item, bytes(r.words)) for r in held], window)
        rows = _apply(rows, block.order(_counts(rows, block)))
        if number + 1 < n_blocks:
            rows = stored(rows, "contamination")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return rows.select(*kept, "n_words", "spans", hit.alias("n_hit"), "items")


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least one hit word, and at least a twentieth of all words."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
