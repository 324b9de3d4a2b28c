"""Ranked lexical search over a trie of documents.

A document is reduced to the terms that some item uses, in order of falling document frequency, so that documents share
trie paths from their most frequent terms on. Each node knows, over its subtree, the largest occurrence count of every
term, the smallest length term m and the smallest id. For an item these give an upper bound of every node, and a
depth-first walk leaves out the subtrees that cannot reach the item's current top ten.

A task takes an even share of the reduced documents, builds their trie (or several, where they hold many terms) and keeps
one top list per item. Beside the reduced documents only these lists are shuffled.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.llm.common import small_batches, stored, text_of

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
#: Terms of items that one pass over the documents holds; more items take more passes, with the same result.
BLOCK_TERMS = 1_000_000
#: Documents and term entries of one trie.
CHUNK_DOCS, CHUNK_ENTRIES = 8192, 1_500_000
TASK_DOCS = 8000
#: Subtrees of at most this many documents are scored one by one.
LEAF_DOCS = 32
#: Bytes of a text that are split into terms at once.
PIECE = 1 << 20
#: Partial lists of an item are first merged in this many groups.
MERGE_GROUPS = 64
_NO_ID = np.iinfo(np.int64).max
_FOLD = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)  # ASCII letters and digits and all bytes of other characters belong to terms


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item`` (a number per row), ``item_id``, ``term, q``: how often a row uses a term."""
    folded = F.translate(text_of(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)).alias("terms"))
    once = stored(numbered, "search-items")
    return once.select("item", "item_id", F.explode("terms").alias("term")).groupBy("item", "item_id", "term").agg(F.count(F.lit(1)).alias("q"))


def _terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a folded text, piece by piece."""
    start = 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            cut = text.rfind(b" ", start, stop)
            if cut <= start:
                cut = text.find(b" ", stop)
            stop = len(text) if cut < 0 else cut
        yield text[start:stop].split()
        start = stop


def _vectors(vocabulary):
    """Reduce texts to (id, n, term numbers, counts)."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(vocabulary.value)}.get
        for batch in batches:
            lengths, terms, counts = [], [], []
            for text in batch.column("text"):
                n, found = 0, Counter()
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                for words in _terms_of(data.translate(_FOLD)):
                    n += len(words)
                    found.update(map(number, words))
                found.pop(None, None)
                lengths.append(n)
                terms.append(np.fromiter(found.keys(), np.int32, len(found)))
                counts.append(np.fromiter(found.values(), np.int32, len(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                ["id", "n", "terms", "counts"],
            )

    return reduce


@dataclass
class Trie:
    """Documents ``first[i]:last[i]`` (sorted by their term sequences) lie below node i; children follow their parent.

    Nodes without children are scored document by document. ``term_at[t]:term_at[t + 1]`` are the places of term t in
    ``node, most, reach``: the nodes below which it occurs, its largest count there and what it can contribute at best.
    ``gain`` is what each entry of a document contributes.
    """

    first: np.ndarray
    last: np.ndarray
    children: list[np.ndarray]
    least_m: np.ndarray
    least_id: np.ndarray
    term_at: np.ndarray
    node: np.ndarray
    most: np.ndarray
    reach: np.ndarray
    ids: np.ndarray
    m: np.ndarray
    at: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray
    gain: np.ndarray


def _shared(ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many leading terms each document shares with the one before it."""
    sizes = np.diff(at)
    out = np.zeros(len(sizes), np.int64)
    alive, depth = np.arange(1, len(sizes)), 0
    while len(alive):
        alive = alive[np.minimum(sizes[alive - 1], sizes[alive]) > depth]
        alive = alive[ranks[at[alive - 1] + depth] == ranks[at[alive] + depth]]
        depth += 1
        out[alive] = depth
    return out


def _nodes(shared: np.ndarray) -> tuple[list[int], list[int], list[int], list[list[int]]]:
    """Nodes of the trie without unary ones: intervals of documents, depth-first, with depth and children.

    Small neighbouring subtrees of one parent share a leaf, so there are about as many nodes as documents divided by
    ``LEAF_DOCS`` where paths are short.
    """
    first, last, depth, children = [0], [len(shared)], [0], [[]]
    stack = [0]
    while stack:
        parent = stack.pop()
        a, b = first[parent], last[parent]
        if b - a <= LEAF_DOCS:
            continue
        inner = shared[a + 1 : b]
        cuts = [a, *(np.flatnonzero(inner == inner.min()) + a + 1).tolist(), b]
        # A group of copies shares everything: cut it evenly, its parts differ in m and ids alone.
        if len(cuts) == b - a + 1:
            cuts = [*range(a, b, LEAF_DOCS), b]
        start = cuts[0]
        for left, right in zip(cuts[:-1], cuts[1:], strict=True):
            if right - left > LEAF_DOCS or right - start > LEAF_DOCS:
                spans = [(start, left), (left, right)] if left > start else [(left, right)]
                if right - left <= LEAF_DOCS:
                    spans, start = spans[:1], left
                else:
                    start = right
                for span in spans:
                    children[parent].append(len(first))
                    stack.append(len(first))
                    first.append(span[0])
                    last.append(span[1])
                    depth.append(depth[parent] + 1)
                    children.append([])
        if start < b:
            children[parent].append(len(first))
            stack.append(len(first))
            first.append(start)
            last.append(b)
            depth.append(depth[parent] + 1)
            children.append([])
    return first, last, depth, children


def build_trie(ids: np.ndarray, m: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> Trie:
    """``vectors`` hold, per document, its ranks in rising order and their counts."""
    keys = [r.astype(">i4").tobytes() for r, _ in vectors]
    order = sorted(range(len(keys)), key=lambda i: (keys[i], ids[i]))
    ranks = np.concatenate([vectors[i][0] for i in order]).astype(np.intp)
    counts = np.concatenate([vectors[i][1] for i in order]).astype(np.int64)
    at = np.concatenate([[0], np.cumsum([len(vectors[i][0]) for i in order])])
    ids, m = ids[order], m[order]
    first, last, depth, children = _nodes(_shared(ranks, at))
    first, last, depth = np.array(first), np.array(last), np.array(depth)
    leaves = np.array([i for i, c in enumerate(children) if not c])
    parent = np.full(len(first), -1)
    for i, below in enumerate(children):
        parent[below] = i
    # Bounds of the leaves from their documents, then of each depth from the one below it.
    leaf_of = np.empty(len(ids), np.int64)
    for leaf in leaves:
        leaf_of[first[leaf] : last[leaf]] = leaf
    least_m, least_id = np.full(len(first), _NO_ID), np.full(len(first), _NO_ID)
    np.minimum.at(least_m, leaf_of, m)
    np.minimum.at(least_id, leaf_of, ids)
    span = np.int64(n_terms)
    held = _maxima(np.repeat(leaf_of, np.diff(at)) * span + ranks, counts)
    found = []
    for level in range(int(depth.max()), -1, -1):
        here = depth[held[0] // span] == level
        done = held[0][here], held[1][here]
        found.append(done)
        if level:
            up = parent[done[0] // span] * span + done[0] % span
            held = _maxima(np.concatenate([held[0][~here], up]), np.concatenate([held[1][~here], done[1]]))
            nodes = np.flatnonzero(depth == level)
            np.minimum.at(least_m, parent[nodes], least_m[nodes])
            np.minimum.at(least_id, parent[nodes], least_id[nodes])
    key, most = np.concatenate([k for k, _ in found]), np.concatenate([v for _, v in found])
    by_term = np.argsort(key % span, kind="stable")
    term_at = np.searchsorted((key % span)[by_term], np.arange(n_terms + 1))
    node, most = (key // span)[by_term], most[by_term]
    kids = [np.array(c, np.int64) for c in children]
    reach, gain = gains(most, least_m[node]), gains(counts, np.repeat(m, np.diff(at)))
    return Trie(first, last, kids, least_m, least_id, term_at, node, most, reach, ids, m, at, ranks, counts, gain)


def _maxima(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.maximum.reduceat(values, starts)


def gains(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term contributes per unit of weight: rises with its count, falls with m."""
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


def search_trie(trie: Trie, ranks: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, top: list[tuple[int, int]], most: int = TOP) -> int:
    """Update ``top``, a heap of (score, -id) of at most ``most`` documents; returns how many documents were scored.

    ``weight_of`` is a table over all ranks, zero outside of ``ranks``.
    """
    bound = np.zeros(len(trie.first), np.int64)
    for a, b, weight in zip(trie.term_at[ranks].tolist(), trie.term_at[ranks + 1].tolist(), weights.tolist(), strict=True):
        # A term stands once per node.
        bound[trie.node[a:b]] += weight * trie.reach[a:b]
    scored = 0
    stack = [0]
    while stack:
        node = stack.pop()
        if bound[node] <= 0 or (len(top) == most and (bound[node], -trie.least_id[node]) <= top[0]):
            continue
        below = trie.children[node]
        least = top[0][0] if len(top) == most else 1
        if len(below):
            # The most promising child is walked first.
            below = below[bound[below] >= least]
            stack += below[np.lexsort((-trie.least_id[below], bound[below]))].tolist()
            continue
        a, b = trie.first[node], trie.last[node]
        scored += int(b - a)
        lo, hi = trie.at[a], trie.at[b]
        score = np.add.reduceat(weight_of[trie.ranks[lo:hi]] * trie.gain[lo:hi], trie.at[a:b] - lo)
        for i in np.flatnonzero(score >= least).tolist():
            entry = (int(score[i]), -int(trie.ids[a + i]))
            if len(top) < most:
                heapq.heappush(top, entry)
            elif entry > top[0]:
                heapq.heapreplace(top, entry)
    return scored


def _searched(plan, n_docs: int, n_all: int, most: int):
    """Search all items in the documents of a task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of, items = plan.value
        n_terms = len(rank_of)
        tops: dict[int, list[tuple[int, int]]] = {item: [] for item, _, _ in items}
        weight_of = np.zeros(n_terms, np.int64)

        def flush(ids, m, vectors):
            trie = build_trie(np.array(ids, np.int64), np.array(m, np.int64), vectors, n_terms)
            for item, ranks, weights in items:
                weight_of[ranks] = weights
                search_trie(trie, ranks, weights, weight_of, tops[item], most)
                weight_of[ranks] = 0

        ids, m, vectors, held = [], [], [], 0
        for batch in batches:
            found = zip(*[batch.column(c) for c in ("id", "n", "terms", "counts")], strict=True)
            for doc, n, terms, counts in found:
                ranks = rank_of[terms.values.to_numpy()]
                order = np.argsort(ranks)
                ids.append(doc.as_py() if doc.is_valid else _NO_ID)
                m.append(25 + 75 * n.as_py() * n_docs // n_all)
                vectors.append((ranks[order], counts.values.to_numpy()[order]))
                held += len(ranks)
                if len(ids) >= CHUNK_DOCS or held >= CHUNK_ENTRIES:
                    flush(ids, m, vectors)
                    ids, m, vectors, held = [], [], [], 0
        if ids:
            flush(ids, m, vectors)
        rows = [(item, None if low == -_NO_ID else -low, score) for item, top in tops.items() for score, low in top]
        yield pa.RecordBatch.from_pylist([dict(zip(("item", "id", "score"), r, strict=True)) for r in rows], pa.schema([("item", pa.int64()), ("id", pa.int64()), ("score", pa.int64())]))

    return search


def _best(found: DataFrame, groups: list[str | Column], most: int) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _block(docs: DataFrame, pairs: list, most: int) -> DataFrame:
    """The best documents of the items in ``pairs`` (item, term, q)."""
    context = docs.sparkSession.sparkContext
    vocabulary = sorted({p.term.encode() for p in pairs})
    shared = context.broadcast(vocabulary)
    with small_batches(docs.sparkSession):
        vectors = stored(docs.mapInArrow(_vectors(shared), "id long, n long, terms array<int>, counts array<int>"), "search-vectors")
    found = F.size("terms")
    totals = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("all"), F.count_if(found > 0).alias("rows"), F.sum(found).alias("entries")).first()
    # At most one row per term of the block.
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    n_docs, n_all = totals["docs"], totals["all"] or 0
    order = np.argsort(-df, kind="stable")
    rank_of = np.empty(len(df), np.int32)
    rank_of[order] = np.arange(len(df))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()]
    number = {t: i for i, t in enumerate(vocabulary)}
    of_item: dict[int, list[tuple[int, int]]] = {}
    for p in pairs:
        t = number[p.term.encode()]
        if weight[t]:
            of_item.setdefault(p.item, []).append((int(rank_of[t]), p.q * weight[t]))
    items = [(item, np.array([r for r, _ in sorted(v)], np.int64), np.array([w for _, w in sorted(v)], np.int64)) for item, v in of_item.items()]
    plan = context.broadcast((rank_of, items))
    # A task holds one trie, however the tables grow.
    tasks = math.ceil(max((totals["rows"] or 0) / TASK_DOCS, (totals["entries"] or 0) / CHUNK_ENTRIES, 1))
    rows = vectors.filter(F.size("terms") > 0).repartition(tasks)
    found = stored(rows.mapInArrow(_searched(plan, n_docs, n_all, most), "item long, id long, score long"), "search-lists", 512)
    shared.unpersist()
    return _best(_best(found, ["item", F.pmod(F.xxhash64("id"), F.lit(MERGE_GROUPS))], most), ["item"], most)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``most`` best documents of each item row with a score above 0, equal scores
    by rising id.

    Null and empty texts have no terms: such items have no rows, such documents are never found and count neither as
    documents nor by length. Every row counts, so equal documents are ranked one after the other and a repeated item is
    answered for each of its rows. Ids are whole numbers; documents without one come after all equal scores. Other
    columns are not read; empty tables give an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pairs = stored(item_terms(items, item_col, item_text), "search-terms")
    total = pairs.count()
    blocks = max(1, math.ceil(total / BLOCK_TERMS))
    part = F.pmod(F.xxhash64("item"), F.lit(blocks))
    names = pairs.select(F.col("item").alias("i"), "item_id").distinct()
    out = None
    for block in range(blocks):
        mine = pairs.filter(part == block).select("item", "term", "q").collect()
        found = _block(texts, mine, most)
        out = found if out is None else out.unionByName(found)
    return out.join(names, F.col("item") == F.col("i")).select("item_id", "rank", F.col("id").alias("doc_id"), "score")
