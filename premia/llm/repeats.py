"""Byte repeats across documents by suffix arrays of content-defined groups.

Every string of ``length`` bytes is assigned to its anchor, the smallest hash of its ``ANCHOR``-byte substrings, so
equal strings share an anchor wherever they stand. Consecutive strings with one anchor form a piece.

First hashes alone are exchanged, by anchor: a piece that a smaller document has, too, is removed as a whole, and of the
others those count whose anchor has different pieces in several documents. Only the bytes of these are sent: they are
gathered by anchor, a suffix array of each anchor's pieces (``suffixes``) brings equal strings together, and their bytes
are compared. Stretches of a piece in which no string has both halves in common with another one cannot hold a repeat and
stay out of the suffix arrays. A string of a document is removed if it starts in a document with a smaller id too,
whichever other strings are removed.

So copies cost disk for their hashes only: a passage that a third of all documents hold reaches its group once. Texts meet
their tags, and pieces their groups, in ``ROUNDS`` parts one after the other, so that the files of one part's exchange
are there at a time.

Anchors with more than ``most_documents`` different pieces, or with more than about ``most_bytes`` bytes of them, which
could be too many for one group, are gathered by string instead of by anchor, and equal strings are combined before the
shuffle; results do not depend on that. So what a task holds of a group is bounded even where few long documents have all
of its pieces.

Texts are UTF-8 bytes; null counts as empty. Matches never cross documents. Rows that repeat an id are one document
each: they never remove each other's bytes. Rows without an id neither lose bytes nor remove any. Texts shorter than
``length`` bytes are untouched. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.llm.common import byte_rows, discard, mixed, powers, run_hashes, slices, stored, text_of
from premia.llm.suffixes import _spread, suffix_orders

#: Bytes of the substrings whose hashes compete for being the anchor.
ANCHOR = 16
#: Piece bytes whose suffix arrays are built in one go.
BATCH_BYTES = 1 << 20
#: Strings of anchors gathered by string that a task handles at once, and keys of pieces that it remembers.
STRINGS, MOST_KNOWN = 1 << 17, 1 << 22
#: Parts in which texts meet their tags and pieces their groups.
ROUNDS = 2
#: A tag is a hash of a piece with its size class in four bits; the lowest bits tell an id's texts apart or what to do.
LOW_BITS = 12
CUT, WHOLE, SINGLE = range(3)
_FACTOR = 0x9E3779B97F4A7C15


def pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row, start and stop of each piece; ``data`` holds the rows' bytes from ``offsets[i]`` to the next."""
    size = min(ANCHOR, length)
    if len(data) < length:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_FACTOR, len(data)), out=sums[1:])
    grams = mixed((sums[size:] - sums[:-size]) * powers(pow(_FACTOR, -1, 1 << 64), len(data) - size + 1))
    width, span = length - size + 1, 1
    while 2 * span <= width:
        grams = np.minimum(grams[:-span], grams[span:])
        span *= 2
    if span < width:
        grams = np.minimum(grams[: len(grams) - (width - span)], grams[width - span :])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(grams)]
    inside = offsets[1:][row] - np.arange(len(grams)) >= length
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    last = np.ones(len(grams), bool)
    last[:-1] = new[1:] | ~inside[1:]
    starts, lasts = np.flatnonzero(new & inside), np.flatnonzero(last & inside)
    return grams[starts], row[starts], starts, lasts + length


def _united(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching intervals of a row become one."""
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    if not len(row):
        return row, start, stop
    # Stops are made comparable across rows, so that one running maximum serves all of them.
    shift = row.astype(np.int64) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + shift)
    new = np.append(True, (start + shift)[1:] > reach[:-1])
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(row)) - 1
    return row[firsts], start[firsts], reach[lasts] - shift[lasts]


def _piece_keys(data: np.ndarray, anchor: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of each piece's bytes and anchor."""
    return mixed(anchor ^ mixed(_hashes_near(data, start, stop) + (stop - start).astype(np.uint64)))


def _tags(data: np.ndarray, anchor: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The tag of each piece, without its lowest bits."""
    size_class = np.searchsorted(64 << np.arange(15), stop - start).astype(np.uint64)
    hashed = _piece_keys(data, anchor, start, stop) >> np.uint64(LOW_BITS + 4)
    return (hashed << np.uint64(4) | size_class) << np.uint64(LOW_BITS)


def _sizes(tags: np.ndarray) -> np.ndarray:
    """The bytes that the tags' size classes stand for: those of the largest piece."""
    return 64 << (tags >> LOW_BITS & 15)


def _in_row(row: np.ndarray, tags: np.ndarray) -> np.ndarray:
    return mixed(tags + mixed(row.astype(np.uint64) + np.uint64(1)))


def _document_anchors(docs: DataFrame, length: int) -> DataFrame:
    """Each document's different pieces: anchor, and the tag with the lowest bits of the text's hash as ``th``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = byte_rows(part.column(2))
                anchor, row, start, stop = pieces(data, offsets, length)
                if not len(anchor):
                    continue
                tags = _tags(data, anchor, start, stop)
                at = np.unique(_in_row(row, tags), return_index=True)[1]
                at.sort()
                row, tags = row[at], tags[at].view(np.int64) | part.column(1).to_numpy()[row[at]] & (1 << LOW_BITS) - 1
                yield pa.RecordBatch.from_arrays([pa.array(anchor[at].view(np.int64)), part.column(0).take(pa.array(row)), pa.array(tags)], names=["anchor", "doc", "th"])

    return docs.mapInArrow(run, "anchor long, doc long, th long")


def _shared_anchors(anchors: DataFrame, most_documents: int, most_bytes: int) -> DataFrame:
    """The rows of anchors that several documents have, and whether their anchor is to be gathered by string.

    Rows come sorted by anchor. An anchor's rows wait for its last one, or until there are too many of them for one group:
    from then on they pass as those of a shared anchor, which at worst sends strings that no other document has.

    Without a size ``th`` is a tag. Then rows whose piece a smaller document has, too, go at once with null for the
    second, and only the others count as rows of the anchor.
    """
    tagged = "size" not in anchors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passing = np.zeros((4, 0), np.int64), None

        def table(rows: np.ndarray, many: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array(c) for c in rows[:3]), many], names=["anchor", "doc", "th", "many"])

        def parted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The rows of each piece's smallest document, and the others."""
            anchor, doc, th, _ = rows = rows[:, np.lexsort((rows[1], rows[2] >> LOW_BITS, rows[0]))]
            piece = th >> LOW_BITS
            new = np.append(True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]))
            later = doc > doc[new][np.cumsum(new) - 1]
            return rows[:, ~later], rows[:, later]

        def judged(rows: np.ndarray, last: bool) -> pa.RecordBatch:
            nonlocal held, passing
            anchor, doc, _, size = rows
            at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            n = np.diff(np.append(at, len(anchor)))
            many = (n > most_documents) | (np.add.reduceat(size, at) > most_bytes)
            shared = np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
            if passing == anchor[0]:
                many[0] = shared[0] = True
            held, passing = rows[:, :0], None
            if not last and many[-1]:
                shared[-1], passing = True, anchor[-1]
            elif not last:
                shared[-1], held = False, rows[:, at[-1] :].copy()
            stays = np.repeat(shared, n)
            return table(rows[:, stays], pa.array(np.repeat(many, n)[stays]))

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            rows = np.concatenate([held, np.stack([*columns, _sizes(columns[2])] if tagged else columns)], axis=1)
            if tagged:
                rows, later = parted(rows)
                yield table(later, pa.nulls(later.shape[1], pa.bool_()))
            yield judged(rows, False)
        if held.shape[1]:
            yield judged(held, True)

    return anchors.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "anchor long, doc long, th long, many boolean")


_FOUND = "key long, doc long, th long, start long, stop long, piece binary"


def _sent(docs: DataFrame, length: int) -> DataFrame:
    """Pieces to be gathered by key, and (with a null key) intervals that are repeats already by the documents' tags or by
    this task's rows."""

    def kinds(row: np.ndarray, tags: np.ndarray, lists: pa.Array) -> np.ndarray:
        """What to do with each piece by the tags of its row, -1 without one."""
        of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        held = lists.values.to_numpy().view(np.uint64)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
        low = np.uint64((1 << LOW_BITS) - 1)
        known = _in_row(of, held & ~low)
        order = np.argsort(known, kind="stable")
        known, kind, wanted = known[order], (held & low).astype(np.int64)[order], _in_row(row, tags)
        place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return np.where(known[place] == wanted, kind[place], -1)

    def found(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, n_cut: int, anchor: np.ndarray, rows: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.RecordBatch:
        """Rows of which the first ``n_cut`` are intervals and the others, with their ``anchor``, pieces."""
        sizes = stops[n_cut:] - starts[n_cut:]
        bounds = np.concatenate([np.zeros(n_cut + 1, np.int64), np.cumsum(sizes)]).astype(np.int32)
        flat = data[_spread(starts[n_cut:], sizes)]
        cut = np.arange(len(rows)) < n_cut
        binary = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(bounds), pa.py_buffer(flat.tobytes())])
        take = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(np.zeros(n_cut, np.uint64), anchor).view(np.int64), mask=cut),
                part.column(0).take(take),
                part.column(1).take(take),
                pa.array(starts - offsets[rows]),
                pa.array(np.where(cut, stops - offsets[rows], 0)),
                binary,
            ],
            names=["key", "doc", "th", "start", "stop", "piece"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, least = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def combined(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, anchor: np.ndarray, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
            """Rows for pieces of one slice, with what this task has met before."""
            nonlocal known, least
            doc = part.column(0).to_numpy()[row]
            key = _piece_keys(data, anchor, start, stop)
            if len(known) > MOST_KNOWN:
                # What is forgotten is sent once more; its group finds it.
                known, least = known[:0], least[:0]
            order = np.lexsort((doc, key))
            lead = order[np.append(True, key[order][1:] != key[order][:-1])]
            place = np.searchsorted(known, key[lead])
            met = np.zeros(len(lead), bool)
            if len(known):
                met = known[np.minimum(place, len(known) - 1)] == key[lead]
            least[place[met]] = np.minimum(least[place[met]], doc[lead[met]])
            known, least = (np.insert(old, place[~met], new[lead[~met]]) for old, new in ((known, key), (least, doc)))
            later = doc > least[np.searchsorted(known, key)]
            r, a, b = _united(row[later], start[later], stop[later])
            first = ~later
            return found(part, data, offsets, len(r), anchor[first], np.append(r, row[first]), np.append(a, start[first]), np.append(b, stop[first]))

        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = byte_rows(part.column(2))
                anchor, row, start, stop = pieces(data, offsets, length)
                if not len(anchor):
                    continue
                kind = kinds(row, _tags(data, anchor, start, stop), part.column(3))
                cut, whole, single = (kind == k for k in (CUT, WHOLE, SINGLE))
                if cut.any():
                    r, a, b = _united(row[cut], start[cut], stop[cut])
                    yield found(part, data, offsets, len(r), anchor[:0], r, a, b)
                if whole.any():
                    yield combined(part, data, offsets, *(x[whole] for x in (anchor, row, start, stop)))
                if not single.any():
                    continue
                anchor, row, start, n = anchor[single], row[single], start[single], (stop - start - length + 1)[single]
                ends = np.cumsum(n)
                for low in range(0, int(n.sum()), STRINGS):
                    number = np.arange(low, min(low + STRINGS, int(ends[-1])))
                    of = np.searchsorted(ends, number, side="right")
                    at = start[of] + number - (ends - n)[of]
                    yield combined(part, data, offsets, mixed(anchor[of] ^ _hashes_near(data, at, at + length)), row[of], at, at + length)

    return docs.mapInArrow(run, _FOUND)


def _hashes_near(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """``run_hashes`` that reads only from the first start to the last stop."""
    low, high = int(starts.min()), int(stops.max())
    return run_hashes(data[low:high], starts - low, stops - low)


def _windows_equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings of ``length`` bytes at places ``a`` and ``b`` are equal."""
    same = np.ones(len(a), bool)
    width = min(8, length)
    words = np.lib.stride_tricks.sliding_window_view(data, width)
    for k in [*range(0, length - width, width), length - width]:
        open_rows = np.flatnonzero(same)
        same[open_rows] = (words[a[open_rows] + k] == words[b[open_rows] + k]).all(axis=1)
    return same


def _distinct(key: np.ndarray, doc: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each string its number among the different ones of its key; for each of these a string that is it, held by
    the smallest document, and whether its key has others."""
    hashes = run_hashes(data, starts, stops)
    order = np.lexsort((doc, hashes, key))
    k, h = key[order], hashes[order]
    new = np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]))
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    lead = order[new]
    head = np.append(True, key[lead][1:] != key[lead][:-1])
    group = np.cumsum(head) - 1
    return which, lead, np.bincount(group)[group] > 1


def _candidates(key: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of the strings (number, start, stop) of which each part may stand in another string of the key, too:
    both halves of every string of ``length`` bytes in them occur more than once."""
    n = stops - starts - length + 1
    at, of = _spread(starts, n), np.repeat(np.arange(len(starts)), n)
    may = np.ones(len(at), bool)
    middle = length // 2
    for low, high in ((0, middle), (middle, length)):
        tags = mixed(run_hashes(data, at + low, at + high) ^ mixed(key[of].view(np.uint64)))
        _, back, counts = np.unique(tags, return_inverse=True, return_counts=True)
        may &= counts[back] > 1
    at, of = at[may], of[may]
    if not len(at):
        return of, at, at
    new = np.append(True, (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1]))
    firsts = np.flatnonzero(new)
    return of[firsts], at[firsts], at[np.append(firsts[1:], len(at)) - 1] + length


def _smaller_elsewhere(key: np.ndarray, least: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, first and last byte (from its start) of each run of repeats in different strings of whole keys, by the
    order of all their suffixes. Strings come sorted by key; ``least`` is the smallest document of each."""
    sizes = stops - starts
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    symbols = np.ones(int(ends[-1]), np.int64)
    symbols[_spread(begins, sizes)] = data[_spread(starts, sizes)].astype(np.int64) + 2
    lasts = np.append(np.flatnonzero(key[1:] != key[:-1]), len(key) - 1)
    symbols[ends[lasts] - 1] = 0
    places = suffix_orders(symbols, np.concatenate([[0], ends[lasts]]))
    string = np.repeat(np.arange(len(key)), sizes + 1)
    left = ends[string] - 1 - np.arange(len(symbols))
    places = places[left[places] >= length]
    text = np.where(symbols >= 2, symbols - 2, 0).astype(np.uint8)
    owner = least[string[places]]
    apart = np.append(True, key[string[places]][1:] != key[string[places]][:-1])
    near = np.flatnonzero(~apart)
    apart[near] = ~_windows_equal(text, places[near - 1], places[near], length)
    at = np.flatnonzero(apart)
    smallest = np.repeat(np.minimum.reduceat(owner, at), np.diff(np.append(at, len(places))))
    hit = np.sort(places[smallest < owner])
    from_start = hit - begins[string[hit]]
    return _united(string[hit], from_start, from_start + length)


def repeated(key: np.ndarray, doc: np.ndarray, data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last (exclusive) byte within the row's piece of every run of repeated strings.

    Rows are pieces of whole groups with the same key: ``data[bounds[i]:bounds[i + 1]]`` of document ``doc[i]``.
    """
    which, lead, many = _distinct(key, doc, data, bounds[:-1], bounds[1:])
    least = doc[lead]
    whole = np.flatnonzero(doc > least[which])
    rows, firsts, lasts = [whole], [np.zeros(len(whole), np.int64)], [(bounds[1:] - bounds[:-1])[whole]]
    leaders = np.flatnonzero(doc == least[which])
    leaders = leaders[np.argsort(which[leaders], kind="stable")]

    def add(piece: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Runs of a piece hold for every row with the piece's smallest document."""
        low, high = (np.searchsorted(which[leaders], piece, side=s) for s in ("left", "right"))
        rows.append(leaders[_spread(low, high - low)])
        firsts.append(np.repeat(first, high - low))
        lasts.append(np.repeat(last, high - low))

    piece = np.flatnonzero(many)
    if len(piece):
        at = lead[piece]
        of, starts, stops = _candidates(key[at], data, bounds[:-1][at], bounds[1:][at], length)
        piece, origin = piece[of], bounds[:-1][at][of]
        if len(piece):
            keys, docs = key[lead[piece]], least[piece]
            part, first_of, more = _distinct(keys, docs, data, starts, stops)
            lowest = docs[first_of]
            later = docs > lowest[part]
            add(piece[later], (starts - origin)[later], (stops - origin)[later])
            open_parts = first_of[more]
            if len(open_parts):
                found, a, b = _smaller_elsewhere(keys[open_parts], docs[open_parts], data, starts[open_parts], stops[open_parts], length)
                # Every stretch that is this string, in a piece with the same smallest document, has these runs.
                number = np.flatnonzero(more)[found]
                same = np.flatnonzero(~later)
                same = same[np.argsort(part[same], kind="stable")]
                low, high = (np.searchsorted(part[same], number, side=s) for s in ("left", "right"))
                stretch = same[_spread(low, high - low)]
                shift = (starts - origin)[stretch]
                add(piece[stretch], np.repeat(a, high - low) + shift, np.repeat(b, high - low) + shift)
    return np.concatenate(rows), np.concatenate(firsts), np.concatenate(lasts)


def _gathered(sent: DataFrame, length: int) -> DataFrame:
    """Intervals found among the pieces of whole keys; rows come sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def work(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            get = lambda c: rows.column(c).to_numpy()
            data, bounds = byte_rows(rows.column("piece").combine_chunks())
            row, first, last = repeated(get("key"), get("doc"), data, bounds, length)
            doc, th, start = get("doc"), get("th"), get("start")[row]
            # Runs of one text that meet become one: a text of one repeated passage has a string at many places.
            order = np.lexsort((th, doc))
            new = np.append(True, (doc[order][1:] != doc[order][:-1]) | (th[order][1:] != th[order][:-1]))
            text = np.empty(len(doc), np.int64)
            text[order] = np.cumsum(new) - 1
            of, start, stop = _united(text[row], start + first, start + last)
            of = order[new][of]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[of], th[of], start, stop)], names=["doc", "th", "start", "stop"])

        for batch in batches:
            for part in slices(batch, "piece", BATCH_BYTES):
                held.append(part)
                size += pc.sum(pc.binary_length(part.column(5))).as_py()
                if size < BATCH_BYTES:
                    continue
                # The last key may go on in the next batch.
                rows = pa.Table.from_batches(held)
                keys = rows.column("key").to_numpy()
                whole = int(np.searchsorted(keys, keys[-1]))
                if whole:
                    yield work(rows.slice(0, whole))
                    held = rows.slice(whole).to_batches()
                    size = sum(pc.sum(pc.binary_length(x.column(5))).as_py() for x in held)
        if held and (rows := pa.Table.from_batches(held)).num_rows:
            yield work(rows)

    return sent.mapInArrow(run, "doc long, th long, start long, stop long")


def _rounds(column: str) -> list[Column]:
    """Conditions that part rows by a column; null fulfils none."""
    return [F.when(F.col(column).isNotNull(), F.pmod(F.xxhash64(column), F.lit(ROUNDS)) == no) for no in range(ROUNDS)]


def _tagged(docs: DataFrame, tags: DataFrame) -> DataFrame:
    """Documents that have tags, with these and what they ask for in the lowest bits."""
    low = F.lit((1 << LOW_BITS) - 1)
    kind = F.when(F.col("many").isNull(), CUT).when(F.col("many"), SINGLE).otherwise(WHOLE)
    tag = F.col("th").bitwiseAND(F.bitwise_not(low)).bitwiseOR(kind)
    lists = tags.groupBy("doc", F.col("th").bitwiseAND(low).alias("of")).agg(F.collect_list(tag).alias("tags"))
    of = docs.withColumn("of", F.col("th").bitwiseAND(low))
    return of.join(lists, ["doc", "of"]).select("doc", "th", "text", "tags")


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", most_documents: int = 5_000, most_bytes: int = 2 << 20) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``spans`` (maximal removed runs: start and end in bytes) and
    ``kept`` (the bytes that remain)."""
    text = text_of(text_col)
    every = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("th"), F.encode(text, "UTF-8").alias("text"))
    usable = every.filter(F.col("doc").isNotNull() & (F.octet_length("text") >= length))
    tags = stored(_shared_anchors(_document_anchors(usable, length), most_documents, most_bytes).select("doc", "th", "many"), "repeat-documents")
    sent = [stored(_sent(_tagged(usable.filter(own), tags.filter(own)), length), "repeat-pieces") for own in _rounds("doc")]
    discard(tags)
    pieces_of = reduce(DataFrame.unionByName, sent)
    cut = pieces_of.filter(F.col("key").isNull()).select("doc", "th", "start", "stop")
    gathered = [pieces_of.filter(own).repartition("key").sortWithinPartitions("key") for own in _rounds("key")]
    found = [stored(_gathered(part, length), "repeat-found") for part in gathered]
    every_cut = reduce(DataFrame.unionByName, found, cut)
    cuts = stored(every_cut.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "stop")).alias("cuts")), "repeat-cuts")
    discard(*sent, *found)
    return _without(every.join(cuts, ["doc", "th"], "left").select("doc", "text", "cuts"))


def _without(docs: DataFrame) -> DataFrame:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = byte_rows(part.column(1))
                cuts = part.column(2)
                sizes = pc.fill_null(pc.list_value_length(cuts), 0).to_numpy()
                row = np.repeat(np.arange(part.num_rows), sizes)
                flat = cuts.flatten()
                row, start, stop = _united(row, flat.field("start").to_numpy(zero_copy_only=False), flat.field("stop").to_numpy(zero_copy_only=False))
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, start + offsets[row], 1)
                np.add.at(change, stop + offsets[row], -1)
                stays = np.cumsum(change[:-1]) == 0
                left = np.concatenate([[0], np.cumsum(stays)])[offsets]
                kept = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(data[stays].tobytes())])
                places = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))]).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(start.astype(np.int64)), pa.array(stop.astype(np.int64))], names=["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(places), pairs).cast(spans), kept.cast(pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"]
                )

    return docs.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
