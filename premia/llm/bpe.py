"""Byte-level BPE: encode texts with a local rank file and decode ids to raw bytes.

The tiktoken library merges; this module feeds it. A long text is cut before it reaches the library, always at a
place where no match of the split pattern can span and none can look across: between a character that is not white
space and a white space character. Runs without such a place (one enormous word, or a very long stretch of white
space, on which the library's pattern engine overflows) are matched with the ``regex`` module instead and their pieces
merged one by one. So memory and time per call stay bounded while ids equal those of one call on the whole text.

Null texts count as empty and give no ids. Repeated rows give repeated results. Extra columns are ignored unless they
are named in ``keep``. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from premia.llm.common import slices, text_of

#: Texts up to this many characters go to the library in one call; longer ones are cut near multiples of it.
CHUNK = 1 << 15
#: Without a safe place this many characters after a cut was due, the stretch is matched piece by piece.
REACH = 1 << 15

# The control characters are left out because engines differ on whether they are white space.
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \t\r\n])")


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The encoding of a rank file; loaded once per Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _pieces(pattern: str):
    return regex.compile(pattern)


def chunks(text: str, size: int = CHUNK, reach: int = REACH) -> Iterator[tuple[str, bool]]:
    """Cut a text at safe places; the flag tells that a chunk is a stretch without one and must be matched alone."""
    start, end = 0, len(text)
    while end - start > size:
        cut = _SAFE.search(text, start + size, min(end, start + size + reach))
        if cut is None:
            cut = _SAFE.search(text, start + size)
            stop = cut.start() if cut else end
            yield text[start:stop], stop - start > size + reach
            start = stop
            continue
        yield text[start : cut.start()], False
        start = cut.start()
    if start < end:
        yield text[start:], False


def encode_text(enc, pattern: str, text: str, size: int = CHUNK, reach: int = REACH) -> np.ndarray:
    """Ids of one whole text, as the library would give them without special tokens."""
    if len(text) <= size:
        return np.asarray(enc.encode_ordinary(text), np.int32)
    parts = []
    for chunk, alone in chunks(text, size, reach):
        if not alone:
            parts.append(np.asarray(enc.encode_ordinary(chunk), np.int32))
            continue
        for match in _pieces(pattern).finditer(chunk):
            parts.append(np.asarray(enc._encode_single_piece(match.group().encode()), np.int32))
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decoded: bool = False
) -> DataFrame:
    """One row per row of ``docs``: its id, the columns of ``keep``, and ``ids`` (array of int).

    With ``decoded`` it has the column that ``decode`` adds, too, made in the same pass: a task then needs one Python
    worker with one copy of the ranks, where ``decode`` after ``encode`` needs two of them at once.
    """
    kept = [id_col, *[c for c in keep if c != id_col]]
    given = docs.select(*[docs[c] for c in kept], text_of(text_col).alias("__text"))
    fields = [*given.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for part in slices(batch, "__text"):
                ids = [encode_text(enc, pattern, t.as_py()) for t in part.column(len(kept))]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                raw = [pa.array([enc.decode_bytes(x.tolist()) for x in ids], pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, *raw], names=names)

    return given.mapInArrow(run, T.StructType(fields))


def decode(tokens: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary): the raw bytes that the ids stand for; they need not be valid UTF-8.

    A null list gives null. An id that is no rank raises.
    """
    if "decoded" in tokens.columns:
        raise ValueError("the table already has a column 'decoded'")
    place = tokens.columns.index(ids_col)
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.BinaryType())])
    names = [*tokens.columns, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                raw = [None if not x.is_valid else enc.decode_bytes(x.values.to_numpy().tolist()) for x in part.column(place)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=names)

    return tokens.mapInArrow(run, schema)
