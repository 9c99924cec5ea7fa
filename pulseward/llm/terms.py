"""Terms of texts as Arrow arrays: maximal runs of ASCII letters and digits and of everything beyond ASCII, A-Z
lower-cased; and tables of query rows, cut into blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_TERM = ((_BYTES >= 48) & (_BYTES <= 57)) | _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def _bounds(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mask of the bytes in terms, start of every term, index of the first term of every text and the total)."""
    inside = _TERM[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = off[:-1][off[:-1] < len(raw)]
    first[begins] = inside[begins]   # a term ends where its text ends
    starts = np.flatnonzero(first)
    return inside, starts, np.searchsorted(starts, off)


def count_terms(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of terms of every text; ``raw``, ``off``: see ``textnum.text_bytes``."""
    return np.diff(_bounds(raw, off)[2])


def terms_of(raw: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all terms, one after another; index of the first term of every text and the total)."""
    inside, starts, first = _bounds(raw, off)
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(inside, out=before[1:])
    edges = np.append(before[starts], before[-1])
    data = _LOWER[raw[inside]]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(data)), first


def query_blocks(rows: DataFrame, pack: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                 schema: str, block_bytes: int, name: str) -> Iterator[pa.Table]:
    """The query rows as blocks, one after another on the driver: ``pack`` makes rows (``schema``, with a long
    column ``size``) of which each is a bounded piece of a query. A block holds rows of at most ``block_bytes``
    together, or a single one. Only one block at a time leaves the cluster, however many queries there are."""
    pieces = stage(rows.mapInArrow(pack, schema).withColumn("piece", F.monotonically_increasing_id()), name)
    sizes = pieces.select("piece", "size").orderBy("piece").toLocalIterator(prefetchPartitions=True)
    lo, last, total = None, None, 0
    for r in sizes:
        if lo is not None and total + r["size"] > block_bytes:
            yield pieces.where(F.col("piece").between(lo, last)).toArrow()
            lo, total = None, 0
        lo, last, total = r["piece"] if lo is None else lo, r["piece"], total + r["size"]
    if lo is not None:
        yield pieces.where(F.col("piece").between(lo, last)).toArrow()
