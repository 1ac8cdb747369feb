"""Arrow batches in and out of ``mapInArrow`` functions, and hashing of words in them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows are handed on in slices of about this many bytes of text, whatever the size of Spark's batches.
SLICE_BYTES = 4 << 20
#: A worker forgets its remembered words beyond this many; it only has to work them out again.
REMEMBERED = 250_000


def slices(batches: Iterable[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices whose ``text`` column (texts or lists of texts) has about ``size`` bytes; one row at least."""
    for batch in batches:
        column = batch.column(text)
        if pa.types.is_list(column.type):
            sizes = np.array([sum(map(len, v or ())) for v in column.to_pylist()], np.int64)
        else:
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.cumsum(sizes) // size
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)


def mapped(work: Callable[[pa.RecordBatch], dict[str, object] | None], text: str, schema: pa.Schema, size: int = SLICE_BYTES):
    """A function for ``mapInArrow``: ``work`` makes the columns of the output from a slice of the input.

    Lists become arrays of the types of ``schema``; Arrow arrays are passed on with the type they have.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text, size):
            made = work(piece)
            if made is not None:
                arrays = [made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], type=f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return run


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        self[word] = found
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words, in order; with fewer words one for them all, without words none."""
    if not len(words):
        return words
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - width + 1 + k]
    return mixed(total)
