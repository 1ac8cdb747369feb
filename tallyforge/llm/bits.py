"""Sets of 64-bit hashes as bits of bounded size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sketch takes 16 bits for each of its members, at most 2**29 (64 MB); false hits are only extra work.
MOST_BITS = 29


class Sketch:
    """A set as bits; what is not in it may be found, never the other way round."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def has(self, found: np.ndarray) -> np.ndarray:
        at = (found & self.mask).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def sketch_of(found: DataFrame, mark: str = "mark") -> Sketch:
    """The sketch of the ``mark long`` rows; bits are set in the tasks, and at most 2**``MOST_BITS`` of them are fetched."""
    power = min(MOST_BITS, max(16, int(16 * found.count()).bit_length()))
    at = F.col(mark).bitwiseAND((1 << power) - 1) + 1
    blocks = found.groupBy(F.bitmap_bucket_number(at).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(1 << (power - 3), np.uint8)
    for block, part in blocks.toLocalIterator():
        start = (block - 1) << 12
        held = np.frombuffer(part, np.uint8)[: len(bits) - start]
        bits[start : start + len(held)] = held
    return Sketch(bits)
