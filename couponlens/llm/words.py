"""Words of lower-cased letters and digits, and stated query sets in blocks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a word after A-Z are lower-cased: digits, a-z and all of UTF-8 beyond ASCII. Other bytes become spaces.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Characters of the query texts that are sent to the tasks at once; one longer text is a block of its own.
BLOCK_CHARS = 4_000_000


_SLICE = 1 << 20  # bytes of a text that are split at once


def words(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists: maximal runs of ASCII letters, digits and characters beyond ASCII, with A-Z
    lower-cased. A long text is cut between words."""
    raw = text.encode("utf-8", "replace").translate(_TABLE)
    at = 0
    while len(raw) - at > _SLICE and (to := raw.find(b" ", at + _SLICE)) >= 0:
        yield raw[at:to].split()
        at = to
    yield raw[at:].split()


def numbering() -> defaultdict[bytes, int]:
    """Numbers the words looked up in it, in order of their first appearance."""
    out: defaultdict[bytes, int] = defaultdict()
    out.default_factory = out.__len__
    return out


def numbered(texts: list[str], number: defaultdict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts one after the other, and where each text's words begin."""
    out, begins = [np.zeros(0, np.int64)], np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        for some in words(text):
            out.append(np.fromiter(map(number.__getitem__, some), np.int64, len(some)))
            begins[i + 1] += len(some)
    return np.concatenate(out), np.cumsum(begins)


def query_blocks(items: DataFrame, key: str = "item_id", text: str = "text", limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The rows (id, text) of a stated query set in ascending order, in blocks of about ``limit`` characters. No more than
    a block and the rows that Spark hands over at a time are in the driver. A null text becomes empty."""
    block: list[tuple[int | None, str]] = []
    held = 0
    chosen = items.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    for row in chosen.orderBy("k", "t").toLocalIterator():
        if block and held + len(row.t) > limit:
            yield block
            block, held = [], 0
        block.append((row.k, row.t))
        held += len(row.t)
    if block:
        yield block
