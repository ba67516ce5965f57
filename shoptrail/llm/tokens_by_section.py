"""Token counts by section, by offset-mapped attribution.

A whole document is encoded once, so tokens are those a model would see. Each token's span of
characters is then joined with the spans of the document's sections. A token that crosses a boundary
goes to one section by an explicit rule, so section counts add up to the document's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shoptrail.llm.bpe import GROUP_ROWS, codec_maker
from shoptrail.llm.common import free_name, slices, texts_of

#: Rules for a token that crosses a boundary: the section of its first character, of its last one, or
#: the one with most of its characters (ties: the earlier).
FIRST, LAST, MOST = "first", "last", "most"


def token_spans(lengths: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points [begin, end) that each token touches, from the tokens' lengths in bytes; a
    character split between tokens belongs to each of them."""
    ends = np.cumsum(lengths)
    if text.isascii():
        return ends - lengths, ends
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    char = np.cumsum((data & 0xC0) != 0x80) - 1  # character that each byte belongs to
    return char[ends - lengths], char[ends - 1] + 1


def attribute(begins: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = FIRST) -> np.ndarray:
    """Number of the section that each token is counted for. ``bounds`` are the sections' starts, the
    first 0; sections leave no gaps."""
    low = np.searchsorted(bounds, begins, side="right") - 1
    high = np.searchsorted(bounds, ends - 1, side="right") - 1
    if rule == FIRST:
        return low
    if rule == LAST:
        return high
    out = low.copy()
    for i in np.flatnonzero(low != high):
        edges = np.clip(np.append(bounds[low[i] : high[i] + 1], ends[i]), begins[i], ends[i])
        out[i] = low[i] + int(np.diff(edges).argmax())
    return out


def count_first(begins: np.ndarray, ends: np.ndarray, bounds: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section under ``FIRST``, and how many of them reach beyond it. Both sides are sorted, so it is
    enough to look the sections up among the tokens."""
    low = np.searchsorted(begins, bounds)
    high = np.append(low[1:], len(begins))
    within = np.searchsorted(ends, stops, side="right")
    return high - low, np.maximum(high - np.maximum(low, within), 0)


def line_starts(text: str) -> np.ndarray:
    """Sections are lines; a line has its line break."""
    return np.asarray([0, *accumulate(len(line) + 1 for line in text.split("\n"))][:-1])


def count_by_section(
    docs: DataFrame, rank_file: str, pattern: str, rule: str = FIRST, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """One row per section: (id, section, start, end, n_tokens, n_crossing).

    ``start`` and ``end`` are code points of the original text; ``n_crossing`` tokens of the section reach
    beyond it. Null and empty texts have one empty section without tokens. Rows are worked on alone, so
    repeated ones give the same sections each; no shuffle.
    """
    make = codec_maker(docs, rank_file, pattern)

    def work() -> Callable:
        codec = make()
        size = np.asarray([len(codec.token.get(i, b"")) for i in range(max(codec.token) + 1)])

        def one(value: str, ids: bytes) -> tuple[np.ndarray, ...]:
            bounds = line_starts(value)
            stops = np.append(bounds[1:], len(value))
            counts = crossing = np.zeros(len(bounds), np.int64)
            if value:
                begins, ends = token_spans(size[np.frombuffer(ids, np.uint32)], value)
                if rule == FIRST:
                    counts, crossing = count_first(begins, ends, bounds, stops)
                else:
                    owner = attribute(begins, ends, bounds, rule)
                    over = (ends > stops[owner]) | (begins < bounds[owner])
                    counts = np.bincount(owner, minlength=len(bounds))
                    crossing = np.bincount(owner[over], minlength=len(bounds))
            return np.arange(len(bounds)), bounds, stops, counts, crossing

        return lambda texts: list(map(one, texts, codec.encode_all(texts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = work()
        for part in slices(batches, GROUP_ROWS):
            found = every([value or "" for value in texts_of(part.column(1))])
            rows = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            columns = [np.concatenate(x) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows)), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=[id_column, "section", "start", "end", "n_tokens", "n_crossing"],
            )

    narrow = docs.select(F.col(id_column), F.col(text).alias(free_name(docs, "text_")))
    kind = docs.schema[id_column].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"`{id_column}` {kind}, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint"
    )
