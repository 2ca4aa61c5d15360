"""Benchmark decontamination by Wu-Manber search for word sequences.

Patterns are windows of benchmark words. Those of one length are searched together: the
two words at the end of the current window are looked up in a shift table, which says
how far the window may move without passing an occurrence; where it says 0, the pair's
bucket holds the patterns ending so, and direct comparison of all words confirms.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stocklake.llm.common import map_arrow, packed, with_fields

WINDOW = 10
#: Windows of one broadcast table; a larger benchmark is searched for in several passes.
TABLE_WINDOWS = 200_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters a-z (A-Z lower-cased), digits and all characters beyond ASCII."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def windows_of(words: list[bytes], width: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    """All windows of ``width`` words; fewer words are one window."""
    if words:
        for start in range(max(1, len(words) - width + 1)):
            yield tuple(words[start : start + width])


@dataclass
class _Length:
    """The tables for patterns of one length: the shift of a pair of words (default: no
    pattern holds the pair), and of pairs with shift 0 the patterns that end in it."""

    length: int
    shift: dict[int, int] = field(default_factory=dict)
    buckets: dict[int, dict[tuple[int, ...], list[int]]] = field(default_factory=dict)

    def add(self, pattern: tuple[int, ...], item: int) -> None:
        pairs = [self.pair(pattern, end) for end in range(len(pattern))]
        first = 1 if self.length > 1 else 0
        for end in range(first, self.length):
            gap = self.length - 1 - end
            self.shift[pairs[end]] = min(gap, self.shift.get(pairs[end], gap))
        found = self.buckets.setdefault(pairs[-1], {}).setdefault(pattern, [])
        if item not in found:
            found.append(item)

    def pair(self, words, end: int) -> int:
        return (words[end - 1] << 32 | words[end]) if self.length > 1 else words[end]

    def search(self, words: list[int], hit: np.ndarray, items: set[int]) -> None:
        """Mark the words of all occurrences, collect the items."""
        length, shift, buckets = self.length, self.shift, self.buckets
        away = max(1, length - 1)
        end, stop, lag = length - 1, len(words), 1 if length > 1 else 0
        while end < stop:
            word = words[end]
            if word < 0:  # no pattern holds it
                end += length
                continue
            pair = words[end - 1] << 32 | word if lag else word
            step = shift.get(pair, away)
            if step:
                end += step
                continue
            start = end - length + 1
            found = buckets[pair].get(tuple(words[start : end + 1]))
            if found:
                hit[start : end + 1] = True
                items.update(found)
            end += 1


class WuManber:
    """Search tables over word numbers; words no pattern holds have the number -1."""

    def __init__(self, patterns: list[tuple[tuple[bytes, ...], int]]):
        self.numbers: dict[bytes, int] = {}
        self.lengths: dict[int, _Length] = {}
        for words, item in patterns:
            numbered = tuple(self.numbers.setdefault(w, len(self.numbers)) for w in words)
            self.lengths.setdefault(len(words), _Length(len(words))).add(numbered, item)

    def search(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        get = self.numbers.get
        numbers = [get(word, -1) for word in words]
        hit, items = np.zeros(len(words), bool), set()
        for table in self.lengths.values():
            table.search(numbers, hit, items)
        return hit, items


def _tables(benchmark: DataFrame, width: int, limit: int) -> Iterator[list]:
    """Windows of the benchmark, ``limit`` at a time; the driver holds one item and one
    table's windows."""
    rows = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    part: list = []
    for row in rows.toLocalIterator():
        for window in windows_of(words_of(row.text), width):
            part.append((window, row.item_id))
            if len(part) >= limit:
                yield part
                part = []
    if part:
        yield part


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, width: int = WINDOW, table_windows: int = TABLE_WINDOWS
) -> DataFrame:
    """The documents' columns with ``n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit if an occurrence of a window of a benchmark item covers it; an item
    counts if one of its windows occurs; ``items_sha256`` is of the items' ids, sorted as
    strings and joined by commas. A null text has no words; benchmark rows without id or
    text take no part; rows of one id are one item, whatever
    the id's type. Columns of the documents with the
    names of results are replaced. Repeated rows are all searched.

    The windows are broadcast, ``table_windows`` at most at a time. A larger benchmark
    takes a pass over the rows per table, chained without a shuffle, that adds to the hit
    bits found before. Work is per document; the longest document bounds a task's memory.
    """
    spark = documents.sparkSession
    results = {
        "n_words": pa.int64(),
        "n_hit": pa.int64(),
        "n_items": pa.int64(),
        "items_sha256": pa.string(),
        "contaminated": pa.bool_(),
    }
    columns = [c for c in documents.columns if c not in results]
    item_type = benchmark.schema["item_id"].dataType
    state = documents.select(
        packed(documents, columns),
        "text",
        F.lit(None).cast("binary").alias("hit"),
        F.lit(None).cast(T.ArrayType(item_type)).alias("items"),
    )

    def search(held, batch):
        for text, bits, had in zip(*(batch[c].to_pylist() for c in ("text", "hit", "items")), strict=True):
            hit, items = held.value.search(words_of(text))
            if bits is not None:
                hit |= np.unpackbits(np.frombuffer(bits, np.uint8), count=len(hit)).astype(bool)
            yield hit, items.union(had or ())

    def more(held):
        def run(batches):
            for batch in batches:
                found = [(np.packbits(hit).tobytes(), list(items)) for hit, items in search(held, batch)]
                bits = pa.array([bits for bits, _ in found], pa.binary())
                items = pa.array([items for _, items in found], pa.list_(to_arrow_type(item_type)))
                yield pa.record_batch([batch["row"], batch["text"], bits, items], names=batch.schema.names)

        return run

    def last(held):
        def run(batches):
            for batch in batches:
                rows = [
                    (len(hit), int(hit.sum()), len(items), _digest(items), bool(hit.any()))
                    for hit, items in search(held, batch)
                ]
                made = [
                    pa.array([row[i] for row in rows], kind) for i, kind in enumerate(results.values())
                ]
                yield pa.record_batch([batch["row"], *made], names=["row", *results])

        return run

    middle = state.schema
    end = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    table: list = []
    for part in _tables(benchmark, width, table_windows):
        if table:
            state = map_arrow(state, more(spark.sparkContext.broadcast(WuManber(table))), middle)
        table = part
    held = spark.sparkContext.broadcast(WuManber(table))
    return map_arrow(state, last(held), with_fields(state, ["row"], end)).select("row.*", *results)


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
