"""How filters interact: what each step of every order of them keeps and removes.

A document matters only by the set of filters it fails, its mask. Every mask stands for one
big integer with a field per order, step and measure, which holds what the step does with
such a document. Integers are added up per part in the tasks, the sums meet in two
shuffles, and the fields of one sum are all counts of a part.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklake.llm.common import Staging, map_arrow

#: What parts words, and the characters that mark a text as not prose.
BLANKS = r"[\x20\x09-\x0D]+"
SIGNS = r"[#$%&*|]"

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Sums of so many tasks meet in the first shuffle, all sums of a part in the second.
TASKS_A_SUM = 256
#: Parts a task adds up at a time; with more it hands over its sums and begins anew.
PARTS_HELD = 256


def few_words(text: Column, words: Column) -> Column:
    return F.size(words) < 100


def repetitive(text: Column, words: Column) -> Column:
    return 100 * F.size(F.array_distinct(words)) < 80 * F.size(words)


def shouting(text: Column, words: Column) -> Column:
    return 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text)


def signs(text: Column, words: Column) -> Column:
    return text.rlike(SIGNS)


#: The failure condition of each filter; ``None`` is the one that fails every text which a
#: smaller id holds too.
FILTERS: dict[str, Callable[[Column, Column], Column] | None] = {
    "A": few_words,
    "B": repetitive,
    "C": shouting,
    "D": signs,
    "E": None,
}


class StepCounters:
    """Integers with a 64-bit field per order, step and measure.

    A field counts documents, of which no table has 2**64, so no sum of these integers
    carries from one field into the next.
    """

    def __init__(self, names: str):
        self.names = names
        self.orders = ["".join(order) for order in permutations(names)]
        self.shape = (len(self.orders), len(names), len(MEASURES))
        self.bytes = int(np.prod(self.shape)) * 8

    def code(self, mask: int, good: bool, toxic: bool) -> int:
        return mask << 2 | good << 1 | toxic

    def outcomes(self) -> list[int]:
        """The integer of every ``code``: bit k of a mask is the k-th filter's failure."""
        return [
            self._outcome(mask, bool(marks & 2), bool(marks & 1))
            for mask in range(1 << len(self.names))
            for marks in range(4)
        ]

    def _outcome(self, mask: int, good: bool, toxic: bool) -> int:
        fields = np.zeros(self.shape, "<u8")
        fails = {name: bool(mask >> k & 1) for k, name in enumerate(self.names)}
        alone = sum(fails.values()) == 1
        for row, order in zip(fields, self.orders, strict=True):
            gone = False
            for step, name in zip(row, order, strict=True):
                removed = fails[name] and not gone
                redundant = fails[name] and gone
                gone = gone or fails[name]
                step[:] = not gone, removed, redundant, fails[name] and alone, removed and good, removed and toxic
        return int.from_bytes(fields.tobytes(), "little")

    def pack(self, total: int) -> bytes:
        return total.to_bytes(self.bytes, "little")

    def unpack(self, total: bytes) -> np.ndarray:
        """Counts by order, step and measure."""
        return np.frombuffer(total, "<u8").reshape(self.shape).astype(np.int64)


def _add(sums: dict[str, int], part: str, value: int) -> None:
    sums[part] = sums.get(part, 0) + value


def _handed_over(sums: dict[str, int], counters: StepCounters) -> pa.RecordBatch:
    batch = pa.record_batch(
        [
            pa.array(list(sums), pa.string()),
            pa.array([counters.pack(total) for total in sums.values()], pa.binary()),
        ],
        names=["part", "total"],
    )
    sums.clear()
    return batch


def failures(documents: DataFrame, filters=FILTERS) -> DataFrame:
    """``doc_id, part, mask, same``: the filters a text fails by itself, as bits in the
    order of ``filters``, and the digest of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, BLANKS), "").alias("words"),
    )
    mask = F.lit(0)
    for bit, fails in enumerate(filters.values()):
        if fails is not None:
            mask += fails(F.col("text"), F.col("words")).cast("int") * (1 << bit)
    same = F.unhex(F.sha2(F.col("text"), 256))
    return rows.select("doc_id", "part", mask.alias("mask"), same.alias("same"))


def masks(documents: DataFrame, labels: DataFrame, filters=FILTERS) -> DataFrame:
    """``part, code``: a row per document with the filters it fails and its labels.

    The least id of each text comes from an aggregate, and documents meet it on their own
    id, so copies of one text never gather.
    """
    names = "".join(filters)
    rows = Staging(documents.sparkSession, "audit").write(failures(documents, filters), "failures")
    copies = [bit for bit, fails in enumerate(filters.values()) if fails is None]
    mask = F.col("mask")
    if copies:
        first = rows.groupBy("same").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
        rows = rows.join(first, ["doc_id", "same"], "left")
        repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
        mask += repeats.cast("int") * sum(1 << bit for bit in copies)
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    code = StepCounters(names).code
    marked = rows.join(marks, "doc_id", "left")
    bits = mask * 4 + F.coalesce("good", F.lit(0)) * code(0, True, False) + F.coalesce("toxic", F.lit(0))
    return marked.select("part", bits.alias("code"))


def audit(documents: DataFrame, labels: DataFrame, filters=FILTERS) -> DataFrame:
    """A row per part (value of ``lang``), order of the filters and step: ``part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley``.

    ``documents`` needs ``doc_id, text, lang`` and ``labels`` needs ``doc_id, quality,
    toxic``; other columns are not read. A null text is empty, a null ``lang`` the part
    "" (as is an empty one). A null id is larger or smaller than none: its text fails no
    comparison and makes none fail. A repeated row counts each time; it is no copy of
    itself, as its id is not smaller. Of several labels of a document any that is 1
    counts; null labels and those of unknown documents do not. An empty table gives no
    rows. Names of filters are one character each.

    Shuffles a row of about 50 bytes per document, and then one integer of 29 KB (five
    filters) per part and task. A part's last sum is made in one task, of one integer for
    every 256 tasks.
    """
    names = "".join(filters)
    counters = StepCounters(names)

    def in_task(batches):
        table, sums = counters.outcomes(), {}
        for batch in batches:
            for part, code in zip(batch["part"].to_pylist(), batch["code"].to_pylist(), strict=True):
                _add(sums, part, table[code])
            if len(sums) > PARTS_HELD:
                yield _handed_over(sums, counters)
        yield _handed_over(sums, counters)

    def added_up(batches):
        sums = {}
        for batch in batches:
            for part, total in zip(batch["part"].to_pylist(), batch["total"], strict=True):
                _add(sums, part, int.from_bytes(total.as_buffer(), "little"))
            if len(sums) > PARTS_HELD:
                yield _handed_over(sums, counters)
        yield _handed_over(sums, counters)

    schema = "part string, total binary"
    sums = map_arrow(masks(documents, labels, filters), in_task, schema, rows=4096)
    groups = (F.spark_partition_id() / TASKS_A_SUM).cast("int").alias("tasks")
    some = map_arrow(sums.select("*", groups).repartition("part", "tasks").drop("tasks"), added_up, schema)
    # Sums of one part may leave a task twice where it holds many parts, so the last task
    # adds up what it gets of a part whole: its rows are sorted by part.
    whole = some.repartition("part").sortWithinPartitions("part")
    return map_arrow(whole, lambda batches: _unpacked(batches, counters), _RESULT)


_RESULT = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in (*MEASURES, "shapley"))


def _unpacked(batches, counters: StepCounters):
    """The counts of each part out of its sums, which come one part after the other."""
    part, total = None, 0
    for batch in batches:
        for name, value in zip(batch["part"].to_pylist(), batch["total"], strict=True):
            if part is not None and name != part:
                yield _counts(part, total, counters)
                total = 0
            part, total = name, total + int.from_bytes(value.as_buffer(), "little")
    if part is not None:
        yield _counts(part, total, counters)


def _counts(part: str, total: int, counters: StepCounters) -> pa.RecordBatch:
    counts = counters.unpack(counters.pack(total))
    orders, steps, _ = counters.shape
    at = np.array([[counters.names.index(name) for name in order] for order in counters.orders])
    removed = counts[:, :, MEASURES.index("removed")]
    shapley = np.array([removed[at == k].sum() for k in range(steps)])[at]
    columns = {
        "part": pa.array([part] * (orders * steps), pa.string()),
        "filter_order": pa.array(np.repeat(counters.orders, steps).tolist(), pa.string()),
        "step": pa.array(np.tile(np.arange(1, steps + 1), orders), pa.int32()),
        **{m: pa.array(counts[:, :, k].ravel(), pa.int64()) for k, m in enumerate(MEASURES)},
        "shapley": pa.array(shapley.ravel(), pa.int64()),
    }
    return pa.record_batch(list(columns.values()), names=list(columns))
