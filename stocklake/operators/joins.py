"""Lookups and anti joins.

No join is hinted: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and otherwise sort-merges and splits hot
keys at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklake.session import stage

#: Hashes are entered in so many words of 64 bits: small enough to be broadcast.
WORDS = 1 << 19


def lookup(
    df: DataFrame, dim: DataFrame, on: dict[str, str], keep: list[str], how: str = "left"
) -> DataFrame:
    """Add the columns ``keep`` of ``dim``, matched by differently named columns.

    ``on`` maps a column of ``df`` to one of ``dim``.
    """
    names = {key: f"_on_{i}" for i, key in enumerate(on.values())}
    side = dim.select(*[F.col(c).alias(n) for c, n in names.items()], *keep)
    condition = [df[left] == side[names[right]] for left, right in on.items()]
    return df.join(side, condition, how).drop(*names.values())


def bits_of(mark: str) -> tuple[Column, Column]:
    """The word of a ``bit_table`` that a hash is entered in, and its bit there."""
    word = F.pmod(mark, F.lit(WORDS)).cast("int")
    bit = F.call_function("shiftrightunsigned", F.col(mark), F.lit(32)).bitwiseAND(F.lit(63)).cast("int")
    return word, F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def bit_table(marks: DataFrame) -> DataFrame:
    """The hashes in ``_mark`` as bits (``_bits``) of at most ``WORDS`` words (``_word``).

    Whatever their number, it stays below the size that Spark broadcasts.
    """
    word, mask = bits_of("_mark")
    return stage(marks.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits")), "bits")


def may_match(df: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """All rows whose ``col`` is in the one column of ``keys``, and few others.

    Before a lookup that drops what it does not find: if ``keys`` are too many to be
    broadcast, both sides are shuffled, and this leaves out most of what is shuffled in vain.
    """
    table = bit_table(keys.select(F.xxhash64(keys.columns[0]).alias("_mark")))
    word, mask = bits_of("_mark")
    marked = df.withColumn("_mark", F.xxhash64(col)).withColumn("_word", word)
    found = marked.join(table, "_word").where(F.col("_bits").bitwiseAND(mask) != 0)
    return found.select(*df.columns)


def denormalise(fact: DataFrame, dims: list[tuple[DataFrame, dict, list]]) -> DataFrame:
    """A chain of left lookups: ``(dim, on, keep)`` each."""
    for dim, on, keep in dims:
        fact = lookup(fact, dim, on, keep)
    return fact


def absent_from(df: DataFrame, other: DataFrame, on, unique=False) -> DataFrame:
    """Rows with no equal key in ``other`` (NOT EXISTS); a null key counts as absent.

    Unless ``other`` is ``unique`` on the key, only its distinct keys are sent: a hot
    key on this side of an anti join cannot be split. The extra grouping column keeps
    that aggregate's shuffle from doubling as the join's, because adaptive execution
    splits a hot key of ``df`` only behind a shuffle of the join's own.
    """
    on = [on] if isinstance(on, str) else on
    keys = other.select(*on)
    if not unique:
        part = F.pmod(F.xxhash64(*on), F.lit(16)).alias("_part")
        keys = keys.select(*on, part).distinct().select(*on)
    return df.join(keys, on, "left_anti")


def not_in(df: DataFrame, other: DataFrame, col: str) -> DataFrame:
    """Rows whose value is NOT IN ``other``, with SQL's rules for null.

    A null in ``other`` empties the result, and a null value only passes when
    ``other`` is empty. Both facts are scalar subqueries; Spark's own null-aware
    join would have to broadcast ``other`` whatever its size.
    """
    values = other.select(F.col(col))
    clear = values.agg(F.count_if(F.col(col).isNull()) == 0).scalar()
    empty = values.agg(F.count("*") == 0).scalar()
    return absent_from(df, values, col).where(clear & (F.col(col).isNotNull() | empty))


def within_bounds(
    target: DataFrame, batch: DataFrame, col: str, stand_in: str | None = None
) -> DataFrame:
    """Only the rows of ``target`` whose value lies between the batch's extremes.

    ``stand_in`` is a value that stands for a missing one: it sets no bound, and rows of
    ``target`` that have it are kept.

    For an equality join on ``col`` this loses nothing, and it keeps the history of
    a large table out of the shuffle. The two extremes are fetched first: as
    literals they reach the scan, where a subquery would not skip any row group.
    """
    real = batch if stand_in is None else batch.where(F.col(col) != stand_in)
    low, high = real.agg(F.min(col), F.max(col)).first()
    inside = F.lit(False) if low is None else F.col(col).between(low, high)
    return target.where(inside if stand_in is None else inside | (F.col(col) == stand_in))


def fanout_counts(
    left: DataFrame, right: DataFrame, on: list[str], name: str, copies: str | None = None
) -> DataFrame:
    """How many rows a many-to-many inner join gives each distinct left row.

    Both sides are counted before they meet, so no pair is ever built; a column
    ``copies`` says how many rows each row stands for. The counts of ``right`` are
    staged: the join then shuffles for itself and can split a hot key.
    """
    many = F.sum(copies) if copies else F.count("*")
    lefts = left.groupBy(*[c for c in left.columns if c != copies]).agg(many.alias("_left"))
    rights = stage(right.groupBy(*on).agg(many.alias("_right")), "fanout")
    return (
        lefts.join(rights, on)
        .withColumn(name, F.col("_left") * F.col("_right"))
        .drop("_left", "_right")
    )
