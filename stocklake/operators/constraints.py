"""Any number of constraints over any number of tables, checked in one pass.

Every row of a table becomes a row per rule it takes part in: the rule's number, the
row's role in it and a hash of its key. All tables meet in one shuffle of such rows,
combined before it, so a table is scanned once whatever the number of its rules, and a key
that a third of all rows share is one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Roles of a row: one of a unique key, one that refers, one referred to, one that breaks
# a rule by itself.
KEYED, CHILD, PARENT, BROKEN = range(4)


@dataclass(frozen=True)
class Rule:
    """``roles`` gives, by table, the role of its rows and what is hashed of a row: key
    columns as text, or a single condition for ``BROKEN`` rows."""

    table: str
    name: str
    roles: dict[str, list[tuple[int, Callable[[], list[Column]]]]]


def not_null(table: str, col: str) -> Rule:
    return _broken(table, f"not null {col}", lambda: F.col(col).isNull())


def longest(table: str, col: str, size: int) -> Rule:
    """Text of at most so many characters; null is sound."""
    return _broken(table, f"length of {col}", lambda: F.char_length(col) > size)


def within(table: str, col: str, low: int, high: int) -> Rule:
    """A declared integer range; null is sound."""
    return _broken(table, f"integer {col}", lambda: ~F.col(col).between(low, high))


def unique(table: str, keys: list[str]) -> Rule:
    """No key twice; a key with a null is never a violation."""
    return Rule(table, f"unique {', '.join(keys)}", {table: [(KEYED, lambda: list(map(F.col, keys)))]})


def reference(table: str, col: str, to: str, key: str) -> Rule:
    """A key that is set must be in the other table. Keys of different types are equal if
    they are as text."""
    child, parent = (CHILD, lambda: [F.col(col)]), (PARENT, lambda: [F.col(key)])
    roles = {table: [child, parent]} if to == table else {table: [child], to: [parent]}
    return Rule(table, f"{col} in {to}", roles)


def _broken(table: str, name: str, condition: Callable[[], Column]) -> Rule:
    return Rule(table, name, {table: [(BROKEN, lambda: [condition()])]})


def _tagged(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """``rule, role, key, key2``: what the rows of one table have to do with the rules."""
    tags = []
    for number, rule in enumerate(rules):
        for role, columns in rule.roles.get(table, ()):
            values = columns()
            if role == BROKEN:
                counts, key = F.coalesce(values[0], F.lit(False)), [F.lit(0)]
            else:
                counts = reduce(Column.__and__, [c.isNotNull() for c in values])
                key = [c.cast("string") for c in values]
            tag = F.struct(
                F.lit(number).alias("rule"),
                F.lit(role).alias("role"),
                F.xxhash64(*key).alias("key"),
                F.xxhash64(F.lit(1), *key).alias("key2"),
            )
            tags.append(F.when(counts, tag))
    return df.select(F.inline(F.array_compact(F.array(*tags))))


def report(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """``table_name, rule, n`` for every rule that some rows break.

    ``n`` counts the repeated keys of a unique rule, and the rows of any other. Keys are
    compared by 128 bits of hash.
    """
    used = [name for name in tables if any(name in rule.roles for rule in rules)]
    tags = reduce(DataFrame.unionAll, [_tagged(tables[name], name, rules) for name in used])

    def rows(role: int) -> Column:
        return F.count_if(F.col("role") == role)

    keys = tags.groupBy("rule", "key", "key2").agg(
        rows(KEYED).alias("keyed"), rows(CHILD).alias("child"), rows(PARENT).alias("parent"), rows(BROKEN).alias("broken")
    )
    orphans = F.when(F.col("parent") == 0, F.col("child")).otherwise(0)
    counts = keys.groupBy("rule").agg(
        F.sum((F.col("keyed") > 1).cast("long") + orphans + F.col("broken")).alias("n")
    )
    names = {"table_name": [rule.table for rule in rules], "rule": [rule.name for rule in rules]}
    named = [F.get(F.array(*map(F.lit, values)), F.col("rule")).alias(c) for c, values in names.items()]
    return counts.where("n > 0").select(*named, "n")
