"""Folds over array columns that take time in proportion to the array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold(items: Column, zero: Column, state: str, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """All that step(state, item) -> (state, array of outputs) gives over an array's items in order, as one array.

    `state` and `kind` are the types of the state and of one output. Growing one array item by item would copy it each
    time; here blocks of items are folded to arrays of their own, which are put together at the end.
    """
    inner, outer = f"struct<state:{state},out:array<{kind}>>", f"struct<state:{state},out:array<array<{kind}>>>"

    def one(acc: Column, item: Column) -> Column:
        after, out = step(acc["state"], item)
        return F.struct(after.alias("state"), F.concat(acc["out"], out).alias("out")).cast(inner)

    def block(acc: Column, part: Column) -> Column:
        begin = F.struct(acc["state"].alias("state"), F.array().cast(f"array<{kind}>").alias("out")).cast(inner)
        return let(F.aggregate(part, begin, one), lambda made: F.struct(made["state"].alias("state"), F.concat(acc["out"], F.array(made["out"])).alias("out")).cast(outer))

    def parts(every: Column) -> Column:
        last = F.greatest(F.floor((F.size(every) - 1) / BLOCK).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(every, b * BLOCK + 1, F.lit(BLOCK)))

    begin = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out")).cast(outer)
    return F.flatten(F.aggregate(let(items, parts), begin, block, lambda acc: acc["out"]))
