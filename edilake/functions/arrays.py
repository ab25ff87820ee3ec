"""Array expressions that Spark lacks: a running state over an array, and literal lookup tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 128


def int_table(values: Iterable[int]) -> Column:
    """A constant ARRAY<INT>. Written as one string, so that the plan holds one literal and not thousands."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast("array<int>")


def lookup(values: Iterable[str | None], index: Column) -> Column:
    """The string at a 0-based index of a constant list, or null."""
    text = F.lit("\n".join("" if v is None else v for v in values))
    return F.nullif(F.get(F.split(text, "\n"), index), F.lit(""))


def running_state(items: Column, initial: Column, step: Callable[[Column, Column], Column], state_type: str) -> Column:
    """The state after each item, as an array as long as ``items``.

    ``aggregate`` can only return its last state, and appending to one long array copies it on every step. So
    the items go through in blocks: the inner fold appends to a block, the outer one appends whole blocks, and
    the copying stays near n * (BLOCK + n / BLOCK) instead of n * n. The states so far are the only accumulator;
    the current state is the last of them.
    """
    first = F.array(initial.cast(state_type))

    def last(states: Column) -> Column:
        return F.element_at(states, -1)

    def inner(states: Column, item: Column) -> Column:
        return F.array_append(states, step(last(states), item))

    def outer(blocks: Column, start: Column) -> Column:
        block = F.slice(items, start, F.lit(BLOCK))
        return F.array_append(blocks, F.aggregate(
            block, F.array(last(last(blocks))), inner,
            lambda states: F.slice(states, F.lit(2), F.size(states) - 1)))

    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK))).otherwise(
        F.array().cast("array<int>"))
    return F.aggregate(
        starts, F.array(first), outer,
        lambda blocks: F.flatten(F.slice(blocks, F.lit(2), F.size(blocks) - 1)))


def explode_items(rows: DataFrame, keep: list[str | Column], items: Column | str, place: str, item: str) -> DataFrame:
    """``keep`` and one row per item of an array, with its 0-based place.

    For a plain explode, Spark first filters on the size of the array, with all that the array is made of written out again
    below the scan. What the steps before computed once for a row is then computed for every item there, and an array of
    pieces of a text takes time by the square of the text. No such filter comes with the outer form.
    """
    return rows.select(*keep, F.posexplode_outer(items).alias(place, item)).where(F.col(place).isNotNull())
