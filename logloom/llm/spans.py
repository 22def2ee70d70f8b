"""Places of regular expressions in text, as column expressions.

Spark returns the matches of a pattern but not where they stand. The text between the matches
(``split`` with the same pattern) gives the places: match i starts after the first i + 1 gaps and
the first i matches. Offsets are code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,end:bigint,value:string>"
# Elements that a growing array holds at most.
BLOCK = 256


def once(name: str, column: Column) -> Column:
    """The column as generator output, so that its readers do not compute it again."""
    return F.explode(F.array(column)).alias(name)


def matches(text: Column, pattern: Column, group: int = 0) -> Column:
    return F.regexp_extract_all(text, pattern, F.lit(group))


def gathered(parts: Column, state: dict[str, Column], step: Callable[[Column, Column], Column], kind: str) -> Column:
    """What ``step`` adds to ``out`` over the elements of ``parts``, in time linear in their number.

    ``step(done, part)`` gives the fields of ``state`` and ``out``, an array of ``kind``. An array that grows is copied
    at every step, so it only grows to ``BLOCK`` elements; then the arrays of all blocks are put together.
    """
    empty = F.array().cast(f"array<{kind}>").alias("out")

    def over(whole: Column) -> Column:
        last = F.greatest(F.floor((F.size(whole) - 1) / BLOCK).cast("int"), F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(whole, b * BLOCK + 1, BLOCK))

        def block_step(done: Column, block: Column) -> Column:
            own = F.aggregate(block, F.struct(*[done[x].alias(x) for x in state], empty), step)
            # As an element, so that it is computed once.
            put = F.transform(F.array(own), lambda r: F.struct(*[r[x].alias(x) for x in state], F.array_append(done["out"], r["out"]).alias("out")))
            return F.get(put, F.lit(0))

        start = F.struct(*[x.alias(name) for name, x in state.items()], F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.aggregate(blocks, start, block_step, lambda done: F.flatten(done["out"]))

    return F.get(F.transform(F.array(parts), over), F.lit(0))


def spans(text: Column, pattern: Column, group: int = 0) -> Column:
    """array<struct<start, end, value>> of the leftmost matches that do not overlap.

    ``start`` and ``end`` are those of the whole match, ``value`` is ``group``.
    """
    hits = matches(text, pattern)
    # arrays_zip pads: the gap behind the last match has no match.
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), matches(text, pattern, group).alias("value"))

    def step(done: Column, part: Column) -> Column:
        begin = done["at"] + F.length(part["gap"])
        end = begin + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), part["value"].alias("value"))
        return F.struct(
            end.cast("bigint").alias("at"),
            F.when(part["hit"].isNull(), done["out"]).otherwise(F.concat(done["out"], F.array(span).cast(f"array<{SPAN}>"))).alias("out"),
        )

    return gathered(parts, {"at": F.lit(0).cast("bigint")}, step, SPAN)
