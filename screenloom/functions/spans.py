"""Places in texts as Columns: where a pattern matches, intervals around them, merged, and cut out.

An interval is a struct (start, end) of characters from 0, end excluded.  All of it is
expressions over one row, so that nothing leaves the executors' code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java's classes of letters, digits and white space by Unicode.
UNICODE = "(?U)"
#: What marks hits in a text.
MARK = "\x01"
HITS = "array<struct<start:int,end:int,hit:string>>"
INTERVALS = "array<struct<start:int,end:int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), value computed once however often it is named: an expression is otherwise computed anew in each place, and within functions of arrays for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def find(text: Column, pattern: str) -> Column:
    """HITS of a pattern that never matches nothing, from left to right; null text: null.

    Where hits are follows from the lengths of what lies between them.  Hits are marked in one
    pass over the text; splitting by the pattern, which would be compiled for each text, is
    left to texts that contain the mark.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast(HITS).alias("out"))

    def step(state: Column, s: Column) -> Column:
        begin = state["at"] + s["gap"]
        end = begin + F.length(s["hit"])
        return F.struct(end.alias("at"), F.array_append(state["out"], F.struct(begin.alias("start"), end.alias("end"), s["hit"].alias("hit"))).alias("out"))

    def placed(parts: Column) -> Column:
        hits = F.filter(parts, lambda p, i: i % 2 == 1)
        steps = F.zip_with(F.filter(parts, lambda p, i: (i % 2 == 0) & (i < F.size(parts) - 1)), hits, lambda b, h: F.struct(F.length(b).alias("gap"), h.alias("hit")))
        return F.when(F.size(parts) == 1, F.array().cast(HITS)).otherwise(F.aggregate(steps, start, step, lambda state: state["out"]))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    apart = F.flatten(F.zip_with(F.split(text, pattern, -1), hits, lambda b, h: F.when(h.isNull(), F.array(b)).otherwise(F.array(b, h))))
    marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    return let(F.when(F.contains(text, F.lit(MARK)), apart).otherwise(marked), placed)


def widened(hits: Column, before: int, after: int, length: Column) -> Column:
    """Intervals around hits, inside a text of that length."""
    return F.transform(hits, lambda h: F.struct(F.greatest(h["start"] - before, F.lit(0)).alias("start"), F.least(h["end"] + after, length).alias("end")))


def merged(intervals: Column, gap: int = 0) -> Column:
    """Sorted intervals with those as one that overlap, touch, or are `gap` characters apart at most."""

    def step(done: Column, i: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], i["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (i["start"] <= F.coalesce(last["end"], F.lit(-1)) + gap), F.array_append(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), longer)).otherwise(F.array_append(done, i))

    return F.aggregate(F.array_sort(intervals), F.array().cast(INTERVALS), step)


def cut(text: Column, intervals: Column) -> Column:
    """The texts of intervals."""
    return F.transform(intervals, lambda i: F.substring(text, i["start"] + 1, i["end"] - i["start"]))


def windows(text: Column, pattern: str, before: int, after: int, gap: int = 0) -> Column:
    """The parts of a text around a pattern's hits, overlapping ones as one; null text: null, no hit: none."""
    return cut(text, merged(widened(find(text, pattern), before, after, F.length(text)), gap))


def apart(candidates: Column) -> Column:
    """Of structs with start and end, in order of preference, those that overlap none that was taken before."""
    taking = lambda taken, c: F.when(F.exists(taken, lambda t: (t["start"] < c["end"]) & (c["start"] < t["end"])), taken).otherwise(F.array_append(taken, c))
    return let(candidates, lambda every: F.aggregate(every, F.slice(every, F.lit(1), F.lit(0)), taking))
