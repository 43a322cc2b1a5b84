"""Regular-expression matches with offsets (R12), on built-in expressions.

Spark returns matches without places.  One ``regexp_replace`` sets marks around every match; the text splits
at the marks, and the running lengths of the parts, in code points, are the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import bind_sql

_OUT = "array<struct<start:int,end:int,match:string>>"
#: Marks in front of and behind a match; where a text holds them itself, another control character stands in.
_OPEN, _CLOSE, _OTHER = "\x01", "\x02", "\x03"


def finditer(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of leftmost non-overlapping matches; ``pattern`` matches no empty string.

    The pattern may hold groups and look-around; groups are read again from ``match`` by the caller.  It matches
    no control character of the marks.
    """
    own = F.when(F.contains(text, F.lit(_OPEN)) | F.contains(text, F.lit(_CLOSE)), F.translate(text, _OPEN + _CLOSE, _OTHER * 2)).otherwise(text)
    flag, body = ("(?i)", pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
    marked = F.regexp_replace(own, f"{flag}(?:{body})", f"{_OPEN}$0{_CLOSE}")
    # a part behind a mark is a match, its end mark and the gap after it
    size = "instr(part, char(2)) - 1"
    one = f"struct(a.pos AS start, a.pos + {size} AS end, substring_index(part, char(2), 1) AS match)"
    step = f"(a, part) -> struct(a.pos + length(part) - 1 AS pos, array_append(a.out, {one}) AS out)"
    parts = "split(r.m, char(1))"
    places = f"aggregate(slice({parts}, 2, 1000000000), struct(length(get({parts}, 0)) AS pos, cast(array() AS {_OUT}) AS out), {step}, a -> a.out)"
    return bind_sql(f"IF(contains(r.m, char(1)), {places}, cast(array() AS {_OUT}))", m=marked)
