"""Spans of kinds in texts: how results list them."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int>"


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


class Taken:
    """Places that spans hold; asked in the logarithm of their number, whatever the text holds."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        nth = bisect_right(self.ends, start)
        return nth < len(self.starts) and self.starts[nth] < end
