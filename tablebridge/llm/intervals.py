"""Spans of one text that are taken already."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable


class Taken:
    """Answers in logarithmic time whether a span overlaps one of those taken."""

    def __init__(self, spans: Iterable[tuple[int, int]] = ()):
        self.runs: list[tuple[int, int]] = []  # apart from each other, ascending
        for a, b in sorted(spans):
            if self.runs and a < self.runs[-1][1]:
                self.runs[-1] = self.runs[-1][0], max(b, self.runs[-1][1])
            else:
                self.runs.append((a, b))

    def meets(self, a: int, b: int) -> bool:
        at = bisect_left(self.runs, (b,)) - 1  # the last run that begins before b
        return at >= 0 and self.runs[at][1] > a

    def take(self, a: int, b: int) -> bool:
        """Take the span unless it meets a taken one; returns whether it did not."""
        free = not self.meets(a, b)
        if free:
            insort(self.runs, (a, b))
        return free
