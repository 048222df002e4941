"""Plain reader of coordinate text, token by token from left to right: what the JVM pattern is held against."""

from __future__ import annotations

import re

from geoincident.functions.coordtext import ALTITUDE_UNITS, DEGREE_MARKS, MINUTE_MARKS, SECOND_MARKS
from geoincident.functions.units import KM_PER_UNIT

_TOKEN = re.compile(r"(?P<number>\d+(?:\.\d+)?)|(?P<blank>\s+)|(?P<unit>km|nmi|nm|mi|ft)|(?P<other>.)", re.S)


class _Reader:
    """Tokens of one text and a place among them."""

    def __init__(self, text: str):
        self.tokens = [(m.lastgroup, m.group()) for m in _TOKEN.finditer(text.replace("''", '"'))]
        self.at = 0

    def kind(self, ahead: int = 0) -> str:
        at = self.at + ahead
        return self.tokens[at][0] if at < len(self.tokens) else "end"

    def text(self, ahead: int = 0) -> str:
        at = self.at + ahead
        return self.tokens[at][1] if at < len(self.tokens) else ""

    def take(self, allowed: str) -> str:
        """The next token if it is one of these characters."""
        got = self.text()
        if self.kind() == "other" and got in allowed:
            self.at += 1
            return got
        return ""

    def blanks(self) -> bool:
        if self.kind() == "blank":
            self.at += 1
            return True
        return False

    def number(self, signed: bool) -> float | None:
        sign = self.take("+-") if signed and self.kind(1) == "number" else ""
        if self.kind() != "number":
            return None
        self.at += 1
        return float(sign + self.text(-1))

    def part(self, marks: str) -> float:
        """A number that one of the marks follows, or 0."""
        if self.kind() == "number" and self.kind(1) == "other" and self.text(1) in marks:
            value = self.number(False)
            self.at += 1
            self.blanks()
            return value
        return 0.0

    def angle(self, plus: str, minus: str) -> float | None:
        front = self.take(plus + minus)
        if front:
            self.blanks()
        degrees = self.number(True)
        if degrees is None:
            return None
        before = self.at
        if self.take(DEGREE_MARKS) or self.blanks():
            marked = self.tokens[before][0] == "other"
            if marked:
                self.blanks()
            start = self.at
            more = self.part(MINUTE_MARKS) / 60 + self.part(SECOND_MARKS) / 3600
            back = self.take(plus + minus)
            if self.at == start and self.tokens[start - 1][0] == "blank":
                self.at = start - 1  # the blank is the separator
        else:
            more, back = 0.0, self.take(plus + minus)
        # the sign of the degrees counts, so "-0 30m" stays positive
        value = degrees - more if degrees < 0 else degrees + more
        return -value if (front or back) == minus else value

    def separator(self) -> bool:
        found = self.blanks()
        if self.take(",;/"):
            found = True
            self.blanks()
        return found

    def point(self, start: int) -> tuple[float, float, float] | None:
        self.at = start
        lat = self.angle("N", "S")
        if lat is None or not self.separator():
            return None
        lon = self.angle("E", "W")
        if lon is None:
            return None
        height = 0.0
        if self.kind() != "end" and self.separator() and self.kind() != "end":
            value = self.number(True)
            self.blanks()
            if value is None or self.text() not in ALTITUDE_UNITS:
                return None
            height = value * KM_PER_UNIT[self.text()]
            self.at += 1
            self.blanks()
        return (lat, lon, height) if self.kind() == "end" else None


def read_point(text: str | None) -> tuple[float, float, float] | None:
    """(latitude, longitude, altitude in km) or None. The first place where a point can start wins."""
    if text is None:
        return None
    reader = _Reader(text)
    for start in range(len(reader.tokens)):
        if reader.kind(start - reader.at) == "number" or reader.text(start - reader.at) in ("N", "S", "+", "-"):
            point = reader.point(start)
            if point:
                return point
    return None
