"""Coordinate text (G9) on the JVM: one scan into tokens, then one pattern from the first place where it fits.

A text holds a latitude, a separator (blanks, comma, semicolon or slash), a
longitude and optionally another separator, an altitude and its unit. An angle
is a number of degrees, optionally with a degree sign and minutes and seconds,
and a compass letter in front or behind. Anything may stand before the latitude.
All Unicode blanks count as blanks, digits are 0 to 9. A point ends with the text
and has at most ``MOST_TOKENS`` tokens, so only as many places at the end are
tried, and each try is linear: every repeat in the pattern is possessive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoincident.functions.units import KM_PER_UNIT

# The marks of degrees, minutes and seconds, and the altitude units.
DEGREE_MARKS, MINUTE_MARKS, SECOND_MARKS = "°D*", "′'m", "″\"s"
ALTITUDE_UNITS = ("km", "m", "mi", "ft", "nm", "nmi")

#: of an angle 13 (letter, blank, sign, number, mark, blank, twice number, mark, blank, letter), of a separator 3, of an
#: altitude 5
MOST_TOKENS = 13 + 3 + 13 + 3 + 5

_BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_NUMBER = r"[0-9]++(?:\.[0-9]++)?+"
_TOKEN = rf"(?s){_NUMBER}|{_BLANK}++|km|nmi|nm|mi|ft|."


def _angle(plus: str, minus: str) -> str:
    """Groups: letter in front, degrees, minutes, seconds, letter behind, letter right behind the degrees."""
    letter, minute = f"[{plus}{minus}]", r"(?:[′']|m(?!i))"  # "mi" is a unit
    more = rf"(?={_NUMBER}(?:{minute}|[″\"s])|{letter})"
    return (rf"(?:({letter}){_BLANK}*+)?+([+-]?{_NUMBER})"
            rf"(?>(?:[{DEGREE_MARKS}]{_BLANK}*+|{_BLANK}++){more}"
            rf"(?:({_NUMBER}){minute}{_BLANK}*+)?+(?:({_NUMBER})[″\"s]{_BLANK}*+)?+({letter})?+"
            rf"|[{DEGREE_MARKS}]|({letter})|)")


_SEPARATOR = rf"(?:{_BLANK}++(?:[,;/]{_BLANK}*+)?+|[,;/]{_BLANK}*+)"
_UNITS = "|".join(sorted(ALTITUDE_UNITS, key=len, reverse=True))
_POINT = (rf"\A{_angle('N', 'S')}{_SEPARATOR}{_angle('E', 'W')}"
          rf"(?:{_SEPARATOR}(?:([+-]?{_NUMBER}){_BLANK}*+({_UNITS}){_BLANK}*+)?+)?+\z")


#: all groups in one text; none of them can hold a semicolon
_GROUPS = ";".join(f"${n}" for n in range(1, 15))


def _value(groups: Column, first: int, minus: str) -> Column:
    """Degrees of the angle whose groups begin at ``first``."""
    def group(n: int) -> Column:
        return groups[first + n - 1]

    def number(n: int, parts: float) -> Column:
        return F.coalesce(F.nullif(group(n), F.lit("")).cast("double"), F.lit(0.0)) / F.lit(parts)

    more = number(2, 60.0) + number(3, 3600.0)
    degrees = group(1).cast("double")
    # the sign of the degrees counts, so "-0 30m" stays positive
    value = F.when(degrees < 0, degrees - more).otherwise(degrees + more)
    letter = F.concat(group(0), group(4), group(5))  # the one in front wins
    return F.when(F.substring(letter, 1, 1) == minus, -value).otherwise(value)


def _read(groups: Column) -> Column:
    factors = F.create_map(*[x for u in ALTITUDE_UNITS for x in (F.lit(u), F.lit(float(KM_PER_UNIT[u])))])
    height = F.nullif(groups[12], F.lit("")).cast("double")
    return F.struct(_value(groups, 1, "S").alias("lat"), _value(groups, 7, "W").alias("lon"),
                    F.coalesce(height * F.try_element_at(factors, groups[13]), F.lit(0.0)).alias("alt_km"),
                    F.lit(True).alias("ok"))


def parsed_point(text: Column) -> Column:
    """Struct (lat, lon, alt_km, ok) of every text; ok is false and the others null where there is no point.

    The first place where a point can start wins.
    """
    tokens = F.regexp_extract_all(F.replace(text, F.lit("''"), F.lit('"')), F.lit(_TOKEN), F.lit(0))

    def ending(tokens: Column) -> Column:
        """The texts from each of the last tokens on that are points."""
        size = F.size(tokens)
        starts = F.when(size > 0, F.sequence(F.greatest(F.lit(1), size - F.lit(MOST_TOKENS - 1)), size)).otherwise(
            F.array().cast("array<int>"))
        starts = F.filter(starts, lambda i: F.substring(tokens[i - 1], 1, 1).rlike("[0-9NS+-]"))
        return F.filter(F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(MOST_TOKENS)), "")),
                        lambda t: t.rlike(_POINT))

    # bound as a lambda's variable, the tokens and the point's groups are made once
    found = F.slice(F.flatten(F.transform(F.array(tokens), ending)), 1, 1)
    groups = F.transform(found, lambda t: F.split(F.regexp_replace(t, _POINT, _GROUPS), ";", -1))
    read = F.get(F.transform(groups, _read), F.lit(0))
    none = F.struct(*[F.lit(None).cast("double").alias(c) for c in ("lat", "lon", "alt_km")], F.lit(False).alias("ok"))
    return F.coalesce(read, none)
