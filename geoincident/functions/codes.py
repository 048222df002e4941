"""Code → name decoding."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Victim descent letters and their names.
DESCENT_CODES = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "Z": "Asian Indian",
}


def decode(c, mapping: dict[str, str] = DESCENT_CODES) -> Column:
    """Look a code up in a literal map. Unknown or null code → null (the row
    is kept). The map is a constant folded into the plan: no join, no shuffle."""
    col = F.col(c) if isinstance(c, str) else c
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.when(col.isNotNull(), F.try_element_at(lookup, col))
