"""Text expressions shared by the event-listing readers."""

from __future__ import annotations

from .numeric import Sql

# fixed pattern: decimal number with E or Fortran D exponent
_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eEdD][+-]?[0-9]+)?$"


def fortran_double(x: Sql) -> Sql:
    """DOUBLE from text that may carry a Fortran exponent; NULL if malformed."""
    return f"if({x} rlike '{_NUMBER}', try_cast(translate({x}, 'Dd', 'Ee') as double), null)"


def fields(line: Sql) -> Sql:
    """Blank-separated fields of a line without tabs.

    A single-character split needs no pattern compilation per line, so the
    empty pieces between repeated blanks are dropped afterwards.
    """
    return f"filter(split({line}, ' '), x -> x <> '')"


def content_lines(text: Sql) -> Sql:
    """Trimmed non-empty lines; tabs and carriage returns become blanks."""
    return (
        f"filter(transform(split(translate({text}, '\\t\\r', '  '), '\n'), l -> trim(l)), l -> l <> '')"
    )
