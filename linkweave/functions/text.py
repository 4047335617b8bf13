"""Text helpers for ids, lines and directory names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters up to U+0020 count as blanks when an id is trimmed.
BLANKS = "".join(map(chr, range(0x21)))


def trim_blanks(value: Column) -> Column:
    return F.trim(value, F.lit(BLANKS))


def field_at(fields: Column, position: int) -> Column:
    """A field of a split line, trimmed; null if the line ends before it.

    Empty fields at the end of a line do not count as fields.
    """
    value = F.get(fields, F.lit(position))
    rest = F.slice(fields, position + 1, F.size(fields))
    present = (value != "") | F.exists(rest, lambda field: field != "")
    return trim_blanks(F.when(present, value))


def action_dir_name(action: Column) -> Column:
    """Directory name of an action: lower case, `_` as `-`, blank as `.`."""
    return F.translate(F.lower(action), "_ ", "-.")


def extension_for(delim: str) -> str:
    return ".csv" if delim == "," else ".tsv"
