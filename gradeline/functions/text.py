"""Text expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeline.functions.dates import as_column

# Fixed value: what separates two words
WORD_GAP = r"[^\p{L}\p{N}]+"


def normalised(text: Column | str) -> Column:
    """Lower case without white space at either end."""
    return F.lower(F.regexp_replace(as_column(text), r"^\s+|\s+$", ""))


def words(text: Column | str) -> Column:
    """Lower-case words of the whole text; a NULL text has none."""
    parts = F.split(F.lower(F.coalesce(as_column(text), F.lit(""))), WORD_GAP)
    return F.array_remove(parts, "")


def joined(parts: list[Column], separator: str = "", skip_null: bool = False) -> Column:
    """Parts put together. One NULL part makes the whole NULL unless ``skip_null`` is set."""
    if skip_null:
        return F.concat_ws(separator, *parts)
    pieces: list[Column] = []
    for part in parts:
        if pieces and separator:
            pieces.append(F.lit(separator))
        pieces.append(part)
    return F.concat(*pieces)
