"""Reading a model's call out of its free-text reply, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeline.functions.dates import as_column
from gradeline.functions.scores import CALLS
from gradeline.functions.text import normalised

# The shortest and the longest braced block, tried in this order
BLOCK_PATTERNS = (r"(?s)\{.*?\}", r"(?s)\{.*\}")
DEFAULT_CONFIDENCE = "low"
DEFAULT_REASONING = ""

_REPLY_TYPE = "array<struct<call: string, confidence: string, reasoning: string>>"
_RESULT_TYPE = "struct<call: string, confidence: string, reasoning: string>"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _result(block: Column, reply: Column) -> Column:
    call = normalised(reply["call"])

    def field(name: str, default: str) -> Column:
        named = F.array_contains(F.json_object_keys(block), name)
        return F.when(reply[name].isNull() & ~F.coalesce(named, F.lit(False)), F.lit(default)).otherwise(reply[name])

    return F.when(
        call.isin(*CALLS),
        F.struct(
            call.alias("call"),
            field("confidence", DEFAULT_CONFIDENCE).alias("confidence"),
            field("reasoning", DEFAULT_REASONING).alias("reasoning"),
        ).cast(_RESULT_TYPE),
    )


def _read_block(block: Column) -> Column:
    # Wrapped as a one-element array: text after the object then makes the document invalid.
    parsed = F.from_json(F.concat(F.lit("["), block, F.lit("]")), _REPLY_TYPE, {"allowSingleQuotes": "false"})
    return _bind(parsed, lambda p: F.when(F.size(p) == 1, _result(block, F.get(p, F.lit(0)))))


def parse_reply(text: Column | str) -> Column:
    """Struct (call, confidence, reasoning) of the first block with a valid call, else NULL."""
    text = as_column(text)
    shortest, longest = (F.regexp_extract(text, pattern, 0) for pattern in BLOCK_PATTERNS)
    blocks = F.struct(shortest.alias("shortest"), longest.alias("longest"))
    return _bind(
        blocks,
        lambda b: F.coalesce(
            F.when(b["shortest"] != "", _read_block(b["shortest"])),
            F.when(b["longest"] != b["shortest"], _read_block(b["longest"])),
        ),
    )
