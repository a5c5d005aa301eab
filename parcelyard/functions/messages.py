"""Checks on one event message."""

from pyspark.sql import Column, functions as F

# fixed values: keys every event message must have
REQUIRED_KEYS = ("event_id", "order_id", "event_type", "event_timestamp", "produced_at")

_STRICT = {"allowSingleQuotes": "false"}


def decoded_text(value: Column) -> Column:
    """Bytes to text; NULL for bytes that are not UTF-8."""
    text = value.cast("string")
    return F.when(F.is_valid_utf8(text), text)


def end_mark(text: Column) -> Column:
    """The digest of a text, which no text can hold."""
    return F.sha2(text, 256)


def parsed_parts(text: Column, mark: Column) -> Column:
    """The message as the first of two array elements; NULL if that is not JSON.

    The parser stops at the end of the first value, so `{"a":1}}` alone would pass. With a known element
    after it, trailing text breaks the array. Its key is the text's end mark.
    """
    closed = F.concat(F.lit("["), text, F.lit(',{"'), mark, F.lit('":null}]'))
    return F.from_json(closed, "array<map<string,string>>", _STRICT)


def object_fields(parts: Column, mark: Column) -> Column:
    """The top-level fields of a message that is one JSON object; NULL for anything else."""
    whole = (F.size(parts) == 2) & F.coalesce(F.map_contains_key(F.get(parts, F.lit(1)), mark), F.lit(False))
    return F.when(whole, F.get(parts, F.lit(0)))


def required_values(text: Column) -> Column:
    """The required keys' values as one struct of texts; the last one if a message repeats a key, as JSON readers of
    files have it."""
    return F.from_json(text, ", ".join(f"{k} string" for k in REQUIRED_KEYS), _STRICT)


def is_other_json(text: Column, mark: Column) -> Column:
    """JSON, but not an object. What starts like an object is not parsed again: it is one or broken."""
    parts = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')), "array<string>", _STRICT)
    return F.coalesce(~text.rlike(r"^[ \t\r\n]*\{") & (F.size(parts) == 2) & (F.get(parts, F.lit(1)) == mark), F.lit(False))


def lacks_required_key(fields: Column) -> Column:
    """A key must be present; its value may be null."""
    wanted = F.array(*[F.lit(k) for k in REQUIRED_KEYS])
    return F.size(F.array_except(wanted, F.map_keys(fields))) > 0
