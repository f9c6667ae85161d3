"""JSON kept in text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_object(column: Column) -> Column:
    """Whether the whole text is one JSON object; never NULL.

    The JSON functions stop at the end of the first value. Inside brackets and inside braces the
    text must also end there: what may follow it differs, so no trailing text passes both.
    """
    alone = F.json_array_length(F.concat(F.lit("["), column, F.lit("]"))) == 1
    inner = F.size(F.json_object_keys(F.concat(F.lit('{"":'), column, F.lit("}")))) == 1
    strict = F.from_json(column, "map<string,variant>", STRICT).isNotNull()
    return F.coalesce(F.json_object_keys(column).isNotNull() & alone & inner & strict, F.lit(False))


def has_any_key(column: Column, keys: list[str]) -> Column:
    """Whether the text is a JSON object with one of ``keys``; never NULL.

    Only texts that show a key, or an escape that may hide one, are parsed.
    """
    hints = [F.contains(column, F.lit(k)) for k in [*keys, "\\"]]
    present = F.arrays_overlap(F.json_object_keys(column), F.array(*[F.lit(k) for k in keys]))
    return F.when(reduce(Column.__or__, hints), F.coalesce(present & is_object(column), F.lit(False))).otherwise(False)


def without_keys(column: Column, keys: list[str]) -> Column:
    """The object without ``keys``. Text without any of them comes back byte for byte."""
    fields = F.from_json(column, "map<string,variant>", STRICT)
    kept = F.map_filter(fields, lambda key, _: ~key.isin(*keys))
    return F.when(has_any_key(column, keys), F.to_json(kept)).otherwise(column)
