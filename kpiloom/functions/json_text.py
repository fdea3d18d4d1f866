"""JSON found in free text: extraction, presence and typed access.

Validity is decided by ``try_parse_json``; reading text straight into a struct
would turn malformed input into a struct of NULLs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.expr import col

_FENCE = "```"


def strip(text: Column | str) -> Column:
    """Trim any white space, not just blanks."""
    return F.regexp_replace(col(text), r"^\s+|\s+$", "")


def _fenced(text: Column, tag: str, opening: str, closing: str) -> Column:
    pattern = rf"(?s){_FENCE}{tag}\s*({opening}.*?{closing})\s*{_FENCE}"
    hit = F.regexp_extract(text, pattern, 1)
    return F.when(text.contains(_FENCE + tag) & (hit != ""), hit)


def extract_json(text: Column | str, mode: str = "object") -> Column:
    """Candidate JSON inside a response.

    * ``object``: first object in a json-tagged fence
    * ``any_fence``: as ``object``; an untagged fence counts when no tagged one is there
    * ``array``: first array in a json-tagged fence
    * ``split``: everything between the fence marks, tagged fence first

    Without a hit the whole text is the candidate.
    """
    if mode == "split":
        raw = col(text)
        tagged = strip(F.split_part(F.split_part(raw, F.lit(_FENCE + "json"), F.lit(2)), F.lit(_FENCE), F.lit(1)))
        plain = strip(F.split_part(raw, F.lit(_FENCE), F.lit(2)))
        return (
            F.when(raw.contains(_FENCE + "json"), tagged).when(raw.contains(_FENCE), plain).otherwise(raw)
        )
    body = strip(text)
    if mode == "array":
        return F.coalesce(_fenced(body, "json", r"\[", r"\]"), body)
    found = _fenced(body, "json", r"\{", r"\}")
    if mode == "any_fence":
        untagged = F.when(~body.contains(_FENCE + "json"), _fenced(body, "", r"\{", r"\}"))
        found = F.coalesce(found, untagged)
    return F.coalesce(found, body)


def kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID or a numeric type name of a variant."""
    return F.regexp_extract(F.schema_of_variant(value), r"^([A-Z]+)", 1)


def field(value: Column, path: str, as_type: str) -> Column:
    """Typed value at a path; NULL when absent or not convertible."""
    return F.try_variant_get(value, path, as_type)


def present_or(value: Column, path: str, as_type: str, default: Column) -> Column:
    """Typed value at a path; ``default`` when it is absent, NULL when it is a JSON null."""
    return F.when(field(value, path, "variant").isNull(), default).otherwise(field(value, path, as_type))


def has_keys(value: Column, keys: list[str]) -> Column:
    """True when the value is an object holding every key (a JSON null counts)."""
    present = [field(value, f"$.{k}", "variant").isNotNull() for k in keys]
    return (kind(value) == "OBJECT") & reduce(lambda a, b: a & b, present)


def number(value: Column, path: str) -> Column:
    """Number at a path: numeric text converts, booleans are 1/0, the rest is NULL."""
    raw = field(value, path, "variant")
    as_bool = field(raw, "$", "boolean").cast("double")
    text = field(raw, "$", "string")
    return F.when(kind(raw) == "BOOLEAN", as_bool).otherwise(text.try_cast("double"))


def truthy(value: Column, path: str) -> Column:
    """Python truth of a JSON value: null, false, 0, "" and empty containers are false."""
    raw = field(value, path, "variant")
    text = field(raw, "$", "string")
    empty_object = F.to_json(raw) == "{}"
    return (
        F.when(kind(raw) == "VOID", False)
        .when(kind(raw) == "BOOLEAN", field(raw, "$", "boolean"))
        .when(kind(raw) == "STRING", text != "")
        .when(kind(raw) == "OBJECT", ~empty_object)
        .when(kind(raw) == "ARRAY", F.size(field(raw, "$", "array<variant>")) > 0)
        .otherwise(field(raw, "$", "double") != 0)
    )
