"""Values and envelope members as JSON text."""

from __future__ import annotations

import json
from json.decoder import WHITESPACE, scanstring

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: finds where a value ends; numbers stay texts, whatever their size
_DECODER = json.JSONDecoder(parse_float=str, parse_int=str)


def json_text(c: Column) -> Column:
    """A scalar as JSON text: strings keep their quotes."""
    return F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)


def _member_text(document: str, name: str) -> str | None:
    """The text of a member's value as it stands in a JSON object (of repeated members,
    the last); None without it, or if the document is no object."""
    blank = WHITESPACE.match
    try:
        at, found = blank(document, 0).end(), None
        if document[at] != "{":
            return None
        at = blank(document, at + 1).end()
        while document[at] != "}":
            key, at = scanstring(document, at + 1)
            at = blank(document, blank(document, at).end() + 1).end()
            _, end = _DECODER.raw_decode(document, at)
            if key == name:
                found = document[at:end]
            at = blank(document, end).end()
            if document[at] == ",":
                at = blank(document, at + 1).end()
        return found
    except (ValueError, IndexError):
        return None


@F.pandas_udf(T.StringType())
def _event_text(envelopes: pd.Series) -> pd.Series:
    return pd.Series([_member_text(x, "event") if isinstance(x, str) else None for x in envelopes], dtype=object)


def payload_json(envelope: Column, bare: bool = False) -> Column:
    """JSON text of the ``event`` member of an envelope, exactly as it was sent: decimals
    keep their zeros and numbers of any size their digits, which Spark's JSON functions
    would read as doubles. A missing member reads as null.

    ``bare``: every envelope holds that member alone, so a pattern cuts it in the JVM
    and the plan needs no Python.
    """
    whole = F.regexp_extract(envelope, r'(?s)^\s*\{\s*"event"\s*:\s*(.*?)\s*\}\s*$', 1)
    if bare:
        return F.when(whole != "", whole).otherwise(F.lit("null"))
    return F.coalesce(_event_text(envelope), F.lit("null"))
