"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let
from .times import offset_text

# Fixed value: the URL name space of RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5_url(name: Column) -> Column:
    """Name-based UUID (version 5, URL name space) of a text."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))

    def layout(h: Column) -> Column:
        # Version nibble 5; the variant nibble keeps its two low bits and gets the prefix 10.
        variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab" * 4)
        return F.concat(
            F.substring(h, 1, 8), F.lit("-"),
            F.substring(h, 9, 4), F.lit("-5"),
            F.substring(h, 14, 3), F.lit("-"),
            variant, F.substring(h, 18, 3), F.lit("-"),
            F.substring(h, 21, 12),
        )

    return let(digest, layout)


def surrogate_id(start: Column, end: Column, region_code: Column, region_name: Column) -> Column:
    """Id of a flight reported without one: UUID of `start|end|region`, null without times.

    The region is its code unless empty, else its name; a null region is left out.
    """
    region = F.coalesce(F.nullif(region_code, F.lit("")), region_name)
    parts = F.struct(start.alias("s"), end.alias("e"), region.alias("r"))
    base = let(parts, lambda p: F.concat_ws("|", offset_text(p.s), offset_text(p.e), p.r))
    return F.when(start.isNotNull() & end.isNotNull(), uuid5_url(base))
