"""Ordered record headers: lookup, replacement and text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import bound


def header_list(pairs: dict[str, Column]) -> Column:
    """Headers from names and text columns; pairs whose value is null are left out."""
    items = [
        F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value")) for k, v in pairs.items()
    ]
    return F.filter(F.array(*items), lambda h: h["value"].isNotNull())


def header(headers: str | Column, name: str) -> Column:
    """Text of the last header of that name, or null."""
    column = F.col(headers) if isinstance(headers, str) else headers
    found = F.filter(column, lambda h: h["key"] == name)
    return F.try_element_at(found, F.lit(-1))["value"].cast("string")


def headers_map(headers: str | Column) -> Column:
    """Names to text, the last occurrence of a name wins."""
    column = F.col(headers) if isinstance(headers, str) else headers

    def keep_last(hs):
        names = F.transform(hs, lambda h: h["key"])
        last = F.filter(hs, lambda h, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), h["key"]))
        return F.map_from_entries(F.transform(last, lambda h: F.struct(h["key"], h["value"].cast("string"))))

    return bound(column, keep_last)


def put_headers(headers: str | Column, updates: dict[str, Column]) -> Column:
    """Replace the first header of each name in place, append the names not present."""
    column = F.col(headers) if isinstance(headers, str) else headers
    old = F.coalesce(column, F.array().cast("array<struct<key:string,value:binary>>"))

    def merge(pair):
        def replaced(h, i):
            at = F.array_position(pair["names"], h["key"])
            first = (at > 0) & (F.array_position(pair["held"], h["key"]) == i + 1)
            value = F.when(first, F.get(pair["new"], (at - 1).cast("int"))["value"]).otherwise(h["value"])
            return F.struct(h["key"].alias("key"), value.alias("value"))

        added = F.filter(pair["new"], lambda u: ~F.array_contains(pair["held"], u["key"]))
        return F.concat(F.transform(pair["old"], replaced), added)

    def with_names(new):
        # Both lists of names are made once, not once per header.
        return F.struct(
            old.alias("old"), new.alias("new"), F.transform(new, lambda u: u["key"]).alias("names"),
            F.transform(old, lambda h: h["key"]).alias("held"),
        )

    return bound(bound(header_list(updates), with_names), merge)


def set_header(headers: str | Column, name: str, value: Column) -> Column:
    return put_headers(headers, {name: value})


def format_headers(headers: str | Column) -> Column:
    """``k=v`` pairs sorted by name with one blank between, ``-`` when there are none."""
    pairs = F.array_sort(F.map_entries(headers_map(headers)))
    text = F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), " ")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("-"))
