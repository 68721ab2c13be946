"""Map and tag expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_tags(arr) -> Column:
    """``array<string>`` of ``k=v`` -> ``map<string,string>``; split on
    the first ``=``; entries without ``=`` are dropped; a repeated key keeps
    its last value (dict semantics)."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    kept = F.filter(arr, lambda t: F.instr(t, "=") > 0)
    pairs = F.transform(kept, lambda t: F.struct(
        F.split(t, "=", 2).getItem(0).alias("key"), F.split(t, "=", 2).getItem(1).alias("value")))
    return merge_entries(pairs)


def merge_entries(entries: Column) -> Column:
    """``array<struct<key,value>>`` -> map, the last entry of a key winning
    (``map_from_entries`` raises on duplicate keys under the default policy)."""
    keys = F.transform(entries, lambda e: e["key"])
    last = F.filter(F.transform(entries, lambda e, i: F.struct(
        e["key"].alias("key"), e["value"].alias("value"), i.alias("i"))),
        lambda e: F.array_position(F.reverse(keys), e["key"]) == F.size(keys) - e["i"])
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"].alias("key"),
                                                                 e["value"].alias("value"))))


def merge_tags(old, new) -> Column:
    """Tags of ``new`` win over ``old`` (plain ``map_concat`` raises
    DUPLICATED_MAP_KEY)."""
    old = F.col(old) if isinstance(old, str) else old
    new = F.col(new) if isinstance(new, str) else new
    new_keys = F.map_keys(new)
    kept = F.map_filter(old, lambda k, v: ~F.array_contains(new_keys, k))
    return F.map_concat(kept, new)
