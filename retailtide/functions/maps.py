"""Maps out of records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def last_values(entries: Column) -> Column:
    """A map of (key, value) entries; of a repeated key the last value stays.

    ``entries`` is worked out once. Repeats are found by sorting, so a record of many
    keys costs no more than its sort.
    """

    def without_repeats(found: Column) -> Column:
        places = F.array_sort(F.transform(found, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"))))

        def last(sorted_places: Column) -> Column:
            # the place after the last one is null, which equals no key
            following = F.transform(F.slice(sorted_places, 2, F.size(found)), lambda p: p["key"])
            marked = F.zip_with(sorted_places, following, lambda p, key: F.struct(p["at"].alias("at"), p["key"].eqNullSafe(key).alias("again")))
            kept = F.array_sort(F.transform(F.filter(marked, lambda p: ~p["again"]), lambda p: p["at"]))
            return F.transform(kept, lambda i: found[i])

        return bound(places, last)

    def as_map(found: Column) -> Column:
        return F.map_from_entries(F.when(no_repeats(found["key"]), found).otherwise(without_repeats(found)))

    return bound(entries, as_map)


def no_repeats(keys: Column) -> Column:
    """Whether each key is there and stands once."""
    return F.size(F.array_compact(F.array_distinct(keys))) == F.size(keys)
