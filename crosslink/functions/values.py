"""Numbers, vectors, arrays and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def magnitude(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def rotated(v: Column, axis: str) -> Column:
    """A 3-vector turned by 90 degrees about x, y or z; ``none`` leaves it."""
    x, y, z = v[0], v[1], v[2]
    return {"none": v, "x90": F.array(x, -z, y), "y90": F.array(z, y, -x), "z90": F.array(-y, x, z)}[axis]


def clipped(value: Column, low: Column, high: Column) -> Column:
    """low -> 0, high -> 1, cut to that range; null unless high is above low."""
    return F.when(high > low, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - low) / (high - low))))


def band(value: Column, center: Column, half: Column, names: tuple[str, str, str] = ("contact", "no_contact", "refused")) -> Column:
    """At or above center + half, at or below center - half, or refused; null values are refused."""
    return F.when(value >= center + half, names[0]).when(value <= center - half, names[1]).otherwise(names[2])


def exact_mean(value: Column) -> Column:
    """The mean of a group, which does not depend on the order of its rows: a sum of doubles does, and so does what is decided at a limit.

    Values that 18 decimals hold are added as decimals; if one of a group is not (or the sum is over 20 digits), it has the mean of doubles.
    """
    decimal = value.try_cast("decimal(38,18)")
    held = F.count_if(decimal.cast("double") == value) == F.count(value)
    return F.coalesce(F.when(held, F.try_divide(F.try_sum(decimal), F.count(value)).cast("double")), F.avg(value))


def two_rules(stable: Column, moving: Column) -> Column:
    """static, dynamic, or refused if both tests or neither hold."""
    a, b = F.coalesce(stable, F.lit(False)), F.coalesce(moving, F.lit(False))
    return F.when(a & ~b, "static").when(b & ~a, "dynamic").otherwise("refused")


def entries(m: Column) -> Column:
    """A map as sorted entries, which compare and group."""
    return F.array_sort(F.map_entries(m))


def same_map(a: Column, b: Column) -> Column:
    return entries(a) == entries(b)


def interchanged(roles: Column, a: Column, b: Column) -> Column:
    """A map in which the fillers of two interchangeable roles stand in order; unchanged if one is not filled."""
    x, y = F.try_element_at(roles, a), F.try_element_at(roles, b)
    others = F.map_filter(roles, lambda k, _: (k != a) & (k != b))
    return F.when(x.isNotNull() & y.isNotNull() & (a != b), F.map_concat(others, F.map_from_arrays(F.array(a, b), F.array(F.least(x, y), F.greatest(x, y))))).otherwise(roles)


def renamed(roles: Column, names: Column) -> Column:
    """A map with its keys renamed by another map, unnamed keys kept; of keys that meet the first in order stays."""
    pairs = F.transform(entries(roles), lambda e: F.struct(F.coalesce(F.try_element_at(names, e["key"]), e["key"]).alias("key"), e["value"].alias("value")))
    first = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["key"]), p["key"]) == i + 1)
    return F.map_from_entries(first)


def inverse(names: Column) -> Column:
    """value -> key; of keys with the same value the first in order stays."""
    pairs = entries(names)
    first = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["value"]), p["value"]) == i + 1)
    return F.map_from_entries(F.transform(first, lambda p: F.struct(p["value"].alias("key"), p["key"].alias("value"))))


def participants_match(a: Column, b: Column, names: Column) -> Column:
    """Equal, or equal after renaming a's roles by the correspondence, or by its inverse."""
    return same_map(a, b) | F.coalesce(same_map(renamed(a, names), b) | same_map(renamed(a, inverse(names)), b), F.lit(False))


def sorted_unique(a: Column) -> Column:
    return a == F.array_sort(F.array_distinct(a))


def event_time(seconds: Column, first_frame: Column, rate: Column) -> Column:
    """Seconds since the first frame of a trial."""
    return seconds - first_frame / rate


def in_trial(seconds: Column, last: Column, slack: float = 1e-6) -> Column:
    return (seconds >= -slack) & (seconds <= last + slack)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null for b = 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))
