"""Text functions as column expressions: units, names, hosts, tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres of a height, storeys, and power with its unit in megawatts.
HEIGHT = r"^\s*([0-9]+(\.[0-9]+)?)\s*(m)?\s*$"
LEVELS = r"^\s*([0-9]+)\s*$"
POWER = r"^\s*([0-9]+(\.[0-9]+)?)\s*(gw|mw|kw)p?\s*$"
MEGAWATTS = {"gw": 1000.0, "mw": 1.0, "kw": 0.001}
#: Roman numerals of generations.
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")


def height_m(value: Column) -> Column:
    return F.when(value.rlike(HEIGHT), F.regexp_extract(value, HEIGHT, 1).cast("double"))


def levels(value: Column) -> Column:
    return F.when(value.rlike(LEVELS), F.regexp_extract(value, LEVELS, 1).cast("int"))


def power_mw(value: Column) -> Column:
    low = F.lower(value)
    factor = F.regexp_extract(low, POWER, 3)
    scaled = F.regexp_extract(low, POWER, 1).cast("double") * lookup(factor, MEGAWATTS)
    return F.when(low.rlike(POWER), scaled)


def lookup(key: Column, table: Mapping) -> Column:
    """The key's value in a small fixed table, null if it has none."""
    flat = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*flat), key)


def roman(value: Column) -> Column:
    """The number that a text like ``generation-iv`` ends with."""
    return lookup(F.element_at(F.split(F.lower(value), "-"), -1), {r: i for i, r in enumerate(ROMAN, 1)})


def by_prefix(name: Column, category: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The category of the first prefix that the name has, if its own is one of the rules' categories."""
    out = category
    own = category.isin(*(c for _, c in rules))
    for prefix, target in reversed(rules):
        out = F.when(own & name.rlike(f"^{prefix}"), target).otherwise(out)
    return out


def split_list(value: Column, separator: str = ";") -> Column:
    """The trimmed parts of a list in a text, blank ones dropped; null stays null."""
    return F.filter(F.transform(F.split(value, f"[{separator}]"), lambda x: F.trim(x)), lambda x: x != "")


def publisher_group(url: Column, groups: Mapping[str, str]) -> Column:
    """The group of a URL's host: of the host itself or the domain above it that is listed; else the host."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    out = host
    for domain, group in sorted(groups.items(), key=lambda x: len(x[0])):
        out = F.when((host == domain) | host.endswith(f".{domain}"), group).otherwise(out)
    return out


def seed_problems(source_url: Column, other_sources: Column, confidence: Column, required: Sequence[Column], groups: Mapping[str, str], forbidden: Sequence[str], ranks: Sequence[str], needs_two: str) -> Column:
    """What is wrong with a row of a hand-made table, as an array of texts."""
    others = F.coalesce(split_list(other_sources), F.array())
    urls = F.concat(F.array(source_url), others)
    hosts = F.array_distinct(F.transform(urls, lambda u: publisher_group(u, groups)))
    secure = F.forall(urls, lambda u: F.coalesce(u.startswith("https://"), F.lit(False)))
    banned = F.exists(urls, lambda u: F.coalesce(F.lower(F.try_parse_url(u, F.lit("HOST"))).isin(*forbidden), F.lit(False)))
    blank = F.exists(F.array(*(F.coalesce(F.trim(c), F.lit("")) for c in required)), lambda x: x == "")
    rules = [(~secure, "a source is not https"), (banned, "a source is on a forbidden host"), (~F.coalesce(confidence.isin(*ranks), F.lit(False)), "unknown confidence"), (blank, "a required field is empty"), ((confidence == needs_two) & (F.size(hosts) < 2), "needs two independent publishers")]
    return F.array_compact(F.array(*(F.when(bad, text) for bad, text in rules)))
