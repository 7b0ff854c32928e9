"""The registry of sources: one YAML document, checked as a whole.

Rules are data: a shape for the top level, one for each source, one for the
parameters of each kind. A rule is a path, a test and what is wanted; ``*``
in a path stands for every item. All problems are reported at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from pathlib import Path
from typing import Any

Test = Callable[[Any], bool]
Rule = tuple[str, Test, str]

#: Extent that every box and point must lie in: south, west, north, east.
EXTENT = (20.0, 122.0, 46.0, 154.0)
#: Farthest radius around a point, ways of asking for geometry, days.
FARTHEST_M = 2000
OUT = ("center", "geom")
DAYS = range(1, 31)


def is_text(v: Any) -> bool:
    return isinstance(v, str) and bool(v.strip())


def is_https(v: Any) -> bool:
    return is_text(v) and v.startswith("https://")


def is_number(v: Any) -> bool:
    return isinstance(v, int | float) and not isinstance(v, bool)


def is_count(v: Any) -> bool:
    return isinstance(v, int) and not isinstance(v, bool) and v > 0


def matches(pattern: str) -> Test:
    return lambda v: isinstance(v, str) and re.fullmatch(pattern, v) is not None


def inside(lat: Any, lon: Any) -> bool:
    south, west, north, east = EXTENT
    return is_number(lat) and is_number(lon) and south <= lat <= north and west <= lon <= east


def is_box(v: Any) -> bool:
    return isinstance(v, list) and len(v) == 4 and all(map(is_number, v)) and v[0] < v[2] and v[1] < v[3] and inside(v[0], v[1]) and inside(v[2], v[3])


def some(test: Test = lambda v: True) -> Test:
    return lambda v: isinstance(v, list | dict) and len(v) > 0 and all(map(test, v.values() if isinstance(v, dict) else v))


def distinct(key: str) -> Test:
    return lambda v: isinstance(v, list) and len({x.get(key) for x in v if isinstance(x, dict)}) == len(v)


NAME = matches("[a-z][a-z0-9_]*")
SELECTOR = matches(r"(node|way|relation|nwr)(\[[^\]\[]+\])+")
STAMP = matches(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ")

TOP: tuple[Rule, ...] = (
    ("version", lambda v: v == 1, "is 1"),
    ("user_agent", lambda v: is_text(v) and ("+http" in v or "@" in v), "names a contact"),
    ("map_api.endpoint", is_https, "is an https address"),
    ("map_api.timeout_s", is_count, "is a positive number"),
    ("map_api.pause_s", is_count, "is a positive number"),
    ("map_api.snapshot_date", lambda v: v is None or STAMP(v), "is null or a UTC time"),
    ("boxes", some(), "has boxes"),
    ("boxes.*", is_box, "is [south, west, north, east] inside the extent"),
    ("sources", some(lambda v: isinstance(v, dict)), "has sources"),
    ("sources", distinct("id"), "has each id once"),
)

SOURCE: tuple[Rule, ...] = (
    ("id", NAME, "is a lower-case name"),
    ("url", is_https, "is an https address"),
    ("license.id", is_text, "is given"),
    ("license.name", is_text, "is given"),
    ("license.url", is_https, "is an https address"),
    ("attribution", is_text, "is given"),
    ("feeds", some(is_text), "names tables"),
    ("days", some(lambda v: v in DAYS), "is a list of days from 1 to 30"),
    ("params", lambda v: isinstance(v, dict), "is a mapping"),
)

KINDS: dict[str, tuple[Rule, ...]] = {
    "http_files": (("files", some(), "has files"), ("files", distinct("name"), "has each name once"), ("files.*.name", is_text, "is given"), ("files.*.url", is_https, "is an https address")),
    "overpass": (("categories", some(), "has categories"), ("categories", distinct("id"), "has each id once"), ("categories.*.id", NAME, "is a lower-case name"), ("categories.*.selectors", some(SELECTOR), "is a list of types with tag filters only"), ("categories.*.out", lambda v: v in OUT, f"is one of {OUT}"), ("categories.*.bboxes", lambda v: v == "all" or some(is_text)(v), "is all or names of boxes")),
    "overpass_around": (("center", lambda v: isinstance(v, dict) and inside(v.get("lat"), v.get("lon")), "is a point inside the extent"), ("radius_m", lambda v: is_count(v) and v <= FARTHEST_M, f"is at most {FARTHEST_M}"), ("selectors", some(SELECTOR), "is a list of types with tag filters only"), ("out", lambda v: v in OUT, f"is one of {OUT}")),
    "sparql": (("queries", some(), "has queries"), ("queries.*.id", is_text, "is given"), ("queries.*.file", is_text, "is given")),
    "rest_json": (("resources", some(is_text), "names resources"),),
    "cog_tiles": (("bucket", is_text, "is given"), ("region", is_text, "is given"), ("tile_name", lambda v: is_text(v) and "{lat}" in v and "{lon}" in v, "has {lat} and {lon}"), ("aois", some(), "has areas"), ("aois.*", is_box, "is [south, west, north, east] inside the extent")),
    "earthdata_tiles": (("product", is_text, "is given"), ("collection", lambda v: v is not None, "is given"), ("year", is_count, "is a year"), ("archive_url", lambda v: is_https(v) and "{year}" in v, "is an https address with {year}"), ("token_env", matches("[A-Z][A-Z0-9_]*"), "names an environment variable"), ("tiles", some(matches(r"h\d\dv\d\d")), "is a list of tiles hXXvYY"), ("crop_bbox", is_box, "is [south, west, north, east] inside the extent"), ("layers", some(is_text), "names layers")),
    "local_csv": (("dir", is_text, "is given"), ("files", some(), "has files"), ("files.*.name", is_text, "is given"), ("files.*.file", is_text, "is given"), ("files.*.required_columns", lambda v: isinstance(v, list) and "source_url" in v, "requires source_url")),
}


def values_at(told: Any, path: str) -> Iterator[tuple[str, Any]]:
    """Each place that the path leads to, with its value; a missing one has None."""
    places = [("", told)]
    for step in path.split("."):
        found = []
        for where, v in places:
            if step == "*":
                items = v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ()
                found += [(f"{where}[{k}]", x) for k, x in items]
            else:
                found.append((f"{where}.{step}" if where else step, v.get(step) if isinstance(v, Mapping) else None))
        places = found
    yield from places


def _broken(told: Any, rules: tuple[Rule, ...], where: str = "") -> list[str]:
    return [f"{where}{place}: not so that it {wanted}" for path, test, wanted in rules for place, v in values_at(told, path) if not test(v)]


def problems(told: Any, folder: str | Path = ".", required: frozenset[str] = frozenset(), tables: frozenset[str] = frozenset(), resources: frozenset[str] = frozenset()) -> list[str]:
    """Everything that is wrong with a registry.

    ``folder`` holds query files; ``required`` ids must be there; ``tables`` and
    ``resources``, if given, are all that may be fed and fetched.
    """
    if not isinstance(told, dict):
        return ["the registry is not a mapping"]
    out = _broken(told, TOP)
    sources = [s for s in told.get("sources") or [] if isinstance(s, dict)]
    boxes = set(told.get("boxes") or {})
    for s in sources:
        where, kind, params = f"{s.get('id')}: ", s.get("kind"), s.get("params")
        out += _broken(s, SOURCE, where)
        if kind not in KINDS:
            out.append(f"{where}unknown kind {kind}")
        elif isinstance(params, dict):
            out += _broken(params, KINDS[kind], where)
        if tables and not set(s.get("feeds") or []) <= tables:
            out.append(f"{where}feeds tables that are not known")
        for _, names in values_at(params, "categories.*.bboxes"):
            if isinstance(names, list) and not set(names) <= boxes:
                out.append(f"{where}boxes that are not known")
        for _, file in values_at(params, "queries.*.file"):
            if is_text(file) and not Path(folder, file).is_file():
                out.append(f"{where}no file {file}")
        if kind == "rest_json" and resources and isinstance(params, dict) and not set(params.get("resources") or []) <= resources:
            out.append(f"{where}resources that may not be fetched")
    missing = sorted(required - {s.get("id") for s in sources})
    return [*out, *([f"sources are missing: {missing}"] if missing else [])]


def feeds(told: Mapping) -> dict[str, list[str]]:
    """The tables that each source feeds, for ``quality.contracts.against_registry``."""
    return {s["id"]: list(s["feeds"]) for s in told["sources"]}
