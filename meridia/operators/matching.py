"""Matching the stops of ordered lists to candidate records, with tiers of tie-breaks.

Candidates are ranked by (tier, metres, id), and the least is chosen. What a
name's candidates say of themselves is one row for each name, and settles lines
where tracks tell all candidates apart; only lines with a stop that looks at
the choice before it are walked. They are dealt into parts, and a part gets the
candidates of its names once, not for each stop: the walk looks for the nearest
one along the longitude, all lines of a part at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridia.operators.storage import materialise

RESULT = "line_id string, seq int, station_id string, candidates int, match_method string"
#: Tiers of a rank: by the track, or by the stop before.
TRACK, SEQUENCE = 0, 1
#: Stops of walked lines in a part.
STOPS_A_PART = 100_000


def _rank(candidate: tuple, by_track: bool, previous: tuple[float, float] | None) -> tuple[int, float, str]:
    name, lon, lat, track_m = candidate
    if by_track and track_m is not None:
        return TRACK, track_m, name
    return SEQUENCE, 0.0 if previous is None else (lon - previous[0]) ** 2 + (lat - previous[1]) ** 2, name


def choose(found: list[tuple], kind: str, previous: tuple[float, float] | None) -> tuple[tuple | None, str | None]:
    """Of (id, lon, lat, metres to a track or None): the chosen one and how.

    Tracks count on a full line, and at the first stop of any; after them, and
    elsewhere, the way from the stop before.
    """
    ranks = {_rank(c, kind == "full" or previous is None, previous): c for c in found}
    if not ranks:
        return None, None
    best = min(ranks)
    return ranks[best], "unique" if len(found) == 1 else "track" if best[0] == TRACK else "sequence"


def match_stops(stops: DataFrame, candidates: DataFrame) -> DataFrame:
    """Match each line's stops in order, as ``choose`` does with the choice before.

    ``stops``: line_id, seq (its key), kind, name. ``candidates``: name, station_id,
    lon, lat, track_m (null if no track is near). The stops of walked lines are
    written to the shared folder first. A stop without candidates has a null station.
    """
    candidates = candidates.where("name IS NOT NULL AND station_id IS NOT NULL").select("name", "station_id", "lon", "lat", "track_m")
    rank = F.struct(F.col("track_m").isNull().alias("far"), "track_m", "station_id")
    told = candidates.groupBy("name").agg(F.min(rank).alias("best"), F.count("*").cast("int").alias("candidates"))
    each = stops.select("line_id", F.col("seq").cast("int").alias("seq"), F.coalesce(F.col("kind") == "full", F.lit(False)).alias("full"), "name").join(told, "name", "left")
    unsure = F.coalesce((F.col("candidates") > 1) & (~F.col("full") | F.col("best.far")), F.lit(False))
    each = each.select("line_id", "seq", "full", "name", "best.station_id", F.coalesce("candidates", F.lit(0)).alias("candidates"), F.max(unsure).over(Window.partitionBy("line_id")).alias("open"))
    each = materialise(each, "stops")
    method = F.when(F.col("candidates") == 1, "unique").when(F.col("candidates") > 1, "track")
    settled = each.where("NOT open").select("line_id", "seq", "station_id", "candidates", method.alias("match_method"))
    walked = each.where("open")
    parts = -(-walked.count() // STOPS_A_PART)
    if not parts:
        return settled
    walked = walked.select(F.pmod(F.xxhash64("line_id"), F.lit(parts)).alias("part"), "line_id", "seq", "full", "name")
    met = walked.select(F.col("part").alias("met_in"), F.col("name").alias("met")).distinct()
    found = met.join(candidates, F.col("met") == F.col("name")).select(F.col("met_in").alias("of"), F.col("met").alias("name"), "station_id", "lon", "lat", "track_m")
    return settled.union(walked.groupBy("part").cogroup(found.groupBy("of")).applyInPandas(_walk, RESULT))


def _walk(stops: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    """The choices for all lines of a part: one place in the lines after the other."""
    names = pd.Index(found["name"].unique())
    code = names.get_indexer(found["name"])
    order = np.lexsort((found["lon"].to_numpy(float), code))
    found, code = found.iloc[order], code[order]
    ids, track = found["station_id"].to_numpy(object), found["track_m"].to_numpy(float)
    lon, lat = found["lon"].to_numpy(float), found["lat"].to_numpy(float)
    by_id = np.unique(ids.astype(str), return_inverse=True)[1]
    ends = np.searchsorted(code, np.arange(len(names) + 1))
    best = np.lexsort((by_id, np.nan_to_num(track), np.isnan(track), code))[ends[:-1]]
    own = names.get_indexer(stops["name"])
    line = pd.factorize(stops["line_id"])[0]
    rows = np.lexsort((stops["seq"].to_numpy(), line))
    rows = rows[own[rows] >= 0]  # a stop without candidates leaves the choice before it as it is
    line, own_code, full = line[rows], own[rows], stops["full"].to_numpy(bool)[rows]
    first = np.flatnonzero(np.diff(line, prepend=-1))
    place = np.arange(len(rows)) - np.repeat(first, np.diff(first, append=len(rows)))
    chosen = best[own_code]
    open_ = (place > 0) & ~(full & ~np.isnan(track[chosen]))
    at = np.flatnonzero(open_)
    for at in np.split(at[np.argsort(place[at], kind="stable")], np.flatnonzero(np.diff(np.sort(place[at]))) + 1):
        pairs, where = np.unique(own_code[at] * len(ids) + chosen[at - 1], return_inverse=True)
        wanted, before = np.divmod(pairs, max(1, len(ids)))
        chosen[at] = _nearest(lon, lat, by_id, ends[wanted], ends[wanted + 1], lon[before], lat[before])[where]
    n = np.zeros(len(stops), dtype="int32")
    n[rows] = np.diff(ends)[own_code]
    station, method = np.full(len(stops), None, dtype=object), np.full(len(stops), None, dtype=object)
    station[rows] = ids[chosen]
    by_track = (full | (place == 0)) & ~np.isnan(track[chosen])
    method[rows] = np.where(n[rows] == 1, "unique", np.where(by_track, "track", "sequence"))
    return pd.DataFrame({"line_id": stops["line_id"], "seq": stops["seq"], "station_id": station, "candidates": n, "match_method": method})


def _nearest(lon: np.ndarray, lat: np.ndarray, by_id: np.ndarray, begin: np.ndarray, end: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each point (x, y) the nearest record of begin to end, which are sorted by lon; of equal ones the first by id."""
    low, high = begin.copy(), end.copy()
    while (going := low < high).any():
        middle = np.where(going, (low + high) // 2, begin)
        less = going & (lon[middle] < x)
        low, high = np.where(less, middle + 1, low), np.where(going & ~less, middle, high)
    best, least = np.full(len(x), -1), np.full(len(x), np.inf)
    # outwards from the point, until the longitude alone is further than the best
    for step, at in ((1, low.copy()), (-1, low - 1)):
        active = np.arange(len(x))
        while len(active := active[(begin[active] <= at[active]) & (at[active] < end[active])]):
            i = at[active]
            gap = (lon[i] - x[active]) ** 2
            far = gap + (lat[i] - y[active]) ** 2
            better = (best[active] < 0) | (far < least[active]) | ((far == least[active]) & (by_id[i] < by_id[best[active]]))
            best[active[better]], least[active[better]] = i[better], far[better]
            active = active[gap <= least[active]]
            at[active] += step
    return best
