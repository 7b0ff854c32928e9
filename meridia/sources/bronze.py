"""Raw files of a run: a source's folder counts once its metadata.json is there."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import re
from collections.abc import Iterable, Mapping, Sequence
from pathlib import Path, PurePosixPath

#: How files of a kind begin.
MAGIC = {".zip": b"PK", ".gz": b"\x1f\x8b", ".tif": (b"II*\x00", b"MM\x00*"), ".h5": b"\x89HDF", ".json": (b"{", b"[")}


class BronzeError(RuntimeError):
    pass


class Bronze:
    """Reads ``root/bronze/<source>/run_id=<id>/``; only sources whose run was closed exist."""

    def __init__(self, root: str | Path, run_id: str) -> None:
        self.root, self.run_id = Path(root), run_id

    def folder(self, source: str) -> Path:
        path = self.root / "bronze" / source / f"run_id={self.run_id}"
        if not (path / "metadata.json").is_file():
            raise BronzeError(f"{source}: run {self.run_id} was not closed")
        return path

    def metadata(self, source: str) -> dict:
        return json.loads((self.folder(source) / "metadata.json").read_text(encoding="utf-8"))

    def path(self, source: str, name: str) -> str:
        path = self.folder(source) / name
        if not path.is_file():
            raise BronzeError(f"{source}: no file {name}")
        return str(path)

    def by_category(self, source: str, categories: Sequence[str]) -> list[str]:
        """Files of the wanted first-level folders, by the metadata; a category without files is an error."""
        names = sorted(f["path"] for f in self.metadata(source)["files"])
        found = [n for n in names if PurePosixPath(n).parts[0] in categories]
        missing = sorted(set(categories) - {PurePosixPath(n).parts[0] for n in found})
        if missing:
            raise BronzeError(f"{source}: nothing for {missing}")
        return [self.path(source, n) for n in found]


def check_file(path: str | Path) -> None:
    """Raise unless the file begins as its kind does and, if compressed, reads to its end."""
    path = Path(path)
    wanted = MAGIC.get(path.suffix.lower())
    with path.open("rb") as f:
        head = f.read(8)
    if wanted and not head.startswith(wanted):
        raise BronzeError(f"{path.name}: is no {path.suffix} file")
    if path.suffix == ".gz":
        try:
            with gzip.open(path) as f:
                while f.read(1 << 20):
                    pass
        except (OSError, EOFError) as e:
            raise BronzeError(f"{path.name}: is cut off") from e


def close_run(root: str | Path, source: str, run_id: str, files: Iterable[Mapping], **facts) -> dict:
    """Write the commit marker: what the run holds, its checksum, and whether it is as the run before."""
    folder = Path(root, "bronze", source, f"run_id={run_id}")
    listed = []
    for f in sorted(files, key=lambda f: f["path"]):
        data = (folder / f["path"]).read_bytes()
        listed.append({**f, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()})
    checksum = hashlib.sha256("".join(f"{f['path']}\t{f['sha256']}\n" for f in listed).encode()).hexdigest()
    before = previous_run(root, source, run_id)
    old = json.loads((before / "metadata.json").read_text()) if before else {}
    told = {"source": source, "run_id": run_id, "files": listed, "bytes": sum(f["bytes"] for f in listed), "checksum": checksum, "previous_run_id": old.get("run_id"), "unchanged_vs_previous": old.get("checksum") == checksum, "warnings": [], **facts}
    part = folder / "metadata.part"
    part.write_text(json.dumps(told, indent=2, sort_keys=True), encoding="utf-8")
    os.replace(part, folder / "metadata.json")
    return told


def previous_run(root: str | Path, source: str, run_id: str) -> Path | None:
    """The last closed run before this one."""
    runs = sorted(p.parent for p in Path(root, "bronze", source).glob("run_id=*/metadata.json") if p.parent.name.removeprefix("run_id=") < run_id)
    return runs[-1] if runs else None


def reuse(root: str | Path, source: str, run_id: str, name: str) -> dict | None:
    """Link a file of the run before into this one if its checksum still holds."""
    before = previous_run(root, source, run_id)
    if not before:
        return None
    known = next((f for f in json.loads((before / "metadata.json").read_text())["files"] if f["path"] == name), None)
    old = before / name
    if not known or not old.is_file() or hashlib.sha256(old.read_bytes()).hexdigest() != known["sha256"]:
        return None
    new = Path(root, "bronze", source, f"run_id={run_id}", name)
    new.parent.mkdir(parents=True, exist_ok=True)
    new.unlink(missing_ok=True)
    os.link(old, new)
    return {"path": name, "reused_from": before.name.removeprefix("run_id=")}


def run_report(metadata: Iterable[Mapping]) -> dict:
    """Sums over the sources of a run."""
    all_of = list(metadata)
    return {"sources": len(all_of), "files": sum(len(m["files"]) for m in all_of), "bytes": sum(m["bytes"] for m in all_of), "unchanged": sum(bool(m.get("unchanged_vs_previous")) for m in all_of), "warnings": sum(len(m.get("warnings", [])) for m in all_of)}


# planning of requests ---------------------------------------------------------------------


def box_query(selectors: Sequence[str], out: str, timeout_s: int, box: Sequence[float] | None = None, around: tuple[float, float, float] | None = None, date: str | None = None) -> str:
    """A query in the map API's language: selectors in a box (S, W, N, E) or around (radius, lat, lon)."""
    if (box is None) == (around is None):
        raise ValueError("give a box or a point to look around")
    where = f"({','.join(map(repr, box))})" if box is not None else f"(around:{','.join(map(repr, around))})"
    head = f"[out:json][timeout:{timeout_s}]" + (f'[date:"{date}"]' if date else "") + ";"
    return head + "(" + "".join(f"{s}{where};" for s in selectors) + f");out {out};"


def plan_queries(categories: Mapping[str, Sequence[str]], boxes: Mapping[str, Sequence[float]]) -> list[tuple[str, str]]:
    """(category, box) of every query: each category in each of its boxes (``all``: every box)."""
    return [(c, b) for c, wanted in categories.items() for b in boxes if "all" in wanted or b in wanted]


def check_response(text: str, timeout_words: Sequence[str] = ("runtime error", "timed out", "out of memory")) -> dict:
    """The response as read; raises if it is cut off or says that the query failed. Times of making it are dropped."""
    try:
        told = json.loads(text)
    except ValueError as e:
        raise BronzeError("the response is cut off") from e
    remark = str(told.get("remark", ""))
    if any(w in remark.lower() for w in timeout_words):
        raise BronzeError(remark)
    told.get("osm3s", {}).pop("timestamp_osm_base", None)
    return told


def degree_tiles(box: Sequence[float], template: str = "{ns}{lat:02d}_{ew}{lon:03d}") -> list[str]:
    """Names of the one-degree tiles that a box (S, W, N, E) touches, by their south-west corners."""
    south, west, north, east = box
    floor = lambda v: int(v // 1)
    lats, lons = range(floor(south), -floor(-north)), range(floor(west), -floor(-east))
    return [template.format(ns="N" if a >= 0 else "S", lat=abs(a), ew="E" if o >= 0 else "W", lon=abs(o)) for a in lats for o in lons]


def tile_box(name: str, degrees: int = 10) -> tuple[int, int, int, int]:
    """Box (S, W, N, E) of a grid tile hXXvYY, counted from 180 W and 90 N."""
    h, v = map(int, re.search(r"h(\d\d)v(\d\d)", name).groups())
    west, north = h * degrees - 180, 90 - v * degrees
    return north - degrees, west, north, west + degrees


def select_tiles(listing: Iterable[str], pattern: str, wanted: Sequence[str]) -> dict[str, str]:
    """The one listed file of each wanted tile; ``pattern`` captures the tile. Missing or repeated ones are errors."""
    found: dict[str, str] = {}
    for name in listing:
        if (m := re.fullmatch(pattern, name)) and m[1] in wanted:
            if m[1] in found:
                raise BronzeError(f"{m[1]} is listed twice")
            found[m[1]] = name
    if missing := sorted(set(wanted) - set(found)):
        raise BronzeError(f"not listed: {missing}")
    return found
