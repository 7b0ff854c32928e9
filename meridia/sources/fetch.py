"""Filling a source's folder of a run: requests, reuse of the run before, resuming.

The transport is the caller's: a function of (url, headers, body) that gives
(status, headers, content). Nothing here opens a connection.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Mapping
from enum import StrEnum
from pathlib import Path

from meridia.sources.bronze import BronzeError, check_file, check_response, close_run, previous_run, reuse

Transport = Callable[[str, Mapping[str, str], bytes | None], tuple[int, Mapping[str, str], bytes]]
OK, NOT_MODIFIED = 200, 304


class Mode(StrEnum):
    """Where the answer to a query comes from: always asked, never asked, or asked if the run before has none."""

    QUERY = "query"
    REUSE = "reuse"
    REUSE_OR_QUERY = "reuse_or_query"


class OpenRun:
    """A run of one source that is being filled.

    Each file is noted in ``progress.jsonl`` when it is whole, so a run that was
    cut off goes on where it stopped. ``close`` makes it a run that readers see.
    """

    def __init__(self, root: str | Path, source: str, run_id: str, transport: Transport) -> None:
        self.root, self.source, self.run_id, self.transport = Path(root), source, run_id, transport
        self.folder = self.root / "bronze" / source / f"run_id={run_id}"
        self.folder.mkdir(parents=True, exist_ok=True)
        if (self.folder / "metadata.json").is_file():
            raise BronzeError(f"{source}: run {run_id} is closed")
        self.warnings: list[str] = []
        before = previous_run(root, source, run_id)
        self.known = {f["path"]: f for f in json.loads((before / "metadata.json").read_text(encoding="utf-8"))["files"]} if before else {}
        noted = self.folder / "progress.jsonl"
        lines = noted.read_text(encoding="utf-8").splitlines(keepends=True) if noted.is_file() else []
        whole = [json.loads(x) for x in lines if x.endswith("\n")]
        self.files = {f["path"]: f for f in whole if (self.folder / f["path"]).is_file()}
        if len(whole) < len(lines):  # the last line was being written
            noted.write_text("".join(lines[: len(whole)]), encoding="utf-8")

    def _note(self, told: dict) -> dict:
        with (self.folder / "progress.jsonl").open("a", encoding="utf-8") as f:
            f.write(json.dumps(told, sort_keys=True) + "\n")
        self.files[told["path"]] = told
        return told

    def _request(self, url: str, headers: Mapping[str, str], body: bytes | None, fine: tuple[int, ...] = (OK,)) -> tuple[int, Mapping[str, str], bytes]:
        status, given, content = self.transport(url, headers, body)
        if status not in fine:
            raise BronzeError(f"{self.source}: {url} answers {status}")
        return status, {k.lower(): v for k, v in given.items()}, content

    def write(self, name: str, content: bytes, **facts) -> dict:
        """A file, whole or not at all."""
        path = self.folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_name(f"part.{path.name}")
        part.write_bytes(content)
        try:
            check_file(part)
        except BronzeError:
            part.unlink()
            raise
        os.replace(part, path)
        return self._note({"path": name, **facts})

    def _again(self, name: str) -> dict | None:
        """The file of the run before with what was known of it."""
        linked = reuse(self.root, self.source, self.run_id, name)
        facts = {k: v for k, v in self.known.get(name, {}).items() if k not in ("bytes", "sha256")}
        return self._note({**facts, **linked}) if linked else None

    def download(self, name: str, url: str) -> dict:
        """A file of a URL; one that has not changed since the run before, by its ETag or date, is linked from there."""
        if name in self.files:
            return self.files[name]
        known = self.known.get(name, {}) if self.known.get(name, {}).get("url") == url else {}
        asked = {h: known[k] for h, k in (("If-None-Match", "etag"), ("If-Modified-Since", "last_modified")) if known.get(k)}
        status, given, content = self._request(url, asked, None, (OK, NOT_MODIFIED) if asked else (OK,))
        if status == NOT_MODIFIED:
            if found := self._again(name):
                return found
            _, given, content = self._request(url, {}, None)
        return self.write(name, content, url=url, etag=given.get("etag"), last_modified=given.get("last-modified"))

    def ask(self, name: str, endpoint: str, query: str, mode: Mode | str = Mode.QUERY) -> dict:
        """The map API's answer to a query. Only an answer to the same query is used again."""
        if name in self.files:
            return self.files[name]
        mode = Mode(mode)
        same = self.known.get(name, {}).get("query") == query
        if mode is not Mode.QUERY and same and (found := self._again(name)):
            return found
        if mode is Mode.REUSE:
            raise BronzeError(f"{self.source}: the run before has no answer to this query of {name}")
        _, _, content = self._request(endpoint, {}, query.encode())
        told = check_response(content.decode("utf-8"))
        return self.write(name, json.dumps(told, ensure_ascii=False).encode(), url=endpoint, query=query)

    def bindings(self, name: str, endpoint: str, query: str) -> dict:
        """Results of a knowledge base's query; none at all is an error."""
        if name in self.files:
            return self.files[name]
        _, _, content = self._request(endpoint, {"Accept": "application/sparql-results+json"}, query.encode())
        if not json.loads(content).get("results", {}).get("bindings"):
            raise BronzeError(f"{self.source}: {name} has no results")
        return self.write(name, content, url=endpoint, query=query)

    def crawl(self, index_url: str, listed: Callable[[dict], Iterable[tuple[str, str]]], allowed: str, refused: str) -> list[dict]:
        """An index and the documents that it lists as (name, url).

        A URL that ``allowed`` does not match whole, and a document that holds
        what ``refused`` matches, is an error.
        """
        self.download("index.json", index_url)
        out = []
        for name, url in listed(json.loads((self.folder / "index.json").read_text(encoding="utf-8"))):
            if not re.fullmatch(allowed, url):
                raise BronzeError(f"{self.source}: {url} is not allowed")
            found = self.download(name, url)
            if re.search(refused, (self.folder / name).read_text(encoding="utf-8")):
                raise BronzeError(f"{self.source}: {name} holds what is refused")
            out.append(found)
        return out

    def close(self, planned: Iterable[str] = (), **facts) -> dict:
        """Write the commit marker; a planned file that is not there is an error."""
        if missing := sorted(set(planned) - set(self.files)):
            raise BronzeError(f"{self.source}: without {missing}")
        if any("reused_from" in f and "query" in f for f in self.files.values()):
            self.warnings.append("answers of the run before were used again: not for publication")
        told = close_run(self.root, self.source, self.run_id, self.files.values(), warnings=self.warnings, **facts)
        (self.folder / "progress.jsonl").unlink(missing_ok=True)
        return told
