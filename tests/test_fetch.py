"""Filling runs over a transport that holds its answers."""

import json

import pytest

from meridia.sources.bronze import Bronze, BronzeError
from meridia.sources.fetch import Mode, OpenRun

API = "https://api.example/interpreter"


class Answers:
    def __init__(self, **urls):
        self.urls, self.asked = urls, []

    def __call__(self, url, headers, body):
        self.asked.append((url, dict(headers), body))
        status, given, content = self.urls[url.rsplit("/", 1)[-1]]
        if given.get("ETag") and headers.get("If-None-Match") == given["ETag"]:
            return 304, {}, b""
        return status, given, content


def test_conditional_download(tmp_path):
    net = Answers(a=(200, {"ETag": "1"}, b"x"))
    run = OpenRun(tmp_path, "s", "1", net)
    run.download("a.csv", "https://h/a")
    assert run.close(["a.csv"])["previous_run_id"] is None
    run = OpenRun(tmp_path, "s", "2", net)
    assert run.download("a.csv", "https://h/a")["reused_from"] == "1" and net.asked[-1][1] == {"If-None-Match": "1"}
    assert run.close()["unchanged_vs_previous"] and Bronze(tmp_path, "2").metadata("s")["files"][0]["etag"] == "1"
    # the file of the run before was changed: asked again without a condition
    (tmp_path / "bronze/s/run_id=2/a.csv").unlink()
    (tmp_path / "bronze/s/run_id=2/a.csv").write_bytes(b"broken")
    run = OpenRun(tmp_path, "s", "3", net)
    assert "reused_from" not in run.download("a.csv", "https://h/a") and net.asked[-1][1] == {}
    net.urls["a"] = (503, {}, b"")
    with pytest.raises(BronzeError, match="503"):
        run.download("b.csv", "https://h/a")


def test_modes(tmp_path):
    answer = json.dumps({"osm3s": {"timestamp_osm_base": "now"}, "elements": []}).encode()
    net = Answers(interpreter=(200, {}, answer))
    first = OpenRun(tmp_path, "m", "1", net)
    with pytest.raises(BronzeError, match="no answer"):
        first.ask("q/box.json", API, "node;", Mode.REUSE)
    first.ask("q/box.json", API, "node;")
    assert first.close()["warnings"] == [] and len(net.asked) == 1
    second = OpenRun(tmp_path, "m", "2", net)
    assert second.ask("q/box.json", API, "node;", "reuse")["reused_from"] == "1" and len(net.asked) == 1
    with pytest.raises(BronzeError, match="no answer"):
        second.ask("q/other.json", API, "way;", "reuse")
    assert "reused_from" not in second.ask("q/other.json", API, "way;", "reuse_or_query")
    assert second.close()["warnings"] and len(net.asked) == 2
    third = OpenRun(tmp_path, "m", "3", net)
    third.ask("q/box.json", API, "changed;", "reuse_or_query")
    assert len(net.asked) == 3
    with pytest.raises(ValueError):
        third.ask("q/x.json", API, "node;", "never")
    net.urls["interpreter"] = (200, {}, answer[:-1])
    with pytest.raises(BronzeError, match="cut off"):
        third.ask("q/x.json", API, "node;")
    assert "q/x.json" not in third.files and "now" not in (third.folder / "q/box.json").read_text()


def test_a_cut_off_run_goes_on(tmp_path):
    net = Answers(a=(200, {}, b"x"), b=(200, {}, b"y"))
    run = OpenRun(tmp_path, "s", "1", net)
    run.download("a.csv", "https://h/a")
    with pytest.raises(BronzeError, match="b.csv"):
        run.close(["a.csv", "b.csv"])
    with (run.folder / "progress.jsonl").open("a") as f:
        f.write('{"path": "b.c')
    again = OpenRun(tmp_path, "s", "1", net)
    again.download("a.csv", "https://h/a")
    again.download("b.csv", "https://h/b")
    assert [u for u, _, _ in net.asked] == ["https://h/a", "https://h/b"]
    resumed = OpenRun(tmp_path, "s", "1", net)
    assert set(resumed.files) == {"a.csv", "b.csv"}
    assert [f["path"] for f in resumed.close(["a.csv", "b.csv"])["files"]] == ["a.csv", "b.csv"]
    with pytest.raises(BronzeError, match="closed"):
        OpenRun(tmp_path, "s", "1", net)


def test_results_and_crawl(tmp_path):
    some = json.dumps({"results": {"bindings": [{"a": {"type": "literal", "value": "1"}}]}}).encode()
    net = Answers(sparql=(200, {}, some), index=(200, {}, b'{"results": [{"name": "k", "url": "https://h/k"}]}'), k=(200, {}, b'{"id": 1}'))
    run = OpenRun(tmp_path, "s", "1", net)
    run.bindings("rows.json", "https://h/sparql", "SELECT")
    net.urls["sparql"] = (200, {}, b'{"results": {"bindings": []}}')
    with pytest.raises(BronzeError, match="no results"):
        run.bindings("none.json", "https://h/sparql", "SELECT")
    listed = lambda d: [(f"{r['name']}.json", r["url"]) for r in d["results"]]
    assert [f["path"] for f in run.crawl("https://h/index", listed, r"https://h/\w+", "sprite")] == ["k.json"]
    with pytest.raises(BronzeError, match="not allowed"):
        run.crawl("https://h/index", listed, r"https://x/.*", "sprite")
    with pytest.raises(BronzeError, match="refused"):
        run.crawl("https://h/index", listed, r"https://h/\w+", '"id"')
    with pytest.raises(BronzeError, match="no .gz file"):
        run.write("a.gz", b"text")
    assert not (run.folder / "a.gz").exists()
