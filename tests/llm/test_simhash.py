from collections import Counter

import pytest
import xxhash

from meridia.llm import simhash


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in text + " ":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: (doc_id, fingerprint) of each row; the smallest id reachable for each row."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(prints))]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 1])
def test_against_brute_force(docs, doc_rows, bucket):
    prints = [(r[0], brute_fingerprint(r[1])) for r in doc_rows]
    expected = Counter((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints), strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(docs, bucket=bucket).collect())) == expected


@pytest.mark.parametrize("bucket", [64, 2])
def test_links_of_crowded_segments(spark, bucket):
    """Fingerprints in a chain and a ball, most with one segment in common."""
    values = [0, 1, 3, 7, 15, 31, 1 << 40, (1 << 40) | 1, -1, -2, -4, -(1 << 63)] + [5 << 32 | 1 << b for b in range(20)]
    distinct = spark.createDataFrame([(v,) for v in sorted(set(values))], "fp long")
    links = {tuple(sorted(map(int, r))) for r in simhash.links(distinct, bucket).collect()}
    near = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert links <= near

    def classes(pairs):
        parent = {v: v for v in values}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in sorted(pairs):
            parent[find(b)] = find(a)
        groups = {}
        for v in values:
            groups.setdefault(find(v), set()).add(v)
        return sorted(map(sorted, groups.values()))

    assert classes(links) == classes(near)


def test_empty_table(no_docs):
    found = simhash.near_duplicates(no_docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert found.count() == 0
