import random
import re

import pytest
import xxhash

from tierflow.llm import simhash
from tierflow.llm.components import components
from tierflow.llm.simhash import close_links, keep_one_per_group, simhash_components


def brute_fingerprint(text, words=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    """Smallest member that links reach, by brute force."""
    parent = {x: x for x in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(items):
        for b in items[i + 1 :]:
            if linked(a, b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {x: root(x) for x in items}


def test_documents_match_brute_force(documents):
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows.items()}
    want = groups(sorted(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_components(documents).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in rows}


@pytest.mark.parametrize("cell", [32, 1])
def test_dense_fingerprints(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    draw = random.Random(3)
    base = [draw.getrandbits(63) for _ in range(6)]
    fps = sorted({b ^ sum(1 << draw.randrange(62) for _ in range(draw.randint(0, 3))) for b in base for _ in range(25)})
    want = groups(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    edges = close_links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    assert all((r["a"] ^ r["b"]).bit_count() <= 2 for r in edges.collect())
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert {f: got.get(f, f) for f in fps} == want


def test_awkward_rows(odd):
    got = simhash_components(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    # Texts without words have fingerprint zero and link like any others.
    assert {by[i]["fingerprint"] for i in (1, 2, 3, 8)} == {"0" * 16} and by[8]["component_id"] == 1
    assert by[None]["component_id"] == 4
    assert simhash_components(odd.limit(0)).collect() == []


def test_one_document_of_each_group_stays(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    fps = {i: brute_fingerprint(t) for i, t in rows}
    want = groups(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    kept = keep_one_per_group(documents)
    assert kept.schema == documents.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_different_texts_under_one_id(docs):
    rows = [(1, "one two three four"), (1, "five six seven eight"), (1, "one two three four"), (2, "five six seven eight")]
    assert sorted(r["text"] for r in keep_one_per_group(docs(*rows)).collect()) == ["five six seven eight", "one two three four"]


def test_awkward_rows_of_the_stage(odd):
    kept = keep_one_per_group(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i or 0))
    assert 5 in ids and 6 in ids and 7 in ids and ids.count(4) == 1 and None not in ids
    assert keep_one_per_group(odd.limit(0)).collect() == []


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7), (None, 3)]
    nodes = sorted({x for e in edges for x in e if x is not None and e[0] != e[1] and None not in e})
    links = {frozenset(e) for e in edges}
    want = groups(nodes, lambda a, b: frozenset((a, b)) in links)
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
