import re

import numpy as np
import pytest
import xxhash

import edges
from starfold.llm import simhash


def brute_print(text, k=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    shingles = shingles or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, distance):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B c", "a b c d", "Á b\x0bc d e é\x1ff", "x " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == brute_print(text)


def test_fingerprint_of_long_text_is_counted_in_blocks(monkeypatch):
    text = " ".join(str(i * 7919 % 1013) for i in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    assert simhash.fingerprint(text) == whole


def clustered(n, seed):
    """Values at random, and around some of them clusters that chains of small steps connect."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for centre in values[:5].tolist():
        at = centre
        for _ in range(60):
            for bit in rng.integers(0, 64, rng.integers(1, 5)):
                at ^= 1 << int(bit)
            values = np.append(values, np.uint64(at))
    return np.unique(values)


@pytest.mark.parametrize("seed", range(4))
def test_every_link_is_connected_by_the_forest_of_trees(seed):
    values = clustered(2000, seed)
    expected = brute_components([int(v) for v in values], 4)
    place = {int(v): i for i, v in enumerate(values)}
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for mask in simhash._masks(3):
        for a, b in simhash.near_pairs(values, mask, 1, 4):
            assert (int(a) ^ int(b)).bit_count() <= 4
            x, y = sorted((find(place[int(a)]), find(place[int(b)])))
            root[y] = x
    assert [find(i) for i in range(len(values))] == expected


def test_routing_keeps_near_values_together():
    values = clustered(3000, 9)
    for mask in simhash._masks(3):
        nodes = simhash.build_tree(values[::3], mask, 1, 50)
        shards, places = simhash.route(nodes, values, mask, 1)
        of = [set() for _ in values]
        for s, p in zip(shards.tolist(), places.tolist()):
            of[p].add(s)
        assert all(of) and len(set(shards.tolist())) > 10
        for i in range(0, len(values), 50):
            near = np.flatnonzero(np.bitwise_count((values ^ values[i]) & mask) <= 1)
            assert all(of[i] & of[j] for j in near)


@pytest.mark.parametrize("shard_rows", [50, 1 << 15])
def test_components_of_spark_equal_brute_force(spark, shard_rows):
    values = clustered(400, 3)
    signed = values.view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = simhash.components(simhash.links(prints, 4, shard_rows=shard_rows)).collect()
    expected = {}
    for i, r in enumerate(brute_components([int(v) for v in values], 4)):
        expected.setdefault(r, set()).add(signed[i])
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node)
    assert all(min(v) == k for k, v in groups.items())
    assert sorted(map(sorted, groups.values())) == sorted(sorted(v) for v in expected.values() if len(v) > 1)


def test_components_of_a_long_chain_a_star_and_loops(spark):
    edges_ = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 6)]
    found = simhash.components(spark.createDataFrame(edges_, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(61)} | {(i, 100) for i in range(100, 160)}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_awkward_documents(spark):
    docs = edges.documents(spark)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    rows = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in found]
    assert sorted((i or 0, f) for i, f, _ in rows) == sorted((i or 0, brute_print(t)) for i, t in edges.TEXTS)
    component = {i: c for i, _, c in rows if i}
    assert component[1] == component[2] == 1 and component[3] == component[4] == component[5] == 3
    assert component[6] == component[7] == 6
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = edges.documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 6, 8, 9]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_the_row_that_stays_is_chosen_by_group_and_not_by_id(spark):
    text = lambda seed: " ".join(str(x) for x in np.random.default_rng(seed).integers(0, 10**6, 60))
    rows = [
        (1, text(1)), (1, text(2)), (1, text(2)), (5, text(3)), (5, text(4)), (3, text(3)),
        (None, text(1)), (None, text(5)), (None, text(5)), (None, text(6)), (None, None),
    ]
    kept = simhash.keep_one(edges.documents(spark, rows)).collect()
    expected = [(1, 1), (1, 2), (5, 4), (3, 3), (None, 5), (None, 6)]
    expected = [*((i, text(seed)) for i, seed in expected), (None, None)]
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted((i or 0, t or "") for i, t in expected)
