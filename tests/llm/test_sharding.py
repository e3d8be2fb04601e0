import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest

import edges
from starfold.llm import sharding


def test_schedule_is_longest_first_to_the_least_loaded():
    rng = random.Random(1)
    items = [(f"g{i}", rng.randrange(1, 100)) for i in range(200)]
    found = dict(sharding.schedule(items, 7))
    heap, expected = [(0, s) for s in range(7)], {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        expected[name] = shard
        heapq.heappush(heap, (load + size, shard))
    assert found == expected
    loads = Counter()
    for name, size in items:
        loads[found[name]] += size
    assert max(loads.values()) <= 4 / 3 * sum(loads.values()) / 7 + 100
    assert sharding.schedule([], 3) == []


def placed(spark, rows, **kwargs):
    got = sharding.shard_documents(edges.documents(spark, rows), **kwargs).collect()
    assert len(got) == len(rows)
    group, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sizes == Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for r in got:
        group[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in group.values())
    return got, loads


def test_awkward_documents(spark):
    got, _ = placed(spark, edges.TEXTS)
    assert {r.shard for r in got} <= set(range(16))
    assert sharding.shard_documents(edges.documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize("grain", [4, 1024])
def test_sizes_are_near_equal_for_large_groups_and_bundles(spark, grain):
    rng = random.Random(3)
    rows = [(i, f"{i} " + "w" * rng.randrange(200)) for i in range(3000)]
    _, loads = placed(spark, rows, shards=8, grain=grain)
    fair = sum(loads.values()) / 8
    assert len(loads) == 8 and max(loads.values()) - min(loads.values()) <= 2 * fair / grain + 300


def test_a_text_that_a_third_of_the_rows_have(spark):
    rows = [(i, "copy " * 20 if i % 3 == 0 else f"own {i} " * 10) for i in range(1500)]
    _, loads = placed(spark, rows, shards=4)
    assert len(loads) == 4 and max(loads.values()) <= 1.05 * max(sum(loads.values()) / 4, 500 * 101)


def test_slots_over_many_buckets(spark):
    frame = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 3 AS INT) AS shard", "1 AS extra")
    got = sharding.numbered(frame, 5000, rows=100).collect()
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_slots_depend_on_the_rows_alone(spark):
    frame = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "CAST(id % 2 AS INT) AS shard")
    one = sorted(sharding.numbered(frame, 3000, rows=10_000).collect())
    assert one == sorted(sharding.numbered(frame.repartition(11), 3000, rows=50).collect())
    for shard in (0, 1):
        assert sorted(r.slot for r in one if r.shard == shard) == list(range(1500))
