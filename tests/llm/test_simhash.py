from __future__ import annotations

import random
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash
from tests.llm.data import empty, frame, prose, rows


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(points, max_bits):
    label = {p: p for p in points}

    def find(p):
        while label[p] != p:
            p = label[p]
        return p
    for a, b in combinations(points, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits:
            label[find(a)] = find(b)
    return {p: find(p) for p in points}


def test_fingerprints_and_components(spark):
    got = simhash.near_duplicates(frame(spark)).withColumn("hex", simhash.as_hex(F.col("fp"))).collect()
    fps = [brute_fingerprint(r[1]) for r in rows()]
    comp = components(set(fps), 3)
    least = {}
    for r, f in zip(rows(), fps):
        if r[0] is not None:
            least[comp[f]] = min(r[0], least.get(comp[f], r[0]))
    want = sorted((str(r[0]), f"{f:016x}", str(least.get(comp[f]))) for r, f in zip(rows(), fps))
    assert sorted((str(r.doc_id), r.hex, str(r.component_id)) for r in got) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


def random_points(n, seed):
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(n // 8)]
    out = set()
    for _ in range(n):
        c = r.choice(centres)
        for _ in range(r.randint(0, 5)):
            c ^= 1 << r.randrange(64)
        out.add(c)
    return sorted(p - (1 << 64) if p >> 63 else p for p in out)


def link_components(spark, points, max_bits, cell_points):
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    found = simhash.connected_components(simhash.links(df, max_bits, cell_points)).collect()
    label = {p: p for p in points} | {r.node: r.component for r in found}
    groups = {}
    for p in points:
        groups.setdefault(label[p], set()).add(p)
    return sorted(map(sorted, groups.values()))


def brute_groups(points, max_bits):
    groups = {}
    for p, c in components(points, max_bits).items():
        groups.setdefault(c, set()).add(p)
    return sorted(map(sorted, groups.values()))


def test_grid_finds_every_pair(spark):
    for max_bits in (0, 1, 3, 5):
        points = random_points(160, max_bits)
        assert link_components(spark, points, max_bits, 256) == brute_groups(points, max_bits)


def test_crowded_cells_lose_no_link(spark):
    points = random_points(120, 9)
    assert link_components(spark, points, 3, 1) == brute_groups(points, 3)


def kept_by_brute_force(data):
    """The rows that stay: one per component, of the smallest id, NULL last."""
    fps = [brute_fingerprint(r[1]) for r in data]
    comp = components(set(fps), 3)
    out = {}
    for r, f in zip(data, fps):
        out.setdefault(comp[f], []).append(r)
    least = [min((r[0] is None, r[0] or 0) for r in g) for g in out.values()]
    return out, least


def test_deduplicate_keeps_one_of_each_component(spark):
    out = simhash.deduplicate(frame(spark))
    assert out.columns == frame(spark).columns
    got = [tuple(r) for r in out.collect()]
    groups, least = kept_by_brute_force(rows())
    assert sorted((r[0] is None, r[0] or 0) for r in got) == sorted(least)
    for r in got:
        assert r in rows()                                  # whole rows, none made up
    assert len({r[1] for r in got}) == len(got) == len(groups)
    ids = [r[0] for r in got]
    assert ids.count(11) == 2 and 2 not in ids and 5 not in ids and 6 not in ids


def test_deduplicate_of_repeated_and_missing_ids(spark):
    a, b, c = prose(31, 60), prose(32, 60), prose(33, 60)
    data = [(7, a), (7, b), (7, a), (None, c), (None, c), (None, b), (3, c + " tail")]
    out = simhash.deduplicate(spark.createDataFrame(data, "doc_id long, text string").repartition(4))
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    groups, least = kept_by_brute_force(data)
    assert sorted((r[0] is None, r[0] or 0) for r in got) == sorted(least) and len(got) == len(groups)
    assert (7, a) in got and (7, b) in got
    assert simhash.deduplicate(spark.createDataFrame([(None, c)] * 5, "doc_id long, text string")).count() == 1
