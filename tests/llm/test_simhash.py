from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import simhash
from mercato.llm.graph import components
from mercato.llm.queries import op3_simhash
from pyspark.sql import functions as F


def plain_fingerprint(text, width=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [words] if len(words) < width else [words[i:i + width] for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_equals_brute_force(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    ids, prints = [d.doc_id for d in docs], [plain_fingerprint(d.text) for d in docs]
    want = dict(zip(ids, zip((f"{p:016x}" for p in prints), plain_components(ids, prints, 3), strict=True), strict=True))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash(llm, "/root/testdata/sf0.001").collect()} == want


def test_odd_rows(llm, make_docs, odd_texts, folder):
    ids = [None, *range(1, len(odd_texts))]
    docs = make_docs(odd_texts, ids).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0))
    prints = [plain_fingerprint(t) for t in odd_texts]
    rows = op3_simhash(llm, folder(documents=docs)).collect()
    want = sorted(zip(map(str, ids), (f"{p:016x}" for p in prints), plain_components(ids, prints, 3), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == want
    assert op3_simhash(llm, folder(documents=make_docs([]))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6, unique=True), st.lists(st.lists(st.integers(0, 63), max_size=5), max_size=12))
def test_tree_finds_all_within_radius(seeds, flips):
    values = set(seeds)
    for i, bits in enumerate(flips):
        v = seeds[i % len(seeds)]
        for b in bits:
            v ^= 1 << b
        values.add(v)
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
        tree.add(v)
    for v in values:
        assert sorted(tree.within(v, 3)) == sorted(x for x in values if (x ^ v).bit_count() <= 3)


def test_shards_hold_every_link():
    draw = np.random.default_rng(1)
    for blocks in (4, 5, 6, 7):
        masks = simhash.shard_masks(blocks, 3)
        for _ in range(300):
            x = int(draw.integers(0, 2**63))
            y = x
            for b in draw.choice(64, 3, replace=False).tolist():
                y ^= 1 << b
            assert any(x & m == y & m for m in masks)


def test_finer_shards_hold_every_link_of_their_shard():
    """Also where fewer free bits are left than there are blocks."""
    draw = np.random.default_rng(4)
    for within in (simhash.shard_masks(4, 3)[1], simhash.shard_masks(7, 3)[5], (1 << 64) - 1 - (1 << 63 | 1 << 20 | 7), (1 << 64) - 1):
        masks = simhash.shard_masks(6, 3, within)
        free = [i for i in range(64) if not within >> i & 1]
        assert all(m & within == within for m in masks)
        for _ in range(200):
            x = int(draw.integers(0, 2**63))
            y = x
            for b in draw.choice(free, min(3, len(free)), replace=False).tolist() if free else []:
                y ^= 1 << b
            assert any(x & m == y & m for m in masks)


@pytest.mark.parametrize("deeper", [0, 1, 2])
def test_large_shards_lose_no_links(llm, monkeypatch, deeper):
    """Tiles alone, and tiles of what one or two splits leave large."""
    monkeypatch.setattr(simhash, "TILE", 8)
    monkeypatch.setattr(simhash, "DEEPER", deeper)
    draw = np.random.default_rng(2)
    values = {0}
    while len(values) < 120:  # one dense cluster: most share a block of bits
        v = 0
        for b in draw.integers(0, 64, 4).tolist():
            v ^= 1 << b
        values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {r.node: r.root for r in components(simhash.links(llm.createDataFrame([(v,) for v in signed], "fp long"), 3)).collect()}
    want = plain_components(signed, [v & (1 << 64) - 1 for v in signed], 3)
    assert [got.get(v, v) for v in signed] == want


def test_components_of_paths_and_stars(llm):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 500), (900, 899)]
    got = {r.node: r.root for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 899: 899, 900: 899}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0
