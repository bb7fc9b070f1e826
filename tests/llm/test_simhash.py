"""Fingerprints and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from meterstone.llm import simhash
from meterstone.llm.common import table
from meterstone.llm.components import connected

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute_bits(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(items, near):
    root = {i: i for i in items}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    items = sorted(items)
    for i, a in enumerate(items):
        for b in items[:i]:
            if near(a, b) and top(a) != top(b):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in items}


def test_whole_table(spark, small_folder):
    docs = table(spark, small_folder, "documents")
    bits = {r.doc_id: brute_bits(r.text) for r in docs.collect()}
    roots = brute_roots(bits, lambda a, b: (bits[a] ^ bits[b]).bit_count() <= 4)
    for r in simhash.near_duplicates(docs).collect():
        assert (r.fingerprint, r.component_id) == (f"{bits[r.doc_id]:016x}", roots[r.doc_id])


def test_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    of = {r.doc_id: r for r in rows}
    assert {of[i].component_id for i in (4, 5, 6)} == {4} and of[5].fingerprint == "0" * 16
    assert of[10].fingerprint == of[11].fingerprint and of[11].component_id == 10
    assert of[12].component_id == of[13].component_id == 12
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == ["4", "None"]
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None} | {of[i].component_id for i in of if i}


@pytest.mark.parametrize("tile", [5, 4096])
def test_links_find_all_pairs(spark, tile):
    rng = random.Random(tile)
    bits = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(rng.choice((1, 2, 20))):
            bits.add(base ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(7))}))
    signed = [int(np.uint64(b).astype(np.int64)) for b in bits]
    links = simhash.near_links(spark.createDataFrame([(b,) for b in signed], "bits long"), tile=tile)
    got = {r.node: r.root for r in connected(links).collect()}
    want = brute_roots(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert {b: got.get(b, b) for b in signed} == want


def test_bit_sliced_distances():
    rng = np.random.default_rng(5)
    bits = rng.integers(-2 ** 63, 2 ** 63 - 1, 300, dtype=np.int64)
    bits[1::2] = bits[::2] ^ (np.int64(1) << rng.integers(0, 63, 150)) ^ (np.int64(1) << rng.integers(0, 63, 150))
    own = simhash.planes(bits)
    for radius in (1, 2, 3, 4, 7, 12):
        for shift in (1, 2, 5):
            lanes = simhash.within(own, shift, (1 << 300 - shift) - 1, radius)
            want = [i for i in range(300 - shift) if ((int(bits[i]) ^ int(bits[i + shift])) & (1 << 64) - 1).bit_count() <= radius]
            assert simhash.places(lanes, 300).tolist() == want


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == (0 if i <= 60 else 1000) for i in got) and len(got) == 261


@pytest.mark.parametrize("tile", [4, 4096])
def test_similar_groups_are_those_of_brute_force(spark, tile):
    rng, rows = random.Random(tile), []
    for _ in range(25):
        n = rng.choice((8, 24, 60, 300))
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
        for _ in range(rng.choice((2, 3, 12))):
            copy = list(base)
            for k in range(rng.choice((0, 1, max(1, n // 50), max(1, n // 40)))):
                copy[rng.randrange(n)] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(copy if rng.random() < 0.7 else copy + base[:rng.randrange(1, n // 4)])))
    passage = " ".join(f"p{i}" for i in range(9))
    rows += [(len(rows) + i, f"{passage} " + " ".join(f"q{i}x{j}" for j in range(30))) for i in range(40)]
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    near = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    want = brute_roots(sets, near)
    pairs = [(a, b) for a in sets for b in sets if a < b and near(a, b) and 10 * len(sets[a] & sets[b]) < 9 * len(sets[a] | sets[b])]
    assert len(pairs) > 20
    got = simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), tile=tile)
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_large_batches_are_cut_between_units():
    import pyarrow as pa

    rng = np.random.default_rng(11)
    base = rng.integers(-2 ** 63, 2 ** 63 - 1, 40_000 // 40, dtype=np.int64)
    unit, bits = np.repeat(np.arange(len(base)), 40), np.repeat(base, 40)
    bits[1:] ^= np.where(np.arange(1, len(bits)) % 40 == 0, 0, np.int64(1) << (np.arange(1, len(bits)) % 40))
    got = pa.Table.from_batches(list(simhash._compare(4, iter([pa.RecordBatch.from_pydict({"unit": unit, "bits": bits})]))))
    assert got.num_rows == len(base) * 39  # a spanning set of each unit
