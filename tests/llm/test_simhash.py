from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from postlens.llm import simhash

SCHEMA = "doc_id bigint, text string, fingerprint string, cell int"


def naive_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\v\f\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(rows):
    prints = [naive_fingerprint(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    names = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [(r[0], f"{prints[i]:016x}", names[find(i)]) for i, r in enumerate(rows)]


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one"), (4, "one"), (None, "One TWO")]
    rows += [(5, "É one two\x0bthree four"), (6, "é one two three four")]
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(40, 400))]
        for copy in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(copy // 2):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((100 * group + copy + 10, " ".join(text)))
    return rows


@pytest.mark.parametrize("dense_cell", [0, 2, 32])
def test_components_equal_all_pairs(spark, dense_cell):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    keys = simhash.fingerprints(docs.select("doc_id", "text"))
    found = simhash.near_duplicates(keys, dense_cell=dense_cell)
    got = keys.join(found, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"), "component_id"
    )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, naive_components(rows)))


@pytest.mark.parametrize("distance", [0, 2, 4])
def test_links_connect_what_all_pairs_connect(spark, distance):
    rng = random.Random(distance)
    values = {0, -1, 1 << 62, -(1 << 63)}
    for _ in range(40):
        value = rng.getrandbits(64)
        for _ in range(4):
            value ^= 1 << rng.randrange(64)
            values.add(value - (1 << 64) if value >> 63 else value)
    values = sorted(values)
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    for dense in (1, 32):
        links = simhash.near_links(prints, distance, dense)
        roots = dict(map(tuple, simhash.connected_components(links).collect()))
        parent = {v: v for v in values}
        for i, a in enumerate(values):
            for b in values[:i]:
                if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                    low, high = sorted((parent[a], parent[b]))
                    parent = {k: low if v == high else v for k, v in parent.items()}
        assert {v: roots.get(v, v) for v in values} == parent


def test_components_of_a_path_and_of_nothing(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(50)], "a bigint, b bigint")
    assert {tuple(r) for r in simhash.connected_components(path).collect()} == {
        (i, 0) for i in range(51)
    }
    assert simhash.connected_components(path.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    expected = {}
    for (doc_id, text), (_, _, component) in zip(rows, naive_components(rows)):
        expected.setdefault(component, set()).add((doc_id, text))
    for limit in (0, 1000):
        kept = simhash.keep_one_per_group(docs, broadcast_rows=limit)
        assert kept.columns == docs.columns
        got = [(r["doc_id"], r["text"]) for r in kept.collect()]
        assert sorted(map(repr, (k for k, _ in got))) == sorted(map(repr, expected))
        assert all(row in expected[row[0]] for row in got)
        assert {r["cell"] for r in kept.collect()} == {1}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_near_duplicates(docs).collect() == []
    assert simhash.keep_one_per_group(docs).collect() == []
