"""SimHash near-duplicates against brute force: fingerprints bit by bit, links over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from conftest import SF
from tickweave.llm import queries, simhash

SCHEMA = "doc_id long, text string"


def words_of(text):
    out, run = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            out, run = out + [run] * bool(run), ""
        else:
            run += c.lower() if "A" <= c <= "Z" else c
    return out + [run] * bool(run)


def brute_print(text):
    words = words_of(text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """Smallest id reachable, by flooding over all pairs of rows."""
    prints = [brute_print(t) for _, t in rows]
    label = list(range(len(rows)))
    moved = True
    while moved:
        moved = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    moved = True
    ids = {}
    for (i, _), k in zip(rows, label):
        ids[k] = min([x for x in (ids.get(k), i) if x is not None], default=None)
    return sorted(((i, f"{p:016x}", ids[k]) for (i, _), p, k in zip(rows, prints, label)), key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_texts_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 40, 200, 400]))
        rows.append((i * 3, " ".join(words)))
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "changed"
            rows.append((i * 3 + 1, "\t ".join(words).upper()))
    rows += [(900, None), (901, ""), (902, " \n\x0b"), (None, rows[5][1]), (None, "alone in the world"), (903, rows[0][1]), (903, rows[0][1]),
             (904, "Ünïcode ÄÖ no-break space  line"), (905, "the " * 30_000)]
    got = found(simhash.near_copies(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute_components(rows)
    assert len({c for _, _, c in got}) < len(got)


@pytest.mark.parametrize("tile", [7, 1000])
def test_chains_over_tiles(spark, tile):
    """Fingerprints a few bits apart, over tiles of one class and of neighbouring ones."""
    rng = random.Random(tile)
    prints = set()
    for _ in range(20):
        p = rng.getrandbits(64)
        for _ in range(8):
            prints.add(p)
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                p ^= 1 << b
    prints = np.array(sorted(prints), np.uint64)
    label = np.arange(len(prints))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    for _ in range(len(prints)):
        label = np.array([label[near[i]].min() for i in range(len(prints))])
    nodes = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    edges = simhash.links(nodes, tile=tile).collect()
    at = {int(p): i for i, p in enumerate(prints.view(np.int64))}
    assert all(near[at[e.a], at[e.b]] or label[at[e.a]] == label[at[e.b]] for e in edges)
    forest = simhash.Forest(len(prints))
    forest.join(np.array([at[e.a] for e in edges]), np.array([at[e.b] for e in edges]))
    assert (forest.parent == label).all()


def test_pairs_equal_brute_force():
    rng = np.random.default_rng(5)
    left = rng.integers(0, 1 << 64, 300, np.uint64)
    right = np.concatenate([left[:100] ^ np.uint64(0b1011), left[100:200] ^ np.uint64(0xF), rng.integers(0, 1 << 64, 77, np.uint64)])
    got = {(int(a), int(b)) for x, y in simhash.near_pairs(left, right) for a, b in zip(x, y)}
    want = set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= 3))))
    assert got == want and len(want) >= 100


def test_large_group_keeps_one_tree():
    """A dense group of near fingerprints leaves a tree, not its pairs."""
    group = np.array([x for x in range(2000) if x.bit_count() <= 3], np.uint64)
    a, b = simhash.linked(group, None)
    assert len(a) == len(group) - 1


def test_empty_table_and_clashing_names(spark):
    assert found(simhash.near_copies(spark.createDataFrame([], SCHEMA))) == []
    rows = [(1, "a b c d", "x", 1), (2, "A b  c d", "y", 2)]
    clash = spark.createDataFrame(rows, "doc_id long, text string, print string, copies int").withColumn("component_id", simhash.F.lit("z")) \
        .withColumn("root", simhash.F.lit(0)).withColumn("fingerprint", simhash.F.lit(0))
    assert {c for _, _, c in found(simhash.near_copies(clash))} == {1}


def test_registered_query(spark):
    import duckdb

    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert found(queries.QUERIES["op12_simhash_near_dedup"](spark, SF)) == brute_components(rows)
