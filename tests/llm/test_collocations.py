"""Phrase collocations against counting in Python and against SQL; transducers against plain counters."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF

from tickweave.llm import automata, collocations, queries

SCHEMA = "doc_id long, lang string, text string"


def brute(rows, least=100, top=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = totals[lang]
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in candidates.items():
            if any(100 * b >= 100 * a and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h))) for h, b in candidates.items()):
                continue
            score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]], n))
        out += [(lang, i, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y, n) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def texts(seed=1, docs=80):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["über", "Über", "a b", "x\ty", "nb sp"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    fixed = ["new york city hall", "one two three four five six", "x x x x x x x"]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randrange(1, 60)):
            parts.append(" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 9))) if rng.random() < 0.8 else rng.choice(fixed))
            parts.append(rng.choice([" ", ". ", "\n", ", ", "!?", "\x0b", "  "]))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), "".join(parts)))
    return rows + [("en", None), ("en", ""), (None, None), ("fr", "one two"), ("en", rows[0][1])]


def found(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(3)


def test_against_brute_force(spark):
    rows = texts()
    got = found(collocations.collocations(frame(spark, rows), least=30))
    assert got == brute(rows, 30)
    assert len(got) > 40 and {len(r[2].split(" ")) for r in got} >= {2, 3, 4}


def test_many_ranges_and_small_shards(spark, monkeypatch):
    """Ends inside hot prefixes, pieces longer than a shard, many ranges: no count changes."""
    monkeypatch.setattr(collocations, "SHARD_WORDS", 50)
    rows = texts(2, 30) + [("en", "the same words again and " * 60)]
    frequent = collocations.counted(frame(spark, rows), 20, range_words=100).cache()
    want = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in collocations.pieces((text or "").encode()):
            words = [w.decode() for w in words]
            want[lang, ""] += len(words)
            want.update((lang, " ".join(words[i : i + k])) for i in range(len(words)) for k in range(1, 6) if i + k <= len(words))
    want = {g: c for g, c in want.items() if c >= 20 or not g[1]}
    assert {(r.lang, r.phrase): r.f for r in frequent.collect()} == want
    for backwards in (False, True):
        cut = found(collocations.parts(frequent, backwards, range_phrases=7))
        assert len(cut) == sum(" " in phrase for _, phrase in want)
        for lang, phrase, along in cut:
            words = phrase.split(" ")
            own = [words[-k:] if backwards else words[:k] for k in range(1, len(words) + 1)]
            assert along == [want[lang, ""], *(want[lang, " ".join(w)] for w in own)]


def test_top_and_ties(spark):
    rows = texts(3)
    assert found(collocations.collocations(frame(spark, rows), least=20, top=9)) == brute(rows, 20, 9)


def test_empty_table_and_clashing_names(spark):
    assert found(collocations.collocations(spark.createDataFrame([], SCHEMA))) == []
    rows = [("en", "good morning. " * 100)]
    clash = frame(spark, rows)
    for name in ("phrase", "f", "range", "part", "words", "rank", "n", "score"):
        clash = clash.withColumn(name, clash.doc_id)
    assert found(collocations.collocations(clash)) == brute(rows) == [("en", 1, "good morning", 100, 100, 100, 200, 2000)]


def test_products_past_64_bits(spark):
    """Counts whose products pass 64 bits are still divided exactly."""
    big = 3_000_000_019
    frequent = spark.createDataFrame([("en", "", 4 * big), ("en", "a", big), ("en", "b", big + 2), ("en", "a b", big - 7)], "lang string, phrase string, f long")
    row = collocations.scored(frequent).first()
    assert (row.l, row.r, row.score) == (big, big + 2, 1000 * (big - 7) * 4 * big // (big * (big + 2)))


@pytest.mark.parametrize("seed", range(3))
def test_transducers_against_counters(seed):
    rng = random.Random(seed)
    words = sorted({bytes([rng.randrange(97, 123)]) * rng.randrange(1, 3) for _ in range(20)})
    parts, want = [], Counter()
    for _ in range(4):
        own = Counter()
        for _ in range(300):
            gram = tuple(rng.choices(range(1, len(words) + 1), k=rng.randrange(1, 6)))
            own[gram] += 1
            want.update(b" ".join(words[k - 1] for k in gram[:d]) for d in range(1, len(gram) + 1))
        rows = np.array([(*g, *[0] * (5 - len(g))) for g, c in own.items() for _ in range(c)], np.int32)
        grams, counts = automata.sorted_grams(rows, len(words) + 1)
        assert [tuple(g) for g in grams] == sorted(tuple(r) for r in {tuple(x) for x in rows.tolist()})
        parts.append(automata.Transducer.unpack(automata.build(grams, counts, words).pack()))
    total, got = automata.unite([*parts], 3, [])
    assert total == 1200 and dict(got) == {g: c for g, c in want.items() if c >= 3}
    # Prefixes of an end are given whatever their weight.
    _, got = automata.unite([*parts], 10**9, [[words[0], words[1]]])
    assert set(dict(got)) <= {words[0], words[0] + b" " + words[1]} and dict(got)[words[0]] == want[words[0]]


def test_registered_query_and_sql(spark):
    rows = duckdb.sql(f"select lang, text from '{SF}/documents.parquet'").fetchall()
    df = queries.QUERIES["op13_phrase_collocations"](spark, SF)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    told = sorted(con.sql(queries.ORACLES["op13_phrase_collocations"]).select(*df.columns).fetchall())
    assert found(df) == told == brute(rows)
