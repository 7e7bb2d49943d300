"""Quality rules, sharding, packing and curve search against brute force, with odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from conftest import SF
from pyspark.sql import functions as F

from tickweave.llm import curves, packing, quality_rules, queries, sharding

DOC = "doc_id long, text string, lang string, source string"


def base(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(found, found[1:], found[2:], strict=False))
    places = {j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places)


def test_base_counts_equal_python(spark):
    texts = ["", None, " \n\t", "a b c a b c", "a a a a a", "x # y\n\nx # y\n \nz", "é ß ü <b>", "w " * 5000, "a\rb\x0bc"]
    docs = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(texts)], DOC)
    for r in quality_rules.with_statistics(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(r.text), r.text


def test_rules_keep_clean_rows_and_reject_outliers(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
    clean = [(i, " ".join(word() for _ in range(200)), "en", "s") for i in range(60)]
    junk = [(100 + i, " ".join(word() + "$$$" for _ in range(200)), "en", "s") for i in range(5)]
    odd = [(200, None, None, None), (201, "", "en", None), (None, clean[0][1], "en", "s"), (0, clean[0][1], "en", "s")]
    docs = spark.createDataFrame(clean + junk + odd, DOC).withColumn("kept", F.lit("old")).withColumn("x_length", F.lit(1))
    out = quality_rules.judge(docs).collect()
    assert len(out) == 69
    assert {r.doc_id for r in out if not r.kept} == {100, 101, 102, 103, 104, 200, 201}
    assert quality_rules.judge(docs.limit(0)).count() == 0
    # Columns named like those made on the way stay what they were.
    clash = spark.createDataFrame(clean + junk + odd, DOC)
    names = ["words", "windows", "sorted", "places", "m0", "l00", "z0", "d2", "g_lang", "x_symbols", "n_lines", "bin", "own__0"]
    for name in names:
        clash = clash.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    again = quality_rules.judge(clash).collect()
    assert sorted((r.doc_id or -1, r.kept) for r in again) == sorted((r.doc_id or -1, r.kept) for r in out)
    assert all(r[name] == (None if r.doc_id is None else f"{name}{r.doc_id}") for r in again for name in names)


def test_shards_hold_every_row_once(spark):
    rows = [(i % 7, "same text", "en", "s") for i in range(500)] + [(9, None, None, None), (None, "", "x", "y")]
    docs = spark.createDataFrame(rows, DOC).withColumn("slot", F.lit("old"))
    out = sharding.external_shuffle(docs, 8, bucket_bytes=700).collect()
    assert Counter((r.doc_id, r.text, r.lang, r.source) for r in out) == Counter(rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.external_shuffle(docs.limit(0)).count() == 0
    digest = {r.doc_id: r for r in queries.QUERIES["op8_sharding"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        raw = r.text.encode()
        assert (digest[r.doc_id].size, digest[r.doc_id].text_crc32) == (len(raw) + 1, zlib.crc32(raw))


def test_shard_places_do_not_depend_on_partitions(spark, monkeypatch):
    """The second pass run over few and many partitions, in any order of arrival, gives the same places."""
    docs = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}", "en", "s") for i in range(400)], DOC).repartition(3)
    stored = {}

    def once(df, name):
        if name not in stored:
            stored[name] = df.cache()
            stored[name].count()
        return stored[name]

    monkeypatch.setattr(sharding, "materialise", once)
    before, places = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in ("3", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            places.append({r.doc_id: (r.shard, r.slot) for r in sharding.external_shuffle(docs, 4, bucket_bytes=500).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert places[0] == places[1] and len(set(places[0].values())) == 400
    # The order is not that of the input.
    order = sorted(places[0], key=lambda i: (places[0][i][1], places[0][i][0]))
    assert sum(a < b for a, b in zip(order, order[1:])) < 260


def plain_best_fit(lengths, clusters, sources, capacity, per_source):
    """Tightest compatible bin by looking at all of them."""
    bins, out = [], []
    whole = sum((n - 1) // capacity for n in lengths if n > capacity)
    rests = [n - (n - 1) // capacity * capacity if n > capacity else n for n in lengths]
    for i in sorted(range(len(lengths)), key=lambda i: (-rests[i], i)):
        fits = [b for b in bins if b["left"] >= rests[i] and b["left"] > 0 and clusters[i] not in b["c"] and b["s"].count(sources[i]) < per_source]
        b = min(fits, key=lambda b: (b["left"], b["n"])) if fits else None
        if b is None:
            b = {"left": capacity, "c": set(), "s": [], "n": len(bins)}
            bins.append(b)
        b["left"] -= rests[i]
        b["c"].add(clusters[i])
        b["s"].append(sources[i])
        out.append(b["left"])
    return whole + len(bins), out


def test_best_fit_equals_a_plain_search():
    rng = np.random.default_rng(5)
    for _ in range(5):
        n = 120
        lengths, clusters, sources = rng.integers(1, 250, n), rng.integers(0, 40, n), rng.integers(0, 4, n)
        pieces = packing.best_fit(lengths, clusters, sources, 100, 3)
        assert [sum(x[2] for x in p) for p in pieces] == lengths.tolist()
        used, held, heads = Counter(), defaultdict(list), {b for p in pieces for b, _, _ in p}
        spans = defaultdict(list)
        for i, p in enumerate(pieces):
            for b, start, tokens in p:
                used[b] += tokens
                spans[b].append((start, start + tokens))
            held[p[-1][0]].append(i)
        assert max(used.values()) <= 100
        assert all(x[1] <= y[0] for s in map(sorted, spans.values()) for x, y in zip(s, s[1:], strict=False))
        for rows in held.values():
            assert len({clusters[i] for i in rows}) == len(rows) and max(Counter(sources[i] for i in rows).values()) <= 3
        assert len(heads) == plain_best_fit(lengths.tolist(), clusters.tolist(), sources.tolist(), 100, 3)[0]


def test_packing_places_odd_rows(spark):
    rows = [(1, "a b c", None, "s"), (1, "a b c", None, "s"), (2, None, None, None), (None, "", None, "t"), (3, "w " * 9000, None, "s")]
    out = packing.pack_documents(spark.createDataFrame(rows, DOC)).collect()
    total = Counter()
    for r in out:
        total[r.doc_id] += r.piece_tokens
    assert total == {1: 8, 2: 1, None: 1, 3: 9001}
    assert len({r.bin for r in out if r.doc_id == 1}) == 2 and max(r.n_pieces for r in out) == 5
    assert packing.pack_documents(spark.createDataFrame([], DOC)).count() == 0


def test_packing_spreads_repeated_rows(spark):
    docs = spark.range(3000).select(F.when(F.col("id") < 2400, 7).otherwise(F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") < 2400, "the same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"), F.lit("s").alias("source"))
    out = packing.pack(docs, packing.n_tokens(F.col("text")), packing.copy_cluster(F.col("text")), F.col("source"), block_rows=300)
    blocks = Counter(r.bin.split("-")[0] for r in out.collect())
    assert len(blocks) == 10 and max(blocks.values()) < 400 and sum(blocks.values()) == 3000


def test_tokens_are_words_and_an_end(spark):
    texts = ["", None, " ", "\t\n ", "a", " a", "a ", " a ", "a b", "\x0ba\r\nb  c\x0c", "\u00a0", "a\u2003b c", "\x1c", "x " * 3000]
    docs = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(texts)], DOC)
    for r in docs.withColumn("n", packing.n_tokens(F.col("text"))).collect():
        assert r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) + 1, repr(r.text)


def test_packing_does_not_work_out_copies_that_the_join_gives(spark, tmp_path):
    """Every text with words has a component, and the others no cluster: no text is hashed to find its copies again."""
    spark.createDataFrame([(1, "a b c", None, "s"), (2, "A  b c", None, "s"), (3, " ", None, "s"), (4, None, None, "s")], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    hashed = []
    before, packing.copy_cluster = packing.copy_cluster, lambda text: hashed.append(text) or before(text)
    try:
        out = queries.QUERIES["op10_packing"](spark, str(tmp_path)).collect()
    finally:
        packing.copy_cluster = before
    assert not hashed and {r.doc_id for r in out} == {1, 2, 3, 4}
    assert len({r.bin for r in out if r.doc_id in (1, 2)}) == 2


def test_packing_keeps_near_copies_apart(spark, tmp_path):
    rng = np.random.default_rng(9)
    base_words = ["w" + str(x) for x in rng.integers(0, 10**6, 60)]
    texts = [" ".join(base_words + [f"end{i}"]) for i in range(6)]
    other = [" ".join("v" + str(x) for x in rng.integers(0, 10**6, 60)) for _ in range(6)]
    rows = [(i, t, None, f"s{i}") for i, t in enumerate(texts + other)] + [(None, texts[0], None, "n"), (50, "", None, "n"), (51, None, None, "n")]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES["op10_packing"](spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    near = [r.bin for r in out if r.doc_id is None or r.doc_id < 6]
    assert len(near) == 7 == len(set(near))


def test_curves_find_the_nearest(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = curves.search(vectors, F.col("vec_id") % 10 == 0).collect()
    rows = vectors.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append(r)
    hit = 0
    for q, got in found.items():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hit += len(set(ids[order]) & {r.vec_id for r in got})
        assert [r["rank"] for r in got] == list(range(1, 11))
        assert all(abs(r.score - d[ids == r.vec_id][0]) < 1e-12 for r in got)
    assert hit >= 9 * len(found) and len(found) == sum(ids % 10 == 0)


def test_curves_with_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(i, one) for i in range(40)] + [(50, None), (51, [0.0] * 3), (52, [1.0, None, 0.0]), (53, [float("nan")] * 3), (54, [1.0]),
                                          (None, one), (60, [0.0, 2.0, 0.0]), (0, one)]
    out = curves.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect()
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        by[r.query_id].append((r.vec_id, r.score))
    assert by[0] == [(i, 0.0) for i in range(1, 11)] and by[20] == [(i, 0.0) for i in range(10)]
    assert [i for i, _ in by[60]] == list(range(10)) and set(by) == {0, 20, 60}
    assert curves.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
