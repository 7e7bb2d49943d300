"""Language model, classifier, HTML model, Jaccard join and the pipeline against brute force and held-out rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from tickweave import session
from tickweave.llm import html, jaccard, lm, quality_classifier
from tickweave.llm.html_pages import labelled_pages


def test_language_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10**6, None), (10**6, None), (10**6 + 1, "")], "doc_id long, text string"))
    model, counts = lm.fit(docs.where(~lm.held_out(F.col("doc_id"))))
    # A class distribution and, inside the tails, shares that leave the unseen words theirs.
    assert np.allclose((10**model.log_class).sum(1), 1)
    out = {r.doc_id: r for r in lm.score(docs, model, counts).collect()}
    rows = docs.collect()
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), "\0"] for r in rows]
    held = [zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    base = score = 0.0
    for r, t, h in zip(rows, tokens, held, strict=True):
        got = out[r.doc_id]
        assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens) == (h, len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(got.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        base, score = base + h * got.base_score, score + h * got.score
    assert score > base  # better than the base on held-out text
    empty = docs.limit(0)
    model, counts = lm.fit(empty)
    assert lm.score(empty, model, counts).count() == 0


def test_tail_probabilities_add_up():
    pairs = np.random.default_rng(1).poisson(0.2, (lm.N_CLASSES + 1, lm.N_CLASSES)).astype(float)
    assert np.allclose(np.exp(lm.fit_nce(pairs, steps=20)).sum(1), 1)


def test_classifier_keeps_clean_and_rejects_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0)], docs.schema)
    out = {r.doc_id: r for r in quality_classifier.judge(docs.union(odd).withColumn("kept", F.lit(1)), labels).collect()}
    assert len(out) == docs.count() + 2 and not out[10**6].kept and not out[10**6 + 1].kept
    good = [out[r.doc_id].kept for r in labels.where("quality = 1").collect()]
    assert sum(good) >= 0.98 * len(good)
    junk = [r for r in docs.collect() if "$$$" in r.text and r.n_chars > 200]
    assert junk and not any(out[r.doc_id].kept for r in junk)
    none = quality_classifier.judge(docs, labels.limit(0))
    assert none.where("kept").count() == docs.where("length(text) > 0").count()
    assert quality_classifier.judge(docs.limit(0), labels).count() == 0
    names = ["of", "low", "middle", "slack", "held", "trusted_id", "lm_lang", "lm_text", "lm_id", "lm_sum", "own__0"]
    clash = docs
    for name in names:
        clash = clash.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    again = quality_classifier.judge(clash, labels).collect()
    assert all(r.kept == out[r.doc_id].kept and all(r[name] == f"{name}{r.doc_id}" for name in names) for r in again) and len(again) == docs.count()


def test_classifier_rejects_rows_labelled_bad(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = quality_classifier.judge(docs, labels, ["doc_id"]).join(labels, "doc_id")
    kept = {r.quality: (r.n, r.kept) for r in out.groupBy("quality").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    print(kept)
    # All rows labelled 0, word loops and short ones too; what it costs of the good ones.
    assert kept[0][1] <= 0.08 * kept[0][0] and kept[1][1] >= 0.99 * kept[1][0]


def test_classifier_thresholds_come_from_all_trusted_documents(spark):
    ids = [r.id for r in spark.range(24_000).orderBy(F.xxhash64("id"), "id").collect()]
    rng = np.random.default_rng(4)

    def text(letters):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(8))

    # The last by hash are of another language and alphabet: none of them is among those fitted on.
    rows = [(i, text("abcdefgh"), "en") for i in ids[:-50]] + [(i, text("äöüßéèçñ"), "xx") for i in ids[-50:]] + [(-1, text("abcdefgh"), "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.where("doc_id >= 0").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    limits = {r.lang: r for r in quality_classifier.judge(docs, labels).groupBy("lang").agg(
        F.max("max_perplexity").alias("limit"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert limits["xx"].kept == 50 and limits["xx"].limit != limits["zz"].limit  # zz has none and takes that of all


def test_classifier_is_fitted_on_all_trusted_documents(spark):
    labels = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    trusted = quality_classifier.trusted_ids(labels)
    assert quality_classifier.fitting_ids(trusted).count() == trusted.where("clean and not held").count() > 40_000
    table = quality_classifier.character_classes([ord(c) for c in "abcdefgh"])
    texts = spark.createDataFrame([("abc abd",)] * 500, "text string")
    assert [r.c for r in quality_classifier.gram_counts(texts, table).collect()] == [500] * 7


def test_texts_of_trusted_documents_are_whole(spark, monkeypatch):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).union(spark.createDataFrame([(None, "none")], "doc_id long, text string"))
    ids = spark.range(0, 4_000, 7).select(F.col("id").alias("trusted_id"))
    for bits in (quality_classifier.FILTER_BITS, 256):
        monkeypatch.setattr(quality_classifier, "FILTER_BITS", bits)
        assert sorted(int(r.text) for r in quality_classifier.texts_of(docs, ids).collect()) == list(range(0, 3_000, 7))


def test_kneser_ney_adds_up(spark):
    table = quality_classifier.character_classes([ord(c) for c in "abcdefgh"])
    counts = quality_classifier.gram_counts(spark.createDataFrame([("abc abd",), ("hgf",), (None,)], "text string"), table)
    p = 10 ** quality_classifier.kneser_ney(counts).astype(float).reshape(-1, quality_classifier.CLASSES)
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def test_html_on_unseen_fillings():
    model = html.train()
    for source in labelled_pages(2, 77):
        page = html.Page(source)
        state = html._labels(page)
        want = " ".join(t for node, t in page.texts if state[node])
        assert html.main_text(model, [source]) == [want], source


def test_html_rows(spark):
    article = "<body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>one\n two<script>x='</p>'</script> <b>thr</b>ee<p>four</article><footer>f</footer>"
    pages = spark.createDataFrame([(1, "u", article, "old"), (1, "u", article, "old"), (2, None, None, "old"), (3, "v", "", "old"), (4, "w", "<<< a < b", "x")],
                                  "page_id long, url string, html string, text string")
    out = [(r.page_id, r.text, r.n_chars) for r in html.extract(pages).orderBy("page_id").collect()]
    text = "A & B one two three four"
    assert out == [(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "<<< a < b", 9)]
    deep = "<div>" * 3000 + "word " * 50
    assert html.main_text(html.train(), [deep]) in (["word " * 49 + "word"], [""])


def test_html_takes_every_block_tag():
    model, long = html.train(), "many words of a paragraph that belongs to the article and says something at length. " * 4
    for tag in sorted(html.BLOCKS):
        # Bare, and within an article between two of its paragraphs.
        html.main_text(model, [f"<{tag}>some text</{tag}>"])
        text = html.main_text(model, [f"<body><article><h1>Head</h1><p>{long}</p><{tag}>inner words</{tag}><p>{long}</p></article></body>"])[0]
        assert text.startswith("Head many words")
        if tag in ("address", "details", "summary"):
            assert "inner words" in text, tag


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(texts):
    sets, parent = {}, {}
    for i, t in texts.items():
        sets[i] = shingles(t)
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    word = lambda: "w" + str(rng.integers(0, 4000))
    texts, passage = {}, " ".join(word() for _ in range(40))
    original = [word() for _ in range(80)]
    for i in range(60):  # near copies of one text, some chained through others, on both sides of the threshold
        copy = list(original)
        for at in rng.choice(80, rng.integers(0, 5), replace=False):
            copy[at] = word()
        texts[i] = " ".join(copy)
    for i in range(60, 100):  # a passage that many share
        texts[i] = passage + " " + " ".join(word() for _ in range(rng.integers(0, 60)))
    texts |= {100: "", 101: None, 102: "one two", 103: "One TWO", 104: "one two three", 105: texts[3], 106: " \n "}
    docs = spark.createDataFrame([(i, t, 7) for i, t in texts.items()] + [(None, texts[3], 7), (105, texts[3], 7)], "doc_id long, text string, n_shingles int")
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == len(texts) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute(texts)
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_rows_of_a_column_meet_by_tiles(spark):
    """With tiny tiles and with one tile: every pair over the similarity that shares a column is met, and only pairs that share one."""
    rng = np.random.default_rng(11)
    base = [["w" + str(x) for x in rng.integers(0, 10**6, size)] for size in (30, 40, 400, 2500)]
    texts = {}
    for i in range(80):
        copy = list(base[i % 4])
        for at in rng.choice(len(copy), rng.integers(0, 2 + len(copy) // 40), replace=False):
            copy[at] = "x" + str(rng.integers(0, 10**6))
        texts[i] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = jaccard.profiles(docs, none).cache()
    name = {r.row: r.doc_id for r in rows.collect()}
    cells = rows.select("row", F.col("row").alias("root"), "n", "short", F.posexplode("prefix").alias("place", "column"))
    members = cells.join(cells.groupBy("column").agg(F.count("*").alias("rows")), "column")
    shared = {frozenset((x, y)) for r in members.groupBy("column").agg(F.collect_set("row").alias("s")).collect() for x in r.s for y in r.s if x != y}
    sets = {r: shingles(texts[i]) for r, i in name.items()}
    alike = {frozenset((x, y)) for x in sets for y in sets if x < y and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])}
    for tile in (2, 512):
        pairs = jaccard.meetings(members, tile=tile).collect()
        met = {frozenset((r.a, r.b)) for r in pairs}
        assert len(met) == len(pairs) and alike <= met <= shared and len(alike) > 100
    same = members.withColumn("root", F.lit(1).cast("long"))
    assert jaccard.meetings(same).count() == 0 and jaccard.meetings(members.limit(0)).count() == 0


def test_meetings_do_not_depend_on_pairs_at_a_time(monkeypatch):
    rng, m = np.random.default_rng(1), 600
    frame = pd.DataFrame({"column": np.sort(rng.integers(0, 9, m)), "i": 0, "j": 0, "own": 0, "row": np.arange(m) * 7, "root": rng.integers(0, 300, m),
                          "n": rng.integers(90, 110, m), "place": rng.integers(0, 16, m), "short": [b"\x01" * (8 << (k % 2)) for k in range(m)]})
    seen = set()
    for pairs in (1 << 20, 3000, 16, 1):
        monkeypatch.setattr(jaccard, "PAIRS", pairs)
        seen.add(frozenset(map(tuple, jaccard._met(frame, 75)[["a", "b"]].to_numpy().tolist())))
    assert len(seen) == 1 and len(next(iter(seen))) > 100


def near_copies(seed, copies, size, most):
    """Texts that differ from one original in up to ``most`` places."""
    rng = np.random.default_rng(seed)
    original = ["w" + str(x) for x in rng.integers(0, 10**6, size)]
    for i in range(copies):
        copy = list(original)
        for at in rng.choice(size, rng.integers(0, most + 1), replace=False):
            copy[at] = "x" + str(rng.integers(0, 10**6))
        yield " ".join(copy)


def test_large_group_of_near_copies_leaves_few_pairs(spark, monkeypatch):
    """Most of a group is one component before all its rows meet, so that the pairs looked at do not grow with its square."""
    texts = dict(enumerate(near_copies(4, 400, 100, 6)))
    stored = {}

    def materialise(df, name, folder=None):
        stored[name] = table = session.materialise(df, name, folder)
        if name == "rest":
            stored["pairs"] = table.count()
        return table
    monkeypatch.setattr(jaccard, "materialise", materialise)
    out = jaccard.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(texts)
    assert stored["pairs"] <= 2 * len(texts)


def test_rest_meets_though_no_row_has_a_new_nearest(spark, monkeypatch):
    """The last meeting does not hang on what the nearest partners bring."""
    texts = dict(enumerate(near_copies(6, 60, 80, 5)))
    meetings = jaccard.meetings
    monkeypatch.setattr(jaccard, "meetings", lambda members, *more, nearest=False, **named: meetings(members, *more, **named).where(F.lit(not nearest)))
    out = jaccard.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(texts)


def test_nearest_partners_are_the_least_unlike():
    pairs = pd.DataFrame([(1, 2, 5), (1, 3, 4), (2, 3, 5), (4, 5, 0), (2, 5, 6)], columns=["a", "b", "unlike"])
    assert sorted(map(tuple, jaccard._nearest(pairs)[["a", "b", "unlike"]].to_numpy().tolist())) == [(1, 3, 4), (2, 1, 5), (3, 1, 4), (4, 5, 0), (5, 4, 0)]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == before.columns and docs.subtract(before).count() == 0, name
    kept = {r.doc_id: r.text for r in docs.collect()}
    groups = Counter(c for _, c in brute(kept).values())
    assert max(groups.values()) == 1 and all(labels.get(i, 1) for i in kept)
    placed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in placed.collect()} == set(kept)
    used = placed.groupBy("bin").agg(F.sum("piece_tokens").alias("n")).agg(F.max("n")).first()[0]
    assert used <= 2048


def test_near_duplicates_stage_decides_on_rows(spark):
    rng = np.random.default_rng(8)
    make = lambda: " ".join("w" + str(x) for x in rng.integers(0, 10**6, 60))
    a, b, c, d, e = (make() for _ in range(5))
    near = lambda t: t + " tail"
    stay = [(3, a, "s"), (7, b, "s"), (None, c, "s"), (None, d, "s"), (9, e, "r"), (10, "", "s"), (10, "", "s"), (None, None, "s"), (None, " ", "s")]
    go = [(7, near(a), "s"), (None, near(a), "s"), (None, c, "s"), (9, e, "s"), (9, near(e), "s"), (11, e, "s")]
    docs = spark.createDataFrame(stay + go, "doc_id long, text string, source string")
    out = corpus_pipeline.near_duplicates_stage(spark, docs, SF)
    assert out.columns == docs.columns and Counter(tuple(r) for r in out.collect()) == Counter(stay)


def test_parities_never_differ_in_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(5)
    for size, other, shared in [(1, 1, 0), (1, 1, 1), (60, 70, 55), (90, 120, 88), (500, 660, 495), (500, 500, 430), (3000, 3000, 0), (64, 65, 64)]:
        pool = rng.integers(0, 1 << 63, size + other - shared).astype(np.uint64)
        a, b = np.sort(pool[:size]), np.sort(pool[size - shared:])
        x, y = jaccard._parities(np.repeat([0, 1], [size, other]), np.concatenate([a, b]), np.array([size, other]))
        assert jaccard._unlike([x, y, x], [y, x, x]).tolist()[2] == 0
        assert max(jaccard._unlike([x, y], [y, x])) <= size + other - 2 * shared
