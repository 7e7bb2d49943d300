"""Word hashes and BPE against plain Python and the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

from tickweave.llm import bpe, tokens, words

TEXTS = ["", " ", "a", "One two  THREE\tfour\x0bfive\nsix", "é É ß word", "x" * 5000, "a b c d e f a b c d e", None]
PIECES = ["a", "aa", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "é", "ß", "中", "😀", "'s", "'re", "1", "²", "_", "!!", "<|endoftext|>", "the", "<|"]


def test_words_and_shingles_equal_sets_of_python_tuples():
    raw = [(t or "").encode() for t in TEXTS]
    hashes, counts = words.hash_words(raw)
    plain = [r.lower().split() for r in raw]
    assert counts.tolist() == [len(p) for p in plain]
    names = {}
    for word, h in zip([w for p in plain for w in p], hashes.tolist(), strict=True):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    grams, n = words.shingle_hashes(hashes, counts, 5)
    at = 0
    for p, k in zip(plain, n.tolist(), strict=True):
        want = {tuple(p[i : i + 5]) for i in range(len(p) - 4)} if len(p) >= 5 else ({tuple(p)} if p else set())
        assert len(set(grams[at : at + k].tolist())) == len(want)
        at += k


def test_encoding_equals_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.vocabulary_path()
    library, own = tokenizers.Tokenizer.from_file(path), bpe.Encoder(bpe.Vocabulary(path))
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(500)] + ["a" * 2000, " " * 300, ""]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = own.encode(texts)
    assert [g.tolist() for g in got] == want
    assert [own.decode(g) for g in got] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_encode_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "old"), (1, "a b", "old"), (2, None, None), (None, "", "x")], "doc_id long, text string, ids string")
    out = bpe.encode(docs, bpe.vocabulary_path()).orderBy("doc_id", "text").collect()
    assert len(out) == 4 and out[0].ids == out[3].ids == [] and out[1].ids == out[2].ids and len(out[1].ids) == 2
    digest = {r.doc_id: r for r in bpe.digest(docs, bpe.vocabulary_path()).collect()}
    assert digest[2].n_tokens == 0 and digest[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.digest(docs.limit(0), bpe.vocabulary_path()).count() == 0


def test_token_counts_come_back_from_files(spark, tmp_path):
    texts = ["a b c", "", None, "word " * 3000, "<|endoftext|> in a text", "a b c"]
    docs = spark.createDataFrame([(i * 10**12 - 5, t) for i, t in enumerate(texts)] + [(None, "kept")], "doc_id long, text string").repartition(3)
    out = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, bpe.vocabulary_path(), str(tmp_path / "t")).collect()}
    plain = bpe.Vocabulary(bpe.vocabulary_path())
    plain.special = {}
    own = bpe.Encoder(plain)
    assert out == {i * 10**12 - 5: len(own.encode([t or ""])[0]) for i, t in enumerate(texts)} | {None: len(own.encode(["kept"])[0])}


def test_separators_are_stitched_across_small_blocks(spark, tmp_path):
    ids = np.array([1, 2, 9, 9, 3, 4, 5, 6, 7, 8, 10, 9, 2], "<u2")
    (tmp_path / "f.bin").write_bytes(ids.tobytes())
    for block in (1, 2, 3, 5, 100):
        rows = tokens.separator_scan(spark, str(tmp_path), 9, block, 2).orderBy("start").collect()
        assert [(r.start, r.length, list(r.head)) for r in rows] == [(0, 2, [1, 2]), (3, 0, [9, 3]), (4, 7, [3, 4])]


def test_rows_without_a_key_are_counted(spark, tmp_path):
    rows = [(None, "a b c"), (None, None), (0, "a b c"), (-1, ""), (2**63 - 1, "x"), (-(2**63), "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", tokens.F.lit("clash")).withColumn("head", tokens.F.lit(1))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in tokens.token_counts(docs, bpe.vocabulary_path(), str(tmp_path / "t")).collect())
    words = {(i, t): n for (i, t), n in zip(rows, (3, 0, 3, 0, 1, 2))}
    assert [g[:2] for g in got] == sorted((i is None, i or 0) for i, _ in rows)
    assert all((n > 0) == (words[row] > 0) for (_, _, n), row in zip(got, sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, words[r]))))
