"""The classifier's model over all characters: none lumped together, none of the trusted texts left out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickweave.llm import quality_classifier as qc

FREQUENT = "".join(chr(0x430 + i) for i in range(50))
RARE = "".join(chr(0x4E00 + i) for i in range(100))


def tables(spark):
    rng = np.random.default_rng(7)
    shuffled = ["".join(rng.permutation(list(RARE))) for _ in range(5)]
    rows = [(i, FREQUENT * 20, "ru") for i in range(30)] + [(100 + i, RARE[i:] + RARE[:i], "zh") for i in range(60)] + [(200 + i, t, "zh") for i, t in enumerate(shuffled)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, docs.where("doc_id < 200").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))


def test_rare_characters_are_told_apart(spark, monkeypatch):
    docs, labels = tables(spark)
    out = {r.doc_id: r for r in qc.judge(docs, labels).collect()}
    ordered, shuffled = ([r for i, r in out.items() if i // 100 == k] for k in (1, 2))
    assert all(r.kept for r in ordered) and not any(r.kept for r in shuffled)
    assert min(r.perplexity for r in shuffled) > 2 * max(r.perplexity for r in ordered)
    # What the tasks' tables lack comes from the whole ones.
    monkeypatch.setattr(qc, "TABLE_ROWS", 40)
    cut = {r.doc_id: r for r in qc.judge(docs, labels).collect()}
    assert all(cut[i].kept == r.kept and cut[i].perplexity == pytest.approx(r.perplexity, rel=1e-4) for i, r in out.items()) and len(cut) == len(out)


def test_all_clean_trusted_documents_are_fitted_on(spark):
    labels = spark.range(1_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    assert qc.fitting_ids(qc.trusted_ids(labels)).count() == 900
    texts = spark.range(200).select(F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), qc.part_of("id").alias("part"))
    parts = {r.part: r.n for r in texts.groupBy("part").agg(F.sum(F.length("text")).alias("n")).collect()}
    sums = qc.character_counts(texts).agg(*[F.sum(f"c{m}") for m in range(qc.MODELS)]).first()
    assert [*sums] == [sum(parts.values())] + [sum(parts.values()) - parts[k] for k in range(qc.PARTS)]


def test_character_probabilities_add_up(spark):
    docs = spark.createDataFrame([(i, "abc abd 12 \U0001F600x " * 5) for i in range(20)], "doc_id long, text string")
    model, own, back = qc.fit(docs, docs.select(F.col("doc_id").alias("trusted_id")))
    assert model.whole
    every = np.arange(qc.START_CODE)
    for context in (" ab", "bc ", "\U0001F600x ", "xyz", "一丁丂"):
        a, b, c = map(ord, context)
        p, unsure = model.probabilities(np.full(len(every), a << qc.BITS | b), c << qc.BITS | every, np.tile(np.arange(qc.MODELS), (len(every), 1)))
        # Less the share of the start and of classes without a character.
        assert not unsure.any() and (p > 0).all() and (p.sum(0) <= 1 + 1e-6).all()
        if context[0] in " b\U0001F600":
            assert (p.sum(0) > 0.98).all()
    asked = spark.createDataFrame([(ord(a) << qc.BITS | ord(b), ord(c) << qc.BITS | ord(d)) for a, b, c, d in ("abc ", "zzab")], "hi long, lo long").toPandas()
    hi, lo = asked["hi"].to_numpy(), asked["lo"].to_numpy()
    p, _ = model.probabilities(hi, lo, np.tile(np.arange(qc.MODELS), (len(hi), 1)))
    rows = spark.createDataFrame([(int(h), int(k), float(q)) for h, k, q in zip(hi, lo, model.base(hi, lo), strict=True)], "hi long, lo long, base double")
    units = {(r.hi, r.lo): [r[f"u{m}"] for m in range(qc.MODELS)] for r in qc.units_of(rows, own, back).collect()}
    assert all(np.allclose(units[h, k], np.log10(q) * qc.UNIT, atol=1) for h, k, q in zip(hi.tolist(), lo.tolist(), p, strict=True))
