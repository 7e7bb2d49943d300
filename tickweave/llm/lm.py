"""Log-bilinear language model: trained in numpy by noise-contrastive estimation, scored with exact token counts.

Frequent words are output classes of their own, all others share hashed tail classes, and the end of a text is a
class. The score of a class after a context is the product of two learned vectors plus a bias; one batched matrix
product over all contexts gives the normalised class probabilities. Inside a tail class a word has its discounted
share of the class's tokens, and what the discount leaves is the probability of all words never seen, so that the
probabilities of a token add up to one.

Training reads every training text: class pairs are counted by Spark over all of them, and the noise-contrastive
objective is followed on that table with the noise taken in expectation, as if infinitely many noise words were drawn.
Words and counts grow with the corpus and stay in Spark; the table has a fixed number of cells.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.words import buffers, hash_words
from tickweave.session import materialise

#: Words with a class of their own, classes of all other words, length of the learned vectors.
SHORT_LIST, TAILS, WIDTH = 512, 64, 24
#: Noise words a data word is told from, and steps of the optimiser.
NOISE, STEPS, RATE = 10, 250, 0.05
#: Bytes of text whose documents meet their words' counts in one task.
BUCKET_BYTES = 8 << 20
#: Stands for the end of a text among the word hashes.
END = np.uint64(0x5E9D0F7EC1A2B3D4)


@dataclass
class Model:
    """Short-list hashes in order with their classes, log10 probabilities of classes after contexts and of unseen words, tails' sizes."""

    hashes: np.ndarray
    classes: np.ndarray
    log_class: np.ndarray
    log_unseen: np.ndarray
    tail_tokens: np.ndarray
    discount: float
    tokens: int
    types: int

    def classify(self, hashes: np.ndarray) -> np.ndarray:
        return classify(hashes, self.hashes, self.classes)


def classify(hashes: np.ndarray, short: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Class of each word: its own, a tail by hash, or the end."""
    out = SHORT_LIST + (hashes % np.uint64(TAILS)).astype(np.int64)
    if len(short):
        at = np.minimum(np.searchsorted(short, hashes), len(short) - 1)
        out = np.where(short[at] == hashes, classes[at], out)
    return np.where(hashes == END, SHORT_LIST + TAILS, out)


N_CLASSES = SHORT_LIST + TAILS + 1
START = N_CLASSES  # context of a text's first token


def token_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each with its end, and tokens by text."""
    hashes, counts = hash_words(texts)
    return np.insert(hashes, np.cumsum(counts), END), counts + 1


def contexts(classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Class of the token before, or the start of the text."""
    before = np.empty_like(classes)
    before[1:] = classes[:-1]
    before[np.cumsum(counts) - counts] = START
    return before


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text (null: empty) leaves 2 when divided by 7."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def word_counts(texts: DataFrame) -> DataFrame:
    """``hash, n`` over the column ``text`` of all rows, summed in each task first."""

    def count(frames):
        for frame in frames:
            streams = [token_stream(run)[0] for _, run in buffers(frame["text"])]
            if streams:
                hashes, n = np.unique(np.concatenate(streams), return_counts=True)
                yield pd.DataFrame({"hash": hashes.view(np.int64), "n": n})

    return texts.select("text").mapInPandas(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _pairs(texts: DataFrame, short: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Counts of class after context over all texts: at most ``(N_CLASSES + 1) * N_CLASSES`` cells reach the driver."""

    def count(frames):
        cells = np.zeros((N_CLASSES + 1) * N_CLASSES, np.int64)
        for frame in frames:
            for _, run in buffers(frame["text"]):
                stream, counts = token_stream(run)
                found = classify(stream, short, classes)
                cells += np.bincount(contexts(found, counts) * N_CLASSES + found, minlength=len(cells))
        at = np.flatnonzero(cells)
        yield pd.DataFrame({"cell": at, "n": cells[at]})

    rows = texts.select("text").mapInPandas(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((N_CLASSES + 1) * N_CLASSES)
    out[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return out.reshape(N_CLASSES + 1, N_CLASSES)


def fit_nce(pairs: np.ndarray, width: int = WIDTH, noise: int = NOISE, steps: int = STEPS, rate: float = RATE, seed: int = 7) -> np.ndarray:
    """Natural log probabilities of classes (columns) after contexts (rows), normalised."""
    rng = np.random.default_rng(seed)
    total = pairs.sum()
    by_class, by_context = pairs.sum(0), pairs.sum(1)
    share = (by_class + 0.1) / (total + 0.1 * len(by_class))
    data = pairs / max(total, 1.0)
    drawn = (by_context / max(total, 1.0))[:, None] * share[None] * noise
    level = np.log(noise * share)
    left, right = rng.normal(0, 0.1, (len(by_context), width)), rng.normal(0, 0.1, (len(by_class), width))
    bias = np.log(share)
    params = [left, right, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        odds = 1 / (1 + np.exp(-np.clip(left @ right.T + bias - level, -40, 40)))
        pull = data * (1 - odds) - drawn * odds
        # The usual weight decay keeps contexts seen a few times near the average one.
        for p, g, a, b in zip(params, (pull @ right - 1e-7 * left, pull.T @ left - 1e-7 * right, pull.sum(0)), first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p += rate * (1 - step / (steps + 1)) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
    scores = left @ right.T + bias
    top = scores.max(1, keepdims=True)
    return scores - top - np.log(np.exp(scores - top).sum(1, keepdims=True))


def fit(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model of all training texts (column ``text``), and the stored ``hash, n`` of all their tokens."""
    counts = materialise(word_counts(training), "counts")
    end = int(END.view(np.int64))
    facts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types"),
                       F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once"), F.sum(F.when(F.col("n") == 2, 1).otherwise(0)).alias("twice")).first()
    short = [r.hash for r in counts.where(F.col("hash") != end).orderBy(F.desc("n"), "hash").limit(SHORT_LIST).collect()]
    hashes = np.array(short, np.int64).view(np.uint64)
    order = np.argsort(hashes)
    pairs = _pairs(training, hashes[order], order)
    tail = F.expr(f"pmod(pmod(hash, {TAILS}) + {TAILS}, {TAILS})")  # a power of two: the same for signed and unsigned
    tails = counts.where(F.col("hash") != end).join(F.broadcast(training.sparkSession.createDataFrame([(h,) for h in short], "hash long")), "hash", "left_anti") \
        .groupBy(tail.alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()
    once, twice = facts["once"] or 0, facts["twice"] or 0
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    tokens, types = np.zeros(TAILS), np.zeros(TAILS)
    for row in tails:
        tokens[row["tail"]], types[row["tail"]] = row["n"], row["types"]
    log_class = fit_nce(pairs)
    unseen = np.where(tokens > 0, discount * types / np.maximum(tokens, 1), 1.0)
    log_unseen = np.log10(np.exp(log_class[:, SHORT_LIST : SHORT_LIST + TAILS]) @ unseen)
    return Model(hashes[order], order, log_class / np.log(10), log_unseen, tokens, discount, int(facts["tokens"]), int(facts["types"])), counts


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 11) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Documents are dealt to buckets; each bucket's distinct words meet their counts in a join, and the answers come
    back to the bucket. Null texts are empty: they hold an end and nothing else. Repeated rows, which the row's place spreads
    over the buckets, are scored each.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), held_out(F.col(f"`{key}`")).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "key", F.monotonically_increasing_id()), F.lit(buckets))) \
        .repartition(min(buckets, 100_000), "bucket")
    sent = spark.sparkContext.broadcast(model)  # a fixed number of cells

    def ask(frames):
        for frame in frames:
            for bucket, part in frame.groupby("bucket"):
                words = [np.unique(token_stream(run)[0]) for _, run in buffers(part["text"])]
                if words:
                    hashes = np.unique(np.concatenate(words)).view(np.int64)
                    yield pd.DataFrame({"bucket": bucket, "hash": hashes})

    asked = dealt.select("bucket", "text").mapInPandas(ask, "bucket long, hash long")
    answers = asked.join(counts, "hash").groupBy("bucket", "hash").agg(F.max("n").alias("n")) \
        .select(F.col("bucket").alias("to"), "hash", "n")

    def judge(left, right):
        m = sent.value
        hashes, n = right["hash"].to_numpy(np.int64).view(np.uint64), right["n"].to_numpy(np.int64)
        order = np.argsort(hashes)
        hashes, n = hashes[order], n[order]
        out = np.zeros((len(left), 4))
        for first, run in buffers(left["text"]):
            stream, lengths = token_stream(run)
            seen = np.zeros(len(stream), np.int64)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, stream), len(hashes) - 1)
                seen = np.where(hashes[at] == stream, n[at], 0)
            found = m.classify(stream)
            before = contexts(found, lengths)
            tail = (found >= SHORT_LIST) & (found < SHORT_LIST + TAILS)
            value = m.log_class[before, found]
            inside = np.maximum(seen - m.discount, 1e-12) / np.maximum(m.tail_tokens[np.where(tail, found - SHORT_LIST, 0)], 1)
            value = np.where(tail, np.where(seen > 0, value + np.log10(inside), m.log_unseen[before]), value)
            base = np.log10((seen + 1) / (m.tokens + m.types + 1))
            starts = np.cumsum(lengths) - lengths
            out[first : first + len(run)] = np.stack([lengths, np.add.reduceat(seen > 0, starts, dtype=np.int64),
                                                      np.add.reduceat(base, starts), np.add.reduceat(value, starts)], 1)
        return pd.DataFrame({key: left["key"], "held_out": left["held_out"], "n_tokens": out[:, 0].astype(np.int64),
                             "n_known": out[:, 1].astype(np.int64), "train_tokens": m.tokens, "base_score": out[:, 2], "score": out[:, 3]})

    kind = docs.schema[key].dataType.simpleString()
    return dealt.groupBy("bucket").cogroup(answers.groupBy("to")).applyInPandas(
        judge, f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model, counts = fit(docs.where(~held_out(F.col("doc_id"))))
    return score(docs, model, counts)
