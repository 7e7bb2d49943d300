"""Phrase collocations: counted n-grams of all texts, scored by their weakest cut.

Tasks build count transducers (:mod:`~tickweave.llm.automata`) of their texts' n-grams and deal them out by ranges of n-grams. A task
for each range unites them and sums their weights; what reaches the least count goes on. Counts of parts come from composing the
phrases of a range with the transducer of that range: first parts in word order, last parts in reversed word order, so that all parts
of a phrase lie on its own path and a part shared by many phrases is no hot key.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.llm import automata
from tickweave.llm.automata import DEPTH
from tickweave.session import materialise

LEAST = 100
TOP = 2000
#: Words whose n-grams one transducer of a task holds; words of a range, and phrases of a range of the composition.
SHARD_WORDS, RANGE_WORDS, RANGE_PHRASES = 1 << 21, 1 << 20, 1 << 18
#: Ranges at most, so that their ends stay small (beyond it ranges grow). A word of an end is cut to END_BYTES, which moves the end and no count.
MOST_RANGES, END_BYTES = 1 << 17, 32
#: About so many documents, and of them every so many words, place the ends of ranges. They change how even ranges are, never a count.
SAMPLE_DOCS, SAMPLE_STEP = 4000, 8

_CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")

End = tuple[str, list[bytes]]


def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """Words of every piece of a UTF-8 text that has words."""
    for line in raw.translate(_CLEAN).split(b"\n"):
        # What bytes.split() takes for white space is a blank here: the others have been replaced.
        if words := line.split():
            yield words


class Shard:
    """N-grams of one language, gathered piece by piece."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.looked: list[int] = []

    def add(self, words: list[bytes]) -> None:
        self.ids.extend(map(self.number.__getitem__, words))
        self.lengths.append(len(words))
        self.looked.append(0)

    def add_part(self, words: list[bytes], ahead: int) -> None:
        """Words of a part of a long piece; the last ``ahead`` only end n-grams that start before them."""
        self.add(words)
        self.looked[-1] = ahead

    def grams(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Different n-grams of up to DEPTH words from every word, as labels in byte order of words; their counts; the words."""
        words = sorted(self.number)
        rank = np.empty(len(words), np.int32)
        rank[[self.number[w] for w in words]] = np.arange(1, len(words) + 1)
        labels, lengths = rank[np.array(self.ids, np.int64)], np.array(self.lengths)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(labels))
        out = np.zeros((len(labels), DEPTH), np.int32)
        for k in range(DEPTH):
            n = max(len(labels) - k, 0)
            out[:n, k] = np.where(left[:n] > k, labels[k:], 0)
        return *automata.sorted_grams(out[left > np.repeat(np.array(self.looked), lengths)], len(words) + 1), words


def _at(grams: np.ndarray, words: list[bytes], end: list[bytes]) -> int:
    """First of the ordered n-grams that is not before ``end``."""
    low, high = 0, len(grams)
    for d, word in enumerate(end):
        place = bisect_left(words, word)
        column = grams[low:high, d]
        if place == len(words) or words[place] != word:
            return low + int(np.searchsorted(column, place + 1))
        low, high = low + int(np.searchsorted(column, place + 1)), low + int(np.searchsorted(column, place + 1, "right"))
    return low


def transducers(docs: DataFrame, ends: list[End]) -> DataFrame:
    """``range, lang, part``: packed count transducers of bounded shards, cut at the ends of ranges. ``docs``: lang, text (binary)."""
    langs = [lang for lang, _ in ends]

    def cut(lang: str, shard: Shard) -> Iterator[tuple[int, str, bytes]]:
        grams, counts, words = shard.grams()
        first, last = bisect_left(langs, lang), bisect_right(langs, lang)
        cuts = [0, *(_at(grams, words, end) for _, end in ends[first:last]), len(grams)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                yield first + k, lang, automata.build(grams[a:b], counts[a:b], words).pack()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = defaultdict(Shard)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(shards):
                for at, own, part in cut(lang, shards.pop(lang)):
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([own]), pa.array([part])], ["range", "lang", "part"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for words in pieces(text.as_py() or b""):
                    if len(words) <= SHARD_WORDS:
                        shards[lang].add(words)
                        held += len(words)
                    else:
                        for a in range(0, len(words), SHARD_WORDS):
                            part = words[a : a + SHARD_WORDS + DEPTH - 1]
                            shards[lang].add_part(part, max(len(part) - SHARD_WORDS, 0))
                            yield from flush()
                            held = 0
                    if held >= SHARD_WORDS:
                        yield from flush()
                        held = 0
        yield from flush()

    return docs.mapInArrow(run, "range int, lang string, part binary")


def _ends(keys: DataFrame, ranges: int) -> list[End]:
    """Ends that cut the sample ``lang, words`` into about equal ranges, fewer than ``ranges``."""
    if ranges < 2:
        return []
    dealt = keys.repartitionByRange(ranges, "lang", "words").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("lang", "words")).alias("end"))
    return sorted((r.end.lang, [bytes(w) for w in r.end.words]) for r in dealt.collect())[1:]


def _sampled(docs: DataFrame, rows: int) -> tuple[DataFrame, float]:
    """First words of n-grams of about :data:`SAMPLE_DOCS` documents, and how many words each stands for."""
    share = min(1.0, SAMPLE_DOCS / max(rows, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, grams, at = [], [], 0
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for words in pieces(text.as_py() or b""):
                    for k in range(-at % SAMPLE_STEP, len(words), SAMPLE_STEP):
                        langs.append(lang)
                        grams.append([w[:END_BYTES] for w in words[k : k + DEPTH]])
                    at += len(words)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(grams, pa.list_(pa.binary()))], ["lang", "words"])

    part = docs.sample(share, seed=7) if share < 1 else docs
    return part.mapInArrow(run, "lang string, words array<binary>"), SAMPLE_STEP / share


def counted(docs: DataFrame, least: int = LEAST, range_words: int = RANGE_WORDS) -> DataFrame:
    """``lang, phrase, f`` of all phrases of 1 to 5 words that occur at least ``least`` times, and of the empty phrase: all words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    keys, each = _sampled(texts, texts.count())
    keys = materialise(keys, "sampled-grams")
    ends = _ends(keys, min(MOST_RANGES, int(-(-keys.count() * each // range_words))))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        place, lang = key[0].as_py(), key[1].as_py()
        around = [words for own, words in ends[max(place - 1, 0) : place + 1] if own == lang]
        total, found = automata.unite([automata.Transducer.unpack(x.as_py()) for x in table.column("part")], least, around)
        phrases, sums = zip((b"", total), *found, strict=True)
        return pa.table({"lang": pa.array([lang] * len(sums), pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
                         "f": pa.array(sums, pa.int64())})

    parts = transducers(texts, ends).groupBy("range", "lang").applyInArrow(run, "lang string, phrase string, f long")
    # Prefixes of ends come from several ranges.
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == ""))


def _words(phrase: Column | str) -> Column:
    return F.filter(F.split(phrase, " "), lambda w: w != "")


def parts(frequent: DataFrame, backwards: bool, range_phrases: int = RANGE_PHRASES) -> DataFrame:
    """``lang, phrase, along`` of every phrase of two words or more of ``frequent``: its language's words, then the counts of its first
    word, first two words and so on; backwards: of its last word, last two words and so on.
    """
    words = F.reverse(_words("phrase")) if backwards else _words("phrase")
    keyed = frequent.select("lang", words.alias("words"), "f")
    ranges = int(min(MOST_RANGES >> 4, -(-frequent.count() // range_phrases)))
    ends = [(lang, [w.decode() for w in end]) for lang, end in _ends(keyed.select("lang", F.transform("words", lambda w: w.cast("binary")).alias("words")), ranges)]
    above = sorted({(lang, " ".join(reversed(end[:k]) if backwards else end[:k])) for lang, end in ends for k in range(len(end))})
    # At most five prefixes for each end: a bounded table.
    known = {}
    if above:
        spark = frequent.sparkSession
        asked = F.broadcast(spark.createDataFrame(above, "lang string, phrase string"))
        known = {(r.lang, r.phrase): r.f for r in frequent.join(asked, ["lang", "phrase"]).collect()}
    order = [(lang, end) for lang, end in ends]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(order, key) for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], ["range", "lang", "words", "f"])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        at, lang = key[0].as_py(), key[1].as_py()
        own, weights = table.column("words").to_pylist(), table.column("f").to_pylist()
        asked = len(own)
        if at and order[at - 1][0] == lang:
            end = order[at - 1][1]
            for k in range(len(end)):
                own.append(end[:k])
                weights.append(known[lang, " ".join(reversed(end[:k]) if backwards else end[:k])])
        total = next(f for w, f in zip(own, weights) if not w)
        number = {w: k for k, w in enumerate({w for phrase in own for w in phrase}, 1)}
        grams = np.zeros((len(own), DEPTH), np.int64)
        for k, phrase in enumerate(own):
            grams[k, : len(phrase)] = [number[w] for w in phrase]
        long = np.flatnonzero((grams[:asked] > 0).sum(axis=1) > 1)
        # An end is also a phrase of the range it begins: one of each is enough.
        once = np.unique(grams, axis=0, return_index=True)[1]
        along = automata.Counts(grams[once], np.array(weights)[once], len(number)).compose(grams[long])
        lists = [[total, *row[: len(own[k])]] for k, row in zip(long.tolist(), along.tolist())]
        phrases = [" ".join(reversed(own[k]) if backwards else own[k]) for k in long.tolist()]
        return pa.table({"lang": pa.array([lang] * len(lists), pa.string()), "phrase": pa.array(phrases, pa.string()),
                         "along": pa.array(lists, pa.list_(pa.int64()))})

    placed = keyed.mapInArrow(place, "range int, lang string, words array<string>, f long")
    return placed.groupBy("range", "lang").applyInArrow(run, "lang string, phrase string, along array<long>")


def scored(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every candidate that is in no longer one as frequent."""
    long = frequent.select("lang", _words("phrase").alias("words"), "f").where(F.size("words") > 2)
    inside = long.select("lang", "f", F.explode(F.array(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1))).alias("part")) \
        .groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("f").alias("longer"))
    whole = parts(frequent, False).join(parts(frequent, True).withColumnRenamed("along", "back"), ["lang", "phrase"]) \
        .join(inside, ["lang", "phrase"], "left")
    m = F.size("along") - 1
    a, n = F.element_at("along", m + 1), F.element_at("along", 1)
    exact = "decimal(20,0)"
    cuts = []
    for k in range(1, DEPTH):
        left, right = F.get("along", F.lit(k)), F.get("back", m - k)
        whole = whole.withColumns({f"l{k}": left, f"r{k}": right})
        product = F.lit(1000).cast("decimal(4,0)") * a.cast(exact) * n.cast(exact)
        share = F.call_function("div", product, F.col(f"l{k}").cast(exact) * F.col(f"r{k}").cast(exact))
        cuts.append(F.when(m > k, F.struct(share.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))))
    return whole.where(F.coalesce("longer", F.lit(0)) < a).withColumn("cut", F.least(*cuts)) \
        .select("lang", "phrase", a.alias("a"), "cut.l", "cut.r", n.alias("n"), "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` needs ``lang`` and ``text``; other columns are not read. Texts of a null language count for ``und``, null and empty texts
    have no words, repeated rows count each time, very long texts are cut into shards with the words that reach over; equal
    scores are ordered by count, then by phrase. Languages without candidates, and empty tables, give no rows.
    """
    frequent = materialise(counted(docs, least), "frequent")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return scored(frequent).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top) \
        .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf}/documents.parquet"))


#: Words keep their order inside a piece; a phrase is every slice of up to five of them.
SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), grams AS (
    SELECT lang, k, unnest(CASE WHEN len(words) < k THEN [] ELSE list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' ')) END) AS phrase
    FROM worded, (SELECT unnest(range(1, 6)) AS k)
), counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
), totals AS (
    SELECT lang, sum(len(words))::hugeint AS n FROM worded GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE k > 1
), parts AS (
    SELECT c.*, cut, array_to_string(words[1:cut], ' ') AS head, array_to_string(words[cut + 1:k], ' ') AS tail
    FROM candidates c, (SELECT unnest(range(1, 5)) AS cut) WHERE cut < k
), cuts AS (
    SELECT p.lang, p.phrase, p.a, x.f AS l, y.f AS r, n, p.cut, (1000::hugeint * p.a * n) // (x.f::hugeint * y.f) AS score
    FROM parts p JOIN counts x ON x.lang = p.lang AND x.phrase = p.head JOIN counts y ON y.lang = p.lang AND y.phrase = p.tail JOIN totals t ON t.lang = p.lang
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), held AS (
    SELECT DISTINCT c.lang, array_to_string(c.words[i:j], ' ') AS phrase, c.a AS longer
    FROM candidates c, (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(2, 6)) AS j) WHERE i < j AND j <= c.k AND j - i + 1 < c.k
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::bigint AS n, score::bigint AS score
FROM lowest w WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = w.lang AND h.phrase = w.phrase AND 100 * h.longer >= 100 * w.a)
QUALIFY rank <= 2000
"""
