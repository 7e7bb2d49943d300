"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

The n-grams are of characters, all of them. Spark counts them over all trusted documents and derives continuation counts,
discounts and back-off weights by joins of the count tables on gram and context. Below the single characters stands a model of
the same kind over character classes (white space, capitals, digits, the most frequent other characters, and the rest), which
shares out what is left for characters that were not seen. Most n-grams of a text are looked up in tables of the most frequent
ones; what these may lack is written down with its text and joined with the whole tables.
A document's mean log probability, drawn towards its language's median while it is short, is held against a threshold
from the quantiles of all trusted documents of its language, each scored by a model that was not fitted on it.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.session import materialise

#: Character classes and length of n-grams: the table of classes has CLASSES ** ORDER cells.
CLASSES, ORDER = 48, 4
#: The trusted documents that are not toxic are dealt to PARTS by a hash of the id. Model 0 is fitted on all of them, model k + 1 on all but part k.
PARTS = 5
MODELS = PARTS + 1
#: Rows of each order's tables that every task gets, most frequent first. N-grams that a longer table may hold are joined with it.
TABLE_ROWS = 1 << 18
#: Pairs of characters by which an n-gram of two such pairs is found at once, less one.
PAIRS = 2048
#: Log10 probabilities are summed in whole units, so that sums do not depend on their order.
UNIT = 1_000_000
#: Characters at the language's median that a document's mean starts with.
PRIOR_CHARS = 150
#: The threshold lies below the median by a multiple of the distance from there to the quantile LOW. The multiple is the one that rejects the
#: share LOSS of the good documents, toxic ones among them as they are no less well written; with none there it is MARGIN.
LOW, LOSS, MARGIN = 0.01, 0.005, 1.0
#: Further distance in log10 for a language with up to FEW trusted documents, whose quantiles are narrow; it shrinks as they become more.
SLACK, FEW = 0.1, 20
#: Bins per unit of log10 probability, and per unit of the multiple.
BINS, STEPS = 2000, 200
#: Bits of the filter that most texts of other documents do not pass: 8 MB, whatever the corpus.
FILTER_BITS = 1 << 26
START, SPACE, CAPITAL, DIGIT, OTHER = range(5)
_GROUPS = 5
#: The code before a text's first character, and the bits of a code. An n-gram is two numbers: ``hi``, all but its last two codes, and ``lo``, these.
START_CODE, BITS = 0x110000, 21
_MASK = (1 << BITS) - 1


def character_classes(frequent: list[int]) -> np.ndarray:
    """Class of every character of the first plane; further characters are of class ``OTHER``."""
    table = np.full(1 << 16, OTHER, np.int64)
    for i, c in enumerate(frequent[: CLASSES - _GROUPS]):
        table[c] = _GROUPS + i
    for c in range(1 << 16):
        if c in (32, 160) or 9 <= c <= 13:
            table[c] = SPACE
        elif 48 <= c <= 57:
            table[c] = DIGIT
        elif c < 0x250 and unicodedata.category(chr(c)) == "Lu":
            table[c] = CAPITAL
    return table


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts, each after ORDER - 1 start codes; which of them are a text's own; their number by text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    pad = "\x00" * (ORDER - 1)
    raw = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(lengths + ORDER - 1)
    begins = ends - lengths
    inside = np.zeros(len(raw) + 1, np.int64)
    np.add.at(inside, begins, 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside[:-1]) > 0
    return np.where(inside, raw, START_CODE).astype(np.int64), inside, lengths


def classes_of(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    # A text's own characters never are of the start class.
    return np.where(codes == START_CODE, START, table[np.minimum(codes, (1 << 16) - 1)])


def grams(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the n-gram of classes ending in each character, text after text, and characters by text."""
    raw, inside, lengths = characters(texts)
    codes = classes_of(raw, table)
    number = codes.copy()
    for k in range(1, ORDER):
        number[k:] += codes[:-k] * CLASSES**k
    return number[inside], lengths


def _texts(frame: pd.DataFrame, text: str, limit: int = 1 << 20):
    """Runs of about ``limit`` characters: position of the first text, texts (null: empty)."""
    run: list[str] = []
    first = size = 0
    for i, t in enumerate(frame[text]):
        t = t if isinstance(t, str) else ""
        if run and size + len(t) > limit:
            yield first, run
            run, first, size = [], i, 0
        run.append(t)
        size += len(t)
    if run:
        yield first, run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``trusted_id`` of all documents labelled good, ``clean`` where not toxic, ``held`` where never fitted on, as are the toxic alone."""
    return labels.where("quality = 1 and doc_id is not null").groupBy(F.col("doc_id").alias("trusted_id")).agg(
        F.max(F.coalesce("toxic", F.lit(0)) == 0).alias("clean")).withColumn("held", ~F.col("clean"))


def fitting_ids(trusted: DataFrame) -> DataFrame:
    """All of the trusted ids that are clean."""
    return trusted.where("not held").select("trusted_id")


def part_of(name: str) -> Column:
    """Part of a document, by its id."""
    return F.pmod(F.xxhash64(F.lit(5), name), F.lit(PARTS)).cast("int")


def gram_counts(texts: DataFrame, table: np.ndarray) -> DataFrame:
    """``gram, c`` of all rows' n-grams, counted in each task and then summed by gram."""

    def count(frames):
        # A cell for each n-gram, so that a task gives one row for each of its grams, however many texts it reads.
        seen = np.zeros(CLASSES**ORDER, np.int64)
        for frame in frames:
            for _, run in _texts(frame, "text"):
                number, n = np.unique(grams(run, table)[0], return_counts=True)
                seen[number] += n
        number = np.flatnonzero(seen)
        for first in range(0, len(number), 1 << 16):
            some = number[first : first + (1 << 16)]
            yield pd.DataFrame({"gram": some, "c": seen[some]})

    return texts.select("text").mapInPandas(count, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def discounts(n: list[int]) -> list[float]:
    """Usual estimates of the three discounts from the numbers of n-grams counted one to four times; too few of these give half a count."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) if n[k - 1] and n[k] and y else 0.5 * min(k, 1) for k in (1, 2, 3)]


def _cut(c: Column, cuts: list[float]) -> Column:
    return F.when(c == 0, 0.0).when(c == 1, cuts[0]).when(c == 2, cuts[1]).otherwise(cuts[2])


def _times(c: str) -> list[Column]:
    """Numbers of n-grams whose count is one to four."""
    return [F.count(F.when(F.col(c) == k, 1)) for k in (1, 2, 3, 4)]


def kneser_ney(counts: DataFrame) -> np.ndarray:
    """Log10 probability of the last class of every n-gram of classes, from the counts of the longest ones.

    Each order joins its grams with the sums of their contexts; lower orders count the distinct characters to the left.
    """
    known: list[tuple[np.ndarray, np.ndarray]] = []  # of each order, its own shares and the weights of the order below
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            counts = counts.groupBy((F.col("gram") % CLASSES**order).alias("gram")).agg(F.count("*").alias("c"))
        counts = materialise(counts, f"grams{order}")
        cut = _cut(F.col("c"), discounts([*counts.agg(*_times("c")).first()]))
        contexts = counts.groupBy(F.floor(F.col("gram") / CLASSES).alias("context")).agg(
            F.sum("c").alias("total"), F.sum(cut).alias("freed")).select("context", "total", (F.col("freed") / F.col("total")).alias("weight"))
        share = counts.withColumn("context", F.floor(F.col("gram") / CLASSES)).join(contexts, "context") \
            .select("gram", ((F.col("c") - cut) / F.col("total")).alias("p"))
        # At most CLASSES ** order rows; no frame outlives its step, so that the driver holds flat arrays of single precision alone.
        own, back = np.zeros((CLASSES ** (order - 1), CLASSES), np.float32), np.ones((CLASSES ** (order - 1), 1), np.float32)
        frame = share.toPandas()
        own.reshape(-1)[frame["gram"].to_numpy(np.int64)] = frame["p"]
        frame = contexts.select("context", "weight").toPandas()
        back[frame["context"].to_numpy(np.int64), 0] = frame["weight"]
        known.append((own, back))
    p = np.full(CLASSES, 1.0 / CLASSES, np.float32)
    while known:
        own, back = known.pop()
        # The order below repeats for each first character of a longer context.
        lower = p.reshape(1, -1, CLASSES)
        own.reshape(-1, lower.shape[1], CLASSES)[...] += back.reshape(-1, lower.shape[1], 1) * lower
        p = own.reshape(-1)
    return np.log10(p, out=p)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of all documents with one of the ``ids`` (a column ``trusted_id``), written out.

    A bit for each hash of an id goes to every task. Of the few other documents that pass it, the ids alone are told by a join,
    and the texts are written without them, so that no text is shuffled while these ids are few enough for a broadcast.
    """
    def place(name: str):
        return F.pmod(F.xxhash64(name), F.lit(FILTER_BITS))
    words = ids.select(place("trusted_id").alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).toPandas()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(held.view(np.uint64))

    @F.pandas_udf("boolean")
    def possible(at: pd.Series) -> pd.Series:
        bit = at.to_numpy(np.uint64)
        return pd.Series((sent.value[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)) == 1)

    passed = docs.where(F.col("doc_id").isNotNull() & possible(place("doc_id")))
    wrong = materialise(passed.select("doc_id").distinct().join(ids, F.col("doc_id") == F.col("trusted_id"), "left_anti"), "wrong")
    texts = materialise(passed.join(wrong, "doc_id", "left_anti").select("doc_id", "text"), "texts")
    sent.destroy()
    return texts


def character_counts(texts: DataFrame) -> DataFrame:
    """``hi, lo`` of all n-grams of characters of the rows ``text, part`` and their counts ``c0, c1, ..`` by model."""

    def count(frames):
        def summed(held):
            return pd.concat(held).groupby(["part", "hi", "lo"], as_index=False)["n"].sum()

        held, size = [], 0
        for frame in frames:
            for part, rows in frame.groupby("part"):
                for _, run in _texts(rows, "text"):
                    codes, inside, _ = characters(run)
                    pairs, at = np.unique(codes[:-1] << BITS | codes[1:], return_inverse=True)
                    number, n = np.unique((at[: 1 - ORDER + 1] * len(pairs) + at[ORDER - 2 :])[inside[ORDER - 1 :]], return_counts=True)
                    held.append(pd.DataFrame({"part": part, "hi": pairs[number // len(pairs)], "lo": pairs[number % len(pairs)], "n": n}))
                    size += len(number)
                    if size > 1 << 21:
                        held = [summed(held)]
                        size = len(held[0])
                        if size > 1 << 20:
                            yield held[0]
                            held, size = [], 0
        if held:
            yield summed(held)

    parts = texts.select("text", "part").mapInPandas(count, "part int, hi long, lo long, n long")
    without = [F.sum(F.when(F.col("part") != k, F.col("n")).otherwise(0)) for k in range(PARTS)]
    return parts.groupBy("hi", "lo").agg(F.sum("n").alias("c0"), *[c.alias(f"c{k + 1}") for k, c in enumerate(without)])


def _shorter(order: int) -> tuple[Column, Column]:
    """An n-gram's last ``order`` codes."""
    hi, lo = F.col("hi"), F.col("lo")
    return {4: (hi, lo), 3: (hi.bitwiseAND(_MASK), lo), 2: (F.lit(0).cast("long"), lo), 1: (F.lit(0).cast("long"), lo.bitwiseAND(_MASK))}[order]


def character_tables(counts: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
    """By order, the n-grams' own shares and, by context, the weights of the order below, as columns ``w0, w1, ..`` by model; ``n`` is the count.

    As in :func:`kneser_ney`, but stored as they are: a row for each n-gram and each context, however many there are.
    """
    own, back = {}, {}
    models = range(MODELS)
    context = [F.col("hi"), F.shiftright("lo", BITS).alias("context")]
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            hi, lo = _shorter(order)
            counts = counts.groupBy(hi.alias("hi"), lo.alias("lo")).agg(*[F.count(F.when(F.col(f"c{m}") > 0, 1)).alias(f"c{m}") for m in models])
        counts = materialise(counts, f"characters{order}")
        times = [*counts.agg(*[c for m in models for c in _times(f"c{m}")]).first()]
        cuts = [_cut(F.col(f"c{m}"), discounts(times[4 * m : 4 * m + 4])) for m in models]
        sums = materialise(counts.groupBy(*context).agg(
            *[F.sum(f"c{m}").alias(f"t{m}") for m in models], *[F.sum(cuts[m]).alias(f"f{m}") for m in models]), f"contexts{order}")
        back[order] = sums.select("hi", F.col("context").alias("lo"), F.col("t0").alias("n"), *[
            F.when(F.col(f"t{m}") > 0, F.col(f"f{m}") / F.col(f"t{m}")).otherwise(1.0).alias(f"w{m}") for m in models])
        own[order] = materialise(counts.withColumn("context", context[1]).join(sums, ["hi", "context"]).select("hi", "lo", F.col("c0").alias("n"), *[
            F.when(F.col(f"c{m}") > 0, (F.col(f"c{m}") - cuts[m]) / F.col(f"t{m}")).otherwise(0.0).alias(f"w{m}") for m in models]), f"shares{order}")
    return own, back


class Rows:
    """The most frequent rows of a table; ``whole`` if these are all."""

    def __init__(self, table: DataFrame, missing: float):
        frame = table.orderBy(F.desc("n"), "hi", "lo").limit(TABLE_ROWS + 1).toArrow().to_pandas()
        self.whole = len(frame) <= TABLE_ROWS
        frame = frame.iloc[:TABLE_ROWS]
        self.hi, self.lo, self.n = (frame[c].to_numpy(np.int64) for c in ("hi", "lo", "n"))
        # Pairs of numbers as one: by their places among all that occur.
        self.highs, self.lows = np.unique(self.hi), np.unique(self.lo)
        key = self._key(self.hi, self.lo)
        order = np.argsort(key)
        self.hi, self.lo, self.n = self.hi[order], self.lo[order], self.n[order]
        self.keys = np.append(key[order], np.iinfo(np.int64).max)
        self.weights = np.vstack([frame[[f"w{m}" for m in range(MODELS)]].to_numpy(float)[order], np.full(MODELS, missing)])

    def _key(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        if not len(self.highs):
            return np.full(len(hi), -1, np.int64)
        h = np.minimum(np.searchsorted(self.highs, hi), len(self.highs) - 1)
        k = np.minimum(np.searchsorted(self.lows, lo), len(self.lows) - 1)
        return np.where((self.highs[h] == hi) & (self.lows[k] == lo), h * len(self.lows) + k, -1)

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Places of the rows; that after the last for what is not here."""
        key = self._key(hi, lo)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, at, len(self.hi))


@dataclass
class Model:
    """What every task gets: a bounded part of the characters' tables and the table of classes."""

    own: dict[int, Rows]
    back: dict[int, Rows]
    table: np.ndarray
    log_p: np.ndarray

    @property
    def whole(self) -> bool:
        return all(rows.whole for rows in (*self.own.values(), *self.back.values()))

    def base(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Probability by the classes, shared evenly by the characters of the last one."""
        codes = [classes_of(c, self.table) for c in (hi >> BITS, hi & _MASK, lo >> BITS, lo & _MASK)]
        sizes = np.bincount(self.table, minlength=CLASSES)
        sizes[OTHER] += START_CODE - len(self.table)
        return 10 ** self.log_p[((codes[0] * CLASSES + codes[1]) * CLASSES + codes[2]) * CLASSES + codes[3]].astype(float) / sizes[codes[3]]

    def probabilities(self, hi: np.ndarray, lo: np.ndarray, models: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each n-gram under its ``models``; and whether it may have rows that are not here."""
        p = np.repeat(self.base(hi, lo)[:, None], models.shape[1], 1)
        left, unsure = np.arange(len(hi)), np.zeros(len(hi), bool)
        for order in range(1, ORDER + 1):
            h = (hi if order == 4 else hi & _MASK if order == 3 else np.zeros_like(hi))[left]
            k = (lo & _MASK if order == 1 else lo)[left]
            own, back = self.own[order], self.back[order]
            context = back.find(h, k >> BITS)
            seen = context < len(back.hi)
            if not back.whole:
                unsure[left[~seen]] = True
            # No longer context has been seen either.
            left, context = left[seen], context[seen]
            at = own.find(h[seen], k[seen])
            if not own.whole:
                unsure[left[at == len(own.hi)]] = True
            p[left] = own.weights[at[:, None], models[left]] + back.weights[context[:, None], models[left]] * p[left]
        return p, unsure

    def cells(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place of each frequent character, number of each pair of these (0: none), cell of each two pairs, units of each cell by model.

        The last cell stands for n-grams that are not found so.
        """
        longest = self.own[ORDER]
        codes = np.concatenate([longest.hi >> BITS, longest.hi & _MASK, longest.lo >> BITS, longest.lo & _MASK])
        often = np.bincount(codes, np.tile(longest.n, 4), START_CODE + 1)
        places = np.full(START_CODE + 1, 255, np.uint8)
        top = [c for c in np.argsort(-often, kind="stable")[:255] if often[c]]
        places[top] = np.arange(len(top))
        both, of = np.unique(np.concatenate([longest.hi, longest.lo]), return_inverse=True)
        number = places[both >> BITS].astype(np.int64) << 8 | places[both & _MASK]
        usual = np.where((number >> 8 < 255) & (number & 255 < 255), np.bincount(of, np.tile(longest.n, 2), len(both)), 0)
        best = np.argsort(-usual, kind="stable")[: PAIRS - 1]
        best = best[usual[best] > 0]
        pairs = np.zeros(1 << 16, np.int32)
        pairs[number[best]] = np.arange(1, len(best) + 1)
        p, unsure = self.probabilities(longest.hi, longest.lo, np.tile(np.arange(MODELS), (len(longest.hi), 1)))
        units = np.vstack([np.rint(np.log10(p) * UNIT).astype(np.int64), np.zeros(MODELS, np.int64)])
        high, low = (pairs[places[x >> BITS].astype(np.int64) << 8 | places[x & _MASK]] for x in (longest.hi, longest.lo))
        fit = (high > 0) & (low > 0) & ~unsure
        cells = np.full(PAIRS * PAIRS, len(p), np.int32)
        cells[high[fit] * PAIRS + low[fit]] = np.flatnonzero(fit)
        return places, pairs, cells, units


def fit(docs: DataFrame, trusted: DataFrame) -> tuple[Model, dict[int, DataFrame], dict[int, DataFrame]]:
    """Model of all texts with a ``trusted_id``, and the whole tables of its characters."""
    texts = texts_of(docs, trusted)

    def count(frames):
        for frame in frames:
            for _, run in _texts(frame, "text"):
                c, n = np.unique(np.frombuffer("".join(run).encode("utf-32-le", "surrogatepass"), "<u4"), return_counts=True)
                yield pd.DataFrame({"c": c.astype(np.int64), "n": n})

    plain = character_classes([])
    letters = texts.select("text").mapInPandas(count, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).where(F.col("c") < 1 << 16) \
        .where(~F.col("c").isin([int(c) for c in np.flatnonzero(plain[:0x250] != OTHER)])).orderBy(F.desc("n"), "c").limit(CLASSES - _GROUPS)
    table = character_classes([r.c for r in letters.collect()])
    log_p = kneser_ney(gram_counts(texts, table))
    own, back = character_tables(character_counts(texts.select("text", part_of("doc_id").alias("part"))))
    model = Model({o: Rows(own[o], 0.0) for o in own}, {o: Rows(back[o], 1.0) for o in back}, table, log_p)
    return model, own, back


def units_of(asked: DataFrame, own: dict[int, DataFrame], back: dict[int, DataFrame]) -> DataFrame:
    """``hi, lo`` and the units ``u0, u1, ..`` by model of the n-grams ``hi, lo, base``, by joins with the whole tables."""
    models = range(MODELS)
    found = asked.select("hi", "lo", *[F.col("base").alias(f"p{m}") for m in models])
    for order in range(1, ORDER + 1):
        hi, lo = _shorter(order)
        found = found.withColumns({"h": hi, "k": lo, "context": F.shiftright(lo, BITS)})
        shares = own[order].select(F.col("hi").alias("h"), F.col("lo").alias("k"), *[F.col(f"w{m}").alias(f"s{m}") for m in models])
        weights = back[order].select(F.col("hi").alias("h"), F.col("lo").alias("context"), *[F.col(f"w{m}").alias(f"b{m}") for m in models])
        found = found.join(shares, ["h", "k"], "left").join(weights, ["h", "context"], "left").select("hi", "lo", *[
            (F.coalesce(f"s{m}", F.lit(0.0)) + F.coalesce(f"b{m}", F.lit(1.0)) * F.col(f"p{m}")).alias(f"p{m}") for m in models])
    return found.select("hi", "lo", *[F.rint(F.log10(f"p{m}") * UNIT).cast("long").alias(f"u{m}") for m in models])


def judge(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all by default) with ``lm_chars``, ``perplexity``, ``max_perplexity`` and ``kept``.

    Texts without characters (null: empty) have no perplexity and are not kept. A language without trusted documents has the
    threshold of all of them; without any trusted document all texts with characters are kept. Repeated rows are judged alike.
    Columns with the names of the results are replaced, other names cannot clash. An empty table gives an empty result.
    """
    kept = [c for c in (columns or docs.columns) if c not in {"lm_chars", "perplexity", "max_perplexity", "kept"}]
    # Under names of their own, so that no column meets one of those made on the way.
    own = [f"own__{i}" for i in range(len(kept))]
    trusted = materialise(trusted_ids(labels), "trusted")
    fitted = materialise(fitting_ids(trusted), "fitted")
    model, own_shares, back_weights = fit(docs.select("doc_id", "text"), fitted)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def measure(frames):
        model = sent.value
        places, pairs, cells, units = model.cells()
        none = len(units) - 1
        row = TaskContext.get().partitionId() << 40
        for frame in frames:
            total, lengths = np.zeros((len(frame), 2), np.int64), np.zeros(len(frame), np.int64)
            rest = [[(), (), (), ()] for _ in range(len(frame))]
            parts = frame["lm_part"].to_numpy(np.int64) + 1
            for first, run in _texts(frame, "lm_text", 1 << 18):
                codes, inside, n = characters(run)
                some = slice(first, first + len(run))
                lengths[some] = n
                place = places[codes].astype(np.int64)
                pair = pairs[place[:-1] << 8 | place[1:]]
                ends = np.flatnonzero(inside)
                cell = cells[pair[ends - 3] * PAIRS + pair[ends - 1]]
                of = np.repeat(np.arange(len(run)), n)
                part = parts[some][of]
                begins = np.append(0, np.cumsum(n))
                for k, values in enumerate((units[cell, 0], units[cell, part])):
                    sums = np.append(0, np.cumsum(values))[begins]
                    total[some, k] = sums[1:] - sums[:-1]
                lost = np.flatnonzero(cell == none)
                at = ends[lost]
                hi, lo = codes[at - 3] << BITS | codes[at - 2], codes[at - 1] << BITS | codes[at]
                p, unsure = model.probabilities(hi, lo, np.stack([np.zeros_like(lost), part[lost]], 1))
                value = np.where(unsure[:, None], 0, np.rint(np.log10(p) * UNIT))
                for k in (0, 1):
                    total[some, k] += np.bincount(of[lost], value[:, k], len(run)).astype(np.int64)
                if unsure.any():
                    open_ = pd.DataFrame({"of": of[lost], "hi": hi, "lo": lo, "base": model.base(hi, lo)})[unsure].groupby(["of", "hi", "lo"], as_index=False).agg(n=("base", "size"), base=("base", "first"))
                    for text, some_rows in open_.groupby("of"):
                        rest[first + text] = [some_rows[c].to_numpy() for c in ("hi", "lo", "n", "base")]
            out = frame.drop(columns="lm_text").assign(lm_row=np.arange(row, row + len(frame)), lm_chars=lengths, lm_sum=total[:, 0], lm_out=total[:, 1])
            row += len(frame)
            yield out.assign(**{c: pd.Series([r[k] for r in rest], index=frame.index, dtype=object) for k, c in enumerate(("lm_hi", "lm_lo", "lm_n", "lm_base"))})

    source = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(kept, own, strict=True)], F.col("doc_id").alias("lm_id"), part_of("doc_id").alias("lm_part"), F.coalesce("lang", F.lit("\x00")).alias("lm_lang"), F.col("text").alias("lm_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "lm_text")
    scored = materialise(source.mapInPandas(measure, f"{kinds}, lm_row long, lm_chars long, lm_sum long, lm_out long, lm_hi array<long>, lm_lo array<long>, lm_n array<long>, lm_base array<double>"),
                         "scored", codec="zstd")
    sent.destroy()
    plain = scored.drop("lm_hi", "lm_lo", "lm_n", "lm_base")
    if not model.whole:
        # What the tasks' tables may lack, n-gram by n-gram from the whole ones.
        rest = scored.select("lm_row", "lm_part", F.explode(F.arrays_zip("lm_hi", "lm_lo", "lm_n", "lm_base")).alias("r")) \
            .select("lm_row", "lm_part", F.col("r.lm_hi").alias("hi"), F.col("r.lm_lo").alias("lo"), F.col("r.lm_n").alias("n"), F.col("r.lm_base").alias("base"))
        known = materialise(units_of(rest.groupBy("hi", "lo").agg(F.min("base").alias("base")), own_shares, back_weights), "units")
        under = F.col("u1")
        for k in range(1, PARTS):
            under = F.when(F.col("lm_part") == k, F.col(f"u{k + 1}")).otherwise(under)
        more = materialise(rest.join(known, ["hi", "lo"]).groupBy("lm_row").agg(F.sum(F.col("n") * F.col("u0")).alias("more"), F.sum(F.col("n") * under).alias("more_out")), "rest")
        open_rows = scored.where(F.size("lm_hi") > 0).drop("lm_hi", "lm_lo", "lm_n", "lm_base").join(more, "lm_row")
        plain = scored.where(F.size("lm_hi") == 0).select(*plain.columns).union(open_rows.withColumns(
            {"lm_sum": F.col("lm_sum") + F.col("more"), "lm_out": F.col("lm_out") + F.col("more_out")}).select(*plain.columns))
    scored = plain.withColumns({"lm_sum": F.col("lm_sum") / UNIT, "lm_out": F.col("lm_out") / UNIT})
    # Bins of the means of all documents labelled good, by language and over all of them, each by the model that was not fitted on it.
    good = scored.where("lm_chars > 0").select("lm_id", "lm_lang", "lm_chars", F.col("lm_out").alias("lm_sum")) \
        .join(trusted.select("trusted_id"), F.col("lm_id") == F.col("trusted_id"))
    known = good.select(F.explode(F.array(F.col("lm_lang"), F.lit(None).cast("string"))).alias("of"), F.floor(F.col("lm_sum") / F.col("lm_chars") * BINS).alias("bin")) \
        .groupBy("of", "bin").agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("of")
    run = known.withColumn("run", F.sum("n").over(by_lang.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("all", F.sum("n").over(by_lang))
    limits = materialise(run.groupBy("of").agg((F.min(F.when(F.col("run") >= LOW * F.col("all"), F.col("bin"))) / BINS).alias("low"),
                                               (F.min(F.when(F.col("run") >= 0.5 * F.col("all"), F.col("bin"))) / BINS).alias("middle"),
                                               (SLACK * F.least(F.lit(1.0), FEW / F.max("all"))).alias("slack")), "limits")
    overall = limits.where("of is null").first()
    low, middle, slack = (overall["low"], overall["middle"], overall["slack"]) if overall else (-1e9, 0.0, 0.0)
    of = limits.where("of is not null")
    mid, slack = F.coalesce("middle", F.lit(middle)), F.coalesce("slack", F.lit(slack))
    spread = F.greatest(mid - F.coalesce("low", F.lit(low)), F.lit(1 / BINS))
    mean = (F.col("lm_sum") + PRIOR_CHARS * mid) / (F.col("lm_chars") + PRIOR_CHARS)
    # Multiples that good documents would need, in at most 100 * STEPS bins.
    needed = good.join(of, F.col("lm_lang") == F.col("of")) \
        .select(F.ceil(F.greatest(F.lit(0.0), F.least(F.lit(100.0), (mid - slack - mean) / spread)) * STEPS).alias("bin")) \
        .groupBy("bin").agg(F.count("*").alias("n")).orderBy("bin").collect()
    run, total, margin = 0, sum(r["n"] for r in needed), MARGIN
    for r in needed:
        run += r["n"]
        if run >= (1 - LOSS) * total:
            margin = r["bin"] / STEPS
            break
    out = scored.join(of, F.col("lm_lang") == F.col("of"), "left")
    floor = mid - slack - margin * spread
    return out.select(*[F.col(o).alias(c) for c, o in zip(kept, own, strict=True)], "lm_chars", F.when(F.col("lm_chars") > 0, F.pow(F.lit(10.0), -mean)).alias("perplexity"),
                      F.pow(F.lit(10.0), F.least(-floor, F.lit(300.0))).alias("max_perplexity"),
                      ((F.col("lm_chars") > 0) & (mean >= floor)).alias("kept"))


def op9_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), ["doc_id", "lang"])
