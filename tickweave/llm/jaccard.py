"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix with itself.

A text's row holds its distinct word shingles. Two rows can only reach the similarity if they share one of their first
``n - ceil(t n) + 1`` shingles in any order common to all rows, so only these columns are multiplied: the ones
that occur in at least two different rows name the cells of the product that can be large enough. Cells go whose row sizes are
too far apart, and those whose rows surely differ in more shingles than the sizes allow: each row has a bit for every few shingles,
the parity of how many fall there, and as many bits as two rows differ in, so many shingles at least do they. For the cells left,
overlap counts are accumulated over blocks of columns and held against the bound from the two sizes.

Groups of near copies do not fill a square of the product. Each column first meets only two of its rows, those with the
smallest and the largest number; linked rows become one component. Then each row meets, of the rows of *other* components that share
a column of many rows with it, the one that its parities say is nearest, which joins most of a large group of near copies that its columns' two rows
did not. Last, all cells between components that are still different and share such a column are worked out too, so that no component is
missed, and cells inside a component, which could join nothing, are not.
These meet block by block in numpy, so that only cells leave a task whose bounds hold: a column at place ``i`` of a row leaves it ``n - i``
shingles that can still be shared, and that is the most if no column before was; and parities, as above. A column of many rows is cut into
tiles of bounded size, and each pair of tiles is a block of its own.
Equal rows are one row throughout. The common order puts frequent shingles last; it decides the cost, never the
result.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.words import buffers, hash_words, mix, shingle_hashes
from tickweave.session import materialise, shared_root

#: Words of a shingle; least similarity in percent.
WORDS, PERCENT = 5, 75
#: Texts of the sample for frequent shingles; most shingles that it, and the count over all texts after it, each put last in the common
#: order; and the number of texts from which all count alike when they are chosen.
SAMPLE_TEXTS, MOST_FREQUENT, LEVELS = 16_000, 400_000, 1024
#: Passes over the first columns, each with a share of them, so that one share's shuffle is on disk at a time.
COLUMN_PASSES = 2
#: Blocks of columns in which overlaps are counted, and bits of a column's number that name it in the candidate search.
COLUMN_BLOCKS, COLUMN_BITS = 4, 44
#: Rows of a tile of a column on average, most places of the parities that rows meet with, and pairs looked at together.
TILE, SHORT_PARITIES, PAIRS = 512, 1024, 1 << 17
#: Rows of a column up to which all its pairs are few: its rows do not meet their nearest ones first. And rows that Python takes at a time.
FEW, BATCH_ROWS = 8, 2000
#: Most bits of the filter that keeps unwanted texts out of a pass. Beyond it more texts pass, and the joins drop them.
FILTER_BITS = 1 << 27


def _distinct(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Row number and hash of the distinct shingles of each text, by row and then hash."""
    hashes, counts = shingle_hashes(*hash_words(texts), words)
    row = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    first = np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))[: len(row)]
    return row[first], hashes[first]


def _row_hash(row: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each text's whole matrix row, and its size."""
    sizes = np.bincount(row, minlength=texts)
    ends = np.cumsum(sizes)
    sums = np.append(np.uint64(0), np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)), dtype=np.uint64))
    return mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)).view(np.int64), sizes


def _prefix_lengths(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Number of first columns of which two rows that reach the similarity share one."""
    return np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1, 0)


def _in_order(row: np.ndarray, hashes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Positions of the shingles by row and common order: how frequent they are, then hash."""
    grams, level = frequent
    order = np.zeros(len(hashes), np.int64)
    if len(grams):
        at = np.minimum(np.searchsorted(grams, hashes), len(grams) - 1)
        order = np.where(grams[at] == hashes, level[at], 0)
    return np.lexsort((hashes, order, row))


def _sorted_counts(found: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    grams = found["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], found["count"].to_numpy(np.int64)[order]


def sampled_shingles(docs: DataFrame, words: int = WORDS, texts: int = SAMPLE_TEXTS, most: int = MOST_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in at least three texts of a bounded sample, sorted, with their number of texts as it would be in all rows."""
    rows = docs.count()
    share = min(1 << 20, int((1 << 20) * texts / max(rows, 1)) + 1)
    sample = docs.where(F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 20)) < share).select("text").limit(2 * texts)

    def count(frames):
        for frame in frames:
            for _, run in buffers(frame["text"]):
                yield pd.DataFrame({"gram": _distinct(run, words)[1].view(np.int64)})

    found = sample.mapInPandas(count, "gram long").groupBy("gram").count().where("count >= 3").orderBy(F.desc("count"), "gram").limit(most).toPandas()
    grams, counts = _sorted_counts(found)
    return grams, counts * (1 << 20) // share


def frequent_shingles(docs: DataFrame, folder: str, words: int = WORDS, percent: int = PERCENT, most: int = MOST_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, with their number of texts. Only the order of columns uses them.

    A sample finds those that are frequent anywhere. Of the others, those that then come first in some text are counted over
    all texts; equally frequent ones are in or out together, down to three texts and ``most`` shingles.
    """
    sampled = sampled_shingles(docs, words, most=most)

    def first(frames):
        for frame in frames:
            for _, run in buffers(frame["text"]):
                row, hashes = _distinct(run, words)
                sizes = np.bincount(row, minlength=len(run))
                place = np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
                grams = hashes[_in_order(row, hashes, sampled)][place < _prefix_lengths(sizes, percent)[row]]
                yield pd.DataFrame({"gram": grams[~np.isin(grams, sampled[0])].view(np.int64)})

    counts = materialise(docs.select("text").mapInPandas(first, "gram long").groupBy("gram").count().where("count >= 3"), "counts", folder)
    level = F.least("count", F.lit(LEVELS))
    least, total = LEVELS, 0
    for at, grams in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("grams")).collect(), reverse=True):
        total += grams
        if total > most:
            break
        least = at
    counted = _sorted_counts(counts.where(F.col("count") >= least).limit(most).toPandas())
    grams, level = (np.concatenate(both) for both in zip(sampled, counted, strict=True))
    order = np.argsort(grams)
    return grams[order], level[order]


def _parities(row: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each text, in bits, whether the number of its shingles that fall on a place is odd: a power of two of places, one for each shingle or more."""
    places = np.where(sizes > 0, np.int64(1) << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64), 0)
    ends = np.cumsum(places)
    at = (ends - places)[row] + (hashes & (places[row] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=int(places.sum())) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [packed[(e - p) // 8 : e // 8] for e, p in zip(ends.tolist(), places.tolist(), strict=True)]


def _unlike(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Bits in which each pair of parities differs, the longer one folded to the length of the shorter: no more than shingles that only one row has."""
    sizes = np.array([[len(x), len(y)] for x, y in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    out = np.zeros(len(sizes), np.int64)
    for a, b in np.unique(sizes, axis=0).tolist():
        these, least = np.flatnonzero((sizes[:, 0] == a) & (sizes[:, 1] == b)), min(a, b)
        folded = [np.bitwise_xor.reduce(np.frombuffer(b"".join([side[i] for i in these]), np.uint64).reshape(len(these), -1, least // 8), axis=1)
                  for side in (left, right)]
        out[these] = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
    return out


def profiles(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n`` (size of the row), ``row`` (a hash of the whole row, equal for equal ones), ``prefix`` (its first columns), ``parities`` and
    ``short`` (parities of at most :data:`SHORT_PARITIES` places)."""

    def run(frames):
        for frame in frames:
            for start, texts in buffers(frame["text"]):
                row, hashes = _distinct(texts, words)
                whole, sizes = _row_hash(row, hashes, len(texts))
                ends = np.cumsum(sizes)
                placed = _in_order(row, hashes, frequent)
                columns = (hashes[placed] >> np.uint64(64 - COLUMN_BITS)).view(np.int64)
                length = _prefix_lengths(sizes, percent)
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[start : start + len(texts)], "n": sizes, "row": whole,
                                    "prefix": [columns[e - s : e - s + k] for e, s, k in zip(ends, sizes, length, strict=True)],
                                    "parities": _parities(row, hashes, sizes),
                                    "short": _parities(row, hashes, np.minimum(sizes, SHORT_PARITIES))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, n long, row long, prefix array<long>, parities binary, short binary")


def id_filter(wanted: DataFrame) -> np.ndarray:
    """Bits set at two places for each ``doc_id`` of ``wanted``: 16 bits a row, :data:`FILTER_BITS` at most."""
    bits = 1 << 20
    while bits < min(FILTER_BITS, 16 * wanted.count()):
        bits *= 2

    def place(frames):
        for frame in frames:
            key = mix(frame["doc_id"].to_numpy(np.int64).view(np.uint64))
            at = np.concatenate([key % np.uint64(bits), (key >> np.uint64(32)) % np.uint64(bits)]).astype(np.int64)
            yield pd.DataFrame({"word": at // 32, "bit": np.int64(1) << (at % 32)})

    words = wanted.select("doc_id").mapInPandas(place, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()
    out = np.zeros(bits // 32, np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bit"].to_numpy(np.int64).astype(np.uint32)
    return out


def incidence(docs: DataFrame, wanted: DataFrame, folder: str, words: int = WORDS, blocks: int = COLUMN_BLOCKS) -> DataFrame:
    """``row, block, grams``: the matrix rows of the documents named by ``wanted`` (``doc_id``), cut into blocks of columns, in one pass over
    the texts without a shuffle, stored in ``folder``. Some others may come along, and a row may come from several tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(id_filter(wanted))

    def run(frames):
        seen: set[int] = set()
        bits = sent.value
        size = np.uint64(32 * len(bits))
        for frame in frames:
            key = mix(frame["doc_id"].to_numpy(np.int64).view(np.uint64))
            asked = np.ones(len(frame), bool)
            for at in (key % size, (key >> np.uint64(32)) % size):
                asked &= (bits[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & 1 > 0
            for _, texts in buffers(frame["text"][asked]):
                row, hashes = _distinct(texts, words)
                names = _row_hash(row, hashes, len(texts))[0]
                passed = np.ones(len(texts), bool)
                for i in range(len(texts)):
                    passed[i] = int(names[i]) not in seen
                    seen.add(int(names[i]))
                stay = passed[row]
                row, hashes = row[stay], hashes[stay]
                cell = row * blocks + (hashes % np.uint64(blocks)).astype(np.int64)
                order = np.argsort(cell, kind="stable")
                cells, first = np.unique(cell[order], return_index=True)
                if len(cells):
                    yield pd.DataFrame({"row": names[cells // blocks], "block": cells % blocks, "grams": np.split(hashes[order].view(np.int64), first[1:])})

    found = materialise(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                        .mapInPandas(run, "row long, block int, grams array<long>"), "matrix", folder)
    sent.destroy()
    return found


def possible(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b``, their sizes and their ``first`` ids, of the pairs whose sizes and parities leave the similarity within reach: the others surely miss it."""
    kept = ["a", "b", "n_a", "n_b", "first_a", "first_b"]

    def run(frames):
        for frame in frames:
            total = (frame["n_a"] + frame["n_b"]).to_numpy(np.int64)
            # Least overlap that reaches the similarity, and so the most shingles that only one of the two may have.
            most = total - 2 * -(-percent * total // (100 + percent))
            yield frame[_unlike(frame["parities_a"].tolist(), frame["parities_b"].tolist()) <= most][kept]

    left, right = (nodes.select(F.col("row").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "first", "parities"))) for x in "ab")
    return pairs.join(left, "a").join(right, "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) \
        .select(*kept, "parities_a", "parities_b").mapInPandas(run, ", ".join(f"{c} long" for c in kept))


def _folded(parities: list[bytes]) -> dict[int, np.ndarray]:
    """By number of 64-bit words: the parities of all rows folded to so many, rows with fewer left at zero."""
    sizes = np.fromiter(map(len, parities), np.int64, len(parities)) // 8
    out = {int(words): np.zeros((len(parities), int(words)), np.uint64) for words in np.unique(sizes[sizes > 0])}
    for size, own in out.items():
        at = np.flatnonzero(sizes == size)
        own[at] = np.frombuffer(b"".join([parities[i] for i in at]), np.uint64).reshape(-1, size)
        for words in out:
            if words < size:
                out[words][at] = np.bitwise_xor.reduce(own[at].reshape(len(at), -1, words), axis=1)
    return out


def _met(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """``a, b, unlike`` (bits of parities) of a run of whole blocks: pairs of rows of different components in one block whose bounds leave the
    similarity within reach."""
    column, i, j, own, row, root, n, place = (frame[c].to_numpy(np.int64) for c in ("column", "i", "j", "own", "row", "root", "n", "place"))
    turns = np.flatnonzero((column[1:] != column[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    ends = np.append(turns, len(frame))
    after = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(frame)) - 1
    until = np.cumsum(after)
    parities, words = _folded(frame["short"].tolist()), frame["short"].map(len).to_numpy(np.int64) // 8
    found = []
    for first in np.flatnonzero(np.diff(until // PAIRS, prepend=-1)):
        last = np.searchsorted(until // PAIRS, until[first] // PAIRS, side="right")
        few = after[first:last]
        a = np.repeat(np.arange(first, last), few)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(few) - few, few)
        # Two tiles meet across; a tile alone meets itself.
        stay = (root[a] != root[b]) & ((own[a] != own[b]) | (i[a] == j[a]))
        a, b = a[stay], b[stay]
        total = n[a] + n[b]
        need = -(-percent * total // (100 + percent))
        stay = np.minimum(n[a] - place[a], n[b] - place[b]) >= need
        a, b, most = a[stay], b[stay], (total - 2 * need)[stay]
        least = np.minimum(words[a], words[b])
        for size, bits in parities.items():
            x, y, bound = (v[least == size] for v in (a, b, most))
            unlike = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
            near = unlike <= bound
            found.append(np.column_stack([row[x[near]], row[y[near]], unlike[near]]))
    pairs = np.concatenate([np.empty((0, 3), np.int64), *found])
    return pd.DataFrame({"a": pairs[:, :2].min(axis=1), "b": pairs[:, :2].max(axis=1), "unlike": pairs[:, 2]}).drop_duplicates(["a", "b"])


def _nearest(pairs: pd.DataFrame) -> pd.DataFrame:
    """Of pairs ``a, b, unlike``, for each row the one whose parities differ least (ties: the smallest partner)."""
    ends = pd.concat([pairs, pairs.rename(columns={"a": "b", "b": "a"})], ignore_index=True)
    return ends.sort_values(["a", "unlike", "b"]).drop_duplicates("a")


def meetings(members: DataFrame, percent: int = PERCENT, tile: int = TILE, nearest: bool = False) -> DataFrame:
    """Distinct ``a < b`` of ``members`` (``column, row, root, n, place, short`` and ``rows``, how many the column has): rows of different roots that
    share a column and, by place and parities, may reach the similarity. A task holds a batch and one block of two tiles. With ``nearest`` each
    row brings only the pair whose parities differ least, so that there are no more pairs than rows."""
    tiles = F.greatest(F.lit(1), F.ceil(F.col("rows") / tile)).cast("int")
    seated = members.withColumn("tiles", tiles).withColumn("own", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int")) \
        .select("column", "own", "row", "root", "n", "place", "short", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")) \
        .select("column", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "row", "root", "n", "place", "short") \
        .repartition("column", "i", "j").sortWithinPartitions("column", "i", "j")

    kept = ["a", "b", "unlike"] if nearest else ["a", "b"]

    def meet(frames):
        held = None
        for frame in frames:
            if not len(frame):
                continue
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            # The last block may go on in the next batch.
            key = held[["column", "i", "j"]].to_numpy(np.int64)
            whole = len(held) - int(np.argmax(np.append((key != key[-1]).any(axis=1)[::-1], True)))
            if whole:
                yield told(held.iloc[:whole])
                held = held.iloc[whole:].reset_index(drop=True)
        if held is not None and len(held):
            yield told(held)

    def told(blocks):
        pairs = _met(blocks, percent)
        return (_nearest(pairs) if nearest else pairs)[kept]

    met = seated.mapInPandas(meet, ", ".join(f"{c} long" for c in kept))
    if nearest:
        best = met.groupBy("a").agg(F.min(F.struct("unlike", "b")).alias("m"))
        met = best.select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b"))
    return met.distinct()


def unsettled(members: DataFrame, roots: DataFrame, name: str, folder: str) -> DataFrame:
    """``column, row, n, place, root, rows`` of the columns that hold different components, ``rows`` in all; stored in ``folder``."""
    labelled = materialise(members.join(roots, "row", "left").select("column", "row", "n", "place", F.coalesce("root", "row").alias("root")), "labelled", folder)
    mixed = labelled.groupBy("column").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("rows")).where("x <> y").select("column", "rows")
    found = materialise(labelled.join(mixed, "column"), name, folder)
    _discard(members.sparkSession, folder, "labelled")
    return found


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """Components of ``roots`` after more links."""
    return components(roots.where("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b")).union(more))


def _hubs(pairs: DataFrame) -> DataFrame:
    """Of the pairs, for each row the one with the partner that has most pairs (ties: the smallest)."""
    own, other = (("a", "n_a", "first_a"), ("b", "n_b", "first_b")), (("b", "n_b", "first_b"), ("a", "n_a", "first_a"))
    ends = pairs.select(F.explode(F.array(*(
        F.struct(*(F.col(c).alias(f"{side}_{name}") for side, columns in (("own", x), ("other", y)) for name, c in zip(("row", "n", "first"), columns, strict=True)))
        for x, y in (own, other)))).alias("e")).select("e.*")
    degree = ends.groupBy("own_row").agg(F.count("*").alias("degree")).select(F.col("own_row").alias("other_row"), "degree")
    # The pair travels with its degree, so that it need not be looked up again.
    best = ends.join(degree, "other_row").groupBy("own_row").agg(
        F.max(F.struct("degree", (-F.col("other_row")).alias("minus"), "own_n", "own_first", "other_n", "other_first")).alias("m")) \
        .select("own_row", (-F.col("m.minus")).alias("other_row"), "m.*")
    up = F.col("own_row") < F.col("other_row")
    return best.select(F.least("own_row", "other_row").alias("a"), F.greatest("own_row", "other_row").alias("b"),
                       *(F.when(up == (x == "a"), F.col(f"own_{c}")).otherwise(F.col(f"other_{c}")).alias(f"{c}_{x}") for c in ("n", "first") for x in "ab")).distinct()


def links(docs: DataFrame, pairs: DataFrame, folder: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Pairs ``a, b`` of ``pairs`` (columns of :func:`possible`) that reach the similarity: overlaps are summed over the blocks of columns.

    The matrix rows they need stay in ``folder``, as the table ``matrix``, for as long as the result is wanted.
    """
    ends = pairs.select(F.explode(F.array("first_a", "first_b")).alias("doc_id")).distinct()
    matrix = incidence(docs, ends, folder, words)
    product = pairs.join(matrix.select(F.col("row").alias("a"), "block", F.col("grams").alias("left")), "a") \
        .join(matrix.select(F.col("row").alias("b"), "block", F.col("grams").alias("right")), ["b", "block"]) \
        .select("a", "b", "block", "n_a", "n_b", F.size(F.array_intersect("left", "right")).alias("overlap"))
    # A row that came from several tasks brings a block's overlap several times: the largest counts, once.
    parts = [F.coalesce(F.max(F.when(F.col("block") == k, F.col("overlap"))), F.lit(0)) for k in range(COLUMN_BLOCKS)]
    both = product.groupBy("a", "b").agg(sum(parts[1:], parts[0]).alias("overlap"), (F.max("n_a") + F.max("n_b")).alias("n"))
    return both.where(100 * F.col("overlap") >= percent * (F.col("n") - F.col("overlap"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``row, root`` of every row with a link: root is the smallest row of its component. Alternating stars, stored after each round."""
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Larger neighbours move to the smallest one: no more edges than before, so that repeated ones can wait.
        large = materialise(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # Smaller neighbours, and the row itself, move to the smallest of them.
        edges = materialise(large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                            .where("u <> v").distinct(), "edges")
        # Done when no row has two smaller neighbours, or a smaller and a larger one.
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("row"), F.lit(1).alias("up")), F.struct(F.col("v").alias("row"), F.lit(0).alias("up")))).alias("e"))
        if ends.groupBy("e.row").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least")).where("up > 1 or up = 1 and least = 0").isEmpty():
            break
    return edges.select(F.col("u").alias("row"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("row"), F.col("v").alias("root")).distinct())


def _discard(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete stored tables that no later step reads."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: the smallest id that links lead to.

    Null and empty texts have no shingles and link with nothing, not even each other; a text of fewer words than a shingle is one
    shingle. Rows with a null id come back with a null component and link nothing. Rows that repeat an id stay rows of their own;
    an empty table gives an empty result.
    """
    conf = docs.sparkSession.conf
    # Each step reads stored tables alone, so the shuffle files that made them can go at once. Whole texts come in small batches, for memory.
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}
    before = {key: conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        conf.set(key, value)
    try:
        return _near_duplicates(docs, words, percent)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def _near_duplicates(docs: DataFrame, words: int, percent: int) -> DataFrame:
    spark, narrow = docs.sparkSession, docs.select("doc_id", "text")
    folder = f"{shared_root(spark)}/near-duplicates-{uuid.uuid4().hex}"
    rows = materialise(profiles(narrow, frequent_shingles(narrow, folder, words, percent), words, percent), "profiles", folder)
    _discard(spark, folder, "counts")
    nodes = rows.where("n > 0 and doc_id is not null").groupBy("row").agg(
        F.min("doc_id").alias("first"), F.max("n").alias("n"), F.max("parities").alias("parities"), F.max("short").alias("short"))
    nodes = materialise(nodes, "nodes", folder)
    cells = rows.where("n > 0 and doc_id is not null").select("row", "n", F.posexplode("prefix").alias("place", "column"))
    # Columns of at least two different rows, with the two that the others meet first.
    shares = [cells.where(F.pmod("column", F.lit(COLUMN_PASSES)) == k) for k in range(COLUMN_PASSES)]
    centres = [materialise(share.groupBy("column").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low <> high"), f"centres{k}", folder)
               for k, share in enumerate(shares)]
    centres = reduce(DataFrame.union, centres)
    members = materialise(cells.join(centres, "column").select("column", "row", "n", "place", "low", "high").distinct(), "members", folder)
    # The first columns are most of what is stored; what comes later goes by these rows alone.
    rows = materialise(rows.select("doc_id", "n", "row"), "rows", folder)
    _discard(spark, folder, "profiles", *(f"centres{k}" for k in range(COLUMN_PASSES)))
    stars = members.select("row", F.explode(F.array("low", "high")).alias("centre")).where("row <> centre") \
        .select(F.least("row", "centre").alias("a"), F.greatest("row", "centre").alias("b")).distinct()
    stars = materialise(_hubs(materialise(possible(stars, nodes, percent), "possible", folder)), "stars", folder)
    linked = materialise(links(narrow, stars, folder, words, percent), "links", folder)
    _discard(spark, folder, "matrix")
    roots = components(linked)
    # Columns that still hold different components: their rows meet, those of one component never. In columns of many, first each row and its nearest.
    open_rows = unsettled(members, roots, "open", folder)
    _discard(spark, folder, "members")
    short = nodes.select("row", "short")
    near = meetings(open_rows.where(F.col("rows") > FEW).join(short, "row"), percent, nearest=True).join(stars.select("a", "b"), ["a", "b"], "left_anti")
    near = materialise(possible(near, nodes, percent), "near", folder)
    if not near.isEmpty():
        more = materialise(links(narrow, near, folder, words, percent), "nearest", folder)
        _discard(spark, folder, "matrix")
        if not more.isEmpty():
            roots = _joined(roots, more)
            open_rows = unsettled(open_rows.drop("root", "rows"), roots, "still", folder)
            _discard(spark, folder, "open")
    # A row whose nearest was tried before, or surely misses, may still have others.
    tried = stars.select("a", "b").union(near.select("a", "b"))
    rest = meetings(open_rows.join(short, "row"), percent).join(tried, ["a", "b"], "left_anti")
    rest = materialise(possible(rest, nodes, percent), "rest", folder)
    if not rest.isEmpty():
        more = materialise(links(narrow, rest, folder, words, percent), "more", folder)
        _discard(spark, folder, "matrix")
        if not more.isEmpty():
            roots = _joined(roots, more)
    named = nodes.join(roots, "row", "left").select("row", "first", F.coalesce("root", "row").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    owner = materialise(named.join(smallest, "root").select("row", "component_id"), "owner", folder)
    return rows.join(owner, "row", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))).alias("component_id"))


#: The same rows from all pairs of documents that share a shingle.
SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS gram
    FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
    FROM shingles x JOIN shingles y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * both_have >= 75 * (x.n + y.n - both_have)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS component_id FROM texts
    UNION
    SELECT ways.b, reach.component_id FROM reach JOIN ways ON ways.a = reach.doc_id),
smallest AS (SELECT doc_id, min(component_id) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CAST(component_id AS BIGINT) AS component_id
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest USING (doc_id)
"""


def op2_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
