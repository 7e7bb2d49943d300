"""Near copies by 64-bit similarity fingerprints, found by comparing tiles of fingerprints exactly.

Fingerprints are grouped by their population count. Two of them that differ in at most ``radius`` bits have population counts that
differ by no more, so only tiles of neighbouring counts meet; inside a task the same test on the counts of the four quarters skips most
of the smaller tiles, and what is left is compared by exclusive-or and bit counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.jaccard import components
from tickweave.session import materialise

RADIUS = 3
WORDS = 3
SEED = 42
#: Fingerprints of one population count that a task takes from each side.
TILE = 1 << 18
#: Fingerprints of a tile inside a task, and tile pairs compared at once.
INNER, TOGETHER = 64, 256
#: Texts and hashes whose bits are counted at once.
BATCH_TEXTS, BATCH_HASHES = 512, 1 << 19
#: A fingerprint of more than one in so many rows is looked up by broadcast: no more than this many can be.
HOT_SHARE = 512

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(raw: bytes, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``words`` words, repeats included; a text of fewer words gives its whole sequence as one, none gives none."""
    tokens = raw.translate(_LOWER).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends[:-words]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a : b - 1], seed) for a, b in zip(starts, ends[words - 1 :], strict=True)), np.uint64, len(starts))


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """For each array, the 64-bit number of the bits that over half of its hashes have set; zero for an empty array."""
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    cells = np.concatenate(hashes).view(np.uint8).reshape(-1, 8)
    base = np.repeat(np.arange(len(hashes)) * 256, sizes)
    out = np.zeros(len(hashes), np.uint64)
    for k in range(8):
        seen = np.bincount(base + cells[:, k], minlength=len(hashes) * 256).reshape(-1, 256)
        bits = 2 * (seen @ _BYTE_BITS) > sizes[:, None]
        out |= np.packbits(bits, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * k)
    return out


def text_fingerprints(texts: Iterable[bytes | None], words: int = WORDS) -> np.ndarray:
    """Fingerprint of every text (null: none, so zero)."""
    done: list[np.ndarray] = [np.zeros(0, np.uint64)]
    run: list[np.ndarray] = []
    size = 0
    for raw in texts:
        run.append(shingle_hashes(raw or b"", words))
        size += len(run[-1])
        if size >= BATCH_HASHES or len(run) == BATCH_TEXTS:
            done.append(majority_bits(run))
            run, size = [], 0
    if run:
        done.append(majority_bits(run))
    return np.concatenate(done)


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, print`` (a signed long) for every row."""
    schema = docs.select("doc_id").schema.add("print", "long", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = text_fingerprints((x.as_py() for x in batch.column(1)), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


class Forest:
    """Union-find over positions ``0 .. n-1``, fed with arrays of pairs; what is emitted is a tree per component, never all its pairs."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.parent[a], self.parent[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            self.parent[np.maximum(ra, rb)] = np.minimum(ra, rb)
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up


def _tiles(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints in order of the population counts of their quarters, cut into tiles: order (-1: padding), tiles, least and most counts."""
    quarters = np.bitwise_count(prints.view(np.uint16).reshape(-1, 4)).astype(np.int8)
    order = np.lexsort(quarters.T)
    # Padding repeats the last fingerprint, so that it widens no bounds.
    pad = -len(order) % INNER
    filled = np.pad(order, (0, pad), mode="edge").reshape(-1, INNER)
    order = np.pad(order, (0, pad), constant_values=-1).reshape(-1, INNER)
    counts = quarters[filled]
    return order, prints[filled], counts.min(axis=1), counts.max(axis=1)


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of the two sides that differ in at most ``radius`` bits, in parts."""
    order_a, tiles_a, low_a, high_a = _tiles(left)
    order_b, tiles_b, low_b, high_b = _tiles(right)
    for i in range(len(tiles_a)):
        apart = np.maximum(low_a[i] - high_b, low_b - high_a[i])
        met = np.flatnonzero(np.maximum(apart, 0).sum(axis=1) <= radius)
        for start in range(0, len(met), TOGETHER):
            part = met[start : start + TOGETHER]
            near = np.bitwise_count(tiles_a[i][None, :, None] ^ tiles_b[part][:, None, :]) <= radius
            t, x, y = np.nonzero(near)
            a, b = order_a[i][x], order_b[part[t], y]
            real = (a >= 0) & (b >= 0)
            if real.any():
                yield a[real], b[real]


def linked(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest with the components that the links between two sides (or inside one, without a right one) make."""
    if not len(left) or right is not None and not len(right):
        return left[:0], left[:0]
    nodes = left if right is None else np.concatenate([left, right])
    forest = Forest(len(nodes))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def settle() -> None:
        if waiting:
            forest.join(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            waiting.clear()

    for a, b in near_pairs(left, left if right is None else right, radius):
        if right is None:
            once = a < b
            a, b = a[once], b[once]
        else:
            b = b + len(left)
        waiting.append((a, b))
        held += len(a)
        if held > 1 << 20:
            settle()
            held = 0
    settle()
    moved = np.flatnonzero(forest.parent != np.arange(len(nodes)))
    return nodes[moved], nodes[forest.parent[moved]]


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``a, b``: links between different fingerprints (column ``print``, each once) that connect all of each component of near ones.

    A tile pair is one group of at most twice ``tile`` rows. The table of classes has a row for each of 65 population counts.
    """
    classed = nodes.select("print", F.bit_count("print").alias("ones"))
    sizes = F.broadcast(classed.groupBy("ones").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles")))
    placed = classed.join(sizes, "ones").withColumn("place", F.pmod(F.xxhash64("print"), "tiles").cast("int"))
    other = sizes.select(F.col("ones").alias("with"), F.col("tiles").alias("with_tiles"))
    met = placed.withColumn("with", F.explode(F.sequence(F.col("ones") - radius, F.col("ones") + radius))).join(other, "with") \
        .withColumn("with_place", F.explode(F.sequence(F.lit(0), F.col("with_tiles") - 1)))
    first = (F.col("ones") < F.col("with")) | (F.col("ones") == F.col("with")) & (F.col("place") <= F.col("with_place"))
    own, away = F.array("ones", "place"), F.array("with", "with_place")
    sided = met.select(F.when(first, own).otherwise(away).alias("low"), F.when(first, away).otherwise(own).alias("high"), first.alias("left"), "print")
    groups = sided.select(*(F.col(side)[k].alias(f"{side}_{name}") for side in ("low", "high") for k, name in enumerate(("ones", "place"))), "left", "print")

    def run(table: pa.Table) -> pa.Table:
        keys = [table.column(c)[0].as_py() for c in ("low_ones", "low_place", "high_ones", "high_place")]
        prints, left = table.column("print").to_numpy().view(np.uint64), table.column("left").to_numpy()
        a, b = linked(prints, None, radius) if keys[:2] == keys[2:] else linked(prints[left], prints[~left], radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return groups.groupBy("low_ones", "low_place", "high_ones", "high_place").applyInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``, which needs ``doc_id`` and ``text``; other columns are not read.

    Null, empty and blank texts have the fingerprint zero, which links like any other. Rows that repeat an id or a text stay rows of
    their own. A row with a null id links like others and has its component's smallest id, null if no row of the component has one.
    A very long text is hashed alone; an empty table gives an empty result.
    """
    prints = materialise(fingerprints(docs, words), "prints")
    nodes = materialise(prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "nodes")
    roots = components(materialise(links(nodes, radius, tile), "links"))
    named = nodes.join(roots.withColumnRenamed("row", "print"), "print", "left") \
        .select("print", "first", "copies", F.coalesce("root", "print").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    owner = materialise(named.join(smallest, "root").select("print", "copies", "component_id"), "owner")
    # Copies can be a third of all rows: such fingerprints, fewer than HOT_SHARE, go to the rows instead of the rows to them.
    rows = prints.agg(F.count("*").alias("n")).first().n
    hot = F.broadcast(owner.where(F.col("copies") * HOT_SHARE > rows).select("print", "component_id"))
    whole = prints.join(hot, "print").unionByName(prints.join(hot, "print", "left_anti").join(owner.select("print", "component_id"), "print"))
    return whole.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf}/documents.parquet"))
