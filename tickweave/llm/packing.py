"""Conflict-constrained best-fit packing of documents into sequences of a fixed number of tokens.

Open bins lie in order of their residual room. A document goes to the tightest bin that has room and does not
conflict: a bin's bitmaps say which duplicate clusters and which sources it holds, and the search for the next
larger residual goes on until a compatible bin is found, else a new bin opens. A document longer than a bin fills
whole bins of its own first; its rest is packed like a document.

Bins are filled within blocks: rows of a seeded hash, a bounded number each, so that blocks pack side by side and a hot
source is dealt evenly over all of them.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import jaccard
from tickweave.session import materialise

#: Tokens in a bin, and rows a block packs on average.
CAPACITY, BLOCK_ROWS = 2048, 2048
#: Documents of one source that a bin may hold.
PER_SOURCE = 8
OUT = "bin string, bin_start int, piece int, n_pieces int, piece_tokens int"


def best_fit(lengths: np.ndarray, clusters: np.ndarray, sources: np.ndarray, capacity: int, per_source: int
             ) -> list[list[tuple[int, int, int]]]:
    """``(bin, start, tokens)`` of the pieces of every row, longest rests first; clusters and sources are small integers.

    Source bitmaps come in layers: a source's bit in layer ``n`` says that the bin holds more than ``n`` of it.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    bins = 0
    rests = lengths.copy()
    for i in np.flatnonzero(lengths > capacity):
        while rests[i] > capacity:
            out[i].append((bins, 0, capacity))
            rests[i] -= capacity
            bins += 1
    room: list[tuple[int, int]] = []  # (residual, bin) in order
    held: dict[int, list[int]] = {}  # bin: cluster bitmap, then the layers of source bitmaps
    for i in sorted(range(len(lengths)), key=lambda i: (-rests[i], i)):
        need, cluster, source = int(rests[i]), 1 << int(clusters[i]), 1 << int(sources[i])
        at = bisect_left(room, (need, -1))
        # Successors in order of residual, until one holds neither a copy nor too many of the source.
        while at < len(room) and (held[room[at][1]][0] & cluster or held[room[at][1]][-1] & source):
            at += 1
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, bins
            held[b] = [0] * (per_source + 1)
            bins += 1
        out[i].append((b, capacity - left, need))
        maps = held[b]
        maps[0] |= cluster
        for layer in range(1, per_source + 1):
            if not maps[layer] & source:
                maps[layer] |= source
                break
        if left > need:
            insort(room, (left - need, b))
    return out


def pack(docs: DataFrame, tokens: Column, cluster: Column, source: Column, capacity: int = CAPACITY,
         per_source: int = PER_SOURCE, block_rows: int = BLOCK_ROWS, seed: int = 3, key: str = "doc_id") -> DataFrame:
    """``key`` and a row for each piece of a document: ``bin`` (block and number), ``bin_start``, ``piece`` (from 0), ``n_pieces``,
    ``piece_tokens``.

    Every row is placed, with all its tokens; a null or negative count is 0, and an empty document takes a place without
    room. Null clusters conflict with nothing; null sources are one source. Rows that repeat a cluster go to different bins. An empty
    table gives an empty result. Which bin a row gets depends on its place in the input.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.greatest(F.coalesce(tokens, F.lit(0)), F.lit(0)).cast("long").alias("tokens"),
                       cluster.cast("string").alias("cluster"), F.coalesce(source.cast("string"), F.lit("\x00")).alias("source"))
    # A stored place spreads repeated rows over the blocks, and a task that runs again deals them as before.
    rows = materialise(rows.withColumn("place", F.monotonically_increasing_id()), "packing")
    blocks = max(1, -(-rows.count() // block_rows))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "place"), F.lit(blocks)))
    key_type = docs.schema[key].dataType.simpleString()

    def fill(group, frame):
        frame = frame.sort_values(["key", "tokens", "cluster", "source"], na_position="first", kind="stable", ignore_index=True)
        clusters = pd.factorize(frame["cluster"])[0]
        lone = clusters < 0
        clusters[lone] = clusters.max(initial=0) + 1 + np.arange(lone.sum())
        placed = best_fit(frame["tokens"].to_numpy(), clusters, pd.factorize(frame["source"])[0], capacity, per_source)
        return pd.DataFrame([(frame["key"].iloc[i], f"{group[0]}-{b}", start, p, len(pieces), n)
                             for i, pieces in enumerate(placed) for p, (b, start, n) in enumerate(pieces)],
                            columns=[key, *[c.split()[0] for c in OUT.split(", ")]])

    return rows.groupBy("block").applyInPandas(fill, f"`{key}` {key_type}, {OUT}")


def n_tokens(text: Column) -> Column:
    """Words of a text and its end."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    # Only the first and the last part can be empty; a text without words may have one part, which is both.
    return F.size(parts) + 1 - (F.get(parts, F.lit(0)) == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")


def copy_cluster(text: Column) -> Column:
    """Texts that are equal but for case and white space share it; texts without words have none."""
    plain = F.trim(F.regexp_replace(F.lower(text), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(plain != "", F.md5(plain))


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(docs, n_tokens(F.col("text")), copy_cluster(F.col("text")), F.col("source"))


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    key = F.xxhash64(F.col("text").isNull(), "text").alias("near_key")
    # The near-duplicate join goes by texts, whatever their ids; texts without words have no component, and are no copies either.
    near = jaccard.near_duplicates(docs.where(F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(key.alias("doc_id"), "text")) \
        .select(F.col("doc_id").alias("near_key"), F.col("component_id").cast("string").alias("component")).distinct()
    rows = docs.select("doc_id", n_tokens(F.col("text")).alias("n"), "source", key).join(near, "near_key", "left")
    return pack(rows, F.col("n"), F.col("component"), F.col("source"))
