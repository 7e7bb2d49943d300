"""Token counts of documents from flat, unindexed token files, by a separator scan.

A file is a run of little-endian unsigned 16-bit ids in which an end-of-document id closes each document;
no index says where documents start. Each block of a file is searched for the id in one vectorised pass, and
a prefix scan over the blocks of a file hands the last separator of earlier blocks to the first document that
ends in a later one.

The files are written by Spark's text writer from the scan's own partitions, so they can lie in any store
Spark writes: a document is one line whose bytes are its ids and whose line end is the separator.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.llm.bpe import Encoder, Vocabulary, _batches, vocabulary_path
from tickweave.session import shared_root

#: Ids that one vectorised search covers.
BLOCK = 1 << 20
#: A document's key is five ids of 15 bits ahead of its tokens, lowest first; they never equal a separator of 2**15 or more.
#: Of their 75 bits a key takes 64; the highest marks a document without one.
KEY_IDS, NO_KEY = 5, 1 << 14


def write_token_files(docs: DataFrame, folder: str, path: str, end: str = "<|endoftext|>", key: str = "doc_id",
                      text: str = "text") -> int:
    """Encode every text (null: empty) and write the flat files; returns the separator id.

    Special strings inside a text would end documents early, so they are encoded as ordinary text. Keys must be integers or null.
    """
    vocabulary = Vocabulary(path)
    separator = vocabulary.special[end]
    if not 1 << 15 <= separator < 1 << 16:
        raise ValueError("the separator must be an id from 32768 to 65535")
    vocabulary.special = {}
    tables = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the vocabulary

    def run(frames):
        encoder = Encoder(tables.value)
        for frame in frames:
            for part, texts in _batches(frame, "text"):
                keys = part["key"].astype("int64").to_numpy().astype(np.uint64)
                heads = np.stack([(keys >> np.uint64(15 * i)) & np.uint64(0x7FFF) for i in range(KEY_IDS)], 1).astype("<u2")
                heads[part["no_key"].to_numpy(bool), -1] |= NO_KEY
                yield pd.DataFrame({"value": [h.tobytes() + x.astype("<u2").tobytes()
                                              for h, x in zip(heads, encoder.encode(texts), strict=True)]})

    # The separator's two bytes, as Latin-1 letters, end each line.
    line = int(separator).to_bytes(2, "little").decode("latin-1")
    keyed = docs.select(F.coalesce(F.col(key), F.lit(0)).alias("key"), F.col(key).isNull().alias("no_key"), F.col(text).alias("text"))
    keyed.mapInPandas(run, "value binary") \
        .select(F.col("value").cast("string")).write.mode("overwrite") \
        .option("encoding", "ISO-8859-1").option("lineSep", line).text(folder)
    return separator


def separator_scan(spark: SparkSession, folder: str, separator: int, block: int = BLOCK, head: int = KEY_IDS) -> DataFrame:
    """``file``, ``start`` (place of the document's first id), ``length`` (ids before its separator), ``head`` (its first ids).

    Ids after a file's last separator are no document. An empty folder gives an empty result.
    """

    def search(frames):
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                ids = np.frombuffer(content, "<u2", len(content) // 2)
                for base in range(0, len(ids), block):
                    ends = base + np.flatnonzero(ids[base : base + block] == separator)
                    # The ids after each separator begin the next document; a block looks that far past its end.
                    begins = np.append(ends + 1, 0) if base == 0 else ends + 1
                    yield pd.DataFrame({
                        "file": [name], "block": [base // block], "ends": [ends],
                        "begins": [begins], "heads": [[ids[b : b + head].astype(np.int32) for b in begins]]})

    # Only one file's content is in a task at a time: files hold one input partition each.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where("length > 0")
    blocks = files.select("path", "content").mapInPandas(
        search, "file string, block long, ends array<long>, begins array<long>, heads array<array<int>>")
    by_file = Window.partitionBy("file").orderBy("block")
    last = F.expr("element_at(ends, -1)")
    # Prefix scan: the last separator seen in the blocks before.
    stitched = blocks.select(
        "file", "block", "ends", "begins", "heads",
        F.coalesce(F.last(F.when(F.size("ends") > 0, last), ignorenulls=True)
                   .over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)).alias("carry"))
    spans = stitched.select("file", F.explode(F.expr(
        "transform(ends, (e, i) -> struct(if(i = 0, carry, ends[i - 1]) + 1 AS start, e AS end))")).alias("s"))
    heads = blocks.select("file", F.explode(F.arrays_zip(F.col("begins").alias("start"), F.col("heads").alias("head"))).alias("h"))
    return spans.select("file", "s.start", (F.col("s.end") - F.col("s.start")).alias("length")) \
        .join(heads.select("file", "h.start", "h.head"), ["file", "start"])


def token_counts(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``: documents go to token files in the shared folder and are counted there.

    Rows with a null key are counted and come back with a null key; repeated rows give one row each. Null and empty texts have no
    tokens; very long texts are encoded alone; an empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_root(spark)}/tokens-{uuid.uuid4().hex}"
    separator = write_token_files(docs, folder, path)
    key = sum((F.col("head")[i].cast("long") * (1 << 15 * i) for i in range(1, 4)), F.col("head")[0].cast("long")) \
        + F.shiftleft(F.col("head")[4].cast("long"), 60)
    keyed = F.col("head")[4].bitwiseAND(NO_KEY) == 0
    return separator_scan(spark, folder, separator).select(
        F.when(keyed, key).alias("doc_id"), (F.col("length") - KEY_IDS).alias("n_tokens"), F.col("start").alias("file_start"))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, its end not counted."""
    return token_counts(spark.read.parquet(f"{sf}/documents.parquet"), vocabulary_path()).select("doc_id", "n_tokens")
