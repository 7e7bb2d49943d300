"""Byte-pair encoding and decoding in batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. A round looks up every adjacent pair of a word
by binary search over the sorted pair keys, takes each word's pair of lowest rank, and merges it in all
words at once; words without a known pair leave. Rounds repeat until no word is left. Encoded words are
kept in a bounded table per task, so that a frequent word is merged once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession

#: Pre-tokenizer pattern of the byte-level vocabulary files (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words a task keeps encoded before it starts afresh.
KEPT_WORDS = 200_000
_NONE = np.iinfo(np.int64).max


def _byte_letters() -> dict[str, int]:
    """The printable letter that vocabulary files write for each byte: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of a byte-level BPE file: pair keys in order with rank and product, bytes of every id, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], _byte_letters()
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * self.size
        for piece, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        for piece, i in self.special.items():
            self.bytes_of[i] = piece.encode()
        self.byte_id = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right, made = (np.array([vocab[x] for x in column], np.int64)
                             for column in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        keys = left * self.size + right
        # A pair listed twice keeps its last rank, as in a map filled in file order.
        last = len(keys) - 1 - np.unique(keys[::-1], return_index=True)[1]
        self.keys, self.rank, self.made = keys[last], last, made[last]
        # Where a merge's product starts pairs of lower rank, one occurrence is merged at a time.
        lowest = np.full(self.size, _NONE)
        np.minimum.at(lowest, left, np.arange(len(keys)))
        np.minimum.at(lowest, right, np.arange(len(keys)))
        self.single = lowest[self.made] < self.rank

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one behind the other, and the number of ids of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.rank[at], _NONE), _NONE)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbols)))
            over = np.repeat(low == _NONE, sizes)
            done.append((word[over], symbols[over]))
            hit = (rank == np.repeat(low, sizes)) & ~over
            where = np.flatnonzero(hit)
            if not len(where):
                break
            # In a run of overlapping hits (a a a) every second one is merged; single merges take the first of a word.
            fresh = np.append(True, np.diff(where) > 1)
            start = np.maximum.accumulate(np.where(fresh, where, 0))
            pick = (where - start) % 2 == 0
            alone = self.single[at[where]] & ~np.append(True, word[where][1:] != word[where][:-1])
            where = where[pick & ~alone]
            symbols = symbols.copy()
            symbols[where] = self.made[at[where]]
            stay = ~over
            stay[where + 1] = False
            symbols, word = symbols[stay], word[stay]
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner = np.concatenate([w for w, _ in done])
        ids = np.concatenate([s for _, s in done])[np.argsort(owner, kind="stable")]
        return ids, np.bincount(owner, minlength=len(words))


class Encoder:
    """Encodes whole texts with a :class:`Vocabulary`; special strings inside a text become their ids."""

    def __init__(self, vocabulary: Vocabulary, kept: int = KEPT_WORDS):
        self.v, self.kept = vocabulary, kept
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") \
            if vocabulary.special else None
        self.find = regex.compile(PATTERN).findall
        self._fresh()

    def _fresh(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.sizes = (np.zeros(0, np.int64) for _ in range(3))

    def _learn(self, words: list[str]) -> None:
        ids, sizes = self.v.merge([w.encode("utf-8", "surrogatepass") for w in words])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > self.kept:
            self._fresh()
        pieces: list[np.ndarray] = []
        owners: list[int] = []
        fresh: list[str] = []
        known = self.known
        for t, text in enumerate(texts):
            for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
                if i % 2:
                    pieces.append(np.array([-1 - self.v.special[part]]))
                    owners.append(t)
                elif part:
                    found = self.find(part)
                    for w in set(found).difference(known):
                        known[w] = len(self.sizes) + len(fresh)
                        fresh.append(w)
                    pieces.append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
                    owners.append(t)
        if fresh:
            self._learn(fresh)
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for t, piece in zip(owners, pieces, strict=True):
            if len(piece) == 1 and piece[0] < 0:
                out[t].append(-1 - piece)
                continue
            sizes = self.sizes[piece]
            ends = np.cumsum(sizes)
            place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - self.starts[piece], sizes)
            out[t].append(self.ids[place])
        return [np.concatenate(p) if p else np.zeros(0, np.int64) for p in out]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.v.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _batches(frame: pd.DataFrame, text: str, limit: int = 1 << 20) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Runs of rows with about ``limit`` characters; a longer text alone."""
    texts = ["" if not isinstance(t, str) else t for t in frame[text]]
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield frame.iloc[first:i], texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts:
        yield frame.iloc[first:], texts[first:]


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``ids`` array<int>: the whole text encoded (null: no ids).

    No shuffle: rows stay where they are. A column named ``ids`` is replaced. Repeated, empty and very long
    texts are encoded like others; an empty table gives an empty result.
    """
    docs = docs.drop("ids")
    tables = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))  # bounded by the vocabulary

    def run(frames):
        encoder = Encoder(tables.value)
        for frame in frames:
            for part, texts in _batches(frame, text):
                yield part.assign(ids=[x.astype(np.int32) for x in encoder.encode(texts)])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInPandas(run, f"{names}, ids array<int>")


def digest(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens``, SHA-256 of the ids and of the text decoded from them, by the same encoder in one pass."""
    import hashlib

    tables = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(frames):
        encoder = Encoder(tables.value)
        for frame in frames:
            for part, texts in _batches(frame, text):
                ids = encoder.encode(texts)
                yield pd.DataFrame({
                    key: part[key], "n_tokens": [len(x) for x in ids],
                    "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(encoder.decode(x).encode()).hexdigest() for x in ids]})

    return docs.select(key, text).mapInPandas(run, f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf}/documents.parquet"), vocabulary_path())
