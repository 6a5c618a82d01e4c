"""Hashed n-gram features for linear models: the same code makes training vectors and scores batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LoosePowers, cut, fits, loose_sums, lower_bytes, map_batches, mix64, texts, word_spans

#: Tasks that hold a sample: optimisers go over it in many short rounds.
SAMPLE_TASKS = 4
_to_sparse = F.udf(lambda size, index, value: Vectors.sparse(size, index, value), VectorUDT())


class Grams:
    """Byte n-grams (within a document) and word n-grams, lower-cased in A-Z, hashed to ``2**bits`` places. A text's
    vector has each kind's relative frequencies, so long and short texts compare; a text without n-grams has zeros."""

    def __init__(self, bits: int, chars: Sequence[int] = (), words: Sequence[int] = ()):
        self.bits, self.chars, self.words, self.size = bits, tuple(chars), tuple(words), 1 << bits

    def places(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each kind: places and the documents they are of."""
        data = lower_bytes(data)
        doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
        shift = np.uint32(32 - self.bits)
        for n in self.chars:
            if len(data) < n:
                continue
            m = len(data) - n + 1
            code = np.full(m, n * 2654435761 % (1 << 32), np.uint32)
            for k in range(n):
                code = (code ^ data[k : k + m]) * np.uint32(0x9E3779B1)
                code ^= code >> np.uint32(15)
            whole = doc[:m] == doc[n - 1 :]
            yield ((code * np.uint32(0x85EBCA6B)) >> shift)[whole], doc[:m][whole]
        if self.words:
            start, end, of = word_spans(data, bounds)
            sums = loose_sums(data)
            word = mix64((sums[end] - sums[start]) * LoosePowers.down[start])
            for n in self.words:
                m = max(0, len(word) - n + 1)
                code = np.zeros(m, np.uint64)
                for k in range(n):
                    code = code * np.uint64(0x9E3779B97F4A7C15) + word[k : k + m]
                whole = of[:m] == of[n - 1 :] if m else np.zeros(0, bool)
                yield (mix64(code + np.uint64(n)) >> np.uint64(64 - self.bits))[whole].astype(np.uint32), of[:m][whole]

    def margins(self, data: np.ndarray, bounds: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Documents by models: products of the vectors with the rows of ``weights`` (models by places)."""
        n = len(bounds) - 1
        out = np.zeros((n, len(weights)))
        for place, doc in self.places(data, bounds):
            share = 1 / np.maximum(np.bincount(doc, minlength=n), 1)
            for k, w in enumerate(weights):
                out[:, k] += np.bincount(doc, w[place], n) * share
        return out

    def rows(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sparse vectors: sorted places and values."""
        n = len(bounds) - 1
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        for place, doc in self.places(data, bounds):
            key, count = np.unique(doc.astype(np.int64) * self.size + place, return_counts=True)
            keys.append(key)
            values.append(count / np.bincount(doc, minlength=n)[key // self.size])
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        value = np.bincount(back, np.concatenate(values), len(key))
        at = np.searchsorted(key, np.arange(n + 1) * self.size)
        for k in range(n):
            yield (key[at[k] : at[k + 1]] % self.size).astype(np.int32), value[at[k] : at[k + 1]]


def training_set(docs: DataFrame, labels: DataFrame, grams: Grams, limit: int, name: str, even: bool = False) -> DataFrame:
    """(doc_id, label, features) of at most ``limit`` labelled rows of (doc_id, label), chosen by a hash of doc_id. With
    ``even`` every label has about the same share of the limit, as far as it has rows, so rare labels are learned too.

    Only ids are sorted for the choice; the chosen ids, at most ``limit`` of them, are the bounded broadcast side.
    """
    known = labels.select("doc_id", "label").where("doc_id is not null and label is not null")
    if even:
        counts = cut(known.groupBy("label").agg(F.count(F.lit(1)).alias("_n")), f"{name}-labels")
        share = F.lit(0.95 * limit / max(1, counts.count())) / F.col("_n")  # what a hash picks varies a little
        known = known.join(fits(counts), "label").where(
            F.pmod(F.xxhash64(F.lit("even"), "doc_id"), F.lit(1 << 30)) / float(1 << 30) < share
        ).drop("_n")
    chosen = cut(known.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit), f"{name}-ids")
    rows = docs.select("doc_id", "text").where("doc_id is not null").join(F.broadcast(chosen), "doc_id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in texts(batch, "text"):
                index, value = zip(*grams.rows(data, bounds), strict=True)
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["label"], pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64()))],
                    ["doc_id", "label", "index", "value"]
                )

    kinds = dict(rows.dtypes)
    made = map_batches(rows, vectors, f"doc_id {kinds['doc_id']}, label {kinds['label']}, index array<int>, value array<double>")
    return cut(made, f"{name}-vectors").coalesce(SAMPLE_TASKS).select(
        "doc_id", "label", _to_sparse(F.lit(grams.size), "index", "value").alias("features")
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


def crc_mod(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % n
