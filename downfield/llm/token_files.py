"""Token ids in files: canonical Huffman codes of limited length from global counts, in blocks that decode by themselves.

The files are a Parquet table of blocks and a table of code lengths. A block holds whole documents in ascending order; each
starts on a byte and has the length in bits of every STEP of its ids, so that all steps of a block are decoded side by
side, one table look-up for an id of each. Code lengths alone give the codes, as they are canonical.
"""

from __future__ import annotations

import gc
import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_characters
from .common import cut, map_batches, scratch_path, small, texts

#: Bits of the longest code, ids from one checkpoint to the next, ids that a block holds about and a part about.
LONGEST, STEP, BLOCK_IDS, PART_IDS = 20, 128, 1 << 18, 1 << 23
#: Words that a worker keeps at most, about 250 bytes each; then its table starts anew.
KNOWN_WORDS = 800_000
#: Bytes of text that are encoded at a time.
STEP_BYTES = 1 << 19
#: Ends every document.
END_ID = 0
#: Letters, numbers and white space below U+0240, and the byte-level vocabulary's words over them. The first
#: byte of a later character in UTF-8 is at least HIGH_BYTE.
HIGH_BYTE = 0xC9
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ȿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
WORDS = re.compile(f" ?[{_L}]+| ?[{_N}]+|'(?:[stmd]|re|ve|ll)| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Between words that are encoded together; no word has it.
_MARK = "\ue000"


# ---- encoding -------------------------------------------------------------------------------------------------------


class _Numbered(dict):
    """Words by number; one that is looked up for the first time gets the next and is noted as new."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class ByteEncoder:
    """Encodes texts as the library does with a byte-level vocabulary. The library's model encodes each word that is new to
    the worker; texts with characters from U+0240 on go through the library whole."""

    _kept: dict[int, ByteEncoder] = {}

    def __init__(self, file: str):
        self.library = Tokenizer.from_str(file)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        added = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.added = {t: self.library.token_to_id(t) for t in added}
        self.characters = dict(enumerate(byte_characters()))
        self.mark = _MARK.encode().decode("latin-1").translate(self.characters)
        self._forget()

    @classmethod
    def of(cls, file: str) -> ByteEncoder:
        """The encoder of this worker process, with the words that earlier tasks met."""
        key = zlib.crc32(file.encode())
        if key not in cls._kept:
            cls._kept = {key: cls(file)}
        return cls._kept[key]

    def _forget(self) -> None:
        self.known = _Numbered({t: k for k, t in enumerate(self.added)})
        self.ids = np.array(list(self.added.values()), np.uint32)
        self.edges = np.arange(len(self.added) + 1, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        pieces = _MARK.join(words).encode().decode("latin-1").translate(self.characters).split(self.mark)
        tokens = list(map(self.model.tokenize, pieces))
        self.edges = np.append(self.edges, self.edges[-1] + np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens))))
        self.ids = np.append(self.ids, np.array([t.id for word in tokens for t in word], np.uint32))

    def _split(self, text: str) -> list[str]:
        """Words; a special token is a word that no text beside gives, as it mixes kinds of characters."""
        if self.special is None or not self.special.search(text):
            return WORDS.findall(text)
        return [w for k, part in enumerate(self.special.split(text)) for w in ([part] if k % 2 else WORDS.findall(part))]

    def encode(self, batch: Sequence[str], whole: Sequence[bool]) -> list[np.ndarray]:
        """Ids of each text. ``whole``: which texts have bytes from HIGH_BYTE on."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        split = [[] if w else self._split(t) for t, w in zip(batch, whole, strict=True)]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        # a word that isn't known gets the next number
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        begin, size = self.edges[which], self.edges[which + 1] - self.edges[which]
        flat = self.ids[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        ends = np.concatenate([[0], np.cumsum(size)])[np.append(0, np.cumsum(sizes))].tolist()
        out = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        others = [k for k, w in enumerate(whole) if w]
        for k, found in zip(others, self.library.encode_batch([batch[k] for k in others], add_special_tokens=False), strict=True):
            out[k] = np.array(found.ids, np.uint32)
        return out


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def id_type(size: int, end_id: int = END_ID) -> np.dtype:
    """The integers that hold all ids of a vocabulary."""
    return np.dtype("<u2" if max(size - 1, end_id) < 1 << 16 else "<u4")


def encode_ids(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids) for each row of ``docs`` (doc_id, text, ...): whole texts by the vocabulary in ``path`` and the
    end id behind each, ``ids`` as little-endian unsigned integers of 16 bits if all of the vocabulary fit, else of 32.

    A null or empty text has the end id only; repeated rows each give a row; other columns are not read; an empty table
    gives no rows. One pass, no shuffle; the vocabulary's file is broadcast."""
    with open(path or default_path(), encoding="utf-8") as f:
        text = f.read()
    kind = id_type(Tokenizer.from_str(text).get_vocab_size(), end_id)
    file = docs.sparkSession.sparkContext.broadcast(text)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder.of(file.value)
        gc.disable()  # millions of words and no cycles
        try:
            yield from encoded(encoder, batches)
        finally:
            gc.enable()

    def encoded(encoder: ByteEncoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in texts(batch, "text", STEP_BYTES):
                raw = data.tobytes()
                above = np.append(0, np.cumsum(data >= HIGH_BYTE))[bounds]
                ids = encoder.encode(
                    [raw[a:b].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], (above[1:] > above[:-1]).tolist()
                )
                made = [np.append(x, end_id).astype(kind).tobytes() for x in ids]
                sizes = pa.array([len(x) // kind.itemsize for x in made], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(at, to - at), sizes, pa.array(made, pa.binary())], ["doc_id", "n_tokens", "ids"]
                )

    return map_batches(docs.select("doc_id", "text"), encode, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids binary")


# ---- codes ----------------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of the code of each id, 0 for ids that don't occur: the fewest bits in all with none above ``longest`` (or above
    what so many ids need), by merging packages."""
    used = np.flatnonzero(counts)
    out, n = np.zeros(len(counts), np.int64), len(used)
    if n < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    weight, packages, levels = counts[order].astype(np.int64), np.zeros(0, np.int64), []
    for _ in range(max(longest, math.ceil(math.log2(n)))):
        merged = np.concatenate([weight, packages])
        place = np.argsort(merged, kind="stable")
        levels.append(place < n)
        merged = merged[place][: len(merged) // 2 * 2]
        packages = merged[::2] + merged[1::2]
    take, length = 2 * (n - 1), np.zeros(n, np.int64)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        length[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = length
    return out


@dataclass(frozen=True)
class Codes:
    """Canonical codes: bits and length by id, and a table that says of the next ``longest`` bits which id they begin with
    (above five bits of its length)."""

    code: np.ndarray
    length: np.ndarray
    table: np.ndarray
    longest: int

    @classmethod
    def of(cls, length: np.ndarray) -> Codes:
        longest = int(length.max(initial=1))
        used = np.flatnonzero(length)
        order = used[np.argsort(length[used], kind="stable")]
        wide = np.left_shift(1, longest - length[order])
        first = np.cumsum(wide) - wide
        code = np.zeros(len(length), np.uint64)
        code[order] = first >> (longest - length[order])
        table = np.zeros(1 << longest, np.int64)
        table[: int(wide.sum())] = np.repeat(order << 5 | length[order], wide)
        return cls(code, length, table, longest)

    def pack(self, ids: np.ndarray, per_doc: np.ndarray, step: int = STEP) -> tuple[bytes, np.ndarray]:
        """The bits of the documents, each from a byte on, and the bits of every ``step`` of a document's ids."""
        size = self.length[ids]
        if len(ids) and size.min() == 0:
            raise ValueError("an id has no code")
        first = np.cumsum(per_doc) - per_doc
        until = np.concatenate([[0], np.cumsum(size)])
        starts = np.cumsum(room := (until[first + per_doc] - until[first] + 7) // 8 * 8) - room
        place = until[:-1] + np.repeat(starts - until[first], per_doc)
        word = place >> 5
        bits = self.code[ids] << (64 - size - (place & 31)).astype(np.uint64)
        new = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(ids) else np.zeros(0, np.int64)
        out = np.zeros(int(room.sum() + 31 >> 5) + 1, np.uint64)
        if len(ids):
            out[word[new]] += np.add.reduceat(bits >> np.uint64(32), new)
            out[word[new] + 1] += np.add.reduceat(bits & np.uint64(0xFFFFFFFF), new)
        steps = -(-per_doc // step)
        begin = np.repeat(first, steps) + (np.arange(int(steps.sum())) - np.repeat(np.cumsum(steps) - steps, steps)) * step
        checkpoints = np.add.reduceat(size, begin) if len(begin) else np.zeros(0, np.int64)
        return out.astype(">u4").tobytes()[: int(room.sum()) // 8], checkpoints

    def unpack(self, data: bytes, per_doc: np.ndarray, checkpoints: np.ndarray, step: int = STEP) -> np.ndarray:
        """The ids of all documents, one behind the other: all steps at once, an id of each a round."""
        raw = np.frombuffer(data + b"\0" * (12 - len(data) % 4), ">u4").astype(np.uint64)
        pairs = raw[:-1] << np.uint64(32) | raw[1:]
        steps = -(-per_doc // step)
        doc = np.repeat(np.arange(len(per_doc)), steps)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(steps) - steps, steps)
        before = np.concatenate([[0], np.cumsum(checkpoints)])
        edge = np.concatenate([[0], np.cumsum(steps)])
        room = (before[edge[1:]] - before[edge[:-1]] + 7) // 8 * 8
        place = before[:-1] - before[edge[doc]] + (np.cumsum(room) - room)[doc]
        target = (np.cumsum(per_doc) - per_doc)[doc] + nth * step
        left = np.minimum(per_doc[doc] - nth * step, step)
        order = np.argsort(-left, kind="stable")
        place, target = place[order], target[order]
        going = np.searchsorted(-left[order], -np.arange(1, step + 1), "right")
        out = np.zeros(int(per_doc.sum()), np.int64)
        mask, top = np.uint64((1 << self.longest) - 1), 64 - self.longest
        for k, n in enumerate(going.tolist()):
            if not n:
                break
            at = place[:n]
            found = self.table[(pairs[at >> 5] >> (top - (at & 31)).astype(np.uint64)) & mask]
            out[target[:n] + k] = found >> 5
            at += found & 31
        return out


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    """All ids of a batch of (n_tokens, ids)."""
    data = b"".join(batch["ids"].to_pylist())
    return np.frombuffer(data, "<u2" if len(data) == 2 * sum(batch["n_tokens"].to_pylist()) else "<u4")


def count_ids(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; one number for each id of the vocabulary comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = _flat(batch)
            now = np.bincount(ids, minlength=len(total))
            now[: len(total)] += total
            total = now
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = map_batches(encoded.select("n_tokens", "ids"), count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r.id] = r.n
    return counts


# ---- files ----------------------------------------------------------------------------------------------------------


def write_ids(encoded: DataFrame, path: str, longest: int = LONGEST, block: int = BLOCK_IDS, part: int = PART_IDS) -> None:
    """Writes (doc_id, n_tokens, ids) of :func:`encode_ids`, a stored table, to files below ``path``: ``blocks`` and ``code``.

    Documents stand in ascending doc_id, null first; those of one doc_id in the order of a digest of their ids. A document
    is never split; one of more than ``block`` ids is a block. One shuffle of the ids, by ranges of doc_id."""
    spark = encoded.sparkSession
    counts = count_ids(encoded)
    length = code_lengths(counts, longest)
    codes = spark.sparkContext.broadcast(Codes.of(length))
    table = [(int(k), int(length[k])) for k in np.flatnonzero(length)]
    spark.createDataFrame(table, "id long, bits long").coalesce(1).write.parquet(f"{path}/code")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, held, size = 0, 0, [], 0

        def made() -> pa.RecordBatch:
            per_doc = np.array([n for _, n, _ in held], np.int64)
            data = b"".join(x for *_, x in held)
            ids = np.frombuffer(data, "<u2" if len(data) == 2 * int(per_doc.sum()) else "<u4")
            bits, checkpoints = codes.value.pack(ids.astype(np.int64), per_doc)
            small_int = np.uint16 if STEP * codes.value.longest < 1 << 16 else np.uint32
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([number], pa.int64()), pa.array([before], pa.int64()),
                    pa.array([[d for d, *_ in held]], pa.list_(key)), pa.array([per_doc.tolist()], pa.list_(pa.int64())),
                    pa.array([bits], pa.binary()), pa.array([checkpoints.astype(small_int).tobytes()], pa.binary())
                ],
                ["part", "block", "before", "doc_ids", "sizes", "bits", "checkpoints"]
            )

        for batch in batches:
            key = batch["doc_id"].type
            for doc, n, ids in zip(*(batch[c].to_pylist() for c in ("doc_id", "n_tokens", "ids")), strict=True):
                if held and size + n > block:
                    yield made()
                    number, before, held, size = number + 1, before + size, [], 0
                held.append((doc, n, ids))
                size += n
        if held:
            yield made()

    kind = dict(encoded.dtypes)["doc_id"]
    parts = max(1, math.ceil(int(counts.sum()) / part))
    order = ["doc_id", F.xxhash64("ids"), "n_tokens"]
    rows = encoded.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "ids")
    schema = f"part int, block long, before long, doc_ids array<{kind}>, sizes array<long>, bits binary, checkpoints binary"
    map_batches(rows, blocks, schema).write.option("compression", "none").parquet(f"{path}/blocks")


#: What a reader can ask for.
OUTPUTS = {"ids": "binary", "ids_crc32": "long"}


def read_ids(spark: SparkSession, path: str, outputs: Sequence[str] = ("ids",)) -> DataFrame:
    """(doc_id, start, n_tokens) and ``outputs`` of each document in the files below ``path``; ``start`` counts the ids of all
    documents before it. Each block is decoded by itself; ``ids`` are little-endian unsigned 32-bit integers."""
    stored = spark.read.parquet(f"{path}/code").collect()  # one row for each id of the vocabulary that occurs
    length = np.zeros(max((r.id for r in stored), default=0) + 1, np.int64)
    for r in stored:
        length[r.id] = r.bits
    codes = spark.sparkContext.broadcast(Codes.of(length))
    blocks = spark.read.parquet(f"{path}/blocks")
    ends = blocks.groupBy("part").agg(F.max(F.col("before") + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    earlier = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))  # a row a part, of PART_IDS each
    parts = ends.select("part", F.coalesce(earlier, F.lit(0)).alias("_from"))
    rows = blocks.join(small(parts, rows=ends.count()), "part").withColumn("before", F.col("before") + F.col("_from"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small_int = np.uint16 if STEP * codes.value.longest < 1 << 16 else np.uint32
            for k in range(batch.num_rows):
                sizes = batch["sizes"][k].values.to_numpy(zero_copy_only=False).astype(np.int64)
                checkpoints = np.frombuffer(batch["checkpoints"][k].as_py(), small_int).astype(np.int64)
                ids = codes.value.unpack(batch["bits"][k].as_py(), sizes, checkpoints).astype("<u4")
                ends = np.cumsum(sizes)
                made = [pa.array(ends - sizes + batch["before"][k].as_py()), pa.array(sizes)]
                cuts = [ids[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                if "ids" in outputs:
                    made.append(pa.array(cuts, pa.binary()))
                if "ids_crc32" in outputs:
                    made.append(pa.array([zlib.crc32(x) for x in cuts], pa.int64()))
                names = ["doc_id", "start", "n_tokens", *(o for o in OUTPUTS if o in outputs)]
                yield pa.RecordBatch.from_arrays([batch["doc_ids"][k].values, *made], names)

    kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    schema = ", ".join([f"doc_id {kind}", "start long", "n_tokens long", *(f"{o} {t}" for o, t in OUTPUTS.items() if o in outputs)])
    return map_batches(rows.select("before", "doc_ids", "sizes", "bits", "checkpoints"), decode, schema)


def token_files(docs: DataFrame, path: str | None = None, outputs: Sequence[str] = ("ids",)) -> DataFrame:
    """Encodes ``docs`` (doc_id, text, ...), writes the files below ``path`` (a scratch folder if none is given) and reads
    them back: see :func:`encode_ids`, :func:`write_ids` and :func:`read_ids`. An empty table gives files without blocks
    and no rows."""
    path = path or scratch_path(docs.sparkSession, "token-files")
    write_ids(cut(encode_ids(docs), "token-ids", "zstd"), path)
    return read_ids(docs.sparkSession, path, outputs)
