"""BPE encoding and decoding with a public word vocabulary, by batched merge rounds in numpy.

All new words of a batch become one flat array of symbols. In each round every adjacent pair of a word is looked up by
binary search over the sorted pair keys; the pair of the lowest rank in each word is merged wherever it stands in it, and
words without a pair that merges leave the rounds. Words that were met before come from a bounded table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import map_batches, texts

#: Words that a worker keeps at most; then its table starts anew.
KNOWN_WORDS = 100_000
#: Bytes from which on a word is merged by itself.
LONG_WORD = 512
#: Bytes of text that are encoded at a time.
STEP_BYTES = 1 << 19
#: The pattern of the vocabulary's words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: UTF-8 texts without a byte from here on have only characters below U+0340, which every version assigns.
HIGH_BYTE = 0xCD
#: What a query can ask for.
OUTPUTS = {
    "n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "ids_sha256": T.StringType(),
    "decoded": T.StringType(), "decoded_sha256": T.StringType()
}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible, else one from 256 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def unassigned() -> str:
    """A pattern for characters that the Unicode tables here don't assign: on these, the libraries' versions differ."""
    late = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    starts = [c for c, before in zip(late, [-2, *late], strict=False) if c != before + 1]
    ends = [c for c, after in zip(late, [*late[1:], -2], strict=True) if after != c + 1]
    return "[" + "".join(rf"\U{a:08X}-\U{b:08X}" for a, b in zip(starts, ends, strict=True)) + "]"


@dataclass(frozen=True)
class Vocabulary:
    """What workers need of a tokenizer file: ids of the bytes within and at the end of a word, sorted keys of pairs
    (left id above 32 bits, right id below) with rank and merged id, the tokens by id, the special tokens, and a pattern of characters on which libraries differ."""

    inner: np.ndarray
    final: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    tokens: np.ndarray
    special: dict[str, int] = field(default_factory=dict)
    rare: str = ""


def load_vocabulary(path: str) -> Vocabulary:
    """From a tokenizer file with a word-end suffix; ``path`` is read on the driver only."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab, suffix = file["model"]["vocab"], file["model"]["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    tokens = np.full(max([*vocab.values(), *special.values()]) + 1, "", object)
    for text, k in [*vocab.items(), *special.items()]:
        tokens[k] = text
    characters = byte_characters()
    pairs = np.array([(vocab[a] << 32 | vocab[b], vocab[a + b]) for a, b in file["model"]["merges"]], np.int64).reshape(-1, 2)
    order = np.argsort(pairs[:, 0], kind="stable")
    ids = lambda end: np.array([vocab[c + end] for c in characters], np.int64)
    return Vocabulary(ids(""), ids(suffix), pairs[order, 0], order.astype(np.int64), pairs[order, 1], tokens, special, unassigned())


_NO_RANK = np.iinfo(np.int64).max


def merge_rounds(symbols: np.ndarray, word: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merges the symbols of many words (``word``: ascending number of the word each symbol is in) to their tokens."""
    done_symbols, done_words = [], []
    last = max(len(vocab.keys) - 1, 0)
    while len(symbols):
        key = symbols[:-1] << 32 | symbols[1:]
        place = np.minimum(np.searchsorted(vocab.keys, key), last)
        found = (word[:-1] == word[1:]) & (vocab.keys[place] == key) if len(vocab.keys) else np.zeros(len(key), bool)
        rank = np.append(np.where(found, vocab.ranks[place] if len(vocab.keys) else 0, _NO_RANK), _NO_RANK)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        least = np.minimum.reduceat(rank, first)
        size = np.diff(np.append(first, len(symbols)))
        going = np.repeat(least != _NO_RANK, size)
        if not going.all():
            done_symbols.append(symbols[~going])
            done_words.append(word[~going])
            if not going.any():
                break
        hit = (rank == np.repeat(least, size)) & going
        # where the pair overlaps itself (three equal symbols), the left one of each two merges
        at = np.flatnonzero(hit)
        run = np.append(True, at[1:] != at[:-1] + 1)
        begin = at[run][np.cumsum(run) - 1]
        at = at[(at - begin) % 2 == 0]
        symbols = symbols.copy()
        symbols[at] = vocab.merged[place[at]]
        going[at + 1] = False
        symbols, word = symbols[going], word[going]
    if not done_symbols:
        return symbols, word
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    return symbols[order], word[order]


def merge_long(symbols: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """The same for one long word, whose rounds would each go over all of it: its pairs wait in a heap by rank and place,
    and a merge looks at its two neighbours only."""
    n = len(symbols)
    symbol, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    keys, ranks, merged = vocab.keys, vocab.ranks, vocab.merged

    def waiting(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        key = left << 32 | right
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[place] == key
        columns = (ranks[place[hit]], at[hit], left[hit], right[hit], merged[place[hit]])
        return list(zip(*(c.tolist() for c in columns), strict=True))

    heap = waiting(np.arange(n - 1), symbols[:-1], symbols[1:]) if len(keys) else []
    heapq.heapify(heap)
    while heap:
        _, at, left, right, new = heapq.heappop(heap)
        gone = after[at]
        if symbol[at] != left or gone >= n or symbol[gone] != right:
            continue  # a neighbour has merged meanwhile
        symbol[at], symbol[gone], after[at] = new, -1, after[gone]
        if after[gone] < n:
            before[after[gone]] = at
        starts = [k for k in (before[at], at) if k >= 0 and after[k] < n]
        if starts:
            for entry in waiting(np.array(starts), np.array([symbol[k] for k in starts]), np.array([symbol[after[k]] for k in starts])):
                heapq.heappush(heap, entry)
    return np.array([s for s in symbol if s >= 0], np.int64)


class Encoder:
    """Encodes texts with a vocabulary; keeps the tokens of words it has met."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.words = regex.compile(WORDS)
        self.rare = regex.compile(vocab.rare)
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()])
        self.library = pre_tokenizers.Split(Regex(WORDS), "removed", invert=True)
        self.special = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(vocab.special, key=len, reverse=True)) + ")"
        ) if vocab.special else None
        self._forget()

    def _forget(self) -> None:
        self.known = {text: k for k, text in enumerate(self.vocab.special)}
        self.ids = np.array(list(self.vocab.special.values()), np.int64)
        self.edges = np.arange(len(self.known) + 1, dtype=np.int64)

    def split(self, text: str, high: bool = True) -> list[str]:
        """The words of a text; a special token is a word that no other text gives, as it mixes kinds of characters."""
        if self.special is None or "<|" not in text:
            return self._plain(text, high)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            out += [part] if k % 2 else self._plain(part, high)
        return out

    def _plain(self, text: str, high: bool) -> list[str]:
        if high and self.rare.search(text):
            return [w for w, _ in self.library.pre_tokenize_str(self.normal.normalize_str(text))]
        # lower case by character: a final sigma is no different from another
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _learn(self, new: list[str]) -> None:
        raw = [w.encode() for w in new]
        size = np.array([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.vocab.inner[data]
        end = np.cumsum(size) - 1
        symbols[end] = self.vocab.final[data[end]]
        word = np.repeat(np.arange(len(new)), size)
        short = size[word] <= LONG_WORD
        parts = [merge_rounds(symbols[short], word[short], self.vocab)]
        for k in np.flatnonzero(size > LONG_WORD):
            merged = merge_long(symbols[end[k] - size[k] + 1 : end[k] + 1], self.vocab)
            parts.append((merged, np.full(len(merged), k)))
        ids, word = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(word, kind="stable")
        ids, word = ids[order], word[order]
        count = np.bincount(word, minlength=len(new))
        base = len(self.edges) - 1
        self.known.update((w, base + k) for k, w in enumerate(new))
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(count)])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, batch: Sequence[str], high: Sequence[bool] | None = None) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers. ``high``: which texts have bytes from HIGH_BYTE on."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        split = [self.split(t, h) for t, h in zip(batch, high or [True] * len(batch), strict=True)]
        known = self.known
        new = list({w for words in split for w in words if w not in known})
        if new:
            self._learn(new)
            known = self.known
        which = np.array([known[w] for words in split for w in words], np.int64)
        begin, size = self.edges[which], self.edges[which + 1] - self.edges[which]
        flat = self.ids[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))].astype("<u4")
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *(len(w) for w in split)])]
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The text of ids: as the vocabulary names no decoder, its tokens with blanks between; unknown ids are left out."""
    ids = ids[ids < len(vocab.tokens)]
    return " ".join(t for t in vocab.tokens[ids].tolist() if t)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, outputs: Sequence[str] = ("n_tokens", "ids"), path: str | None = None) -> DataFrame:
    """``docs`` (text, ...) without the text, with ``outputs`` (names in OUTPUTS) of each row: whole texts are encoded
    without added special tokens and decoded from the ids.

    A null or empty text has no tokens and decodes to an empty text; repeated rows each give a row; other columns pass
    through, those named like an output are replaced; an empty table gives no rows. One pass, no shuffle; the vocabulary
    (a file of fixed size) is broadcast.
    """
    vocab = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path or default_path()))
    kept = [c for c in docs.columns if c.lower() != "text" and c.lower() not in OUTPUTS]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab.value)
        for batch in batches:
            for at, to, data, bounds in texts(batch, "text", STEP_BYTES):
                raw = data.tobytes()
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                above = np.concatenate([[0], np.cumsum(data >= HIGH_BYTE)])[bounds]
                ids = encoder.encode([raw[a:b].decode() for a, b in spans], (above[1:] > above[:-1]).tolist())
                made: dict[str, pa.Array] = {}
                if "n_tokens" in outputs:
                    made["n_tokens"] = pa.array([len(x) for x in ids], pa.int64())
                if "ids" in outputs:
                    made["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()),
                        pa.array(np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32))
                    )
                if "ids_sha256" in outputs:
                    made["ids_sha256"] = pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string())
                if "decoded" in outputs or "decoded_sha256" in outputs:
                    decoded = [decode(x, vocab.value) for x in ids]
                    made["decoded"] = pa.array(decoded, pa.string())
                    made["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string())
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), *(made[o] for o in outputs)], [*kept, *outputs])

    schema = docs.select(*kept).schema
    for o in outputs:
        schema = schema.add(o, OUTPUTS[o])
    return map_batches(docs.select(*kept, "text"), encode, schema)


def decode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array of int) replaced by ``decoded``. Null ids decode to an empty text."""
    vocab = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path or default_path()))
    kept = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoded = [decode(x.values.to_numpy().astype(np.int64), vocab.value) if x.is_valid else "" for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(decoded, pa.string())], [*kept, "decoded"])

    return map_batches(docs.select(*kept, "ids"), text, docs.select(*kept).schema.add("decoded", "string"))
