"""Repeated byte strings across documents, by prefix doubling on positions chosen by content.

Doubling gives equal strings equal names: first short ones, then, from pairs of names at growing offsets, longer ones;
a position whose name is unique drops out, and the rounds end at the threshold. Done for every byte that is one
shuffled row a byte and round. Here the rounds see only seeds: of all SEED-byte strings within a THRESHOLD-byte string,
its seed is the one with the least hash. Equal strings have equal seeds at equal places, so nothing is lost.

* Round 1 names the SEED bytes at each seed; Spark counts the names, and seeds whose name is unique drop out.
* Round 2 pairs the name at a seed with the name at the offset SEED to either side. A THRESHOLD-byte string around the
  seed holds one of the two doubled strings whole; where its pair is unique, it drops out.
* Round 3 ends at the threshold: the strings around the seeds that are left are sorted by seed, name, document and
  start. All but the first of equal ones are repeats, and their bytes are removed once they have been compared.

Documents that are whole copies of an earlier one need no positions; they go by their digest first.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LoosePowers, cut, fits, loose_sums, map_batches, mix64, prefix_hash, some, span_hash, texts

THRESHOLD, SEED = 100, 32
#: Bytes of one text whose seeds are found at a time.
SEGMENT = 1 << 24
#: Rows of round 3 that one task ranks at a time, about.
RANKED_ROWS = 10_000
#: Strings that are ranked together before a batch's rows are shuffled.
BATCH_STRINGS = 250_000
_PLACE = np.uint64((1 << 28) - 1)
#: Bytes that second names are made for at a time.
_PIECE = 1 << 19


def _names(data: np.ndarray, length: int) -> np.ndarray:
    """A name for the string of ``length`` bytes at each position: a cheap sum modulo 2**64, of which strings of a regular
    build may share more than chance would have. Names only pick what is compared byte by byte, or by :func:`_strings` too."""
    prefix = loose_sums(data)
    return mix64((prefix[length:] - prefix[:-length]) * LoosePowers.down[: len(data) - length + 1])


def _strings(data: np.ndarray, length: int) -> np.ndarray:
    """A second name, modulo a prime, for the string of ``length`` bytes at each position."""
    out = np.empty(max(0, len(data) - length + 1), np.uint64)
    for at in range(0, len(out), _PIECE):  # in pieces, as each takes many times its size
        start = np.arange(min(_PIECE, len(out) - at))
        out[at : at + _PIECE] = span_hash(prefix_hash(data[at : at + _PIECE + length - 1]), start, start + length)
    return out


def seeds(
    data: np.ndarray, bounds: np.ndarray, threshold: int = THRESHOLD, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of seeds, their names, and the first and last start of the strings that each is the seed of."""
    none = np.zeros(0, np.int64)
    if len(data) < threshold:
        return none, none.astype(np.uint64), none, none
    if len(data) > SEGMENT + threshold - 1:
        parts = []
        for at in range(0, len(data) - threshold + 1, SEGMENT):
            to = min(len(data), at + SEGMENT + threshold - 1)
            place, name, first, last = seeds(data[at:to], np.clip(bounds - at, 0, to - at), threshold, seed)
            parts.append((place + at, name, first + at, last + at))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    name = _names(data, seed)
    least = (name & ~_PLACE) | np.arange(len(name), dtype=np.uint64)  # by hash, then by place
    width, want = 1, threshold - seed + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if want > width:
        least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    inside = np.zeros(len(least) + 1, np.int64)  # strings that run over a border are none
    for border in bounds[1:-1]:
        inside[min(max(0, border - threshold + 1), len(least))] += 1
        inside[min(border, len(least))] -= 1
    starts = np.flatnonzero(np.cumsum(inside[:-1]) == 0)
    if not len(starts):
        return none, none.astype(np.uint64), none, none
    place = (least[starts] & _PLACE).astype(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    last = starts[np.append(at[1:], len(starts)) - 1]
    return place[at], name[place[at]], starts[at], last


def _doubled(data: np.ndarray, place: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Round 2: for each seed the pair of its name and the name SEED bytes on, and the pair of the name SEED bytes before
    and its own, each as one number. Where the text ends first there is no string to pair with, and the number is as good as unique."""
    every = _names(data, SEED)
    after, before = place + SEED, place - SEED
    right = np.where(after < len(every), every[np.minimum(after, len(every) - 1)], mix64(place.astype(np.uint64)))
    left = np.where(before >= 0, every[np.maximum(before, 0)], mix64(place.astype(np.uint64)))
    odd = np.uint64(0x9E3779B97F4A7C15)
    return mix64(name * odd + right), mix64(mix64(left * odd + name) + np.uint64(1))


def _listed(lists: pa.ListArray, of: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Whether each row's name is in the list of its document ``of`` (sorted)."""
    keep = np.zeros(len(name), bool)
    edges = np.searchsorted(of, np.arange(len(lists) + 1))
    for k in range(len(lists)):
        keep[edges[k] : edges[k + 1]] = np.isin(name[edges[k] : edges[k + 1]], lists[k].values.to_numpy().view(np.uint64))
    return keep


def _seed_names(docs: DataFrame, with_ids: bool) -> DataFrame:
    """Names of seeds, (name, n) pre-aggregated by batch, or (name, doc_id), once a document. Without a column ``names``
    these are of round 1; with it, the pairs of round 2 at the seeds with these names."""
    second = "names" in docs.columns

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in texts(batch, "text"):
                place, name, _, _ = seeds(data, bounds)
                of = np.searchsorted(bounds, place, "right") - 1
                if second:
                    keep = _listed(batch["names"].slice(at, to - at), of, name)
                    name, of = np.concatenate(_doubled(data, place[keep], name[keep])), np.tile(of[keep], 2)
                if with_ids:
                    order = np.lexsort((name, of))
                    name, of = name[order], of[order]
                    new = np.ones(len(name), bool)
                    new[1:] = (name[1:] != name[:-1]) | (of[1:] != of[:-1])
                    ids = batch["doc_id"].slice(at, to - at).take(pa.array(of[new]))
                    yield pa.RecordBatch.from_arrays([pa.array(name[new].view(np.int64)), ids], ["name", "doc_id"])
                else:
                    name, n = np.unique(name, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n.astype(np.int64))], ["name", "n"])

    columns = ["doc_id", "text", "names"][: 2 + second]
    return map_batches(docs.select(*columns), make, "name long, doc_id long" if with_ids else "name long, n long")


def _round(docs: DataFrame, name: str) -> DataFrame:
    """One round: a scratch table of the documents (doc_id) that hold names met twice or more, with these ``names``."""
    again = cut(_seed_names(docs, False).groupBy("name").agg(F.sum("n").alias("n")).where("n > 1").select("name"), f"suffix-{name}-names")
    held = _seed_names(docs, True).join(again, "name", "left_semi")  # names grow with the text: never a broadcast
    return cut(held.groupBy("doc_id").agg(F.collect_list("name").alias("names")), f"suffix-{name}-found")


_ROW = "name long, doc_id long, start long, context binary"
_SPAN = "first long, end long"


def _equal(data: np.ndarray, one: np.ndarray, two: np.ndarray, length: int) -> bool:
    """Whether the strings that begin at ``one`` and ``two`` are equal, byte by byte. Where both go on by one byte from the
    row before, only the last byte is new."""
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1] + 1) | (two[1:] != two[:-1] + 1)
    if (data[one + length - 1] != data[two + length - 1]).any():
        return False
    new &= one != two
    one, two = one[new], two[new]
    return not any((data[one + k] != data[two + k]).any() for k in range(length - 1))


def _rank(
    name: np.ndarray, doc: np.ndarray, start: np.ndarray, lengths: np.ndarray, data: np.ndarray, threshold: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Round 3 on rows: the context of row k is ``lengths[k]`` bytes of ``data`` and begins at ``start[k]`` of document
    ``doc[k]``. Returns spans of repeats (document, first byte, end) and the rows that hold a first occurrence."""
    if not len(name):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, bool)
    offset = np.concatenate([[0], np.cumsum(lengths)])
    count = lengths - threshold + 1
    row = np.repeat(np.arange(len(name)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = offset[row] + step
    string = _names(data, threshold)[begin]
    who, at = doc[row], start[row] + step
    order = np.lexsort((at, who, string, name[row]))
    same = (string[order[1:]] == string[order[:-1]]) & (name[row[order[1:]]] == name[row[order[:-1]]])
    leader = np.arange(len(order))
    leader[1:][same] = 0
    leader = np.maximum.accumulate(leader)
    first_of = np.empty(len(order), np.int64)
    first_of[order] = order[leader]
    if not _equal(data, begin, begin[first_of], threshold):  # unlike strings of one name: go by the bytes
        raw, seen = data.tobytes(), {}
        for k in np.lexsort((at, who)).tolist():
            first_of[k] = seen.setdefault(raw[begin[k] : begin[k] + threshold], k)
    # one document and start can come twice only if a row does; such a pair is one occurrence
    again = (who != who[first_of]) | (at != at[first_of])
    firsts = np.bincount(row[~again], minlength=len(name)) > 0
    hit = np.flatnonzero(again)
    if not len(hit):
        none = np.zeros(0, np.int64)
        return none, none, none, firsts
    hit = hit[np.lexsort((at[hit], who[hit]))]
    new = np.ones(len(hit), bool)
    new[1:] = (who[hit[1:]] != who[hit[:-1]]) | (at[hit[1:]] > at[hit[:-1]] + 1)
    begin = np.flatnonzero(new)
    return who[hit[begin]], at[hit[begin]], at[hit[np.append(begin[1:], len(hit)) - 1]] + threshold, firsts


def _first_rows(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Ranks rows of round 3 among themselves: spans of repeats come out at once, and of the rows only those that hold
    a first occurrence go on."""
    name, doc, start, length, data = (np.concatenate(x) for x in zip(*parts, strict=True))
    who, begin, end, firsts = _rank(name, doc, start, length, data, THRESHOLD)
    edge = np.concatenate([[0], np.cumsum(length)])
    rows = np.flatnonzero(firsts)
    raw = data.tobytes()
    columns = ["name", "doc_id", "start", "context", "first", "end"]
    if len(rows):
        none = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(name[rows].view(np.int64)), pa.array(doc[rows]), pa.array(start[rows]),
                pa.array([raw[edge[r] : edge[r + 1]] for r in rows], pa.binary()), none, none
            ],
            columns
        )
    if len(who):
        none = pa.nulls(len(who), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, pa.array(who), none, pa.nulls(len(who), pa.binary()), pa.array(begin), pa.array(end)], columns
        )


def _contexts(found: DataFrame) -> DataFrame:
    """Rows of round 3 around the seeds of each (doc_id, text, names: pairs of round 2), pre-aggregated by
    BATCH_STRINGS. Strings that hold the doubled string to the right of the seed need its pair in ``names``, the others that to the left."""
    reach = THRESHOLD - 2 * SEED  # how far before its seed a string may start and hold the right one

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        strings = 0
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for at, to, data, bounds in texts(batch, "text"):
                place, name, first, last = seeds(data, bounds)
                of = np.searchsorted(bounds, place, "right") - 1
                right, left = (_listed(batch["names"].slice(at, to - at), of, pair) for pair in _doubled(data, place, name))
                first = np.where(left, first, np.maximum(first, place - reach))
                last = np.where(right, last, np.minimum(last, place - reach - 1))
                keep = (left | right) & (first <= last)
                name, first, last, of = name[keep], first[keep], last[keep], of[keep]
                length = last - first + THRESHOLD
                take = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
                parts.append((name, ids[at + of], first - bounds[of], length, data[take]))
                strings += int((length - THRESHOLD + 1).sum())
                if strings >= BATCH_STRINGS:
                    yield from _first_rows(parts)
                    parts, strings = [], 0
        if parts:
            yield from _first_rows(parts)

    return map_batches(found.select("doc_id", "text", "names"), make, f"{_ROW}, {_SPAN}")


def _arrays(group: pa.Table) -> tuple[np.ndarray, ...]:
    context = group["context"].combine_chunks()
    edges = np.frombuffer(context.buffers()[1], np.int32)[context.offset : context.offset + len(context) + 1]
    data = np.frombuffer(context.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    return group["name"].to_numpy(), group["doc_id"].to_numpy(), group["start"].to_numpy(), np.diff(edges).astype(np.int64), data


def _spread(rows: DataFrame) -> DataFrame:
    """Spans of repeats among rows of round 3 whose names have too many for one task: each string is a row, and meets
    only the least document and start of its own kind."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            name, doc, start, lengths, data = _arrays(pa.Table.from_batches([batch]))
            offset = np.cumsum(lengths) - lengths
            count = lengths - THRESHOLD + 1
            row = np.repeat(np.arange(len(name)), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            string, twice = (names(data, THRESHOLD)[offset[row] + step] for names in (_names, _strings))
            yield pa.RecordBatch.from_arrays(
                [pa.array(string.view(np.int64)), pa.array(twice.view(np.int64)), pa.array(doc[row]), pa.array(start[row] + step)],
                ["string", "twice", "doc_id", "start"]
            )

    key = ["string", "twice"]  # 64 and 62 bits, of two kinds
    strings = cut(
        map_batches(rows.select("name", "doc_id", "start", "context"), make, "string long, twice long, doc_id long, start long"),
        "suffix-strings"
    )
    least = strings.groupBy(*key).agg(
        F.min(F.struct("doc_id", "start")).alias("least"), F.max(F.struct("doc_id", "start")).alias("most"),
        F.count(F.lit(1)).alias("n")
    )
    least = cut(least.where("least <> most").drop("most"), "suffix-least")
    # a string of very many rows is looked up by broadcast, so that its rows don't meet in the join either
    hot = cut(least.where(F.col("n") > RANKED_ROWS), "suffix-strings-hot")  # at most strings / RANKED_ROWS
    hot = fits(hot)
    again = strings.join(hot, key).unionByName(
        strings.join(hot.select(*key), key, "left_anti").join(least.where(F.col("n") <= RANKED_ROWS), key)
    )
    return again.where("struct(doc_id, start) <> least").select(
        "doc_id", F.col("start").alias("first"), (F.col("start") + THRESHOLD).alias("end")
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """Spans of repeats among the rows of round 3 (a scratch table). Buckets of names have about RANKED_ROWS rows; names
    with more rows than that are dealt by document first, and only rows with a first occurrence meet again, as long as
    this lowers their number. Names that then still have more are ranked string by string."""

    def thin(group: pa.Table) -> pa.Table:
        if not len(group):
            return pa.table(
                {
                    c: pa.array([], t)
                    for c, t in zip(
                        ("name", "doc_id", "start", "context", "first", "end"),
                        (*[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 2), strict=True
                    )
                }
            )
        return pa.Table.from_batches(_first_rows([_arrays(group)]))

    def rank(group: pa.Table) -> pa.Table:
        who, begin, end, _ = _rank(*_arrays(group), THRESHOLD)
        return pa.table({"doc_id": pa.array(who), "first": pa.array(begin), "end": pa.array(end)})

    spans: list[DataFrame] = []
    while True:
        hot = cut(
            rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > RANKED_ROWS), "suffix-hot"
        )  # at most rows / RANKED_ROWS names
        n_hot = hot.agg(F.sum("n")).first()[0] or 0
        if not n_hot:
            break
        dealt = rows.join(fits(hot), "name").withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.ceil(F.col("n") / RANKED_ROWS)))
        thinned = cut(dealt.groupBy("name", "salt").applyInArrow(thin, f"{_ROW}, {_SPAN}"), "suffix-thin")
        spans.append(thinned.where("first is not null").select("doc_id", "first", "end"))
        less = thinned.where("first is null").select("name", "doc_id", "start", "context")
        rows = cut(rows.join(fits(hot.select("name")), "name", "left_anti").unionByName(less), "suffix-rows")
        if less.count() > n_hot // 2:
            stay = cut(rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > RANKED_ROWS).select("name"), "suffix-stay")
            stay = fits(stay)
            spans.append(_spread(rows.join(stay, "name", "left_semi")))
            rows = cut(rows.join(stay, "name", "left_anti"), "suffix-rows")
            break
    buckets = max(1, -(-rows.count() // RANKED_ROWS))
    out = rows.withColumn("bucket", F.pmod("name", F.lit(buckets))).groupBy("bucket").applyInArrow(rank, f"doc_id long, {_SPAN}")
    for more in spans:
        out = out.unionByName(more)
    return out


def _removal(found: DataFrame) -> DataFrame:
    """From (doc_id, text, spans): doc_id, n_removed, n_spans, kept (bytes), kept_sha256."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                raw = (text.as_py() or "").encode()
                begin, end = (np.sort(spans.values.field(k).to_numpy()) for k in (0, 1))
                cover = np.zeros(len(raw) + 1, np.int64)
                np.add.at(cover, begin, 1)
                np.add.at(cover, end, -1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                runs = np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1
                for column, value in zip(out, (int(gone.sum()), int(runs.sum()), kept, hashlib.sha256(kept).hexdigest()), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                ["doc_id", "n_removed", "n_spans", "kept", "kept_sha256"]
            )

    return map_batches(
        found.select("doc_id", "text", "spans"), make,
        "doc_id long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three scratch tables for ``docs`` (long doc_id, text): every document's (doc_id, n_bytes, whole_sha256), the ids
    of whole copies (doc_id), and the repeats of the others (doc_id, spans)."""
    text = F.coalesce("text", F.lit(""))
    basics = cut(
        docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole_sha256")),
        "suffix-basics"
    )
    long_ones = basics.where(f"n_bytes >= {THRESHOLD} and doc_id is not null")
    earliest = cut(
        long_ones.groupBy("whole_sha256").agg(
            F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
        ).where("least < most").drop("most"),
        "suffix-earliest"
    )
    copies = cut(long_ones.join(fits(earliest), "whole_sha256").where("doc_id > least").select("doc_id").distinct(), "suffix-copies")
    docs = some(docs.select("doc_id", "text").where(f"doc_id is not null and octet_length(text) >= {THRESHOLD}"), copies, "left_anti")
    found = _round(docs, "single")
    around = cut(some(docs, found.select("doc_id"), "left_semi").join(found, "doc_id"), "suffix-around")
    found = _round(around, "double")
    rows = cut(_contexts(some(around.drop("names"), found.select("doc_id"), "left_semi").join(found, "doc_id")), "suffix-contexts")
    spans = _ranked(
        rows.where("first is null").select("name", "doc_id", "start", "context")
    ).unionByName(rows.where("first is not null").select("doc_id", "first", "end"))
    spans = cut(spans.groupBy("doc_id").agg(F.collect_list(F.struct("first", "end")).alias("spans")), "suffix-spans")
    return basics, copies, spans


def remove_repeats(docs: DataFrame, text_out: bool = False) -> DataFrame:
    """Removes each byte that a THRESHOLD-byte string covers which also starts earlier: in a smaller doc_id, or in the
    same document at an earlier start. Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256,
    and with ``text_out`` also ``kept``, the remaining bytes (null if nothing was removed).

    Texts are UTF-8 bytes, null is empty; strings are judged on the input. Rows of one doc_id count as one document
    (they should repeat one text) and each give a row. Rows with a null doc_id neither match nor lose bytes. An empty
    table gives no rows; other columns are not read.
    """
    basics, copies, spans = repeated_spans(docs)
    hit = some(
        docs.select("doc_id", "text"), cut(spans.select("doc_id"), "suffix-hit"), "left_semi"
    ).dropDuplicates(["doc_id"]).join(spans, "doc_id")
    removed = _removal(hit) if text_out else _removal(hit).drop("kept")
    empty = hashlib.sha256(b"").hexdigest()
    out = basics.alias("b").join(
        copies.select(F.col("doc_id").alias("copy")), F.col("doc_id") == F.col("copy"), "left"
    ).join(removed.alias("r"), F.col("b.doc_id") == F.col("r.doc_id"), "left")
    gone = F.col("copy").isNotNull()
    kept = [F.when(gone, F.lit(b"")).otherwise(F.col("r.kept")).alias("kept")] if text_out else []
    return out.select(
        F.col("b.doc_id").alias("doc_id"), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"), *kept,
    )
