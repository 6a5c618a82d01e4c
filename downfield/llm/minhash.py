"""Near-duplicates by HyperMinHash: a register holds the leading zeros and some mantissa bits of its bucket's least hash.

1. Each text gets the set of its shingles, a fingerprint of the set, and a sketch of registers; equal sets become one
   class, whatever their number.
2. Bands of five registers put classes into buckets; a bucket's least document leads it. A family is all that one leader
   leads, in any band. At a similarity of 0.85 a pair misses all bands once in 10**8 times.
3. Families are cut into blocks of bounded size. In a block the collision-corrected Jaccard estimate of the sketches
   picks the pairs, and only those are confirmed, on the full sets. Links come out as a spanning forest, not as pairs.
4. Families of several blocks whose members are not yet one component are compared across their blocks too, but only
   between different components; so no pair that shares a bucket is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, fits, lower_bytes, map_batches, mix64, prefix_hash, some, span_hash, texts, word_spans
from .components import Forest, components

WORDS = 5
#: Link at 100 * intersection >= LINK * union.
LINK = 85
#: A band is five registers, kept as a long (four of them) and a short.
BANDS, PER_BAND, MANTISSA = 32, 5, 10
REGISTERS = BANDS * PER_BAND
#: Pairs whose estimate is this much (of 1) below the threshold aren't confirmed: six standard errors of the estimate.
SLACK = 0.17
#: Members and shingles a block of a family has at most, about.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 400_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles and the documents they are of, sorted by document and hash. A document of fewer
    words has its whole sequence as one; one without words has none."""
    data = lower_bytes(data)
    start, end, of = word_spans(data, bounds)
    word = span_hash(prefix_hash(data), start, end)
    per = np.bincount(of, minlength=len(bounds) - 1)
    first = np.concatenate([[0], np.cumsum(per)])
    at, length = np.arange(len(word)), np.full(len(word), words)
    left = first[of + 1] - at if len(word) else at
    short = per[of] < words
    take = (left >= words) | (short & (at == first[of]))
    length[short] = left[short]
    at, length, of = at[take], length[take], of[take]
    code = np.zeros(len(at), np.uint64)
    for k in range(words):
        more = k < length
        code[more] = code[more] * _STEP + word[at[more] + k]
    code = mix64(code + length.astype(np.uint64))
    order = np.lexsort((code, of))
    code, of = code[order], of[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
    return code[new], of[new]


def registers(code: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Documents by registers, 16 bits each: leading zeros + 1 above MANTISSA bits; 0 is an empty bucket."""
    least = np.full(n * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    seen = np.zeros(n * REGISTERS, bool)
    place = of * REGISTERS + ((code >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
    rest = mix64(code ^ np.uint64(0xA0761D6478BD642F))
    np.minimum.at(least, place, rest)
    seen[place] = True
    top = (least >> np.uint64(11)).astype(np.float64)  # 53 bits are exact
    zeros = np.where(top > 0, 53 - np.frexp(top)[1], 53).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return np.where(seen, ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | mantissa, 0).astype(np.uint16).reshape(n, REGISTERS)


def estimate(one: np.ndarray, n_one: int, many: np.ndarray, n_many: np.ndarray) -> np.ndarray:
    """Jaccard estimates of one sketch with others: the share of equal registers, less what unequal sets of these
    sizes agree on by chance."""
    used = (one > 0) | (many > 0)
    share = ((one == many) & used).sum(axis=1) / np.maximum(used.sum(axis=1), 1)
    width = 0.5 ** np.arange(1, 54)[:, None]
    a, b = n_one / REGISTERS, np.asarray(n_many)[None, :] / REGISTERS
    chance = np.minimum((width**2 * a * b * np.exp(-(a + b) * 1.5 * width)).sum(axis=0) / (1 << MANTISSA), 0.5)
    return (share - chance) / (1 - chance)


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_sum, set_mix, sketch, fifth): a row for each document, the sketch as a long and a short
    for each band."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in texts(batch, "text"):
                n = to - at
                code, of = shingles(data, bounds)
                total, mixed = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                np.add.at(total, of, code)
                np.add.at(mixed, of, mix64(code ^ _STEP))
                bands = registers(code, of, n).reshape(n, BANDS, PER_BAND)
                edges = pa.array(np.arange(n + 1, dtype=np.int32) * BANDS)
                halves = [
                    pa.ListArray.from_arrays(edges, pa.array(np.ascontiguousarray(x).view(kind).reshape(-1)))
                    for x, kind in ((bands[..., :4], np.int64), (bands[..., 4], np.int16))
                ]
                counts = [pa.array(x) for x in (np.bincount(of, minlength=n).astype(np.int64), total.view(np.int64), mixed.view(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(at, n), *counts, *halves],
                    ["doc_id", "n_shingles", "set_sum", "set_mix", "sketch", "fifth"]
                )

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(
        docs.select("doc_id", "text"), make,
        f"doc_id {kind}, n_shingles long, set_sum long, set_mix long, sketch array<long>, fifth array<short>"
    )


def _links(members: pa.Table, link: int) -> tuple[list[int], list[int]]:
    """Confirmed links between the rows of a block (doc_id, text, sketch, fifth, n_shingles, group, side): a spanning forest.
    Rows that share a ``group`` are linked already; with two sides, only rows of different sides are compared."""
    ids = members["doc_id"].to_numpy()
    n = len(ids)
    side, sizes = members["side"].to_numpy(), members["n_shingles"].to_numpy()
    four, fifth = (members[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("sketch", "fifth"))
    sketches = np.concatenate([four.view(np.uint16).reshape(n, -1), fifth.view(np.uint16).reshape(n, -1)], axis=1)
    _, group = np.unique(members["group"].to_numpy(), return_inverse=True)
    joined, first = Forest(n), {}
    root = joined.root
    for k in range(n):
        joined.join(first.setdefault(int(group[k]), k), k)
    label = np.array([root(k) for k in range(n)])
    whole = pa.record_batch([members["text"].combine_chunks()], ["text"])
    sets: list[np.ndarray] = [np.zeros(0, np.uint64)] * n
    known = np.zeros(n, bool)

    def load(rows: np.ndarray) -> None:
        for r in rows[~known[rows]]:
            for _, _, data, bounds in texts(whole.slice(r, 1), "text"):
                sets[r] = shingles(data, bounds)[0]
            known[r] = True

    u, v = [], []
    two = side.min() != side.max() if n else False
    for a in range(n):
        ahead = np.flatnonzero(
            (label != label[a]) & ((side > side[a]) if two else (np.arange(n) > a))
            & (100 * np.minimum(sizes, sizes[a]) >= link * np.maximum(sizes, sizes[a]))
        )
        if not len(ahead):
            continue
        ahead = ahead[estimate(sketches[a], sizes[a], sketches[ahead], sizes[ahead]) >= link / 100 - SLACK]
        if not len(ahead):
            continue
        load(np.append(ahead, a))
        lengths = np.array([len(sets[b]) for b in ahead])
        together = np.concatenate([sets[b] for b in ahead])
        place = np.minimum(np.searchsorted(sets[a], together), len(sets[a]) - 1)
        hit = np.add.reduceat((sets[a][place] == together).astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
        for b in ahead[100 * hit >= link * (len(sets[a]) + lengths - hit)]:
            if root(a) != root(int(b)):
                joined.join(a, int(b))
                u.append(int(ids[a]))
                v.append(int(ids[b]))
        label = np.array([root(k) for k in range(n)]) if u else label
    return u, v


def _confirm(docs: DataFrame, led: DataFrame, places: DataFrame, link: int, name: str) -> DataFrame:
    """Scratch table of the links (u, v) found in the blocks of ``places`` (cls, leader, group, block, first, last): a class meets
    the blocks first..last of its leader's family. It has BANDS leaders at most, whose places come to its text as one
    list; so a text goes through one shuffle by doc_id and one by blocks."""
    columns = ["leader", "group", "block", "first", "last"]
    lists = cut(
        places.groupBy(F.col("cls").alias("doc_id")).agg(F.collect_list(F.struct(*columns)).alias("places")), f"minhash-lists-{name}", "zstd"
    )
    bodies = some(docs.select("doc_id", "text"), lists.select("doc_id"), "left_semi").dropDuplicates(["doc_id"])
    sketches = some(led, lists.select("doc_id"), "left_semi").select("doc_id", "sketch", "fifth", "n_shingles").dropDuplicates(["doc_id"])
    whole = bodies.join(sketches, "doc_id").join(lists, "doc_id").withColumn("place", F.explode("places"))
    whole = whole.withColumn("other", F.explode(F.sequence("place.first", "place.last"))).select(
        "place.leader", F.least("place.block", "other").alias("low"), F.greatest("place.block", "other").alias("high"), "doc_id",
        "text", "sketch", "fifth", "n_shingles", "place.group", F.when(F.col("place.block") > F.col("other"), 1).otherwise(0).alias("side")
    )

    def links(group: pa.Table) -> pa.Table:
        u, v = _links(group, link)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    found = cut(whole.groupBy("leader", "low", "high").applyInArrow(links, "u long, v long"), f"minhash-links-{name}")
    drop(lists)
    return found


def _across(docs: DataFrame, led: DataFrame, placed: DataFrame, roots: DataFrame, link: int) -> DataFrame:
    """Links (u, v) between different blocks of a family, for families of several blocks of which some members are still apart."""
    several = cut(
        placed.where("blocks > 1").join(roots.select(F.col("u").alias("cls"), F.col("v").alias("root")), "cls", "left").select(
            "leader", "cls", "n_shingles", F.coalesce("root", "cls").alias("group")
        ),
        "minhash-several", "zstd"
    )
    per_group = several.groupBy("leader", "group").agg(F.count(F.lit(1)).alias("n"))
    largest = cut(
        per_group.groupBy("leader").agg(
            F.max(F.struct("n", "group"))["group"].alias("main"), F.count(F.lit(1)).alias("groups")
        ).where("groups > 1").select("leader", "main"),
        "minhash-largest"
    )
    apart = several.join(fits(largest), "leader").withColumn("rest", (F.col("group") != F.col("main")).cast("int")).drop("main")
    cuts = apart.groupBy("leader", "rest").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    cuts = cut(
        cuts.groupBy("leader").agg(
            F.coalesce(F.max(F.when(F.col("rest") == 1, F.col("blocks"))), F.lit(0)).alias("rests"),
            F.coalesce(F.max(F.when(F.col("rest") == 0, F.col("blocks"))), F.lit(0)).alias("mains")
        ),
        "minhash-cuts"
    )
    # blocks 0..rests-1 hold the rest, rests.. the largest component; a pair of blocks has at least one of the rest
    rest = F.col("rest") == 1
    own = F.when(rest, F.pmod(F.xxhash64("cls"), "rests")).otherwise(F.col("rests") + F.pmod(F.xxhash64("cls"), "mains"))
    last = F.when(rest, F.col("rests") + F.col("mains") - 1).otherwise(F.col("rests") - 1)
    again = apart.join(fits(cuts), "leader").select(
        "cls", "leader", "group", own.cast("int").alias("block"), F.lit(0).alias("first"), last.cast("int").alias("last")
    )
    found = _confirm(docs, led, again, link, "2")
    drop(several, largest, cuts)
    return found


def near_duplicates(docs: DataFrame, link: int = LINK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (long doc_id, text, ...).

    Documents with 100 * intersection >= ``link`` * union of their sets are linked; component_id is the least doc_id
    reachable. Null and empty texts and texts without words have no shingles and are linked with nothing. Rows of one
    doc_id count as one document (they should repeat one text; of different ones the one with the least set counts)
    and each give a row. A null doc_id has a null
    component_id and is kept. An empty table gives no rows; other columns are not read.
    """
    sketches = cut(sketch(docs), "minhash-sketches")
    keys = ["n_shingles", "set_sum", "set_mix"]
    usable = sketches.where("n_shingles > 0 and doc_id is not null")
    one_each = usable.groupBy("doc_id").agg(F.min(F.struct(*keys)).alias("k")).select("doc_id", "k.*")
    classes = cut(one_each.groupBy(*keys).agg(F.min("doc_id").alias("cls")), "minhash-classes")
    led = some(usable, classes.select(F.col("cls").alias("doc_id")), "left_semi")

    banded = led.select(
        F.col("doc_id").alias("cls"), F.posexplode(F.arrays_zip("sketch", "fifth")).alias("band", "r")
    ).where("r.sketch <> 0 or r.fifth <> 0").select("cls", "band", F.xxhash64("r.sketch", "r.fifth").alias("key"))
    leaders = cut(
        banded.groupBy("band", "key").agg(F.min("cls").alias("leader"), F.max("cls").alias("last")).where("leader < last").drop("last"),
        "minhash-leaders"
    )
    members = cut(
        banded.join(fits(leaders), ["band", "key"]).select("leader", "cls").distinct(), "minhash-pairs", "zstd"
    )  # leaders lead themselves
    pairs, members = members, cut(members.join(fits(classes.select("cls", "n_shingles")), "cls"), "minhash-members", "zstd")
    drop(leaders, pairs)
    sizes = members.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    sizes = cut(
        sizes.select(
            "leader",
            F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")
        ),
        "minhash-sizes"
    )
    placed = cut(
        members.join(fits(sizes), "leader").select(
            "leader", "cls", "n_shingles", "blocks", F.pmod(F.xxhash64("cls", "leader"), "blocks").cast("int").alias("block")
        ),
        "minhash-placed", "zstd"
    )
    drop(members, sizes)
    block = F.col("block")
    first = placed.select("cls", "leader", F.col("cls").alias("group"), "block", block.alias("first"), block.alias("last"))
    links = _confirm(docs, led, first, link, "1")
    roots = components(links, "minhash-1")

    more = _across(docs, led, placed, roots, link)
    drop(placed)
    if not more.isEmpty():
        roots = components(links.unionByName(more), "minhash-2")

    named = cut(
        classes.join(roots.select(F.col("u").alias("cls"), "v"), "cls", "left").select(*keys, F.coalesce("v", "cls").alias("component_id")),
        "minhash-named"
    )
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)  # beside the join: they may be very many
    out = sketches.where(~alone).select("doc_id", *keys).join(fits(named), keys, "left").select("doc_id", "n_shingles", "component_id")
    out = out.unionByName(sketches.where(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
