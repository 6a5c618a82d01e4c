"""Prefix trie, token files and hard negatives against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from downfield.llm import negatives, prefix_trie, queries, token_files

# ---- prefix trie ----------------------------------------------------------------------------------------------------


def brute_trie(rows):
    said = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    said = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in said.items()}
    made = {}
    for conv, own in said.items():
        h = zlib.crc32(str(conv).encode()) % 9
        made[conv] = said.get(conv - conv % 5, [])[:h] + own[h:]
    nodes = collections.defaultdict(list)
    for conv, turns in made.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(conv)
    children = collections.Counter(k[:-1] for k in nodes if k)
    sums = collections.defaultdict(lambda: [0, 0])
    for key, convs in nodes.items():
        for d in range(len(key) + 1):
            sums[key[:d]][0] += children[key] == 0
            sums[key[:d]][1] += (len(convs) - 1) * len(key[-1][1].encode()) if key else 0
    out = set()
    for key, convs in nodes.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(key))
        parent = min(nodes[key[:-1]]) if key else None
        out.add((min(convs), len(key), parent, len(convs), children[key], *sums[key], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check_trie(turns):
    found = [tuple(r) for r in prefix_trie.conversation_trie(turns).collect()]
    expected = brute_trie([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert set(found) == expected and len(found) == len(expected)


TURNS = "conv_id long, turn long, role string, text string, depth string, a long, place string, h int"


def test_trie_of_odd_rows(spark):
    """Nulls, equal turns, repeated rows, absent and short openings, long texts, and columns with the operator's names."""
    rows = [(c, t, "user" if t % 2 else "assistant", f"says {t}" if t < 3 else f"says {t} {c % 3}") for c in range(60) for t in range(c % 11)]
    rows += [(61, None, None, None), (61, None, "user", None), (61, 2, "user", "x"), (61, 2, "user", "x"), (61, 2, "a", "y"), (None, 1, "user", "lost")]
    rows += [(73, 0, "user", "no opening"), (78, 5, "user", "é" * 200_000), (79, 5, "user", "é" * 200_000), (-4, 1, "user", "below nought"), (10**15, 1, "", "")]
    check_trie(spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], TURNS))
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_trie_in_small_blocks_with_hot_nodes(spark, monkeypatch):
    """Deep conversations over many blocks, a node of which very many are children, and ids in many pieces."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 8)
    monkeypatch.setattr(prefix_trie, "BROADCAST_ROWS", 20)
    rows = [(c, t, "user", "same" if t < 12 else f"{c % 90} {t}") for c in range(0, 500, 5) for t in range(12 + c % 4)]
    rows += [(7000, t, "user", f"deep {t}") for t in range(130)] + [(7005, t, "user", f"deep {min(t, 100)}") for t in range(120)]
    check_trie(spark.createDataFrame([(*r, None, 1, None, 2) for r in rows], TURNS))


# ---- token files ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_files.default_path())


def test_words_as_the_library_has_them(library):
    random.seed(5)
    with open(token_files.default_path(), encoding="utf-8") as f:
        encoder = token_files.ByteEncoder(f.read())
    pools = [[chr(c) for c in range(0x250)], list(" \n\t'srtvemldDMS a1!"), list("ab '  \x85\xa0\x1c\x1f12²³¼ªº__-"), list("日本 語é🙂's \n")]
    texts = ["".join(random.choice(pool) for _ in range(random.randint(0, 14))) for pool in pools for _ in range(1500)]
    texts += ["", "a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> x<|endoftext|", "x" * 5000, "ab " * 3000]
    for text, mine, other in zip(texts, encoder.encode(texts, [max(t.encode(), default=0) >= token_files.HIGH_BYTE for t in texts]), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert mine.tolist() == other.ids, repr(text)


@pytest.mark.parametrize("n, longest", [(1, 20), (2, 20), (5, 3), (300, 9), (3000, 14), (40_000, 20)])
def test_code_lengths_are_the_best_within_the_limit(n, longest):
    counts = np.random.default_rng(n).zipf(1.2, n).clip(1, 10**8)
    length = token_files.code_lengths(counts, longest)
    assert length.min() > 0 and length.max() <= longest and (2.0 ** -length.astype(float)).sum() <= 1
    if n <= 5:  # all lengths that make a code
        best = min(
            (sum(c * k for c, k in zip(counts, ks, strict=True)) for ks in np.ndindex(*(longest + 1,) * n)
             if min(ks) > 0 and sum(2.0**-k for k in ks) <= 1), default=None
        )
        assert (counts * length).sum() == best


@pytest.mark.parametrize("sizes", [[], [0], [1], [127, 128, 129, 0, 1, 1000], [5000], [1] * 300])
def test_blocks_decode_to_what_was_packed(sizes):
    rng, sizes = np.random.default_rng(3), np.array(sizes, np.int64)
    ids = rng.zipf(1.3, int(sizes.sum())).clip(1, 40_000)
    codes = token_files.Codes.of(token_files.code_lengths(np.bincount(np.append(ids, 7)), 17))
    data, checkpoints = codes.pack(ids, sizes)
    assert (codes.unpack(data, sizes, checkpoints) == ids).all() and len(checkpoints) == (-(-sizes // token_files.STEP)).sum()


def brute_files(texts, library):
    start, out = 0, {}
    for doc, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out[doc] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_token_files_of_the_table(spark, data, library):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect())
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op12_token_files(spark, data).collect()}
    assert found == brute_files(texts, library)


def test_token_files_of_odd_rows(spark, library, tmp_path):
    """Several files and blocks, nulls, repeated ids, long and foreign texts, clashing columns, an empty table."""
    rows = [(k, f"text {k} " * (k % 50)) for k in range(0, 400, 2)]
    rows += [(401, None), (402, ""), (403, "word " * 60_000), (404, "日本語 it's <|endoftext|> \n\n x"), (404, "日本語 it's <|endoftext|> \n\n x"), (None, "lost")]
    schema = "doc_id long, text string, ids string, start int, part int"
    docs = spark.createDataFrame([(*r, None, 1, 2) for r in rows], schema)
    token_files.write_ids(token_files.cut(token_files.encode_ids(docs), "test"), f"{tmp_path}/f", block=500, part=2000)
    assert spark.read.parquet(f"{tmp_path}/f/blocks").select("part").distinct().count() > 3
    found = token_files.read_ids(spark, f"{tmp_path}/f", ("ids", "ids_crc32")).orderBy("start").collect()
    start = 0
    for r, (doc, text) in zip(found, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens) == (doc, start, len(ids)) and np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.ids_crc32 == zlib.crc32(r.ids)
        start += len(ids)
    assert token_files.token_files(docs.limit(0)).count() == 0


# ---- hard negatives -------------------------------------------------------------------------------------------------


def brute_negatives(rows, every=50):
    usable = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable[i] = min(usable.get(i, (label, w := [int(np.floor(256 * float(x))) for x in v])), (label, w))
    out = []
    for i, (label, v) in usable.items():
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, o) for j, (o, w) in usable.items() if j != i and len(w) == len(v))
        for score, j in [(-s, j) for s, j, o in scored if o == label][:5]:
            fit = [(-s, n) for s, n, o in scored if o != label and 50 * score <= -100 * s <= 95 * score][:3]
            out += [(i, j, k + 1, n, score, s) for k, (s, n) in enumerate(fit)]
    return sorted(out)


def check_negatives(vectors, every=50):
    found = negatives.hard_negatives(vectors, F.col("vec_id") % every == 0).collect()
    expected = brute_negatives([tuple(r) for r in vectors.select("vec_id", "label", "embedding").collect()], every)
    assert sorted(tuple(r) for r in found) == expected
    return expected


VECTORS = "vec_id long, embedding array<float>, label int, v string, windows int, score string"


def test_negatives_of_odd_rows(spark):
    """Nulls, non-finite components, other lengths, repeated rows, ties, zero and negative scores, clashing columns."""
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(0, 0.2, 8).tolist(), int(k % 3)) for k in range(400)]
    rows += [(k, [0.25] * 8, k % 2) for k in range(400, 520)] + [(600 + k, [float(k % 3 - 1)] + [0.0] * 7, k % 4) for k in range(60)]
    rows += [(700, None, 1), (701, [None] + [0.1] * 7, 1), (702, [float("nan")] + [0.1] * 7, 1), (703, [float("inf")] * 8, 1), (704, [0.1] * 8, None)]
    rows += [(750, [0.5, 0.5], 1), (751, [0.5, 0.25], 1), (752, [0.5, 0.125], 0), (800, [], 1), (801, [], 1), (802, [], 0), (None, [0.1] * 8, 1)]
    rows += [(20, rows[20][1], rows[20][2]), (900, [3e5] * 8, 1), (901, [-3e5] * 8, 1), (902, [2.9e5] * 8, 0)]
    vectors = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)
    assert len(check_negatives(vectors, 10)) > 100
    assert negatives.hard_negatives(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        negatives.hard_negatives(spark.createDataFrame([(1, [3e18, 1.0], 1, "x", 1, "y")], VECTORS), F.col("vec_id") % 50 == 0)


def test_negatives_in_small_blocks(spark, monkeypatch):
    """Many blocks of rows and anchors; one vector that a third of the rows share."""
    for name, n in (("ROWS", 60), ("ANCHORS", 7), ("AT_ONCE", 3), ("FIRST", 4)):
        monkeypatch.setattr(negatives, name, n)
    rng = np.random.default_rng(6)
    rows = [(k, (rng.normal(0, 0.3, 16) if k % 3 else np.full(16, 0.2)).tolist(), int(k % 5 == 0)) for k in range(500)]
    check_negatives(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS), 20)
