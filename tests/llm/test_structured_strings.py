"""Strings built so that sums modulo powers of two would vanish: op2, op3 and op9 against brute force."""

import collections
import hashlib

import numpy as np
import pytest

from downfield.llm import common, minhash, quality_rules, suffix_dedup

from .test_operators import brute_components


def thue_morse(n, a="a", b="b"):
    """The first ``n`` (a power of two) letters of the word that repeats itself with the letters swapped."""
    word = a
    while len(word) < n * len(a):
        word += word.translate(str.maketrans({a: b, b: a})) if len(a) == 1 else word.replace(a, "\0").replace(b, a).replace("\0", b)
    return word


SIZES = [512, 1024, 2048, 4096, 8192]


@pytest.mark.parametrize("n", SIZES)
def test_hashes_of_structured_strings_differ(n):
    texts = [thue_morse(n), thue_morse(n, "b", "a"), thue_morse(n // 8, "abbabaab", "baababba"), thue_morse(n, "x", "y"), thue_morse(n, "y", "x")]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    edges = np.cumsum([0, *(len(t) for t in texts)])
    found = common.span_hash(common.prefix_hash(data), edges[:-1], edges[1:])
    assert len(set(found.tolist())) == len(set(texts))


def test_hashes_don_t_depend_on_the_place_nor_on_the_chunk(monkeypatch):
    data = np.random.default_rng(1).integers(0, 3, 5000).astype(np.uint8)
    start = np.arange(4000)
    plain = common.span_hash(common.prefix_hash(data), start, start + 900)
    monkeypatch.setattr(common, "_REDUCE", 700)
    assert (common.span_hash(common.prefix_hash(data), start, start + 900) == plain).all()
    shifted = common.prefix_hash(np.append(np.full(123, 9, np.uint8), data))
    monkeypatch.setattr(suffix_dedup, "_PIECE", 1000)
    assert (suffix_dedup._strings(data, 900)[:4000] == plain).all()
    assert (common.span_hash(shifted, start + 123, start + 1023) == plain).all() and len(np.unique(plain)) == 4000


def test_repeated_lines_and_words(spark):
    """Lines and words that are complements of each other aren't repeats; true repeats are."""
    lines = [f(n) for n in SIZES for f in (thue_morse, lambda n: thue_morse(n, "b", "a"))]
    text = "\n".join([*lines, "", lines[2], lines[2]])
    data = np.frombuffer(text.encode(), np.uint8)
    counts = quality_rules.base_counts(data, np.array([0, len(data)]))
    assert [int(c[0]) for c in counts] == [12, sum(map(len, lines)) + 2 * len(lines[2]), 0, 2, 0]
    windows = collections.Counter(zip(lines, lines[1:], lines[2:], strict=False))
    assert max(windows.values()) == 1


def test_near_copies_of_structured_documents(spark):
    docs = {k: f(n) for k, (n, f) in enumerate((n, f) for n in SIZES for f in (thue_morse, lambda n: thue_morse(n, "b", "a")))}
    docs |= {20 + k: " ".join([f(n), *(f"w{n}x{i}" for i in range(3))]) for k, (n, f) in enumerate((n, f) for n in SIZES for f in (thue_morse, lambda n: thue_morse(n, "b", "a")))}
    docs[40] = docs[3]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert found == brute_components(docs) and found[40] == (1, 3) and len({c for _, c in found.values()}) == 20


def brute_repeats(texts):
    seen, out = set(), {}
    for doc in sorted(texts):
        raw = texts[doc].encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(raw[k : k + 100])
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[doc] = (int(gone.sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("ranked", [10_000, 20])
def test_repeated_passages_of_structured_documents(spark, monkeypatch, ranked):
    """Also where names have more rows than a task ranks, so that strings go by two names."""
    monkeypatch.setattr(suffix_dedup, "RANKED_ROWS", ranked)
    docs = {k: f(512) for k, f in enumerate((thue_morse, lambda n: thue_morse(n, "b", "a")))}
    docs |= {10 + k: thue_morse(128, "a", "b") + f" own words of {k} " + thue_morse(256, "b", "a") for k in range(40)}
    docs[60] = thue_morse(1024, "c", "d") + thue_morse(1024, "d", "c")
    found = suffix_dedup.remove_repeats(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in found} == brute_repeats(docs)
