import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from downfield.llm import bpe, chat, language_id, media, minhash, mixing, quality_model, quality_rules, queries, suffix_dedup, url_filter
from tests.compare import assert_same

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, label int"


@pytest.fixture(scope="module")
def base(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def texts(base):
    return {r.doc_id: r.text for r in base.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long_text = "alpha beta gamma delta epsilon " * 4000
    rows = [
        (1, None, None, None, None, "x", 1), (2, "", "en", "a", 0, None, None), (3, "one two", "en", "a", 7, "y", 0), (3, "one two", "en", "a", 7, "y", 0), (None, "lost words here", "fr", None, None, None, None),
        (4, long_text, "en", "b", None, None, 1), (5, long_text, "en", "b", None, None, 1), (6, "\x0b \t\n", "de", "", 4, None, None), (
            7, "éÉ ñ ß Σ 日本語 🙂", None, "a", 1, None, None
        ), (8, "12 34 !!", "es", "c", 1, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, data, name):
    assert_same(spark, queries.QUERIES[name], queries.ORACLES[name], data)


# ---- near-duplicates ------------------------------------------------------------------------------------------------


def shingle_set(text):
    words = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(texts, link=85):
    sets, by = {d: shingle_set(t) for d, t in texts.items()}, collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for e, n in collections.Counter(e for x in s for e in by[x] if e < d).items():
            if 100 * n >= link * (len(s) + len(sets[e]) - n):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_minhash_finds_all_links_of_a_large_family(spark, monkeypatch):
    """Copies with ever more edits: chains, families over several blocks, and links across them."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 16)
    rng = np.random.RandomState(3)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for d in range(150):
        words = list(base) if d % 3 else texts[rng.choice(list(texts))].split() if texts else list(base)
        for k in rng.choice(len(words), rng.randint(0, 6), replace=False):
            words[k] = f"x{rng.randint(50)}"
        texts[d] = " ".join(words)
    out = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(texts)


def test_minhash_odd_rows(odd, none):
    out = minhash.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    by = {r.doc_id: r for r in out}
    assert by[1].n_shingles == by[2].n_shingles == by[6].n_shingles == 0 and by[2].kept and by[3].n_shingles == 1
    assert by[5].component_id == 4 and not by[5].kept and by[None].kept and by[None].component_id is None
    assert minhash.near_duplicates(none).count() == 0


def test_estimate_is_near_the_truth():
    rng = np.random.RandomState(0)
    common = rng.randint(0, 2**63, 850).astype(np.uint64)
    one, two = (np.unique(np.concatenate([common, rng.randint(0, 2**63, 75).astype(np.uint64)])) for _ in range(2))
    code = np.concatenate([minhash.mix64(one), minhash.mix64(two)])
    regs = minhash.registers(code, np.repeat([0, 1], [len(one), len(two)]), 2)
    assert abs(minhash.estimate(regs[0], len(one), regs[1:], np.array([len(two)]))[0] - 0.85) < 0.12


# ---- repeats --------------------------------------------------------------------------------------------------------


def brute_repeats(texts):
    seen, out = set(), {}
    for d in sorted(texts):
        raw = (texts[d] or "").encode()
        cover = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                cover[p] += 1
                cover[p + 100] -= 1
            seen.add(raw[p : p + 100])
        gone = np.cumsum(cover[:-1]) > 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[d] = (
            len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()),
            hashlib.sha256(kept).hexdigest()
        )
    return out


def test_repeats_match_brute_force(base, texts):
    out = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(base).collect()}
    assert out == brute_repeats(texts)


def test_repeats_within_a_document_and_hot_strings(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANKED_ROWS", 20)
    monkeypatch.setattr(suffix_dedup, "BATCH_STRINGS", 50)
    passage = "the quick brown fox jumps over the lazy dog and then it runs away from all of the other animals of the wood, " * 2
    texts = {
        d: f"{d} some text of its own {d * 7919} " + passage[: 60 + d * 3] + f" {d} end" for d in range(60)
    } | {100: "ab" * 300, 101: passage * 3}
    out = {
        r.doc_id: tuple(r)[1:]
        for r in suffix_dedup.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    }
    assert out == brute_repeats(texts)


def test_repeats_of_a_line_in_many_documents_meet_in_no_large_group(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANKED_ROWS", 20)
    kind, most = type(spark.range(1).groupBy("id")), []
    real = kind.applyInArrow

    def watched(self, *args):
        most.append(self.count().agg(F.max("count")).first()[0] or 0)
        return real(self, *args)

    monkeypatch.setattr(kind, "applyInArrow", watched)
    own = lambda d, k: hashlib.sha256(f"{d} {k}".encode()).hexdigest() * 2
    # windows around the line reach into each document's own text; every tenth document repeats some of that, too
    line = "This line of about seventy bytes stands in each and every document. "
    texts = {d: f"{own(d, 0)} {line}{own(d - (d % 10 == 1), 1)}" for d in range(200)} | {200: line * 3, 201: own(0, 0) + line * 3}
    out = {
        r.doc_id: tuple(r)[1:]
        for r in suffix_dedup.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    }
    assert out == brute_repeats(texts) and sum(r[1] > 0 for r in out.values()) > 20
    assert max(most) < 100


def test_seeds_of_a_long_text_in_segments(monkeypatch):
    data, bounds = np.random.RandomState(0).randint(97, 100, 5000).astype(np.uint8), np.array([0, 5000])
    starts = lambda found: sorted((int(n), int(p), s) for p, n, a, b in zip(*found, strict=True) for s in range(a, b + 1))
    whole = starts(suffix_dedup.seeds(data, bounds))
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    assert starts(suffix_dedup.seeds(data, bounds)) == whole and len(whole) == 4901


@pytest.mark.parametrize("collide", [False, True])
def test_ranking_compares_bytes(monkeypatch, collide):
    real, base = suffix_dedup._names, np.random.RandomState(1).randint(97, 99, 300).astype(np.uint8)
    if collide:
        monkeypatch.setattr(suffix_dedup, "_names", lambda data, length: real(data, length) & np.uint64(1))
    rows = [base[k % 7 : k % 7 + 110 + k % 5] for k in range(40)]
    lengths = np.array([len(r) for r in rows])
    who, begin, end, _ = suffix_dedup._rank(np.zeros(40, np.uint64), np.arange(40), np.zeros(40, int), lengths, np.concatenate(rows), 100)
    texts = {k: r.tobytes().decode() for k, r in enumerate(rows)}
    assert {
        k: sum(e - b for w, b, e in zip(who, begin, end, strict=True) if w == k) for k in texts
    } == {k: v[1] for k, v in brute_repeats(texts).items()}


def test_repeats_odd_rows(odd, none):
    out = suffix_dedup.remove_repeats(odd).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == odd.count() and by[5].n_removed == by[5].n_bytes and by[1].n_bytes == 0 and by[None].n_removed == 0
    assert 0 < by[4].n_removed < by[4].n_bytes
    assert suffix_dedup.remove_repeats(none).count() == 0


# ---- tokens ---------------------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, base, odd, none):
    library = Tokenizer.from_file(bpe.default_path())
    extra = spark.createDataFrame(
        [
            (k, t)
            for k, t in enumerate(
                [
                    "aaaaaaaaaa AAA <|endoftext|><|startoftext|> x <|endoftext|", "it's we'll I'D 'S 123 ٣٤",
                    "a" * 5000, "ab" * 3000, "İ ſ ﬁ ΑΣ Σ", "\U000323b0՘ x", "\x00​"
                ]
            )
        ],
        "doc_id long, text string"
    )
    for docs in (base, odd, extra):
        out = bpe.encode_documents(
            docs.select("text", F.col("text").alias("source_text")), ("n_tokens", "ids", "decoded", "ids_sha256")
        ).collect()
        assert len(out) == docs.count()
        for r in out:
            ids = library.encode(r.source_text or "", add_special_tokens=False).ids
            assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), library.decode(ids, skip_special_tokens=False))
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_documents(none).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(extra)).orderBy("doc_id").first()
    assert back.decoded.startswith("aaaaa")


def test_long_words_merge_like_the_library():
    library, encoder = Tokenizer.from_file(bpe.default_path()), bpe.Encoder(bpe.load_vocabulary(bpe.default_path()))
    rng = np.random.RandomState(0)
    letters = lambda kinds, n: "".join(rng.choice(list(kinds), n))
    for text in (
        letters("etaoinshrdlu", 700), letters("abcdefghijklmnopqrstuvwxyz", 100_000), letters("ab", 3000),
        "x " + "the" * 400 + " y", "é" * 900, "." * 2000
    ):
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


# ---- mixing ---------------------------------------------------------------------------------------------------------


def test_mix_meets_targets_and_shards_share_them(base):
    mix = mixing.mix_sources(base, shards=4).persist()
    rows = mix.groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.size("shards")).alias("taken"),
        F.sum("size").alias("size"), F.max("size").alias("most")
    ).collect()
    assert sum(r.target for r in rows) == pytest.approx(1.5 * sum(r.size for r in rows))
    assert all(r.target <= 2 * r.size + 1e-6 and abs(r.taken - r.target) <= max(0.04 * r.target, r.most / 2) for r in rows)
    assert mix.where(F.size("shards") > 2).count() == 0
    assert mixing.mixed(base, shards=4).count() == mix.agg(F.sum(F.size("shards"))).first()[0]
    assert sorted(map(str, mix.select("doc_id", "shards").collect())) == sorted(
        map(str, mixing.mix_sources(base, shards=4).select("doc_id", "shards").collect())
    )


def test_hypergeometric_has_its_moments(spark):
    n = lambda v: F.lit(v).cast("long")
    rows = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
    for good, total, draws in ((300, 1000, 500), (1, 9, 4), (7, 7, 3), (0, 5, 2), (5000, 9000, 4500)):
        x = np.array([r[0] for r in rows.select(mixing.hypergeometric(n(good), n(total), n(draws), F.col("u"))).collect()])
        share = good / total
        assert x.mean() == pytest.approx(draws * share, abs=0.1) and x.min() >= max(0, draws + good - total) and x.max() <= min(good, draws)
        assert x.var() == pytest.approx(draws * share * (1 - share) * (total - draws) / (total - 1), rel=0.05, abs=1e-9)


def test_quotas_are_split_exactly(spark):
    quotas = spark.createDataFrame([("a", 40), ("b", 7), (None, 3), ("c", 90), ("d", 0)], "source string, n long")
    out = mixing.split_quotas(quotas, 8, "s").collect()
    sources, shards = collections.Counter(), collections.Counter()
    for r in out:
        sources[r.source] += r.n
        shards[r.shard] += r.n
    assert sources == {"a": 40, "b": 7, None: 3, "c": 90} and set(shards.values()) <= {17, 18}
    assert mixing.split_quotas(quotas.limit(0), 8, "s").count() == 0


def test_mixed_shards_are_sorted_by_key(base):
    mix = mixing.mixed(base, shards=2, pieces=3)
    parts = collections.defaultdict(list)
    for r in mix.select(F.spark_partition_id().alias("part"), "shard", "order_key", "doc_id").collect():
        parts[r.part, r.shard].append((r.order_key, r.doc_id))
    assert all(keys == sorted(keys) for keys in parts.values()) and {s for _, s in parts} == {0, 1}


def test_deal_is_even_and_without_replacement(spark):
    draws = spark.range(64).select((F.col("id") % 3).cast("string").alias("source"), F.col("id").alias("block"), F.lit(0).alias("copy"))
    dealt = mixing.deal(draws, 8, "s")
    assert dealt.groupBy("shard").count().where("count = 8").count() == 8 and dealt.select("block").distinct().count() == 64


def test_mix_odd_rows(odd, none):
    out = mixing.mix_sources(odd, shards=2).collect()
    assert len(out) == odd.count() and all(len(r.shards) <= 2 for r in out)
    assert mixing.mix_sources(none).count() == 0


# ---- classifiers ----------------------------------------------------------------------------------------------------


def test_language_on_held_out_rows(spark, data, base, odd, none):
    out = queries.op7_language_id(spark, data).join(base.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95 and all(0 <= r.score <= 1 for r in out)
    model = language_id.fit_language(base, base.where("lang in ('fr', 'es')"))
    rows = language_id.predict_language(odd.withColumn("n", F.monotonically_increasing_id()), model).collect()
    assert len(rows) == odd.count() and all((r.lang_pred == "und") == (r.doc_id in (1, 2, 6, 8)) for r in rows)
    empty = language_id.fit_language(none, none)
    assert {r.lang_pred for r in language_id.predict_language(odd, empty).collect()} == {"und"}
    assert language_id.predict_language(none, model).count() == 0


def test_decide_matches_brute_force():
    model = language_id.LanguageModel(
        {"f": ["a", "b", "c"], "g": ["d"]}, [(None, "f", "g"), ("f", "a", "b"), ("f", "a", "c"), ("f", "b", "c")]
    )
    margins = np.random.RandomState(2).normal(size=(300, 4))
    margins[0] = 0  # ties
    lang, score = language_id.decide(model, margins)
    odds = lambda m: 1 / (1 + math.exp(-2 * m))
    for row, got, its_score in zip(margins, lang, score, strict=True):
        p = [odds(m) for m in row]
        if p[0] < 0.5:
            want, sure = "d", 1 - p[0]
        else:
            chance = {"a": [p[1], p[2]], "b": [1 - p[1], p[3]], "c": [1 - p[2], 1 - p[3]]}
            want = max("abc", key=lambda k: (sum(q > 0.5 for q in chance[k]), sum(chance[k])))
            sure = p[0] * min(chance[want])
        assert got == want and its_score == pytest.approx(sure)


def test_every_language_is_learned(spark, none):
    rows = [(k, "der hund und die katze" if k % 50 == 0 else "the dog and the cat", "de" if k % 50 == 0 else "en") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_language(docs, docs, sample=80)
    out = language_id.predict_language(docs, model).where("lang = 'de'").select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in out] == ["de"]


def auc(rows):
    rows = sorted(rows, key=lambda r: r[0])
    positive = [k for k, r in enumerate(rows, 1) if r[1] == 1]
    return (sum(positive) - len(positive) * (len(positive) + 1) / 2) / max(1, len(positive) * (len(rows) - len(positive)))


def test_rule_ensemble(spark, data, odd, none):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    rows = queries.op8_quality_classifier(spark, data).join(labels, "doc_id").where("held_out").select("score", "quality").collect()
    assert auc(rows) > 0.9
    model = quality_model.fit_rules(none, labels)
    assert model.constant == 0.5 and quality_model.score_rules(odd, model).count() == odd.count()
    rules = quality_model.paths(
        "  Tree 0 (weight 1.0):\n    If (feature 0 <= 2.0)\n     Predict: 0.0\n    Else (feature 0 > 2.0)\n     If (feature 1 <= 0.5)\n      Predict: 1.0\n     Else (feature 1 > 0.5)\n      Predict: 0.0\n",
        ["a", "b"]
    )
    assert [r.tests for r in rules] == [
        (("a", "<=", 2.0),), (("a", ">", 2.0),), (("a", ">", 2.0), ("b", "<=", 0.5)), (("a", ">", 2.0), ("b", ">", 0.5))
    ]


def brute_counts(text):
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    windows = collections.defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k : k + 3])].append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_rules_match_brute_force(spark, data, base, odd, none):
    model = quality_rules.fit_quality(base, spark.read.parquet(f"{data}/labels.parquet"))
    for docs in (base, odd):
        ids = docs.withColumn("source_text", F.col("text"))
        wanted = collections.Counter((r.doc_id, *brute_counts(r.text)) for r in ids.collect())
        out = quality_rules.score_quality(docs, model).collect()
        assert collections.Counter(tuple(r)[:6] for r in out) == wanted
        assert all(
            r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
            for r in out
        )
    good = quality_rules.score_quality(base, model).join(
        spark.read.parquet(f"{data}/labels.parquet"), "doc_id"
    ).select("score", "quality").collect()
    assert auc(good) > 0.9 and quality_rules.score_quality(none, model).count() == 0


def test_quality_on_held_out_rows(spark, data):
    data = data.replace("sf0.001", "sf0.01")  # some hundred labels
    base, labels = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    model = quality_rules.fit_quality(base, labels.where(~held))
    rows = quality_rules.score_quality(base, model).join(labels, "doc_id").where(held).select("score", "quality").collect()
    assert auc(rows) > 0.9
    # calibrated: mean score and share of good rows agree
    assert np.mean([r.score for r in rows]) == pytest.approx(np.mean([r.quality for r in rows]), abs=0.15)
    one_class = quality_rules.fit_quality(base, labels.where("quality = 1"))
    assert one_class.constant == 1.0


def test_rules_compile_to_what_they_say(spark, base, odd):
    """Scores of compiled columns against rules read one by one in Python, on real and on odd rows."""
    names = list(quality_model.statistics())
    rules = ((((names[0], ">", 3.0),), 1.5), (((names[1], "<=", 2.0), (names[0], "<=", 100.0)), -2.0), (((names[2], ">", 5.5),), 0.25))
    model = quality_model.RuleModel(tuple((quality_model.Rule(tests), weight) for tests, weight in rules), -0.5)
    for docs in (base, odd):
        texts = docs.select("doc_id", "text")
        facts = texts.withColumns({n: c for n, c in quality_model.statistics().items()}).collect()
        margin = lambda r: -0.5 + sum(
            w * all((r[c] > v) if op == ">" else (r[c] <= v) for c, op, v in tests) for tests, w in rules
        )
        want = collections.Counter((r.doc_id, round(1 / (1 + math.exp(-margin(r))), 9)) for r in facts)
        assert collections.Counter((r.doc_id, round(r.score, 9)) for r in quality_model.score_rules(texts, model).collect()) == want


def brute_rule(url):
    """Host, path and the longest rule that fits."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    path = tail[: min([k for k in (tail.find(c) for c in "?#") if k >= 0], default=len(tail))]
    rules = ("org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/")
    fits = [
        r
        for r in rules if (h := r.split("/", 1)[0]) and (host == h or host.endswith("." + h)) and path.startswith("/" + r.split("/", 1)[1])
    ]
    return host, path, max(fits, key=len, default=None)


def test_url_parts_match_brute_force(spark, data):
    seen = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url")
    odd = [
        None, "", "x", "http://", "http:///a", "://Q.ORG", "http://a.org?x://b.com/fr/", "http://com/fr/",
        "http://ÄB.com/de/", "http://h.org/" + "a/" * 50_000, "http://a.org#/x", "http://x.example.org/en/1"
    ]
    rows = seen.unionByName(spark.createDataFrame([(10**6 + k, u) for k, u in enumerate(odd)] * 2, "page_id long, url string"))
    want = collections.Counter((r.page_id, *brute_rule(r.url)) for r in rows.collect())
    assert collections.Counter((r.page_id, r.host, r.path, r.rule) for r in url_filter.judge_urls(rows).collect()) == want


def test_urls(spark, data):
    urls = [
        None, "", "nohost", "http://A.Example.org/es/x?y", "https://example.org/en/12", "http://x.org", "http://x.org/",
        "http://fr.com/fr/", "http://a.com/de/z#q", "http://evilexample.org/es/", "ftp://h.net:80?x=/a"
    ]
    pages = spark.createDataFrame([(k, u, None, "x") for k, u in enumerate(urls)], "page_id long, url string, html string, host string")
    seen = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html", F.lit("x").alias("host"))
    out = {r.page_id: r for r in url_filter.judge_urls(seen.where("page_id >= 1000").unionByName(pages)).collect()}
    assert [(out[k].host, out[k].path, out[k].rule) for k in range(11)] == [
        ("", "", None), ("", "", None), ("", "", None), (
            "a.example.org", "/es/x", "example.org/es/"
        ), ("example.org", "/en/12", "example.org/en/1"), ("x.org", "", None), ("x.org", "/", "org/"),
        ("fr.com", "/fr/", "com/fr/"), ("a.com", "/de/z", "com/de/"), ("evilexample.org", "/es/", "org/"), ("h.net:80", "", None),
    ]
    assert {r.verdict for r in out.values()} <= {"allow", "block"} and out[3].verdict == "block" and out[6].verdict == "allow"
    labelled = spark.createDataFrame(
        [(f"http://h{k}.net/{'1' * (k % 2 * 9 + 1)}", "block" if k % 2 else "allow") for k in range(200)],
        "url string, verdict string"
    )
    model = url_filter.fit_urls(labelled)
    judged = url_filter.judge_urls(labelled.select(F.lit(1).alias("page_id"), "url"), model, rules=()).groupBy("verdict").count().collect()
    assert {r.verdict: r["count"] for r in judged} == {"allow": 100, "block": 100}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


# ---- chat and media -------------------------------------------------------------------------------------------------


def test_chat_rotation(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, None, "?"),
        (2, 0, "system", "alone"), (None, 5000, "ann", "x" * 9)
    ]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, seq string")
    out = chat.rotate_perspectives(turns, block=2)
    whole = {(r.conv_id, r.perspective): r for r in chat.training_texts(out).collect()}
    assert set(whole) == {(1, "ann"), (1, "bob"), (None, "ann")}
    ann = whole[1, "ann"]
    assert ann.text == "<|im_start|>system\ns<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n" + "<|im_start|>user name=bob\n<|im_end|>\n" * 2 + "<|im_start|>user name=unknown\n?<|im_end|>\n"
    assert [ann.text[m.start : m.end] for m in ann.masks] == ["hi<|im_end|>"]
    assert [whole[1, "bob"].text[m.start : m.end] for m in whole[1, "bob"].masks] == ["<|im_end|>"] * 2
    assert chat.rotate_perspectives(turns.limit(0)).count() == 0


def picture(rng, side=140):
    """Soft noise of all scales under some rectangles and discs."""
    y, x = np.meshgrid(np.fft.fftfreq(side), np.fft.fftfreq(side), indexing="ij")
    out = np.fft.ifft2(np.fft.fft2(rng.normal(size=(side, side))) / np.maximum(np.hypot(y, x), 1 / side)).real
    out = out / out.std()
    yy, xx = np.mgrid[:side, :side]
    for k in range(12):
        cy, cx, h, w = *rng.randint(0, side, 2), *rng.randint(5, 40, 2)
        inside = (abs(yy - cy) < h) & (abs(xx - cx) < w) if k % 2 else (yy - cy) ** 2 + (xx - cx) ** 2 < h * h
        out[inside] += rng.normal() * 1.2
    return np.clip(128 + 45 * out, 0, 255).astype(np.uint8)


def turned(image, degrees):
    side = len(image)
    c, t = (side - 1) / 2, math.radians(degrees)
    y, x = np.mgrid[:side, :side] - c
    sy, sx = (np.clip(v, 0, side - 1.001) for v in (c + math.cos(t) * y + math.sin(t) * x, c - math.sin(t) * y + math.cos(t) * x))
    y0, x0 = sy.astype(int), sx.astype(int)
    a, b, v = sy - y0, sx - x0, image.astype(float)
    return (
        (v[y0, x0] * (1 - b) + v[y0, x0 + 1] * b) * (1 - a) + (v[y0 + 1, x0] * (1 - b) + v[y0 + 1, x0 + 1] * b) * a
    ).round().astype(np.uint8)


def edits(image, rng):
    shrunk = lambda x, f: media.resized(x[None], f)[0].round().astype(np.uint8)
    noisy = lambda x, s: np.clip(x + rng.normal(0, s, x.shape), 0, 255).astype(np.uint8)
    return {
        "brighter": np.clip(image * 0.8 + 20, 0, 255).astype(np.uint8), "turned by 90": np.rot90(image).copy(), "turned by 20": turned(image, 20), "noise 10": noisy(image, 10), "crop 100": image[20:120, 30:130],
        "crop 80": image[30:110, 50:130], "shrunk 1.2": shrunk(image, 1.2), "shrunk 1.5": shrunk(image, 1.5), "shrunk 2": shrunk(image, 2.0), "crop, shrunk": shrunk(image[20:120, 30:130], 1.25), "crop, noise": noisy(image[10:100, 20:110], 5),
    }


def rows_of(images):
    return [(k, x.shape[1], x.shape[0], bytearray(x.tobytes())) for k, x in images]


IMAGE = "media_id long, width int, height int, pixels binary"


def test_recall_of_edited_copies(spark):
    """Every edit is linked to its original, and nothing else is, in at least nine of ten cases; a common mark makes no copy."""
    rng, images, truth, kinds = np.random.RandomState(0), [], {}, {}
    mark = picture(rng, 48)
    for g in range(10):
        base = picture(rng)
        if g < 5:
            base[80:128, 80:128] = mark
        for k, (kind, image) in enumerate([("original", base), *edits(base, rng).items()]):
            truth[100 * g + k], kinds[100 * g + k] = 100 * g, kind
            images.append((100 * g + k, np.ascontiguousarray(image)))
    out = {r.media_id: r.component_id for r in media.image_copies(spark.createDataFrame(rows_of(images), IMAGE)).collect()}
    found = collections.Counter(kinds[k] for k in truth if out[k] == truth[k])
    assert all(found[kind] >= 9 for kind in set(kinds.values())), found
    assert all(out[k] in (truth[k], k) for k in truth)


def test_image_copies_odd_rows(spark):
    rng = np.random.RandomState(1)
    one, two = picture(rng, 100), picture(rng, 100)
    rows = [(*r, "x") for r in rows_of([(5, one), (7, one), (7, two), (3, two), (3, two)])]
    rows += [
        (90, None, 3, bytearray(b"abc"), None), (91, 5, 5, bytearray(b"x"), None), (92, 100, 100, bytearray(10000), ""),
        (None, 1, 1, bytearray(b"x"), "y"), (93, 2, 2, None, None)
    ]
    wide = np.tile(picture(rng, 200), (4, 40))  # larger than SIDE, with repeats of its own
    rows += [(*r, None) for r in rows_of([(95, wide), (96, np.ascontiguousarray(wide[:, :6000]))])]
    images = spark.createDataFrame(rows, IMAGE + ", component_id string")
    out = media.image_copies(images).collect()
    assert len(out) == len(rows)
    by = {r.media_id: r for r in out}
    assert by[5].component_id in (5, 3) and by[3].component_id == 3 and by[7].component_id in (3, 5) and not by[7].kept
    assert all(by[k].component_id == k and by[k].n_corners == 0 and by[k].kept for k in (None, 90, 91, 92, 93)) and by[95].n_corners > 0
    assert media.image_copies(images.limit(0)).count() == 0


def brute_components_of_images(packs):
    """All pairs by the definition: MET matches that share a word in one cell of two grids, then one geometry."""
    points = {r.media_id: np.frombuffer(bytes(r.points), media.POINT) for r in packs}
    size, parent, links = {r.media_id: (r.wide, r.tall) for r in packs}, {m: m for m in points}, 0

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u in points:
        for v in (v for v in points if v > u):
            cells = collections.defaultdict(list)
            for a in points[u]:
                for b in points[v]:
                    words = [int(p) ^ int(q) for p, q in zip(a["bits"], b["bits"], strict=True)]
                    if 0 in words and sum(w.bit_count() for w in words) <= media.HAMMING:
                        turn = ((int(b["turn"]) - int(a["turn"])) % 256 * media.TURNS + 128) // 256 % media.TURNS
                        r, s, c = media.SCALES[b["level"]] / media.SCALES[a["level"]], math.sin(
                            turn * 2 * math.pi / media.TURNS
                        ), math.cos(turn * 2 * math.pi / media.TURNS)
                        dx, dy = int(b["x"]) - r * (
                            int(a["x"]) * c - int(a["y"]) * s
                        ), int(b["y"]) - r * (int(a["x"]) * s + int(a["y"]) * c)
                        for g in (0, 0.5):
                            unit = media.SHIFT * media.UNITS
                            cells[
                                turn, int(b["level"]) - int(a["level"]), g, math.floor(dx / unit + g),
                                math.floor(dy / unit + g)
                            ].append(((a["x"], a["y"]), (b["x"], b["y"])))
            met = any(len(c) >= media.MET and len({p for p, _ in c}) > 1 and len({q for _, q in c}) > 1 for c in cells.values())
            if met and media.same_picture(points[u], points[v], size[u], size[v]):
                links += 1
                parent[max(root(u), root(v))] = min(root(u), root(v))
    return {m: root(m) for m in points}, links


@pytest.mark.parametrize(("hot", "pairs"), [(0, 50), (12, 1 << 18), (10**6, 1 << 18)])
def test_image_copies_of_hot_keys_match_brute_force(spark, data, monkeypatch, hot, pairs):
    monkeypatch.setattr(media, "HOT", hot)
    monkeypatch.setattr(media, "BLOCK_CORNERS", 400)
    monkeypatch.setattr(media, "PAIRS", pairs)
    vectors = [list(r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").orderBy("vec_id").limit(8).collect()]
    vectors += [v[:-8] + [-x for x in v[-8:]] for v in vectors[:3]] + vectors[:3]  # copies with another last row, and equal ones
    vectors += [v[:-8] + [x * s for x in v[-8:]] for v in vectors[:2] for s in (-3, -0.5, 0, 0.5, 3)]
    images = media.vector_images(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).cache()
    wanted, links = brute_components_of_images(media.describe(images).collect())
    assert links > 9
    assert {r.media_id: r.component_id for r in media.image_copies(images).collect()} == wanted
