"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame operations only.

Every source is cut into blocks of its permuted documents (the permutation is a digest of the doc_id). A source's
target gives an exact quota of block draws. A binary tree splits these quotas: at each node half of the draws go left,
and how many of each source is one multivariate hypergeometric sample, drawn source by source from counts alone. At the
leaves, the shards, each source has an exact count; its permuted draws are dealt to the shards in that order. So shards
hold disjoint blocks; :func:`mixed` brings the rows of a shard together and sorts them by a digest.

Defined results: null text or no word: size 0; null source is a source of its own, last in order; repeated rows (same
doc_id, source and size) share one fate; a null doc_id is a document like others; an empty table gives an empty result;
other columns are kept and never read (clashing names are safe: inner columns start with ``_mix_``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, fits, small, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Documents a block, and blocks a source at most: above, blocks hold more documents.
BLOCK_DOCS, BLOCKS = 512, 4096
#: How often the gap to a target is filled from the block where the quota ends.
FILLS = 3


def _digest(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws(":", *(F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("~")) for p in parts)))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From (source, n_docs, source_size) each source's ``target`` of words: weights repeat over the sources in code
    point order, null last; no target is above ``most`` times the source, what is over goes to the others by weight.

    Sources are sorted by cap / weight; those capped are a prefix of this order, so one pass of running sums finds the
    level at which the others share. The windows see one row a source.
    """
    every = W.partitionBy(F.lit(0))
    by_cap = every.orderBy("_mix_ratio", "_mix_rank")
    level = (
        F.lit(share) * F.sum("source_size").over(every) - F.coalesce(
            F.sum("_mix_cap").over(by_cap.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
        )
    ) / F.sum("_mix_weight").over(by_cap.rowsBetween(0, W.unboundedFollowing))
    ranked = sources.withColumn("_mix_rank", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
    weighed = (
        ranked.withColumn(
            "_mix_weight",
            F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_mix_rank") - 1) % len(weights) + 1)
        )
        .withColumn("_mix_cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("_mix_ratio", F.col("_mix_cap") / F.col("_mix_weight"))
    )
    levelled = weighed.withColumn("_mix_level", level).withColumn("_mix_full", F.col("_mix_level") > F.col("_mix_ratio"))
    first = F.min(F.when(~F.col("_mix_full"), F.struct("_mix_ratio", "_mix_rank", "_mix_level"))).over(every)["_mix_level"]
    return levelled.withColumn(
        "target", F.when(F.col("_mix_full"), F.col("_mix_cap")).otherwise(first * F.col("_mix_weight"))
    ).select("source", "n_docs", "source_size", "target")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out and planned once."""
    return F.transform(F.array(value), use)[0]


def _log_factorial(n: Column) -> Column:
    """By Stirling's series at n + 8, and the factors in between."""

    def series(x: Column) -> Column:
        stirling = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
        return stirling - F.log(reduce(lambda a, k: a * (x - float(k)), range(2, 8), x - 1.0))

    return _let(n + 8.0, series)


def hypergeometric(good: Column, total: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` out of ``total`` are among the ``good`` ones: the inverse of the distribution at ``u`` in
    [0, 1). All counts are longs; the work is in proportion to ``good``."""

    def step(s: Column, k: Column) -> Column:
        """From k - 1 to k, as long as the sum is not beyond u."""
        log = s["log"] + F.log((s["good"] - k + 1) * (s["draws"] - k + 1) / (k * (s["bad"] - s["draws"] + k)))
        more = _let(
            log,
            lambda x: F.struct(
                s["good"].alias("good"), s["bad"].alias("bad"), s["draws"].alias("draws"), s["u"].alias("u"),
                x.alias("log"), (s["sum"] + F.exp(x)).alias("sum"), k.alias("at")
            )
        )
        return F.when(s["sum"] > s["u"], s).otherwise(more)

    def walk(c: Column) -> Column:
        log = reduce(
            lambda a, n: a - _log_factorial(n),
            (c["at"], c["good"] - c["at"], c["draws"] - c["at"], c["bad"] - c["draws"] + c["at"]), F.lit(0.0)
        )
        log = log + reduce(
            lambda a, n: a + _log_factorial(n), (c["good"], c["bad"], c["draws"], c["good"] + c["bad"] - c["draws"]),
            F.lit(0.0)
        ) - _log_factorial(c["good"] + c["bad"])
        high = F.least(c["good"], c["draws"])
        steps = F.when(high > c["at"], F.sequence(c["at"] + 1, high)).otherwise(F.array().cast("array<bigint>"))
        first = _let(
            log,
            lambda x: F.struct(
                *(c[n].alias(n) for n in ("good", "bad", "draws", "u")), x.alias("log"), F.exp(x).alias("sum"),
                c["at"].alias("at")
            )
        )
        return F.aggregate(steps, first, step, lambda s: s["at"])

    bad = total - good
    low = F.greatest(F.lit(0).cast("long"), draws - bad)
    return _let(F.struct(good.alias("good"), bad.alias("bad"), draws.alias("draws"), u.alias("u"), low.alias("at")), walk)


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """The splitting tree: (shard, source, n) from (source, n), the numbers of draws. At a node the left half's draws of
    one source after the other are hypergeometric, given what the sources before have taken. A node is one row, with
    an array of one struct a source."""
    entry = F.struct(F.col("source"), F.col("n").cast("long").alias("n"))
    nodes = quotas.where("n > 0").agg(F.array_sort(F.collect_list(entry)).alias("parts")).withColumn("shard", F.lit(0))
    empty = F.array().cast(f"array<struct<source:{dict(quotas.dtypes)['source']},n:bigint,left:bigint>>")
    for level in range(max(0, (shards - 1).bit_length())):
        total, key = F.aggregate("parts", F.lit(0).cast("long"), lambda t, p: t + p["n"]), F.lit(f"{seed}/{level}")

        def draw(state: Column, part: Column) -> Column:
            digest = _digest(key, F.col("shard"), part["source"])  # noqa: B023  used at once
            u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
            left = hypergeometric(part["n"], state["total"], state["draws"], u)

            def after(taken: Column) -> Column:
                struct = F.struct(part["source"].alias("source"), part["n"].alias("n"), taken.alias("left"))
                return F.struct(
                    (state["total"] - part["n"]).alias("total"), (state["draws"] - taken).alias("draws"),
                    F.array_append(state["parts"], struct).alias("parts")
                )

            return _let(left, after)

        first = F.struct(total.alias("total"), F.floor(total / 2).cast("long").alias("draws"), empty.alias("parts"))
        drawn = nodes.select("shard", F.aggregate("parts", first, draw, lambda s: s["parts"]).alias("parts"))
        left = F.transform("parts", lambda p: F.struct(p["source"].alias("source"), p["left"].alias("n")))
        right = F.transform("parts", lambda p: F.struct(p["source"].alias("source"), (p["n"] - p["left"]).alias("n")))
        halves = [F.struct((F.col("shard") * 2 + side).alias("shard"), parts.alias("parts")) for side, parts in enumerate((left, right))]
        nodes = drawn.select(F.inline(F.array(*halves)))
    return nodes.select("shard", F.inline("parts")).where("n > 0")


def deal(draws: DataFrame, shards: int, seed: str) -> DataFrame:
    """Adds ``shard`` to (source, block, copy): the tree says how many draws of a source a shard gets, and the source's
    draws, permuted by a digest, fill the shards in turn. Windows see the draws of one source; a row is a block."""
    quotas = cut(split_quotas(draws.groupBy("source").agg(F.count(F.lit(1)).alias("n")), shards, seed), "mix-shards")
    upto = F.sum("n").over(W.partitionBy("source").orderBy("shard"))
    spans = quotas.select("source", "shard", (upto - F.col("n")).alias("_mix_from"), upto.alias("_mix_to"))
    place = F.row_number().over(W.partitionBy("source").orderBy(_digest(F.lit(seed), "source", "block", "copy"), "block", "copy"))
    placed = draws.withColumn("_mix_place", place)
    same = F.col("d.source").eqNullSafe(F.col("q.source")) & (
        F.col("d._mix_place") > F.col("q._mix_from")
    ) & (F.col("d._mix_place") <= F.col("q._mix_to"))
    return placed.alias("d").join(spans.alias("q"), same).select("d.source", "d.block", "d.copy", "q.shard")


def mix_sources(
    docs: DataFrame, shards: int = 16, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
    seed: str = "mix"
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with ``size``, ``source_size``, ``target``, ``shards`` (array of int: the
    shards that hold a copy; empty: not in the mix) and ``order_key``, by which a shard is shuffled. Columns of these five
    names are replaced, all others pass through.

    ``shards`` has to be a power of two.
    """
    docs = docs.withColumn("size", word_count("text")).withColumn("order_key", _digest(F.lit(seed), "doc_id"))
    units = cut(
        docs.groupBy(
            "doc_id", "source", "size", "order_key"
        ).agg(F.count(F.lit(1)).alias("rows")).withColumn("words", F.col("size") * F.col("rows")),
        "mix-units"
    )
    sources = cut(
        targets(units.groupBy("source").agg(F.sum("rows").alias("n_docs"), F.sum("words").alias("source_size")), weights, share, most),
        "mix-sources"
    )
    sources = small(
        sources.withColumn("blocks", F.least(F.lit(BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BLOCK_DOCS))).cast("long"))
        .withColumn("base", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
    )
    here = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    of = lambda other: F.col("u.source").eqNullSafe(F.col(f"{other}.source"))
    placed = (
        units.alias("u").join(sources.alias("s"), of("s")).select(
            "u.*", "s.source_size", "s.target", "s.base", "s.rest", F.floor(here * F.col("s.blocks")).alias("block")
        )
    )
    # quotas of blocks: whole blocks before the one in which the rest ends, and part of that one
    running = F.sum("block_words").over(W.partitionBy("source").orderBy("block"))
    blocks = placed.groupBy("source", "block", "base", "rest").agg(F.sum("words").alias("block_words")).withColumn("upto", running)
    blocks = cut(
        blocks.withColumn(
            "state",
            F.when(F.col("upto") <= F.col("rest"), "whole").when(
                F.col("upto") - F.col("block_words") <= F.col("rest"), "part"
            ).otherwise("none")
        ).withColumn("left_over", F.col("rest") - (F.col("upto") - F.col("block_words"))),
        "mix-blocks"
    )
    draws = blocks.withColumn(
        "copies", F.col("base") + (F.col("state") != "none").cast("long")
    ).withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).where("copies > 0")
    dealt = deal(draws.select("source", "block", "copy"), shards, seed)
    dealt = dealt.groupBy("source", "block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("dealt")
    )
    quota = small(
        cut(
            blocks.alias("u").join(dealt.alias("d"), of("d") & (F.col("u.block") == F.col("d.block")), "left")
            .select("u.source", "u.block", "u.state", "u.left_over", F.coalesce("d.dealt", F.array().cast("array<int>")).alias("dealt")),
            "mix-quota",
        )
    )
    unit = placed.alias("u").join(
        quota.alias("q"), of("q") & (F.col("u.block") == F.col("q.block"))
    ).select("u.*", "q.state", "q.left_over")
    unit = unit.withColumn("more", F.lit(False))
    part = unit.where("state = 'part'")
    for _ in range(FILLS):  # documents in order while they fit, then again what fits into the gap
        inside = W.partitionBy("source", "block")
        fit = ~F.col("more") & F.col("words").between(1, F.floor("left_over"))
        upto = F.sum(F.when(fit, F.col("words"))).over(inside.orderBy("order_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0))
        part = part.withColumn("_mix_now", fit & (upto <= F.col("left_over")))
        part = part.withColumn(
            "left_over",
            F.col("left_over") - F.coalesce(F.sum(F.when(F.col("_mix_now"), F.col("words"))).over(inside), F.lit(0))
        ).withColumn("more", F.col("more") | F.col("_mix_now")).drop("_mix_now")
    # the document nearest to the gap that is left, if it brings the source nearer to its target
    nearest = F.row_number().over(
        W.partitionBy("source", "block").orderBy(
            F.when(~F.col("more") & (F.col("words") > 0), F.abs(F.col("words") - F.col("left_over"))).asc_nulls_last(),
            "order_key", "doc_id", "size"
        )
    )
    part = part.withColumn("_mix_nearest", nearest).withColumn(
        "more", F.col("more") | ((F.col("_mix_nearest") == 1) & F.col("words").between(1, 2 * F.col("left_over")))
    ).drop("_mix_nearest")
    taken = cut(part.where("more").select(*(F.col(c).alias(f"_mix_t_{c}") for c in ("doc_id", "source", "size"))), "mix-taken")

    # texts meet only tables of sources and blocks; rows of blocks where a quota ends also those that are taken there
    facts = {"source_size": "source_size", "target": "target", "base": "_mix_base", "blocks": "_mix_blocks"}
    facts = small(sources.select(F.col("source").alias("_mix_source"), *(F.col(c).alias(n) for c, n in facts.items())))
    rest = small(quota.select(*(F.col(c).alias(f"_mix_q_{c}") for c in ("source", "block", "state", "dealt"))))
    rows = docs.drop("source_size", "target", "shards")
    kept = [*rows.columns, "source_size", "target"]
    rows = rows.join(facts, F.col("source").eqNullSafe(F.col("_mix_source"))).withColumn("_mix_block", F.floor(here * F.col("_mix_blocks")))
    rows = rows.join(rest, F.col("source").eqNullSafe(F.col("_mix_q_source")) & (F.col("_mix_block") == F.col("_mix_q_block")))
    less = F.slice("_mix_q_dealt", F.lit(1), F.col("_mix_base").cast("int"))
    plain = rows.where("_mix_q_state <> 'part'").select(
        *kept, F.when(F.col("_mix_q_state") == "whole", F.col("_mix_q_dealt")).otherwise(less).alias("shards")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_mix_t_{c}")) for c in ("doc_id", "source", "size")]
    ends = rows.where("_mix_q_state = 'part'").join(fits(taken.withColumn("_mix_t", F.lit(True))), same[0] & same[1] & same[2], "left")
    return plain.unionByName(ends.select(*kept, F.when(F.col("_mix_t"), F.col("_mix_q_dealt")).otherwise(less).alias("shards")))


def mixed(docs: DataFrame, pieces: int = 16, **options) -> DataFrame:
    """The mix itself: a row for each copy, its shard in ``shard``, each shard shuffled: its rows are dealt to ``pieces``
    ranges of ``order_key``, so that no task has to hold a shard, and sorted by it. Written ``partitionBy("shard")``, a
    shard's files in order of their first key are the shuffled shard."""
    copies = mix_sources(docs, **options).withColumn("shard", F.explode("shards")).drop("shards")
    piece = F.floor(F.conv(F.substring("order_key", 1, 4), 16, 10).cast("long") * pieces / (1 << 16))
    return copies.repartition("shard", piece).sortWithinPartitions("shard", "order_key", "doc_id")
