"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import row_key, spread_hash, text_or_empty, word_count
from riskloom.session import pin

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # the mix is 3/2 of all words
CAP = 2  # no source, and no document, is taken more often
BUCKETS = 65_536


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP
) -> DataFrame:
    """(source, source_size, target) from rows with ``source`` and ``size``.

    Sources in code-point order, null last, weigh ``weights`` in turn. Targets are filled
    like connected vessels: a source stops at ``cap`` times its size and what it can't hold
    is shared again by weight. Sources filled up are those with the least size per weight,
    so one running sum over the sources finds them; all numbers but the last quotient are
    whole. The windows run over one row per source, never over documents.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Ordering by bytes is ordering by code points.
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    every, thriftiest = W.partitionBy(), W.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = thriftiest.rowsBetween(W.unboundedPreceding, -1)
    num, den = share
    filled = (
        sums.withColumn("_weight", weight.cast("long"))
        .withColumn("_ratio", F.col("source_size") / F.col("_weight"))
        .withColumns(
            {
                "_rest": F.lit(num) * F.sum("source_size").over(every)
                - F.lit(den * cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
                "_left": F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0)),
            }
        )
        # Full if its share of what is left would exceed what it can hold.
        .withColumn("_full", F.col("_weight") * F.col("_rest") >= F.lit(den * cap) * F.col("source_size") * F.col("_left"))
        .withColumn("_stop", F.min(F.when(~F.col("_full"), F.struct("_ratio", "_rest", "_left"))).over(every))
    )
    open_share = F.col("_weight") * F.col("_stop._rest") / (F.lit(den) * F.col("_stop._left"))
    target = F.when(F.col("_full"), (F.lit(cap) * F.col("source_size")).cast("double")).otherwise(open_share)
    return filled.select("source", "source_size", target.alias("target"))


def inclusions(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, class, copies, odds part, need) from rows with source, class, size, _whole.

    Documents of a source are taken the more often the longer they are: a document whose
    size has g binary digits is wanted min(``cap``, t * g) times, with t such that the
    wanted words add up to the source's ``_whole``. The whole part of that number are
    copies for certain, the rest is the inclusion probability ``p`` of one more; ``_need``
    are the words that these leave to be sampled. A source has at most 63 classes.
    """
    words = sizes.groupBy("source", "class").agg(F.sum("size").alias("words"), F.first("_whole").alias("_whole"))
    digits = F.col("class") + 1
    longest = W.partitionBy("source").orderBy(F.desc("class"))
    filled = (
        words.withColumn("_rest", F.col("_whole") - F.lit(cap) * F.coalesce(F.sum("words").over(longest.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_below", F.sum(digits * F.col("words")).over(longest.rowsBetween(W.currentRow, W.unboundedFollowing)))
        # Full if its share of what is left would exceed what it can hold.
        .withColumn("_full", digits * F.col("_rest") >= F.lit(cap) * F.col("_below"))
        .withColumn("_stop", F.max(F.when(~F.col("_full"), F.struct("class", "_rest", "_below"))).over(W.partitionBy("source")))
        .withColumn("_num", F.when(F.col("_full"), F.lit(cap)).otherwise(digits * F.col("_stop._rest")))
        .withColumn("_den", F.when(F.col("_full"), F.lit(1)).otherwise(F.col("_stop._below")))
        .withColumn("_copies", F.expr("_num div _den"))
        .withColumn("_p", (F.col("_num") - F.col("_copies") * F.col("_den")) / F.col("_den"))
    )
    need = F.col("_whole") - F.sum(F.col("_copies") * F.col("words")).over(W.partitionBy("source"))
    return filled.select(F.col("source").alias("_source"), F.col("class").alias("_class"), "_copies", "_p", need.alias("_need"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    cap: int = CAP,
    seed: str = "mix",
    buckets: int = BUCKETS,
) -> DataFrame:
    """How many words the mix takes of each document: doc_id, size, source_size, target, taken.

    Each document has inclusion odds of its own, which grow with its size (``inclusions``);
    whole copies are taken first. For the rest, documents are ranked by random odds over
    inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken in that order until the rest is
    filled; the sample's size is fixed in words, so the document at the edge gives only its
    first words and each source meets its target to the word. u is a hash of seed, doc_id
    and text: reruns agree whatever the partitioning.

    The edge is found without sorting a source: words are summed per (source, bucket of the
    rank), a running sum over at most ``buckets`` rows per source finds the bucket at the
    edge, and only its rows are ordered. A source with a third of all rows is a partial sum
    on every task, and rows without ids fall into buckets by their texts.

    Null texts have size 0 and give 0 words; a source without words has target 0; repeated
    rows are rows of their own that share their random number; an empty table gives an
    empty one; further columns are ignored.
    """
    size = word_count(text_or_empty())
    narrow = docs.select("doc_id", "source", size.alias("size"), spread_hash(row_key(), seed).alias("u"))
    digits = F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)
    narrow = pin(narrow.withColumn("class", (digits - 1).cast("int")), "mix-sizes")
    targets = pin(
        source_targets(narrow, weights, share, cap).withColumnRenamed("source", "_tsource").withColumn("_whole", F.floor(F.col("target") + 0.5)),
        "mix-targets",
    )
    aimed = narrow.join(targets, F.col("source").eqNullSafe(F.col("_tsource"))).drop("_tsource")
    plan = pin(inclusions(aimed.select("source", "class", "size", "_whole"), cap), "mix-plan")
    p = F.col("_p")
    rank = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    ranked = (
        aimed.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("class") == F.col("_class")))
        .withColumn("_rank", F.when((F.col("_need") > 0) & (F.col("size") > 0) & (p > 0), rank))
        .withColumn("_bucket", F.floor(F.col("_rank") / (1 + F.col("_rank")) * buckets))
    )
    upto = W.partitionBy("_bsource").orderBy("_bbucket").rowsBetween(W.unboundedPreceding, -1)
    edges = (
        ranked.filter(F.col("_rank").isNotNull())
        .groupBy(F.col("source").alias("_bsource"), F.col("_bucket").alias("_bbucket"))
        .agg(F.sum("size").alias("_words"), F.first("_need").alias("_bneed"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(upto), F.lit(0)))
        .filter((F.col("_before") <= F.col("_bneed")) & (F.col("_before") + F.col("_words") > F.col("_bneed")))
        .select("_bsource", "_bbucket", "_before")
    )
    joined = ranked.join(edges, F.col("source").eqNullSafe(F.col("_bsource")), "left")
    columns = ["doc_id", "size", "source_size", "target"]
    certain = F.col("_copies") * F.col("size")
    # Without an edge bucket the rest takes every ranked document, or there is no rest.
    sure = F.when(
        F.col("_rank").isNotNull() & (F.col("_bbucket").isNull() | (F.col("_bucket") < F.col("_bbucket"))), F.col("size")
    ).otherwise(0)
    at_edge = F.coalesce(F.col("_bucket") == F.col("_bbucket"), F.lit(False))
    inside = W.partitionBy("source").orderBy("_rank", "u", F.col("doc_id"), "size").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_need") - earlier))
    taken = lambda extra: (certain + extra).cast("long").alias("taken")
    return joined.filter(~at_edge).select(*columns, taken(sure)).unionAll(
        joined.filter(at_edge).select(*columns, taken(part))
    )


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix|' || md5(coalesce(doc_id::VARCHAR, '~') || '|' || coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM {docs}
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER o, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS lft
  FROM s WINDOW o AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, w * rest >= 4 * source_size * lft AS is_full FROM r
), stop AS (
  SELECT min(rest) FILTER (NOT is_full) AS rest, min(lft) FILTER (NOT is_full AND lft = m) AS lft
  FROM (SELECT *, max(lft) FILTER (NOT is_full) OVER () AS m FROM f)
), t AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN (2 * source_size)::DOUBLE ELSE (w * (SELECT max(rest) FROM f WHERE NOT is_full AND lft = stop.lft))::DOUBLE / (2 * stop.lft)::DOUBLE END AS target
  FROM f, stop
), a AS (
  SELECT d.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS whole, CASE WHEN size > 0 THEN len(bin(size)) ELSE 0 END AS g
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT source, g, sum(size)::BIGINT AS words, any_value(whole) AS whole FROM a GROUP BY source, g
), e AS (
  SELECT *, whole - 2 * coalesce(sum(words) OVER (PARTITION BY source ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(g * words) OVER (PARTITION BY source ORDER BY g DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS below FROM c
), h AS (
  SELECT *, g * rest >= 2 * below AS is_full FROM e
), i AS (
  SELECT h.*, CASE WHEN h.is_full THEN 2 ELSE h.g * o.rest END::BIGINT AS num, CASE WHEN h.is_full THEN 1 ELSE o.below END::BIGINT AS den
  FROM h LEFT JOIN (SELECT source, arg_max(rest, g) AS rest, arg_max(below, g) AS below FROM h WHERE NOT is_full GROUP BY source) o ON o.source IS NOT DISTINCT FROM h.source
), j AS (
  SELECT source, g, num // den AS copies, (num - (num // den) * den)::DOUBLE / den AS p, whole - sum((num // den) * words) OVER (PARTITION BY source) AS need FROM i
), k AS (
  SELECT a.*, copies, p, need, (u / (1 - u)) / (p / (1 - p)) AS rank FROM a JOIN j ON a.source IS NOT DISTINCT FROM j.source AND a.g = j.g
), q AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 AND need > 0 THEN greatest(0, least(size, need - coalesce(sum(size) OVER (PARTITION BY source, p > 0 AND size > 0
         ORDER BY rank, u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) ELSE 0 END AS extra
  FROM k
)
SELECT doc_id, size, source_size, target, (copies * size + extra)::BIGINT AS taken FROM q
"""
