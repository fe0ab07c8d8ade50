"""Mixing sources to target weights by systematic sampling.

Within a source every document expects ``rate = target / source size`` copies. The
documents stand in a fixed order, the expected copies are prefix-summed, one offset
per source is added, and a document is emitted once per integer boundary that its
interval crosses. Ordering by size makes the taken words follow the target closely:
the copy error never exceeds one document at any point of the order.

The prefix sum is distributed: rows are range-partitioned by (source, size, key),
so a source that holds a third of all rows is spread over many tasks; per-partition
counts (sources x partitions rows) give each partition its start.

Defined cases: a null text has size 0; a null source is a source of its own, last
in order; sources of total size 0 get target 0 and nothing is taken; rows that
repeat an id are separate documents; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SEPARATOR, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_RATE = 2.0


def word_count(text: Column) -> Column:
    """Words of a text (null: 0): separators between the trimmed ends, plus one."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATOR, " ")
    t = F.trim(t)
    return F.when(t == "", F.lit(0)).otherwise(
        F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_rate: float = MAX_RATE) -> DataFrame:
    """Targets per source: shares by weight, stopped at ``max_rate`` x size.

    The excess of stopped sources is reshared by weight until none is above its
    limit; in closed form, target = min(limit, level * weight), where the level is
    the first one (sources by limit / weight) that the remaining sources can take.
    One row per source, so the unpartitioned windows below see sources, not documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count(F.lit(1)).alias("source_docs"))
           .withColumn("_n", F.row_number().over(order) - 1)
           .withColumn("_w", F.element_at(F.array(*map(F.lit, map(float, weights))),
                                          (F.col("_n") % len(weights) + 1).cast("int")))
           .withColumn("_limit", F.col("source_size") * F.lit(max_rate)))
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.col("_limit") / F.col("_w"), F.col("_n"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    on = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * F.lit(share)
              - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / F.sum("_w").over(on))
    per = per.withColumn("_level", level).withColumn(
        "_fits", F.when(F.col("_level") * F.col("_w") <= F.col("_limit"), F.col("_level")))
    # Levels rise up to the first that fits and fall after it: that one is the largest.
    common = F.max("_fits").over(everything)
    return per.withColumn("target", F.least(
        F.col("_limit"), F.coalesce(common * F.col("_w"), F.col("_limit")))).select(
        "source", "source_size", "source_docs", "target")


def _key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def offset(source: Column) -> Column:
    """A source's random offset in [0, 1), the same in every run."""
    digest = F.md5(F.coalesce(F.concat(F.lit("mix:"), source), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    # Written first: range partitioning reads its input twice, once for the bounds.
    narrow = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
                     "mix-sizes")
    order = ["source", "size", "_key", "doc_id"]
    placed = written(
        narrow.withColumn("_key", _key(F.col("doc_id")))
        .repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-order")
    targets = source_targets(placed, **options)
    counts = placed.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = (Window.partitionBy("source").orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("source", "_part",
                         F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    base = base.alias("b").join(targets.alias("t"), F.expr("b.source <=> t.source"))
    base = base.select("b.source", "_part", "_before", "source_size", "target")
    within = Window.partitionBy("source", "_part").orderBy(*order)
    ranked = placed.withColumn("_in", F.row_number().over(within))
    rows = ranked.alias("r").join(
        base.alias("b"), (F.col("r._part") == F.col("b._part"))
        & F.expr("r.source <=> b.source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank = F.col("_before") + F.col("_in")
    u = offset(F.col("r.source"))
    copies = (F.floor(rate * rank + u) - F.floor(rate * (rank - 1) + u)).cast("long")
    return (rows.select("r.doc_id", "r.source", "r.size", "source_size", "target",
                        copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as its copies say, same columns.

    Copies are joined back by document, not carried with the texts through the
    ordering. Rows that repeat (doc_id, source, size) are numbered, so each gets its
    own copies; only such rows pass a window.
    """
    keyed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", word_count(F.col("text")).alias("_size"))
    chosen = plan(docs, **options)
    pairs = (chosen.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
                            F.col("size").alias("_s"))
             .agg(F.count(F.lit(1)).alias("_same"), F.sum("copies").alias("_copies"))
             .where(F.col("_copies") > 0))
    joined = keyed.join(pairs, F.expr("doc_id <=> _id AND source <=> _source AND _size = _s"))
    single = joined.where("_same = 1").withColumn("_n", F.col("_copies"))
    same = Window.partitionBy("_id", "_source", "_s").orderBy(F.md5(F.coalesce("row.text", F.lit("")).cast("binary")))
    turn = F.row_number().over(same)
    repeated = joined.where("_same > 1").withColumn("_n", F.expr("_copies div _same") + F.when(
        turn <= F.expr("_copies % _same"), 1).otherwise(0))
    both = single.unionByName(repeated)
    return (both.where("_n > 0").withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
            .select("row.*"))
