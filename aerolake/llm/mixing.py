"""Mixing sources to target weights by hierarchical budgets.

Documents hang on the leaves of a tree (domain, language, source). A token
budget is handed down from the root in proportion to the weights; a child that
cannot use its share (it has too few tokens, counting a bounded number of
epochs) leaves the rest to its siblings by weight, and only what a whole
subtree cannot use goes to the siblings one level up. A leaf's budget is spent
on whole epochs and then on a prefix, by tokens, of the next epoch's seeded
order: the documents that start before the budget is used up.

The prefix is found without sorting a leaf as a whole: documents fall into
buckets by the seeded hash, bucket sums find the one bucket per leaf in which
the prefix ends, and only that bucket is ordered. Only Spark SQL functions
are used; documents are selected by comparing their hash with the leaf's cut.

Defined cases: a null text has no tokens; null languages and sources form the
leaf named by the empty string; names without a weight weigh 1, names of
weight 0 or less get nothing; a null id hashes as the empty string; rows of
one id are taken together; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialize

LEAF = ("domain", "lang", "source")
# Documents per bucket of a leaf's seeded order, and the number of leaves
# (about 100 bytes each) up to which they are broadcast.
BUCKET_DOCS, BROADCAST_LEAVES = 4096, 200_000


def weight_of(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for key, weight in weights.items():
        out = F.when(name == key, F.lit(weight)).otherwise(out)
    return out.cast("long")


def fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``budget`` of every node from its parent's ``given``, its ``weight`` and
    its capacity ``cap``; all integers. Siblings number far fewer than documents."""
    group = W.partitionBy(*parent)
    by_ratio = group.orderBy(F.col("cap") / F.col("weight"), name)
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    real = lambda c: c.cast("double")
    full = real(F.col("cap")) * real(after) <= real(F.col("given") - before) * real(F.col("weight"))
    nodes = nodes.withColumn("full", full)
    left = F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0))
    open_weight = F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))
    nodes = nodes.withColumns({"left": left, "open_weight": open_weight})
    nodes = nodes.withColumn("all_open", F.sum("open_weight").over(group))
    upto = F.sum("open_weight").over(group.orderBy(name))
    share = lambda w: F.when(w == F.col("all_open"), F.col("left")).otherwise(
        F.floor(real(F.col("left")) * real(w) / real(F.col("all_open"))))
    part = share(upto) - share(upto - F.col("open_weight"))
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(part)) \
        .drop("full", "left", "open_weight", "all_open")


def budgets(leaves: DataFrame, weights: list[dict[str, int]], total: Column, epochs: int) -> DataFrame:
    """``leaves`` (leaf columns, ``tokens``, ``docs``) with ``budget``."""
    nodes = leaves
    for level, table in zip(LEAF, weights):
        nodes = nodes.withColumn(f"w_{level}", weight_of(F.col(level), table))
    nodes = nodes.where(" and ".join(f"w_{level} > 0" for level in LEAF)).withColumn("cap", F.col("tokens") * epochs)
    given = nodes.agg(F.least(total, F.coalesce(F.sum("cap"), F.lit(0))).cast("long").alias("given")).first()[0]
    out = None
    for depth, level in enumerate(LEAF):
        path, parent = list(LEAF[:depth + 1]), list(LEAF[:depth])
        level_nodes = nodes.groupBy(*path).agg(F.sum("cap").alias("cap"), F.first(f"w_{level}").alias("weight"))
        level_nodes = level_nodes.withColumn("given", F.lit(given)) if out is None else \
            level_nodes.join(out.select(*parent, F.col("budget").alias("given")), parent)
        out = fill(level_nodes, parent, level)
    return leaves.join(out.select(*LEAF, "budget"), list(LEAF), "left") \
        .withColumn("budget", F.coalesce("budget", F.lit(0)).cast("long"))


def order_key(seed: str, epoch: Column, doc_id: Column) -> Column:
    return F.sha2(F.concat(F.lit(seed + ":"), epoch.cast("string"), F.lit(":"),
                           F.coalesce(doc_id.cast("string"), F.lit(""))), 256)


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_LEAVES else df


def mix(docs: DataFrame, domain: Column, weights: list[dict[str, int]], share: float = 0.6, epochs: int = 4,
        seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """Returns (documents, leaves).

    Documents: ``row`` (the input's row), ``domain``, ``n_tokens`` and ``copies``
    (how often the mixture takes the document, 0 if not at all). Leaves:
    tokens, documents and budget of each. The budget is ``share`` of all tokens.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    tagged = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(domain, F.lit("")).alias("domain"),
                         text("lang").alias("lang"), text("source").alias("source"), "doc_id", tokens.alias("n_tokens"))
    narrow = materialize(tagged.drop("row"), "mix-docs")
    leaves = narrow.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    total = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * share)).first()[0]
    leaves = budgets(leaves, weights, F.lit(total), epochs)
    empty = F.col("tokens") == 0
    leaves = materialize(leaves.withColumns({
        "whole": F.when(empty, F.lit(0)).otherwise(F.expr("budget div tokens")).cast("long"),
        "rest": F.when(empty, F.lit(0)).otherwise(F.expr("budget % tokens")).cast("long"),
        "buckets": F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_DOCS)).cast("long")}), "mix-leaves")
    keyed = narrow.join(_few(leaves.select(*LEAF, "whole", "rest", "buckets").where("rest > 0")), list(LEAF)) \
        .withColumn("key", order_key(seed, F.col("whole"), F.col("doc_id")))
    bucket = F.shiftrightunsigned(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("buckets"), 32)
    keyed = keyed.withColumn("bucket", bucket)
    sums = keyed.groupBy(*LEAF, "bucket", "rest").agg(F.sum("n_tokens").alias("size"))
    base = F.coalesce(F.sum("size").over(W.partitionBy(*LEAF).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # The bucket in which the prefix ends: the last to start before the budget is used up.
    ends = (sums.withColumn("base", base).where("base < rest").groupBy(*LEAF)
            .agg(F.max(F.struct("bucket", "base")).alias("last")).select(*LEAF, "last.*"))
    last = keyed.join(_few(materialize(ends, "mix-ends")), [*LEAF, "bucket"])
    order = W.partitionBy(*LEAF).orderBy("key", "doc_id", "n_tokens")
    before = F.col("base") + F.coalesce(F.sum("n_tokens").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cuts = last.withColumn("before", before).where("before < rest").groupBy(*LEAF).agg(F.max("key").alias("cut"))
    plan = materialize(leaves.select(*LEAF, "whole").join(cuts, list(LEAF), "left"), "mix-plan")
    key = order_key(seed, F.col("whole"), F.col("doc_id"))
    copies = F.col("whole") + F.coalesce((key <= F.col("cut")).cast("long"), F.lit(0))
    return tagged.join(_few(plan), list(LEAF)).select("row", *LEAF, "n_tokens", copies.alias("copies")), leaves
