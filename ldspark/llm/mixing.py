"""Mixing sources to target weights by hierarchical budgeting.

A budget of tokens is propagated through a tree of sources, level by level. A node that holds less than its share
gives what it lacks to its siblings by their weights; only what a whole family lacks goes to the families beside
it. Each leaf then takes a prefix of its tokens in a seeded order, in as many epochs as its target needs.
Everything is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE, text_of, unpack, whole_row, write_scratch

BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Level:
    """One level of the tree: the value a document has there (null counts as empty), and the whole-number weights
    of values among their siblings. A value of weight zero is never taken."""

    name: str
    value: Column
    weights: dict[str, int] = field(default_factory=dict)
    default_weight: int = 1

    def weight(self) -> Column:
        chosen = F.lit(self.default_weight)
        for value, weight in sorted(self.weights.items()):
            chosen = F.when(F.col(self.name) == value, F.lit(weight)).otherwise(chosen)
        return chosen.cast("long")


def word_count(text: Column) -> Column:
    """Words between white space, from the length of the collapsed text with and without its spaces."""
    norm = F.trim(F.regexp_replace(text, SPACE, " "))
    return F.when(norm == "", F.lit(0)).otherwise(
        F.octet_length(norm) - F.octet_length(F.replace(norm, F.lit(" "), F.lit(""))) + 1
    ).cast("long")


def share(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """``nodes`` (with the parent's ``budget``, a positive ``weight``, ``capacity``) and their ``target``: the
    budget, which is at most the sum of capacities, dealt to the parent's children by weight, none above its
    capacity, exact in whole tokens.

    Children are met in the order of capacity per weight. One is filled if an even share of what is left would be
    more; the others divide the rest, each from the rounded-down running share before it to the one at it. The
    windows are over nodes of the tree, never over documents.
    """
    family = Window.partitionBy(*(parents or [F.lit(0)]))
    order = family.orderBy(F.col("capacity") / F.col("weight"), name)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.greatest(F.col("budget") - F.sum("capacity").over(upto) + F.col("capacity"), F.lit(0).cast("long"))
    full = F.col("capacity").cast("decimal(20,0)") * F.sum("weight").over(onward).cast("decimal(18,0)") <= left.cast(
        "decimal(20,0)"
    ) * F.col("weight").cast("decimal(18,0)")
    open_weight = F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))
    marked = nodes.withColumn("full", full).withColumns(
        {
            "open_budget": F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(F.lit(0))).over(family),
            "open_weights": F.sum(open_weight).over(family),
            "open_upto": F.sum(open_weight).over(upto),
        }
    )
    dealt = F.expr(
        "CAST(open_budget AS decimal(20,0)) * CAST(open_upto AS decimal(18,0)) div CAST(open_weights AS decimal(18,0))"
        " - CAST(open_budget AS decimal(20,0)) * CAST(open_upto - weight AS decimal(18,0)) div CAST(open_weights AS decimal(18,0))"
    )
    target = F.when(F.col("full"), F.col("capacity")).otherwise(dealt).cast("long")
    return marked.withColumn("target", target).select(*nodes.columns, "target")


def leaf_targets(leaves: DataFrame, levels: list[Level], budget: int, max_epochs: int) -> DataFrame:
    """``leaves`` (level columns, ``tokens``) with ``target``; the targets sum to the budget, or to all that the
    leaves can give in ``max_epochs`` epochs where that is less."""
    names = [level.name for level in levels]
    taken = F.lit(True)
    for level in levels:
        taken = taken & (level.weight() > 0)
    leaves = leaves.withColumn("capacity", F.when(taken, F.col("tokens") * max_epochs).otherwise(F.lit(0)))
    total = leaves.agg(F.coalesce(F.sum("capacity"), F.lit(0))).first()[0]
    above = None
    for k, level in enumerate(levels, start=1):
        nodes = leaves.groupBy(*names[:k]).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(min(budget, total)).cast("long"))
        else:
            nodes = nodes.join(above, names[: k - 1])
        nodes = nodes.withColumn("weight", F.greatest(level.weight(), F.lit(1)))
        dealt = share(nodes, names[: k - 1], level.name)
        above = dealt.select(*names[:k], F.col("target").alias("budget"))
    return dealt.select(*names, "tokens", "target")


def _order_key(seed: int, epoch: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)


def mix(
    docs: DataFrame,
    levels: list[Level],
    budget_percent: int | None = None,
    budget: int | None = None,
    max_epochs: int = 1,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """``row`` (all columns of the input), ``id``, the level columns, ``n_tokens``, ``epoch``, ``target``: one row
    for every document and epoch it is taken in.

    * The budget is a number of tokens or a percentage of all tokens there are; tokens are words.
    * A leaf whose target is e times its tokens and some more is taken whole in epochs 0 to e-1. In epoch e its
      documents are met in the order of a hash of seed, epoch and identifier, and taken until the target is
      reached; the document that reaches it is the last. Rows that repeat an identifier are taken together.
    * Null levels count as the empty value, null text as no tokens; an empty table gives no rows; other columns
      are carried as they are.
    * However many documents a leaf has, its running sum is cut in two steps: sums by the first hex digits of the
      order, then only the documents of the digits where the target falls, summed by order key. The documents
      themselves meet one row per leaf and are not shuffled while the leaves are few.
    """
    names = [level.name for level in levels]
    values = [F.coalesce(level.value.cast("string"), F.lit("")).alias(level.name) for level in levels]
    counted = docs.select(F.col(id_col).alias("id"), *values, word_count(text_of(text_col)).alias("tokens"))
    slim = write_scratch(counted, "tokens")
    leaves = write_scratch(slim.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "leaves")
    if budget is None:
        budget = (leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0] * budget_percent) // 100
    epochs = write_scratch(
        leaf_targets(leaves, levels, budget, max_epochs)
        .where("target > 0")
        .withColumn("whole", F.expr("target div tokens"))
        .withColumn("rest", F.col("target") % F.col("tokens"))
        .select(*names, "target", "whole", "rest"),
        "leaf-targets",
    )
    keyed = (
        slim.join(epochs.where("rest > 0"), names)
        .withColumn("key", _order_key(seed, F.col("whole")))
        .withColumn("bucket", F.left("key", F.lit(bucket_digits)))
    )

    def reached(parts: DataFrame, column: str) -> DataFrame:
        """The part of each leaf in which the running sum reaches what is needed, and the sum before it."""
        upto = F.sum("tokens").over(Window.partitionBy(*names).orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (
            parts.withColumn("upto", upto)
            .where((F.col("upto") >= F.col("needed")) & (F.col("upto") - F.col("tokens") < F.col("needed")))
            .select(*names, F.col(column), (F.col("needed") - F.col("upto") + F.col("tokens")).alias("still"))
        )

    buckets = keyed.groupBy(*names, "bucket").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("needed"))
    within = keyed.join(reached(buckets, "bucket"), [*names, "bucket"])
    keys = within.groupBy(*names, "key").agg(F.sum("tokens").alias("tokens"), F.first("still").alias("needed"))
    cuts = reached(keys, "key").select(*names, F.col("key").alias("cut"))
    plan = write_scratch(epochs.join(cuts, names, "left").select(*names, "target", "whole", "cut"), "mixture")
    return (
        docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), *values, word_count(text_of(text_col)).alias("n_tokens"))
        .join(plan, names)
        .withColumn("partial", F.coalesce(_order_key(seed, F.col("whole")) <= F.col("cut"), F.lit(False)))
        .withColumn("epochs", F.col("whole") + F.col("partial").cast("long"))
        .where("epochs > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
        .select("row", "id", *names, "n_tokens", "epoch", "target")
    )


def mixed_documents(docs: DataFrame, levels: list[Level], **options) -> DataFrame:
    """The documents of the mixture with their columns, once for every epoch they are taken in."""
    return unpack(mix(docs, levels, **options), "row", docs.columns)
