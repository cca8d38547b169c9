"""Mixing sources to target weights by hierarchical budgeting (DataFrame only).

The tree is domain > language > source.  Every inner node shares its budget
among its children by weight, and a child takes no more than its capacity
(tokens below it times ``max_epochs``).  What a child cannot take goes to its
siblings first; only when all children of a node are full does the node itself
take less, and its own siblings share the rest.  With children sorted by
capacity per weight this has a closed form: a child is full exactly when the
budget still covers filling every later sibling to the child's own level.  So
each level is one window over the tree's nodes, top down, in whole tokens
(shares are rounded down).

A leaf with budget b and n tokens gives ``b / n`` whole epochs and a token
prefix of the next one: the longest whose tokens stay within b.  What the
document after it would have overrun is not lost: at the end of each node the
unspent tokens of its children go to the one with room for them whose documents
are shortest on average (siblings first, then, level by level, the ancestors'
other children; if none has room for all, to the one with the most), whose
prefix grows.
So the mix misses its total by less than one document, and a leaf falls short
of its budget by less than its next document.

Each epoch has its own seeded order of documents.  The prefix is found without sorting a leaf: order keys are cut into buckets,
the bucket sums say which single bucket holds the end of the prefix, and only
that bucket is summed row by row.  The selection itself is then a comparison
with one threshold per leaf, so no text is shuffled.

Defined cases: NULL text has no tokens; NULL tree columns form their own
node; unlisted nodes weigh ``default_weight``; a weight of 0 takes nothing;
a document's place depends on its id and text, so only rows that repeat both
stand at the same place of every epoch and are selected together; a leaf without
tokens selects nothing; an empty table gives an empty result; input columns
keep their values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import WORD_PATTERN, all_but, fresh, quoted, text_of, written

#: More leaves than this are joined by shuffle instead of broadcast.
MAX_BROADCAST_LEAVES = 100_000
NULL_NODE = "\\N"


@dataclass(frozen=True)
class Mixture:
    """Parameters: integer weights per node of each level, the budget as
    a share of the corpus (``share_num / share_den``), epochs and seed."""

    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    default_weight: int = 1
    share_num: int = 3
    share_den: int = 5
    max_epochs: int = 2
    seed: int = 7
    rows_per_bucket: int = 4096


def token_count(text: str | Column) -> Column:
    """Words between ASCII white space."""
    return F.regexp_count(text_of(text), F.lit(WORD_PATTERN)).cast("long")


def identity(doc_id: Column, text: str | Column) -> Column:
    """What tells a row from others: its id and a digest of its text."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text_of(text).cast("binary")))


def order_key(seed: int, epoch: Column, ident: Column) -> Column:
    """Place of a document in an epoch: the first 60 bits of an MD5."""
    named = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), ident)
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def _weight(mix: Mixture, level: str) -> Column:
    listed = mix.weights.get(level, {})
    pairs = [x for name, w in listed.items() for x in (F.lit(name), F.lit(int(w)))]
    default = F.lit(mix.default_weight)
    return (F.coalesce(F.element_at(F.create_map(*pairs), F.col(level)), default) if pairs else default).cast("long")


def leaf_budgets(leaf_tokens: DataFrame, mix: Mixture) -> DataFrame:
    """Budgets of the leaves.  ``leaf_tokens``: the level columns (no NULLs),
    ``tokens``, ``docs``; adds ``cap`` (what the leaf can give) and ``budget``."""
    levels = list(mix.levels)
    taken = reduce(and_, [_weight(mix, level) > 0 for level in levels])
    nodes = leaf_tokens.withColumn("_cap", F.when(taken, F.col("tokens") * mix.max_epochs).otherwise(F.lit(0)))
    total, capacity = nodes.agg(F.sum("tokens"), F.sum("_cap")).first()
    budget = min((total or 0) * mix.share_num // mix.share_den, capacity or 0)
    nodes = nodes.withColumn("_budget", F.lit(budget).cast("long"))
    for depth, level in enumerate(levels):
        above, path = levels[:depth], levels[: depth + 1]
        children = (nodes.groupBy(*path).agg(F.sum("_cap").alias("_c"), F.first("_budget").alias("_b"))
                    .withColumn("_w", _weight(mix, level)))
        parent = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(1))
        by_level = parent.orderBy(F.when(F.col("_w") > 0, F.col("_c") / F.col("_w")).otherwise(F.lit(0.0)), level)
        upto = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        after = by_level.rowsBetween(1, Window.unboundedFollowing)
        children = (children.withColumn("_used", F.sum("_c").over(upto))
                    .withColumn("_later", F.coalesce(F.sum("_w").over(after), F.lit(0)))
                    .withColumn("_full", (F.col("_b") - F.col("_used")) * F.col("_w") >= F.col("_c") * F.col("_later")))
        full = F.when(F.col("_full"), F.col("_c")).otherwise(0)
        open_weight = F.when(F.col("_full"), 0).otherwise(F.col("_w"))
        children = (children.withColumn("_rest", F.col("_b") - F.sum(full).over(parent))
                    .withColumn("_open", F.sum(open_weight).over(parent))
                    .withColumn("_share", F.when(F.col("_full"), F.col("_c"))
                                .otherwise(F.expr("_w * _rest div greatest(_open, 1)"))))
        nodes = nodes.drop("_budget").join(children.select(*path, F.col("_share").alias("_budget")), path)
    return nodes.withColumnRenamed("_budget", "budget").withColumnRenamed("_cap", "cap")


def _prefixes(docs: DataFrame, leaves: DataFrame, mix: Mixture, small: bool) -> DataFrame:
    """``leaves`` with ``epochs`` (whole ones), ``threshold`` (largest order key
    of the next epoch's prefix, -1 for none) and ``selected`` tokens.  ``small``:
    the leaves may be broadcast.  ``leaves`` is used twice, so it is best read
    from a table."""
    levels, hinted = list(mix.levels), F.broadcast if small else (lambda df: df)
    leaves = (leaves.withColumn("epochs", F.expr("budget div tokens")).withColumn("rest", F.expr("budget % tokens"))
              # a power of two of equally wide buckets
              .withColumn("width", F.expr(
                  f"{1 << 60} div shiftleft(1L, cast(ceil(log2(docs div {mix.rows_per_bucket} + 1)) as int))")))
    placed = (docs.join(hinted(leaves.where("rest > 0").select(*levels, "epochs", "rest", "width")), levels)
              .withColumn("key", order_key(mix.seed, F.col("epochs") + 1, F.col("ident")))
              .withColumn("bucket", F.expr("key div width")))
    sums = placed.groupBy(*levels, "rest", "bucket").agg(F.sum("tokens").alias("n"))
    running = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the bucket in which the prefix ends: the first whose running sum exceeds the rest (there is one, as a leaf has more tokens)
    ends = (sums.withColumn("upto", F.sum("n").over(running)).where(F.col("upto") > F.col("rest"))
            .groupBy(*levels).agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")), "bucket").alias("e"))
            .select(*levels, F.col("e.bucket").alias("last"), F.col("e.before").alias("before")))
    inside = placed.join(hinted(ends), levels).where(F.col("bucket") == F.col("last"))
    by_key = Window.partitionBy(*levels).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = F.col("upto") <= F.col("rest")
    # with no key inside the last bucket, the prefix ends below that bucket
    found = (inside.withColumn("upto", F.col("before") + F.sum("tokens").over(by_key)).groupBy(*levels)
             .agg(F.coalesce(F.max(F.when(fits, F.col("key"))), F.max(F.expr("last * width - 1"))).alias("threshold"),
                  F.coalesce(F.max(F.when(fits, F.col("upto"))), F.max("before")).alias("taken")))
    return (leaves.join(found, levels, "left").withColumn("threshold", F.coalesce("threshold", F.lit(-1).cast("long")))
            .withColumn("selected", F.expr("epochs * tokens") + F.coalesce("taken", F.lit(0))).drop("rest", "width", "taken"))


def leaf_plan(docs: DataFrame, mix: Mixture) -> DataFrame:
    """Per leaf: ``planned`` and ``selected`` tokens, ``epochs`` (whole ones)
    and ``threshold`` (largest order key of the next epoch's prefix, -1 for
    none).  ``docs``: the level columns (no NULLs), ``ident``, ``tokens``."""
    levels = list(mix.levels)
    totals = docs.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = leaf_budgets(written(totals, "mix-totals"), mix).where("tokens > 0").withColumn("planned", F.col("budget"))
    leaves = written(leaves, "mix-leaves")
    small = leaves.count() <= MAX_BROADCAST_LEAVES
    plan = _prefixes(docs, leaves, mix, small).withColumn("unspent", F.col("budget") - F.col("selected"))
    for depth in reversed(range(len(levels))):
        plan = _pass_on(docs, plan, levels[:depth], mix, small)
    return written(plan, "mix-plan")


def _pass_on(docs: DataFrame, plan: DataFrame, above: list[str], mix: Mixture, small: bool) -> DataFrame:
    """What the leaves below each node ``above`` left unspent goes to one of
    them, which keeps what its next document would overrun."""
    parent = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(1))
    room = F.col("cap") - F.col("selected")
    pooled = (plan.withColumn("pool", F.sum("unspent").over(parent))
              .withColumn("fits", room >= F.col("pool"))
              .withColumn("takes", F.row_number().over(parent.orderBy(
                  F.col("fits").desc(), F.when(F.col("fits"), F.col("tokens") / F.col("docs")).otherwise(0.0), room.desc(), *mix.levels)) == 1)
              .withColumn("unspent", F.when(F.col("takes"), F.col("pool")).otherwise(F.lit(0).cast("long")))
              .withColumn("budget", F.when(F.col("takes"), F.least(F.col("selected") + F.col("pool"), F.col("cap"))).otherwise(F.col("selected"))))
    pooled = written(pooled.drop("pool", "fits"), "mix-pooled")
    grows = F.col("takes") & (F.col("budget") > F.col("selected"))
    columns = [c for c in plan.columns if c not in ("epochs", "threshold", "selected")]
    grown = _prefixes(docs, pooled.where(grows).select(*columns, F.col("selected").alias("had")), mix, small)
    grown = grown.withColumn("unspent", F.col("unspent") + F.col("had") - F.col("selected"))
    return pooled.where(~grows).select(*plan.columns).unionByName(grown.select(*plan.columns))


def bounded(leaves: DataFrame) -> DataFrame:
    """Broadcast a leaf table after counting it."""
    return F.broadcast(leaves) if leaves.count() <= MAX_BROADCAST_LEAVES else leaves


def node_of(col: str | Column) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(NULL_NODE))


def select_epochs(docs: DataFrame, plan: DataFrame, tree: Sequence[Column], mix: Mixture, id_col: str = "doc_id",
                  text_col: str = "text", epoch_col: str = "epoch") -> DataFrame:
    """The documents of every selected epoch: columns of ``docs`` and ``epoch``."""
    names = [fresh(docs, f"_mix_{level}") for level in mix.levels]
    epochs, threshold = fresh(docs, "_mix_epochs"), fresh(docs, "_mix_threshold")
    small = plan.select(*[F.col(lv).alias(n) for lv, n in zip(mix.levels, names)],
                        F.col("epochs").alias(epochs), F.col("threshold").alias(threshold))
    keep = all_but(docs, epoch_col)
    marked = docs.select("*", *[c.alias(n) for c, n in zip(tree, names)]).join(bounded(small), names)
    times = F.col(epochs) + F.when(
        order_key(mix.seed, F.col(epochs) + 1, identity(F.col(id_col), quoted(text_col))) <= F.col(threshold), 1).otherwise(0)
    epoch = fresh(marked, "_mix_epoch")
    return (marked.withColumn(epoch, times).where(F.col(epoch) > 0)
            .withColumn(epoch, F.explode(F.sequence(F.lit(1).cast("long"), F.col(epoch))))
            .select(*keep, F.col(epoch).alias(epoch_col)))


def mix_documents(docs: DataFrame, tree: Sequence[Column], mix: Mixture, id_col: str = "doc_id",
                  text_col: str = "text", epoch_col: str = "epoch") -> DataFrame:
    """The selected documents, a row per document and epoch."""
    nodes = [node_of(c) for c in tree]
    rows = written(docs.select(identity(F.col(id_col), text_col).alias("ident"), token_count(text_col).alias("tokens"),
                               *[c.alias(lv) for c, lv in zip(nodes, mix.levels)]), "mix-docs")
    return select_epochs(docs, leaf_plan(rows, mix), nodes, mix, id_col, text_col, epoch_col)


# -- the registered query and the pipeline's stage ------------------------

#: Sources are dealt to four domains by their number; weights favour the first.
MIXTURE = Mixture(weights={"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
                           "lang": {"en": 3, "de": 2, "fr": 2, "es": 2}})


def corpus_tree() -> list[Column]:
    number = F.regexp_extract(text_of("source"), "([0-9]{1,9})$", 1)
    domain = F.when(number != "", F.concat(F.lit("d"), (number.cast("long") % 4).cast("string"))).otherwise("other")
    return [domain, F.col("lang"), F.col("source")]


def op4_mixing(docs: DataFrame) -> DataFrame:
    domain, lang, source = corpus_tree()
    rows = docs.select("doc_id", "text", "lang", "source")
    mixed = mix_documents(rows, [domain, lang, source], MIXTURE)
    return mixed.select("doc_id", domain.alias("domain"), "lang", "source", token_count("text").alias("tokens"),
                        F.col("epoch").cast("long").alias("epoch"))
