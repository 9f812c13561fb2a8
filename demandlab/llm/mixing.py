"""Mixing sources to target weights by hierarchical budgeting.

The levels (by default domain, language, source) form a tree; a leaf's supply
is its tokens times ``max_epochs``. A token budget is propagated from the root:
each node shares its budget among its children by weight, no child gets more
than the supply below it, and what a child can't take goes to its siblings by
their weights. As a node never receives more than its own supply, shortages
settle among siblings first and reach an ancestor's siblings only after that.

A leaf's stream is its rows in the order of epoch 0, then of epoch 1, and so on, each
epoch in its own seeded order; the leaf's quota is a prefix of that stream.
Whole epochs need no order. In the last one, rows are dealt to 4096 cells by
the leading digits of their order key, sums of cells find the cell in which
the quota ends, and only that cell is sorted: no leaf is gathered in one task.

Defined cases: NULL levels are the child ``''``; a child without a weight has
``default_weight``; children of weight 0 get nothing; NULL and empty texts have
no tokens and are never taken; rows that agree in the key columns tie and are
taken one after the other; empty tables give no rows. The columns of ``docs`` are
returned with ``epoch``, ``n_tokens`` and ``take_tokens`` (fewer than n_tokens
where the quota ends inside the row), which replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlab.llm.textcols import small
from demandlab.session import scratch_table

CELLS = 3  # hexadecimal digits


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def budgets(leaves: DataFrame, weights: DataFrame | None, budget: float, levels: int, max_epochs: int,
            default_weight: float = 1.0) -> DataFrame:
    """Quota of each leaf from rows (l1 .. ln, tokens); windows hold the children of one node."""
    names = [f"l{i + 1}" for i in range(levels)]
    path = lambda i: F.concat_ws("/", *names[:i])
    tree = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    given = None
    for i in range(1, levels + 1):
        nodes = tree.groupBy(*names[:i]).agg(F.sum("cap").alias("cap"))
        if given is None:
            nodes = nodes.withColumn("given", F.lit(float(budget)))
        else:
            nodes = nodes.join(given, names[:i - 1])
        nodes = nodes.withColumn("path", path(i))
        if weights is not None:
            nodes = nodes.join(weights.select("path", F.col("weight").cast("double")), "path", "left")
        else:
            nodes = nodes.withColumn("weight", F.lit(None).cast("double"))
        nodes = nodes.withColumn("weight", F.coalesce("weight", F.lit(float(default_weight))))
        parent = Window.partitionBy(*names[:i - 1]) if i > 1 else Window.partitionBy(F.lit(1))
        # a child is full when its supply per weight is below the level that the rest could reach
        up = parent.orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf"))), "path")
        after = F.col("given") - (F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
        rest = F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))
        full = (F.col("weight") > 0) & (F.col("cap") * rest <= F.col("weight") * after)
        nodes = nodes.withColumn("full", full)
        left = F.col("given") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(parent)
        share = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(parent)
        quota = F.when(F.col("full"), F.col("cap")).when(share > 0, F.least(F.col("cap"), F.greatest(left, F.lit(0.0)) * F.col("weight") / share)).otherwise(0.0)
        given = nodes.select(*names[:i], quota.alias("given"))
    return tree.join(given, names).select(*names, "tokens", F.floor(F.col("given") + F.lit(1e-6)).cast("long").alias("quota"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix_sources(docs: DataFrame, levels: dict[str, Column], weights: DataFrame | None, budget: float | None = None, share: float = 1.0,
                max_epochs: int = 3, seed: int = 7, tokens: Column | None = None, key: Column | None = None,
                broadcast_leaves: int = 200_000) -> DataFrame:
    """The rows taken, one per epoch that takes them.

    ``budget`` counts tokens; without it the budget is ``share`` times the tokens of
    ``docs``. ``key`` (a string) identifies a row in the seeded orders.
    """
    names = [f"l{i + 1}" for i in range(len(levels))]
    keep = [c for c in docs.columns if c not in ("epoch", "n_tokens", "take_tokens")]
    key = docs["doc_id"].cast("string") if key is None else key
    size = word_count(docs["text"]) if tokens is None else tokens
    part = docs.select(F.struct(*[docs[c] for c in keep]).alias("r"), F.coalesce(key, F.lit("")).alias("key"), F.coalesce(size, F.lit(0)).cast("long").alias("n"),
                       *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels.values(), strict=True)])
    leaves = part.groupBy(*names).agg(F.sum("n").alias("tokens"))
    if budget is None:
        budget = share * (leaves.agg(F.sum("tokens")).first()[0] or 0)
    quota = budgets(leaves, weights, budget, len(names), max_epochs).where("quota > 0 and tokens > 0") \
        .select(*names, F.floor(F.col("quota") / F.col("tokens")).cast("int").alias("whole"), (F.col("quota") % F.col("tokens")).alias("more"))
    quota = small(_written(quota, "quotas"), broadcast_leaves)
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole"), "key"))
    cells = part.where("n > 0").select(*names, "key", "n").join(quota.where("more > 0"), names).withColumn("cell", F.substring(order, 1, CELLS)) \
        .groupBy(*names, "cell", "more").agg(F.sum("n").alias("m"))
    run = Window.partitionBy(*names).orderBy("cell")
    ends = cells.withColumn("to", F.sum("m").over(run)).where((F.col("to") - F.col("m") < F.col("more"))) \
        .groupBy(*names).agg(F.max(F.struct("cell", (F.col("to") - F.col("m")).alias("before"))).alias("e")) \
        .select(*names, F.col("e.cell").alias("last"), F.col("e.before").alias("before"))
    # one row per leaf, written once: the rows themselves are not shuffled to meet it
    plan = small(_written(quota.join(ends, names, "left"), "leaves"), broadcast_leaves)
    rows = part.where("n > 0").join(plan, names).withColumn("o", order).withColumn("cell", F.substring("o", 1, CELLS))
    upto = F.when(F.col("last").isNotNull() & (F.col("cell") < F.col("last")), F.col("whole")).otherwise(F.col("whole") - 1)
    sure = rows.where(upto >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), upto))).withColumn("take", F.col("n"))
    here = Window.partitionBy(*names).orderBy("o", "key", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = rows.where("cell = last").withColumn("had", F.col("before") + F.sum("n").over(here) - F.col("n")).where("had < more") \
        .withColumn("epoch", F.col("whole")).withColumn("take", F.least(F.col("n"), F.col("more") - F.col("had")))
    cols = ["r.*", F.col("epoch").cast("int").alias("epoch"), F.col("n").alias("n_tokens"), F.col("take").alias("take_tokens")]
    return sure.select(*cols).union(edge.select(*cols))
