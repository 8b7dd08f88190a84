"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A document's size is its number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0). Targets: the budget is shared by weight; a
source stops at REPEATS times its size and the excess is shared again by weight until no target is above.

Each source is laid out as REPEATS passes over its documents in an order given by a keyed hash, and cut into blocks of
about BLOCK_WORDS words; a document belongs to the block that holds its middle, so the blocks up to the target hold the
target's words to within half a document. The blocks are dealt to output shards by a binary tree: a node splits its
vector of block quotas per source into a multivariate-hypergeometric draw for the left half of its shards and the rest
for the right half, seeded by the node, so every shard gets its exact number of blocks with the composition that
shuffling all blocks would give. A shard draws the next quota of blocks of each source's order, so draws are disjoint;
its documents are shuffled locally, by hash.

The tree works on one row per source; it is cut into subtrees that tasks expand alone, each repeating the draws on
its path from the root. Running sums go by hash ranges of bounded size, so a source with a third of all rows is never one
task's, and reruns agree (the hash, not the partitioning, decides).

Rows alike in doc_id, source and size are drawn together. Null doc_id and null source are values like others (null last
among sources). Documents without words are never drawn. An empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import read_table, staged

BUDGET = 1.5
REPEATS = 2
WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 1 << 16
#: Output shards: one for each SHARD_WORDS words of the mix, but no fewer than SHARDS.
SHARDS = 64
SHARD_WORDS = 1 << 25
#: Documents that one hash range of a source holds, about.
RANGE = 20_000
SEED = 11
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``rank`` from 0 in a total order: a range sort, then offsets by partition (one number a partition)."""
    s = staged(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    before = s.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    offset = before.withColumn("_before", F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    joined = s.withColumn("_part", part).join(offset.select("_part", "_before"), "_part")
    return joined.withColumn("rank", F.coalesce("_before", F.lit(0)) + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_before", "_at")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, docs, target) from (source, source_size, docs). Each round sets the sources above their cap to it and
    shares the rest; a round is one aggregate, and only its sums reach the driver."""
    w = F.element_at(F.array(*(F.lit(x) for x in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    s = staged(ranked(sizes, F.asc_nulls_last("source")).withColumn("w", w).withColumn("cap", F.col("source_size") * repeats), "sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        capped = F.col("cap") < F.col("w") * F.lit(level)
        row = s.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0)), F.sum(F.when(~capped, F.col("w")).otherwise(0))).first()
        new = (budget * total - (row[0] or 0)) / row[1] if row[1] else level
        if new <= level:
            return s.select("source", "source_size", "docs", F.least(F.col("cap").cast("double"), F.col("w") * F.lit(new)).alias("target"))
        level = new


def _split_maker(shards: int, subtrees: int, seed: int):
    def node_draw(depth, index, quotas, left):
        rng = np.random.Generator(np.random.PCG64([seed, depth, index]))
        return rng.multivariate_hypergeometric(quotas, left, method="marginals")

    def run(pdf):
        import pandas as pd
        pdf = pdf.sort_values("rank")
        quotas, start = pdf["blocks"].to_numpy(np.int64), np.zeros(len(pdf), np.int64)
        mine, out = int(pdf["tree"].iloc[0]), []
        total = int(quotas.sum())
        share = [total * k // shards for k in range(shards + 1)]  # exact blocks before each shard

        def walk(depth, index, lo, hi, q, at):
            if hi <= mine * shards // subtrees or lo >= (mine + 1) * shards // subtrees:
                return
            if hi - lo == 1:
                some = q > 0
                out.append(pd.DataFrame({"rank": pdf["rank"].to_numpy()[some], "shard": lo, "first": at[some], "n": q[some]}))
                return
            mid = (lo + hi) // 2
            left = node_draw(depth, index, q, share[mid] - share[lo])
            walk(depth + 1, 2 * index, lo, mid, left, at)
            walk(depth + 1, 2 * index + 1, mid, hi, q - left, at + left)

        walk(0, 0, 0, shards, quotas, start)
        return pd.concat(out) if out else pd.DataFrame({"rank": [], "shard": [], "first": [], "n": []}).astype("int64")
    return run


def split(blocks: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(rank, shard, first, n): the run of each source's block order that each shard draws, from (rank, blocks)."""
    n = blocks.agg(F.sum("blocks")).first()[0] or 0
    if n >= 10 ** 9:
        raise ValueError("the draw counts below 10**9 blocks: raise block_words")
    subtrees = max(1, min(shards, max(16, shards // 512)))
    trees = blocks.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(subtrees - 1))))
    return trees.groupBy("tree").applyInPandas(_split_maker(shards, subtrees, seed), "rank long, shard int, first long, n long")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS, shards: int = SHARDS,
        block_words: int = BLOCK_WORDS, seed: int = SEED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """For each distinct (doc_id, source, size) of ``docs`` and its number of copies: source_size, target, and ``draws``, an array
    of (pass, shard, key): one entry for each time the mix takes it; ``key`` orders a shard's documents."""
    rows = docs.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = staged(rows.withColumn("h", h).withColumn("mass", F.col("size") * F.col("copies")), "rows")
    sums = rows.groupBy("source").agg(F.sum("mass").alias("source_size"), F.count("*").alias("docs"))
    goal = targets(sums, weights, budget, repeats)
    goal = staged(ranked(goal, F.asc_nulls_last("source"))
                  .withColumn("blocks", F.when(F.col("target") > 0, F.greatest(F.lit(1), F.round(F.col("target") / block_words))).otherwise(0).cast("long"))
                  .withColumn("ranges", F.greatest(F.lit(1), F.ceil(F.col("docs") / RANGE))), "goal")
    # One row a source, so a broadcast is left to the planner's own size check.
    near = rows.join(goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    near = near.withColumn("range", (F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.col("ranges") / F.lit(1 << 32)).cast("long"))
    sums = near.groupBy("rank", "range").agg(F.sum("mass").alias("m"))
    sums = sums.withColumn("before", F.coalesce(F.sum("m").over(Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    near = near.join(sums.drop("m"), ["rank", "range"])
    inside = Window.partitionBy("rank", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("start", F.col("before") + F.coalesce(F.sum("mass").over(inside), F.lit(0)))
    middle = F.col("start") + F.col("pass") * F.col("source_size") + F.col("mass") / 2
    taken = (near.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
             .withColumn("middle", middle).where((F.col("middle") < F.col("target")) & (F.col("mass") > 0))
             .withColumn("block", F.least(F.floor(F.col("middle") * F.col("blocks") / F.col("target")), F.col("blocks") - 1)))
    shards = max(shards, math.ceil((goal.agg(F.sum("target")).first()[0] or 0) / shard_words))
    runs = split(goal.select("rank", "blocks"), shards, seed)
    where = runs.select("rank", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("block"))
    key = F.md5(F.concat_ws(":", F.lit(seed), "shard", "pass", "h").cast("binary"))
    draws = (taken.join(where, ["rank", "block"]).groupBy("rank", "h", "doc_id", "size")
             .agg(F.sort_array(F.collect_list(F.struct("pass", "shard", key.alias("key")))).alias("draws")))
    d = draws.select(*(F.col(c).alias(f"_{c}") for c in ("rank", "h", "doc_id", "size")), "draws")
    return (near.join(d, (F.col("rank") == F.col("_rank")) & (F.col("h") == F.col("_h")) & (F.col("size") == F.col("_size"))
                      & F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left")
            .select("doc_id", "source", "size", "copies", "source_size", "target", F.coalesce("draws", F.array().cast(
                "array<struct<pass:int,shard:int,key:string>>")).alias("draws")))


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: what it takes of each."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    docs = docs.select("doc_id", "source", words("text").alias("size"))
    out = mix(docs).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("_copy")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Pipeline stage: the mix itself, a row for each time a document is taken, by shard and shuffled inside it."""
    sized = docs.withColumn("_size", words("text"))
    plan = mix(sized.select("doc_id", "source", F.col("_size").alias("size"))).where(F.size("draws") > 0)
    plan = plan.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_n"), "draws")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_n"))
    taken = sized.withColumn("_doc", F.struct(*docs.columns)).select("_doc", "doc_id", "source", "_size").join(plan, same)
    rows = taken.select("_doc", F.explode("draws").alias("_draw"))
    return (rows.repartition(F.col("_draw.shard")).sortWithinPartitions("_draw.shard", "_draw.key").select("_doc.*"))


# The same in SQL. The order inside a source is md5 of seed and doc_id; ties (rows alike) are drawn together.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
g AS (SELECT doc_id, source, size, count(*) AS copies, size * count(*) AS mass, md5('11:' || coalesce(doc_id::VARCHAR, '')) AS h
      FROM d GROUP BY doc_id, source, size),
s AS (SELECT source, sum(mass)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM g GROUP BY source),
c AS (SELECT *, CASE rnk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * source_size AS cap FROM s),
v AS (SELECT *, cap / w AS most, coalesce(sum(cap) OVER (ORDER BY cap / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(w) OVER (ORDER BY cap / w, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(source_size) OVER () AS total FROM c),
lev AS (SELECT max((1.5::DOUBLE * total::DOUBLE - below::DOUBLE) / rest::DOUBLE) AS level FROM v),
t AS (SELECT c.*, least(cap::DOUBLE, w::DOUBLE * (SELECT level FROM lev)) AS target FROM c),
o AS (
  SELECT g.*, t.source_size, t.target, coalesce(sum(mass) OVER (PARTITION BY t.rnk ORDER BY h, g.doc_id NULLS FIRST, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * ((mass > 0 AND start + mass / 2 < target)::BIGINT + (mass > 0 AND source_size + start + mass / 2 < target)::BIGINT) AS taken
FROM o, LATERAL (SELECT unnest(range(copies)) AS k)
"""
