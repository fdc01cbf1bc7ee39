"""Top-k BM25 search over impact-ordered postings with block maxima, for queries without country and city.

The postings of each (field, token) are cut into blocks by impact: a block holds the postings whose impact lies in one
step of a geometric ladder (``GROWTH``), so blocks come in descending order of impact and each has a known maximum. Both
are computed by plain aggregation, so a token held by a third of the registry is no window over one task.

A query's score for a row is the best of its fields, each the sum of ``qtf * impact`` over the query's tokens. Per
(query, field):

1. Seeds: the top block of the query's token of highest reach (``qtf`` times its largest impact). Their exact scores
   give ``theta``, the ``k``-th best of them, a lower bound of the final ``k``-th score (0 with fewer than ``k`` seeds).
2. A row not in block ``j`` of token ``t`` scores at most ``qtf_t * max_j + rest_t``, ``rest_t`` being what the other
   tokens can give at most. Any row that can reach ``theta`` lies, for every token it holds, in a block whose bound
   reaches ``theta``; only those blocks are read.
3. The rows of the read blocks are scored exactly over all fields and the best ``k`` kept, ties to the smaller id.

The best ``k`` of the best field are among the best ``k`` of that field alone, so the field-wise bound loses nothing.
Scores are compared with a margin of ``1e-6``, the rounding of the ranking.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affilix.functions.text import words
from affilix.operators.retrieval import SCORED, TOP_K, SearchIndex, code_of, numbered, packed
from affilix.operators.score_grid import best_in_cells
from affilix.session import materialize

GROWTH = 1.25
MARGIN = 1e-6


def impact_blocks(index: SearchIndex, growth: float = GROWTH) -> DataFrame:
    """``field, token, inst_id, impact, block``: block 0 holds the largest impacts, ``block`` grows as impact falls."""
    step = math.log(growth)
    block = F.floor(-F.log(F.greatest(F.col("impact"), F.lit(1e-12))) / step).cast("int")
    return index.postings.filter(F.col("field").isin(SCORED)).withColumn("block", block)


def _best(df: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc(F.round("score", 6)), "inst_id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def block_max_search(queries: DataFrame, index: SearchIndex, k: int = TOP_K, growth: float = GROWTH) -> DataFrame:
    """Best ``k`` rows of each ``query_id, institute``: ``query_id, inst_id, score, rank``. A query without tokens finds
    nothing; a NULL institute is one without tokens."""
    tokens = (
        queries.select("query_id", F.explode(words(F.col("institute"))).alias("token"))
        .groupBy("query_id", "token").agg(F.count("*").alias("qtf"))
    )
    tokens = materialize(tokens.withColumn("pair_id", F.lit("")), "query_tokens")
    asked = numbered(tokens)
    index = SearchIndex(impact_blocks(index, growth), index.docs)
    vectors, rows = packed(tokens, index, asked)
    vectors = vectors.withColumn("bound", F.lit(False))
    # Always empty, but no constant: of a constant key the optimizer makes a join without keys.
    rows = rows.withColumns({"pair_id": F.substring("inst_id", 1, 0), "req": F.lit(0.0)})
    blocks = index.postings.join(asked, "token").groupBy(
        "field", "token", code_of(F.col("id"), F.col("field")).alias("code"), "block"
    ).agg(F.max("impact").alias("block_top"))
    blocks = materialize(blocks, "blocks")
    tops = blocks.groupBy("field", "token", "code").agg(F.max("block_top").alias("top"), F.min("block").alias("first"))
    reach = materialize(
        tokens.drop("pair_id").join(tops, "token").withColumn("most", F.col("qtf") * F.col("top")), "reach"
    )
    per_field = W.partitionBy("query_id", "field")
    reach = reach.withColumn("rest", F.sum("most").over(per_field) - F.col("most"))

    def looking_at(limits: DataFrame) -> DataFrame:
        lists = limits.groupBy("query_id").agg(F.collect_list(F.struct("code", "upto")).alias("m"))
        return materialize(vectors.join(lists.select(
            "query_id", F.col("m.code").alias("marks"), F.col("m.upto").alias("upto")), "query_id"), "limits")

    # 1. Seeds: the first block of the token of highest reach, per (query, field).
    leading = reach.withColumn(
        "lead", F.row_number().over(per_field.orderBy(F.desc("most"), "token"))
    ).filter("lead = 1").select("query_id", "code", F.col("first").alias("upto"))
    seeded = best_in_cells(looking_at(leading), rows, k, marked=True, per_field=True)
    kth = W.partitionBy("query_id", "field").orderBy(F.desc("score"))
    theta = (
        seeded.withColumn("n", F.row_number().over(kth)).filter(F.col("n") == k)
        .select("query_id", F.element_at(F.array(*[F.lit(f) for f in SCORED]), F.col("field") + 1).alias("field"),
                F.col("score").alias("theta"))
    )
    theta = materialize(theta, "theta")

    # 2. Blocks whose bound reaches theta: the first ones of a token, as bounds fall with the number of the block.
    bounds = reach.join(theta, ["query_id", "field"], "left").join(
        blocks.select("code", "block", "block_top"), "code"
    )
    needed = bounds.filter(
        F.col("qtf") * F.col("block_top") + F.col("rest") >= F.coalesce(F.col("theta"), F.lit(0.0)) - MARGIN
    ).groupBy("query_id", "code").agg(F.max("block").alias("upto"))

    # 3. Their rows, scored exactly over every field.
    scored = best_in_cells(looking_at(needed), rows, k, marked=True)
    return _best(scored, k).select("query_id", "inst_id", "score", "rank")
