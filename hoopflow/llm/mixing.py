"""Mixing sources to target weights by pivotal dependent rounding.

A mix gives each document of a source the same expected number of copies: the source's share of the total divided by its tokens.
The whole part is certain; the fraction is rounded by the pivotal method in units of tokens: two documents meet, tokens move
between them at random until one has a whole number of copies, and the other goes on. Blocks do this in parallel, each leaves at
most one undecided document, and these meet again in a tree of reductions. Expectations stay as planned and a source's total
misses its plan by less than one document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoopflow.llm.tokens import VOCABULARY, token_counts
from hoopflow.session import cut

BLOCK, FAN = 20_000, 64
#: A plan of so many rows at most (mixes times sources) is joined by broadcast, a larger one by a shuffle.
PLANNED = 100_000
ROW = "mix_id string, source string, doc_id long, n_tokens long, whole long, p double, key long, block long"


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """mix_id, source, target_share (of the mix), max_repeats, available, copies: the expected copies of each document.

    sizes: source, available (tokens), n_docs. The total is the largest at which every source that has tokens, a share and a
    repeat can give its share; sources without documents give nothing and the others keep their proportions. Null, NaN and
    negative shares and repeats count as 0; repeated (mix_id, source) rows add their shares and keep the larger repeats.
    """
    share = F.when(F.col("target_share") > 0, F.when(~F.isnan("target_share"), F.col("target_share"))).otherwise(0.0)
    t = targets.groupBy("mix_id", "source").agg(F.sum(F.coalesce(share, F.lit(0.0))).alias("w"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).alias("max_repeats"))
    t = t.join(sizes, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)).cast("long"))
    mix = Window.partitionBy("mix_id")
    able = (F.col("w") > 0) & (F.col("available") > 0) & (F.col("max_repeats") > 0)
    t = t.withColumn("target_share", F.coalesce(F.try_divide("w", F.sum("w").over(mix)), F.lit(0.0)))
    t = t.withColumn("part", F.when(able, F.try_divide("w", F.sum(F.when(able, F.col("w"))).over(mix))).otherwise(0.0))
    t = t.withColumn("total", F.min(F.when(able, F.col("available") * F.col("max_repeats") / F.col("part"))).over(mix))
    copies = F.least(F.col("part") * F.col("total") / F.col("available"), F.col("max_repeats").cast("double"))
    return t.select("mix_id", "source", "target_share", "max_repeats", "available", F.when(able, copies).otherwise(0.0).alias("copies"))


def pivot(weights: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Rounds fractions one pair at a time; the sum of weights * p is kept, all but at most one of the results are 0 or 1."""
    p = p.copy()
    draw = rng.random(len(p))
    i = -1
    for j in range(len(p)):
        if not 1e-9 < p[j] < 1 - 1e-9:
            p[j] = round(p[j])
            continue
        if i < 0:
            i = j
            continue
        wi, wj = weights[i], weights[j]
        up, down = min((1 - p[i]) * wi, p[j] * wj), min(p[i] * wi, (1 - p[j]) * wj)
        move = up if draw[j] * (up + down) < down else -down
        p[i] += move / wi
        p[j] -= move / wj
        done = [k for k in (i, j) if not 1e-9 < p[k] < 1 - 1e-9]
        for k in done:
            p[k] = round(p[k])
        i = next((k for k in (i, j) if k not in done), -1)
    return p


def _round_block(seed: int, level: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "doc_id"], ignore_index=True)
        name = f"{pdf.mix_id[0]}|{pdf.source[0]}|{level}|{pdf.block[0]}"
        rng = np.random.default_rng([seed, *name.encode()])
        p = pivot(pdf.n_tokens.to_numpy("float64"), pdf.p.to_numpy("float64"), rng)
        if last:
            p = (rng.random(len(p)) < p).astype("float64")
        return pdf.assign(p=p)

    return run


def choose(sized: DataFrame, targets: DataFrame, seed: int = 7) -> DataFrame:
    """mix_id, source, doc_id, n_tokens, copies of each document that a mix uses.

    sized: doc_id, source, n_tokens. Documents without tokens and without a source are never chosen: they can't add to a share.
    No document is used more than max_repeats times. Repeated rows of one doc_id count as documents of their own.
    """
    sizes = sized.where("n_tokens > 0 and source is not null").groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count(F.lit(1)).alias("n_docs"))
    planned = plan(sizes.drop("n_docs"), targets).where("copies > 0")
    n = sizes.agg(F.max("n_docs")).first()[0] or 0
    blocks = max(1, -(-n // BLOCK))
    planned = cut(planned.select("mix_id", "source", "copies"))
    rows = sized.where("n_tokens > 0").join(F.broadcast(planned) if planned.count() <= PLANNED else planned, "source")
    whole = F.floor(F.col("copies") + 1e-9)
    rows = rows.select(
        "mix_id", "source", "doc_id", "n_tokens", whole.cast("long").alias("whole"), F.greatest(F.col("copies") - whole, F.lit(0.0)).alias("p"),
        F.xxhash64("doc_id", F.lit(seed)).alias("key"),
    ).withColumn("block", F.pmod("key", F.lit(blocks)))
    # Whole numbers of copies are settled; only fractions are rounded.
    settled = ~F.col("p").between(1e-9, 1 - 1e-9)
    parts, rows, level = [rows.where(settled).withColumn("p", F.round("p"))], rows.where(~settled), 0
    while True:
        last = blocks == 1
        rounded = cut(rows.groupBy("mix_id", "source", "block").applyInPandas(_round_block(seed, level, last), ROW))
        if last:
            parts.append(rounded)
            break
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        parts.append(rounded.where(~undecided))
        rows, blocks, level = rounded.where(undecided).withColumn("block", F.floor(F.col("block") / FAN)), -(-blocks // FAN), level + 1
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("mix_id", "source", "doc_id", "n_tokens", (F.col("whole") + F.col("p")).cast("long").alias("copies")).where("copies > 0")


def sized_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    return token_counts(docs, vocabulary, ("doc_id", "source"))


def shares(chosen: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """What each source of each mix reached, sources that give nothing included."""
    sizes = sized.where("n_tokens > 0 and source is not null").groupBy("source").agg(F.sum("n_tokens").alias("available"))
    used = chosen.groupBy("mix_id", "source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens")
    )
    t = plan(sizes, targets).withColumnRenamed("copies", "planned_copies").join(used, ["mix_id", "source"], "left").fillna(0, ["documents", "copies", "most_copies", "tokens"])
    return t.withColumn("reached_share", F.coalesce(F.try_divide(F.col("tokens").cast("double"), F.sum("tokens").over(Window.partitionBy("mix_id"))), F.lit(0.0)))
