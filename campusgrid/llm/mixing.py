"""Mixing sources to target weights by hierarchical budgets.

Leaves are (domain, language, source). A token budget is dealt from the root down: a node's children get shares in
proportion to their weights, none more than its subtree can give (its tokens times ``max_epochs``); what one child
cannot give goes to its siblings first, and only what all siblings together cannot give is dealt again by the
ancestors, which happens by itself as every node's cap is the sum of its leaves' caps.

A leaf takes whole epochs and then the prefix of one more: each epoch orders the leaf's documents by a seeded hash.
The place where the last prefix ends is found without sorting a leaf: documents fall into hash buckets of about
``bucket_rows`` rows, bucket sums give the bucket in which the budget ends, and only that bucket's rows are ordered.
The texts themselves are read in one pass that compares each row with its leaf's end; they are never shuffled."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campusgrid.llm.shelf import prepare, save

LEAF = ["domain", "lang", "source"]
WORD = r"[^\x20\x09-\x0D]+"


def deal(budget: int, weights: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """Whole numbers of tokens in proportion to ``weights``, none over its cap, adding up to min(budget, all caps).

    Children at their cap leave the rest to the others; fractions go to the largest remainders, ties to the first."""
    weights, caps = np.asarray(weights, dtype=np.float64), np.asarray(caps, dtype=np.int64)
    out, open_ = np.zeros(len(caps), dtype=np.int64), (weights > 0) & (caps > 0)
    left = int(min(budget, caps.sum()))
    while left > 0:
        if not open_.any():  # only children without weight have anything left
            open_ = caps > out
            weights = open_.astype(np.float64)
        share = np.where(open_, weights, 0)
        share = share / share.sum() * left
        full = open_ & (share >= caps - out)
        if full.any():
            left -= int((caps - out)[full].sum())
            out[full] = caps[full]
            open_ &= ~full
            continue
        whole = np.floor(share).astype(np.int64)
        rest = left - int(whole.sum())
        order = np.lexsort((np.arange(len(share)), -(share - whole) * open_))
        order = order[open_[order] & (caps - out > whole)[order]]
        whole[order[:rest]] += 1
        out += whole
        left -= int(whole.sum())
        open_ &= caps > out
    return out


def _level(weights: Mapping[str, float] | None, parent: list[str], child: str, default: float):
    table = dict(weights or {})

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(child).reset_index(drop=True)
        share = np.array([table.get(x, default) for x in frame[child]])
        frame["budget"] = deal(int(frame["above"].iloc[0]), share, frame["cap"].to_numpy())
        return frame[[*parent, child, "budget"]]

    return run


def budgets(
    leaves: DataFrame, budget_share: float, weights: Mapping[str, Mapping[str, float]], default_weight: float, max_epochs: int
) -> DataFrame:
    """Leaves (``LEAF``, tokens, docs) with the budget of each, dealt level by level from the root."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(F.sum("tokens").alias("t")).collect()[0]["t"] or 0
    above, parent = None, []
    for depth, child in enumerate(LEAF):
        nodes = leaves.groupBy(*LEAF[: depth + 1]).agg(F.sum("cap").alias("cap")).withColumn("root", F.lit(0))
        # The root's budget is one number; below, every node finds the budget of the node above it.
        nodes = nodes.join(above, parent) if parent else nodes.withColumn("above", F.lit(int(total * budget_share)).cast("bigint"))
        schema = ", ".join([*[f"{c} string" for c in [*parent, child]], "budget bigint"])
        grouped = nodes.groupBy(*(parent or ["root"]))
        dealt = save(grouped.applyInPandas(_level(weights.get(child), parent, child, default_weight), schema), "budgets")
        above, parent = dealt.withColumnRenamed("budget", "above"), [*parent, child]
    return leaves.join(above.withColumnRenamed("above", "budget"), LEAF)


def _order(key: Column, epoch: Column, seed: int) -> Column:
    """Place of a row in an epoch: a hash moved to 0 .. 2**63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(key, epoch, F.lit(seed)), 1)


def mix_sources(
    docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]] | None = None, budget_share: float = 0.8,
    max_epochs: int = 2, seed: int = 7, default_weight: float = 1.0, id_column: str = "doc_id", text_column: str = "text",
    lang_column: str = "lang", source_column: str = "source", bucket_rows: int = 4096,
) -> DataFrame:
    """The chosen rows: ``row`` (all columns), ``domain``, ``epoch`` (from 0), ``n_tokens``, ``take_tokens``.

    ``weights`` has a weight by name for each of ``domain``, ``lang`` and ``source``; other names get
    ``default_weight``. The budget is ``budget_share`` of all tokens (words). The document in which a leaf's budget
    ends is taken for its first ``take_tokens`` tokens; all others are taken whole. A null domain, language or source
    counts as the empty name. Texts without words (null, empty) are never taken. Rows that agree in id and text stand
    at one place in the order; where a budget ends there, each is cut at the same word. No rows give no rows."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.col(f"row.`{text_column}`")
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name(domain).alias("domain"))
    keyed = keyed.select(
        "row", "domain", name(F.col(f"row.`{lang_column}`")).alias("lang"), name(F.col(f"row.`{source_column}`")).alias("source"),
        F.xxhash64(F.col(f"row.`{id_column}`"), text).alias("key"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_tokens"),
    ).where("n_tokens > 0")

    slim = save(keyed.select(*LEAF, "key", "n_tokens"), "tokens")
    leaves = save(slim.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "leaves")
    plan = budgets(leaves, budget_share, weights or {}, default_weight, max_epochs).select(
        *LEAF, (F.col("budget") / F.col("tokens")).cast("bigint").alias("epochs"),
        (F.col("budget") % F.col("tokens")).alias("rest"),
        F.greatest(F.ceil(F.log2(F.col("docs") / bucket_rows)), F.lit(0)).cast("int").alias("bits"),
    )
    plan = save(plan, "plan")

    # Where the last epoch of each leaf ends: first the bucket, then the row in it.
    place = _order(F.col("key"), F.col("epochs"), seed)
    # A row's bucket is made of the leading bits of its place; zero bits make one bucket.
    bucket = F.when(F.col("bits") == 0, F.lit(0)).otherwise(F.expr("shiftright(place, 63 - bits)")).cast("bigint")
    placed = slim.join(plan, LEAF).withColumn("place", place).withColumn("bucket", bucket)
    sums = placed.groupBy(*LEAF, "bucket").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("bucket"))
    ends = sums.withColumn("upto", upto).where("upto > rest and upto - tokens <= rest")
    ends = save(ends.select(*LEAF, "bucket", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("room")), "ends")
    inside = placed.join(ends, [*LEAF, "bucket"]).groupBy(*LEAF, "place", "key").agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("copies"), F.first("room").alias("room")
    )
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("place", "key"))
    last = inside.withColumn("upto", upto).where("upto > room and upto - tokens <= room").select(
        *LEAF, F.col("place").alias("end_place"), F.col("key").alias("end_key"),
        ((F.col("room") - F.col("upto") + F.col("tokens")) / F.col("copies")).cast("bigint").alias("part"),
    )
    plan = save(plan.join(last, LEAF, "left").select(*LEAF, "epochs", "end_place", "end_key", "part"), "cuts")

    chosen = keyed.join(plan, LEAF).withColumn("place", place)
    at_end = (F.col("place") == F.col("end_place")) & (F.col("key") == F.col("end_key"))
    before = (F.col("place") < F.col("end_place")) | ((F.col("place") == F.col("end_place")) & (F.col("key") < F.col("end_key")))
    extra = F.when(before, F.col("n_tokens")).when(at_end, F.col("part")).otherwise(0)
    takes = F.concat(F.transform(F.sequence(F.lit(1), F.lit(max_epochs)), lambda e: F.when(e <= F.col("epochs"), F.col("n_tokens"))), F.array())
    takes = F.filter(takes, lambda t: t.isNotNull())
    takes = F.when(extra > 0, F.concat(takes, F.array(extra))).otherwise(takes)
    return chosen.select("row", "domain", "n_tokens", F.posexplode(takes).alias("epoch", "take_tokens"))
