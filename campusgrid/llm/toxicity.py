"""Toxicity by classifier chains.

Categories are predicted one after the other by linear models. A later model gets the log-odds of all earlier
categories as features; for its training rows these come from models that have not seen the row (out-of-fold), so
it learns from the same kind of evidence as it meets when scoring.

Features are the distinct words and the 4- and 5-byte pieces inside words (with the space before the word) of the
whole lower-cased text, hashed. Each model keeps the ``kept`` features that tell the classes apart best, weighs them
by their log-count ratio and fits a ridge logistic regression on that.

Fitting uses at most ``sample`` labelled rows: those with the smallest keyed hash of the id, over all labels. The
folds' models are fitted in parallel tasks, one task per fold and category. A model is ``kept`` weights per category,
whatever the size of the data; scoring is a map over all documents without a shuffle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.shelf import give_back, prepare, save, tidy
from campusgrid.llm.words import Words, find_words, mix, small_batches, span_hashes

#: Width of the feature hash, features a model keeps, most labelled rows it is fitted on, and its folds.
HASH_BITS, KEPT, SAMPLE, FOLDS = 20, 4096, 8_000, 2
_TEXT, _ID = "_text", "_id"


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hashed feature) of all words and inner pieces, repeats included."""
    shift = np.uint64(64 - HASH_BITS)
    owner, found = words.owner, [(words.hashes() >> shift).astype(np.int64)]
    owners = [owner]
    # A piece may begin at the space before its word, which stands for the word's start.
    data = np.concatenate([[np.uint8(32)], words.data]).astype(np.uint64)
    lengths = words.ends - words.starts + 1
    total = np.concatenate([[0], np.cumsum(lengths)])
    word_of = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(total[-1]) - np.repeat(total[:-1] - words.starts, lengths)
    room = words.ends[word_of] + 1 - place
    first = place == words.starts[word_of]
    bytes_at = np.where(first, np.uint64(32), data[place])
    for size in (4, 5):
        at = np.flatnonzero(room >= size)
        value = np.full(len(at), size, dtype=np.uint64)
        for i in range(size):
            value = value * np.uint64(257) + bytes_at[at + i]
        found.append((mix(value) >> shift).astype(np.int64))
        owners.append(owner[word_of[at]])
    return np.concatenate(owners), np.concatenate(found)


def _distinct(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((text.astype(np.int64) << HASH_BITS) | feature)
    return both >> HASH_BITS, both & ((1 << HASH_BITS) - 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Linear:
    """Log-odds = bias + weights of the features present + earlier log-odds @ chain."""

    feature: np.ndarray
    weight: np.ndarray
    chain: np.ndarray
    bias: float

    def score(self, rows: int, text: np.ndarray, feature: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        table = np.full(1 << HASH_BITS, 0.0)
        table[self.feature] = self.weight
        return self.bias + np.bincount(text, table[feature], minlength=rows) + earlier @ self.chain


def fit_linear(
    parts: Sequence[tuple[np.ndarray, np.ndarray]], earlier: np.ndarray, label: np.ndarray,
    rank: np.ndarray | None = None, kept: int = KEPT,
) -> Linear:
    """Ridge logistic regression on log-count ratios.

    ``parts`` are the rows in pieces: how many distinct features each row has, and the features of the piece's rows one
    after the other. ``label`` is 0 or 1; ``earlier`` and ``label`` are in an order of their own if ``rank`` gives the
    place of each row of the pieces in it. All features are counted piece by piece; only those of the kept ones are
    spread out."""
    label, rows = label.astype(np.float64), len(label)
    rank = np.arange(rows) if rank is None else rank
    size, ones = 1 << HASH_BITS, label.sum()
    if not 0 < ones < rows:
        odds = float(np.log((ones + 0.5) / (rows - ones + 0.5))) if rows else -35.0
        return Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), odds)
    yes, both = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    at = 0
    for lengths, feature in parts:
        positive = np.repeat(label[rank[at : at + len(lengths)]] > 0, lengths)
        at += len(lengths)
        both += np.bincount(feature, minlength=size)
        yes += np.bincount(feature[positive], minlength=size)
    no = both - yes
    p, q = yes / ones, no / (rows - ones)
    spread = np.sqrt(p * (1 - p) / ones + q * (1 - q) / (rows - ones)) + 2 / rows
    chosen = np.argsort(-np.abs(p - q) / spread, kind="stable")[:kept]
    chosen = chosen[both[chosen] >= 3]
    ratio = np.log((yes[chosen] + 1) / (ones + 2)) - np.log((no[chosen] + 1) / (rows - ones + 2))
    spot = np.full(size, -1, dtype=np.int32)
    spot[chosen] = np.arange(len(chosen))
    found, at = [], 0
    for lengths, feature in parts:
        inside = np.flatnonzero(spot[feature] >= 0)
        row = rank[at + np.searchsorted(np.cumsum(lengths), inside, side="right")]
        found.append(row * kept + spot[feature[inside]])
        at += len(lengths)
    # In one order, whatever order the rows came in.
    found = np.sort(np.concatenate(found))
    text, at = found // kept, found % kept
    value = ratio[at]
    scale = np.maximum(np.abs(earlier).max(axis=0, initial=0), 1)
    extra = earlier / scale
    weight, chain, bias = np.zeros(len(chosen)), np.zeros(extra.shape[1]), float(np.log(ones / (rows - ones)))
    # Rows of the rarer class weigh more, up to a balance of one to four.
    heavy = np.where(label > 0, max(1.0, (rows - ones) / (4 * ones)), max(1.0, ones / (4 * (rows - ones))))
    m_w, m_c, m_b = np.zeros(len(chosen)), np.zeros(extra.shape[1]), 0.0
    v_w, v_c, v_b = np.zeros(len(chosen)), np.zeros(extra.shape[1]), 0.0
    for turn in range(1, 201):
        z = bias + np.bincount(text, weight[at] * value, minlength=rows) + extra @ chain
        error = (_sigmoid(z) - label) * heavy / rows
        g_w = np.bincount(at, error[text] * value, minlength=len(chosen)) + 1e-4 * weight
        g_c, g_b = extra.T @ error + 1e-4 * chain, error.sum()
        m_w, m_c, m_b = 0.9 * m_w + 0.1 * g_w, 0.9 * m_c + 0.1 * g_c, 0.9 * m_b + 0.1 * g_b
        v_w, v_c, v_b = 0.99 * v_w + 0.01 * g_w**2, 0.99 * v_c + 0.01 * g_c**2, 0.99 * v_b + 0.01 * g_b**2
        fade, grow = 1 - 0.9**turn, 1 - 0.99**turn
        move = lambda m, v: 0.05 * (m / fade) / (np.sqrt(v / grow) + 1e-8)
        weight, chain, bias = weight - move(m_w, v_w), chain - move(m_c, v_c), bias - move(m_b, v_b)
    return Linear(chosen, weight * ratio, chain / scale, float(bias))


_MODEL_ARROW = pa.schema([
    ("fold", pa.int32()), ("feature", pa.list_(pa.int64())), ("weight", pa.list_(pa.float64())),
    ("chain", pa.list_(pa.float64())), ("bias", pa.float64()),
])
_MODEL = "fold int, feature array<bigint>, weight array<double>, chain array<double>, bias double"


def _fit_fold(stage: int):
    """Fit one category on a fold's rows; a null label takes no part."""

    def run(table: pa.Table) -> pa.Table:
        fit = table.column("fit")[0].as_py()
        table = table.filter(pc.is_valid(table.column(f"label{stage}")))
        # Rows in order of id; their features stay where they are.
        order = np.argsort(table.column(_ID).to_numpy(), kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        earlier = np.array(table.column("earlier").to_pylist(), dtype=np.float64).reshape(table.num_rows, stage)
        label = table.column(f"label{stage}").to_numpy().astype(int)
        lists = table.column("features").chunks
        parts = [(c.value_lengths().to_numpy(), c.flatten().to_numpy()) for c in lists if len(c)]
        model = fit_linear(parts, earlier[order], label[order], rank)
        row = {"fold": fit, "feature": model.feature, "weight": model.weight, "chain": model.chain, "bias": model.bias}
        del table, lists, parts
        give_back()
        return pa.Table.from_pylist([row], schema=_MODEL_ARROW)

    return run


def _models(rows) -> dict[int, Linear]:
    return {
        r["fold"]: Linear(np.array(r["feature"], dtype=np.int64), np.array(r["weight"]), np.array(r["chain"]), r["bias"])
        for r in rows
    }


def training_rows(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_column: str, text_column: str, sample: int,
    folds: int,
) -> DataFrame:
    """At most ``sample`` labelled rows with their distinct features and fold."""
    ident = F.col(f"`{id_column}`").cast("bigint")
    marks = labels.select(ident.alias(_ID), *[c.cast("int").alias(f"label{i}") for i, c in enumerate(categories.values())])
    marks = marks.where(F.col(_ID).isNotNull()).groupBy(_ID).agg(*[F.max(c).alias(c) for c in marks.columns[1:]])
    # The bound holds before the texts are met: the smallest hashes among all labelled ids.
    marks = save(marks.orderBy(F.xxhash64(F.col(_ID), F.lit("sample")), _ID).limit(sample), "labelled")
    texts = docs.select(ident.alias(_ID), F.col(f"`{text_column}`").alias(_TEXT)).join(F.broadcast(marks), _ID)
    texts = texts.withColumn("fold", F.pmod(F.xxhash64(F.col(_ID), F.lit("fold")), F.lit(folds)).cast("int"))
    texts = texts.withColumn("earlier", F.array().cast("array<double>"))
    names = [c for c in marks.columns if c != _ID]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, _TEXT):
            text, feature = _distinct(*_features(find_words(batch.column(_TEXT))))
            places = np.searchsorted(text, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(_ID), *[batch.column(n) for n in names], lists, batch.column("fold"), batch.column("earlier")],
                names=[_ID, *names, "features", "fold", "earlier"],
            )

    schema = ", ".join([f"{_ID} bigint", *[f"{n} int" for n in names], "features array<int>", "fold int", "earlier array<double>"])
    return texts.mapInArrow(tidy(run), schema)


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_column: str = "doc_id",
    text_column: str = "text", sample: int = SAMPLE, folds: int = FOLDS,
) -> list[Linear]:
    """One model per category, in the order of ``categories`` (name: 0/1 column of ``labels``)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = save(training_rows(docs, labels, categories, id_column, text_column, sample, folds), "stage0")
    chain = []
    for stage in range(len(categories)):
        # fit = a fold: the model for that fold's rows, fitted on the others; fit = folds: the model of all rows.
        fits = rows.withColumn("fit", F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(folds)), F.col("fold"))))
        fitted = fits.groupBy("fit").applyInArrow(_fit_fold(stage), _MODEL)
        models = _models(save(fitted, "models").collect())
        chain.append(models.get(folds, Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(stage), -35.0)))
        if stage + 1 < len(categories):
            rows = save(_add_out_of_fold(rows, models, stage), f"stage{stage + 1}")
    return chain


def _add_out_of_fold(rows: DataFrame, models: dict[int, Linear], stage: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            scores = np.zeros(len(frame))
            for fold, place in frame.groupby("fold").indices.items():
                part = frame.iloc[place]
                feature = np.concatenate([*part["features"], np.zeros(0, np.int64)]).astype(np.int64)
                text = np.repeat(np.arange(len(part)), [len(x) for x in part["features"]])
                earlier = np.array([list(x) for x in part["earlier"]], dtype=np.float64).reshape(len(part), stage)
                if fold in models:
                    scores[place] = models[fold].score(len(part), text, feature, earlier)
            frame["earlier"] = [np.append(x, s) for x, s in zip(frame["earlier"], scores)]
            yield frame

    return rows.mapInPandas(run, rows.schema)


def score_chain(
    docs: DataFrame, chain: Sequence[Linear], names: Sequence[str], text_column: str = "text", keep_text: bool = True
) -> DataFrame:
    """``row`` (the other columns of ``docs`` as a struct), ``text`` and ``p_<category>``, over whole texts."""
    spark = docs.sparkSession
    prepare(spark)
    used = np.unique(np.concatenate([np.zeros(0, np.int64), *[m.feature for m in chain]]))
    weights = np.zeros((len(chain), len(used)))
    for i, model in enumerate(chain):
        weights[i, np.searchsorted(used, model.feature)] = model.weight
    shared = spark.sparkContext.broadcast((used, weights, [(m.chain, m.bias) for m in chain]))
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("row")
    keyed = docs.select(rest, F.col(f"`{text_column}`").alias(_TEXT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, weights, rest = shared.value
        known = np.full(1 << HASH_BITS, -1, dtype=np.int64)
        known[used] = np.arange(len(used))
        for batch in small_batches(batches, _TEXT):
            text, feature = _features(find_words(batch.column(_TEXT)))
            at = known[feature]
            text, feature = _distinct(text[at >= 0], feature[at >= 0])
            at = known[feature]
            earlier, out = np.zeros((batch.num_rows, 0)), []
            for i, (links, bias) in enumerate(rest):
                z = bias + np.bincount(text, weights[i, at], minlength=batch.num_rows) + earlier @ links
                earlier = np.column_stack([earlier, z])
                out.append(pa.array(_sigmoid(z)))
            kept = [batch.column(_TEXT)] * keep_text
            yield pa.RecordBatch.from_arrays([batch.column("row"), *kept, *out], names=["row", *texts, *marks])

    texts, marks = ["text"] * keep_text, [f"p_{n}" for n in names]
    shown = [T.StructField("text", T.StringType())] * keep_text
    schema = T.StructType([keyed.schema["row"], *shown, *[T.StructField(f"p_{n}", T.DoubleType()) for n in names]])
    return keyed.mapInArrow(tidy(run), schema)


def toxicity(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column] | None = None, id_column: str = "doc_id",
    text_column: str = "text", sample: int = SAMPLE, folds: int = FOLDS, keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of its other columns) and ``text`` (unless ``keep_text`` is off), with
    ``p_<category>`` for each category.

    By default the chain is (low quality, toxic), the two categories that the label table knows. A null or empty
    text has no features and gets the models' base rate. Labels without a document, and null labels, are left out;
    several labels of one id count as the highest. Without any label every probability is zero (to 1e-15). Repeated
    rows are scored alike and returned as often."""
    if categories is None:
        categories = {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
    chain = fit_chain(docs, labels, categories, id_column, text_column, sample, folds)
    return score_chain(docs, chain, list(categories), text_column, keep_text)
