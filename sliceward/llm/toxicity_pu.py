"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear in the presence of words and of word beginnings (invented or inflected forms share these). It
is trained in numpy from confirmed toxic texts and from texts whose labels are not looked at, with the risk
``prior * R_p+ + max(0, R_u- - prior * R_p-)``; when the second part gets negative, the step goes the other way, so that
the classifier cannot fit the positives among the unlabelled as negatives. Fitting takes a bounded sample of labelled
rows; features are counted and chosen by Spark, and only their columns of the sample reach the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sliceward.llm.chunks import beside_tasks
from sliceward.sources.stored import settle

FOLDS, HELD_OUT = 5, 0
#: Labelled rows that are fitted on, at most about: toxic ones, and ones taken as unlabelled.
MOST_TOXIC, MOST_UNLABELLED = 6_000, 20_000
#: Features that are fitted.
FEATURES = 4_000
#: Lengths of word beginnings.
BEGINNINGS = (4, 5, 6)
#: Steps of training, step size, and the weight of the squared coefficients.
STEPS, RATE, SHRINK = 600, 0.05, 1e-5
WORD = re.compile(r"[^\W_]+")


def features(text: str | None) -> set[str]:
    """Distinct words of a text in lower case, and their beginnings, marked with ^."""
    words = set(WORD.findall((text or "").lower()))
    return words.union(f"^{w[:n]}" for w in words for n in BEGINNINGS if len(w) > n)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def fit(rows: list[np.ndarray], toxic: np.ndarray, unlabelled: np.ndarray, prior: float, columns: int) -> np.ndarray:
    """Weights of the features, the bias last. rows: features of each text; toxic, unlabelled: their places."""
    index = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights, first, second = np.zeros(columns + 1), np.zeros(columns + 1), np.zeros(columns + 1)
    weights[-1] = math.log(prior / (1 - prior))
    for step in range(1, STEPS + 1):
        g = weights[-1] + np.bincount(owner, weights=weights[index], minlength=len(rows))
        p = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        negative = np.logaddexp(0, g)
        rest = negative[unlabelled].mean() - prior * negative[toxic].mean()
        on_rest, on_toxic = np.zeros(len(rows)), np.zeros(len(rows))
        np.add.at(on_rest, unlabelled, p[unlabelled] / len(unlabelled))
        np.add.at(on_rest, toxic, -prior * p[toxic] / len(toxic))
        np.add.at(on_toxic, toxic, -prior * (1 - p[toxic]) / len(toxic))
        slope = on_toxic + on_rest if rest >= 0 else -on_rest
        gradient = np.append(np.bincount(index, weights=slope[owner], minlength=columns), slope.sum())
        gradient[:-1] += SHRINK * weights[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = weights - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def train(docs: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Weights by feature, the bias under the empty text, from labels of documents that are not held out.

    Without a toxic or without an unlabelled row, the bias alone: the prior, kept within 1e-6 and 1 - 1e-6.
    """
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total, toxic = marked.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(max(toxic / total if total else 0.0, 1e-6), 1 - 1e-6)
    bias = {"": math.log(prior / (1 - prior))}
    if not toxic or toxic == total:
        return bias
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("pu")), F.lit(1_000_000)) / F.lit(1e6)
    as_toxic = (F.col("toxic") == 1) & (drawn < min(1.0, MOST_TOXIC / toxic))
    # Rows are taken as unlabelled whatever their label is.
    as_unlabelled = F.pmod(F.xxhash64("doc_id", F.lit("u")), F.lit(1_000_000)) / F.lit(1e6) < min(1.0, MOST_UNLABELLED / total)
    picked = marked.select("doc_id", as_toxic.alias("p"), as_unlabelled.alias("u")).filter("p or u")
    # The sample is bounded by the two parameters; texts of all documents are not shuffled for it.
    texts = docs.select("doc_id", "text").join(beside_tasks(picked, 2 * (MOST_TOXIC + MOST_UNLABELLED)), "doc_id")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [sorted(features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("u"), pa.array(names, pa.list_(pa.string()))], ["p", "u", "names"])

    sample = settle(texts.select("p", "u", "text").mapInArrow(found, "p boolean, u boolean, names array<string>"), "pu_sample")
    n_toxic, n_unlabelled = sample.agg(F.count_if("p"), F.count_if("u")).first()
    if not n_toxic or not n_unlabelled:
        return bias
    counted = sample.select("p", "u", F.explode("names").alias("name")).groupBy("name").agg(
        F.count_if("p").alias("in_toxic"), F.count_if("u").alias("in_unlabelled")
    )
    rate, base = F.col("in_toxic") / n_toxic, F.col("in_unlabelled") / n_unlabelled
    spread = F.sqrt((F.col("in_toxic") + F.col("in_unlabelled") + 1) / (n_toxic + n_unlabelled) / n_toxic)
    scored = counted.filter("in_toxic >= 3").select("name", ((rate - base) / spread).alias("z")).filter("z > 2")
    best = [r.name for r in scored.orderBy(F.desc("z"), "name").limit(FEATURES).collect()]
    place = {name: i for i, name in enumerate(best)}

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[place[x] for x in names if x in place] for names in batch.column("names").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("u"), pa.array(own, pa.list_(pa.int32()))], ["p", "u", "own"])

    fitted = sample.mapInArrow(columns, "p boolean, u boolean, own array<int>").toArrow()
    rows = [np.array(x, np.int64) for x in fitted["own"].to_pylist()]
    is_toxic, is_unlabelled = (np.flatnonzero(fitted[c].to_numpy(zero_copy_only=False)) for c in ("p", "u"))
    weights = fit(rows, is_toxic, is_unlabelled, prior, len(best))
    return {name: float(w) for name, w in zip(best, weights[:-1], strict=True)} | {"": float(weights[-1])}


def score(weights: dict[str, float]) -> Column:
    """The score (0 to 1) of the column text. At most FEATURES weights are sent to tasks; only texts go to Python."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        short = {n: {f[1:]: w for f, w in weights.items() if f[:1] == "^" and len(f) == n + 1} for n in BEGINNINGS}
        whole = {f: w for f, w in weights.items() if f[:1] != "^"}
        made = np.empty(len(texts))
        for i, text in enumerate(texts):
            words = set(WORD.findall((text or "").lower()))
            total = whole.get("", 0.0) + sum(whole[w] for w in words & whole.keys())
            for n, of in short.items():
                if of:
                    total += sum(of[b] for b in {w[:n] for w in words if len(w) > n} & of.keys())
            made[i] = total
        return pd.Series(1 / (1 + np.exp(-np.clip(made, -500, 500))))

    return scored("text")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: likelier toxic) and predicted (1 from 0.5 on) of every row.

    Null, empty and wordless texts have the score of the bias. Labels without doc_id or without toxic are left out; of
    repeated labels the toxic one counts; a label of a repeated document applies to each of its rows. A row without
    doc_id is held out. labels, lang, source and doc_id are no inputs of the score.
    """
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(train(docs, labels)).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, rows as given."""
    return docs.filter(score(train(docs, labels)) < 0.5)


def op3_toxicity_pu(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
