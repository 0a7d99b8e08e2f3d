"""A word bigram model by deleted interpolation, learned from and applied to a whole corpus.

Bigram, unigram and uniform estimates are mixed; the weights depend on how often the context was seen, in buckets that
double. Weights are learned by expectation-maximisation on held-out counts in the deleted form: every training token is
predicted from counts without itself. Counts are joined through shards of the hash space: each chunk of documents asks
for its distinct n-grams once, with its own training counts, and is answered with the totals.

The EM does not run over tokens: chunks reduce them to a histogram of (bucket, bigram estimate, unigram estimate) with
eight bins per octave, so its size depends on the range of the counts and not on the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType

from sliceward.llm import chunks as C
from sliceward.llm import packed as P
from sliceward.llm import textarrays as T

#: One in so many documents is held out, by the checksum of its doc_id.
FOLDS, HELD_OUT = 7, 2
#: The lowest bit of a key: 1 for words, 0 for bigrams and the start, so that they never share a key.
WORD = np.uint64(1)
#: Bins per octave of the estimates, and the rounds of EM.
BINS, ROUNDS = 8, 200
BUCKETS = 48
#: The bin of an estimate of zero; bins below uniform are negative.
ZERO = -(1 << 30)
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
RESULT = [
    ("held_out", BooleanType()),
    ("n_tokens", LongType()),
    ("n_known", LongType()),
    ("train_tokens", LongType()),
    ("base_score", DoubleType()),
    ("score", DoubleType()),
]


def bucket_of(contexts: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, then one bucket per power of two."""
    return np.frexp(contexts.astype(np.float64))[1]


def binned(p: np.ndarray, uniform: float) -> np.ndarray:
    """The bins of estimates, counted from the uniform one."""
    return np.rint(np.log2(p / uniform, out=np.full(len(p), ZERO / BINS), where=p > 0) * BINS).astype(np.int64)


def learn(cells: np.ndarray, uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of (bigram, unigram, uniform) per bucket from rows of bucket, bigram bin, unigram bin, tokens.

    A bucket without tokens has the weights of the next smaller one; bucket 0 never uses the bigram.
    """
    weights = np.zeros((BUCKETS, 3))
    last = np.array([0.0, 0.5, 0.5])
    for b in range(BUCKETS):
        rows = cells[cells[:, 0] == b]
        if len(rows):
            seen = rows[:, 3].astype(np.float64)
            estimate = np.stack([np.where(rows[:, k] == ZERO, 0.0, uniform * 2.0 ** (rows[:, k] / BINS)) for k in (1, 2)], axis=1)
            estimate = np.column_stack((estimate, np.full(len(rows), uniform)))
            last = np.full(3, 1 / 3) if b else np.array([0.0, 0.5, 0.5])
            for _ in range(rounds):
                share = estimate * last
                last = (share * (seen / share.sum(axis=1))[:, None]).sum(axis=0) / seen.sum()
            last = np.maximum(last, [0.0, 0.0, 1e-6])
            last = last / last.sum()
        weights[b] = last
    return weights


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` in lower case (A-Z), then one end. base_score is add-one smoothing of
    the unigrams, score the interpolated model, both as log10 probability. A document is held out if crc32 of its
    doc_id as text leaves 2 modulo 7; all others are learned from. Null and empty texts consist of the end alone.
    A null doc_id counts as an id above 2**62 made from the text. Every row gives one row; repeated rows all count.
    N-grams are told apart by 63 bits of a hash, words and bigrams in spaces of their own.
    """
    chunks = C.chunked(docs)
    n = chunks.n

    def shard_of(keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(40)) % np.uint64(n)).astype(np.int64)

    def grams(rows: pa.Table) -> tuple:
        """Keys of the chunk's n-grams, sorted by shard; per token its unigram, bigram and context among them; text offsets."""
        raw, offsets = T.utf8(rows["__text"])
        (words,), at = T.word_hashes(raw, offsets, [T.SpanHash(31)], lower=True)
        size = len(at) - 1
        ends = at[1:] + np.arange(1, size + 1)
        tokens = np.full(len(words) + size, END)
        inside = np.ones(len(tokens), bool)
        inside[ends - 1] = False
        tokens[inside] = words
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        starts = np.concatenate(([0], ends[:-1]))
        before[starts] = START
        pairs = T.mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens)
        every = np.concatenate((tokens | WORD, pairs & ~WORD, before[starts] & ~WORD))
        known, which = np.unique(every, return_inverse=True)
        order = np.argsort(shard_of(known), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        known, which = known[order], place[which]
        one, two = which[: len(tokens)], which[len(tokens) : 2 * len(tokens)]
        context = np.empty_like(one)
        context[1:] = one[:-1]
        context[starts] = which[2 * len(tokens) :]
        held = np.array([zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in rows["__id"].to_pylist()], bool)
        learned = np.repeat(~held, np.diff(np.append(starts, len(tokens))))
        return known, one, two, context, starts, held, learned, which[2 * len(tokens) :]

    def ask(rows: pa.Table, _) -> pa.Table:
        known, one, two, _, _, held, learned, begins = grams(rows)
        total = len(known)
        counts = np.bincount(one[learned], minlength=total) + np.bincount(two[learned], minlength=total)
        counts = counts + np.bincount(begins[~held], minlength=total)
        return P.routed(P.chunk_of(rows), shard_of(known), [known], [counts.astype(np.uint64)])

    def count(table: pa.Table) -> pa.Table:
        sizes = [len(x.as_py()) // 8 for x in table["keys"]]
        key = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint64)
        told = np.frombuffer(b"".join(zlib.decompress(x) for x in table["extra"].to_pylist()), np.uint64)
        known, which = np.unique(key, return_inverse=True)
        totals = np.bincount(which, weights=told.astype(np.float64), minlength=len(known)).astype(np.uint64)
        unigram = known & WORD == 1
        answers = P.answered(table, sizes, totals[which])
        summary = np.array([totals[unigram].sum(), (totals[unigram] > 0).sum()], np.uint64).tobytes()
        shard = table["shard"][0].as_py()
        own = pa.table({"chunk": pa.array([-1], pa.int32()), "shard": pa.array([shard], pa.int32()), "answer": pa.array([summary])})
        return pa.concat_tables([answers, own.cast(answers.schema)])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.frombuffer(b"".join(batch.column("answer").to_pylist()), np.uint64).reshape(-1, 2).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([int(both[0])]), pa.array([int(both[1])])], ["n", "v"])

    answers = C.ask(chunks, ask, count)
    summed = answers.filter("chunk = -1").mapInArrow(sums, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    tokens, types = summed[0] or 0, summed[1] or 0
    uniform = 1.0 / (types + 1)
    told = answers.filter("chunk >= 0")

    def histogram(rows: pa.Table, answers: pa.Table) -> pa.Table:
        known, one, two, context, _, _, learned, _ = grams(rows)
        counts = P.in_order(answers, np.uint64).astype(np.float64)
        c1, c2, cc = counts[one][learned] - 1, counts[two][learned] - 1, counts[context][learned] - 1
        b2 = binned(np.divide(c2, cc, out=np.zeros_like(c2), where=cc > 0), uniform)
        b1 = binned(c1 / max(tokens - 1, 1), uniform)
        cells, seen = np.unique(np.stack((bucket_of(cc), b2, b1)), axis=1, return_counts=True)
        return pa.table({"b": cells[0].astype(np.int64), "b2": cells[1], "b1": cells[2], "n": seen})

    found = C.both(chunks, told, histogram, "b long, b2 long, b1 long, n long")
    cells = found.groupBy("b", "b2", "b1").agg(F.sum("n").alias("n"))
    collected = [tuple(r) for r in cells.collect()]
    weights = learn(np.array(collected, np.int64).reshape(-1, 4), uniform)

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        known, one, two, context, starts, held, _, _ = grams(rows)
        counts = P.in_order(answers, np.uint64).astype(np.float64)
        c1, c2, cc = counts[one], counts[two], counts[context]
        w = weights[bucket_of(cc)]
        p = w[:, 0] * np.divide(c2, cc, out=np.zeros_like(c2), where=cc > 0) + w[:, 1] * (c1 / max(tokens, 1)) + w[:, 2] * uniform
        base = np.log10((c1 + 1) / (tokens + types + 1))
        return pa.table({
            "doc_id": rows["__id"],
            "held_out": pa.array(held),
            "n_tokens": pa.array(np.diff(np.append(starts, len(one))), pa.int64()),
            "n_known": pa.array(np.add.reduceat((c1 > 0).astype(np.int64), starts), pa.int64()),
            "train_tokens": pa.array([tokens] * len(held), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, starts)),
            "score": pa.array(np.add.reduceat(np.log10(p), starts)),
        })

    return C.both(chunks, told, score, C.result_schema(RESULT))


def op2_deleted_interpolation(spark, sf_dir: str) -> DataFrame:
    """log10 probability of every document."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
