"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

The model is trained on all rows labelled as good that are not held out. It is never put together: every n-gram's counts
are whole numbers, which chunks of documents ask for. Texts are turned into numbers of their words once, by chunk. Then,
for triples, pairs and words in turn, every chunk sends its sorted distinct n-grams with what it adds to their counts to
shards of the hash space; a shard adds up and tells each chunk the sums in the order of the chunk's own keys.

* A triple's count is how often it stands in trusted texts. One chunk is told that the triple is its own.
* That chunk counts it for the pair it ends in (continuations) and for the pair it begins with (a context).
* In the same way a pair counts once, for its last word and for its first.

So every sum is taken in the chunks first and no task depends on how frequent an n-gram is. The questions of a level go
out in slices of the hash space, one after the other, and the files of a slice are removed before the next.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sliceward.llm import chunks as C
from sliceward.llm import packed as P
from sliceward.llm import textarrays as T
from sliceward.llm.chunks import beside_tasks
from sliceward.sources.stored import scratch_name, settle, shuffles_dropped

FOLDS, HELD_OUT = 5, 0
#: Ids of trusted documents up to which a join is by broadcast.
FEW_TRUSTED = 2_000_000
#: Bytes of text in a chunk: in larger ones fewer words stand twice.
CHUNK_BYTES = 16 << 20
#: Words of the n-grams of a level, and the slices of the hash space in which they are asked for.
LEVELS = ((3, 3), (2, 5), (1, 2))
#: Parts of the chunks that are scored one after the other.
SCORED = 4
#: A document is kept up to this quantile of its language's trusted perplexities.
QUANTILE = 0.99
START, END = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x5851F42D4C957F2D)
ODD1, ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
TOKENS = "chunk long, words binary, once int, tokens binary, starts binary, asked binary, trusted binary, ids array<bigint>, langs array<string>"
ASKED = "chunk long, part int, keys binary, counts binary"
ADDS = "chunk long, slice int, counts binary"
TOLD = "chunk long, part int, level int, counts binary, contexts binary, totals array<bigint>"


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, each text followed by its end; first token of every text."""
    raw, offsets = T.utf8(column)
    (words,), at = T.word_hashes(raw, offsets, [T.SpanHash(41)], lower=True)
    ends = at[1:] + np.arange(1, len(at))
    tokens = np.full(len(words) + len(at) - 1, END)
    inside = np.ones(len(tokens), bool)
    inside[ends - 1] = False
    tokens[inside] = words
    return tokens, np.concatenate(([0], ends[:-1])).astype(np.int64)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return T.mix(a * ODD1 + b)


def triple(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return T.mix(pair(a, b) * ODD2 + c)


def discounts(n: dict[int, float]) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams counted once to four times; kept within 0 and the count."""
    y = n.get(1, 0) / (n[1] + 2 * n.get(2, 0)) if n.get(1) else 0.5
    made = [k - (k + 1) * y * n.get(k + 1, 0) / n[k] if n.get(k) else k * 0.5 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k * 0.95) for k, d in zip((1, 2, 3), made, strict=True)]


def numbered(rows: DataFrame, chunk_bytes: int) -> tuple[DataFrame, str, int]:
    """The texts by chunk as numbers of the chunk's words, stored without a shuffle; the table's name and its buckets.

    rows: doc_id, lang, text, asked and trusted. A chunk is a part of one input partition. Its words have their hashes.
    """

    def chunk(k: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        tokens, starts = tokens_of(table["text"])
        words, at, often = np.unique(tokens, return_inverse=True, return_counts=True)
        # Frequent words have small numbers, which take little room; words that stand once share one and follow by place.
        last = np.empty(len(words), np.int64)
        last[at] = np.arange(len(at))
        order = np.lexsort((last, -often))
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        marks = [np.packbits(table[c].to_numpy()).tobytes() for c in ("asked", "trusted")]
        columns = [[(TaskContext.get().partitionId() << 32) + k], [words[order].tobytes()], [int((often == 1).sum())], [P.planes(np.minimum(place[at], np.uint32((often > 1).sum())))], [starts.tobytes()]]
        columns += [[m] for m in marks] + [[table["doc_id"].to_pylist()], [table["lang"].to_pylist()]]
        kinds = [pa.int64(), pa.binary(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.int64()), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, k = [], 0, 0
        for batch in batches:
            _, offsets = T.utf8(batch.column("text"))
            for low, high in T.steps(offsets, max(1, chunk_bytes // 8)):
                held.append(batch.slice(low, high - low))
                size += int(offsets[high] - offsets[low]) + 8 * (high - low)
                if size > chunk_bytes - chunk_bytes // 8:
                    yield chunk(k, held)
                    held, size, k = [], 0, k + 1
        if held:
            yield chunk(k, held)

    names = [c.split()[0] for c in TOKENS.split(", ")]
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(8))).first()[0] or 0
    n = min(C.MOST_BUCKETS, max(1, math.ceil(size / chunk_bytes)))
    name = scratch_name(spark, "kn_tokens")
    made = rows.select("doc_id", "lang", "text", "asked", "trusted").mapInArrow(work, TOKENS)
    made.write.format("parquet").option("compression", "zstd").bucketBy(n, "chunk").saveAsTable(name)
    return spark.table(name), name, n


class Grams:
    """The n-grams of a chunk's tokens."""

    def __init__(self, row: dict) -> None:
        self.words = words = np.frombuffer(row["words"], np.uint64)
        self.place = place = P.from_planes(row["tokens"], np.uint32)
        once = np.flatnonzero(place == len(words) - row["once"])
        place[once] += np.arange(row["once"], dtype=np.uint32)
        self.w = words[place]
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.lengths = np.diff(np.append(self.starts, len(self.w)))
        self.asked, self.trusted = (np.unpackbits(np.frombuffer(row[c], np.uint8), count=len(self.starts)).astype(bool) for c in ("asked", "trusted"))
        self.v = self.before(self.w, START)

    def before(self, values: np.ndarray, at_start) -> np.ndarray:
        """For every token the value of the token before it in its text."""
        made = np.roll(values, 1)
        made[self.starts] = at_start
        return made

    def keys(self, level: int) -> np.ndarray:
        """The n-gram that ends in every token; for words each once. Those that are only a context come last."""
        if level == 3:
            return triple(self.before(self.v, START), self.v, self.w)
        return np.append(pair(self.v, self.w), pair(START, START)) if level == 2 else np.append(self.words, START)

    def level(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Sorted distinct n-grams, and where those that end in a token and those that are its context are in them."""
        known, at = np.unique(self.keys(level), return_inverse=True)
        if level == 3:
            return known, at, None
        own = at[:-1] if level == 2 else at[self.place]
        return known, own, self.before(own, at[-1])


def adds(grams: Grams, level: int, above: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """What a chunk adds to the counts of its n-grams: as predicted; and as a context the n-grams of one word more that
    are counted 1, 2, 3 or more, and by how much they exceed 3 in all.

    above: the counts of the n-grams of one word more, and which of them are its own.
    """
    known, own, context = grams.level(level)
    if level == 3:
        return known, [np.bincount(own[np.repeat(grams.trusted, grams.lengths)], minlength=len(known))]
    longer, at, _ = grams.level(level + 1)
    token = np.empty(len(longer), np.int64)
    token[at] = np.arange(len(at))
    mine = above[1] > 0
    token, count = token[mine], above[0][mine]
    ends, begins = own[token], context[token]
    classes = [np.bincount(begins[np.minimum(count, 3) == k], minlength=len(known)) for k in (1, 2, 3)]
    beyond = np.bincount(begins, weights=np.maximum(count - 3, 0), minlength=len(known)).astype(np.int64)
    return known, [np.bincount(ends, minlength=len(known)), *classes, beyond]


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts of the hash space are ranges, so sorted keys are sorted by part."""
    return ((keys >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def told_of(answers: pa.Table, level: int, column: str = "counts") -> list[np.ndarray]:
    """The answers about a level in the order of the chunk's keys."""
    rows = [r for r in answers.select(["part", "level", column]).to_pylist() if r["level"] == level]
    found = [P.whole_numbers(r[column]) for r in sorted(rows, key=lambda r: r["part"])]
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def cut(chunk: int, keys: np.ndarray, counts: list[np.ndarray], parts: int) -> pa.Table:
    """ASKED rows of a chunk."""
    part = part_of(keys, parts)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(cuts[1:], len(part))
    blocks = [(P.gaps(keys[a:b]), P.small([c[a:b] for c in counts])) for a, b in zip(cuts, ends, strict=True)] if len(part) else []
    columns = {"chunk": pa.array([chunk] * len(blocks), pa.int64()), "part": pa.array(part[cuts] if len(part) else [], pa.int32())}
    return pa.table(columns | {c: pa.array([b[i] for b in blocks], pa.binary()) for i, c in enumerate(("keys", "counts"))})


def answering(level: int) -> Callable[[pa.Table], pa.Table]:
    return lambda table: summed(table, level)


def summed(table: pa.Table, level: int) -> pa.Table:
    """TOLD rows of a part: for every chunk the sums of its keys, and which of them are its own; one key belongs to one chunk."""
    table = table.sort_by("chunk")
    keys = [P.from_gaps(x.as_py()) for x in table["keys"]]
    ends = np.cumsum([0, *map(len, keys)])
    counts = [np.concatenate(c) for c in zip(*(P.whole_numbers(x.as_py()) for x in table["counts"]), strict=True)]
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = [np.bincount(at, weights=c, minlength=len(known)).astype(np.int64) for c in counts]
    first, some = np.full(len(known), -1), np.flatnonzero(counts[0])[::-1]
    first[at[some]] = some
    mine = np.zeros(len(at), np.int64)
    mine[first[first >= 0]] = 1
    spans = [*zip(ends[:-1], ends[1:], strict=True)]
    blocks = [P.small([sums[0][at[a:b]], mine[a:b]]) for a, b in spans]
    contexts = [P.small([s[at[a:b]] for s in sums[1:]]) if sums[1:] else None for a, b in spans]
    totals = [*(int((sums[0] == k).sum()) for k in (1, 2, 3, 4)), int((sums[0] > 0).sum()), int(sums[0].sum())]
    n = len(blocks)
    columns = [[*table["chunk"].to_pylist(), -1], [table["part"][0].as_py()] * (n + 1), [level] * (n + 1), [*blocks, None], [*contexts, None], [None] * n + [totals]]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = [c.split()[0] for c in TOLD.split(", ")]
    return pa.table({name: pa.array(c, t) for name, c, t in zip(names, columns, kinds, strict=True)})


def added(tokens: DataFrame, told: DataFrame, level: int, slices: int, parts: int) -> DataFrame:
    """What the chunks add to the counts of a level, by slice of the hash space and in the order of their keys there."""

    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        keys, counts = adds(Grams(row), level, told_of(answers, level + 1))
        ends = np.searchsorted(part_of(keys, parts), np.arange(slices + 1) * (parts // slices))
        blocks = [P.small([c[a:b] for c in counts]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        chunk, slice_of = pa.array([row["chunk"]] * slices, pa.int64()), pa.array(range(slices), pa.int32())
        return pa.table({"chunk": chunk, "slice": slice_of, "counts": pa.array(blocks, pa.binary())})

    known = told.filter("chunk >= 0").select("chunk", "part", "level", "counts")
    return tokens.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(work, ADDS)


def asked(tokens: DataFrame, made: DataFrame | None, level: int, low: int, high: int, parts: int) -> DataFrame:
    """ASKED rows for the parts from low to below high; made: what the chunks add there, unless these are triples."""

    def within(grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = grams.keys(level)
        part = part_of(keys, parts)
        some = (part >= low) & (part < high)
        return some, *np.unique(keys[some], return_inverse=True)

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            grams = Grams(row)
            some, known, at = within(grams)
            trusted = np.repeat(grams.trusted, grams.lengths)[some]
            yield from cut(row["chunk"], known, [np.bincount(at[trusted], minlength=len(known))], parts).combine_chunks().to_batches()

    def shorter(rows: pa.Table, counts: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        return cut(row["chunk"], within(Grams(row))[1], P.whole_numbers(counts["counts"][0].as_py()), parts)

    if made is None:
        return tokens.mapInArrow(triples, ASKED)
    return tokens.groupBy("chunk").cogroup(made.groupBy("chunk")).applyInArrow(shorter, ASKED)


def counted(tokens: DataFrame, n: int, names: list[str]) -> DataFrame:
    """TOLD rows of all levels, stored; the names of their tables are added to names."""
    spark = tokens.sparkSession
    every: dict[int, DataFrame] = {}

    def store(rows: DataFrame, stem: str) -> DataFrame:
        names.append(scratch_name(spark, stem))
        rows.write.format("parquet").option("compression", "zstd").saveAsTable(names[-1])
        return spark.table(names[-1])

    for level, slices in LEVELS:
        each = math.ceil(n / slices)
        parts, made = each * slices, None
        if level + 1 in every:
            made = store(added(tokens, every[level + 1], level, slices, parts), f"kn_adds_{level}")
        for k in range(slices):
            sent = asked(tokens, made and made.filter(F.col("slice") == k), level, k * each, (k + 1) * each, parts)
            found = store(sent.groupBy("part").applyInArrow(answering(level), TOLD), f"kn_told_{level}")
            every[level] = every[level].unionByName(found) if k else found
        if made:
            spark.sql(f"DROP TABLE {names.pop(-1 - slices)}")
    return reduce(DataFrame.unionByName, every.values())


def weighed(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, lang and perplexity (per token, the end included) of every row that is asked, stored.

    rows: doc_id, lang, text; asked; trusted, which the model learns from.
    """
    spark = rows.sparkSession
    with shuffles_dropped(spark):
        tokens, *names, n = numbered(rows, chunk_bytes)
        told = counted(tokens.drop("ids", "langs"), n, names)
        sums = [F.sum(F.col("totals")[i]).alias(str(i)) for i in range(6)]
        totals = {r.level: r for r in told.filter("chunk = -1").groupBy("level").agg(*sums).collect()}
        off = {k: np.array([0.0, *discounts({c: r[str(c - 1)] for c in (1, 2, 3, 4) if r[str(c - 1)]})]) for k, r in totals.items()}
        ones = totals.get(1)
        words, whole = (ones["4"], ones["5"] or 1) if ones else (0, 1)
        spared = float(off[1][1:] @ [ones["0"], ones["1"], words - ones["0"] - ones["1"]]) if words else float(whole)
        unknown = spared / whole / (words + 1)

        def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
            row = rows.to_pylist()[0]
            grams = Grams(row)
            _, at, before = grams.level(1)
            c, _ = told_of(answers, 1)
            p = np.where(c > 0, (c - off[1][np.minimum(c, 3)]) / whole, 0.0)[at] + unknown
            for level in (2, 3):
                *classes, beyond = told_of(answers, level - 1, "contexts")
                n = (sum(k * x for k, x in enumerate(classes, 1)) + beyond)[before]
                kept = sum(d * x for d, x in zip(off[level][1:], classes, strict=True))[before]
                _, at, before = grams.level(level)
                c = told_of(answers, level)[0][at]
                seen = np.maximum(n, 1)
                p = np.where(n > 0, (c - off[level][np.minimum(c, 3)]) / seen + kept / seen * p, p)
            made = 10 ** (-np.add.reduceat(np.log10(p), grams.starts) / grams.lengths)
            asked = np.flatnonzero(grams.asked)
            ids, langs = (pa.array(row[c], t).take(pa.array(asked)) for c, t in (("ids", pa.int64()), ("langs", pa.string())))
            return pa.table({"doc_id": ids, "lang": langs, "perplexity": made[asked]})

        results = []
        for k in range(SCORED):
            some = F.pmod(F.xxhash64("chunk"), F.lit(SCORED)) == k
            mine = told.drop("totals").filter(some & (F.col("chunk") >= 0)).groupBy("chunk")
            made = tokens.filter(some).groupBy("chunk").cogroup(mine).applyInArrow(scored, "doc_id long, lang string, perplexity double")
            results.append(settle(made, "perplexities"))
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return reduce(DataFrame.unionByName, results)


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, lang and perplexity (per token, the end included) of every row, under the model of other rows."""
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", F.lit(True).alias("asked"), F.lit(False).alias("trusted"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("lang", "string"))]
    return weighed(asked.unionByName(trusted.select(*none, "text", F.lit(False).alias("asked"), F.lit(True).alias("trusted"))))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, perplexity, threshold and keep of every row.

    The model learns from all rows labelled as good that are not held out (crc32 of doc_id modulo 5 is not 0). The
    threshold of a language is a quantile of the perplexities of its held-out good documents; a language without any,
    or a null language, has the quantile of all. Without good labels the threshold is null and every row is kept.
    Null and empty texts consist of the end alone and are judged like others. Labels without doc_id are left out; a
    row without doc_id is never trusted; repeated rows each count.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    # Only ids are sent to the documents, whose texts are not shuffled for it.
    trusted = beside_tasks(good.filter(~held_out()).withColumn("trusted", F.lit(True)), FEW_TRUSTED)
    marked = docs.select("doc_id", "lang", "text").join(trusted, "doc_id", "left")
    flags = F.lit(True).alias("asked"), F.coalesce("trusted", F.lit(False)).alias("trusted")
    scored = weighed(marked.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", *flags))
    checked = scored.join(good.filter(held_out()), "doc_id")
    middle = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    by_lang = checked.filter("lang IS NOT NULL").groupBy(F.col("lang").alias("l")).agg(middle.alias("own"))
    limits = scored.join(by_lang, F.col("lang") == F.col("l"), "left")
    every = F.lit(checked.agg(middle).first()[0]).cast("double")
    threshold = F.coalesce("own", every).alias("threshold")
    keep = F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("keep")
    return limits.select("doc_id", "lang", "perplexity", threshold, keep)


def op10_kneser_ney_quality(spark, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
