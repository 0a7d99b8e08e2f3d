"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into overlapping passages of two blocks of words. Passages are TF-IDF vectors over hashed words (a word
counts once in a block, so that a repeated mark does not drown the rest); document
frequencies are counted over all documents. A randomised singular value decomposition (range finder with power
iterations) of the benchmark's passages and all documents' passages gives the latent space. The same scan that counts
frequencies counts, exactly and in whole numbers, the products of the passages' rows, as the weights can follow; Spark
adds them up by blocks of features, and the range finder multiplies by these blocks. The space is spanned by the
features that items have, as no other one can bring a passage nearer to an item. Every passage is projected, its cosine with every benchmark item decides whether it is a candidate, and candidates are
checked at once, where their words are: by the longest common subsequence with the item and by the share of the item's
answer words that the place holds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceward.llm import textarrays as T
from sliceward.llm.chunks import key_of
from sliceward.sources.stored import settle

#: Words of a block; a passage has two, and passages overlap by one.
BLOCK = 24
#: Bits of a word's hash that make its feature; dimensions of the latent space and some more while it is sought.
FEATURE_BITS, RANK, MORE, POWERS = 18, 192, 16, 2
#: How much more than all documents the items weigh in the fit, so that the latent space keeps them apart.
ITEMS_WEIGH = 10
#: Items whose vectors are sent to tasks at once; more are handled in further passes over the documents.
ITEMS_AT_ONCE = 5_000
#: Least cosine of a candidate, least share of the item's words in order, least share of its answer words.
COSINE, IN_ORDER, ANSWER = 0.4, 0.5, 0.5
#: Share of an item's distinct words that count as its answer: the rarest.
ANSWER_PART = 1 / 3
#: Bytes of text whose words are multiplied at once.
STEP = 256 << 10
#: Features whose sums travel together, and rows of products that do.
FEATURE_BLOCK, PRODUCT_ROWS = 1024, 32
#: Document frequencies that travel together; the key of the number of documents among them.
FREQUENCIES, ALL = 1 << 14, 1 << FEATURE_BITS
#: Pairs of features that are counted at once, and different ones that a task holds before it hands them on.
PAIRS, HELD = 2_000_000, 2_000_000
COUNTED = "part int, block int, held binary"


def cut(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of texts: first word of each; passages: their first and last block (one of two at least)."""
    counts = -(-np.diff(at) // BLOCK)
    first = np.concatenate(([0], np.cumsum(counts)))
    inside = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    heads = np.repeat(at[:-1], counts) + inside * BLOCK
    last = inside == np.repeat(counts, counts) - 1
    begin = np.flatnonzero(~last | (inside == 0))
    return heads, begin, np.where(last[begin], begin, begin + 1)


def features_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """In steps of some texts: which texts, the words' hashes, and the texts' offsets in them."""
    raw, offsets = T.utf8(column)
    for low, high in T.steps(offsets, STEP):
        part = raw[offsets[low] : offsets[high]]
        (words,), at = T.word_hashes(part, offsets[low : high + 1] - offsets[low], [T.SpanHash(51)], lower=True)
        yield low, high, words, at


def distinct(keys: np.ndarray) -> np.ndarray:
    """The different keys from 0 on, sorted in place; much faster than by a hash table."""
    keys.sort()
    return keys[np.diff(keys, prepend=-1) != 0]


def block_features(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every block, distinct features by block, and where each block begins in these."""
    heads, _, _ = cut(at)
    block = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(words))))
    own = distinct(block << FEATURE_BITS | (words >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
    return heads, own & (1 << FEATURE_BITS) - 1, np.searchsorted(own, np.arange(len(heads)) << FEATURE_BITS)


def of_items(column: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns below ``size``, how many of them each block has, and where they begin."""
    inside = column < size
    kept = np.add.reduceat(inside, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return column[inside], kept, np.concatenate(([0], np.cumsum(kept)))


class Space:
    """Which column a feature has (the last for all that no item has), weights, and the basis by column."""

    def __init__(self, features: np.ndarray, idf: np.ndarray, basis: np.ndarray | None = None) -> None:
        self.features, self.idf = features, idf.astype(np.float32)
        self.column = np.full(len(idf), len(features), np.int32)
        self.column[features] = np.arange(len(features))
        self.basis = basis

    def with_basis(self, basis: np.ndarray) -> Space:
        """basis: a row for each of the features; it is weighted here."""
        weighted = np.zeros((len(self.features) + 1, basis.shape[1]), np.float32)
        weighted[:-1] = basis * self.idf[self.features][:, None]
        return Space(self.features, self.idf, weighted)

    def passages(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors of the passages, their first word, and the word after the last."""
        heads, begin, end = cut(at)
        if not len(heads):
            return np.zeros((0, self.basis.shape[1]), np.float32), heads, heads
        _, feature, first = block_features(words, at)
        column, kept, at_block = of_items(self.column[feature], first, len(self.features))
        sums = np.zeros((len(heads), self.basis.shape[1]), np.float32)
        some = np.flatnonzero(kept)
        if len(some):
            sums[some] = np.add.reduceat(self.basis[column], at_block[some], axis=0)
        made = sums[begin] + np.where((end > begin)[:, None], sums[end], 0)
        return made, heads[begin], np.append(heads[1:], len(words))[end]


def pairs_of(column: np.ndarray, start: np.ndarray, stop: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Keys i * size + j of the products of passages, whose entries stand from start to stop, for i up to j.

    An entry that stands in both blocks of a passage counts as two, so its square is four.
    """
    number = stop - start
    ends = np.cumsum(number * (number + 1) // 2)
    cuts = np.searchsorted(ends, np.arange(0, max(1, ends[-1]), PAIRS))
    for low, high in zip(cuts, [*cuts[1:], len(number)], strict=True):
        n = number[low:high]
        here = np.repeat(start[low:high] - np.cumsum(n) + n, n) + np.arange(n.sum())
        after = np.repeat(stop[low:high], n) - here - 1
        left = np.repeat(here, after)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
        x, y = column[left], column[right]
        keys = np.minimum(x, y) * np.int64(size) + np.maximum(x, y)
        yield np.concatenate((keys, keys[x == y], column[here] * np.int64(size + 1)))


def packed(key: np.ndarray, n: np.ndarray) -> bytes:
    return zlib.compress(np.diff(key, prepend=0).astype(np.int32).tobytes() + n.astype(np.int64).tobytes(), 1)


def unpacked(held: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(held)
    return np.cumsum(np.frombuffer(raw, np.int32, len(raw) // 12), dtype=np.int64), np.frombuffer(raw, np.int64, offset=len(raw) // 3)


def counts_of(texts: DataFrame, own: list[np.ndarray]) -> DataFrame:
    """What the fit needs, in whole numbers, by part and block: stored rows COUNTED.

    Part -1: in how many texts each feature stands and, under ALL, the number of texts. Part p: the sums over all passages
    of the products of the entries of two of the features own[p], for columns i up to j.
    """
    spans = {-1: FREQUENCIES, **{p: PRODUCT_ROWS * len(features) for p, features in enumerate(own)}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        fresh: dict[int, list[np.ndarray]] = {part: [] for part in spans}
        columns = [Space(features, np.zeros(1 << FEATURE_BITS)).column for features in own]

        def add(part: int, keys: np.ndarray) -> None:
            if len(keys):
                fresh[part].append(keys)
            if sum(map(len, fresh[part])) >= PAIRS:
                unite(part)

        def unite(part: int) -> None:
            key, n = np.unique(np.concatenate(fresh[part]), return_counts=True)
            fresh[part] = []
            if part in held:
                known, sums = held[part]
                at = np.searchsorted(known, key)
                old = known[np.minimum(at, len(known) - 1)] == key
                sums[at[old]] += n[old]
                key, n = np.insert(known, at[~old], key[~old]), np.insert(sums, at[~old], n[~old])
            held[part] = key, n

        def out() -> Iterator[pa.RecordBatch]:
            for part in [part for part, keys in fresh.items() if keys]:
                unite(part)
            for part, (key, n) in held.items():
                block = key // spans[part]
                at = np.flatnonzero(np.diff(block, prepend=-1))
                made = [packed(key[a:b] - block[a] * spans[part], n[a:b]) for a, b in zip(at, [*at[1:], len(key)], strict=True)]
                arrays = [pa.array(np.full(len(at), part), pa.int32()), pa.array(block[at], pa.int32()), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "block", "held"])
            held.clear()

        for batch in batches:
            if batch.num_rows:
                add(-1, np.full(batch.num_rows, ALL))
            for low, high, words, at in features_of(batch.column("text")):
                heads, begin, end = cut(at)
                if not len(heads):
                    continue
                _, feature, first = block_features(words, at)
                entries = np.diff(np.append(first, len(feature)))
                doc = np.repeat(np.searchsorted(at, heads, side="right") - 1, entries)
                add(-1, distinct(doc << FEATURE_BITS | feature) & (1 << FEATURE_BITS) - 1)
                for part, column in enumerate(columns):
                    inside, _, at_block = of_items(column[feature], first, len(own[part]))
                    for keys in pairs_of(inside, at_block[begin], at_block[end + 1], len(own[part])):
                        add(part, keys)
                if sum(len(key) for key, _ in held.values()) > HELD:
                    yield from out()
        yield from out()

    def summed(table: pa.Table) -> pa.Table:
        total = np.zeros(spans[table["part"][0].as_py()], np.int64)
        for held in table["held"]:
            key, n = unpacked(held.as_py())
            total[key] += n
        key = np.flatnonzero(total)
        return pa.table({"part": table["part"][:1], "block": table["block"][:1], "held": pa.array([packed(key, total[key])], pa.binary())})

    return settle(texts.select("text").mapInArrow(run, COUNTED).groupBy("part", "block").applyInArrow(summed, COUNTED), "products")


def document_frequencies(counts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature stands, and the number of documents."""
    frequencies = np.zeros((1 << FEATURE_BITS) + FREQUENCIES, np.int64)
    for row in counts.filter("part = -1").toLocalIterator():
        key, n = unpacked(row.held)
        frequencies[row.block * FREQUENCIES + key] = n
    return frequencies[: 1 << FEATURE_BITS], int(frequencies[ALL])


def latent_space(products: DataFrame, space: Space, rank: int = RANK) -> Space:
    """The space with the right singular vectors of the TF-IDF passages as basis. products: block, held and weight."""
    size = len(space.features)
    wide = min(rank + MORE, size)
    idf = space.idf[space.features]

    def multiplied(basis: np.ndarray) -> np.ndarray:
        """The products of all rows, times the basis."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, wide))
            for batch in batches:
                for block, held, weight in zip(*(batch.column(c).to_pylist() for c in ("block", "held", "weight")), strict=True):
                    key, n = unpacked(held)
                    low = block * PRODUCT_ROWS
                    rows = min(PRODUCT_ROWS, size - low)
                    dense = np.zeros(rows * size, np.float32)
                    dense[key] = n * weight
                    dense = dense.reshape(rows, size) * idf[low : low + rows, None] * idf
                    total[low : low + rows] += dense @ basis
                    # The other triangle; squares stand in the first one.
                    dense[np.arange(rows), low + np.arange(rows)] = 0
                    total += dense.T @ basis[low : low + rows]
            for k, x in enumerate(np.split(total, range(FEATURE_BLOCK, size, FEATURE_BLOCK))):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([x.tobytes()])], ["block", "sums"])

        found = products.mapInArrow(run, "block long, sums binary").groupBy("block").applyInArrow(add, "block long, sums binary")
        return np.frombuffer(b"".join(found.toArrow().sort_by("block")["sums"].to_pylist())).reshape(-1, wide)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x) for x in table["sums"].to_pylist())
        return pa.table({"block": table["block"][:1], "sums": pa.array([total.tobytes()])})

    basis = np.random.default_rng(5).standard_normal((size, wide)).astype(np.float32)
    for _ in range(POWERS):
        basis = np.linalg.qr(multiplied(basis))[0].astype(np.float32)
    values, vectors = np.linalg.eigh(basis.T @ multiplied(basis))
    return space.with_basis((basis @ vectors[:, np.argsort(values)[::-1][:rank]]).astype(np.float32))


def in_order(item: dict[int, int], n: int, place: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel. item: for each word the set of its places as bits."""
    full = (1 << n) - 1
    v = full
    for word in place:
        bits = item.get(word)
        if bits:
            u = v & bits
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def leaks(
    docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, share: float = IN_ORDER, answer: float = ANSWER
) -> DataFrame:
    """id, item_id, cosine, in_order and answer of every document and benchmark item that it holds.

    in_order is the share of the item's words in the longest common subsequence with the passage and its surroundings,
    answer the share of the item's answer words (its rarest third) there. Words are lower-cased (A-Z) runs without
    white space. Null, empty and wordless texts and items match nothing. id is doc_id, or an id above 2**62 made from
    the text; rows with the same id are one document. Repeated items count once each item_id; a null item_id stays null.
    """
    known = benchmark.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("item_id", "text").distinct()
    known = settle(known, "benchmark_items")
    n_items = known.count()
    schema = "id long, item_id long, cosine double, in_order double, answer double"
    if not n_items:
        return docs.sparkSession.createDataFrame([], schema)
    parts = -(-n_items // ITEMS_AT_ONCE)
    bounds = known.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int"))

    def items_of(part: int) -> pa.Table:
        return bounds.filter(F.col("part") == part).select("item_id", "text").toArrow()

    own = []
    for part in range(parts):
        held = [np.unique(words >> np.uint64(64 - FEATURE_BITS)).astype(np.int64) for _, _, words, _ in features_of(items_of(part)["text"])]
        own.append(np.unique(np.concatenate([np.zeros(0, np.int64), *held])))
    counts = counts_of(docs, own)
    frequencies, n_docs = document_frequencies(counts)
    idf = np.log((1 + n_docs) / (1 + frequencies)) + 0.1
    weight = max(1.0, ITEMS_WEIGH * n_docs / n_items)
    products = counts.withColumn("weight", F.lit(1.0)).unionByName(counts_of(known, own).withColumn("weight", F.lit(weight)))
    rows, found = docs.select(key_of(docs).alias("id"), "text"), None
    for part in range(parts):
        if not len(own[part]):
            continue
        items = items_of(part)
        space = latent_space(products.filter(F.col("part") == part), Space(own[part], idf))
        sent = docs.sparkSession.sparkContext.broadcast((space.features, space.idf, space.basis))
        hits = rows.mapInArrow(searcher(sent, items, frequencies, (cosine, share, answer)), schema)
        found = hits if found is None else found.unionByName(hits)
    best = found.groupBy("id", "item_id").agg(F.max(F.struct("in_order", "answer", "cosine")).alias("b"))
    return best.select("id", "item_id", "b.cosine", "b.in_order", "b.answer")


def searcher(sent, items: pa.Table, frequencies: np.ndarray, least: tuple[float, float, float]):
    """A function for mapInArrow that finds the items in batches of id and text."""
    cosine, share, answer = least
    ids = items["item_id"].to_pylist()
    texts = items["text"].combine_chunks()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(*sent.value)
        vectors, words_of, places, answers = [], [], [], []
        for _, _, words, at in features_of(texts):
            for i in range(len(at) - 1):
                own = words[at[i] : at[i + 1]]
                vectors.append(space.basis[space.column[np.unique((own >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))]].sum(axis=0))
                words_of.append(own)
                bits: dict[int, int] = {}
                for k, w in enumerate(own.tolist()):
                    bits[w] = bits.get(w, 0) | 1 << k
                places.append(bits)
                rare = sorted(bits, key=lambda w: (frequencies[w >> 64 - FEATURE_BITS], w))
                answers.append(set(rare[: max(1, round(len(rare) * ANSWER_PART))]))
        vectors = np.array(vectors, np.float32)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        for batch in batches:
            ident, out = batch.column("id"), []
            for low, _, words, at in features_of(batch.column("text")):
                made, begin, stop = space.passages(words, at)
                made /= np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)
                close = made @ vectors.T
                passage, item = np.nonzero(close >= cosine)
                doc = np.searchsorted(at, begin[passage], side="right") - 1
                for p, k, d in zip(passage.tolist(), item.tolist(), doc.tolist(), strict=True):
                    n = len(words_of[k])
                    place = words[max(at[d], begin[p] - n) : min(at[d + 1], stop[p] + n)].tolist()
                    here = answers[k].intersection(place)
                    if len(here) < answer * len(answers[k]):
                        continue
                    common = in_order(places[k], n, place)
                    if common >= share * n:
                        out.append((ident[low + d].as_py(), ids[k], float(close[p, k]), common / n, len(here) / len(answers[k])))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["id", "item_id", "cosine", "in_order", "answer"]
            )

    return search


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; rows as given."""
    dirty = leaks(docs, benchmark).select(F.col("id").alias("__id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), key_of(docs).alias("__id"))
    return rows.join(settle(dirty, "dirty"), "__id", "left_anti").select("row.*")


def op6_latent_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return leaks(docs, items).withColumnRenamed("id", "doc_id")
