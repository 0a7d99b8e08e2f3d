"""SimHash near-dedup by anchor-point covering.

The 64 bits of a fingerprint are cut into blocks. If two fingerprints differ in at most ``threshold`` bits, they differ
in at most ``threshold // blocks`` bits of one block. The anchors of a block are the words of a covering code: a
Hamming code of 15 bits, whose words reach every pattern within one bit, beside free bits. A fingerprint is at home at
its nearest anchor (within the covering radius) and is replicated to every anchor within covering radius plus allowed
difference, so of two linked fingerprints one meets the other at the home of the first. Each anchor compares those at
home with all it received and hands on a spanning forest of the links, never the links of a dense group in full.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceward.llm.chunks import key_of, text_digest
from sliceward.sources.stored import Interim, settle

#: Bits in which linked fingerprints may differ.
THRESHOLD = 4
#: Words of a shingle.
SHINGLE = 4
#: Bits of the Hamming code at the start of each block, and its covering radius.
CODE_BITS, RADIUS = 15, 1
#: Fingerprints at one anchor from which on it is split into tiles of at most about this many.
TILE = 20_000


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, digest: bool = False) -> DataFrame:
    """The id of a row (doc_id, or one made from the text) and its SimHash: columns doc_id, id, fp (signed long) and, if
    wanted, digest, which tells texts apart.

    A-Z are lowered; a text of fewer words than a shingle is one shingle; null, empty and blank texts have 0.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xxh64 = xxhash.xxh64_intdigest
        for batch in batches:
            made = np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = (text or "").encode().lower().split()
                if not words:
                    continue
                joined = b" ".join(words)
                ends = list(itertools.accumulate(len(w) + 1 for w in words))
                starts = [0, *ends]
                last = ends[min(shingle, len(words)) - 1 :]
                values = np.fromiter((xxh64(joined[a : b - 1], 42) for a, b in zip(starts, last)), np.uint64, len(last))
                counts = np.zeros(64, np.int64)
                for at in range(0, len(values), 1 << 16):
                    bits = np.unpackbits(values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    counts += np.add.reduce(bits, axis=0, dtype=np.int64)
                made[i] = np.packbits(counts * 2 > len(values), bitorder="little").view(np.uint64)[0]
            columns = [batch.column("doc_id"), batch.column("id"), pa.array(made.view(np.int64)), *([batch.column("digest")] if wanted else [])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "id", "fp", *wanted])

    wanted = ["digest"] if digest else []
    more = [text_digest().alias("digest")] if digest else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key_of(docs).alias("id"), "text", *more)
    return rows.mapInArrow(hashed, "doc_id long, id long, fp long" + ", digest string" * digest)


def ball(width: int, radius: int) -> np.ndarray:
    """For each syndrome of the code the flips of at most ``radius`` bits that lead to an anchor; -1 fills up."""
    found: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
    for weight in range(radius + 1):
        for bits in itertools.combinations(range(width), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= b + 1 if b < CODE_BITS else 0
            found[syndrome].append(sum(1 << b for b in bits))
    most = max(map(len, found))
    return np.array([x + [-1] * (most - len(x)) for x in found], np.int64)


def at_anchors(fps: DataFrame, threshold: int = THRESHOLD, blocks: int = 3) -> DataFrame:
    """anchor, fp, home: every fingerprint at each anchor near enough, and once more where it is at home."""
    if 64 // blocks <= CODE_BITS:
        raise ValueError("a block must be longer than the code")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    syndromes = np.zeros(1 << CODE_BITS, np.int64)
    for b in range(CODE_BITS):
        syndromes ^= np.where(np.arange(1 << CODE_BITS) >> b & 1, b + 1, 0)
    balls = {w: ball(w, RADIUS + threshold // blocks) for w in {b - a for a, b in itertools.pairwise(cuts)}}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for block, (low, high) in enumerate(itertools.pairwise(cuts)):
                value = (fp >> np.uint64(low) & np.uint64((1 << high - low) - 1)).astype(np.int64)
                syndrome = syndromes[value & (1 << CODE_BITS) - 1]
                flips = balls[high - low][syndrome]
                near = np.where(flips >= 0, value[:, None] ^ flips, -1)
                home = value ^ np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)
                who, which = np.nonzero(near >= 0)
                anchor = np.concatenate((near[who, which], home)) | block << 40
                both = np.concatenate((fp[who], fp)).view(np.int64)
                is_home = np.repeat([False, True], [len(who), len(fp)])
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(both), pa.array(is_home)], ["anchor", "fp", "home"])

    return fps.mapInArrow(spread, "anchor long, fp long, home boolean")


def links(fps: DataFrame, threshold: int = THRESHOLD, blocks: int = 3, tile: int = TILE) -> DataFrame:
    """a, b: pairs of distinct fingerprints whose connected components are those of all links.

    fps: distinct values in the column fp. An anchor with more than ``tile`` fingerprints is cut into tiles of those at
    home times those received, which are compared in tasks of their own.
    """
    placed = at_anchors(fps, threshold, blocks)
    sizes = placed.groupBy("anchor").count().filter(F.col("count") > tile)
    crowded = settle(sizes.select("anchor", F.ceil(F.col("count") / tile).cast("int").alias("cuts")), "crowded")
    cuts = F.coalesce("cuts", F.lit(1))
    own, every = F.pmod(F.xxhash64("fp"), cuts).cast("int"), F.sequence(F.lit(0), cuts - 1)
    tiles = (
        placed.join(crowded, "anchor", "left")
        .withColumn("x", F.explode(F.when(F.col("home"), F.array(own)).otherwise(every)))
        .withColumn("y", F.explode(F.when(F.col("home"), every).otherwise(F.array(own))))
        .select("anchor", "x", "y", "home", "fp")
    )

    def forest(members: np.ndarray, homes: np.ndarray, into: list[tuple[int, int]]) -> None:
        """Unite what is linked; hand on one pair for each two parts that come together.

        Of a split anchor, those at home are members too, though another tile may hold what their tile received of them.
        """
        whole = np.concatenate((members, homes[~np.isin(homes, members)]))
        part, order = np.arange(len(whole)), np.argsort(whole)
        for h, own in zip(homes, order[np.searchsorted(whole, homes, sorter=order)], strict=True):
            near = np.flatnonzero(np.bitwise_count(members ^ h) <= threshold)
            if not len(near) or len(near) == 1 and near[0] == own:
                continue
            parts = np.unique(part[np.append(near, own)])
            if len(parts) > 1:
                into.extend((int(whole[parts[0]]), int(whole[p])) for p in parts[1:])
                part[np.isin(part, parts)] = parts[0]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles come one after the other; only one is held."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        key = None
        found: list[tuple[int, int]] = []

        def close() -> None:
            fp = np.concatenate([x[0] for x in held])
            home = np.concatenate([x[1] for x in held])
            if home.any() and not home.all():
                forest(fp[~home], fp[home], found)

        def out() -> pa.RecordBatch:
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "x", "y")]
            fp, home = batch.column("fp").to_numpy().view(np.uint64), batch.column("home").to_numpy(zero_copy_only=False)
            change = np.zeros(len(fp), bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts_at = [0, *np.flatnonzero(change).tolist(), len(fp)]
            for a, b in itertools.pairwise(cuts_at):
                if a == b:
                    continue
                now = tuple(int(c[a]) for c in columns)
                if now != key:
                    if held:
                        close()
                    held, key = [], now
                held.append((fp[a:b], home[a:b]))
            if found:
                yield out()
        if held:
            close()
        yield out()

    dealt = tiles.repartition("anchor", "x", "y").sortWithinPartitions("anchor", "x", "y")
    return settle(dealt.mapInArrow(compare, "a long, b long").distinct(), "links")


def components(pairs: DataFrame) -> DataFrame:
    """node, root: the smallest node of the component of every node that has a pair.

    Alternating stars: each node hands its larger neighbours to its smallest neighbour, then each its smaller ones.
    Every round reduces with partial minima and is stored; rounds grow with the logarithm of the component's size.
    """
    interim = Interim(pairs.sparkSession)
    edges = interim.settle(pairs.select("a", "b").filter("a <> b"), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = interim.settle(small.filter("a <> b").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def rooted_classes(rows: DataFrame, threshold: int, blocks: int = 3) -> DataFrame:
    """fp, least (its smallest id) and root of every fingerprint."""
    classes = settle(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(links(classes.select("fp"), threshold, blocks))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left")
    return rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_copies(docs: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE, blocks: int = 3) -> DataFrame:
    """Per row: doc_id, id, fp (signed long) and component_id, the smallest id that links lead to.

    Fingerprints of at most ``threshold`` different bits are linked; that of texts without words is zero and linked
    like any other. A null doc_id gets an id above 2**62 from the text, so that it never stands for a group with a
    known document; rows with the same doc_id and text have the same fingerprint and component.
    """
    rows = settle(fingerprints(docs, shingle), "fingerprints")
    rooted = settle(rooted_classes(rows, threshold, blocks), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "id", "fp", "component_id")


def keep_one(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id, then the smallest digest of its text.

    Rows are told apart by doc_id and text, so a doc_id that stands for texts that are no copies keeps one row for each
    group; of rows that agree in both, one stays. An empty table gives no rows.
    """
    rows = settle(fingerprints(docs, digest=True), "fingerprints")
    rooted = rows.join(rooted_classes(rows, threshold), "fp")
    kept = rooted.groupBy("root").agg(F.min(F.struct("id", "digest")).alias("k"))
    kept = kept.select(F.col("k.id").alias("__id"), F.col("k.digest").alias("__digest"))
    whole = docs.select(F.struct("*").alias("row"), key_of(docs).alias("__id"), text_digest().alias("__digest"))
    return whole.join(kept, ["__id", "__digest"], "left_semi").dropDuplicates(["__id", "__digest"]).select("row.*")


def op4_simhash_anchors(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    found = near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")
