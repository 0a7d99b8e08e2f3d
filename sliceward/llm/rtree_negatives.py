"""Hard-negative mining over STR-packed R-trees.

Vectors become integers, so inner products are exact. Rows are dealt by ranges of (label, slab of the widest
coordinate, second widest coordinate, id): sort-tile-recursive packing across the cluster. Inside a part, trees of a
bounded number of rows and of a single label are packed further, along more coordinates. A tree is one row of the index:
its vectors, and the bounding boxes of its leaves and inner nodes.

A box bounds the inner product with an anchor from both sides, coordinate by coordinate. The search takes boxes from a
queue, those with the largest upper bound first, each with the anchors that still need it: an anchor leaves a box whose
interval lies outside all of its score windows or whose upper bound is strictly below its k-th score. Two searches are
made: for the positives over trees of the anchor's label, then for the negatives over the others, in the windows that
the positives set. Anchors are a stated set; they go to the trees in blocks of bounded size. One tree in so many is
searched first, and its merged k-th scores are thresholds for the others, so a part hands on few rows beyond the true k.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sliceward.sources.stored import scratch_name, settle

#: Rows of a leaf, boxes of an inner node, rows of a tree.
LEAF, FAN_OUT, TREE_ROWS = 64, 8, 8192
#: Bytes of vectors in a part of the index.
PART_BYTES = 16 << 20
#: Bytes of anchors that are sent to the trees at once.
ANCHOR_BYTES = 8 << 20
#: Anchors that are searched together, which bounds the memory of a task.
ANCHORS_AT_ONCE = 1024
#: One tree in so many is searched first.
FIRST = 8
#: Coordinates that trees are tiled along.
TILED = 4
EVERY, POSITIVES, NEGATIVES, SCALE = 100, 5, 10, 256
#: A negative's score lies between these percentages of the positive's.
LOWEST, HIGHEST = 30, 90

LEAST = np.iinfo(np.int64).min // 2
FOUND = "anchor long, window int, id long, score long"


def integers(vectors: DataFrame, relabel: Column | None = None) -> DataFrame:
    """id, label and x of the rows that take part; x is floor(256 * component).

    Left out are rows with a null id, label or vector and those with a null or non-finite component. Of several rows with
    one id that with the smallest label, then the smallest vector, counts; so do repeated rows once. Components whose
    multiple does not fit a long are cut to the nearest long. A shorter vector counts as followed by zeros.
    """
    whole = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        (F.col("label") if relabel is None else relabel).cast("long").alias("label"),
        F.transform("embedding", lambda e: F.floor(e.cast("double") * SCALE).cast("long")).alias("x"),
        F.coalesce(whole, F.lit(False)).alias("whole"),
    ).filter("whole AND id IS NOT NULL AND label IS NOT NULL")
    return rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")


def matrix(column: pa.ChunkedArray | pa.Array, wide: int) -> np.ndarray:
    """Lists as rows of equal length, followed by zeros where they are shorter."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = array.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(array), wide), np.int64)
    out[np.arange(wide) < lengths[:, None]] = array.flatten().to_numpy(zero_copy_only=False)
    return out


def exact(x: np.ndarray, most: int, wide: int) -> np.ndarray:
    """The type in which inner products with numbers up to ``most`` are exact: double while sums stay below 2**49."""
    largest = int(max(-int(x.min()), int(x.max()))) if x.size else 0
    return x.astype(np.float64) if largest * most * max(wide, 1) < 1 << 49 else x.astype(object)


def packing(x: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order of the rows: slabs along the widest coordinate, each cut along the next one."""
    axes = np.argsort(-spread, kind="stable")[:TILED]

    def tile(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        rows = rows[np.argsort(x[rows, axes[depth]], kind="stable")]
        leaves = -(-len(rows) // LEAF)
        if leaves <= 1 or depth + 1 == len(axes):
            return [rows]
        slabs = int(np.ceil(leaves ** (1 / (len(axes) - depth))))
        wide = -(-leaves // slabs) * LEAF
        return [part for low in range(0, len(rows), wide) for part in tile(rows[low : low + wide], depth + 1)]

    return np.concatenate(tile(np.arange(len(x)), 0)) if len(x) and len(axes) else np.arange(len(x))


def tree_row(ids: np.ndarray, x: np.ndarray, label: int) -> dict:
    """A tree: rows in the order of its leaves, and per level, leaves first, the corners of its boxes."""
    order = packing(x, x.std(axis=0) if x.size else np.zeros(0))
    ids, x = ids[order], x[order]
    low, high = (np.stack([f(x[a : a + LEAF], axis=0) for a in range(0, len(x), LEAF)]) for f in (np.min, np.max))
    levels, corners = [len(low)], [(low, high)]
    while len(low) > 1:
        low, high = (np.stack([f(c[a : a + FAN_OUT], axis=0) for a in range(0, len(c), FAN_OUT)]) for f, c in ((np.min, low), (np.max, high)))
        levels.append(len(low))
        corners.append((low, high))
    lows, highs = (np.concatenate([c[k] for c in corners]) for k in (0, 1))
    return {"label": label, "ids": ids.tobytes(), "x": x.tobytes(), "levels": levels, "low": lows.tobytes(), "high": highs.tobytes()}


INDEX = "label long, ids binary, x binary, levels array<int>, low binary, high binary"


def build(rows: DataFrame) -> tuple[DataFrame, int]:
    """The index of rows (id, label, x), stored, and the length of the longest vector."""
    size = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    wide = max(size[1] or 0, 0)
    parts = max(1, -(-(size[0] * (wide + 2) * 8) // PART_BYTES))

    def spreads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(wide), np.zeros(wide)
        for batch in batches:
            x = matrix(batch.column("x"), wide).astype(np.float64)
            n, sums, squares = n + len(x), sums + x.sum(axis=0), squares + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"axis": np.arange(wide, dtype=np.int32), "n": np.full(wide, n), "s": sums, "q": squares})

    # One row per coordinate: bounded by the length of the vectors.
    spread = rows.select("x").mapInArrow(spreads, "axis int, n long, s double, q double").groupBy("axis")
    spread = spread.agg((F.sum("q") - F.sum("s") * F.sum("s") / F.greatest(F.sum("n"), F.lit(1))).alias("spread"))
    axes = [r["axis"] for r in spread.orderBy(F.desc("spread"), "axis").limit(2).collect()]
    first, second = (F.coalesce(F.get("x", F.lit(a)), F.lit(0)) for a in (axes * 2)[:2]) if axes else (F.lit(0), F.lit(0))
    slabs = min(1000, max(1, round(parts**0.5)))
    cuts = rows.agg(F.percentile_approx(first, [i / slabs for i in range(1, slabs)], 10_000)).first()[0] if slabs > 1 else []
    slab = F.size(F.filter(F.lit(cuts), lambda c: c <= first)) if cuts else F.lit(0)
    keys = [F.col("label"), F.col("slab"), F.col("along"), F.col("id")]
    placed = rows.select("id", "label", "x", slab.alias("slab"), second.alias("along"))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number, label = 0, None

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            return pa.RecordBatch.from_pylist([tree_row(table["id"].to_numpy(), matrix(table["x"], wide), label)], schema)

        for batch in batches:
            labels = batch.column("label").to_numpy()
            at = 0
            while at < len(labels):
                if held and (labels[at] != label or number == TREE_ROWS):
                    yield packed()
                    held, number = [], 0
                label = int(labels[at])
                end = at + int(np.argmax(np.append(labels[at:] != label, True)))
                end = min(end, at + TREE_ROWS - number)
                held.append(batch.slice(at, end - at))
                number, at = number + end - at, end
        if held:
            yield packed()

    schema = pa.schema([("label", pa.int64()), ("ids", pa.binary()), ("x", pa.binary()), ("levels", pa.list_(pa.int32())), ("low", pa.binary()), ("high", pa.binary())])
    dealt = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return settle(dealt.select("id", "label", "x").mapInArrow(trees, INDEX), "rtrees"), wide


class Tree:
    """A tree read from the index. Leaves are the first boxes; the children of a box are FAN_OUT of the level below."""

    def __init__(self, row: dict, wide: int) -> None:
        self.label, self.levels = row["label"], row["levels"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        boxes = sum(self.levels)
        shapes = (("x", len(self.ids)), ("low", boxes), ("high", boxes))
        self.x, self.low, self.high = (np.frombuffer(row[c], np.int64).reshape(n, wide) for c, n in shapes)
        self.first = np.concatenate(([0], np.cumsum(self.levels)))
        # Place of each row among the ids, from the largest down: of equal scores the smaller id is ahead.
        self.ahead = np.empty(len(self.ids), np.int64)
        self.ahead[np.argsort(-self.ids, kind="stable")] = np.arange(len(self.ids))

    def children(self, box: int) -> range:
        level = int(np.searchsorted(self.first, box, side="right")) - 1
        low = self.first[level - 1] + (box - self.first[level]) * FAN_OUT
        return range(low, min(low + FAN_OUT, self.first[level]))


def best_in_tree(
    tree: Tree, anchors: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, visited: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows for each anchor and window, LEAST where there are fewer.

    anchors: a row each; own: their ids, never found; low, high: the windows' inclusive bounds, a row per anchor.
    """
    most = int(max(-int(anchors.min()), int(anchors.max()), 1)) if anchors.size else 1
    x, box_low, box_high = (exact(m, most, anchors.shape[1]) for m in (tree.x, tree.low, tree.high))
    a = anchors.astype(x.dtype)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    upper = (up @ box_high.T + down @ box_low.T).astype(object if x.dtype == object else np.int64)
    lower = (up @ box_low.T + down @ box_high.T).astype(upper.dtype)
    if upper.dtype == object and upper.size and (upper.max() >= -LEAST or lower.min() <= LEAST):
        raise OverflowError("scores may not fit a long")
    base = 1 << 13
    top = np.full((*low.shape, k), LEAST, upper.dtype)
    least = low.astype(upper.dtype)

    def wanted(box: int, some: np.ndarray) -> np.ndarray:
        meets = (upper[some, box, None] >= least[some]) & (lower[some, box, None] <= high[some]) & (low[some] <= high[some])
        return some[meets.any(axis=1)]

    root = len(tree.low) - 1
    queue: list[tuple] = []

    def enter(box: int, some: np.ndarray) -> None:
        some = wanted(box, some)
        if len(some):
            heappush(queue, (-int(upper[some, box].max()), box, some))

    enter(root, np.arange(len(a)))
    while queue:
        _, box, some = heappop(queue)
        some = wanted(box, some)
        if not len(some):
            continue
        if visited is not None:
            visited.append((box, len(some)))
        if box >= tree.levels[0]:
            for child in tree.children(box):
                enter(child, some)
            continue
        rows = slice(box * LEAF, min((box + 1) * LEAF, len(tree.ids)))
        scores = (a[some] @ x[rows].T).astype(upper.dtype)
        # Score and place as one number, so that ties are in order of the ids.
        ranked = scores * base + tree.ahead[rows]
        ranked = np.where(tree.ids[rows] == own[some, None], LEAST, ranked)[:, None, :]
        inside = (scores[:, None, :] >= least[some][:, :, None]) & (scores[:, None, :] <= high[some][:, :, None])
        gain = inside.any(axis=(1, 2))
        some, ranked = some[gain], np.where(inside, ranked, LEAST)[gain]
        both = np.concatenate((top[some], ranked), axis=2)
        both = np.sort(both, axis=2) if both.dtype == object else np.partition(both, both.shape[2] - k, axis=2)
        top[some] = both[:, :, both.shape[2] - k :]
        kth = top[some].min(axis=2)
        least[some] = np.where(kth > LEAST, np.maximum(least[some], kth // base), least[some])
    there = top > LEAST
    by_rank = np.argsort(tree.ahead, kind="stable")
    ids = np.where(there, tree.ids[by_rank[np.where(there, top % base, 0).astype(np.int64)]], 0)
    return ids, np.where(there, top // base, LEAST)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best along the last axis: higher scores, then smaller ids."""
    order = np.lexsort((ids, -scores), axis=-1)[..., :k]
    return np.take_along_axis(ids, order, -1), np.take_along_axis(scores, order, -1)


def searched(index: DataFrame, wide: int, sent, same: bool, k: int) -> DataFrame:
    """FOUND: the k best of every part of the index for each anchor and window of a broadcast block.

    same: look in trees of the anchor's label only, else in all others.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = sent.value
        own, labels = told["id"].to_numpy(), told["label"].to_numpy()
        x = matrix(told["x"], wide)
        low, high, least = (matrix(told[c], told["windows"][0].as_py()) for c in ("low", "high", "least"))
        ids, scores = np.zeros((*low.shape, k), np.int64), np.full((*low.shape, k), LEAST)
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree(row, wide)
                mine = np.flatnonzero((labels == tree.label) == same)
                for at in range(0, len(mine), ANCHORS_AT_ONCE):
                    some = mine[at : at + ANCHORS_AT_ONCE]
                    floor = np.maximum(np.maximum(low[some], least[some]), scores[some].min(axis=2))
                    more = best_in_tree(tree, x[some], own[some], floor, high[some], k)
                    joined = (np.concatenate((ids[some], more[0]), axis=2), np.concatenate((scores[some], more[1].astype(np.int64)), axis=2))
                    ids[some], scores[some] = best_of(*joined, k)
        anchor, window, place = np.nonzero(scores > LEAST)
        columns = (own[anchor], window.astype(np.int32), ids[anchor, window, place], scores[anchor, window, place])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "window", "id", "score"])

    return index.mapInArrow(look, FOUND)


def search(index: DataFrame, wide: int, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """FOUND with rank: the k best rows for each anchor and window.

    anchors: stored rows of id, label, x, low and high, the windows' inclusive bounds as arrays of one length.
    """
    spark = anchors.sparkSession
    size = anchors.agg(F.count("*"), F.max(F.size("low"))).first()
    blocks = max(1, -(-(size[0] * (wide + 4 * (size[1] or 0)) * 8) // ANCHOR_BYTES))
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    own = F.pmod(F.xxhash64("ids"), F.lit(FIRST)) == 0
    nothing = F.transform("low", lambda _: F.lit(LEAST).cast("long"))
    least = F.transform("low", lambda _, i: F.coalesce(F.try_element_at("kth", i), F.lit(LEAST).cast("long")))
    name = scratch_name(spark, "nearest")
    spark.createDataFrame([], FOUND + ", rank int").write.format("parquet").saveAsTable(name)

    def run(trees: DataFrame, rows: DataFrame) -> DataFrame:
        told = rows.select("id", "label", "x", "low", "high", "least", F.size("low").alias("windows")).toArrow()
        return settle(searched(trees, wide, spark.sparkContext.broadcast(told), same, k), "near")

    for block in range(blocks):
        rows = anchors.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        if rows.isEmpty():
            continue
        early = run(index.filter(own), rows.withColumn("least", nothing))
        kth = early.withColumn("r", F.row_number().over(order)).filter(F.col("r") == k)
        kth = kth.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
        later = rows.join(kth, rows["id"] == kth["anchor"], "left").withColumn("least", least)
        hits = early.unionByName(run(index.filter(~own), later))
        ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        # An anchor is in one block, so the block's rows are final.
        ranked.write.format("parquet").mode("append").saveAsTable(name)
    return spark.table(name)


def mine(
    vectors: DataFrame,
    relabel: Column | None = None,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: Callable[[Column], tuple[Column, Column]] | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of hard negatives.

    Anchors are the rows whose vec_id is divisible by ``every``, positives the first rows of the anchor's label other
    than itself, negatives the first rows of other labels whose score lies in the positive's ``window`` (inclusive bounds
    as longs; by default 30 to 90 percent of its score). Higher scores come first, equal ones by smaller vec_id. A
    positive without negatives has no rows, so a negative positive score has none, and an empty table gives none. Which
    rows take part and how nulls, repeated ids and lengths count: see ``integers``. Other columns are not read. Scores
    are exact; where a bound of them does not fit 62 bits there is an error.
    """
    rows = settle(integers(vectors, relabel), "vectors")
    index, wide = build(rows)
    anchors = rows.filter(F.col("id") % every == 0)
    whole = [F.array(F.lit(v).cast("long")).alias(c) for c, v in (("low", LEAST), ("high", -LEAST))]
    near = search(index, wide, settle(anchors.select("*", *whole), "anchors"), True, positives)
    near = settle(near.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive"), F.col("score").alias("near")), "positives")

    def percent(score: Column) -> tuple[Column, Column]:
        """Smallest and largest integer within; a negative score has none."""
        wide = score.cast("decimal(20,0)")
        least, most = (F.call_function("div", wide * p + more, F.lit(100)) for p, more in ((LOWEST, 99), (HIGHEST, 0)))
        return F.when(score < 0, 1).otherwise(least), F.when(score < 0, 0).otherwise(most)

    low, high = (window or percent)(F.col("near"))
    bounds = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", low.cast("long").alias("low"), high.cast("long").alias("high")))).alias("w"))
    asked = anchors.join(bounds, anchors["id"] == bounds["anchor"]).select("id", "label", "x", "w.low", "w.high")
    # Windows beyond an anchor's own positives are empty, so that all anchors have as many.
    asked = asked.select(
        "id", "label", "x",
        *(F.concat(c, F.array_repeat(F.lit(v).cast("long"), F.lit(positives) - F.size(c))).alias(c) for c, v in (("low", 1), ("high", 0))),
    )
    hard = search(index, wide, settle(asked, "anchors"), False, negatives)
    hard = hard.withColumn("place", F.col("window") + 1)
    return hard.join(near, ["anchor", "place"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("near").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def op12_rtree_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives for each anchor and positive of the embeddings; every seventh row has its label moved first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), moved)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), a AS (SELECT * FROM v WHERE vec_id % 100 = 0
), s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same, list_inner_product(a.x, v.x)::BIGINT AS score
  FROM a JOIN v ON a.vec_id <> v.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""
