"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Each source gets a target of words. A document's expected copies are target / size of its source; the whole part is
certain, and the rest f is its inclusion probability in a sample. Documents are ranked by random odds over inclusion
odds, (u / (1 - u)) / (f / (1 - f)), and taken in this order as long as the target allows. A document that does not fit
is passed over, with all others that are larger than what is still open, and the order is taken up again behind it, up to
ROUNDS times; what is open falls below the size of the document passed over each time. One more document, the one whose
size is nearest to what is left open, closes the sample if it brings the source nearer to its target.

The order is cut without sorting a source: sizes are added up by bins of u (within a source the rank rises with u), the
bin that holds the cut is found from these sums, and only its few thousand rows are ordered. The result is a predicate
per source, a size limit and a cut for each round, so documents are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sliceward.sources.stored import settle

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix, as a part of all words, and the most of a source, as a multiple of its words.
SHARE, MOST = 1.5, 2.0
#: Rows that a bin should hold at most, on average.
BIN_ROWS = 4096
#: Times that the order is taken up.
ROUNDS = 5


def sized(docs: DataFrame) -> DataFrame:
    """Adds __size (words; null: 0), __key (doc_id as text, or a digest of the text) and __u, uniform in (0, 1)."""
    text_digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), text_digest))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), key).cast("binary")), 1, 12), 16, 10).cast("double")
    return docs.withColumns(
        {
            "__size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
            "__key": key,
            "__u": (drawn + 0.5) / F.lit(float(1 << 48)),
        }
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target from the summed sizes per source.

    Sources in code point order, null last, have the weights in turn. Words are shared by weight; no target exceeds
    ``most`` times its source, and the excess is shared again by weight. In the order of cap / weight the common level
    (words per weight) rises over the capped sources and falls after them, so it is the largest of the levels.
    """
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ranked = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("cap").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    levels = rows.withColumn("level", (total - before) / left)
    level = F.max("level").over(Window.partitionBy())
    return levels.select("source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


PLACE = "struct<rank double, key string>"
ROUND = f"struct<most: bigint, bin: bigint, cut: {PLACE}>"


def place() -> Column:
    """Rank and key of a row beside its source's plan ``p``; rows that agree in both go together."""
    f = F.col("p.part")
    rank = F.try_divide(F.col("__u") / (1 - F.col("__u")), f / (1 - f))
    return F.struct(rank.alias("rank"), F.col("__key").alias("key"))


def own_bin() -> Column:
    return F.floor(F.col("__u") * F.col("p.bins"))


def sampled() -> Column:
    """Whether a row beside its source's plan ``p`` is in the sample: up to the cut of a round that its size is allowed
    in, or the one that closes it."""
    own, at = own_bin(), place()

    def before_cut(r: Column) -> Column:
        at_cut = (own == r["bin"]) & F.coalesce(at <= r["cut"], F.lit(False))
        return (F.col("__size") <= r["most"]) & (r["bin"].isNull() | (own < r["bin"]) | at_cut)

    return (F.col("p.part") > 0) & (F.exists("p.rounds", before_cut) | F.coalesce(at == F.col("p.closing"), F.lit(False)))


def beside(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Each row with the plan of its source in the struct p."""
    side = planned.select(F.struct("*").alias("p"), F.col("source").alias("__s"))
    return rows.join(side, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")


def next_cut(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plans with one more round: how far the order goes among the rows that fit into what is open."""
    names = plans.columns
    left = beside(rows, plans).filter((F.col("p.part") > 0) & (F.col("__size") <= F.col("p.open")) & ~sampled())
    sums = settle(left.groupBy("source", own_bin().alias("own"), F.col("p.open").alias("open")).agg(F.sum("__size").alias("words")), "bins")
    running = Window.partitionBy("source").orderBy("own")
    upto = sums.withColumn("upto", F.sum("words").over(running))
    first = F.min(F.when(F.col("upto") > F.col("open"), F.struct("own", (F.col("upto") - F.col("words")).alias("before"))))
    crossing = upto.groupBy(F.col("source").alias("__c")).agg(first.alias("at"), F.sum("words").alias("all"))
    at_bin = plans.join(crossing, F.col("source").eqNullSafe(F.col("__c")), "left").drop("__c")
    at_bin = at_bin.select(*names, F.col("at.own").alias("bin"), F.coalesce("at.before", "all", F.lit(0)).alias("before"))
    at_bin = settle(at_bin, "cut_bins")

    inside = beside(rows, at_bin).filter((F.col("p.part") > 0) & (F.col("__size") <= F.col("p.open")) & (own_bin() == F.col("p.bin")) & ~sampled())
    order = Window.partitionBy("source").orderBy("place")
    inner = inside.withColumn("place", place()).withColumn("upto", F.col("p.before") + F.sum("__size").over(order))
    inner = inner.filter(F.col("upto") <= F.col("p.open")).groupBy(F.col("source").alias("__c"))
    cuts = inner.agg(F.max("place").alias("last"), F.max("upto").alias("taken"))
    cut = at_bin.join(cuts, F.col("source").eqNullSafe(F.col("__c")), "left").drop("__c")
    made = F.struct(F.floor("open").alias("most"), "bin", F.col("last").alias("cut"))
    return settle(
        cut.withColumn("rounds", F.concat("rounds", F.array(made))).withColumn("open", F.col("open") - F.coalesce("taken", "before")).select(*names),
        "cuts",
    )


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source_size, target, whole (certain copies), part (inclusion probability), rounds and closing.

    rows: columns source, __size, __key, __u. A round has the largest size that it takes, the bin of u that holds its cut,
    null if all such documents are taken, and the last place in it that is taken; open: what the rounds have left open;
    closing: the place of the document that closes the sample.
    """
    sums = rows.groupBy("source").agg(F.sum("__size").alias("source_size"))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = targets(settle(sums, "source_sizes"), weights, share, most).withColumn("whole", F.floor(copies))
    plans = settle(
        goals.withColumns(
            {
                "part": copies - F.col("whole"),
                "open": F.col("target") - F.col("whole") * F.col("source_size"),
                "bins": F.lit(max(1024, rows.count() // BIN_ROWS)).cast("long"),
                "rounds": F.array().cast(f"array<{ROUND}>"),
                "closing": F.lit(None).cast(PLACE),
            }
        ),
        "goals",
    )
    for _ in range(ROUNDS):
        plans = next_cut(rows, plans)

    rest = beside(rows, plans).filter(~sampled()).filter((F.col("p.part") > 0) & (F.col("__size") > 0))
    off = F.abs(F.col("__size") - F.col("p.open"))
    nearest = F.min(F.struct(off.alias("off"), place().alias("place"))).alias("n")
    closing = rest.filter(off < F.col("p.open")).groupBy(F.col("source").alias("__c")).agg(nearest)
    closed = plans.drop("closing").join(closing, F.col("source").eqNullSafe(F.col("__c")), "left")
    return settle(closed.withColumn("closing", F.col("n.place")).drop("__c", "n"), "mix_plan")


def slim(docs: DataFrame) -> DataFrame:
    """Stored rows of doc_id, source, __size, __key and __u, without texts."""
    return settle(sized(docs.select("doc_id", "source", "text")).drop("text"), "sizes")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix: every document as often as it is taken (0, 1 or 2 times with the defaults), columns as given.

    Null and empty texts have size 0; they are in the mix only with their certain copies or before the cut. A null
    source is a source of its own, last in order. Rows with equal doc_id draw the same number; in one source they are
    taken together. A row without doc_id draws by its text. Runs agree, as nothing but ids and sizes is drawn on.
    """
    planned = plan(slim(docs), weights, share, most)
    names = docs.columns
    rows = sized(docs.select(F.struct(*names).alias("row"), "doc_id", "source", "text")).drop("text")
    copies = (F.col("p.whole") + sampled().cast("long")).cast("int")
    told = beside(rows, planned).select("row", F.explode(F.sequence(F.lit(1), copies)).alias("__copy"), copies.alias("__n"))
    return told.filter(F.col("__n") > 0).select("row.*")


def op8_pareto_mix(spark, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    rows = slim(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    taken = F.col("__size") * (F.col("p.whole") + sampled().cast("long"))
    return beside(rows, plan(rows)).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("p.source_size").alias("source_size"),
        F.col("p.target").alias("target"),
        taken.cast("long").alias("taken"),
    )


_ROUND_SQL = """), t@K@ AS (
  SELECT * EXCLUDE (sofar), coalesce(fits OR (part > 0 AND size <= open AND sofar <= open), false) AS fits_now
  FROM (SELECT *, sum(size) FILTER (WHERE NOT fits AND size <= open) OVER (PARTITION BY source ORDER BY rank, key) AS sofar FROM k@J@)
), k@K@ AS (
  SELECT * EXCLUDE (fits, open, fits_now), fits_now AS fits,
         open - coalesce(sum(size) FILTER (WHERE fits_now AND NOT fits) OVER (PARTITION BY source), 0) AS open
  FROM t@K@
"""
#: The same in SQL: the order is not cut by bins but ranked as a whole.
OP8_SQL = r"""
WITH r AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         doc_id::VARCHAR AS key,
         (('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         source_size * 2.0::DOUBLE AS cap
  FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), g AS (SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM l
), c AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS copies, floor(copies)::BIGINT AS whole,
         copies - whole AS part, target - whole * source_size AS open
  FROM g
), d AS (
  SELECT r.*, c.* EXCLUDE (source), (u / (1 - u)) / (part / (1 - part)) AS rank
  FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source
), k0 AS (SELECT *, false AS fits FROM d
@ROUNDS@), n AS (
  SELECT source, min(struct_pack(off := abs(size - open), rank := rank, key := key)) AS closing
  FROM k@LAST@ WHERE NOT fits AND part > 0 AND size > 0 AND abs(size - open) < open GROUP BY source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + (fits OR coalesce(rank = n.closing.rank AND key = n.closing.key, false))::INT))::BIGINT AS taken
FROM k@LAST@ k LEFT JOIN n ON k.source IS NOT DISTINCT FROM n.source
""".replace("@ROUNDS@", "".join(_ROUND_SQL.replace("@K@", str(k)).replace("@J@", str(k - 1)) for k in range(1, ROUNDS + 1))).replace("@LAST@", str(ROUNDS))
