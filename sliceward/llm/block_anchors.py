"""Substring dedup by fixed-block anchors.

A reference block is a run of ``width // 2`` words that starts at a multiple of that length in its document. Every
window of ``width`` words holds a whole reference block of its own document, so a window that stands in two documents
makes the rolling probes of the one hit the blocks of the other. Only places near a hit are looked at again: hits are
extended to all windows that hold them, extended windows are matched by a hash of 64 bits within shards that an
independent hash deals out, and overlapping repeated windows unite to maximal exact repeats. A block or a window that a
third of all documents share is one entry per chunk, and hits are never paired with each other.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from sliceward.llm import chunks as C
from sliceward.llm import packed as P
from sliceward.llm import textarrays as T

#: Words of a window.
WIDTH = 50
#: Bytes of text in a chunk; a task holds some dozens of bytes per word of it.
CHUNK_BYTES = 4 << 20
RESULT = [("kept_text", StringType()), ("n_words", LongType()), ("n_removed", LongType())]


def remove_repeats(docs: DataFrame, width: int = WIDTH, carry: bool = False) -> DataFrame:
    """Remove each word covered by a window of ``width`` words that also starts in a document with a smaller doc_id.

    Returns doc_id, kept_text (the kept words joined by one space), n_words, n_removed and, with carry, the other columns
    of the input as the struct ``rest`` and a text from which nothing is removed as it was. Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are. Windows are judged on the input.

    Null and empty texts have no words. A null doc_id counts as an id above 2**62 made from the text, and that id is
    returned. Rows with the same doc_id do not remove words from each other, as neither id is smaller; repeats within a
    document stay. Every row of the input gives one row; other columns are not looked at.
    """
    chunks = C.chunked(docs, carry=carry, chunk_bytes=CHUNK_BYTES)
    n, block = chunks.n, width // 2

    def probes(rows: pa.Table) -> tuple:
        """Places of the rolling probes, their sorted distinct keys, and which key each probe has."""
        raw, offsets = T.utf8(rows["__text"])
        (first, second), words = T.word_hashes(raw, offsets, [T.SpanHash(11), T.SpanHash(12)])
        one, two = T.SpanHash(13), T.SpanHash(14)
        sums = one.prefix(first)
        at = np.flatnonzero(T.fits(words, block))
        key = one.rolling(sums, block)[at]
        shard = (key >> np.uint64(32)) % np.uint64(n)
        known, which = np.unique((shard << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF)), return_inverse=True)
        doc = np.repeat(np.arange(len(words) - 1), np.diff(words))
        return words, doc, at, known, which, (one, sums), (two, two.prefix(second))

    def ask_probes(rows: pa.Table, _) -> pa.Table:
        words, doc, at, known, which, _, _ = probes(rows)
        ids = P.by_id(rows)[doc[at]]
        low = np.full(len(known), np.iinfo(np.int64).max)
        high = np.full(len(known), np.iinfo(np.int64).min)
        np.minimum.at(low, which, ids)
        np.maximum.at(high, which, ids)
        blocks = np.zeros(len(known), np.uint8)
        blocks[which[(at - words[doc[at]]) % block == 0]] = 1
        flags = blocks | ((low < high).astype(np.uint8) << 1)
        shard = (known >> np.uint64(32)).astype(np.int64)
        return P.routed(P.chunk_of(rows), shard, [known.astype(np.uint32)], [flags])

    def find_hits(table: pa.Table) -> pa.Table:
        """Keys that are a block somewhere and stand in two documents."""
        keys = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
        flags = np.frombuffer(b"".join(zlib.decompress(x) for x in table["extra"].to_pylist()), np.uint8)
        known, which, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        blocks, shared = np.zeros(len(known), bool), times > 1
        blocks[which[flags & 1 == 1]] = True
        shared[which[flags & 2 == 2]] = True
        return P.answered(table, [len(k) for k in keys], (blocks & shared)[which].astype(np.uint8))

    def extended(rows: pa.Table, hit_answers: pa.Table) -> tuple:
        """Windows that hold a hit, sorted by shard and key, the runs of equal ones and the smallest id of each run."""
        words, doc, at, known, which, (one, first), (two, second) = probes(rows)
        hits = np.zeros(int(words[-1]), np.int64)
        hits[at] = P.in_order(hit_answers, np.uint8)[which] if len(known) else 0
        before = np.concatenate(([0], np.cumsum(hits)))
        starts = np.flatnonzero(T.fits(words, width))
        starts = starts[before[starts + width - block + 1] > before[starts]]
        key = one.spans(first, starts, starts + width)
        shard = (two.spans(second, starts, starts + width) % np.uint64(n)).astype(np.int64)
        order = np.lexsort((key, shard))
        starts, key, shard = starts[order], key[order], shard[order]
        new = np.ones(len(starts), bool)
        new[1:] = (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])
        ids = P.by_id(rows)[doc[starts]]
        low = np.minimum.reduceat(ids, np.flatnonzero(new)) if len(ids) else ids
        return words, starts, ids, np.cumsum(new) - 1, low, key[new], shard[new]

    def ask_windows(rows: pa.Table, answers: pa.Table) -> pa.Table:
        *_, low, key, shard = extended(rows, answers)
        return P.routed(P.chunk_of(rows), shard, [key], [low])

    def find_smaller(table: pa.Table) -> pa.Table:
        """Whether a document of another chunk with a smaller id has the window."""
        keys = [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]
        low = np.frombuffer(b"".join(zlib.decompress(x) for x in table["extra"].to_pylist()), np.int64)
        known, which = np.unique(np.concatenate(keys), return_inverse=True)
        least = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(least, which, low)
        return P.answered(table, [len(k) for k in keys], (least[which] < low).astype(np.uint8))

    def remove(rows: pa.Table, answers: pa.Table) -> pa.Table:
        words, starts, ids, run, low, _, _ = extended(rows, P.part(answers, False))
        smaller = P.in_order(P.part(answers, True), np.uint8).astype(bool)
        repeated = smaller[run] | (ids > low[run]) if len(starts) else np.zeros(0, bool)
        gone = T.covered(starts[repeated], width, int(words[-1]))
        kept = []
        for i, text in enumerate(rows["__text"]):
            found = (text.as_py() or "").encode().split()
            drop = gone[words[i] : words[i + 1]]
            some = bool(drop.any())
            if carry and not some:
                kept.append(text.as_py())
                continue
            kept.append(b" ".join([w for w, d in zip(found, drop.tolist(), strict=True) if not d] if some else found).decode())
        sums = np.concatenate(([0], np.cumsum(gone)))
        made = {
            "doc_id": rows["__id"],
            "kept_text": pa.array(kept, pa.string()),
            "n_words": pa.array(np.diff(words), pa.int64()),
            "n_removed": pa.array(sums[words[1:]] - sums[words[:-1]], pa.int64()),
        }
        return pa.table(made | ({"rest": rows["__rest"]} if carry else {}))

    hits = C.ask(chunks, ask_probes, find_hits)
    firsts = C.ask(chunks, ask_windows, find_smaller, told=hits)
    return C.both(chunks, C.together(hits, firsts), remove, C.result_schema(RESULT, C.rest_of(docs) if carry else None))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without their repeated words, columns as given; n_chars, if there, follows the text.

    A document that loses all its words stays, with an empty text.
    """
    found = remove_repeats(docs, width, carry=True)
    made = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        kept = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("rest.n_chars"))
        made["n_chars"] = kept.cast(docs.schema["n_chars"].dataType)
    return found.select(*[made.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def op5_block_anchors(spark, sf_dir: str) -> DataFrame:
    """Repeats of 50 words removed from all documents."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))



#: The same in SQL, over all windows.
OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
g AS (
  SELECT *, string_agg(word, ' ') OVER later AS k, count(*) OVER later AS n
  FROM e WINDOW later AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
),
f AS (SELECT md5(k) AS k, min(doc_id) AS least FROM g WHERE n = 50 GROUP BY md5(k)),
r AS (SELECT g.doc_id, pos, word, coalesce(n = 50 AND least < g.doc_id, false)::INT AS hit FROM g LEFT JOIN f ON md5(g.k) = f.k),
c AS (
  SELECT doc_id, pos, word, max(hit) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM r
),
s AS (
  SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""
