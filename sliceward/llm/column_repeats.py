"""Byte-level repeats by column-wise construction of a Burrows-Wheeler transform over a collection of short strings.

Windows of ``width`` bytes are dealt out by their minimizer, the smallest hash among the 32-byte strings inside. A run
of neighbouring windows with the same minimizer is one short string. Strings are kept if their minimizer stands in two
documents, are sent to the shard of the minimizer, and are laid out there with the minimizer in the same columns, so
that equal windows stand in equal columns. The shard then inserts one symbol of every string per round, from the last
column to the first: each round is one stable pass over the new column in the order of the last round, which gives the
next column of the transform and, from the running common prefixes, those of the new order. Where a window can start,
neighbours with a common prefix of ``width`` are the same window. Each round reads and writes its arrays in sequence;
they are held in memory, since a shard is bounded and a folder of one machine must not be used on a cluster.

A minimizer with very many strings (a line that a third of all documents share, with other bytes around it) would fill
one shard; its windows are sent one by one, dealt by the hash of the whole window.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from sliceward.llm import chunks as C
from sliceward.llm import packed as P
from sliceward.llm import textarrays as T

#: Bytes of a window.
WIDTH = 50
#: Bytes of the strings whose smallest hash deals out the windows.
ANCHOR = 32
#: Strings of one minimizer from which on its windows are dealt out one by one.
HOT = 20_000
#: Not a byte of UTF-8.
PAD = 0xFF
RESULT = [("kept_bytes", BinaryType()), ("n_bytes", LongType()), ("n_removed", LongType()), ("n_spans", LongType())]


def common_prefixes(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Insert one symbol of every string per round, last column first; yields after every round.

    columns: symbols by column and string. Yields the column, the order of the strings by what stands from it on, and
    the common prefix of each with the one before it in this order.
    """
    width, n = columns.shape
    order, prefix = np.arange(n), np.full(n, 0, np.int16)
    for column in range(width - 1, -1, -1):
        symbols = columns[column][order]
        place = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[place]
        # The prefix of two that come together is the least prefix on the way from the one to the other.
        far, span = prefix.copy(), 1
        tables = [far]
        while span * 2 <= n:
            far = np.minimum(far[:-span], far[span:])
            tables.append(far)
            span *= 2
        new = np.zeros(n, np.int16)
        if n > 1:
            low, high = place[:-1] + 1, place[1:] + 1
            same = sorted_symbols[1:] == sorted_symbols[:-1]
            low, high, at = low[same], high[same], np.flatnonzero(same) + 1
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            least = np.empty(len(at), np.int16)
            for k in np.unique(level):
                pick = level == k
                least[pick] = np.minimum(tables[k][low[pick]], tables[k][high[pick] - (1 << k)])
            new[at] = least + 1
        order, prefix = order[place], new
        yield column, order, prefix


def remove_byte_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Remove each byte covered by a string of ``width`` bytes that also starts in a document with a smaller doc_id.

    Returns doc_id, kept_bytes (the remaining bytes, concatenated), n_bytes, n_removed and n_spans (maximal removed
    runs). Texts are UTF-8 bytes; strings are judged on the input and never cross documents.

    Null and empty texts have no bytes. A null doc_id counts as an id above 2**62 made from the text, and that id is
    returned. Rows with the same doc_id do not remove bytes from each other; repeats within a document stay. Every row
    of the input gives one row; other columns are not looked at.
    """
    chunks = C.chunked(docs)
    n, free = chunks.n, width - anchor
    columns = width + free

    def strings(rows: pa.Table):
        """In steps of some documents: where a string starts and ends, its document, anchor, and minimizer's hash."""
        raw, offsets = T.utf8(rows["__text"])
        roll = T.SpanHash(21)
        for low, high in T.steps(offsets):
            part, at = raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            if len(part) < width:
                continue
            sums = roll.prefix_of_bytes(part)
            key = roll.rolling(sums, anchor)
            least = (key & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(key), dtype=np.uint64)
            have = 1
            while have * 2 <= free + 1:
                least = np.minimum(least[:-have], least[have:])
                have *= 2
            if have < free + 1:
                more = free + 1 - have
                least = np.minimum(least[:-more], least[more:])
            starts = np.flatnonzero(T.fits(at, width))
            place = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            if not len(starts):
                continue
            new = np.ones(len(starts), bool)
            new[1:] = (place[1:] != place[:-1]) | (np.diff(starts) != 1)
            heads = np.flatnonzero(new)
            begin, last = starts[heads], starts[np.append(heads[1:], len(starts)) - 1]
            doc = np.searchsorted(at, begin, side="right") - 1 + low
            yield offsets[low], part, sums, roll, begin, last + width, doc, place[heads], key[place[heads]]

    def minimizers(rows: pa.Table, whole: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys of the chunk, which key each string has, its document and, if asked, the string's hash."""
        found = []
        for _, _, sums, roll, begin, end, doc, place, key in strings(rows):
            own = T.mix(roll.spans(sums, begin, end) + (place - begin).astype(np.uint64)) if whole else key
            found.append((key, doc, own))
        key, doc, own = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, t) for t in (np.uint64, np.int64, np.uint64)]
        shard = (key >> np.uint64(32)) % np.uint64(n)
        known, which = np.unique((shard << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF)), return_inverse=True)
        return known, which, doc, own

    def ask_minimizers(rows: pa.Table, _) -> pa.Table:
        known, which, doc, own = minimizers(rows, whole=True)
        ids = P.by_id(rows)[doc]
        low = np.full(len(known), np.iinfo(np.int64).max)
        high = np.full(len(known), np.iinfo(np.int64).min)
        np.minimum.at(low, which, ids)
        np.maximum.at(high, which, ids)
        # Equal strings of a chunk are sent once, so it is the different ones that fill a shard.
        order = np.lexsort((own, which))
        new = (np.diff(which[order], prepend=-1) != 0) | (np.diff(own[order], prepend=np.uint64(0)) != 0)
        times = np.bincount(which[order][new], minlength=len(known)).astype(np.uint32)
        shard = (known >> np.uint64(32)).astype(np.int64)
        told = times << np.uint32(1) | (low < high).astype(np.uint32)
        return P.routed(P.chunk_of(rows), shard, [known.astype(np.uint32)], [told])

    def find_shared(table: pa.Table) -> pa.Table:
        """0: in one document; 1: in several; 2: in several and hot."""
        keys = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
        told = np.frombuffer(b"".join(zlib.decompress(x) for x in table["extra"].to_pylist()), np.uint32)
        known, which, rows = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = rows > 1
        shared[which[told & np.uint32(1) == 1]] = True
        many = np.bincount(which, weights=told >> np.uint32(1), minlength=len(known)) > hot
        return P.answered(table, [len(k) for k in keys], np.where(shared, 1 + many, 0)[which].astype(np.uint8))

    def pieces(rows: pa.Table, answers: pa.Table) -> tuple:
        """Strings to compare, sorted by shard and hash: where they start and end in the chunk, document, first column."""
        known, which, *_ = minimizers(rows)
        state = P.in_order(answers, np.uint8)[which] if len(known) else np.zeros(0, np.uint8)
        made, done = [], 0
        for base, _, sums, roll, begin, end, doc, place, key in strings(rows):
            mine = state[done : done + len(begin)]
            done += len(begin)
            one, many = np.flatnonzero(mine == 1), np.flatnonzero(mine == 2)
            count = (end - begin - width + 1)[many]
            again = np.repeat(many, count)
            starts = begin[again] + np.arange(len(again)) - np.repeat(np.cumsum(count) - count, count)
            a, b = np.concatenate((begin[one], starts)), np.concatenate((end[one], starts + width))
            of = np.concatenate((one, again))
            first = a - place[of] + free
            own = T.mix(roll.spans(sums, a, b) + first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            hashed = np.concatenate((key[one], own[len(one) :]))
            made.append((a + base, b + base, doc[of], first, own, hashed >> np.uint64(32)))
        a, b, doc, first, own, deal = (np.concatenate(x) for x in zip(*made, strict=True)) if made else [np.zeros(0, np.int64)] * 6
        shard = (deal.astype(np.uint64) % np.uint64(n)).astype(np.int64)
        order = np.lexsort((own, shard))
        a, b, doc, first, own, shard = (x[order] for x in (a, b, doc, first, own, shard))
        new = np.ones(len(a), bool)
        new[1:] = (own[1:] != own[:-1]) | (shard[1:] != shard[:-1])
        ids = P.by_id(rows)[doc]
        low = np.minimum.reduceat(ids, np.flatnonzero(new)) if len(ids) else ids
        return a, b, first, ids, new, low, shard

    def ask_strings(rows: pa.Table, answers: pa.Table) -> pa.Table:
        a, b, first, _, new, low, shard = pieces(rows, answers)
        a, b, first, shard = a[new], b[new], first[new], shard[new]
        raw, _ = T.utf8(rows["__text"])
        cuts = np.flatnonzero(np.diff(shard, prepend=-1)) if len(shard) else np.zeros(0, np.int64)
        keys, extra = [], []
        for x, y in zip(cuts, np.append(cuts[1:], len(shard)) if len(cuts) else cuts, strict=True):
            length = b[x:y] - a[x:y]
            spread = np.repeat(a[x:y] - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
            keys.append(zlib.compress(raw[spread].tobytes(), 1))
            extra.append(zlib.compress(low[x:y].tobytes() + first[x:y].astype(np.uint8).tobytes() + length.astype(np.uint8).tobytes(), 1))
        return pa.table({
            "chunk": pa.array([P.chunk_of(rows)] * len(cuts), pa.int32()),
            "shard": pa.array(shard[cuts].astype(np.int32), pa.int32()),
            "keys": pa.array(keys, pa.binary()),
            "extra": pa.array(extra, pa.binary()),
        })

    def compare(table: pa.Table) -> pa.Table:
        """For each string, by bit, which of its windows stand in a document before the smallest of the chunk."""
        low, first, length, sizes = [], [], [], []
        for x in table["extra"].to_pylist():
            x = zlib.decompress(x)
            count = len(x) // 10
            low.append(np.frombuffer(x, np.int64, count))
            first.append(np.frombuffer(x, np.uint8, count, 8 * count))
            length.append(np.frombuffer(x, np.uint8, count, 9 * count))
            sizes.append(count)
        low, first, length = np.concatenate(low), np.concatenate(first).astype(np.int64), np.concatenate(length).astype(np.int64)
        symbols = np.frombuffer(b"".join(zlib.decompress(x) for x in table["keys"].to_pylist()), np.uint8)
        m = len(low)
        laid = np.full((columns, m), PAD, np.uint8)
        of = np.repeat(np.arange(m), length)
        laid[np.arange(len(symbols)) - np.repeat(np.cumsum(length) - length, length) + first[of], of] = symbols
        found = np.zeros(m, np.uint32)
        for column, order, prefix in common_prefixes(laid):
            if column > free:
                continue
            holds = (first[order] <= column) & (first[order] + length[order] >= column + width)
            group = np.cumsum(prefix < width)[holds]
            own = low[order][holds]
            least = np.full(m + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, group, own)
            found[order[holds][least[group] < own]] |= np.uint32(1 << column)
        return P.answered(table, sizes, found)

    def remove(rows: pa.Table, answers: pa.Table) -> pa.Table:
        raw, offsets = T.utf8(rows["__text"])
        a, b, first, ids, new, low, _ = pieces(rows, P.part(answers, False))
        smaller = P.in_order(P.part(answers, True), np.uint32)
        starts = []
        if len(a):
            run = np.cumsum(new) - 1
            late, bits = ids > low[run], smaller[run]
            for column in range(free + 1):
                holds = (first <= column) & (b - a >= column + width - first)
                hit = holds & (late | (bits >> np.uint32(column) & np.uint32(1) == 1))
                starts.append(a[hit] + column - first[hit])
        gone = T.covered(np.concatenate(starts) if starts else np.zeros(0, np.int64), width, len(raw))
        sums = np.concatenate(([0], np.cumsum(gone)))
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        cut = offsets[:-1][offsets[:-1] < len(raw)]
        head[cut] = gone[cut]
        heads = np.concatenate(([0], np.cumsum(head)))
        kept = raw[~gone].tobytes()
        ends = (offsets - sums[offsets]).astype(np.int64)
        return pa.table({
            "doc_id": rows["__id"],
            "kept_bytes": pa.array([kept[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(sums[offsets[1:]] - sums[offsets[:-1]], pa.int64()),
            "n_spans": pa.array(heads[offsets[1:]] - heads[offsets[:-1]], pa.int64()),
        })

    shared = C.ask(chunks, ask_minimizers, find_shared)
    earlier = C.ask(chunks, ask_strings, compare, told=shared)
    return C.both(chunks, C.together(shared, earlier), remove, C.result_schema(RESULT))


def op9_column_repeats(spark, sf_dir: str) -> DataFrame:
    """Repeats of 50 bytes removed from all documents."""
    found = remove_byte_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = F.sha2("kept_bytes", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


#: The same in SQL, over all windows.
OP9_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, len(h) // 2 AS n, unnest(range(0, len(h) // 2, 1000)) AS base FROM d),
q AS (SELECT doc_id, n, base, substr(h, 2 * base + 1, 2100) AS part FROM p),
e AS (SELECT *, unnest(range(least(1000, n - base))) AS off FROM q),
g AS (
  SELECT doc_id, base + off AS pos, substr(part, 2 * off + 1, 2) AS byte, md5(substr(part, 2 * off + 1, 100)) AS k,
         base + off + 50 <= n AS whole
  FROM e
),
f AS (SELECT k, min(doc_id) AS least FROM g WHERE whole GROUP BY k),
r AS (SELECT g.doc_id, pos, byte, coalesce(whole AND least < g.doc_id, false)::INT AS hit FROM g LEFT JOIN f USING (k)),
c AS (
  SELECT doc_id, pos, byte, max(hit) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM r
),
b AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), 0) = 0 AS head FROM c),
s AS (
  SELECT doc_id, sum(gone) AS n_removed, count(*) FILTER (head) AS n_spans,
         string_agg(byte, '' ORDER BY pos) FILTER (gone = 0) AS kept
  FROM b GROUP BY doc_id
)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""
