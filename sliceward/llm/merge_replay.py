"""Byte-level BPE: corpus-level merge replay, and decoding.

A corpus has far fewer distinct words (matches of the split pattern) than words. Chunks of documents are stored as
numbers of their distinct words, and these words go to shards; a shard replays the merges over all of its words at once. An inverted index
leads from a rank to the places whose token pair has it; the ranks are taken up from the lowest, every place of a rank
is merged in one step, and only the pairs of the touched neighbours are looked up anew. The ids go back to the chunks,
which put them together in the order of the text; no text is read or split twice. A word that stands in a third of all documents is one entry per
chunk and is merged once.

Vocabularies need not come from training: a merge may make a pair of a lower rank than its own. Ranks where that is
possible are known from the vocabulary; their places in a word are merged from the left up to the first that makes such
a pair, which then goes first.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from sliceward.llm import chunks as C
from sliceward.sources.stored import scratch_name

#: Bytes of text whose words go to one shard. Replaying has a fixed cost per shard, so shards are larger than chunks.
SHARD_BYTES = 32 << 20
#: Bytes of distinct words that are merged at once, and characters of a text that are split at once; one longer word is
#: taken alone.
REPLAY_BYTES, SPLIT_CHARS = 2 << 20, 1 << 20
ENTERED_AT_ONCE = 1 << 18
#: Stands for "no token" beside the ends of words.
NONE = (1 << 31) - 1

# A place between a word and white space after it: matches of the pattern end there, whatever stands around it.
_CUT = regex.compile(r"(?<=\S)(?=\s)")


@dataclass(frozen=True)
class Vocabulary:
    """tokens: bytes by id (b"" for a free id); keys, ranks: sorted pairs a << 32 | b and the id of the joined token."""

    tokens: list[bytes]
    of_bytes: dict[bytes, int]
    keys: np.ndarray
    ranks: np.ndarray
    unsafe: np.ndarray

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), -1)
        wanted = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], -1)


def vocabulary(path: str) -> Vocabulary:
    """The ranks of a file with lines of a base64 token and its rank. All 256 single bytes must be tokens."""
    of_bytes = {}
    with open(path, "rb") as lines:
        for line in filter(None, map(bytes.split, lines)):
            of_bytes[base64.b64decode(line[0])] = int(line[1])
    if missing := [b for b in range(256) if bytes([b]) not in of_bytes]:
        raise ValueError(f"{len(missing)} single bytes have no rank")
    tokens = [b""] * (max(of_bytes.values()) + 1)
    keys, ranks, unsafe = [], [], np.zeros(len(tokens), bool)
    for token, rank in of_bytes.items():
        tokens[rank] = token
        for cut in range(1, len(token)):
            left, right = of_bytes.get(token[:cut]), of_bytes.get(token[cut:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                ranks.append(rank)
                unsafe[[x for x in (left, right) if x > rank]] = True
    order = np.argsort(np.array(keys, np.int64))
    return Vocabulary(tokens, of_bytes, np.array(keys, np.int64)[order], np.array(ranks, np.int64)[order], unsafe)


class Replay:
    """The tokens of many words as linked places, and the inverted index from ranks to places."""

    def __init__(self, words: list[bytes], vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        raw = np.frombuffer(b"".join(words), np.uint8)
        self.starts = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
        n = self.n = len(raw)
        of_byte = np.array([vocabulary.of_bytes[bytes([b])] for b in range(256)], np.int64)
        self.token = np.append(of_byte[raw], NONE).astype(np.int32)
        self.after, self.before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        ends = self.starts[1:][np.diff(self.starts) > 0]
        self.after[ends - 1] = self.after[n] = n
        self.before[ends] = self.before[0] = n
        self.alive = np.ones(n + 1, bool)
        self.rank = np.full(n + 1, -1, np.int32)
        self.index: dict[int, list[np.ndarray]] = {}
        self.due: list[int] = []
        for low in range(0, n, ENTERED_AT_ONCE):
            self._enter(np.arange(low, min(low + ENTERED_AT_ONCE, n), dtype=np.int32))

    def _enter(self, places: np.ndarray) -> None:
        """Look up the pairs at these places and enter them into the index."""
        ranks = self.vocabulary.pair_ranks(self.token[places], self.token[self.after[places]])
        self.rank[places] = ranks
        there = ranks >= 0
        places, ranks = places[there], ranks[there]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
        for rank, low, high in zip(ranks[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(ranks)]):
            self._push(rank, places[low:high])

    def _push(self, rank: int, places: np.ndarray) -> None:
        if rank in self.index:
            self.index[rank].append(places)
        else:
            self.index[rank] = [places]
            heappush(self.due, rank)

    def run(self) -> None:
        while self.due:
            rank = heappop(self.due)
            entered = self.index.pop(rank)
            places = np.unique(np.concatenate(entered)) if len(entered) > 1 else np.unique(entered[0])
            places = places[self.rank[places] == rank]
            if len(places):
                self._merge(rank, places)

    def _merge(self, rank: int, places: np.ndarray) -> None:
        right = self.after[places]
        clash = np.append(False, places[1:] == right[:-1])
        lefts, rights = places, right
        if clash.any():
            # In a row of overlapping pairs every other one is merged, beginning with the first.
            number = np.arange(len(places))
            first = np.maximum.accumulate(np.where(clash, 0, number))
            chosen = (number - first) % 2 == 0
            lefts, rights = places[chosen], right[chosen]
        if self.vocabulary.unsafe[rank]:
            due = self._until_lower(rank, lefts, rights)
            if not due.all():
                lefts, rights = lefts[due], rights[due]
                self._push(rank, places)
        self.token[lefts] = rank
        self.alive[rights] = False
        self.rank[rights] = -1
        beyond = self.after[rights]
        self.after[lefts] = beyond
        self.before[beyond] = lefts
        before = self.before[lefts]
        self._enter(np.concatenate((lefts, before[before < self.n])))

    def _until_lower(self, rank: int, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        """Which pairs are merged before a lower rank appears in their word."""
        before = self.before[lefts]
        ahead = self.token[before]
        ahead[1:][before[1:] == rights[:-1]] = rank
        joined = np.full(len(lefts), rank)
        made = np.stack((self.vocabulary.pair_ranks(ahead, joined), self.vocabulary.pair_ranks(joined, self.token[self.after[rights]])))
        lower = ((made >= 0) & (made < rank)).any(axis=0)
        if not lower.any():
            return np.ones(len(lefts), bool)
        word = np.searchsorted(self.starts, lefts, side="right")
        seen = np.cumsum(lower) - lower
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        return seen == np.repeat(seen[heads], np.diff(np.append(heads, len(word))))

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens in a row and their number per word."""
        alive = self.alive[: self.n]
        upto = np.concatenate(([0], np.cumsum(alive)))
        return self.token[: self.n][alive].astype(np.uint32), np.diff(upto[self.starts]).astype(np.uint32)


def merged(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row and their number per word. A word that is a token is that token, without merges."""
    whole = [vocabulary.of_bytes.get(w, -1) for w in words]
    open_words = [w for w, known in zip(words, whole, strict=True) if known < 0]
    ids, numbers, low, size = [], [], 0, 0
    for high, word in enumerate(open_words, 1):
        size += len(word)
        if size >= REPLAY_BYTES or high == len(open_words):
            replay = Replay(open_words[low:high], vocabulary)
            replay.run()
            made, per_word = replay.tokens()
            ids.append(made)
            numbers.append(per_word)
            low, size = high, 0
    whole = np.array(whole, np.int64)
    counts = np.ones(len(words), np.int64)
    counts[whole < 0] = np.concatenate(numbers) if numbers else 0
    known = np.repeat(whole, counts)
    known[known < 0] = np.concatenate(ids) if ids else 0
    return known.astype(np.uint32), counts.astype(np.uint32)


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def split(text: str | None, pattern: regex.Pattern) -> Iterator[list[str]]:
    """All matches in the text, in lists of bounded size: a long text is cut where no match goes across."""
    text, low = text or "", 0
    while low < len(text):
        cut = _CUT.search(text, low + SPLIT_CHARS) if low + SPLIT_CHARS < len(text) else None
        high = cut.start() if cut else len(text)
        yield pattern.findall(text[low:high])
        low = high


class _Chunk:
    """Texts as numbers of their distinct words."""

    def __init__(self) -> None:
        self.known, self.ids, self.numbers, self.size = _Numbers(), [], [np.zeros(0, np.int32)], 0
        self.lengths: list[int] = []

    def add(self, doc_id: int, text: str | None, pattern: regex.Pattern) -> None:
        parts = [np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)) for words in split(text, pattern)]
        self.ids.append(doc_id)
        self.lengths.append(sum(map(len, parts)))
        self.numbers += parts
        self.size += len(text or "")

    def rows(self, number: int, n: int) -> pa.RecordBatch:
        """One row of the texts, and one of words for each shard; words keep the order of their numbers."""
        words = [w.encode() for w in self.known]
        shard = np.array([zlib.crc32(w) % n for w in words], np.int32)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        each = [[words[i] for i in part.tolist()] for part in np.split(order, cuts[1:])] if len(words) else []
        texts = [np.array(self.ids, np.int64), np.array(self.lengths, np.int64), np.concatenate(self.numbers), shard]
        packed = [_packed(x) for x in texts]
        nothing = [None] * len(each)
        columns = [
            pa.array([number] * (len(each) + 1), pa.int64()),
            pa.array([TEXTS, *shard[order][cuts].tolist()], pa.int32()),
            pa.array([None, *(zlib.compress(b"".join(w), 1) for w in each)], pa.binary()),
            pa.array([None, *map(_lengths, each)], pa.binary()),
            *(pa.array([x, *nothing], pa.binary()) for x in packed),
        ]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "shard", "keys", "extra", "ids", "lengths", "numbers", "shards"])


CODED = "chunk long, shard int, keys binary, extra binary, ids binary, lengths binary, numbers binary, shards binary"
ANSWER = "chunk long, shard int, answer binary"
#: The shard of a chunk's row of texts.
TEXTS = -1


def _packed(x: np.ndarray) -> bytes:
    """Deflated with first all lowest bytes, then all second ones and so on."""
    return zlib.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 1)


def _unpacked(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(size, -1).T).view(kind)[:, 0]


def _lengths(words: list[bytes]) -> bytes:
    return zlib.compress(np.array([len(w) for w in words], np.uint32).tobytes(), 1)


def _words(keys: bytes, extra: bytes) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(np.frombuffer(zlib.decompress(extra), np.uint32)))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(zlib.decompress(keys))])


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices of values that begin at starts, in a row."""
    at = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - at, sizes) + np.arange(int(sizes.sum()))]


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every whole text; if wanted, what they stand
    for as the column decoded.

    path: ranks, pattern: what splits a text before the merges; both are read on the driver and sent to the tasks.
    Special tokens are ordinary text. Null and empty texts have no ids. Every row gives one row, repeated rows too; a
    null doc_id counts as an id above 2**62 made from the text; other columns are left out, whatever their names; an
    empty table gives no rows. A text that the pattern does not cover whole loses what it leaves out, as in the tiktoken
    library. Very long texts are split piece by piece; a task needs some 30 bytes per byte of its longest single word.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n, buckets = max(1, -(-size // SHARD_BYTES)), min(C.MOST_BUCKETS, max(1, -(-size // C.CHUNK_BYTES)))
    sent = spark.sparkContext.broadcast(vocabulary(path))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, number, chunk = regex.compile(pattern), TaskContext.get().partitionId() << 32, _Chunk()
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                chunk.add(doc_id, text.as_py(), splitter)
                if chunk.size >= C.CHUNK_BYTES:
                    yield chunk.rows(number, n)
                    number, chunk = number + 1, _Chunk()
        if chunk.ids:
            yield chunk.rows(number, n)

    def answer(table: pa.Table) -> pa.Table:
        each = [_words(k.as_py(), x.as_py()) for k, x in zip(table["keys"], table["extra"], strict=True)]
        coded = pa.chunked_array(each, pa.large_binary()).dictionary_encode().unify_dictionaries()
        del each
        ids, counts = merged(coded.chunk(0).dictionary.to_pylist(), sent.value)
        starts = np.cumsum(counts, dtype=np.int64) - counts
        made = []
        for part in coded.chunks:
            which = part.indices.to_numpy()
            own = gathered(ids, starts[which], counts[which].astype(np.int64))
            made.append(zlib.compress(np.concatenate((counts[which], own)).tobytes(), 1))
        return pa.table({"chunk": table["chunk"], "shard": table["shard"], "answer": pa.array(made, pa.binary())})

    def put_together(texts: pa.Table, answers: pa.Table) -> pa.Table:
        row = texts.to_pylist()[0]
        doc_ids, lengths, numbers, shards = (
            _unpacked(row[c], t) for c, t in (("ids", "i8"), ("lengths", "i8"), ("numbers", "i4"), ("shards", "i4"))
        )
        order = np.argsort(shards, kind="stable")
        held = np.bincount(shards, minlength=n)
        counts, ids = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for shard, told in sorted(zip(answers["shard"].to_pylist(), answers["answer"].to_pylist(), strict=True) if len(order) else []):
            values = np.frombuffer(zlib.decompress(told), np.uint32)
            counts.append(values[: held[shard]])
            ids.append(values[held[shard] :])
        ids, sizes = np.concatenate(ids), np.empty(len(order), np.int64)
        sizes[order] = np.concatenate(counts)
        starts = np.empty(len(order), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        made, cuts = [], np.concatenate(([0], np.cumsum(lengths)))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            own = numbers[low:high]
            made.append(gathered(ids, starts[own], sizes[own]).astype("<u4").tobytes())
        out = {
            "doc_id": pa.array(doc_ids),
            "n_tokens": pa.array([len(x) // 4 for x in made], pa.int64()),
            "ids": pa.array(made, pa.binary()),
        }
        return pa.table(out | ({"decoded": pa.array([_text(x, sent.value.tokens) for x in made], pa.binary())} if decoded else {}))

    name = scratch_name(spark, "coded")
    coded = docs.select(C.key_of(docs).alias("id"), "text").mapInArrow(code, CODED)
    coded.write.format("parquet").bucketBy(buckets, "chunk").saveAsTable(name)
    coded = spark.table(name)
    asked = coded.filter(F.col("shard") != TEXTS).select("chunk", "shard", "keys", "extra")
    answers = asked.repartition(n, "shard").groupBy("shard").applyInArrow(answer, ANSWER)
    texts = coded.filter(F.col("shard") == TEXTS).select("chunk", "ids", "lengths", "numbers", "shards")
    both = texts.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(put_together, "doc_id long, n_tokens long, ids binary" + ", decoded binary" * decoded)


def _text(ids: bytes, tokens: list[bytes]) -> bytes:
    each = [tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]
    if not all(each):
        raise ValueError("an id has no token")
    return b"".join(each)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with the column decoded: the bytes of the tokens in ``ids``, whose text is UTF-8 if it was before.

    Null ids give null. An id without a token is an error.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary(path).tokens)
    schema = StructType([*encoded.schema.fields, StructField("decoded", BinaryType())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = sent.value
        for batch in batches:
            made = [_text(ids.as_py(), tokens) if ids.is_valid else None for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(texts, schema)


def op11_merge_replay(spark, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they stand for, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    made = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.PATTERN, decoded=True)
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
