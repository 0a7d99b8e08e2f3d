"""Byte-level BPE against the tiktoken library, and the way back."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from sliceward.llm import merge_replay

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, n_tokens string, decoded string, __text string"


@pytest.fixture(scope="module")
def vocabulary():
    return merge_replay.vocabulary(PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.of_bytes, special_tokens={})


def of_texts(texts, vocabulary):
    """Ids of each text by the merges over all words at once."""
    pattern = regex.compile(public_tokenizers.PATTERN)
    split = [[w for part in merge_replay.split(t, pattern) for w in part] for t in texts]
    words = list(dict.fromkeys(w for each in split for w in each))
    ids, counts = merge_replay.merged([w.encode() for w in words], vocabulary)
    cuts = np.cumsum(counts.astype(int)).tolist()
    known = {w: ids[b - n : b].tolist() for w, n, b in zip(words, counts.tolist(), cuts, strict=True)}
    return [[i for w in each for i in known[w]] for each in split]


def test_merges_equal_the_library(vocabulary, library):
    rng = random.Random(5)
    tokens = [t for t in vocabulary.tokens if t]
    texts = ["".join(chr(c) for c in range(low, low + 400)) for low in range(0, 0xD000, 400)]
    texts += [b"".join(rng.choices(tokens, k=30)).decode("utf-8", "ignore") for _ in range(400)]
    texts += [rng.choice(["a", "=", "  ", "ab", "aba", " \n", "漢", "́x"]) * rng.randrange(1, 3000) for _ in range(60)]
    texts += ["", " ", "it's  we'LL 12½ <|endoftext|>\r\n"]
    assert of_texts(texts, vocabulary) == [library.encode_ordinary(t) for t in texts]


def test_a_lower_rank_made_by_a_merge_goes_first(tmp_path):
    """Merging b with c makes the pair a + bc, whose rank is lower; so does every repeat of it."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"ca": 258, b"bcab": 259, b"cabc": 260, b"bcbc": 261}
    path = tmp_path / "ranks"
    path.write_text("\n".join(f"{base64.b64encode(t).decode()} {r}" for t, r in ranks.items()))
    made = merge_replay.vocabulary(str(path))
    library = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    words = list({"".join(rng.choices("abc", k=rng.randrange(1, 24))) for _ in range(3000)})
    assert made.unsafe.any()
    ids, counts = merge_replay.merged([w.encode() for w in words], made)
    cuts = np.cumsum(counts.astype(int))
    for word, n, high in zip(words, counts.tolist(), cuts.tolist(), strict=True):
        assert ids[high - n : high].tolist() == library.encode_ordinary(word), word


def test_long_texts_are_cut_between_matches(monkeypatch):
    pattern = regex.compile(public_tokenizers.PATTERN)
    text = "one  two\n\n three 's   \t four" * 50 + "x" * 300 + "  "
    monkeypatch.setattr(merge_replay, "SPLIT_CHARS", 17)
    parts = list(merge_replay.split(text, pattern))
    assert len(parts) > 20 and [w for p in parts for w in p] == pattern.findall(text)


def test_odd_rows_and_shards(spark, library, monkeypatch):
    """Null, empty, blank, repeated and very long rows, clashing columns; many shards and small steps."""
    monkeypatch.setattr(merge_replay, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(merge_replay, "REPLAY_BYTES", 5_000)
    monkeypatch.setattr(merge_replay.C, "CHUNK_BYTES", 60_000)
    long = " ".join(f"w{i % 9777}é" for i in range(60_000)) + "z" * 50_000
    rows = [(1, "a b", "x", "y", "z", "t"), (1, "a b", "x", "y", "z", "t"), (2, None, None, None, None, None), (3, "", *"xyzt"), (4, " \n ", *"xyzt"), (5, long, *"xyzt"), (None, "no id", *"xyzt")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    encoded = merge_replay.encode(docs, PATH, public_tokenizers.PATTERN)
    found = merge_replay.decode(encoded, PATH).collect()
    assert len(found) == len(rows)
    texts = {i: t or "" for i, t, *_ in rows}
    for r in found:
        text = texts[r.doc_id] if r.doc_id < 1 << 62 else texts[None]
        ids = library.encode_ordinary(text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids) and r.decoded.decode() == text
    empty = merge_replay.encode(docs.filter("false"), PATH, public_tokenizers.PATTERN)
    assert merge_replay.decode(empty, PATH).collect() == []
    with pytest.raises(Exception, match="no token|out of range"):
        merge_replay.decode(spark.createDataFrame([(b"\xff\xff\xff\x00",)], "ids binary"), PATH).collect()


def test_query_equals_the_library(spark, library):
    path = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in merge_replay.op11_merge_replay(spark, path).collect()}
    for r in spark.read.parquet(f"{path}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()
        assert (found[r.doc_id].n_tokens, found[r.doc_id].ids_sha256, found[r.doc_id].decoded_sha256) == (len(ids), *digests)
