"""The numbered operators against brute force, and their defined results for odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sliceward.llm import blockmax_topk, block_anchors, chunks, column_repeats, deleted_interpolation
from sliceward.llm import kneser_ney_quality, latent_decontamination, license_scan, pareto_mix, simhash_anchors, toxicity_pu

ZERO = deleted_interpolation.ZERO
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, score string, row string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
RUN = " ".join(f"shared{i}" for i in range(60))
NOTICE = "Licensed under the Apache License, Version 2.0."
ITEM = "the quick answer of zygomorphic nebulae lies between violet quarks and ancient pentagonal rivers of glass"

#: Null in every column, empty, blank, very long, repeated rows, copies, one id twice, clashing extra columns.
ODD = [
    (1, f"alpha {RUN} omega", "en", "a", 9, "x", "y", "z"),
    (2, f"beta {RUN} gamma {RUN}", "en", "a", 9, None, None, None),
    (3, RUN, "de", "b", 9, "x", "y", "z"),
    (3, RUN, "de", "b", 9, "x", "y", "z"),
    (4, None, None, None, None, None, None, None),
    (5, "", "en", None, 0, "x", "y", "z"),
    (6, " \t\n ", "en", "b", 4, "x", "y", "z"),
    (7, LONG, "en", "a", 1, "x", "y", "z"),
    (8, LONG + " end", "en", "a", 1, "x", "y", "z"),
    (None, f"no id here {NOTICE} indeed", "en", "c", 1, "x", "y", "z"),
    (None, f"no id here {NOTICE} indeed", "en", "c", 1, "x", "y", "z"),
    (9, f"Ünï çödé wörds ärê fine {ITEM} and more", "fr", "c", 1, "x", "y", "z"),
    (-5, f"one below zero {RUN}", "fr", "c", 1, "x", "y", "z"),
    (100, "one below zero and some words", "fr", "c", 1, "x", "y", "z"),
]
BENCHMARK = [(1, ITEM), (2, None), (3, ""), (None, "some other item of no interest to anyone at all today")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture
def small_chunks(monkeypatch):
    """Many chunks and shards also for little data."""
    whole = chunks.chunked
    monkeypatch.setattr(chunks, "chunked", lambda docs, carry=False, chunk_bytes=0: whole(docs, carry, 60_000))


def made_id(text: str | None, spark) -> int:
    row = spark.createDataFrame([(None, text)], "doc_id long, text string")
    return row.select(chunks.key_of(row)).first()[0]


def windows_removed(docs: list[tuple], split, width: int) -> dict:
    """Per document its parts and which of them are removed; docs: (id, text), ids in order decide."""
    parts, first = [(i, split(t or "")) for i, t in docs], {}
    for i, own in sorted(parts, key=lambda p: p[0]):
        for s in range(len(own) - width + 1):
            first.setdefault(tuple(own[s : s + width]), i)
    out = []
    for i, own in parts:
        gone = [False] * len(own)
        for s in range(len(own) - width + 1):
            if first[tuple(own[s : s + width])] < i:
                gone[s : s + width] = [True] * width
        out.append((i, own, gone))
    return out


def sf(spark, table="documents"):
    return spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")


def known(docs, spark) -> list[tuple]:
    return [(r.doc_id if r.doc_id is not None else made_id(r.text, spark), r.text) for r in docs.select("doc_id", "text").collect()]


def test_span_hashes_tell_spans_apart_wherever_they_stand():
    from sliceward.llm.textarrays import SpanHash

    h = SpanHash(3)
    raw = np.frombuffer(b"abcabcabdabc", np.uint8)
    key = h.rolling(h.prefix_of_bytes(raw), 3)
    assert key[0] == key[3] == key[9] and len({*key.tolist()}) == len({bytes(raw[i : i + 3]) for i in range(10)})


@pytest.mark.parametrize("rows", ["odd", "sf"])
def test_block_anchors_equal_brute_force(spark, odd, rows, small_chunks):
    docs = odd if rows == "odd" else sf(spark)
    found = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in block_anchors.remove_repeats(docs).collect())
    want = windows_removed(known(docs, spark), lambda t: t.encode().split(), 50)
    assert found == Counter((i, len(w), sum(g), b" ".join(x for x, d in zip(w, g) if not d).decode()) for i, w, g in want)
    assert sum(x[2] for x in found) > 0


@pytest.mark.parametrize("hot", [20_000, 1])
def test_column_repeats_equal_brute_force(spark, odd, hot, small_chunks):
    for docs in (odd, sf(spark).filter("doc_id < 60")):
        found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in column_repeats.remove_byte_repeats(docs, hot=hot).collect())
        want = Counter()
        for i, own, gone in windows_removed(known(docs, spark), lambda t: t.encode(), 50):
            spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
            want[(i, len(own), sum(gone), spans, bytes(x for x, g in zip(own, gone) if not g))] += 1
        assert found == want


def test_a_line_of_many_documents_is_hot_within_one_chunk(spark, monkeypatch):
    """Counts of strings are whole, so a minimizer is hot however few chunks there are; equal strings count once."""
    line = " ".join(f"boilerplate{i}" for i in range(6))
    texts = [(i, f"start {i * 7919} {line} finish {i * 104729}") for i in range(300)] + [(1000 + i, "the same text " * 9) for i in range(300)]
    told = []
    answered = column_repeats.P.answered
    monkeypatch.setattr(column_repeats.P, "answered", lambda table, sizes, values: told.append(values) or answered(table, sizes, values))
    rows = column_repeats.pa.table({"__chunk": [0] * len(texts), "__id": [t[0] for t in texts], "__text": [t[1] for t in texts]})

    def at_once(chunks_, asking, answering, told=None):
        return answering(asking(rows, told))

    monkeypatch.setattr(column_repeats.C, "chunked", lambda docs: chunks.Chunked(docs, 1))
    monkeypatch.setattr(column_repeats.C, "ask", at_once)
    monkeypatch.setattr(column_repeats.C, "together", lambda a, b: column_repeats.pa.concat_tables([a, second(b)]))
    monkeypatch.setattr(column_repeats.C, "both", lambda chunks_, answers, work, schema: work(rows, answers))
    second = lambda b: b.set_column(1, "shard", column_repeats.pa.compute.add(b["shard"], column_repeats.P.SECOND).cast("int32"))
    found = column_repeats.remove_byte_repeats(None, hot=250).to_pylist()
    assert (told[0] == 2).any(), "300 different strings around one line are hot"
    assert (told[0] == 1).any(), "300 equal texts are not"
    want = windows_removed(texts, lambda t: t.encode(), 50)
    assert [(r["doc_id"], r["n_removed"]) for r in found] == [(i, sum(gone)) for i, _, gone in want]


def test_common_prefixes_are_those_of_sorted_strings():
    rng = np.random.default_rng(1)
    columns = rng.integers(0, 2, (12, 60)).astype(np.uint8)
    for column, order, prefix in column_repeats.common_prefixes(columns):
        ends = [bytes(columns[column:, i]) for i in order]
        assert ends == sorted(ends)
        assert all(ends[i][: prefix[i]] == ends[i - 1][: prefix[i]] and ends[i][prefix[i]] != ends[i - 1][prefix[i]] for i in range(1, 60) if prefix[i] < len(ends[i]))


def simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    made = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in made) > len(made))


def roots(values: list[int], near) -> dict:
    part = {v: v for v in values}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in combinations(part, 2):
        if near(a, b):
            part[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in part}


def test_simhash_components_equal_brute_force(spark, odd):
    for docs in (odd, sf(spark)):
        rows = known(docs, spark)
        prints = {i: simhash(t) for i, t in rows}
        at = roots([*set(prints.values())], lambda a, b: (a ^ b).bit_count() <= 4)
        least: dict = {}
        for i, p in prints.items():
            least[at[p]] = min(i, least.get(at[p], i))
        found = Counter((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash_anchors.near_copies(docs).collect())
        assert found == Counter((i, prints[i], least[at[prints[i]]]) for i, _ in rows)


@pytest.mark.parametrize("tile", [20_000, 40])
def test_anchors_lose_no_link(spark, tile):
    """A dense cloud around few centres, and chains of near prints."""
    rng = np.random.default_rng(2)
    made = set()
    for centre in rng.integers(0, 1 << 63, 12, dtype=np.uint64).tolist():
        for _ in range(60):
            flips = rng.choice(64, int(rng.integers(0, 7)), replace=False)
            made.add(int(centre) ^ sum(1 << int(f) for f in flips))
    signed = [x - (1 << 64) if x >> 63 else x for x in made]
    pairs = simhash_anchors.links(spark.createDataFrame([(x,) for x in signed], "fp long"), tile=tile)
    found = {r.node: r.root for r in simhash_anchors.components(pairs).collect()}
    want = roots(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert {v: found.get(v, v) for v in signed} == want
    assert pairs.count() < 45 * len(signed)


@pytest.mark.parametrize("tile", [1, 3])
def test_split_anchors_lose_no_link(spark, tile):
    """Pairs of four different bits and small clouds at anchors that are all split, so that most tiles hold one end of a link alone."""
    rng = np.random.default_rng(6)
    made = set()
    for centre in rng.integers(0, 1 << 63, 40, dtype=np.uint64).tolist():
        made.add(int(centre))
        for _ in range(int(rng.integers(1, 4))):
            flips = rng.choice(64, 4, replace=False)
            made.add(int(centre) ^ sum(1 << int(f) for f in flips))
    signed = [x - (1 << 64) if x >> 63 else x for x in made]
    pairs = simhash_anchors.links(spark.createDataFrame([(x,) for x in signed], "fp long"), tile=tile)
    found = {r.node: r.root for r in simhash_anchors.components(pairs).collect()}
    assert {v: found.get(v, v) for v in signed} == roots(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)


def test_one_document_of_a_group_stays(spark, odd):
    kept = simhash_anchors.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # 4, 5 and 6 have no words; 7 and 8 are near copies; 3 and the row without id are there twice.
    assert ids[4] == 1 and not ids[5] and not ids[6] and ids[7] == 1 and not ids[8] and ids[3] <= 1 and ids[None] == 1


def test_deleted_interpolation(spark, odd, small_chunks):
    for docs in (odd, sf(spark)):
        rows = known(docs, spark)
        tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
        counts = Counter(w for i, own in tokens if zlib.crc32(str(i).encode()) % 7 != 2 for w in own)
        n, v = sum(counts.values()), len(counts)
        want = Counter()
        for i, own in tokens:
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
            want[(i, zlib.crc32(str(i).encode()) % 7 == 2, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6))] += 1
        found = deleted_interpolation.score_texts(docs).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
        assert all(r.score < 0 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_weights_maximise_the_held_out_likelihood():
    rng = np.random.default_rng(6)
    cells = np.array([[b, b2, b1, n] for b in (0, 1, 3) for b2 in (ZERO, -20, 40, 90) for b1, n in zip((ZERO, -9, 8, 30), rng.integers(1, 50, 4)) if b or b2 == ZERO])
    uniform = 1e-3
    weights = deleted_interpolation.learn(cells, uniform)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0 and (weights[2] == weights[1]).all()

    def likelihood(b, w):
        rows = cells[cells[:, 0] == b]
        p = [[0.0 if x == ZERO else uniform * 2 ** (x / deleted_interpolation.BINS) for x in r[1:3]] + [uniform] for r in rows]
        return float(rows[:, 3] @ np.log(np.array(p) @ w))

    for b in (1, 3):
        others = rng.dirichlet(np.ones(3), 200)
        assert all(likelihood(b, weights[b]) >= likelihood(b, w) - 1e-6 for w in others)


def test_interpolated_scores_equal_the_plain_model(spark):
    """Scores from counts of a Counter, with the weights that the operator learns from its histogram."""
    texts = ["a b a b a c", "b a", "c c a b", "a b", "a b c zz", "b yy a b"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    tokens = {i: [None, *t.split(), "\n"] for i, t in enumerate(texts)}
    learned = {i: w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2}
    one = Counter(w for own in learned.values() for w in own[1:])
    context, two = Counter(w for own in learned.values() for w in own[:-1]), Counter(p for own in learned.values() for p in zip(own, own[1:]))
    n, uniform = sum(one.values()), 1 / (len(one) + 1)

    def binned(p):
        return round(math.log2(p / uniform) * deleted_interpolation.BINS) if p > 0 else ZERO

    cells = Counter()
    for (v, w), c in two.items():
        cells[(context[v] - 1).bit_length(), binned((c - 1) / (context[v] - 1) if context[v] > 1 else 0), binned((one[w] - 1) / (n - 1))] += c
    weights = deleted_interpolation.learn(np.array([[*k, c] for k, c in cells.items()]), uniform)
    for r in deleted_interpolation.score_texts(docs).collect():
        want = 0.0
        for v, w in zip(tokens[r.doc_id], tokens[r.doc_id][1:]):
            a = weights[context[v].bit_length()]
            want += math.log10(a @ [two[v, w] / context[v] if context[v] else 0, one[w] / n, uniform])
        assert r.score == pytest.approx(want, rel=1e-9)
    assert sum(a @ [two["a", w] / context["a"], one[w] / n, uniform] for w in [*one, "unknown"]) == pytest.approx(1)


def test_binned_weights_are_those_of_exact_estimates(spark):
    """The weights from bins against expectation-maximisation over every token of a corpus, many below uniform."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 7 <> 2").collect()]
    own = [[None, *(t or "").encode().lower().split(), b"\n"] for t in texts]
    one = Counter(w for t in own for w in t[1:])
    context, two = Counter(w for t in own for w in t[:-1]), Counter(p for t in own for p in zip(t, t[1:]))
    n, uniform = sum(one.values()), 1 / (len(one) + 1)
    rows = np.array([[context[v] - 1, (c - 1) / (context[v] - 1) if context[v] > 1 else 0.0, (one[w] - 1) / (n - 1), c] for (v, w), c in two.items()])
    buckets = deleted_interpolation.bucket_of(rows[:, 0])
    bins = [deleted_interpolation.binned(rows[:, k], uniform) for k in (1, 2)]
    found = deleted_interpolation.learn(np.column_stack((buckets, *bins, rows[:, 3].astype(np.int64))), uniform)
    below = rows[(rows[:, 2] > 0) & (rows[:, 2] < uniform), 3].sum()
    assert below > 0.01 * rows[:, 3].sum()
    for b in np.unique(buckets):
        mine = rows[buckets == b]
        p = np.column_stack((mine[:, 1], mine[:, 2], np.full(len(mine), uniform)))
        w = np.full(3, 1 / 3) if b else np.array([0.0, 0.5, 0.5])
        for _ in range(deleted_interpolation.ROUNDS):
            share = p * w
            w = (share * (mine[:, 3] / share.sum(axis=1))[:, None]).sum(axis=0) / mine[:, 3].sum()
        if mine[:, 3].sum() > 200:
            assert np.abs(found[b] - w).max() < 0.01


def test_kneser_ney_equals_brute_force(spark):
    texts = ["a b c a b d", "a b c", "b c d e", "a b", "e e e a b c"]
    asked = [*texts, "a b x", "c d zz q", ""]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(asked)], "doc_id long, text string, lang string")
    found = {r.doc_id: r.perplexity for r in kneser_ney_quality.perplexities(docs, docs.filter("doc_id < 5")).collect()}

    def padded(t):
        return [0, 0, *t.split(), 1]

    three = Counter(tuple(padded(t)[i - 2 : i + 1]) for t in texts for i in range(2, len(padded(t))))
    two = Counter((v, w) for _, v, w in three)
    one = Counter(w for _, w in two)

    def off(counts):
        n = [0, *(sum(c == k for c in counts.values()) for k in range(1, 5))]
        y = n[1] / (n[1] + 2 * n[2])
        made = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k * 0.5 for k in (1, 2, 3)]
        return lambda c, d=[min(max(x, 0.05), k * 0.95) for k, x in zip((1, 2, 3), made)]: d[min(c, 3) - 1] if c else 0.0

    tables = [(one, off(one)), (two, off(two)), (three, off(three))]

    def p(context, w):
        counts, d = tables[len(context)]
        after = {k if not context else k[-1]: c for k, c in counts.items() if not context or k[:-1] == context}
        below = p(context[1:], w) if context else 1 / (len(one) + 1)
        total = sum(after.values())
        if not total:
            return below
        return (after.get(w, 0) - d(after.get(w, 0))) / total + sum(map(d, after.values())) / total * below

    for i, t in enumerate(asked):
        s = padded(t)
        want = 10 ** (-sum(math.log10(p((s[k - 2], s[k - 1]), s[k])) for k in range(2, len(s))) / (len(s) - 2))
        assert found[i] == pytest.approx(want, rel=1e-5)
    assert sum(p(("a", "b"), w) for w in [*one, "unknown"]) == pytest.approx(1)


def test_kneser_ney_keeps_good_documents(spark):
    found = kneser_ney_quality.judge(sf(spark), sf(spark, "labels")).join(sf(spark, "labels"), "doc_id").collect()
    good = [r.keep for r in found if r.quality == 1]
    assert len(good) > 50 and sum(good) >= 0.95 * len(good)


def test_kneser_ney_learns_from_every_trusted_row(spark):
    """More trusted rows than a sample of some thousand, each with a word of its own."""
    rows = [(i, f"own{i} some words that all have and w{i % 97}", "en") for i in range(7_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    good = docs.select("doc_id", F.lit(1).alias("quality"))
    found = {r.doc_id: r.perplexity for r in kneser_ney_quality.judge(docs, good).collect()}
    whole = kneser_ney_quality.perplexities(docs, docs.filter(~kneser_ney_quality.held_out()))
    assert found == pytest.approx({r.doc_id: r.perplexity for r in whole.collect()}, rel=1e-6)


def test_kneser_ney_takes_its_interim_tables_away(spark):
    """Neither texts by chunk nor the model's counts or the shuffles they came from stay on disk."""
    kneser_ney_quality.judge(sf(spark), sf(spark, "labels")).count()  # makes the database
    before = {t.name for t in spark.catalog.listTables("sliceward_scratch")}
    assert kneser_ney_quality.judge(sf(spark), sf(spark, "labels")).count() == sf(spark).count()
    left = {t.name.partition("_")[0] for t in spark.catalog.listTables("sliceward_scratch") if t.name not in before}
    assert left <= {"perplexities", "bounded"}


def test_kneser_ney_does_not_depend_on_chunks(spark):
    """Many chunks and shards; rows without id, text or words, repeated rows, and a word that stands everywhere."""
    rows = [(i, f"the w{i % 7} the w{i % 11} the own{i} the", "en", True, i % 3 == 0) for i in range(300)]
    rows += [(None, "the w1", None, True, False), (5, None, "en", True, True), (6, " ", "en", True, False), (6, " ", "en", True, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, asked boolean, trusted boolean").repartition(2)
    found = [Counter(map(tuple, kneser_ney_quality.weighed(docs, size).collect())) for size in (1 << 20, 1_000)]
    assert found[0] == found[1] and sum(found[0].values()) == len(rows)


def test_packed_numbers_and_keys():
    from sliceward.llm import packed

    rng = np.random.default_rng(2)
    keys = np.sort(rng.integers(0, 1 << 64, 5_000, dtype=np.uint64))
    assert (packed.from_gaps(packed.gaps(keys)) == keys).all()
    columns = [rng.geometric(0.4, 5_000) - 1, np.zeros(5_000, np.int64), np.where(rng.random(5_000) < 0.01, 1 << 40, 1)]
    for n in (5_000, 1, 0):
        made = packed.whole_numbers(packed.small([c[:n] for c in columns]))
        assert len(made) == 3 and all((a == b[:n]).all() for a, b in zip(made, columns, strict=True))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity_pu.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    hits = sum(r.predicted == 1 and r.toxic == 1 for r in found)
    assert hits >= 0.85 * sum(r.toxic == 1 for r in found) and hits >= 0.95 * sum(r.predicted for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_risk_turns_when_it_gets_negative():
    """Positives hidden among the unlabelled are not fitted as negatives."""
    rng = np.random.default_rng(0)
    rows = [np.array([0]) for _ in range(50)] + [np.array([0] if i < 60 else [1]) for i in rng.permutation(200)]
    weights = toxicity_pu.fit(rows, np.arange(50), np.arange(50, 250), 0.3, 2)
    assert weights[0] + weights[-1] > 0 > weights[1] + weights[-1]


def test_license_scan_equals_exact_containment(spark, odd):
    import duckdb

    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = {(r[0], r[1]): r[2] for r in con.execute(license_scan.OP1_SQL).fetchall()}
    found = {(r.doc_id, r.license): r.containment for r in license_scan.scan(sf(spark)).collect()}
    assert found == want and found
    assert [(r.doc_id, r.license, r.at) for r in license_scan.scan(odd).collect()] == [(None, "Apache-2.0", 0)]


def test_pareto_mix_equals_ranking_as_a_whole(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = Counter(con.execute(pareto_mix.OP8_SQL).fetchall())
    assert Counter(tuple(r) for r in pareto_mix.op8_pareto_mix(spark, "/root/testdata/sf0.001").collect()) == want


def test_pareto_mix_targets(spark, odd):
    sizes = [("a", 1000), ("b", 10), ("c", 500), ("d", 0), (None, 300)]
    found = {r.source: r.target for r in pareto_mix.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    assert found["b"] == 20 and found["d"] == 0 and found[None] <= 600
    assert sum(found.values()) == pytest.approx(1.5 * 1810) and all(found[s] <= 2 * n for s, n in sizes)
    mix = Counter(r.doc_id for r in pareto_mix.mixed(odd).collect())
    assert mix == Counter(r.doc_id for r in pareto_mix.mixed(odd.repartition(5)).collect()) and max(mix.values()) <= 4


def test_a_long_document_at_the_cut_is_passed_over(spark):
    """One document with a quarter or more of its source; 400 short ones fill what is open."""
    for long_words in (15_000, 60_000, 200_000):
        for seed in range(3):
            rows = [(seed * 10_000 + i, "w " * 90, "a") for i in range(400)] + [(seed * 10_000 + 9_999, "w " * long_words, "a"), (5, "w " * 40_000, "b")]
            docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
            planned = pareto_mix.plan(pareto_mix.slim(docs), weights=(1, 3), share=0.8)
            goal = {r.source: r.target for r in planned.collect()}
            sizes = {i: (s, len(t.split())) for i, t, s in rows}
            taken: Counter = Counter()
            for r in pareto_mix.mixed(docs, weights=(1, 3), share=0.8).collect():
                taken[sizes[r.doc_id][0]] += sizes[r.doc_id][1]
            fits = long_words <= goal["a"] or goal["a"] <= 36_000
            assert not fits or abs(taken["a"] - goal["a"]) <= 90


def test_one_id_on_two_texts_loses_no_text(spark):
    from sliceward.llm import minhash_copies

    rows = [(1, "a b c d e f g"), (1, "other words here that are not alike at all"), (2, "a b c d e f g"), (1, "a b c d e f g"), (None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for keep in (minhash_copies.keep_one, simhash_anchors.keep_one):
        found = [(r.doc_id, r.text or "") for r in keep(docs).collect()]
        assert sorted(found, key=repr) == [(1, "a b c d e f g"), (1, "other words here that are not alike at all"), (3, "")]
        assert keep(docs.filter("false")).count() == 0


def test_top_k_equals_brute_force(spark, small_chunks):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = {tuple(r) for r in con.execute(blockmax_topk.OP7_SQL).fetchall()}
    found = {tuple(r) for r in blockmax_topk.op7_blockmax_topk(spark, "/root/testdata/sf0.001").collect()}
    assert found == want and len(found) == 20


def test_pivots_lose_no_document():
    """Any threshold up to the k-th score leaves the top k as they are by plain addition."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 60)) if x < 500) for _ in range(700)]
    texts[50:90] = [texts[49]] * 40
    texts[3] = ""
    terms = blockmax_topk.Terms(blockmax_topk.pa.table({"__text": texts}), 7)
    assert (np.diff(terms.shard) >= 0).all() and terms.shard.max() < 7
    index = blockmax_topk.Index(terms, 20.0)
    held = np.bincount(terms.term)
    weight = np.log1p((len(texts) - held + 0.5) / (held + 0.5))
    plain = np.zeros((len(texts), len(held)))
    norm = blockmax_topk.K1 * (1 - blockmax_topk.B + blockmax_topk.B * terms.lengths / 20.0)
    plain[terms.doc, terms.term] = terms.tf * (blockmax_topk.K1 + 1) / (terms.tf + norm[terms.doc])
    for q in (0, 1, 2, 49, 60, 300, 699):
        own = terms.term[terms.doc == q]
        score = np.round(plain[:, own] @ weight[own], 9)
        kth = np.sort(score)[-10]
        for least in (0.0, kth / 2, kth * (1 - 1e-9)):
            place, got = blockmax_topk.best(index, own, weight[own], 10, least)
            doc = index.docs[place]
            assert np.array_equal(np.round(got, 9), score[doc])
            assert {*np.flatnonzero((score >= kth) & (score > 0)).tolist()} <= {*doc.tolist()}


def test_many_copies_give_k_rows_a_query(spark, small_chunks):
    text = "one text that very many documents share"
    docs = spark.createDataFrame([(i, text) for i in range(400)] + [(900, "share nothing else"), (None, text)], "doc_id long, text string")
    found = [tuple(r)[:3] for r in blockmax_topk.search(docs).collect()]
    want = [(q, r, r - 1) for q in (0, 100, 200, 300) for r in range(1, 11)]
    assert sorted(x for x in found if x[0] != 900) == want
    assert sorted(x for x in found if x[0] == 900) == [(900, 1, 900)] + [(900, r, r - 2) for r in range(2, 11)]


def test_latent_retrieval_recall_and_checks(spark, odd):
    docs, items = sf(spark), sf(spark, "benchmark")
    found = {(r.id, r.item_id) for r in latent_decontamination.leaks(docs, items).collect()}
    texts = {r.doc_id: f" {' '.join((r.text or '').lower().split())} " for r in docs.collect()}
    whole = {r.item_id: f" {' '.join(r.text.lower().split())} " for r in items.collect()}
    want = {(d, i) for d, t in texts.items() for i, x in whole.items() if x in t}
    assert want and len(found & want) >= 0.9 * len(want) and len(found - want) <= 0.5 * len(want)
    rare = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert [(r.id, r.item_id) for r in latent_decontamination.leaks(odd, rare).collect()] == [(9, 1)]
    kept = latent_decontamination.without_leaks(odd, rare)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1


def test_latent_space_is_fitted_on_every_document(spark, monkeypatch):
    """The products of all passages, more documents than a sample of some thousand, equal plain sums."""
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 90)) if x < 60) for _ in range(3_000)]
    docs = spark.createDataFrame([*enumerate([*texts, None])], "doc_id long, text string").repartition(3)
    L = latent_decontamination
    (words,) = [w for _, _, w, _ in L.features_of(L.pa.array([" ".join(f"w{i}" for i in range(1, 40))]))]
    own = np.unique(words >> np.uint64(64 - L.FEATURE_BITS)).astype(np.int64)
    plain, frequencies = np.zeros((len(own), len(own)), np.int64), Counter()
    for _, _, words, at in L.features_of(L.pa.array(texts)):
        feature = (words >> np.uint64(64 - L.FEATURE_BITS)).astype(np.int64)
        for a, b in zip(at[:-1], at[1:], strict=True):
            frequencies.update(set(feature[a:b].tolist()))
            blocks = [np.isin(own, feature[x : min(b, x + L.BLOCK)]).astype(np.int64) for x in range(a, b, L.BLOCK)]
            for row in [x + y for x, y in zip(blocks, blocks[1:])] or blocks:
                plain += np.outer(row, row)
    for held in (L.HELD, 50):
        monkeypatch.setattr(L, "HELD", held)
        counts = L.counts_of(docs, [own])
        found = np.zeros((len(own) // L.PRODUCT_ROWS + 1) * L.PRODUCT_ROWS * len(own), np.int64)
        for r in counts.filter("part = 0").collect():
            key, n = L.unpacked(r.held)
            found[r.block * L.PRODUCT_ROWS * len(own) + key] = n
        assert np.array_equal(found.reshape(-1, len(own))[: len(own)], np.triu(plain))
        told, n_docs = L.document_frequencies(counts)
        assert n_docs == 3_001 and {f: told[f] for f in np.flatnonzero(told)} == frequencies
    foreign = L.counts_of(spark.createDataFrame([(1, "zzz " * 40)], "doc_id long, text string"), [own])
    assert L.document_frequencies(foreign)[1] == 1 and foreign.filter("part = 0").isEmpty()


def test_bit_parallel_subsequence():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        return row[-1]

    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = rng.integers(0, 6, 20).tolist(), rng.integers(0, 6, 33).tolist()
        bits: dict = {}
        for i, x in enumerate(a):
            bits[x] = bits.get(x, 0) | 1 << i
        assert latent_decontamination.in_order(bits, len(a), b) == slow(a, b)


def test_odd_rows_and_empty_tables(spark, odd, none, labels):
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    no_labels = labels.limit(0)
    n = odd.count()
    assert toxicity_pu.classify(odd, labels).count() == n and toxicity_pu.classify(odd, no_labels).agg(F.sum("predicted")).first()[0] == 0
    assert kneser_ney_quality.judge(odd, labels).count() == n
    assert kneser_ney_quality.judge(odd, no_labels).filter("keep").count() == n
    assert blockmax_topk.search(odd, k=3).filter("query_id = 100 AND doc_id = 100 AND rank = 1").count() == 1
    assert toxicity_pu.without_toxic(odd, labels).columns == odd.columns
    fixed = block_anchors.without_repeats(odd)
    assert fixed.columns == odd.columns and fixed.count() == n and fixed.filter("doc_id = 4 AND text IS NULL").count() == 1
    for made in (
        license_scan.scan(none),
        deleted_interpolation.score_texts(none),
        toxicity_pu.classify(none, labels),
        simhash_anchors.near_copies(none),
        block_anchors.without_repeats(none),
        latent_decontamination.without_leaks(none, items),
        latent_decontamination.leaks(odd, items.limit(0)),
        blockmax_topk.search(none),
        pareto_mix.mixed(none),
        column_repeats.remove_byte_repeats(none),
        kneser_ney_quality.judge(none, labels),
    ):
        assert made.count() == 0


def test_pipeline_equals_brute_force(spark):
    """Every stage on what its predecessor kept, against the plain reading of what it does."""
    import corpus_pipeline

    path, stages = "/root/testdata/sf0.001", dict(corpus_pipeline.STAGES)
    docs = sf(spark).cache()
    labels = sf(spark, "labels")
    weights = toxicity_pu.train(docs, labels)
    score = {r.doc_id: weights[""] + sum(weights.get(f, 0.0) for f in toxicity_pu.features(r.text)) for r in docs.collect()}
    kept = stages["toxicity"](spark, docs, path).cache()
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in score.items() if s < 0}

    own = {r.doc_id: five_words(r.text) for r in kept.collect()}
    at = roots([*own], lambda a, b: 5 * len(own[a] & own[b]) >= 4 * len(own[a] | own[b]))
    least: dict = {}
    for i in own:
        least[at[i]] = min(i, least.get(at[i], i))
    kept = stages["near_copies"](spark, kept, path).cache()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())

    rows = {r.doc_id: r.text for r in kept.collect()}
    want = {}
    for i, words, gone in windows_removed([*rows.items()], lambda t: t.encode().split(), 50):
        want[i] = b" ".join(w for w, g in zip(words, gone) if not g).decode() if any(gone) else rows[i]
    kept = stages["repeats"](spark, kept, path).cache()
    assert {r.doc_id: r.text for r in kept.collect()} == want
    assert all(r.n_chars == len(r.text) for r in kept.collect() if r.text != rows[r.doc_id])

    whole = [f" {' '.join(r.text.lower().split())} " for r in sf(spark, "benchmark").collect()]
    leaking = {i for i, t in want.items() if any(x in f" {' '.join(t.lower().split())} " for x in whole)}
    kept = stages["leaks"](spark, kept, path).cache()
    left = {r.doc_id for r in kept.collect()}
    assert len(leaking & left) <= 0.1 * len(leaking) and len(want.keys() - leaking - left) <= 0.02 * len(want)

    mix = Counter(r.doc_id for r in stages["mix"](spark, kept, path).collect())
    size = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in kept.collect()}
    goal = {r.source: r.target for r in pareto_mix.targets(kept.select("source", F.size(F.expr("regexp_extract_all(text, '[^ \\t-\\r]+', 0)")).alias("n")).groupBy("source").agg(F.sum("n").alias("source_size"))).collect()}
    taken: Counter = Counter()
    for i, n in mix.items():
        taken[size[i][0]] += n * size[i][1]
    largest = max(n for _, n in size.values())
    assert all(abs(taken[s] - g) <= largest for s, g in goal.items()) and max(mix.values()) <= 2


def test_digest_queries_have_the_promised_columns(spark):
    from sliceward.llm.queries import QUERIES

    found = QUERIES["op5_block_anchors"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    row = found.filter("n_removed = 0").first()
    text = sf(spark).filter(F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256(b" ".join(text.encode().split())).hexdigest()
    row = QUERIES["op4_simhash_anchors"](spark, "/root/testdata/sf0.001").filter("doc_id = 7").first()
    assert row.fingerprint == format(simhash(sf(spark).filter("doc_id = 7").first().text), "016x")


def five_words(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def test_near_copies_stage_equals_brute_force(spark):
    """Five words, similarity 0.8 or more; a chain of near copies, a dense cloud, short and empty texts."""
    import corpus_pipeline

    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(300)]
    texts = [r.text for r in sf(spark).collect()]
    for centre in range(3):
        own = [f"c{centre}{w}" for w in base]
        for _ in range(90):
            texts.append(" ".join(w if rng.random() > 0.012 else f"x{rng.integers(1000)}" for w in own))
    chain = base
    for step in range(8):
        chain = [*chain[:30 * step], *(f"y{step}_{i}" for i in range(25)), *chain[30 * step + 25 :]]
        texts.append(" ".join(chain))
    texts += ["", None, " ", "one two", "One  two", "one three"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    part, own = [*range(len(texts))], [five_words(t) for t in texts]
    for i, j in combinations(range(len(texts)), 2):
        if part[i] != part[j] and 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j]):
            low, high = sorted((part[i], part[j]))
            part = [low if p == high else p for p in part]
    found = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, "")
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == sorted({*part})


def test_near_copies_compare_few_pairs_and_drop_what_they_stored(spark, monkeypatch):
    """A text at many keys meets the same few others at all of them, none of a size that rules a link out."""
    from sliceward.llm import minhash_copies
    from sliceward.sources.stored import scratch_database

    rng = np.random.default_rng(12)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(w if rng.random() > 0.03 else f"x{rng.integers(10**6)}" for w in base) for _ in range(600)]
    texts += [" ".join(base[:n]) for n in range(100, 220)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    size, asked, similar = {}, [], minhash_copies.similar

    def seen(pairs, held, least):
        asked.extend((r.a, r.b) for r in pairs.collect())
        size.update((r.cls, len(r.held)) for r in held.collect())
        return similar(pairs, held, least)

    monkeypatch.setattr(minhash_copies, "similar", seen)
    before = {r.tableName for r in spark.sql(f"SHOW TABLES IN {scratch_database(spark)}").collect()}
    kept = minhash_copies.keep_one(docs).count()
    after = {r.tableName.rpartition("_")[0] for r in spark.sql(f"SHOW TABLES IN {scratch_database(spark)}").collect() if r.tableName not in before}
    assert after <= {"kept", "roots", "edges"} and 0 < kept < len(texts)
    assert len(asked) == len(set(asked)) and all(min(size[a], size[b]) >= 0.8 * max(size[a], size[b]) for a, b in asked)


def test_common_words_are_added_up_for_many_queries_at_once():
    """Their sums come from one product and are those of plain addition; a query that brings them along reads rare words alone."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 60)) if x < 500) for _ in range(333)]
    terms = blockmax_topk.Terms(blockmax_topk.pa.table({"__text": texts}), 3)
    index = blockmax_topk.Index(terms, 20.0)
    weight = np.log1p(len(texts) / np.bincount(terms.term))
    asked = [terms.term[terms.doc == q] for q in (0, 5, 77, 200)]
    sums = index.common([(own, weight[own]) for own in asked])
    norm = blockmax_topk.K1 * (1 - blockmax_topk.B + blockmax_topk.B * terms.lengths / 20.0)
    impact = terms.tf * (blockmax_topk.K1 + 1) / (terms.tf + norm[terms.doc])
    assert 0 < (~index.rare).sum() < 60
    for own, row in zip(asked, sums, strict=True):
        mine = np.isin(terms.term, own) & ~index.rare[terms.term]
        plain = np.bincount(terms.doc[mine], weights=(weight[terms.term] * impact)[mine], minlength=len(texts))
        np.testing.assert_allclose(row[: len(texts)], plain[index.docs], rtol=1e-12)
        assert not row[len(texts) :].any()
        entries = blockmax_topk.Cursors(index, own, weight[own]).entries
        assert index.rare[np.searchsorted(index.of_term, entries, side="right") - 1].all()
        for found, want in zip(blockmax_topk.best(index, own, weight[own], 10, 0.0, row), blockmax_topk.best(index, own, weight[own], 10, 0.0), strict=True):
            np.testing.assert_allclose(found, want)


def test_near_copies_of_a_cloud_meet_by_common_differences(spark, monkeypatch):
    """Texts of one base, changed in different places and mostly unlinked: few of all pairs are compared, no link is lost."""
    from sliceward.llm import minhash_copies

    rng = np.random.default_rng(21)
    base = [f"w{i}" for i in range(160)]
    texts = [" ".join(w if rng.random() > rate else f"x{rng.integers(10**6)}" for w in base) for rate in (0.01, 0.03, 0.05) for _ in range(200)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    sets = [{tuple(words[i : i + 5]) for i in range(len(words) - 4)} for words in map(str.split, texts)]
    part = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) and part[i] != part[j]:
            part = [part[i] if p == part[j] else p for p in part]
    asked, similar = [], minhash_copies.similar

    def seen(pairs, held, least):
        asked.extend((r.a, r.b) for r in pairs.collect())
        return similar(pairs, held, least)

    monkeypatch.setattr(minhash_copies, "similar", seen)
    kept = [r.doc_id for r in minhash_copies.keep_one(docs).collect()]
    first = {p: part.index(p) for p in part}
    assert sorted(kept) == sorted(first.values()) and 200 < len(kept) < 500
    assert len(asked) == len(set(asked))
    assert len(asked) < 0.15 * len(texts) ** 2 / 2


def test_kneser_ney_needs_no_limit_of_ngrams(spark, small_chunks, monkeypatch):
    """More triples than were once broadcast, one very long trusted text, many chunks and shards, a crowded filter."""
    docs = sf(spark).unionByName(spark.createDataFrame([(10**6, LONG, "en", "a", 1)], sf(spark).schema))
    trusted = docs.filter("doc_id % 3 = 1")
    whole = {r.doc_id: r.perplexity for r in kneser_ney_quality.perplexities(docs, trusted).collect()}
    monkeypatch.setattr(kneser_ney_quality, "MOST_NGRAMS", 1, raising=False)
    monkeypatch.setattr(kneser_ney_quality, "FILTER_BYTES", 64, raising=False)
    found = {r.doc_id: r.perplexity for r in kneser_ney_quality.perplexities(docs, trusted).collect()}
    assert found == whole and len(found) == docs.count()


def test_a_word_and_a_bigram_with_like_hashes_are_told_apart(spark):
    """A held-out word agrees with a learned bigram in the low 40 bits of the hash; neither N nor n_known may notice."""
    from sliceward.llm import textarrays as T

    raw = np.frombuffer(" ".join(f"w{i}" for i in range(3_000_000)).encode(), np.uint8)
    (words,), _ = T.word_hashes(raw, np.array([0, len(raw)]), [T.SpanHash(31)])
    pairs, low = T.mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]), np.uint64((1 << 40) - 1)
    _, word, pair = np.intersect1d(words & low, pairs & low, return_indices=True)
    assert len(word)
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    learned = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 != 2)
    rows = [(learned, f"w{pair[0]} w{pair[0] + 1}"), (held, f"w{word[0]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: (r.train_tokens, r.n_known) for r in deleted_interpolation.score_texts(docs).collect()}
    assert found == {learned: (3, 3), held: (3, 1)}


def test_near_copies_without_a_common_minhash_key_are_found(spark):
    """Pairs at 0.8 that share none of the 20 MinHash keys; one in some 40,000 does."""
    from sliceward.llm import minhash_copies

    pairs = [27442, 57850, 197440]
    texts = [" ".join(f"p{i}w{j}" for j in range(words)) for i in pairs for words in (9, 8, 7)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(2)
    keys = {r.id: {*r["keys"]} for r in minhash_copies.sketches(docs).collect()}
    assert not any(keys[3 * p] & keys[3 * p + 1] for p in range(3))
    assert sorted(r.doc_id for r in minhash_copies.keep_one(docs).collect()) == [0, 2, 3, 5, 6, 8]


def test_linked_texts_share_one_of_their_rarest_shingles():
    """Whatever else holds the shingles; texts that others cannot be linked to have no such key."""
    from sliceward.llm import minhash_copies

    rng, sets = np.random.default_rng(17), []
    for _ in range(150):
        base = rng.choice(4000, rng.integers(1, 60), replace=False)
        for _ in range(3):
            kept = base[rng.random(len(base)) > 0.1 * rng.random()]
            sets.append(np.unique(np.concatenate((kept, rng.choice(4000, rng.integers(0, 6)), base[:1]))).astype(np.uint64))
    sets += [np.arange(9000, 9040, dtype=np.uint64), np.arange(9036, 9080, dtype=np.uint64)]
    at, made = np.cumsum([0] + [len(x) for x in sets]), np.concatenate(sets)
    keys = [{*k.tolist()} for k in minhash_copies.rarest(made, at, np.bincount(made.astype(np.int64))[made.astype(np.int64)], 0.8)]
    links = 0
    for i, j in combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
            links += 1
            assert keys[i] & keys[j]
    assert links > 100 and not keys[-1] and not keys[-2]


def test_queries_searched_together_find_what_each_finds_alone(monkeypatch):
    """With and without thresholds, whichever way postings are read; a query without words in the shard finds nothing."""
    rng = np.random.default_rng(14)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 60)) if x < 500) for _ in range(900)]
    texts[50:90] = [texts[49]] * 40
    terms = blockmax_topk.Terms(blockmax_topk.pa.table({"__text": texts}), 7)
    held = np.bincount(terms.term)
    weight = np.log1p((len(texts) - held + 0.5) / (held + 0.5))
    norm = blockmax_topk.K1 * (1 - blockmax_topk.B + blockmax_topk.B * terms.lengths / 20.0)
    plain = np.zeros((len(texts), len(held)))
    plain[terms.doc, terms.term] = terms.tf * (blockmax_topk.K1 + 1) / (terms.tf + norm[terms.doc])
    own = [terms.term[terms.doc == q] for q in (0, 49, 60, 300, 899)] + [np.zeros(0, np.int64)]
    scores = [np.round(plain[:, x] @ weight[x], 9) for x in own]
    kth = np.array([np.sort(x)[-10] for x in scores])
    for rare in (0.02, 0.1, 1.0):
        monkeypatch.setattr(blockmax_topk, "RARE", rare)
        index = blockmax_topk.Index(terms, 20.0)
        for least in (np.zeros(6), kth / 2, kth * (1 - 1e-9), kth * [1 - 1e-9, 0, 1, 0, 0.5, 0]):
            query, place, got = blockmax_topk.best_of_all(index, blockmax_topk.Asked.of([(x, weight[x]) for x in own]), 10, least)
            for q, score in enumerate(scores):
                doc = index.docs[place[query == q]]
                assert len(doc) == len({*doc.tolist()}) and np.array_equal(np.round(got[query == q], 9), score[doc])
                assert {*np.flatnonzero((score >= kth[q]) & (score > 0)).tolist()} <= {*doc.tolist()}
