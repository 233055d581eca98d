"""The class model against plain recounts: gains, class tables and scores, with words that no task holds."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import class_lm
from pitpanel.llm.base import staged
from pitpanel.session import get_spark

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spark():
    return get_spark("local[2]", app="llm-tests", shuffle_partitions=4)


def test_gains_are_those_of_a_recount():
    rng = np.random.default_rng(7)
    seq, cls, k = rng.integers(0, 14, 400), rng.integers(0, 6, 14), 6

    def table(of):
        n = np.zeros((k, k))
        np.add.at(n, (of[seq[:-1]], of[seq[1:]]), 1)
        return n
    n = table(cls)
    right, left, same = np.zeros((14, k)), np.zeros((14, k)), np.zeros(14)
    for a, b in zip(seq, seq[1:]):
        if a == b:
            same[a] += 1
        else:
            right[a, cls[b]] += 1
            left[b, cls[a]] += 1
    for movable in (4, 6):
        best, gain = class_lm.best_moves(n, cls, right, left, same, movable)
        for w in range(14):
            def moved(c):
                of = cls.copy()
                of[w] = c
                return class_lm.likelihood(table(of)) - class_lm.likelihood(n)
            want = [moved(c) for c in range(movable)]
            assert math.isclose(gain[w], max(want), abs_tol=1e-6) and math.isclose(want[best[w]], max(want), abs_tol=1e-6)


def test_rare_words_have_classes_of_their_contexts(spark):
    """Words that are neither clustered nor held, alike in form and count, are told apart by their neighbours."""
    rare = {g: [g + x + y for x in "abcdefg" for y in "abcdefg"] for g in "xy"}
    texts, frames = [], {"x": "aa {} bb", "y": "cc {} dd"}
    for g, words in rare.items():
        texts += [" ".join(frames[g].format(v) for w in words[i % 7::7] for v in (w, g + "qr"[i % 2])) for i in range(49)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(
        f"{frames[g].format(w)}" for g in "xy" for h in "xy" for w in rare[h])], "doc_id bigint, text string")
    docs = docs.where(f"doc_id < 1000 or crc32(cast(doc_id as string)) % {class_lm.HOLD_OUT[0]} = {class_lm.HOLD_OUT[1]}")
    got = {r.doc_id: r.score for r in class_lm.score(docs, clustered=8, classes=8, held=8).collect()}
    kind = {1000 + i: (g == h) for i, (g, h) in enumerate((g, h) for g in "xy" for h in "xy" for _ in rare[h])}
    right, wrong = ([s for i, s in got.items() if i >= 1000 and kind[i] == x] for x in (True, False))
    assert right and wrong and min(right) > max(wrong) + 1


@pytest.mark.parametrize("held", [40, 900, 10**6])
def test_score_is_that_of_a_plain_version(spark, monkeypatch, held):
    kept, whole = {}, class_lm.exchange_all

    def exchange_all(*args):
        kept["got"] = whole(*args)
        kept["tail"] = {r["word"].encode(): r["cls"] for r in kept["got"][1].collect()}
        return kept["got"]

    def frequent(*args):
        kept["head"] = [r["word"].encode() for r in most(*args)]
        return most(*args)
    most = class_lm.frequent
    monkeypatch.setattr(class_lm, "exchange_all", exchange_all)
    monkeypatch.setattr(class_lm, "frequent", frequent)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).union(spark.createDataFrame(
        [(10**6 + i, t) for i, t in enumerate([None, "", "again again again zq zq zq", "zq zq", "only-here seen", "um um " * 30])],
        "doc_id bigint, text string")).persist()
    rows = [(r.doc_id, class_lm.tokens(r.text or "")) for r in docs.collect()]
    got = {r.doc_id: r.score for r in class_lm.score(docs, clustered=30, classes=6, held=held).collect()}
    cls, _, _, table = kept["got"]
    head, end = kept["head"], len(cls) - 1
    k, first_form = int(cls[end]) + 1, int(cls[len(head)])
    of = {**dict(zip(head, cls.tolist())), **kept["tail"], b"": k - 1}
    training = [[b"", *t, b""] for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for t in training for w in t[1:])
    assert set(of) == set(count)
    n = np.zeros((k, k))
    for t in training:
        for a, b in zip(t, t[1:]):
            n[of[a], of[b]] += 1
    assert np.array_equal(table[:k, :k], n)
    n = np.zeros((k, k))
    mass, kinds = np.zeros(k), np.zeros(k)
    for t in training:
        for a, b in zip(t, t[1:]):
            for c in [of[a]] + [first_form + class_lm.form(a)] * (a != b"" and count[a] == 1):
                for d in [of[b]] + [first_form + class_lm.form(b)] * (b != b"" and count[b] == 1):
                    n[c, d] += 1
    for w, x in count.items():
        for c in [of[w]] + [first_form + class_lm.form(w)] * (w != b"" and x == 1):
            mass[c] += x
            kinds[c] += 1
    for i, t in rows:
        c = [of.get(w, first_form + class_lm.form(w) if w else k - 1) for w in [b"", *t, b""]]
        want = sum(math.log10((n[x, y] + .5) / (n[x].sum() + .5 * k)) + math.log10((count[w] + .5) / (mass[y] + .5 * (kinds[y] + 1)))
                   for x, y, w in zip(c, c[1:], [*t, b""]))
        assert math.isclose(got[i], want, rel_tol=1e-9)


# -- work per pair of codes, per occurrence and per token (FINDINGS_r03: 1395 CPU seconds a GB) ---------------------------

def test_moves_of_codes_shuffle_no_pairs(spark):
    """A code's neighbours lie in its row: its best move needs no shuffle and is that of a plain recount."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40).persist()
    words = [r["word"].encode() for r in class_lm.frequent(class_lm.word_counts(class_lm.texts(docs)).where("word != ''"), 60)]
    bigrams = staged(class_lm.bigram_counts(class_lm.texts(docs), words), "bigrams")
    m, end = len(words), len(words) + class_lm.FORMS
    code = {w: i for i, w in enumerate(words)} | {b"": end}
    pairs = Counter()
    for r in docs.collect():
        seq = [code.get(w, m + class_lm.form(w) if w else end) for w in [b"", *class_lm.tokens(r.text or ""), b""]]
        pairs.update(zip(seq, seq[1:]))
    cls = np.concatenate([np.arange(m) % 6, 6 + np.arange(class_lm.FORMS + 1)])
    n = np.zeros((cls.max() + 1,) * 2)
    right, left, same = np.zeros((m, len(n))), np.zeros((m, len(n))), np.zeros(m)
    for (a, b), x in pairs.items():
        n[cls[a], cls[b]] += x
        if a == b:
            if a < m:
                same[a] += x
            continue
        if a < m:
            right[a, cls[b]] += x
        if b < m:
            left[b, cls[a]] += x
    assert np.array_equal(class_lm.class_table(bigrams, cls), n)
    moves = class_lm.proposals(bigrams, cls, n, m, 6)
    assert "Exchange" not in moves._jdf.queryExecution().executedPlan().toString()
    best, gain = class_lm.best_moves(n, cls[:m], right, left, same, 6)
    got = {r["w"]: (r["cls"], r["gain"]) for r in moves.collect()}
    assert {w: c for w, (c, _) in got.items()} == dict(enumerate(best.tolist()))
    assert all(math.isclose(got[w][1], gain[w], abs_tol=1e-6) for w in range(m))


def test_words_of_a_batch_are_the_tokens():
    rows = ["".join(map(chr, range(1, 300))), " a  b ", "", "   ", "É Aé b c\x85d\x1cE", "\n", "A" * 20 + "\r\n\x0b\x0c z9", "x"]
    text, word = class_lm.words_of(pa.array(rows))
    assert [[w.encode() for w, i in zip(word.to_pylist(), text) if i == k] for k in range(len(rows))] == [
        class_lm.tokens(x) for x in rows]


def test_a_row_per_word_whatever_its_number(spark, monkeypatch):
    """Words that share a number, and words that go on in the next batch, are put together by themselves."""
    monkeypatch.setattr(class_lm.F, "xxhash64", lambda name: F.length(name).cast("bigint"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(f"{'w' * (i % 3)}{i % 11}", i) for i in range(900)]
        got = class_lm.by_word(spark.createDataFrame(rows, "word string, around bigint")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for word, i in rows:
        want.setdefault(word, []).append(i)
    assert len(got) == len(want) and {r["word"]: sorted(r["around"]) for r in got} == want


# -- each occurrence once through the shuffles (FINDINGS_r03: projected to 968 CPU seconds a GB) ----------------------------

def test_a_row_per_word_keeps_its_texts_beside_its_contexts(spark):
    rows = [(f"{'w' * (i % 3)}{i % 11}", i, 10**12 + 7 * i) for i in range(900)]
    got = class_lm.by_word(spark.createDataFrame(rows, "word string, around bigint, rid bigint"), ("rid",)).collect()
    assert len(got) == 33 and sorted((r["word"], a, t) for r in got for a, t in zip(r["around"], r["rid"], strict=True)) == sorted(rows)


def test_classes_are_dealt_out_once_for_both_neighbours(spark):
    of = staged(spark.createDataFrame([("a", 3, True), ("b", 4, False)], "word string, cls int, once boolean"), "of")
    rare = staged(spark.createDataFrame([(1, True, "a", "b"), (2, False, "b", "new"), (3, True, "b", None)],
                                        "rid bigint, train boolean, word string, follow string"), "rare")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = class_lm.neighbours(rare, of, 10)
        assert pairs._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") == 1
        got = {r["rid"]: (r["word"], r["follow"], r["c"], r["d"], r["once_c"], r["form_c"]) for r in pairs.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == {1: ("a", "b", 3, 4, True, 10), 2: ("b", "new", 4, 10, False, None)}


def test_texts_held_out_are_paired_once_with_the_classes_found(spark, monkeypatch):
    """Rounds before the last pair training words alone; if the search ends early, the other pairs still reach the scores."""
    monkeypatch.setattr(class_lm, "likelihood", lambda n: 0.0)       # the second round is refused
    seen, whole = [], class_lm.neighbours

    def neighbours(rare, *args):
        seen.append(sorted(r["train"] for r in rare.select("train").distinct().collect()))
        return whole(rare, *args)
    monkeypatch.setattr(class_lm, "neighbours", neighbours)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).persist()
    scores = []
    for rounds in (2, 1):
        scores.append({r.doc_id: r.score for r in class_lm.score(docs, clustered=30, classes=6, held=40, rounds=rounds).collect()})
    early, want = scores
    assert seen[0] == [True] and seen[-2:] == [[False], [False, True]]
    assert early.keys() == want.keys() and all(math.isclose(early[i], want[i], rel_tol=1e-12) for i in want)
