"""Parity-sketch join, fill-in-the-middle, filter audit: SQL, brute force and edge tables."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitpanel.llm import fill_in_middle as fim
from pitpanel.llm import filter_audit as fa
from pitpanel.llm import parity_join as pj
from pitpanel.llm.oracle import SQL
from pitpanel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, part string, mask int, form string"


def frame(spark, rows):
    """Rows (doc_id, text[, source]) with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, 3, "clash", 31, "psm") for r in rows], SCHEMA)


def sql_rows(name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    return cols, sorted((tuple(r[cols.index(c)] for c in sorted(cols)) for r in res.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["op11_parity_join", "op12_fill_in_middle", "op13_filter_audit"])
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cols, want = sql_rows(name)
    assert sorted(df.columns) == sorted(cols)
    assert sorted((tuple(r[c] for c in sorted(cols)) for r in df.collect()), key=repr) == want


# -- 11 parity-sketch join ---------------------------------------------------------------------

def shingle_set(text, k=5):
    w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute_components(rows, percent=80):
    """{row number: (set size, component's rows)} by comparing every pair of sets that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    common = Counter(p for at in where.values() for p in itertools.combinations(at, 2))
    for (i, j), n in common.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            up[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    return {i: (len(sets[i]), g) for g in groups.values() for i in g}


def check_join(spark, rows, **params):
    got = sorted(map(tuple, pj.similar(frame(spark, rows), **params).select(
        "doc_id", "n_shingles", "component_id", "component_size").collect()), key=repr)
    want = []
    for i, (n, group) in brute_components(rows, params.get("percent", 80)).items():
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        want.append((rows[i][0], n, min(ids) if ids else None, len(group)))
    assert got == sorted(want, key=repr)
    return want


def vary(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**9)}"
    return " ".join(words)


def test_join_edges(spark):
    long = " ".join(f"v{i % 5003}" for i in range(400_000))                      # 2.6 MB, many repeats
    rows = [(1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two"), (7, "a b c d e"),
            (8, "A B\nC\tD E"), (None, "a b c d e"), (None, "alone here"), (9, "x" * 300_000), (10, long), (11, long + " more"),
            (12, "é ü ñ 漢字 ß"), (13, "É Ü Ñ 漢字 ß"), (14, "a b c d e f g h i"), (15, "a b c d e f g h j"), (16, "a b c d e")]
    want = check_join(spark, rows)
    assert (11, 5004, 10, 2) in want                       # the long texts are linked
    assert pj.similar(frame(spark, [])).count() == 0
    assert pj.similar(frame(spark, [(1, None), (2, "")])).count() == 2


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_join_against_brute_force_around_the_threshold(spark, percent):
    """Families of edited texts of every length, most of them near the threshold, chains among them."""
    rng, rows = random.Random(percent), []
    for family in range(60):
        n = rng.choice([5, 6, 7, 8, 9, 10, 12, 13, 20, 33, 64, 100, 260, 700])
        base = [f"t{rng.randrange(10**9)}" for _ in range(n)]
        text = " ".join(base)
        rows.append((len(rows), text))
        for _ in range(rng.randrange(6)):
            near = vary(rng, text.split() if rng.random() < 0.5 else base, rng.randrange(0, max(2, n // 25)))
            near = near if rng.random() < 0.6 else " ".join(near.split()[:max(5, int(n * rng.uniform(0.75, 1)))])
            rows.append((len(rows), near))
            text = near
    rng.shuffle(rows)
    check_join(spark, rows, percent=percent)


def test_join_of_a_large_group_goes_through_blocks(spark, monkeypatch):
    """One text's edited copies, many of them below the threshold to each other, and a passage that all texts
    share: the leader leaves components open, which blocks of a few sets must settle."""
    monkeypatch.setattr(pj, "SMALL", 8)
    monkeypatch.setattr(pj, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, vary(rng, base, rng.randrange(1, 14))) for i in range(90)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(200 + i, passage + " " + " ".join(f"o{i}_{j}" for j in range(rng.randrange(10, 60)))) for i in range(60)]
    rows += [(300 + i, rows[i % 3][1]) for i in range(40)]
    want = check_join(spark, rows)
    assert len({c for _, _, c, _ in want}) > 20


def test_join_checks_its_percent(spark):
    with pytest.raises(ValueError):
        pj.similar(frame(spark, [(1, "a")]), percent=50)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.floats(0, 0.3))
def test_linked_sets_show_a_common_piece(seed, n, share):
    """The pigeonhole, whatever the order of the pieces: no linked pair without a shown piece in common, and
    both sketches bound the symmetric difference from below."""
    rng = np.random.default_rng(seed)
    def fresh(size):
        return pj.S.mix(rng.integers(0, 2**63, size).astype(np.uint64))

    a = np.unique(fresh(n))
    drop = rng.random(len(a)) < share * rng.random()
    b = np.unique(np.concatenate([a[~drop], fresh(int(share * n * rng.random()))]))
    if len(b) == 0:
        return
    diff = len(a) + len(b) - 2 * len(np.intersect1d(a, b))
    g, t = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
    sizes = np.bincount(t)
    hot = np.sort(rng.choice(pj.shown(g, t, sizes, 80, None)[0], 5))
    for order in ((np.zeros(0, np.uint64), np.zeros(0, np.int64)), (hot, np.arange(5) + 1)):
        key, owner = pj.shown(g, t, sizes, 80, order)
        if pj.within(diff, len(a), len(b), 80):
            assert np.intersect1d(key[owner == 0], key[owner == 1]).size
        assert all(np.bincount(owner, minlength=2)[i] <= 2 * (pj.most_different(sizes[i]) + 1) + 40 for i in (0, 1))
    x, y = (np.frombuffer(s, np.uint64) for s in pj.bit_sketches(g, t, sizes))
    w = min(len(x), len(y))
    assert np.bitwise_count(pj.folded(x, w) ^ pj.folded(y, w)).sum() <= diff


def test_pieces_are_fine_enough():
    assert [pj.finer(p) for p in (80, 90, 100)] == [0, 0, 0] and pj.finer(60) > 1
    for percent in (51, 60, 80):
        rng = np.random.default_rng(percent)
        for n in (60, 127, 128, 1000):
            g = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            key, _ = pj.pieces(g, np.zeros(n, np.int64), np.array([int(np.log2(n)) + pj.finer(percent)]), 0)
            assert len(key) > pj.most_different(n, percent)


def test_words_of_long_texts_are_cut_at_white_space():
    texts = ["", "aa bb\tcc  dd", "x" * 100, "  e f  ", "g" * 40 + " h"]
    col = pa.array(texts)
    data, offs = pj.S.utf8(col)
    want = pj.words(data, offs)
    for segment in (1, 3, 7, 50):
        got = pj.words(data, offs, segment)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert np.bincount(want[1], minlength=5).tolist() == [0, 4, 1, 2, 2]


def test_two_sets_with_one_hash_are_noticed(spark, monkeypatch):
    real = pj.set_hashes
    monkeypatch.setattr(pj, "profile", lambda docs, k, percent: docs.sparkSession.createDataFrame(
        [(1, 5, 77, 1, b"x"), (2, 5, 77, 2, b"y")], "doc_id bigint, n bigint, node bigint, again bigint, content binary"))
    assert real is pj.set_hashes
    with pytest.raises(RuntimeError):
        pj.similar(frame(spark, [(1, "a")]))


# -- 12 fill in the middle ---------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=200))
def test_skip_list_places(widths):
    units = fim.SkipList(widths)
    assert [units.place(r) for r in range(len(widths) + 1)] == [sum(widths[:r]) for r in range(len(widths) + 1)]
    with pytest.raises(IndexError):
        units.place(len(widths) + 1)


def test_skip_list_descends_in_few_steps():
    n = 100_000
    units = fim.SkipList([3] * n)
    assert len(units.lanes) >= 6
    for lane, below in zip(units.lanes[1:], units.lanes):
        assert len(lane) < len(below) / 2 or len(below) < 100
        assert all(sum(x[0] for x in below[start:end[2]]) == end[0] for start, end in
                   zip([0] + [x[2] for x in lane], lane[:50]))
    assert units.place(77_777) == 3 * 77_777


TEXTS = ["", "a", "\n", "\n\n", "a\nb", "a\nb\n", "é漢\n𝄞x\r\ny", "has <P> in it", "<S>", "x<M>\n", "<", "<S", "P>\n<", "<P\n>",
         "line\n" * 5000, "𝄞" * 200_000 + "\nz" * 100_000]


def brute_fim(i, t):
    t = t or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(lines)
    h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if t == "" or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    return (n, *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 50 else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")))


def test_fim_against_brute_force_and_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(i, t) for i, t in enumerate(TEXTS[3:7], 100)] * 2 + [(None, "a\nb\nc"), (55, None)]
    out = fim.transform(frame(spark, rows))
    got = [tuple(r) for r in out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                                        fim.restored().alias("restored")).collect()]
    want = [(i, *brute_fim(i, t), t or "") for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.digest(fim.transform(frame(spark, []))).count() == 0


def test_fim_other_units_shares_and_sentinels(spark):
    marks = ("[pre]", "[suf]", "[mid]")
    rows = [(i, f"text {i} é\nof some lines\n" * (i % 5)) for i in range(200)]
    out = fim.transform(frame(spark, rows), unit="char", seed=3, fim_percent=60, spm_percent=30, sentinels=marks)
    got = out.withColumn("back", fim.restored(sentinels=marks)).collect()
    assert all(r.back == dict(rows)[r.doc_id] and r.n == len(r.back) for r in got)
    forms = Counter(r.form for r in got if r.back)
    assert 0.45 < (forms["psm"] + forms["spm"]) / sum(forms.values()) < 0.75 and forms["psm"] > forms["spm"]
    for bad in (("<P>", "<P>", "<M>"), ("ab", "ba", "x"), ("aXa", "b", "c"), ("", "b", "c"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            fim.check_sentinels(bad)
    with pytest.raises(ValueError):
        fim.transform(frame(spark, []), unit="word")


# -- 13 filter audit -----------------------------------------------------------------------------

AUDIT_TEXTS = ["", None, "word " * 250, " ".join(f"u{i}" for i in range(250)), "A" * 50, "B b" * 10, "has # mark", "é" * 98 + "AB",
               "é" * 97 + "ABC", " ".join(f"u{i}" for i in range(199)), " ".join(f"u{i}" for i in range(200)), "a&b " * 300,
               "x x y y", "x x x y y y z", " \t\n\v\f\r   a", "Ω" * 1_000_000, "q\x1cq q"]


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = []
    for i, text, part in docs:
        t = text or ""
        w = re.findall(r"[^ \t-\r]+", t)
        same = [j for j, other, _ in docs if (other or "") == t and j is not None]
        fails.append((part or "", i, {f for f, x in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search(r"[#$%&*|]", t)), i is not None and min(same) < i)) if x}))
    out, shapley = {}, Counter()
    for order in itertools.permutations("ABCDE"):
        for part in {p for p, _, _ in fails}:
            alive = [(i, f) for p, i, f in fails if p == part]
            everyone = alive
            for step, f in enumerate(order, 1):
                gone = [(i, s) for i, s in alive if f in s]
                alive = [(i, s) for i, s in alive if f not in s]
                out[part, "".join(order), step] = (
                    len(alive), len(gone), sum(f in s for _, s in everyone) - len(gone), sum(s == {f} for _, s in everyone),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                shapley[part, f] += len(gone)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_against_brute_force_on_edges(spark):
    docs = [(i, t, ("a", "b", None, "")[i % 4]) for i, t in enumerate(AUDIT_TEXTS * 2)]
    docs += [(3, AUDIT_TEXTS[3], "a"), (3, AUDIT_TEXTS[3], "a"), (None, AUDIT_TEXTS[3], "b"), (None, "", "b"), (-5, "x x y y", "c")]
    labels = [(0, 1, 0), (0, 0, 1), (3, 1, 1), (4, 0, 1), (9, None, 1), (10, 1, None), (None, 1, 1), (99, 1, 1), (20, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {tuple(r) for r in fa.interactions(frame(spark, docs), table).collect()}
    assert got == brute_audit(docs, labels)
    assert len(got) == 600 * 4                                       # '' and NULL are one part
    assert fa.interactions(frame(spark, []), table).count() == 0
    assert fa.interactions(frame(spark, docs), table.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[0:2] == (0, 0)


def test_potentials_are_the_recursion_of_the_definition(spark):
    rng = random.Random(2)
    v = [0] + [rng.randrange(10**6) for _ in range(31)]
    from fractions import Fraction
    p = {0: Fraction(0)}
    for s in range(1, 32):
        p[s] = (v[s] + sum(p[s ^ 1 << i] for i in range(5) if s >> i & 1)) / Fraction(bin(s).count("1"))
    got = spark.createDataFrame([(v,)], "v array<bigint>").select(fa.potentials(F.col("v"), 5)).first()[0]
    assert got == [math.factorial(bin(s).count("1")) * p[s] for s in range(32)]
    assert sum(got[31] - 5 * got[31 ^ 1 << i] for i in range(5)) == 120 * v[31]          # efficiency


def test_audit_of_other_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 3, 1, 1), ("p", 3, 2, 2, 0)],
                                  "part string, mask int, n bigint, good bigint, toxic bigint")
    rows = {(r.filter_order, r.step): r.asDict() for r in fa.audit(cells, "XY").collect()}
    assert rows["XY", 1]["removed"] == 5 and rows["XY", 2]["removed"] == 0 and rows["XY", 2]["redundant"] == 2
    assert rows["YX", 1]["removed"] == 2 and rows["YX", 2]["removed"] == 3 and rows["YX", 2]["kept"] == 5
    assert rows["XY", 1]["shapley"] == 8 and rows["XY", 2]["shapley"] == 2
    with pytest.raises(ValueError):
        fa.audit(cells, "ABCDEFGH")
