"""The training-data operators against brute force, and on edge tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from pitpanel.llm import (class_lm, decontaminate, licenses, mixing, near_dups, quality, secrets, shingles, token_counts,
                          token_files, tokens, toxicity)
from pitpanel.llm.queries import QUERIES, tokenizer_path
from pitpanel.session import work_dir

SF = "/root/testdata/sf0.001"
EDGES = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (None, "The MIT license"), (5, "x" * 50_000),
         (6, "word " * 20_000), (7, "é ü ñ 漢字 " * 30), (8, "a  b \n c "), (9, "AKIA" + "A" * 20 + ' token = "0123456789abcdef"')]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, content string, node bigint, rid string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(i, t, None, None, None, "c", 1, "r") for i, t in EDGES], SCHEMA)


def words(t):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))


# -- 1 near duplicates -------------------------------------------------------------------------

def brute_classes(rows):
    sets, first = {}, {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset([t])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    inv, common = defaultdict(list), Counter()
    for i, s in sets.items():
        j = first.setdefault(s, i)
        up[root(i)] = root(j)
        if i == j:
            for x in s:
                inv[x].append(i)
    for x in inv.values():
        common.update((a, b) for k, a in enumerate(x) for b in x[k + 1:])
    for (a, b), n in common.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8:
            up[root(a)] = root(b)
    out = defaultdict(list)
    for i in sets:
        out[root(i)].append(i)
    return {i: min(g) for g in out.values() for i in g}


def test_near_dups_match_sql(spark):
    import duckdb
    from pitpanel.llm.oracle import SQL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = QUERIES["op1_near_dups"](spark, SF)
    want = con.execute(SQL["op1_near_dups"])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_near_dups_match_brute_force(docs, rows):
    got = {r.doc_id: r.class_id for r in near_dups.classes(docs).collect()}
    assert got == brute_classes(rows)
    kept = near_dups.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_dart_signatures_estimate_weighted_jaccard():
    a, b = shingles.stream(200, 1), np.concatenate([shingles.stream(160, 1), shingles.stream(40, 2)])
    w = np.arange(200) % 6 + 1.0
    sig = near_dups.signatures(np.concatenate([a, b]), np.concatenate([w, w]), np.repeat([0, 1], 200), 2, 5000)
    low = w[:160].sum()
    assert abs((sig[0] == sig[1]).mean() - low / (2 * w.sum() - low)) < 0.03
    assert not np.isinf(sig).any()


def test_star_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    made = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        for p in rng.choice(200, 3, replace=False):
            w[p] = f"z{i}x{p}"
        made.append((i, " ".join(w)))
    made += [(100 + i, " ".join(f"q{i}k{j}" for j in range(50))) for i in range(5)]
    df = spark.createDataFrame(made, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_dups.classes(df).collect()}
    assert got == brute_classes(made)


def test_crowded_buckets_without_leaders(spark):
    # texts that share boilerplate (similarity about 0.7 to each other), and of some an edited copy: all
    # pairs at 0.8 or more share crowded buckets, and hardly one of them holds a leader
    rng = np.random.default_rng(5)
    common = [f"b{i}" for i in range(120)]
    data, edited = [], {}
    for i in range(150):
        own = [f"o{i}x{j}" for j in range(20)]
        data.append((i, " ".join(common + own)))
        if i % 3 == 0:
            at = int(rng.integers(10, 110))
            edited[1000 + i] = i
            data.append((1000 + i, " ".join(common[:at] + [f"e{i}"] + common[at + 1:] + own)))
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    for weights in ("set", "count"):                     # bands of one place: every bucket holds most texts
        got = {r.doc_id: r.class_id for r in near_dups.classes(df, weights=weights, bands=6, rows=1).collect()}
        assert all(got[i] == j for i, j in edited.items())
    assert got == brute_classes(data)


# -- 2 secrets ---------------------------------------------------------------------------------

def brute_base(t):
    out = []
    for k, (kind, p, g, n) in enumerate((
            ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
            ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16))):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(p, t) if len(m[g]) >= n]
    return ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(out))


def test_secrets_match_brute_force_and_rescan_nothing(spark, docs, rows, edges):
    ledger = work_dir(spark, "test-ledger")
    both = docs.select("doc_id", "text").union(edges.select("doc_id", "text"))
    got = secrets.digest(secrets.scan(both, ledger)).collect()
    want = Counter((i, hashlib.sha256(brute_base(t or "").encode()).hexdigest()) for i, t in rows + EDGES)
    assert Counter((r.doc_id, r.base_sha256) for r in got) == want
    n = spark.read.parquet(ledger).count()
    secrets.scan(both, ledger).collect()
    assert spark.read.parquet(ledger).count() == n == len({t or "" for _, t in rows + EDGES})


# -- 3 and 6 tokens ----------------------------------------------------------------------------

def test_pieces_equal_whole_texts(rows):
    enc = tokens.encoder(tokenizer_path())
    odd = ["", " ", "  ", " a", "a ", "a  b", "x\n y", "\n x", "é ü  z", "a\tb c\t d", "w " * 3000, "a <|endoftext|> b"]
    texts = [t for _, t in rows] + odd
    whole = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == whole and enc.encode(texts) == whole


def test_token_files_round_trip(spark, docs, rows, edges):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    both = docs.select("doc_id", "text").union(edges.select("doc_id", "text"))
    path = work_dir(spark, "test-orc")
    token_files.write(both, path, tokenizer_path())
    got = sorted(token_files.digest(token_files.read(spark, path)).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = Counter()
    for i, t in rows + EDGES:
        x = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[i, len(x), zlib.crc32(x.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_allocation_rules(rule):
    w, cross = token_counts.allocate(np.array([3, 4, 1, 6]), np.array([0, 5, 6]), 14, rule)
    # tokens at 0-3, 3-7 (2 bytes in section 0, 1 in 1, 1 in 2), 7-8, 8-14
    want = {"largest": [2, 0, 2], "first": [2, 0, 2], "split": [1.5, 0.25, 2.25]}[rule]
    assert w.tolist() == want and cross.tolist() == [1, 0, 0]


def test_section_counts_add_up(docs, edges):
    for df in (docs, edges):
        got = token_counts.section_counts(df, tokenizer_path()).toPandas().fillna({"doc_id": -1})
        per = got.groupby(["doc_id"]).agg(t=("tokens", "sum"))
        enc = tokens.encoder(tokenizer_path())
        want = Counter()
        for r in df.collect():
            want[-1 if r.doc_id is None else r.doc_id] += len(enc.encode([r.text or ""])[0]) // 4
        assert dict(per.t) == dict(want)


# -- 4 decontamination -------------------------------------------------------------------------

def test_tiles_are_matches_and_find_reordered_passages():
    rng = np.random.default_rng(5)
    h = lambda x: shingles.mix(np.array(x, np.uint64) + np.uint64(1))
    for _ in range(300):
        a, b = rng.integers(0, 20, 30).tolist(), rng.integers(0, 20, 50).tolist()
        cut = int(rng.integers(8, 22))
        b = b[:20] + a[cut:] + b[20:35] + a[:cut] + b[35:]
        got = decontaminate.tile(h(a), h(b), 5)
        used_a, used_b = [], []
        for i, t, n in got:
            assert n >= 5 and a[i:i + n] == b[t:t + n]
            used_a += range(i, i + n)
            used_b += range(t, t + n)
        assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
        assert len(used_a) >= 26            # greedy may lose a few words at the seam


def test_contaminated_match_brute_force(spark, docs, rows):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    want = set()
    for b in bench.collect():
        item = words(b.text)
        grams = {tuple(item[k:k + 5]) for k in range(len(item) - 4)}
        for i, t in rows:
            w = words(t)
            if any(tuple(w[k:k + 5]) in grams for k in range(len(w) - 4)):
                code = {x: n for n, x in enumerate(sorted(set(w) | set(item)))}
                h = lambda x: shingles.mix(np.array([code[y] for y in x], np.uint64) + np.uint64(1))
                if sum(n for _, _, n in decontaminate.tile(h(item), h(w), 5)) >= 0.5 * len(item):
                    want.add((i, b.item_id))
    assert got == want and got
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in want}


# -- 5 class model -----------------------------------------------------------------------------

def test_class_model(docs, rows):
    got = {r.doc_id: r for r in class_lm.score(docs, clustered=300, classes=12, sweeps=8, held=500).collect()}
    c = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(class_lm.tokens(t) + [b""])
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        toks, r = class_lm.tokens(t) + [b""], got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == \
            (zlib.crc32(str(i).encode()) % 5 == 1, len(toks), sum(c[x] > 0 for x in toks), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in toks), rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_exchange_raises_likelihood(docs):
    words_ = [r["word"].encode() for r in class_lm.frequent(class_lm.word_counts(docs).where("word != ''"), 200)]
    bigrams = class_lm.bigram_counts(docs, words_).persist()
    start = np.concatenate([np.arange(len(words_)) % 8, 8 + np.arange(class_lm.FORMS + 1)])
    _, table = class_lm.exchange(bigrams, len(words_), 8, 8)
    assert class_lm.likelihood(table) > class_lm.likelihood(class_lm.class_table(bigrams, start))


# -- 7 and 9 classifiers -----------------------------------------------------------------------

def test_mixing_reaches_targets(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    p = mixing.mix(d, labels).toPandas()
    assert (p.rate >= 0).all() and len(p) == d.count()
    share = {c: (p[f"p_{c}"] * p.n_tokens * p.rate).sum() / p.n_tokens.sum() for c in mixing.DOMAINS}
    assert all(share[c] <= mixing.TARGETS[c] + 0.01 for c in mixing.CEILINGS)
    assert abs(sum(share.values()) - 1) < 0.02


def test_mixing_matches_targets_above_the_present_share(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    targets = {"clean": 0.7, "toxic": 0.1, "low": 0.2}
    for ceilings in ((), ("low",)):
        p = mixing.mix(d, labels, targets, ceilings=ceilings).toPandas()
        share = {c: (p[f"p_{c}"] * p.n_tokens * p.rate).sum() / p.n_tokens.sum() for c in mixing.DOMAINS}
        assert (abs(share["low"] - 0.2) < 2e-4) == (not ceilings), share
        assert ceilings or all(abs(share[c] - w) < 2e-4 for c, w in targets.items()), share


def test_toxicity_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(d, labels.where("doc_id % 4 != 0"))
    got = toxicity.score(d, model).select("doc_id", "toxic", "severity").withColumnRenamed("toxic", "said")
    p = got.join(labels.where("doc_id % 4 = 0"), "doc_id").toPandas()
    assert p[p.toxic == 1].said.mean() > 0.7 and p[p.toxic == 0].said.mean() < 0.01
    assert p.severity.between(0, 2).all()


# -- 8 quality ---------------------------------------------------------------------------------

def test_quality_counts_match_brute_force(spark, docs, rows, edges):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = docs.select("doc_id", "text", "lang").union(edges.select("doc_id", "text", "lang"))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality.judge(both, labels).collect())
    want = Counter()
    for i, t in rows + EDGES:
        t = t or ""
        w, seen, cover, lines, dup = re.findall(r"[^\x20\x09-\x0D]+", t), defaultdict(list), set(), set(), 0
        for k in range(len(w) - 7):
            seen[tuple(w[k:k + 8])].append(k)
        for at in seen.values():
            if len(at) > 1:
                cover.update(x for k in at for x in range(k, k + 8))
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in lines
                lines.add(line)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover),
             len(w) < 20 or 100 * len(cover) > 30 * len(w)] += 1
    assert got == want


def test_binomial_bound_is_exact(spark):
    cases = [(n, k, p) for n in (10, 300, 5000, 40_000) for k in (0, 1, 7, 40) for p in (0.005, 0.02)
             if k < n * p]
    for n, k, p in cases:
        got = spark.range(1).select(quality.binomial_cdf(quality.F.lit(n), quality.F.lit(k), p)).first()[0]
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                            + (n - i) * math.log1p(-p)) for i in range(k + 1))
        assert want * (1 - 1e-6) <= got <= want * 1.05 + 1e-300


# -- 10 licences -------------------------------------------------------------------------------

def test_licenses_match_brute_force(spark, docs, rows, edges):
    both = docs.select("doc_id", "text").union(edges.select("doc_id", "text"))
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                  for r in licenses.scan(both).collect())
    want = Counter()
    for i, t in rows + EDGES:
        w = words(t or "")
        at = [(k, label) for label, phrase in licenses.PHRASES for k in range(len(w))
              if w[k:k + len(phrase.split())] == phrase.split()]
        want[i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None,
             ",".join(sorted({x for _, x in at}))] += 1
    assert got == want


def test_license_notice_with_changes(spark):
    notice = licenses.NOTICES[8 - 3][1].split()
    text = "intro words " + " ".join(notice[:10] + ["extra"] + notice[10:]) + " tail"
    r = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert r.labels == licenses.NOTICES[5][0] and 0.5 < r.score <= 1


def test_license_notices_with_one_or_two_edits(spark):
    data, want, none = [], {}, []
    for label, notice in licenses.NOTICES:
        w = notice.split()
        changed = []
        for i in range(len(w)):
            if not licenses.tells(w[i]):
                changed += [w[:i] + ["qqq"] + w[i + 1:], w[:i] + w[i + 1:]]
            elif w[i] != "lesser":                     # without it, a GPL notice with an inserted word
                text = " ".join(["intro", "words", *w[:i], "zzz9", *w[i + 1:], "tail", "words"])
                if not any(phrase in text for _, phrase in licenses.PHRASES):
                    none.append(len(data))
                    data.append((len(data), text))
            for j in range(i + 1, len(w)):
                changed.append(w[:i] + ["qqq"] + w[i:j] + ["rrr"] + w[j:])
        for c in changed if len(w) >= 8 else []:
            want[len(data)] = label
            data.append((len(data), " ".join(["intro", "words", *c, "tail", "words"])))
    other = ["licensed under the gnu general public license version 1", "licensed under the gnu affero general public license version 3",
             "creative commons attribution noderivatives 4 0 international license"]
    none += range(len(data), len(data) + len(other))
    data += [(len(data) + i, t) for i, t in enumerate(other)]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(data, "doc_id bigint, text string")).collect()}
    assert {i: got[i] for i in want} == want
    assert {data[i][1]: got[i] for i in none if got[i]} == {}


# -- edge tables and the pipeline --------------------------------------------------------------

def test_operators_on_edge_and_empty_tables(spark, edges):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (3, "x y")], "item_id bigint, text string")
    for df in (edges, edges.limit(0)):
        n = df.count()
        assert near_dups.classes(df).count() == n
        assert class_lm.score(df).count() == n
        assert mixing.mix(df, labels).where("rate = 1").count() == n
        assert quality.judge(df, labels).count() == n
        assert toxicity.severity(df, labels).where("not toxic").count() == n
        assert licenses.scan(df).count() == n
        assert mixing.mixed(df, labels).columns == df.columns
        assert near_dups.representatives(df).columns == df.columns
        got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
        assert got == ({(4, 3)} if n else set())
    assert near_dups.classes(edges).where("doc_id = 4 and class_size = 2").count() == 2


def test_pipeline_stages(spark, docs, rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "mixing", "token files"]
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
    assert set(QUERIES) >= {"pipeline"} and len(QUERIES) == 14
