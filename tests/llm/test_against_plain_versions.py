"""Operators against plain versions written for the tests: places of phrases by SQL, sections by the encoder's offsets, rates
by a numpy descent, cutoffs by exact binomials, an ordinal fit by its likelihood, and the pipeline stage by stage."""

import math
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitpanel.llm import (base, decontaminate, features, licenses, mixing, near_dups, quality, secrets, token_counts, token_files,
                          tokens, toxicity)
from pitpanel.llm.queries import tokenizer_path
from pitpanel.session import work_dir

SF = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"
NO_LABELS = "doc_id bigint, quality int, toxic int"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


# -- secrets: added kinds ------------------------------------------------------------------------

def spans_of(text):
    rules = [(k, re.compile(p, f), g, n) for k, p, f, g, n in secrets.BASE_RULES + secrets.MORE_RULES]
    return {(s["kind"], text[s["start"]:s["end"]]) for s in secrets.find_spans(text, rules)}


def test_added_kinds():
    key = "-----BEGIN RSA PRIVATE KEY-----\nMIIB-x\n--abc\n-----END RSA PRIVATE KEY-----"
    token = "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl"
    long = "p" * 200
    for text, want in ((f"a {key} b", ("pem", key)), ("x -----BEGIN PRIVATE KEY----- y", ("pem", "-----BEGIN PRIVATE KEY-----")),
                       (f"see {token}.", ("jwt", token)), ("redis://:password1@host", ("url", "redis://:password1@")),
                       (f"https://u:{long}@h", ("url", f"https://u:{long}@")), ("ghp_" + "a1" * 20 + "!", ("github", "ghp_" + "a1" * 20))):
        assert want in spans_of(text), text
    assert not {k for k, _ in spans_of("x" + token)} & {"jwt"}                       # within another word
    assert spans_of("-----BEGIN A PRIVATE KEY-----\n-----BEGIN B PRIVATE KEY-----\nz\n-----END B PRIVATE KEY-----") == {
        ("pem", "-----BEGIN A PRIVATE KEY-----"), ("pem", "-----BEGIN B PRIVATE KEY-----\nz\n-----END B PRIVATE KEY-----")}


@pytest.mark.parametrize("piece", ["eyJ", "eyJabcdefgh.", "-----BEGIN PRIVATE KEY-----", "-", "a://b:", "http://", "://:", "ghp_", "token=", "AKIA", "-----"])
def test_rules_are_linear_in_long_texts(piece):
    rules = [(k, re.compile(p, f), g, n) for k, p, f, g, n in secrets.BASE_RULES + secrets.MORE_RULES]

    def seconds(n):
        text, t = piece * (n // len(piece)), time.process_time()
        secrets.find_spans(text, rules)
        return time.process_time() - t
    assert seconds(1_600_000) < 40 * max(seconds(100_000), 0.01)


# -- token ids ---------------------------------------------------------------------------------

def test_pieces_equal_whole_texts_of_any_spacing(monkeypatch):
    rng = random.Random(7)
    parts = ["a", "B", "é", "ß", "漢", "1", "23", ".", ",", "'s", "'ll", "'", "!", "\n", " ", " ", " ", "word", "Word", "\t", "\xa0", "\u2028",
             "\x1c", "\r\n", "<|endoftext|>", "%%%", "½", "٣", "_", "\x85", "ª", "×", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(4000)]
    texts += [" ".join(rng.choice(["the", "cat.", "don't", "über", "x\ny", "A\n\nB", "9%", "l'été", "w" * 150]) for _ in range(30)) for _ in range(200)]
    texts += ["", "\n", "\n\n\n", "a\n\n\nb c", "x " * 3 + "y" * 300_000, "one two\n" * 40_000]
    for room in (tokens.KEEP_TOKENS, 20):                                        # a full store changes no id
        monkeypatch.setattr(tokens, "KEEP_TOKENS", room)
        monkeypatch.setattr(tokens, "KEEP_PIECES", min(room, tokens.KEEP_PIECES))
        enc = tokens.Encoder(tokenizer_path())
        assert enc.cuts
        whole = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert enc.encode(texts) == whole and enc.encode(texts) == whole
        assert len(enc.pieces) + len(enc.inner) <= max(room, 20)


def test_orc_files_have_row_indexes_and_bloom_filters_that_prune(spark):
    path = work_dir(spark, "test-orc")
    token_files.write(docs_of(spark, [(3 * i, f"text number {i}") for i in range(12_000)]).repartition(2), path, tokenizer_path())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = [f.getPath() for f in folder.getFileSystem(conf).listStatus(folder) if f.getPath().getName().endswith(".orc")]
    kinds = Counter()
    for f in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(f, jvm.org.apache.orc.OrcFile.readerOptions(conf))
        assert reader.getRowIndexStride() == token_files.ROW_STRIDE
        rows = reader.rows()
        for stripe in reader.getStripes():
            for stream in rows.readStripeFooter(stripe).getStreamsList():
                kinds[stream.getKind().toString()] += stream.getColumn() == 1               # doc_id
        rows.close()
    assert kinds["ROW_INDEX"] and kinds["BLOOM_FILTER_UTF8"]

    def scanned(doc_id):
        df = token_files.read(spark, path).where(F.col("doc_id") == doc_id).select("doc_id", "n_tokens")
        assert df.count() == (1 if doc_id % 3 == 0 else 0)
        rows = df.collect()
        plan, todo = df._jdf.queryExecution().executedPlan(), []
        todo, n = [plan], 0
        while todo:
            p = todo.pop()
            if p.nodeName().startswith("Scan orc"):
                n += p.metrics().apply("numOutputRows").value()
            if p.nodeName() == "AdaptiveSparkPlan":
                todo.append(p.executedPlan())
            kids = p.children()
            todo += [kids.apply(i) for i in range(kids.size())]
        return len(rows), n
    found, n = scanned(3 * 7000)
    assert found == 1 and 0 < n <= 2 * token_files.ROW_STRIDE                          # the row index skips the other groups
    assert scanned(3 * 7000 + 1) == (0, 0)                                       # within a group's range: its Bloom filter skips it


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_match_the_encoders_offsets(spark, rule):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(-1, ""), (-2, "\n"), (-3, "a\n\nb\n"), (-4, "é\n漢字\nx"), (-5, "no break")]
    got = Counter((r.doc_id, r.section, r.start, r.end, round(r.tokens, 9), r.n_crossing, r.doc_tokens)
                  for r in token_counts.section_counts(docs_of(spark, rows), tokenizer_path(), rule).collect())
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t, add_special_tokens=False).ids
        at, place = [], 0
        lengths = tokens.encoder(tokenizer_path()).lengths()
        for x in ids:
            at.append((place, place + int(lengths[x])))
            place += int(lengths[x])
        raw = t.encode()
        assert place == len(raw)
        starts = [0] + [k + 1 for k, c in enumerate(raw[:-1]) if c == 10]
        bounds = list(zip(starts, starts[1:] + [len(raw)]))
        per, cross = [0.0] * len(bounds), [0] * len(bounds)
        for a, b in at:
            share = [max(0, min(b, e) - max(a, s)) for s, e in bounds]
            touched = [k for k, x in enumerate(share) if x]
            if len(touched) > 1:
                cross[touched[0]] += 1
            if rule == "split":
                for k in touched:
                    per[k] += share[k] / (b - a)
            else:
                per[touched[0] if rule == "first" else share.index(max(share))] += 1
        chars = [len(raw[:k].decode(errors="ignore")) for k in range(len(raw) + 1)]
        for k, (s, e) in enumerate(bounds):
            want[i, k, chars[s], chars[e], round(per[k], 9), cross[k], len(ids)] += 1
    assert got == want


# -- mixing: rates ---------------------------------------------------------------------------------

def objective(r, p, q, w):
    return (((r * q) @ p - w) ** 2 / (q @ p)).sum() / 2 + mixing.MU / 2 * (q * (r - 1) ** 2).sum()


def plain_rates(p, q, w, steps=30_000):
    """Plain projected gradient of the module's objective, on dense arrays, far past convergence."""
    m, r = q @ p, np.ones(len(q))
    for _ in range(steps):
        r = np.maximum(r - (p @ (((r * q) @ p - w) / m) + mixing.MU * (r - 1)) / (1 + mixing.MU), 0)
    return r


@pytest.mark.parametrize("targets", [{"clean": 0.5, "toxic": 0.2, "low": 0.3}, {"clean": 0.6, "toxic": 0.25, "low": 0.15}])
def test_rates_match_a_plain_descent(spark, targets):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([4, 1, 1], 400)
    n = rng.integers(0, 300, 400)
    u = rng.random(400)
    members = spark.createDataFrame([(i, int(n[i]), float(u[i]), p[i].tolist()) for i in range(400)],
                                    "doc_id bigint, n_tokens bigint, u double, p array<double>")
    out, reached = mixing.rates(members, list(mixing.DOMAINS), targets)
    w, q = np.array([targets[d] for d in mixing.DOMAINS]), n / n.sum()
    rows = sorted(out.collect(), key=lambda r: r.doc_id)
    got, want = np.array([r.rate for r in rows]), plain_rates(p, q, w)
    assert (got >= 0).all() and np.abs((got * q) @ p - w).max() <= 2 * mixing.TOLERANCE
    assert objective(got, p, q, w) < objective(want, p, q, w) + 1e-4 < objective(np.ones(400), p, q, w)
    assert (q * np.abs(got - want)).sum() < 0.1
    assert all(abs(reached[d] - ((got * q) @ p)[i]) < 1e-9 for i, d in enumerate(mixing.DOMAINS))
    assert [r.copies for r in rows] == np.floor(got + u).astype(int).tolist()


def test_targets_out_of_reach_end_and_are_reported(spark, caplog):
    members = spark.createDataFrame([(i, 10, 0.5, [0.9, 0.1, 0.0]) for i in range(20)],
                                    "doc_id bigint, n_tokens bigint, u double, p array<double>")
    _, reached = mixing.rates(members, list(mixing.DOMAINS), {"clean": 0.1, "toxic": 0.1, "low": 0.8})
    assert reached["low"] == 0.0 and reached["clean"] < 1
    mixing.report(list(mixing.DOMAINS), {"clean": 0.1, "toxic": 0.1, "low": 0.8}, reached)
    assert any("target 0.8" in r.getMessage() and r.levelname == "WARNING" for r in caplog.records)


def test_mixed_keeps_any_columns(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], NO_LABELS)
    two = docs_of(spark, [(1, "a b"), (2, None), (2, None)])
    assert mixing.mixed(two, labels).columns == ["doc_id", "text"]
    more = two.selectExpr("doc_id", "text", "1 AS u", "2 AS p", "3 AS rate", "4 AS k0", "5 AS copies", "6 AS n_tokens", "7 AS `a.b`")
    out = mixing.mixed(more, spark.createDataFrame([], NO_LABELS))
    assert out.columns == more.columns and sorted(out.collect(), key=repr) == sorted(more.withColumn(
        "text", F.coalesce("text", F.lit(""))).collect(), key=repr)


# -- quality: cutoffs ------------------------------------------------------------------------------

def test_cutoffs_and_kept_match_exact_binomials(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(3000):
        lang = ("en", "de", None)[(i % 20 == 0) + (i % 50 == 0)]
        words = [f"w{rng.randrange(10**6)}" for _ in range(30)]
        for k in range(25 if i % 17 == 0 else rng.choice([0, 0, 0, 0, 1, 2])):
            words[k] = "###"
        docs.append((i, " ".join(words).upper() if i % 700 == 3 else " ".join(words), lang))
        labels.append((i, int(i % 17 != 0), 0))
    table = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    alpha, delta = 0.02, 0.05
    good = {i for i, q, _ in labels if q}
    feats = {r.doc_id: r.asDict() for r in quality.features(table).collect()}
    limits, strata = {}, {f["stratum"] for i, f in feats.items() if i in good}
    for s in strata:
        held = [f for i, f in feats.items() if i in good and f["stratum"] == s]
        for rule, grid in quality.GRIDS.items():
            for cut in sorted(grid):
                k, n, p = sum(f[rule] > cut for f in held), len(held), alpha / len(quality.GRIDS)
                cdf = sum(math.comb(n, j) * p**j * (1 - p)**(n - j) for j in range(k + 1)) if k < n * p else 1.0
                if cdf <= delta / (len(strata) * len(quality.GRIDS)):
                    limits[s, rule] = cut
                    break
    assert any(s == "en" for s, _ in limits) and len(limits) < len(strata) * len(quality.GRIDS)
    got = {r.doc_id: (r.kept, r.rejected_by) for r in quality.judge(table, spark.createDataFrame(labels, NO_LABELS), alpha, delta).collect()}
    for i, f in feats.items():
        over = ",".join(r for r in quality.GRIDS if (f["stratum"], r) in limits and f[r] > limits[f["stratum"], r])
        base_failed = f["n_words"] < 20 or 100 * f["n_repeat_words"] > 30 * f["n_words"]
        assert got[i] == (not base_failed and over == "", over)
    lost = sum(1 for i in good if got[i][1] and feats[i]["stratum"] == "en") / sum(1 for i in good if feats[i]["stratum"] == "en")
    assert lost <= alpha and any(over for _, over in got.values())


# -- toxicity: the fit -------------------------------------------------------------------------------

def test_ordinal_fit_is_the_likelihoods_optimum():
    rng = np.random.default_rng(1)
    n, dim = 1500, 40
    owner = np.repeat(np.arange(n), 8)
    feature = rng.integers(0, dim, 8 * n)
    key = np.unique(owner * dim + feature)
    owner, feature = key // dim, key % dim
    true = np.zeros(dim)
    true[:10] = rng.normal(0, 2, 10)
    latent = features.dot(np.pad(true, (0, features.DIM - dim)), feature, owner, n) + rng.logistic(size=n)
    grade = (latent > 1.0).astype(int) + (latent > 3.0)
    weights, t = toxicity.fit(feature, owner, grade)
    used = np.flatnonzero(weights)

    def loss(w, t):
        z = features.dot(w, feature, owner, n)
        above = np.concatenate([np.ones((1, n)), 1 / (1 + np.exp(t[:, None] - z)), np.zeros((1, n))])
        return -np.log(np.maximum(above[grade, np.arange(n)] - above[grade + 1, np.arange(n)], 1e-12)).mean() \
            + toxicity.RIDGE / 2 * (w ** 2).sum()
    best, step = loss(weights, t), 0.05
    for d in range(len(t)):                                  # no step to either side of any coordinate is better by much
        for sign in (-1, 1):
            moved = t.copy()
            moved[d] += sign * step
            assert loss(weights, moved) > best - 2e-4
    for f in used:
        for sign in (-1, 1):
            moved = weights.copy()
            moved[f] += sign * step
            assert loss(moved, t) > best - 2e-4
    assert t[0] < t[1] and len(used) and np.corrcoef(weights[used], true[used])[0, 1] > 0.9


# -- licences ------------------------------------------------------------------------------------------

LICENSE_SQL = r"""WITH w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM docs),
found AS (SELECT doc_id, len(ws) AS n,
    list_filter(range(1, len(ws) + 1), lambda i: ws[i] = 'under' AND ws[i + 1] = 'the' AND ws[i + 2] = 'mit' AND ws[i + 3] = 'license') AS mit,
    list_filter(range(1, len(ws) + 1), lambda i: ws[i] = 'apache' AND ws[i + 1] = 'license' AND ws[i + 2] = 'version' AND ws[i + 3] = '2') AS apache,
    list_filter(range(1, len(ws) + 1), lambda i: ws[i] = 'cc' AND ws[i + 1] = 'by' AND ws[i + 2] = 'nc') AS cc FROM w)
SELECT doc_id, n, len(mit) + len(apache) + len(cc), list_min(mit || apache || cc) - 1, list_max(mit || apache || cc) - 1,
  array_to_string(list_filter([CASE WHEN len(apache) > 0 THEN 'apache-2' END, CASE WHEN len(cc) > 0 THEN 'cc-by-nc' END,
    CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL), ',') FROM found"""


@pytest.mark.parametrize("sf", [SF, SF1])
def test_phrases_match_sql(spark, sf):
    extra = [(-1, "under the MIT license"), (-2, "The MIT license; see the mit license file"), (-3, None), (-4, "cc by nc cc-by-nc CC BY\nNC"),
             (-5, "Apache License, Version 2.0 under the mit-license"), (-6, "under the mit"), (-7, "é under the mit license ß"),
             (-8, "x " * 50_000 + "under the mit license" + " y" * 50_000)]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + extra
    con = duckdb.connect()
    con.execute("CREATE TABLE docs(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO docs VALUES (?, ?)", rows)
    want = sorted(con.execute(LICENSE_SQL).fetchall())
    out = licenses.scan(docs_of(spark, rows)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    got = out.collect()
    assert sorted(tuple(r)[:6] for r in got) == want
    by = {r.doc_id: r for r in got}
    assert by[-1].labels == "mit" and by[-2].labels == "" and by[-2].n_base == 0 and by[-5].labels == "apache-2,mit"
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1 for r in got)


def test_whole_licence_texts_are_templates(spark):
    whole = max((t for _, t in licenses.NOTICES), key=len).split()
    assert len(whole) > 150
    edited = whole[:40] + ["inserted", "words"] + whole[40:90] + whole[92:]
    rows = [(1, "intro " + " ".join(whole)), (2, " ".join(edited)), (3, " ".join(whole[:20])), (4, " ".join(w + "x" for w in whole))]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs_of(spark, rows), notices=(("mit-text", " ".join(whole)),)).collect()}
    assert got[1] == ("mit-text", 1.0) and got[2][0] == "mit-text" and 0.8 < got[2][1] < 1 and got[3][0] == got[4][0] == ""


def plain_labels(text, notices):
    """Label sets of a text that holds a notice word for word."""
    w = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
    return {label for label, t in (*notices, *licenses.PHRASES) if f" {t} " in f" {w} "}


def test_labels_hold_every_verbatim_notice(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF1}/documents.parquet").collect()]
    rows += [(10**6 + i, f"see\n{t.title()}, and so on") for i, (_, t) in enumerate(licenses.NOTICES)]
    got = {r.doc_id: set(r.labels.split(",")) - {""} for r in licenses.scan(docs_of(spark, rows)).collect()}
    for i, t in rows:
        assert plain_labels(t, licenses.NOTICES) <= got[i], (i, got[i])
    assert sum(map(bool, got.values())) < len(rows) / 2


# -- clashing names, and the pipeline -----------------------------------------------------------------------

def test_names_that_the_stages_use_themselves(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["_bad_id", "_own_content", "_kept_content", "_kept_id", "_BAD_ID_", "kept", "copies", "class", "rid"]
    more = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for run in (lambda d: decontaminate.clean(d, bench), near_dups.representatives, lambda d: corpus_pipeline.quality_rules(spark, d, SF)):
        out = run(more)
        assert out.columns == more.columns
        assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in run(docs).collect())
    assert base.unused(more, "_bad_id", "x") == ["_bad_id__", "x"]
    null = docs_of(spark, [(None, "a"), (1, "b"), (1, "c"), (2, "d")])
    assert [r.text for r in base.without_ids(null, docs_of(spark, [(None, ""), (1, "")]).select("doc_id")).collect()] == ["d"]


def test_pipeline_against_plain_stages(spark):
    """Each stage's kept ids by a plain version over what the stage before kept."""
    from test_llm import brute_classes, words
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = [r.text or "" for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)

    def kept(name, d):
        out = base.staged(stage[name](spark, d, SF), "test-stage")
        return out, Counter(r.doc_id for r in out.select("doc_id").collect())

    def rows_of(d):
        return [(r.doc_id, r.text or "") for r in d.collect()]
    # quality: without a provable cutoff at this size the base rules alone, counted here word by word
    good, ids = kept("quality rules", docs)
    want = set()
    for i, t in rows_of(docs):
        w = re.findall(r"[^ \t-\r]+", t)
        at = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        cover = {x for k in range(len(w) - 7) if at[tuple(w[k:k + 8])] > 1 for x in range(k, k + 8)}
        if len(w) >= 20 and 100 * len(cover) <= 30 * len(w):
            want.add(i)
    limits = quality.thresholds(quality.features(docs), labels).drop("stratum", "n_good").collect()
    assert all(v is None for r in limits for v in r) and set(ids) == want
    # near duplicates: the least id of each class of the brute-force closure
    single, ids = kept("near duplicates", good)
    assert set(ids) == set(brute_classes(rows_of(good)).values()) and max(ids.values()) == 1
    # decontamination: no item has half of its words in shared runs of five in any document that stays; whole items are gone
    clean, ids = kept("decontamination", single)
    gone = {i for i, _ in rows_of(single)} - set(ids)
    for i, t in rows_of(single):
        w = words(t)
        grams = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        best, verbatim = 0.0, False
        for b in map(words, bench):
            hit = {x for k in range(len(b) - 4) if tuple(b[k:k + 5]) in grams for x in range(k, k + 5)}
            best = max(best, len(hit) / max(len(b), 1))
            verbatim |= " ".join(b) in " ".join(w)
        assert (i in gone) <= (best >= 0.5) and verbatim <= (i in gone)
    # mixing: every document as often as its rate and hash say
    mixed_, ids = kept("mixing", clean)
    rates = {r.doc_id: r for r in mixing.mix(clean, labels, ceilings=mixing.CEILINGS).collect()}
    assert ids == Counter({i: r.copies for i, r in rates.items() if r.copies})
    # token files: ids by the library over whole texts, in order
    from tokenizers import Tokenizer
    import zlib
    tok, at = Tokenizer.from_file(tokenizer_path()), 0
    out = sorted(stage["token files"](spark, mixed_, SF).collect(), key=lambda r: r.start)
    plain = sorted(rows_of(mixed_))
    assert [r.doc_id for r in out] == [i for i, _ in plain]
    for r, (i, t) in zip(out, plain):
        x = np.array(tok.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(x), zlib.crc32(x.tobytes()))
        at += len(x)
