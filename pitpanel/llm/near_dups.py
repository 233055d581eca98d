"""Near duplicates by DartMinHash signatures, banded joining and an exact check.

A text is a weighted set of five-word shingles (``shingles``): weight 1 each, or the number of
occurrences with ``weights="count"``. Darts are thrown at the plane of (weight, rank): the
region of weights [2**v - 1, 2**(v+1) - 1) is cut into cells of area 1 along the rank axis, and a
hash of (shingle, v, cell) says how many darts (Poisson, mean 1) fall into the cell and where.
A shingle of weight w owns the darts below w; each dart belongs to one of ``coordinates``
signature places, and a place keeps its earliest dart (least rank). Only cells up to a rank
that leaves few places empty are visited - about k ln k + 2k darts a text however long it is -
and texts with an empty place are thrown again to twice the rank. Two texts agree on a
place with the probability of their (weighted) Jaccard similarity.

Signatures are cut into bands; texts that agree on a band meet in a bucket. With 30 bands of 5
a pair at similarity 0.8 misses every bucket with probability 7e-6. A bucket of n texts is not
turned into n**2 pairs: all its members are compared exactly with one leader, the member that
meets most texts over all its buckets (of a text and its edited copies, the text); ``rounds``
more leaders follow, each the next such member that is not yet in the component of an earlier
leader, and each compared with the other such members. What the leaders leave open is joined exactly:
the members of every bucket of three or more that still holds several components, led or not, are
joined by the rare shingles of each text (``rest_pairs``), so every two texts that share a bucket and
reach the threshold end in one class. Linked texts (similarity
>= ``threshold``, counted exactly) form classes, the connected components.

Defined cases: exact copies (equal texts) are one node whatever their number; a NULL or empty text, or
one without a word, is in the class of texts equal to it; a repeated row gets the same class twice; a
NULL doc_id takes part but gives no name to a class unless the class has no other id (then NULL).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import shingles as S
from pitpanel.llm.base import staged, texts, unused

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
ROUNDS = 3
BINS = 1 << 20         # counters that order shingles by frequency; they bear on cost only, not on pairs
U = np.uint64


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) * 2.0 ** -53


_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(24)])


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, k: int, seed: int = 1) -> np.ndarray:
    """(n, k) earliest ranks; row i is the signature of the weighted set with owner i (inf where
    a set is empty). ``elements`` are 64-bit hashes, one row per (element, owner)."""
    sig = np.full((n, k), np.inf)
    total = np.bincount(owner, weights=weights, minlength=n)
    open_sets = np.flatnonzero(total > 0)
    with np.errstate(divide="ignore"):
        reach = k * (math.log(k) + 2) / total
    salt = S.stream(4, seed) | U(1)
    rows = np.arange(len(elements))
    while len(open_sets):
        e, w, o = elements[rows], weights[rows], owner[rows]
        for v in range(int(math.log2(w.max() + 1)) + 1):
            has = np.flatnonzero(w > 2 ** v - 1)
            cells = np.ceil(reach[o[has]] * 2.0 ** v).astype(np.int64)
            at = np.repeat(has, cells)
            cell = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
            with np.errstate(over="ignore"):
                h = S.mix(e[at] ^ (cell.astype(U) * salt[0] + U(v) * salt[1]))
            darts = np.searchsorted(_POISSON, _uniform(h), "right")
            dart_of = np.repeat(np.arange(len(at)), darts)
            nth = np.arange(len(dart_of)) - np.repeat(np.cumsum(darts) - darts, darts)
            with np.errstate(over="ignore"):
                d = S.mix(h[dart_of] + (nth.astype(U) + U(1)) * salt[2])
            rank = (cell[dart_of] + _uniform(d)) * 2.0 ** -v
            d2 = S.mix(d ^ salt[3])
            who = o[at[dart_of]]
            hit = (rank < reach[who]) & ((2 ** v - 1) + _uniform(d2) * 2 ** v < w[at[dart_of]])
            np.minimum.at(sig, (who[hit], (S.mix(d2[hit]) % U(k)).astype(np.int64)), rank[hit])
        open_sets = open_sets[np.isinf(sig[open_sets]).any(axis=1)]
        reach[open_sets] *= 2
        again = np.zeros(n, bool)
        again[open_sets] = True
        rows = np.flatnonzero(again[owner])
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) 64-bit bucket keys; the band's number is part of the key."""
    bits = np.ascontiguousarray(sig).view(U).reshape(len(sig), bands, rows)
    salt = S.stream(bands, 31)
    key = np.broadcast_to(salt, (len(sig), bands)).copy()
    for j in range(rows):
        key = S.mix(key ^ S.mix(bits[:, :, j] + U(j + 1)))
    return key.view(np.int64)


def sketch(docs: DataFrame, k: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, weights: str = "set") -> DataFrame:
    """(doc_id, content, keys): the MD5 of the text and its bucket keys (NULL without a word)."""
    def run(batches):
        for b in batches:
            data, offs = S.utf8(b.column("text"))
            for i, j in S.chunks(offs):
                h, t = S.words(data, offs[i:j + 1])
                g, t, times = S.shingle_sets(h, t, j - i, k)
                w = times.astype(float) if weights == "count" else np.ones(len(g))
                sig = signatures(g, w, t, j - i, bands * rows)
                keys = band_keys(sig, bands, rows)
                full = ~np.isinf(sig).any(axis=1)
                ends = np.append(0, np.cumsum(full * bands)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[full].ravel()), mask=pa.array(~full))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("content").slice(i, j - i), lists],
                    ["doc_id", "content", "keys"])

    return texts(docs).select("doc_id", F.unhex(F.md5("text")).alias("content"), "text") \
        .mapInArrow(run, "doc_id bigint, content binary, keys array<bigint>")


def similarity(a: tuple, b: tuple, weights: str) -> float:
    """Jaccard similarity of two (sorted hashes, occurrences); weighted with ``"count"``."""
    common, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if weights == "count":
        low = np.minimum(a[1][x], b[1][y]).sum()
        return float(low) / max(a[1].sum() + b[1].sum() - low, 1)
    return len(common) / max(len(a[0]) + len(b[0]) - len(common), 1)


def verified(pairs: DataFrame, nodes: DataFrame, k: int, threshold: float, weights: str) -> DataFrame:
    """(a, b) of the pairs whose similarity, counted on whole texts, reaches the threshold.
    ``nodes``: (node, text) of every text that may occur in a pair."""
    both = (pairs.join(nodes.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))

    def sets(col):
        data, offs = S.utf8(col)
        for i, j in S.chunks(offs):
            h, t = S.words(data, offs[i:j + 1])
            g, t, times = S.shingle_sets(h, t, j - i, k)
            cut = np.searchsorted(t, np.arange(j - i + 1))
            yield from ((g[x:y], times[x:y]) for x, y in zip(cut[:-1], cut[1:]))

    def run(batches):
        for batch in batches:
            keep = [similarity(x, y, weights) >= threshold
                    for x, y in zip(sets(batch.column("text_a")), sets(batch.column("text_b")))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]) \
                .filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, class): the least node that each linked node is connected with. Each round a node
    takes the least class of its neighbours, then its class's class; rounds are written tables,
    and only their number and a count of changes reach the driver."""
    edges = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-edges")
    label = staged(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("class")), name)
    for _ in range(max_rounds):
        near = (edges.join(label.select(F.col("node").alias("b"), F.col("class").alias("near")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near")))
        step = label.join(near, "node").select("node", F.least("class", "near").alias("c"), F.col("class").alias("old"))
        up = label.select(F.col("node").alias("c"), F.col("class").alias("upper"))
        new = staged(step.join(up, "c", "left").select(
            "node", F.least("c", F.coalesce("upper", F.col("c"))).alias("class"), "old"), name)
        changed = new.where("class != old").limit(1).count()
        label = new.select("node", "class")
        if not changed:
            return label
    raise RuntimeError("components did not settle; raise max_rounds")


def _elements(batches, k: int, weights: str):
    """(nodes, element hashes, text index, elements per text) by chunk of (node, class, text) batches; with
    ``"count"`` every further occurrence of a shingle is an element of its own."""
    for b in batches:
        data, offs = S.utf8(b.column("text"))
        for i, j in S.chunks(offs):
            h, t = S.words(data, offs[i:j + 1])
            g, t, times = S.shingle_sets(h, t, j - i, k)
            if weights == "count":
                nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                with np.errstate(over="ignore"):
                    g = np.repeat(g, times) + nth.astype(U) * (S.stream(1, 47)[0] | U(1))
                t = np.repeat(t, times)
            yield b.slice(i, j - i), g, t, np.bincount(t, minlength=j - i)


def rest_pairs(rest: DataFrame, k: int, threshold: float, weights: str) -> DataFrame:
    """(a, b): candidates among ``rest`` (node, class, text), a superset of its pairs of different classes
    that reach the threshold. Elements are ordered rare first. The first common element of a pair that needs
    an overlap of o stands before place n - o + 1 in both texts, so only a prefix of each text is joined,
    and a match counts only if the elements from there on suffice. A common element's most frequent class
    is not joined with itself."""
    def count(batches):
        total = np.zeros(BINS, np.int64)
        for _, g, _, _ in _elements(batches, k, weights):
            total += np.bincount((g & U(BINS - 1)).astype(np.int64), minlength=BINS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bin", "n"])

    counted = rest.select("text").mapInArrow(count, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(BINS, np.int64)
    often[counted.column("bin").to_numpy()] = counted.column("n").to_numpy()

    def prefix(batches):
        for b, g, t, n in _elements(batches, k, weights):
            order = np.lexsort((g, often[(g & U(BINS - 1)).astype(np.int64)], t))
            g, t = g[order], t[order]
            pos = np.arange(len(t)) - (np.cumsum(n) - n)[t]
            kept = pos <= n[t] - np.ceil(threshold * n[t] - 1e-9)
            g, t, pos = g[kept], t[kept], pos[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(g.view(np.int64)), b.column("node").take(pa.array(t)), b.column("class").take(pa.array(t)),
                 pa.array(n[t].astype(np.int64)), pa.array((n[t] - pos).astype(np.int64))],
                ["element", "node", "class", "n", "left"])

    listed = staged(rest.select("node", "class", "text").mapInArrow(
        prefix, "element bigint, node bigint, class bigint, n bigint, left bigint"), "dart-prefix")
    per = listed.groupBy("element", "class").agg(F.count(F.lit(1)).alias("c"))
    main = per.groupBy("element").agg(F.max(F.struct("c", "class")).alias("m"), F.count(F.lit(1)).alias("classes")) \
        .where("classes > 1").select("element", F.col("m.class").alias("main"))
    found = staged(listed.join(main, "element"), "dart-prefix")
    x = found.where("class != main").select("element", F.col("node").alias("a"), F.col("class").alias("class_a"),
                                            F.col("n").alias("n_a"), F.col("left").alias("left_a"))
    y = found.select("element", F.col("node").alias("b"), F.col("class").alias("class_b"), F.col("n").alias("n_b"),
                     F.col("left").alias("left_b"), "main")
    need = F.ceil((F.col("n_a") + F.col("n_b")) * (threshold / (1 + threshold)) - 1e-6)
    return (x.join(y, "element")
            .where((F.col("class_a") != F.col("class_b")) & ((F.col("a") < F.col("b")) | (F.col("class_b") == F.col("main")))
                   & (F.least("left_a", "left_b") >= need))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def text_classes(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS,
                 rows: int = ROWS, rounds: int = ROUNDS, weights: str = "set") -> tuple:
    """(sketches by row, (content, first_id, class) by distinct text)."""
    sketched = staged(sketch(docs, k, bands, rows, weights), "dart-sketch")
    # one node per distinct text, numbered by position (not by doc_id, which may be NULL or repeated)
    nodes = staged(sketched.groupBy("content").agg(F.min("doc_id").alias("first_id"), F.first("keys").alias("keys"))
                   .withColumn("node", F.monotonically_increasing_id()), "dart-nodes")
    spread = nodes.select("node", F.explode("keys").alias("key"))
    shared = staged(spread.join(spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key"), "dart-shared")
    buckets = staged(shared.join(shared.groupBy("node").agg(F.sum("n").alias("company")), "node")
                     .select("key", "node", F.struct("company", (-F.col("node")).alias("minus")).alias("rank")), "dart-buckets")
    first_lead = staged(buckets.groupBy("key").agg((-F.max("rank")["minus"]).alias("lead")), "dart-lead")
    pairs = staged(buckets.join(first_lead, "key").where("node != lead")
                   .select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "dart-pairs")
    # the texts of nodes that share a bucket, one copy of each
    wanted = buckets.select("node").distinct().join(nodes.select("node", "content"), "node")
    held = staged(texts(docs).select(F.unhex(F.md5("text")).alias("content"), "text")
                  .join(wanted, "content").groupBy("node").agg(F.first("text").alias("text")), "dart-texts")
    links = staged(verified(pairs, held, k, threshold, weights), "dart-links")
    label = components(links, "dart-classes")
    led = first_lead.withColumnRenamed("lead", "led")
    for _ in range(rounds):
        # members whose component holds no earlier leader of their bucket
        state = (buckets.join(label, "node", "left")
                 .select("key", "node", "rank", F.coalesce("class", F.col("node")).alias("class")))
        done = led.join(label.withColumnRenamed("node", "led"), "led", "left") \
            .select("key", F.coalesce("class", F.col("led")).alias("class")).distinct()
        left = state.join(done, ["key", "class"], "left_anti")
        lead = staged(left.groupBy("key").agg(F.max(F.struct("rank", "node", "class")).alias("l"))
                      .select("key", F.col("l.node").alias("led"), F.col("l.class").alias("led_class")), "dart-lead")
        more = (left.join(lead, "key").where("class != led_class")
                .select(F.least("node", "led").alias("a"), F.greatest("node", "led").alias("b")).distinct()
                .join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
        more = staged(more, "dart-pairs")
        if more.isEmpty():
            break
        pairs = pairs.union(more)
        new = staged(verified(more, held, k, threshold, weights), "dart-links")
        if not new.isEmpty():
            links = links.union(new)
            label = components(links, "dart-classes")
        led = led.union(lead.select("key", "led"))
    # what the leaders left open: buckets of three or more that hold several components
    state = buckets.select("key", "node").join(label, "node", "left").select(
        "key", "node", F.coalesce("class", F.col("node")).alias("class"))
    several = state.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y"), F.count(F.lit(1)).alias("n")) \
        .where("x != y and n > 2").select("key")
    rest = state.join(several, "key").groupBy("node").agg(F.min("class").alias("class")).join(held, "node")
    more = (rest_pairs(staged(rest.select("node", "class", "text"), "dart-rest"), k, threshold, weights)
            .join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    new = staged(verified(staged(more, "dart-pairs"), held, k, threshold, weights), "dart-links")
    if not new.isEmpty():
        label = components(links.union(new), "dart-classes")
    named = (nodes.select("node", "content", "first_id").join(label, "node", "left")
             .select("content", "first_id", F.coalesce("class", F.col("node")).alias("class")))
    return sketched, staged(named, "dart-named")


def classes(docs: DataFrame, **params) -> DataFrame:
    """One row per document: (doc_id, class_id, class_size): class_id is the least doc_id of the
    class, class_size the rows in it. Parameters: see ``text_classes``."""
    sketched, named = text_classes(docs, **params)
    copies = sketched.groupBy("content").agg(F.count(F.lit(1)).alias("n"))
    per = (named.join(copies, "content").groupBy("class")
           .agg(F.min("first_id").alias("class_id"), F.sum("n").alias("class_size")))
    return (sketched.select("doc_id", "content")
            .join(named.select("content", "class").join(per, "class").select("content", "class_id", "class_size"), "content")
            .select("doc_id", "class_id", "class_size"))


def representatives(docs: DataFrame, **params) -> DataFrame:
    """One document of each class - the one with the least doc_id - with its columns. Of rows that
    repeat its doc_id and text any one stays."""
    _, named = text_classes(docs, **params)
    own, kept, kept_id = unused(docs, "_own_content", "_kept_content", "_kept_id")
    first = named.groupBy("class").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "content")).alias("r"))
    keep = first.select(F.col("r.content").alias(kept), F.col("r.first_id").alias(kept_id))
    rows = docs.withColumn(own, F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))
    return (rows.join(keep, (F.col(own) == F.col(kept)) & F.col("doc_id").eqNullSafe(F.col(kept_id)), "left_semi")
            .dropDuplicates(["doc_id", own]).drop(own))
