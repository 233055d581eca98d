"""Benchmark decontamination by greedy string tiling.

Tokens are words (``shingles``: lower-cased A-Z, letters, digits and non-ASCII characters).

Seeds. A text must share a run of ``SEED`` tokens with an item to be compared with it. Whole
texts are read once; a rolling hash of every run is looked up in a bitmap of 2**24 bits set by the
benchmark's runs (its size is fixed, whatever the benchmark's), and only texts with a hit go
on, with their hits. Hits are then joined to the benchmark's runs exactly. A tiling that covers
``coverage`` of an item's tokens with tiles of ``SEED`` tokens or more holds at least
m = ceil(ceil(coverage * tokens) / SEED) different runs of the item, so the m - 1 runs that occur in
most items need not be joined (a run in every item would join every text with every item), and a
(text, item) pair whose runs cannot cover enough is dropped before the tiling.

Tiling (running Karp-Rabin, greedy): a search length s starts at the item's length; runs of s
unmarked tokens are compared by rolling hash and matches grown to both sides; while matches
longer than 2s turn up the search restarts there, else matches are marked, longest first, s halves
and the search repeats down to ``SEED``. Marked tokens never match again, so tiles do not overlap, and
their order does not matter: a reordered passage is covered as well as a copied one. A document
is contaminated when the tiles of one item cover ``coverage`` of that item's tokens.

Defined cases: NULL or empty texts and items match nothing; an item of fewer than ``SEED`` tokens matches
where its whole token sequence occurs; repeated rows are judged one by one; equal items with other
ids are reported each; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import shingles as S
from pitpanel.llm.base import staged, texts, without_ids

SEED = 5
COVERAGE = 0.5
BITMAP_BITS = 24
U = np.uint64
_ROLL = U(0x9E3779B97F4A7C15)
_UNROLL = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _runs(h: np.ndarray, seed: int) -> np.ndarray:
    """Hash of every run of ``seed`` tokens; of all tokens if there are fewer (but one at least)."""
    if 0 < len(h) < seed:
        return _runs(h, len(h))
    return S.grams(h, np.zeros(len(h), np.int64), seed)[0] if len(h) else np.zeros(0, U)


def tile(item: np.ndarray, text: np.ndarray, least: int) -> list:
    """(item start, text start, length) tiles of greedy string tiling over two token hash arrays."""
    least = min(least, len(item))
    if least == 0 or len(text) < least:
        return []
    # tokens outside every shared run of ``least`` tokens can be in no tile
    shared = np.isin(_runs(text, least), _runs(item, least))
    live = np.zeros(len(text), bool)
    for j in range(least):
        live[j:len(text) - least + 1 + j] |= shared
    text_free, item_free, tiles, s = live, np.ones(len(item), bool), [], len(item)
    item_tokens, text_tokens = item.tolist(), text.tolist()
    while s >= least:
        longest, found = s, {}
        index: dict = {}
        for i, x in _free_runs(item, item_free, s):
            index.setdefault(x, []).append(i)
        if index:
            reached: dict = {}                                # per diagonal: text place that is matched already
            for t, x in _free_runs(text, text_free, s):
                for i in index.get(x, ()):
                    if reached.get(t - i, -1) >= t + s:
                        continue
                    n = _grow(item_tokens, text_tokens, item_free, text_free, i, t)
                    if n >= s:
                        found.setdefault(n, []).append((i, t))
                        reached[t - i] = t + n
                        longest = max(longest, n)
        if longest > 2 * s:
            s = longest
            continue
        for n in sorted(found, reverse=True):
            for i, t in found[n]:
                if item_free[i:i + n].all() and text_free[t:t + n].all():
                    item_free[i:i + n] = False
                    text_free[t:t + n] = False
                    tiles.append((i, t, n))
        if not item_free.any():
            break
        if not found:                    # else search again: occluded matches may leave free parts of s or more
            if s == least:
                break
            s = max(s // 2, least)
    return tiles


def _free_runs(tokens: np.ndarray, free: np.ndarray, s: int):
    """(place, rolling hash) of every run of ``s`` free tokens."""
    if len(tokens) < s:
        return []
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([np.ones(1, U), np.full(len(tokens) - 1, _ROLL)]))
        back = np.cumprod(np.concatenate([np.ones(1, U), np.full(len(tokens) - s, _UNROLL)]))
        prefix = np.concatenate([np.zeros(1, U), np.cumsum(tokens * power)])
        rolled = (prefix[s:] - prefix[:-s]) * back          # a window's hash, moved back to place 0
    busy = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(busy[s:] == busy[:-s])
    return zip(at.tolist(), rolled[at].tolist())


def _grow(item, text, item_free, text_free, i, t) -> int:
    n = 0
    while i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n] and item_free[i + n] and text_free[t + n]:
        n += 1
    return n


def item_runs(benchmark: DataFrame, seed: int, coverage: float) -> DataFrame:
    """(item_id, row, n, place, run, needed) of the benchmark's rows; ``row`` tells rows apart."""
    def run(batches):
        for b in batches:
            data, offs = S.utf8(b.column("text"))
            for r in range(b.num_rows):
                h, _ = S.words(data, offs[r:r + 2])
                runs = _runs(h, seed)
                n, m = len(h), len(runs)
                cover = int(np.ceil(coverage * n - 1e-9))
                needed = max(-(-cover // max(min(seed, n), 1)), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("row")[r].as_py()] * m, pa.int64()), pa.array([n] * m, pa.int32()),
                     pa.array(np.arange(m, dtype=np.int32)), pa.array(runs.view(np.int64)),
                     pa.array([needed] * m, pa.int32())], ["row", "n", "place", "run", "needed"])

    return benchmark.mapInArrow(run, "row bigint, n int, place int, run bigint, needed int")


def bitmap(runs: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """The runs' bits, gathered as at most 2**(bits - 6) words of 64 bits."""
    low = F.col("run").bitwiseAND((1 << bits) - 1)
    words = runs.groupBy(F.shiftright(low, 6).alias("w")) \
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(63).cast("int"))).alias("m"))
    got = words.toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[got.column("w").to_numpy()] = got.column("m").to_numpy()
    return out.view(U)


def candidates(docs: DataFrame, held, lengths: list, seed: int) -> DataFrame:
    """(doc_id, text, runs) of the texts with a run whose bit is set; ``held``: broadcast bitmap;
    ``lengths``: run lengths to look for (``seed``, and those of items shorter than it)."""
    def run(batches):
        bits = held.value
        low = U((len(bits) << 6) - 1)
        for b in batches:
            data, offs = S.utf8(b.column("text"))
            for i, j in S.chunks(offs):
                h, t = S.words(data, offs[i:j + 1])
                runs, of = [], []
                for n in lengths:
                    g, o, _ = S.grams(h, t, n)
                    at = g & low
                    hit = (bits[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == 1
                    runs.append(g[hit])
                    of.append(o[hit])
                runs, of = np.concatenate(runs), np.concatenate(of)
                rows, where = np.unique(of, return_inverse=True)
                if not len(rows):
                    continue
                order = np.argsort(where, kind="stable")
                ends = np.append(0, np.cumsum(np.bincount(where))).astype(np.int32)
                take = pa.array(rows + i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(take), b.column("text").take(take),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(runs[order].view(np.int64)))],
                    ["doc_id", "text", "runs"])

    return texts(docs).mapInArrow(run, "doc_id bigint, text string, runs array<bigint>")


def tilings(pairs: DataFrame, seed: int, coverage: float) -> DataFrame:
    """Tile each (doc_id, rid, item_id, text, item_text) and keep those over the threshold."""
    def run(batches):
        for b in batches:
            rows = []
            text_data, text_offs = S.utf8(b.column("text"))
            item_data, item_offs = S.utf8(b.column("item_text"))
            for r in range(b.num_rows):
                text, _ = S.words(text_data, text_offs[r:r + 2])
                item, _ = S.words(item_data, item_offs[r:r + 2])
                tiles = tile(item, text, seed)
                covered = sum(n for _, _, n in tiles)
                if len(item) and covered >= coverage * len(item) - 1e-9:
                    rows.append({"r": r, "n_tokens": len(item), "covered": covered, "n_tiles": len(tiles),
                                 "longest": max(n for _, _, n in tiles), "coverage": covered / len(item)})
            take = pa.array([x["r"] for x in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(take), b.column("rid").take(take), b.column("item_id").take(take),
                 *[pa.array([x[c] for x in rows], pa.int64()) for c in ("n_tokens", "covered", "n_tiles", "longest")],
                 pa.array([x["coverage"] for x in rows], pa.float64())],
                ["doc_id", "rid", "item_id", "n_tokens", "covered", "n_tiles", "longest", "coverage"])

    return pairs.select("doc_id", "rid", "item_id", "text", "item_text").mapInArrow(
        run, "doc_id bigint, rid bigint, item_id bigint, n_tokens bigint, covered bigint, n_tiles bigint, "
             "longest bigint, coverage double")


def contaminated(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_tokens, covered, n_tiles, longest, coverage) of every document row and
    benchmark row whose tiling covers the threshold."""
    spark = docs.sparkSession
    items = staged(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"),
                                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                   .withColumn("row", F.monotonically_increasing_id()), "bench")
    runs = staged(item_runs(items.select("row", "text"), seed, coverage), "bench-runs")
    short = [r["n"] for r in runs.where(F.col("n") < seed).select("n").distinct().collect()]     # below SEED: few values
    held = spark.sparkContext.broadcast(bitmap(runs))
    found = staged(candidates(docs, held, sorted({seed, *short}), seed)
                   .withColumn("rid", F.monotonically_increasing_id()), "bench-texts")
    # per item: all runs but the needed - 1 that are in most items. ``needed`` counts places in the
    # item; a run that stands at several places of the item stands for as many.
    distinct = runs.groupBy("row", "n", "needed", "run").agg(F.collect_list("place").alias("places"))
    spread = distinct.groupBy("run").agg(F.count(F.lit(1)).alias("items"))
    ranked = distinct.join(spread, "run").groupBy("row", "needed").agg(
        F.max(F.size("places")).alias("most"), F.sort_array(F.collect_list(F.struct("items", "run"))).alias("runs"))
    rare = ranked.select("row", F.explode(F.slice("runs", F.lit(1), F.size("runs") + 1
                                                  - F.ceil(F.col("needed") / F.col("most")).cast("int"))).alias("r")) \
        .select("row", F.col("r.run").alias("run"))
    seen = staged(found.select("rid", F.explode(F.array_distinct("runs")).alias("run"))
                  .join(runs.select("run").distinct(), "run", "left_semi"), "bench-seeds")
    pairs = seen.join(rare, "run").select("rid", "row").distinct()
    # what the shared runs of such a pair could cover at most
    could = (pairs.join(seen, "rid").join(distinct, ["row", "run"])
             .select("rid", "row", "n", F.explode("places").alias("place"))
             .groupBy("rid", "row", "n").agg(F.count_distinct("place").alias("places"))
             .where(F.least(F.col("places") * seed, F.col("n")) >= F.col("n") * coverage - 1e-9))
    both = (could.select("rid", "row").join(found.select("rid", "doc_id", "text"), "rid")
            .join(items.select("row", "item_id", F.col("text").alias("item_text")), "row"))
    return tilings(both, seed, coverage).drop("rid")


def clean(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """The documents without those that are contaminated (by doc_id), with their columns."""
    return without_ids(docs, contaminated(docs, benchmark, seed, coverage).select("doc_id"))
