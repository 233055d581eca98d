"""Exact n-gram Jaccard self-join by parity sketches.

A text's set holds its distinct k-word shingles (words: runs of anything but ASCII white space, A-Z
folded; a text of 1 to k - 1 words has its whole word sequence as its only shingle). Two sets link when
their Jaccard similarity reaches ``percent`` / 100, that is when their symmetric difference is at most
(100 - percent) / (100 + percent) of their sizes' sum.

* **Sketch.** Every shingle is XOR-ed by its hash into one of the pieces of the sketch. A shingle of the
  symmetric difference changes one piece at most, so the number of pieces in which two sketches differ
  (their Hamming distance) never exceeds the symmetric difference. A second sketch of single bits
  (each shingle flips one) bounds it in the same way and is cheap to compare.
* **Size bands.** Band j holds the sets of 2**j to 2**(j+1) - 1 shingles and cuts them into 2**j pieces (into finer
  ones for low thresholds, see ``finer``). A set that may link with a set of the next band is sketched for that band too.
* **Pigeonhole.** A set of n shingles differs from any partner in at most d pieces (``most_different``), so
  of any d + 1 non-empty pieces one agrees. Pieces are put in one order for all sets, frequent ones last, and a set
  shows its first d + 1; partners share one of those (both agree on all pieces but d). The
  frequent pieces (a passage in many texts) are the ``hot`` most counted ones that tasks saw several times; the
  order bears on cost, never on the result. A set with no more than d non-empty pieces shows
  all and is cut again by other hash bits, until it has enough: of two partners, the first cut that is
  enough for one of them is shown by both.
* **Verify.** Sets that show a common piece are compared: sizes, then bit sketches, then whole sets.
  Linked sets form components. A piece shown by more than two rows is not turned into pairs: all
  its sets are compared with one leader, the one that meets most others. What
  stays in different components afterwards is compared by bit sketches in blocks of ``BLOCK`` sets
  below each leader (``open_pairs``), the largest component of a leader not with itself. So no link
  between different components is lost, whatever the size of a group, and no task holds more than two blocks.

Defined cases: equal sets are one node whatever their number; a NULL or empty text, or one
without a word, has n_shingles 0 and is its own component; a repeated row is returned again with the same
values; a NULL doc_id takes part and names a component only if it has no other id (then NULL); an empty table gives
an empty result; other columns are ignored. Two sets with one 64-bit hash would be one node: their second hashes
are compared, and a difference stops the job with an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import shingles as S
from pitpanel.llm.base import discard, staged, texts
from pitpanel.llm.near_dups import components

SHINGLE = 5
PERCENT = 80
HOT = 1 << 16          # pieces put last in the order; they bear on cost only
WINDOW = 1 << 22       # pieces a task counts at a time
OFTEN = 3              # times that a window holds a piece reported as frequent
BLOCK = 2048           # sets of a block of ``open_pairs``
SMALL = 64             # members of a leader up to which its open pairs are rows of a join
SEGMENT = 1 << 21      # bytes whose words are hashed at a time
U = np.uint64

_BYTE = np.arange(256)
_FOLD = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE)
_SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
_VALUE = np.where(_SPACE, U(0), S.stream(256, 211)[_FOLD] | U(1))


def most_different(n, percent: int = PERCENT):
    """The largest symmetric difference of a set of ``n`` shingles and a partner of any size."""
    n = np.asarray(n, dtype=np.int64)
    return (100 - percent) * (n + 100 * n // percent) // (100 + percent)


def finer(percent: int) -> int:
    """How often a band's pieces are halved, so that even its largest sets have clearly more non-empty pieces than
    ``most_different``: of n shingles in m pieces about m * (1 - exp(-n / m)) are not empty."""
    differ, e = (100 - percent) / (100 + percent) * (1 + 100 / percent), 0
    while (1 - math.exp(-2.0 ** (1 - e))) * 2.0 ** (e - 1) < min(1.25 * differ, (1 + differ) / 2):
        e += 1
    return e


# -- sets and sketches of many texts, inside tasks ----------------------------------------------

def _segment_words(buf: np.ndarray, begin: np.ndarray) -> tuple:
    is_word = ~_SPACE[buf]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    at = begin[(begin >= 0) & (begin < len(buf))]
    first[at] = is_word[at]
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return np.zeros(0, U), starts
    pos = S._positions(starts, len(buf))
    pos[~is_word] = 0
    with np.errstate(over="ignore"):
        return S.mix(np.add.reduceat(_VALUE[buf] * S._powers(int(pos.max()) + 1)[pos], starts)), starts


def words(data: np.ndarray, offs: np.ndarray, segment: int = SEGMENT) -> tuple:
    """(hash per word, text index per word); long texts are hashed in segments cut at white space."""
    buf, begin = data[offs[0]:offs[-1]], offs[:-1] - offs[0]
    hashes, places, at = [], [], 0
    while at < len(buf):
        end = min(at + segment, len(buf))
        while end < len(buf) and not _SPACE[buf[end]]:
            space = np.flatnonzero(_SPACE[buf[end:end + segment]])
            end = min(end + int(space[0]), len(buf)) if len(space) else min(end + segment, len(buf))
        h, starts = _segment_words(buf[at:end], begin - at)
        hashes.append(h)
        places.append(starts + at)
        at = end
    if not hashes:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(begin, np.concatenate(places), "right") - 1


def text_sets(column, k: int):
    """(first text, n texts, shingle hashes, text index, set sizes), chunk by chunk; the hashes of a text ascend."""
    data, offs = S.utf8(column)
    for i, j in S.chunks(offs):
        h, t = words(data, offs[i:j + 1])
        g, t, _ = S.shingle_sets(h, t, j - i, k)
        yield i, j - i, g, t, np.bincount(t, minlength=j - i)


def _runs(n: np.ndarray) -> np.ndarray:
    return (np.cumsum(n) - n)[n > 0]


def set_hashes(g: np.ndarray, n: np.ndarray) -> tuple:
    """Two 64-bit hashes of each set (0 for an empty one)."""
    salt, out = S.stream(2, 223), []
    for s in salt:
        h = np.zeros(len(n), U)
        if len(g):
            with np.errstate(over="ignore"):
                h[n > 0] = S.mix(np.add.reduceat(S.mix(g ^ s), _runs(n)) + n[n > 0].astype(U))
        out.append(h.view(np.int64))
    return tuple(out)


def pieces(g: np.ndarray, t: np.ndarray, level: np.ndarray, cut: int) -> tuple:
    """(piece key, text index) of every non-empty piece; a text of level j is cut into 2**j pieces by the
    leading bits of its shingles' hashes (of further hashes for the cuts after the first)."""
    if len(g) == 0:
        return g, t
    with np.errstate(over="ignore"):
        if cut:
            g = S.mix(g + S.stream(1, 227)[0] * U(cut))
            order = np.lexsort((g, t))
            g, t = g[order], t[order]
        j = level[t].astype(U)
        piece = np.where(j == 0, U(0), g >> np.where(j == 0, U(0), U(64) - j))
        new = np.ones(len(g), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (t[1:] != t[:-1])
        at = np.flatnonzero(new)
        x = np.bitwise_xor.reduceat(S.mix(g ^ S.stream(1, 229)[0]), at)
        return S.mix(x + S.stream(64, 233)[level[t[at]]] + U(cut)), t[at]


def grids(n: np.ndarray, percent: int):
    """(texts, level) pairs of arrays: the band of each set, then the next band for sets that reach it."""
    has = np.flatnonzero(n > 0)
    level = np.zeros(len(n), np.int64)
    level[has] = np.frexp(n[has].astype(float))[1] - 1
    yield n > 0, level
    up = (n > 0) & (100 * n // percent >= 2 ** (level + 1))
    if up.any():
        yield up, level + 1


def shown(g: np.ndarray, t: np.ndarray, n: np.ndarray, percent: int, hot: tuple | None) -> tuple:
    """(piece key, text index): the pieces each set shows; with ``hot`` None all non-empty pieces.
    ``hot``: ascending piece keys and their counts."""
    d, more, keys, owners = most_different(n, percent), finer(percent), [], []
    for chosen, level in grids(n, percent):
        cut, level = 0, level + more
        while chosen.any():
            mine = chosen[t]
            key, owner = pieces(g[mine], t[mine], level, cut)
            full = np.bincount(owner, minlength=len(n))
            if hot is not None:
                at = np.minimum(np.searchsorted(hot[0], key), max(len(hot[0]) - 1, 0))
                often = np.where(hot[0][at] == key, hot[1][at], 0) if len(hot[0]) else np.zeros(len(key), np.int64)
                order = np.lexsort((key, often, owner))
                key, owner = key[order], owner[order]
                keep = np.arange(len(key)) - (np.cumsum(full) - full)[owner] <= d[owner]
                key, owner = key[keep], owner[keep]
            keys.append(key)
            owners.append(owner)
            chosen, cut = chosen & (full <= d), cut + 1
    if not keys:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def bit_sketches(g: np.ndarray, t: np.ndarray, n: np.ndarray) -> list:
    """Parity bits of each set as bytes: 2 to 4 bits a shingle, a power of two, 64 at least."""
    bits = np.maximum(2 ** (np.frexp(np.maximum(n, 1).astype(float))[1].astype(np.int64) + 1), 64)
    first = np.cumsum(bits) - bits
    place = first[t] + (S.mix(g ^ S.stream(1, 239)[0]) & (bits[t] - 1).astype(U)).astype(np.int64)
    packed = np.packbits((np.bincount(place, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little")
    return [packed[f // 8:(f + b) // 8].tobytes() for f, b in zip(first.tolist(), bits.tolist())]


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches (one a row, 64-bit words) folded to ``width`` words: parity sketches of the same sets."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def within(distance, n_a, n_b, percent: int):
    """Whether so small a distance may belong to a linked pair of these sizes."""
    return (100 + percent) * distance <= (100 - percent) * (n_a + n_b)


# -- the join ------------------------------------------------------------------------------------

def profile(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per document (doc_id, n, node, again, content) - set size, the set's two hashes, MD5 of the text -
    and, with n NULL, the pieces a task saw often (node: piece, again: count)."""
    def run(batches):
        seen, held, size = set(), [], 0

        def often():
            key, times = np.unique(np.concatenate(held), return_counts=True)
            at = times >= OFTEN
            none = pa.nulls(int(at.sum()), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, pa.array(key[at].view(np.int64)), pa.array(times[at]), pa.nulls(int(at.sum()), pa.binary())],
                ["doc_id", "n", "node", "again", "content"])

        for b in batches:
            for i, count, g, t, n in text_sets(b.column("text"), k):
                node, again = set_hashes(g, n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, count), pa.array(n.astype(np.int64)), pa.array(node), pa.array(again),
                     b.column("content").slice(i, count)], ["doc_id", "n", "node", "again", "content"])
                new = np.array([x not in seen and not seen.add(x) for x in node.tolist()], bool) & (n > 0)
                mine = new[t]
                key, _ = shown(g[mine], t[mine], np.where(new, n, 0), percent, None)
                held.append(key)
                size += len(key)
                if size >= WINDOW:
                    yield often()
                    held, size = [], 0
        if held:
            yield often()

    return texts(docs).select("doc_id", "text", F.unhex(F.md5("text")).alias("content")).mapInArrow(
        run, "doc_id bigint, n bigint, node bigint, again bigint, content binary")


def frequent(profiled: DataFrame, hot: int) -> tuple:
    """The ``hot`` most counted pieces, ascending, and their counts (at most ``hot`` rows reach the driver)."""
    rows = (profiled.where("n IS NULL").groupBy("node").agg(F.sum("again").alias("times"))
            .orderBy(F.desc("times"), "node").limit(hot).toArrow())
    key = rows.column("node").to_numpy().view(U) if rows.num_rows else np.zeros(0, U)
    order = np.argsort(key)
    return key[order], (rows.column("times").to_numpy() if rows.num_rows else np.zeros(0, np.int64))[order]


def sketch(docs: DataFrame, k: int, percent: int, hot: tuple) -> DataFrame:
    """(node, n, keys, bits): shown pieces and bit sketch of each set, once for each task that meets it."""
    def run(batches):
        seen = set()
        for b in batches:
            for _, count, g, t, n in text_sets(b.column("text"), k):
                node, _ = set_hashes(g, n)
                new = np.array([x not in seen and not seen.add(x) for x in node.tolist()], bool) & (n > 0)
                mine = new[t]
                g, t, n = g[mine], t[mine], np.where(new, n, 0)
                key, owner = shown(g, t, n, percent, hot)
                order = np.argsort(owner, kind="stable")
                ends = np.append(0, np.cumsum(np.bincount(owner, minlength=count)))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(key[order].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(n.astype(np.int64)), lists, pa.array(bit_sketches(g, t, n), pa.binary())],
                    ["node", "n", "keys", "bits"]).filter(pa.array(new))

    return texts(docs).select("text").mapInArrow(run, "node bigint, n bigint, keys array<bigint>, bits binary")


def near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose sizes and bit sketches allow a link. ``nodes``: (node, n, bits)."""
    def side(x):
        return nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))

    def run(batches):
        for b in batches:
            n_a, n_b = b.column("n_a").to_numpy(), b.column("n_b").to_numpy()
            far = np.empty(len(n_a), np.int64)
            for i, (x, y) in enumerate(zip(b.column("bits_a"), b.column("bits_b"))):
                x, y = np.frombuffer(x.as_py(), U), np.frombuffer(y.as_py(), U)
                w = min(len(x), len(y))
                far[i] = np.bitwise_count(folded(x, w) ^ folded(y, w)).sum()
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]) \
                .filter(pa.array(within(far, n_a, n_b, percent)))

    a, b = F.col("n_a"), F.col("n_b")
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where((100 * a >= percent * b) & (100 * b >= percent * a))
            .mapInArrow(run, "a bigint, b bigint"))


def linked(pairs: DataFrame, docs: DataFrame, profiled: DataFrame, k: int, percent: int) -> DataFrame:
    """The (a, b) whose whole sets link."""
    def run(batches):
        for b in batches:
            for _, count, g, t, n in text_sets(b.column("text"), k):
                node, _ = set_hashes(g, n)
                ends = np.append(0, np.cumsum(n)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.ListArray.from_arrays(pa.array(ends), pa.array(g.view(np.int64)))], ["node", "grams"])

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    # one text per set; copies are combined before the shuffle
    contents = (profiled.where("n > 0").groupBy("node").agg(F.min("content").alias("content"))
                .join(wanted, "node", "left_semi").select("content"))
    sets = staged(texts(docs).select("text", F.unhex(F.md5("text")).alias("content"))
                  .join(contents, "content", "left_semi").dropDuplicates(["content"]).select("text")
                  .mapInArrow(run, "node bigint, grams array<bigint>"), "parity-sets")
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b")), "b")
            .where(100 * both >= percent * (F.size("grams_a") + F.size("grams_b") - both)).select("a", "b"))


def open_pairs(members: DataFrame, label: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of sets below one leader that are in different components and whose sizes and bit
    sketches allow a link. ``members``: (lead, node). The sets outside the leader's largest component are
    compared with all; below ``SMALL`` members as rows of a join, else in pairs of blocks."""
    state = members.join(label, "node", "left").select("lead", "node", F.coalesce("class", F.col("node")).alias("class"))
    per = state.groupBy("lead", "class").agg(F.count(F.lit(1)).alias("c"))
    open_ = (per.groupBy("lead").agg(F.max(F.struct("c", "class"))["class"].alias("main"), F.sum("c").alias("s"),
                                     F.count(F.lit(1)).alias("classes")).where("classes > 1").drop("classes"))
    state = staged(state.join(open_, "lead"), "parity-open")
    few = state.where(F.col("s") <= SMALL).select("lead", "node", "class", "main")
    x = few.where("class != main").select("lead", F.col("node").alias("x"), F.col("class").alias("class_x"))
    rows = (x.join(few, "lead").where("class != class_x AND (x < node OR class = main)")
            .select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct())

    large = state.where(F.col("s") > SMALL).join(nodes, "node")
    blocks = F.ceil(F.col("s") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    cols = ["node", "class", "main", "n", "bits"]
    left = staged(large.where("class != main").select("lead", block.alias("bx"), other.alias("by"), *cols), "parity-blocks")
    right = large.select("lead", block.alias("by"), other.alias("bx"), *cols)

    def side(table):
        return (table.column("node").to_numpy(), table.column("class").to_numpy(), table.column("n").to_numpy(),
                table.column("bits").to_pylist())

    def compare(xs, ys):
        found_a, found_b = [], []
        if xs.num_rows and ys.num_rows:
            main = xs.column("main")[0].as_py()
            node_x, class_x, n_x, bits_x = side(xs)
            node_y, class_y, n_y, bits_y = side(ys)
            width_y = np.array([len(v) // 8 for v in bits_y])
            packed = {w: np.stack([np.frombuffer(bits_y[i], U) for i in np.flatnonzero(width_y == w)])
                      for w in np.unique(width_y).tolist()}
            for i in range(len(node_x)):
                mine = np.frombuffer(bits_x[i], U)
                for w, sketches in packed.items():
                    at = np.flatnonzero(width_y == w)
                    keep = ((100 * n_y[at] >= percent * n_x[i]) & (100 * n_x[i] >= percent * n_y[at])
                            & (class_y[at] != class_x[i]) & ((node_x[i] < node_y[at]) | (class_y[at] == main)))
                    if not keep.any():
                        continue
                    at, sketches_ = at[keep], sketches[keep]
                    narrow = min(len(mine), w)
                    far = np.bitwise_count(folded(sketches_, narrow) ^ folded(mine, narrow)).sum(axis=1, dtype=np.int64)
                    at = at[within(far, n_x[i], n_y[at], percent)]
                    found_a.append(np.minimum(node_x[i], node_y[at]))
                    found_b.append(np.maximum(node_x[i], node_y[at]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *found_a]), "b": np.concatenate([none, *found_b])})

    key = ["lead", "bx", "by"]
    blocked = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, "a bigint, b bigint")
    return near(rows, nodes, percent).unionByName(blocked).distinct()


def set_classes(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, hot: int = HOT) -> tuple:
    """(profile by document, (node, class) of the linked sets)."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 (size bands are a factor of two apart) and at most 100")
    profiled = staged(profile(docs, k, percent), "parity-profile")
    clash = profiled.where("n > 0").groupBy("node").agg(F.min("again").alias("x"), F.max("again").alias("y")).where("x != y")
    if not clash.isEmpty():
        raise RuntimeError("two sets share a 64-bit hash; change the seeds of set_hashes")
    sketched = staged(sketch(docs, k, percent, frequent(profiled, hot)), "parity-sketch")
    spread = sketched.select(F.explode("keys").alias("key"), "node")
    buckets = staged(spread.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"),
                                               F.count(F.lit(1)).alias("c")).where("a != b"), "parity-buckets")
    members = staged(spread.join(buckets.where("c > 2").select("key", "c"), "key").distinct(), "parity-members")
    company = members.groupBy("node").agg(F.sum("c").alias("company"))
    lead = (members.join(company, "node").groupBy("key")
            .agg(F.max(F.struct("company", "node"))["node"].alias("lead")))
    led = staged(members.join(lead, "key").select("lead", "node").distinct(), "parity-led")
    pairs = staged(buckets.where("c = 2").select("a", "b")
                   .union(led.where("lead != node").select(F.least("lead", "node"), F.greatest("lead", "node"))).distinct(),
                   "parity-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    nodes = staged(sketched.join(wanted, "node", "left_semi").groupBy("node")
                   .agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "parity-nodes")
    discard(sketched, buckets, members)
    links = staged(linked(staged(near(pairs, nodes, percent), "parity-near"), docs, profiled, k, percent), "parity-links")
    label = components(links, "parity-classes")
    more = staged(open_pairs(led, label, nodes, percent).join(pairs, ["a", "b"], "left_anti"), "parity-near")
    if not more.isEmpty():
        new = staged(linked(more, docs, profiled, k, percent), "parity-links")
        if not new.isEmpty():
            label = components(links.union(new), "parity-classes")
    return profiled, label


def similar(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, component_size (rows in the component)."""
    profiled, label = set_classes(docs, k, percent, hot)
    rows = profiled.where("n IS NOT NULL")
    per_set = (rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
               .join(label, "node", "left").select("node", F.coalesce("class", F.col("node")).alias("class"), "first_id", "copies"))
    per_class = per_set.groupBy("class").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("component_size"))
    named = staged(per_set.select("node", "class").join(per_class, "class").drop("class"), "parity-named")
    return (rows.where("n > 0").join(named, "node")
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id", "component_size")
            .unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"),
                                                    F.col("doc_id").alias("component_id"),
                                                    F.lit(1).cast("bigint").alias("component_size"))))
