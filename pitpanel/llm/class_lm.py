"""Brown class n-grams: a class bigram model whose classes come from exchange clustering.

Tokens are the runs of characters other than space and tab to carriage return, A-Z folded, and
one end per text. Counts of all training tokens are a Spark aggregation. Every training word takes
part in the exchange; it starts in the class of its form (length band, letters only or not), and the
end has its own class. The move looked for is the one with the largest gain in the class bigrams' log likelihood,
found in parallel from a word's class contexts (word -> next class, previous class -> word).
First the ``clustered`` most frequent words are exchanged between ``classes`` classes, a quarter of
them at a time; then in each of ``rounds`` rounds every training word, however rare, is tried against
the class table. The first of these leaves the forms behind, whatever the likelihood; other moves that lower it
together are tried again for every second word, and so on.

The ``held`` most frequent words are coded where the text is, and their classes are held by every task. All
other words stay in Spark tables: one row per occurrence with its neighbours, grouped to one row per word
for the moves, and joined back to score the texts. What reaches the driver is bounded by the parameters: the
held words, their classes and the class bigram table.

P(w | v) = P(class w | class v) * P(w | class w), both with 0.5 added to every count, so every text has a
finite score. A word that is not among the training words has the class of its form; since a word met once
is, but for that one place, such a word, it counts there as an unseen word of its form as well.

Defined cases: a NULL or empty text is one end; repeated rows and NULL doc_ids are scored row by row (a NULL
doc_id falls on crc32 of the empty text, 0: training); without training rows all counts are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.base import discard, staged, texts

CLUSTERED = 2000
HELD = 60_000          # most frequent words whose counts and classes every task holds; other words' are joined
CLASSES = 48
SWEEPS = 12            # a quarter of the clustered words each
ROUNDS = 2             # every training word each
SHARES = (1, 2, 4)     # a round's moves that lower the likelihood together are tried again for every 2nd, every 4th word
FORMS = 8
HOLD_OUT = (5, 1)      # a text is held out if crc32(doc_id as text) mod 5 is 1
KEEP = 16_000_000      # bytes of words kept by a task before it hands their counts on
PART = 4_000_000       # bytes of text coded together
BLOCKS = 240           # tables of codes are merged and tried in so many parts
CHUNK = 1024           # words whose gains are computed together


def tokens(text: str) -> list:
    return text.encode().lower().split()       # bytes: only A-Z are folded, only ASCII white space cuts


def form(word: bytes) -> int:
    return min((len(word) - 1) // 3, 3) + (0 if word.isalpha() else 4)


def form_of(word: Column) -> Column:
    return (F.least(F.floor((F.octet_length(word) - 1) / 3), F.lit(3))
            + F.when(F.rlike(word, F.lit("[^a-z]")), 4).otherwise(0)).cast("int")


def words_of(text: pa.Array) -> tuple:
    """(text, word) of all ``tokens`` of some texts, by numbers of texts."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words = cut.flatten()
    full = pc.binary_length(words).to_numpy() > 0                    # white space at an end cuts off an empty word
    return np.repeat(np.arange(len(cut)), cut.value_lengths().to_numpy())[full], words.filter(pa.array(full))


def slices(batch: pa.RecordBatch, most: int):
    """A batch in parts whose texts have about ``most`` bytes."""
    part = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)) // most
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for first, last in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(first, last - first)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HOLD_OUT[0] == HOLD_OUT[1]


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) of all training tokens; the end is the empty word."""
    def run(batches):
        waiting, ends, pending = [], 0, 0

        def rows():
            count = pa.chunked_array([*waiting, pa.array([], pa.string())]).value_counts()
            return pa.RecordBatch.from_arrays([pa.concat_arrays([count.field("values"), pa.array([""])]),
                                               pa.concat_arrays([count.field("counts"), pa.array([ends], pa.int64())])],
                                              ["word", "n"])
        for b in batches:
            for part in slices(b, PART):
                waiting.append(words_of(part.column("text"))[1])
                ends += part.num_rows
                pending += waiting[-1].nbytes
                if pending > KEEP:
                    yield rows()
                    waiting, ends, pending = [], 0, 0
        if ends:
            yield rows()

    return training.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> list:
    """The (word, n) rows of the highest counts, ``most`` at most, most frequent first: counts are
    binned by size (eight bins an octave), and whole bins are taken from the top while they fit."""
    size = F.floor(F.log2("n") * 8).cast("int")
    left, lowest = most, None
    for r in sorted(counts.groupBy(size.alias("bin")).agg(F.count(F.lit(1)).alias("words")).collect(),
                    key=lambda r: -r["bin"]):
        left -= r["words"]
        if left < 0:
            break
        lowest = r["bin"]
    rows = counts.where(size >= lowest).collect() if lowest is not None else []
    return sorted(rows, key=lambda r: (-r["n"], r["word"]))


def coded(docs: DataFrame, words: list, log_count: np.ndarray) -> DataFrame:
    """A row per text: (rid, doc_id, train, codes, known, base), its codes between two ends as 32-bit integers, how
    many of them are held words or ends, and the sum of their ``log_count``. A row per occurrence of another word: (rid,
    train, word, around, follow), the codes before and after it as one number (the code after the end's stands for
    the same word), and the next word, if that is not held either and another."""
    n = len(words)
    end, itself, size = n + FORMS, n + FORMS + 1, n + FORMS + 2

    def run(batches):
        head = pa.array(words, pa.string())

        def rows(b):
            text, word = words_of(b.column("text"))
            word = word.dictionary_encode()
            distinct = word.dictionary
            code = pc.index_in(distinct, value_set=head)
            forms = (np.minimum((pc.binary_length(distinct).to_numpy() - 1) // 3, 3)
                     + np.where(pc.ascii_is_alpha(distinct).to_numpy(zero_copy_only=False), 0, 4))
            code = np.where(code.is_null().to_numpy(zero_copy_only=False), n + forms, code.fill_null(0).to_numpy())
            lens = np.bincount(text, minlength=b.num_rows) + 2
            starts = np.cumsum(lens) - lens
            at = np.arange(len(text)) + 2 * text + 1
            seq, which = np.full(lens.sum(), end), np.full(lens.sum(), -1)
            which[at] = word.indices.to_numpy()
            seq[at] = code[which[at]]
            other = (seq >= n) & (seq < end)
            first = np.zeros(len(seq), dtype=bool)
            first[starts] = True                                     # the end before a text is no token of it
            value = np.where(other | first, 0.0, log_count[seq])
            at = np.flatnonzero(other)
            before, after = seq[at - 1], seq[at + 1]
            same = which[at] == which[at + 1]
            after[same] = itself
            before[np.flatnonzero(same) + 1] = itself
            per_text = [b.column("doc_id"), packed(np.repeat(np.arange(len(lens)), lens), seq, seq)[1],
                        pa.array(np.add.reduceat((~(other | first)).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(value, starts))]
            doc_id, codes, known, base = (pa.concat_arrays([x, pa.nulls(len(at), x.type)]) for x in per_text)
            per_word = [distinct.take(pa.array(which[at])), pa.array(before * size + after),
                        distinct.take(pa.array(which[at + 1], mask=same | ~other[at + 1]))]
            word, around, follow = (pa.concat_arrays([pa.nulls(b.num_rows, x.type), x]) for x in per_word)
            of = pa.array(np.repeat(np.arange(b.num_rows), np.add.reduceat(other.astype(np.int64), starts)))
            rid, train = (pa.concat_arrays([x, x.take(of)]) for x in (b.column("rid"), b.column("train")))
            return pa.RecordBatch.from_arrays([rid, doc_id, train, codes, known, base, word, around, follow], [
                "rid", "doc_id", "train", "codes", "known", "base", "word", "around", "follow"])
        for b in batches:
            for part in slices(b, PART):
                yield rows(part)

    return docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", (~held_out(F.col("doc_id"))).alias("train"),
                       "text").mapInArrow(
        run, "rid bigint, doc_id bigint, train boolean, codes binary, known bigint, base double, word string, "
             "around bigint, follow string")


def packed(key: np.ndarray, value: np.ndarray, n: np.ndarray) -> tuple:
    """(keys, and for each of them the bytes of its values and of their counts): ``key`` is sorted."""
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    ends = np.append(starts, len(key))
    out = [pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((ends * width).astype("<i4").tobytes()),
                                                            pa.py_buffer(x.astype(kind).tobytes())])
           for x, kind, width in ((value, "<i4", 4), (n, "<i8", 8))]
    return key[starts], *out


def unpacked(batch, name: str) -> tuple:
    """(row, value, count) of a batch's ``packed`` column ``name``, one after the other."""
    value, n = (b"".join(batch.column(x).to_pylist()) for x in (name, f"{name}_n"))
    lens = pc.binary_length(batch.column(name)).to_numpy(zero_copy_only=False) // 4
    return np.repeat(np.arange(batch.num_rows), lens), np.frombuffer(value, "<i4"), np.frombuffer(n, "<i8")


def code_pairs(texts_coded: DataFrame, words: int) -> DataFrame:
    """(w, after, after_n, before, before_n): a row per code, ``packed`` with the codes beside it in the ``coded`` texts and
    how often they are; at most (codes)**2 pairs."""
    size = words + FORMS + 1

    def run(batches):
        waiting, pending = [], 0

        def rows():
            pairs, n = np.unique(np.concatenate(waiting), return_counts=True)
            a, b = pairs // size, pairs % size
            order = np.argsort(b, kind="stable")
            for side, found in ((0, packed(a, b, n)), (1, packed(b[order], a[order], n[order]))):
                for i in range(0, len(found[0]), 10_000):
                    w, near, near_n = (x[i:i + 10_000] for x in found)
                    yield pa.RecordBatch.from_arrays([pa.array(w, pa.int32()), pa.array(np.full(len(w), side), pa.int32()),
                                                      near, near_n], ["w", "side", "near", "near_n"])
        for b in batches:
            for codes in b.column("codes").to_pylist():
                seq = np.frombuffer(codes, dtype="<i4").astype(np.int64)
                waiting.append(seq[:-1] * size + seq[1:])
                pending += len(seq)
                if pending > 4_000_000:
                    yield from rows()
                    waiting, pending = [], 0
        if waiting:
            yield from rows()

    def merged(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        of, side = table.column("w").to_numpy(), table.column("side").to_numpy()
        codes, sides = np.unique(of), []
        row, near, n = unpacked(table, "near")
        for x in (0, 1):
            use = side[row] == x
            pairs, at = np.unique(of[row[use]].astype(np.int64) * size + near[use], return_inverse=True)
            found = packed(pairs // size, pairs % size, np.bincount(at, n[use], len(pairs)))
            lacks = pa.array(np.searchsorted(found[0], codes), mask=~np.isin(codes, found[0]))
            sides += [pc.fill_null(column.take(lacks), b"") for column in found[1:]]
        return pa.table([pa.array(codes, pa.int32()), *sides], names=["w", "after", "after_n", "before", "before_n"])

    return (texts_coded.select("codes").mapInArrow(run, "w int, side int, near binary, near_n binary")
            .groupBy((F.col("w") % BLOCKS).alias("block"))
            .applyInArrow(merged, "w int, after binary, after_n binary, before binary, before_n binary"))


def folded(bigrams: DataFrame, fold: np.ndarray, kept: int) -> DataFrame:
    """``code_pairs`` with the codes ``fold`` gives: a row of each code below ``kept``, which ``fold`` leaves as it is, and
    one or more of the others, to be added up."""
    size = int(fold.max()) + 1

    def run(batches):
        rest: dict = {}
        for b in batches:
            w = b.column("w").to_numpy()
            to, columns = fold[w], []
            own = np.flatnonzero(w < kept)
            for side, name in enumerate(("after", "before")):
                row, near, n = unpacked(b, name)
                pairs, at = np.unique(to[row] * size + fold[near], return_inverse=True)
                sums = np.bincount(at, n, len(pairs)).astype(np.int64)
                low = pairs < kept * size
                for x, y in zip(pairs[~low].tolist(), sums[~low].tolist()):
                    rest[side, x] = rest.get((side, x), 0) + y
                found = packed(pairs[low] // size, pairs[low] % size, sums[low])
                lacks = pa.array(np.searchsorted(found[0], w[own]), mask=~np.isin(w[own], found[0]))
                columns += [pc.fill_null(column.take(lacks), b"") for column in found[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(w[own], pa.int32()), *columns],
                                             ["w", "after", "after_n", "before", "before_n"])
        for side in (0, 1):
            pairs = np.array(sorted(x for s, x in rest if s == side), dtype=np.int64)
            code, *found = packed(pairs // size, pairs % size, np.array([rest[side, x] for x in pairs.tolist()], dtype=np.int64))
            none = pa.array([b""] * len(code), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), *(found + [none] * 2 if side == 0 else [none] * 2 + found)],
                                             ["w", "after", "after_n", "before", "before_n"])

    return bigrams.mapInArrow(run, bigrams.schema)


def bigram_counts(training: DataFrame, words: list) -> DataFrame:
    """The ``code_pairs`` of the texts, each between two ends."""
    return code_pairs(coded(training, words, np.zeros(len(words) + FORMS + 1)).where("codes is not null"), len(words))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(n: np.ndarray) -> float:
    """Of the class bigrams, but for what the words inside the classes add (the same for any classes)."""
    return float(_xlogx(n).sum() - _xlogx(n.sum(1)).sum() - _xlogx(n.sum(0)).sum())


def best_moves(n: np.ndarray, own: np.ndarray, right: np.ndarray, left: np.ndarray, same: np.ndarray, movable: int) -> tuple:
    """(classes, gains) of the best moves of words of the classes ``own`` into one of the first ``movable`` classes:
    ``right`` / ``left`` (a row per word) are their counts before / after each class (without themselves), ``same``
    their counts beside themselves. A gain is what the move alone adds to the likelihood of the class table ``n``."""
    f, w = _xlogx, np.arange(len(own))
    r, l = right.sum(1) + same, left.sum(1) + same
    rows, cols, diag = n.sum(1), n.sum(0), n.diagonal()
    gain, stay = np.zeros(right.shape), np.zeros(len(own))
    for part, table in ((right, n), (left, n.T)):
        i, c = np.nonzero(part)
        if len(i):
            x = part[i, c].astype(np.int64)
            cells, at = np.unique(x * len(n) + c, return_inverse=True)
            to = np.ascontiguousarray(table.T)[cells % len(n)]
            starts = np.flatnonzero(np.diff(i, prepend=-1))
            gain[i[starts]] += np.add.reduceat((f(to + (cells // len(n))[:, None]) - f(to))[at], starts, axis=0)
            old = table[own[i], c]
            stay += np.bincount(i, np.where(c == own[i], 0.0, f(old) - f(old - x)), len(own))
    # the cells beside the word's own class lack the word's counts
    for part, back, table in ((right, left, n.T), (left, right, n)):
        some = np.flatnonzero(part[w, own])
        x, there, least = part[some, own[some]][:, None], table[own[some]], table[own[some]] - back[some]
        gain[some] += f(least + x) - f(least) - f(there + x) + f(there)
    i, c = np.nonzero(((right > 0) & (left > 0)) | (same > 0)[:, None])
    x, y, mid = right[i, c], left[i, c], diag[c]
    gain[i, c] += f(mid + x + y + same[i]) + f(mid) - f(mid + x) - f(mid + y)
    for sums, count in ((rows, r), (cols, l)):
        x, at = np.unique(count, return_inverse=True)
        gain -= (f(sums + x[:, None]) - f(sums))[at]
    stay += f(diag[own]) - f(diag[own] - right[w, own] - left[w, own] - same)
    stay -= f(rows[own]) - f(rows[own] - r) + f(cols[own]) - f(cols[own] - l)
    gain -= stay[:, None]
    gain[w, own] = 0
    best = np.argmax(gain[:, :movable], axis=1)
    return best, gain[w, best]


def filled(counted: DataFrame, k: int) -> np.ndarray:
    """The table of (c, d, n) rows."""
    got, out = counted.toArrow(), np.zeros((k, k))
    out[got.column("c").to_numpy(), got.column("d").to_numpy()] = got.column("n").to_numpy()
    return out


def class_tables(bigrams: DataFrame, classes: list, k: int) -> np.ndarray:
    """Class bigram counts under each of (the first code's, the second code's) class arrays; a class of -1 is left out."""
    def run(batches):
        sums = np.zeros((len(classes), k * k))
        for b in batches:
            row, near, n = unpacked(b, "after")
            of = b.column("w").to_numpy()[row]
            for own, (left, right) in zip(sums, classes):
                c, d = left[of], right[near]
                use = (c >= 0) & (d >= 0)
                own += np.bincount(c[use] * k + d[use], n[use], k * k)
        which, cell = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(which * k + cell // k), pa.array(cell % k),
                                          pa.array(sums[which, cell].astype(np.int64))], ["c", "d", "n"])

    got = (bigrams.select("w", "after", "after_n").mapInArrow(run, "c bigint, d bigint, n bigint")
           .groupBy("c", "d").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros((len(classes) * k, k))
    out[got.column("c").to_numpy(), got.column("d").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(len(classes), k, k)


def class_table(bigrams: DataFrame, cls: np.ndarray) -> np.ndarray:
    """Class bigram counts under a code -> class array."""
    return class_tables(bigrams, [(cls, cls)], int(cls.max()) + 1)[0]


def tries(w: np.ndarray, side: np.ndarray, c: np.ndarray, x: np.ndarray, cls: np.ndarray, n: np.ndarray, movable: int) -> list:
    """[(codes, classes, gains)]: the best moves of codes by their contexts, one or more (code, side, class, count) each:
    before (side 0) and after a class, or beside themselves (side 2)."""
    out, k = [], len(n)
    code, at = np.unique(w, return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, cell, x = at[order], (side * k + c)[order], x[order]
    for first in range(0, len(code), CHUNK):
        some = code[first:first + CHUNK]
        part = slice(*np.searchsorted(at, (first, first + len(some))))
        v = np.bincount((at[part] - first) * 3 * k + cell[part], x[part], len(some) * 3 * k).reshape(-1, 3, k)
        out.append((some, *best_moves(n, cls[some], v[:, 0], v[:, 1], v[:, 2].sum(1), movable)))
    return out


def proposals(bigrams: DataFrame, cls: np.ndarray, n: np.ndarray, words: int, movable: int,
              beside: DataFrame | None = None) -> DataFrame:
    """(w, cls, gain): every coded word's best move against the class table ``n``, in parallel; codes of class -1 are no
    contexts. ``beside`` adds contexts among words without a code: (w, near, near_n), ``packed`` with 3 * class + side."""
    k, out = len(n), "w int, cls int, gain double"

    def contexts(b):
        found = []
        w = b.column("w").to_numpy()
        for side, name in enumerate(("after", "before")):
            row, near, x = unpacked(b, name)
            itself, c = near == w[row], cls[near]
            use = (c >= 0) & ~itself
            found.append((w[row[use]], np.full(use.sum(), side), c[use], x[use]))
            if not side:
                found.append((w[row[itself]], np.full(itself.sum(), 2), np.zeros(itself.sum(), dtype=np.int64), x[itself]))
        return [np.concatenate(x) for x in zip(*found)]

    def moves(found):
        none = (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0))
        return [pa.array(np.concatenate(x), t) for x, t in zip(zip(none, *found), (pa.int32(), pa.int32(), pa.float64()))]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(moves(tries(*contexts(b), cls, n, movable)), ["w", "cls", "gain"])

    def run_packed(batches):
        for b in batches:
            w, side, c, x = contexts(b)
            cells, at = np.unique(w.astype(np.int64) * 3 * k + c * 3 + side, return_inverse=True)
            found, near, near_n = packed(cells // (3 * k), cells % (3 * k), np.bincount(at, x, len(cells)))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), near, near_n], ["w", "near", "near_n"])

    def run_block(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        row, near, x = unpacked(table, "near")
        use = near < 3 * k
        row, near = row[use], near[use]
        found = tries(table.column("w").to_numpy()[row], near % 3, near // 3, x[use], cls, n, movable)
        return pa.table(moves(found), names=["w", "cls", "gain"])

    bigrams = bigrams.where(F.col("w") < words)
    if beside is None:
        return bigrams.mapInArrow(run, out)
    return (bigrams.mapInArrow(run_packed, "w int, near binary, near_n binary").union(beside.where(F.col("w") < words))
            .groupBy((F.col("w") % BLOCKS).alias("block")).applyInArrow(run_block, out))


def exchange(bigrams: DataFrame, words: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> tuple:
    """(code -> class, class bigram table) after exchange clustering."""
    classes = max(min(classes, words), 1)
    cls = np.concatenate([np.arange(words) % classes, classes + np.arange(FORMS + 1)]).astype(np.int64)
    n, idle = class_table(bigrams, cls), 0
    for sweep in range(sweeps if words else 0):
        moves = proposals(bigrams.where(F.col("w") % 4 == sweep % 4), cls, n, words, classes).where("gain > 0").toArrow()
        w, to, gain = (moves.column(i).to_numpy() for i in ("w", "cls", "gain"))
        order = np.lexsort((w, -gain))
        idle += 1
        tried = []
        while len(order):
            tried.append(cls.copy())
            tried[-1][w[order]] = to[order]
            order = order[:-1:2] if len(order) > 1 else order[:0]
        tables = class_tables(bigrams, [(x, x) for x in tried], len(n)) if tried else []
        for x, m in zip(tried, tables):
            if likelihood(m) > likelihood(n):
                cls, n, idle = x, m, 0
                break
        if idle == 4:
            break
    return cls, n


def by_word(rare: DataFrame, more: tuple = (), then=None, out: str = "") -> DataFrame:
    """(word, around, *more): a row per word with all its occurrences' ``around`` and, in the same order, their columns
    ``more``. ``then`` takes these rows on in the same task, to rows of the columns ``out``."""
    names = ["around", *more]

    def run(batches):
        last = None
        for b in batches:
            b = pa.Table.from_batches([b] if last is None else [last, b]).combine_chunks()
            if not b.num_rows:
                continue
            b, last = grouped(b, False)
            yield b
        if last is not None:
            yield grouped(pa.Table.from_batches([last]), True)[0]

    def grouped(b, whole):
        """The rows of all words but for those of the last number, which may go on, and these."""
        def changes(x):
            return np.append(True, pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False))

        numbers = np.flatnonzero(changes(b.column("number")))
        rest = b.slice(numbers[-1])
        b = b if whole else b.slice(0, numbers[-1])
        new = np.flatnonzero(changes(b.column("word"))) if b.num_rows else np.zeros(0, dtype=np.int64)
        if len(new) != len(numbers) - (not whole):                   # words that share a number
            b = b.sort_by([("number", "ascending"), ("word", "ascending")]).combine_chunks()
            new = np.flatnonzero(changes(b.column("word")))
        word, *lists = (pa.concat_arrays(b.column(x).chunks) if b.num_rows else pa.array([], t)
                        for x, t in (("word", pa.string()), *((x, pa.int64()) for x in names)))
        ends = pa.array(np.append(new, b.num_rows), pa.int32())
        out = pa.RecordBatch.from_arrays([word.take(pa.array(new)), *(pa.ListArray.from_arrays(ends, x) for x in lists)],
                                         ["word", *names])
        return out, rest.combine_chunks().to_batches()[0]

    return (rare.select("word", *names).repartition("word").withColumn("number", F.xxhash64("word"))
            .sortWithinPartitions("number")
            .mapInArrow((lambda batches: then(run(batches))) if then else run,
                        out or "word string, " + ", ".join(f"{x} array<bigint>" for x in names)))


def by_form(batches, first_form: int):
    """Rows of ``by_word`` with the class of their word's form, in batches of thousands."""
    waiting, pending = [], 0

    def rows():
        b = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        word = b.column("word")
        forms = (np.minimum((pc.binary_length(word).to_numpy() - 1) // 3, 3)
                 + np.where(pc.ascii_is_alpha(word).to_numpy(zero_copy_only=False), 0, 4))
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(first_form + forms, pa.int32())], [*b.schema.names, "cls"])
    for b in batches:
        if b.num_rows:
            waiting.append(b)
            pending += b.num_rows
        if pending > 8_000:
            yield rows()
            waiting, pending = [], 0
    if waiting:
        yield rows()


MOVES = "word string, around array<bigint>, rid array<bigint>, own int, to int, gain double"


def placing(cls: np.ndarray, n: np.ndarray, words: int, movable: int, placed: bool):
    """The function from batches of words without a code to their best moves, ``MOVES``. A row is (word, its occurrences'
    ``around`` and ``rid``, its class). Other such words beside it are taken by their form, or, if they are ``placed``,
    by their classes, further numbers in ``around``: -1 - c for a class c after it, -1 - len(n) - c before it."""
    k, size, end = len(n), words + FORMS + 2, words + FORMS

    def run(batches):
        # words met once that share their class and those around them have the same move
        met = np.full(k * (k + 1) ** 2, -1, dtype=np.int32)
        met_gain = np.zeros(len(met))
        for b in batches:
            m, own = b.num_rows, b.column("cls").to_numpy()
            w = np.repeat(np.arange(m), b.column("around").value_lengths().to_numpy())
            pairs = b.column("around").flatten().to_numpy()
            near, x = -1 - pairs[pairs < 0], w[pairs < 0]
            w, pairs = w[pairs >= 0], pairs[pairs >= 0]
            sides = []
            for side, code in ((0, pairs % size), (1, pairs // size)):
                use = (code < words) | (code == end) | ((code < end) & (not placed))
                sides.append((np.concatenate([w[use], x[near // k == side]]),
                              np.concatenate([cls[code[use]], near[near // k == side] % k])))
            same = np.bincount(w[pairs % size > end], minlength=m).astype(float)
            lens = np.bincount(w, minlength=m)
            around = np.full((2, m), k)
            for of, (v, c) in zip(around, sides):
                of[v] = c
            key = (own * (k + 1) + around[0]) * (k + 1) + around[1]
            once = np.flatnonzero(lens == 1)
            unmet = once[met[key[once]] < 0]
            unmet = unmet[np.unique(key[unmet], return_index=True)[1]]
            to, gain = np.zeros(m, dtype=np.int32), np.zeros(m)
            todo = np.concatenate([unmet, np.flatnonzero(lens != 1)])
            at = np.full(m, -1)
            for first in range(0, len(todo), CHUNK):
                some = todo[first:first + CHUNK]
                at[some] = np.arange(len(some))
                full = []
                for v, c in sides:
                    use = at[v] >= 0
                    full.append(np.bincount(at[v[use]] * k + c[use], minlength=len(some) * k).reshape(-1, k).astype(float))
                to[some], gain[some] = best_moves(n, own[some], *full, same[some], movable)
                at[some] = -1
            met[key[unmet]], met_gain[key[unmet]] = to[unmet], gain[unmet]
            to[once], gain[once] = met[key[once]], met_gain[key[once]]
            yield pa.RecordBatch.from_arrays(
                [b.column("word"), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)), pa.int32()), pa.array(pairs)),
                 b.column("rid"), pa.array(own, pa.int32()), pa.array(to, pa.int32()), pa.array(gain, pa.float64())],
                ["word", "around", "rid", "own", "to", "gain"])

    return run


def edges(tail: DataFrame, words: int, k: int) -> DataFrame:
    """(w, near, near_n), one or more rows a code, ``packed`` with 3 * class + side: how often the code stands before (side 0)
    or after (1) the words without a code, by their class; the code after the end's: beside themselves. Words met once
    count a second time as class ``k`` + their form."""
    size, end, wide = words + FORMS + 2, words + FORMS, k + FORMS

    def run(batches):
        waiting, pending = [], 0

        def rows():
            at, x = np.unique(np.concatenate(waiting), return_counts=True)
            w, near, near_n = packed(at // (3 * wide), at % (3 * wide), x)
            for i in range(0, len(w), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(w[i:i + 10_000], pa.int32()), near[i:i + 10_000],
                                                  near_n[i:i + 10_000]], ["w", "near", "near_n"])
        for b in batches:
            around, c = b.column("around"), b.column("cls").to_numpy()
            lens = around.value_lengths().to_numpy()
            w, pairs = np.repeat(np.arange(b.num_rows), lens), around.flatten().to_numpy()
            once = (lens == 1)[w]
            unseen = b.column("form").to_numpy()[w] + k
            for side, code in ((0, pairs // size), (1, pairs % size)):
                use = ((code < words) | (code >= end)) & ((code <= end) | (side == 1))
                for of, some in ((c[w], use), (unseen, use & once)):
                    waiting.append((code[some] * wide + of[some]) * 3 + side)
                    pending += len(waiting[-1])
            if pending > 4_000_000:
                yield from rows()
                waiting, pending = [], 0
        if waiting:
            yield from rows()

    return tail.select("around", "cls", form_of(F.col("word")).alias("form")).mapInArrow(
        run, "w int, near binary, near_n binary")


def without_forms(cls: np.ndarray, words: int) -> np.ndarray:
    """The classes of held words and the end alone; words without a code have their own."""
    return np.concatenate([cls[:words], np.full(FORMS, -1), cls[words + FORMS:]])


def neighbours(rare: DataFrame, of: DataFrame, first_form: int) -> DataFrame:
    """(rid, train, word, follow, c, d, ...): words without a code beside each other and their classes by ``of`` (word, cls,
    once); words that it lacks have the class of their form, which is given beside the classes of words met once."""
    out = rare.where("follow is not null").select("rid", "train", "word", "follow")
    for name, side in (("word", "c"), ("follow", "d")):
        # both times the same columns under new names, so that Spark deals them out once
        out = out.join(of.select(F.col("word").alias(f"of_{side}"), F.col("cls").alias(side), F.col("once").alias(f"once_{side}"))
                       .hint("shuffle_hash"), F.col(name) == F.col(f"of_{side}"), "left").drop(f"of_{side}")
        by_form = first_form + form_of(F.col(name))
        out = out.withColumn(f"form_{side}", F.when(F.col(f"once_{side}"), by_form)).withColumn(side, F.coalesce(side, by_form))
    return out


def whole_table(bigrams: DataFrame, cls: np.ndarray, beside: DataFrame, pairs: DataFrame, words: int, k: int) -> np.ndarray:
    """The class bigram table of all words: of the held words' own bigrams, of ``edges`` and of ``neighbours``. The
    rows and columns from ``k`` on are, by form, the places of words without a code that are met once."""
    end, wide = words + FORMS, k + FORMS
    out = np.zeros((wide, wide))
    of = np.append(without_forms(cls, words), -1)
    out[:k, :k] = class_tables(bigrams, [(of, of)], k)[0]

    def run(batches):
        sums = np.zeros(wide * wide)
        for b in batches:
            row, near, n = unpacked(b, "near")
            c, side = near // 3, near % 3
            own = of[b.column("w").to_numpy()[row]]
            own = np.where(own < 0, c, own)
            sums += np.bincount(np.where(side == 0, own * wide + c, c * wide + own), n, wide * wide)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at // wide), pa.array(at % wide), pa.array(sums[at].astype(np.int64))],
                                         ["c", "d", "n"])

    out += filled(beside.mapInArrow(run, "c bigint, d bigint, n bigint").groupBy("c", "d").agg(F.sum("n").alias("n")), wide)
    first_form = k - FORMS - 1
    kinds = ["c", "d", F.coalesce("once_c", F.lit(False)).alias("p"), F.coalesce("once_d", F.lit(False)).alias("q"),
             "form_c", "form_d"]
    for r in pairs.where("train").select(*kinds).groupBy("c", "d", "p", "q", "form_c", "form_d").count().collect():
        c, d = [r["c"]], [r["d"]]
        if r["p"]:
            c.append(k + r["form_c"] - first_form)
        if r["q"]:
            d.append(k + r["form_d"] - first_form)
        for x in c:
            for y in d:
                out[x, y] += r["count"]
    return out


def exchange_all(bigrams: DataFrame, rare: DataFrame, cls: np.ndarray, words: int, movable: int, rounds: int = ROUNDS) -> tuple:
    """Rounds of exchange of every training word. ``rare`` are the ``coded`` rows of words without a code, ``cls`` the classes
    the codes start with. Returns code -> class, (word, around, rid, cls, once) of the words without a code, their
    ``neighbours`` and the ``whole_table``."""
    end = words + FORMS
    first_form, k = int(cls[words]), int(cls[end]) + 1
    once = (F.size("around") == 1).alias("once")

    def state(of, tried, last):
        # texts held out are only scored: their neighbours wait for the last round's classes
        of = of.select("word", "around", "rid", "cls", once)
        pairs = staged(neighbours(rare if last else rare.where("train"), of.drop("around", "rid"), first_form),
                       "lm-neighbours", "zstd")
        beside = staged(edges(of, words, k), "lm-edges")
        return tried, of, pairs, whole_table(bigrams, tried, beside, pairs, words, k), beside, last

    if not rounds:
        start = staged(by_word(rare.where("train"), ("rid",)), "lm-contexts")
        return state(start.withColumn("cls", first_form + form_of(F.col("word"))), cls, True)[:4]
    found, n, old = None, class_table(bigrams, cls), []
    for turn in range(rounds):
        place = placing(cls, n, words, movable, found is not None)
        if found:
            pairs = found[2].where("train")
            near = (pairs.select("word", (-1 - F.col("d")).cast("bigint").alias("x"))
                    .union(pairs.select("follow", (-1 - k - F.col("c")).cast("bigint")))
                    .groupBy("word").agg(F.collect_list("x").alias("near")))
            tail = found[1].join(near, "word", "left").withColumn(
                "around", F.when(F.col("near").isNull(), F.col("around")).otherwise(F.concat("around", "near")))
            got = proposals(bigrams, without_forms(cls, words), n, words, movable, found[4])
            moves = tail.select("word", "around", "rid", "cls").mapInArrow(place, MOVES)
        else:
            got = proposals(bigrams, cls, n, words, movable)
            moves = by_word(rare.where("train"), ("rid",), lambda batches, of=place: of(by_form(batches, first_form)), MOVES)
        got = got.where("gain > 0").toArrow()
        w, to, gain = (got.column(i).to_numpy() for i in ("w", "cls", "gain"))
        moves = staged(moves, "lm-moves", "zstd")
        if found:
            discard(found[4])
        better = False
        for share in SHARES:
            some = (gain > 0) & (w % share == 0)
            tried = cls.copy()
            tried[w[some]] = to[some]
            move = (F.col("gain") > 0) & (F.pmod(F.hash("word"), F.lit(share)) == 0)
            new = state(moves.select("word", "around", "rid", F.when(move, F.col("to")).otherwise(F.col("own")).alias("cls")),
                        tried, turn == rounds - 1)
            better = not turn or likelihood(new[3][:k, :k]) > likelihood(n)
            if better:
                discard(*old)
                found, cls, n, old = new, tried, new[3][:k, :k], [moves, new[2]]
                break
            discard(new[2], new[4])
        if not better:
            discard(moves)
            break
    cls, of, pairs, n, _, last = found
    if not last:
        pairs = pairs.union(staged(neighbours(rare.where("not train"), of.drop("around", "rid"), first_form),
                                   "lm-neighbours", "zstd"))
    return cls, of, pairs, n


def score(docs: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES, sweeps: int = SWEEPS,
          held: int = HELD, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity): log10 probabilities under add-0.5 unigrams and under the class model."""
    d = texts(docs)
    counts = staged(word_counts(d.where(~held_out(F.col("doc_id")))), "lm-counts")
    total, distinct, ends = counts.agg(F.sum("n"), F.count(F.lit(1)),
                                       F.sum(F.when(F.col("word") == "", F.col("n")))).first()
    total, ends = total or 0, ends or 0
    head = frequent(counts.where("word != ''"), max(held, clustered))
    names, head_n = [r["word"].encode() for r in head], np.array([r["n"] for r in head], dtype=float)
    words, forms = len(names), np.arange(FORMS)
    end, exchanged = words + FORMS, min(clustered, words)
    head_form = np.array([form(w) for w in names], dtype=np.int64)
    log_count = np.concatenate([np.log10(head_n + 0.5), np.zeros(FORMS), [np.log10(ends + 0.5)]])
    all_coded = staged(coded(d, names, log_count), "lm-coded", "zstd")
    per_text, rare = all_coded.where("codes is not null"), all_coded.where("word is not null")
    bigrams = staged(code_pairs(per_text.where("train"), words), "lm-bigrams", "zstd")
    # the most frequent words alone, all others by their form
    fold = np.concatenate([np.arange(exchanged), exchanged + head_form[exchanged:], exchanged + forms, [exchanged + FORMS]])
    core = staged(folded(bigrams, fold, exchanged).repartition(8), "lm-core")
    cls, _ = exchange(core, exchanged, classes, sweeps)
    discard(counts, core)
    first_form, k = int(cls[exchanged]), int(cls[-1]) + 1
    cls, tail, pairs, table = exchange_all(bigrams, rare, cls[fold], words, first_form, rounds)

    # what the classes emit; words met once are, by their form, unseen words too
    mass, kinds = (np.bincount(cls[:words], weights=x, minlength=k).astype(float) for x in (head_n, np.ones(words)))
    mass[k - 1], kinds[k - 1] = ends, 1
    for r in tail.groupBy("cls").agg(F.sum(F.size("around")).alias("n"), F.count(F.lit(1)).alias("v")).collect():
        mass[r["cls"]] += r["n"]
        kinds[r["cls"]] += r["v"]
    unseen = np.bincount(head_form[head_n == 1], minlength=FORMS).astype(float)
    for r in tail.where("once").groupBy(form_of(F.col("word")).alias("f")).count().collect():
        unseen[r["f"]] += r["count"]
    if (head_n == 1).any():
        ghost = np.concatenate([np.where(head_n == 1, k + head_form, -1), np.full(FORMS + 1, -1)])
        table += class_tables(bigrams, [(cls, ghost), (ghost, cls), (ghost, ghost)], len(table)).sum(0)
    discard(bigrams)
    target = np.concatenate([np.arange(k), first_form + forms])
    n = np.zeros((k, k))
    np.add.at(n, (target[:, None], target[None, :]), table)
    mass[first_form:k - 1] += unseen
    kinds[first_form:k - 1] += unseen
    spread = np.log10(mass + 0.5 * (kinds + 1))
    step = np.log10((n + 0.5) / (n.sum(1, keepdims=True) + 0.5 * k))

    def run_texts(batches):
        for b in batches:
            model, n_tokens = [], []
            for codes in b.column("codes").to_pylist():
                seq = np.frombuffer(codes, dtype="<i4")
                own, c = (seq < words) | (seq == end), cls[seq]
                model.append(float(step[c[:-1], c[1:]][own[:-1] & own[1:]].sum() - spread[c[1:]][own[1:]].sum()))
                n_tokens.append(len(seq) - 1)
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in ("rid", "doc_id", "known", "base")),
                                              pa.array(n_tokens, pa.int64()), pa.array(model, pa.float64())],
                                             ["rid", "doc_id", "known", "base", "n_tokens", "model"])

    def summed(parts):
        """(block, rid, more, rare, model): sums by text of (rid, more, rare, model) parts, as far as a task holds them, a row
        per block of texts with 8 bytes a text in each column."""
        waiting, pending = [], 0

        def rows():
            rid, *values = (np.concatenate(x) for x in zip(*waiting))
            rid, *values = by_text(rid, values)
            block = (rid + (rid >> 33)) % blocks                     # the rows of a part of the input are numbered from its number << 33
            order = np.argsort(block, kind="stable")
            starts = np.flatnonzero(np.diff(block[order], prepend=-1))
            ends = pa.py_buffer((np.append(starts, len(order)) * 8).astype("<i4").tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(block[order[starts]], pa.int64()),
                 *(pa.Array.from_buffers(pa.binary(), len(starts), [None, ends, pa.py_buffer(x[order].tobytes())])
                   for x in (rid, *values))], ["block", "rid", "more", "rare", "model"])
        for part in parts:
            waiting.append(part)
            pending += len(part[0])
            if pending > 500_000:
                yield rows()
                waiting, pending = [], 0
        if pending:
            yield rows()

    def by_text(rid, values):
        text, at = np.unique(rid, return_inverse=True)
        return [text, *(np.bincount(at, x, len(text)) for x in values)]

    def merged(table: pa.Table) -> pa.Table:
        rid, *values = (np.frombuffer(b"".join(table.column(x).to_pylist()), kind)
                        for x, kind in (("rid", "<i8"), ("more", "<f8"), ("rare", "<f8"), ("model", "<f8")))
        rid, more, *values = by_text(rid, values)
        return pa.table([rid, more.astype(np.int64), *values], names=["rid", "more", "rare", "model"])

    def occurrences(rid, around, c, count) -> tuple:
        size, wide = end + 2, np.append(cls, -1)
        before, after = around // size, around % size
        out = -spread[c]
        for code, of in ((before, lambda x: step[x, c]), (after, lambda x: step[c, x])):
            near = (code < words) | (code == end)
            out += np.where(near, of(wide[np.where(near, code, end)]), 0.0)
        out += np.where(after == end + 1, step[c, c], 0.0)
        return rid, (count > 0).astype(float), np.log10(count + 0.5), out

    def run_training(batches):
        def parts():
            for b in batches:
                lens = b.column("rid").value_lengths().to_numpy()
                yield occurrences(b.column("rid").flatten().to_numpy(), b.column("around").flatten().to_numpy(),
                                  np.repeat(b.column("cls").to_numpy(), lens), np.repeat(lens, lens))
        return summed(parts())

    def run_held_out(batches):
        return summed(occurrences(*(b.column(x).to_numpy() for x in ("rid", "around", "cls", "c"))) for b in batches)

    def run_pairs(batches):
        def parts():
            for b in batches:
                none = np.zeros(b.num_rows)
                yield b.column("rid").to_numpy(), none, none, step[b.column("c").to_numpy(), b.column("d").to_numpy()]
        return summed(parts())

    # a training word's row has its occurrences; those in texts held out look up the word
    blocks = max(BLOCKS, int(total) // 20_000_000)
    sums = "block bigint, rid binary, more binary, rare binary, model binary"
    known = tail.select("word", "cls", F.size("around").cast("bigint").alias("c"))
    of_training = tail.select("rid", "around", "cls").mapInArrow(run_training, sums)
    of_held_out = (rare.where("not train").select("rid", "word", "around").join(known.hint("shuffle_hash"), "word", "left")
                   .select("rid", "around", F.coalesce("c", F.lit(0).cast("bigint")).alias("c"),
                           F.coalesce("cls", first_form + form_of(F.col("word"))).alias("cls"))
                   .mapInArrow(run_held_out, sums))
    of_pairs = pairs.select("rid", "c", "d").mapInArrow(run_pairs, sums)
    more = (of_training.union(of_held_out).union(of_pairs).groupBy("block")
            .applyInArrow(merged, "rid bigint, more bigint, rare double, model double").withColumnRenamed("model", "rare_model"))
    per = (per_text.select("rid", "doc_id", "known", "base", "codes").mapInArrow(
        run_texts, "rid bigint, doc_id bigint, known bigint, base double, n_tokens bigint, model double")
        .join(more, "rid", "left"))
    if not ends:
        per = per.withColumn("known", F.col("known") - 1)
    base = F.col("base") + F.coalesce("rare", F.lit(0.0))
    model = base + F.col("model") + F.coalesce("rare_model", F.lit(0.0))
    return per.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (base - F.col("n_tokens") * float(np.log10(total + 0.5 * (distinct + 1)))).alias("base_score"),
        model.alias("score"), F.pow(F.lit(10.0), -model / F.col("n_tokens")).alias("perplexity"))
