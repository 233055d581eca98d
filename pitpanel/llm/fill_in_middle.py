"""Fill-in-the-middle transformation over an indexable skip list.

A text is cut into units (lines, the line break included; or single code points). The units are
the bottom lane of a skip list; every lane above links some of the units of the lane below, chosen by a fixed coin
per unit, and each link carries the two widths it spans: units and code points. A cut at rank r is
found by descending from the top lane: a link is followed while its unit width fits into what is left of r, and
the code-point widths followed add up to the place of the cut in the text. Two cuts drawn from a hash of the
document's id give prefix, middle and suffix, which are put together as

* ``psm``: P prefix S suffix M middle, or ``spm``: S suffix P prefix M middle (sentinels P, S, M), or
* ``plain``: the text itself - empty texts, texts that hold a sentinel, and the share not drawn.

``restore`` rebuilds the text from output and form alone: sentinels do not occur in the text, and no
sentinel's end is another one's beginning, so they are found again where they were put.

Defined cases: a NULL text is the empty text (plain, n 0); a NULL doc_id draws from the seed with an empty id; equal
rows give equal results; a text of one unit may be cut before or after it; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.base import texts

SEED = 7
SENTINELS = ("<P>", "<S>", "<M>")
FIM_PERCENT = 100
SPM_PERCENT = 50
COIN = 4               # one unit in so many is linked by the next lane as well
OUTPUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def towers(i: int) -> int:
    """Lanes above the bottom one that stop at unit ``i`` (counted from 1): a fixed coin per unit."""
    x = (i * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 31
    h = 0
    while x % COIN == 0 and h < 32:
        x //= COIN
        h += 1
    return h


class SkipList:
    """Units by rank. A lane is a list of links (unit width, code-point width, index below): the last
    is where the lane below goes on after the link, one link past the ones the link spans."""

    def __init__(self, widths: list):
        self.n = len(widths)
        self.lanes = [[(1, w, i + 1) for i, w in enumerate(widths)]]
        heights = [towers(i + 1) for i in range(self.n)]
        while len(self.lanes[-1]) > COIN:
            level, lane, units, chars, at = len(self.lanes), [], 0, 0, 0
            for k, (u, c, _) in enumerate(self.lanes[-1]):
                units, chars, at = units + u, chars + c, at + u
                if heights[at - 1] >= level:
                    lane.append((units, chars, k + 1))
                    units = chars = 0
            if not lane:
                break
            self.lanes.append(lane)

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank (0 to n)."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        left, chars, at = rank, 0, 0
        for lane in reversed(self.lanes):
            while at < len(lane) and lane[at][0] <= left:
                units, width, below = lane[at]
                left, chars, at = left - units, chars + width, at + 1
            # go down to the link after the last one followed
            at = lane[at - 1][2] if at else 0
        return chars


def line_widths(text: str) -> list:
    """Code points of each line, its line break included."""
    lines = text.split("\n")
    widths = [len(x) + 1 for x in lines]
    widths[-1] -= 1
    return widths if widths[-1] else widths[:-1]


UNITS = {"line": line_widths, "char": lambda text: [1] * len(text)}


def draws(seed: int, doc_id) -> list:
    """Four 32-bit numbers from the document's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4)]


def arrange(doc_id, text: str, unit: str = "line", seed: int = SEED, fim_percent: int = FIM_PERCENT,
            spm_percent: int = SPM_PERCENT, sentinels: tuple = SENTINELS) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    widths = UNITS[unit](text)
    n = len(widths)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or any(s in text for s in sentinels) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    i, j = units.place(first), units.place(second)
    p, s, m = sentinels
    if h4 % 100 < spm_percent:
        return n, "spm", i, j - i, "".join((s, text[j:], p, text[:i], m, text[i:j]))
    return n, "psm", i, j - i, "".join((p, text[:i], s, text[j:], m, text[i:j]))


def check_sentinels(sentinels: tuple) -> None:
    """Sentinels must be told apart wherever they stand: none empty or inside another, no end of one is a
    beginning of one."""
    for i, x in enumerate(sentinels):
        others = [y for j, y in enumerate(sentinels) if j != i]
        if not x or any(x in y for y in others):
            raise ValueError(f"sentinels must differ and not contain one another: {sentinels}")
        if any(x.endswith(x[:n]) for n in range(1, len(x))) or any(x.endswith(y[:n]) for y in others for n in range(1, len(y) + 1)):
            raise ValueError(f"the end of {x!r} is a beginning of a sentinel")


def transform(docs: DataFrame, unit: str = "line", seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT, sentinels: tuple = SENTINELS) -> DataFrame:
    """``OUTPUT`` rows, one per document, in one narrow pass (no shuffle)."""
    check_sentinels(sentinels)
    if unit not in UNITS:
        raise ValueError(f"unit is one of {sorted(UNITS)}")

    def run(batches):
        for b in batches:
            step = max(1, min(len(b), 256))              # few output texts are held at a time
            for at in range(0, len(b), step):
                part = b.slice(at, step)
                rows = [arrange(i, t, unit, seed, fim_percent, spm_percent, sentinels)
                        for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())]
                n, form, prefix, middle, out = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return texts(docs).mapInArrow(run, OUTPUT)


def restored(output="output", form="form", sentinels: tuple = SENTINELS) -> Column:
    """The original text, from output and form alone (built-in expressions)."""
    parts = F.split(F.col(output), "|".join(re.escape(s) for s in sentinels), -1)     # "", two parts, middle
    a, b, middle = F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
    return (F.when(F.col(form) == "plain", F.col(output))
            .when(F.col(form) == "psm", F.concat(a, middle, b))
            .when(F.col(form) == "spm", F.concat(b, middle, a)))


def digest(rows: DataFrame, sentinels: tuple = SENTINELS) -> DataFrame:
    """Per document: n, form, widths, and SHA-256 of the output and of the text restored from it."""
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(sentinels=sentinels).cast("binary"), 256).alias("restored_sha256"))
