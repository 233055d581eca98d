"""Token counts per section of a document.

A document is encoded once, whole; its tokens' places in the text come from the byte lengths
of the ids (byte-level vocabularies: the ids' bytes, in a row, are the text's bytes). Sections
are sorted, adjoining spans, so the interval join of tokens to sections is two binary searches
per token, done where the text is. A token that crosses a boundary goes, by ``rule``:

* ``"largest"``: to the section with most of its bytes, the earlier one on a tie;
* ``"first"``: to the section of its first byte;
* ``"split"``: to every section it touches, by its share of bytes (``tokens`` is then fractional).

Sections are the lines of the text, each with its line break. Starts and ends are in code points.

Defined cases: a NULL or empty text is one empty section with no tokens; a text that ends in a line
break has no section after it; repeated rows and NULL doc_ids are counted row by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitpanel.llm.base import texts
from pitpanel.llm.tokens import encoder, slices

SCHEMA = "doc_id bigint, section int, start bigint, end bigint, tokens double, n_crossing bigint, doc_tokens bigint"
RULES = ("largest", "first", "split")


def line_starts(buf: np.ndarray) -> np.ndarray:
    """Byte offsets where the sections of a UTF-8 text begin."""
    return np.concatenate([np.zeros(1, np.int64), np.flatnonzero(buf[:-1] == 10) + 1]) if len(buf) else np.zeros(1, np.int64)


def allocate(lengths: np.ndarray, starts: np.ndarray, size: int, rule: str) -> tuple:
    """(tokens per section, tokens per section that begin there and cross its end) for tokens of
    these byte lengths laid end to end over sections that begin at ``starts`` and end at ``size``."""
    k = len(starts)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    a = np.searchsorted(starts, begins, "right") - 1
    b = np.searchsorted(starts, np.maximum(ends - 1, begins), "right") - 1
    cross = np.flatnonzero(a != b)
    weights = np.bincount(np.delete(a, cross), minlength=k).astype(float)
    bounds = np.append(starts, size)
    for t in cross:                      # as many as there are boundaries at most
        s = np.arange(a[t], b[t] + 1)
        part = np.minimum(bounds[s + 1], ends[t]) - np.maximum(bounds[s], begins[t])
        if rule == "split":
            weights[s] += part / lengths[t]
        else:
            weights[s[0] if rule == "first" else s[int(np.argmax(part))]] += 1
    return weights, np.bincount(a[cross], minlength=k)


def section_counts(docs: DataFrame, tokenizer: str, rule: str = "largest") -> DataFrame:
    """One row per document and line: (doc_id, section, start, end, tokens, n_crossing, doc_tokens)."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def run(batches):
        enc = encoder(tokenizer)
        lengths = enc.lengths()
        for batch in batches:
            batch_texts, doc_ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for i, j in slices(batch_texts):
                cols = [[], [], [], [], [], [], []]
                for x, (text, ids) in enumerate(zip(batch_texts[i:j], enc.encode(batch_texts[i:j])), i):
                    buf = np.frombuffer(text.encode(), dtype=np.uint8)
                    of = lengths[np.frombuffer(ids, dtype="<u4")]
                    if int(of.sum()) != len(buf):
                        raise ValueError("the tokenizer's ids do not spell the text: a byte-level vocabulary is needed")
                    starts = line_starts(buf)
                    tokens, crossing = allocate(of, starts, len(buf), rule)
                    chars = np.append(0, np.cumsum((buf & 0xC0) != 0x80))
                    n = len(starts)
                    for c, v in zip(cols, (np.full(n, x), np.arange(n), chars[starts], chars[np.append(starts[1:], len(buf))],
                                           tokens, crossing, np.full(n, len(of)))):
                        c.append(v)
                rows, section, start, end, tokens, crossing, total = (np.concatenate(c) for c in cols)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(rows)), pa.array(section.astype(np.int32)), pa.array(start.astype(np.int64)),
                     pa.array(end.astype(np.int64)), pa.array(tokens.astype(float)), pa.array(crossing.astype(np.int64)),
                     pa.array(total.astype(np.int64))],
                    ["doc_id", "section", "start", "end", "tokens", "n_crossing", "doc_tokens"])

    return texts(docs).mapInArrow(run, SCHEMA)
