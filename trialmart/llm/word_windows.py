"""Substring dedup over words by super-k-mer partitioning.

Consecutive windows of 50 words that share a minimiser (the smallest hash of
their 8-word pieces) travel as one packed string to the minimiser's bucket.
There every word becomes a number (by its bytes), and sorting ranks of 1, 2, 4,
... 32 consecutive words gives exact classes of equal windows, without hashing.
The steps around it are those of :mod:`repeats`.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: a null or blank text has no
words and an empty remainder; a text of fewer than 50 words keeps all; a null
id is never smaller or larger than another, so its text is kept and removes
nothing; rows that repeat id and text are one document and get equal results;
texts under the same id do not remove from each other; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bytes_ import NOT_SPACE, tokens
from .repeats import WINDOW, find_repeats

GRAM = 8


def word_classes(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows per string, class of each window) for strings of words with single blanks."""
    starts, ends, counts = tokens(raw, np.concatenate([[0], np.cumsum(sizes)]), NOT_SPACE)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts),
                                             [None, pa.py_buffer(offsets), pa.py_buffer(raw[NOT_SPACE[raw]])])
    rank = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    span = 1
    while span < WINDOW:
        step = min(span, WINDOW - span)
        _, rank = np.unique(rank[:-step] * (int(rank.max()) + 1) + rank[step:], return_inverse=True)
        span += step
    windows = counts - WINDOW + 1
    begin = np.cumsum(counts) - counts
    at = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
    return windows, rank[at]


def _finish(with_text: bool):
    def finish(text: bytes, covered: np.ndarray | None) -> tuple:
        words = text.split()
        n = len(words)
        if covered is None:
            covered = np.array([[0, n]] if n >= WINDOW else [], np.int64).reshape(-1, 2)
        kept, at, gone = [], 0, 0
        for a, b in covered.tolist():
            kept += words[at:a]
            at, gone = b, gone + b - a
        rest = b" ".join(kept + words[at:])
        return n, gone, hashlib.sha256(rest).hexdigest(), *([rest.decode("utf-8", "ignore")] if with_text else [])
    return finish


def remove_repeated_words(docs: DataFrame, keep: list[str], *, id_col: str = "doc_id", text_col: str = "text",
                          with_text: bool = False) -> DataFrame:
    """``keep`` columns of every row with ``n_words``, ``n_removed``, ``kept_sha256`` and, ``with_text``, ``kept_text``."""
    out = T.StructType().add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    if with_text:
        out = out.add("kept_text", "string")
    return find_repeats(docs, kind="word", gram=GRAM, classes=word_classes, finish=_finish(with_text), out=out,
                        id_col=id_col, text_col=text_col, keep=keep)
