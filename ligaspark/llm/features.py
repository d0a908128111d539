"""Statistics of a text for the quality classifier: lengths, shares of character classes, words and lines; computed for many texts at once on their bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .bytesops import IS_WORD, LOWER, buffer_of, per_text, runs, word_hashes

NAMES = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "longest_word", "upper", "digit", "space", "newline", "comma_period", "other_punct", "high", "bar",
    "hash", "bang", "repeated_punct", "distinct_words", "common_word_share", "short_words", "lines_log", "words_per_line", "distinct_lines", "upper_start", "top_line_share", "words_before_punct",
)


def _class(*ranges) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for r in ranges:
        out[list(r) if not isinstance(r, int) else r] = True
    return out


_UPPER, _DIGIT, _SPACE = _class(range(65, 91)), _class(range(48, 58)), _class(range(9, 14), 32)
_PERIOD = _class(ord(","), ord("."))
_PUNCT = _class(range(33, 48), range(58, 65), range(91, 97), range(123, 127))


def table(texts: pa.Array) -> np.ndarray:
    """(texts, len(NAMES)) float32; nulls are empty texts."""
    raw, offsets = buffer_of(texts)
    n, size = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((n, len(NAMES)), dtype=np.float32)
    if not n:
        return out
    low = LOWER[raw]
    word = IS_WORD[low]
    start, end = runs(word, offsets)
    first = np.searchsorted(start, offsets)
    words = np.diff(first)
    length = end - start
    by_bytes = lambda mask: per_text(mask, offsets)
    some_b, some_w = np.maximum(size, 1), np.maximum(words, 1)
    col = {}
    col["log_bytes"], col["log_words"] = np.log1p(size), np.log1p(words)
    mean = per_text(length, first) / some_w
    col["word_length"] = mean
    col["word_length_sd"] = np.sqrt(np.maximum(per_text(length * length, first) / some_w - mean * mean, 0))
    col["longest_word"] = _largest(length, first)
    letters = np.maximum(by_bytes(low >= 97), 1)
    col["upper"] = by_bytes(_UPPER[raw]) / letters
    for name, mask in (("digit", _DIGIT[raw]), ("space", _SPACE[raw]), ("newline", raw == 10), ("comma_period", _PERIOD[raw]), ("high", raw >= 128), ("bar", raw == 124), ("hash", (raw == 35) | (raw == 36) | (raw == 37) | (raw == 38) | (raw == 42)), ("bang", raw == 33)):
        col[name] = by_bytes(mask) / some_b
    punct = _PUNCT[raw] & ~_PERIOD[raw]
    col["other_punct"] = by_bytes(punct) / some_b
    again = np.zeros(len(raw), dtype=bool)
    if len(raw) > 1:
        again[1:] = punct[1:] & (raw[1:] == raw[:-1])
    col["repeated_punct"] = by_bytes(again) / some_b
    doc = np.repeat(np.arange(n), words)
    hashes = word_hashes(low, start, end)
    order = np.lexsort((hashes, doc))
    new = np.ones(len(order), dtype=bool)
    if len(order) > 1:
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    col["distinct_words"] = np.bincount(doc[order], weights=new, minlength=n) / some_w
    at = np.flatnonzero(new)
    runs_of = np.diff(np.append(at, len(order)))
    col["common_word_share"] = _group_max(runs_of, doc[order][at], n) / some_w
    col["short_words"] = per_text(length <= 3, first) / some_w
    col["upper_start"] = per_text(_UPPER[raw[start]], first) / some_w
    after = np.minimum(end, max(0, len(raw) - 1))
    col["words_before_punct"] = per_text((end < offsets[doc + 1]) & punct[after], first) / some_w
    ls, le = runs(raw != 10, offsets)
    lfirst = np.searchsorted(ls, offsets)
    lines = np.diff(lfirst)
    col["lines_log"], col["words_per_line"] = np.log1p(lines), words / np.maximum(lines, 1)
    lh, ldoc = word_hashes(low, ls, le), np.repeat(np.arange(n), lines)
    lorder = np.lexsort((lh, ldoc))
    lnew = np.ones(len(lorder), dtype=bool)
    if len(lorder) > 1:
        lnew[1:] = (lh[lorder][1:] != lh[lorder][:-1]) | (ldoc[lorder][1:] != ldoc[lorder][:-1])
    col["distinct_lines"] = np.bincount(ldoc[lorder], weights=lnew, minlength=n) / np.maximum(lines, 1)
    lat = np.flatnonzero(lnew)
    col["top_line_share"] = _group_max(np.diff(np.append(lat, len(lorder))), ldoc[lorder][lat], n) / np.maximum(lines, 1)
    for i, name in enumerate(NAMES):
        out[:, i] = col[name]
    return out


def _largest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _group_max(values, np.repeat(np.arange(len(first) - 1), np.diff(first)), len(first) - 1)


def _group_max(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Largest value of each group; ``group`` ascends; 0 for an absent one."""
    out = np.zeros(n, dtype=np.int64)
    if len(values):
        at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        out[group[at]] = np.maximum.reduceat(values, at)
    return out
