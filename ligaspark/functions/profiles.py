"""Profiles of aligned sequences: how often each column holds A, C, G, T or a gap, and the alignment of two of them.

Columns are aligned by Needleman and Wunsch (1970) with the expected score of a letter drawn from each: 1 if they are the same, -1 if not, -1 for a letter against a
gap; a column's gaps weigh nothing. Shares are whole thousandths, so all scores are exact integers. For two single sequences this is plain global alignment.
Of equal scores a pair of columns goes before a gap in the second profile, and that before a gap in the first.
"""

from __future__ import annotations

import numpy as np

LETTERS = "ACGT-"
_CODE = np.full(256, 5, dtype=np.uint8)
for _k, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _k


def of_sequence(seq: str, n: int = 1) -> np.ndarray:
    """(columns, 5) counts of one sequence that occurs ``n`` times; other letters take a column and count for nothing."""
    codes = _CODE[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]
    return np.eye(6, dtype=np.int64)[codes][:, :5] * n


def merged(p: np.ndarray, np_: int, q: np.ndarray, nq: int) -> np.ndarray:
    """The profile of both, of ``np_`` and ``nq`` sequences."""
    fp, fq = (1000 * p[:, :4] + np_ // 2) // np_, (1000 * q[:, :4] + nq // 2) // nq
    op, oq = fp.sum(axis=1), fq.sum(axis=1)
    pair = 2 * (fp @ fq.T) - op[:, None] * oq[None, :]
    down, right = 1000 * op, np.concatenate([[0], np.cumsum(1000 * oq)])
    score = -right
    way = np.zeros((len(p) + 1, len(q) + 1), dtype=np.int8)
    way[0] = 2
    for i in range(1, len(p) + 1):
        diagonal, above = score[:-1] + pair[i - 1], score - down[i - 1]
        best = np.concatenate([above[:1], np.maximum(diagonal, above[1:])])
        now = np.maximum.accumulate(best + right) - right
        way[i] = np.where(now == above, 1, 2)
        way[i, 1:][now[1:] == diagonal] = 0
        score = now
    i, j, rows = len(p), len(q), []
    gap = np.array([0, 0, 0, 0, 1], dtype=np.int64)
    while i or j:
        w = 2 if not i else 1 if not j else way[i, j]
        rows.append((p[i - 1] if w != 2 else gap * np_) + (q[j - 1] if w != 1 else gap * nq))
        i, j = i - (w != 2), j - (w != 1)
    return np.array(rows[::-1], dtype=np.int64).reshape(-1, 5)
