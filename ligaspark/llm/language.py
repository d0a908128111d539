"""Language ID by cross-parsing: suffix automata of labelled text per language, the fewest normalised phrases win.

A suffix automaton of a language's sample knows every substring of it. A text is parsed from left to right into the longest phrases that occur in the sample;
a text in the same language needs fewer of them. Phrases times log2 of the sample's length, over the text's length, estimates the cross entropy in bits per
symbol, which makes languages with samples of different lengths comparable.

Symbols are bytes of the lower-cased text: a to z, one symbol for any run of other ASCII, and the ``high_symbols`` commonest bytes of 0x80 and above in the
samples (one more symbol for the rest). Texts are parsed whole. For speed a text is parsed in stretches of ``stretch`` symbols side by side, each as if a phrase
began with it; then each stretch is parsed again from the state in which the one before really ends, up to the symbol where both parses are in the same state
and so agree from there on. What is counted is the parse of the whole text from its first symbol: no phrase is cut.

Fitting takes at most ``docs_per_language`` labelled texts per language, spread by hash, and of them as many whole texts as ``sample_bytes`` hold; a text of more
than ``text_bytes`` is taken only where its hash bucket has no shorter one, and then gives pieces from all over it. All bounds are parameters. Languages come in
blocks of ``languages_per_block``, each a table of its own; where there are several, a worker loads one after another, so any number of languages is told apart
in the memory of one block.

Null texts and texts without a letter: ``und`` with score 0. No labelled text at all: every text is ``und``. Ties go to the language that sorts first. Repeated rows
each give their row; for fitting, rows that share id and language count once, by the smallest text. Only the columns named are read, so no other can clash. An
empty table gives no rows, and fits a model without languages.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import buffer_of
from .common import bounded_sample, filter_text, held, map_text, remainder, with_ids

DOCS_PER_LANGUAGE = 64
SAMPLE_BYTES = 65_536
TEXT_BYTES = 1_024
HIGH_SYMBOLS = 60
STRETCH = 256
PIECE = 64  # bytes of a text that go into a sample together
LANGUAGES_PER_BLOCK = 12
_TOGETHER = 8  # languages whose parses are held at once
_ROUNDS = 6  # of parsing stretches again side by side; what is left is parsed symbol by symbol
_ASCII_LETTER = re.compile("[A-Za-z]")


class SuffixAutomaton:
    """Online construction (Blumer et al. 1985): states are classes of substrings with the same end positions."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def extend(self, c: int) -> None:
        now = len(self.next)
        self.next.append({})
        self.length.append(self.length[self.last] + 1)
        self.link.append(0)
        p = self.last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = now
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            if self.length[q] == self.length[p] + 1:
                self.link[now] = q
            else:
                twin = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                while p >= 0 and self.next[p].get(c) == q:
                    self.next[p][c] = twin
                    p = self.link[p]
                self.link[q] = self.link[now] = twin
        self.last = now


@dataclass
class Model:
    languages: list[str]
    classes: np.ndarray  # byte -> symbol
    n_symbols: int
    table: np.ndarray  # (state base + symbol) -> next state base * 2 + (1 if a new phrase begins)
    roots: np.ndarray  # state base of each language's beginning
    bits: np.ndarray  # log2 of each sample's length
    stretch: int = STRETCH

    def phrases(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(languages, texts) counts of phrases, and each text's number of symbols."""
        low = pa.array([(t or "").lower() for t in texts.to_pylist()], pa.large_string())
        raw, offsets = buffer_of(low)
        symbols = self.classes[raw]
        keep = np.ones(len(symbols), dtype=bool)
        if len(symbols) > 1:
            keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
            keep[offsets[:-1][offsets[:-1] < len(symbols)]] = True
        at = np.concatenate([[0], np.cumsum(keep)])[offsets]
        symbols = symbols[keep]
        n = np.diff(at)
        pieces = -(-n // self.stretch)
        owner = np.repeat(np.arange(len(n)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = at[owner] + number * self.stretch
        length = np.minimum(self.stretch, at[owner + 1] - start)
        order = np.argsort(-length, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        before = np.where(number > 0, place[np.arange(len(owner)) - 1], -1)[order] if len(owner) else np.zeros(0, np.int64)
        start, length, owner = start[order], length[order], owner[order]
        out = np.zeros((len(self.languages), len(n)), dtype=np.int64)
        for a in range(0, len(self.languages) if len(owner) else 0, _TOGETHER):
            count = self._parse(self.roots[a : a + _TOGETHER], symbols, start, length, before)
            for i in range(len(count)):
                out[a + i] = np.bincount(owner, weights=count[i], minlength=len(n))
        return out, n

    def _parse(self, roots: np.ndarray, symbols: np.ndarray, start: np.ndarray, length: np.ndarray, before: np.ndarray) -> np.ndarray:
        """(roots, stretches) phrases that begin in each stretch. Stretches come longest first; ``before`` is the one that precedes in the text, or -1."""
        lanes, top = len(start), int(length[0])
        count = np.zeros((len(roots), lanes), dtype=np.int32)
        state = np.repeat(roots[:, None], lanes, axis=1)
        states, counts = np.empty((top, len(roots), lanes), np.int32), np.empty((top, len(roots), lanes), np.int16)
        active = np.searchsorted(-length, -np.arange(1, top + 1), side="right")
        for step, k in enumerate(active.tolist()):
            moved = self.table[state[:, :k] + symbols[start[:k] + step]]
            count[:, :k] += moved & 1
            state[:, :k] = moved >> 1
            states[step, :, :k], counts[step, :, :k] = state[:, :k], count[:, :k]
        after = np.full(lanes, -1)
        after[before[before >= 0]] = np.flatnonzero(before >= 0)
        total, end = count.copy(), state.copy()
        lang, lane = (x.ravel() for x in np.meshgrid(np.arange(len(roots)), np.flatnonzero(before >= 0), indexing="ij"))
        for _ in range(_ROUNDS):
            if not len(lane):
                return total
            was = end[lang, lane]
            now, began = end[lang, before[lane]], np.zeros(len(lane), dtype=np.int32)
            going = np.arange(len(lane))
            for step in range(top):
                going = going[length[lane[going]] > step]
                if not len(going):
                    break
                g, x = lang[going], lane[going]
                moved = self.table[now[going] + symbols[start[x] + step]]
                began[going] += moved & 1
                now[going] = moved >> 1
                met = now[going] == states[step, g, x]
                done = going[met]
                began[done] += count[g[met], x[met]] - counts[step, g[met], x[met]]
                now[done] = state[g[met], x[met]]
                going = going[~met]
            total[lang, lane], end[lang, lane] = began, now
            changed = (now != was) & (after[lane] >= 0)
            lang, lane = lang[changed], after[lane[changed]]
        table, letters = memoryview(self.table), symbols.tobytes()
        for g, x in sorted(zip(lang.tolist(), lane.tolist(), strict=True), key=lambda p: (p[0], start[p[1]])):
            while x >= 0:
                s, n = int(end[g, before[x]]), 0
                for c in letters[start[x] : start[x] + length[x]]:
                    m = table[s + c]
                    n += m & 1
                    s = m >> 1
                total[g, x] = n
                if s == end[g, x]:
                    break
                end[g, x] = s
                x = int(after[x])
        return total

    def two_best(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the best language, its entropy and that of the next one (infinite if there is none)."""
        counts, n = self.phrases(texts)
        entropy = counts * self.bits[:, None] / np.maximum(n, 1)
        best = np.argmin(entropy, axis=0)
        second = np.partition(entropy, 1, axis=0)[1] if len(self.languages) > 1 else np.full(len(n), np.inf)
        return best, entropy[best, np.arange(len(n))], second

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        return predict([self], texts)


def predict(blocks, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text by models that come in the order of their languages, one held at a time."""
    plain = texts.to_pylist()
    names = np.full(len(plain), "und", dtype=object)
    first, second, seen = np.full(len(plain), np.inf), np.full(len(plain), np.inf), 0
    for m in blocks:
        if not m.languages or not len(plain):
            continue
        best, e1, e2 = m.two_best(texts)
        better = e1 < first
        second = np.where(better, np.minimum(first, e2), np.minimum(second, e1))
        names[better] = np.array(m.languages, dtype=object)[best[better]]
        first, seen = np.where(better, e1, first), seen + len(m.languages)
    lettered = np.array([bool(t) and bool(_ASCII_LETTER.search(t) or any(map(str.isalpha, t))) for t in plain], dtype=bool)
    if seen > 1:
        score = np.where((second > 0) & np.isfinite(second), 1 - first / np.maximum(second, 1e-12), 0.0)
    else:
        score = np.full(len(plain), float(seen))
    names[~lettered] = "und"
    return names.tolist(), np.where(lettered, np.clip(score, 0.0, 1.0), 0.0)


def spread(text: bytes, room: int) -> list[bytes]:
    """At most ``room`` bytes of a text, separators included: all of it, or pieces from hashed positions, one in each of equal stretches of the whole text."""
    if len(text) <= room:
        return [text]
    size = min(PIECE, room)
    if not size:
        return []
    n, seed, out = (room + 1) // (size + 1), zlib.crc32(text), []
    for j in range(n):
        a, z = j * len(text) // n, (j + 1) * len(text) // n
        a += zlib.crc32(b"%d" % j, seed) % (z - a - size + 1)
        out.append(text[a : a + size])
    return out


def build(samples: dict[str, list[str]], sample_bytes: int = SAMPLE_BYTES, high_symbols: int = HIGH_SYMBOLS, stretch: int = STRETCH) -> Model:
    """Automata from labelled texts: whole ones in order of a hash, as many as fit; if none does, pieces from all over the first."""
    raw: dict[str, bytes] = {}
    for lang in sorted(samples):
        texts = sorted({t.lower().encode() for t in samples[lang] if t}, key=lambda t: (zlib.crc32(t), t))
        parts, left = [], sample_bytes
        for t in texts:
            if len(t) <= left:
                parts.append(t)
                left -= len(t) + 1
        parts = parts or spread(texts[0], sample_bytes) if texts else []
        if any(parts):
            raw[lang] = b"\n".join(parts)
    common = Counter(b for t in raw.values() for b in t if b >= 128)
    classes = np.zeros(256, dtype=np.uint8)
    classes[97:123] = np.arange(1, 27)
    classes[128:] = 27
    for i, (b, _) in enumerate(sorted(common.items(), key=lambda x: (-x[1], x[0]))[:high_symbols]):
        classes[b] = 28 + i
    n_symbols = int(classes.max()) + 1
    tables, roots, bits, base = [], [], [], 0
    for text in raw.values():
        symbols = classes[np.frombuffer(text, np.uint8)]
        symbols = symbols[np.concatenate([[True], (symbols[1:] != 0) | (symbols[:-1] != 0)])]
        automaton = SuffixAutomaton()
        for c in symbols.tolist():
            automaton.extend(c)
        n = len(automaton.next)  # one more state, in which nothing is matched: every text begins in it, and an unknown symbol leads to it
        moves = np.full((n + 1, n_symbols), -1, dtype=np.int64)
        for state, to in enumerate(automaton.next):
            for c, t in to.items():
                moves[state, c] = t
        fresh = np.where(moves[0] < 0, n, moves[0])
        flat = np.where(moves >= 0, (moves * n_symbols + base) * 2, (fresh * n_symbols + base)[None, :] * 2 + 1)
        tables.append(flat.ravel())
        roots.append(base + n * n_symbols)
        bits.append(np.log2(max(2, len(symbols))))
        base += flat.size
    if base >= 1 << 30:
        raise ValueError("the samples are too large for 32-bit tables; lower sample_bytes")
    table = np.concatenate(tables).astype(np.int32) if tables else np.zeros(0, np.int32)
    return Model(list(raw), classes, n_symbols, table, np.array(roots, np.int32), np.array(bits), stretch)


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, languages_per_block: int = LANGUAGES_PER_BLOCK, text_bytes: int = TEXT_BYTES, id_col: str = "doc_id", text: str = "text", lang: str = "lang", **how) -> list[Model]:
    """Models of blocks of languages, in order, from rows with a text and a label; the driver holds the samples of one block at a time."""
    body = F.col(f"`{text}`")
    known = docs.where(body.isNotNull() & F.col(f"`{lang}`").isNotNull())
    ids = bounded_sample(known.select(id_col, lang, (F.octet_length(body) > text_bytes).alias("_long")), docs_per_language, id_col, group=lang, seed=8, last="_long")
    languages = sorted({g for g, _ in ids})
    room = text_bytes

    def cut(t):
        raw = t.lower().encode()
        return t if len(raw) <= room else b"\n".join(spread(raw, room)).decode("utf-8", "ignore")

    pieces = F.udf(cut, "string")  # where the text is, so the driver has no long ones
    out = []
    for a in range(0, len(languages), languages_per_block):
        some = set(languages[a : a + languages_per_block])
        rows = with_ids(known.select(id_col, text, lang), sorted({i for g, i in ids if g in some}), id_col)
        rows = rows.where(F.col(lang).isin(*some)).groupBy(id_col, lang).agg(F.min(pieces(body)).alias("t"))
        samples: dict[str, list[str]] = {}
        for r in rows.collect():
            samples.setdefault(r[lang], []).append(r["t"])
        out.append(build(samples, **how))
    return out


def train_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that labels may be learned from: crc32 of the id modulo 3 is not 1."""
    return docs.where(remainder(F.col(id_col), 3) != 1)


def _predictor(docs: DataFrame, models: list[Model]):
    sent = [docs.sparkSession.sparkContext.broadcast(m) for m in models]
    return lambda texts: predict(held(sent), texts)


def identify(docs: DataFrame, models: list[Model], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred string, score double), a row per row."""
    told = _predictor(docs, models)

    def make():
        def f(texts):
            names, score = told(texts)
            return [pa.array(names, pa.string()), pa.array(score, pa.float64())]

        return f

    return map_text(docs, make, "lang_pred string, score double", text=text, carry=(id_col,))


def keep_languages(docs: DataFrame, models: list[Model], allowed: tuple[str, ...] | None = None, text: str = "text") -> DataFrame:
    """Rows whose predicted language is in ``allowed`` (None: any that was learned); ``und`` goes."""
    told = _predictor(docs, models)

    def make():
        return lambda texts: [n != "und" and (allowed is None or n in allowed) for n in told(texts)[0]]

    return filter_text(docs, make, text)
