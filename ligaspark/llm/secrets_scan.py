"""Secret scan: an Aho-Corasick keyword prefilter, anchored regular expressions only near its hits, then validation of embedded checksums.

All patterns are ASCII, so texts are scanned as UTF-8 bytes and only the ends of what is found are turned into code points.

Base kinds, each leftmost and non-overlapping, matches that fail the length dropped: ``assign`` (a keyword, a separator, and a value of 8 characters or more),
``access`` (AKIA and more, 16 or more in all), ``hex`` (a run of 32 or more of 0-9 and a-f). A run has no keyword; it is found by a pattern that skips ahead
to runs of the full length. The other kinds are added by rules whose keyword gates them and whose checksum or structure must hold:

* ``github``, ``npm``: the last 6 characters are the base-62 CRC-32 of the part before (36 characters after the prefix);
* ``jwt``: three base64url parts, the first of which decodes to a JSON object with "alg" (a first part of more than ``JWT_HEAD`` characters is none);
* ``iban``: after the keyword IBAN, a number that is 1 modulo 97 by ISO 13616;
* ``card``: after a keyword of card numbers, 13 to 19 digits that pass the Luhn sum;
* ``pem``: a private key's header line;
* ``google``, ``slack``, ``stripe``: fixed prefixes and lengths.

Null and empty texts have no spans. Repeated rows each give their row. Of overlapping matches of one kind the one that begins first counts, and rules of other
kinds do not suppress it; spans that begin alike come in the order of kinds. A text of any length is scanned whole, in one pass and in linear time: every
pattern is bounded, or consumes what it matches, or (``jwt``) remembers how far a run reaches. Columns besides id and text are not read, so their names
cannot clash. Empty tables give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text

ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "iban", "card", "pem", "google", "slack", "stripe")
JWT_HEAD, JWT_LEAST = 1_024, len('{"alg":0}') * 4 // 3
_JWT_RUN, _JWT_TAIL = re.compile(rb"[0-9A-Za-z_-]+"), re.compile(rb"\.[0-9A-Za-z_-]+\.[0-9A-Za-z_-]+")
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_tail(body: bytes) -> bytes:
    """Six base-62 digits of the CRC-32 of ``body``."""
    v, out = zlib.crc32(body), b""
    for _ in range(6):
        v, r = divmod(v, 62)
        out = _BASE62[r : r + 1] + out
    return out


def _crc_ok(m: re.Match) -> bool:
    body = m.group(1)
    return _crc_tail(body[:-6]) == body[-6:]


def _jwt_ok(head: bytes) -> bool:
    if not JWT_LEAST <= len(head) <= JWT_HEAD:
        return False
    try:
        raw = base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4))
        return (b'"alg"' in raw or b"\\u" in raw) and "alg" in json.loads(raw)  # most hits are not worth parsing
    except (ValueError, TypeError):
        return False


def _iban_ok(m: re.Match) -> bool:
    s = m.group(1).replace(b" ", b"").decode()
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _luhn_ok(m: re.Match) -> bool:
    digits = [c - 48 for c in m.group(1) if 48 <= c <= 57]
    if not 13 <= len(digits) <= 19:
        return False
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0


#: kind -> (keywords in lower case, pattern that must match where the keyword begins, group that is the span, check of a match)
RULES: dict[str, tuple] = {
    "github": ((b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"), re.compile(rb"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"), 0, _crc_ok),
    "npm": ((b"npm_",), re.compile(rb"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"), 0, _crc_ok),
    "jwt": ((b"eyj",), None, 0, None),  # see Jwt
    "iban": ((b"iban",), re.compile(rb"(?i:iban)[ :=]{1,4}([A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]){11,30})(?![0-9A-Za-z])"), 1, _iban_ok),
    "card": ((b"card", b"visa", b"mastercard", b"credit"), re.compile(rb"(?i:credit card|credit|mastercard|visa|card)(?i:[ _-]?(?:number|no\.?|num))?[ :=#]{1,4}([0-9](?:[ -]?[0-9]){12,18})(?![0-9])"), 1, _luhn_ok),
    "pem": ((b"-----begin",), re.compile(rb"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----"), 0, None),
    "google": ((b"aiza",), re.compile(rb"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])"), 0, None),
    "slack": ((b"xox",), re.compile(rb"xox[abprs]-[0-9A-Za-z-]{10,}"), 0, None),
    "stripe": ((b"sk_live_", b"rk_live_"), re.compile(rb"[rs]k_live_[0-9A-Za-z]{24,}"), 0, None),
}
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_LONGEST = max(len(w) for w in (*_ASSIGN_WORDS, *[w for r in RULES.values() for w in r[0]]))


def automaton() -> ahocorasick.Automaton:
    """All keywords over the lower-cased bytes, each byte read as the Latin-1 character of its number."""
    kinds: dict[bytes, list[str]] = {}
    for kind, words in [("assign", _ASSIGN_WORDS), ("access", (b"akia",)), *[(k, r[0]) for k, r in RULES.items()]]:
        for w in words:
            kinds.setdefault(w, []).append(kind)
    a = ahocorasick.Automaton()
    for w, ks in kinds.items():
        a.add_word(w.decode("latin-1"), (len(w), tuple(ks)))
    a.make_automaton()
    return a


class Jwt:
    """Matches of ``eyJ``, more of its alphabet, and two further parts, found from any place of a run without reading the run again."""

    def __init__(self, text: bytes):
        self.text, self.stop, self.tail = text, -1, None

    def match(self, start: int) -> int | None:
        """The end of a match that begins at ``start``."""
        if not self.text.startswith(b"eyJ", start):
            return None
        if start >= self.stop:
            self.stop = _JWT_RUN.match(self.text, start).end()
            self.tail = _JWT_TAIL.match(self.text, self.stop)
        if self.tail is None or self.stop == start + 3 or not _jwt_ok(self.text[start : min(self.stop, start + JWT_HEAD + 1)]):
            return None
        return self.tail.end()


def hits(text: bytes, words: ahocorasick.Automaton):
    """(start, kinds) of all keywords, by start. The automaton gives them by end, so a few are held back until no later one can begin before them."""
    held: list = []
    for end, (n, kinds) in words.iter(text.lower().decode("latin-1")):
        while held and held[0][0] <= end - _LONGEST:
            yield heapq.heappop(held)
        heapq.heappush(held, (end - n + 1, kinds))
    while held:
        yield heapq.heappop(held)


def scan(text: bytes, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes, by start and then by kind as listed."""
    found: list[tuple[str, int, int]] = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    done, tokens = dict.fromkeys(KINDS, 0), Jwt(text)
    for start, kinds in hits(text, words):
        for kind in kinds:
            if start < done[kind]:
                continue
            if kind == "assign":
                m = ASSIGN.match(text, start)
                if m:
                    done[kind] = m.end()
                    if m.end(2) - m.start(2) >= 8:
                        found.append((kind, start, m.end()))
            elif kind == "access":
                m = ACCESS.match(text, start)
                if m:
                    done[kind] = m.end()
                    if m.end() - start >= 16:
                        found.append((kind, start, m.end()))
            elif kind == "jwt":
                end = tokens.match(start)
                if end is not None:
                    done[kind] = end
                    found.append((kind, start, end))
            else:
                _, pattern, group, check = RULES[kind]
                m = pattern.match(text, start)
                if m and (check is None or check(m)):
                    done[kind] = m.end()
                    found.append((kind, m.start(group), m.end(group)))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return found


def to_code_points(text: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    if not spans or text.isascii():
        return spans
    at = sorted({p for _, a, z in spans for p in (a, z)})
    points, done, seen = {}, 0, 0
    for p in at:
        seen += len(text[done:p].decode())
        done, points[p] = p, seen
    return [(k, points[a], points[z]) for k, a, z in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) in code points, end exclusive; a row per row."""

    def make():
        words = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

        def f(texts):
            out = []
            for t in texts.to_pylist():
                raw = (t or "").encode()
                out.append([{"kind": k, "start": a, "end": z} for k, a, z in to_code_points(raw, scan(raw, words))])
            return [pa.array(out, kind)]

        return f

    return map_text(docs, make, "spans array<struct<kind:string,start:int,end:int>>", text=text, carry=(id_col,))


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in spans).encode()).hexdigest()
