"""Token ids in packed binary matrices: best-fit-decreasing packing with a segment tree over capacities.

Texts become token ids (a public byte-level BPE vocabulary, read once on the driver and sent to the workers: its size is fixed), each closed by ``eos``. A text
of more than ``seq_len`` ids is split, losslessly, into parts of ``seq_len`` and a rest. Within a window of at most ``window_tokens`` ids of one task, parts
go longest first into the row with the least room that still holds them; the row is found in a segment tree over the capacities 0 to ``seq_len``, in
log(seq_len) steps. Windows bound memory; nothing is shuffled, and a lost executor's task makes the same rows anew.

A result row is a matrix of at most ``rows`` rows: ``ids`` (little-endian, row by row, padded), ``cu_seqlens`` (cumulative segment lengths over the flattened
matrix, the padding at a row's end being a segment of its own), ``position_resets`` (offsets at which position ids begin again at 0), and per segment
``doc_ids`` (null: padding) and ``parts`` (number of the part in its text). Joining a text's parts in order gives its ids back.

Null and empty texts are a lone ``eos``. Null ids are kept as -1 in ``parts``'s sign: their segments have a null id and a part >= 0, padding has part -1.
Repeated rows each take their place. Parts of equal length keep their order. A very long text is encoded whole and split; its ids are held at once. Only id and text
are read, so no other column can clash. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, tokenizer_dir

SEQ_LEN = 2048
ROWS = 64
WINDOW_TOKENS = 1_000_000
#: How the public byte-level vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
EOS = 50256
#: What ``\\s`` of the pattern matches. Runs of so many are split off before the pattern sees them, as its look-ahead gives up on very long ones.
_LONG_SPACE = re.compile("[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
_SPACE_RULE = r"|\s+(?!\S)|\s+"


class Capacities:
    """Rows by free room: a segment tree over 0..most whose leaves hold stacks of row numbers."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.some = [0] * (2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, row: int) -> None:
        self.stacks[room].append(row)
        i = room + self.size
        while i:
            self.some[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The least room of at least ``need`` and a row that has it, removed; None if no row has so much."""
        i, some = need + self.size, self.some
        if not some[i]:
            while i > 1 and (i & 1 or not some[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if some[2 * i] else 2 * i + 1
        room = i - self.size
        row = self.stacks[room].pop()
        while i:
            some[i] -= 1
            i >>= 1
        return room, row


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of item numbers; every length is from 1 to ``capacity``. Ties keep the items' order."""
    tree = Capacities(capacity)
    rows: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            rows.append([i])
            room, row = capacity, len(rows) - 1
        else:
            room, row = found
            rows[row].append(i)
        if room > n:
            tree.put(room - n, row)
    return rows


def encoder(vocabulary: bytes, pattern: str = PATTERN):
    """text -> array of ids, for a file of base64 tokens and ranks; strings of special tokens are ordinary text.

    A pattern that ends in ``_SPACE_RULE`` takes a run of white space as one piece, but for its last character if more text follows, whatever is around it. So
    long runs are cut out and merged as the one piece that they are, and what is before and after is encoded by itself, with the same ids.
    """
    import tiktoken

    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in vocabulary.splitlines() if line)}
    made = lambda p: tiktoken.Encoding("own", pat_str=p, mergeable_ranks=ranks, special_tokens={})
    plain, whole = made(pattern), []

    def encode(text: str, disallowed_special: tuple = ()) -> np.ndarray:
        out, at = [], 0
        for m in _LONG_SPACE.finditer(text) if pattern.endswith(_SPACE_RULE) else ():
            end = m.end() if m.end() == len(text) else m.end() - 1
            if not whole:
                whole.append(made("(?s).+"))
            out.append(plain.encode_to_numpy(text[at : m.start()], disallowed_special=disallowed_special))
            out.append(whole[0].encode_to_numpy(text[m.start() : end], disallowed_special=disallowed_special))
            at = end
        out.append(plain.encode_to_numpy(text[at:] if at else text, disallowed_special=disallowed_special))
        return np.concatenate(out) if len(out) > 1 else out[0]

    return encode


def matrices(parts: list[np.ndarray], owners: list, numbers: list[int], seq_len: int, rows: int, pad: int, kind: type) -> Iterator[tuple]:
    packed = best_fit_decreasing(np.array([len(p) for p in parts], dtype=np.int64), seq_len)
    for a in range(0, len(packed), rows):
        part = packed[a : a + rows]
        ids = np.full((len(part), seq_len), pad, dtype=kind)
        ends, docs, nums = [0], [], []
        for r, items in enumerate(part):
            at = 0
            for i in items:
                ids[r, at : at + len(parts[i])] = parts[i]
                at += len(parts[i])
                ends.append(r * seq_len + at)
                docs.append(owners[i])
                nums.append(numbers[i])
            if at < seq_len:
                ends.append((r + 1) * seq_len)
                docs.append(None)
                nums.append(-1)
        yield len(part), ids.tobytes(), ends, ends[:-1], docs, nums


def pack(docs: DataFrame, vocabulary: str | None = None, pattern: str = PATTERN, seq_len: int = SEQ_LEN, rows: int = ROWS, eos: int = EOS, window_tokens: int = WINDOW_TOKENS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(n_rows int, seq_len int, token_bytes int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array, parts array<int>)."""
    spark = docs.sparkSession
    with open(vocabulary or f"{tokenizer_dir()}/byte_bpe_50k.tiktoken", "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    kind = np.uint16 if eos < 1 << 16 else np.uint32
    inner = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    own = inner.schema["id"].dataType
    fields = [("n_rows", T.IntegerType()), ("seq_len", T.IntegerType()), ("token_bytes", T.IntegerType()), ("ids", T.BinaryType()), ("cu_seqlens", T.ArrayType(T.IntegerType())), ("position_resets", T.ArrayType(T.IntegerType())), ("doc_ids", T.ArrayType(own)), ("parts", T.ArrayType(T.IntegerType()))]
    out = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(batches):
        encode = encoder(sent.value, pattern)
        parts, owners, numbers, held, id_type = [], [], [], 0, None

        def flush():
            for n, ids, ends, resets, docs_, nums in matrices(parts, owners, numbers, seq_len, rows, eos, kind):
                i32 = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int32()), pa.array([seq_len], pa.int32()), pa.array([np.dtype(kind).itemsize], pa.int32()), pa.array([ids], pa.binary()), pa.array([ends], i32), pa.array([resets], i32), pa.array([docs_], pa.list_(id_type)), pa.array([nums], i32)],
                    names=[n for n, _ in fields],
                )
            parts.clear(), owners.clear(), numbers.clear()
            pa.default_memory_pool().release_unused()

        for batch in batches:
            id_type = batch.column(0).type
            for some in pieces(batch, 1):
                for owner, t in zip(some.column(0).to_pylist(), some.column(1), strict=True):
                    ids = np.append(encode(t.as_py() or ""), eos).astype(kind)
                    for number, a in enumerate(range(0, len(ids), seq_len)):
                        parts.append(ids[a : a + seq_len])
                        owners.append(owner)
                        numbers.append(number)
                        held += len(parts[-1])
                        if held >= window_tokens:
                            yield from flush()
                            held = 0
        if parts:
            yield from flush()

    return inner.mapInArrow(run, out)


def unpack(row) -> dict:
    """{(doc_id, part): ids} of one result row, for readers and round-trip tests; padding is left out."""
    ids = np.frombuffer(row["ids"], dtype=np.uint16 if row["token_bytes"] == 2 else np.uint32)
    ends = row["cu_seqlens"]
    return {(d, p): ids[a:z] for a, z, d, p in zip(ends, ends[1:], row["doc_ids"], row["parts"], strict=False) if p >= 0}


def position_ids(row) -> np.ndarray:
    """Position of every id of one result row within its segment."""
    n = row["n_rows"] * row["seq_len"]
    resets = np.array(row["position_resets"], dtype=np.int64)
    return np.arange(n) - np.repeat(resets, np.diff(np.append(resets, n)))
