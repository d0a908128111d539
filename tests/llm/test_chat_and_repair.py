"""Chat formatting and structure repair against brute force."""

import hashlib
import itertools
import random
import re

import pytest

from ligaspark.llm import chat_format, queries, structure_repair

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, loss int, pos int, fault string"
PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[AND]", "[ROLE]", "[TEXT]", "[/ROLE]", "\\", "<", "[", "]", ">", "s>", "/", " ", "\n", "é", "😀", "$1", "INST]", "hello.", "no end", "<\\s>", "[\\\\INST]", "Wait!", "What?", ""]


def turns(spark, rows):
    """conversations with further columns whose names are those of results."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def awkward(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 7)):
            text = None if rng.random() < 0.05 else "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 6)))
            rows.append((c, None if rng.random() < 0.05 else t // rng.choice([1, 1, 1, 2]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "[ROLE]x\n", "", "us", None]), text))
    return rows + [rows[0], rows[0], (None, None, None, None), (None, 3, "user", "orphan"), (-5, 0, "assistant", "")]


def ordered(rows, null):
    """Rows by conversation, in order, nulls first."""
    out = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, null if r[2] is None else r[2], null if r[3] is None else r[3])):
        out.setdefault(c, []).append((t, null if r is None else r, null if x is None else x))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chats_read_back(spark, monkeypatch):
    rows = awkward(1)
    for stretch in (256, 3):
        monkeypatch.setattr(chat_format, "_STRETCH", stretch)
        chats = chat_format.format_conversations(turns(spark, rows))
        made = {r["conv_id"]: r for r in chats.collect()}
        read = {r["conv_id"]: r for r in chat_format.read_back(chats).collect()}
        want = ordered(rows, "")
        assert set(made) == set(read) == set(want)
        for c, ts in want.items():
            assert [(t["role"], t["text"]) for t in read[c]["turns"]] == [(r, x) for _, r, x in ts]
            assert read[c]["loss_text"] == "".join(x for _, r, x in ts if r == "assistant") and len(made[c]["loss"]) == sum(r == "assistant" for _, r, _ in ts)
            assert read[c]["formatted_chars"] == len(made[c]["formatted"])
            bare = made[c]["formatted"]
            blocks = [r for r, _ in itertools.groupby(r for _, r, _ in ts)]
            assert bare.count("</s>") == blocks.count("assistant") and bare.count("[INST]") == bare.count("[/INST]") == blocks.count("user")
            assert bare.count("[AND]") == len(ts) - len(blocks) and bare.count("[ROLE]") == sum(b not in chat_format.FORMS for b in blocks)
    assert chat_format.format_conversations(turns(spark, [])).count() == 0


def test_one_form_of_a_chat(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "a <s>"), (1, 2, "user", "b"), (1, 3, "assistant", "é"), (1, 4, "tool", "x")]
    got = chat_format.format_conversations(turns(spark, rows)).first()
    assert got["formatted"] == "<s><<SYS>>Be kind.<</SYS>>[INST] a <\\s>[AND]b [/INST]é</s>[ROLE]tool[TEXT]x[/ROLE]"
    raw = got["formatted"].encode()
    assert [raw[a:z].decode() for a, z in got["loss"]] == ["é"]


def test_long_and_large_chats(spark):
    """Texts of megabytes, and a conversation of many turns."""
    rows = [(1, 0, "user", "<\\" * 1_000_000), (1, 1, "assistant", "[INST]" * 500_000), (1, 2, "user", "<s" + "\\" * 2_000_000), (2, 0, "assistant", "<" + "\\" * 2_000_000 + "s>")]
    rows += [(3, t, "user" if t % 3 else "assistant", f"turn {t} </s>") for t in range(20_000)]
    read = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(turns(spark, rows))).collect()}
    for c, ts in ordered(rows, "").items():
        assert [(t["role"], t["text"]) for t in read[c]["turns"]] == [(r, x) for _, r, x in ts]
        assert read[c]["loss_text"] == "".join(x for _, r, x in ts if r == "assistant")


def run_query(spark, monkeypatch, name, rows):
    monkeypatch.setattr(queries, "table", lambda *a: turns(spark, rows))
    return {r[0]: r for r in queries.QUERIES[name](spark, "").collect()}


def test_op11(spark, monkeypatch):
    rows = awkward(2)
    got = run_query(spark, monkeypatch, "op11_chat", rows)
    want = ordered(rows + queries.TRAP, "")
    assert set(got) == set(want)
    for c, ts in want.items():
        loss = "".join(x for _, r, x in ts if r == "assistant")
        assert tuple(got[c])[1:5] == (len(ts), sha("".join(f"{r}\n{x}\n" for _, r, x in ts)), len(loss), sha(loss))


def damage(rows):
    import zlib

    out, convs = [], {r[0] for r in rows}
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if hit == 1 else re.sub("[.!?]", "", x) if hit == 2 else x
        out += [(c, t, "user" if hit == 4 else r, x)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out, convs


def faults(ts):
    seen, out = set(), []
    for _, r, x in ts:
        visible = re.sub("[\x20\x09-\x0d]", "", x)
        out.append("blank" if not visible else "duplicate" if (r, x) in seen else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((r, x))
    return out


_KNOWN = {}


def best_repair(ts):
    """(cost, audit, repaired) by trying everything, up to two insertions in a place."""
    kinds, places = faults(ts), [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    key = tuple((r, x) for _, r, x in ts)
    if key in _KNOWN:
        return _KNOWN[key]
    best = None
    own = [[("D", 2, None)] + ([] if f in ("blank", "duplicate") else [("K", 5 * (f == "truncated"), r)] + [("R", 1 + 5 * (f == "truncated"), q) for q in ("user", "assistant")]) for f, (_, r, _) in zip(kinds, ts, strict=True)]
    for edits in itertools.product(*own):
        for ins in itertools.product(places, repeat=len(ts) + 1):
            cost = sum(e[1] for e in edits) + 5 * sum(map(len, ins))
            if best and cost > best[0]:
                continue
            audit, roles, lines = "", "", []
            for k in range(len(ts) + 1):
                for r in ins[k]:
                    audit, roles, lines = audit + "I", roles + r[0], [*lines, f"{r}:"]
                if k < len(ts):
                    audit += edits[k][0]
                    if edits[k][2] is not None:
                        roles, lines = roles + (edits[k][2][:1] or "-"), [*lines, f"{edits[k][2]}:{ts[k][2]}"]
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(lines))
    _KNOWN[key] = best
    return best


def test_cheapest_repair_by_trying_all(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", "user", "assistant"]), rng.choice(["Yes.", "no end", "  ", "What?", "Yes."])) for c in range(48) for t in range(c % 4)]
    for stretch in (256, 1, 2):
        monkeypatch.setattr(structure_repair, "STRETCH", stretch)
        got = {r["conv_id"]: r for r in structure_repair.repair(turns(spark, rows)).collect()}
        for c, ts in ordered(rows, " ").items():
            r = got[c]
            assert (r["cost"], r["audit"], r["repaired"]) == best_repair(ts), ts


def plain_cost(ts):
    """The least cost by a table over states, for long conversations."""
    inf = 1 << 60
    cost = {"e": 0, "s": inf, "u": 5, "a": inf}
    for f, (_, r, _) in zip(faults(ts), ts, strict=True):
        extra = inf if f in ("blank", "duplicate") else 5 * (f == "truncated")
        k = lambda i: extra + (0 if r[:1] == i else inf)  # noqa: B023, E731
        o = min(cost["e"], cost["s"], cost["a"])
        cost = {"e": cost["e"] + 2, "s": min(cost["s"] + 2, cost["e"] + k("s")), "u": min(cost["u"] + 2, o + min(k("u"), 1 + extra)), "a": min(cost["a"] + 2, cost["u"] + min(k("a"), 1 + extra))}
        cost["u"] = min(cost["u"], min(cost["e"], cost["s"], cost["a"]) + 5)
        cost["a"] = min(cost["a"], cost["u"] + 5)
    return min(cost["e"], cost["a"])


def valid(ts, cost, audit, repaired):
    """Whether the edits cost what they should, fit the rows and give the repaired text."""
    kinds, row, roles, lines, spent = faults(ts), 0, "", repaired.split("\n") if repaired else [], 0
    texts = []
    for letter in audit:
        if letter == "I":
            spent += 5
            texts.append("")
            continue
        spent += {"D": 2, "K": 0, "R": 1}[letter] + (5 if letter != "D" and kinds[row] == "truncated" else 0)
        assert letter == "D" or kinds[row] not in ("blank", "duplicate")
        if letter != "D":
            texts.append(ts[row][2])
        row += 1
    roles = "".join(x[0] for x in lines)
    return row == len(ts) and spent == cost and re.fullmatch("(s?(ua)+)?", roles) and [x.split(":", 1)[1] for x in lines] == texts


def test_long_conversations(spark):
    rng = random.Random(4)
    sizes = {1: 3_000, 2: 256, 3: 257, 4: 512, 5: 20_000}
    rows = [(c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[t % 2], f"t{rng.randint(0, n)}{rng.choice('.!?.. ')}") for c, n in sizes.items() for t in range(n)]
    for r in structure_repair.repair(turns(spark, rows)).collect():
        ts = ordered(rows, " ")[r["conv_id"]]
        assert r["cost"] == plain_cost(ts) and valid(ts, r["cost"], r["audit"], r["repaired"])
        assert (r["blank"], r["duplicate"], r["truncated"]) == tuple(faults(ts).count(f) for f in ("blank", "duplicate", "truncated"))


@pytest.mark.parametrize("seed", [5, 6])
def test_op13(spark, monkeypatch, seed):
    rows = [r for r in awkward(seed, 150) if r[0] is None or r[0] % 3 or r[1] in (0, 1)]
    got = run_query(spark, monkeypatch, "op13_repair", rows)
    left, convs = damage(rows)
    want = ordered(left, " ")
    assert set(got) == convs
    for c in convs:
        ts = want.get(c, [])
        r, at = got[c], [t for t, *_ in ts if t is not None]
        assert r["gaps"] == (max(at) - min(at) + 1 - len(set(at)) if at else 0)
        assert (r["blank"], r["duplicate"], r["truncated"]) == tuple(faults(ts).count(f) for f in ("blank", "duplicate", "truncated"))
        assert r["illegal"] == sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(ts))
        if len(ts) <= 2:
            cost, audit, text = best_repair(ts)
            assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, sha(text))
        assert r["cost"] == plain_cost(ts)
    assert run_query(spark, monkeypatch, "op13_repair", []) == {}
