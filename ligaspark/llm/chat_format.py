"""Chat formatting in Spark expressions: sorted turn structs, adjacent turns of one role merged, texts escaped, and a loss mask.

A conversation becomes one string. Its turns come by turn number (nulls first; ties by role and then text). Adjacent turns of one role are one block, whose texts
are joined by the mark ``[AND]``, so that reading back gives the turns as they were::

    <s><<SYS>>text<</SYS>>[INST] text [/INST]text</s>[INST] text[AND]text [/INST]...[ROLE]tool[TEXT]text[/ROLE]

``system``, ``user`` and ``assistant`` have the first three forms, every other role, exactly as it is spelled, the last. A control string inside a text or a
role's name gets a backslash after its first character, and so does one that already has backslashes there; taking one away gives the text back. No mark can
then arise but where the template puts it.

The loss mask is an array of spans of the formatted string, in bytes of its UTF-8 form: each assistant text once, in order, without marks.

A null role is the empty name, a null text is empty, a null conversation id is a conversation of its own, repeated rows are turns each. Only the four columns named
are read, so no other can clash. An empty table gives no rows. A conversation is a row of the result, so its turns meet in one task, once, and it has to be
shorter than Spark's 2 GB for a string; everything done to it is linear in its length, with sums of lengths taken over stretches of ``_STRETCH`` segments first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, AND, NAME, TEXT, NAME_END = "<s>", "[AND]", "[ROLE]", "[TEXT]", "[/ROLE]"
#: role -> what stands before and after its block.
FORMS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("", "</s>")}
LOSS_ROLE = "assistant"
#: What may follow ``<`` or ``[`` in a control string.
TAILS = r"/?s>|/?SYS>>|/?INST\]|AND\]|/?ROLE\]|TEXT\]"
_BLOCK = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\] .*? \[/INST\]|\[ROLE\].*?\[/ROLE\]|.*?</s>"
_STRETCH = 256


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*+(?:{TAILS}))", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*+(?:{TAILS}))", r"$1$2")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often, and inside whatever lambda, it is read: it is the variable of a lambda over an array of one."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sums(lengths: Column) -> Column:
    """The sums of the first, the first two, ... elements of an array of integers."""
    add = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    stretches = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _STRETCH).cast("int")), lambda k: F.slice(lengths, k * _STRETCH + 1, _STRETCH))
    within = F.transform(stretches, lambda s: F.aggregate(s, F.array(F.lit(0)), add))
    before = lambda w: F.aggregate(w, F.array(F.lit(0)), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + F.element_at(x, -1))))
    raised = lambda w, b: F.flatten(F.transform(w, lambda x, k: F.transform(F.slice(x, 2, F.size(x)), lambda y: y + F.get(b, k))))
    return bound(within, lambda w: bound(before(w), lambda b: raised(w, b)))


def _segments(role: Column, texts: Column) -> Column:
    """array<struct<s, loss>> of one block: what stands before it, its texts with marks between, what stands after."""
    piece = lambda s, loss=False: F.struct(s.alias("s"), F.lit(loss).alias("loss") if isinstance(loss, bool) else loss.alias("loss"))
    form = lambda i, other: F.coalesce(*[F.when(role == r, F.lit(marks[i])) for r, marks in FORMS.items()], other)
    loss = role == LOSS_ROLE
    inner = F.flatten(F.transform(texts, lambda x, i: F.when(i == 0, F.array(piece(x, loss))).otherwise(F.array(piece(F.lit(AND)), piece(x, loss)))))
    return F.concat(F.array(piece(form(0, F.concat(F.lit(NAME), escaped(role), F.lit(TEXT))))), inner, F.array(piece(form(1, F.lit(NAME_END)))))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, formatted string, loss array<struct<start int, end int>>), a row per conversation."""
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = turns.select(F.col(f"`{conv}`").alias("_conv"), F.struct(F.col(f"`{turn}`").alias("turn"), plain(role).alias("role"), plain(text).alias("text")).alias("_t"))
    got = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("_t")).alias("_t"))
    t, first = F.col("_t"), F.col("_first")
    role_at = lambda i: F.get(t, i)["role"]
    got = got.withColumn("_first", F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (role_at(i) != role_at(i - 1))))
    texts = lambda a, z: F.transform(F.slice(t, a + 1, z - a), lambda x: escaped(x["text"]))
    got = got.withColumn("_s", F.flatten(F.transform(first, lambda a, k: _segments(role_at(a), texts(a, F.coalesce(F.get(first, k + 1), F.size(t)))))))
    s = F.col("_s")
    got = got.select("_conv", "_s", F.transform(s, lambda x: F.octet_length(x["s"])).alias("_n"))
    got = got.select("_conv", "_s", "_n", running_sums(F.col("_n")).alias("_end"))
    spans = F.zip_with(F.arrays_zip(s, F.col("_n")), F.col("_end"), lambda x, e: F.when(x["_s"]["loss"], F.struct((e - x["_n"] + len(OPEN)).alias("start"), (e + len(OPEN)).alias("end"))))
    formatted = F.concat(F.lit(OPEN), F.array_join(F.transform(s, lambda x: x["s"]), ""))
    return got.select(F.col("_conv").alias(conv), formatted.alias("formatted"), F.filter(spans, lambda x: x.isNotNull()).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns that a formatted string holds, adjacent ones of one role apart as they were."""

    def turns(b: Column) -> Column:
        name = lambda: F.substring_index(F.substr(b, F.lit(len(NAME) + 1)), TEXT, 1)
        is_role = {"system": b.startswith(FORMS["system"][0]), "user": b.startswith(FORMS["user"][0])}
        other = b.startswith(NAME)
        role = F.when(is_role["system"], F.lit("system")).when(is_role["user"], F.lit("user")).when(other, unescaped(name())).otherwise(F.lit("assistant"))
        ends = lambda r: F.substr(b, F.lit(len(FORMS[r][0]) + 1), F.length(b) - len(FORMS[r][0]) - len(FORMS[r][1]))
        skip = F.length(name()) + len(NAME) + len(TEXT)
        body = F.when(is_role["system"], ends("system")).when(is_role["user"], ends("user")).when(other, F.substr(b, skip + 1, F.length(b) - skip - len(NAME_END))).otherwise(ends("assistant"))
        return F.transform(F.split(body, r"\[AND\]", -1), lambda x: F.struct(role.alias("role"), unescaped(x).alias("text")))

    return F.flatten(F.transform(F.regexp_extract_all(F.substr(formatted, F.lit(len(OPEN) + 1)), F.lit(_BLOCK), 0), turns))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, in order, with nothing between."""
    raw = formatted.cast("binary")
    return F.array_join(F.transform(loss, lambda x: unescaped(F.substring(raw, x["start"] + 1, x["end"] - x["start"]).cast("string"))), "")


def read_back(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns array<struct<role, text>>, loss_text string, formatted_chars long) from what :func:`format_conversations` made."""
    return chats.select(conv, read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))
