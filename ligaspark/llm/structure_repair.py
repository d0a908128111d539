"""Conversation structure repair: window-derived fault flags and a Spark SQL fold over sorted turns that finds the cheapest edits.

The rows of a conversation come by turn (nulls first; ties by role and then text). Each row's first fault counts: ``blank`` (nothing but white space),
``duplicate`` (role and text seen earlier), ``truncated`` (its last visible character is none of ``.!?``). The repaired roles have to read, by initials,
``(s?(ua)+)?``. Keep costs 0, Rerole (to user or assistant) 1, Delete 2 and is required for blank and duplicate rows, Insert (an empty user or assistant turn, anywhere)
5, and a truncated row that is not deleted adds 5. Of the cheapest repairs the one whose edits' initials are least counts.

The fold carries four structs of cost and edits, one for each state of the roles' automaton: nothing yet (e), after the system turn (s), after a user (u), after an
assistant (a); e and a are complete. A row moves each state by native ``least`` over structs; insertions follow every row. Two insertions in a row are never cheapest
(from e or a they lead back, from s deleting the system turn is cheaper), so one step of them is enough. Edits are kept as letters that tell roles: D, I and J
(insert user, assistant), K, R and S (rerole to them); as the letters before give the state, they sort as D, I, K, R do. Equal costs never have edits of which one
begins the other, so the least of sums is the sum of leasts.

Long conversations are folded in stretches of ``STRETCH`` rows from each of the four states; stretches are joined by the least over the state between, so edits are
not copied once per row. A conversation is a row of the result: its rows meet in one task by one shuffle, which windows and fold share.

Null roles and texts are one space. A null conversation id is a conversation. Repeated rows are duplicates. Only the columns named are read, so no other can clash.
An empty table gives no rows. With ``copies`` (a column: how often a row stands), a conversation whose rows all stand 0 times has zeros, no edits and an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chat_format import bound

STRETCH = 256
_NEVER = 1 << 40  # the cost of a state that cannot be reached
_SPACE = " \t\n\x0b\x0c\r"
_STATES = "esua"
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5


def _by(x: Column, cost, letter: str) -> Column:
    return F.struct((x["cost"] + cost).alias("cost"), F.concat(x["edits"], F.lit(letter)).alias("edits"))


def _step(acc: Column, row: Column) -> Column:
    """All four states after one row and, perhaps, one insertion."""
    extra = F.when(row["fault"] == "truncated", TRUNCATED).otherwise(0).cast("long")
    must = row["fault"].isin("blank", "duplicate")
    stay = F.when(must, F.lit(_NEVER)).otherwise(extra)
    keep = lambda initial: F.when(row["initial"] == initial, stay).otherwise(F.lit(_NEVER))
    e, s, u, a = (acc[k] for k in _STATES)
    open_ = F.least(e, s, a)
    moved = F.struct(
        _by(e, DELETE, "D").alias("e"),
        F.least(_by(s, DELETE, "D"), _by(e, keep("s"), "K")).alias("s"),
        F.least(_by(u, DELETE, "D"), _by(open_, keep("u"), "K"), _by(open_, stay + REROLE, "R")).alias("u"),
        F.least(_by(a, DELETE, "D"), _by(u, keep("a"), "K"), _by(u, stay + REROLE, "S")).alias("a"),
    )
    return bound(moved, _inserted)


def _inserted(m: Column) -> Column:
    e, s, u, a = (m[k] for k in _STATES)
    return F.struct(e.alias("e"), s.alias("s"), F.least(u, _by(F.least(e, s, a), INSERT, "I")).alias("u"), F.least(a, _by(u, INSERT, "J")).alias("a"))


def _begin(state: Column, stretch: Column) -> Column:
    at = lambda k: F.struct(F.when(state == k, F.lit(0)).otherwise(F.lit(_NEVER)).cast("long").alias("cost"), F.lit("").alias("edits"))
    plain = F.struct(*[at(k).alias(name) for k, name in enumerate(_STATES)])
    return F.when(stretch == 0, _inserted(plain)).otherwise(plain)


def _joined(acc: Column, fold: Column) -> Column:
    both = lambda q, k: F.struct((acc[_STATES[q]]["cost"] + F.get(fold, F.lit(q))[k]["cost"]).alias("cost"), F.concat(acc[_STATES[q]]["edits"], F.get(fold, F.lit(q))[k]["edits"]).alias("edits"))
    return F.struct(*[F.least(*[both(q, k) for q in range(4)]).alias(k) for k in _STATES])


def cheapest(rows: Column) -> Column:
    """struct<cost, edits> of an array of structs with ``initial`` and ``fault``."""
    last = F.floor((F.greatest(F.size(rows), F.lit(1)) - 1) / STRETCH).cast("int")
    states = lambda k: F.when(k == 0, F.array(F.lit(0))).otherwise(F.array(*[F.lit(q) for q in range(4)]))
    fold = lambda k, q: F.aggregate(F.slice(rows, k * STRETCH + 1, STRETCH), _begin(q, k), _step)
    folds = F.transform(F.sequence(F.lit(0), last), lambda k: F.transform(states(k), lambda q: fold(k, q)))
    whole = bound(folds, lambda f: F.aggregate(F.slice(f, 2, F.size(f)), F.get(F.get(f, F.lit(0)), F.lit(0)), _joined))
    return bound(whole, lambda w: F.least(w["e"], w["a"]))


def repaired(rows: Column, edits: Column) -> Column:
    """``role:text`` lines of the rows that stay and of inserted turns."""

    def line(letter: Column, row: Column) -> Column:
        made = {"I": F.lit("user:"), "J": F.lit("assistant:"), "K": F.concat(row["role"], F.lit(":"), row["text"]), "R": F.concat(F.lit("user:"), row["text"]), "S": F.concat(F.lit("assistant:"), row["text"])}
        return F.coalesce(*[F.when(letter == k, v) for k, v in made.items()])

    pieces = F.regexp_extract_all(edits, F.lit(r"[IJ]*[DKRS]|[IJ]+"), 0)  # one for each row, and one for what is inserted at the end
    return F.array_join(F.flatten(F.transform(pieces, lambda p, i: F.transform(F.split(p, ""), lambda letter: line(letter, F.get(rows, i))))), "\n")


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost longs, audit string, repaired string), a row per conversation.

    ``gaps`` counts turn numbers missing between the least and the greatest, ``illegal`` adjacent rows whose roles' initials are not su, ua or au.
    """
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    stands = F.explode_outer(F.array_repeat(F.lit(True), F.col(f"`{copies}`").cast("int"))) if copies else F.lit(True)
    rows = turns.select(F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").alias("turn"), plain(role).alias("role"), plain(text).alias("text"), stands.alias("_in")).repartition("_conv")
    order = ["turn", "role", "text"]
    seen, by = Window.partitionBy("_conv", "_in", "role", "text").orderBy("turn"), Window.partitionBy("_conv", "_in").orderBy(*order)
    bare = F.rtrim(F.col("text"), F.lit(_SPACE))
    initial = F.left("role", F.lit(1))
    fault = F.when(bare == "", "blank").when(F.row_number().over(seen) > 1, "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    rows = rows.withColumn("initial", initial).withColumn("fault", fault)
    pair = F.concat(F.lag("initial").over(by), F.col("initial"))
    rows = rows.withColumn("pos", F.row_number().over(by)).withColumn("illegal", F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)))
    rows = rows.withColumn("new", F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(by)))
    own = lambda c: F.when(F.col("_in"), c)
    total = lambda c: F.coalesce(F.sum(own(c.cast("long"))), F.lit(0)).cast("long")
    got = rows.groupBy("_conv").agg(
        F.sort_array(F.collect_list(own(F.struct("pos", "role", "text", "initial", "fault")))).alias("_rows"),
        F.coalesce(F.max(own(F.col("turn"))) - F.min(own(F.col("turn"))) + 1 - F.sum(own(F.col("new").cast("long"))), F.lit(0)).cast("long").alias("gaps"),
        *[total(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        total(F.col("illegal")).alias("illegal"),
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal"]
    got = got.select("_conv", "_rows", *counts, cheapest(F.col("_rows")).alias("_best"))
    edits = F.col("_best.edits")
    return got.select(F.col("_conv").alias(conv), *counts, F.col("_best.cost").alias("cost"), F.translate(edits, "JS", "IR").alias("audit"), repaired(F.col("_rows"), edits).alias("repaired"))
