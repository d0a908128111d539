"""Small tables that hold every awkward case, and plain word splitters."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, size string, labels string"
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(_LOW))


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def prose(rng, n, pool="the of and to in is was for with on that by this ing tion er re ar en".split()):
    return " ".join(rng.choice(pool) + rng.choice(pool) for _ in range(n))


def frame(spark, rows):
    """documents with further columns whose names are those of results."""
    return spark.createDataFrame([(*r, 0.5, "x", "y", "z") for r in rows], SCHEMA)


def awkward(seed=1, n=30):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, other scripts."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 120)), rng.choice(["en", "de", None]), f"s{i % 3}", 5) for i in range(n)]
    rows += [(100, None, "en", "s0", None), (101, "", None, None, 0), (102, " \n\t ", "de", "s1", 3), (103, prose(rng, 30_000), "en", "s0", 9), (None, "no id at all here", "en", "s1", 2), (None, None, None, None, None)]
    rows += [rows[0], rows[0], (rows[1][0], "same id, other text", "en", "s0", 4), (104, "ÉCOLE Straße Ünï çödé 中文 字 😀 mit", "fr", "s9", 1), (105, "?!... --- ###", "en", "s2", 1)]
    return rows
