"""Awkward rows that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, chunk string, part int, row string"


def awkward():
    rng = random.Random(5)
    words = ["der", "the", "und", "and", "of", "Zeit", "time", "le", "été", "日本", "x" * 300, "Ⅷ", "a▁b"]
    long_ = " ".join(rng.choice(words) for _ in range(6000))
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(80))
    texts = [None, "", "  \t\n ", "one", "the the the the", long_, passage, "Before it. " + passage + " and after it",
             passage, " ".join(["same"] * 120), "x " + " ".join(["same"] * 120), "a b " * 200, "1234 -- 5678", "\u0000 nul", long_]
    rows = [(i, t, ["de", "en", None][i % 3], ["s1", "s2", None, "é"][i % 4], None if t is None else len(t),
             "clash", "clash", i, "clash") for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, passage, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None)]
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
