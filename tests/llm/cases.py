"""Small documents with the awkward cases, and brute-force forms of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = (
    "doc_id long, text string, source string, id long, row string, ids string, words string, size long, key string"
)
VOCABULARY = [a + b for a in "ka lo mi nu re sa to vu".split() for b in "ban der fil gos han jek".split()]


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(VOCABULARY) + str(draw.randrange(40)) for _ in range(words))


def documents() -> list[tuple]:
    base, passage = prose(1, 400), prose(2, 70)
    near = base.split()
    near[200] = "changed"
    texts = [
        None, "", "  \n\t ", "one", "One", "two words", base, base, base + " ", " ".join(near),
        prose(3, 40) + " " + passage + " " + prose(4, 30),
        prose(5, 10) + "\n" + passage.replace(" ", "\t", 5) + " " + prose(6, 90),
        passage, prose(7, 20_000), "again " * 300, "Ünïcode ▁ łódź 你好 \U0001f600\n\nline\r\nline\n\nline\x0bend",
        prose(8, 49), prose(8, 50), prose(8, 50) + " more", None, "x" * 5000,
    ]
    rows = [(i, t, ("a", "b", None)[i % 3], 7, "r", "i", "w", -1, "k") for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, base, "b", 7, "r", "i", "w", -1, "k")]
    # One id with several texts: a shorter one that shares a passage, null and empty.
    for number, text in ((13, prose(9, 5) + " " + passage), (13, "short"), (0, ""), (1, None), (15, base)):
        rows.append((number, text, "c", 7, "r", "i", "w", -1, "k"))
    return rows


CLASHING = "_id _kept_id _given _digest given digest number hash head salt kept text_key draw".split()


def frame(spark, rows=None):
    """The documents, with columns named as operators name theirs."""
    made = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    return made.withColumns({name: F.lit("x") for name in CLASHING})


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
