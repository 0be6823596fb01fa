"""Hand-made tables with awkward rows, and reference helpers."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, _id string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def random_text(rng, n, vocabulary=60):
    return " ".join(rng.choice("ba ce di fo gu ka le mi no pu".split()) + str(rng.randrange(vocabulary)) for _ in range(n))


def doc_rows(seed=1, n=60):
    """Copies, near copies, a shared passage, nulls, short, empty and one long text; columns that clash with helper names."""
    rng = random.Random(seed)
    base, passage = random_text(rng, 120), random_text(rng, 70)
    texts = [random_text(rng, rng.randrange(5, 150)) for _ in range(n)]
    for i in range(0, n, 6):
        edited = base.split()
        for _ in range(rng.randrange(1, 4)):
            edited[rng.randrange(len(edited))] = "edit" + str(rng.randrange(99))
        texts[i] = " ".join(edited)
    for i in range(1, n, 7):
        texts[i] = texts[i] + " " + passage + " " + random_text(rng, 9)
    texts[2] = texts[8] = texts[14] = texts[3]
    texts += [None, "", " \t\n", "Solo", "Eins Zwei", "one two three four", random_text(rng, 6000), "né Ñandú " * 20, "x" * 400, "x" * 400]
    return [(i, t, "en", ("b", "a", None)[i % 3], i, i, "z") for i, t in enumerate(texts)]


def docs(spark, rows=None, parts=3):
    return spark.createDataFrame(doc_rows() if rows is None else rows, COLUMNS).repartition(parts)
