"""Small tables for the tests: NULLs, empty and long texts, ties, repeated rows, extra columns with clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, row long, `at` int, bucket int"
BENCH = "item_id long, text string, words string, n int"
LABELS = "doc_id long, quality int, toxic int"

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
SHORT_ITEM = "one two three"


def _words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 9))) for _ in range(n))


def texts() -> list[str | None]:
    rng = random.Random(5)
    base = _words(rng, 60)
    return [
        None, "", " \n\t ", "a", "Hello World", "x" * 30_000, _words(rng, 9_000), base, base, base.replace(" ", "  ", 1),
        base + " more", "Prefix words " + ITEM.upper() + ", and then " + _words(rng, 20), "one, two-three!", "naïve café 漢字 😀 \x00 end",
        "<|im_end|> <s> <|endoftext|> \\ <\\|", "line\r\n\r\nbreaks  and   spaces \n", ITEM[:40], "!!! ??? ...", _words(rng, 3), "a",
    ]


def documents(spark):
    rows = [(k, t, "en", "s", 0 if t is None else len(t), 0.5, 1, 2, 3, 4) for k, t in enumerate(texts())]
    rows += [rows[4], rows[4], (None, "no id", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
