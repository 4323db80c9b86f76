"""Documents with everything that may go wrong, and helpers of the tests beside it."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("the of and reading river Stone clown élan größer 中文 x, y.").strip() or "a" if rng.random() < 0.1 else f"w{rng.randrange(900)}" for _ in range(n))


def rows() -> list[tuple]:
    base = prose(1, 300)
    words = base.split()
    near = " ".join(words[:120] + ["changed"] + words[121:])
    far = " ".join(words[:150]) + " " + prose(2, 150)
    texts = [
        (0, None), (1, ""), (2, " \n\t\x0b "), (3, "one two three"), (4, "One two three"), (5, base), (6, base), (7, near), (8, far),
        (9, prose(3, 6000)), (10, "\x00​  zero width ﻿"), (11, "a"), (12, "b b b b b b b b b b b b"),
        (12, "b b b b b b b b b b b b"), (13, base.upper()), (None, base), (None, prose(4, 40)), (14, "line\nline\r\nline  two   spaces   "),
        (15, prose(5, 80)), (16, prose(5, 80) + " end"), (-3, prose(6, 50)), (2**40, prose(7, 50)), (17, "▁ <s> </s> <|endoftext|> <0x0A> don't"),
    ]
    sources = ["a", "b", None, "ä", "A"]
    return [(i, t, None if k % 4 == 0 else "en", sources[k % 5], None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


def documents(spark, extra: bool = False):
    made = spark.createDataFrame(rows(), SCHEMA)
    if not extra:
        return made
    # Names that operators might use themselves.
    for name in ("score", "class", "size", "rank", "target", "draw", "copy", "ids", "decoded", "root", "sketch", "slice", "word", "n", "region"):
        made = made.selectExpr("*", f"'kept' AS `{name}`")
    return made


def empty(spark, schema: str = SCHEMA):
    return spark.createDataFrame([], schema)


def words(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text: str | None) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
