"""Awkward documents that every operator must take, and plain versions of what the operators count."""

from __future__ import annotations

import random
import re
from collections import Counter

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that the operators use inside.
    "digest string, row bigint, quality string, score double, shard int, rate double, found string, root string, kept boolean, "
    "lang_ string, key bigint, n bigint"
)
_EXTRA = ("d", 1, "q", 0.5, 3, 0.1, "f", "r", True, "x", 7, 9)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded_words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("aeiou") + pick.choice("lmnrst") for _ in range(pick.randint(1, 4))) for _ in range(n))


def rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, repeated rows, equal texts, clashing names."""
    base, long = prose(1, 120), prose(2, 20_000)
    near = " ".join([*base.split()[:60], "altered", *base.split()[61:]])
    texts = [
        (1, base, "en", "a"),
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, near, "en", "a"),
        (4, None, "en", "a"),
        (4, None, "en", "a"),
        (5, "", "en", "a"),
        (6, "", None, "a"),
        (7, " \t\n ", "en", None),
        (None, prose(3, 80), "en", "a"),
        (None, None, None, None),
        (8, long, "en", "a"),
        (9, prose(4, 200) + "\x01\x02\x00    größe naïve 漢字 " + base, None, "a"),
        (10, "one two three", "en", "a"),
        (11, "one two three", "de", "a"),
        (12, "\n".join(["same line here"] * 40), "en", "a"),
        (13, " ".join(["word"] * 200), "en", "a"),
    ]
    return [(i, t, lang, source, None if t is None else len(t), *_EXTRA) for i, t, lang, source in texts]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def base_counts(text: str | None) -> tuple:
    text = text or ""
    found = words(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    repeated = {i + j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(3)}
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)
