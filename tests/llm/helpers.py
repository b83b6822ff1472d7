from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, dk string, fp int, part int, rate double, lang string, source string"


def documents(spark, rows):
    """Rows of (doc_id, text) as a table with further columns whose names clash with those that operators make."""
    return spark.createDataFrame([(i, t, "x", 1, 2, 3.0, None if n % 7 == 0 else "en", None if n % 5 == 0 else f"s{n % 3}") for n, (i, t) in enumerate(rows)], DOCS).repartition(3)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0d]+", lower(text or ""))


def corpus(seed: int = 1, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Documents with shared passages, copies, near copies, nulls, empty and very long texts and a repeated row."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefgé", k=r.randint(2, 7))) for _ in range(200)]
    say = lambda k: " ".join(r.choices(vocabulary, k=k))
    passages = [say(r.randint(15, 50)) for _ in range(6)]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(n):
        rows.append((i, " ".join(r.choice(passages) if r.random() < 0.4 else say(r.randint(2, 30)) for _ in range(r.randint(1, 6)))))
    long = say(4000)
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, rows[3][1]), (903, rows[3][1]), (904, long), (905, long + " end"), (None, passages[0]), (906, "a" * 400), (907, "One TWO"), (908, "x")]
    return rows
