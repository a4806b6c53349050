"""Awkward documents for the tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts() -> list[str | None]:
    """Empty, wordless, very long, repeated and awkward texts."""
    pick = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    base = [" ".join(pick.choice(letters) + pick.choice(letters) for _ in range(150)) for _ in range(4)]
    out: list[str | None] = [
        None, "", " \n\t ", "one", "two words", "The END.", "a@b.c_d@e.f x@y..z", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255",
        "4111 1111 1111 1111 x 4111-1111-1111-1111-", "+1 (743) 555-3824 +12 +1 2", "éa@b.c 😀 a@b.c 1.2.3.4", "\x01a@b.c 4111\x011111",
        "9" * 3000 + " a@" + ".".join("b" * 2000) + " " + "a" * 20000 + "@", "the " * 90, "ab c ab d " * 40,
        "Licensed under the MIT licence!\nMore text here.", "© 2020 Some One\nReleased under the MIT License.", "SPDX-License-Identifier: MIT",
        "a  b c d", "tab\there  two \n\n three", "x<|endoftext|>y <|endoftext|> z", "Home | About | Contact | Help\nAll rights reserved.",
        " ".join(pick.choice(letters) + str(k % 97) for k in range(30000)),
    ]
    for k in range(40):
        part = pick.choice(base).split()
        if k % 4 == 0:
            part[pick.randrange(150)] = "changed"
        elif k % 4 == 1:
            part = part[pick.randrange(60) :][: pick.randrange(15, 80)] + [pick.choice(letters) for _ in range(30)]
        elif k % 4 == 2:
            del part[pick.randrange(150)]
        lines = [" ".join(part[i : i + 12]) for i in range(0, len(part), 12)]
        out.append("\n".join(lines) + "." * (k % 3))
    pick.shuffle(out)
    return out


def odd_rows() -> list[tuple]:
    sources = [None, "s1", "s2", "é", "Z"]
    return [(i, t, "en", sources[i % 5] if i % 7 else "s1", None if t is None else len(t)) for i, t in enumerate(odd_texts())]


def write(spark, folder, rows, schema=SCHEMA, name="documents") -> str:
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
