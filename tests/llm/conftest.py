from __future__ import annotations

import random

import pytest

from kestrel.llm.common import ship_package


def _texts() -> list[tuple]:
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["an", "er", "io", "ña", "Th", "ß"]) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", ",", ".", "***"])
    make = lambda n: [word() for _ in range(n)]
    base, passage = make(300), make(70)
    rows = [(i, " ".join(make(rng.randint(1, 400)))) for i in range(20)]
    rows += [(20, None), (21, ""), (22, " \t\n "), (23, "one"), (24, "one two three four"), (None, "no id " + " ".join(base)), (25, "long " * 60_000)]
    rows += [(30 + i, " ".join(base)) for i in range(6)]  # copies, and below the same words with other blanks
    rows += [(40, "\n".join(base) + "  "), (41, " ".join(base[:290] + make(10))), (42, " ".join(make(60) + passage + make(60))), (43, " ".join(make(30) + passage + make(9)))]
    rows += [(44, "a b c d e f g"), (45, "a b c d e f g"), (46, "A B c d e f g"), (47, "x b c d e f g"), (48, " ".join(["that"] * 300))]
    rows += [(50, "Mail ann.b@mail.example.com or ANN.B@mail.example.com, +1 (743) 555-3824, card 4111 1111 1111 1111, Mr. John Smith, Mrs Anna Kern")]
    rows += [(51, "again ann.b@mail.example.com 743-555-3824 at 10.0.0.7; password=abc123def"), (30, " ".join(base)), (52, "x" * 90_000 + " tail")]
    rows += [(60 + i, "  ".join(["plain words only here"] * 30)) for i in range(3)]
    return rows


ROWS = _texts()


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, blanks, long texts, copies, ties, repeated rows, and columns with clashing names."""
    ship_package(spark)
    rows = [(i, t, None if t is None else "en", "src", len(t or ""), "x", 1) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, n int").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("1 = 0")
