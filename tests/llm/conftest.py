from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, row string"


@pytest.fixture(scope="session")
def texts() -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows, ties and passages that several rows share."""
    import random

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, long = prose(70), prose(9000)
    near = prose(120).split()
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One."), (5, "One."), (None, prose(30))]
    rows += [(10 + i, prose(40) + ". " + shared + "! " + prose(30)) for i in range(6)]
    rows += [(20 + i, " ".join(near[:i * 9] + ["changed"] + near[i * 9 + 1 :])) for i in range(8)]
    rows += [(30, long), (31, long), (32, "ab" * 40_000), (33, prose(20) + " all, rights--RESERVED cc\nby " + "the gnu  general public license.")]
    rows += [(34, "Released undr the MIT licence"), (35, "x" * 450), (36, shared), (36, shared)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", "src0", len(t or ""), "clash", "clash") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
