"""Small document frames with every awkward case."""

from __future__ import annotations

import pytest

CLASH = ["key", "kept", "component", "bucket", "host", "length", "slot", "layout", "text_sha256", "words"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int = 1) -> str:
    """n invented words, all different for one seed."""
    return " ".join(f"w{seed}x{k}" for k in range(n))


def docs_rows() -> list[tuple]:
    base = words(300)
    near = base.replace("w1x150 ", "changed ")
    texts = [
        (1, base), (2, near), (3, base), (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "one two"),
        (9, "Don't stop: café 12 #### ΣΑΣ <|endoftext|> x"), (10, words(20_000, 3)), (11, "a b c\n" * 200),
        (12, base.upper()), (13, words(60, 5)), (13, words(60, 5)), (None, words(70, 6)), (15, "x" * 5000),
        (16, "    z\u0000y"), (17, words(60, 5) + " more words here"),
    ]
    return [(i, t, "en", None if i == 7 else f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(docs_rows(), DOCS)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    from pyspark.sql import functions as F

    return awkward.withColumns({c: F.lit(f"clash-{c}") for c in CLASH})
