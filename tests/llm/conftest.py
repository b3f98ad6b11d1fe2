from __future__ import annotations

import pytest

pytest.importorskip("aerofuse.llm")

from aerofuse.llm.deploy import prepare_tasks  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars int, near string, h string, start string, cls string"


def prose(k: int, n: int = 80) -> str:
    """Words that no other ``k`` has, twelve to a line."""
    words = [f"word{k}x{j}{'abc'[j % 3]}" for j in range(n)]
    return "\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12))


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls, empty and huge texts, ties, repeated rows, no letters; columns that operators use names of."""
    near = prose(5, 400)
    texts = [
        (1, prose(1)), (1, prose(1)), (2, prose(1)), (3, None), (None, prose(3)), (None, None), (4, ""), (5, near),
        (6, near.replace("word5x7b", "other")), (7, "x" * 300_000), (8, "12 34\n\n  56"), (9, " lead  and\ttrail \n"),
        (10, "one"), (11, "ONE"), (12, "Ünïcödé 漢字 <|endoftext|> done."), (13, "a b c d e f g h\n" * 40),
        (14, prose(14) + "\n" + prose(1)), (15, (prose(15, 3000) + "\n") * 12), (16, "one"),
    ]
    return [(i, t, "en" if t else None, None, None if t is None else len(t), "n", "h", "s", "c") for i, t in texts]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    prepare_tasks(spark)
    return spark.createDataFrame(awkward_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    prepare_tasks(spark)
    return spark.createDataFrame([], DOCS)
