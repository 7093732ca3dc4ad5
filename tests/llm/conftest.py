import random

import pytest
from llm_samples import docs_frame


@pytest.fixture(scope="session")
def awkward():
    """Null, empty and white texts, long texts, repeated rows, near and exact copies, a null id, odd characters."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    long = [word() for _ in range(4000)]
    passage = [word() for _ in range(70)]
    rows = [(0, None), (1, ""), (2, " \n\t \x0b"), (3, "one"), (3, "one"), (4, "Only four words here"), (None, "a null id " * 30), (None, None)]
    rows += [(10, " ".join(long)), (11, " ".join(long)), (12, " ".join(long[:3900] + passage)), (13, " ".join([*long, "more"]))]
    rows += [(20 + i, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(30)])) for i in range(6)]
    rows += [(40 + i, f"This line is in very many documents.\n{word()}\n  THIS line is in very many documents.\t\nshort\nshort") for i in range(5)]
    rows += [(41, "This line is in very many documents.\nother")]
    rows += [(50, "x\x1cy  z w \x85 \x00 end"), (51, "퟿ 漢字 😀 ÀÉ àé"), (52, "\n" * 50), (53, "w " * 300)]
    return rows


@pytest.fixture(scope="session")
def awkward_docs(spark, awkward):
    return docs_frame(spark, awkward).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return docs_frame(spark, [(1, "x")]).filter("false")
