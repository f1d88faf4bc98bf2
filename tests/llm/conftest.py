import random

import pytest

from clickstar.llm.tables import Scratch, ship


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)


@pytest.fixture
def scratch(llm):
    return Scratch(llm, "test")


DOCS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, size int, "
        "copies string, label int, x double")


@pytest.fixture(scope="session")
def awkward(llm):
    """Rows with nulls, empty and long texts, repeats, near copies and clashing columns."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []

    def add(doc_id, text, source):
        rows.append((doc_id, text, None, source, None, 7, "many", doc_id, 0.5))

    for i in range(40):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(1, 160)))
        add(i, text, f"s{i % 4}")
        if i % 5 == 0:
            near = text.split()
            near[len(near) // 2] = "changed"
            add(100 + i, " ".join(near), "s1")
            add(200 + i, "\n".join(text.upper().split()), None)
    add(300, " ".join(rng.choices(vocabulary, k=9000)), "s0")
    add(301, None, "s0")
    add(302, "", "s2")
    add(303, " \n\t ", None)
    add(304, "w1", "")
    add(305, "w1", "s3")
    add(None, "w1 w2 w3 w4 w5 w6 w7", "s3")
    add(None, None, None)
    add(306, "repeated row of a few words here", "s1")
    add(306, "repeated row of a few words here", "s1")
    add(307, "Zürich É é 日本 \U0001f600 naïve", "s1")
    return llm.createDataFrame(rows, DOCS)
