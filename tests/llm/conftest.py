import os
import random

import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

WORDS = "the of on tion re wh an ing th er enough sturdy lantern river ça über niño 中文 🙂 it's".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): nulls, empty and white-space texts, copies, ties, repeated rows, a long text."""
    rows = [(k, prose(k, 5 + 13 * k)) for k in range(20)]
    rows += [(20, None), (21, ""), (22, " \n\t "), (23, rows[7][1]), (24, rows[7][1] + " more"), (25, prose(99, 12_000))]
    rows += [(26, "x" * 5000), (27, "<|endoftext|> then  two  spaces \r\n"), (5, rows[5][1]), (None, "no id here")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with columns whose names the operators use themselves."""
    names = "doc_id long, text string, lang string, source string, n_chars long, id string, ids string, fp string, score int, start int, n int, held boolean, word string, chunk string, component_id int"
    rows = [(i, t, "en", "src0", len(t or ""), "a", "b", "c", 1, 2, 3, True, "w", "k", 4) for i, t in texts]
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
