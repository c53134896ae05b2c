import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, c string, score double, words string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("lo", "ra", "mi", "té", "su", "Ka") for b in ("n", "ster", "v", "gö", "p", "x", "tion")]
    out = []
    for i in range(n):
        out.append(rng.choice(vocabulary) + str(rng.randrange(30)) + rng.choice(["", "", "", ".", ","]))
        out.append("\n" if i % 17 == 16 else " ")
    return "".join(out).strip()


def rows(docs):
    return [(i, t, None, "s", None if t is None else len(t), 7, "x", 0.5, "w") for i, t in docs]


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and blank texts, a very long one, near and exact copies,
    repeated rows, marks that look like special tokens, odd white space."""
    base = prose(1, 300)
    near = base.replace("mi", "zu", 2)
    passage = "\n".join(prose(99, 70).split("\n"))
    docs = [
        (0, base), (1, None), (2, ""), (3, " \n\t  "), (4, "one"), (5, "ONE two"), (None, base), (6, near), (7, prose(3, 30_000)),
        (8, "a<|endoftext|>b  c <|startoftext|>\n\n x "), (9, "tab\x1cin é́ ñandú　wide’s it's DON'T"), (10, base),
        (11, passage + "\n" + prose(12, 120)), (12, prose(13, 90) + "\n" + passage), (13, "Released under the MIT License. More."),
        (14, "same words " * 500), (15, "same words " * 499 + "same other"), (16, " lead and trail "),
    ]
    return [*docs, docs[0], docs[2], docs[6]]


@pytest.fixture(scope="session")
def odd(spark, odd_docs):
    return spark.createDataFrame(rows(odd_docs), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
