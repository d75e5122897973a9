"""A small documents table with the hard cases, for all operators."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, doc string, h long"


def prose(seed: int, n: int) -> str:
    """Deterministic words with sentences and lines."""
    out, x = [], seed
    for i in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("".join("aeioubdgklmnprst"[(x >> k) % 16] for k in (3, 7, 11, 15, 19)[: 2 + x % 4]) + ("." if x % 11 == 0 else ""))
        out.append("\n" if x % 41 == 0 else " ")
    return "".join(out)


@pytest.fixture(scope="session")
def rows():
    passage = prose(999, 70)
    shared = [prose(i, 60) + " " + passage + " " + prose(i + 50, 40) for i in range(1, 7)]
    copies = [prose(7, 300)] * 5
    texts = [
        None, "", "   \n\t ", "one", "two words", "Ähnlich große Wörter: été, ñandú!", "a\0b \x01 c", "### $$$ %%% " * 30,
        prose(11, 9000), *shared, *copies, prose(7, 299) + " changed", passage, passage + " " + passage, "same " * 60,
    ]
    out = [(100 + 3 * i, t, ("en", "de", None)[i % 3], "s", len(t or ""), "x", "y", 1) for i, t in enumerate(texts)]
    out += [out[10], (None, prose(21, 80), "en", None, 1, None, None, None), (None, None, None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
