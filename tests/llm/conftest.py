import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, os.path.dirname(os.path.dirname(HERE)))

#: Nulls, empty and blank texts, ties, repeated rows, a long text, extra columns with clashing names.
LONG = " ".join(f"word{i % 977} und{i % 13}" for i in range(60_000))
PROSE = (
    "the river of stones runs under an old bridge and the people who live in the town walk to the market with baskets for bread while the bells "
    "of a church ring over roofs that are red with rust from many years of rain and smoke and the wind of winter blows on and on until spring comes"
)
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \n\t ", None, None),
    (4, PROSE, "en", "a"),
    (5, PROSE, "en", "b"),
    (5, PROSE, "en", "b"),
    (6, PROSE + " indeed", "en", "a"),
    (7, LONG, "de", "a"),
    (8, "Äpfel über Öfen und schöne grüne Wiesen mit vielen Blumen", "de", "b"),
    (9, "日本語 のテキスト 12 🙂🙂", "ja", None),
    (10, "x" * 300, None, "c"),
    (11, "a\r\nb\r\n\r\nc", "en", "c"),
    (None, "no id at all and nothing else to say", None, "c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows with two extra columns whose names operators might use themselves."""
    rows = [(*x, len(x[1] or ""), "k", 7) for x in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, size int")


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def rows():
    return ROWS
