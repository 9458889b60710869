"""Cases that earlier forms of the operators lost."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodstream.llm import pii, spotsigs
from moodstream.llm.language import gram_counts, identified, learned, learned_blocks


@pytest.mark.parametrize(
    "text, found",
    [
        ("+1 (743) 555-3824 4111 1111 1111 1111", [("phone", "7435553824"), ("card", "4111111111111111")]),
        ("+1 212 555 0199 212 555 0100", [("phone", "2125550199"), ("phone", "2125550100")]),
        ("+1 (743) 555-3824 97.51.17.173", [("phone", "7435553824"), ("ip", "97.51.17.173")]),
        ("+44 20 7946 0958 97.51.17.173", [("phone", "442079460958"), ("ip", "97.51.17.173")]),
        ("+44 20 7946 0958 4111 1111 1111 1111", [("phone", "442079460958"), ("card", "4111111111111111")]),
        ("call +44 20 7946 0958 now", [("phone", "442079460958")]),
        ("999.10.10.10 and 212-555-0100", [("phone", "2125550100")]),
    ],
)
def test_numbers_side_by_side_are_all_found(text, found):
    assert [(kind, value) for _, _, kind, value in pii.finds(text)] == found


def test_every_label_is_learned(spark):
    names = [f"l{k:03d}" for k in range(80)]
    words = {name: chr(0x4E00 + 7 * k) * 3 for k, name in enumerate(names)}
    rows = [(f"{words[x]} {words[x]}", x) for x in names]
    counts = gram_counts(spark.createDataFrame(rows, "text string, lang string")).persist()
    asked = spark.createDataFrame([(k, words[x], 9.5, "mine") for k, x in enumerate(names)] + [(99, "12", 1.0, "x"), (98, None, 1.0, None)], "id int, text string, best double, row string")
    one = identified(asked, learned(counts, 100)).orderBy("id").collect()
    many = identified(asked, learned_blocks(counts, 32)).orderBy("id").collect()
    assert [x.lang_pred for x in many] == [*names, "und", "und"] == [x.lang_pred for x in one]
    assert [(x.best, x.row) for x in many] == [(9.5, "mine")] * 80 + [(1.0, None), (1.0, "x")]
    assert np.allclose([x.score for x in many], [x.score for x in one])
    assert [len(x.labels) for x in learned_blocks(counts, 40)] == [40, 40] and not next(learned_blocks(counts.limit(0))).labels
    clash = asked.withColumns({"score": F.lit(1), "lang_pred": F.lit("x")})
    assert identified(clash, learned(counts)).columns == ["id", "best", "row", "lang_pred", "score"]


def test_likeness_is_exact_whatever_the_sizes():
    small, large = np.arange(3, dtype=np.uint32), np.arange(40, dtype=np.uint32)
    assert spotsigs.likeness(small, large, 0.0) == 0.075 and spotsigs.likeness(small, large) == 0.0
