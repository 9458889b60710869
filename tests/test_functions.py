"""Column functions against plain Python."""

import re
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodstream.functions import scores
from moodstream.functions.clock import descending_time_key
from moodstream.functions.lookup import MAX_LITERAL_ENTRIES, lookup
from moodstream.functions.text import feature_tokens, has_token, tokens, with_placeholders


def values(spark, rows, kind, expression):
    frame = spark.createDataFrame([(r,) for r in rows], f"v {kind}")
    return [r[0] for r in frame.select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("rt:@bob hi", "retweetplaceholderpseudoplaceholder hi"),
        ("RT @bob hi", "RT pseudoplaceholder hi"),
        ("start: now", "staretweetplaceholder now"),
        ("a @ b", "a pseudoplaceholder b"),
        ("me@home.org", "mepseudoplaceholder.org"),
        ("#tag# x", "hashtagplaceholderhashtagplaceholder x"),
        ("see https://a.co/x?y=1", "see linkplaceholder?y=1"),
        ("http://a.co/x#top", "linkplaceholder"),
        ("plain", "plain"),
        ("", ""),
    ],
)
def test_placeholders(spark, text, expected):
    assert values(spark, [text], "string", with_placeholders) == [expected]


def test_placeholder_patterns_are_arguments(spark):
    def custom(text):
        return with_placeholders(text, mention="~[a-z]+", retweet="RT")

    assert values(spark, ["RT ~bob @ann"], "string", custom) == [
        "retweetplaceholder pseudoplaceholder @ann"
    ]


def test_tokens(spark):
    texts = ["Été 2 fois_x", "don't", "", "...", "naïve  東京 x"]
    assert values(spark, texts, "string", tokens) == [
        ["été", "2", "fois_x"],
        ["don", "t"],
        [],
        [],
        ["naïve", "東京", "x"],
    ]
    assert values(spark, texts, "string", has_token) == [True, True, False, False, True]
    assert values(spark, ["RT @Bob http://x.y"], "string", feature_tokens) == [
        ["rt", "pseudoplaceholder", "linkplaceholder"]
    ]


def test_tokens_pattern_is_an_argument(spark):
    assert values(spark, ["a1b22"], "string", lambda c: tokens(c, r"\d+")) == [["1", "22"]]


def python_placeholders(text):
    for pattern, term in (
        (r"rt:", "retweetplaceholder"),
        (r"@[a-zA-Z0-9_]*", "pseudoplaceholder"),
        (r"#[a-zA-Z0-9_]*", "hashtagplaceholder"),
        (r"http(s)?://[a-zA-Z0-9./\-]*", "linkplaceholder"),
    ):
        text = re.sub(pattern, term, text)
    return text


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.text(alphabet=st.sampled_from("rt:@#http://. aZ_9-é?\n"), max_size=40),
        min_size=20,
        max_size=60,
    )
)
def test_texts_agree_with_python(spark, texts):
    assert values(spark, texts, "string", with_placeholders) == [
        python_placeholders(t) for t in texts
    ]
    assert values(spark, texts, "string", feature_tokens) == [
        re.findall(r"\w+", python_placeholders(t).lower()) for t in texts
    ]


def test_lookup(spark):
    table = {f"w{i}": float(i) for i in range(500)} | {"é": -1.0, "": 7.0}
    words = ["w0", "w499", "é", "", "w500", None]
    assert values(spark, words, "string", lambda c: lookup(c, table)) == [
        0.0, 499.0, -1.0, 7.0, None, None,
    ]
    assert values(spark, ["a"], "string", lambda c: lookup(c, {})) == [None]
    with pytest.raises(ValueError):
        lookup(F.lit("a"), {str(i): 0.0 for i in range(MAX_LITERAL_ENTRIES + 1)})


def test_time_key(spark):
    times = [datetime(2024, 1, 2, 3, 4, 5, 678901), datetime(2031, 5, 1), datetime(2029, 12, 31, 23)]
    expected = [(datetime(2030, 1, 1) - t).total_seconds() for t in times]
    assert values(spark, times, "timestamp_ntz", descending_time_key) == expected


def test_rounding_and_bands(spark):
    xs = [-2.0, -1.25, -0.76, -0.75, -0.5, -0.25, 0.0, 0.24, 0.25, 0.49, 0.75, 3.0]
    halves = [round(x * 2) / 2 for x in xs]
    assert values(spark, xs, "double", scores.half_step) == halves
    names = []
    for h in halves:
        place = sum(h >= limit for limit in scores.BAND_LIMITS)
        names.append(scores.BAND_COLOURS[place])
    assert values(spark, halves, "double", scores.score_band) == names


def test_polarity(spark):
    xs = [0.1, 0.09, 0.0, -0.09, -0.1]
    assert values(spark, xs, "double", scores.polarity) == [
        "positive", "neutral", "neutral", "neutral", "negative",
    ]
    assert values(spark, [0.5, 0.0, -0.5], "double", scores.polarity_colour) == [
        "#002C0D", "#0C0F0A", "#270000",
    ]


def test_font_size(spark):
    counts = list(range(3, 40))
    smallest, spread = min(counts), max(counts) - min(counts) + 1
    expected = [
        (round(((c - smallest) / spread) * 2 - 1, 2) * 0.4 + 1) * 120 for c in counts
    ]
    got = values(
        spark, counts, "bigint", lambda c: scores.font_size(c, F.lit(smallest), F.lit(spread))
    )
    assert got == pytest.approx(expected)


def test_compat_normalisation_of_equal_counts(spark):
    # One distinct count of 1: the literal form divides by zero.
    for compat, expected in ((True, None), (False, -0.49)):
        assert values(
            spark,
            [1],
            "bigint",
            lambda c: scores.normalised_count(c, F.lit(1), F.lit(1), compat),  # noqa: B023
        ) == [expected]


def test_random_score(spark):
    rows = spark.range(200).select(scores.random_score(3).alias("s")).collect()
    assert all(-1 <= r.s < 1 for r in rows)
    assert len({r.s for r in rows}) > 150
