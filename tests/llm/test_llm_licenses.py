"""Every licence template against prose around it, against variants, and side by side."""

import random
import re

import pytest

from moodstream.llm import licenses
from moodstream.llm.license_texts import TEMPLATES

PROSE = "the river of stones runs below an old bridge and the people who live in the town walk to the market with baskets for bread".split()


def prose(seed: int, n: int = 200) -> str:
    return " ".join(random.Random(seed).choices(PROSE, k=n))


def names(text):
    return [x[2] for x in licenses.notices(text)]


@pytest.mark.parametrize("number", range(len(TEMPLATES)))
def test_every_template_is_found_exactly_amid_prose(number):
    name, _, wording = TEMPLATES[number]
    text = f"{prose(number)}. {wording} {prose(number + 1)}"
    ((start, end, found, _, differences),) = licenses.notices(text)
    assert (found, differences) == (name, [])
    assert [w for w, _, _ in licenses.wording(text[start:end])] == [w for w, _, _ in licenses.wording(wording)]
    assert names(f"a license of another kind. {text.upper()}") == [name]


@pytest.mark.parametrize("number", [i for i, x in enumerate(TEMPLATES) if len(x[2].split()) >= 40])
def test_long_texts_with_few_changes_are_found_and_with_many_are_not(number):
    name, telling, wording = TEMPLATES[number]
    words = wording.split()
    loose = [i for i in range(4, len(words) - 4) if not set(re.findall(r"\w+", words[i].lower())) & set(telling.split())]
    few = {i: "changed" for i in random.Random(number).sample(loose, len(words) // 40)}
    found = [x for x in licenses.notices(" ".join(few.get(i, w) for i, w in enumerate(words)))]
    assert name in [x[2] for x in found] and len(next(x for x in found if x[2] == name)[4]) == 2 * len(few)
    many = set(loose[:: max(1, len(loose) // (len(words) // 4))])
    assert wording not in [TEMPLATES[number][2] for x in licenses.notices(" ".join("changed" if i in many else w for i, w in enumerate(words))) if x[2] == name and not x[4]]


@pytest.mark.parametrize(
    "text, found",
    [
        ("Distributed under the MIT License", ["MIT"]),
        ("MIT-licensed", ["MIT"]),
        ("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
        ("// SPDX-License-Identifier: LGPL-2.1-only", ["LGPL-2.1-only"]),
        ("GNU Lesser General Public License v2.1", ["LGPL-2.1"]),
        ("CC BY-SA 3.0", ["CC-BY-SA-3.0"]),
        ("a licence to fish in the public domain", []),
        ("I read about the MIT license", []),
        ("Licensed under CC BY 4.0. " * 12, ["CC-BY-4.0"] * 12),
        (None, []),
    ],
)
def test_short_forms(text, found):
    assert names(text) == found


def test_notices_side_by_side_are_all_found():
    rng = random.Random(8)
    for _ in range(25):
        chosen = [x for x in rng.sample(TEMPLATES, 5) if len(x[2]) > 25]
        text = " ".join(f"{prose(rng.random(), rng.choice([8, 60]))}. {x[2]}" for x in chosen)
        assert names(text) == [x[0] for x in chosen]


def test_a_very_long_text_is_searched_to_its_end():
    text = " ".join(f"{prose(i, 300)} our license says nothing." for i in range(60)) + " Released under CC0 1.0."
    assert names(text) == ["CC0-1.0"]
