"""Benchmark items of any length are looked for."""

from __future__ import annotations

import random

import pytest

from changetrail.llm import decontamination
from tests.llm.test_operators import documents


def distance(item, text):
    """Least edits between the item and any stretch of the text, by the whole table."""
    row = list(range(len(item) + 1))
    least = row[-1]
    for c in text:
        new = [0]
        for i, d in enumerate(item):
            new.append(min(row[i] + (c != d), row[i + 1] + 1, new[i] + 1))
        row, least = new, min(least, new[-1])
    return least


def allowed(item):
    return min(int(len(item) * decontamination.EDITS), len(item) // 8 - 1)


def test_places_within_the_edits_are_those_of_the_whole_table():
    """Random items of 8 to 120 characters, put into texts with edits, against plain dynamic programming."""
    dice = random.Random(9)
    letters = "abcdefg h"
    for _ in range(60):
        item = "".join(dice.choices(letters, k=dice.choice((8, 9, 15, 16, 20, 31, 32, 60, 120)))).strip().ljust(8, "z")
        copy = list(item)
        for _ in range(dice.randint(0, allowed(item) + 2)):
            at = dice.randrange(len(copy))
            copy[at : at + 1] = dice.choice(([], ["x"], [copy[at], "y"]))
        text = "".join(dice.choices(letters, k=60)) + "".join(copy) + "".join(dice.choices(letters, k=50))
        found = decontamination.Index([(1, item)]).search([text])[0]
        assert bool(found) == (distance(item, text) <= allowed(item)), (item, text)
        assert all(e == distance(item, text[a:b]) for _, a, b, e in found)


@pytest.mark.parametrize("item", ["What is the largest sea of all", "ab cd ef", "Wörter ün"])
def test_short_items_copied_word_for_word_are_found(spark, item):
    items = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "  "), (11, "yes")], "item_id long, text string")
    texts = [f"so: {item.upper()}! and yes", "nothing of it", None, "", item, " Yes\n", "yes 𝒳", "y" * 40]
    docs = documents(spark, texts)
    rows = {(r["doc_id"], r["item_id"]): (r["start"], r["end"], r["edits"]) for r in decontamination.leaks(docs, items).collect()}
    assert rows == {(0, 7): (4, 4 + len(item), 0), (4, 7): (0, len(item), 0), (5, 11): (1, 4, 0)}
    assert sorted(r["doc_id"] for r in decontamination.without_leaks(docs, items).collect()) == [1, 2, 3, 6, 7]
