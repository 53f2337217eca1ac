"""Windows and items that are compared, and what is found."""

import random

import pyarrow as pa
import pytest

from filmweave.llm import decontam


def _tables(seed=4):
    rnd = random.Random(seed)
    common = "the quick brown fox jumps over".split()
    words = [f"w{i}" for i in range(60)]
    items = [[*common, *rnd.choices(words, k=rnd.choice([8, 14]))] for _ in range(60)]
    items += [rnd.choices(words, k=k) for k in (1, 1, 3, 8, 9, 40)] + [items[0], []]
    texts = [None, "", "w1"]
    for _ in range(40):
        found = list(rnd.choice(items))
        for _ in range(rnd.randint(0, 5)):
            if found:
                found[rnd.randrange(len(found))] = rnd.choice(words)
        texts.append(" ".join([*rnd.choices(words, k=rnd.randint(0, 20)), *common, *found, *rnd.choices(words, k=rnd.randint(0, 20))]))
    return [(i, " ".join(w)) for i, w in enumerate(items)], texts


@pytest.mark.parametrize("most", [0, 1, 8, 1000])
def test_pairs_counted_by_item_lose_no_match(monkeypatch, most):
    items, texts = _tables()
    texts = pa.array([t or "" for t in texts], pa.large_string())
    monkeypatch.setattr(decontam, "ITEMS_PER_PAIR", 0)
    plain = decontam.find(texts, decontam.prepare(items))
    monkeypatch.setattr(decontam, "ITEMS_PER_PAIR", most)
    assert decontam.find(texts, decontam.prepare(items)) == plain
    assert sum(map(len, plain)) > 20


def test_items_that_share_too_few_pairs_with_a_window_are_not_compared(monkeypatch):
    """A passage that all items share a key with is compared with the item it comes from."""
    rnd = random.Random(1)
    items = [" ".join(["the", "quick", *rnd.choices([f"w{i}" for i in range(500)], k=18)]) for _ in range(100)]
    compared = []
    exact = decontam.edit_distances

    def counted(rows, *others):
        compared.append(len(rows))
        return exact(rows, *others)

    monkeypatch.setattr(decontam, "edit_distances", counted)
    found = decontam.find(pa.array(items, pa.large_string()), decontam.prepare(list(enumerate(items))))
    assert [[x["item_id"] for x in own] for own in found] == [[i] for i in range(100)]
    assert sum(compared) < 20 * len(items)
