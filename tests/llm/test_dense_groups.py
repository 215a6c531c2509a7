"""Groups whose members all meet: results against all pairs, and rows that don't grow with the square."""

from __future__ import annotations

import random
from collections import defaultdict

from shelflog.llm import jaccard, near


def counted(monkeypatch, module):
    """Rows of each table that ``module`` writes, by label."""
    rows, plain = defaultdict(int), module.materialize

    def materialize(df, label):
        found = plain(df, label)
        rows[label] += found.count()
        return found

    monkeypatch.setattr(module, "materialize", materialize)
    return rows


def test_near_classes_of_texts_that_are_one_passage_for_the_most_part(spark, monkeypatch):
    r = random.Random(41)
    passage = [f"p{i}" for i in range(100)]
    texts = [passage + [f"w{r.randrange(13)}" for _ in range(38)] for _ in range(160)]
    root = near.Joined()
    for b in range(len(texts)):
        for a in range(b):
            if near.similar(texts[a], texts[b]):
                root.join(max(root.root(a), root.root(b)), min(root.root(a), root.root(b)))
    expected = {d: root.root(d) for d in range(len(texts))}
    assert 10 < len(set(expected.values())) < 150

    monkeypatch.setattr(near, "CELL", 24)
    monkeypatch.setattr(near, "BLOCK", 30)
    rows = counted(monkeypatch, near)
    df = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    assert {x.doc_id: x.class_id for x in near.near_classes(df).collect()} == expected
    assert rows["near-lists"] > 0 and rows["pairs"] < 10000  # all pairs are 12,720, and most met in several rounds


def test_block_links_join_what_all_pairs_join():
    r = random.Random(43)
    base = [f"w{i}" for i in range(60)]
    texts = {bytes([i]): [f"e{r.randrange(9)}" if r.random() < 0.11 else w for w in base] for i in range(40)}
    keys = list(texts)
    rows = [(k, " ".join(t).encode(), None) for k, t in texts.items()] + [(k, None, keys[i + 1 :]) for i, k in enumerate(keys[:-1])]
    every, few = near.Joined(), near.Joined()
    linked = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if near.similar(texts[a], texts[b])]
    found = list(near.block_links(rows))
    for joined, pairs in ((every, linked), (few, found)):
        for a, b in pairs:
            joined.join(a, b)
    assert set(found) <= set(linked) and len(found) < len(keys) < len(linked)
    assert all(every.apart(a, b) == few.apart(a, b) for a in keys for b in keys)


def test_jaccard_chain_is_joined_by_fewer_links_than_texts(spark, monkeypatch):
    texts = [" ".join(f"w{j}" for j in range(2 * i, 2 * i + 100)) for i in range(200)]
    monkeypatch.setattr(jaccard, "ROUNDS", ("trees",))
    rows = counted(monkeypatch, jaccard)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x.component_id for x in jaccard.shingle_components(df).collect()} == {0}
    assert rows["candidates"] > 600 and rows["links"] == 199
    monkeypatch.setattr(jaccard, "BLOCK", 30)
    assert {x.component_id for x in jaccard.shingle_components(df).collect()} == {0}
