"""Merkle manifest, filter audit and Jaccard join against plain computations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflog.llm import filter_audit, jaccard, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", part string, leaf string, digest string, key string, n int, tokens string, root string, mask int, rank long"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def prose(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def corpus(seed, n=150):
    r = random.Random(seed)
    rows = []
    for d in range(n):
        pick = r.random()
        if rows and pick < 0.15:
            text = r.choice(rows)[1]
        elif rows and pick < 0.5:
            words = (r.choice(rows)[1] or "").split()
            for _ in range(r.randint(0, 3)):
                if words:
                    words[r.randrange(len(words))] = prose(r, 1).upper()
            text = " ".join(words)
        else:
            text = r.choice([None, "", " \t\n", "One", "Is $5 & more", prose(r, 3), prose(r, r.randint(20, 90)), "hot line " * 60])
        source = "hot" if r.random() < 0.4 else r.choice([None, "é", "a", "A", "", f"s{r.randint(0, 20)}"])
        rows.append((d * r.choice([1, 1, 7000]), text, r.choice(["en", "de", None, ""]), source, None if r.random() < 0.1 else len(text or "")))
    return rows


ODD = [
    (None, "x y", "en", "a", 3),
    (None, "x y", "en", "a", 3),
    (None, None, None, None, None),
    (None, "Other", None, "only-nulls", 5),
    (-5, "B b", "en", "a", 3),
    (-(1 << 62), "b b", "en", "a", 3),
    (1 << 62, LONG, "de", "a", None),
    (7, "same id", "en", "a", 7),
    (7, "Same id", "en", "a", 7),
    (7, "same id", "en", "a", 7),
    (7, "same id", "en", "b", 7),
    (8, "é" * 3, None, None, 3),
]


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def with_clashes(df):
    names = [c.split()[0] for c in CLASHING[2:].split(", ")]
    return df.withColumns({c: F.lit(None).cast("string") for c in names})


# ---- manifest --------------------------------------------------------------------------


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def reduce_all(nodes):
    """Levels from the nodes up to the one that remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        start = at - at % 16
        out.append((level[start:at], level[at + 1 : start + 16]))
        at //= 16
    return out


def plain_manifest(rows):
    parts = defaultdict(list)
    for row in rows:
        parts[row[3]].append(row)
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        parts[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[name] = reduce_all([leaf_of(r, r[1]) for r in parts[name]])
    top = reduce_all([trees[n][-1][0] for n in names])
    out = []
    for place, name in enumerate(names):
        above = siblings(top, place)
        for at, row in enumerate(parts[name]):
            leaf = leaf_of(row, row[1])
            path = siblings(trees[name], at) + above
            changed = row[1] and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            text = re.sub("[A-Z]", lambda m: m.group().lower(), row[1]) if changed else row[1]
            made = leaf_of(row, text)
            for before, after in path:
                made = H(*before, made, *after)
            proof = H(*[d for before, after in path for d in before + after])
            out.append((row[0], leaf, trees[name][-1][0], top[-1][0], proof, made, made == top[-1][0]))
    return sorted(map(repr, out))


@pytest.mark.parametrize("rows", [corpus(1, 400), ODD, ODD[2:3], ODD + corpus(3, 60)], ids=["corpus", "odd", "one", "both"])
def test_manifest_against_a_plain_tree(spark, rows):
    got = merkle.merkle_manifest(with_clashes(frame(spark, rows)))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(repr(tuple(r)) for r in got.collect())
    assert got == plain_manifest(rows)


def test_manifest_of_an_empty_table(spark):
    assert merkle.merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tampering_is_noticed_only_where_something_changed(spark):
    rows = corpus(5, 120)
    for r in merkle.merkle_manifest(frame(spark, rows)).collect():
        texts = [t for d, t, *_ in rows if d == r.doc_id]
        if zlib.crc32(str(r.doc_id).encode()) % 5 or not any(re.search("[A-Z]", t or "") for t in texts):
            assert r.verified


@pytest.mark.parametrize("size", [1, 100, merkle.PAGE // 16 - 1, merkle.PAGE // 16, merkle.PAGE])
def test_ranks_in_a_page(size):
    r = np.random.default_rng(size)
    offsets = np.sort(r.choice(merkle.PAGE, size, replace=False))
    rows = r.choice([1, 1, 1, 3], size)
    bits, more_at, more, total = merkle._packed(offsets, rows)
    assert (merkle.unpack(bits) == offsets).all() and total == rows.sum()
    assert [a.tolist() for a in merkle._counts(bits, more_at, more)] == [offsets.tolist(), rows.tolist()]
    rank, same = merkle.Page(bits, more_at, more).rank(offsets)
    assert rank.tolist() == (np.cumsum(rows) - rows).tolist() and same.tolist() == rows.tolist()


def test_bitmaps_gather_and_merge_over_flushes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "_GATHER", 3)
    r = random.Random(2)
    ids = [(r.choice("pq"), r.choice([r.randint(0, 50), r.randint(-(10**12), 10**12)])) for _ in range(500)]
    index = merkle.bitmap_index(spark.createDataFrame(ids, "part string, doc_id long").repartition(5)).collect()
    for part in "pq":
        mine = sorted(d for p, d in ids if p == part)
        pages = sorted((p for p in index if p.part == part), key=lambda p: p.page)
        assert {p.n for p in pages} == {len(mine)}
        got = []
        for p in pages:
            assert p.base == len(got)
            for offset, rows in zip(*merkle._counts(p.bits, p.more_at, p.more)):
                got += [p.page * merkle.PAGE + int(offset)] * int(rows)
        assert got == mine


# ---- audit -----------------------------------------------------------------------------


def plain_fails(rows):
    out = []
    for d, text, *_ in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        earlier = any(d is not None and e is not None and e < d and (t or "") == text for e, t, *_ in rows)
        capitals = len(re.findall("[A-Z]", text))
        out.append((len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 3 * len(text), bool(re.search("[#$%&*|]", text)), earlier))
    return out


def plain_audit(rows, labels):
    fails = plain_fails(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out, shapley = {}, defaultdict(int)
    parts = {r[2] or "" for r in rows}
    for part in parts:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, name in enumerate(order, 1):
                i = "ABCDE".index(name)
                gone = [m for m in left if m[1][i]]
                left = [m for m in left if not m[1][i]]
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(m[1][i] for m in mine) - len(gone),
                    sum(m[1][i] and sum(m[1]) == 1 for m in mine),
                    sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone),
                ]
                shapley[part, name] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("rows", [corpus(2, 120), ODD], ids=["corpus", "odd"])
def test_audit_against_playing_all_orders(spark, rows):
    r = random.Random(4)
    labels = [(d, r.choice([0, 1, None]), r.choice([0, 1])) for d, *_ in rows if r.random() < 0.6] + [(None, 1, 1), (10**9, 1, 1)]
    df = filter_audit.audit_filters(with_clashes(frame(spark, rows)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {(x.part, x.filter_order, x.step): tuple(x)[3:] for x in df.collect()}
    assert df.columns[3:] == ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got == plain_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(spark.createDataFrame([], SCHEMA), none).collect() == []


def test_intervals_cover_each_order_once():
    names = filter_audit.orders()
    assert names == sorted(names)
    for mask in range(1, 32):
        hit = defaultdict(int)
        for m, step, first, end in filter_audit.removal_intervals():
            if m == mask:
                for rank in range(first, end):
                    hit[rank] = step
        for rank, order in enumerate(names):
            assert hit[rank] == 1 + min(i for i, f in enumerate(order) if mask >> "ABCDE".index(f) & 1)


def test_words_are_counted_alike_in_blocks():
    r = random.Random(9)
    for _ in range(200):
        text = "".join(r.choice("ab \t\n\x0b\x0cé\x1c\xa0") for _ in range(r.randint(0, 60))).encode()
        want = [w for w in re.split(rb"[\x20\x09-\x0D]+", text) if w]
        for block in (1, 3, 10, 1000):
            assert filter_audit.count_words(text, block) == (len(want), len(set(want)))


# ---- join ------------------------------------------------------------------------------


def plain_sets(rows):
    out = []
    for _, text, *_ in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
        k = min(4, len(words))
        out.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    return out


def plain_components(rows):
    sets = plain_sets(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return sorted(repr((rows[i][0], len(sets[i]), least[find(i)])) for i in range(len(rows)))


def edited_groups(seed):
    """Chains and stars of near copies around the threshold, and texts that share most of a passage."""
    r = random.Random(seed)
    rows, passage = [], prose(r, 60)
    for g in range(4):
        words = prose(r, r.choice([12, 60, 150, 1200 if g == 3 else 90])).split()
        for _ in range(12):
            edited = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                edited[r.randrange(len(edited))] = prose(r, 1)
            rows.append(" ".join(edited))
            if r.random() < 0.4:
                words = edited
    rows += [f"{passage} {prose(r, r.randint(1, 9))}" for _ in range(40)]
    rows += [passage, passage.upper(), "a b c", "a  b\tc", "a b", "a b c d", "a b c d"]
    return [(i, t, "en", "hot", len(t)) for i, t in enumerate(rows)]


@pytest.mark.parametrize("tight", [False, True])
@pytest.mark.parametrize("rows", [corpus(6), edited_groups(1), edited_groups(2) + ODD], ids=["corpus", "groups", "odd"])
def test_components_against_all_pairs(spark, monkeypatch, rows, tight):
    if tight:  # trees from the start, cells of few members, frequent shingles everywhere
        for name, value in (("ROUNDS", ("trees",)), ("CELL", 8), ("SMALL_CELL", 0), ("FREQUENT", 2)):
            monkeypatch.setattr(jaccard, name, value)
    got = jaccard.shingle_components(with_clashes(frame(spark, rows)))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain_components(rows)


def test_components_of_an_empty_table(spark):
    assert jaccard.shingle_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_table_of_frequent_shingles_may_be_cut(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_FREQUENT", 40)
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    rows = edited_groups(3)
    assert sorted(repr(tuple(r)) for r in jaccard.shingle_components(frame(spark, rows)).collect()) == plain_components(rows)


def test_tree_bounds_lose_no_pair(monkeypatch):
    r = np.random.default_rng(3)
    base = [r.integers(0, 1 << 63, n).astype(np.uint64) for n in (5, 40, 300, 1500, 5000)]
    sets = []
    for b in base:
        for share in (0.0, 0.02, 0.05, 0.08, 0.15):
            gone = r.random(len(b)) < share
            sets.append(np.unique(np.concatenate([b[~gone], r.integers(0, 1 << 63, int(gone.sum())).astype(np.uint64)])))
    sizes = np.array([len(s) for s in sets])
    vectors = [jaccard.count_vector(s).tobytes() for s in sets]
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if jaccard.linked(sets[i], sets[j])}
    assert len({len(v) for v in vectors}) > 2
    few = jaccard.surviving_pairs(sizes, vectors, np.arange(len(sets)), np.zeros(len(sets)))
    monkeypatch.setattr(jaccard, "SMALL_CELL", 0)
    got = jaccard.surviving_pairs(sizes, vectors, np.arange(len(sets)), np.zeros(len(sets)))
    assert sorted(few) == sorted(got)
    assert want <= set(got) and len(got) == len(set(got)) < 150
    side = np.arange(len(sets)) % 2
    across = jaccard.surviving_pairs(sizes, vectors, np.arange(len(sets)), side)
    assert set(across) == {(i, j) for i, j in got if side[i] != side[j]}
    order = jaccard.Order(sets[0][:2], np.array([50, 60]))
    for i, j in want:
        assert set(order.prefix(sets[i])) & set(order.prefix(sets[j]))
    for s in sets:
        head = s[np.argsort(jaccard.mix(s))[: jaccard.head_length(len(s))]]
        short = order.from_head(head, len(s))
        assert short is None or short.tolist() == order.prefix(s).tolist()
