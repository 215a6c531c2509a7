"""Each operator against a plain computation, and over a table of odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflog.llm import (
    credentials,
    decontaminate,
    exact,
    language,
    mixing,
    near,
    quality,
    queries,
    substring_dedup,
    suffix_dedup,
    tokens,
)

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
COLUMNS = "doc_id long, text string, lang string, source string, key string, score double, kept string, mix int, uid long"


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, clashing names."""
    rows = [
        (1, prose(1), "en", "a", "k", 0.5, "no", 1, 7),
        (2, prose(1), "en", "a", None, None, None, None, None),
        (2, prose(1), "en", "a", None, None, None, None, None),
        (None, prose(1), "en", "b", "k", 0.5, "no", 1, 7),
        (None, None, None, None, None, None, None, None, None),
        (3, None, "de", "a", "k", 0.5, "no", 1, 7),
        (4, "", "de", None, "k", 0.5, "no", 1, 7),
        (5, "!!! \n\t", "de", "c", "k", 0.5, "no", 1, 7),
        (6, LONG, "en", "c", "k", 0.5, "no", 1, 7),
        (6, prose(2), "en", "c", "k", 0.5, "no", 1, 7),
    ]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def pairs(df, *columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


def sized(row):
    return row.n_units, sum(s.end - s.start for s in row.spans), bytes(row.kept)


def patchwork(seed):
    r = random.Random(seed)
    chars = ["".join(r.choice("ab é\n") for _ in range(r.randint(5, 60))) for _ in range(6)]
    phrases = [" ".join(r.choice("xyzuv") + r.choice("ab") for _ in range(r.randint(2, 14))) for _ in range(6)]
    docs = []
    for d in range(60):
        if r.random() < 0.5:
            text = "".join(r.choice(chars) if r.random() < 0.5 else prose(r.random(), 3) for _ in range(r.randint(0, 5)))
        else:
            text = " ".join(r.choice(phrases) if r.random() < 0.6 else f"w{r.randint(0, 50)}" for _ in range(r.randint(0, 8)))
        docs.append((d, "a" * r.randint(0, 90) if r.random() < 0.05 else text))
    return docs


@pytest.mark.parametrize("window", [2, 24])
def test_suffix_dedup_against_all_windows(spark, window):
    docs = patchwork(window)
    starts = defaultdict(list)
    texts = {d: t.encode() for d, t in docs}
    for d, t in texts.items():
        for i in range(len(t) - window + 1):
            starts[t[i : i + window]].append((d, i))
    gone = {d: bytearray(len(t)) for d, t in texts.items()}
    for places in starts.values():
        for d, i in places if len(places) > 1 else []:
            gone[d][i : i + window] = b"\1" * window
    want = {d: (len(t), sum(gone[d]), bytes(c for c, g in zip(t, gone[d]) if not g)) for d, t in texts.items()}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: sized(r) for r in suffix_dedup.remove_repeats(df, window=window).collect()}
    assert got == want
    assert sum(n for _, n, _ in want.values()) > 0


def complement_words(levels):
    """Two texts that differ everywhere and agree under any polynomial hash modulo 2**64."""
    a = "a"
    for _ in range(levels):
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_span_hashes_modulo_a_prime():
    from shelflog.llm import hashing

    powers, prime = hashing.Powers(), hashing._PRIME
    r = np.random.default_rng(5)
    values = r.integers(0, 1 << 64, 3000, dtype=np.uint64)
    a, b = hashing._reduced(values[:1500]), hashing._reduced(values[1500:])
    assert a.tolist() == [int(v) % prime for v in values[:1500]]
    assert hashing._times(a, b).tolist() == [x * y % prime for x, y in zip(a.tolist(), b.tolist())]
    total, sums = 0, []
    for x in a.tolist():
        sums.append(total := (total + x) % prime)
    assert hashing._sums(a).tolist() == sums
    spans = hashing.Spans(np.tile(values[:40], 50), powers)
    start = np.arange(0, 1900)
    assert len(set(spans.hash(start, start + 37).tolist())) == 40
    one, other = (hashing.Spans(hashing.symbols()[np.frombuffer(t.encode(), np.uint8)], powers) for t in complement_words(12))
    whole = np.array([0]), np.array([4096])
    assert one.hash(*whole) != other.hash(*whole)


def test_complementary_words_are_no_repeats(spark):
    one, other = complement_words(10)
    words = [f"word{i}" for i in range(10)]
    docs = [(1, " ".join([*words, one, *words[::-1]])), (2, " ".join([*words, other, *words[::-1]]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [sized(r)[1] for r in substring_dedup.remove_later_repeats(df).collect()] == [0, 0]
    long = spark.createDataFrame([(1, complement_words(12)[0] + "x" * 30), (2, complement_words(12)[1] + "y" * 30)], "doc_id long, text string")
    plain = {d: t.encode() for d, t in long.collect()}
    seen = defaultdict(set)
    for d, t in plain.items():
        for i in range(len(t) - 399):
            seen[t[i : i + 400]].add((d, i))
    want = {d: len({j for w, at in seen.items() if len(at) > 1 for e, i in at if e == d for j in range(i, i + 400)}) for d in plain}
    assert {r.doc_id: sized(r)[1] for r in suffix_dedup.remove_repeats(long, window=400).collect()} == want


@pytest.mark.parametrize("window", [3, 7])
def test_substring_dedup_against_all_windows(spark, window):
    docs = patchwork(window)
    seen, want = set(), {}
    for d, t in docs:
        words = t.encode().split()
        gone = [0] * len(words)
        for i in range(len(words) - window + 1):
            at = tuple(words[i : i + window])
            if at in seen:
                gone[i : i + window] = [1] * window
            seen.add(at)
        want[d] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: sized(r) for r in substring_dedup.remove_later_repeats(df, window=window).collect()}
    assert got == want
    assert sum(n for _, n, _ in want.values()) > 0


def test_dedup_of_odd_rows(odd, none):
    for remove in (suffix_dedup.remove_repeats, substring_dedup.remove_later_repeats):
        assert remove(none).count() == 0
        rows = remove(odd).collect()
        assert len(rows) == 10
        assert [sized(r) for r in rows if r.doc_id in (3, 4)] == [(0, 0, b"")] * 2
    later = [r for r in substring_dedup.remove_later_repeats(odd).collect() if r.n_units == 60]
    # The null id comes first and keeps its words, the rows of doc_id 1 and 2 lose them.
    assert sorted((r.doc_id or 0, len(r.kept) > 0) for r in later if r.doc_id != 6) == [(0, True), (1, False), (2, False), (2, False)]


def test_decontamination_against_plain_search(spark, odd, none):
    bench = [(1, prose(7, 30)), (1, "Short One"), (None, "gamma"), (3, None), (4, "..."), (5, prose(8, 10).upper())]
    docs = [
        (1, f"{prose(1)} {' '.join(prose(7, 30).split()[5:17])}, {prose(2)}"),
        (2, "a SHORT, one; and gamma"),
        (3, prose(3)),
        (4, None),
        (5, prose(8, 10)),
        (6, " ".join(prose(7, 30).split()[:9])),
    ]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(text):
        return word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    want = {}
    for d, text in docs:
        found, hit, items = words(text), set(), set()
        for item, other in bench:
            w = words(other)
            size = min(10, len(w))
            windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
            for i in range(len(found) - size + 1):
                if tuple(found[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    items.add("" if item is None else str(item))
        want[d] = (len(found), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    for block in (1 << 20, 40):  # in one pass and item by item
        found = decontaminate.digest(decontaminate.find_benchmark(df, benchmark, pattern_bytes=block))
        assert {r.doc_id: tuple(r)[1:] for r in found.collect()} == want
    assert want[1][1] == 12 and want[2][2] == 2 and not want[6][4]
    kept = decontaminate.find_benchmark(odd, benchmark, name="match")
    assert kept.columns == [*odd.columns, "match"] and kept.count() == 10
    assert decontaminate.find_benchmark(none, benchmark.limit(0)).count() == 0


def test_exact_dedup(spark, odd, none):
    r = random.Random(3)
    docs = [(i, f"text {r.randint(0, 300)}" if i % 3 else "hot") for i in range(900)]
    groups = defaultdict(list)
    for d, t in docs:
        groups[t].append(d)
    want = sorted((d, max(groups[t]), len(groups[t]), d == max(groups[t])) for d, t in docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for bits in (1, 16):  # a crowded filter changes nothing
        got = exact.exact_dedup(df, bits_per_row=bits).drop("text_sha256").collect()
        assert sorted(map(tuple, got)) == want
    rows = exact.exact_dedup(odd).collect()
    assert len(rows) == 10 and exact.exact_dedup(none).count() == 0
    same = [x for x in rows if x.group_size == 4]
    assert len(same) == 4 and {x.keep_id for x in same} == {2} and sum(x.kept for x in same) == 1
    empty = [x for x in rows if x.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert len(empty) == 3 and {x.keep_id for x in empty} == {4}
    plan = exact.exact_dedup(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mix(spark, odd, none):
    docs = [(i, "w " * (1 + i % 5), "big" if i % 10 else f"small{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(t.split())
    mixed = mixing.mix_sources(df, max_repeat=3.0, block_tokens=200)
    read = {r.source: r for r in mixed.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n"), F.max("mix.epoch").alias("e"), F.count_distinct("doc_id").alias("d")).collect()}
    # The least exponent that keeps the rarest source at three readings, the largest at one.
    total, least, most = sum(sizes.values()), min(sizes.values()), max(sizes.values())
    exponent = 1 - np.log(3) / np.log(most / least)
    for s, n in sizes.items():
        wanted = n * (n / most) ** (exponent - 1)
        assert wanted - 6 <= read[s].n <= wanted + 1e-3 * n, s
        assert read[s].d == sum(1 for x in docs if x[2] == s)
    # A target entropy and a budget: a third of the tokens, weights by the shares.
    shares = np.array(list(sizes.values())) / total
    entropy = float(-(shares * np.log(shares)).sum())
    small = mixing.mix_sources(df, target_entropy=entropy, max_repeat=None, budget=total / 3, block_tokens=200)
    got = small.agg(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
    assert total / 3 - 5 * len(sizes) <= got <= total / 3 + 1
    assert mixing.mix_sources(df, target_entropy=9.0, max_repeat=None).groupBy("source").agg(F.first("mix.weight").alias("w")).agg(F.max("w") - F.min("w")).first()[0] < 1e-6
    out = mixing.mix_sources(odd)
    assert out.columns == [*odd.columns, "mix_"]
    assert out.count() >= 10 and mixing.mix_sources(none).count() == 0
    assert out.select("doc_id", "text").distinct().count() == odd.select("doc_id", "text").distinct().count()


def test_secrets(spark, odd, none):
    value = "Ab3" * 6
    docs = [
        (1, f'é password = "{value}" and AKIA{"Z9" * 8} beside {"0af" * 7}'),
        (2, f"user: maria pass token=short12 {prose(1)}"),
        (3, f"user: maria {'x ' * 400} token=short12"),
        (4, "https://host.example/path only"),
        (5, f"see postgres://db.example:5432/x with secret: {value}"),
        (6, f"token=secret:{value} {'token=abc ' * 700} api_key={value}"),
        (7, "deadbeef " * 3 + "AKIA12"),
        (8, None),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    kinds = [
        ("assign", assign, lambda m: len(m[2]) >= 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    ]
    got = {r.doc_id: r for r in credentials.digest(credentials.scan_secrets(df)).collect()}
    for d, text in docs:
        spans = sorted(
            (m.start(), rank, kind, m.end())
            for rank, (kind, pattern, holds) in enumerate(kinds)
            for m in pattern.finditer(text or "")
            if holds(m)
        )
        spelt = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert got[d].base_sha256 == hashlib.sha256(spelt.encode()).hexdigest()
        assert set(filter(None, spelt.split(","))) <= set(got[d].spans.split(","))
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == tuple(sum(s[2] == k for s in spans) for k, _, _ in kinds)
    linked = {d: [s.split(":")[0] for s in got[d].spans.split(",") if s] for d in got}
    assert linked[2] == ["user", "weak"]  # both weak, side by side
    assert linked[3] == [] and linked[4] == []  # too far apart; nothing to complete
    assert linked[5] == ["endpoint", "assign"]
    rows = credentials.digest(credentials.scan_secrets(odd)).collect()
    assert len(rows) == 10 and credentials.scan_secrets(none).count() == 0
    plan = credentials.scan_secrets(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_secrets_link_after_long_parts(spark):
    docs, want = [], {}
    for size in (32, 320, 620, 700, 900, 1600, 4000):
        for gap in (1, 150, 299, 300, 301):
            for lead in (0, 37, 290):
                key = ("Ab3" * size)[:size]
                url = "https://" + "xyz" * (size // 3 - 2)
                # The partner begins ``gap`` after the end of the long part, or ends before it.
                texts = [
                    "." * lead + key + " " * gap + "user=alice",
                    "." * lead + "user=alice" + " " * gap + key,
                    "." * lead + url + " " * gap + "token=short12",
                ]
                for kinds, text in zip((("opaque", "user"), ("user", "opaque"), ("endpoint", "weak")), texts):
                    docs.append((len(docs), text))
                    want[len(want)] = list(kinds) if gap <= 300 else []
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in credentials.digest(credentials.scan_secrets(df)).collect()}
    assert got == want


def test_secrets_link_beside_a_hex_key(spark):
    key = "0af" * 7
    docs = [(1, f"user: maria {key}"), (2, f"{key} at mysql://db.example:3306/x"), (3, f"user: maria {'x ' * 400} {key}"), (4, f"AKIA{'Z9' * 8} {key}")]
    rows = credentials.digest(credentials.scan_secrets(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    linked = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",")] for r in rows}
    assert linked == {1: ["user", "hex"], 2: ["hex", "endpoint"], 3: ["hex"], 4: ["access", "hex"]}


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def test_banded_distance():
    r = random.Random(1)
    for _ in range(1500):
        a = [r.randint(0, 4) for _ in range(r.randint(0, 25))]
        b = a[:]
        for _ in range(r.randint(0, 6)):
            i = r.randint(0, len(b))
            b[i : i + r.randint(0, 1)] = [r.randint(0, 4)] * r.randint(0, 1)
        d, most = distance(a, b), r.randint(0, 8)
        assert near.banded_distance(a, b, most) == (d if d <= most else None)


def test_near_classes_against_all_pairs(spark, odd, none):
    r = random.Random(5)
    docs, passage = [], prose(99, 25)
    for base in range(25):
        words = prose(base, 80).split()
        docs.append(" ".join(words))
        for _ in range(r.randint(0, 4)):
            new = [w if r.random() > 0.03 else "edit" for w in words]
            docs.append(" ".join(new).upper() + ".")
    docs += [f"{prose(1000 + i, 60)} {passage} {prose(2000 + i, 60)}" for i in range(25)]
    docs = list(enumerate(docs))
    words = {d: decontaminate.words(t.encode()) for d, t in docs}
    root = {d: d for d in words}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in words:
        for b in words:
            if a < b and near.similar(words[a], words[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = {d: find(d) for d in words}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = near.near_classes(df).collect()
    assert {x.doc_id: x.class_id for x in rows} == want
    assert {x.doc_id for x in rows if x.kept} == set(want.values())
    sizes = Counter(want.values())
    assert all(x.class_size == sizes[x.class_id] for x in rows)
    assert max(sizes.values()) > 2 and sum(s == 1 for s in sizes.values()) >= 25
    assert near.keep_one(df).count() == len(sizes)

    found = near.near_classes(odd).collect()
    assert len(found) == 10 and near.near_classes(none).count() == 0
    same = [x for x in found if x.class_size == 4]
    assert len(same) == 4 and {x.class_id for x in same} == {1}
    stay = near.keep_one(odd)
    assert stay.columns == odd.columns and stay.count() == 7


def test_near_classes_with_spread_edits_and_short_texts(spark):
    r = random.Random(11)
    pairs = []
    for i in range(60):  # at random places, similarity 0.8, 0.85 and 0.9
        a = [f"w{r.randrange(5000)}" for _ in range(100)]
        b = a[:]
        for at in r.sample(range(100), (20, 15, 10)[i % 3]):
            b[at] = f"edit{i}at{at}"
        pairs.append((a, b))
    for i in range(60):  # every tenth word
        a = [f"w{r.randrange(5000)}" for _ in range(100)]
        pairs.append((a, [f"edit{i}at{k}" if k % 10 == 5 else w for k, w in enumerate(a)]))
    for n in range(5, 15):  # in the middle, one word off or another
        a = [f"short{n}w{k}" for k in range(n)]
        pairs += [(a, a[: n // 2] + a[n // 2 + 1 :]), ([w + "o" for w in a], [w + "o" * (k != n // 2) for k, w in enumerate(a)])]
        pairs.append(([w + "l" for w in a], [w + "l" * (n < 10 and k != 0 or k % 7 != 3) for k, w in enumerate(a)]))
    assert all(near.similar(a, b) for a, b in pairs)
    docs = [(2 * i + j, " ".join(w)) for i, p in enumerate(pairs) for j, w in enumerate(p)]
    docs += [(10_001, "one two three four five six"), (10_002, "one two three five six seven"), (10_003, "lone")]
    got = {x.doc_id: x.class_id for x in near.near_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: d if d > 10_000 else d // 2 * 2 for d, _ in docs}


def test_near_classes_around_frequent_passages(spark):
    """Texts with a common passage, a third to most of them; pairs with all edits outside of it, or spread."""
    r = random.Random(23)
    passages = [[f"p{k}x{i}" for i in range(60)] for k in range(3)]
    texts = []
    for i in range(240):
        passage, own = passages[i % 3], (20, 60, 140)[i // 3 % 3]
        a = passage + [f"w{r.randrange(5000)}" for _ in range(own)]
        at = len(a) // 2 if i % 2 else 0
        a = a[at:] + a[:at]
        texts.append(a)
        if i % 4 == 0:
            b, most = a[:], near.allowed(len(a), len(a), near.SIMILARITY)
            free = [k for k, w in enumerate(a) if w[0] == "w"] if i % 8 else range(len(a))
            for k in r.sample(list(free), min(most, len(free) - 1)):
                b[k] = f"edit{i}at{k}"
            texts.append(b)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(texts)):
        for a in range(b):
            if near.similar(texts[a], texts[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    df = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    assert {x.doc_id: x.class_id for x in near.near_classes(df).collect()} == {d: find(d) for d in range(len(texts))}
    assert len({find(d) for d in range(len(texts))}) > 100


def test_second_sketches_meet_similar_texts():
    r = random.Random(29)
    missed = 0
    for trial in range(200):
        n = r.randint(40, 300)
        passage = [f"p{i}" for i in range(int(n * r.random() * 0.9))]
        a = passage + [f"w{r.randrange(5000)}" for _ in range(n - len(passage))]
        places = range(n - near.allowed(n, n, 0.8), n) if trial % 2 else r.sample(range(n), near.allowed(n, n, 0.8))
        b = [f"e{k}" if k in set(places) else w for k, w in enumerate(a)]
        assert near.similar(a, b)
        plain = near.SecondSketches(np.empty(0, np.uint64))
        common = np.array(plain.grams(" ".join(passage).encode()) if passage else [], np.int64).view(np.uint64)
        second = near.SecondSketches(np.sort(common))
        missed += not set(second.one(" ".join(a).encode())) & set(second.one(" ".join(b).encode()))
    assert missed <= 4


def test_alignment_over_blocks():
    r = random.Random(31)
    a = [r.randrange(300) for _ in range(700)]
    b = [w for w in a if r.random() > 0.05]
    whole = near.banded_distance(a, b, 140)
    small = near.Aligner.__new__(near.Aligner)
    small.ROWS = 64
    small.__init__(a)
    assert len(small.blocks) == 11 and whole is not None and small.distance(b, 140) == whole == distance(a, b)


def test_rests_miss_no_short_pair():
    r, shorts = random.Random(3), near.OrderMinHash()
    linked = 0
    for _ in range(3000):
        a = [r.choice("abcdef") for _ in range(r.randint(1, 14))]
        b = a[:]
        for _ in range(r.randint(1, 3)):
            i = r.randint(0, len(b))
            b[i : i + r.randint(0, 1)] = [r.choice("abcdef")] * r.randint(0, 1)
        if b and len(b) <= 14 and near.similar(a, b):
            linked += 1
            x, y = (shorts.one(" ".join(t).encode())["sketch"] for t in (a, b))
            assert set(x) & set(y)
    assert near.exact_words(0.8) == 14 and linked > 500


def test_language(spark, odd, none):
    letters = {"xx": "abcde", "yy": "vwxyz", "zz": "mnopq"}
    r = random.Random(2)

    def text(lang):
        return " ".join("".join(r.choice(letters[lang]) for _ in range(5)) for _ in range(20))

    docs = [(i, text(lang), lang) for i in range(150) for lang in [list(letters)[i % 3]]] + [(900, text("xx"), None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language.fit_language(df.where("doc_id < 100"))
    assert model.languages == ["xx", "yy", "zz"]
    assert (model.weights == 0).mean() > 0.5
    got = language.identify_language(df, model).where("doc_id between 100 and 149").collect()
    assert sum(x.language.lang == x.lang for x in got) >= 49
    assert all(0.5 < x.language.score <= 1 for x in got)
    rows = language.identify_language(odd, model)
    assert rows.columns == [*odd.columns, "language"]
    silent = [x for x in rows.collect() if x.text is None or not any(map(str.isalpha, x.text))]
    assert len(silent) == 4 and all(x.language.lang == "und" and x.language.score == 0 for x in silent)
    blank = language.fit_language(none)
    assert {x.language.lang for x in language.identify_language(odd, blank).collect()} == {"und"}


def test_quality(spark, odd, none):
    r = random.Random(4)
    docs = [(i, prose(i, 200) if i % 4 else f"{prose(i, 100)} {'Buy NOW!! ' * 60}", int(i % 4 > 0)) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, quality int")
    labels = df.select("doc_id", "quality").unionByName(spark.createDataFrame([(None, 1), (5, None), (9999, 0)], "doc_id long, quality int"))
    model = quality.fit_quality(df.drop("quality"), labels.where("doc_id < 300 or doc_id is null"))
    got = quality.score_quality(df, model).where("doc_id >= 300").collect()
    assert sum((x.score >= 0.3) == bool(x.quality) for x in got) >= 98
    rows = quality.score_quality(odd, model, name="quality")
    assert rows.columns == [*odd.columns, "quality"]
    scores = [x.quality for x in rows.collect()]
    assert len(scores) == 10 and all(0 <= s <= 1 for s in scores)
    flat = quality.fit_quality(none, labels.limit(0))
    assert {x.quality for x in quality.score_quality(odd, flat, name="quality").collect()} == {0.5}


def test_quality_gradients():
    rng = np.random.default_rng(0)
    p = quality.new_parameters()
    x, counts, label = rng.random((7, quality.N_FEATURES)), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])

    def loss(q):
        s = 1 / (1 + np.exp(-quality.forward(q, x, counts)["logit"]))
        return -(label * np.log(s) + (1 - label) * np.log(1 - s)).mean()

    found = quality.gradients(p, x, counts, label)
    for name, g in found.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[at]) < 1e-6, name


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (5, 3), (700, 10), (3000, 10**6), (1000, 10**12)):
        values = np.sort(rng.integers(0, top, n))
        coded = tokens.EliasFano.from_bytes(tokens.EliasFano.encode(values, top).to_bytes())
        assert coded.values().tolist() == values.tolist()
        assert [coded.select(i) for i in range(0, n, 7)] == values[::7].tolist()
        assert len(coded.low) + len(coded.high) <= n * (2 + max(0, np.log2(max(top / n, 1)))) / 8 + n / 8 + 16


def test_token_shards(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    docs = [
        (i, f"It's  {prose(i, 9)}\n\n naïve straße 12,5 'quoted'  {prose(i + 1, i % 7)}? x y \U0001f600 日本 ") for i in range(80)
    ] + [(90, None), (91, ""), (92, " lead"), (93, "a\n b \t c"), (94, "<|endoftext|> x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert 50256 in tokenizer.encode(docs[-1][1], add_special_tokens=False).ids
    want, start = {}, 0
    for d, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want[d] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    manifest = tokens.write_tokens(df, f"file:{tmp_path}/shards", queries.tokenizer_file(), shard_ids=500)
    assert manifest.count() > 3
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokens.read_tokens(manifest).collect()} == {d: w[:3] for d, w in want.items()}
    for row in manifest.collect():
        reader = tokens.ShardReader(row.path)
        assert reader.document(0).tolist() == want[reader.doc_ids()[0]][3]
    full = tokens.Encoder(queries.tokenizer_file(), memo_pieces=1)
    assert [list(np.frombuffer(full.encode(t), "<u2")) for _, t in docs] == [w[3][:-1] for w in want.values()]
    rows = tokens.read_tokens(tokens.write_tokens(odd, str(tmp_path / "odd"), queries.tokenizer_file())).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 2, 3, 4, 5, 6, 6]
    assert tokens.read_tokens(tokens.write_tokens(none, str(tmp_path / "none"), queries.tokenizer_file())).count() == 0
