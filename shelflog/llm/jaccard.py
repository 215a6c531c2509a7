"""Jaccard join of shingle sets: count vectors in R-trees, then the sets themselves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflog.llm.bloom import known_keys, probe
from shelflog.llm.common import id_and_text, slices
from shelflog.llm.hashing import mix
from shelflog.llm.near import BLOCK, Joined, components, runs
from shelflog.session import materialize

SHINGLE = 4
PERCENT = 85
GROUPS = 64  # coordinates of the shortest count vector
_PER_GROUP = 16  # tokens a coordinate, at most about that many
FREQUENT = 32  # documents beyond which a shingle counts as frequent
MOST_FREQUENT = 1 << 20  # entries of the table of frequent shingles, at most
ROUNDS = ("star", "trees")  # how a round chooses its pairs
FIRST_TOKENS = 3
SMALL_CELL = 48  # members up to which a cell's pairs are looked at one by one
CELL = 1024  # members of a token group that meet in one task, at most
LEAF = 16
_SMALL = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_SETS = "doc_id bigint, key binary, n int, head array<bigint>, counts binary"


# ---- sets and vectors ------------------------------------------------------------------


def shingles(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct runs of ``k`` words, ascending; of all words if they are fewer."""
    found = (text or b"").translate(_SMALL).split()
    if not found:
        return np.empty(0, np.uint64)
    names: dict[bytes, int] = {}
    ids = np.array([names.get(w) or names.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in found], np.uint64)
    k = min(k, len(ids))
    out = np.full(len(ids) - k + 1, k, np.uint64)
    for j in range(k):
        out = mix(out * _GOLDEN + ids[j : j + len(out)])
    return np.unique(out)


def groups_of(n: int) -> int:
    """Coordinates for a set of ``n``: a power of two, so that a longer vector folds to a shorter."""
    g = GROUPS
    while g * _PER_GROUP < n:
        g *= 2
    return g


def count_vector(tokens: np.ndarray) -> np.ndarray:
    """How many tokens fall into each group (their lowest bits)."""
    g = groups_of(len(tokens))
    counts = np.bincount((tokens & np.uint64(g - 1)).astype(np.int64), minlength=g)
    if counts.max() > 255:  # some 16 tokens a group are usual
        raise ValueError("shingle hashes are not spread")
    return counts.astype(np.uint8)


def fold(counts: np.ndarray, g: int) -> np.ndarray:
    """The count vector over ``g`` groups from one over more."""
    return counts.reshape(-1, g).sum(axis=0, dtype=np.int64)


def least_overlap(n: np.ndarray | int, m: np.ndarray | int, percent: int = PERCENT):
    """Fewest common elements at which sets of ``n`` and ``m`` are linked."""
    return -(-percent * (n + m) // (100 + percent))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """So many first tokens of a set, in an order common to all, hold one of any linked set.

    Two linked sets have at least ``percent`` of the larger in common.
    """
    return n + percent * n // -100 + 1


def head_length(n: int) -> int:
    """The prefix and half as much again, for tokens that turn out to be frequent."""
    return min(n, -(-3 * prefix_length(n) // 2))


def key_of(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in slices(batch, 1, 1 << 18):
            yield part, [shingles(t) for t in part.column(1).cast(pa.binary()).to_pylist()]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, made in _texts(batches):
        heads = [s[np.argsort(mix(s), kind="stable")[: head_length(len(s))]] for s in made]
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array([key_of(s) for s in made], pa.binary()),
                pa.array([len(s) for s in made], pa.int32()),
                pa.array([h.view(np.int64) for h in heads], pa.list_(pa.int64())),
                pa.array([count_vector(s).tobytes() if len(s) else None for s in made], pa.binary()),
            ],
            ["doc_id", "key", "n", "head", "counts"],
        )


# ---- R-tree ----------------------------------------------------------------------------


class CountTree:
    """R-tree over count vectors, packed by size and then by the coordinates that vary most.

    A leaf keeps the greatest count per group and its least and greatest size. The groupwise
    minima of a query and a leaf's greatest counts add up to no less than any overlap inside.
    """

    def __init__(self, sizes: np.ndarray, counts: np.ndarray, leaf: int = LEAF):
        self.sizes, self.counts = sizes, counts
        wide = np.argsort(-counts.var(axis=0), kind="stable")[:2]
        rank = np.empty(len(sizes), np.int64)
        rank[np.argsort(sizes, kind="stable")] = np.arange(len(sizes))
        slab = rank // max(1, leaf * leaf)
        self.order = np.lexsort((counts[:, wide[-1]], counts[:, wide[0]] // 4, slab))
        starts = np.arange(0, len(sizes), leaf)
        self.leaves = [self.order[s : s + leaf] for s in starts]
        self.high = np.maximum.reduceat(counts[self.order], starts, axis=0)
        self.least = np.minimum.reduceat(sizes[self.order], starts)
        self.most = np.maximum.reduceat(sizes[self.order], starts)

    def search(self, size: int, point: np.ndarray, percent: int = PERCENT) -> np.ndarray:
        """Members whose overlap with the query may suffice for a link."""
        near = (100 * self.most >= percent * size) & (percent * self.least <= 100 * size)
        near &= np.minimum(self.high, point).sum(axis=1) >= least_overlap(size, self.least, percent)
        if not near.any():
            return np.empty(0, np.int64)
        at = np.concatenate([self.leaves[i] for i in np.flatnonzero(near)])
        return at[may_link(size, point, self.sizes[at], self.counts[at], percent)]


def may_link(size: int, point: np.ndarray, sizes: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    close = (100 * sizes >= percent * size) & (percent * sizes <= 100 * size)
    close[close] = np.minimum(counts[close], point).sum(axis=1) >= least_overlap(size, sizes[close], percent)
    return close


def surviving_pairs(sizes: np.ndarray, vectors: list[bytes], roots: np.ndarray, side: np.ndarray, met_here=lambda i, j: True, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of different roots that their count vectors allow to be linked.

    ``side`` tells the two slices of a cell apart (pairs across only), or is 0 throughout.
    Vectors of close sizes differ in length by a factor of two at most, so trees are built
    per length, over the vectors of that length and of the next, folded. A few members are
    a single leaf each: their sizes and roots are compared first, then the vectors.
    ``met_here`` leaves out pairs that another cell looks at.
    """
    across, out = len(np.unique(side)) > 1, []
    if len(sizes) <= SMALL_CELL:
        small = np.minimum.outer(sizes, sizes)
        close = (100 * small >= percent * np.maximum.outer(sizes, sizes)) & (roots[:, None] != roots[None, :])
        if across:
            close &= side[:, None] != side[None, :]
        for i, j in np.argwhere(np.triu(close, 1)).tolist():
            if met_here(i, j) and overlap_bound(vectors[i], vectors[j]) >= least_overlap(int(sizes[i]), int(sizes[j]), percent):
                out.append((i, j))
        return out
    points = [np.frombuffer(v, np.uint8) for v in vectors]
    lengths = np.array([len(v) for v in points])
    for g in np.unique(lengths):
        mine = np.flatnonzero((lengths == g) | (lengths == 2 * g))
        if len(mine) < 2:
            continue
        counts = np.stack([fold(points[i], g) for i in mine])
        tree = CountTree(sizes[mine], counts)
        for q, i in enumerate(mine):
            hits = mine[tree.search(sizes[i], counts[q], percent)]
            hits = hits[(hits > i) & (roots[hits] != roots[i]) & ((lengths[hits] == g) | (lengths[i] == g))]
            if across:
                hits = hits[side[hits] != side[i]]
            out += [(int(i), j) for j in hits.tolist() if met_here(i, j)]
    return out


def overlap_bound(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    g = min(len(x), len(y))
    return int(np.minimum(fold(x, g), fold(y, g)).sum())


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surviving pairs of each cell; a cell's rows follow each other."""

    def pairs_of(token: int, rows: list[tuple]) -> list[tuple]:
        keys, named, sizes, vectors, side, firsts = zip(*rows)
        earlier = [{t for t in f if t < token} for f in firsts]
        names = {r: i for i, r in enumerate(dict.fromkeys(named))}
        roots = np.array([names[r] for r in named])
        found = surviving_pairs(np.array(sizes, np.int64), vectors, roots, np.array(side), lambda i, j: earlier[i].isdisjoint(earlier[j]))
        return [(min(keys[i], keys[j]), max(keys[i], keys[j])) for i, j in found]

    def batch_of(pairs: list[tuple]) -> pa.RecordBatch:
        a, b = zip(*pairs)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    cell, held = None, []
    for batch in batches:
        out: list[tuple] = []
        for token, low, high, *row in zip(*[batch.column(i).to_pylist() for i in range(9)]):
            if (token, low, high) != cell:
                out += pairs_of(cell[0], held) if len(held) > 1 else []
                cell, held = (token, low, high), []
            held.append(tuple(row))
        if out:
            yield batch_of(out)
    if len(held) > 1:
        last = pairs_of(cell[0], held)
        if last:
            yield batch_of(last)


# ---- candidates ------------------------------------------------------------------------


def _frequent_tokens(sets: DataFrame) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """Shingles in the heads of several rows (a table), and the names and counts of the most frequent.

    The latter are bounded: the threshold rises by powers of two until the list is short enough.
    """
    counted = sets.select(F.explode("head").alias("token")).groupBy("token").count()
    shared = materialize(counted.where("count > 1"), "shared-shingles")
    level = F.floor(F.log2("count")).cast("int")
    held, least = 0, 64
    tail = {r["level"]: r["tokens"] for r in shared.groupBy(level.alias("level")).agg(F.count("*").alias("tokens")).collect()}
    for lv in range(63, int(np.log2(FREQUENT)) - 1, -1):
        held += tail.get(lv, 0)
        if held > MOST_FREQUENT:
            break
        least = lv
    rows = [] if least > 62 else shared.where(F.col("count") >= F.lit(max(1 << least, FREQUENT))).collect()
    names = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    counts = np.array([r["count"] for r in rows], np.int64)
    order = np.argsort(names, kind="stable")
    return shared, (names[order], counts[order])


class Order:
    """The common order of tokens: frequent ones (ascending ``names``) last, by a hash otherwise."""

    def __init__(self, names: np.ndarray, counts: np.ndarray):
        self.names, self.counts = names, counts

    def weight(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.names, tokens), len(self.names) - 1)
        return np.where(self.names[at] == tokens, self.counts[at], 0)

    def prefix(self, tokens: np.ndarray) -> np.ndarray:
        """The prefix of a whole set."""
        return tokens[np.lexsort((mix(tokens), self.weight(tokens)))[: prefix_length(len(tokens))]]

    def from_head(self, head: np.ndarray, n: int) -> np.ndarray | None:
        """The prefix of a set of ``n`` from its first tokens by hash; None if these don't suffice."""
        if len(head) == n:
            return self.prefix(head)
        rare = head[self.weight(head) == 0][: prefix_length(n)]
        return rare if len(rare) == prefix_length(n) else None


def _token_rows(batch: pa.RecordBatch, keys: pa.Array, sizes: pa.Array, chosen: list[np.ndarray]) -> pa.RecordBatch:
    at = pa.array(np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]))
    tokens = np.concatenate(chosen).view(np.int64) if chosen else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(tokens), keys.take(at), sizes.take(at)], ["token", "key", "n"])


def _memberships(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """token, key, n for the prefix tokens that several different sets have in their prefix."""
    shared, frequent = _frequent_tokens(sets)
    sent = sets.sparkSession.sparkContext.broadcast(frequent)
    none = np.empty(0, np.uint64)

    def prefixes(batch: pa.RecordBatch) -> list[np.ndarray | None]:
        order = Order(*sent.value)
        lists, sizes = batch.column(2), batch.column(1).to_pylist()
        values, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        return [order.from_head(values[a:b], n) for a, b, n in zip(ends, ends[1:], sizes)]

    def from_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [none if p is None else p for p in prefixes(batch)]
            yield _token_rows(batch, batch.column(0), batch.column(1), found)

    def left_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select([3]).filter(pa.array([p is None for p in prefixes(batch)], pa.bool_()))

    def from_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(*sent.value)
        for part, made in _texts(batches):
            keys, sizes = pa.array([key_of(s) for s in made], pa.binary()), pa.array([len(s) for s in made], pa.int32())
            yield _token_rows(part, keys, sizes, [order.prefix(s) for s in made])

    rows = sets.where("n > 0").select("key", "n", "head", "doc_id")
    # Sets that consist of frequent shingles for the most part need tokens behind their head.
    again = materialize(rows.mapInArrow(left_open, "doc_id bigint").distinct(), "open-heads")
    more = materialize(_only(docs, again, "doc_id").mapInArrow(from_texts, "token bigint, key binary, n int"), "long-prefixes")
    known = materialize(shared.select("token").unionByName(more.select("token")).distinct(), "known-shingles")
    pages, bits = known_keys(known, "token", "shingle-filter")
    maybe = probe(rows.mapInArrow(from_heads, "token bigint, key binary, n int"), pages, "token", bits, "hit").where("hit").drop("hit")
    once = materialize(maybe.unionByName(more).groupBy("token", "key").agg(F.first("n").alias("n")), "prefixes")
    several = once.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    return once.join(several, "token")


def _only(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` may be in ``wanted``: all that are, and few others."""
    pages, bits = known_keys(wanted, key, "wanted-filter")
    return probe(rows, pages, key, bits, "hit").where("hit").drop("hit")


def _allowed(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pairs (a, b) whose count vectors allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [overlap_bound(x, y) >= least_overlap(n, m) for n, m, x, y in zip(*[batch.column(i).to_pylist() for i in range(2, 6)])]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left, right = (vectors.select(F.col("key").alias(k), F.col("n").alias(f"n_{k}"), F.col("counts").alias(f"counts_{k}")) for k in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "counts_a", "counts_b")
    return both.mapInArrow(run, "a binary, b binary")


def _pair_sets(pairs: DataFrame, docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """key, tokens of the sets of ``pairs`` (a, b). Only the texts of their first documents are read again."""
    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    needed = materialize(firsts.join(keys, "key", "left_semi"), "pair-documents")

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, made in _texts(batches):
            keys = pa.array([key_of(s) for s in made], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))], ["key", "tokens"])

    found = _only(docs, needed.select("doc_id"), "doc_id").mapInArrow(tokens_of, "key binary, tokens array<bigint>")
    return materialize(found.join(needed.select("key"), "key", "left_semi").dropDuplicates(["key"]), "pair-sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ((c.values.to_numpy().view(np.uint64), c.offsets.to_numpy()) for c in (batch.column(2), batch.column(3)))
            keep = [linked(x[0][x[1][i] : x[1][i + 1]], y[0][y[1][i] : y[1][i + 1]]) for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.select(F.col("key").alias(k), F.col("tokens").alias(f"tokens_{k}")) for k in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "tokens_a", "tokens_b").mapInArrow(run, "a binary, b binary")


def _verified_in_blocks(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Linked pairs of ``pairs`` (a, b), as many as it takes to join whatever they join.

    Keys are dealt to blocks of about ``BLOCK`` by hash. A set goes once to each pair of blocks
    that needs it and not once to each pair of sets, and a pair that links of the same two
    blocks have joined already is not looked at.
    """
    blocks = max(1, ceil(sets.count() / BLOCK))
    x, y = (F.pmod(F.xxhash64(k), F.lit(blocks)).cast("int") for k in "ab")
    asked = pairs.select(F.least(x, y).alias("low"), F.greatest(x, y).alias("high"), "a", "b")
    ends = [asked.select("low", "high", F.col(k).alias("key")) for k in "ab"]
    needed = ends[0].unionByName(ends[1]).distinct().join(sets, "key")
    needed = needed.select("low", "high", F.col("key").alias("a"), F.lit(None).cast("binary").alias("b"), "tokens")
    both = needed.unionByName(asked.withColumn("tokens", F.lit(None).cast("array<bigint>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, 2):
            held = {a: np.array(tokens, np.int64).view(np.uint64) for a, b, tokens in rows if b is None}
            joined = Joined()
            found = [(a, b) for a, b, _ in rows if b is not None and joined.apart(a, b) and linked(held[a], held[b]) and joined.join(a, b)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["a", "b"])

    return both.repartition("low", "high").sortWithinPartitions("low", "high").mapInArrow(run, "a binary, b binary")


def _close(n: str, m: str):
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def _star_pairs(located: DataFrame) -> DataFrame:
    """Each member of a token group with one leader of it, where their components differ."""
    rank = F.struct(F.xxhash64("token", "key").alias("h"), F.col("key").alias("key"), F.col("n").alias("n"), F.col("root").alias("root"))
    led = located.groupBy("token").agg(F.min(rank).alias("lead"))
    met = located.join(led, "token").where((F.col("root") != F.col("lead.root")) & _close("n", "lead.n"))
    return met.select(F.least("key", "lead.key").alias("a"), F.greatest("key", "lead.key").alias("b")).distinct()


def _tree_pairs(located: DataFrame, vectors: DataFrame) -> DataFrame:
    """All pairs of different components within a token group that its R-trees let pass.

    A group of over ``CELL`` members is cut into slices by the members' hashes; each pair of
    slices is a cell of its own, so no task holds a whole large group. A pair that meets in
    several groups is left to the first of them, as far as the few first tokens of both tell.
    """
    firsts = located.groupBy("key").agg(F.slice(F.sort_array(F.collect_set("token")), 1, FIRST_TOKENS).alias("firsts"))
    vectors = vectors.select("key", "counts").join(firsts, "key")
    cut = F.ceil(F.col("members") / CELL).cast("int")
    placed = located.withColumn("cut", cut).withColumn("own", F.pmod(F.xxhash64("key"), F.col("cut")).cast("int"))
    meets = placed.join(vectors, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    cells = meets.select(
        "token", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "key", "root", "n", "counts", "own", "firsts"
    )
    ready = cells.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")
    return ready.mapInArrow(_cells, "a binary, b binary").distinct()


def _located(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the groups that still span several components."""
    placed = members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    spans = placed.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token")
    return materialize(placed.join(spans, "token", "left_semi"), "open-groups")


def shingle_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    A document's set holds its distinct shingles of four words (A-Z lower-cased; all words if
    they are fewer). Documents are linked if 100 times the intersection is at least 85 times
    the union; component_id is the least doc_id that links reach.

    Equal sets are one node. A shingle of one document links nothing, and of the others a
    node's prefix suffices to meet every partner (``prefix_length``); frequent shingles stand
    last in it, so that a common passage brings only those together that consist of it. The
    members of a shingle's group are compared with a leader; groups that still span several
    components then go through R-trees of count vectors, all pairs of theirs, and the
    survivors are verified on the sets. No pair is cut off by a cap; the table of frequent
    shingles is bounded, and what it leaves out is only ordered differently.

    What is kept of a document is its count vector and the first tokens by hash, about a
    quarter of the set; frequency is counted there. The texts of those that need more, and of
    the surviving pairs, are read again.

    Shingles are 64-bit hashes of word hashes; keys of sets are 128-bit hashes.

    Cases: a text without words (null, empty, only blanks) has 0 shingles and is its own
    component. Rows that agree in doc_id each have a row with the same component if their
    sets are linked. A null doc_id counts as greater than all others; a component of such
    rows only has a null id. An empty table gives no rows. Other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sets = materialize(rows.mapInArrow(_sets, _SETS), "shingle-sets")
    members = materialize(_memberships(rows, sets), "memberships")

    # The nodes of members only, with their first document.
    worded = sets.where("n > 0").select("key", "n", "counts", "doc_id")
    wanted = _only(worded, materialize(members.select("key").distinct(), "nodes"), "key")
    nodes = materialize(
        wanted.groupBy("key").agg(F.first("n").alias("n"), F.first("counts").alias("counts"), F.min("doc_id").alias("doc_id")), "node-vectors"
    )
    firsts = nodes.select("key", "doc_id")

    located, links = members.withColumn("root", F.col("key")), None
    roots = members.sparkSession.createDataFrame([], "key binary, root binary")
    for turn in ROUNDS:
        if turn == "star":
            pairs = _allowed(materialize(_star_pairs(located), "star-pairs"), nodes)
        else:
            # A group of two is its leader and the other one.
            pairs = _tree_pairs(located.where("members > 2") if "star" in ROUNDS else located, nodes)
        pairs = materialize(pairs, "candidates")
        if pairs.isEmpty():
            continue
        held = _pair_sets(pairs, rows, firsts)
        found = materialize(_verified(pairs, held) if turn == "star" else _verified_in_blocks(pairs, held), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = components(links)
        if turn != ROUNDS[-1]:
            located = _located(members, roots)
    return _components(sets, roots)


def _components(sets: DataFrame, roots: DataFrame) -> DataFrame:
    rows = sets.select("doc_id", "key", "n")
    worded = rows.where("n > 0").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")).drop("key")
    placed = materialize(worded, "placed-sets")
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(least, "root").select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.unionByName(alone)
