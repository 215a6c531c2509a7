"""Near-duplicates by Order MinHash, verified by banded alignment."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.llm.bloom import known_keys, probe
from shelflog.llm.common import append_column, column, fresh, id_and_text
from shelflog.llm.decontaminate import words
from shelflog.llm.hashing import mix
from shelflog.session import materialize

SHINGLE = 3
SKETCHES = 64
KEPT = 2  # k-mers in a sketch
SIMILARITY = 0.8
SMALL = 32  # nodes up to which all of a band are compared with each other
CELL = 1024  # nodes of a band whose pairs are listed at once, at most
BLOCK = 512  # nodes of a block, about
WIDE = 4096  # word counts kept of each text of a block
LISTED = 1 << 18  # pairs a task lists before it hands them on
COMMON = 1 << 20  # entries of the table of common k-mers, at most
WORDS_KEPT = 6  # labelled words in a second sketch
BUCKETS = 128  # word counts kept of each text
_MATRIX = 1 << 21  # hashes held at once
_SUBSETS = 100  # most rests of equal length that a short text lists


def allowed(n: int, m: int, least: float) -> int:
    """Most edits at which 1 - edits / longer length is still ``least``."""
    return int(max(n, m) * (1 - least) + 1e-9)


def exact_words(least: float) -> int:
    """Most words of a text whose rests without the allowed edits are few enough to list."""
    n = 0
    while n < _SUBSETS and comb(n + 1, allowed(n + 1, 0, least)) <= _SUBSETS:
        n += 1
    return n


class Rests:
    """Hashes of what is left of a short text when some of its words are left out.

    Texts of n >= m words with at most e edits have n - e words in common, in order. So both
    list all their rests of n - e words, for each n that a partner may have, and no pair of
    texts with at most ``exact_words`` words is missed.
    """

    def __init__(self, least: float):
        self.longest = exact_words(least)
        self.sizes = {n: n - allowed(n, 0, least) for n in range(1, self.longest + 1)}
        self.chosen: dict = {}

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        n = len(ids)
        if n > self.longest:
            return np.empty(0, np.uint64)
        out = []
        for size in {self.sizes[m] for m in range(n, self.longest + 1)}:
            if size > n:
                continue
            if (n, size) not in self.chosen:
                self.chosen[n, size] = np.array(list(combinations(range(n), size)), np.int64).reshape(-1, size)
            at = self.chosen[n, size]
            rest = mix(np.full(len(at), (1 << 32) + size, np.uint64))
            for j in range(size):
                rest = mix(rest * np.uint64(0x9E3779B97F4A7C15) + ids[at[:, j]])
            out.append(rest)
        return np.unique(np.concatenate(out))


class OrderMinHash:
    """Sketches of whole texts: of each of ``sketches`` random orders the least k-mers.

    A k-mer is ``k`` words with the number of its earlier occurrences; the chosen ones are
    listed as they stand in the text, and their hash is the sketch. The ``Rests`` of a short
    text are added to its sketches.
    """

    def __init__(self, k: int = SHINGLE, sketches: int = SKETCHES, kept: int = KEPT, similarity: float = SIMILARITY):
        self.k, self.kept, self.rests = k, kept, Rests(similarity)
        self.seeds = mix(np.arange(1, sketches + 1, dtype=np.uint64)) | np.uint64(1)

    def __call__(self, texts: list[bytes | None]) -> list[dict]:
        return [self.one(t) for t in texts]

    def one(self, text: bytes | None) -> dict:
        found = words(text)
        joined = b" ".join(found)
        if not found:
            return {"key": None, "words": 0, "sketch": []}
        ids = self.ids(found)
        grams, labelled = self.labelled(ids, self.k)
        sketch = np.concatenate([self.sketches(grams, labelled, self.kept, 0), self.rests(ids)])
        key = hashlib.blake2b(joined, digest_size=16).digest()
        return {"key": key, "words": len(ids), "sketch": sketch.view(np.int64).tolist()}

    def ids(self, found: list[bytes]) -> np.ndarray:
        """Hashes of words."""
        names: dict[bytes, int] = {}
        return np.array([names.get(w) or names.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in found], np.uint64)

    def labelled(self, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-mers, without and with the number of earlier occurrences."""
        k = min(k, len(ids))
        n = len(ids) - k + 1
        at = np.arange(n)
        grams = np.full(n, k, np.uint64)
        for j in range(k):
            grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n])
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        label = np.empty(n, np.uint64)
        label[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
        return grams, mix(grams + label * np.uint64(0x9E3779B97F4A7C15))

    def sketches(self, grams: np.ndarray, labelled: np.ndarray, kept: int, family: int) -> np.ndarray:
        """One hash per order: the ``kept`` least of ``labelled``, as they stand in the text."""
        n = len(grams)
        kept = min(kept, n)
        chosen = np.empty((len(self.seeds), kept), np.int64)
        step = max(1, _MATRIX // n)
        for a in range(0, len(self.seeds), step):
            table = labelled[None, :] * self.seeds[a : a + step, None]
            rows = np.arange(len(table))
            for j in range(kept):
                chosen[a : a + step, j] = least = table.argmin(axis=1)
                table[rows, least] = np.uint64(0xFFFFFFFFFFFFFFFF)
        chosen.sort(axis=1)
        sketch = mix(np.arange(len(self.seeds), dtype=np.uint64) + np.uint64(1 + 1000 * family))
        for j in range(kept):
            sketch = mix(sketch * np.uint64(0x9E3779B97F4A7C15) + grams[chosen[:, j]])
        return sketch


class SecondSketches:
    """Sketches of texts that share common k-mers with many others that they don't resemble.

    Similar texts of n words with e edits share all but 3 e of their n - 2 three-word k-mers. So
    either a text has at least that many common k-mers (less n / 10), or over n / 10 of the
    shared ones are not common. The second case is met by sketches of one k-mer that is not
    common. In the first, texts get sketches of six labelled words: edits spoil as many words as
    they are, wherever they stand, so two thirds of all words of similar texts agree at 0.8.
    """

    def __init__(self, common: np.ndarray, similarity: float = SIMILARITY, sketches: int = SKETCHES):
        self.common, self.least, self.hashes = common, similarity, OrderMinHash(sketches=sketches, similarity=similarity)

    def grams(self, text: bytes | None) -> list[int]:
        """The different k-mers of a text."""
        ids = self.hashes.ids(words(text))
        return np.unique(self.hashes.labelled(ids, SHINGLE)[0]).view(np.int64).tolist()

    def one(self, text: bytes | None) -> list[int]:
        ids = self.hashes.ids(words(text))
        grams, labelled = self.hashes.labelled(ids, SHINGLE)
        common = np.zeros(len(grams), bool)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, grams), len(self.common) - 1)
            common = self.common[at] == grams
        out = []
        if not common.all():
            out.append(self.hashes.sketches(grams[~common], labelled[~common], 1, 1))
        if common.sum() >= len(grams) - SHINGLE * allowed(len(ids), 0, self.least) - len(ids) / 10:
            out.append(self.hashes.sketches(*self.hashes.labelled(ids, 1), WORDS_KEPT, 2))
        return np.unique(np.concatenate(out)).view(np.int64).tolist()


class Aligner:
    """Edit distance to one sequence of words, within a band around the main diagonal.

    A column of the band is two whole numbers, one bit per cell: where a cell is one more and
    where it is one less than the cell above. A new column follows from the last by a few
    operations on whole numbers (a band-wise form of Myers' bit-parallel algorithm), and the
    distance is counted along the diagonal that ends in the last cell. The places of words are
    kept by blocks of rows, so that memory is in proportion to the text.
    """

    ROWS = 4096

    def __init__(self, sequence: list):
        self.size = len(sequence)
        self.blocks: list[dict] = [{} for _ in range(0, self.size, self.ROWS)]
        for i, word in enumerate(sequence):
            places = self.blocks[i // self.ROWS]
            places[word] = places.get(word, 0) | 1 << i % self.ROWS

    def places(self, word, first: int, count: int) -> int:
        """Bit b is set if ``word`` stands in row ``first`` + b; rows from 0, ``count`` at least."""
        found = 0
        for block in range(max(first, 0) // self.ROWS, min((first + count) // self.ROWS + 1, len(self.blocks))):
            bits = self.blocks[block].get(word)
            if bits:
                shift = block * self.ROWS - first
                found |= bits << shift if shift >= 0 else bits >> -shift
        return found

    def distance(self, other: list, most: int) -> int | None:
        """The distance to ``other`` if it is at most ``most``, else None."""
        goal = self.size - len(other)
        if abs(goal) > most:
            return None
        cells = (1 << 2 * most + 1) - 1
        # Bit b of column j is row b + j - most; above row 1 all cells of a column are equal.
        more, less = cells ^ (1 << most) - 1, 0
        followed = 1 << goal + most
        found = abs(goal)
        for j, word in enumerate(other, 1):
            equal = self.places(word, j - most - 1, 2 * most + 1) & cells
            same = ((equal & more) + more ^ more | equal | less) & cells
            right_more = less | cells & ~(same | more)
            right_less = same & more
            if not same & followed and j + goal >= 1:
                found += 1
                if found > most:
                    return None
            below = same >> 1
            more, less = right_less | cells & ~(below | right_more), below & right_more
        return found


def banded_distance(a: list, b: list, most: int) -> int | None:
    return Aligner(a).distance(b, most)


def similar(a: list, b: list, least: float = SIMILARITY) -> bool:
    return banded_distance(a, b, allowed(len(a), len(b), least)) is not None


def word_counts(text: bytes | None) -> bytes | None:
    """Words of a text per bucket of their hash; None if a count takes over a byte."""
    counts = [0] * BUCKETS
    for word in words(text):
        counts[crc32(word) % BUCKETS] += 1
    return bytes(counts) if max(counts) < 256 else None


def _sides(pairs: DataFrame, texts: DataFrame, value: str) -> DataFrame:
    left = texts.select(F.col("key").alias("a"), F.col(value).alias("value_a"))
    right = texts.select(F.col("key").alias("b"), F.col(value).alias("value_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", F.col("value_a").cast("binary"), F.col("value_b").cast("binary"))


class Joined:
    """Keys joined step by step."""

    def __init__(self):
        self.above: dict = {}

    def root(self, key):
        while (up := self.above.get(key, key)) != key:
            self.above[key] = self.above.get(up, up)
            key = up
        return key

    def apart(self, a, b) -> bool:
        return self.root(a) != self.root(b)

    def join(self, a, b) -> bool:
        self.above[self.root(a)] = self.root(b)
        return True


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those pairs of text keys (a, b) whose texts are similar.

    Similar texts have at least the longer one's words less the allowed edits in common, so
    only pairs whose word counts per bucket allow that get their texts.
    """

    def allow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if x is None or y is None:
                    ok.append(True)
                    continue
                p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                longer = int(max(p.sum(), q.sum()))
                ok.append(int(np.minimum(p, q).sum()) >= longer - allowed(longer, 0, least))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    likely = materialize(_sides(pairs, texts, "counts").mapInArrow(allow, "a binary, b binary"), "likely")
    both = _sides(likely, texts, "text")  # few of them don't have the words in common, which is found first

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, aligner, held = None, Aligner([]), Counter()  # pairs come sorted by b
        for batch in batches:
            ok = []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if b != key:
                    found = words(y.as_py())
                    key, aligner, held = b, Aligner(found), Counter(found)
                other = words(x.as_py())
                most = allowed(aligner.size, len(other), least)
                enough = (held & Counter(other)).total() >= max(aligner.size, len(other)) - most
                ok.append(enough and aligner.distance(other, most) is not None)
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(check, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """Least key reachable from each key of ``links`` (a, b): columns key, root.

    Large-star and small-star steps in turn hang every key below its component's least; each
    step is a grouped minimum and a join, and writes its links.
    """
    now = materialize(links.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(), "links")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high"))).first())

    before = state(now)
    while True:
        both = now.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            now.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("low"), F.col("v").alias("high"))
        large = materialize(large.where("low <> high").distinct(), "large-star")
        low = materialize(large.groupBy("high").agg(F.min("low").alias("m")), "star")
        small = (
            large.join(low, "high")
            .select(F.explode(F.array(F.struct("m", F.col("low").alias("x")), F.struct("m", F.col("high").alias("x")))).alias("l"))
            .select(F.col("l.m").alias("low"), F.col("l.x").alias("high"))
        )
        now = materialize(small.where("low <> high").distinct(), "small-star")
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select("low").distinct().select(F.col("low").alias("key"), F.col("low").alias("root"))
    return materialize(now.select(F.col("high").alias("key"), F.col("low").alias("root")).unionByName(roots), "roots")


SKETCHED = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("words", T.IntegerType()),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ]
)


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, sketches: int = SKETCHES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, class_id, class_size, kept.

    Words are taken as in the benchmark search (small letters, no punctuation). Texts with
    equal words are one node, so copies cost nothing further. Nodes that share an Order
    MinHash sketch of three-word k-mers are candidates, and so are nodes of few words (14 at
    a similarity of 0.8) that share a rest (``Rests``), which misses no pair of them; a pair is linked if the banded
    alignment of its whole word sequences has a similarity (1 - edits / longer length) of
    ``similarity`` or more. Classes are the components of the links; class_id is the least
    doc_id in it, and that row is ``kept``.

    All nodes with a sketch are compared with one leader. Of sketches whose nodes are still in
    several components, those of up to ``SMALL`` nodes compare all of them. The nodes of larger
    ones share k-mers that are common among them; they meet by ``SecondSketches`` instead,
    with one leader first; where components are left in a second sketch, all pairs across them
    are compared in ``_blocks``. A large group so costs one comparison per node, texts around a
    frequent passage don't meet by it, and no cap hides a pair. The table of common k-mers
    holds the most frequent 2^20; k-mers beyond it only count as not common.

    Cases: a text without words (null, empty, only signs) is a class of its own and kept. Of
    rows that agree in doc_id and words one is kept. A null doc_id comes after all others.
    Texts under three words have one k-mer. An empty table gives no rows. Other columns are
    not read.
    """
    rows = id_and_text(docs, id_col, text_col)
    sketched = append_column(rows, "text", "node", SKETCHED, lambda: OrderMinHash(sketches=sketches, similarity=similarity))
    nodes = materialize(sketched.select("doc_id", "node.*"), "sketches")
    distinct = nodes.where("words > 0").groupBy("key").agg(F.first("words").alias("words"), F.first("sketch").alias("sketch"))
    banded = materialize(distinct, "distinct").select("key", "words", F.explode("sketch").alias("band"))
    shared = materialize(banded.groupBy("band").count().where("count > 1").select("band"), "shared-bands")
    # Most bands are alone; those surely alone don't move.
    band_pages, band_bits = known_keys(shared, "band", "band-filter")
    maybe = probe(banded, band_pages, "band", band_bits, "hit").where("hit").drop("hit")
    members = materialize(maybe.join(shared, "band", "left_semi"), "members")
    needed = materialize(members.select("key").distinct(), "candidates")
    pages, n_bits = known_keys(needed, "key", "candidate-filter")
    first = nodes.where("words > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    texts = _texts_of(docs, id_col, text_col, needed, pages, n_bits, first)

    links = materialize(_verified(materialize(_led(members.withColumn("root", F.col("key")), 1, similarity), "pairs"), texts, similarity), "verified")
    roots = components(links)
    located = _open(members, roots)
    if located.isEmpty():
        return _classes(nodes, roots)
    second = _second_members(located.where(F.col("n") > SMALL), texts, similarity, sketches)
    pairs = _led(located.where(F.col("n") <= SMALL), SMALL, similarity, 1).unionByName(_led(_placed(second, roots), 1, similarity))
    pairs = materialize(pairs.distinct().join(links, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(materialize(_verified(pairs, texts, similarity), "verified"))
    roots = components(links)
    located = _open(second, roots, 1)
    if not located.isEmpty():
        links = links.unionByName(materialize(_blocks(located, texts, similarity), "verified"))
        roots = components(links)
    return _classes(nodes, roots)


def _led(located: DataFrame, leaders: int, similarity: float, compared: int = 0) -> DataFrame:
    """Pairs (a, b) between the rows of each band and its leaders of rank ``compared`` + 1 to ``leaders``."""
    order = Window.partitionBy("band").orderBy(F.xxhash64("key"), F.col("key"))
    led = located.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= leaders) & (F.col("rank") > compared))
    led = materialize(led.select("band", F.col("key").alias("b"), F.col("words").alias("words_b"), F.col("root").alias("root_b")), "leaders")
    near = F.least("words", "words_b") >= F.greatest("words", "words_b") * similarity - 1e-9
    pairs = located.join(led, "band").where((F.col("root") != F.col("root_b")) & near)
    return pairs.select(F.least("key", "b").alias("a"), F.greatest("key", "b").alias("b")).distinct()


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))


def _blocks(located: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Linked pairs (a, b) of different roots in the bands of ``located`` that join all such pairs join.

    Texts that consist of one passage for the most part are nearly similar to each other, so
    their pairs are many. Nodes are dealt to blocks of about ``BLOCK`` by hash. Bands are cut
    into cells of at most ``CELL`` nodes a side, whose pairs are listed by pair of blocks; a
    text goes once to each pair of blocks that needs it and not once to each pair, and no task
    holds more texts than two blocks have.
    """
    nodes = located.select("key").distinct().count()
    cut, blocks = F.ceil(F.col("n") / CELL).cast("int"), max(1, ceil(nodes / BLOCK))
    placed = located.withColumn("own", F.pmod(F.xxhash64("key"), cut).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), cut - 1)))
    cells = cells.select("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "key", "words", "root", "block")

    def pairs_of(rows: list[tuple]) -> Iterator[tuple]:
        own, keys, sizes, named, block = zip(*rows)
        names = {r: i for i, r in enumerate(dict.fromkeys(named))}
        own, sizes, roots = np.array(own), np.array(sizes, np.int64), np.array([names[r] for r in named])
        met = np.minimum.outer(sizes, sizes) >= np.maximum.outer(sizes, sizes) * least - 1e-9
        met &= roots[:, None] != roots[None, :]
        if own.min() != own.max():
            met &= own[:, None] != own[None, :]
        for i, j in np.argwhere(np.triu(met, 1)).tolist():
            yield ((block[i], keys[i]), (block[j], keys[j])) if (block[i], keys[i]) < (block[j], keys[j]) else ((block[j], keys[j]), (block[i], keys[i]))

    def batch_of(pairs: set) -> pa.RecordBatch:
        lists: dict = {}
        needed = set()
        for (low, a), (high, b) in pairs:
            lists.setdefault((low, high, a), []).append(b)
            needed.add((low, high, b))
        rows = [*((*k, v) for k, v in lists.items()), *((*k, None) for k in needed if k not in lists)]
        low, high, key, partners = zip(*rows)
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((low, high, key, partners), kinds)], ["low", "high", "key", "partners"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: set = set()
        for _, rows in runs(batches, 3):
            pairs.update(pairs_of(rows))
            if len(pairs) > LISTED:
                yield batch_of(pairs)
                pairs = set()
        if pairs:
            yield batch_of(pairs)

    ready = cells.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    lists = materialize(ready.mapInArrow(listed, "low int, high int, key binary, partners array<binary>"), "near-lists")
    needed = lists.select("low", "high", "key").distinct().join(texts.select("key", F.col("text").cast("binary").alias("text")), "key")
    needed = needed.select("low", "high", "key", "text", F.lit(None).cast("array<binary>").alias("partners"))
    asked = lists.where("partners is not null").select("low", "high", "key", F.lit(None).cast("binary").alias("text"), "partners")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, 2):
            found = list(block_links(rows, least))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    both = needed.unionByName(asked).repartition("low", "high").sortWithinPartitions("low", "high")
    return both.mapInArrow(check, "a binary, b binary")


def runs(batches: Iterator[pa.RecordBatch], named: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that agree in the first ``named`` columns, without these; such rows follow each other."""
    name, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:named] != name:
                if held:
                    yield name, held
                name, held = row[:named], []
            held.append(row[named:])
    if held:
        yield name, held


def block_links(rows: list[tuple], least: float = SIMILARITY) -> Iterator[tuple[bytes, bytes]]:
    """Linked pairs among those that ``rows`` (key, text, partners) ask for, but none that others join.

    Word counts in ``WIDE`` buckets rule out most pairs, the others are aligned.
    """
    texts = {key: words(text) for key, text, partners in rows if partners is None}
    place = {key: i for i, key in enumerate(texts)}
    counts = np.zeros((len(texts), WIDE), np.uint32)
    for key, found in texts.items():
        counts[place[key]] = np.bincount([crc32(w) % WIDE for w in found], minlength=WIDE)
    sizes = np.array([len(found) for found in texts.values()])
    asked: dict = {}
    for key, _, partners in rows:
        if partners is not None:
            asked.setdefault(key, set()).update(partners)
    joined = Joined()
    for key, partners in asked.items():
        keys = sorted(partners)
        at = np.array([place[k] for k in keys])
        mine, aligner = place[key], None
        longer = np.maximum(sizes[at], sizes[mine])
        most = (longer * (1 - least) + 1e-9).astype(np.int64)
        shared = np.minimum(counts[at], counts[mine]).sum(axis=1)
        for i in np.flatnonzero(shared >= longer - most):
            aligner = aligner or Aligner(texts[key])
            if joined.apart(key, keys[i]) and aligner.distance(texts[keys[i]], int(most[i])) is not None:
                joined.join(key, keys[i])
                yield min(key, keys[i]), max(key, keys[i])


def _open(members: DataFrame, roots: DataFrame, compared: int = 0) -> DataFrame:
    """Rows of bands with several components and more than ``compared`` rows: also their root and the band's rows n."""
    located = _placed(members, roots)
    bands = located.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n"))
    bands = bands.where((F.col("x") != F.col("y")) & (F.col("n") > compared)).select("band", "n")
    return materialize(located.join(bands, "band"), "members")


def _second_members(crowded: DataFrame, texts: DataFrame, similarity: float, sketches: int) -> DataFrame:
    """Second sketches of the nodes of ``crowded``: key, words, band."""
    crowd = materialize(crowded.select("key", "words").distinct(), "crowd")
    held = materialize(texts.select("key", "text").join(crowd, "key"), "crowd-texts")

    def grams():
        make = SecondSketches(np.empty(0, np.uint64), similarity, sketches)
        return lambda found: [make.grams(t) for t in found]

    listed = append_column(held, "text", "grams", T.ArrayType(T.LongType()), grams)
    counts = listed.select(F.explode("grams").alias("gram")).groupBy("gram").count().where(F.col("count") > SMALL)
    most = counts.orderBy(F.desc("count"), "gram").limit(COMMON).select("gram").toArrow()
    common = np.sort(most.column(0).to_numpy().view(np.uint64))
    sent = texts.sparkSession.sparkContext.broadcast(common)

    def second():
        make = SecondSketches(sent.value, similarity, sketches)
        return lambda found: [make.one(t) for t in found]

    bands = append_column(held, "text", "bands", T.ArrayType(T.LongType()), second)
    bands = materialize(bands.select("key", "words", F.explode("bands").alias("band")), "second-bands")
    shared = bands.groupBy("band").count().where("count > 1").select("band")
    return materialize(bands.join(shared, "band", "left_semi"), "second-members")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows that ``near_classes`` doesn't keep; all columns stay.

    The kept rows are found by (doc_id, words), so documents move once, without the classes'
    texts. Rows that agree in both are told apart only where there are such rows.
    """
    classes = materialize(near_classes(docs, id_col, text_col, similarity), "classes")
    same = ["doc_id", "text_key"]
    stay = classes.where("kept and text_key is not null").select(*same).distinct()
    repeated = classes.where("text_key is not null").groupBy(*same).count().where("count > 1").select(*same)
    repeated = materialize(repeated.join(stay.select(*[F.col(c).alias(f"s_{c}") for c in same]), F.col("doc_id").eqNullSafe(F.col("s_doc_id")) & (F.col("text_key") == F.col("s_text_key")), "left_semi"), "repeated")

    def make():
        return lambda texts: [hashlib.blake2b(b" ".join(w), digest_size=16).digest() if (w := words(t)) else None for t in texts]

    key = fresh(docs.columns, "text_key")
    keyed = append_column(docs, text_col, key, T.BinaryType(), make)

    def among(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
        side = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        return rows.join(side, column(id_col).eqNullSafe(F.col("_id")) & (column(key) == F.col("_key")), how)

    wordless = keyed.where(column(key).isNull()).drop(key)
    kept = among(keyed.where(column(key).isNotNull()), stay, "left_semi")
    if not repeated.isEmpty():
        twice = among(kept, repeated, "left_semi").dropDuplicates([id_col, key])
        kept = among(kept, repeated, "left_anti").unionByName(twice)
    return wordless.unionByName(kept.drop(key))


def _texts_of(docs, id_col, text_col, needed, pages, n_bits, first) -> DataFrame:
    """One text for each needed key: key, text, counts (of words)."""
    chosen = materialize(first.join(needed, "key", "left_semi"), "first-documents")
    id_pages, id_bits = known_keys(chosen, "doc_id", "first-filter")
    rows = probe(id_and_text(docs, id_col, text_col), id_pages, "doc_id", id_bits, "hit").where("hit").select("doc_id", "text")

    def make():
        return lambda texts: [hashlib.blake2b(b" ".join(words(t)), digest_size=16).digest() for t in texts]

    keyed = append_column(rows, "text", "key", T.BinaryType(), make)
    wanted = keyed.join(chosen.withColumnRenamed("doc_id", "first_id"), "key")
    wanted = wanted.where(F.col("doc_id").eqNullSafe(F.col("first_id"))).select("key", "text").dropDuplicates(["key"])
    counted = append_column(wanted, "text", "counts", T.BinaryType(), lambda: lambda found: [word_counts(t) for t in found])
    return materialize(counted, "candidate-texts")


def _classes(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    rows = nodes.select("doc_id", "key", (F.col("words") == 0).alias("wordless"))
    lone = rows.where("wordless").select(
        "doc_id", F.lit(None).cast("binary").alias("text_key"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    worded = rows.where("not wordless").groupBy("key", "doc_id").agg(F.count("*").alias("copies"))
    placed = worded.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    placed = materialize(placed, "placed")
    rank = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"), F.col("key").alias("key"))
    sizes = materialize(
        placed.groupBy("root").agg(F.min(rank).alias("best"), F.sum("copies").alias("class_size")), "class-sizes"
    )
    grouped = placed.join(sizes, "root").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    is_best = F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("key") == F.col("best.key")) & (F.col("copy") == 1)
    grouped = grouped.select("doc_id", F.col("key").alias("text_key"), F.col("best.id").alias("class_id"), "class_size", is_best.alias("kept"))
    return lone.unionByName(grouped)
