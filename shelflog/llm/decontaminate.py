"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflog.llm.common import append_column, column, fresh
from shelflog.session import materialize

WINDOW = 10
BLOCK = 3  # words in a shift-table block
PATTERN_BYTES = 32 << 20  # benchmark text searched for at once

# A-Z become a-z, word bytes stay, all others become a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

MATCH = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])),
        ),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class Matcher:
    """Wu-Manber tables for the windows of one length, over word numbers (0: in no window)."""

    def __init__(self, length: int, windows: dict[tuple[int, ...], set[str]]):
        self.length, self.block = length, min(BLOCK, length)
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], dict[tuple[int, ...], set[str]]] = {}
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                key = window[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, length), length - end)
            self.buckets.setdefault(window[-self.block :], {}).setdefault(window, set()).update(items)

    def search(self, ids: list[int]) -> Iterator[tuple[int, set[str]]]:
        """Start and items of each occurrence."""
        length, block, shift = self.length, self.block, self.shift
        most = length - block + 1
        end, n = length, len(ids)
        while end <= n:
            if not ids[end - 1]:
                end += length
                continue
            step = shift.get(tuple(ids[end - block : end]), most)
            if step:
                end += step
                continue
            window = tuple(ids[end - length : end])
            items = self.buckets[window[-block:]].get(window)
            if items:
                yield end - length, items
            end += 1


class Searcher:
    def __init__(self, items: list[tuple[str, bytes]], length: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text))
            size = min(length, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                windows.setdefault(size, {}).setdefault(ids[at : at + size], set()).add(item)
        self.matchers = [Matcher(size, found) for size, found in sorted(windows.items())]

    def match(self, text: bytes | None) -> dict:
        found = words(text)
        number = self.vocabulary.get
        ids = [number(w, 0) for w in found]
        hits, items = [], set()
        for matcher in self.matchers:
            for at, names in matcher.search(ids):
                hits.append((at, at + matcher.length))
                items |= names
        return {"n_words": len(found), "spans": merged(hits), "items": sorted(items)}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of at most ``most`` bytes of text (one item at least)."""
    rows = benchmark.select(
        F.coalesce(column(id_col).cast("string"), F.lit("")).alias("item"),
        column(text_col).cast("binary").alias("text"),
    ).where("length(text) > 0")
    block, held = [], 0
    for row in rows.toLocalIterator():
        if block and held + len(row.text) > most:
            yield block
            block, held = [], 0
        block.append((row.item, bytes(row.text)))
        held += len(row.text)
    yield block


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    name: str = "match",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    pattern_bytes: int = PATTERN_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, spans, items.

    A window is ``window`` consecutive words of an item; a shorter item that has words is one
    window. ``spans`` are the maximal runs of document words inside occurrences, ``items``
    the sorted ids of the items found. Windows of one length share a set of Wu-Manber tables:
    the last block of words under the window tells how far to move on, blocks that end a
    window lead to a bucket, and the words themselves are compared there.

    Documents never shuffle. The tables are built from at most ``pattern_bytes`` of benchmark
    text and sent with the task; a larger benchmark is searched for block by block, each pass
    adding to the struct over a written table.

    Cases: a null or empty text has no words, no spans and no items; a null or wordless item
    matches nothing; a null item id is named by the empty string; items that share an id count
    once. Either table may be empty. All columns of ``docs`` stay as they are.
    """
    spark = docs.sparkSession

    def one_pass(rows: DataFrame, block: list[tuple[str, bytes]], out: str) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def make() -> Callable[[list], list]:
            searcher = Searcher(shared.value, window)
            return lambda texts: [as_row(searcher.match(t)) for t in texts]

        return append_column(rows, text_col, out, MATCH, make)

    blocks = _blocks(benchmark, item_col, item_text_col, pattern_bytes)
    result = one_pass(docs, next(blocks), name)
    for block in blocks:
        more = fresh(result.columns, "more")
        both = one_pass(materialize(result, "benchmark-pass"), block, more)
        result = both.withColumn(name, _union(column(name), column(more))).drop(more)
    return result


def as_row(match: dict) -> dict:
    return match | {"spans": [{"start": a, "end": b} for a, b in match["spans"]]}


@F.pandas_udf(MATCH)
def _union(first, second):
    import pandas as pd

    rows = []
    for a, b in zip(first.to_dict("records"), second.to_dict("records")):
        spans = merged([(s["start"], s["end"]) for s in [*a["spans"], *b["spans"]]])
        items = sorted({*a["items"], *b["items"]})
        rows.append({"n_words": a["n_words"], "spans": [{"start": x, "end": y} for x, y in spans], "items": items})
    return pd.DataFrame(rows, columns=["n_words", "spans", "items"])


def digest(matched: DataFrame, name: str = "match", id_col: str = "doc_id") -> DataFrame:
    hit = F.aggregate(f"{name}.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return matched.select(
        column(id_col).alias("doc_id"),
        F.col(f"{name}.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(f"{name}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{name}.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(f"{name}.spans") > 0).alias("contaminated"),
    )
