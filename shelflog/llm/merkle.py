"""Merkle manifest of a dataset, its leaves placed by ranks in bitmaps of their ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflog.llm.common import column
from shelflog.session import materialize

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
PAGE_BITS = 12
PAGE = 1 << PAGE_BITS  # ids of one bitmap
_DENSE = PAGE // 8  # bytes of a full bitmap; fewer bytes are a list of two-byte offsets
_GATHER = 1 << 18  # ids gathered in a task before their bitmaps are written
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---- bitmaps ---------------------------------------------------------------------------


def pack(offsets: np.ndarray) -> bytes:
    """Ascending different offsets as a list while that is smaller, else as a bitmap."""
    if 2 * len(offsets) < _DENSE:
        return offsets.astype("<u2").tobytes()
    bits = np.zeros(PAGE, np.uint8)
    bits[offsets] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(bits: bytes) -> np.ndarray:
    if len(bits) < _DENSE:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


class Page:
    """The ids of one page: how many rows have a smaller one, and how many have the same.

    A bitmap's directory is the running popcount of its 64-bit words. Ids of several rows
    are listed beside the bitmap with the number of their further rows.
    """

    def __init__(self, bits: bytes, more_at: bytes, more: bytes):
        self.dense = len(bits) == _DENSE
        if self.dense:
            self.words = np.frombuffer(bits, "<u8")
            counts = np.bitwise_count(self.words).astype(np.int64)
            self.directory = np.cumsum(counts) - counts
        else:
            self.offsets = np.frombuffer(bits, "<u2")
        self.more_at = np.frombuffer(more_at, "<u2")
        self.more = np.frombuffer(more, "<i8")
        self.more_before = np.concatenate([[0], np.cumsum(self.more)])

    def rank(self, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.dense:
            word, bit = offset >> 6, (offset & 63).astype(np.uint64)
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            before = self.directory[word] + np.bitwise_count(below)
        else:
            before = np.searchsorted(self.offsets, offset)
        at = np.searchsorted(self.more_at, offset)
        rows = np.ones(len(offset), np.int64)
        if len(self.more):
            here = np.minimum(at, len(self.more) - 1)
            rows += np.where(self.more_at[here] == offset, self.more[here], 0)
        return before + self.more_before[at], rows


def _packed(offsets: np.ndarray, rows: np.ndarray) -> tuple[bytes, bytes, bytes, int]:
    several = rows > 1
    return (
        pack(offsets),
        offsets[several].astype("<u2").tobytes(),
        (rows[several] - 1).astype("<i8").tobytes(),
        int(rows.sum()),
    )


def _counts(bits: bytes, more_at: bytes, more: bytes) -> tuple[np.ndarray, np.ndarray]:
    offsets = unpack(bits)
    rows = np.ones(len(offsets), np.int64)
    rows[np.searchsorted(offsets, np.frombuffer(more_at, "<u2"))] += np.frombuffer(more, "<i8")
    return offsets, rows


_PAGES = "part string, page bigint, bits binary, more_at binary, more binary, rows bigint"


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of the rows (part, page, offset) of this task, a bounded number at a time."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        parts = table.column(0).combine_chunks().dictionary_encode()
        names = parts.dictionary.to_pylist()
        code = parts.indices.to_numpy().astype(np.int64)
        page, offset = table.column(1).to_numpy(), table.column(2).to_numpy()
        order = np.lexsort((offset, page, code))
        code, page, offset = code[order], page[order], offset[order]
        first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (page[1:] != page[:-1])]))
        out = []
        for a, b in zip(first, [*first[1:], len(code)]):
            out.append((names[code[a]], int(page[a]), *_packed(*np.unique(offset[a:b], return_counts=True))))
        return _page_batch(out)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= _GATHER:
            yield flush(held)
            held, size = [], 0
    if size:
        yield flush(held)


def _page_batch(rows: list[tuple], *more: tuple[str, pa.DataType]) -> pa.RecordBatch:
    fields = [("part", pa.string()), ("page", pa.int64()), ("bits", pa.binary()), ("more_at", pa.binary()), ("more", pa.binary()), ("rows", pa.int64()), *more]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bitmap per part and page from bitmaps sorted by both, with the rows before it here."""
    from pyspark import TaskContext

    slot = TaskContext.get().partitionId()
    key, held, before, out = None, [], 0, []

    def close() -> None:
        nonlocal before
        if len(held) == 1:
            bits, more_at, more, rows = held[0]
        else:
            both = [_counts(*h[:3]) for h in held]
            offsets, where = np.unique(np.concatenate([o for o, _ in both]), return_inverse=True)
            counts = np.zeros(len(offsets), np.int64)
            np.add.at(counts, where, np.concatenate([r for _, r in both]))
            bits, more_at, more, rows = _packed(offsets, counts)
        out.append((*key, bits, more_at, more, rows, slot, before))
        before += rows

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for part, page, *body in zip(*columns):
            if (part, page) != key:
                if key is not None:
                    close()
                    if key[0] != part:
                        before = 0
                key, held = (part, page), []
            held.append(tuple(body))
        if out:
            yield _page_batch(out, ("slot", pa.int32()), ("before", pa.int64()))
            out = []
    if key is not None:
        close()
        yield _page_batch(out, ("slot", pa.int32()), ("before", pa.int64()))


def bitmap_index(ids: DataFrame) -> DataFrame:
    """Bitmaps of ``ids`` (part, doc_id, both present) with a directory of what comes before.

    Columns: part, page, bits, more_at, more, base (rows of the part on earlier pages), n
    (rows of the part). Each task makes bitmaps of its own rows; these, not the rows, are
    range-partitioned by part and page and merged. A part may take up any number of tasks;
    their totals are added up, one row per task and part.
    """
    offsets = ids.select("part", F.shiftright("doc_id", PAGE_BITS).alias("page"), F.col("doc_id").bitwiseAND(F.lit(PAGE - 1)).alias("offset"))
    gathered = materialize(offsets.mapInArrow(_gathered, _PAGES), "bitmaps")
    ranged = gathered.repartitionByRange("part", "page").sortWithinPartitions("part", "page")
    pages = materialize(ranged.mapInArrow(_merged, _PAGES + ", slot int, before bigint"), "bitmap-pages")
    totals = pages.groupBy("part", "slot").agg(F.sum("rows").alias("rows"))
    of_part = Window.partitionBy("part")
    earlier = F.sum("rows").over(of_part.orderBy("slot")) - F.col("rows")
    starts = totals.select("part", "slot", earlier.alias("start"), F.sum("rows").over(of_part).alias("n"))
    return pages.join(starts, ["part", "slot"]).select("part", "page", "bits", "more_at", "more", (F.col("start") + F.col("before")).alias("base"), "n")


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of rows that follow their page's bitmap; rows of a page are one run of the input."""
    page, base, n = None, 0, 0
    for batch in batches:
        bits = batch.column(0)
        starts = np.flatnonzero(bits.is_valid().to_numpy(zero_copy_only=False))
        offset = batch.column(3).to_numpy(zero_copy_only=False)
        rank, rows, size = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for a, b in zip([-1, *starts], [*starts, batch.num_rows]):
            if a >= 0:
                page = Page(bits[a].as_py(), batch.column(1)[a].as_py(), batch.column(2)[a].as_py())
                base, n = batch.column(4)[a].as_py(), batch.column(5)[a].as_py()
            if b > a + 1:
                before, same = page.rank(offset[a + 1 : b].astype(np.int64))
                rank[a + 1 : b], rows[a + 1 : b], size[a + 1 : b] = base + before, same, n
        keep = pa.array(batch.column(0).is_null())
        out = pa.RecordBatch.from_arrays(
            [batch.column(6), batch.column(7), batch.column(8), batch.column(9), pa.array(rank), pa.array(rows), pa.array(size)],
            ["part", "doc_id", "leaf", "tampered", "rank", "rows", "n"],
        )
        yield out.filter(keep)


_LEAVES = "part string, doc_id bigint, leaf string, tampered string"


def placed_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves`` (part, doc_id, leaf, tampered) with ``rank`` in the part and its size ``n``.

    Rows meet the bitmap of their page and are ranked there; they are not sorted by id. Rows
    that share their id (or have none; these come first) follow each other by leaf.
    """
    index = materialize(bitmap_index(leaves.where("doc_id is not null").select("part", "doc_id")), "bitmap-index")
    none = "cast(null as {0}) {1}"
    maps = index.selectExpr(
        "bits", "more_at", "more", none.format("bigint", "offset"), "base", "n", "part",
        *[none.format(t, c) for c, t in (("doc_id", "bigint"), ("leaf", "string"), ("tampered", "string"))], "page",
    )
    rows = leaves.where("doc_id is not null").select(
        *[F.lit(None).cast("binary").alias(c) for c in ("bits", "more_at", "more")],
        F.col("doc_id").bitwiseAND(F.lit(PAGE - 1)).alias("offset"),
        F.lit(None).cast("bigint").alias("base"),
        F.lit(None).cast("bigint").alias("n"),
        "part",
        "doc_id",
        "leaf",
        "tampered",
        F.shiftright("doc_id", PAGE_BITS).alias("page"),
    )
    met = maps.unionByName(rows).repartition("part", "page").sortWithinPartitions("part", "page", F.col("bits").isNull())
    ranked = materialize(met.drop("page").mapInArrow(_ranked, _LEAVES + ", rank bigint, rows bigint, n bigint"), "ranked")

    without = leaves.where("doc_id is null")
    known = index.select("part", "n").distinct()
    blanks = materialize(without.groupBy("part").agg(F.count("*").alias("blank")), "leaves-without-id")
    if blanks.isEmpty():
        tied, ranked_all = ranked.where("rows > 1"), ranked
    else:
        # Rows without an id precede all others of their part.
        ranked_all = ranked.join(blanks, "part", "left").na.fill(0, ["blank"])
        ranked_all = ranked_all.withColumns({"rank": F.expr("rank + blank"), "n": F.expr("n + blank")}).drop("blank")
        sizes = blanks.join(known, "part", "left").select("part", "blank", (F.coalesce("n", F.lit(0)) + F.col("blank")).alias("n"))
        first = without.join(sizes, "part").select(
            "part", "doc_id", "leaf", "tampered", F.lit(0).cast("bigint").alias("rank"), F.col("blank").alias("rows"), "n"
        )
        tied = ranked_all.where("rows > 1").unionByName(first)
    single = ranked_all.where("rows = 1").drop("rows")
    if tied.isEmpty():
        return single
    equal = tied.groupBy("part", "doc_id", "leaf", "tampered", "rank", "n").agg(F.count("*").alias("copies"))
    spread = numbered(equal, ["part", "rank", "leaf"], ["part", "rank"], "copies")
    apart = spread.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return single.unionByName(
        apart.select("part", "doc_id", "leaf", "tampered", (F.col("rank") + F.col("before") + F.col("copy") - 1).alias("rank"), "n")
    )


def numbered(rows: DataFrame, order: list[str], within: list[str], size: str | None = None) -> DataFrame:
    """``rows`` with ``before``: the sum of ``size`` (or the number) of the rows ahead, per ``within``.

    Rows are range-partitioned and summed up inside each slot; the slots' totals are one row
    per slot and group. No task sees a whole large group.
    """
    step = F.lit(1).cast("bigint") if size is None else F.col(size)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    slots = materialize(ranged.withColumn("_slot", F.spark_partition_id()).withColumn("_step", step), "numbered")
    totals = slots.groupBy("_slot", *within).agg(F.sum("_step").alias("_sum"))
    ahead = F.sum("_sum").over(Window.partitionBy(*within).orderBy("_slot")) - F.col("_sum")
    totals = totals.withColumn("_ahead", ahead).drop("_sum")
    here = F.sum("_step").over(Window.partitionBy("_slot", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_step")
    return slots.withColumn("_here", here).join(totals, ["_slot", *within]).withColumn("before", F.col("_here") + F.col("_ahead")).drop("_slot", "_step", "_here", "_ahead")


# ---- the tree --------------------------------------------------------------------------


def digest_of(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """A value as the leaf hashes it: its UTF-8 size, a colon, the text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _runs(nodes: DataFrame, extra: list[str], label: str) -> DataFrame:
    """Slot arrays: the nodes (tree, idx, n, digest) of each parent, by their place in it."""
    slot = F.struct((F.col("idx") % FAN_OUT).cast("int").alias("slot"), "digest", *extra)
    grouped = nodes.where("n > 1").groupBy("tree", F.expr(f"idx div {FAN_OUT}").alias("parent"), "n")
    return materialize(grouped.agg(F.sort_array(F.collect_list(slot)).alias("slots")), label)


class Levels:
    """Slot arrays of every level of a forest of trees, and its finished trees' roots."""

    def __init__(self, nodes: DataFrame, extra: list[str]):
        self.runs: list[DataFrame] = []
        self.finished: list[DataFrame] = []
        most = nodes.agg(F.max("n")).first()[0] or 0
        while most > 0:
            own = extra if not self.runs else []
            self.finished.append(nodes.where("n = 1").select("tree", "idx", "digest", *own))
            if most == 1:
                break
            runs = _runs(nodes, own, "slot-arrays")
            self.runs.append(runs)
            whole = F.array_join(F.col("slots.digest"), "")
            nodes = runs.select("tree", F.col("parent").alias("idx"), F.expr(f"(n + {FAN_OUT - 1}) div {FAN_OUT}").alias("n"), digest_of(whole).alias("digest"))
            most = -(-most // FAN_OUT)

    def roots(self) -> DataFrame:
        out = self.finished[0].select("tree", "digest")
        for more in self.finished[1:]:
            out = out.unionByName(more.select("tree", "digest"))
        return out

    def paths(self, above: DataFrame, extra: list[str]) -> DataFrame:
        """Each lowest node with its siblings up to the root: tree, idx, digest, path, and ``extra``.

        ``above`` (tree, path, carried columns) goes on from the trees' roots. Only the runs'
        rows, one per parent, move on the way down.
        """
        carried = [c for c in above.columns if c not in ("tree", "path")]
        down = None
        for level in range(len(self.finished) - 1, -1, -1):
            own = extra if level == 0 else []
            here = self.finished[level].join(above, "tree").select("tree", "idx", "digest", "path", *own, *carried)
            if down is not None:
                met = self.runs[level].join(down.drop("digest"), (self.runs[level]["tree"] == down["tree"]) & (self.runs[level]["parent"] == down["idx"])).drop(down["tree"]).drop("idx")
                met = met.select("tree", "parent", F.col("slots.digest").alias("all"), F.posexplode("slots").alias("at", "s"), "path", *carried)
                join = lambda a, n: F.array_join(F.slice("all", a, n), "")
                step = F.struct(join(F.lit(1), F.col("at")).alias("left"), join(F.col("at") + 2, F.lit(FAN_OUT)).alias("right"))
                met = met.select(
                    "tree", (F.col("parent") * FAN_OUT + F.col("s.slot")).alias("idx"), F.col("s.digest").alias("digest"),
                    F.concat(F.array(step), "path").alias("path"), *[F.col(f"s.{c}").alias(c) for c in own], *carried,
                )
                here = here.unionByName(met)
            down = here if level == 0 else materialize(here, "paths")
        return down


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    part_col: str = "source",
    fields: tuple[str, ...] = FIELDS,
    text_col: str = "text",
    tamper_every: int = TAMPER_EVERY,
) -> DataFrame:
    """A Merkle tree per part and over the parts, with one inclusion proof per row.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. A leaf is the
    SHA-256 of a row's fields. A part's leaves stand in the order of doc_id, 16 make a node,
    level by level; the parts' roots do the same. Where ``tamper_every`` divides the CRC-32
    of the doc_id, the proof is tried on a changed row (text in small letters).

    The place of a leaf is its id's rank in the merged bitmaps of its part
    (``placed_leaves``); slot arrays keyed by part and parent then reduce the levels, each a
    sixteenth of the one below. Proofs come down the same way and are hashed where the
    siblings meet, so no row's proof is ever stored.

    Cases: a null field is hashed as such; rows with a null part are a part of their own that
    comes first; rows with a null doc_id come first in their part and are never tampered
    with. Rows of one part that agree in doc_id follow each other by leaf, and equal rows are
    a leaf each. An empty table gives no rows. Other columns are not read.
    """
    fields_of = {f: column(f) for f in fields}
    changed = fields_of | {text_col: F.translate(column(text_col), _UPPER, _LOWER)}
    chosen = F.crc32(column(id_col).cast("string").cast("binary")) % tamper_every == 0
    part = F.coalesce(F.concat(F.lit("="), column(part_col).cast("string")), F.lit(""))  # null first
    leaves = materialize(
        docs.select(
            part.alias("part"),
            column(id_col).cast("bigint").alias("doc_id"),
            digest_of(*[encoded(c) for c in fields_of.values()]).alias("leaf"),
            F.when(chosen, digest_of(*[encoded(c) for c in changed.values()])).alias("tampered"),
        ),
        "leaves",
    )
    if leaves.isEmpty():
        empty = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], empty)
    nodes = placed_leaves(leaves).select(F.col("part").alias("tree"), F.col("rank").alias("idx"), "n", F.col("leaf").alias("digest"), "doc_id", "tampered")
    extra = ["doc_id", "tampered"]
    trees = Levels(nodes, extra)
    subroots = numbered(trees.roots(), ["tree"], [])
    parts = materialize(subroots.select(F.col("tree").alias("part"), F.col("before").alias("idx"), "digest"), "subroots")
    top = Levels(parts.select(F.lit("").alias("tree"), "idx", F.lit(parts.count()).alias("n"), "digest", "part"), ["part"])
    root = top.roots().first()["digest"]
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    start = docs.sparkSession.range(1).select(F.lit("").alias("tree"), no_path.alias("path"))
    above = top.paths(start, ["part"]).select(F.col("part").alias("tree"), "path", F.col("digest").alias("subroot"))
    proven = trees.paths(materialize(above, "part-paths"), extra)
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    folded = F.aggregate("path", F.coalesce("tampered", "digest"), lambda made, p: digest_of(p["left"], made, p["right"]))
    result = proven.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        digest_of(siblings).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))
