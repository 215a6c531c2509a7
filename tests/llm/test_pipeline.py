"""The pipeline's stages, each over what its predecessor kept, against plain computations."""

import os
import zlib

import numpy as np
import pytest

import corpus_pipeline
from shelflog.llm import near, queries
from shelflog.llm.common import read_table
from shelflog.llm.decontaminate import words
from shelflog.session import materialize

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage but the last, then the last one's result."""
    docs = read_table(spark, SF_DIR, "documents")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_DIR), name)
        found.append((name, docs))
    return dict(found)


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order_of_stages(kept):
    names = ["quality", "near_dedup", "benchmark_decontamination", "source_mix", "token_output"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names
    for name in ["documents", *names[:-1]]:
        assert kept[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_clean_documents(spark, kept):
    before, after = texts(kept["documents"]), texts(kept["quality"])
    assert set(after.items()) <= set(before.items())
    # The smallest folder has too few bad labels to learn from; the next shows the decisions.
    folder = SF_DIR.replace("0.001", "0.01")
    docs = read_table(spark, folder, "documents")
    stayed = {r.doc_id for r in corpus_pipeline.good_quality(spark, docs, folder).select("doc_id").collect()}
    for held_out in (True, False):
        labels = [r for r in read_table(spark, folder, "labels").collect() if (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == held_out]
        good = [r.doc_id in stayed for r in labels if r.quality == 1]
        bad = [r.doc_id in stayed for r in labels if r.quality == 0]
        assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.25 * len(bad)


def test_one_of_each_near_group_stays(kept):
    before, after = texts(kept["quality"]), texts(kept["near_dedup"])
    found = {d: words(t.encode()) for d, t in before.items() if t}
    root = {d: d for d in found}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in found:
        for b in found:
            if a < b and near.similar(found[a], found[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(after) == {d for d in before if d not in found or find(d) == d}


def test_benchmark_passages_go(spark, kept):
    windows = set()
    for r in read_table(spark, SF_DIR, "benchmark").collect():
        w = words((r.text or "").encode())
        size = min(10, len(w))
        windows |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
    sizes = {len(w) for w in windows}
    before, after = texts(kept["near_dedup"]), texts(kept["benchmark_decontamination"])
    clean = set()
    for d, t in before.items():
        w = words((t or "").encode())
        if not any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1)):
            clean.add(d)
    assert set(after) == clean and len(clean) < len(before)


def test_mix_reads_every_document(kept):
    before, after = texts(kept["benchmark_decontamination"]), kept["source_mix"].select("doc_id").collect()
    counts = np.unique([r.doc_id for r in after], return_counts=True)
    assert set(counts[0].tolist()) == set(before) and set(counts[1].tolist()) <= {1, 2}


def test_token_rows_come_from_the_mixed_documents(kept):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    mixed = kept["source_mix"].select("doc_id", "text").collect()
    want = []
    for r in mixed:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
    rows = sorted(kept["token_output"].collect(), key=lambda r: r.start)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == sorted(want)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows(spark, empty):
    columns = "doc_id long, text string, lang string, source string, n_chars long, score double, match string, mix int, text_key string"
    prose = "the quick brown fox jumps over the lazy dog and runs away from it all today"
    rows = [
        (1, prose, "en", "a", 5, 0.1, "x", 1, "k"),
        (1, prose, "en", "a", 5, 0.1, "x", 1, "k"),
        (None, prose, None, None, None, None, None, None, None),
        (2, None, "en", None, 5, 0.1, "x", 1, "k"),
        (3, "", "en", "b", 5, 0.1, "x", 1, "k"),
        (4, " ".join(f"w{i % 911}" for i in range(40_000)), "en", "b", 5, 0.1, "x", 1, "k"),
    ]
    docs = spark.createDataFrame([] if empty else rows, columns)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        done = materialize(stage(spark, docs, SF_DIR), name)
        assert done.columns == docs.columns
        want = {"near_dedup": 4, "benchmark_decontamination": 6}.get(name)
        assert done.count() == 0 if empty else want is None or done.count() == want, name
    for stage in (corpus_pipeline.good_quality, corpus_pipeline.tokenised):
        assert stage(spark, docs, SF_DIR).count() <= len(rows)
