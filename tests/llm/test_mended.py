"""Sampling after unknown characters, columns of clashing names, broken pages."""

import math
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docforge.llm import decontaminate, html_mincut, language_id, piece_codec, simhash_vptree

SF = "/root/testdata/sf0.001"
UNKNOWN = "\U00010330"     # four bytes, none of them part of a piece


@pytest.fixture(scope="module")
def model():
    return piece_codec.PieceModel(piece_codec._load(piece_codec.DEFAULT_MODEL))


def segmentations(weights, word):
    """All ways to spell a word with pieces, and their weights."""
    if not word:
        return {(): 1.0}
    return {(word[:n], *rest): weights[word[:n]] * w for n in range(1, len(word) + 1) if word[:n] in weights
            for rest, w in segmentations(weights, word[n:]).items()}


@pytest.mark.parametrize("unknown", [0, 25, 100])
def test_sampled_shares_after_unknown_characters(model, unknown):
    word, keys = b"theres", 1500
    text = (UNKNOWN * unknown).encode() + word
    raw = np.frombuffer(text * keys, np.uint8)
    ids, at = piece_codec.encode_slice(model, raw, np.arange(keys + 1) * len(text),
                                       np.arange(keys, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    single = set(model.byte_ids.tolist())
    weights = {p: model.weight[i] for i, p in enumerate(model.pieces) if model.weight[i] and i not in single}
    want = segmentations(weights, word if unknown else b" " + word)
    total = sum(want.values())
    skip, seen = 4 * unknown + bool(unknown), Counter()
    for a, b in zip(at[:-1], at[1:], strict=True):
        seen[tuple(model.pieces[i] for i in ids[a + skip:b])] += 1
    assert len(seen) > 3 and set(seen) <= set(want)
    for pieces, weight in want.items():
        assert abs(seen[pieces] / keys - weight / total) < 0.05, pieces


def test_chunks_of_every_length_are_sampled_by_weight(model):
    """The share of an edge is the part its paths have in the weight of its end node."""
    for n in (1, 20, 63, 64, 127, 128, 129, 700):
        raw = np.frombuffer(("ab" + UNKNOWN + "the")[:9].encode() * (n // 9 + 1), np.uint8)[:n].copy()
        while len(raw) and (raw[-1] & 0xC0) == 0x80 or raw[-1] >= 0xC0:
            raw = raw[:-1]
        first, start, size, piece, share = piece_codec.forward_filter(model, raw, np.array([0, len(raw)]))
        logs = np.full(len(raw) + 1, -math.inf)
        logs[0] = 0.0
        for node in range(1, len(raw) + 1):
            edges = range(first[node], first[node + 1])
            parts = [logs[start[e]] + math.log(model.weight[piece[e]]) + int(size[e]) * math.log(3.0) for e in edges]
            top = max(parts, default=-math.inf)
            if top == -math.inf:
                continue
            each = np.exp(np.array(parts) - top)
            logs[node] = top + math.log(each.sum())
            assert np.allclose(share[first[node]:first[node + 1]], np.cumsum(each) / each.sum(), atol=1e-9)
        assert logs[-1] > -math.inf


def test_columns_of_clashing_names_stay(spark):
    names = ["_hit", "_row_key", "_lettered", "_text_hash", "_kept_id", "_kept_hash", "_HIT_"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").limit(40)
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names if c != "_HIT_"})
    docs = docs.withColumn("_HIT_", F.lit(1))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    fitted = language_id.fit(docs)
    for out in (piece_codec.encode_sampled(docs), language_id.predict(docs, fitted), simhash_vptree.keep_one_per_group(docs),
                decontaminate.drop_contaminated(docs, bench)):
        assert out.columns[:len(docs.columns)] == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names[:-1])


def test_pages_with_many_unmatched_tags_take_linear_time():
    began = time.process_time()
    page = "<div>" * 20_000 + "A whole sentence of text, with words in it." + "</section>" * 20_000
    deep = "<div>" * 60_000 + "Another sentence of text, with words in it." + "</p>" * 3_000 + "</div>" * 60_000 + "<p>Last."
    found = [html_mincut.blocks(p) for p in (page, deep)]
    assert time.process_time() - began < 20
    assert found[0][0][0].startswith("A whole") and [b[0] for b in found[1]] == ["Another sentence of text, with words in it.", "Last."]
    assert [b[0] for b in html_mincut.blocks("<div>a<ul><li>b</div>c</ul>d<section>e</b></section>f")] == ["a", "b", "cd", "e", "f"]
