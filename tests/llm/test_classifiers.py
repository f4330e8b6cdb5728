"""Language and quality models: all languages, brute-force votes, long labelled texts."""

import math
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from docforge.llm import language_id, quality_crf

SF = "/root/testdata/sf0.001"


def brute_counts(text):
    """Damped counts of hashed strings of 1 to 4 folded bytes, as a unit vector."""
    folded = [c | 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in text.encode()]
    counts = [0] * language_id.BUCKETS
    for size in range(1, 5):
        for at in range(len(folded) - size + 1):
            h = 0
            for c in folded[at:at + size]:
                h = (h * 0x01000193 + c + 1) % 2 ** 32
            h ^= h >> 15
            counts[(h * 0x2C1B3C6D) % 2 ** 32 >> 20] += 1
    damped = [math.log1p(n) for n in counts]
    length = math.sqrt(sum(v * v for v in damped))
    return [v / max(length, 1e-12) for v in damped]


def brute_vote(vector, machines, classes):
    """The class of most votes, and its share of them from 0 (undecided) to 1."""
    votes = dict.fromkeys(classes, 0.0)
    for a, b in combinations(classes, 2):
        z = sum(v * float(w) for v, w in zip(vector, machines[a, b][:-1], strict=True)) + float(machines[a, b][-1])
        p = 1 / (1 + math.exp(-z))
        votes[a] += p
        votes[b] += 1 - p
    best = max(classes, key=lambda c: votes[c])
    return best, votes[best] / sum(votes.values()) * len(classes) - 1 if len(classes) > 1 else 1.0


def test_predictions_equal_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(table)
    odd = [(-1, "x"), (-2, "Ünïcode 文字 only here"), (-3, "A" * 5000), (-4, "der the le el")]
    texts = table.where(F.length("text") < 3000).orderBy("doc_id").limit(25).select("doc_id", "text").union(
        spark.createDataFrame(odd, "doc_id bigint, text string"))
    for r in language_id.predict(texts, model).collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        v = brute_counts(r.text)
        family, sure = brute_vote(v, model.top, model.families)
        lang, surer = brute_vote(v, model.inner[family], model.members[family])
        shared = sum(x * float(c) for x, c in zip(v, model.common[lang], strict=True)) / sum(v)
        assert r.lang_pred == lang
        assert r.score == pytest.approx(min(1.0, max(0.0, sure * surer)) if shared >= model.floor[lang] else 0.0, abs=1e-4)


def made_up_languages(count, texts, seed=5):
    """Rows of texts in languages of own words and own frequent letters."""
    rnd = random.Random(seed)
    rows = []
    for k in range(count):
        letters = rnd.sample("abcdefghijklmnopqrstuvwxyz", 9)
        words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(40)]
        rows += [(len(rows) + i, " ".join(rnd.choice(words) for _ in range(40)), f"q{k:03d}") for i in range(texts)]
    return rows


def test_every_language_is_learned(spark):
    rows = made_up_languages(230, 12)
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = language_id.fit(table, most_rows=800, least_rows=8)
    assert len(model.langs) == 230
    assert max(len(v) for v in model.members.values()) <= 8 and len(model.families) < 80
    got = language_id.predict(table, model).collect()
    assert sum(r.lang == r.lang_pred for r in got) > 0.97 * len(got)
    assert {r.lang_pred for r in got} == {r[2] for r in rows}


def test_labels_that_are_no_languages_are_refused(spark):
    table = spark.range(language_id.MOST_LANGUAGES + 1).select(
        F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="no languages"):
        language_id.fit(table)


def test_alike_groups_keep_likes_together():
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(4, 50))
    means = np.concatenate([c + 0.05 * rnd.normal(size=(4, 50)) for c in centres])
    means /= np.sqrt((means * means).sum(1, keepdims=True))
    names = [f"{i // 4}{i % 4}" for i in range(16)]
    groups = language_id.alike_groups(names, means, 4)
    assert sorted(sum(groups, [])) == names
    assert all(len({n[0] for n in g}) == 1 and len(g) == 4 for g in groups)
    same = np.ones((5, 3)) / math.sqrt(3)
    assert sorted(map(len, language_id.alike_groups(list("abcde"), same, 2))) == [1, 2, 2]
    assert language_id.alike_groups([], same[:0], 2) == []


def test_stretches_are_whole_lines():
    texts = [b"", b"a", b"a\nb\nc", b"\n\n", "\n".join(f"line {i}" for i in range(50)).encode()]
    raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    got, cuts = quality_crf.stretches(raw, offsets, 3)
    out = [got[a:z].tobytes() for a, z in zip(cuts, cuts[1:], strict=False)]
    assert out[:4] == texts[:4]
    lines, at = texts[4].split(b"\n"), zlib.crc32(texts[4]) % 48
    assert out[4] == b"\n".join(lines[at:at + 3])


def test_quality_is_learned_from_long_texts(spark):
    """Labelled texts of about a megabyte are the only ones there are."""
    rnd = random.Random(2)
    good = lambda n: "\n".join("The " + " ".join(rnd.choice(["river", "carries", "old", "stones", "slowly", "home"]) for _ in range(8)) + "." for _ in range(n))
    bad = lambda n: "\n".join(" | ".join(rnd.choice(["BUY", "$$$", "{x}", "##", "99"]) for _ in range(8)) for _ in range(n))
    rows = [(i, good(19_000) if i % 2 else bad(30_000)) for i in range(6)] + [(100, good(5)), (101, bad(5))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id bigint, quality int")
    assert min(len(t) for i, t in rows if i < 6) > 700_000
    field = quality_crf.fit(docs, labels)
    score = {r.doc_id: r.score for r in quality_crf.score_quality(docs, field).collect()}
    assert all((score[i] >= 0.7) == bool(i % 2) for i in range(6)) and score[100] >= 0.7 > score[101]
