"""Tokenizer alignment, conversation tries and byte-level BPE against the
tokenizer libraries and brute-force versions."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docforge.llm import byte_bpe, queries, token_align, turn_tries

SF = "/root/testdata/sf0.001"
# characters that the libraries might class differently, contractions, and words that look like special tokens
PARTS = ["a", "bc", "'re", "'", "l", "ll", " ", "  ", "\n", "\t", "1", "23", "!", "?!", "é", "梦", "՘", "꟒",
         "\U0002ebf0", "\x1c", " ", "᠎", "😀", "Ⅷ", "́", "<|endoftext|>", "<s>", "<0x41>", "the", " word",
         "\x00", "…", "ﬁ", "한", " "]


def random_texts(n, seed):
    rnd = random.Random(seed)
    kinds = [PARTS, ["a"], ["a", "b", " "], [" ", "\n", "a"], ["'", "r", "e", "l", " "], ["a"] * 30 + [" "]]
    return ["".join(rnd.choice(kind) for _ in range(rnd.randrange(0, 150))) for kind in (rnd.choice(kinds) for _ in range(n))]


@pytest.fixture(scope="module")
def texts(spark):
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(80).collect()]
    return [*real, None, "", " ", "x" * 30000, "lo " * 30000, real[0], real[0], "a▁b", *random_texts(150, 4)]


def table(spark, texts):
    ids = [*range(len(texts) - 2), None, 0]
    rows = list(zip(ids, texts, strict=True))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("id", F.lit("clash")).withColumn(
        "ids", F.lit(1)).withColumn("n_a", F.lit(2)).withColumn("slice", F.lit(3))


def got(df):
    return Counter(tuple(r) for r in df.collect())


# --- byte-level BPE -----------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    with open(byte_bpe.DEFAULT_RANKS, "rb") as f:
        ranks = byte_bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("chunk, overlap", [(byte_bpe.CHUNK_CHARS, byte_bpe.OVERLAP_CHARS), (64, 16), (900, 40)])
def test_encoding_equals_the_library_and_decodes_to_the_text(spark, texts, library, chunk, overlap):
    rows, df = table(spark, texts if chunk > 64 else [t and t[:3000] for t in texts])
    out = byte_bpe.encode_bytes(df, decoded_col="back", chunk_chars=chunk, overlap_chars=overlap)
    assert got(out) == Counter((i, packed(library[0].encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    again = byte_bpe.decode_bytes(out.withColumnRenamed("back", "text"))
    assert again.where("decoded <> text or decoded is null").count() == 0 and again.count() == len(rows)
    assert byte_bpe.encode_bytes(df.limit(0)).count() == 0
    assert [bytes(r.decoded) for r in byte_bpe.decode_bytes(spark.sql("select cast(null as binary) token_ids")).collect()] == [b""]


def test_walks_are_stitched_at_every_chunk_size(library):
    encoder = byte_bpe.Encoder(library[1], byte_bpe.PATTERN, *byte_bpe.character_classes())
    for text in random_texts(1500, 9):
        want = packed(library[0].encode_ordinary(text))
        for chunk, overlap in ((8, 7), (16, 8), (40, 12)):
            chunks = []
            for at in range(0, max(1, len(text) - overlap), chunk):
                last = at + chunk >= len(text) - overlap
                part = text[at:] if last else text[at:at + chunk + overlap]
                chunks.append({"text": part} | byte_bpe.chunk_tokens(encoder, part, chunk, last))
            assert byte_bpe.stitch(encoder, chunks, chunk) == want, (text, chunk)


def test_overlap_must_exceed_the_look_ahead(spark):
    with pytest.raises(ValueError):
        byte_bpe.encode_bytes(spark.createDataFrame([], "doc_id bigint, text string"), overlap_chars=6)


# --- alignment ----------------------------------------------------------------


def brute_links(ends_a, ends_b):
    spans_a, spans_b = (list(zip([0, *e[:-1]], e, strict=True)) for e in (ends_a, ends_b))
    return [(i, j) for i, (a, b) in enumerate(spans_a) for j, (c, d) in enumerate(spans_b) if a < d and c < b]


def test_diagonal_runs_give_all_groups_and_links():
    rnd = random.Random(3)
    for _ in range(1500):
        every, keep = rnd.sample(range(1, 200), rnd.randrange(0, 120)), rnd.choice([0.5, 0.9, 0.98, 1])
        a, b = (sorted({e for e in every if rnd.random() <= keep} | {200}) for _ in range(2))
        upto_a, upto_b, link_a, link_b = token_align.align(a, b)
        common = sorted(set(a) & set(b))
        assert upto_a == [sum(e <= c for e in a) for c in common] and upto_b == [sum(e <= c for e in b) for c in common]
        assert list(zip(link_a, link_b, strict=True)) == brute_links(a, b)
    assert token_align.align([], []) == ([], [], [], [])


def brute_alignment(rows):
    """Per row: both tokenizations by the libraries, groups, links; then the counts."""
    model = Tokenizer.from_file(token_align.DEFAULT_BYTE_BPE)
    model.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=token_align.DEFAULT_PIECES)
    symbols = {v: k for k, v in token_align.byte_symbols().items()}
    assert len(symbols) == 256
    back = token_align.byte_symbols()
    spell_a = {i: bytes(back[c] for c in t) for t, i in model.get_vocab(with_added_tokens=False).items() if t != "<|endoftext|>"}

    def spell_b(i):
        return bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()

    docs, seen = [], Counter()
    for _, text in rows:
        a = model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a, bytes_b = [spell_a[i] for i in a], [spell_b(i) for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            docs.append(([], [], [], []))
            continue
        ends = []
        for spelled in (bytes_a, bytes_b):
            at = 0
            ends.append([at := at + len(x) for x in spelled])
        owner = {}
        for k, e in enumerate(ends[1]):
            owner.update(dict.fromkeys(range(ends[1][k - 1] if k else 0, e), k))
        links = []
        for k, e in enumerate(ends[0]):
            links += [(a[k], b[j]) for j in sorted({owner[p] for p in range(ends[0][k - 1] if k else 0, e)})]
        common, groups, i, j = set(ends[0]) & set(ends[1]), [], 0, 0
        for stop in sorted(common):
            i2, j2 = ends[0].index(stop, i) + 1, ends[1].index(stop, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        docs.append((a, b, groups, links))
        seen.update(set(links))
    best = defaultdict(int)
    for (x, _), n in seen.items():
        best[x] = max(best[x], n)
    return Counter((i, len(a), len(b), len(g), len(k), sum(seen[p] == best[p[0]] for p in k), sum(seen[p] for p in k),
                    ";".join(g)) for (i, _), (a, b, g, k) in zip(rows, docs, strict=True))


@pytest.mark.parametrize("slice_bytes", [2000, token_align.SLICE_BYTES])
def test_alignment_equals_the_libraries(spark, texts, slice_bytes):
    rows, df = table(spark, [t and t[:4000] for t in texts])
    want = brute_alignment(rows)
    found = token_align.align_tokenizers(df, slice_bytes=slice_bytes)
    assert found.columns[-1] == "groups" and got(found) == want
    if slice_bytes > 2000:
        digests = token_align.align_tokenizers(df, groups="sha256")
        assert got(digests) == Counter({(*k[:-1], hashlib.sha256(k[-1].encode()).hexdigest() if k[1] else ""): n
                                        for k, n in want.items()})
        assert token_align.align_tokenizers(df.limit(0)).count() == 0
        assert got(token_align.align_tokenizers(df.where("text is null"))) == Counter(
            {k: n for k, n in want.items() if k[0] == 80})


def test_both_encoders_equal_the_libraries_on_any_characters():
    data, pieces = token_align._read(token_align.DEFAULT_BYTE_BPE), token_align._read(token_align.DEFAULT_PIECES)
    model = Tokenizer.from_str(data.decode())
    model.encode_special_tokens = True
    pair = token_align.Pair(data, pieces, *token_align.classes_of(model))
    plain = sentencepiece.SentencePieceProcessor(model_proto=pieces)
    rnd = random.Random(8)
    wild = ["".join(chr(rnd.choice([rnd.randrange(32, 0x3000), rnd.randrange(0x3000, 0xD800), rnd.randrange(0x10000, 0x20000)]))
                    + rnd.choice(["", " ", "a", "1"]) for _ in range(30)) for _ in range(300)]
    for text in filter(None, [*wild, *random_texts(1500, 6)]):
        a, n_a, b, n_b = pair.encode(token_align._WORD.split(text))
        assert a.tolist() == model.encode(" " + text, add_special_tokens=False).ids, text
        assert "▁" in text or b.tolist() == plain.encode(text), text
        assert n_a.sum() == len(a) and n_b.sum() == len(b)


def test_other_vocabulary_files_are_refused():
    with open("/opt/tokenizers/word_bpe_49k.json", "rb") as f, pytest.raises(ValueError):
        token_align.read_byte_bpe(f.read())


# --- conversation tries -------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        source = sorted(turns.get(c - int(math.fmod(c, 20)), []))
        built[c] = tuple(x[2:] for x in source[:h] + sorted(own)[h:])
    members = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))).encode()).hexdigest())
                   for p, m in members.items())


@pytest.mark.parametrize("shard_turns", [10, turn_tries.SHARD_TURNS])
def test_trie_equals_brute_force(spark, shard_turns):
    rnd = random.Random(5)
    rows = [(c, rnd.choice([t, t, None, 0]), rnd.choice(["u", "a", None]), rnd.choice(["hi", "hi there x", None, "", "a b c"]))
            for c in range(-25, 90) for t in range(rnd.choice([0, 1, 2, 3, 4, 6, 9]))]
    rows += [(None, 1, "u", "x"), (95, None, None, None), *rows[:3]]
    rows += [(c, t, "u", "same words") for c in (200, 201, 202) for t in range(150 + c - 200)]  # long and alike
    rows += [(c, t, "u", f"common {t}") for c in range(300, 420) for t in range(4)]            # a group of copies
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("ids", F.lit("clash"))
    assert got(turn_tries.conversation_trie(df, shard_turns=shard_turns)) == brute_trie(rows)
    if shard_turns > 10:
        assert turn_tries.conversation_trie(df.limit(0)).count() == 0
        assert turn_tries.conversation_trie(df.where("conv_id is null")).count() == 0


def test_trie_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    found = con.sql(queries.ORACLES["op12_conversation_trie"])
    df = queries.QUERIES["op12_conversation_trie"](spark, SF)
    assert df.columns == found.columns and got(df) == Counter(found.fetchall())


def test_shards_know_which_nodes_are_shared():
    rnd = random.Random(1)

    def alike(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    for _ in range(300):
        rows = sorted({tuple(rnd.randrange(3) for _ in range(rnd.randrange(0, 5))) for _ in range(rnd.randrange(1, 40))})
        cuts = sorted(rnd.sample(range(1, len(rows)), min(len(rows) - 1, rnd.randrange(0, 5)))) if len(rows) > 1 else []
        shards = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        shared = [-1, *[alike(a[-1], b[0]) for a, b in zip(shards, shards[1:], strict=False)]]
        found = turn_tries.owners(shared, [alike(s[0], s[-1]) for s in shards])
        for s, own in enumerate(shards):
            for d in range(len(own[0]) + 1):
                first = [k for k in range(s) if any(r[:d] == own[0][:d] for r in shards[k])]
                assert next((o for depth, o in found[s] if depth >= d), None) == (first[0] if first else None)


def test_median_insertion_keeps_siblings_balanced():
    tree = turn_tries.TernaryTree()
    for k in turn_tries.median_order(1023):
        tree.insert([k], [1])
    heights, stack = [], [(tree.down[0], 1)]
    while stack:
        node, height = stack.pop()
        if node >= 0:
            heights.append(height)
            stack += [(tree.low[node], height + 1), (tree.high[node], height + 1)]
    assert max(heights) == 10 and [tree.turn[i] for i in tree.traverse()] == list(range(1023))
