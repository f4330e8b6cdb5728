"""Alignment of two tokenizers over the same text by diagonal run skipping.

Both tokenizations of a text are arrays of byte ends.  At the current index
shift, slices of the two arrays are compared, twice as long at each success
(exponential probing) and halved after the first difference: that jumps over
a stretch in which token for token ends alike.  The irregular group behind it
is resolved locally, the side that lags steps on until both end at one byte,
and the shift is updated.

Both vocabularies keep a blank at the start of a token, so every tokenization
of a text has an end before a blank that stands between two other characters.
The words between such blanks recur; a slice of documents is encoded and
aligned once per distinct word (all words behind each other, as one pair of
end arrays), and documents are put together from their words.

Pairs of linked ids are counted over the whole corpus: every slice sends each
of its pairs once, with the number of its documents that hold it, and gets the
corpus-wide counts back.  Slices are written to the shared folder, so that the
texts are encoded once and a lost executor costs a part of one step.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
import sentencepiece
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import checkpoint_path
from .arrow_batches import binary_offsets
from .byte_bpe import PATTERN, Encoder, char_ranges, character_classes, every_character
from .piece_codec import spellings

DEFAULT_BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
DEFAULT_PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SLICE_BYTES = 8 << 20
BLOCK_WORDS = 1 << 15      # words that are encoded and aligned at a time
#: A blank behind another character and before one that is not white space.
_WORD = re.compile(r"(?<=[^ ]) (?=\S)")


# --- the two tokenizers -------------------------------------------------------


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    ones of Latin-1 for themselves, the others in order from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(0x100 + k): b for k, b in enumerate(others)}}


def read_byte_bpe(data: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file, special tokens left out.
    Its merges must be in the order of the ids they make, which is what lets
    ids stand for merge ranks; other files are refused."""
    spec = json.loads(data)
    model, vocab = spec["model"], spec["model"]["vocab"]
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    split = spec["pre_tokenizer"] or {}
    if (model["type"] != "BPE" or spec["normalizer"] or split.get("type") != "ByteLevel" or not split.get("use_regex")
            or split.get("add_prefix_space") or made != sorted(set(made))):
        raise ValueError("not a byte-level BPE file with merges in the order of their ids")
    symbols, special = byte_symbols(), {t["content"] for t in spec["added_tokens"] if t["special"]}
    return {bytes(symbols[c] for c in token): i for token, i in vocab.items() if token not in special}


def classes_of(tokenizer: Tokenizer) -> tuple[dict[str, str], str]:
    """``character_classes`` as the pre-tokeniser of this library sees them.
    All characters that the other library puts into one class are split as one
    string; of each piece that comes back one character is tried by itself."""
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    kinds = {r"\s": set(), r"\p{L}": set(), r"\p{N}": set()}

    def kind(c):
        after = {r"\p{L}": "a", r"\p{N}": "1", "": "!"}
        return next((k for k, before in after.items() if len(split(before + c)) == 1), r"\s")

    every = every_character()
    guess, _ = character_classes()
    members = {k: re.findall(f"[{v}]", every) for k, v in guess.items()}
    known = set().union(*map(set, members.values()))
    for some in (*members.values(), [c for c in every if c not in known]):
        text = "".join(some)
        for _, (a, b) in split(text):
            if (k := kind(text[a])) in kinds:
                kinds[k].update(text[a:b])
    rare = set().union(*(kinds[k] ^ set(regex.findall(k, every)) for k in kinds))
    return {k: char_ranges(v) for k, v in kinds.items()}, char_ranges(rare)


class Pair:
    """Both tokenizers, and the bytes and decimal names of their ids."""

    def __init__(self, byte_bpe: bytes, pieces: bytes, classes: dict[str, str], rare: str):
        self._a = Encoder(read_byte_bpe(byte_bpe), PATTERN, classes, rare)
        self._b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = self._a.tokens
        self.bytes_b = pa.array(spellings(pieces)[0], pa.large_binary())
        self.size_a, self.size_b = (pa.compute.binary_length(t).to_numpy() for t in (self.bytes_a, self.bytes_b))
        self.names_a, self.names_b = ([str(i) for i in range(len(t))] for t in (self.bytes_a, self.bytes_b))

    def forget(self) -> None:
        """Gives the memory of the pieces back."""
        self._a.forget()

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words, each with one blank before it, by both tokenizers,
        and how many each word has."""
        a = [b"".join(self._a.encode(self._a.pieces(" " + w))) for w in words]
        b = self._b.encode(words, num_threads=1)
        n_b = np.fromiter(map(len, b), np.int64, len(b))
        return (np.frombuffer(b"".join(a), "<u4").astype(np.int64), np.fromiter(map(len, a), np.int64, len(a)) >> 2,
                np.fromiter(chain.from_iterable(b), np.int64, int(n_b.sum())), n_b)


# --- diagonal run skipping ----------------------------------------------------


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Two strictly increasing lists of ends, the last ones equal -> the groups
    between common ends, as the number of tokens of each side up to their ends,
    and all links (pairs of tokens that overlap), as indexes of both sides."""
    upto_a, upto_b, link_a, link_b = [], [], [], []
    i = j = 0
    n = len(ends_a)
    while i < n:
        begin, shift, step = i, j - i, 1
        while (run := ends_a[i:i + step]) and run == ends_b[i + shift:i + shift + step]:
            i += len(run)
            step *= 2
        while step > 1:                              # the difference lies within the last slice
            step //= 2
            if (run := ends_a[i:i + step]) and run == ends_b[i + shift:i + shift + step]:
                i += len(run)
        j = i + shift
        if i > begin:
            upto_a += range(begin + 1, i + 1)
            upto_b += range(begin + 1 + shift, j + 1)
            link_a += range(begin, i)
            link_b += range(begin + shift, j)
        if i < n:                                    # an irregular group
            a, b = ends_a[i], ends_b[j]
            link_a.append(i)
            link_b.append(j)
            while a != b:
                if a < b:
                    i += 1
                    a = ends_a[i]
                else:
                    j += 1
                    b = ends_b[j]
                link_a.append(i)
                link_b.append(j)
            i += 1
            j += 1
            upto_a.append(i)
            upto_b.append(j)
    return upto_a, upto_b, link_a, link_b


def _sorted_once(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; a plain sort beats a hash table here."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] - 1) != 0]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` that end there."""
    total = np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])]
    return np.diff(total)


def _gather(ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all members of the stretches ``which``, and how many each has."""
    starts, counts = np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0)
    n = counts[which]
    return np.repeat(starts[which] - np.cumsum(n) + n, n) + np.arange(int(n.sum())), n


class Words:
    """Distinct words of a slice, encoded and aligned block by block: which are
    ``good`` (both tokenizers spell them), per word ``n_a, n_b, n_groups`` and
    the text of its ``groups``, and its ``links`` (up to ``link_ends``), each the
    number of a pair of ids in ``pairs``."""

    def __init__(self, pair: Pair, words: list[str]):
        self.groups: list[str] = []
        blocks = [self._block(pair, words[at:at + BLOCK_WORDS]) for at in range(0, len(words), BLOCK_WORDS)]
        none = np.zeros(0, np.int64)
        self.good, self.n_a, self.n_b, self.n_groups, n_links, codes = (
            np.concatenate([none.astype(bool) if k == 0 else none, *(b[k] for b in blocks)]) for k in range(6))
        self.link_ends = np.cumsum(n_links)
        self.pairs, self.links = np.unique(codes, return_inverse=True)

    def _block(self, pair: Pair, words: list[str]) -> tuple[np.ndarray, ...]:
        ids_a, n_a, ids_b, n_b = pair.encode(words)
        good = self._spelled(pair, words, ids_a, n_a, ids_b, n_b)
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        # all words behind each other are one pair of end arrays
        upto_a, upto_b, link_a, link_b = align(np.cumsum(pair.size_a[ids_a]).tolist(), np.cumsum(pair.size_b[ids_b]).tolist())
        word_a = np.cumsum(n_a)                       # where the tokens of a word end
        self.groups += self._texts(pair, ids_a.tolist(), ids_b.tolist(), upto_a, upto_b, word_a)
        link_a, link_b = np.asarray(link_a, np.int64), np.asarray(link_b, np.int64)
        n_groups = np.diff(np.searchsorted(np.asarray(upto_a, np.int64), word_a, side="right"), prepend=0)
        n_links = np.diff(np.searchsorted(link_a, word_a, side="left"), prepend=0)
        return good, n_a, n_b, n_groups, n_links, ids_a[link_a] * len(pair.bytes_b) + ids_b[link_b]

    @staticmethod
    def _spelled(pair, words, ids_a, n_a, ids_b, n_b) -> np.ndarray:
        """Which words both tokenizers spell byte for byte."""
        want, at = binary_offsets(pa.array([" " + w for w in words], pa.large_string()))
        good = np.ones(len(words), bool)
        for table, ids, n in ((pair.bytes_a, ids_a, n_a), (pair.bytes_b, ids_b, n_b)):
            got, token_at = binary_offsets(table.take(pa.array(ids)))
            got_at = token_at[np.concatenate([[0], np.cumsum(n)])]
            if len(got) == len(want) and np.array_equal(got_at, at) and np.array_equal(got, want):
                continue
            same = np.diff(got_at) == np.diff(at)
            for w in np.flatnonzero(same):
                good[w] &= bool(np.array_equal(got[got_at[w]:got_at[w + 1]], want[at[w]:at[w + 1]]))
            good &= same
        return good

    @staticmethod
    def _texts(pair, ids_a, ids_b, upto_a, upto_b, word_a) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every word."""
        a, b = [pair.names_a[i] for i in ids_a], [pair.names_b[i] for i in ids_b]
        out, now, i, j, g = [], [], 0, 0, 0
        for end in word_a.tolist():
            now = []
            while i < end:
                i2, j2 = upto_a[g], upto_b[g]
                now.append(f"{a[i]}|{b[j]}" if i2 - i == 1 == j2 - j else f"{','.join(a[i:i2])}|{','.join(b[j:j2])}")
                i, j, g = i2, j2, g + 1
            out.append(";".join(now))
        return out


# --- slices of documents ------------------------------------------------------

_SLICE = ("slice bigint, pairs array<bigint>, pair_docs array<int>, word_links array<int>, word_ends array<bigint>, "
          "doc_words array<int>, doc_ends array<bigint>, doc_a array<bigint>, doc_b array<bigint>, "
          "doc_groups array<bigint>, doc_links array<bigint>, doc_text array<string>")


def _finish(pair: Pair, index: dict[str, int], rows: list, ids: list, number: int, digest: bool) -> dict:
    """The row of a slice: ``index`` numbers its words, ``rows`` has the words
    of each document as an array."""
    words = Words(pair, list(index))
    flat = np.concatenate([np.zeros(0, np.int32), *rows])
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    doc = np.repeat(np.arange(len(rows)), counts)
    bad = np.zeros(len(rows), bool)
    bad[doc[~words.good[flat]]] = True
    keep = ~bad[doc]
    flat, doc, counts = flat[keep], doc[keep], np.where(bad, 0, counts)
    ends = np.cumsum(counts)
    # distinct words of a document, then its distinct pairs
    once = _sorted_once(doc * max(1, len(index)) + flat)
    at, n = _gather(words.link_ends, once % max(1, len(index)))
    held = _sorted_once(np.repeat(once // max(1, len(index)), n) * max(1, len(words.pairs)) + words.links[at])
    pair_docs = np.bincount(held % max(1, len(words.pairs)), minlength=len(words.pairs))
    texts, start = [], 0
    for end in ends.tolist():
        text = ";".join([words.groups[w] for w in flat[start:end].tolist()])
        texts.append(hashlib.sha256(text.encode()).hexdigest() if digest and end > start else text)
        start = end
    return {"slice": number, "pairs": words.pairs, "pair_docs": pair_docs.astype(np.int32),
            "word_links": words.links.astype(np.int32), "word_ends": words.link_ends,
            "doc_words": flat.astype(np.int32), "doc_ends": ends, "doc_a": _sums(words.n_a[flat], ends),
            "doc_b": _sums(words.n_b[flat], ends), "doc_groups": _sums(words.n_groups[flat], ends),
            "doc_links": _sums(np.diff(words.link_ends, prepend=0)[flat], ends), "doc_text": texts,
            "doc_id": pa.chunked_array(ids).combine_chunks() if ids else None}


def _slices_of(batches, pair: Pair, slice_bytes: int, digest: bool) -> Iterator[dict]:
    """Documents gathered to slices of about ``slice_bytes`` of text; only the
    distinct words of a slice are held as text, a document as numbers."""
    number, index, rows, ids, size = TaskContext.get().partitionId() << 33, {}, [], [], 0

    def fresh():
        made = defaultdict()
        made.default_factory = made.__len__
        return made

    index = fresh()
    for batch in batches:
        for one in range(len(batch)):
            text = batch.column(1)[one].as_py()
            words = _WORD.split(text) if text else []
            rows.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
            ids.append(batch.column(0).slice(one, 1))
            size += len(text or "")
            if size >= slice_bytes:
                yield _finish(pair, index, rows, ids, number, digest)
                number, index, rows, ids, size = number + 1, fresh(), [], [], 0
    if rows:
        yield _finish(pair, index, rows, ids, number, digest)


_PAIRS: dict[int, Pair] = {}


def _pair(model: tuple) -> Pair:
    """The tokenizers of a worker process, built once."""
    key = xxhash.xxh64_intdigest(model[0], seed=xxhash.xxh64_intdigest(model[1]))
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(*model)
    return _PAIRS[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def align_tokenizers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     byte_bpe_path: str = DEFAULT_BYTE_BPE, pieces_path: str = DEFAULT_PIECES,
                     groups: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: ``id_col, n_a, n_b, n_groups, n_links, n_best,
    count_sum`` (long) and ``groups`` -- the groups of the alignment as text
    ``a1,a2|b1;a3|b2,b3`` (decimal ids of both tokenizers in order), or with
    ``groups="sha256"`` as ``groups_sha256``, the digest of that text.

    A is a byte-level BPE file, B a SentencePiece model that adds a blank; both
    encode the whole text with a blank before it, special tokens as plain text.
    A pair of ids counts the documents (rows) that hold it linked;
    ``count_sum`` adds the counts of a document's links, ``n_best`` is the
    number of links whose count is the highest of their A id (ties included).
    A document without tokens -- null or empty text, or one that a tokenizer
    does not spell byte for byte -- has zeros and an empty text or digest.
    Null and repeated ids keep a row each; other columns are ignored.  An empty
    table gives an empty result.

    A slice holds the distinct words of about ``slice_bytes`` characters of text
    (and of one longer text whole).  The pairs of a slice are sent once, so no
    group grows with the corpus but the rows of one pair, one per slice."""
    if groups not in ("text", "sha256"):
        raise ValueError("groups is text or sha256")
    spark = docs.sparkSession
    data = _read(byte_bpe_path)
    size_b = len(spellings(pieces := _read(pieces_path))[0])
    model = spark.sparkContext.broadcast((data, pieces, *classes_of(Tokenizer.from_str(data.decode()))))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = _SLICE + f", doc_id array<{id_type}>"

    def encode(batches):
        names = [part.strip().split(" ")[0] for part in schema.split(", ")]
        for made in _slices_of(batches, _pair(model.value), slice_bytes, groups == "sha256"):
            yield pa.RecordBatch.from_arrays(
                [pa.array([made[c]]) if c == "slice" else
                 pa.ListArray.from_arrays(pa.array([0, len(made[c])], pa.int32()), pa.array(made[c])
                                          if not isinstance(made[c], pa.Array) else made[c]) for c in names], names)
        # a waiting worker remembers no pieces while the executor works on the slices
        _pair(model.value).forget()
        gc.collect()
        pa.default_memory_pool().release_unused()

    path = checkpoint_path(spark, f"token-alignment-{uuid.uuid4().hex}", "slices")
    # a reader holds the rows of a file at once, and a slice has some 10 MB
    rows.mapInArrow(encode, schema).write.option("maxRecordsPerFile", 2).parquet(path)
    written = spark.read.schema(schema).parquet

    # corpus-wide counts of every pair, given back to the slices that hold it
    sent = written(path).select("slice", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("at", "p"))
    counted = sent.select("slice", "at", F.col("p.pairs").alias("pair"), F.expr(f"p.pairs div {size_b}").alias("a"),
                          F.sum("p.pair_docs").over(Window.partitionBy("p.pairs")).alias("n"))
    # a row per A id at most, so bounded by the vocabulary
    best = counted.groupBy("a").agg(F.max("n").alias("most"))
    back = counted.join(F.broadcast(best), "a").select("slice", "at", "n", (F.col("n") == F.col("most")).alias("top"))
    text_col_out = "groups" if groups == "text" else "groups_sha256"
    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", text_col_out]

    def sum_up(table, pairs):
        at = pairs.column("at").to_numpy()
        counts, tops = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        counts[at] = pairs.column("n").to_numpy()
        tops[at] = pairs.column("top").to_numpy(zero_copy_only=False)
        s = {c: table.column(c).combine_chunks().flatten() for c in table.column_names if c != "slice"}
        links, word_ends = s["word_links"].to_numpy(), s["word_ends"].to_numpy()
        words, doc_ends = s["doc_words"].to_numpy(), s["doc_ends"].to_numpy()
        n_best = _sums(_sums(tops[links], word_ends)[words], doc_ends)
        count_sum = _sums(_sums(counts[links], word_ends)[words], doc_ends)
        return pa.Table.from_arrays([s["doc_id"], s["doc_a"], s["doc_b"], s["doc_groups"], s["doc_links"],
                                     pa.array(n_best), pa.array(count_sum), s["doc_text"]], names)

    return written(path).drop("pairs", "pair_docs").groupBy("slice").cogroup(back.groupBy("slice")).applyInArrow(
        sum_up, f"`{id_col}` {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                f"count_sum bigint, {text_col_out} string")
