"""Language identification by hierarchical discrimination.

A text's family is decided first, by linear classifiers over hashed character
n-grams; within the family, one-versus-one linear support vector machines
separate the languages.  Families are the known ones; languages outside them
are grouped by the likeness of their mean n-grams.  Everything is fitted on a
bounded sample of labelled rows in one task; only the machines' weights reach
the driver.
"""

from __future__ import annotations

import pickle
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_batches import binary_offsets, free_name, slices

BUCKETS = 4096
MOST_LANGUAGES = 1000  # more are refused; the machines of so many take about 160 MB

# Families of ISO 639-1 codes.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "iranian": "fa ku ps",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv ms tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str | None:
    """The known family of a language code, a region or script in it aside."""
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0])


def alike_groups(names: list[str], means: np.ndarray, most: int) -> list[list[str]]:
    """``names`` in groups of at most ``most``: a group too large is halved
    between the two whose unit ``means`` are least alike."""
    if len(names) <= most:
        return [names] if names else []
    far = means @ means.T
    a, b = np.unravel_index(far.argmin(), far.shape)
    order = np.argsort(far[b] - far[a], kind="stable")
    halves = (np.sort(order[:len(names) // 2]), np.sort(order[len(names) // 2:]))
    return [group for half in halves for group in alike_groups([names[i] for i in half], means[half], most)]


def _fold_table() -> np.ndarray:
    """Bytes to bytes: ASCII letters in lower case, other ASCII to blank."""
    table = np.arange(256, dtype=np.uint32)
    table[:128] = 32
    for c in range(97, 123):
        table[c] = table[c - 32] = c
    return table


_FOLD = _fold_table()


def ngram_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unit rows of damped counts of hashed 1- to 4-byte strings of every text."""
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS, np.float32)
    if len(raw):
        row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
        byte = _FOLD[raw]
        gram = np.zeros(len(raw), np.uint32)
        for size in range(1, 5):
            m = len(raw) - size + 1
            if m <= 0:
                break
            gram = gram[:m] * np.uint32(0x01000193) + byte[size - 1:] + np.uint32(1)
            inside = row[:m] == row[size - 1:]
            h = gram ^ (gram >> np.uint32(15))
            h = (h * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
            counts += np.bincount(row[:m][inside] * BUCKETS + h[inside], minlength=n * BUCKETS).astype(np.float32)
    out = np.log1p(counts.reshape(n, BUCKETS))
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """Weights (bias last) of a squared-hinge support vector machine for labels
    -1 and 1, classes weighted alike, by accelerated gradient steps."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    share = (share * y).astype(x.dtype)
    w = np.zeros(x.shape[1] + 1, x.dtype)
    y = y.astype(x.dtype)
    ahead, step, t = w.copy(), 0.2, 1.0
    for _ in range(rounds):
        pull = share * np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        grad = -2 * np.append(pull @ x, pull.sum(dtype=x.dtype)) + 2 * x.dtype.type(penalty) * ahead
        nxt, t_next = ahead - x.dtype.type(step) * grad, float((1 + np.sqrt(1 + 4 * t * t)) / 2)
        ahead, w, t = nxt + x.dtype.type((t - 1) / t_next) * (nxt - w), nxt, t_next
    return w


def _pairwise(x: np.ndarray, labels: np.ndarray, classes: list[str]) -> dict[tuple[str, str], np.ndarray]:
    """One machine per two classes, its margin scaled to log-odds (Platt's
    method with equal slopes: the scale that fits the sample best)."""
    out = {}
    for a, b in combinations(classes, 2):
        own = (labels == a) | (labels == b)
        xs, y = x if own.all() else x[own], np.where(labels[own] == a, 1.0, -1.0)
        w = linear_svm(xs, y)
        margin = y * (xs @ w[:-1] + w[-1])
        scales = [1.0, 2.0, 4.0, 8.0]
        out[a, b] = w * min(scales, key=lambda s: np.logaddexp(0, -s * margin).mean())
    return out


def _class_shares(x: np.ndarray, machines: dict, classes: list[str]) -> np.ndarray:
    """Votes of the pairwise machines, as shares that add up to 1 in a row."""
    shares = np.zeros((len(x), len(classes)))
    if len(classes) == 1:
        return shares + 1.0
    place = {c: i for i, c in enumerate(classes)}
    for (a, b), w in machines.items():
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -50, 50)))
        shares[:, place[a]] += p
        shares[:, place[b]] += 1 - p
    return shares / shares.sum(1, keepdims=True)


class LanguageModel:
    """Family machines, then the machines of every family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        labels = np.asarray(langs, object)
        self.langs = sorted(set(langs))
        members: dict[str, list[str]] = {}
        for lang in self.langs:
            if family_of(lang):
                members.setdefault(family_of(lang), []).append(lang)
        others = [lang for lang in self.langs if not family_of(lang)]
        means = np.zeros((len(others), BUCKETS), np.float32)
        for i, lang in enumerate(others):
            means[i] = x[labels == lang].mean(0)
        means /= np.maximum(np.sqrt((means * means).sum(1, keepdims=True)), 1e-12)
        # of this size, the machines between and within the groups are fewest together
        for group in alike_groups(others, means, max(1, round((2 * len(others)) ** (1 / 3)))):
            members[f"of-{group[0]}"] = group
        self.members, self.families = members, sorted(members)
        belongs = {lang: f for f, group in members.items() for lang in group}
        fam = np.asarray([belongs[v] for v in langs], object)
        self.top = _pairwise(x, fam, self.families)
        self.inner = {f: _pairwise(x[fam == f], labels[fam == f], members[f]) for f in self.families}
        # how common each n-gram is in a language, and how common those of its texts are at least
        self.common, self.floor = {}, {}
        for lang in self.langs:
            own = x[labels == lang]
            used, n = own > 0, len(own)
            self.common[lang] = used.mean(0).astype(np.float32)
            others = (used.sum(0) - used) / max(1, n - 1)       # every text by the others of its language
            self.floor[lang] = 0.9 * np.quantile((own * others).sum(1) / np.maximum(own.sum(1), 1e-12), 0.01)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The predicted language and its score: how decided the vote for the
        family is times how decided the vote in the family is (``_decided``), and 0
        where the text's n-grams are less common in the language than those of
        its own texts."""
        family = _class_shares(x, self.top, self.families)
        best = family.argmax(1)
        lang, score = np.full(len(x), "", object), np.zeros(len(x))
        for i, f in enumerate(self.families):
            own = np.flatnonzero(best == i)
            if len(own):
                inner = _class_shares(x[own], self.inner[f], self.members[f])
                at = inner.argmax(1)
                lang[own] = np.asarray(self.members[f], object)[at]
                score[own] = np.clip(_decided(family[own, i], len(self.families))
                                     * _decided(inner.max(1), len(self.members[f])), 0, 1)
                for name in self.members[f]:
                    as_name = own[lang[own] == name]
                    shared = x[as_name] @ self.common[name] / np.maximum(x[as_name].sum(1), 1e-12)
                    score[as_name[shared < self.floor[name]]] = 0.0
        return lang, score


def _decided(share: np.ndarray, classes: int) -> np.ndarray:
    """A vote share from 0 (undecided, 1 / classes) to 1 (2 / classes, the most
    a class can get)."""
    return np.ones_like(share) if classes < 2 else share * classes - 1


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id as text (null: empty text) leaves ``part``."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts == part


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        most_rows: int = 1600, least_rows: int = 12) -> LanguageModel | None:
    """A model from a sample of labelled rows, chosen by a hash of id and text.
    None without rows.

    Every language is learned.  The sample is of about ``most_rows`` rows shared
    evenly by the languages, but of ``least_rows`` a language (or all that it
    has) where that is more.  Labels of more than ``MOST_LANGUAGES`` values
    are refused with a ``ValueError``, for the model would outgrow a broadcast."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.coalesce(F.col(text_col), F.lit("")).rlike(r"\p{L}"))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                       (F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("_draw"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(
        MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values, which are no languages")
    if not counts:
        return None
    each = max(most_rows / len(counts), float(least_rows))
    rate = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, each / n))])
    sample = rows.where(F.col("_draw") < rate[F.col("lang")]).select("lang", "text").limit(
        int(2 * each * len(counts)))

    def train(batches):
        langs, parts = [], []
        for b in slices(batches, "text"):
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                langs += part.column(0).to_pylist()
                parts.append(ngram_counts(*binary_offsets(part.column(1))).astype(np.float32))
        if langs:
            model = LanguageModel(np.concatenate(parts), langs)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # the sample is bounded, so one task fits the model; the driver gets its weights only
    got = sample.coalesce(1).mapInArrow(train, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else None


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score, from the whole text.

    Null texts and texts without a letter are ``und`` with score 0, as is
    everything without a model.  All other columns stay (those named like the
    two new ones are replaced); rows are independent, so repeated rows and ties
    need no rule; an empty table gives an empty result."""
    rows = docs.drop(lang_out, score_out)
    lettered = F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"\p{L}")
    if model is None:
        return rows.withColumn(lang_out, F.lit("und")).withColumn(score_out, F.lit(0.0))
    flag = free_name(rows, "_lettered")
    rows = rows.withColumn(flag, lettered)
    schema = rows.drop(flag).withColumn(lang_out, F.lit("")).withColumn(score_out, F.lit(0.0)).schema
    # a vector of BUCKETS numbers for every two languages of a family and every two families
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, text_col):
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                names = part.schema.names
                x = ngram_counts(*binary_offsets(part.column(names.index(text_col))))
                lang, score = shared.value.predict(x)
                no = ~part.column(names.index(flag)).to_numpy(zero_copy_only=False).astype(bool)
                lang[no], score[no] = "und", 0.0
                keep = [i for i, c in enumerate(names) if c != flag]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in keep] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    [names[i] for i in keep] + [lang_out, score_out])

    return rows.mapInArrow(run, schema)


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      parts: int = 5, part: int = 0) -> DataFrame:
    """``id_col, held_out, lang_pred, score`` of every row: fitted on the rows
    that are not held out (CRC-32 of the id modulo ``parts`` is not ``part``)."""
    out = held_out(F.col(id_col), parts, part)
    model = fit(docs.where(~out), id_col, text_col, lang_col)
    return predict(docs.select(id_col, F.col(text_col), out.alias("held_out")), model, text_col).drop(text_col)
