"""Reading level of documents: regularised ordinal regression on lexical diversity, word rarity, connectives, clause depth and length.

Word rarity is taken from the vocabulary of a public tokenizer, which is ordered by frequency in general text: long everyday words are
usual there, short technical ones and symbols aren't. No feature knows any grade; only the regression's weights come from graded documents.
Rarity and sentence lengths also enter as shares of the text in bins, so that a text of easy and hard sentences isn't one of middling ones.
Every feature comes from the whole text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tokens import VOCABULARY, encoder
from ledgerline.operators.skew import few
from ledgerline.session import cut

BANDS = ("plain", "student", "expert")
#: Most graded documents from which the model is fitted, chosen by a hash of their id; accuracy is level from about 750 on.
SAMPLE_DOCS = 4000
#: A document's grades weigh as their number, up to this many: one that is graded over and over isn't the whole model.
MOST_WEIGHT = 4.0
RIDGE = 10.0

#: Connectives, words that open a subordinate clause, and of both those of formal prose (English, German, French, Spanish).
CONNECTIVES = frozenset(
    "and but or so because however therefore moreover thus hence also then although while consequently nevertheless "
    "und aber oder denn also daher jedoch außerdem folglich infolgedessen dennoch "
    "et mais ou donc car ainsi cependant toutefois néanmoins surcroît puis "
    "y pero o porque así además embargo obstante luego pues".split()
)
SUBORDINATORS = frozenset(
    "that which who whom whose whereas whereupon whereby whence where when if since unless until provided insofar inasmuch notwithstanding after once "
    "dass ob wenn weil obwohl während wohingegen wodurch woraus sofern sodass indem nachdem ungeachtet "
    "que qui dont lorsque quand puisque tandis afin nonobstant quoique "
    "cual cuyo cuando aunque mientras modo donde".split()
)

FORMAL = frozenset(
    "thus hence moreover therefore consequently nevertheless whereas whereupon whereby whence notwithstanding inasmuch insofar provided unless thereby "
    "folglich infolgedessen dennoch wohingegen wodurch woraus sofern ungeachtet "
    "surcroît toutefois néanmoins nonobstant quoique".split()
)

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_SENTENCE = re.compile(r"[.!?;]+(?=\s|$)|\n+")


def sentences(text: str) -> list[list[str]]:
    """Sentences of three words or more, in lower case; the whole text as one if it has none."""
    low = text.lower()
    found = [w for w in map(_WORD.findall, _SENTENCE.split(low)) if len(w) > 2]
    return found or [_WORD.findall(low)]


#: Edges of the bins: a word's rarity in bits, a sentence's mean rarity, a sentence's words.
WORD_BITS, SENTENCE_BITS, SENTENCE_WORDS = (9, 11, 13, 15, 18, 24, 32, 42), (8, 9, 10, 11, 12, 13, 14, 16, 18, 20, 23), (6, 9, 12, 16, 22, 30)
#: Words of the stretches in which diversity is also measured, so that it doesn't hang on a text's length.
STRETCH = 30
#: What each feature belongs to, in their order.
GROUPS = (
    *["rarity"] * (3 + len(WORD_BITS) + 1 + len(SENTENCE_BITS) + 1),
    *["length"] * (8 + len(SENTENCE_WORDS) + 1),
    *["diversity"] * 4,
    *["connectives"] * 3,
    *["clauses"] * 5,
)


class Words:
    """What is known of each word met so far: bits of rarity, letters, kind. Rarity comes from a public tokenizer's vocabulary, whose order is
    that of frequency in general text: the bits are those of the ranks of a word's pieces, so that a usual word has few and a rare one, which falls into pieces, many.
    """

    LIMIT = 1 << 20

    def __init__(self, ranks: bytes):
        self.encode = encoder(ranks)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.values = np.zeros((1024, 6), np.float32)  # bits, letters, connective, formal connective, subordinator, hyphen

    def ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        for w in {w for w in words if w not in known}:
            k = known[w] = len(known)
            if k == len(self.values):
                self.values = np.concatenate((self.values, np.zeros_like(self.values)))
            bits = sum(math.log2(r + 2) for r in self.encode(" " + w))
            self.values[k] = bits, len(w), w in CONNECTIVES, w in FORMAL, w in SUBORDINATORS, "-" in w
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def features(texts: Sequence[str], words: Words) -> np.ndarray:
    """One row of len(GROUPS) features for each text, from whole texts; a text without words has zeros."""
    if len(words.known) > words.LIMIT:
        words.clear()
    flat, lengths, of_text, marks = [], [], [], np.zeros((len(texts), 4))
    for k, t in enumerate(texts):
        for s in sentences(t):
            flat += s
            lengths.append(len(s))
            of_text.append(k)
        marks[k] = t.count(","), t.count(";") + t.count(":"), t.count("("), t.count("<") + t.count(">") + t.count("=") + t.count("+")
    n_texts, size, text_of_sentence = len(texts), np.array(lengths, np.int64), np.array(of_text, np.int64)
    size, text_of_sentence = size[size > 0], text_of_sentence[size > 0]
    if not len(flat):
        return np.zeros((n_texts, len(GROUPS)))
    word = words.ids(flat)
    sentence = np.repeat(np.arange(len(size)), size)
    text = text_of_sentence[sentence]
    bits, letters, joins, formal, opens, hyphen = words.values[word].T.astype(float)
    per = lambda x: np.bincount(text, x, n_texts)
    per_sentence = lambda x: np.bincount(text_of_sentence, x, n_texts)
    n, parts = np.maximum(per(np.ones(len(word))), 1), np.maximum(per_sentence(np.ones(len(size))), 1)

    def shares(at: np.ndarray, edges: Sequence[float], of: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        k = len(edges) + 1
        return list((np.bincount(of * k + np.digitize(at, edges), weight, n_texts * k).reshape(n_texts, k) / n[:, None]).T)

    mean_bits = np.bincount(sentence, bits) / size
    one = np.ones(len(word))
    mean = per(bits) / n
    out = [mean, per(np.log(bits)) / n, np.sqrt(np.maximum(per(bits**2) / n - mean**2, 0)), *shares(bits, WORD_BITS, text, one), *shares(mean_bits, SENTENCE_BITS, text_of_sentence, size)]
    longest = np.zeros(n_texts)
    np.maximum.at(longest, text_of_sentence, size)
    out += [per(letters) / n, per(letters == 1) / n, per(letters >= 9) / n, per(letters >= 13) / n, np.log(n / parts), np.log(np.maximum(longest, 1)), np.log(n), per(hyphen) / n, *shares(size, SENTENCE_WORDS, text_of_sentence, size)]
    # Kinds of words in each text, and in each stretch of it.
    kind, uses = np.unique(text * len(words.known) + word, return_counts=True)
    kinds = lambda x: np.bincount(kind // len(words.known), x, n_texts)
    start = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_texts))))[:-1]
    stretch = text * (len(word) // STRETCH + 1) + (np.arange(len(word)) - start[text]) // STRETCH
    which, place = np.unique(stretch, return_inverse=True)
    rate = np.bincount(np.unique(place * len(words.known) + word) // len(words.known), minlength=len(which)) / np.bincount(place)
    of_stretch = which // (len(word) // STRETCH + 1)
    out += [np.log(kinds(None) + 1) / np.log(n + 1), kinds(None) / n, kinds(uses == 1) / n, np.bincount(of_stretch, rate, n_texts) / np.maximum(np.bincount(of_stretch, minlength=n_texts), 1)]
    out += [per(joins) / n, per(joins * (1 - formal)) / n, per(formal) / n]
    out += [per(opens) / n, np.log1p((per(opens) + marks[:, 0]) / parts), *(marks[:, 1:] / n[:, None]).T]
    x = np.column_stack(out)
    x[per(one) == 0] = 0.0
    return x


def fit_ordinal(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and the two cuts of a cumulative logit model with a penalty on the weights, by Newton's method."""
    n, p = x.shape
    weight = np.ones(n) if weight is None else weight
    par = np.concatenate((np.zeros(p), [-1.0, 1.0]))
    penalty = np.concatenate((np.full(p, ridge), [1e-3, 1e-3]))
    for _ in range(100):
        grad, hess = -penalty * par, np.diag(penalty)
        for k in (0, 1):
            z = np.column_stack((x, np.zeros((n, 2))))
            z[:, p + k] = -1.0
            q = 1 / (1 + np.exp(-np.clip(z @ par, -30, 30)))
            grad += z.T @ (weight * ((y > k) - q))
            hess += (z * (weight * q * (1 - q))[:, None]).T @ z
        step = np.linalg.solve(hess, grad)
        par += step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return par[:p], np.sort(par[p:])


def fit_model(x: np.ndarray, grades: Sequence[Sequence[int]]) -> tuple[np.ndarray, float, np.ndarray]:
    """(weights on raw features, intercept, cuts); x has a row of features for each graded text, grades how often each band was given to it."""
    count = np.array(grades, float).reshape(len(x), 3)
    count *= np.minimum(1.0, MOST_WEIGHT / count.sum(1))[:, None]
    weight = count.T.reshape(-1)
    rows, bands = np.tile(x, (3, 1))[weight > 0], np.repeat(np.arange(3), len(x))[weight > 0]
    weight = weight[weight > 0]
    mean = np.average(rows, axis=0, weights=weight)
    scale = np.sqrt(np.average((rows - mean) ** 2, axis=0, weights=weight)) + 1e-9
    w, cuts = fit_ordinal((rows - mean) / scale, bands, weight=weight)
    return w / scale, float(-(mean / scale) @ w), cuts


def reading_bands(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", band: str = "band", min_words: int = 40, sample_docs: int = SAMPLE_DOCS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, band, score, p_plain, p_student, p_expert): one row for each document of at least min_words words (between white space).

    labels (doc_id, band) grade some of the documents, several times perhaps; the model is fitted on at most sample_docs of the graded
    documents with so many words, chosen by a hash of the id. Each text is read once; its features, of fixed number, are stored in the shared
    folder, and those of the sample, one row an id, go to the driver, where the model is fitted. Grades of other names, or of documents that
    don't exist or have no text, are left out. Documents with NULL text or too few words get no row; without any grade there are no rows
    at all. Rows repeated under one id give equal rows if their texts are equal. Other columns are not read.
    """
    with open(vocabulary, "rb") as f:
        ranks = documents.sparkSession.sparkContext.broadcast(f.read())

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(ranks.value)
        for pdf in batches:
            for k in range(0, len(pdf), 512):  # few texts at a time, whatever the size of the batches
                part = pdf.iloc[k : k + 512]
                yield pd.DataFrame({"doc_id": part["doc_id"], "x": list(features(part["d_text"].tolist(), words).astype(np.float32))})

    # White space is counted before any text is sent to Python.
    long = F.size(F.filter(F.split("d_text", r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")) >= min_words
    texts = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("d_text")).where(F.col("d_text").isNotNull() & long)
    known = cut(texts.mapInPandas(measured, "doc_id bigint, x array<float>"))
    grade = F.lower(F.trim(band))
    # Counts, not lists: a document may have a third of all grades.
    graded = cut(labels.where(grade.isin(*BANDS)).groupBy(F.col(doc_id).cast("bigint").alias("doc_id")).agg(F.array(*(F.count_if(grade == b) for b in BANDS)).alias("grades")))
    ids = known.select("doc_id").join(F.broadcast(graded) if few(graded) else graded, "doc_id").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    sample = known.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.first("grades").alias("grades")).collect()
    if not sample:
        return documents.sparkSession.createDataFrame([], "doc_id bigint, band string, score double, p_plain double, p_student double, p_expert double")
    sample.sort(key=lambda r: r["doc_id"])
    weights, intercept, cuts = fit_model(np.array([r["x"] for r in sample], float), [r["grades"] for r in sample])
    score = F.aggregate(F.zip_with("x", F.array(*map(F.lit, weights.tolist())), lambda a, w: a * w), F.lit(intercept), lambda total, v: total + v)
    above = [1 / (1 + F.exp(F.lit(float(c)) - F.col("score"))) for c in cuts]
    name = F.when(F.col("score") > float(cuts[1]), BANDS[2]).when(F.col("score") > float(cuts[0]), BANDS[1]).otherwise(BANDS[0])
    return known.select("doc_id", score.alias("score")).select("doc_id", name.alias("band"), "score", (1 - above[0]).alias("p_plain"), (above[0] - above[1]).alias("p_student"), above[1].alias("p_expert"))
