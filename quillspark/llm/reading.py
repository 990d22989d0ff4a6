"""Reading level of each document.

Every sentence of a document's running prose gets a distribution over the levels from a
regularised multinomial model over hashed words and the character n-grams inside words. Since
the score of a sentence is the mean of its words' scores, a batch scores each distinct word
once. A second small model turns a document's sentence distributions into a calibrated level.
Both are trained on a bounded sample of labelled documents; scoring covers every sentence.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quillspark.llm.kernels import Words, folded, mix, slices

LEVELS = 4
WORD_BITS, CHAR_BITS = 17, 17
#: Most labelled documents that the models are fitted on.
MAX_LABELLED = 1500

#: Function words by language (fixed values).
FUNCTION_WORDS = {
    "en": "the of and to in a is that for it was on are as with by at from this be or an which have not we you they "
          "has their its but these more than if when how each our she he his her there into can will who my i do so",
    "de": "der die und das den dem von zu mit sich auf nicht eine einer eines als auch es werden aus ist im fur wird "
          "sind bei nach wie oder aber wenn nur noch uber einen zum zur ein dass sie durch dieser diese wir",
    "fr": "le la les des une et est dans que qui pour pas sur plus par avec ce cette sont aux du au ne se sa son ses "
          "leur mais nous vous ou ces il elle ils elles un en de comme entre etre ont",
    "es": "el la los las una y que en es por con para su se del al lo como mas o pero sus este esta entre son sobre "
          "cuando muy sin tambien un de no ha fue ser hay donde cada",
    "it": "il lo gli le una e che di in per con non su come piu della delle dei nel alla sono da anche questo questa "
          "si del al un ha tra ma",
    "pt": "o os as uma e que em para com nao por mais como dos das do da no na ao se sua seu mas ou entre sobre um "
          "foi esta ser pelo pela",
    "nl": "de het een en van is dat op te in voor met niet zijn aan er ook als door maar bij om naar uit dan nog wordt "
          "deze die",
}

_END_OF_SENTENCE = re.compile(r"(?<=[.!?])[\"')\]]*\s+")
_CONTACT = re.compile(r"@|://|\bwww\.|^\s*(?:contact|tel|phone|fax|e-?mail)\b\s*[:.]", re.I)
_REFERENCES = re.compile(r"^\W*(?:\d+\W+)?(?:references|bibliography|works cited|literature(?: cited)?|further reading)\W*$", re.I)
_REFERENCE = re.compile(r"^\s*(?:\[\d+\]|\(\d+\)|\d{1,3}[.)]\s)|\bet al\b|\b(?:19|20)\d\d\b")
_BULLET = re.compile(r"^\s*(?:[-*•·]|\d{1,3}[.)]|[a-z][.)])\s+")
_FORMULA = re.compile(r"[=<>≤≥]|\b[a-z]\s*[+*/^]\s*[a-z]\b")
_MARKUP = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|&[a-zA-Z]{2,8};|[*_#`~]{1,}")


def prose(text: str) -> list[str]:
    """The sentences of a text's running prose.

    Headings, reference lists, contact lines, tables, formulas and markup are no prose; the
    points of a list are.
    """
    out, skip = [], False
    for line in _MARKUP.sub(" ", text).split("\n"):
        if not line.strip():
            continue
        if _REFERENCES.match(line):
            skip = True
            continue
        if skip:
            if _REFERENCE.search(line):
                continue
            skip = False
        if _CONTACT.search(line) or line.count("|") > 1 or "\t" in line.strip():
            continue
        bullet = _BULLET.match(line)
        body = line[bullet.end():] if bullet else line
        if len(body.split()) <= 7 and not re.search(r"[.!?][\"')\]]*\s*$", body):
            continue
        out.extend(s for s in _END_OF_SENTENCE.split(body.strip()) if s and not _FORMULA.search(s))
    return out


def language_shares(words: Words, doc_of_word: np.ndarray, docs: int) -> np.ndarray:
    """Per document and language, the share of words that are its function words."""
    counts = np.bincount(doc_of_word, minlength=docs).astype(float)
    out = np.zeros((docs, len(FUNCTION_WORDS)))
    for j, text in enumerate(FUNCTION_WORDS.values()):
        known = np.unique(Words([text]).hash)
        out[:, j] = np.bincount(doc_of_word[np.isin(words.hash, known)], minlength=docs)
    return out / np.maximum(counts, 1)[:, None]


def is_english(shares: np.ndarray, least: float = 0.12) -> np.ndarray:
    return (shares[:, 0] >= least) & (shares[:, 0] >= shares[:, 1:].max(axis=1))


@dataclass
class Vocabulary:
    """Features of distinct words, kept from batch to batch: a word's own bucket and its n-grams' buckets."""

    known: dict = field(default_factory=dict)

    def features(self, word: str) -> np.ndarray:
        f = self.known.get(word)
        if f is None:
            padded = np.frombuffer(f"^{word}$".encode(), np.uint8).astype(np.uint64)
            codes = [np.array([hash_word(word)], np.uint64) & np.uint64((1 << WORD_BITS) - 1)]
            with np.errstate(over="ignore"):
                for n in (2, 3, 4):
                    m = len(padded) - n + 1
                    if m > 0:
                        c = np.full(m, n, np.uint64)
                        for k in range(n):
                            c = c * np.uint64(0x100000001B3) + padded[k: k + m]
                        codes.append((mix(c) & np.uint64((1 << CHAR_BITS) - 1)) + np.uint64(1 << WORD_BITS))
            f = np.concatenate(codes).astype(np.int32)
            if len(self.known) < 200_000:
                self.known[word] = f
        return f


def hash_word(word: str) -> int:
    h = 14695981039346656037
    for b in word.encode():
        h = (h ^ b) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return h ^ (h >> 29)


def _digits(word: str) -> str:
    return "0" if word.isdigit() else word


class Sentences:
    """Sentences of texts as places in a table of distinct words."""

    def __init__(self, texts: list[str], vocabulary: Vocabulary):
        split = [prose(t) for t in texts]
        flat = [folded(s) for ss in split for s in ss]
        self.doc = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        w = Words(flat)
        self.count = len(flat)
        values, at, self.word = np.unique(w.hash, return_index=True, return_inverse=True)
        self.sentence = w.doc
        feats = [vocabulary.features(_digits(w.word(i))) for i in at]
        self.size = np.array([len(f) for f in feats], np.int64)
        self.feature = np.concatenate(feats) if feats else np.zeros(0, np.int32)
        self.length = np.bincount(self.sentence, minlength=self.count)

    def word_scores(self, theta: np.ndarray) -> np.ndarray:
        if not len(self.size):
            return np.zeros((0, theta.shape[1]), theta.dtype)
        at = np.r_[0, np.cumsum(self.size)[:-1]]
        own = theta[self.feature[at]]
        return own + (np.add.reduceat(theta[self.feature], at, axis=0) - own) / np.maximum(self.size - 1, 1)[:, None]

    def logits(self, theta: np.ndarray, bias: np.ndarray) -> np.ndarray:
        s = self.word_scores(theta)[self.word]
        z = np.stack([np.bincount(self.sentence, s[:, k], self.count) for k in range(theta.shape[1])], axis=1) \
            if self.count else np.zeros((0, theta.shape[1]))
        return z / np.maximum(self.length, 1)[:, None] + bias

    def back(self, g: np.ndarray, features: int) -> np.ndarray:
        """Gradient of the feature weights for gradients of the sentence logits."""
        g = g / np.maximum(self.length, 1)[:, None]
        k = g.shape[1]
        per_word = np.stack([np.bincount(self.word, g[self.sentence, j], len(self.size)) for j in range(k)], axis=1)
        at = np.r_[0, np.cumsum(self.size)[:-1]]
        scale = np.repeat(1 / np.maximum(self.size - 1, 1), self.size)
        scale[at] = 1
        rows = np.repeat(np.arange(len(self.size)), self.size)
        return np.stack([np.bincount(self.feature, per_word[rows, j] * scale, features) for j in range(k)], axis=1)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
    return z / z.sum(axis=1, keepdims=True) if len(z) else z


def adam(grad, theta: list[np.ndarray], steps: int, rate: float) -> None:
    m = [np.zeros_like(t) for t in theta]
    v = [np.zeros_like(t) for t in theta]
    for i in range(1, steps + 1):
        for t, g, a, b in zip(theta, grad(), m, v):
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            t -= rate * (a / (1 - 0.9 ** i)) / (np.sqrt(b / (1 - 0.99 ** i)) + 1e-8)


@dataclass
class LevelModel:
    theta: np.ndarray
    bias: np.ndarray
    doc_w: np.ndarray
    doc_b: np.ndarray

    def sentence_levels(self, s: Sentences) -> np.ndarray:
        return softmax(s.logits(self.theta, self.bias))

    def document_levels(self, s: Sentences, docs: int) -> np.ndarray:
        return softmax(document_features(s, self.sentence_levels(s), docs) @ self.doc_w + self.doc_b)


def document_features(s: Sentences, p: np.ndarray, docs: int) -> np.ndarray:
    """Mean sentence distribution, share of sentences by level, and their logs."""
    n = np.maximum(np.bincount(s.doc, minlength=docs), 1)[:, None]
    top = np.eye(LEVELS)[p.argmax(axis=1)] if len(p) else np.zeros((0, LEVELS))
    mean = np.stack([np.bincount(s.doc, p[:, k], docs) for k in range(LEVELS)], axis=1) / n if len(p) else np.zeros((docs, LEVELS))
    share = np.stack([np.bincount(s.doc, top[:, k], docs) for k in range(LEVELS)], axis=1) / n if len(p) else np.zeros((docs, LEVELS))
    return np.concatenate([mean, share, np.log(mean + 0.02)], axis=1)


def fit(texts: list[str], grades: np.ndarray, steps: int = 50, l2: float = 1e-6) -> LevelModel:
    """Fit on labelled texts (grades 1 to 4): sentences first take their document's grade, then, twice, the
    grade that the model and the neighbouring grades of the document make likely. The document model is
    fitted on the half of the documents that the first sentence model hasn't seen."""
    vocabulary = Vocabulary()
    features = (1 << WORD_BITS) + (1 << CHAR_BITS)
    y = np.asarray(grades, int) - 1
    half = np.random.default_rng(0).permutation(len(texts)) % 2 == 0

    #: how likely a sentence of each level is in a document of each grade, at first
    near = np.array([[0.7 ** (3 * abs(i - j)) for j in range(LEVELS)] for i in range(LEVELS)])
    near = near / near.sum(axis=1, keepdims=True)

    def sentence_model(part: np.ndarray):
        s = Sentences([t for t, k in zip(texts, part) if k], vocabulary)
        own = y[part][s.doc]
        q = np.eye(LEVELS)[own]
        weight = 1 / np.maximum(np.bincount(own, minlength=LEVELS), 1)[own]
        weight = weight / weight.sum() if len(weight) else weight
        theta, bias = np.zeros((features, LEVELS)), np.zeros(LEVELS)
        for round_ in range(3):
            if round_:
                p = softmax(s.logits(theta, bias)) * near[own]
                q = p / p.sum(axis=1, keepdims=True)

            def grad():
                g = (softmax(s.logits(theta, bias)) - q) * weight[:, None]
                return s.back(g, features) + l2 * theta, g.sum(axis=0)

            adam(grad, [theta, bias], steps if round_ == 0 else steps // 2, 0.15)
        return theta, bias

    def document_model(model, part: np.ndarray):
        s = Sentences([t for t, k in zip(texts, part) if k], vocabulary)
        x = document_features(s, softmax(s.logits(*model)), int(part.sum()))
        q = np.eye(LEVELS)[y[part]] * 0.94 + 0.015
        w, b = np.zeros((x.shape[1], LEVELS)), np.zeros(LEVELS)

        def grad():
            g = (softmax(x @ w + b) - q) / max(1, len(x))
            return x.T @ g + 1e-4 * w, g.sum(axis=0)

        adam(grad, [w, b], 300, 0.1)
        return w, b

    w, b = document_model(sentence_model(half), ~half)
    theta, bias = sentence_model(np.ones(len(texts), bool))
    return LevelModel(theta.astype(np.float32), bias, w, b)


def labels(rated: DataFrame, doc_id: str = "doc_id", grade: str = "grade", at: str = "labelled_at") -> DataFrame:
    """``(doc_id, grade)``: the newest grade of each document, the lower of two at one time; grades outside 1 to 4 are left out."""
    w = Window.partitionBy("doc_id").orderBy(F.col("at").desc_nulls_last(), "grade")
    return (rated.select(F.col(doc_id).alias("doc_id"), F.col(grade).cast("int").alias("grade"), F.col(at).alias("at"))
            .where(f"doc_id is not null and grade between 1 and {LEVELS}")
            .withColumn("rn", F.row_number().over(w)).where("rn = 1").select("doc_id", "grade"))


def train(documents: DataFrame, rated: DataFrame, doc_id: str = "doc_id", text: str = "text",
          most: int = MAX_LABELLED) -> LevelModel | None:
    """A model from at most ``most`` labelled documents, drawn by the hash of their ids. None without any."""
    some = labels(rated).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = (documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
            .join(F.broadcast(some), "doc_id").select("doc_id", "text", "grade").dropDuplicates(["doc_id"]).collect())
    rows.sort(key=lambda r: r["doc_id"])
    if len(rows) < 2 * LEVELS:
        return None
    words = Words([folded(r["text"]) for r in rows])
    english = is_english(language_shares(words, words.doc, len(rows)))
    rows = [r for r, e in zip(rows, english) if e]
    return fit([r["text"] for r in rows], np.array([r["grade"] for r in rows]))


def score(batches, model: LevelModel, least_words: int):
    vocabulary = Vocabulary()
    for batch, texts in slices(batches, "text"):
        keep = [i for i, t in enumerate(texts) if t and len(t.split()) >= least_words]
        kept = [texts[i] for i in keep]
        words = Words([folded(t) for t in kept])
        english = is_english(language_shares(words, words.doc, len(kept)))
        keep = [i for i, e in zip(keep, english) if e]
        kept = [t for t, e in zip(kept, english) if e]
        s = Sentences(kept, vocabulary)
        p = model.document_levels(s, len(kept)) if kept else np.zeros((0, LEVELS))
        ids = batch.column("doc_id").take(pa.array(keep, pa.int64()))
        yield pa.record_batch([ids, pa.array(p.argmax(axis=1) + 1 if len(p) else [], pa.int64()),
                               pa.array(p.max(axis=1) if len(p) else [], pa.float64()),
                               pa.array(p @ np.arange(1, LEVELS + 1) if len(p) else [], pa.float64()),
                               pa.array(np.bincount(s.doc, minlength=len(kept)).astype(np.int32))],
                              names=["doc_id", "grade", "confidence", "expected_grade", "sentences"])


def reading_levels(documents: DataFrame, rated: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   least_words: int = 30, most_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(doc_id, grade, confidence, expected_grade, sentences)`` for every English document.

    Documents in another language (judged by their function words, not by a label), with fewer than
    ``least_words`` words, or with a null id or text give no row; identical rows count once. A document
    without prose gets the level that the document model gives to no evidence. Without enough labels the
    result is empty.
    """
    schema = "doc_id bigint, grade bigint, confidence double, expected_grade double, sentences int"
    spark = documents.sparkSession
    model = train(documents, rated, doc_id, text, most_labelled)
    if model is None:
        return spark.createDataFrame([], schema)
    box = spark.sparkContext.broadcast(model)
    docs = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where(
        "doc_id is not null and text is not null")
    scored = docs.mapInArrow(lambda b: score(b, box.value, least_words), schema)
    # one whole row where an id repeats: the one with the most prose
    row = F.struct("sentences", "confidence", "grade", "expected_grade")
    return scored.groupBy("doc_id").agg(F.max(row).alias("m")).select("doc_id", "m.grade", "m.confidence", "m.expected_grade", "m.sentences")
