"""Subject areas of documents, by subject-specific interpolated n-gram language models.

A sentence is about a subject when the subject's model codes it with fewer nats per word than the background model, by
a margin calibrated on labelled documents; a document has the subjects of at least ``LEAST_SENTENCES`` sentences.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents that the models are fitted on, at most (in the order of a hash of the id); everything else covers all rows.
MOST_LABELLED = 2_500
LEAST_SENTENCES = 4
#: Weights of bigram, unigram and uniform distribution.
LAMBDA = (0.5, 0.4, 0.1)
ROUNDS = 3
#: Candidates of the calibration: gain a word from which a sentence counts; least share of a document's counted sentences.
SHARES = [0.0, 0.01, 0.02, 0.03, 0.05, 0.07]
MARGINS = [0.05, 0.08, 0.1, 0.12, 0.15, 0.18, 0.22, 0.26, 0.3, 0.35, 0.4, 0.5]

_BREAK = re.compile(r"</?(?:p|br|div|li|h\d)\b[^>]*>|[\n\r]+|(?<=[.!?])\s+|(?<=[.!?])(?=[A-ZÁÉÍÓÚÑ¿¡])", re.I)
_TAG = re.compile(r"<[^<>]{1,80}>")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence in lower case. Null and blank texts have none."""
    if not text:
        return []
    out = []
    for part in _BREAK.split(text):
        words = _WORD.findall(_TAG.sub(" ", part).lower()) if part else []
        if len(words) > 1:
            out.append(words)
    return out


@dataclass
class SubjectModel:
    """index: a word or (word, word) -> row of ``gain``; gain: log P(word | history, subject) - log P(word | history, background)."""

    subjects: list[str]
    index: dict
    gain: np.ndarray
    common: frozenset[str]
    passing: frozenset[tuple[str, ...]]
    margin: float
    share: float = 0.0

    def rows(self, words: list[str]) -> list[int]:
        index, out, before = self.index, [], "<s>"
        for word in words:
            row = index.get((before, word))
            if row is None:
                row = index.get(word, 0)
            out.append(row)
            before = word
        return out

    def frame(self, words: list[str], rows: list[int], best: int) -> tuple[str, ...]:
        """The common words of a sentence that don't speak for its subject: what the sentence is like, whatever it is about."""
        return tuple(w for w, r in zip(words, rows) if w in self.common and self.gain[r, best] < 1.0)

    def about(self, text: str | None) -> list[int]:
        """The subject of each sentence that is about one."""
        found = sentences(text)
        if not found:
            return []
        rows, total = _totals(self, found)
        best = total.argmax(axis=1)
        out = []
        for i in np.nonzero(total[np.arange(len(best)), best] >= self.margin)[0]:
            s = int(best[i])
            if not self.passing or self.frame(found[i], rows[i], s) not in self.passing:
                out.append(s)
        return out

    def subjects_of(self, text: str | None) -> list[str]:
        counts = Counter(self.about(text))
        least = max(LEAST_SENTENCES, self.share * sum(counts.values()))
        return [self.subjects[s] for s, n in sorted(counts.items()) if n >= least]


def _models(counted: list[tuple[list[str], int]], subjects: list[str], common: frozenset[str]) -> SubjectModel:
    """``counted``: sentences with their subject, -1 for none.

    The background is the even mixture of the subject models and the model of the sentences without one, so that a frequent
    subject is no more a part of it than a rare one.
    """
    k = len(subjects)
    uni: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(k + 1))
    bi: dict[tuple[str, str], np.ndarray] = defaultdict(lambda: np.zeros(k + 1))
    history: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(k + 1))
    size = np.zeros(k + 1)
    for words, s in counted:
        before = "<s>"
        j = s if s >= 0 else k
        for word in words:
            uni[word][j] += 1
            bi[before, word][j] += 1
            history[before][j] += 1
            size[j] += 1
            before = word
    vocabulary = max(1, len(uni))
    l2, l1, l0 = LAMBDA
    size = np.maximum(size, 1.0)
    one = {w: l1 * c / size + l0 / vocabulary for w, c in uni.items()}
    index: dict = {}
    gain = [np.zeros(k)]
    for w, p in one.items():
        index[w] = len(gain)
        gain.append(np.log(p[:k]) - math.log(p.mean()))
    for (h, w), c in bi.items():
        if c.sum() < 2:
            continue
        p = one[w] + l2 * c / np.maximum(history[h], 1.0)
        index[h, w] = len(gain)
        gain.append(np.log(p[:k]) - math.log(p.mean()))
    return SubjectModel(subjects, index, np.array(gain, dtype=np.float32), common, frozenset(), 0.15)


def _totals(model: SubjectModel, found: list[list[str]]) -> tuple[list[list[int]], np.ndarray]:
    """Rows and gain a word by subject of each sentence."""
    rows = [model.rows(words) for words in found]
    if not rows:
        return rows, np.zeros((0, len(model.subjects)))
    starts = np.cumsum([0] + [len(r) for r in rows[:-1]])
    sums = np.add.reduceat(model.gain[[r for one in rows for r in one]], starts, axis=0)
    return rows, sums / np.array([[len(r)] for r in rows])


def _fit(docs: list[tuple[list[list[str]], set[int]]], subjects: list[str]) -> SubjectModel:
    """Models from document labels: each sentence goes to the label whose model codes it best, or to none; a few rounds."""
    seen = Counter(w for sents, _ in docs for w in {w for s in sents for w in s})
    common = frozenset(w for w, n in seen.items() if n >= max(3, 0.02 * len(docs)))
    found = [s for sents, _ in docs for s in sents]
    allowed = np.zeros((len(found), len(subjects)), dtype=bool)
    at = 0
    for sents, labels in docs:
        allowed[at : at + len(sents), sorted(labels)] = True
        at += len(sents)
    # Sentences of documents with one label start the models.
    start = [int(a.argmax()) if a.sum() == 1 else -1 for a in allowed]
    model = _models(list(zip(found, start)), subjects, common)
    for _ in range(ROUNDS):
        _, total = _totals(model, found)
        own = np.where(allowed, total, -np.inf)
        best = own.argmax(axis=1)
        value = own[np.arange(len(found)), best]
        sure = (value >= 0.1) & (value >= total.max(axis=1) - 0.05)
        model = _models([(words, int(b) if ok else -1) for words, b, ok in zip(found, best, sure)], subjects, common)
    return model


def _calibrate(model: SubjectModel, train_docs: list, held: list) -> None:
    """Set margin, share and passing frames: the frames from the documents trained on, margin and share by F1 on the others."""
    scores = []
    _, total = _totals(model, [s for sents, _ in held for s in sents])
    rows = [model.rows(s) for sents, _ in held for s in sents]
    flat = [s for sents, _ in held for s in sents]
    best = total.argmax(axis=1) if len(flat) else np.zeros(0, dtype=int)
    value = total.max(axis=1) if len(flat) else np.zeros(0)
    frames = [model.frame(words, r, int(b)) for words, r, b in zip(flat, rows, best)]
    for margin in MARGINS:
        model.margin = margin
        passing = _passing(model, train_docs)
        counted, at = [], 0
        for sents, labels in held:
            n = Counter(int(best[i]) for i in range(at, at + len(sents)) if value[i] >= margin and frames[i] not in passing)
            counted.append((n, labels))
            at += len(sents)
        for share in SHARES:
            hit = wrong = missed = 0
            for n, labels in counted:
                least = max(LEAST_SENTENCES, share * sum(n.values()))
                got = {s for s, k in n.items() if k >= least}
                hit, wrong, missed = hit + len(got & labels), wrong + len(got - labels), missed + len(labels - got)
            scores.append((2 * hit / max(1, 2 * hit + wrong + missed), -share, -margin))
    top = max(scores)
    model.margin, model.share = -top[2], -top[1]


def _passing(model: SubjectModel, docs: list[tuple[list[list[str]], set[int]]]) -> frozenset[tuple[str, ...]]:
    """Frames of sentences whose subject is seldom a label of the document: mentions in passing."""
    agree: Counter = Counter()
    met: Counter = Counter()
    flat = [(words, labels) for sents, labels in docs for words in sents]
    rows, total = _totals(model, [words for words, _ in flat])
    for (words, labels), r, t in zip(flat, rows, total):
        best = int(t.argmax())
        if t[best] >= model.margin:
            frame = model.frame(words, r, best)
            met[frame] += 1
            agree[frame] += best in labels
    return frozenset(f for f, n in met.items() if n >= 4 and len(f) >= 3 and agree[f] < 0.6 * n)


def train(labelled: list[tuple[str, list[str]]], subjects: list[str]) -> SubjectModel:
    """Fit the models on (text, subjects), calibrated on the half not trained on. No rows: nothing is accepted."""
    number = {s: i for i, s in enumerate(subjects)}
    docs = [(sentences(text), {number[s] for s in labels if s in number}) for text, labels in labelled]
    if not docs or not subjects:
        return SubjectModel(subjects, {}, np.zeros((1, max(1, len(subjects))), dtype=np.float32), frozenset(), frozenset(), math.inf)
    half = _fit(docs[::2], subjects)
    _calibrate(half, docs[::2], docs[1::2] or docs)
    model = _fit(docs, subjects)
    model.margin, model.share = half.margin, half.share
    model.passing = _passing(model, docs)
    return model


def labelled_texts(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> list[tuple[str, list[str]]]:
    """At most ``most`` labelled documents, whole texts. This bounded sample is all that reaches the driver."""
    chosen = labels.where("doc_id is not null and subject is not null").groupBy("doc_id").agg(F.collect_set("subject").alias("subjects")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").orderBy("doc_id").collect()
    return [(r.text, r.subjects) for r in rows]


def classify(documents: DataFrame, model: SubjectModel) -> DataFrame:
    """(doc_id, subject): one row for each subject of each document; none for null or blank texts."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            rows = [(i, s) for i, text in zip(batch.doc_id, batch.text) for s in own.subjects_of(text)]
            yield pd.DataFrame(rows, columns=["doc_id", "subject"])

    return documents.where("doc_id is not null and text is not null").select("doc_id", "text").mapInPandas(run, "doc_id long, subject string")


def document_subjects(documents: DataFrame, labels: DataFrame, subject_ref: DataFrame) -> DataFrame:
    names = sorted(r.subject for r in subject_ref.select("subject").where("subject is not null").distinct().collect())
    return classify(documents, train(labelled_texts(documents, labels), names))
