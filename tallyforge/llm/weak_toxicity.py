"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier on its posteriors.

Lexicon voters are mined from labelled rows: words, and beginnings of longer words, that toxic documents have much more
often. Pattern voters look at the writing. The label model estimates by expectation-maximization how each voter votes
given the hidden class, and how votes depend on each other beyond it; dependent voters count for less. Its posteriors are
the labels of a logistic regression over words and beginnings, which scores every text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import LETTER_RUN, held_out, map_slices, texts_of

SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"
#: Kinds of features: 0 is the whole word, k its first k letters where it is longer.
KINDS = (0, 4, 5, 6, 7, 8)
#: Words whose weights a task keeps; when full it starts anew.
MOST_WORDS = 200_000
PATTERNS = (
    ("shouting", lambda text, words: sum(map(str.isupper, text)) > 0.5 * sum(map(str.isalpha, text)), 1),
    ("exclaiming", lambda text, words: 10 * text.count("!") > len(words), 1),
    ("masked_letters", lambda text, words: re.search(r"[^\W\d_][*#@$]+[^\W\d_]", text) is not None, 1),
    ("addressing", lambda text, words: not {"you", "your", "tu", "du", "eres"}.isdisjoint(words), 1),
    ("very_long", lambda text, words: len(words) > 1000, 0),
)
ABSTAIN = 2
RELATED = 0.3


@dataclass(frozen=True)
class Supervision:
    """`sample_per_class`: about so many labelled documents of each class are learnt from, chosen by a hash of their ids.

    A feature is mined if its log-likelihood ratio reaches `least_evidence`; voters are told apart by `precisions`.
    """

    sample_per_class: int = 1500
    least_evidence: float = 9.0
    precisions: tuple[float, ...] = (0.97, 0.85)
    rounds: int = 30
    penalty: float = 0.02
    steps: int = 400
    threshold: float = 0.3


@dataclass(frozen=True)
class Classifier:
    """Weights of the mined features and of the patterns, for the sum over a text's distinct words."""

    weights: dict[int, float] = field(default_factory=dict)
    patterns: tuple[float, ...] = (0.0,) * len(PATTERNS)
    intercept: float = 0.0


def features(word: str) -> list[int]:
    """One id per kind that the word has."""
    found = [zlib.crc32(word.encode("utf-8", "surrogatepass"))]
    return found + [zlib.crc32(f"{k}:{word[:k]}".encode("utf-8", "surrogatepass")) for k in KINDS[1:] if len(word) > k]


def words_of(text: str) -> set[str]:
    return set(LETTER_RUN.findall(text.lower()))


def pattern_hits(text: str, words: set[str]) -> list[bool]:
    return [bool(words) and bool(test(text, words)) for _, test, _ in PATTERNS]


@dataclass
class Sample:
    """Labelled documents as the driver sees them: pairs (document, feature, distinct words with it), and patterns."""

    doc: np.ndarray
    feature: np.ndarray
    count: np.ndarray
    patterns: np.ndarray
    toxic: np.ndarray
    group: np.ndarray
    prior: float


def sample_of(documents: DataFrame, labels: DataFrame, how: Supervision) -> Sample | None:
    """A bounded sample of labelled rows that are not held out, as hashed features; None if a class has none.

    A document with two labels counts as toxic if one of them says so.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {True, False}:
        return None
    steps = 1_000_000
    limits = {c: max(1, round(steps * how.sample_per_class / n)) for c, n in sizes.items()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(steps))
    chosen = known.filter(place < F.when(F.col("toxic"), limits[True]).otherwise(limits[False]))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.col("text").isNotNull())
    texts = texts.filter(place < max(limits.values())).join(F.broadcast(chosen), "doc_id")

    def hashed(part: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        for text in texts_of(part):
            words = words_of(text)
            ids, counts = np.unique(np.array([f for w in words for f in features(w)], np.uint32), return_counts=True)
            signature = min((zlib.crc32(w.encode("utf-8", "surrogatepass"), 7) for w in words), default=0)
            row = (ids.tobytes(), counts.astype(np.uint16).tobytes(), pattern_hits(text, words), signature)
            for column, value in zip(columns, row):
                column.append(value)
        kinds = (pa.binary(), pa.binary(), pa.list_(pa.bool_()), pa.int64())
        arrays = [part.column("toxic"), *[pa.array(c, k) for c, k in zip(columns, kinds)]]
        return pa.RecordBatch.from_arrays(arrays, ["toxic", "ids", "counts", "patterns", "signature"])

    rows = map_slices(texts, hashed, "toxic boolean, ids binary, counts binary, patterns array<boolean>, signature bigint").collect()
    if {r["toxic"] for r in rows} != {True, False}:
        return None
    rows.sort(key=lambda r: (r["signature"], r["ids"]))
    ids = [np.frombuffer(r["ids"], np.uint32) for r in rows]
    return Sample(
        doc=np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in ids]),
        feature=np.concatenate(ids),
        count=np.concatenate([np.frombuffer(r["counts"], np.uint16) for r in rows]),
        patterns=np.array([r["patterns"] for r in rows], bool).reshape(len(rows), len(PATTERNS)),
        toxic=np.array([r["toxic"] for r in rows]),
        group=np.unique([r["signature"] for r in rows], return_inverse=True)[1],
        prior=sizes[True] / (sizes[True] + sizes[False]),
    )


def mine(sample: Sample, how: Supervision) -> tuple[np.ndarray, np.ndarray]:
    """Features that toxic documents have more often, and their precision at equal class sizes.

    Copies of one document (equal signatures) count once.
    """
    per_class = (sample.group * 2 + sample.toxic).astype(np.int64)
    pairs = np.unique(per_class[sample.doc] << 32 | sample.feature)
    names, at = np.unique((pairs & 0xFFFFFFFF).astype(np.uint32), return_inverse=True)
    is_toxic = (pairs >> 32 & 1).astype(bool)
    toxic, clean = (np.bincount(at[is_toxic == c], minlength=len(names)).astype(float) for c in (True, False))
    n_toxic, n_clean = (len(np.unique(sample.group[sample.toxic == c])) for c in (True, False))
    p, q = (toxic + 0.25) / (n_toxic + 0.5), (clean + 0.25) / (n_clean + 0.5)
    both = (toxic + clean + 0.5) / (n_toxic + n_clean + 1)
    evidence = 2 * (toxic * np.log(p / both) + clean * np.log(q / both))
    chosen = (toxic >= 3) & (p > q) & (evidence >= how.least_evidence)
    return names[chosen], (p / (p + q))[chosen]


def only(sample: Sample, mined: np.ndarray) -> Sample:
    """The sample without the features that were not mined."""
    kept = np.isin(sample.feature, mined)
    return replace(sample, doc=sample.doc[kept], feature=sample.feature[kept], count=sample.count[kept])


def votes_of(sample: Sample, mined: np.ndarray, precision: np.ndarray, how: Supervision) -> np.ndarray:
    """One row per document, one column per voter: 1 toxic, 0 clean, 2 abstains.

    Lexicons are the mined features of one precision tier, dealt to eight by their hash, so that voters differ; a
    strict one needs one hit, a loose one two. For each tier one more voter says clean where its lexicons find nothing.
    """
    n = len(sample.toxic)
    tier = sum((precision < p).astype(int) for p in how.precisions)
    order = np.argsort(mined)
    place = np.searchsorted(mined[order], sample.feature)
    place = np.minimum(place, max(len(mined) - 1, 0))
    hit = mined[order][place] == sample.feature if len(mined) else np.zeros(len(sample.feature), bool)
    docs, which = sample.doc[hit], order[place[hit]] if len(mined) else place[hit]
    columns = []
    for t in range(len(how.precisions) + 1):
        of_tier = tier[which] == t
        for part in range(8):
            counts = np.bincount(docs[of_tier & (mined[which] % 8 == part)], minlength=n)
            columns.append(np.where(counts > t, 1, ABSTAIN))
        columns.append(np.where(np.bincount(docs[of_tier], minlength=n) > t, ABSTAIN, 0))
    for i, (_, _, vote) in enumerate(PATTERNS):
        columns.append(np.where(sample.patterns[:, i], vote, ABSTAIN))
    return np.stack(columns, axis=1)


def label_model(votes: np.ndarray, start: np.ndarray, prior: float, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of the hidden class, P(vote | class) per voter, and each voter's weight.

    `start` holds what a labelled row's own label says, one more voter of known accuracy. After each round, correlations
    of the votes that the classes don't explain give the weights: a voter that goes along with others counts in part.
    Correlations below RELATED are taken for chance.
    """
    kinds = np.stack([votes == v for v in (0, 1, ABSTAIN)], axis=2).astype(float)
    posterior, weights = start.astype(float), np.ones(votes.shape[1])
    own = np.log(start / (1 - start))
    for _ in range(rounds):
        classes = np.stack([1 - posterior, posterior])
        given = np.einsum("cn,njv->cjv", classes, kinds) + 0.5
        given /= given.sum(axis=2, keepdims=True)
        active = kinds[:, :, :2].sum(axis=2)
        residual = active - np.einsum("cn,cj->nj", classes, 1 - given[:, :, 2])
        scale = np.sqrt((residual**2).mean(axis=0)) + 1e-9
        related = np.abs(residual.T @ residual / len(votes)) / np.outer(scale, scale)
        np.fill_diagonal(related, 0)
        related[related < RELATED] = 0
        weights = 1 / (1 + related.sum(axis=1))
        logit = np.log(prior / (1 - prior)) + own + np.einsum("njv,jv,j->n", kinds, np.log(given[1] / given[0]), weights)
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior, given, weights


def fit(sample: Sample | None, how: Supervision = Supervision()) -> Classifier:
    """The classifier. Without labelled rows of both classes every text scores one half of the threshold."""
    if sample is None:
        half = how.threshold / 2
        return Classifier(intercept=float(np.log(half / (1 - half))))
    mined, precision = mine(sample, how)
    sample = only(sample, mined)
    votes = votes_of(sample, mined, precision, how)
    posterior, _, _ = label_model(votes, np.where(sample.toxic, 0.95, 0.05), float(sample.toxic.mean()), how.rounds)
    names = np.sort(mined)
    place = np.minimum(np.searchsorted(names, sample.feature), max(len(names) - 1, 0))
    hit = names[place] == sample.feature if len(names) else np.zeros(len(sample.feature), bool)
    doc, column, value = sample.doc[hit], place[hit], sample.count[hit].astype(float)
    patterns = sample.patterns.astype(float)
    n, groups = len(posterior), np.bincount(sample.group)
    share = 1 / groups[sample.group]  # copies count as one document
    share /= share.sum()
    w, v, b = np.zeros(len(names)), np.zeros(patterns.shape[1]), 0.0
    moments = [np.zeros(len(names)), np.zeros(len(v)), 0.0]
    for step in range(how.steps):
        logit = np.bincount(doc, weights=value * w[column], minlength=n) + patterns @ v + b
        error = share * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - posterior)
        slopes = (
            np.bincount(column, weights=value * error[doc], minlength=len(names)) + how.penalty / n * w,
            patterns.T @ error + how.penalty * v,
            error.sum(),
        )
        moments = [0.9 * m + s for m, s in zip(moments, slopes)]
        rate = 2.0 / (1 + step / how.steps)
        w, v, b = w - rate * moments[0], v - rate * moments[1], b - rate * moments[2]
    balance = sample.toxic.mean()
    shift = np.log(sample.prior / (1 - sample.prior)) - np.log(balance / (1 - balance))
    return Classifier(dict(zip(names.tolist(), w.tolist())), tuple(v.tolist()), float(b + shift))


class Scorer:
    """Scores texts; keeps the weights of words it has met."""

    def __init__(self, classifier: Classifier):
        self.classifier, self.known = classifier, {}

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MOST_WORDS:
                self.known.clear()
            weights = self.classifier.weights
            found = self.known[word] = sum(weights.get(f, 0.0) for f in features(word))
        return found

    def score(self, text: str) -> float:
        words = words_of(text)
        logit = self.classifier.intercept + sum(sorted(x for w in words if (x := self.weight(w))))
        logit += sum(w for hit, w in zip(pattern_hits(text, words), self.classifier.patterns) if hit)
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def scorer(shared) -> Scorer:
    """One per Python worker and classifier."""
    if _SCORERS.get("of") is not shared.value:
        _SCORERS.update(of=shared.value, scorer=Scorer(shared.value))
    return _SCORERS["scorer"]


_SCORERS: dict = {}


def train(documents: DataFrame, labels: DataFrame, how: Supervision = Supervision()) -> Classifier:
    return fit(sample_of(documents, labels, how), how)


def weak_toxicity(documents: DataFrame, labels: DataFrame, how: Supervision = Supervision()) -> DataFrame:
    """One row per row of `documents` (doc_id, text): a score from 0 to 1, and whether it reaches the threshold.

    `labels` (doc_id, toxic) is learnt from where the id is not held out; a score uses the text alone. A null or empty
    text scores like a text without any known word. Repeated rows give repeated rows; other columns are ignored; an
    empty table gives no rows. Texts are read in place; only the bounded sample comes to the driver.
    """
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels, how))

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        scores = [scorer(shared).score(text) for text in texts_of(part)]
        columns = [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64())]
        columns.append(pa.array([int(s >= how.threshold) for s in scores], pa.int32()))
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out().alias("held_out"))
    return map_slices(rows, judge, SCHEMA)


def not_toxic(documents: DataFrame, labels: DataFrame, how: Supervision = Supervision()) -> DataFrame:
    """The documents that score below the threshold, all columns kept."""
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels, how))

    def keep(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array([scorer(shared).score(text) < how.threshold for text in texts_of(part)], pa.bool_()))

    return map_slices(documents, keep, documents.schema)
