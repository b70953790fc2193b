"""Toxicity severity by cumulative-link ordinal regression.

Ordered grades 0 (clean) to ``GRADES`` share one weight vector ``w`` over
sparse text features; each grade has its own threshold:
``P(grade >= k) = sigmoid(w . x - theta_k)`` with ``theta_1 < theta_2 < ...``.
The expected severity is the sum of these probabilities.

Labels only say toxic or not, so the grades of toxic rows are derived: the
number of a text's words that are toxic-associated, cut at its terciles.

Fitting reads a bounded sample of labelled rows (``max_labelled``, half of it
per class, in hash order of doc_id). Near copies inside the sample count once
(equal minimum hash of word pairs), so one copied text cannot turn its words
into evidence. Terms are words and word beginnings of ``PREFIXES`` letters
(inflected and compound forms share a beginning). A term is used if its
chi-square association with the label is the best of its chain (a word and its
beginnings) and passes ``MIN_CHI2``, counted over the texts that hold it or over those where it makes at least ``OFTEN`` of the
words; at most ``MAX_FEATURES`` terms reach the driver, which bounds the fit
and the model sent to the workers. Each term gives three features: present
or not, and the logs of its count and of its rate per thousand words.

The rejection threshold is the expected severity that separates the sample
best, a falsely rejected row weighing ``FALSE_REJECT`` missed ones.

Defined results: null and empty texts have severity 0 and are kept; texts of
any length are read whole; without labels of both classes every severity is 0
and nothing is rejected; repeated rows are scored alike; other columns pass.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import fresh, whole_text, written

GRADES = 3
MAX_FEATURES = 1000
MIN_CHI2 = 24.0          # about one false feature in a million words
MIN_DOCS = 5
FALSE_REJECT = 5.0
LINK_WEIGHT = np.array([1.0, 0.1, 0.1])  # toxic or not counts most: only it is labelled
SIGNATURES = 3
PREFIXES = (3, 4, 5, 6, 7)
OFTEN = 0.01
CACHE = 200_000          # distinct words remembered by a task
# ASCII punctuation counts as white space
_TABLE = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def tokens(text: str | None) -> list[str]:
    """Lower-case words; ASCII punctuation separates them."""
    return [w.decode() for w in text.lower().encode().translate(_TABLE).split()] if text else []


def terms(word: str) -> list[str]:
    """The word itself and, marked by a trailing asterisk, its beginnings."""
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) >= k)]


@dataclass
class Model:
    terms: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thetas: np.ndarray = field(default_factory=lambda: np.full(GRADES, np.inf))
    threshold: float = float("inf")

    def features(self, hits: np.ndarray, n_words: float) -> np.ndarray:
        """hits: count of each term in one text."""
        return np.concatenate([hits > 0, np.log1p(hits), np.log1p(1000.0 * hits / max(n_words, 1))])

    def exceed(self, texts) -> list[np.ndarray]:
        """P(grade >= 1 .. GRADES) of each text."""
        clean = 1 / (1 + np.exp(np.minimum(self.thetas, 700)))
        out = []
        known: dict[str, tuple] = {}  # word -> its terms in the model
        for t in texts:
            toks = tokens(t)
            if len(known) > CACHE:
                known = {}
            for w in set(toks).difference(known):
                known[w] = tuple(i for i in map(self.terms.get, terms(w)) if i is not None)
            found = [i for ids in map(known.__getitem__, toks) if ids for i in ids]
            if found:
                x = self.features(np.bincount(found, minlength=len(self.terms)), len(toks))
                out.append(1 / (1 + np.exp(np.clip(self.thetas - x @ self.weights, -700, 700))))
            else:
                out.append(clean)
        return out


def fit_ordinal(x: np.ndarray, grade: np.ndarray, steps: int = 1000, l2: float = 3e-5):
    """Weights and ascending thresholds by full-batch Adam on the summed
    binary losses of the cumulative links."""
    over = grade[:, None] >= np.arange(1, GRADES + 1)
    # thetas as a start and log gaps, so they stay in order
    par = np.concatenate([np.zeros(x.shape[1]), [1.0], np.zeros(GRADES - 1)])
    m, v = np.zeros_like(par), np.zeros_like(par)
    d = x.shape[1]
    for t in range(1, steps + 1):
        gaps = np.exp(par[d + 1:])
        theta = par[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        err = 1 / (1 + np.exp(np.clip(theta - (x @ par[:d])[:, None], -60, 60))) - over
        err *= LINK_WEIGHT / len(x)
        g_theta = -err.sum(0)
        tail = np.cumsum(g_theta[::-1])[::-1]
        grad = np.concatenate([x.T @ err.sum(1) + l2 * par[:d], [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        par -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return par[:d], par[d] + np.concatenate([[0.0], np.cumsum(np.exp(par[d + 1:]))])


def _distinct_terms(found: list) -> list:
    """Of nested terms (a word and its beginnings), the best associated one.
    ``found`` is in falling order of association."""
    kept: list = []
    for r in found:
        stem = r.w.rstrip("*")
        if not any(stem.startswith(k) or k.startswith(stem) for k in (x.w.rstrip("*") for x in kept)):
            kept.append(r)
    return kept


def _sample(docs: DataFrame, labels: DataFrame, max_labelled: int, key: str, text: str) -> DataFrame:
    """Labelled rows with their distinct terms and counts, near copies once."""
    rows = labels.select(F.col(key).alias("id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    halves = [rows.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(max_labelled // 2)
              for c in (0, 1)]
    sample = halves[0].union(halves[1])  # at most max_labelled rows: a bounded broadcast

    def run(batches):
        import pyarrow as pa
        import xxhash
        for b in batches:
            out = []
            for i, tox, t in zip(*(c.to_pylist() for c in b.columns)):
                toks = tokens(t)
                counts = Counter(x for w, n in Counter(toks).items() for x in terms(w) for _ in range(n))
                two = {f"{a} {c}" for a, c in zip(toks, toks[1:])} or set(toks)
                sig = [min((xxhash.xxh64_intdigest(s, seed) >> 1 for s in two), default=-1)
                       for seed in range(SIGNATURES)]
                out.append((i, tox, len(toks), sig, list(counts), list(counts.values())))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             names=["id", "toxic", "n", "sig", "terms", "counts"]) \
                if out else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds],
                                                       names=["id", "toxic", "n", "sig", "terms", "counts"])

    import pyarrow as pa
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32())]
    picked = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")) \
        .join(F.broadcast(sample), "id").select("id", "toxic", "text")
    got = picked.mapInArrow(run, "id long, toxic int, n long, sig array<long>, terms array<string>, counts array<int>")
    for k in range(SIGNATURES):  # partial minima before the shuffle, so copies meet as one row per task
        got = got.groupBy(F.col("sig")[k].alias("s")).agg(
            F.min(F.struct("id", "toxic", "n", "sig", "terms", "counts")).alias("r")).select("r.*")
    return got


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000,
        key: str = "doc_id", text: str = "text") -> Model:
    spark = docs.sparkSession
    sample = written(spark, _sample(docs, labels, max_labelled, key, text), "toxic-sample")
    size = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return Model()
    # chi-square of the two-by-two table (word present, toxic)
    def chi2(a: str, c: str) -> Column:
        a, c = F.col(a).cast("double"), F.col(c).cast("double")
        n = float(pos + neg)
        return n * F.pow(a * (neg - c) - c * (pos - a), F.lit(2)) / ((a + c + 1e-9) * (n - a - c + 0.5) * pos * neg)

    tox, often = F.col("toxic"), (F.col("p.counts") >= OFTEN * F.col("n")).cast("int")
    found = sample.select("toxic", "n", F.explode(F.arrays_zip("terms", "counts")).alias("p")) \
        .groupBy(F.col("p.terms").alias("w")) \
        .agg(F.sum(tox).alias("a"), F.sum(1 - tox).alias("c"),
             F.sum(tox * often).alias("a_often"), F.sum((1 - tox) * often).alias("c_often")) \
        .where(F.col("a") + F.col("c") >= MIN_DOCS) \
        .withColumn("chi2", F.greatest(chi2("a", "c"), chi2("a_often", "c_often"))) \
        .where(F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), F.desc(F.length("w")), "w").limit(MAX_FEATURES).collect()
    if not found:
        return Model()
    found = _distinct_terms(found)
    known = {r.w: i for i, r in enumerate(found)}
    names = F.array(*map(F.lit, known))
    hits = sample.select("toxic", "n", F.filter(
        F.arrays_zip("terms", "counts"), lambda p: F.array_contains(names, p["terms"])).alias("hits")).collect()
    model = Model(terms=known)
    count = np.zeros((len(hits), len(known)))
    for i, r in enumerate(hits):
        for h in r.hits:
            count[i, known[h["terms"]]] = h["counts"]
    total = np.array([r.n for r in hits], float)
    toxic = np.array([r.toxic for r in hits])
    up = np.array([r.a / pos > r.c / neg for r in found])
    amount = count[:, up].sum(1)
    cuts = np.quantile(amount[(toxic == 1) & (amount > 0)], np.arange(1, GRADES) / GRADES)
    grade = toxic * (1 + (amount[:, None] > cuts).sum(1))
    x = np.stack([model.features(h, t) for h, t in zip(count, total)])
    model.weights, model.thetas = fit_ordinal(x, grade)
    severity = (1 / (1 + np.exp(np.clip(model.thetas - (x @ model.weights)[:, None], -700, 700)))).sum(1)
    levels = np.unique(severity)
    middles = np.concatenate([(levels[1:] + levels[:-1]) / 2, [np.inf]])
    flagged = severity[:, None] >= middles
    gain = flagged[toxic == 1].mean(0) - FALSE_REJECT * flagged[toxic == 0].mean(0)
    best = np.flatnonzero(gain == gain.max())
    model.threshold = float(middles[best[len(best) // 2]])
    return model


def exceedance(model: Model, text: Column) -> Column:
    """array<double>: P(grade >= 1), P(grade >= 2), ..."""
    @F.pandas_udf("array<double>")
    def probs(s: pd.Series) -> pd.Series:
        return pd.Series(model.exceed(s), dtype=object)
    return probs(text)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``tox_severity``, ``tox_grade``,
    ``tox_rejected`` (with underscores added where a name is taken)."""
    p, sev, gra, rej = (fresh(docs, n) for n in ("tox_p", "tox_severity", "tox_grade", "tox_rejected"))
    out = docs.withColumn(p, exceedance(model, whole_text(text)))
    out = out.withColumn(sev, F.aggregate(p, F.lit(0.0), lambda a, x: a + x)) \
        .withColumn(gra, F.size(F.filter(p, lambda x: x >= 0.5)))
    return out.withColumn(rej, F.col(sev) >= F.lit(model.threshold)).drop(p)


def keep_clean(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with the same columns."""
    scored = score(docs, fit(docs, labels, max_labelled))
    return scored.where(~F.col(scored.columns[-1])).select(*docs.columns)
