"""Operator 10: toxicity by a counterfactual-regularised classifier.

A logistic regression on the set of a text's words (lower-cased, without ASCII
punctuation, hashed).  It is fitted on a bounded sample of labelled documents.
Every training document that mentions a group gets a counterfactual, in which the
term is swapped for another of its kind, and the squared change of the score is
penalised; documents without such a mention are paired with a copy that neutrally
mentions a term.  Naming a group then moves a score hardly at all.

Scoring covers every whole text and is one pass without a shuffle.

Defined cases: null, empty and blank texts get the model's score of a text without
words; several labels of one document count as toxic if any does; without any
labelled training row every score is 0.5; equal texts get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import textkernel as K
from sparkmine.llm.common import cut_lineage, documents

#: Labelled rows used for fitting (by hash of id and text), and hashed words.
MAX_TRAIN = 20_000
HASHED = 1 << 20
#: Words with the strongest association that enter the model; least documents per word.
KEEP, LEAST_DOCS = 2_000, 8
L2, PENALTY, ROUNDS = 3e-4, 1.0, 400
THRESHOLD = 0.7

# Neutral group terms by kind; a term is swapped within its line.
IDENTITY_TERMS = [
    "christian christians muslim muslims jewish jews hindu hindus buddhist buddhists sikh atheist atheists catholic catholics protestant",
    "gay lesbian bisexual straight heterosexual homosexual transgender queer",
    "black white asian african european american mexican chinese indian arab latino hispanic",
    "woman women man men girl girls boy boys female male",
    "old young elderly teenager blind deaf disabled",
    "immigrant immigrants refugee refugees foreigner foreigners citizen citizens",
    "chrétien chrétienne musulman musulmane juif juive athée femme femmes homme hommes noir noire blanc blanche étranger immigré",
    "christlich muslimisch jüdisch frau frauen mann männer schwarz weiß ausländer flüchtling",
    "cristiano musulmán judío ateo mujer mujeres hombre hombres negro blanco extranjero inmigrante",
]


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def _features(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hashed word), each pair once."""
    h, doc = chunk.drop_punctuation().words(lower=True)
    pair = np.unique(doc.astype(np.int64) * HASHED + (h % K.U64(HASHED)).astype(np.int64))
    return pair // HASHED, pair % HASHED


def _sparse(batches):
    for batch in batches:
        for chunk in K.chunks(batch.column(1)):
            doc, word = _features(chunk)
            first = np.searchsorted(doc, np.arange(chunk.hi - chunk.lo + 1))
            body = [word[first[i] : first[i + 1]].astype(np.int32).tobytes() for i in range(chunk.hi - chunk.lo)]
            label, key = (batch.column(j).slice(chunk.lo, chunk.hi - chunk.lo) for j in (0, 2))
            yield pa.RecordBatch.from_arrays([label, pa.array(body, pa.binary()), key], ["toxic", "words", "row_hash"])


def _term_groups() -> list[np.ndarray]:
    out = []
    for line in IDENTITY_TERMS:
        (chunk,) = K.chunks(pa.array([line]))
        out.append((chunk.words(lower=True)[0] % K.U64(HASHED)).astype(np.int64))
    return out


@dataclass
class Model:
    weight: np.ndarray  # by hashed word
    bias: float

    def scores(self, chunk: K.Chunk) -> np.ndarray:
        doc, word = _features(chunk)
        z = self.bias + np.bincount(doc, self.weight[word], minlength=chunk.hi - chunk.lo)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _counterfactuals(rows: list[np.ndarray], column: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
    """(term taken away or -1, term put in) as columns of the model, one pair per
    swap; ``column`` maps hashed words to model columns (-1: not in the model)."""
    kind = {int(t): g for g in groups for t in g}
    pairs = []
    for i, words in enumerate(rows):
        mine = [int(t) for t in words if int(t) in kind]
        for t in mine:
            group = kind[t]
            other = int(group[(int(np.flatnonzero(group == t)[0]) + 1 + i % (len(group) - 1)) % len(group)])
            if other not in mine:
                pairs.append((column[t], column[other]))
        if not mine:
            group = groups[i % len(groups)]
            pairs.append((-1, column[group[(i // len(groups)) % len(group)]]))
    return np.array(pairs, dtype=np.int64).reshape(-1, 2)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Gradient descent (Adam) on logistic loss, L2 and the counterfactual penalty."""
    weight = np.zeros(HASHED)
    n, positive = len(rows), int(labels.sum())
    if not 0 < positive < n:
        return Model(weight, 0.0 if not n else (6.0 if positive else -6.0))
    groups = _term_groups()
    size = np.array([len(r) for r in rows])
    flat, doc = np.concatenate(rows).astype(np.int64), np.repeat(np.arange(n), size)
    there = np.bincount(flat, minlength=HASHED)
    with_label = np.bincount(flat, labels[doc], minlength=HASHED)
    rate = positive / n
    strength = np.where(there >= LEAST_DOCS, np.abs(with_label - there * rate) / np.sqrt(np.maximum(there, 1) * rate * (1 - rate)), 0)
    chosen = np.union1d(np.flatnonzero(strength > 4.0)[np.argsort(-strength[strength > 4.0], kind="stable")[:KEEP]], np.concatenate(groups))
    column = np.full(HASHED, -1)
    column[chosen] = np.arange(len(chosen))
    used = column[flat] >= 0
    col, row = column[flat[used]], doc[used]
    pairs = _counterfactuals(rows, column, groups)
    gone, put = pairs[:, 0], pairs[:, 1]
    had = gone >= 0
    w, b = np.zeros(len(chosen) + 1), np.log(rate / (1 - rate))
    theta, m, v = np.append(w, b), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        w, b = theta[:-1], theta[-1]
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[col], minlength=n), -30, 30)))
        err = (p - labels) / n
        grad = np.bincount(col, err[row], minlength=len(w)) + L2 * w
        change = (w[put] - np.where(had, w[gone], 0.0)) * (2 * PENALTY / len(pairs))
        grad += np.bincount(put, change, minlength=len(w)) - np.bincount(gone[had], change[had], minlength=len(w))
        grad = np.append(grad, err.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    weight[chosen] = theta[: len(chosen)]
    return Model(weight.astype(np.float32), float(theta[-1]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` rows that are labelled and not held out, also where a
    labelled id has many: rows equal in id and text count once, and of more than
    ``max_train`` the first by the hash of both are taken.  A row reaches the driver as
    at most 4 * HASHED bytes."""
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    marked = marked.groupBy(F.col(id_col).alias("own_id")).agg(F.max(F.col(label_col)).cast("double").alias("toxic"))
    sample = marked.orderBy(F.xxhash64("own_id"), "own_id").limit(max_train)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # at most max_train rows of 16 bytes are broadcast
    labelled = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("own_id")).select("toxic", "text", F.xxhash64("doc_id", "text").alias("row_hash"))
    sparse = cut_lineage(labelled.mapInArrow(_sparse, "toxic double, words binary, row_hash long").dropDuplicates(["row_hash"]))
    n = sparse.count()
    if n > max_train:
        # hashes spread evenly: a bound leaves few more than max_train rows to sort, in all partitions together
        bound = int(-(2**63) + 2**64 * min(1.0, 1.2 * (max_train + 100) / n))
        sparse = sparse.where(F.col("row_hash") < F.lit(min(bound, 2**63 - 1))).orderBy("row_hash").limit(max_train)
    rows = sparse.select("toxic", "words").collect()
    rows.sort(key=lambda r: (bytes(r["words"]), r["toxic"]))  # the same fit whatever the order of arrival
    return fit([np.frombuffer(r["words"], np.int32) for r in rows], np.array([r["toxic"] for r in rows]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every text."""

    def run(batches):
        for batch in batches:
            got = [model.scores(chunk) for chunk in K.chunks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over every whole text of ``documents``."""
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
