"""Operator 9: quality by co-training two views.

The text view describes the content (share of letters, capitals, signs, digits; distinct and repeated
words; commonest word; word length). The metadata view describes the page without its words (source,
language, length, lines, bytes per character). Each view has a logistic classifier. In every round each
view labels the unlabelled documents it is surest of, and the other view learns from them; at
the end a logistic combination, fitted on labelled rows only, calibrates the two views' scores.

Training: at most ``train_rows`` labelled and ``pool_rows`` unlabelled documents (by a hash of doc_id; a
documented bound) reach the driver as feature vectors. Scoring covers all rows in one pass.

Cases: null and empty texts have all text features 0 and are scored by the same model. Null source, language
or length count as the empty string and 0. Without labels of both kinds the score is the share of good
labels (1 without labels), and nothing is rejected. Repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, table
from .langid import held_out
from .toxicity import logistic

SOURCE_BINS, LANG_BINS = 16, 8
TEXT_FEATURES = 12
META_FEATURES = 6 + SOURCE_BINS + LANG_BINS
_KIND = np.zeros(256, np.uint8)  # 1 small letter, 2 capital, 3 digit, 4 blank, 5 sign, 6 byte of a non-ASCII character
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[[32, 9, 10, 13]] = 4
_KIND[128:] = 6
_KIND[[b for b in range(33, 127) if _KIND[b] == 0]] = 5


def text_features(data: bytes) -> list[float]:
    if not data:
        return [0.0] * TEXT_FEATURES
    n = len(data)
    kind = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=7) / n
    words = data.split()
    if not words:
        return [*kind[1:7], *[0.0] * (TEXT_FEATURES - 6)]
    count: dict[bytes, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    again = sum(a == b for a, b in zip(words, words[1:])) / len(words)
    lines = data.split(b"\n")
    stops = data.count(b".") + data.count(b",")
    return [*kind[1:7], len(count) / len(words) ** 0.8, max(count.values()) / len(words), again,
            min(20.0, sum(map(len, words)) / len(words)) / 10, 1 - len(set(lines)) / len(lines), min(1.0, stops / len(words))]


def meta_features(n_bytes: int, n_lines: int, n_chars, source, lang) -> list[float]:
    n_chars = n_chars or 0
    out = [np.log1p(max(0, n_chars)) / 5, np.log1p(n_bytes) / 5, np.log1p(n_lines) / 3, min(3.0, n_bytes / max(1, n_chars)),
           np.log1p(n_bytes / n_lines) / 5, float(n_chars == 0)]
    s, g = [0.0] * SOURCE_BINS, [0.0] * LANG_BINS
    s[zlib.crc32((source or "").encode()) % SOURCE_BINS] = 1.0
    g[zlib.crc32((lang or "").encode()) % LANG_BINS] = 1.0
    return [*out, *s, *g]


def view_matrix(batch) -> tuple[np.ndarray, np.ndarray]:
    texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
    text = np.array([text_features(t) for t in texts], np.float64).reshape(len(texts), TEXT_FEATURES)
    meta = np.array([meta_features(len(t), t.count(b"\n") + 1, c, s, g) for t, c, s, g in
                     zip(texts, *(batch.column(x).to_pylist() for x in ("n_chars", "source", "lang")))], np.float64)
    return text, meta.reshape(len(texts), META_FEATURES)


class View:
    """A logistic classifier on standardised features and their squares."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        z = self._wide(x)
        self.mean, self.scale = z.mean(axis=0), z.std(axis=0) + 1e-9
        self.coef = logistic((z - self.mean) / self.scale, y, ridge=1.0)

    @staticmethod
    def _wide(x):
        return np.hstack([x, x * x])

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((self._wide(x) - self.mean) / self.scale, -8, 8)
        return np.clip(z @ self.coef[:-1] + self.coef[-1], -30, 30)


def co_train(labelled, y, pool, rounds: int = 4, share: float = 0.05, sure: float = 0.95) -> dict:
    """labelled, pool: pairs (text features, metadata features). Each round a view hands over at most
    ``share`` of the pool, and only rows whose own probability is at least ``sure`` for one class."""
    sure_logit = np.log(sure / (1 - sure))
    own = [[labelled[v]] for v in (0, 1)]
    tags = [[y] for _ in (0, 1)]
    free = np.ones(len(pool[0]), bool)
    views = [View(labelled[v], y) for v in (0, 1)]
    for _ in range(rounds):
        given = []
        for v in (0, 1):
            z = views[v].logit(pool[v]) if len(free) else np.zeros(0)
            rows = np.flatnonzero(free & (np.abs(z) >= sure_logit))
            rows = rows[np.argsort(-np.abs(z[rows]), kind="stable")][: int(share * len(free))]
            given.append((rows, (z[rows] > 0).astype(float)))
        for v in (0, 1):  # the other view's rows
            rows, tag = given[1 - v]
            own[v].append(pool[v][rows])
            tags[v].append(tag)
        free[np.concatenate([r for r, _ in given])] = False
        views = [View(np.vstack(own[v]), np.concatenate(tags[v])) for v in (0, 1)]
        if not any(len(r) for r, _ in given):
            break
    z = np.column_stack([views[v].logit(labelled[v]) for v in (0, 1)])
    return {"views": views, "mix": logistic(z, y, ridge=0.1), "flat": None}


def _sample(df: DataFrame, rows: int, count: int) -> DataFrame:
    return df if count <= rows else df.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(rows / count * (1 << 30)))


def _collect(df: DataFrame):
    """Feature rows of a bounded sample: (text view, metadata view, labels)."""
    def run(batches):
        for batch in batches:
            text, meta = view_matrix(batch)
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(np.hstack([text, meta]).tolist(), pa.list_(pa.float64()))], ["quality", "x"])

    rows = df.select("text", "lang", "source", "n_chars", F.col("quality").cast("int").alias("quality")).mapInArrow(run, "quality int, x array<double>").collect()
    x = np.array([r.x for r in rows], np.float64).reshape(len(rows), TEXT_FEATURES + META_FEATURES)
    return (x[:, :TEXT_FEATURES], x[:, TEXT_FEATURES:]), np.array([float(r.quality or 0) for r in rows])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, pool_rows: int = 20_000) -> dict:
    """docs: the columns of documents; labels: doc_id, quality (rows to learn from)."""
    labels = labels.where("quality IS NOT NULL").select("doc_id", "quality")
    n, mean = labels.agg(F.count("*"), F.avg("quality")).first()
    if not n or mean in (0.0, 1.0):
        return {"views": None, "mix": None, "flat": 1.0 if mean is None else float(mean)}
    base = docs.select(*DOCUMENT_COLUMNS)
    labelled, y = _collect(_sample(base.join(_sample(labels, train_rows, n), "doc_id"), train_rows, train_rows))
    others = base.join(labels.select("doc_id"), "doc_id", "left_anti").withColumn("quality", F.lit(None).cast("int"))
    total = docs.select("doc_id").count()
    pool, _ = _collect(_sample(others, pool_rows, max(1, total - n)))
    if not len(y) or y.min() == y.max():
        return {"views": None, "mix": None, "flat": float(mean)}
    return co_train(labelled, y, pool)


def score(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """The columns ``keep``, then text_score, meta_score and quality_score (probabilities)."""
    def run(batches):
        def squash(z):
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

        for batch in batches:
            if model["views"] is None:
                p = [np.full(batch.num_rows, model["flat"])] * 3
            else:
                text, meta = view_matrix(batch)
                z = [model["views"][0].logit(text), model["views"][1].logit(meta)]
                m = model["mix"]
                p = [squash(z[0]), squash(z[1]), squash(m[0] * z[0] + m[1] * z[1] + m[2])]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(x) for x in p]], [*keep, "text_score", "meta_score", "quality_score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*DOCUMENT_COLUMNS).mapInArrow(run, schema + ", text_score double, meta_score double, quality_score double")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, the two views' scores, the combined score and the decision.
    Rows whose crc32(doc_id) mod 5 is 0 are held out from learning."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    return score(docs, model, ["doc_id"]).select(
        "doc_id", held_out(5, 0).alias("held_out"), "text_score", "meta_score", "quality_score",
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose combined score is at least 0.5."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, DOCUMENT_COLUMNS).where("quality_score >= 0.5").select(*DOCUMENT_COLUMNS)
