"""Operator 2: language identification with hyperdimensional n-gram profiles.

Every letter has a random vector of +1/-1 (seeded by its code point); white space, digits and signs
share one boundary symbol. A trigram is bound as the product of its letters' vectors, the first permuted
twice and the second once. A document's vector is the bundle (sum) of its trigram vectors, each
weighted with the square root of its count; a language's prototype is the bundle of its training
documents' unit vectors. The prediction is the prototype with the largest cosine.

Training: documents with a language whose crc32(doc_id) mod 4 is not 2, at most ``train_per_lang`` of
each language, chosen by a hash of doc_id (a documented bound; everything else runs over all rows).

Cases: null texts and texts without a letter are ``und`` with score 0. Ties go to the language that sorts
first. Without any training document every row is ``und``. Repeated rows are scored alike; extra columns
are ignored. Long texts are counted in pieces, so memory follows ``CHUNK_CHARS``, not the text.
Driver and broadcast data: (languages x dimensions) numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, worker_cache

DIMENSIONS = 1024
CHUNK_CHARS = 1 << 20


class Profiles:
    """Document vectors; the letter vectors and symbol numbers of a worker."""

    def __init__(self, dimensions: int):
        self.d = dimensions
        self.symbol = np.full(0x110000, -1, np.int32)
        self.letters = np.ones((1, dimensions), np.int8)
        self.letters[0] = self.letter_vector(0)

    def letter_vector(self, code: int) -> np.ndarray:
        return np.random.Generator(np.random.Philox(key=code)).integers(0, 2, self.d, dtype=np.int8) * 2 - 1

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        s = self.symbol[codes]
        if (s < 0).any():
            new = np.unique(codes[s < 0])
            is_letter = np.array([chr(c).isalpha() for c in new.tolist()], bool)
            self.symbol[new[~is_letter]] = 0
            at = len(self.letters)
            self.symbol[new[is_letter]] = np.arange(at, at + int(is_letter.sum()))
            self.letters = np.concatenate([self.letters, *[self.letter_vector(int(c))[None] for c in new[is_letter]]])
            s = self.symbol[codes]
        return s

    def vectors(self, texts: list[str | None]) -> np.ndarray:
        """(documents x dimensions) bundles; zero rows for texts without a letter."""
        out = np.zeros((len(texts), self.d), np.float32)
        lows = [(t or "").lower() for t in texts]
        i = 0
        while i < len(lows):
            size, j = len(lows[i]), i + 1
            while j < len(lows) and size + len(lows[j]) <= CHUNK_CHARS:
                size, j = size + len(lows[j]), j + 1
            if j == i + 1 and size > CHUNK_CHARS:
                out[i] = self.long_vector(lows[i])
            else:
                out[i:j] = self.bundle(*self.counts(lows[i:j]))
            i = j
        return out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(trigram keys, documents x keys counts)."""
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(len(texts)), lens + 2)
        # A boundary before and after each text; runs of boundaries count once.
        s = np.zeros(len(codes) + 2 * len(texts), np.int64)
        s[np.arange(len(codes)) + 1 + 2 * np.repeat(np.arange(len(texts)), lens)] = self.symbols(codes)
        once = np.ones(len(s), bool)
        once[1:] = (s[1:] > 0) | (s[:-1] > 0)
        s, doc = s[once], doc[once]
        n = len(self.letters)
        if len(s) < 3:
            return np.zeros(0, np.int64), np.zeros((len(texts), 0), np.float32)
        key = (s[:-2] * n + s[1:-1]) * n + s[2:]
        same = (doc[:-2] == doc[2:]) & (s[1:-1] > 0)
        key, of = key[same], doc[:-2][same]
        if n ** 3 <= 1 << 23:
            seen = np.zeros(n ** 3, np.int32)
            seen[key] = 1
            keys = np.flatnonzero(seen)
            seen[keys] = np.arange(len(keys), dtype=np.int32)
            column = seen[key]
        else:
            keys, column = np.unique(key, return_inverse=True)
        count = np.bincount(of * len(keys) + column, minlength=len(texts) * len(keys)) if len(keys) else np.zeros(0)
        return keys, count.reshape(len(texts), len(keys)).astype(np.float32)

    def bundle(self, keys: np.ndarray, count: np.ndarray) -> np.ndarray:
        n, weight = len(self.letters), np.sqrt(count)
        first, second = np.roll(self.letters, 2, axis=1), np.roll(self.letters, 1, axis=1)
        out = np.zeros((len(count), self.d), np.float32)
        for a in range(0, len(keys), 4096):
            k = keys[a:a + 4096]
            bound = first[k // (n * n)] * second[k // n % n] * self.letters[k % n]
            out += weight[:, a:a + 4096] @ bound.astype(np.float32)
        return out

    def long_vector(self, text: str) -> np.ndarray:
        """Bundle of one text longer than a chunk, counted in pieces that overlap by two letters."""
        total: dict[tuple, float] = {}
        for a in range(0, len(text), CHUNK_CHARS):
            keys, count = self.counts([text[a:a + CHUNK_CHARS]])
            n = len(self.letters)
            for k, c in zip(keys.tolist(), count[0].tolist()):
                t = (k // (n * n), k // n % n, k % n)
                total[t] = total.get(t, 0.0) + c
        n = len(self.letters)
        keys = np.array([(a * n + b) * n + c for a, b, c in total], np.int64)
        return self.bundle(keys, np.array([list(total.values())], np.float32).reshape(1, -1))[0]


def profiles(dimensions: int) -> Profiles:
    cache = worker_cache()
    if ("profiles", dimensions) not in cache:
        cache["profiles", dimensions] = Profiles(dimensions)
    return cache["profiles", dimensions]


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def fit(docs: DataFrame, dimensions: int = DIMENSIONS, train_per_lang: int = 5000) -> dict[str, list[float]]:
    """Prototypes of the languages in ``docs`` (doc_id, text, lang), from at most ``train_per_lang`` documents each."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, train_per_lang / n))])
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))

    def sums(batches):
        p, total = profiles(dimensions), {}
        for batch in batches:
            unit = _unit(p.vectors(batch.column("text").to_pylist()))
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs):
                total[lang] = total.get(lang, 0) + unit[langs == lang].sum(axis=0, dtype=np.float64)
        for lang, v in total.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(v)), "i": pa.array(range(len(v)), pa.int32()), "x": pa.array(v)})

    rows = chosen.select("text", "lang").mapInArrow(sums, "lang string, i int, x double").groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    out = {k: np.zeros(dimensions) for k in sorted({r.lang for r in rows})}
    for r in rows:
        out[r.lang][r.i] = r.x
    return {k: v.tolist() for k, v in out.items() if np.any(v)}


def predict(docs: DataFrame, prototypes: dict[str, list[float]], dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, lang_pred, score (the best cosine, 0 to 1) for every row of ``docs`` (doc_id, text)."""
    langs = sorted(prototypes)
    matrix = _unit(np.array([prototypes[k] for k in langs], np.float64).reshape(len(langs), dimensions)).T.astype(np.float32)

    def score(batches):
        p = profiles(dimensions)
        for batch in batches:
            v = p.vectors(batch.column("text").to_pylist())
            some = v.any(axis=1) & bool(langs)
            cos = _unit(v) @ matrix if langs else np.zeros((len(v), 1))
            best = cos.argmax(axis=1) if len(v) else np.zeros(0, int)
            top = np.clip(cos.max(axis=1), 0, 1) if len(v) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([langs[b] if s else "und" for b, s in zip(best, some)], pa.string()),
                 pa.array(np.where(some, top, 0.0).astype(np.float64))], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def held_out(mod: int, value: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == value


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = fit(docs.where(~held_out(4, 2)))
    return predict(docs, prototypes).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
