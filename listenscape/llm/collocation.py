"""Operator 13: phrases that recur as units, mined with Misra-Gries summaries and counted exactly.

A phrase is frequent in a language from ``least`` occurrences on. Every contiguous part of a frequent phrase is
frequent, so three rounds cover lengths 1, 2 and 3 to 5, each on what the round before left:

1. Tasks count the hashes of the phrases that may still be frequent and pass (hash, count) on.
2. Hashes are dealt into partitions by value. Each partition keeps a mergeable Misra-Gries summary whose
   capacity exceeds the partition's mass divided by ``least``, so that every frequent phrase survives in it.
3. Survivors become a ``Filter``: a bitmap of at most 2^26 bits (8 MB), whatever their number. What passes it
   wrongly only costs work, and nothing frequent fails to pass.
4. The second pass over the texts counts exactly, by language and words, what passes the filter.

The texts are read three times: words, pairs of frequent words, and the exact pass for both, which also cuts the
texts down to the runs of frequent pairs. Longer phrases lie inside such runs, so that the last round reads those.

Cutting, scoring and the containment rule are joins on the table of frequent phrases; products are decimals.

Cases: a null text has no word, a null lang is ``und``. Repeated rows count each. An empty table, or one without
frequent phrases, gives no row. Ties: smallest cut, then phrase by its bytes. Extra columns are passed over.
Hashes that collide only add candidates in the summaries; exact counts compare two independent 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stage, ranked, stage, table

LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: 0: part of a word, 1: between words, 2: between pieces.
KIND = np.array([1 if b in b" \t" else 2 if b in b".,;:!?\n\x0b\x0c\r" else 0 for b in range(256)], np.uint8)
#: Bytes hashed at a time, and the longest word hashed by table.
HASH_BYTES, TABLE_BYTES = 1 << 21, 256
#: Distinct hashes that a task holds before it passes them on.
HELD = 1 << 21
#: The largest filter in bits.
MAX_BITS = 1 << 26


def _tables(lane: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(lane)
    of_byte = rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    of_byte[KIND > 0] = 0
    return of_byte, rng.integers(1, 1 << 63, TABLE_BYTES, np.uint64) * np.uint64(2) + np.uint64(1)


TABLES = [_tables(0), _tables(1)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of x changes every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salt(lang: str, lane: int) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8, salt=bytes([lane])).digest(), "little")


class Words:
    """The words of a batch of texts, in order, as places in one buffer."""

    def __init__(self, texts: pa.Array, langs: list[str]):
        texts = texts.fill_null("").cast(pa.large_string())
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
        off = off - off[0]
        self.data, kind = LOWER[data], KIND[data]
        inside = np.concatenate([[False], kind == 0, [False]])
        heads = np.unique(off[:-1][off[:-1] < len(data)])
        begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        begins[heads] = inside[1:-1][heads]
        stops[heads[1:] - 1] = inside[1:-1][heads[1:] - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.doc = np.searchsorted(off, self.starts, "right") - 1
        piece = np.cumsum(kind == 2)[self.starts]
        #: Whether word i + 1 goes on in the piece of word i.
        self.linked = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])
        self.langs = langs

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lane: int) -> np.ndarray:
        """A hash of (lang, word) for each word."""
        out = np.zeros(len(self), np.uint64)
        of_byte, of_place = TABLES[lane]
        i = 0
        while i < len(self):
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + HASH_BYTES, "right")))
            a, s = int(self.starts[i]), self.starts[i:j] - self.starts[i]
            if j == i + 1:  # one word, perhaps a very long one
                b = min(int(self.ends[i]), a + TABLE_BYTES)
            else:
                b = int(self.ends[j - 1])
            place = np.arange(b - a) - np.repeat(s, np.diff(np.append(s, b - a)))
            out[i:j] = np.add.reduceat(of_byte[self.data[a:b]] * of_place[np.minimum(place, TABLE_BYTES - 1)], s)
            i = j
        for i in np.flatnonzero(self.ends - self.starts > TABLE_BYTES):
            word = self.data[self.starts[i]:self.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=bytes([lane])).digest(), "little")
        salts = {x: salt(x, lane) for x in set(self.langs)}
        return mixed(out ^ np.array([salts[x] for x in self.langs], np.uint64)[self.doc]) if len(self) else out

    def text(self, i: int, j: int) -> bytes:
        """Words i to j - 1 of one piece, joined by spaces."""
        return b" ".join(filter(None, self.data[self.starts[i]:self.ends[j - 1]].tobytes().replace(b"\t", b" ").split(b" ")))


def longer(gram: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases, each with one more word behind it."""
    return mixed(gram * np.uint64(0x9E3779B97F4A7C15) + word)


class Filter:
    """A bitmap over the leading bits of hashes."""

    def __init__(self, bitmap: np.ndarray, bits: int):
        self.bitmap, self.bits = bitmap, bits

    def __call__(self, gram: np.ndarray) -> np.ndarray:
        place = gram >> np.uint64(64 - self.bits)
        return (self.bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


class Tally:
    """Weights summed by hash."""

    def __init__(self):
        self.parts: list[pa.Table] = []
        self.rows = 0

    def add(self, gram: np.ndarray, weight: np.ndarray | None = None) -> None:
        if len(gram):
            if weight is None:
                found = pc.value_counts(pa.array(gram.view(np.int64)))
                gram, weight = found.field(0), found.field(1)
            self.parts.append(pa.table({"gram": gram, "weight": weight}))
            self.rows += self.parts[-1].num_rows

    def settle(self) -> pa.Table:
        t = pa.concat_tables(self.parts).group_by("gram", use_threads=False).aggregate([("weight", "sum")])
        t = t.rename_columns(["gram", "weight"]).select(["gram", "weight"])
        self.parts, self.rows = [t], t.num_rows
        return t

    def passed_on(self, parts: int):
        """A row for each of ``parts`` hash partitions: its mass, the leading halves of its hashes and their weights."""
        if self.parts:
            t = self.settle()
            gram, weight = t.column("gram").to_numpy().view(np.uint64), t.column("weight").to_numpy()
            part = (gram % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            names, begins = np.unique(part[order], return_index=True)
            half, weight = (gram >> np.uint64(32)).astype("<u4")[order], weight[order].astype("<i8")
            ends = np.append(begins[1:], len(order)).tolist()
            for i in range(0, len(names), 256):
                cuts = list(zip(begins[i:i + 256].tolist(), ends[i:i + 256]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[i:i + 256]), pa.array([int(weight[a:b].sum()) for a, b in cuts], pa.int64()),
                     pa.array([half[a:b].tobytes() for a, b in cuts], pa.binary()), pa.array([weight[a:b].tobytes() for a, b in cuts], pa.binary())],
                    ["part", "mass", "grams", "weights"])
        self.parts, self.rows = [], 0


def batch_words(batch: pa.RecordBatch) -> Words:
    return Words(batch.column("text"), batch.column("lang").to_pylist())


def grams(words: Words, lengths, filters, lanes=(0,)):
    """(length, places of the first words, their hashes in each lane) of the phrases that may be frequent. Phrases of a
    length that has a Filter must pass it, and longer ones must consist of such."""
    word = [words.hashes(lane) for lane in lanes]
    gram, fits = word, np.ones(len(words), bool)
    for n in range(1, max(lengths) + 1):
        if n > 1:
            m = max(0, len(words) - n + 1)
            gram = [longer(g[:m], w[n - 1:]) for g, w in zip(gram, word)]
            fits = fits[:m] & fits[1:m + 1] & words.linked[n - 2:][:m]
        if n in filters:
            fits = fits & filters[n](gram[0])
        if n in lengths:
            at = np.flatnonzero(fits)
            yield n, at, *(g[at] for g in gram)


TALLY = "part int, mass long, grams binary, weights binary"


def tally_task(lengths, filters, parts: int):
    def run(batches):
        tally = Tally()
        known = {n: f.value for n, f in filters.items()}
        for batch in batches:
            for _, _, gram in grams(batch_words(batch), lengths, known):
                tally.add(gram)
            if tally.rows > 2 * HELD:
                tally.settle()
                if tally.rows > HELD:
                    yield from tally.passed_on(parts)
        yield from tally.passed_on(parts)

    return run


class Summary:
    """A mergeable Misra-Gries summary: at most ``capacity`` hashes, none of whose counts is too low by more than
    ``lost``, which stays at most mass / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity, self.lost, self.tally = capacity, 0, Tally()

    def add(self, gram: np.ndarray, weight: np.ndarray) -> None:
        self.tally.add(gram, weight)
        if self.tally.rows > 2 * self.capacity + HELD // 16:
            self.trim()

    def trim(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.tally.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        t = self.tally.settle()
        gram, weight = (t.column(k).to_numpy() for k in range(2))
        if len(gram) > self.capacity:
            cut = np.partition(weight, len(weight) - self.capacity - 1)[len(weight) - self.capacity - 1]
            gram, weight = gram[weight > cut], weight[weight > cut] - cut
            self.lost += int(cut)
            self.tally.parts, self.tally.rows = [pa.table({"gram": gram, "weight": weight})], len(gram)
        return gram, weight

    def survivors(self, least: int) -> np.ndarray:
        gram, weight = self.trim()
        return gram[weight + self.lost >= least]


def summary_task(capacity: int, least: int):
    def run(batches):
        found: dict[int, Summary] = {}
        for batch in batches:
            for part, gram, weight in zip(*(batch.column(c).to_pylist() for c in ("part", "grams", "weights"))):
                found.setdefault(part, Summary(capacity)).add(np.frombuffer(gram, "<u4").astype(np.int64), np.frombuffer(weight, "<i8"))
        for s in found.values():
            yield pa.RecordBatch.from_arrays([pa.array(s.survivors(least))], ["half"])

    return run


def partitions(spark: SparkSession) -> int:
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def survivors(counts: DataFrame, least: int) -> DataFrame:
    """(half): the leading halves of the hashes in ``counts`` (TALLY; staged) that may weigh ``least`` in sum, at
    least of all that do. Within a partition a hash is known by its half; those that share it only add candidates."""
    most = counts.groupBy("part").agg(F.sum("mass").alias("mass")).agg(F.max("mass")).first()[0] or 0
    rows = counts.select("part", "grams", "weights").repartition("part")
    return stage(rows.mapInArrow(summary_task(most // least + 1, least), "half long"), "phrase-survivors")


def broadcast_filter(found: DataFrame):
    """A broadcast Filter of the hashes whose halves are ``found`` (staged): 64 bits for each, and MAX_BITS in all at most."""
    bits = min(MAX_BITS.bit_length() - 1, max(16, (64 * found.count()).bit_length()))
    cells = (found.withColumn("place", F.shiftright("half", 32 - bits))
             .select(F.shiftright("place", 5).alias("cell"), F.expr("shiftleft(1L, cast(place & 31 as int))").alias("bit")))
    rows = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most MAX_BITS / 32 rows
    bitmap = np.zeros((1 << bits) // 32, "<u4")
    bitmap[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy()
    return found.sparkSession.sparkContext.broadcast(Filter(bitmap.view(np.uint8), bits))


def distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first occurrence, occurrences) of each pair of hashes."""
    code, names = pd.factorize(first)
    heads = np.zeros(len(names), np.int64)
    heads[code[::-1]] = np.arange(len(code))[::-1]
    if (second[heads][code] != second).any():  # two phrases share the first hash
        _, heads, code = np.unique(np.stack([first, second]), axis=1, return_index=True, return_inverse=True)
    return heads, np.bincount(code.ravel(), minlength=len(heads))


class Counted:
    """Exact counts of a task, by both hashes; a phrase's words are read once."""

    def __init__(self):
        self.place: dict = {}
        self.second: list[int] = []
        self.names: list[tuple[str, int, bytes]] = []
        self.sums = np.zeros(1 << 12, np.int64)

    def add(self, first: np.ndarray, second: np.ndarray, sums: np.ndarray, name) -> None:
        for i, (x, y) in enumerate(zip(first.tolist(), second.tolist())):
            k = self.place.get(x)
            if k is not None and self.second[k] != y:  # two phrases share the first hash
                x = (x, y)
                k = self.place.get(x)
            if k is None:
                k = self.place[x] = len(self.names)
                self.second.append(y)
                self.names.append(name(i))
                if k == len(self.sums):
                    self.sums = np.append(self.sums, np.zeros(k, np.int64))
            self.sums[k] += sums[i]

    def passed_on(self, parts: int):
        """A row for each of ``parts`` hash partitions, with its phrases."""
        first = np.array([x[0] if isinstance(x, tuple) else x for x in self.place], np.uint64)
        part = (first % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        found, begins = np.unique(part[order], return_index=True)
        rows = [[(*self.names[i], int(self.sums[i])) for i in at.tolist()] for at in np.split(order, begins[1:])]
        for i in range(0, len(found), 64):
            yield exact_rows(found[i:i + 64].tolist(), phrases=rows[i:i + 64])
        self.__init__()


PHRASE = pa.struct([("lang", pa.string()), ("n", pa.int32()), ("phrase", pa.binary()), ("count", pa.int64())])
EXACT = "part int, lang string, text string, phrases array<struct<lang:string,n:int,phrase:binary,count:long>>"


def exact_rows(parts: list[int], langs=None, texts=None, phrases=None) -> pa.RecordBatch:
    none = [None] * len(parts)
    cells = [[dict(zip(("lang", "n", "phrase", "count"), x)) for x in row] for row in phrases] if phrases else none
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array(langs or none, pa.string()), pa.array(texts or none, pa.binary()).cast(pa.string()),
         pa.array(cells, pa.list_(PHRASE))], ["part", "lang", "text", "phrases"])


def runs_of(words: Words, pairs: np.ndarray):
    """(document, what is left of its text) of the documents that hold chains of three words or more whose pairs all
    begin at ``pairs``: the chains, a line each."""
    on = np.zeros(len(words) + 2, bool)
    on[1 + pairs] = True
    long = on[1:-1] & (on[:-2] | on[2:])  # pairs that stand beside another one
    inside = np.flatnonzero(long | np.append(False, long[:-1]))
    if not len(inside):
        return
    size = words.ends[inside] - words.starts[inside] + 1
    to = np.cumsum(size)
    out = words.data[np.minimum(np.repeat(words.starts[inside] - (to - size), size) + np.arange(to[-1]), len(words.data) - 1)]
    out[to - 1] = np.where(long[inside], 32, 10)
    docs, begins = np.unique(words.doc[inside], return_index=True)
    at = (to - size)[begins].tolist()
    for d, a, b in zip(docs.tolist(), at, [*at[1:], int(to[-1])]):
        yield d, out[a:b].tobytes()


def exact_task(lengths, filters, runs: bool, parts: int):
    """Per hash partition, (lang, n, phrase, count) of the phrases that pass. With ``runs``, n = 0 counts a language's
    words, and rows of partition -1 hold what ``runs_of`` leaves of a text."""

    def run(batches):
        known = {n: f.value for n, f in filters.items()}
        counted, totals = Counted(), Counter()
        for batch in batches:
            words = batch_words(batch)
            for n, at, first, second in grams(words, lengths, known, (0, 1)):
                heads, sums = distinct(first, second)
                counted.add(first[heads], second[heads], sums,
                            lambda i, n=n, at=at[heads]: (words.langs[words.doc[at[i]]], n, words.text(at[i], at[i] + n)))
                if runs and n == 2:
                    left = list(runs_of(words, at))
                    yield exact_rows([-1] * len(left), [words.langs[d] for d, _ in left], [t for _, t in left])
            if runs:
                for lang, c in zip(words.langs, np.bincount(words.doc, minlength=batch.num_rows).tolist()):
                    totals[lang] += c
            if len(counted.names) > HELD // 8:
                yield from counted.passed_on(parts)
        yield from counted.passed_on(parts)
        if totals:
            yield exact_rows([0], phrases=[[(lang, 0, b"", c) for lang, c in totals.items()]])

    return run


def sum_task(least: int):
    """(lang, n, phrase, count) of the phrases of a task's partitions that occur ``least`` times, and of all n = 0."""

    def run(batches):
        sums: Counter = Counter()
        for batch in batches:
            lists = batch.column("phrases")
            off, cells = np.asarray(lists.offsets), lists.values
            lang, n, phrase, count = (cells.field(k).slice(off[0], off[-1] - off[0]).to_pylist() for k in range(4))
            for key, c in zip(zip(lang, n, phrase), count):
                sums[key] += c
        rows = [(k, c) for k, c in sums.items() if c >= least or k[1] == 0]
        for i in range(0, len(rows), 20_000):
            part = rows[i:i + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in part]), pa.array([k[1] for k, _ in part], pa.int32()),
                 pa.array([k[2] for k, _ in part], pa.binary()).cast(pa.string()), pa.array([c for _, c in part], pa.int64())],
                ["lang", "n", "phrase", "count"])

    return run


def frequent(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """(lang, n_words, phrase, a) of every phrase of up to ``longest`` words with a >= ``least`` occurrences, and
    (lang, n) with the words of each language. Both staged."""
    spark = docs.sparkSession
    parts = partitions(spark)

    def passing(texts, lengths, filters):
        counts = stage(texts.mapInArrow(tally_task(lengths, filters, parts), TALLY), "phrase-hashes")
        found = survivors(counts, least)
        drop_stage(counts)
        out = broadcast_filter(found)
        drop_stage(found)
        return out

    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    filters = {}
    for n in (1, 2):
        filters = filters | {n: passing(texts, [n], filters)}
    both = stage(texts.mapInArrow(exact_task([1, 2], filters, True, parts), EXACT), "short-phrases")
    runs = both.where("part = -1").select("text", "lang")
    lengths = range(3, longest + 1)
    of_runs = passing(runs, lengths, {})
    long = runs.mapInArrow(exact_task(lengths, {n: of_runs for n in lengths}, False, parts), EXACT)
    found = stage(both.where("part >= 0").unionAll(long).select("part", "phrases").repartition("part")
                  .mapInArrow(sum_task(least), "lang string, n int, phrase string, count long"), "phrases")
    drop_stage(both)
    return (found.where("n > 0").select("lang", F.col("n").alias("n_words"), "phrase", F.col("count").alias("a")),
            found.where("n = 0").select("lang", F.col("count").alias("n")))


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase of two words or more, by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cut = (phrases.where("n_words > 1").withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
           .select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                   F.array_join(F.slice("w", F.col("k") + 1, F.col("n_words") - F.col("k")), " ").alias("rest")))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    score = F.expr("cast(1000 * cast(a as decimal(16,0)) as decimal(19,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    # A language may hold most phrases, so its total meets them in 64 parts.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    totals = totals.withColumn("part", F.explode(F.expr("sequence(0L, 63L)")))
    each = (cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("part", part).join(totals, ["lang", "part"])
            .withColumn("score", score))
    return (each.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
            .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"))


def uncontained(candidates: DataFrame) -> DataFrame:
    """Candidates without those that a longer candidate contains and occurs as often as."""
    sized = candidates.select("lang", "phrase", "a", F.split("phrase", " ").alias("w")).withColumn("m", F.size("w"))
    parts = (sized.where("m > 2").withColumn("k", F.explode(F.expr("sequence(2, m - 1)")))
             .withColumn("i", F.explode(F.expr("sequence(1, m - k + 1)")))
             .groupBy("lang", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("phrase")).agg(F.max("a").alias("most")))
    return candidates.join(parts, ["lang", "phrase"], "left").where("most IS NULL OR most < a").drop("most")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language."""
    phrases, totals = frequent(docs, least, longest)
    best = uncontained(scored(phrases, totals))
    rows = ranked(best, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], "phrase-ranks")
    return rows.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS id, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (VALUES (1), (2), (3), (4), (5)) AS v(m))),
f AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cut AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
parts AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, x.a AS l, y.a AS r, s.n,
    1000::hugeint * c.a * s.n // (x.a::hugeint * y.a) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ') JOIN sizes s ON s.lang = c.lang),
best AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM best g WHERE g.lang = b.lang AND g.m > b.m AND g.a >= b.a AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, CAST(n AS bigint) AS n, CAST(score AS bigint) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM kept)
WHERE rank <= 2000
"""
