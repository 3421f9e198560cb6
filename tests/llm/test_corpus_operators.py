"""Operators 11 to 13 against SQL, brute force, odd rows and empty tables."""

import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from listenscape.llm import collocation, common, divergence, queries, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def options(spark):
    common.configure(spark)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, sf_dir, name, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 50)
    monkeypatch.setattr(divergence, "PAIR_CELLS", 10)
    got = queries.QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)


# ---- op11


def least_capacity(sizes, shards):
    def needed(c):
        n, room = 1, c
        for s in sizes:
            if s > room:
                n, room = n + 1, c
            room -= s
        return n

    return next(c for c in range(max(sizes), sum(sizes) + 1) if needed(c) <= shards)


def check_shards(rows, texts, shards=16):
    """rows: of ``assign``; texts: text by doc_id."""
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    of, load, slots = {}, Counter(), defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert of.setdefault(data, r.shard) == r.shard
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(load) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


def test_op11_shards_are_as_even_as_can_be(spark, sf_dir):
    texts = {r.doc_id: r.text for r in common.table(spark, sf_dir, "documents").collect()}
    load = check_shards(queries.QUERIES["op11_sharding"](spark, sf_dir).collect(), texts)
    groups = defaultdict(int)
    for i in sorted(texts):
        groups[texts[i]] += len((texts[i] or "").encode()) + 1
    assert max(load.values()) == least_capacity(list(groups.values()), 16)


def test_op11_few_cells_give_the_same_shards(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    plain = sorted(map(tuple, sharding.assign(docs).collect()))
    assert sorted(map(tuple, sharding.assign(docs, cells=8).collect())) == plain


@pytest.mark.parametrize("seed", range(3))
def test_op11_capacity_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, [12, 400, 30][seed], 300).tolist()
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()
    placed = spark.createDataFrame(list(zip(starts)), "start long").cache()
    axis = sharding.Skeleton(placed, sum(sizes), cells=16)
    capacity = sharding.smallest_capacity(axis, max(sizes), 7)
    assert capacity == least_capacity(sizes, 7)
    ends = [0, *sharding.cuts(axis, capacity, 7), sum(sizes)]
    assert set(ends) <= {*starts, sum(sizes)} and all(0 < b - a <= capacity for a, b in pairwise(ends))


def test_op11_a_hot_group_stands_alone(spark):
    rows = [(i, "copy of one long passage " * 4, "en", "s", 0) for i in range(100)] + [(100 + i, f"text {i}", "en", "s", 0) for i in range(300)]
    load = check_shards(sharding.assign(spark.createDataFrame(rows, SCHEMA)).collect(), {r[0]: r[1] for r in rows})
    assert load[15] == 100 * 101
    assert max(load[k] for k in range(15)) - min(load[k] for k in range(15)) < 20


def test_op11_odd_rows_and_empty_tables(spark, odd_docs, tmp_path):
    nulls = spark.createDataFrame([(None, "a", None, None, 0), (None, "b", None, None, 0), (9, "a", None, None, 0)], SCHEMA)
    rows = sharding.assign(odd_docs.select("doc_id", "text").unionAll(nulls.select("doc_id", "text"))).collect()
    assert len(rows) == odd_docs.count() + 3
    assert len({r.shard for r in rows if r.text_crc32 == zlib.crc32(b"a")}) == 1
    assert len({r.shard for r in rows if r.doc_id in (3, 4)}) == 1  # null and empty
    assert len({r.shard for r in rows if r.doc_id in (1, 2)}) == 1
    assert sharding.assign(spark.createDataFrame([], SCHEMA)).collect() == []
    sharding.write(odd_docs, str(tmp_path / "shards"), shards=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((r.doc_id, r.text) for r in odd_docs.collect())


# ---- op12


def test_op12_vocabulary_and_vectors_equal_brute_force(spark):
    rows = [(1, "a b b c", "en"), (2, "B a, d", "en"), (3, "a-b", "en"), (4, "a a é", "fr"), (5, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).coalesce(1)
    words = divergence.vocabulary(docs, min_df=2)
    assert sorted((r.lang, r["index"], r.term, r.n, r.df) for r in words.collect()) == [("en", 0, "b", 4, 3), ("en", 1, "a", 3, 3)]
    got = {r.doc_id: (r["indices"], r["counts"]) for r in divergence.document_vectors(docs, words).collect()}
    assert got == {1: ([0, 1], [2, 1]), 2: ([0, 1], [1, 1]), 3: ([0, 1], [1, 1])}


def test_op12_odd_rows_and_empty_tables(spark, odd_docs):
    got = divergence.audit(odd_docs, min_df=1).collect()
    groups = {(r.lang or "", r.source or "") for r in odd_docs.collect()}
    pairs = {((r.lang, r.source), r.item) for r in got if r.part == "pair"}
    assert pairs == {(a, b[1]) for a in groups for b in groups if a[0] == b[0] and a != b}
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


# ---- op13


def brute_collocations(rows, least, top=2000):
    f, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(c, "\n")
        for piece in low.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            totals[lang or "und"] += len(w)
            for n in range(1, 6):
                for i in range(len(w) - n + 1):
                    f[lang or "und"][tuple(w[i:i + n])] += 1
    out = []
    for lang, all_ in f.items():
        seen = {p: a for p, a in all_.items() if a >= least}
        parts = defaultdict(int)
        for p, a in seen.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    parts[p[i:i + k]] = max(parts[p[i:i + k]], a)
        best = []
        for p, a in seen.items():
            if len(p) > 1 and parts[p] < a:
                score, k = min((1000 * a * totals[lang] // (seen[p[:k]] * seen[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), seen[p[:k]], seen[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def test_op13_low_thresholds_and_small_buffers_equal_brute_force(spark, sf_dir, monkeypatch):
    docs = common.table(spark, sf_dir, "documents").select("text", "lang")
    want = brute_collocations([tuple(r) for r in docs.collect()], 5)
    for name, value in (("HELD", 64), ("MAX_BITS", 1 << 17), ("HASH_BYTES", 50)):
        monkeypatch.setattr(collocation, name, value)
    assert sorted(map(tuple, collocation.collocations(docs, least=5).collect())) == want


def test_op13_odd_rows_and_empty_tables(spark, odd_docs):
    long = "x" * 300
    rows = [("A b\tc, a B c; " * 3, None), ("a b c", "und"), (None, "en"), ("", "en"), (" \t", "en"), (f"é {long}a {long}b é {long}a", "fr"),
            (f"é {long}a\x0bé {long}a", "fr"), ("end", "fr"), ("é", "fr"), ("\u0000 b", "und")]
    rows += [(r.text, r.lang) for r in odd_docs.collect()]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("phrase", F.lit(1)).withColumn("weight", F.lit("x")).coalesce(1)
    assert sorted(map(tuple, collocation.collocations(docs, least=2).collect())) == brute_collocations(rows, 2)
    assert collocation.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_op13_summaries_keep_every_frequent_hash():
    rng = np.random.default_rng(1)
    gram = np.concatenate([rng.integers(0, 2**31, 60_000), np.repeat(np.arange(20), 100)])
    rng.shuffle(gram)
    s = collocation.Summary(len(gram) // 100 + 1)
    for part in np.array_split(gram, 50):
        s.add(part, np.ones(len(part), np.int64))
        s.trim()
    assert 0 < s.lost <= len(gram) / (s.capacity + 1)
    assert set(range(20)) <= set(s.survivors(100).tolist())


def test_op13_phrases_that_share_a_hash_stay_apart():
    heads, n = collocation.distinct(np.array([5, 5, 5, 7], np.uint64), np.array([1, 2, 1, 3], np.uint64))
    assert sorted(zip(heads.tolist(), n.tolist())) == [(0, 2), (1, 1), (3, 1)]
