"""Operator 12: how far each source of a language lies from the others, by exact term counts.

1. ``count_groups`` makes every document's exact sparse count vector and, as sums of vectors are linear, adds it at
   once to its (lang, source) group's, in each task and then over all of them. Beside the counts go document counts.
2. ``vocabulary`` keeps a language's terms that at least ``min_df`` of its documents hold, which are all of them up
   to ``vocab_size`` = 2^31 - 1: the terms that a CountVectorizer fitted per language with these parameters has.
   ML's own fit sends the vocabulary to the driver and broadcasts it, which no bound holds for; here it
   stays a table, and the group vectors keep the rows of their terms. ``document_vectors`` gives each
   document's vector by the vocabulary's indices.
3. Pairs of sources are evaluated sparsely. With p0, q0 the smoothed shares of an absent term, a pair's sum
   of f(p, q) over all V terms is V f(p0, q0), plus f(p, q0) - f(p0, q0) for each term of the first group, plus
   f(p0, q) - f(p0, q0) for each of the second, plus f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) for each in both.
   The middle parts need a group's histogram of shares only; the last one numpy makes term by term, and
   sums it per task before it is shuffled. All of it is integer arithmetic.

Cases: null text, lang and source are ''. Repeated rows count each. A group without terms has p = p0 throughout;
a language without kept terms has pairs of value 0 and no term rows. An empty table gives no row. Extra columns
are passed over. Counts must stay below 9 * 10^15 in a language.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_rows, ranked, stage, table

UNIT = 1_000_000_000
#: Entries that a task's group vectors may hold before they are passed on.
HELD_TERMS = 400_000
#: Term pairs that numpy evaluates at a time.
PAIR_CELLS = 1 << 20

#: A-Z to lower case; all other ASCII that is not a letter separates terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split(b" ")


def count_task(batches):
    """lang, source, term, n and df of a task's documents."""
    sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def passed_on():
        for (lang, source), (n, df) in sums.items():
            del n[b""], df[b""]
            terms = list(n)
            for i in range(0, len(terms), 50_000):
                part = terms[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array([n[t] for t in part], pa.int64()), pa.array([df[t] for t in part], pa.int64())],
                    ["lang", "source", "term", "n", "df"])
        sums.clear()

    for batch in batches:
        held = 0
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
            n, df = sums.setdefault((lang, source), (Counter(), Counter()))
            words = terms_of(text)
            n.update(words)
            df.update(set(words))
        held = sum(len(df) for _, df in sums.values())
        if held > HELD_TERMS:
            yield from passed_on()
    yield from passed_on()


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")])


def count_groups(docs: DataFrame) -> DataFrame:
    """(lang, term, source, n, df): the groups' sparse vectors. One shuffle, by term."""
    rows = plain(docs).mapInArrow(count_task, "lang string, source string, term string, n long, df long")
    return rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def kept_groups(docs: DataFrame, min_df: int = 3) -> DataFrame:
    """The group vectors on the vocabulary only, with the language's count ``n_lang`` and ``df_lang``."""
    of_term = Window.partitionBy("lang", "term")
    return (count_groups(docs).withColumn("n_lang", F.sum("n").over(of_term)).withColumn("df_lang", F.sum("df").over(of_term))
            .where(F.col("df_lang") >= min_df).drop("df"))


def vocabulary(docs: DataFrame, min_df: int = 3, vocab_size: int = (1 << 31) - 1) -> DataFrame:
    """(lang, term, n, df, index) of the ``vocab_size`` most frequent kept terms of each language; index from 0 by
    falling count, then term."""
    terms = kept_groups(docs, min_df).select("lang", "term", F.col("n_lang").alias("n"), F.col("df_lang").alias("df")).distinct()
    return (ranked(terms, ["lang"], [F.col("n").desc(), F.col("term")], "vocabulary").where(F.col("rank") <= vocab_size)
            .withColumn("index", (F.col("rank") - 1).cast("int")).drop("rank"))


def document_terms(batches):
    for batch in batches:
        vectors = [Counter(filter(None, terms_of(t))) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("lang"),
             pa.array([[t.decode() for t in v] for v in vectors], pa.list_(pa.string())),
             pa.array([list(v.values()) for v in vectors], pa.list_(pa.int64()))], ["doc_id", "lang", "terms", "counts"])


def document_vectors(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, lang, indices, counts): exact sparse vectors by ``words`` (see ``vocabulary``), indices ascending.
    Documents without a kept term have no row; documents are told apart by doc_id."""
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
            .mapInArrow(document_terms, "doc_id long, lang string, terms array<string>, counts array<long>"))
    flat = rows.select("doc_id", "lang", F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("doc_id", "lang", "x.*")
    found = flat.join(words.select("lang", F.col("term").alias("terms"), "index"), ["lang", "terms"])
    return (found.groupBy("doc_id", "lang").agg(F.array_sort(F.collect_list(F.struct("index", "counts"))).alias("v"))
            .select("doc_id", "lang", F.col("v.index").alias("indices"), F.col("v.counts").alias("counts")))


def _share(count: Column, mass: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / mass), exact; null where there is no mass."""
    whole = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", whole, F.nullif(mass, F.lit(0)).cast("decimal(20,0)")) + 1


def _f(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def pair_task(batches):
    """lang, a, b and the summed part of the terms that groups a and b both hold."""
    sums: dict[str, dict[tuple[int, int], int]] = {}

    def f(p, q):
        return (p - q) ** 2 // q

    for batch in batches:
        lists, langs = batch.column("groups"), np.array(batch.column("lang").to_pylist(), object)
        off, flat = np.asarray(lists.offsets), lists.values
        group, p, p0 = (np.asarray(flat.field(k)).astype(np.int64) for k in range(3))
        sizes = np.diff(off)
        for lang in set(langs):
            total = sums.setdefault(lang, {})
            for k in np.unique(sizes[(langs == lang) & (sizes > 1)]):
                begins = off[:-1][(langs == lang) & (sizes == k)]
                step = max(1, PAIR_CELLS // int(k * k))
                for i in range(0, len(begins), step):
                    at = begins[i:i + step, None] + np.arange(k)
                    names, local = np.unique(group[at], return_inverse=True)
                    local = local.reshape(at.shape)
                    P, P0, Q, Q0 = p[at][:, :, None], p0[at][:, :, None], p[at][:, None, :], p0[at][:, None, :]
                    value = f(P, Q) - f(P, Q0) - f(P0, Q) + f(P0, Q0)
                    code, place = np.unique((local[:, :, None] * len(names) + local[:, None, :]).ravel(), return_inverse=True)
                    s = np.zeros(len(code), np.int64)
                    np.add.at(s, place.ravel(), value.ravel())
                    for c, v in zip(code.tolist(), s.tolist()):
                        pair = (int(names[c // len(names)]), int(names[c % len(names)]))
                        if pair[0] != pair[1]:
                            total[pair] = total.get(pair, 0) + v
    for lang, total in sums.items():
        pairs = list(total)
        for i in range(0, len(pairs), 50_000):
            part = pairs[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), *(pa.array([x[k] for x in part], pa.int32()) for k in (0, 1)), pa.array([total[x] for x in part], pa.int64())],
                ["lang", "a", "b", "value"])


def audit(docs: DataFrame, min_df: int = 3, top_terms: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources of a language, and each group's ``top_terms``
    terms that are more frequent than in its language."""
    spark = docs.sparkSession
    kept = stage(kept_groups(docs, min_df), "term-groups")
    # A row per group, with its number within the language and its masses.
    counts = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("n_all"), F.count_distinct("term").alias("v"))
    groups = (plain(docs).select("lang", "source").distinct().join(counts, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("group"),
                      F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("n", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("mass"),
                      (F.coalesce("n_all", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("mass_all"))
              .withColumn("p0", _share(F.lit(0), F.col("mass"))))
    groups = stage(groups, "source-groups")
    shares = stage(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "group", "p0", _share(F.col("n"), F.col("mass")).alias("p"),
        _share(F.col("n_lang"), F.col("mass_all")).alias("q")), "term-shares")

    a = groups.select("lang", F.col("group").alias("a"), "v", F.col("p0").alias("p0_a"))
    b = groups.select("lang", F.col("group").alias("b"), F.col("p0").alias("p0_b"))
    pairs = a.join(b, "lang").where("a <> b")
    base = pairs.select("lang", "a", "b", F.coalesce(F.col("v") * _f("p0_a", "p0_b"), F.lit(0)).alias("value"))
    bars = stage(shares.groupBy("lang", "group", "p0", "p").count(), "share-bars")
    of_a = (bars.select("lang", F.col("group").alias("a"), F.col("p0").alias("p0_a"), "p", "count").join(b, "lang").where("a <> b")
            .select("lang", "a", "b", (F.col("count") * (_f("p", "p0_b") - _f("p0_a", "p0_b"))).alias("value")))
    of_b = (bars.select("lang", F.col("group").alias("b"), F.col("p0").alias("p0_b"), "p", "count").join(a, "lang").where("a <> b")
            .select("lang", "a", "b", (F.col("count") * (_f("p0_a", "p") - _f("p0_a", "p0_b"))).alias("value")))
    with arrow_rows(spark, 8192):
        both = stage(shares.groupBy("lang", "term").agg(F.collect_list(F.struct("group", "p", "p0")).alias("groups"))
                     .where(F.size("groups") > 1).select("lang", "groups")
                     .mapInArrow(pair_task, "lang string, a int, b int, value long"), "shared-terms")
    names = groups.select("lang", "group", "source")
    total = base.unionAll(of_a).unionAll(of_b).unionAll(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    of_pair = (total.join(names.select("lang", F.col("group").alias("a"), "source"), ["lang", "a"])
               .join(names.select("lang", F.col("group").alias("b"), F.col("source").alias("item")), ["lang", "b"])
               .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    of_term = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").alias("value"))
    rows = ranked(of_pair.unionAll(of_term), ["lang", "source", "part"], [F.col("value").desc(), F.col("item")], "divergence")
    return rows.where((F.col("part") == "pair") | (F.col("rank") <= top_terms)).withColumn("rank", F.col("rank").cast("int"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of sources of a language, and the 200 most typical terms of each, over all ``documents``."""
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source")).select("lang", "source", "part", "item", "value", "rank")


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
sums AS (SELECT lang, CAST(sum(n) AS hugeint) AS n, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
sources AS (SELECT DISTINCT lang, source FROM docs),
masses AS (SELECT s.lang, s.source, CAST(coalesce(sum(c.n), 0) AS hugeint) AS n FROM sources s LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
p AS (SELECT m.lang, m.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::hugeint * (coalesce(c.n, 0) + 1) // (m.n + s.v) AS p
  FROM masses m JOIN sums s USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = m.lang AND c.source = m.source AND c.term = k.term),
q AS (SELECT k.lang, k.term, 1 + 1000000000::hugeint * (k.n + 1) // (s.n + s.v) AS q FROM kept k JOIN sums s USING (lang)),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) v
  ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS bigint) AS value, CAST(rank AS integer) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C") AS rank FROM rows)
WHERE part = 'pair' OR rank <= 200
"""
