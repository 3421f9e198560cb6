"""Operator 5: near-duplicate line removal as an exact set-similarity join, in DataFrame operations only.

A line's tokens are its shingles of ``width`` words (words are separated by blanks; a line of fewer words
is one token). Two lines match if the Jaccard similarity of their token sets is at least ``percent`` / 100.
A line is removed if a matching line stands earlier (smaller doc_id, or same document and above); this is
judged on the input. Lines without a word always stay.

1. Equal lines collapse to one class, known by its first place (``ord``).
2. Tokens are ordered by rarity, estimated for all tokens by counts in 2^14 hash bins (any total order is
   exact; bins only make it cheaper), and each class posts its prefix.
3. For each token, every poster is verified against the token's earliest poster (a star: a row per posting).
   Classes still unmatched are then paired with all earlier posters of their tokens, under the length
   and positional filters and a bound on the tokens they share, from 128 parity bits a class. Matched ones need no further partner, so a large group never makes all its pairs.
4. Pairs are verified on the full token sets.

Cases: null texts stay null, empty texts and blank lines stay. Rows that share a doc_id count as one
document: repeated rows collapse, and lines at the same place are decided together. An empty table gives
an empty result. Extra columns are passed over; the result has the columns asked for. Nothing is broadcast
by hint; the driver sees the bin counts (2^14 numbers) and the ends of doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, drop_stage, in_order, stage, table

BINS = 1 << 14
PLACE_BITS = 28


def _place(docs: DataFrame) -> tuple[Column, Column, Column]:
    """(ord from doc_id and pos, doc_id of an ord, pos of an ord): one number that orders lines by place.
    A long where the ids leave room for 2^28 lines a document, else a decimal."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None or (low >= 0 and high < 1 << (63 - PLACE_BITS)):
        return (F.shiftleft(F.col("doc_id"), PLACE_BITS) + F.col("pos"), F.shiftright("ord", PLACE_BITS),
                F.col("ord").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))
    unit = F.lit(1 << 31).cast("decimal(11,0)")
    whole = F.floor(F.col("ord") / unit)
    return ((F.col("doc_id").cast("decimal(20,0)") * unit + F.col("pos")).cast("decimal(38,0)"), whole.cast("long"),
            (F.col("ord") - whole * unit).cast("int"))


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once: the optimiser copies a projected column into every place
    that names it, but not the variable of a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _words(line: str = "line") -> Column:
    return F.array_remove(F.split(line, " "), "")


def _places(words: Column, width: int) -> Column:
    """The places where a line's shingles begin; a line of fewer words has one, at 0."""
    return F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0)))


def _shingle(words: Column, i: Column, width: int) -> Column:
    """Hash of the shingle at place i. Places past the end are null, which the hash passes over."""
    return F.xxhash64(*[F.get(words, i + k) for k in range(width)])


def _tokens(width: int, line: str = "line") -> Column:
    """Hashes of the shingles of a line."""
    return _let(_words(line), lambda w: F.transform(_places(w, width), lambda i: _shingle(w, i, width)))


def classes_of(docs: DataFrame, place: Column) -> DataFrame:
    """(line, ord): each distinct line that has a word, and its first place."""
    lines = docs.where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.where(F.trim("line") != "").groupBy("line").agg(F.min(place).alias("ord"))


def _parities(tokens: str) -> list[Column]:
    """``even`` and ``odd``: the parities of a set's tokens in 128 bins. A token that one of two sets lacks turns one
    bit, so that the bits in which two sets differ are at most the tokens in which they do."""
    turn = "aggregate(%s, 0L, (x, t) -> x ^ IF((t & 64) = %d, shiftleft(1L, int(t & 63)), 0L))"
    return [F.expr(turn % (tokens, bit)).alias(name) for name, bit in (("even", 0), ("odd", 64))]


def _bin(token: Column) -> Column:
    return token.bitwiseAND(F.lit(BINS - 1)).cast("int")


def _ranks(classes: DataFrame, width: int) -> Column:
    """Rarity class of a token (0: rare) by the count of its bin, 55 bits up, as a constant array. Shingles are
    rows here, so that all of it is compiled."""
    places = classes.select(_words().alias("w")).select("w", F.explode(_places(F.col("w"), width)).alias("i"))
    bins = places.select(_bin(_shingle(F.col("w"), F.col("i"), width)).alias("bin"))
    rows = bins.groupBy("bin").agg(F.count("*").alias("n")).collect()
    mean = max(1.0, sum(r.n for r in rows) / BINS)
    ranks = ["0"] * BINS
    for r in rows:  # at most BINS rows
        if r.n > 1.5 * mean:
            ranks[r.bin] = str(min(127, (int(4 * r.n / mean)).bit_length() * 4) << 55)
    return F.split(F.lit(",".join(ranks)), ",").cast("array<long>")


def matches(classes: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(b): the ``ord`` of every class that has an earlier matching class. ``classes`` should be staged."""
    rank = _ranks(classes, width)
    # Rarity class above 55 bits of hash: sorting the numbers sorts by rarity.
    key = F.transform(_tokens(width), lambda t: F.coalesce(F.get(rank, _bin(t)), F.lit(0)).bitwiseOR(F.shiftrightunsigned(t, 9)))
    sets = classes.select("ord", F.sort_array(F.array_distinct(key)).alias("s"))
    n = F.size("s")
    prefix = F.slice("s", F.lit(1), n - F.ceil(n * percent / F.lit(100)).cast("int") + 1)
    # One shuffle serves the count and the join: both sides read all its columns, so that the exchange is reused.
    posts = sets.select("ord", n.alias("n"), F.posexplode_outer(prefix).alias("i", "token")).repartition("token")
    first = (posts.groupBy("token").agg(F.min("ord").alias("a"), F.count("*").alias("posters"), F.max("n").alias("_n"), F.max("i").alias("_i"))
             .where("posters > 1 AND _n IS NOT NULL AND _i IS NOT NULL").select("token", "a", "posters"))
    shared = stage(posts.join(first.hint("shuffle_hash"), "token").select("token", "ord", "n", "i", "a", "posters"), "line-posts")

    wanted = shared.select("ord").distinct()
    known = classes.join(wanted, "ord", "left_semi").select("ord", F.array_distinct(_tokens(width)).alias("set"))
    known = stage(known.select("ord", "set", *_parities("set")), "line-sets")
    star = shared.where("ord <> a").select("a", F.col("ord").alias("b")).distinct()
    found = stage(_verified(star, known, percent), "line-matches")

    rest = shared.where("posters > 2").join(known.select("ord", "even", "odd"), "ord")
    late = rest.where("ord <> a").join(found, F.col("ord") == F.col("b"), "left_anti")
    x, y = rest.alias("x"), late.alias("y")
    least = F.ceil((F.col("x.n") + F.col("y.n")) * percent / F.lit(100 + percent))
    differ = F.bit_count(F.col("x.even").bitwiseXOR(F.col("y.even"))) + F.bit_count(F.col("x.odd").bitwiseXOR(F.col("y.odd")))
    pairs = (x.join(y, F.col("x.token") == F.col("y.token"))
             .where("x.ord < y.ord AND x.ord <> y.a")
             .where((100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
                    & (F.least(F.col("x.n") - F.col("x.i"), F.col("y.n") - F.col("y.i")) + F.least("x.i", "y.i") >= least)
                    & (differ <= F.col("x.n") + F.col("y.n") - 2 * least))
             .select(F.col("x.ord").alias("a"), F.col("y.ord").alias("b")).distinct())
    late = stage(_verified(pairs, known, percent), "line-late")
    drop_stage(shared)
    drop_stage(known)
    return found.unionAll(late).distinct()


def _verified(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    a = known.select(F.col("ord").alias("a"), F.col("set").alias("set_a"))
    b = known.select(F.col("ord").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    return pairs.join(a, "a").join(b, "b").where(100 * both >= percent * either).select("b").distinct()


def dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text (what is left), n_lines and n_kept (lines with words) of every document that has a text."""
    place, doc_of, pos_of = _place(docs)
    classes = stage(classes_of(docs, place), "line-classes")
    removed = matches(classes, width, percent).select(F.col("b").alias("ord"))
    gone = removed.select(doc_of.alias("doc_id"), pos_of.alias("pos")).groupBy("doc_id").agg(F.collect_set("pos").alias("gone"))
    all_lines = docs.where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    counts = docs.where("text IS NOT NULL").select(
        "doc_id", F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).alias("n_lines"))
    blank = all_lines.where(F.trim("line") == "").select("doc_id", "pos", "line").distinct()
    firsts = classes.select(doc_of.alias("doc_id"), pos_of.alias("pos"), "line")
    left = (firsts.unionAll(blank).groupBy("doc_id").agg(F.collect_list(F.struct("pos", "line")).alias("lines"))
            .join(gone, "doc_id", "left")
            .select("doc_id", F.array_sort(F.filter("lines", lambda x: ~F.coalesce(F.array_contains("gone", x["pos"]), F.lit(False)) | (F.trim(x["line"]) == ""))).alias("lines")))
    out = left.select("doc_id", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"),
                      F.size(F.filter("lines", lambda x: F.trim(x["line"]) != "")).alias("n_kept"))
    return (counts.groupBy("doc_id").agg(F.max("n_lines").alias("n_lines")).join(out, "doc_id", "left")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_lines", F.coalesce("n_kept", F.lit(0)).alias("n_kept")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines and n_removed (lines with words), kept_sha256 of the remaining text; one row per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = dedup(docs)
    return (docs.select("doc_id").distinct().join(done, "doc_id", "left")
            .select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                    F.coalesce(F.col("n_lines") - F.col("n_kept"), F.lit(0)).alias("n_removed"),
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, the place of each row by doc_id and text. The driver sees a count for each range."""
    rows = in_order(docs, [F.col("doc_id"), F.md5("text")], "line-rows").withColumn("_range", F.shiftright("_id", 33))
    ranges = rows.groupBy("_range").count().orderBy("_range").collect()
    base, at = [], 0
    for r in ranges:
        base += [F.lit(r["_range"]), F.lit(at)]
        at += r["count"]
    before = F.create_map(*base)[F.col("_range")] if base else F.lit(0)
    return rows.withColumn("_row", (before + F.col("_id") - F.shiftleft("_range", 33)).cast("long")).drop("_id", "_range")


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the remaining lines; those that had words and keep none of their lines go. Each row is a
    document of its own: rows that share a doc_id, or have none, are ordered by their texts."""
    docs = _numbered(docs.select(*DOCUMENT_COLUMNS))
    done = dedup(docs.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), F.col("text").alias("left_text"), "n_lines", "n_kept")
    return (docs.join(done, "_row", "left")
            .where("n_lines IS NULL OR n_lines = 0 OR n_kept > 0")
            .withColumn("n_chars", F.when(F.col("n_kept") < F.col("n_lines"), F.length("left_text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
            .withColumn("text", F.coalesce("left_text", "text"))
            .select(*DOCUMENT_COLUMNS))
