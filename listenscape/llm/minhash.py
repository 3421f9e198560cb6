"""Operator 3: near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

Words are maximal runs without ASCII white space, A-Z lower-cased; a document's set holds the distinct
shingles of ``width`` words (all words as one shingle if there are fewer). Documents link if the Jaccard
similarity of their sets is at least ``percent`` / 100; components are the groups reachable by links.

1. One pass makes each document's set size, a 128-bit digest of the set and a packed signature: the low
   8 bits of ``BANDS * ROWS`` minima. Equal sets collapse to one class (its smallest doc_id).
2. Every class posts its signature's bands. Members of a band bucket are candidates.
3. Candidates are screened by the collision-corrected estimate from bit counts of the packed signatures,
   with a margin of five standard deviations below the threshold, and confirmed on the full sets.
4. Buckets are worked off as stars, so a group of g near copies costs g pairs and not g^2: each class is compared with
   the text of most company over all its buckets; then, where a bucket's members are not in one component by then, with
   the bucket's own such member, its hub (which may lie outside) and one of those that share a difference from the hub.
   Members of still different components are joined by these differences (see ``_prefixes``): near copies that miss
   the threshold with the hub and with one another share almost all their shingles, but few of what tells them from the
   hub. What is rare is counted for each hub over its own members. The bound is exact, so no link between components is lost.

A pair at the threshold of 0.8 shares no band with probability (1 - 0.8^7)^48 = 1e-5, one at 0.85 with 1e-8.

Cases: null and empty texts, and texts of white space only, have an empty set, link with nothing and are kept.
Equal texts link. Rows sharing a doc_id keep a row each; for links, a doc_id stands for all its rows.
The pipeline's stage keeps rows without a doc_id, and a row for each different set of a kept doc_id.
Empty tables give empty results; extra columns are ignored; long texts are hashed in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, components, stage, table, worker_cache

BANDS, ROWS = 48, 7
#: About how many members of a hub one task compares with it.
TOGETHER = 64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


class Hasher:
    """Hashes of words and shingles. The seeds are constants, so every worker agrees."""

    def __init__(self):
        rng = np.random.Generator(np.random.Philox(key=20240229))
        self.byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = np.uint64(rng.integers(1, 1 << 63) | 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.a = rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
        self.block = np.empty((256, BANDS * ROWS), np.uint32)
        self.grow(1 << 14)

    def grow(self, n: int) -> None:
        self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, self.base))])
        self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, self.inverse))])

    @staticmethod
    def mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))

    def words(self, data: bytes) -> np.ndarray:
        """A 64-bit hash of every word of ``data`` (already lower-cased)."""
        codes = np.frombuffer(data, np.uint8)
        if len(codes) >= len(self.up):
            self.grow(2 * len(codes))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[codes], [True]]).view(np.int8)))
        start, end = edge[::2], edge[1::2]
        total = np.concatenate([[np.uint64(0)], np.cumsum(self.byte[codes] * self.up[:len(codes)])])
        return self.mix((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64))

    def shingles(self, text: bytes | None, width: int) -> np.ndarray:
        """The sorted distinct shingle hashes of a whole text."""
        words = self.words(text.lower()) if text else np.zeros(0, np.uint64)
        if not len(words):
            return words
        n = max(1, len(words) - width + 1)
        h = np.full(n, np.uint64(min(width, len(words))))
        for k in range(min(width, len(words))):
            h = self.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n])
        return np.unique(h)

    def signature(self, shingles: np.ndarray) -> bytes:
        x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), len(self.block)):  # a block stays in the processor's cache
            h = self.block[:len(x) - i]
            np.multiply(x[i:i + len(h), None], self.a, out=h)
            h += self.b
            np.minimum(low, h.min(axis=0), out=low)
        return (low & np.uint32(0xFF)).astype(np.uint8).tobytes()


def hasher() -> Hasher:
    cache = worker_cache()
    if "hasher" not in cache:
        cache["hasher"] = Hasher()
    return cache["hasher"]


def _signer(width: int):
    def run(batches):
        h = hasher()
        for batch in batches:
            sizes, high, low, signs, keys = [], [], [], [], []
            for t in batch.column("text").cast(pa.binary()).to_pylist():
                s = h.shingles(t, width)
                sizes.append(len(s))
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                high.append(int.from_bytes(d[:8], "little", signed=True) if d else None)
                low.append(int.from_bytes(d[8:], "little", signed=True) if d else None)
                signs.append(h.signature(s) if d else None)
                keys.append(hashlib.md5(t).digest() if t is not None else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(signs, pa.binary()), pa.array(keys, pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "sign", "text_key"])

    return run


def _bands(batches):
    """A row for each class and band: the band's number above the bits it kept."""
    for batch in batches:
        signs = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint8).reshape(-1, BANDS, ROWS).astype(np.int64)
        key = np.zeros(signs.shape[:2], np.int64) + np.arange(BANDS)
        for r in range(ROWS):
            key = key << 8 | signs[:, :, r]
        ids = np.repeat(np.asarray(batch.column("rep")), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(ids)], ["key", "rep"])


def _screen(least: float):
    """Pairs whose estimated similarity, corrected for chance collisions of 8 bits, is at least ``least``."""
    chance = 2.0 ** -8

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("sign_a", "sign_b"))
            x = a ^ b
            for k in (4, 2, 1):
                x = x | x >> np.uint64(k)
            differ = np.bitwise_count(x & np.uint64(0x0101010101010101)).sum(axis=1)
            same = 1 - differ / (BANDS * ROWS)
            keep = (same - chance) / (1 - chance) >= least
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return run


def _prefixes(percent: int):
    """The differences between a member and a pivot that a link must share one of, rarest first.

    A member's set lacks ``r`` of the pivot's ``n`` shingles and adds ``a``. With w = 100 r + percent a, two members link
    if and only if their differences (lacked or added) have at least (w + w' - (100 - percent) n) / (100 + percent) in common, and
    a member links with the pivot itself if w <= (100 - percent) n. Of two members in different components at least one has no
    such link (members are compared with the pivot as well), so that this number is positive: the two share one of their first d - number + 1 differences in any
    fixed order, d being how many there are. ``index`` bounds the number for partners of no smaller w, ``probe`` for
    partners of no larger w: they hold at least w / percent differences, or too few to reach it.
    """

    def run(batches):
        for batch in batches:
            own, base = ([(np.asarray(batch.column(t)[i].values), np.asarray(batch.column(f)[i].values)) for i in range(batch.num_rows)]
                         for t, f in (("tokens", "df"), ("tokens_p", "df_p")))
            rows, parts = [], []
            for i, ((c, dc), (p, dp), members) in enumerate(zip(own, base, batch.column("members").to_pylist())):
                added, lacked = ~np.isin(c, p), ~np.isin(p, c)
                r, a, slack = int(lacked.sum()), int(added.sum()), (100 - percent) * len(p)
                w, d = 100 * r + percent * a, r + a
                index = d + 1 + (slack - w - max(w, slack + 1)) // (100 + percent)
                probe = d + 1 + (slack - w) // 100 if w > slack else 0
                # How many members share a difference: those that hold the added one, or do not hold the lacked one.
                tokens, df = np.concatenate([c[added], p[lacked]]), np.concatenate([dc[added], members - dp[lacked]])
                order = np.lexsort((tokens, df))[:max(index, probe, 0)]
                pos = np.arange(len(order))
                some = (df[order] > 1) | (order >= a)  # no other member adds a shingle found once
                pos, tokens = pos[some], tokens[order][some]
                rows.append(np.full(len(pos), i))
                parts.append((tokens, pos, np.full(len(pos), w), np.full(len(pos), d), np.full(len(pos), slack), pos < index, pos < probe))
            if not parts:
                continue
            at = pa.array(np.concatenate(rows))
            made = [pa.array(np.concatenate(x)) for x in zip(*parts)]
            yield pa.RecordBatch.from_arrays([batch.column("pivot").take(at), batch.column("rep").take(at), *made],
                                             ["pivot", "rep", "token", "pos", "w", "d", "slack", "index", "probe"])

    return run


def _setter(width: int):
    def run(batches):
        h = hasher()
        for batch in batches:
            sets = [h.shingles(t, width).view(np.int64) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))], ["doc_id", "set"])

    return run


class _Confirm:
    """Screens and confirms candidate pairs. The full sets of all documents that share a bucket are made once."""

    def __init__(self, docs: DataFrame, classes: DataFrame, shared: DataFrame, width: int, percent: int):
        self.classes, self.percent = classes, percent
        self.kind = docs.schema["doc_id"].dataType.simpleString()
        needed = shared.select(F.col("rep").alias("doc_id")).distinct()
        text = docs.select("doc_id", "text").join(needed.hint("merge"), "doc_id", "left_semi")
        self.sets = stage(text.mapInArrow(_setter(width), f"doc_id {self.kind}, set array<long>"), "minhash-sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        t = self.percent / 100
        least = t - 5 * (t * (1 - t) / (BANDS * ROWS)) ** 0.5
        signs = self.classes.select("rep", "sign")
        both = (pairs.distinct().join(signs.select(F.col("rep").alias("a"), F.col("sign").alias("sign_a")), "a")
                .join(signs.select(F.col("rep").alias("b"), F.col("sign").alias("sign_b")), "b"))
        likely = both.mapInArrow(_screen(least), f"a {self.kind}, b {self.kind}")
        a = self.sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a"))
        b = self.sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b"))
        shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
        either = F.size("set_a") + F.size("set_b") - shared
        return stage(likely.join(a, "a").join(b, "b").where(100 * shared >= self.percent * either).select("a", "b").distinct(), "minhash-links")

    def differences(self, shared: DataFrame) -> DataFrame:
        """The rows of ``_prefixes`` for each member of ``shared`` and hub of a bucket of it.

        How often a token occurs is counted for each hub over its own members: what a member lacks is as rare as the
        members that lack it, which a count over the members of all hubs does not tell."""
        pairs = shared.where("rep <> hub").select(F.col("hub").alias("pivot"), "rep").distinct()
        pairs = stage(pairs.unionAll(pairs.select("pivot", F.col("pivot").alias("rep")).distinct()), "minhash-members")
        ids = pairs.select(F.col("rep").alias("doc_id")).distinct()
        sets = stage(self.sets.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "minhash-member-sets")
        each = pairs.join(sets.withColumnRenamed("doc_id", "rep"), "rep").select("pivot", "rep", F.explode("set").alias("token"))
        often = each.groupBy("pivot", "token").agg(F.count_if(F.col("rep") != F.col("pivot")).cast("int").alias("df"))
        ranked = stage(each.join(often, ["pivot", "token"]).groupBy("pivot", "rep").agg(F.collect_list(F.struct("df", "token")).alias("s"))
                       .select("pivot", "rep", F.col("s.token").alias("tokens"), F.col("s.df").alias("df")), "minhash-ranked")
        # A hub of many members meets them in several tasks.
        members = pairs.groupBy("pivot").agg((F.count("*") - 1).alias("members")).withColumn("parts", F.ceil(F.col("members") / TOGETHER))
        base = (ranked.where("rep = pivot").join(members, "pivot")
                .select("pivot", F.col("tokens").alias("tokens_p"), F.col("df").alias("df_p"), "members",
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")))
        own = (ranked.where("rep <> pivot").join(members.select("pivot", "parts"), "pivot")
               .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts"))).drop("parts"))
        return stage(own.join(base, ["pivot", "part"]).mapInArrow(
            _prefixes(self.percent), f"pivot {self.kind}, rep {self.kind}, token long, pos long, w long, d long, slack long, index boolean, probe boolean"),
            "minhash-differences")

    def late(self, x: DataFrame, y: DataFrame) -> DataFrame:
        """Pairs of ``x`` and ``y`` (rows of ``differences`` with a component) that share a difference early enough for a link."""
        x, y = x.alias("x"), y.alias("y")
        return (x.join(y, (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.token") == F.col("y.token")))
                .where(f"x.component <> y.component AND x.w + y.w - x.slack <= {100 + self.percent} * least(x.d - x.pos, y.d - y.pos)"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    return _grouped(docs, width, percent).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, the set's digest (d1, d2) and the text's (text_key) for every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stage(docs.select("doc_id", "text").mapInArrow(
        _signer(width), f"doc_id {kind}, n_shingles long, d1 long, d2 long, sign binary, text_key binary"), "minhash-rows")
    classes = stage(rows.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("sign").alias("sign")), "minhash-classes")
    posts = classes.select("rep", "sign").mapInArrow(_bands, f"key long, rep {kind}")
    sizes = posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(posts.join(sizes.hint("shuffle_hash"), "key"), "minhash-buckets")
    # A bucket's pivot is its member with most company over all buckets, a member's centre the one of its buckets' pivots that has
    # most: the text that others were copied from. A bucket's hub is the centre most in company of all its members' ones.
    company = shared.groupBy("rep").agg(F.sum("n").alias("company"))
    most = F.max(F.struct("company", (-F.col("pivot")).alias("low"), "pivot"))
    pivots = (shared.join(company, "rep").groupBy("key").agg(F.max(F.struct("company", -F.col("rep"), "rep")).alias("m"))
              .select("key", F.col("m.rep").alias("pivot"), "m.company"))
    shared = stage(shared.select("key", "rep").join(pivots, "key"), "minhash-buckets")
    centres = stage(shared.groupBy("rep").agg(most.alias("m")).select("rep", F.col("m.pivot").alias("centre"), "m.company"), "minhash-centres")
    hubs = (shared.select("key", "rep").join(centres.withColumnRenamed("centre", "pivot"), "rep")
            .groupBy("key").agg(most.alias("m")).select("key", F.col("m.pivot").alias("hub")))
    shared = stage(shared.select("key", "rep", "pivot").join(hubs, "key"), "minhash-buckets")

    confirm = _Confirm(docs, classes, shared, width, percent)
    links = confirm.links(centres.where("rep <> centre").select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b")))
    groups = stage(components(links), "minhash-groups")
    posts = None
    for last in (False, True):
        # Buckets whose members are in one component are done.
        member = (shared.select("key", "rep", "pivot", "hub").join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
                  .select("key", "rep", "pivot", "hub", F.coalesce("component", "rep").alias("component")))
        split = member.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
        shared = stage(member.join(split.hint("shuffle_hash"), "key"), "minhash-buckets")
        if shared.isEmpty():
            break
        if posts is None:
            posts = confirm.differences(shared)
        named = (posts.join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
                 .withColumn("component", F.coalesce("component", "rep")))
        if last:
            pairs = confirm.late(named.where("index"), named.where("probe")).where("x.w < y.w OR x.w = y.w AND x.rep < y.rep")
            pairs = pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        else:
            first = F.min_by(F.struct("rep", "w", "d", "slack", "pos", "component"), F.xxhash64("rep"))
            one = named.groupBy("pivot", "token").agg(first.alias("m")).select("pivot", "token", "m.*")
            stars = [confirm.late(named, one).select(F.col("x.rep").alias("rep"), F.col("y.rep").alias("of")),
                     *(shared.select("rep", F.col(c).alias("of")) for c in ("pivot", "hub"))]
            # Links that are known need no second confirmation.
            own, other = (groups.select(F.col("id").alias(i), F.col("component").alias(c)) for i, c in (("rep", "own"), ("of", "other")))
            pairs = (stars[0].unionAll(stars[1]).unionAll(stars[2]).where("rep <> of").distinct().join(own, "rep", "left").join(other, "of", "left")
                     .where("coalesce(own, rep) <> coalesce(other, of)").select(F.least("rep", "of").alias("a"), F.greatest("rep", "of").alias("b")))
        more = confirm.links(pairs)
        if not more.isEmpty():
            links = links.unionAll(more)
            groups = stage(components(links), "minhash-groups")
    named = (classes.select("d1", "d2", "rep").join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
             .select("d1", "d2", F.coalesce("component", "rep").alias("component_id")))
    some = rows.where("n_shingles > 0").select("doc_id", "n_shingles", "d1", "d2", "text_key").join(named, ["d1", "d2"])
    none = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", "d1", "d2", "text_key"]
    return some.select(*columns).unionAll(none.select(*columns))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), width=2)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the rows with the smallest doc_id, one for each shingle set (the text with the smallest digest);
    of texts without shingles, one row for each doc_id and text. Rows without a doc_id have no group and are all kept."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    named = docs.where("doc_id IS NOT NULL")
    kept = (_grouped(named, width=5).where("doc_id = component_id")
            .groupBy("doc_id", "d1", "d2", F.when(F.col("n_shingles") == 0, F.col("text_key")).alias("bare"))
            .agg(F.min("text_key").alias("text_key")).select("doc_id", "text_key").distinct())
    named = named.withColumn("text_key", F.coalesce(F.unhex(F.md5("text")), F.lit(b"")))
    one = named.join(kept, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    return one.select(*DOCUMENT_COLUMNS).unionAll(docs.where("doc_id IS NULL"))
