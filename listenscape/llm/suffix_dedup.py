"""Operator 1: removal of byte strings of ``length`` bytes that also start earlier, by suffix arrays.

Every text is read as UTF-8 bytes. A window (``length`` bytes from a start) is a repeat if the same bytes
start earlier: in a smaller doc_id, or in the same document further left. Each byte of a repeat goes.

1. Documents are dealt into shards by a hash of doc_id. Each window is known by its smallest hash over
   its 32-byte grams; consecutive starts with the same smallest hash form a run. Equal windows have equal
   smallest hashes, so only runs whose hash occurs twice in the corpus, or that hold their smallest gram
   twice, can hold repeats. All hashes are counted: a shard sends each distinct hash once to the bucket that owns it, and gets back those seen twice.
2. A shard sends its runs with such hashes (text, place) to the bucket of the hash. A run equal to an
   earlier run of its shard is a repeat as a whole and is not sent. Hashes with more than ``hot_runs``
   runs are dealt over buckets by a second smallest hash, again equal for equal windows.
3. A bucket first drops whole runs equal to an earlier one. The rest goes, in order of place, into pieces
   of at most ``piece_bytes``; each piece gets a suffix array by Larsson-Sadakane refinement (8, 16, 32, 64, then
   ``length`` bytes; only groups that are still tied are sorted again) and common prefixes by Kasai's
   argument in text order. Suffixes that share ``length`` bytes form a class; all but its first are
   repeats. The pieces' sorted classes are merged by binary search; a class met in an earlier piece is a repeat as a whole.
4. Repeated starts return to their shard, which removes the bytes.

Cases: null texts are empty. Texts shorter than ``length`` keep all bytes. Rows that share a doc_id are
ordered by text, the earlier row counts as earlier. Rows without a doc_id stand before all others, as if they shared one. An empty table gives no rows. Extra columns are ignored.
Memory: a shard of text, a bucket's runs and one piece; buckets and shards grow in number with the input.
Between the steps, tables lie in the shared scratch folder.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stage, shard_count, stage, table

GRAM = 32
CHUNK = 1 << 20
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93)]


def _loads8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as a number (``data`` has 8 spare bytes at its end)."""
    return np.lib.stride_tricks.as_strided(data.view(np.uint8)[:8].view("<u8"), (len(data) - 8,), (1,)).copy()


def gram_hashes(data: np.ndarray, second: bool = False) -> np.ndarray:
    """A hash of the 32 bytes from every position of ``data`` (the last 31 positions have none)."""
    x = _loads8(np.concatenate([data, np.zeros(8, np.uint8)])) * _C[0]
    x ^= x >> np.uint64(29)
    for step, c in ((8, _C[1]), (16, _C[2])):
        x = x[:-step] * c + x[step:]
        x ^= x >> np.uint64(31)
    if second:
        x = x * _C[3]
        x ^= x >> np.uint64(33)
    return x * _C[0] if not second else x * _C[2]


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` consecutive hashes."""
    m, have = hashes, 1
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[:-rest], m[rest:]) if rest else m


class Shard:
    """The texts of a shard in order of place, as one byte array."""

    def __init__(self, rows: pa.Table):
        ids = rows.column("doc_id").to_pylist()
        texts = (t or b"" for t in rows.column("text").cast(pa.binary()).to_pylist())
        pairs = sorted(((-1 << 63, t, True) if i is None else (i, t, False)) for i, t in zip(ids, texts))
        self.ids = np.array([p[0] for p in pairs], np.int64)
        self.unnamed = np.array([p[2] for p in pairs], bool)
        self.data = np.frombuffer(b"".join(p[1] for p in pairs), np.uint8)
        self.ends = np.cumsum([len(p[1]) for p in pairs], dtype=np.int64)
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def runs(self, length: int, second: bool = False):
        """(first start, number of starts, hash, second hash, periodic) of all runs; starts count from the shard's beginning.

        A run can repeat a window inside itself only if its smallest gram is in it twice: then some window,
        not the run's last, begins with that gram."""
        width, out = length - GRAM + 1, []
        n = len(self.data) - length + 1
        for a in range(0, max(0, n), CHUNK):
            part = self.data[a:a + CHUNK + length - 1]
            grams = gram_hashes(part)
            low = window_minima(grams, width)[:len(part) - length + 1]
            also = window_minima(gram_hashes(part, True), width)[:len(low)] if second else None
            doc = self._doc(a, len(low))
            inside = np.arange(a, a + len(low)) + length <= self.ends[doc]
            new = np.ones(len(low), bool)
            new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
            if second:
                new[1:] |= also[1:] != also[:-1]
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(low)))
            leads = grams[:len(low)] == low
            leads[first + size - 1] = False
            periodic = np.add.reduceat(leads.astype(np.int32), first) > 0
            use = inside[first]
            first, size = first[use], size[use]
            out.append((first + a, size, low[first], also[first] if second else np.zeros(len(first), np.uint64), periodic[use]))
        if not out:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, bool))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _doc(self, a: int, n: int) -> np.ndarray:
        """The row of each of n positions from a."""
        i = int(np.searchsorted(self.ends, a, side="right"))
        j = int(np.searchsorted(self.ends, a + n - 1, side="right"))
        cut = np.minimum(self.ends[i:j + 1], a + n)
        return np.repeat(np.arange(i, j + 1), np.diff(np.concatenate([[a], cut])))


def owner(hashes: np.ndarray, buckets: int) -> np.ndarray:
    x = hashes * _C[1]
    return ((x ^ (x >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def _by_owner(target: np.ndarray):
    """(bucket, indices) for each bucket present."""
    order = np.argsort(target, kind="stable")
    cuts = np.flatnonzero(np.diff(target[order])) + 1
    return [(int(target[x[0]]), x) for x in np.split(order, cuts)] if len(order) else []


def count_hashes(length: int, buckets: int):
    """A shard's distinct hashes with their numbers of runs, a row for each bucket."""
    def run(rows: pa.Table) -> pa.Table:
        _, _, low, _, periodic = Shard(rows).runs(length)
        shard = rows.column("shard")[0].as_py()
        value, inverse = np.unique(low, return_inverse=True)
        n = np.bincount(inverse, weights=1 + periodic, minlength=len(value))
        n = np.minimum(n, 0xFFFF).astype(np.uint16)
        parts = _by_owner(owner(value, buckets))
        return pa.table({"bucket": pa.array([b for b, _ in parts], pa.int64()), "shard": pa.array([shard] * len(parts), pa.int64()),
                         "hashes": pa.array([value[x].tobytes() for _, x in parts], pa.binary()),
                         "counts": pa.array([n[x].tobytes() for _, x in parts], pa.binary())})

    return run


def seen_twice(hot_runs: int):
    """For each shard, its hashes that have two runs or more in the corpus, and the hot ones among them."""
    def run(rows: pa.Table) -> pa.Table:
        value = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
        n = np.concatenate([np.frombuffer(x, np.uint16) for x in rows.column("counts").to_pylist()]).astype(np.int64)
        total = np.concatenate(value)
        u, inverse = np.unique(total, return_inverse=True)
        count = np.bincount(inverse, weights=n, minlength=len(u))[inverse]
        out, at = [], 0
        for shard, v in zip(rows.column("shard").to_pylist(), value):
            c = count[at:at + len(v)]
            at += len(v)
            if (c > 1).any():
                out.append((shard, v[c > 1].tobytes(), v[c > hot_runs].tobytes()))
        return pa.table({"shard": pa.array([x[0] for x in out], pa.int64()), "hashes": pa.array([x[1] for x in out], pa.binary()),
                         "hot": pa.array([x[2] for x in out], pa.binary())})

    return run


def _places(shard: Shard, first: np.ndarray, size: np.ndarray) -> dict:
    row = np.searchsorted(shard.ends, first, side="right")
    return {"row": row.astype(np.int64), "start": first - shard.begins[row], "n": size}


def send_runs(length: int, buckets: int):
    """(kind 0, bucket, runs to compare) and (kind 1, shard, runs known to be repeats)."""
    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        kinds, targets, payloads = [], [], []
        if rows.num_rows and wanted.num_rows:
            shard, number = Shard(rows), rows.column("shard")[0].as_py()
            known = np.sort(np.frombuffer(b"".join(wanted.column("hashes").to_pylist()), np.uint64))
            hot = np.sort(np.frombuffer(b"".join(wanted.column("hot").to_pylist()), np.uint64))
            first, size, low, also, periodic = shard.runs(length, second=len(hot) > 0)
            is_in = lambda x, s: s[np.minimum(np.searchsorted(s, x), len(s) - 1)] == x if len(s) else np.zeros(len(x), bool)
            pick = is_in(low, known)
            first, size, low, also, periodic = first[pick], size[pick], low[pick], also[pick], periodic[pick]
            key = np.where(is_in(low, hot), low ^ (also * _C[3]), low)
            raw, seen, fresh = shard.data.tobytes(), set(), np.ones(len(first), bool)
            for i, (a, n) in enumerate(zip(first.tolist(), size.tolist())):
                text = raw[a:a + n + length - 1]
                digest = hashlib.blake2b(text, digest_size=16).digest()
                fresh[i] = digest not in seen
                seen.add(digest)
            for bucket, x in _by_owner(owner(key[fresh], buckets)):
                x = np.flatnonzero(fresh)[x]
                place = _places(shard, first[x], size[x])
                place |= {"doc": shard.ids[place["row"]], "shard": number, "key": key[x], "periodic": periodic[x],
                          "text": zstandard.compress(b"".join(raw[a:a + n + length - 1] for a, n in zip(first[x].tolist(), size[x].tolist())), 1)}
                kinds.append(0)
                targets.append(bucket)
                payloads.append(pickle.dumps(place, protocol=5))
            if not fresh.all():
                kinds.append(1)
                targets.append(number)
                payloads.append(pickle.dumps(_places(shard, first[~fresh], size[~fresh]), protocol=5))
        return pa.table({"kind": pa.array(kinds, pa.int32()), "target": pa.array(targets, pa.int64()), "payload": pa.array(payloads, pa.binary())})

    return run


def suffix_order(data: np.ndarray, room: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with at least ``length`` bytes of room in order of those bytes, by Larsson-Sadakane refinement.

    room: bytes from each position to the end of its run. Returns (positions, rank of each)."""
    pos = np.flatnonzero(room >= 8)
    key = _loads8(np.concatenate([data, np.zeros(8, np.uint8)])).byteswap()[pos]
    order = np.argsort(key, kind="stable")
    pos, key = pos[order], key[order]
    rank = np.zeros(len(data) + 1, np.int64)
    head = np.concatenate([[True], key[1:] != key[:-1]]) if len(pos) else np.zeros(0, bool)
    rank[pos] = np.maximum.accumulate(np.where(head, np.arange(len(pos)), 0))
    have = 8
    while have < length:
        step = min(have, length - have)
        have += step
        pos = pos[room[pos] >= have]
        new = rank[pos].copy()
        tied = np.zeros(len(pos), bool)
        if len(pos) > 1:
            same = new[1:] == new[:-1]
            tied[1:] |= same
            tied[:-1] |= same
        t = np.flatnonzero(tied)
        if len(t):
            group, second = new[t], rank[pos[t] + step]
            order = np.lexsort((second, group))
            moved, group, second = pos[t][order], group[order], second[order]
            start = np.concatenate([[True], group[1:] != group[:-1]])
            fresh = start | np.concatenate([[True], second[1:] != second[:-1]])
            at = np.arange(len(t))
            inside = at - np.maximum.accumulate(np.where(start, at, 0))
            offset = np.maximum.accumulate(np.where(fresh, at, 0)) - (at - inside)
            pos[t] = moved  # tied groups are contiguous, so the order of groups stays
            new[t] = group + offset
        rank[pos] = new
    return pos, rank[pos]


def common_prefixes(data: np.ndarray, room: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``order`` (0 for the first).

    Kasai: if a suffix's neighbour moves one byte on with it, their common prefix is one byte shorter; only
    where the neighbour changes are bytes compared."""
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    before = np.full(len(data), -2, np.int64)
    before[order[1:]] = order[:-1]
    p = np.sort(order[1:])
    q = before[p]
    head = np.ones(len(p), bool)
    head[1:] = (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1) | (room[p[1:]] != room[p[:-1]] - 1) | (room[q[1:]] != room[q[:-1]] - 1)
    hp, hq = p[head], q[head]
    limit = np.minimum(room[hp], room[hq])
    size = np.zeros(len(hp), np.int64)
    eight = _loads8(np.concatenate([data, np.zeros(8, np.uint8)]))
    live = np.arange(len(hp))
    while len(live):
        a, b = eight[hp[live] + size[live]], eight[hq[live] + size[live]]
        left = limit[live] - size[live]
        whole = (a == b) & (left >= 8)
        x = a ^ b
        low = np.where(x == 0, np.uint64(0), np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.uint64) >> np.uint64(3)).astype(np.int64)
        size[live] += np.where(whole, 8, np.minimum(left, np.where(x == 0, 8, low)))
        live = live[whole & (left > 8)]
    at = np.arange(len(p))
    first = np.maximum.accumulate(np.where(head, at, 0))
    lcp = np.zeros(len(data), np.int64)
    lcp[p] = np.maximum(0, size[np.cumsum(head) - 1] - (at - first))
    out = lcp[order]
    out[0] = 0
    return out


def repeats_of(texts: list[bytes], length: int, piece_bytes: int) -> list[np.ndarray]:
    """For each run (in order of place): which of its starts are repeats of a start before it."""
    out = [np.zeros(len(t) - length + 1, bool) for t in texts]
    seen = np.zeros(0, f"S{length}")
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= piece_bytes):
            size, j = size + len(texts[j]), j + 1
        lens = np.array([len(t) for t in texts[i:j]])
        data = np.frombuffer(b"".join(texts[i:j]), np.uint8)
        room = np.repeat(np.cumsum(lens), lens) - np.arange(len(data))
        order, _ = suffix_order(data, room, length)
        lcp = common_prefixes(data, room, order)
        head = np.flatnonzero(lcp < length)
        first = np.minimum.reduceat(order, head)
        again = np.ones(len(data), bool)
        again[first] = False
        # Merge: this piece's classes against the sorted classes of the pieces before it.
        if i or j < len(texts):
            windows = np.lib.stride_tricks.sliding_window_view(data, length)[first]
            keys = np.ascontiguousarray(windows).view(f"S{length}").ravel()
            at = np.searchsorted(seen, keys)
            met = (seen[np.minimum(at, len(seen) - 1)] == keys) if len(seen) else np.zeros(len(keys), bool)
            again[first[met]] = True
            seen = np.insert(seen, at[~met], keys[~met])
        for k, a in zip(range(i, j), np.cumsum(lens) - lens):
            out[k] = again[a:a + len(out[k])]
        i = j
    return out


def find_repeats(length: int, piece_bytes: int):
    """A bucket's runs in; (kind 1, shard, repeated starts) out."""
    def run(rows: pa.Table) -> pa.Table:
        sent = [pickle.loads(x) for x in rows.column("payload").to_pylist()]
        doc, row, start, n, key, periodic = (np.concatenate([s[c] for s in sent]) for c in ("doc", "row", "start", "n", "key", "periodic"))
        shard = np.repeat([s["shard"] for s in sent], [len(s["n"]) for s in sent])
        texts = []
        for s in sent:
            s["text"] = zstandard.decompress(s["text"])
            cuts = np.concatenate([[0], np.cumsum(s["n"] + length - 1)]).tolist()
            texts += [s["text"][a:b] for a, b in zip(cuts, cuts[1:])]
        found: dict[int, list] = {}

        def note(i, a, b):
            found.setdefault(int(shard[i]), []).append((int(row[i]), int(start[i]) + a, b - a))

        first_of: dict[bytes, int] = {}
        left: dict[int, list] = {}
        for i in np.lexsort((start, row, doc)).tolist():
            if texts[i] in first_of:
                note(i, 0, int(n[i]))
            else:
                first_of[texts[i]] = i
                left.setdefault(int(key[i]), []).append(i)
        # A hash with one distinct run can only repeat inside that run.
        compare = sorted((i for v in left.values() for i in v if len(v) > 1 or periodic[i]), key=lambda i: (doc[i], row[i], start[i]))
        for i, mask in zip(compare, repeats_of([texts[i] for i in compare], length, piece_bytes)):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))).tolist()
            for a, b in zip(edge[::2], edge[1::2]):
                note(i, a, b)
        out = []
        for s, v in found.items():
            r, a, m = (np.array(x, np.int64) for x in zip(*v))
            out.append((s, pickle.dumps({"row": r, "start": a, "n": m}, protocol=5)))
        return pa.table({"target": pa.array([x[0] for x in out], pa.int64()), "payload": pa.array([x[1] for x in out], pa.binary())})

    return run


def remove(length: int, texts: bool):
    def run(rows: pa.Table, repeats: pa.Table) -> pa.Table:
        shard = Shard(rows)
        edge = np.zeros(len(shard.data) + 1, np.int32)
        for x in repeats.column("payload").to_pylist() if repeats.num_rows else []:
            p = pickle.loads(x)
            at = shard.begins[p["row"]] + p["start"]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + p["n"] + length - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        out = []
        for a, b in zip(shard.begins.tolist(), shard.ends.tolist()):
            g = gone[a:b]
            kept = shard.data[a:b][~g].tobytes()
            spans = int(g[:1].sum()) + int((g[1:] & ~g[:-1]).sum())
            out.append((b - a, int(g.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if texts else None))
        n, m, s, h, k = zip(*out) if out else ([],) * 5
        cols = {"doc_id": pa.array(shard.ids, mask=shard.unnamed), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(m, pa.int64()),
                "n_spans": pa.array(s, pa.int64()), "kept_sha256": pa.array(h, pa.string())}
        return pa.table(cols | ({"kept": pa.array(k, pa.binary())} if texts else {}))

    return run


def dedup(docs: DataFrame, length: int = 100, shard_bytes: int = 5 << 20, piece_bytes: int = 4 << 20, hot_runs: int = 20_000,
          texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes of every row of ``docs``."""
    if length <= GRAM:
        raise ValueError(f"length must be more than {GRAM}")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shards = shard_count(slim, shard_bytes)
    sharded = slim.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    counted = sharded.groupBy("shard").applyInArrow(count_hashes(length, shards), "bucket long, shard long, hashes binary, counts binary")
    wanted = counted.groupBy("bucket").applyInArrow(seen_twice(hot_runs), "shard long, hashes binary, hot binary")
    sent = stage(sharded.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(
        send_runs(length, shards), "kind int, target long, payload binary"), "suffix-runs")
    found = sent.where("kind = 0").groupBy("target").applyInArrow(find_repeats(length, piece_bytes), "target long, payload binary")
    repeats = stage(found.unionAll(sent.where("kind = 1").select("target", "payload")).withColumnRenamed("target", "shard"), "suffix-repeats")
    drop_stage(sent)
    return sharded.groupBy("shard").cogroup(repeats.groupBy("shard")).applyInArrow(
        remove(length, texts), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else ""))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
