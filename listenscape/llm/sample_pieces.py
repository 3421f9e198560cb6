"""Operator 4: SentencePiece segmentations by Gumbel top-k without replacement, and decoding.

A text's lattice has a node at each character and an edge for each piece of the vocabulary that fits; a
character outside the vocabulary is an edge of its UTF-8 byte pieces. No piece has a blank behind another character
(a run of blanks belongs to the word behind it, and may be cut into pieces of several blanks), so the lattice falls into words, and a distinct word's edges are found once
per batch. Piece log-probabilities follow Zipf's law over the ranks of the model's pieces, as BPE models
keep ranks and no probabilities.

The search is A* over perturbed log-probabilities: the exact heuristic is the backward log-sum of the
lattice. The best path inherits the root's Gumbel value; the other children of every node on it form a
region whose value is a Gumbel truncated at the path's. The best region is opened next, which fixes
its best child and the rest of that path. So k pops give k distinct segmentations, in falling order of
perturbed log-probability, without replacement. The inclusion score is P(Gumbel value > kappa) with
kappa the best value left. All random numbers are a hash of (row key, sample, word, step): results do not
depend on partitions, batches or retries.

Cases: null and empty texts give one empty segmentation with log-probability 0 and inclusion 1. Texts with
fewer than k segmentations give those they have. A text has one search, and a word one lattice, whatever
their lengths; a text of more than ``CHUNK_CHARS`` characters is a batch of its own, which needs memory in proportion
to it. Rows that share a key are sampled alike. Literal U+2581 is
coded as bytes, so decoding returns the text exactly. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, worker_cache

CHUNK_CHARS = 3 << 20
BLANK = "▁"
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def uniform(*parts) -> np.ndarray:
    """Numbers in (0, 1) hashed from whole numbers."""
    x = np.uint64(0x2545F4914F6CDD1D)
    with np.errstate(over="ignore"):
        for p in parts:
            p = np.asarray(p)
            x = x ^ (p.view(np.uint64) if p.dtype == np.int64 else p.astype(np.uint64))
            x *= _M[0]
            x ^= x >> np.uint64(32)
            x *= _M[1]
        x = x ^ (x >> np.uint64(29))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


class Hashes:
    """A sorted set of hashes. A table of bits, one for each value of some mixed bits, turns most others away."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = len(hashes).bit_length() + 4
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        # The place of a hash with these bits; where several have them, they are looked up in the sorted set.
        self.place, self.shared = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, bool)
        slot = hashes * _M[0] >> self.shift
        self.table[slot] = True
        self.place[slot] = np.arange(len(hashes))
        self.shared[slot[self.place[slot] != np.arange(len(hashes))]] = True

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``x`` of hashes of the set, and their places in the set."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        slot = x * _M[0] >> self.shift
        likely = np.flatnonzero(self.table[slot])
        x, slot = x[likely], slot[likely]
        at = self.place[slot].astype(np.int64)
        several = np.flatnonzero(self.shared[slot])
        at[several] = np.minimum(np.searchsorted(self.hashes, x[several]), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == x)
        return likely[hit], at[hit]


class Pieces:
    """The vocabulary: piece hashes by length, log-probabilities, bytes for decoding."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.vocab_size()
        self.byte_id = np.zeros(256, np.int64)
        self.text: list[bytes] = [b""] * n
        words = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_id[b], self.text[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.text[i] = piece.replace(BLANK, " ").encode()
                if BLANK not in piece.lstrip(BLANK):
                    words.append((piece, i))
        rank = np.arange(len(words)) + 10.0
        logp = -np.log(rank) - np.log((1 / rank).sum())
        self.byte_logp = float(logp[-1]) - 1.0
        # Hashes of whole pieces and of their beginnings, by length.
        whole: dict[int, dict[int, tuple]] = {}
        begin: dict[int, set] = {}
        for (piece, i), p in zip(words, logp.tolist()):
            h = 0
            for k, c in enumerate(piece, 1):
                h = (h * 0x100000001B3 + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                begin.setdefault(k, set()).add(h)
            whole.setdefault(len(piece), {})[h] = (i, p)
        self.longest = max(whole)
        # Sorted beginnings of each length, with the piece that is just that (-1: none) and its log-probability.
        self.begin = {}
        for k in range(1, self.longest + 1):
            h = sorted(begin.get(k, ()))
            found = [whole.get(k, {}).get(x, (-1, 0.0)) for x in h]
            self.begin[k] = (Hashes(np.array(h, np.uint64)), np.array([i for i, _ in found], np.int64), np.array([p for _, p in found]))
        self.sizes = np.array([len(t) for t in self.text], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.text), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text behind ids, without the blank that encoding put in front."""
        return self.decode_each([ids])[0]

    def decode_each(self, rows: list[np.ndarray]) -> list[bytes]:
        """The text behind each row of ids."""
        ids = np.concatenate([*rows, np.zeros(0, np.int32)])
        size = self.sizes[ids]
        end = np.cumsum(size)
        data = self.flat[np.repeat(self.offsets[ids] - end + size, size) + np.arange(int(size.sum()))].tobytes()
        cuts = np.concatenate([[0], end])[np.cumsum([0, *map(len, rows)])].tolist()
        return [data[a + 1:b] for a, b in zip(cuts, cuts[1:])]


class Lattices:
    """The lattices of distinct words, as one graph. State s has the edges first[s] .. first[s + 1]."""

    def __init__(self, words: list[str], pieces: Pieces, lens: np.ndarray | None = None):
        if lens is None:  # else the lengths of words that are one text
            lens = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.start = np.cumsum(lens + 1) - (lens + 1)  # a state for each character and one for the end
        end = self.start + lens
        n = int((lens + 1).sum())
        at = np.arange(len(code)) + np.repeat(np.arange(len(lens)), lens)  # state of each character
        limit = np.repeat(np.cumsum(lens), lens)
        # Literal U+2581 never fits a piece; a word's own leading blanks are marked by a lone surrogate.
        plain = np.where(code == ord(BLANK), 0x110001, np.where(code == 0xD800, ord(BLANK), code)).astype(np.uint64)
        frm, to, piece, logp = [], [], [], []
        alive, h = np.arange(len(code)), np.zeros(len(code), np.uint64)
        covered = np.zeros(len(code), bool)
        for k in range(1, pieces.longest + 1):
            room = alive + k <= limit[alive]
            alive, h = alive[room], h[room]
            if not len(alive):
                break
            h = h * np.uint64(0x100000001B3) + plain[alive + k - 1] + np.uint64(1)
            hashes, ids, p = pieces.begin[k]
            more, i = hashes.find(h)  # no piece begins like the others: no longer one can fit
            alive, h = alive[more], h[more]
            hit = np.flatnonzero(ids[i] >= 0)
            if len(hit):
                here, i = alive[hit], i[hit]
                frm.append(at[here])
                to.append(at[here] + k)
                piece.append(ids[i])
                logp.append(p[i])
                if k == 1:
                    covered[here] = True
        bare = np.flatnonzero(~covered)
        c = code[bare]
        n_bytes = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        frm.append(at[bare])
        to.append(at[bare] + 1)
        piece.append(-1 - c)
        logp.append(n_bytes * pieces.byte_logp)
        counts = np.zeros(n, np.int64)
        for f in frm:  # a state has at most one edge of each length
            counts[f] += 1
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.branches = counts > 1
        self.several = np.repeat(self.branches, counts)
        self.frm = np.repeat(np.arange(n), counts)
        n_edges, free = len(self.frm), self.first[:-1].copy()
        self.to, self.piece, flat = np.empty(n_edges, np.int64), np.empty(n_edges, np.int64), np.empty(n_edges)
        for f, t, i, p in zip(frm, to, piece, logp):
            spot = free[f]
            self.to[spot], self.piece[spot], flat[spot] = t, i, p
            free[f] = spot + 1
        logp = flat
        self.is_end = np.zeros(n, bool)
        self.is_end[end] = True
        # Backward log-sums, from the last character of all words to the first.
        beta = np.zeros(n)
        back = np.repeat(lens, lens) - (at - np.repeat(self.start, lens))  # characters to the word's end
        by = np.argsort(back.astype(np.uint16) if lens.max(initial=0) < 1 << 16 else back, kind="stable")  # 16 bits: a radix sort
        cuts = np.concatenate([[0], np.cumsum(np.bincount(back, minlength=int(lens.max(initial=0)) + 1))]).astype(int)
        for d in range(1, len(cuts) - 1):
            s = at[by[cuts[d]:cuts[d + 1]]]
            a, b = self.first[s], self.first[s + 1]
            e = np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange(int((b - a).sum()))
            v = logp[e] + beta[self.to[e]]
            heads = np.cumsum(b - a) - (b - a)
            top = np.maximum.reduceat(v, heads)
            beta[s] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, b - a)), heads))
        self.logq = np.minimum(0.0, logp + beta[self.to] - beta[self.frm])
        self.q = np.exp(self.logq)

    def choose(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each state with its probability."""
        edge, last = self.first[state].copy(), self.first[state + 1] - 1
        u = u - self.q[edge]
        live = np.flatnonzero((u > 0) & (edge < last))
        while len(live):
            edge[live] += 1
            u[live] -= self.q[edge[live]]
            live = live[(u[live] > 0) & (edge[live] < last[live])]
        return edge


class Search:
    """k segmentations of each of a batch of texts (as word numbers), all searched together."""

    def __init__(self, lat: Lattices, word: np.ndarray, n_words: np.ndarray, keys: np.ndarray):
        self.lat, self.word, self.keys = lat, word, keys
        self.doc = np.repeat(np.arange(len(n_words)), n_words)
        self.place = np.arange(len(word)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
        self.samples: list[dict] = []
        self.extra: dict[tuple[int, int], list[int]] = {}

    def walk(self, turn: int, state: np.ndarray, active: np.ndarray, step: np.ndarray):
        """(word, step, edge) of the rest of each active word's path."""
        lat, out = self.lat, []
        live = ~lat.is_end[state]
        state, active, step = state[live], active[live], step[live]
        while len(active):
            e = lat.first[state]
            many = np.flatnonzero(lat.branches[state])  # elsewhere there is no choice
            some = active[many]
            e[many] = lat.choose(state[many], uniform(self.keys[self.doc[some]], turn, self.place[some], step[many]))
            out.append((active, step, e))
            state = lat.to[e]
            live = ~lat.is_end[state]
            state, active, step = state[live], active[live], step[live] + 1
        return out or [(np.zeros(0, np.int64),) * 3]

    def add(self, turn: int, parts, docs: np.ndarray, value: np.ndarray, new_from: np.ndarray):
        """Keep the sample of ``docs``; regions open on its nodes from place ``new_from`` of each document."""
        lat = self.lat
        occ, step, edge = (np.concatenate(x) for x in zip(*parts))
        per = np.bincount(occ, minlength=len(self.word))
        at = (np.cumsum(per) - per)[occ] + step
        o, s, e = np.empty_like(occ), np.empty_like(step), np.empty_like(edge)
        o[at], s[at], e[at] = occ, step, edge
        doc = self.doc[o]
        n = len(self.keys)
        sizes = np.bincount(doc, minlength=n)
        begin = np.cumsum(sizes) - sizes
        logq = lat.logq[e]
        total = np.cumsum(logq)
        base = np.where(begin > 0, total[np.maximum(begin - 1, 0)], 0.0) if len(total) else np.zeros(n)
        phi = total - logq - base[doc]
        many = lat.several[e]
        if new_from.any():
            many &= (np.arange(len(e)) - begin[doc]) >= new_from[doc]
        g = np.full(len(e), -np.inf)
        m = np.flatnonzero(many)
        doc_m = doc[m]
        mu = phi[m] + np.log(np.maximum(1e-300, -np.expm1(logq[m])))
        g[m] = self.truncated(mu, value[doc_m], uniform(self.keys[doc_m], turn + (1 << 20), self.place[o[m]], s[m]))
        logp = np.bincount(doc, weights=logq, minlength=n)
        has = np.zeros(n, bool)
        has[docs] = True
        self.samples.append({"occ": o, "step": s, "edge": e, "begin": begin, "size": sizes, "phi": phi, "g": g, "logp": logp, "value": value, "has": has})

    @staticmethod
    def truncated(mu, bound, u):
        """A Gumbel of location mu, given that it is below ``bound``."""
        return mu - np.log(np.exp(np.minimum(mu - bound, 700)) - np.log(u))

    def best_regions(self):
        """For each document the sample and node of its best region, and the value (-inf: none)."""
        n = len(self.keys)
        top, sample, node = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for j, s in enumerate(self.samples):
            some = np.flatnonzero(s["size"] > 0)
            if not len(some):
                continue
            best = np.full(n, -np.inf)
            best[some] = np.maximum.reduceat(s["g"], s["begin"][some])
            hit = np.flatnonzero((s["g"] == np.repeat(best, s["size"])) & np.isfinite(s["g"]))
            where = np.zeros(n, np.int64)
            where[self.doc[s["occ"][hit[::-1]]]] = hit[::-1]
            better = best > top
            top[better], sample[better], node[better] = best[better], j, where[better]
        return top, sample, node

    def run(self, k: int):
        n, lat = len(self.keys), self.lat
        root = -np.log(-np.log(uniform(self.keys, 1 << 30, 0, 0)))
        everything = np.arange(len(self.word))
        self.add(0, self.walk(0, lat.start[self.word], everything, np.zeros(len(self.word), np.int64)), np.arange(n), root, np.zeros(n, np.int64))
        for turn in range(1, k):
            value, sample, node = self.best_regions()
            docs = np.flatnonzero(np.isfinite(value))
            if not len(docs):
                break
            cut_word, cut_step, new_from = np.full(n, len(self.word)), np.zeros(n, np.int64), np.full(n, 1 << 60)
            forced = []
            cut_at = np.zeros((2, n), np.int64)  # the word in its text, and the step, of each document's best region
            for j, s in enumerate(self.samples):
                own = docs[sample[docs] == j]
                cut_at[:, own] = s["occ"][node[own]] - self.word_begin(own), s["step"][node[own]]
            draw, redraw = (np.zeros(n), np.zeros(n))
            draw[docs] = uniform(self.keys[docs], turn + (2 << 20), *cut_at[:, docs])
            redraw[docs] = uniform(self.keys[docs], turn + (3 << 20), *cut_at[:, docs])
            for d in docs.tolist():
                s, m = self.samples[sample[d]], int(node[d])
                state = int(lat.frm[s["edge"][m]])
                used = self.extra.setdefault((int(sample[d]), m), [int(s["edge"][m])])
                left = [e for e in range(int(lat.first[state]), int(lat.first[state + 1])) if e not in used]
                mass = np.cumsum(lat.q[left])
                u = float(draw[d])
                e = left[min(int(np.searchsorted(mass, u * mass[-1])), len(left) - 1)]
                used.append(e)
                rest = float(mass[-1] - lat.q[e])
                again = float(redraw[d])
                s["g"][m] = self.truncated(s["phi"][m] + np.log(rest), value[d], again) if len(left) > 1 and rest > 0 else -np.inf
                cut_word[d], cut_step[d], new_from[d] = s["occ"][m], s["step"][m], m - s["begin"][d] + 1
                forced.append((int(s["occ"][m]), int(s["step"][m]), e))
            parts = []
            in_turn = np.zeros(n, bool)
            in_turn[docs] = True
            for j, s in enumerate(self.samples):
                d = self.doc[s["occ"]]
                keep = in_turn[d] & (sample[d] == j) & ((s["occ"] < cut_word[d]) | ((s["occ"] == cut_word[d]) & (s["step"] < cut_step[d])))
                parts.append((s["occ"][keep], s["step"][keep], s["edge"][keep]))
            f = tuple(np.array(x, np.int64) for x in zip(*forced))
            parts.append(f)
            fresh = np.flatnonzero(in_turn[self.doc] & (everything > cut_word[self.doc]))
            active = np.concatenate([f[0], fresh])
            state = np.concatenate([lat.to[f[2]], lat.start[self.word[fresh]]])
            parts += self.walk(turn, state, active, np.concatenate([f[1] + 1, np.zeros(len(fresh), np.int64)]))
            self.add(turn, parts, docs, value, new_from)
        return self.samples, self.best_regions()[0]

    def word_begin(self, d: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_begin"):
            self._begin = np.searchsorted(self.doc, np.arange(len(self.keys)))
        return self._begin[d]


def words_of(text: str) -> list[str]:
    """The words of a text, each with a blank before it that is left out here; words behind several blanks keep the others."""
    words = text.split(" ")
    return words if "" not in words else [w[1:] for w in re.findall(" +[^ ]*", " " + text)]


def segment(texts: list[str], keys: np.ndarray, pieces: Pieces, k: int):
    """For each text: a list of (ids, log-probability, inclusion score), best first. Texts are not empty."""
    index: dict[str, int] = defaultdict(itertools.count().__next__)
    number = [list(map(index.__getitem__, words_of(t))) for t in texts]
    n_words = np.array([len(x) for x in number], np.int64)
    word = np.fromiter(itertools.chain.from_iterable(number), np.int64, int(n_words.sum()))
    lens = np.fromiter(map(len, index), np.int64, len(index)) + 1
    lat = Lattices(["\ud800".join(["", *index]).replace(" ", "\ud800")], pieces, lens)
    samples, kappa = Search(lat, word, n_words, keys).run(k)
    out: list[list] = [[] for _ in texts]
    for s in samples:
        score = -np.expm1(-np.exp(np.minimum(s["logp"] - kappa, 50)))
        ids, per = expand(lat.piece[s["edge"]], pieces)
        at = np.concatenate([[0], np.cumsum(per)])
        for d in np.flatnonzero(s["has"]).tolist():
            a, b = at[s["begin"][d]], at[s["begin"][d] + s["size"][d]]
            out[d].append((ids[a:b], float(s["logp"][d]), float(score[d]) if np.isfinite(kappa[d]) else 1.0))
    return out


def expand(piece: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of edges (a byte edge gives several) and the number of ids of each edge."""
    c = -1 - piece
    bare = piece < 0
    per = np.where(bare, 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000), 1)
    ids = np.repeat(piece, per)
    if bare.any():
        at = (np.cumsum(per) - per)[bare]
        data = [chr(x).encode("utf-8", "surrogatepass") for x in c[bare].tolist()]
        spots = np.repeat(at, per[bare]) + np.arange(int(per[bare].sum())) - np.repeat(np.cumsum(per[bare]) - per[bare], per[bare])
        ids[spots] = pieces.byte_id[np.frombuffer(b"".join(data), np.uint8)]
    return ids.astype(np.int32), per


def sampler(model_file: str, k: int, with_ids: bool):
    def run(batches):
        cache = worker_cache()
        if ("pieces", model_file) not in cache:
            cache["pieces", model_file] = Pieces(model_file)
        pieces = cache["pieces", model_file]
        rows, size = [], 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                n = len(row[1] or "")
                if rows and size + n > CHUNK_CHARS:
                    yield table_of(rows, pieces, k, with_ids, kind)
                    rows, size = [], 0
                rows.append(row)
                size += n
        if rows:
            yield table_of(rows, pieces, k, with_ids, kind)

    return run


def row_keys(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(str(x).encode()) << 32 | zlib.adler32(repr(x).encode()) for x in ids], np.uint64)


def table_of(rows, pieces: Pieces, k: int, with_ids: bool, id_type) -> pa.RecordBatch:
    found: list[list] = [[(np.zeros(0, np.int32), 0.0, 1.0)] if not t else [] for _, t in rows]
    keys = row_keys([i for i, _ in rows])
    some = [r for r, (_, t) in enumerate(rows) if t]
    if some:
        for r, f in zip(some, segment([rows[r][1] for r in some], keys[some], pieces, k)):
            found[r] = f
    ids, sample, sizes, crc, logp, score, exact, raw = [], [], [], [], [], [], [], []
    decoded = iter(pieces.decode_each([x for f in found for x, _, _ in f]))
    for (doc, t), f in zip(rows, found):
        data = (t or "").encode("utf-8", "surrogatepass")
        for s, (x, p, q) in enumerate(f, 1):
            ids.append(doc)
            sample.append(s)
            sizes.append(len(x))
            crc.append(zlib.crc32(x.astype("<u4").tobytes()))
            logp.append(p)
            score.append(q)
            exact.append(next(decoded) == data)
            raw.append(x)
    cols = {"doc_id": pa.array(ids, id_type), "sample": pa.array(sample, pa.int32()), "n_ids": pa.array(sizes, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()), "log_prob": pa.array(logp, pa.float64()), "inclusion": pa.array(score, pa.float64()),
            "round_trip": pa.array(exact, pa.bool_())}
    if with_ids:
        cols["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.concatenate([*raw, np.zeros(0, np.int32)])))
    return pa.RecordBatch.from_pydict(cols)


def sample(docs: DataFrame, model_file: str, samples: int = 2, with_ids: bool = True) -> DataFrame:
    """A row for each document and sample: doc_id, sample (1 is the best), n_ids, ids_crc32, log_prob,
    inclusion, round_trip (decoding gave the text back) and, if asked for, ids."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, sample int, n_ids long, ids_crc32 long, log_prob double, inclusion double, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(sampler(model_file, samples, with_ids), schema + (", ids array<int>" if with_ids else ""))


def op4_sample_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sample(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, with their ids."""
    import public_tokenizers

    return sample(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)
