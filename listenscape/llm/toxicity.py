"""Operator 6: toxicity behind a noisy channel.

Words that look disguised (leetspeak signs inside a word, separators between letters, letters repeated) are read
as noisy copies of an intended word. Each observed character opens the letters it may stand for; a
character may also be a repeat of the letter before it or a separator to skip. A Viterbi pass
over this lattice under a character bigram model finds the likeliest word, and the restored words are scored.

The bigram counts come from every document (one partial table per task, summed by Spark), plus the
learned toxic words. Word weights are shrunken log-odds of a word, or of its first letters, between
toxic and other training documents; the score is a logistic function of a document's weights.

Training: rows of ``labels`` joined to ``documents``; the caller leaves out what it holds out. At most
``train_rows`` labelled documents are used (by a hash of doc_id), and at most ``max_features`` weights
kept; both are documented bounds. Bigram counts have a fixed size (alphabet squared).

Cases: null and empty texts get the score of a text without weighted words. Without labels of both kinds
every score is the share of toxic labels (0 without labels). Ties cannot arise; repeated rows score
alike; extra columns are ignored. Whole texts are read, and disguised words and runs of any length: words may begin
and end at separators, and anywhere in a run of letters set apart by blanks. A doubled letter is a disguise unless the
word as it stands is usual in documents that are not toxic (at most 5,000 such words are kept).
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, table, worker_cache
from .langid import held_out

ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâäåæçèéêëìíîïñòóôöøùúûüœ"
#: What a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¢": "c", "v": "u", "u": "v"}
SEPARATORS = ".-_*~' ,/\\:;^`"
LETTER_COST, LEET_COST, REPEAT_COST, SKIP_COST = 0.0, -1.0, -0.7, -0.5

_N = len(ALPHABET)
_INDEX = {c: i for i, c in enumerate(ALPHABET)}
_EDGE = re.compile(r"^[^\w@$!|+(€£¢]+|[^\w@$€£¢]+$")
_SIGN = re.compile(r"[0-9@$!|+(€£¢]")
_APART = re.compile(r"[^\W\d_](?:[^\w@$!|+(€£¢]|_)+[^\W\d_]")
_DOUBLE = re.compile(r"(\w)\1")
_SIGNS_OR_LETTERS = re.compile(r"^[\w@$!|+(€£¢]$")
_LETTER = re.compile(r"[^\W\d_]")


def _classes() -> dict[str, str]:
    """For each character that may stand for a letter, one letter for all that share a sign with it."""
    same = {c: c for c in ALPHABET}
    for sign, letters in LEET.items():
        group = {same[x] for x in letters} | ({same[sign]} if sign in same else set())
        same = {c: min(group) if k in group else k for c, k in same.items()}
    return same | {sign: same[letters[0]] for sign, letters in LEET.items()}


_CLASS = _classes()
#: Letters that are read as themselves only: after one, the state of the lattice is certain.
_CERTAIN = set(ALPHABET) - LEET.keys()


def disguised(word: str) -> bool:
    return bool((_SIGN.search(word) and _LETTER.search(word)) or _APART.search(word) or _DOUBLE.search(word))


def folded(word: str) -> str:
    """The classes of a word's letters, repeats once. All that the channel makes of a word folds alike."""
    return collapsed("".join(_CLASS.get(c, "") for c in word))


def decode(words: list[str], start: np.ndarray, step: np.ndarray, block: int = 64) -> list[str]:
    """The likeliest intended word of each observed word: Viterbi over all lattices at once.

    start, step: log-probabilities of a first letter and of a letter after a letter. Words are worked off in
    blocks that end behind a certain letter, from which the next block goes on; that changes no result."""
    pieces = []  # (word, text, state before it)
    for r, w in enumerate(words):
        state, begin = _N, 0
        while len(w) - begin > block:
            end = next((t for t in range(begin + block, len(w)) if w[t] in _CERTAIN), len(w) - 1) + 1
            if end == len(w):
                break
            pieces.append((r, w[begin:end], state))
            state, begin = _INDEX[w[end - 1]], end
        if w:
            pieces.append((r, w[begin:], state))
    order = sorted(range(len(pieces)), key=lambda i: len(pieces[i][1]))
    read = [""] * len(pieces)
    while order:
        n = max(1, min(512, (1 << 16) // max(1, len(pieces[order[min(511, len(order) - 1)]][1]))))
        some, order = order[:n], order[n:]
        for i, x in zip(some, _viterbi([pieces[i][1] for i in some], np.array([pieces[i][2] for i in some]), start, step)):
            read[i] = x
    out = [[] for _ in words]
    for (r, _, _), x in zip(pieces, read):
        out[r].append(x)
    return ["".join(x) for x in out]


def _viterbi(words: list[str], begin: np.ndarray, start: np.ndarray, step: np.ndarray) -> list[str]:
    """The letters read from each of ``words``, from the states ``begin`` on (_N: no letter yet)."""
    width, n = max(map(len, words)), len(words)
    best = np.full((n, _N + 1), -np.inf)
    best[np.arange(n), begin] = 0
    lens = np.array([len(w) for w in words])
    signs, sign = np.unique(np.array([list(w.ljust(width, "\0")) for w in words]).reshape(n, width), return_inverse=True)
    sign = sign.reshape(n, width)
    opens, skips = np.full((len(signs), _N + 1), -np.inf), np.full(len(signs), -np.inf)
    for r, c in enumerate(signs.tolist()):
        if c in _INDEX:
            opens[r, _INDEX[c]] = LETTER_COST
        for x in LEET.get(c, ""):
            opens[r, _INDEX[x]] = max(opens[r, _INDEX[x]], LEET_COST if c not in "uv" else -4.0)
        if c in SEPARATORS or (c not in _INDEX and c not in LEET):
            skips[r] = SKIP_COST
    # A sign opens few letters; only these are reached by a step (the state _N fills up the rows).
    few = np.argsort(opens == -np.inf, axis=1, kind="stable")[:, :max(1, int((opens > -np.inf).sum(axis=1).max()))]
    few[np.take_along_axis(opens, few, axis=1) == -np.inf] = _N
    slot = np.full((len(signs), _N + 1), -1, np.int8)  # a state's column in few
    np.put_along_axis(slot, few, np.broadcast_to(np.arange(few.shape[1], dtype=np.int8), few.shape), axis=1)
    slot[:, _N] = -1
    back = np.zeros((width, n, few.shape[1]), np.int8)  # -1: no new letter at this character
    into = np.vstack([np.vstack([step, start]).T, np.full((1, _N + 1), -np.inf)])
    for t in range(width):
        emit, skip, to = opens[sign[:, t]], skips[sign[:, t]], few[sign[:, t]]
        come = best[:, None, :] + into[to]
        frm = come.argmax(axis=2)
        full = np.full((n, _N + 1), -np.inf)
        np.put_along_axis(full, to, np.take_along_axis(come, frm[:, :, None], axis=2)[:, :, 0], axis=1)
        full += emit
        stay = best + REPEAT_COST + emit
        stay = np.maximum(stay, best + skip[:, None])
        live = (t < lens)[:, None]
        back[t] = np.where(np.take_along_axis((stay >= full) | ~live, to, axis=1), -1, frm)
        best = np.where(live, np.maximum(stay, full), best)
    state = best.argmax(axis=1)
    letters = [[] for _ in words]
    for t in range(width - 1, -1, -1):
        for r in range(n):
            if t < lens[r] and (k := slot[sign[r, t], state[r]]) >= 0 and back[t, r, k] >= 0:
                letters[r].append(ALPHABET[state[r]])
                state[r] = back[t, r, k]
    return ["".join(reversed(x)) for x in letters]


def token_word(token: str) -> str:
    """A token without the signs at its edges."""
    w = token.rstrip(".,")
    return w if w.isalpha() else _EDGE.sub("", token)


def observed(text: str) -> tuple[set[str], set[str]]:
    """(plain words, disguised words) of a whole text; letters set apart by blanks are one disguised word."""
    tokens = text.lower().split()
    plain, hidden = set(), set()
    for t in set(tokens):
        if w := token_word(t):
            (hidden if disguised(w) else plain).add(w)
    hidden.update(runs(tokens))
    return plain, hidden


def runs(tokens: list[str]) -> list[str]:
    """Runs of three or more tokens of one letter, or of a letter with a stop behind it."""
    sizes, out, run = list(map(len, tokens)), [], []
    if 1 in sizes and b"\1\1\1" in bytes(map((3).__gt__, sizes)):
        for w in [*tokens, "   "]:
            if len(w) == 2:
                w = _EDGE.sub("", w)  # a letter with a stop behind it
            if len(w) == 1 and _SIGNS_OR_LETTERS.match(w):
                run.append(w)
            else:
                if len(run) >= 3:
                    out.append("".join(run))
                run = []
    return out


def features(word: str) -> list[str]:
    return [word, *[f"{word[:k]}*" for k in (4, 5, 6) if len(word) > k]]


def collapsed(word: str) -> str:
    return re.sub(r"(.)\1+", r"\1", word)


class Restorer:
    """Plain and restored words of texts that may have a weight. A repeat and a double letter look alike on the
    channel, so a restored word that equals a learned word but for doubled letters is read as that word.

    A word can begin and end at any separator of a token, and anywhere in a run of letters set apart by blanks. Only
    places that fold like a learned word or prefix are decoded, which leaves out nothing. ``usual`` holds plain words
    with a doubled letter that are not to be read as another word."""

    def __init__(self, start, step, lexicon, usual=()):
        self.start, self.step, self.known, self.lexicon, self.usual = np.array(start), np.array(step), {}, lexicon, set(usual)
        self.heads = {f[:4] for f in lexicon}
        self.doubled = {collapsed(w): w for w in sorted(lexicon) if not w.endswith("*")}
        self.whole = {folded(w) for w in self.doubled.values()} - {""}
        self.front = {folded(h) for h in self.heads} - {""}
        self.whole_sizes, self.front_sizes = sorted(set(map(len, self.whole))), sorted(set(map(len, self.front)))

    def places(self, word: str, apart: bool) -> list[list[tuple[int, str, str]]]:
        """For each place where a learned word may begin: (first folded letter, observed characters, what follows them)."""
        fold, at, starts, ends, fresh = [], [], [], {}, True
        for p, c in enumerate(word):
            if (k := _CLASS.get(c)) is None:
                fresh = True
                continue
            if fresh and fold:
                ends[len(fold)] = last + 1
            if not fold or fold[-1] != k:
                fold.append(k)
                at.append(p)
            if fresh or apart:
                starts.append((len(fold) - 1, p))
            if apart:
                ends[len(fold)] = p + 1
            last, fresh = p, False
        if not fold:
            return []
        ends[len(fold)] = len(word)
        line, out = "".join(fold), []
        for i, p in starts:
            if not any(line[i:i + n] in self.front for n in self.front_sizes):
                continue
            found = [(i, word[p:ends[i + n]], "") for n in self.whole_sizes if i + n in ends and line[i:i + n] in self.whole]
            # A prefix is settled by a certain letter behind it; what follows that letter cannot change it.
            end = next((q + 1 for q in range(at[i + 7], len(word)) if word[q] in _CERTAIN), len(word)) if i + 7 < len(at) else len(word)
            out.append([*found, (i, word[p:end], "" if end == len(word) else "\0")])
        return out

    def weight(self, word: str) -> tuple[float, str]:
        return max(((self.lexicon[f], f) for f in features(word) if f in self.lexicon), default=(0.0, ""))

    def restore(self, words: list[tuple[str, bool]]) -> list[set[str]]:
        """The weighted words in disguised words; the flag tells runs of letters set apart."""
        found = [self.places(w, apart) for w, apart in words]
        some = list({x for each in found for place in each for _, x, _ in place})
        read = dict(zip(some, decode(some, self.start, self.step)))
        out = []
        for (w, apart), each in zip(words, found):
            got, done = set(), 0
            if not apart and not any(i == 0 for place in each for i, _, _ in place):
                each = [[], *each]
            for n, place in enumerate(each):
                options = []
                for i, x, more in place:
                    x = read[x] if more else self.doubled.get(collapsed(read[x]), read[x])
                    weight, f = self.weight(x + more)
                    options.append((weight, i + len(folded(f.rstrip("*"))), x + more))
                if n == 0 and not apart:  # as it stands
                    weight, f = self.weight(w)
                    options.append((weight, len(folded(f.rstrip("*"))), w))
                weight, end, x = max(options)
                if weight and end > done:
                    got.add(x)
                    done = end
            out.append(got)
        return out

    def words(self, texts: list[str | None]) -> list[set[str]]:
        split = [(t or "").lower().split() for t in texts]
        if len(self.known) > 200_000:
            self.known = {}
        distinct, known = [set(x) for x in split], self.known
        new = set().union(*distinct) - known.keys() if distinct else set()
        hidden, plain = [], {}
        for t in new:
            w = token_word(t)
            if w and w not in self.usual and disguised(w):
                hidden.append((t, w))
            else:
                plain[t] = {w} if w[:4] in self.heads else ()
        plain.update(zip([t for t, _ in hidden], self.restore([(w, False) for _, w in hidden])))
        known.update(plain)
        apart = [runs(x) for x in split]
        spaced = iter(self.restore([(w, True) for x in apart for w in x]))
        out = [set().union(*[known[t] for t in d if known[t]], *[next(spaced) for _ in a]) for d, a in zip(distinct, apart)]
        for t in new:
            if len(t) > 1000:
                del known[t]
        return out


def bigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter after letter (row _N: first letters of a word) over all documents."""
    def count(batches):
        lut = np.full(0x110000, _N, np.int64)
        for c, i in _INDEX.items():
            lut[ord(c)] = lut[ord(c.upper()) if len(c.upper()) == 1 else ord(c)] = i
        total = np.zeros((_N + 1) ** 2, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    s = lut[np.frombuffer((" " + text).encode("utf-32-le", "surrogatepass"), np.uint32)]
                    total += np.bincount(s[:-1] * (_N + 1) + s[1:], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(some), "n": pa.array(total[some])})

    out = np.zeros((_N + 1) ** 2)
    rows = docs.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    for r in rows:  # at most (alphabet + 1) squared rows
        out[r.pair] = r.n
    return out.reshape(_N + 1, _N + 1)


def language_model(counts: np.ndarray, lexicon: list[str], share: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities (first letter, letter after letter): the corpus's counts, mixed with the learned words'."""
    def norm(c):
        c = c[:, :_N] + 0.05
        return c / c.sum(axis=1, keepdims=True)

    own = np.zeros_like(counts)
    for w in lexicon:
        s = [_INDEX.get(c, _N) for c in " " + w]
        for a, b in zip(s, s[1:]):
            own[a, b] += 1
    p = np.log((1 - share) * norm(counts) + share * norm(own)) if lexicon else np.log(norm(counts))
    return p[_N], p[:_N]


def learn_weights(rows: DataFrame, min_docs: int = 5, min_weight: float = 1.0, max_features: int = 5000) -> dict[str, float]:
    """Shrunken log-odds of word and prefix features from ``rows`` (text, toxic)."""
    def count(batches):
        for batch in batches:
            pos, neg = {}, {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                into = pos if toxic else neg
                plain, hidden = observed(text or "")
                for f in {f for w in plain | hidden for f in features(w)}:
                    into[f] = into.get(f, 0) + 1
            keys = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_pydict({"f": pa.array(keys, pa.string()), "pos": pa.array([pos.get(k, 0) for k in keys], pa.int64()),
                                              "neg": pa.array([neg.get(k, 0) for k in keys], pa.int64())})

    sizes = {int(r.toxic): r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return {}
    p, n = F.col("pos") + 0.5, F.col("neg") + 0.5
    weight = F.log(p / F.lit(n_pos + 1.0)) - F.log(n / F.lit(n_neg + 1.0)) - 1.5 * F.sqrt(1 / p + 1 / n)
    found = (rows.select("text", "toxic").mapInArrow(count, "f string, pos long, neg long")
             .groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .where(F.col("pos") >= min_docs).withColumn("w", weight).where(F.col("w") > min_weight)
             .orderBy(F.desc("w"), "f").limit(max_features).collect())
    return {r.f: r.w for r in found}


def usual_words(rows: DataFrame, weights: dict[str, float], max_words: int = 5000) -> list[str]:
    """Words of ``rows`` (text, toxic) with a doubled letter that fold like a learned word or prefix, but stand in two or
    more documents that are not toxic and in no larger share of the toxic ones: 'looser' is not a disguised 'loser'."""
    known = Restorer([], [], weights)

    def count(batches):
        for batch in batches:
            pos, neg = {}, {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                into = pos if toxic else neg
                for w in {token_word(t) for t in set((text or "").lower().split())}:
                    if w.isalpha() and _DOUBLE.search(w) and w not in weights and known.places(w, False):
                        into[w] = into.get(w, 0) + 1
            keys = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_pydict({"w": pa.array(keys, pa.string()), "pos": pa.array([pos.get(k, 0) for k in keys], pa.int64()),
                                              "neg": pa.array([neg.get(k, 0) for k in keys], pa.int64())})

    sizes = {int(r.toxic): r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    found = (rows.select("text", "toxic").mapInArrow(count, "w string, pos long, neg long")
             .groupBy("w").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .where((F.col("neg") >= 2) & (F.col("neg") * sizes.get(1, 0) >= F.col("pos") * sizes.get(0, 0)))
             .orderBy(F.desc("neg"), "w").limit(max_words).collect())
    return [r.w for r in found]


def evidence(words: set[str], weights: dict[str, float], heads: set[str]) -> tuple[float, float]:
    """(largest weight, sum of weights up to 20) of a document's words; a word counts with its best feature.
    ``heads`` holds the first letters of all features, as many as the shortest prefix has: other words have none."""
    each = sorted(max(x) for x in ([weights[f] for f in features(w) if f in weights] for w in words if w[:4] in heads) if x)
    return (each[-1], min(20.0, sum(each))) if each else (0.0, 0.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; the last coefficient is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def fit(docs: DataFrame, labelled: DataFrame, train_rows: int = 20_000) -> dict:
    """A model from all of ``docs`` (bigrams) and a bounded sample of ``labelled`` (doc_id, text, toxic)."""
    labelled = labelled.where("toxic IS NOT NULL").select("doc_id", "text", "toxic")
    n = labelled.agg(F.count("*"), F.coalesce(F.avg("toxic"), F.lit(0.0))).first()
    model = {"weights": {}, "coef": [0.0, 0.0], "const": 0.0, "start": None, "step": None, "usual": [], "flat": float(n[1])}
    if n[0] > train_rows:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(train_rows / n[0] * (1 << 30)))
    labelled = stage(labelled, "toxicity-labelled")  # read three times; the join with the texts runs once
    model["weights"] = learn_weights(labelled)
    start, step = language_model(bigram_counts(docs), [w for w in model["weights"] if not w.endswith("*")])
    model["start"], model["step"] = start.tolist(), step.tolist()
    if model["weights"]:
        model["usual"] = usual_words(labelled, model["weights"])
        seen = _score_rows(labelled, ["toxic"], model, raw=True).select("toxic", "top", "total").collect()  # at most train_rows rows
        x, y = np.array([[r.top, r.total] for r in seen]), np.array([float(r.toxic) for r in seen])
        b = logistic(x, y)
        model |= {"coef": b[:2].tolist(), "const": float(b[2])}
    return model


def _score_rows(docs: DataFrame, keep: list[str], model: dict, raw: bool = False) -> DataFrame:
    key = hashlib.sha256(json.dumps(model, sort_keys=True).encode()).hexdigest()

    def run(batches):
        cache = worker_cache()
        if cache.get("restorer", (None,))[0] != key:
            cache["restorer"] = (key, Restorer(model["start"], model["step"], model["weights"], model["usual"]))
        restorer = cache["restorer"][1]
        for batch in batches:
            found = [evidence(w, model["weights"], restorer.heads) for w in restorer.words(batch.column("text").to_pylist())]
            cols = [batch.column(c) for c in keep]
            if raw:
                yield pa.RecordBatch.from_arrays([*cols, pa.array([a for a, _ in found], pa.float64()), pa.array([b for _, b in found], pa.float64())], [*keep, "top", "total"])
            else:
                score = [1 / (1 + math.exp(-max(-30, min(30, model["coef"][0] * a + model["coef"][1] * b + model["const"])))) for a, b in found]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(score if model["weights"] else [model["flat"]] * len(found), pa.float64())], [*keep, "score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(run, schema + (", top double, total double" if raw else ", score double"))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score for every row of ``docs`` (doc_id, text)."""
    return _score_rows(docs, ["doc_id"], model)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0)).select("doc_id", "toxic")
    model = fit(docs, docs.join(labels, "doc_id"))
    return score(docs, model).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
