"""The operators against brute force on sf0.001, and on odd rows, empty tables and planted cases."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listenscape.llm import (common, cover_tree, decontaminate, langid, line_dedup, minhash, quality, queries, sample_pieces,
                             suffix_dedup, token_orc, toxicity)


@pytest.fixture(scope="module", autouse=True)
def options(spark):
    common.configure(spark)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r.doc_id: r.text for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


def run(spark, sf_dir, name):
    return {r[0]: tuple(r)[1:] for r in queries.QUERIES[name](spark, sf_dir).collect()}


def test_op1_equals_brute_force(spark, sf_dir, docs):
    seen, want = set(), {}
    for i, t in sorted(docs.items()):
        b = (t or "").encode()
        m = np.zeros(len(b) + 1, int)
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if w in seen:
                m[s] += 1
                m[s + 100] -= 1
            seen.add(w)
        g = np.cumsum(m)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~g].tobytes()
        want[i] = (len(b), int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    assert run(spark, sf_dir, "op1_suffix_dedup") == want


def test_op1_pieces_and_hot_hashes_agree(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    plain = sorted(map(tuple, suffix_dedup.dedup(docs).collect()))
    assert sorted(map(tuple, suffix_dedup.dedup(docs, piece_bytes=2000, hot_runs=2).collect())) == plain


def test_suffix_order_and_prefixes():
    data = np.frombuffer(b"abracadabra" * 30 + b"abracadabrx" * 20, np.uint8)
    room = len(data) - np.arange(len(data))
    order, _ = suffix_dedup.suffix_order(data, room, 100)
    raw = data.tobytes()
    assert [raw[p:p + 100] for p in order] == sorted(raw[p:p + 100] for p in range(len(raw) - 99))
    lcp = suffix_dedup.common_prefixes(data, room, order)
    for k in range(1, len(order)):
        a, b = raw[order[k]:], raw[order[k - 1]:]
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_op2_held_out_accuracy(spark, sf_dir):
    got = queries.QUERIES["op2_language_id"](spark, sf_dir).join(common.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert held[0] > 0.95 and held[1] >= 0 and held[2] <= 1


def test_op3_equals_brute_force(spark, sf_dir, docs):
    sets = {}
    for i, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert run(spark, sf_dir, "op3_minhash") == {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def _hub_and_copies(n_words: int, n_copies: int, changed: tuple[int, int], seed: int) -> list[str]:
    """A text and copies of it with ``changed`` words replaced; then 30 copies that are one another's near copies."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(n_words)]

    def copy(words, n, own):
        words = list(words)
        for k in rng.choice(len(words), n, replace=False):
            words[k] = f"{own}n{rng.integers(1000)}"
        return words

    out = [base, *(copy(base, int(rng.integers(*changed)), f"c{i}") for i in range(n_copies))]
    second = copy(base, changed[1], "second")
    return [" ".join(w) for w in [*out, *(copy(second, n_words // 50, f"s{i}") for i in range(30))]]


def _linked_components(texts: list[str]) -> list[int]:
    sets = [set(zip(w, w[1:])) for w in map(str.split, texts)]
    label = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = len(x & y)
            if label[i] != label[j] and 100 * both >= 80 * (len(x) + len(y) - both):
                a, b = sorted((label[i], label[j]))
                label = [a if v == b else v for v in label]
    return label


def test_op3_copies_that_miss_the_threshold_make_no_square_of_pairs(spark, monkeypatch):
    texts = _hub_and_copies(150, 300, (6, 12), 3)
    made, links = [], minhash._Confirm.links
    monkeypatch.setattr(minhash._Confirm, "links", lambda self, pairs: (made.append(pairs.distinct().count()), links(self, pairs))[1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, width=2).collect()}
    assert got == dict(enumerate(_linked_components(texts)))
    assert sum(made) < 10 * len(texts), made


def test_op3_differences_are_counted_for_each_hub(spark, monkeypatch):
    """A shingle that few members of a hub lack is rare there, though the members of another hub hold it."""
    rng = np.random.default_rng(11)
    whole = [f"w{i}" for i in range(120)]

    def copies(words, n):
        out = [" ".join(words)]
        for k in range(n):
            t = list(words)
            for at in rng.choice(len(t), max(2, len(t) // 12), replace=False):
                t[at] = f"n{rng.integers(1 << 40)}"
            out.append(" ".join(t))
        return out

    texts = copies(whole, 400) + copies(whole[:70], 150)
    made, late = [], minhash._Confirm.late
    monkeypatch.setattr(minhash._Confirm, "late", lambda self, x, y: (made.append(late(self, x, y).count()), late(self, x, y))[1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, width=5).collect()}
    sets, label = [minhash.hasher().shingles(t.encode(), 5) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if v == b else v for v in label]
    assert got == dict(enumerate(label))
    assert sum(made) < 2 * len(texts), made


@pytest.mark.parametrize("seed", range(2))
def test_op3_differences_lose_no_link(spark, seed):
    """All links of one bucket between members of different components come from differences they share."""
    texts = _hub_and_copies(60, 40, (1, 9), seed) + ["w1 w2", "w1 w2 w3 far away", "far away w9 w10"]
    rng = np.random.default_rng(seed)
    texts += [" ".join(np.delete(t.split(), rng.choice(30, n, replace=False))) for t in texts[:40:4] for n in (2, 7)]
    hasher = minhash.hasher()
    sets = {i: hasher.shingles(t.encode(), 2) for i, t in enumerate(texts)}
    df = Counter(x for s in sets.values() for x in s.tolist())
    ids = sorted(sets)[1:]
    lists = {i: (s.view(np.int64).tolist(), [df[x] for x in s.tolist()]) for i, s in sets.items()}
    batch = pa.RecordBatch.from_pydict({"pivot": [0] * len(ids), "rep": ids, "members": [len(ids)] * len(ids), "tokens": [lists[i][0] for i in ids], "df": [lists[i][1] for i in ids],
                                        "tokens_p": [lists[0][0]] * len(ids), "df_p": [lists[0][1]] * len(ids)})
    rows = [r for b in minhash._prefixes(80)(iter([batch])) for r in b.to_pylist()]
    found = {tuple(sorted((x["rep"], y["rep"]))) for x in rows for y in rows
             if x["token"] == y["token"] and x["index"] and y["probe"] and (x["w"], x["rep"]) < (y["w"], y["rep"])
             and x["w"] + y["w"] - x["slack"] <= 180 * min(x["d"] - x["pos"], y["d"] - y["pos"])}

    def link(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)

    wanted = {(i, j) for j in ids for i in ids if i < j and link(i, j) and not (link(i, 0) and link(j, 0))}
    assert len(wanted) > 100 and wanted <= found


def test_near_dedup_stage_keeps_rows_without_id_and_texts_that_share_one(spark, sf_dir):
    a, b, c = ("".join(f"{w}{i} " for i in range(30)) for w in ("apple", "berry", "cherry"))
    rows = [(None, a), (None, a), (None, c), (1, a), (2, a), (2, b), (2, b), (3, b.upper()), (4, c), (4, "short one"), (5, None), (5, ""), (5, " ")]
    odd = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text) for r in minhash.pipeline_stage(spark, odd, sf_dir).collect())
    assert got == Counter([(None, a), (None, a), (None, c), (1, a), (2, b), (4, c), (4, "short one"), (5, None), (5, ""), (5, " ")])


def test_op4_round_trip_distinct_and_repeatable(spark, sf_dir):
    rows = queries.QUERIES["op4_sample_pieces"](spark, sf_dir).collect()
    again = queries.QUERIES["op4_sample_pieces"](spark, sf_dir).repartition(5).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert all(r.round_trip and 0 <= r.inclusion <= 1 for r in rows)
    assert len({(r.doc_id, r.ids_crc32) for r in rows if r.n_ids > 20}) == sum(r.n_ids > 20 for r in rows)


def test_op4_samples_without_replacement_follow_the_lattice():
    pieces = sample_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    lat = sample_pieces.Lattices(["\ud800there"], pieces)
    every = {}

    def go(s, ids, p):
        if lat.is_end[s]:
            every[ids] = p
        else:
            for e in range(lat.first[s], lat.first[s + 1]):
                go(lat.to[e], (*ids, int(lat.piece[e])), p * lat.q[e])

    go(0, (), 1.0)
    assert abs(sum(every.values()) - 1) < 1e-9
    n = 4000
    found = sample_pieces.segment(["there"] * n, sample_pieces.row_keys(list(range(n))), pieces, 2)
    first, second = (Counter(tuple(x[k][0].tolist()) for x in found) for k in (0, 1))
    for ids in sorted(every, key=every.get)[-3:]:
        p = every[ids]
        assert abs(first[ids] / n - p) < 0.03
        assert abs(second[ids] / n - sum(every[o] * p / (1 - every[o]) for o in every if o != ids)) < 0.03
    assert abs(np.mean([sum(np.exp(s[1]) / s[2] for s in x) for x in found]) - 1) < 0.05


def test_op4_hashes_that_share_a_slot_are_told_apart():
    rng = np.random.default_rng(4)
    for size in (0, 1, 3, 5000):
        known = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        table = sample_pieces.Hashes(known)
        x = rng.permutation(np.concatenate([known, rng.integers(0, 1 << 64, 20000, dtype=np.uint64)]))
        where, place = table.find(x)
        assert (where == np.flatnonzero(np.isin(x, known))).all() and (known[place] == x[where]).all()
    assert table.shared.sum() > 10


def test_op4_draws_of_a_turn_are_made_at_once(monkeypatch):
    calls, uniform = [], sample_pieces.uniform
    monkeypatch.setattr(sample_pieces, "uniform", lambda *parts: (calls.append(1), uniform(*parts))[1])
    pieces = sample_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    found = sample_pieces.segment(["some plain words"] * 200, np.arange(200, dtype=np.uint64), pieces, 2)
    assert all(len(f) == 2 for f in found)
    assert len(calls) < 100  # by steps of the walk, not by texts


def test_op4_long_texts_have_one_search(monkeypatch):
    import pyarrow as pa

    pieces = sample_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(7, "there were three others " * 20)]
    want = sample_pieces.table_of(rows, pieces, 3, True, pa.int64()).to_pylist()
    monkeypatch.setattr(sample_pieces, "CHUNK_CHARS", 50)
    assert sample_pieces.table_of(rows, pieces, 3, True, pa.int64()).to_pylist() == want
    assert len(want) == 3 and all(r["round_trip"] for r in want)


def test_op4_long_words_and_runs_of_blanks_have_whole_lattices():
    pieces = sample_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    piece_of = {i: t.decode() for i, t in enumerate(pieces.text) if t.isascii()}
    for text, across in [("there" * 15, 48), ("a" + " " * 6 + "b  c ", 3), ("  x", 2)]:
        seen, logp = {}, {}
        for key in range(600):
            for ids, p, _ in sample_pieces.segment([text], sample_pieces.row_keys([key]), pieces, 2)[0]:
                assert pieces.decode(ids).decode() == text
                cuts = set(np.cumsum([len(piece_of[i]) for i in ids.tolist()]).tolist())
                seen[tuple(ids.tolist())] = cuts
                logp[tuple(ids.tolist())] = p
        assert any(across not in c for c in seen.values()), text  # a piece goes across this place
        assert sum(map(np.exp, logp.values())) < 1 + 1e-9
    assert sum(map(np.exp, logp.values())) > 0.99  # all segmentations of the last text


def test_op5_equals_brute_force(spark, sf_dir, docs):
    posted, sets, seen, want = {}, [], set(), {}
    for i, t in sorted(docs.items()):
        kept, n, gone = [], 0, 0
        for line in (t or "").split("\n"):
            w = [x for x in line.split(" ") if x]
            if not w:
                kept.append(line)
                continue
            n += 1
            s = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))
            hits = Counter(j for g in s for j in posted.get(g, ()))
            if line in seen or any(5 * m >= 4 * (len(s) + len(sets[j]) - m) for j, m in hits.items()):
                gone += 1
            else:
                kept.append(line)
            if line not in seen:
                seen.add(line)
                for g in s:
                    posted.setdefault(g, []).append(len(sets))
                sets.append(s)
        want[i] = (n, gone, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    assert run(spark, sf_dir, "op5_line_dedup") == want


def test_op5_is_native(spark, sf_dir):
    plan = line_dedup.classes_of(common.table(spark, sf_dir, "documents").withColumn("x", F.lit(1)), F.col("doc_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op5_parity_bits_bound_what_sets_differ_in(spark):
    rng = np.random.default_rng(5)
    pool = rng.integers(-(1 << 63), (1 << 63) - 1, 60)
    sets = [sorted(int(x) for x in rng.choice(pool, size, replace=False)) for size in (0, 1, 20, 30, 40, 50, 60)]
    rows = spark.createDataFrame(list(enumerate(sets)), "i int, set array<long>").select("i", *line_dedup._parities("set")).collect()
    bits = {r.i: (r.even & (1 << 64) - 1) << 64 | r.odd & (1 << 64) - 1 for r in rows}
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert (bits[i] ^ bits[j]).bit_count() <= len(set(x) ^ set(y))
    assert all(bits[i].bit_count() > 0 for i in range(1, len(sets)))


def test_op5_lines_that_cannot_match_are_not_carried_to_their_sets(spark, monkeypatch):
    """Lines of 68 words, 50 of which they share: pairs of them share prefixes, and none matches."""
    common_words = " ".join(f"same{k}" for k in range(50))
    rows = [(i, common_words + "".join(f" own{i}x{k}" for k in range(18))) for i in range(60)]
    carried, verified = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_ranks", lambda classes, width: F.array_repeat(F.lit(0).cast("long"), line_dedup.BINS))
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, known, percent: (carried.append(pairs.count()), verified(pairs, known, percent))[1])
    done = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert done.where("n_kept <> 1").count() == 0
    assert 59 <= carried[0] < 600 and carried[1] < 60  # the stars' pairs, then the late ones


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    def blocks():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in found.mkString(" ").split() if b.startswith("shuffle_")}

    df, before = spark.range(1000).repartition(7, "id"), blocks()
    with common.shuffles_end_with_query(spark):
        df.write.parquet(str(tmp_path / "out"))
    for _ in range(100):
        if not blocks() - before:
            break
        time.sleep(0.1)
    assert not blocks() - before
    assert spark.read.parquet(str(tmp_path / "out")).count() == df.count() == 1000


def test_op6_reads_disguised_words():
    counts = np.ones((toxicity._N + 1, toxicity._N + 1))
    start, step = toxicity.language_model(counts, ["idiot", "moron", "loser", "scum", "trash"])
    assert toxicity.decode(["1d10t", "idiooot", "m0r0n", "l0s3r", "sc.u.m", "tr@sh", "s-c-u-m"], start, step) == \
        ["idiot", "idiot", "moron", "loser", "scum", "trash", "scum"]
    plain, hidden = toxicity.observed("you i d i o t, fine words here")
    assert "idiot" in hidden and "words" in plain


def toxic_words():
    counts = np.ones((toxicity._N + 1, toxicity._N + 1))
    lexicon = {f: 2.0 for w in ["idiot", "moron", "loser", "scum"] for f in (w, w[:4] + "*") if len(w) > 4 or f == w}
    start, step = toxicity.language_model(counts, [w for w in lexicon if not w.endswith("*")])
    return toxicity.Restorer(start, step, lexicon, ["looser"])


def test_op6_gate_passes_partly_separated_and_doubled_words():
    for text, want in [("a sc.u.m here", {"scum"}), ("mo.ron", {"moron"}), ("id-iot!", {"idiot"}), ("moorroon", {"moron"}),
                       ("idiioott,", {"idiot"}), ("l'idiot", {"idiot"}), ("looser or well-known or mo.re", set()), ("sc\u200bum", {"scum"})]:
        assert toxic_words().words([text]) == [want], text


def test_op6_words_inside_runs_and_behind_character_64():
    long = "x/" * 40
    for text, want in [("such a m o r o n", {"moron"}), ("y o u a r e a n i d i o t", {"idiot"}), ("y o u 1 d 1 0 t s c u m", {"idiot", "scum"}),
                       ("b c " * 30 + "a m o r o n", {"moron"}), ("b " * 62 + "m o r o n", {"moron"}), ("l" + "o" * 70 + "ser", {"loser"}),
                       (long + "m0r0n", {"moron"}), ("ab-" * 30 + "id-iot", {"idiot"}), ("x" * 90 + "/l0ser", {"loser"})]:
        assert toxic_words().words([text]) == [want], text


def test_op6_blocks_change_no_reading():
    r = toxic_words()
    words = ["1d10t-" * 30 + "m0r0n", "l" + "o" * 200 + "s3r", "uv1" * 60, "a.b.c" * 40]
    assert toxicity.decode(words, r.start, r.step, block=7) == toxicity.decode(words, r.start, r.step, block=10_000)


def test_op6_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES["op6_toxicity"](spark, d).join(common.table(spark, d, "labels"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0] > 0.9


def test_op7_equals_whole_text_encoding(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, want = 0, {}
    for i in sorted(docs):
        ids = [*t.encode(docs[i] or "", add_special_tokens=False).ids, 1]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert run(spark, sf_dir, "op7_token_orc") == want


def test_op7_words_with_punctuation_take_no_call_each(monkeypatch):
    """Words of visible ASCII are encoded by their pre-tokens, many in a call; letters that do not stay letters are not cut from a stop."""
    from tokenizers import Tokenizer

    texts = ["it's (here); don't've 'STOP' --s a1b2 x;y 'tis ''ve {end}", "caf\u00e9. \u0130. \u0958, A<|endoftext|>b \u0130", None, "", " \n"]
    path = public_tokenizers.path("word_bpe_49k.json")
    t, alone, each = Tokenizer.from_file(path), [], token_orc.WordIds.encode_each
    monkeypatch.setattr(token_orc.WordIds, "encode_each", lambda self, words: (alone.extend(words), each(self, words))[1])
    got = token_orc.WordIds(path).encode(texts, 1)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]
    assert not [w for w in alone if w.isascii() and "<" not in w], alone


def test_op7_odd_words_and_lookup(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = ["İstanbul don't.. A.B, ΣΑΣ x́ é<|endoftext|> 12,3.", " tab\there em", "...", "."]
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = token_orc.WordIds(path).encode(texts, 1)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [[*t.encode(x, add_special_tokens=False).ids, 1] for x in texts]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    token_orc.write(docs, str(tmp_path / "orc"), path)
    assert [r.doc_id for r in token_orc.lookup(spark, str(tmp_path / "orc"), [2]).collect()] == [2]


def test_op8_equals_brute_force(spark, sf_dir, docs):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    windows = {}
    for r in common.table(spark, sf_dir, "benchmark").collect():
        w = words(r.text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(r.item_id))
    sizes = {len(x) for x in windows}
    want = {}
    for i, t in docs.items():
        w, hit, items = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in windows:
                    hit |= set(range(k, k + n))
                    items |= windows[x]
        want[i] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    got = run(spark, sf_dir, "op8_decontaminate")
    assert {i: r[:5] for i, r in got.items()} == want
    assert all(sum(len(words(docs[i][s.start:s.end])) for s in r[5]) == r[1] for i, r in got.items())


def test_op8_spans_and_blocks(spark):
    docs = spark.createDataFrame([(1, "Ähm — say: ONE two, three! four. end"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "one two three"), (6, "three four"), (7, "")], "item_id long, text string")
    for block in (64 << 20, 20):
        got = {r.doc_id: r for r in decontaminate.hits(docs, bench, window=3, block_bytes=block).collect()}
        assert got[1]["items"] == ["5", "6"] and got[1].n_hit == 4 and got[2].n_words == 0
        (span,) = got[1].spans
        assert "Ähm — say: ONE two, three! four. end"[span.start:span.end] == "ONE two, three! four"


def test_op9_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES["op9_quality"](spark, d).join(common.table(spark, d, "labels"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.9


def test_op10_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(40, 16))
    x = np.concatenate([np.repeat(centre, 10, axis=0) + rng.normal(size=(400, 16)) * 0.25, np.repeat(centre[:1], 60, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.link_groups(df, block_rows=64).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    label = np.arange(len(x))
    while True:
        new = np.array([label[r].min() for r in near])
        if (new == label).all():
            break
        label = new
    assert got == {i: (int(near[i].sum()) - 1, int(label[i])) for i in range(len(x))} | {i: (0, i) for i in range(900, 905)}


def test_odd_rows(spark, odd_docs, sf_dir, tmp_path):
    n = odd_docs.count()
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    one = suffix_dedup.dedup(odd_docs)
    assert one.count() == n and one.where("doc_id = 7").first().n_removed > 100_000
    assert langid.predict(odd_docs, langid.fit(odd_docs)).where("doc_id in (3, 4, 5)").select("lang_pred").distinct().collect()[0][0] == "und"
    three = {r.doc_id: r.component_id for r in minhash.near_duplicates(odd_docs).collect()}
    assert three[2] == 1 and three[7] == 6 and three[3] == 3 and three[5] == 5
    four = sample_pieces.sample(odd_docs, public_tokenizers.path("piece_bpe_32k.model"))
    assert four.where("NOT round_trip").count() == 0 and four.select("doc_id").distinct().count() == 8
    assert line_dedup.pipeline_stage(spark, odd_docs, sf_dir).where("doc_id = 2").count() == 0
    assert line_dedup.pipeline_stage(spark, odd_docs, sf_dir).where("doc_id in (3, 4, 5)").count() == 3
    assert toxicity.score(odd_docs, toxicity.fit(odd_docs, odd_docs.join(labels, "doc_id"))).count() == n
    token_orc.write(odd_docs, str(tmp_path / "orc"), public_tokenizers.path("word_bpe_49k.json"))
    assert token_orc.read_offsets(spark, str(tmp_path / "orc")).count() == n
    assert decontaminate.pipeline_stage(spark, odd_docs, sf_dir).count() == n
    assert quality.score(odd_docs, quality.fit(odd_docs, labels), ["doc_id"]).count() == n


def test_empty_tables(spark, odd_docs, sf_dir, tmp_path):
    none = odd_docs.where("doc_id < 0")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert suffix_dedup.dedup(none).count() == 0
    assert langid.predict(none, langid.fit(none)).count() == 0
    assert minhash.near_duplicates(none).count() == 0
    assert line_dedup.dedup(none).count() == 0
    assert cover_tree.link_groups(vectors).count() == 0
    token_orc.write(none, str(tmp_path / "orc"), public_tokenizers.path("word_bpe_49k.json"))
    assert token_orc.read_offsets(spark, str(tmp_path / "orc")).count() == 0
    bench = common.table(spark, sf_dir, "benchmark")
    assert decontaminate.hits(none, bench).count() == 0
    assert decontaminate.hits(odd_docs, bench.limit(0)).where("n_hit > 0 OR size(items) > 0").count() == 0
    assert sample_pieces.sample(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(none, toxicity.fit(none, none.join(labels, "doc_id"))).count() == 0
    assert quality.score(none, quality.fit(none, labels), ["doc_id"]).count() == 0
    assert line_dedup.pipeline_stage(spark, none, sf_dir).count() == 0


def test_rows_without_id_and_rows_that_share_one(spark, sf_dir, tmp_path):
    """Operators 1, 5, 7, 8 and 10: null keys, and different rows under one key."""
    a, b, c = ("".join(f"{w}{i} " for i in range(30)) for w in ("apple", "berry", "cherry"))
    rows = [(None, a), (3, a), (1, a + b), (1, c), (1, "x"), (1, "yy"), (1, None), (None, "short")]
    odd = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    one = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.dedup(odd).collect())
    shared = len(a.encode())
    assert one == Counter([(None, shared, 0), (None, 5, 0), (3, shared, shared), (1, len((a + b).encode()), shared),
                           (1, len(c.encode()), 0), (1, 1, 0), (1, 2, 0), (1, 0, 0)])

    five = Counter((r.doc_id, r.text) for r in line_dedup.pipeline_stage(spark, odd, sf_dir).collect())
    assert five == Counter([(None, a), (None, "short"), (1, a + b), (1, c), (1, "x"), (1, "yy"), (1, None)])

    path = public_tokenizers.path("word_bpe_49k.json")
    token_orc.write(odd, str(tmp_path / "orc"), path)
    files = sorted((tmp_path / "orc").glob("*.orc"))
    ids = [(r.doc_id, r.ids) for f in files for r in spark.read.orc(str(f)).coalesce(1).collect()]
    want, at = Counter(), 0
    for i, x in ids:
        want[(i, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))] += 1
        at += len(x)
    assert len(ids) == len(rows) and Counter(map(tuple, token_orc.read_offsets(spark, str(tmp_path / "orc")).collect())) == want

    bench = spark.createDataFrame([(None, "apple1 apple2 apple3"), (9, "cherry4 cherry5 cherry6")], "item_id long, text string")
    eight = Counter((r.doc_id, r.n_hit, tuple(r["items"])) for r in decontaminate.hits(odd, bench, window=3).collect())
    assert eight == Counter([(None, 3, ()), (3, 3, ()), (1, 3, ()), (1, 3, ("9",)), (1, 0, ()), (1, 0, ()), (1, 0, ()), (None, 0, ())])

    vectors = [(7, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [1.0, 0.01]), (9, [-1.0, 0.0])]
    ten = Counter((r.vec_id, r.n_links, r.component_id) for r in cover_tree.link_groups(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect())
    assert ten == Counter([(7, 1, 7), (7, 1, 7), (8, 1, 7), (9, 0, 9)])


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs, sizes = common.table(spark, sf_dir, "documents"), []
    for name, fn in corpus_pipeline.STAGES:
        docs = common.stage(fn(spark, docs, sf_dir), f"test-{name}")
        sizes.append(docs.count())
        if name != "sample_pieces":
            assert docs.columns == common.DOCUMENT_COLUMNS
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0 and docs.where("NOT round_trip").count() == 0


def test_op10_every_length_has_links(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (4, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0]), (6, [1.0]), (7, [1.0, 0.01, 0.0]), (8, None)]
    got = cover_tree.link_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (2, 4), 5: (2, 4), 6: (0, 6), 7: (2, 4), 8: (0, 8)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
