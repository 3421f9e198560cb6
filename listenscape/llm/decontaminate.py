"""Operator 8: benchmark decontamination with one Aho-Corasick automaton.

Words are maximal runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased.
Every window of ``window`` consecutive words of a benchmark item (a shorter item is one window) becomes
a pattern; each document is normalised and scanned once. Matches are mapped back to character offsets
of the original text.

Cases: null and empty texts have no words, no hit and an empty item list. Items without words give no
pattern. Repeated items and windows count once per item_id; an item without an id hits words like any other
but stands in no list of items. An empty benchmark hits nothing. Extra columns are ignored; a repeated
document row gives a row each.

Bounds: the patterns travel in a broadcast variable of at most ``block_bytes`` of pattern text. A larger
benchmark is cut into blocks of items, one automaton and one pass each; blocks run in a driver loop
whose length is benchmark bytes / block_bytes; each pass carries the hit words and items of the passes
before it in the row, so no shuffle is needed. Windows are collected block by block, never all at once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, stage, table, worker_cache

_FOLD = bytes(
    (b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32
    for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


def windows_of(words: list[bytes], window: int) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))]


def build_automaton(patterns: dict[bytes, list]):
    """patterns: window -> item ids. Keys are padded with blanks so that only whole words match."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for key, items in patterns.items():
        machine.add_word(f" {key.decode('latin-1')} ", (len(key) + 1, items))
    if len(machine):
        machine.make_automaton()
    return machine


def scan(machine, words: list[bytes]):
    """(hit flag per word, set of item ids)."""
    hit = None
    items: set = set()
    if words and len(machine):
        line = f" {b' '.join(words).decode('latin-1')} "
        found = [(end - 1, *v) for end, v in machine.iter(line)]
        if found:
            starts = np.concatenate([[1], 2 + np.cumsum([len(w) for w in words[:-1]], dtype=np.int64) + np.arange(len(words) - 1)]) \
                if len(words) > 1 else np.array([1])
            edge = np.zeros(len(words) + 1, np.int64)
            for last, length, of in found:
                # last: index of the window's last character; its first is last - length + 2
                a = int(np.searchsorted(starts, last - length + 2))
                b = int(np.searchsorted(starts, last, side="right"))
                edge[a] += 1
                edge[b] -= 1
                items.update(of)
            hit = np.cumsum(edge[:-1]) > 0
    return hit, items


def original_spans(data: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges [start, end) of the original text covered by runs of hit words."""
    flags = np.frombuffer(data.translate(_FOLD), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    chars = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    run = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    out = []
    for a, b in zip(run[::2], run[1::2]):
        start, end = edges[2 * a], edges[2 * (b - 1) + 1]
        out.append((int(chars[start]) - 1, int(chars[end - 1])))
    return out


def scanner(patterns, key: str, keep: list[str], first: bool, last: bool, spans: bool):
    """One pass with one automaton. ``_hit`` (a byte per word) and ``_items`` carry what earlier passes found."""
    def run(batches):
        cache = worker_cache()
        if cache.get("automaton", (None,))[0] != key:
            cache["automaton"] = (key, build_automaton(patterns.value))
        machine = cache["automaton"][1]
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            before = [(None, ())] * len(texts) if first else list(zip(batch.column("_hit").to_pylist(), batch.column("_items").to_pylist()))
            n_words, hits_, items, ranges = [], [], [], []
            for t, (old, had) in zip(texts, before):
                w = words_of(t or b"")
                hit, of = scan(machine, w)
                if old is not None:
                    old = np.frombuffer(old, np.uint8).astype(bool)
                    hit = old if hit is None else hit | old
                n_words.append(len(w))
                hits_.append(hit)
                items.append(sorted({*of, *had}))
                if last and spans:
                    ranges.append([] if hit is None else [{"start": a, "end": b} for a, b in original_spans(t, hit)])
            cols = [batch.column(c) for c in (keep if last else dict.fromkeys([*keep, "text"]))]
            names = list(keep if last else dict.fromkeys([*keep, "text"]))
            if last:
                cols += [pa.array(n_words, pa.int64()), pa.array([0 if h is None else int(h.sum()) for h in hits_], pa.int64())]
                names += ["n_words", "n_hit"]
            else:
                cols.append(pa.array([None if h is None else h.astype(np.uint8).tobytes() for h in hits_], pa.binary()))
                names.append("_hit")
            cols.append(pa.array(items, pa.list_(pa.string())))
            names.append("items" if last else "_items")
            if last and spans:
                cols.append(pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def item_blocks(benchmark: DataFrame, block_bytes: int, window: int) -> list[DataFrame]:
    """Item texts in blocks whose pattern text is bounded by ``block_bytes`` on average."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    total = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * window
    n = max(1, -(-total // block_bytes))
    return [items if n == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) for i in range(n)]


def block_patterns(block: DataFrame, window: int) -> dict[bytes, list]:
    patterns: dict[bytes, set] = {}
    for r in block.toLocalIterator():
        for w in windows_of(words_of(bytes(r.text)), window):
            items = patterns.setdefault(w, set())
            if r.item_id is not None:
                items.add(r.item_id)
    return {w: sorted(s) for w, s in patterns.items()}


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 64 << 20, spans: bool = True,
         keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` (default doc_id), n_words, n_hit, items (ids, sorted
    as strings) and, if asked for, spans (character ranges of the original text)."""
    keep = keep or ["doc_id"]
    blocks = item_blocks(benchmark, block_bytes, window)
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        patterns = block_patterns(block, window)
        digest = hashlib.sha256(repr(sorted(patterns.items())).encode()).hexdigest()
        shared = docs.sparkSession.sparkContext.broadcast(patterns)
        schema = [f"`{c}` {kinds[c]}" for c in (keep if last else dict.fromkeys([*keep, "text"]))]
        schema += ["n_words long", "n_hit long", "items array<string>"] if last else ["_hit binary", "_items array<string>"]
        schema += ["spans array<struct<start:long,end:long>>"] if last and spans else []
        rows = rows.mapInArrow(scanner(shared, digest, keep, i == 0, last, spans), ", ".join(schema))
        if not last:
            rows = stage(rows, "decontaminate")
    return rows


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of ``hits``, with the hit ranges of the original text (characters) in ``spans``."""
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans")


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with no benchmark window in them."""
    cols = DOCUMENT_COLUMNS
    found = hits(docs, table(spark, sf_dir, "benchmark"), window=10, spans=False, keep=cols)
    return found.where("n_hit = 0").select(*cols)
