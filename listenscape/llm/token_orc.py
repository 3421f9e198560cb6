"""Operator 7: token ids in ORC files, one row per document.

``write`` encodes whole texts with a tokenizer file, orders the documents by id and writes ORC:
integer columns use ORC's run-length encoding, stripes carry row indexes (min / max per
``row_index_stride`` rows) and a Bloom filter on ``doc_id``, so a look-up by id skips files, stripes
and row groups from metadata, and a scan reads stripes in parallel. ``read_offsets`` reads the files
back and places every document in the stream of all ids.

Cases: a null or empty text gives only the end id. Repeated rows and repeated ids keep one row each; rows
that share a ``doc_id`` are written by the checksum of their ids, then by their number, and placed so. Rows
without a ``doc_id`` come first. An empty table gives no row. Extra columns are ignored.
A text is encoded at ASCII spaces and line ends, each piece once per worker and the distinct pieces of some
megabytes of text at a time; white space belongs to no token of this vocabulary, so the ids equal those of the whole text.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import input_bytes, scratch_path, stage, worker_cache

#: Words kept per Python worker; beyond it only words met more than once are kept. Texts are lower-cased
#: by the vocabulary's own normaliser, so ASCII texts may be lower-cased before the look-up.
CACHE_WORDS = 800_000
#: The vocabulary's pre-tokens, for words of lower-case visible ASCII characters.
_PRE_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Text whose words are numbered and looked up at once.
BATCH_BYTES = 8 << 20


def _of_letters(word: str) -> bool:
    """Whether a word is letters, and still is in the vocabulary's normal form."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class WordIds:
    """Ids of whole texts as little-endian bytes, with each distinct word encoded once."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        # No added token begins in such a word, since it lacks their first characters.
        first = {t.content[0] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.visible = re.compile("[%s]+" % "".join(re.escape(c) for c in map(chr, range(33, 127)) if c not in first)).fullmatch
        self.codes: dict[str, bytes] = {"": b""}
        self.often: dict[str, bytes] = {"": b""}

    def learn(self, words: list[str]) -> None:
        """Adds the ids of distinct ``words`` that are not known."""
        if len(self.codes) > CACHE_WORDS:
            # Words that were met again stay; those met once make room.
            self.codes, self.often = self.often, {"": b""}
        # A word of letters is one pre-token. So is a stop or comma behind it, and other words of visible ASCII
        # characters fall into pre-tokens by a rule that ``re`` knows as well.
        letters, cut, rest = [], [], []
        for w in words:
            if _of_letters(w):
                letters.append(w)
            elif w[-1] in ".," and _of_letters(w[:-1]):
                cut.append((w, (w[:-1], w[-1])))
            elif self.visible(w):
                cut.append((w, _PRE_TOKENS.findall(w.lower())))
            else:
                rest.append(w)
        bases = list({p for _, parts in cut for p in parts}.difference(letters, self.codes)) + letters
        for i in range(0, len(bases), 256):
            self.codes.update(self.encode_parts(bases[i:i + 256]))
        self.codes.update(self.encode_each(rest))
        known = self.codes
        known.update([(w, b"".join([known[p] for p in parts])) for w, parts in cut])

    def encode_each(self, words: list[str]) -> list[tuple[str, bytes]]:
        return [(w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False))]

    def encode_parts(self, words: list[str]) -> list[tuple[str, bytes]]:
        """Words that are one pre-token each, in one call, cut behind the ids that end a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):  # a letter whose lower-case form is more than letters
            return self.encode_each(words)
        data, cuts = ids.tobytes(), (4 * cuts).tolist()
        return [(w, data[a:b]) for w, a, b in zip(words, [0, *cuts], cuts)]

    def encode(self, texts: list[str | None], end_id: int) -> list[bytes]:
        """The ids of each text, ended by end_id."""
        offsets, ids = self.encode_column(pa.array(texts, pa.string()), end_id)
        return [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]

    def encode_column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(where each text's ids begin, and the end of all; the ids, each text's ended by end_id). Arrow splits the
        texts and numbers their words, so that only distinct ones are looked up."""
        texts = pc.fill_null(texts, "")
        texts = pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(texts), texts)
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ends = np.asarray(words.offsets, np.int64)[1:] - words.offsets[0].as_py()
        words = words.flatten().dictionary_encode()
        own = words.dictionary.to_pylist()
        codes = list(map(self.codes.get, own))
        missing = [w for w, c in zip(own, codes) if c is None]
        if missing:
            if len(self.codes) > CACHE_WORDS // 2:
                self.often.update((w, c) for w, c in zip(own, codes) if c is not None)
            self.learn(missing)
            codes = [self.codes[w] if c is None else c for w, c in zip(own, codes)]
        # The end id is one more word, behind the last one of each text.
        codes.append(int(end_id).to_bytes(4, "little"))
        size = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        each = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(np.frombuffer(b"".join(codes), "<i4")))
        number = np.insert(np.asarray(words.indices), ends, len(own))
        ids = np.asarray(each.cast(pa.large_list(pa.int32())).take(pa.array(number)).flatten()).view("<u4")
        last = np.cumsum(size[number])[ends + np.arange(len(ends))]
        return np.concatenate([np.zeros(1, np.int64), last]), ids


def encoder(tokenizer_path: str, end_id: int):
    def run(batches):
        cache = worker_cache()
        key = ("tokenizer", tokenizer_path)
        if key not in cache:
            cache[key] = WordIds(tokenizer_path)
        for batch in together(batches):
            offsets, ids = cache[key].encode_column(batch.column("text"), end_id)
            crc = pa.array([zlib.crc32(ids[a:b]) for a, b in zip(offsets, offsets[1:])], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, crc], ["doc_id", "ids", "ids_crc32"])

    return run


def together(batches):
    """Batches joined to about ``BATCH_BYTES``: a word is looked up once in each."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > BATCH_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, file_bytes: int = 32 << 20,
          stripe_bytes: int = 16 << 20, row_index_stride: int = 1000, bloom_fpp: float = 0.01) -> None:
    """Write ``doc_id, ids`` as ORC below ``path``, in ascending doc_id order over the sorted files."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(slim) // file_bytes))
    (slim.repartitionByRange(files, "doc_id")
     .mapInArrow(encoder(tokenizer_path, end_id), "doc_id long, ids array<int>, ids_crc32 long")
     .sortWithinPartitions("doc_id", "ids_crc32", F.size("ids"))
     .select("doc_id", "ids")
     .write.mode("overwrite")
     .option("compression", "zstd")
     .option("orc.stripe.size", str(stripe_bytes))
     .option("orc.row.index.stride", str(row_index_stride))
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", str(bloom_fpp))
     .orc(path))


def checksums(batches):
    for batch in batches:
        lists = batch.column("ids")
        off = np.asarray(lists.offsets)
        values = np.ascontiguousarray(np.asarray(lists.values), dtype="<u4")
        crc = [zlib.crc32(values[a:b]) for a, b in zip(off[:-1], off[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("file"), pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "file", "n_tokens", "ids_crc32"])


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    Offsets need two levels only: ids per file (one row per file, ordered by the file's first id),
    and a running sum inside each file. No task sees more than one file's documents.
    """
    rows = (spark.read.schema("doc_id long, ids array<int>").orc(path).withColumn("file", F.input_file_name())
            .mapInArrow(checksums, "doc_id long, file string, n_tokens long, ids_crc32 long"))
    rows = stage(rows, "token-rows")  # the ids are read once, and two aggregates use the rows
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    base = files.select("file", (F.sum("n").over(Window.orderBy("first", "last", "file")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("file").orderBy("doc_id", "ids_crc32", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(base, "file")
            .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of a few documents; the predicate reaches the ORC reader (file, stripe and Bloom pruning)."""
    return spark.read.orc(path).where(F.col("doc_id").isin(list(doc_ids)))


def op7_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import table

    path = scratch_path(spark, "token-orc")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_offsets(spark, path)
