"""Token-ID files: concatenated ids with Elias-Fano document boundaries.

A file holds the ids of a run of documents in ascending doc_id order.  Its boundaries
(where each document ends) are a rising sequence, and so are its doc_ids.  Both are stored
by Elias and Fano: the low bits of each number packed, the high bits as unary gaps in a bit
vector, with a sample of positions of ones so that ``select`` starts near its goal.  That is
about 2 + log2(ids a document) bits for each document, where a table of offsets takes 64;
no table of 64-bit numbers is kept, but a sample of each 256th.

File format, little-endian: magic ``LFEF0002``; u64 documents n, u64 documents without
doc_id (they come first), i64 smallest doc_id, u32 bytes of an id, u64 ids; then the
sequences of boundaries and of doc_ids less the smallest, each as u64 count, u32 low bits,
u64 bytes of low bits, u64 bytes of high bits, u64 samples, low bits, high bits, samples
(u64); then the ids.

Writing: documents are ranged by doc_id, and each range encodes its texts (each distinct
word of a batch once: the pre-tokenizer never joins across white space) and writes its
files in the same task, every one of at most ``file_ids`` ids or a single document.  The
manifest has a row for each file; sums over it give each file's first position, within a
range in the cluster, over ranges (as many as the shuffle has partitions) on the driver.

Cases: a null text is the empty text (the end id alone); a null doc_id comes first;
repeated doc_ids lie together, ordered by a hash of the text; very long texts are encoded
word by word; a tokenizer that does join across white space encodes whole texts, and one
with more ids than ``width`` holds raises ValueError; an empty table gives an empty result;
extra columns are dropped.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lanternflow.llm._shared import bounded_batches, given_back, opened, read_table, small_table, staged, workspace, written_once

MAGIC = b"LFEF0002"
HEAD = struct.Struct("<8sQQqIQ")
PART = struct.Struct("<QIQQQ")
EVERY = 256
FILE_IDS = 4_000_000


class EliasFano:
    """A rising sequence of n numbers from 0 up, of 64 bits at most."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values, n = values.astype(np.uint64), len(values)
        width = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        packed = []
        for lo in range(0, n if width else 0, 1 << 14):  # whole bytes, some megabytes of bits at a time
            part = values[lo : lo + (1 << 14), None] >> np.arange(width, dtype=np.uint64)
            packed.append(np.packbits((part & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) + 1) if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, width, np.concatenate(packed) if packed else np.zeros(0, np.uint8), np.packbits(high, bitorder="little"), ones[::EVERY].astype(np.uint64))

    def _low(self, first: int, count: int) -> np.ndarray:
        w = self.low_bits
        if not w:
            return np.zeros(count, np.uint64)
        start, end = first * w, (first + count) * w
        bits = np.unpackbits(self.low[start // 8 : (end + 7) // 8], bitorder="little")[start % 8 : start % 8 + count * w]
        return (bits.reshape(count, w).astype(np.uint64) << np.arange(w, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, first: int, count: int = 1) -> np.ndarray:
        """The numbers from the first-th on: one sample, then a scan of the high bits from there, no further than they go."""
        if not count:
            return np.zeros(0, np.uint64)
        at, need = int(self.samples[first // EVERY]), first % EVERY
        byte, skip, found, have = at // 8, at % 8, [], 0
        while have < need + count:
            step = 64 + (need + count - have) // 2
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + step], bitorder="little")[skip:]) + (skip + 8 * byte)
            found.append(ones)
            have, byte, skip = have + len(ones), byte + step, 0
        ones = np.concatenate(found)[need : need + count]
        return ((ones - np.arange(first, first + count)).astype(np.uint64) << np.uint64(self.low_bits)) + self._low(first, count)

    def dumped(self) -> bytes:
        low, high, samples = self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u8").tobytes()
        return PART.pack(self.n, self.low_bits, len(low), len(high), len(self.samples)) + low + high + samples

    @classmethod
    def loaded(cls, file) -> EliasFano:
        n, low_bits, low, high, samples = PART.unpack(file.read(PART.size))
        return cls(n, low_bits, np.frombuffer(file.read(low), np.uint8), np.frombuffer(file.read(high), np.uint8), np.frombuffer(file.read(8 * samples), "<u8"))


def encoded(doc_ids: list, lengths: np.ndarray, ids: bytes, width: int) -> bytes:
    """The bytes of a file.  doc_ids: None first, then rising."""
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    ends = np.cumsum(lengths)
    keys = np.array([d - least for d in known], np.uint64)
    return HEAD.pack(MAGIC, len(doc_ids), len(doc_ids) - len(known), least, width, int(ends[-1]) if len(ends) else 0) + EliasFano.of(ends).dumped() + EliasFano.of(keys).dumped() + ids


class TokenFile:
    """Reads a file by URI: the index first, ids of documents when asked."""

    def __init__(self, uri: str):
        store, path = opened(uri)
        self.file = store.open_input_file(path)
        magic, self.n, self.nulls, self.least, self.width, self.n_ids = HEAD.unpack(self.file.read(HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        self.ends, self.keys = EliasFano.loaded(self.file), EliasFano.loaded(self.file)
        self.data = self.file.tell()

    def doc_ids(self, first: int, count: int) -> list[int | None]:
        """doc_ids of the documents from the first-th on."""
        none = min(count, max(0, self.nulls - first))
        return [None] * none + [self.least + d for d in self.keys.select(max(0, first - self.nulls), count - none).tolist()]

    def bounds(self, first: int, count: int) -> np.ndarray:
        """Where the documents from the first-th on start, and where the last one ends."""
        start = self.ends.select(first - 1) if first else np.zeros(1, np.uint64)
        return np.concatenate([start, self.ends.select(first, count)]).astype(np.int64)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the file's k-th document."""
        return self.slice(*self.bounds(k, 1).tolist())

    def slice(self, start: int, end: int) -> np.ndarray:
        self.file.seek(self.data + start * self.width)
        return np.frombuffer(self.file.read((end - start) * self.width), f"<u{self.width}")

    def close(self) -> None:
        self.file.close()


#: Letters whose lower case is one letter again, then ASCII signs without the apostrophe: one or two units of the
#: pre-tokenizer, which the model takes without the normaliser.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: Words and units that a worker remembers, and the longest of them.
KNOWN, LONG = 250_000, 64
SLICE_BYTES = 4 << 20


class WordIds:
    """The ids, as bytes, of runs between ASCII white space; each is encoded once while it is remembered."""

    def __init__(self, tokenizer_path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(tokenizer_path), {1: "B", 2: "H", 4: "I"}[width]
        if self.tokenizer.get_vocab_size() > 1 << 8 * width:
            raise ValueError(f"{self.tokenizer.get_vocab_size()} ids do not fit {width} bytes")
        self.model, self.units, self.words = self.tokenizer.model, {}, {}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        self.byte_sign = {**{b: chr(b) for b in printable}, **{b: chr(256 + k) for k, b in enumerate(rest)}}
        # other kinds of tokenizers take the plain way, word by word, and those that look beyond white space text by text
        probes = ("two words", "a  b", "x\ny", " lead", "tail ", "the, cat\t(sat)")
        self.by_word = all(self._whole(x) == b"".join(map(self._whole, x.split())) for x in probes)
        try:
            self.fast = self.by_word and all(self._unit(x) == self._whole(x) for x in ("Word", "été", "...", "#&*"))
        except Exception:  # a model of a kind that can't take a unit
            self.fast = False

    def _whole(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _unit(self, text: str) -> bytes:
        known = self.units.get(text)
        if known is None:
            low = text.lower()
            signs = low if low.isascii() else low.encode().decode("latin-1").translate(self.byte_sign)
            known = array(self.kind, [t.id for t in self.model.tokenize(signs)]).tobytes()
            self._remember(self.units, text, known)
        return known

    @staticmethod
    def _remember(table: dict[str, bytes], text: str, ids: bytes) -> None:
        if len(text) <= LONG:
            if len(table) >= KNOWN:
                table.clear()
            table[text] = ids

    def __call__(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            m = PLAIN.fullmatch(word) if self.fast else None
            if not m:
                known = self._whole(word)
            else:
                known = self._unit(m[1]) + self._unit(m[2]) if m[2] else self._unit(m[1])
            self._remember(self.words, word, known)
        return known


@lru_cache(maxsize=1)
def word_ids(tokenizer_path: str, width: int) -> WordIds:
    """One for each Python worker, kept over its tasks."""
    return WordIds(tokenizer_path, width)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with some megabytes of text, or one row."""
    at, size = 0, 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()):
        if size and size + n > SLICE_BYTES:
            yield batch.slice(at, k - at)
            at, size = k, 0
        size += n
    if at < batch.num_rows:
        yield batch.slice(at)


def _encoded(part: pa.RecordBatch, ids_of: WordIds, end: bytes, width: int) -> tuple[np.ndarray, bytes]:
    """How many ids each text of a batch (doc_id, text) has, and all of them as bytes."""
    texts = pc.fill_null(part.column(1), "")
    if not ids_of.by_word:
        each = [ids_of._whole(t) + end for t in texts.to_pylist()]
        return np.array([len(x) // width for x in each], np.int64), b"".join(each)
    words = pc.ascii_split_whitespace(texts)
    per_doc = np.diff(words.offsets.to_numpy())
    coded = words.flatten().dictionary_encode()
    table = [ids_of(w) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
    table.append(end)
    size = np.fromiter(map(len, table), np.int64, len(table)) // width
    first = np.cumsum(size) - size
    # word numbers of all documents, with the end id's number after each
    closes = np.cumsum(per_doc + 1) - 1
    which = np.full(int(per_doc.sum()) + len(per_doc), len(table) - 1, np.int64)
    inner = np.ones(len(which), bool)
    inner[closes] = False
    which[inner] = coded.indices.to_numpy(zero_copy_only=False)
    reps = size[which]
    ends = np.cumsum(reps)
    flat = np.frombuffer(b"".join(table), f"<u{width}")[np.repeat(first[which] - (ends - reps), reps) + np.arange(int(ends[-1]) if len(ends) else 0)]
    return np.diff(ends[closes], prepend=0) if len(closes) else np.zeros(0, np.int64), flat.tobytes()


def _writer(folder: str, tokenizer_path: str, end_id: int, width: int, file_ids: int):
    """Arrow batches of (doc_id, text) in order, to files and their rows of the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at, docs, lengths, ids, held, out = TaskContext.get().partitionId(), [], [], [], 0, []

        def close() -> None:
            nonlocal docs, lengths, ids, held
            uri = f"{folder}/{at:06d}-{len(out):05d}.lfef"
            with written_once(uri) as f:
                f.write(encoded(docs, np.array(lengths, np.int64), b"".join(ids), width))
            out.append((at, len(out), uri, len(docs), held))
            docs, lengths, ids, held = [], [], [], 0

        for batch in batches:
            ids_of, end = word_ids(tokenizer_path, width), np.array([end_id], f"<u{width}").tobytes()
            for part in _slices(batch):
                count, raw = _encoded(part, ids_of, end, width)
                place = 0
                for d, n in zip(part.column(0).to_pylist(), count.tolist()):
                    if docs and held + n > file_ids:
                        close()
                    docs.append(d)
                    lengths.append(n)
                    ids.append(raw[place * width : (place + n) * width])
                    held, place = held + n, place + n
        if docs:
            close()
        cols = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], names=["range", "part", "uri", "docs", "ids"])

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, width: int = 2, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode docs (doc_id, text), write files under folder and return their manifest: range, part, uri, docs, ids.
    width: bytes of an id; 2 holds vocabularies up to 65,536."""
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    ranged = narrow.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return staged(ranged.mapInArrow(given_back(_writer(folder, tokenizer_path, end_id, width, file_ids)), "range int, part int, uri string, docs long, ids long"), "token-manifest")


READ = 2000


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            f = TokenFile(uri)
            for lo in range(0, f.n, READ):
                n = min(READ, f.n - lo)
                at = f.bounds(lo, n)
                ids = f.slice(int(at[0]), int(at[-1])).astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1] - at[0], at[1:] - at[0])]
                yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids(lo, n), pa.int64()), pa.array(at[:-1] + base, pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
            f.close()


def read_token_files(manifest: DataFrame) -> DataFrame:
    """A row for each document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark, base, first = manifest.sparkSession, 0, []
    for r in sorted(manifest.groupBy("range").agg(F.sum("ids").alias("ids")).collect()):  # a row for each range
        first.append((r["range"], base))
        base += r["ids"]
    starts = small_table(spark, range=pa.array([r for r, _ in first], pa.int32()), first=pa.array([b for _, b in first], pa.int64()))
    within = F.coalesce(F.sum("ids").over(W.partitionBy("range").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("within", within).join(F.broadcast(starts), "range")
    files = files.select("uri", (F.col("first") + F.col("within")).alias("base")).repartition(max(1, manifest.count()))
    return files.mapInArrow(given_back(_read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = write_token_files(read_table(spark, sf_dir, "documents"), workspace(spark, "token-files"), public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(manifest)


QUERIES = {"op9_token_files": op9_token_files}
SQL: dict[str, str] = {}
