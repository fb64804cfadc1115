"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from a hash of the letter.  A letter
n-gram is bound: the vectors of its letters, rotated by their place, are multiplied.  The
n-grams of a text (white space and all that is no letter is a gap) are bundled: summed as
often as they occur.  A language's prototype is the sum of the unit vectors of its
training texts, less what all languages share, and a text goes to the prototype with the
largest cosine.

The fit takes, of each language, the ``per_lang`` distinct pairs of doc_id and text with
the smallest hash, a bound that does not grow with the corpus; the counts that choose them
cover all rows.  Scoring is a pass over the texts without a shuffle; the model, a vector for each
language, travels with the code.

Cases: texts that are null, empty or without letters get ``und`` and score 0, and so does
every text if nothing could be learned; very long texts are counted a piece at a time; a
null doc_id is neither held out nor learned from; null langs are not learned; equal
cosines go to the first language by name; repeated rows are learned from once and
predicted each; a language with one row only is learned from that; an empty table gives
an empty result; extra columns are carried through ``identified``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lanternflow.llm._shared import bounded_batches, given_back, read_table

GRAM, DIMS, PER_LANG, PIECE = 3, 1024, 1000, 1 << 20
UNKNOWN = "und"
#: A text unrelated to a prototype has a cosine with a deviation of about 1 / sqrt(dims); ``accepted`` wants this many.
#: Texts of fewer letters than SHORT share too few n-grams with any language to be told from noise.
DEVIATIONS, SHORT = 5, 40


class Encoder:
    """Texts to bundled n-gram vectors."""

    def __init__(self, dims: int = DIMS, gram: int = GRAM, seed: int = 7):
        self.dims, self.gram, self.seed = dims, gram, seed
        self.letters: dict[int, np.ndarray] = {}
        self.is_letter: dict[int, bool] = {}

    def _vector(self, letter: int) -> np.ndarray:
        """A letter's vector; 0 is the gap between words."""
        if letter not in self.letters:
            self.letters[letter] = np.random.default_rng([self.seed, letter]).integers(0, 2, self.dims).astype(np.float32) * 2 - 1
        return self.letters[letter]

    def _letters(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        there = np.flatnonzero(np.bincount(points)) if len(points) else np.zeros(0, np.int64)
        table = np.zeros(int(there[-1]) + 1 if len(there) else 1, np.uint32)
        for p in there.tolist():
            if p not in self.is_letter:
                self.is_letter[p] = chr(p).isalpha()
            table[p] = p if self.is_letter[p] else 0
        return table[points]

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of each kind of n-gram (kinds x gram), and how often each text has it (texts x kinds)."""
        runs, owner = [np.zeros(self.gram, np.uint32)], [np.zeros(self.gram, np.int64)]
        for k, text in enumerate(texts):
            x = self._letters(text)
            runs += [x, np.zeros(self.gram, np.uint32)]
            owner += [np.full(len(x) + self.gram, k, np.int64)]
        points, owners = np.concatenate(runs), np.concatenate(owner)
        kinds, at = np.unique(points, return_inverse=True) if len(points) < 4096 else self._kinds(points)
        n, g = len(kinds), self.gram
        code = np.zeros(len(points) - g + 1, np.int64)
        for j in range(g):
            code = code * n + at[j : len(at) - g + 1 + j]
        zero = int(np.searchsorted(kinds, 0))
        middle = at[g // 2 : len(at) - g + 1 + g // 2] != zero
        code, owners = code[middle], owners[g // 2 : len(at) - g + 1 + g // 2][middle]
        if n**g <= 1 << 21:
            held = np.flatnonzero(np.bincount(code, minlength=1))
            where = np.zeros(int(held[-1]) + 1 if len(held) else 1, np.int64)
            where[held] = np.arange(len(held))
            column = where[code]
        else:
            held, column = np.unique(code, return_inverse=True)
        counts = np.bincount(owners * len(held) + column, minlength=len(texts) * len(held)).reshape(len(texts), len(held)) if len(held) else np.zeros((len(texts), 0))
        letters = np.stack([kinds[held // n ** (g - 1 - j) % n] for j in range(g)], 1) if len(held) else np.zeros((0, g), np.uint32)
        return letters, counts.astype(np.float32)

    @staticmethod
    def _kinds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kinds = np.flatnonzero(np.bincount(points))
        table = np.zeros(int(kinds[-1]) + 1, np.int64)
        table[kinds] = np.arange(len(kinds))
        return kinds, table[points]

    def _bundle(self, texts: list[str]) -> np.ndarray:
        letters, counts = self.grams(texts)
        out = np.zeros((len(texts), self.dims), np.float32)
        for lo in range(0, len(letters), 2048):
            part = letters[lo : lo + 2048]
            bound = np.ones((len(part), self.dims), np.float32)
            for j in range(self.gram):
                kinds, at = np.unique(part[:, j], return_inverse=True)
                bound *= np.stack([np.roll(self._vector(int(p)), self.gram - 1 - j) for p in kinds])[at]
            out += counts[:, lo : lo + 2048] @ bound
        return out

    def encode(self, texts: list[str | None]) -> np.ndarray:
        """A vector for each text; zero for texts without letters."""
        out = np.zeros((len(texts), self.dims), np.float32)
        group: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            if text is None:
                continue
            if len(text) > PIECE:  # whole words stay together where there is white space
                at = 0
                while at < len(text):
                    end = min(len(text), at + PIECE)
                    cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end)) if end < len(text) else end
                    end = cut if cut > at else end
                    out[k] += self._bundle([text[at:end]])[0]
                    at = end
                continue
            group.append(k)
            size += len(text)
            if len(group) == 128 or size > PIECE:
                out[group] = self._bundle([texts[i] for i in group])
                group, size = [], 0
        if group:
            out[group] = self._bundle([texts[i] for i in group])
        return out


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """lang, text of at most per_lang distinct rows (doc_id, text) of each language, by hash; fold 0 is left out."""
    wide = F.lit(1 << 30)
    may = docs.where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("__h"))
    # a row for each language; twice the distinct rows wanted pass by hash, so that no language is ranked as a whole
    share = may.groupBy(F.col("lang").alias("__lang")).agg((F.lit(2.0 * per_lang + 100) / F.approx_count_distinct("__h")).alias("__share"))
    drawn = may.join(F.broadcast(share), F.col("lang") == F.col("__lang")).where(F.pmod("__h", wide) < F.col("__share") * wide).select("lang", "__h").distinct()
    last = drawn.withColumn("__k", F.row_number().over(W.partitionBy("lang").orderBy(F.pmod("__h", wide), "__h"))).where(F.col("__k") <= per_lang)
    kept = last.select(F.col("lang").alias("__lang"), F.col("__h").alias("__kept"))  # per_lang rows a language
    rows = may.join(F.broadcast(kept), (F.col("lang") == F.col("__lang")) & (F.col("__h") == F.col("__kept")))
    return rows.groupBy("lang", "__h").agg(F.first("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, dims: int = DIMS, gram: int = GRAM, per_lang: int = PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages by name, and their prototypes."""
    bounded_batches(docs.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = Encoder(dims, gram), {}
        for batch in batches:
            vectors = unit(encoder.encode(batch.column(1).to_pylist()))
            for lang, v in zip(batch.column(0).to_pylist(), vectors):
                total[lang] = total.get(lang, 0) + v.astype(np.float64)
        names = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([total[n].tolist() for n in names], pa.list_(pa.float64()))], names=["lang", "v"])

    parts = training_rows(docs, per_lang).mapInArrow(given_back(sums), "lang string, v array<double>")
    rows = parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v")).collect()
    names = sorted(r["lang"] for r in rows)
    of = {r["lang"]: np.array([p["x"] for p in r["v"]]) for r in rows}
    prototypes = unit(np.array([of[n] for n in names]).reshape(len(names), dims))
    if len(names) > 1:
        shared = prototypes.mean(0)
        prototypes = unit(prototypes - 0.5 * shared)
    # sums of floats differ in their last bits with the order of tasks
    return names, np.round(prototypes, 6).astype(np.float32)


def _predict(names: list[str], prototypes: np.ndarray, dims: int, gram: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dims, gram)
        for batch in batches:
            vectors = encoder.encode(batch.column(text_at).to_pylist())
            near = unit(vectors) @ prototypes.T if names else np.zeros((len(vectors), 1))
            best, known = near.argmax(1), vectors.any(axis=1) & bool(names)
            lang = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = np.where(known, np.clip(near[np.arange(len(best)), best], 0, 1), 0.0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*batch.schema.names, "__lang_pred", "__lang_score"])

    return run


def identified(docs: DataFrame, model: tuple[list[str], np.ndarray], dims: int = DIMS, gram: int = GRAM) -> DataFrame:
    """docs with __lang_pred and __lang_score."""
    bounded_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField("__lang_pred", T.StringType()), T.StructField("__lang_score", T.DoubleType())])
    return docs.mapInArrow(given_back(_predict(*model, dims, gram, docs.columns.index("text"))), schema)


def accepted(docs: DataFrame, model: tuple[list[str], np.ndarray], dims: int = DIMS, gram: int = GRAM) -> DataFrame:
    """docs in a learned language; those without a letter go, as do those that are like no prototype.

    Like one is a cosine of DEVIATIONS / sqrt(dims) or more (0.156 at 1,024); for texts of fewer than SHORT letters, above 0."""
    near, letters = F.col("__lang_score") >= DEVIATIONS / dims**0.5, F.length(F.regexp_replace("text", r"\P{L}+", ""))
    like = (F.col("__lang_score") > 0) & (near | (letters < SHORT))
    return identified(docs, model, dims, gram).where((F.col("__lang_pred") != UNKNOWN) & like).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = identified(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), F.col("__lang_pred").alias("lang_pred"), F.col("__lang_score").alias("score"))


QUERIES = {"op2_language_id": op2_language_id}
SQL: dict[str, str] = {}
