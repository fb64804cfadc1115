from __future__ import annotations

import random

import pytest

#: Names that operators use inside; a table may have them too.
CLASHES = ("size", "tie", "fp", "n", "root", "hash", "s", "w", "h", "k", "key", "copies", "target", "width", "items", "segment", "rank", "x", "digest", "bytes", "bad", "by", "host", "path", "template", "source_size")


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and very long texts, ties and repeated rows: (doc_id, text, lang, source)."""
    rng = random.Random(3)
    out = [(k, words(rng, rng.randint(1, 60)), rng.choice(["aa", "bb"]), rng.choice(["src0", "src0", "src1", "src2"])) for k in range(40)]
    base = words(rng, 300)
    out += [(50 + k, base, "aa", "src0") for k in range(4)]
    out += [(60, base + " tail", "aa", None), (61, None, "aa", "src1"), (62, "", None, "src1"), (63, " \t\n", "aa", "src2"), (64, "123 -- 456 !!", "bb", "src2")]
    out += [(None, words(rng, 9), "aa", "src0"), (None, None, None, None), (70, "Çà éTÉ Straße ßüß", "bb", "ſrc"), (70, "Çà éTÉ Straße ßüß", "bb", "ſrc"), (70, "other text of the same id", "bb", "src2"), (71, words(rng, 30_000), "bb", "src1"), (72, "x", "aa", "src1")]
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(*r, len(r[1] or ""), *["clash"] * len(CLASHES)) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def docs(frame, rows):
    return frame(rows).repartition(3).cache()


@pytest.fixture(scope="session")
def none(frame):
    return frame([])
