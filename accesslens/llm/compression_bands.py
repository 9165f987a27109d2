"""Quality rules: texts that compress too well or too badly for their length.

Repetitive text compresses far better than prose, encoded or random text hardly at
all. How well prose compresses depends on how much of it there is, so the limits do
too. A ratio over the whole text misses a document half of which is junk; ratios of
chunks of fixed size see it. Every byte of a text that is as long as a chunk stands in
one; the limits by length see a shorter text whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import WORDS, fresh

LEVEL = 3
CHUNK = 2048  # bytes; the last chunk is the text's end, and overlaps the one before

#: Limits of UTF-8 bytes over compressed bytes: (from so many bytes, least, most).
#: Set around the ratios that documents labelled good have at each length, with a
#: margin above and below.
BANDS = (
    (0, 1.00, 2.10),
    (256, 1.15, 2.15),
    (512, 1.25, 2.25),
    (1024, 1.40, 2.35),
    (2048, 1.50, 2.45),
    (4096, 1.55, 2.55),
    (8192, 1.60, 2.65),
    (16384, 1.60, 2.80),
    (65536, 1.60, 3.00),
    (1 << 20, 1.60, 3.30),
)
#: The limits for a chunk; a document with more than this share outside is rejected.
CHUNK_BAND = (1.40, 2.35)
BAD_CHUNKS = 0.25

SYMBOLS = frozenset("#*$%&|<>")  # fixed values

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_bytes bigint, "
    "ratio double, bad_chunks double"
)
_NAMES = [field.split()[0] for field in MEASURES.split(", ")]
_TYPES = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
_STRUCT = pa.struct(
    [(name, _TYPES[kind]) for name, kind in (f.split() for f in MEASURES.split(", "))]
)


def repeated_words(words: list[str]) -> int:
    """Words in runs of three that the text has twice or more."""
    runs = list(zip(words, words[1:], words[2:]))  # noqa: B905
    if len(set(runs)) == len(runs):
        return 0
    times = Counter(runs)
    covered, end = 0, 0
    for at, run in enumerate(runs):
        if times[run] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return len(lines) - len(set(lines))


def band(n_bytes: int) -> tuple[float, float]:
    return next((low, high) for at, low, high in reversed(BANDS) if n_bytes >= at)


def bad_share(ratios: list[float]) -> float:
    low, high = CHUNK_BAND
    return sum(not low <= r <= high for r in ratios) / len(ratios) if ratios else 0.0


def measure(text: str, compress) -> tuple:
    """The values of MEASURES for one text; ``compress`` takes and gives bytes."""
    words = WORDS.findall(text)
    repeated = repeated_words(words)
    data = text.encode("utf-8", "replace")
    ratio = len(data) / len(compress(data)) if data else 0.0
    starts = [*range(0, len(data) - CHUNK, CHUNK), len(data) - CHUNK]
    chunks = [data[a : a + CHUNK] for a in starts if a >= 0]
    bad = bad_share([len(chunk) / len(compress(chunk)) for chunk in chunks])
    low, high = band(len(data))
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        duplicate_lines(text),
        repeated,
        failed,
        not failed and low <= ratio <= high and bad <= BAD_CHUNKS,
        len(data),
        ratio,
        bad,
    )


def with_measures(documents: DataFrame, name: str = "quality") -> DataFrame:
    """``documents`` and a struct of MEASURES of each text.

    A null or empty text has no words, so it fails the base rules and is not kept.
    Whole texts are measured, whatever their length. Every row stays, equal rows
    included; no shuffle. ``name`` gets underscores in front if it is taken.
    """

    def over(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for texts in batches:
            rows = [measure(text or "", compress) for text in texts.to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in _NAMES]
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _STRUCT, strict=True)],
                fields=list(_STRUCT),
            )

    fields = ", ".join(f.replace(" ", ": ") for f in MEASURES.split(", "))
    measured = F.arrow_udf(over, f"struct<{fields}>", F.ArrowUDFType.SCALAR_ITER)
    return documents.withColumn(fresh(documents, name), measured("text"))


def reject(documents: DataFrame) -> DataFrame:
    """Documents that pass, with the columns they came with."""
    columns = documents.columns
    name = fresh(documents, "quality")
    return with_measures(documents, name).where(F.col(f"`{name}`.kept")).select(*columns)
