"""Document fingerprints by consistent weighted sampling.

A text is a set of words weighted by how often it has them. For each sample, every word
draws r and c from a gamma distribution with shape 2 and beta from [0, 1), fixed by the
word and the sample. With t = floor(ln(weight) / r + beta) it gets the value
ln(c) - r (t - beta + 1); the word with the smallest value and its t are the sample. Two
texts have equal samples with a probability that is their generalised Jaccard
similarity: the sum of the smaller weights over the sum of the larger ones.

A fingerprint keeps 16 bits of each sample, so unequal samples agree once in 65,536.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import WORDS, shuffle_partitions

SAMPLES = 64
RANGES = 4  # of ids for each task, so that tasks that are dealt more differ less
CELLS = 64  # of a sample of ids, for each range of them
GROUP = 256  # texts that share a table of their words' values

# Multipliers and shifts of a well-known 64-bit mixing function.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW = np.uint64(0xFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the lowest 21 bits."""
    low = (bits & np.uint64(0x1FFFFF)).astype(np.float32)
    return (low + np.float32(0.5)) * np.float32(2.0**-21)


def _sortable(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of 32-bit floats."""
    bits = values.astype(np.float32).view(np.uint32)
    negative = (bits >> np.uint32(31)).astype(bool)
    return np.where(negative, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)


def _draws(hashes: np.ndarray, samples: int) -> tuple[np.ndarray, ...]:
    """r, ln c and beta of each word (row) and sample (column)."""
    places = np.arange(1, 2 * samples + 1, dtype=np.uint64).reshape(2, 1, samples)
    bits = _mix(hashes[None, :, None] + places * _GOLDEN)
    second = bits >> np.uint64(21)
    r = -np.log(_uniform(bits[0]) * _uniform(second[0]))
    c = -np.log(_uniform(bits[1]) * _uniform(second[1]))
    return r, np.log(c), _uniform(bits[0] >> np.uint64(42))


def _keys(hashes: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """For each word and sample a number: the value in front, then bits of (word, t)."""
    r, log_c, beta = _draws(hashes, samples)
    t = np.floor(np.log(weights.astype(np.float32))[:, None] / r + beta)
    value = log_c - r * (t - beta + np.float32(1))
    steps = np.minimum(t, np.float32(2.0**62)).astype(np.int64).view(np.uint64)
    code = ((hashes >> np.uint64(32))[:, None] + steps * _GOLDEN) & _LOW
    return (_sortable(value) << np.uint64(32)) | code


class Sampler:
    """Fingerprints of texts; remembers the commonest words' values."""

    def __init__(self, samples: int = SAMPLES, remembered: int = 100_000):
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest
        self.samples = samples
        self.known: dict[str, int] = {}
        self.table = np.empty((remembered, samples), np.uint64)

    def _hashes(self, words: list[str]) -> np.ndarray:
        return np.array(
            [self.hash(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64
        )

    def _once(self, words: list[str]) -> np.ndarray:
        """Keys of words that a text has once."""
        keys = np.empty((len(words), self.samples), np.uint64)
        at = [self.known.get(w, -1) for w in words]
        where = np.array(at, np.int64)
        keys[where >= 0] = self.table[where[where >= 0]]
        new = np.flatnonzero(where < 0)
        for start in range(0, len(new), 2048):
            part = new[start : start + 2048]
            hashes = self._hashes([words[i] for i in part])
            keys[part] = _keys(hashes, np.ones(len(part)), self.samples)
        room = len(self.table) - len(self.known)
        for i in new[:room]:
            self.table[len(self.known)] = keys[i]
            self.known[words[i]] = len(self.known)
        return keys

    def sample(self, texts: list[str]) -> list[np.ndarray]:
        """16 bits of each sample of each text; none for a text without words."""
        weights = [Counter(WORDS.findall(text)) for text in texts]
        words = list(dict.fromkeys(w for counted in weights for w in counted))
        index = dict(zip(words, range(len(words)), strict=True))
        once = self._once(words)
        often = list({item for counted in weights for item in counted.items() if item[1] > 1})
        place = dict(zip(often, range(len(often)), strict=True))
        several = np.empty((len(often), self.samples), np.uint64)
        for start in range(0, len(often), 2048):
            part = often[start : start + 2048]
            hashes = self._hashes([w for w, _ in part])
            several[start : start + 2048] = _keys(
                hashes, np.array([n for _, n in part]), self.samples
            )
        found = []
        for counted in weights:
            least = np.full(self.samples, np.iinfo(np.uint64).max, np.uint64)
            one = np.array([index[w] for w, n in counted.items() if n == 1], np.int64)
            more = np.array([place[x] for x in counted.items() if x[1] > 1], np.int64)
            for rows, table in ((one, once), (more, several)):
                for start in range(0, len(rows), 4096):
                    part = table[rows[start : start + 4096]].min(axis=0)
                    np.minimum(least, part, out=least)
            codes = (least & np.uint64(0xFFFF)).astype(np.uint16)
            found.append(codes if counted else codes[:0])
        return found


@cache
def sampler(samples: int) -> Sampler:
    """One sampler for each Python worker, so that its memory outlives a task."""
    return Sampler(samples)


def fingerprint(codes: np.ndarray) -> str:
    """Four hexadecimal digits a sample; '' for a text without words."""
    return codes.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: estimates the generalised Jaccard similarity.

    Two texts without words are alike (1), one without and one with words are not (0).
    """
    if len(a) != len(b):
        return 0.0
    return float((a == b).mean()) if len(a) else 1.0


def fingerprints(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and the fingerprint of each whole text, a row for each row; no shuffle.

    A null text is empty. Equal texts have equal fingerprints.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sampler(samples).sample
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = []
            for start in range(0, len(texts), GROUP):
                codes = sample(texts[start : start + GROUP])
                found += [fingerprint(c) for c in codes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string())],
                names=["doc_id", "fingerprint"],
            )

    schema = "doc_id bigint, fingerprint string"
    return documents.select("doc_id", "text").mapInArrow(over, schema)


# -- each document and the next ------------------------------------------------


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(documents: DataFrame, n: int) -> DataFrame:
    """(id_range, doc_id, text): ranges of ids with about equal numbers of rows.

    Ends of ranges are ids of a sample drawn by hash, of about CELLS rows for each range
    whatever the ids are like. What is collected are its distinct ids with their numbers of
    rows. Null ids come first.
    """
    docs = documents.select("doc_id", "text")
    ids = docs.where("doc_id IS NOT NULL").select("doc_id")
    step = max(1, ids.count() // (CELLS * n))
    drawn = ids.where(F.pmod(F.xxhash64(F.lit("ranges"), "doc_id"), F.lit(step)) == 0)
    sample = sorted(map(tuple, drawn.groupBy("doc_id").count().collect()))
    each = max(1, -(-sum(rows for _, rows in sample) // n))
    ends, total = [], 0
    for doc_id, rows in sample:
        if total // each > len(ends):
            ends.append(doc_id)
        total += rows
    # halving: how many ends are at most the id
    table = F.split(F.lit(",".join(map(str, ends))), ",").cast("array<bigint>")
    halves = [1 << i for i in reversed(range(len(ends).bit_length()))]
    if not halves:
        return docs.withColumn("id_range", F.lit(0))
    below = F.aggregate(
        F.array(*map(F.lit, halves)),
        F.lit(0),
        lambda low, half: low
        + F.when(F.get(table, low + half - 1) <= F.col("doc_id"), half).otherwise(0),
    )
    return docs.withColumn("id_range", below)


def _with_first_of_next(ranged: DataFrame) -> DataFrame:
    """Adds to each range the first document of the range after it (the last: the first).

    There is one such row for each range; ``ahead`` marks them.
    """
    spark = ranged.sparkSession
    firsts = ranged.groupBy("id_range").agg(
        F.min("doc_id").alias("doc_id"), F.count_if(F.col("doc_id").isNull()).alias("nulls")
    )
    firsts = sorted(firsts.collect(), key=lambda r: r["id_range"])
    rows = ranged.withColumn("ahead", F.lit(0))
    if not firsts:
        return rows
    ids = {r["id_range"]: None if r["nulls"] else r["doc_id"] for r in firsts}
    order = list(ids)
    before = dict(zip(order, order[-1:] + order[:-1], strict=True))
    is_first = F.col("doc_id").isin([i for i in ids.values() if i is not None])
    if None in ids.values():
        is_first = is_first | F.col("doc_id").isNull()
    targets = spark.createDataFrame(list(before.items()), "id_range int, before int")
    first = ranged.where(is_first).groupBy("id_range", "doc_id").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text")
    )
    first = first.join(F.broadcast(targets), "id_range")  # a row for each range
    ahead = first.select(
        "doc_id", "text", F.col("before").alias("id_range"), F.lit(1).alias("ahead")
    )
    return rows.unionByName(ahead)


EDITED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited_fingerprints(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each text and of its edited form, and likenesses; see EDITED.

    The next document is that of the next id (equal ids: by text; null ids first); after
    the last comes the first. A null text is empty. An only document is its own next.
    Equal rows each have a row.

    Ranges of ids are sorted in their partitions and read in one pass, each document
    waiting for the next; the one row that a range needs of the following is sent along.
    Texts are shuffled once.
    """
    n = shuffle_partitions(documents.sparkSession)
    names = [field.split()[0] for field in EDITED.split(", ")]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (range, ahead, doc_id, text), the last not yet done
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            rows = zip(*columns, strict=True)
            for row in rows:
                held.append((*row[:3], row[3] or ""))
                if len(held) > GROUP:
                    yield done(held)
                    held = held[-1:]
        if len(held) > 1:
            yield done(held)

    def done(held: list[tuple]) -> pa.RecordBatch:
        texts = [row[3] for row in held]
        pairs = [i for i in range(len(held) - 1) if not held[i][1]]
        edited = [edited_text(texts[i], texts[i + 1]) for i in pairs]
        codes = sampler(samples).sample(texts + edited)
        rows = []
        for i, text, codes_edited in zip(pairs, edited, codes[len(texts) :], strict=True):
            digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
            rows.append(
                (
                    held[i][2],
                    len(texts[i]),
                    digest,
                    fingerprint(codes[i]),
                    fingerprint(codes_edited),
                    likeness(codes[i], codes_edited),
                    likeness(codes[i], codes[i + 1]),
                )
            )
        types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )

    rows = _with_first_of_next(_ranges(documents, RANGES * n)).select(
        "id_range", "ahead", "doc_id", "text"
    )
    dealt = rows.repartition(n, "id_range")
    return dealt.sortWithinPartitions("id_range", "ahead", "doc_id", "text").mapInArrow(
        over, EDITED
    )
