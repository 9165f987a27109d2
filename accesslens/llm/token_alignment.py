"""Alignment of two tokenizers' ids over whole texts.

A text with a blank before it is tokenized by a byte-level vocabulary (A) and by a piece
vocabulary (B), which adds that blank itself. Both give the bytes of the text, so a token has an
end, the number of bytes up to it. The ends of either side are the keys to its tokens; the sorted
intersection of the keys slices both lists into groups, and the links of a group are its tokens
with overlapping bytes: one for each run of bytes between two ends of whichever side.

Neither tokenizer has a token across a single blank between two other characters, nor across a
line end between two: texts are cut before those, and both sides end a token there. So chunks
are tokenized and aligned by themselves, each distinct one of a batch once, and a text's groups are
those of its chunks. Whether that holds of a vocabulary is found out from its pieces.

How often an id pair is linked in all documents needs all documents: each document's pairs
are stored with their numbers, and every task's sums besides, which are added up. The pairs that
occur most often, up to a fixed number, go to every task; a pair that isn't found among them
is looked up by a join, if there are others that have more than one link or are best.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, compress, repeat
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import written
from accesslens.llm.tokens import groups

#: Chunks a Python worker remembers, the longest of them, and bytes of text taken at once.
REMEMBERED, LONGEST, TOGETHER = 200_000, 32, 3_000_000
#: Sums of pairs that a task holds before it hands them on.
HELD = 500_000
#: Pairs that go to every task: 40 bytes each there.
FREQUENT = 1_000_000

#: Chunks start at a single blank between others, or at a single line end between others.
CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
#: Texts that can't be cut at blanks and line ends alone. ``MARK`` stands before a whole chunk.
ODD = (
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}\x00]|[ \n]{2}|\A[ \n]|[ \n]\z"
)
MARK = "\0"

BLANK = "▁"  # how the piece vocabulary writes a blank
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

_PAIRS = "array<struct<pair: bigint, times: bigint>>"
COLUMNS = {
    "row": "bigint", "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint",
    "n_groups": "bigint", "n_links": "bigint", "groups": "string",
    "pairs": _PAIRS, "sums": _PAIRS,
}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, others in order for what comes after it.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + n): b for n, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    byte = _BYTE_PIECE.fullmatch(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace(BLANK, " ").encode()


@dataclass
class Aligned:
    """What is known of chunks, a row of each array for a chunk.

    ``numbers`` are those of tokens of A and of B, of groups and of links, all zero where one side's
    bytes aren't the chunk's (``good`` is false); ``texts`` the groups as text; ``pairs`` the linked
    ids of all chunks in order, as ``a * n_pieces + b``.
    """

    good: np.ndarray
    numbers: np.ndarray
    texts: pa.Array
    pairs: np.ndarray

    @classmethod
    def none(cls, n: int = 0) -> Aligned:
        texts = pa.array([""] * n, pa.string())
        return cls(np.zeros(n, bool), np.zeros((n, 4), np.int64), texts, np.zeros(0, np.int64))

    def take(self, rows: np.ndarray) -> Aligned:
        numbers = self.numbers[rows]
        ends = np.cumsum(self.numbers[:, 3])
        each = numbers[:, 3]
        pairs = self.pairs[_runs(ends[rows] - each, each)]
        return Aligned(self.good[rows], numbers, self.texts.take(pa.array(rows)), pairs)

    @staticmethod
    def joined(parts: list[Aligned]) -> Aligned:
        return Aligned(
            np.concatenate([p.good for p in parts]),
            np.concatenate([p.numbers for p in parts]),
            pa.concat_arrays([p.texts for p in parts]),
            np.concatenate([p.pairs for p in parts]),
        )


def _runs(first: np.ndarray, each: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each run, ``each`` long, one run after the other."""
    ends = np.cumsum(each)
    return np.repeat(first - (ends - each), each) + np.arange(each.sum())


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in order, and how many each list has."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, counts.sum()), counts


class Aligner:
    """Tokenizes and aligns chunks; remembers the short ones it has met.

    Chunks are aligned together: their bytes stand one after the other, so the ends of all their
    tokens are a sorted array on either side, which no Python code goes through one by one.
    """

    def __init__(self, letters: str, pieces: str, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(letters)
        self.a.encode_special_tokens = True
        byte_of = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            if all(c in byte_of for c in token):
                self.bytes_a[i] = bytes(map(byte_of.__getitem__, token))
        self.b = SentencePieceProcessor(model_file=pieces)
        self.n_pieces = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(self.n_pieces)]
        self.bytes_b = [piece_bytes(name) for name in names]
        self.blank_id = self.b.piece_to_id(BLANK)
        self.cuts = not any(re.search(rf"[^{BLANK}]{BLANK}|\n", name) for name in names)
        self.sizes_a = np.fromiter(map(len, self.bytes_a), np.int64, len(self.bytes_a))
        self.sizes_b = np.fromiter(map(len, self.bytes_b), np.int64, self.n_pieces)
        # ids with what follows them: inside a group; A's last there; B's; B's last of a chunk
        n_a, n_b = range(len(self.bytes_a)), range(self.n_pieces)
        kinds = [(n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";"), (n_b, "")]
        self.written_out = pa.array([f"{i}{mark}" for n, mark in kinds for i in n], pa.string())
        self.known: dict[str, int] = {}  # rows of what is remembered
        self.rows = Aligned.none()
        self.remembered = remembered

    def cut(self, text: str) -> list[str]:
        """Chunks of a text; those that follow a blank without it, others with a mark."""
        if not self.cuts:
            return [f"{MARK} {text}"]
        first, *others = CUT.split(text)
        return [f"{MARK} {first}", *(MARK + c if c[0] in "\n\0" else c for c in others)]

    def _whole(self, chunk: str) -> str:
        if chunk[0] == MARK:
            # behind a cut at a blank, a chunk that starts with the mark's own character
            return chunk[1:] if chunk[1:2] in (" ", "\n") else f" {chunk[1:]}"
        return chunk if chunk[0] == "\n" else f" {chunk}"

    def _pieces(self, chunks: list[str]) -> list[list[int]]:
        """B's ids of whole chunks. The blank that it adds is the one that most start with."""
        blank = [c[0] == " " for c in chunks]
        ids = self.b.encode([c[1:] if b else c for c, b in zip(chunks, blank, strict=True)])
        return [
            i if b else i[1:] if i[:1] == [self.blank_id] else [0]
            for i, b in zip(ids, blank, strict=True)
        ]

    def _sound(self, whole: list[bytes], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether both sides' bytes are a chunk's."""
        good = np.full(len(whole), True)
        sizes = np.fromiter(map(len, whole), np.int64, len(whole))
        text = b"".join(whole)
        for ids, parts, lengths in (a, self.bytes_a, self.sizes_a), (b, self.bytes_b, self.sizes_b):
            flat, counts = _flat(ids)
            upto = np.concatenate(([0], np.cumsum(lengths[flat])))
            own = np.diff(upto[np.concatenate(([0], np.cumsum(counts)))])
            found = b"".join(map(parts.__getitem__, chain.from_iterable(ids)))
            if found != text or (own != sizes).any():
                each = (b"".join(map(parts.__getitem__, i)) for i in ids)
                good &= np.fromiter(map(eq, each, whole), bool, len(whole))
        return good

    def _align(self, whole: list[bytes], a: list[list[int]], b: list[list[int]]) -> Aligned:
        """Alignment of chunks with their bytes and ids of both sides, which give these bytes."""
        (ids_a, n_a), (ids_b, n_b) = _flat(a), _flat(b)
        of_chunks = np.cumsum(np.fromiter(map(len, whole), np.int64, len(whole)))
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        sides = np.zeros(of_chunks[-1] + 1, np.uint8)
        sides[ends_a] = 1
        sides[ends_b] |= 2
        # a link for each run of bytes without an end of either side inside
        links, ends = np.flatnonzero(sides), np.flatnonzero(sides == 3)
        pairs = ids_a[np.searchsorted(ends_a, links)] * self.n_pieces
        pairs += ids_b[np.searchsorted(ends_b, links)]
        n_links = np.diff(np.searchsorted(links, of_chunks, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(ends, of_chunks, "right"), prepend=0)
        # as text, a group's tokens of A stand before those of B
        upto_a = np.searchsorted(ends_a, ends, "right")
        upto_b = np.searchsorted(ends_b, ends, "right")
        each_a, each_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        marked = np.empty(len(ids_a) + len(ids_b), np.int64)
        coded_a, coded_b = ids_a.copy(), ids_b + 2 * len(self.bytes_a)
        coded_a[upto_a - 1] += len(self.bytes_a)
        coded_b[upto_b - 1] += self.n_pieces
        coded_b[np.cumsum(n_b) - 1] += self.n_pieces
        marked[np.arange(len(ids_a)) + np.repeat(upto_b - each_b, each_a)] = coded_a
        marked[np.arange(len(ids_b)) + np.repeat(upto_a, each_b)] = coded_b
        offsets = np.concatenate(([0], np.cumsum(n_a + n_b))).astype(np.int32)
        parts = self.written_out.take(pa.array(marked))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), parts), "")
        numbers = np.stack((n_a, n_b, n_groups, n_links), axis=1)
        return Aligned(np.full(len(whole), True), numbers, texts, pairs)

    def _new(self, chunks: list[str]) -> Aligned:
        whole = [self._whole(c) for c in chunks]
        a = [x.ids for x in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        b = self._pieces(whole)
        whole = [w.encode("utf-8", "surrogatepass") for w in whole]
        good = self._sound(whole, a, b)
        if good.all():
            return self._align(whole, a, b)
        if not good.any():
            return Aligned.none(len(chunks))
        found = self._align(*(list(compress(x, good)) for x in (whole, a, b)))
        rows = np.where(good, np.cumsum(good) - 1, len(found.good))
        return Aligned.joined([found, Aligned.none(1)]).take(rows)

    def chunks(self, chunks: list[str]) -> Aligned:
        """What is known of distinct chunks."""
        rows = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = [c for c, row in zip(chunks, rows.tolist(), strict=True) if row < 0]
        if not new:
            return self.rows.take(rows)
        parts = [self._new(new[at : at + 10_000]) for at in range(0, len(new), 10_000)]
        found = Aligned.joined(parts)
        rows[rows < 0] = np.arange(len(new)) + len(self.known)
        every = Aligned.joined([self.rows, found])
        short = [i for i, c in enumerate(new) if len(c) <= LONGEST]
        short = short[: max(0, self.remembered - len(self.known))]
        if short:
            self.known.update((new[i], row) for row, i in enumerate(short, len(self.known)))
            self.rows = Aligned.joined([self.rows, found.take(np.array(short))])
        return every.take(rows)

    def lists(self, texts: pa.Array) -> pa.ListArray:
        """Chunks of each text; none of empty ones."""
        odd = np.full(len(texts), True)
        if self.cuts:
            odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        if not (odd | empty).any():
            return split
        values = split.flatten()
        ends = np.asarray(split.offsets) - split.offsets[0].as_py()
        parts, counts = [], []
        for i in range(len(texts)):
            if empty[i]:
                counts.append(0)
            elif odd[i]:
                own = pa.array(self.cut(texts[i].as_py()), pa.string())
                parts.append(own)
                counts.append(len(own))
            else:
                parts.append(values[ends[i] : ends[i + 1]])
                counts.append(int(ends[i + 1] - ends[i]))
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        joined = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
        return pa.ListArray.from_arrays(pa.array(offsets), joined)


def n_pieces(pieces: str) -> int:
    """How many pieces a vocabulary has."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=pieces).get_piece_size()


@cache
def aligner(letters: str, pieces: str, remembered: int) -> Aligner:
    """One for each Python worker, so that its memory outlives a task."""
    return Aligner(letters, pieces, remembered)


def _pair_lists(offsets: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> pa.ListArray:
    fields = [pa.array(pairs, pa.int64()), pa.array(times, pa.int64())]
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["pair", "times"])
    )


def align_texts(texts: pa.Array, aligned: Aligner) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """Columns n_a to pairs of texts, and their distinct pairs with numbers."""
    lists = aligned.lists(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    where = np.asarray(coded.indices).astype(np.int64)
    starts = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
    known = aligned.chunks(coded.dictionary.to_pylist())
    bad_before = np.concatenate(([0], np.cumsum(~known.good[where])))
    sound = (bad_before[starts[1:]] == bad_before[starts[:-1]]) & (starts[1:] > starts[:-1])
    numbers = known.numbers
    sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(numbers[where], axis=0)))
    totals = (sums[starts[1:]] - sums[starts[:-1]]) * sound[:, None]
    written_out = known.texts.take(coded.indices)
    joined = pc.binary_join(
        pa.ListArray.from_arrays(pa.array(starts, pa.int32()), written_out), ";"
    )
    joined = pc.if_else(pa.array(sound), joined, "")
    # pairs by number among the distinct ones, at each place of a chunk, with its text
    distinct, number = np.unique(known.pairs, return_inverse=True)
    sizes = numbers[:, 3]
    first = np.cumsum(sizes) - sizes
    text_of = np.repeat(np.arange(len(lists)), starts[1:] - starts[:-1])
    used = where[sound[text_of]] if len(where) else where
    each = sizes[used]
    take = _runs(first[used], each)
    owner = np.repeat(text_of[sound[text_of]] if len(where) else text_of, each)
    n = max(len(distinct), 1)
    keys, times = np.unique(owner * n + number[take], return_counts=True)
    per_text = np.bincount(keys // n, minlength=len(lists)) if len(keys) else np.zeros(len(lists))
    offsets = np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)
    pairs = distinct[keys % n] if len(keys) else np.zeros(0, np.int64)
    columns = [pa.array(totals[:, i], pa.int64()) for i in range(4)]
    columns += [joined, _pair_lists(offsets, pairs, times)]
    all_times = np.bincount(keys % n, weights=times, minlength=n)[: len(distinct)]
    linked_here = all_times > 0  # others are only of chunks of texts without tokens
    return columns, distinct[linked_here], all_times[linked_here].astype(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    times = np.bincount(at, weights=np.concatenate([t for _, t in parts]), minlength=len(pairs))
    return pairs, times.astype(np.int64)


def alignments(
    documents: DataFrame, letters: str, pieces: str, remembered: int = REMEMBERED
) -> DataFrame:
    """Alignment of each document's text; columns as in ``COLUMNS``.

    ``row`` numbers the rows, ``groups`` is ``a1,a2|b1;a3|b2`` with the ids in order, ``pairs``
    has each linked pair ``a * number of pieces + b`` with the number of its links.
    Rows without ``row`` have sums of ``pairs`` over documents in ``sums``.

    A null or empty text, and one that the bytes of one side's tokens don't give back (such as one
    with the character that B writes for a blank), has no tokens: zeros and ''. Null and
    equal doc_ids are rows like others. An empty table gives none. Other columns are not read.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = aligner(letters, pieces, remembered)
        names = list(COLUMNS)
        row = TaskContext.get().partitionId() << 40
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def handed_on(pairs: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
            longs = [pa.nulls(1, pa.int64())] * 6
            lists = _pair_lists(np.array([0, len(pairs)]), pairs, times)
            columns = [*longs, pa.nulls(1, pa.string()), pa.nulls(1, lists.type), lists]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for start, texts in groups(batch.column(1), TOGETHER):
                columns, pairs, times = align_texts(texts, aligned)
                rows = pa.array(np.arange(row, row + len(texts)), pa.int64())
                row += len(texts)
                ids = batch.column(0).slice(start, len(texts))
                none = pa.nulls(len(texts), columns[-1].type)
                yield pa.RecordBatch.from_arrays([rows, ids, *columns, none], names=names)
                held.append((pairs, times))
                if sum(len(p) for p, _ in held) > HELD:
                    held = [_added(held)]
                    if len(held[0][0]) > HELD // 2:
                        yield handed_on(*held.pop())
        if held:
            yield handed_on(*_added(held))

    columns = documents.select(F.col("doc_id").cast("bigint"), "text")
    schema = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())
    return columns.mapInArrow(over, schema)


def link_counts(stored: DataFrame, n_pieces: int) -> DataFrame:
    """(pair, n, best): links of each pair in all documents of stored alignments.

    ``best`` is true of the pairs that have the most links among those of their B id.
    """
    sums = stored.where("sums IS NOT NULL").select(F.inline("sums"))
    counts = sums.groupBy("pair").agg(F.sum("times").alias("n"))
    counts = written(counts, "pairs")
    # a row for each id of the vocabulary at most
    most = counts.groupBy(F.pmod("pair", F.lit(n_pieces)).alias("b")).agg(F.max("n").alias("most"))
    b = F.pmod(F.col("pair"), F.lit(n_pieces))
    marked = counts.withColumn("b", b).join(F.broadcast(most), "b")
    return marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> tuple[int | None, bool]:
    """(least, all): how often pairs occur that, with all best ones, are ``most`` at most.

    ``all`` is whether they are all pairs but those with a single link that aren't best.
    """
    bits = F.floor(F.log2("n")).cast("int").alias("bits")
    table = counts.groupBy(bits, "best").count().collect()  # under 130 rows
    for least in range(1, 64):
        chosen = sum(r["count"] for r in table if r.bits >= least or r.best)
        if chosen <= most:
            return 1 << least, least == 1
    return None, False


def with_link_counts(stored: DataFrame, n_pieces: int, frequent: int = FREQUENT) -> DataFrame:
    """Stored alignments of documents with ``n_best`` and ``count_sum``.

    ``n_best`` is the number of links whose pair is best, ``count_sum`` the sum over links of
    how many links their pair has in all documents.
    """
    counts = written(link_counts(stored, n_pieces), "link-counts")
    least, complete = _frequent(counts, frequent)
    links = stored.where("row IS NOT NULL").select("row", F.inline("pairs"))
    links = links.withColumns({"n": F.lit(None).cast("bigint"), "best": F.lit(None).cast("boolean")})

    def looked_up(links: DataFrame, table: DataFrame) -> DataFrame:
        found = table.toDF("pair", "found_n", "found_best")
        links = links.join(found, "pair", "left")
        return links.select(
            "row", "pair", "times",
            F.coalesce("n", "found_n").alias("n"), F.coalesce("best", "found_best").alias("best"),
        )

    if least is not None:
        high = F.col("best") | (F.col("n") >= least)
        links = looked_up(links, F.broadcast(counts.where(high)))
        counts = counts.where(~high & (F.col("n") > 1))
    if not complete:  # those that weren't found; the others' keys are null and join nothing
        known = links.where("n IS NOT NULL")
        links = looked_up(links.where("n IS NULL"), counts).unionByName(known)
    # what isn't in either table has one link and isn't best
    n, best = F.coalesce("n", F.lit(1)), F.coalesce("best", F.lit(False))
    sums = links.groupBy("row").agg(
        F.sum(F.when(best, F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * n).alias("count_sum"),
    )
    rows = stored.where("row IS NOT NULL").drop("pairs", "sums").join(sums, "row", "left")
    return rows.fillna(0, ["n_best", "count_sum"])
