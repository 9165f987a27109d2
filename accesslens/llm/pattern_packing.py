"""Packing of token sequences by patterns of lengths that fill a sequence.

Patterns of a few documents whose lengths add up to a full sequence are enumerated over
classes of lengths; how often to repeat each is fitted to the histogram of lengths by
non-negative least squares and rounded. Each repetition is a sequence with the documents of
its pattern. The remaining documents, longest first, go where they leave the least room, or
open further sequences.

All this works on the histogram, which has a row for each length however many documents
there are: documents of equal length are interchangeable, so a plan says how many
sequences hold which lengths. Documents then find their place by their rank among those
of their length. Only the histogram reaches the driver.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm import tokens
from accesslens.llm.common import fresh, small_table, written

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
CLASSES = 128  # of lengths; patterns are sums of them
RANK_ROWS = 1000  # rows of one length that are ranked together, about

Contents = tuple[tuple[int, int], ...]  # (length, how many of them)
Plan = list[tuple[Contents, int]]  # contents of a sequence, number of such sequences


# -- pieces -------------------------------------------------------------------


def cut_pieces(
    documents: DataFrame,
    vocabulary: str,
    max_tokens: int,
    end_id: int,
    chunks: str = "words",
    with_ids: bool = False,
    remembered: int = tokens.REMEMBERED,
    together: int = tokens.TOGETHER,
) -> DataFrame:
    """Token ids of every text and the end id, in pieces of at most ``max_tokens``.

    Only longer documents are cut. A null text has only the end id. A row for each
    piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids as
    unsigned 32-bit little-endian numbers. Each row of the input has its own pieces,
    also if ids or whole rows are equal; no row is left out, an empty table has none.
    ``remembered`` chunks and texts of ``together`` bytes bound the memory of a task.
    """
    schema = PIECES + (", ids binary" if with_ids else "")
    size = 4 * max_tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary, chunks, 4, remembered)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, group in tokens.groups(batch.column(1), together):
                rows = []
                for i, found in enumerate(encoder.encode(group), first):
                    ids = found + end
                    for n, at in enumerate(range(0, len(ids), size)):
                        part = ids[at : at + size]
                        row = (doc_ids[i], n, at // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, part) if with_ids else row)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                types += [pa.binary()] * with_ids
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return documents.select("doc_id", "text").mapInArrow(cut, schema)


# -- the plan -------------------------------------------------------------------


def patterns(classes: int) -> np.ndarray:
    """Multisets of two to four classes that add up to ``classes``, as counts.

    Of four, those whose classes are multiples of a sixteenth of the whole, so that
    short documents have patterns too without too many of these.
    """
    found = []
    for a in range(1, classes):
        for b in range(1, min(a, classes - a) + 1):
            c = classes - a - b
            if c == 0:
                found.append((a, b))
            elif 0 < c <= b:
                found.append((a, b, c))
    step = max(1, classes // 16)
    grid = range(step, classes, step)
    for a in grid:
        for b in (x for x in grid if x <= a):
            for c in (x for x in grid if x <= b):
                d = classes - a - b - c
                if 0 < d <= c:
                    found.append((a, b, c, d))
    counts = np.zeros((classes + 1, len(found)))
    for column, pattern in enumerate(found):
        for c in pattern:
            counts[c, column] += 1
    return counts


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by active sets."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        free[best] = True
        while True:
            columns = np.flatnonzero(free)
            solved = np.linalg.lstsq(a[:, columns], b, rcond=None)[0]
            if solved.min() > 0:
                x[:] = 0
                x[columns] = solved
                break
            low = solved <= 0
            with np.errstate(divide="ignore", invalid="ignore"):
                steps = x[columns][low] / (x[columns][low] - solved[low])
            step = float(np.nan_to_num(steps, nan=0.0).min())
            x[columns] += step * (solved - x[columns])
            x[columns[x[columns] <= tolerance]] = 0
            free = x > 0
            if not free.any():
                break
    return x


def _take(lengths: dict[int, int], order: list[int], n: int) -> list[tuple[int, int]]:
    """n documents of a class, the longest first: (length, how many)."""
    taken = []
    while n and order:
        length = order[-1]
        some = min(n, lengths[length])
        taken.append((length, some))
        lengths[length] -= some
        n -= some
        if not lengths[length]:
            order.pop()
    return taken


def _filled(left: dict[int, int], max_tokens: int, up: int) -> Plan:
    """Sequences that hold fitted patterns; takes what they hold from ``left``.

    A length's class is (length + ``up``) // the width of classes. A pattern is repeated as
    often as the fit says and its classes have documents. The last place of a pattern goes to
    the longest document that fits there: as lengths vary within their classes, that may be
    one of a class next to the pattern's.
    """
    width = -(-max_tokens // CLASSES)
    classes = max_tokens // width
    of_class: dict[int, list[int]] = defaultdict(list)
    lengths = sorted(left)
    for length in lengths:
        of_class[(length + up) // width].append(length)
    histogram = np.zeros(classes + 1)
    # longer documents fill a sequence alone; with the shortest, other classes might leave no room
    for c in range(2, classes):
        histogram[c] = sum(left[x] for x in of_class[c])
    counts = patterns(classes)
    counts = counts[:, (counts[histogram == 0] == 0).all(axis=0)]
    if not counts.shape[1]:
        return []
    # what doesn't fit counts by its length: short documents go anywhere later
    weight = np.sqrt(np.arange(classes + 1) / classes)[:, None]
    scale = histogram.max()
    fitted = nnls(counts * weight, histogram / scale * weight[:, 0]) * scale
    plan: Plan = []
    for column in np.argsort(-fitted, kind="stable"):
        used = np.flatnonzero(counts[:, column])
        most = (histogram[used] // counts[used, column]).min()
        repeats = int(min(fitted[column] + 0.5, most))
        if not repeats:
            continue
        pattern = [c for c in used[::-1] for _ in range(int(counts[c, column]))]
        groups: Plan = [((), repeats)]
        for c in pattern[:-1]:
            histogram[c] -= repeats
            taken = _take(left, of_class[c], repeats)
            split: Plan = []
            for contents, n in groups:
                while n:
                    length, some = taken.pop()
                    now = min(n, some)
                    split.append(((*contents, (length, 1)), now))
                    n -= now
                    if some > now:
                        taken.append((length, some - now))
            groups = split
        for contents, n in groups:
            room = max_tokens - sum(length for length, _ in contents)
            while n:
                at = bisect.bisect_right(lengths, room) - 1
                while at >= 0 and not left[lengths[at]]:
                    del lengths[at]
                    at -= 1
                if at < 0:
                    plan.append((contents, n))
                    break
                length = lengths[at]
                now = min(n, left[length])
                plan.append(((*contents, (length, 1)), now))
                n -= now
                left[length] -= now
                c = (length + up) // width
                if c < classes:
                    histogram[c] -= now
                if not left[length]:
                    of_class[c].remove(length)
    return plan


def pack_histogram(histogram: dict[int, int], max_tokens: int) -> Plan:
    """Contents of sequences that hold each length as often as the histogram says.

    Patterns are fitted twice, to classes of lengths rounded up and to the nearest: rounded up
    all patterns fit, to the nearest they are full on average. The plan with fewer sequences
    counts.
    """
    width = -(-max_tokens // CLASSES)
    plans = [_packed(histogram, max_tokens, up) for up in (width - 1, width // 2)]
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def _packed(histogram: dict[int, int], max_tokens: int, up: int) -> Plan:
    """Fitted patterns, and best fit for the rest in the room they leave."""
    left = {length: n for length, n in histogram.items() if n}
    spaces: dict[int, list[list]] = defaultdict(list)  # room -> [contents, count]
    for contents, n in _filled(left, max_tokens, up):
        room = max_tokens - sum(length * m for length, m in contents)
        spaces[room].append([contents, n])
    rooms = sorted(spaces)
    for length in sorted(left, reverse=True):
        need = left[length]
        while need:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = max_tokens // length
                for m in (each, need % each):
                    n = need // each if m == each else min(m, 1)
                    if m and n:
                        room = max_tokens - m * length
                        if room not in spaces:
                            bisect.insort(rooms, room)
                        spaces[room].append([((length, m),), n])
                        need -= m * n
                    if not need:
                        break
                continue
            room = rooms[at]
            contents, n = spaces[room].pop()
            if not spaces[room]:
                del spaces[room], rooms[at]
            fits = min(room // length, max(1, need // n))
            now = min(n, need // fits)
            if now < n:
                if room not in spaces:
                    bisect.insort(rooms, room)
                spaces[room].append([contents, n - now])
            rest = room - fits * length
            if rest not in spaces:
                bisect.insort(rooms, rest)
            spaces[rest].append([(*contents, (length, fits)), now])
            need -= fits * now
    return [(contents, n) for groups in spaces.values() for contents, n in groups]


def slots(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """Where the documents of each length go, by their rank from 0.

    Rows (length, from rank, to rank, each, sequence, offset): ``each`` documents in a
    row go to one sequence, side by side from ``offset``.
    """
    rows, ranks, sequence = [], defaultdict(int), 0
    for contents, n in plan:
        offset = 0
        for length, each in contents:
            first = ranks[length]
            ranks[length] = first + each * n
            rows.append((length, first, ranks[length], each, sequence, offset))
            offset += length * each
        sequence += n
    return rows


# -- places -----------------------------------------------------------------------


def pack_pieces(pieces: DataFrame, max_tokens: int) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with their places.

    Adds sequence_id and offset: pieces of a sequence stand side by side from 0 and
    add up to at most ``max_tokens``. Any other columns of the pieces are kept, whatever
    their names but those two; pieces
    longer than a sequence are an error. No pieces give no rows.

    ``pieces`` is read twice, so it should be stored. Pieces are ranked among those of
    their length by buckets of a hash, so that a length which a third of all have is
    ranked by many tasks. The slots that are broadcast have a few rows for each length.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").count().collect()  # at most max_tokens rows
    histogram = {row["length"]: row["count"] for row in counts}
    if histogram and (max(histogram) > max_tokens or min(histogram) < 1):
        raise ValueError("a piece has no length between 1 and max_tokens")
    rows = slots(pack_histogram(histogram, max_tokens))
    names = ("buckets", "bucket", "within", "before", "rank", "slot_length")
    buckets, bucket, within, before, rank, slot_length = (fresh(pieces, f"rank_{n}") for n in names)
    slot = [fresh(pieces, f"slot_{n}") for n in ("from", "to", "each", "sequence", "offset")]
    places = small_table(
        spark, rows, ", ".join(f"{name} bigint" for name in (slot_length, *slot))
    )
    dealt = small_table(
        spark,
        [(length, n // RANK_ROWS + 1) for length, n in histogram.items()],
        f"length bigint, {buckets} bigint",
    )
    key = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = pieces.join(F.broadcast(dealt), "length")
    dealt = dealt.withColumn(bucket, F.pmod(key, F.col(buckets)))
    same = Window.partitionBy("length", bucket)
    ranked = dealt.withColumn(
        within, F.row_number().over(same.orderBy("doc_id", "piece", "ids_crc32"))
    )
    earlier = Window.partitionBy("length").orderBy(bucket)
    totals = dealt.groupBy("length", bucket).agg(F.count(F.lit(1)).alias(within))
    totals = totals.withColumn(before, F.sum(within).over(earlier) - F.col(within))
    ranked = ranked.join(totals.drop(within), ["length", bucket])
    ranked = ranked.withColumn(rank, F.col(before) + F.col(within) - 1)
    first, end, each, sequence, offset = (F.col(name) for name in slot)
    fits = (F.col(rank) >= first) & (F.col(rank) < end)
    placed = ranked.join(F.broadcast(places), (F.col("length") == F.col(slot_length)) & fits)
    nth = F.col(rank) - first
    return placed.select(
        *[F.col(f"`{c}`") for c in pieces.columns],
        (sequence + F.floor(nth / each)).cast("bigint").alias("sequence_id"),
        (offset + nth % each * F.col("length")).alias("offset"),
    )


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    max_tokens: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
    **memory: int,
) -> DataFrame:
    """Cuts, stores and packs all documents; see ``cut_pieces`` and ``pack_pieces``."""
    pieces = cut_pieces(documents, vocabulary, max_tokens, end_id, with_ids=with_ids, **memory)
    return pack_pieces(written(pieces, "pieces"), max_tokens)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ids as whole sequences: sequence_id, ids, doc_ids, lengths.

    A group has at most as many rows as a sequence has tokens.
    """
    rows = F.array_sort(
        F.collect_list(F.struct("offset", F.col("length").alias("n"), "doc_id", "ids"))
    )
    return packed.groupBy("sequence_id").agg(rows.alias("rows")).select(
        "sequence_id",
        F.aggregate("rows.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        F.col("rows.doc_id").alias("doc_ids"),
        F.col("rows.n").alias("lengths"),
    )
