"""Groups of spelling variants by a frontier of states in a trie of words.

Words of all documents are counted, and those that are long and frequent enough are put
into a trie, whose nodes are named by their prefixes. A state is a word, a position in it, a node
and the number of edits, 0 or 1; all states move down level by level, each by a join of those of
a level with the level's edges. Without an edit a state follows its word's letters or branches off:
to another letter (replaced), or past a letter (deleted). With one it only follows the word. A
state that reaches the end of its word at the end of another one has found a near word.

What makes the frontier small: one edit leaves the first half of a word whole or the second, so a
word enters the trie below its first half, and below its reversed second half in
a trie of reversed words; both tries are one, under two roots. A replaced letter is only sought
among larger ones, and no inserted one, as the near word finds the same pair from its side.
Of equal letters in a row the last is deleted. States without an edit are on their word's
own path, so a level takes them from the words; only those with an edit are handed on.

Words of more than ``LEVELS`` letters, which would need as many joins, are compared by hashes of what
is left without one letter, and then letter by letter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import written
from accesslens.session import new_folder
from accesslens.sources.tables import delete

#: Letters, and how often a letter is deleted.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
EVERY = 97

MIN_LENGTH, MIN_COUNT = 5, 3
LEVELS = 48
#: Distinct words that a task counts before it hands them on.
HELD = 300_000

END = "$"
FORWARD, BACKWARD = ">", "<"


def text_words(doc_id: int | None, text: str, every: int | None = EVERY) -> Iterator[Counter]:
    """Words of a text and their numbers, then what has to be added for deleted letters."""
    words = RUN.findall(text)
    yield Counter(words)
    if every is None:
        return
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    hashes = ((w, crc32(w.encode(), start)) for w in set(words))
    marked = {w: h for w, h in hashes if not h % every}
    if marked:
        changed: Counter = Counter()
        for word, n in Counter(filter(marked.__contains__, words)).items():
            at = marked[word] % len(word)
            changed[word] -= n
            changed[word[:at] + word[at + 1 :]] += n
        yield changed


def count_words(
    documents: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    every: int | None = EVERY,
) -> DataFrame:
    """(word, n) of words that are long and frequent enough.

    Runs of letters, only A-Z in lower case. Of about one in ``every`` (document, run) the
    checksum of ``<doc_id>:<run>`` says which letter is left out; a null doc_id is written as
    nothing there.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            rows = [(w, n) for w, n in held.items() if n and len(w) >= min_length]
            held.clear()
            words, counts = [w for w, _ in rows], [n for _, n in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for i, value in enumerate(texts):
                text = value.as_py()
                if text is None:
                    continue
                # of bytes, only A-Z have lower case
                low = text.lower().decode("utf-8", "replace")
                for counts in text_words(batch.column(0)[i].as_py(), low, every):
                    held.update(counts)
                if len(held) > HELD:
                    yield handed_on()
        yield handed_on()

    columns = documents.select(F.col("doc_id").cast("bigint"), "text")
    counted = columns.mapInArrow(over, "word string, n bigint")
    totals = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return totals.where(F.col("n") >= min_count)


def _marked(words: DataFrame) -> DataFrame:
    """(m, enters): both spellings of each word between marks, and how many letters go first."""
    half = F.floor(F.length("word") / 2)
    forward = F.struct(
        F.concat(F.lit(FORWARD), "word", F.lit(END)).alias("m"),
        (half + 1).cast("int").alias("enters"),
    )
    backward = F.struct(
        F.concat(F.lit(BACKWARD), F.reverse("word"), F.lit(END)).alias("m"),
        (F.length("word") - half + 1).cast("int").alias("enters"),
    )
    return words.select(F.inline(F.array(forward, backward)))


def _letter(at: int | Column) -> Column:
    """The letter of ``m`` at a place from 0; '' behind the end."""
    return F.substring("m", F.lit(at) + 1, 1)


def _level(spelled: DataFrame, states: DataFrame | None, depth: int) -> DataFrame:
    """(m, place, node, done): states with an edit after the step from nodes of a depth.

    ``done`` ones are at the end of their word, and ``node`` is the near one.
    """
    here = spelled.where(F.length("m") > depth).withColumn("node", F.substring("m", 1, depth))
    edges = here.select("node", _letter(depth).alias("letter")).groupBy("node")
    edges = edges.agg(F.collect_set("letter").alias("letters"))
    fresh_states = here.where(F.col("enters") <= depth).select(
        "m", F.lit(depth).alias("place"), "node", F.lit(0).alias("edits")
    )
    moving = fresh_states
    if states is not None:
        carried = states.select("m", "place", "node", F.lit(1).alias("edits"))
        moving = moving.unionByName(carried)
    own, after = _letter(F.col("place")), _letter(F.col("place") + 1)
    has_own = F.array_contains("letters", own)

    def step(letter: Column, places: int) -> Column:
        done = letter == END
        return F.struct(
            (F.col("place") + places).cast("int").alias("place"),
            F.when(done, F.col("node")).otherwise(F.concat("node", letter)).alias("node"),
            done.alias("done"),
        )

    nothing = F.array().cast("array<struct<place:int,node:string,done:boolean>>")
    followed = F.when(has_own, F.array(step(own, 1))).otherwise(nothing)
    larger = F.filter("letters", lambda c: (c > own) & (c != END))
    replaced = F.when(own != END, F.transform(larger, lambda c: step(c, 1))).otherwise(nothing)
    past = (own != END) & (own != after) & F.array_contains("letters", after)
    deleted = F.when(past, F.array(step(after, 2))).otherwise(nothing)
    branched = F.concat(replaced, deleted)
    joined = moving.join(edges, "node")
    following = F.when(F.col("edits") == 1, followed).otherwise(branched)
    return joined.select("m", F.inline(following))


def _trie_pairs(words: DataFrame, folder: str) -> DataFrame | None:
    """(u, v) of words of at most ``LEVELS`` letters that are near, each pair once or more."""
    spelled = _marked(words)
    least, longest = spelled.agg(F.min("enters"), F.max(F.length("m"))).first()
    if least is None:
        return None
    levels: list[DataFrame] = []
    states = None
    for depth in range(least, longest):
        level = written(_level(spelled, states, depth), f"level-{depth}", folder)
        states = level.where("NOT done")
        levels.append(level.where("done").select("m", "node"))
    found = reduce(DataFrame.unionByName, levels)
    u = F.expr("substring(m, 2, length(m) - 2)")
    v = F.expr("substring(node, 2)")
    back = F.col("m").startswith(BACKWARD)
    return found.select(
        F.when(back, F.reverse(u)).otherwise(u).alias("u"),
        F.when(back, F.reverse(v)).otherwise(v).alias("v"),
    )


def rest_hashes(word: str) -> np.ndarray:
    """A hash of what is left of a word without each of its letters, and one of all of it."""
    letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(letters)
    powers = np.cumprod(np.full(n + 1, 0x9E3779B97F4A7C15, np.uint64))
    letters = (letters + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    letters ^= letters >> np.uint64(29)
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters * powers[:n])))
    shifted = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters[1:] * powers[: n - 1])))
    rest = before[:n] + (shifted[-1] - shifted[:n])
    return np.concatenate((rest, before[n:])).view(np.int64)


def _long_pairs(words: DataFrame) -> DataFrame:
    """(u, v) of near words of which the longer has more than ``LEVELS`` letters.

    Words without the same letter's place are equal only if that letter is all that differs, so
    there are no more of them than letters.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, key in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                hashes = rest_hashes(word)
                n = len(word)
                places = np.arange(n + 1, dtype=np.int64)
                places[n] = -1  # nothing is left out
                sizes = np.where(places < 0, n, n - 1)
                for start in range(0, n + 1, 100_000):
                    part = slice(start, start + 100_000)
                    same = np.full(len(hashes[part]), key, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (same, sizes[part], places[part], hashes[part])],
                        names=["key", "size", "place", "hash"],
                    )

    keyed = words.select("word", F.xxhash64("word").alias("key"))
    long = keyed.where(F.length("word") >= LEVELS)
    schema = "key bigint, size bigint, place bigint, hash bigint"
    rests = long.mapInArrow(over, schema)
    cut = rests.where("place >= 0").where(F.col("size") >= LEVELS)
    whole = rests.where("place < 0")
    other = cut.withColumnRenamed("key", "other")
    replaced = cut.join(other, ["size", "place", "hash"]).where("key < other")
    deleted = cut.join(whole.select("size", "hash", F.col("key").alias("other")), ["size", "hash"])
    pairs = replaced.select("key", "other").unionByName(deleted.select("key", "other")).distinct()
    u = long.select("key", F.col("word").alias("u"))
    v = long.select(F.col("key").alias("other"), F.col("word").alias("v"))
    pairs = pairs.join(u, "key").join(v, "other")
    return pairs.where(F.levenshtein("u", "v", 1) == 1).select("u", "v")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of words, both ways, that differ by one letter.

    By one that is inserted, deleted or replaced. ``words`` has each once, in ``word``; they
    consist of letters, that is, neither of ``$`` nor of ``<`` or ``>``.
    """
    spark = words.sparkSession
    words = words.select("word")
    folder = new_folder(spark, "llm-trie")
    short = _trie_pairs(words.where(F.length("word") <= LEVELS), folder)
    pairs = _long_pairs(words)
    pairs = pairs if short is None else short.unionByName(pairs)
    both = F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("near")),
                   F.struct(F.col("v").alias("word"), F.col("u").alias("near")))
    stored = written(pairs.select(F.inline(both)).distinct(), "near-words")
    delete(spark, [folder])
    return stored


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that follow from a word's.

    Each round makes the way twice as long. A form occurs twice as often as the word, so
    there are no circles and few rounds.
    """
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(further, "root", "left_semi").isEmpty():
            return roots
        moved = roots.join(further, "root", "left")
        roots = written(moved.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variant_groups(documents: DataFrame, **options) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of ``documents``.

    ``form`` is the near word with the largest n, the smallest of equal ones, if it occurs at
    least twice as often as the word, else null; ``root`` the last of the forms that follow
    from each other, the word itself if it has none. ``options`` are those of ``count_words``.

    A null text has no words. Rows count as often as they occur, equal or null doc_ids or not. An
    empty table gives no rows. Other columns are not read.
    """
    words = written(count_words(documents, **options), "words")
    near = near_words(words)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(counts, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    joined = words.join(best, "word", "left")
    most = -F.col("best.less")
    taken = most >= 2 * F.col("n")
    joined = written(
        joined.select(
            "word",
            F.when(taken, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(taken, most).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(joined.where("form IS NOT NULL"))
    found = joined.join(roots, "word", "left")
    root = F.coalesce("root", "word").alias("root")
    return found.select("word", "form", root, "n", "n_near", "form_n")
