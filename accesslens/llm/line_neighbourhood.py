"""Line deduplication by deletion neighbourhoods.

A line is a sequence of words; two lines are near if one word inserted, deleted or
replaced turns one into the other. All variants of a line with one word deleted are
emitted as hashed keys; lines with equal variants are joined and verified on their
words, and of near lines the earliest stays. A variant keeps the place of the deleted
word: lines with equal variants and places differ by a replaced word at most, all of
them among each other, so the earliest of a group is all that its lines need to know.

Only lines that can have a near one emit variants. If one edit turns a line into another,
then of the two halves of the shorter, one is a whole prefix or suffix of both; so each
line has four keys, of its prefixes and suffixes of about half its length, and those
without a key in common with another line have no near line.

Documents are ordered by doc_id and lines by their place. A line goes if an equal or near
one comes earlier, whether or not that one stays. Words are compared, so white space
doesn't matter. Every line with a word is compared for equality, unless ``min_chars`` asks for
longer ones; lines that aren't compared stay. Near lines have five words at least, so that four
in five words agree.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import fresh, small_table, text_or_empty, written

MIN_CHARS = 1
MIN_WORDS = 5
BROADCAST_ROWS = 300_000  # rows of 50 bytes at most that go to every executor
BITS = 1 << 40  # of a word's hash: sums over a line's words don't overflow


def _least_id() -> Column:
    """A null doc_id counts as the least there is."""
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63))).cast("bigint")


def _text_hashes() -> list[Column]:
    text = text_or_empty()
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def _ties(documents: DataFrame) -> DataFrame | None:
    """(id, t1, t2, tie) of documents whose doc_id others have too; None if there are none.

    Ties are numbers from 1 on in the order of ids and hashes of texts, dealt out by ranges and
    counted within each; only the sizes of ranges are put together. Equal texts have one.
    """
    spark = documents.sparkSession
    first, second = _text_hashes()
    texts = documents.select(_least_id().alias("id"), first.alias("t1"), second.alias("t2"))
    texts = written(texts.distinct(), "text-hashes")
    several = texts.groupBy("id").count().where("count > 1").select("id")
    shared = written(texts.join(several, "id", "left_semi"), "shared-ids")
    n_shared = shared.count()
    if not n_shared:
        return None
    if n_shared >= 10**9:
        raise ValueError(f"{n_shared} documents with ids that others have; 10^9 are too many")
    ordered = shared.orderBy("id", "t1", "t2").withColumn("at", F.monotonically_increasing_id())
    ordered = written(ordered, "ordered-ids")
    part = F.shiftright("at", 33)
    start, starts = 1, []
    for size in ordered.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((size.part, start))
        start += size["count"]
    offsets = F.broadcast(small_table(spark, starts, "part bigint, start bigint"))
    numbered = ordered.withColumn("part", part).join(offsets, "part")
    row = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return written(numbered.select("id", "t1", "t2", (F.col("start") + row).alias("tie")), "ties")


def _with_key(documents: DataFrame, ties: DataFrame | None, name: str) -> DataFrame:
    """``documents`` with a number that grows with doc_id and is one for each id and text."""
    billion = F.lit(10**9).cast("decimal(10,0)")
    number = _least_id().cast("decimal(19,0)") * billion
    if ties is None:
        return documents.withColumn(name, number.cast("decimal(28,0)"))
    names = {c: fresh(documents, c) for c in ("id", "t1", "t2", "tie")}
    keys = [names[c] for c in ("id", "t1", "t2")]
    hashed = documents.withColumns(dict(zip(keys, [_least_id(), *_text_hashes()], strict=True)))
    joined = hashed.join(_checked(ties).withColumnsRenamed(names), keys, "left")
    tie = F.coalesce(F.col(names["tie"]), F.lit(0)).cast("decimal(9,0)")
    return joined.withColumn(name, (number + tie).cast("decimal(28,0)")).drop(*names.values())


def _at() -> Column:
    """Where a line is: a number that grows with documents and places."""
    billion = F.lit(10**9).cast("decimal(10,0)")
    return (F.col("doc_key") * billion + F.col("place")).cast("decimal(38,0)")


def _place_of(at: Column) -> tuple[Column, Column]:
    """(document's number, place of the line) of where a line is."""
    billion = F.lit(10**9).cast("decimal(10,0)")
    place = F.pmod(at, billion)
    return ((at - place) / billion).cast("decimal(28,0)"), place.cast("int")


def _normal(line: Column) -> Column:
    """A line's words with single blanks between them.

    Most lines are like that; finding out takes a small part of a pattern's time.
    """
    odd = [line.contains(c) for c in ("  ", "\t", "\x0b", "\x0c", "\r")]
    single = F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")
    return F.trim(F.when(reduce(or_, odd), single).otherwise(line))


def _count(line: Column) -> Column:
    blanks = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return (blanks + 1).cast("bigint")


def _lines(keyed: DataFrame) -> DataFrame:
    """(doc_key, place, raw) of the lines of documents."""
    split = F.split(text_or_empty(), "\n", -1)
    return keyed.select("doc_key", F.posexplode(split).alias("place", "raw"))


def _identity() -> list[Column]:
    return [
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit("second"), "line").alias("h2"),
    ]


def _halves(line: Column, n: Column) -> Column:
    """Keys of a line's halves, as the shorter or equal one and as the longer one."""

    def pair(s: Column) -> list[Column]:
        half = F.floor(s / 2).cast("int")
        prefix = F.call_function("substring_index", line, F.lit(" "), half)
        suffix = F.call_function("substring_index", line, F.lit(" "), half - s.cast("int"))
        return [F.xxhash64(s, F.lit("p"), prefix), F.xxhash64(s, F.lit("s"), suffix)]

    return F.array(*pair(n), *pair(n - 1))


def _distinct(keyed: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, n, at, halves) of distinct lines; ``at`` is where the earliest is."""
    lines = _lines(keyed).select("doc_key", "place", _normal(F.col("raw")).alias("line"))
    lines = lines.where(F.length("line") >= min_chars)
    n = _count(F.col("line"))
    halves = F.when(n >= MIN_WORDS - 1, _halves(F.col("line"), n))
    rows = lines.select(*_identity(), n.alias("n"), _at().alias("at"), halves.alias("x"))
    rows = rows.select("h1", "h2", "n", "at", *[F.col("x")[i].alias(f"x{i}") for i in range(4)])
    least = rows.groupBy("h1", "h2").agg(
        F.min("at").alias("at"), *[F.first(c).alias(c) for c in ("n", "x0", "x1", "x2", "x3")]
    )
    return least.select("h1", "h2", "n", "at", F.array("x0", "x1", "x2", "x3").alias("halves"))


def _candidates(distinct: DataFrame) -> DataFrame:
    """(at, n) of distinct lines that share a half with another one."""
    keyed = distinct.where("halves[0] IS NOT NULL")
    keyed = keyed.select("h1", "at", "n", F.explode("halves").alias("half"))
    shared = keyed.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
    shared = _checked(written(shared.where("a <> b").select("half"), "halves"))
    found = keyed.join(shared, "half", "left_semi").select("at", "n").distinct()
    return written(found, "candidates")


def _texts_of(keyed: DataFrame, candidates: DataFrame) -> DataFrame:
    """(at, n, line) of candidates: read at their places, only in the documents that have them.

    Rows with equal ids and texts are one document, so each line is taken once.
    """
    documents = candidates.select(_place_of(F.col("at"))[0].alias("doc_key")).distinct()
    own = _checked(written(documents, "candidate-documents"))
    lines = _lines(keyed.join(own, "doc_key", "left_semi"))
    lines = lines.select(_at().alias("at"), "raw")
    found = lines.join(_checked(candidates), "at")
    return found.select("at", "n", _normal(F.col("raw")).alias("line")).dropDuplicates(["at"])


def _checked(df: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if it is small; if not, Spark joins by sorting."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _variants(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(at, n, i, v1, v2) with the i-th word deleted, and (at, n, v1, v2) of whole lines.

    A line's hash is the sum of its words' hashes with their places; behind a deleted
    word places are less by one. Running sums give all variants in one pass.
    """
    words = candidates.select("at", "n", F.posexplode(F.split("line", " ", -1)).alias("i", "word"))

    def hashed(salt: int, place: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "word", place), F.lit(BITS))

    line = Window.partitionBy("at")
    before = line.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    after = line.orderBy("i").rowsBetween(1, Window.unboundedFollowing)
    columns = {}
    for salt in (1, 2):
        words = words.withColumn(f"own{salt}", hashed(salt, F.col("i")))
        words = words.withColumn(f"moved{salt}", hashed(salt, F.col("i") - 1))
    for salt in (1, 2):
        down = F.coalesce(F.sum(f"own{salt}").over(before), F.lit(0))
        # what follows, from the total: no second order
        total = F.sum(f"moved{salt}").over(line)
        upto = F.sum(f"moved{salt}").over(before)
        up = total - F.coalesce(upto, F.lit(0)) - F.col(f"moved{salt}")
        columns[f"v{salt}"] = down + up
        columns[f"whole{salt}"] = F.sum(f"own{salt}").over(line)
    found = words.withColumns(columns)
    variants = found.select("at", "n", "i", "v1", "v2")
    whole = found.where("i = 0").select("at", "n", "whole1", "whole2")
    return variants, whole.toDF("at", "n", "v1", "v2")


def _near(candidates: DataFrame) -> DataFrame:
    """(at, earlier) of lines that have a near one earlier, verified on their words."""
    variants, whole = _variants(candidates)
    variants = written(variants, "variants")
    whole = written(whole, "whole")
    long = variants.where(F.col("n") >= MIN_WORDS)
    key = ["n", "i", "v1", "v2"]
    first = long.groupBy(*key).agg(F.min("at").alias("earlier"), F.max("at").alias("last"))
    first = first.where("earlier <> last").drop("last")
    replaced = long.join(first, key).where("earlier < at")
    same = [F.col("i").alias("cut"), F.col("i").alias("cut_earlier")]
    replaced = replaced.select("at", "earlier", *same)
    # a line and what is left of a longer one without a word
    longer = long.select((F.col("n") - 1).alias("n"), "i", "v1", "v2", F.col("at").alias("long_at"))
    both = longer.join(whole, ["n", "v1", "v2"])
    nothing = F.lit(None).cast("int")
    deleted = both.select(
        F.greatest("at", "long_at").alias("later"),
        F.least("at", "long_at").alias("earlier"),
        F.when(F.col("long_at") > F.col("at"), F.col("i")).alias("cut"),
        F.when(F.col("long_at") < F.col("at"), F.col("i")).otherwise(nothing).alias("cut_earlier"),
    ).withColumnRenamed("later", "at")
    pairs = replaced.unionByName(deleted)
    least = pairs.groupBy("at").agg(F.min(F.struct("earlier", "cut", "cut_earlier")).alias("p"))
    pairs = least.select("at", "p.*")
    own = candidates.select("at", "line")
    other = candidates.select(F.col("at").alias("earlier"), F.col("line").alias("earlier_line"))
    pairs = pairs.join(own, "at").join(other, "earlier")

    def without(line: str, cut: str) -> Column:
        words, at = F.split(line, " ", -1), F.col(cut)
        kept = F.concat(F.slice(words, 1, at), F.slice(words, at + 2, F.size(words)))
        return F.when(at.isNull(), words).otherwise(kept)

    return pairs.where(without("line", "cut") == without("earlier_line", "cut_earlier"))


def _kept(keyed: DataFrame, min_chars: int) -> DataFrame:
    """(doc_key, kept): places of the compared lines that stay, in order."""
    distinct = written(_distinct(keyed, min_chars), "lines")
    near = _near(written(_texts_of(keyed, _candidates(distinct)), "texts"))
    near = _checked(written(near.select("at"), "near"))
    doc_key, place = _place_of(F.col("at"))
    stays = distinct.select("at").join(near, "at", "left_anti")
    stays = stays.select(doc_key.alias("doc_key"), place.alias("place"))
    return stays.groupBy("doc_key").agg(F.array_sort(F.collect_list("place")).alias("kept"))


def deduplicate_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    counts: bool = False,
    drop_empty: bool = False,
) -> DataFrame:
    """``documents`` with the lines that stay in ``text``, other columns as they were.

    Every row stays; a document all of whose lines went has the text '', and so has a null
    text. Rows with equal doc_id and text count as one document and keep the same
    lines; equal ids with different texts are ordered by a hash of the text, null ids
    count as the least id there is. Up to 10^9 documents may have ids that others have.
    ``counts`` adds n_lines, the number of lines before, and n_removed, with underscores in
    front if there are such columns. ``drop_empty`` leaves out documents in which no word stays.
    """
    names = {c: fresh(documents, c) for c in ("doc_key", "kept", "lines", "stay")}
    ties = _ties(documents)
    kept = _kept(_with_key(documents.select("doc_id", "text"), ties, "doc_key"), min_chars)
    kept = kept.withColumnsRenamed(names)
    marked = _with_key(documents, ties, names["doc_key"])
    joined = marked.join(kept, names["doc_key"], "left")
    lines, own_kept = F.col(names["lines"]), F.col(names["kept"])
    if drop_empty:  # a line that was compared and stays has words; else look for short ones
        short_words = F.exists(
            F.split(text_or_empty(), "\n", -1),
            lambda line: F.length(_normal(line)).between(1, min_chars - 1),
        )
        joined = joined.where(own_kept.isNotNull() | (short_words if min_chars > 1 else F.lit(False)))
    joined = joined.withColumn(names["lines"], F.split(text_or_empty(), "\n", -1))
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    short = F.filter(places, lambda i: F.length(_normal(F.get(lines, i))) < min_chars)
    stays = F.array_sort(F.concat(F.coalesce(own_kept, F.array().cast("array<int>")), short))
    # most documents keep all their lines, and need no look at each
    whole = F.coalesce(F.size(own_kept) == F.size(lines), F.lit(False))
    joined = joined.withColumn(names["stay"], F.when(~whole, stays))
    stay = F.col(names["stay"])
    picked = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    text = F.when(stay.isNull(), text_or_empty()).otherwise(picked)
    columns = [text.alias(c) if c == "text" else F.col(c) for c in documents.columns]
    if counts:
        removed = F.when(stay.isNull(), 0).otherwise(F.size(lines) - F.size(stay))
        columns.append(F.size(lines).alias(fresh(documents, "n_lines")))
        columns.append(removed.alias(fresh(documents, "n_removed")))
    return joined.select(*columns)
