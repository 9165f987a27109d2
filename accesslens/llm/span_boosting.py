"""Personal data: spans proposed by wide patterns and chosen by gradient-boosted trees.

Spans of a fixed format that pass their check (the base) are always found. Wider
patterns propose further ones: e-mail addresses with bracketed signs or letters of other
scripts, addresses with bracketed dots, numbers with other separators. Trees score a
proposal by its format, read with the brackets taken off, and by what stands around it.
They are fitted on spans of the fixed formats, which their checks label, on plain
numbers and parts of numbers in a card's format, which are none, and on rewritten ones: each
labelled span once more with its signs or separators changed (its label stays), or as what
looks similar and is none (dates, ranges, account numbers, versions). Thresholds for each kind
are calibrated on held-out ones; a span and its rewriting are held out together. A run
of digits and separators can be several numbers: all runs of its digit groups are
proposed. Those that overlap a base span go; of the others the best stays, then the best
that doesn't overlap it, and so on. Scores are compared in tenths, and of equal ones the
longer is better, as a part of a number scores much like the number.

All is DataFrame expressions: texts are cut at the matches of a pattern, and the lengths
of the pieces give the places. Only documents that can have a span are looked at, equal
texts once, and no text is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import cumulated, settled, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")

# Formats. Each matches what the plain form does, in linear time: a match
# starts at the first character of a run, or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
    r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A date, and what stands before a part of an international account number.
DATE = (
    r"^(?:(?:19|20)[0-9]{2}[-./ ]+[0-9]{1,2}[-./ ]+[0-9]{1,2}"
    r"|[0-9]{1,2}[-./ ]+[0-9]{1,2}[-./ ]+(?:19|20)[0-9]{2})$"
)
ACCOUNT = r"(?:^|[^A-Za-z])[A-Z]{2}(?:[0-9]{2}[ 0-9]*)?$"
CAN_HAVE_ONE = r"[0-9@]|[\[({](?i:at)[\])}]"
AT = r"\x20?(?:[\[({](?i:at)[\])}])\x20?"
DOT = r"(?:\.|\x20?[\[({](?i:dot|\.)[\])}]\x20?)"
#: Wider patterns; ``number`` proposes cards and phones, by their numbers of digits.
WIDE = {
    "email": rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]++(?:@|{AT})"
    rf"[\p{{L}}\p{{N}}-]++(?:{DOT}[\p{{L}}\p{{N}}-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\x20\.\x20|\x20?[\[({]\.[\])}]\x20?)[0-9]{1,3}+){3}(?![0-9])",
    "number": r"(?<![0-9])(?:\+|00)?\(?[0-9](?:[\x20().\-/‐-– ]{0,2}[0-9])++",
}
AROUND = 24  # characters before a span that are looked at
HINTS = {
    "email": r"(?i)mail|write|contact|kontakt|correo",
    "ip": r"(?i)\bip\b|address|server|host",
    "card": r"(?i)card|visa|karte|tarjeta|carte|payment|iban",
    "phone": r"(?i)phone|tel|call|fax|mobile|ruf",
}

MOST_DIGITS = 19
#: Overlapping proposals that one task chooses from; larger groups are split first.
TOGETHER = 2_000

#: All labelled proposals are fitted, with the weight of so many at most. Kinds and labels
#: have equal shares of it; what rare ones don't use goes to the others.
TRAINING_WEIGHT = 20_000
TREES, DEPTH, SEED = 12, 5, 11
#: Least precision of a threshold on held-out proposals, and of how many.
PRECISION, LEAST_HELD_OUT = 0.98, 20
#: The threshold of kinds with fewer held-out proposals than that.
UNCALIBRATED = 0.8

FEATURES = (
    "f_email", "f_ip", "f_card", "f_phone", "f_length", "f_digits", "f_letters", "f_groups",
    "f_longest", "f_plus", "f_brackets", "f_separators", "f_kinds", "f_dots", "f_luhn",
    "f_octets", "f_last", "f_word_before", "f_word_after", "f_hint", "f_zero", "f_date",
    "f_account",
)


# -- places -----------------------------------------------------------------------------


def _matches(texts: DataFrame, kind: str, pattern: str) -> DataFrame:
    """(h1, h2, kind, nth, gap, match, before, after) of all matches in texts.

    ``gap`` is the number of code points between a match and the one before.
    """
    pieces = F.split("text", pattern, -1)
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    rows = texts.withColumns({"pieces": pieces, "found": found}).where(F.size("found") > 0)
    following = F.slice("pieces", 2, F.size("found")).alias("next")
    each = F.posexplode(F.arrays_zip("found", "pieces", following))
    rows = rows.select("h1", "h2", each.alias("nth", "m"))
    return rows.where("m.found IS NOT NULL").select(
        "h1",
        "h2",
        F.lit(kind).alias("kind"),
        "nth",
        F.length("m.pieces").cast("bigint").alias("gap"),
        F.col("m.found").alias("match"),
        F.right("m.pieces", F.lit(AROUND)).alias("before"),
        F.left("m.next", F.lit(8)).alias("after"),
    )


def _places(matches: DataFrame) -> DataFrame:
    """Adds start and end, in code points; equal texts' matches become one."""
    once = matches.groupBy("h1", "h2", "kind", "nth").agg(
        *[F.first(c).alias(c) for c in ("gap", "match", "before", "after")]
    )
    size = F.length("match").cast("bigint")
    upto = Window.partitionBy("h1", "h2", "kind").orderBy("nth")
    end = F.sum(F.col("gap") + size).over(upto)
    return once.withColumn("end", end).withColumn("start", F.col("end") - size).drop("gap", "nth")


def _parts(runs: DataFrame) -> DataFrame:
    """Numbers a run can hold: its digit groups from one to another, by kind.

    Each has 7 to 19 digits, so a group starts 19 at most. A sign or bracket before the
    first group belongs to it.
    """
    separators = F.split("match", "[0-9]+", -1)
    digits = F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0))
    each = F.transform(
        digits, lambda d, i: F.struct(F.get(separators, i).alias("separator"), d.alias("digits"))
    )
    run = ["h1", "h2", "run_start"]
    rows = runs.where(F.length(_digits(F.col("match"))) >= 7).select(
        "h1",
        "h2",
        F.col("start").alias("run_start"),
        "before",
        "after",
        F.posexplode(each).alias("i", "g"),
    )
    rows = rows.select(*run, "before", "after", "i", "g.*")
    sign = F.when(F.col("i") == 0, F.col("separator")).otherwise(
        F.regexp_extract("separator", r"\($", 0)
    )
    rows = rows.withColumn("sign", sign)
    rows = rows.withColumn("piece", F.concat("separator", "digits"))
    order = Window.partitionBy(*run).orderBy("i")
    upto = F.sum(F.length("piece").cast("bigint")).over(order)
    # a piece has one character at least, so these are enough
    earlier = F.array_join(F.collect_list("piece").over(order.rowsBetween(-AROUND, -1)), "")
    later = F.array_join(F.collect_list("piece").over(order.rowsBetween(1, 8)), "")
    gap = F.length("separator") - F.length("sign")
    rows = rows.withColumns(
        {
            "end": F.col("run_start") + upto,
            "before": F.right(
                F.concat("before", earlier, F.left("separator", gap)), F.lit(AROUND)
            ),
            "after": F.left(F.concat(later, "after"), F.lit(8)),
        }
    )
    following = F.collect_list(F.struct("piece", "digits", "end", "after")).over(
        order.rowsBetween(0, MOST_DIGITS - 1)
    )
    first = F.concat("sign", "digits")
    rows = rows.withColumn("start", F.col("end") - F.length(first)).withColumn("f", following)

    def number(last: Column, j: Column) -> Column:
        used = F.slice("f", F.lit(1), j + 1)
        more = F.array_join(F.transform(F.slice("f", F.lit(2), j), lambda g: g["piece"]), "")
        n = F.aggregate(used, F.lit(0), lambda n, g: n + F.length(g["digits"]))
        return F.struct(
            F.concat(first, more).alias("match"), n.alias("n"), last["end"], last["after"]
        )

    found = rows.select("h1", "h2", "before", "start", F.explode(F.transform("f", number)).alias("x"))
    kinds = F.array_compact(
        F.array(
            F.when(F.col("x.n").between(13, MOST_DIGITS), F.lit("card")),
            F.when(F.col("x.n").between(7, 15), F.lit("phone")),
        )
    )
    found = found.where(F.col("x.n").between(7, MOST_DIGITS))
    return found.select(
        "h1", "h2", F.explode(kinds).alias("kind"), "x.match", "before", "x.after",
        F.col("x.end").alias("end"), "start",
    )


# -- checks and features ------------------------------------------------------------------


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(i % 2 == 1, double).otherwise(digit)

    places = F.sequence(F.lit(0), F.least(n, F.lit(24)) - 1)
    total = F.aggregate(places, F.lit(0), lambda sum_, i: sum_ + value(i))
    return F.when(n == 0, False).otherwise(total % 10 == 0)


def _octets(text: Column) -> Column:
    """Whether all numbers in a text are at most 255."""
    parts = F.transform(
        F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)),
        lambda p: F.regexp_replace(p, "^0+", ""),
    )
    small = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return small & (F.size(parts) == 4)


def _passes(kind: Column, match: Column) -> Column:
    """The check of a fixed format."""
    n = F.length(_digits(match))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", _octets(match))
        .when(kind == "card", n.between(13, 19) & _luhn(_digits(match)))
        .otherwise(n.between(9, 15))
    )


def _features(proposals: DataFrame) -> DataFrame:
    """Format and context of proposals, brackets around signs read as the signs."""
    plain = F.regexp_replace("match", AT, "@")
    plain = F.regexp_replace(plain, r"\x20?[\[({](?i:dot|\.)[\])}]\x20?", ".")
    rows = proposals.withColumn("plain", plain)
    plain, digits = F.col("plain"), _digits(F.col("plain"))
    number = lambda condition: condition.cast("double")
    count = lambda pattern: F.regexp_count(plain, F.lit(pattern)).cast("double")
    longest = F.array_max(F.transform(F.split(plain, "[^0-9]+"), lambda p: F.length(p)))
    hint = reduce(
        lambda found, kind: found.when(F.col("kind") == kind, F.col("before").rlike(HINTS[kind])),
        KINDS[1:],
        F.when(F.col("kind") == "email", F.col("before").rlike(HINTS["email"])),
    )
    kinds = F.size(F.array_distinct(F.regexp_extract_all(plain, F.lit(r"[^0-9\p{L}]"), F.lit(0))))
    return rows.withColumns(
        {
            **{f"f_{kind}": number(F.col("kind") == kind) for kind in KINDS},
            "f_length": F.length(plain).cast("double"),
            "f_digits": F.length(digits).cast("double"),
            "f_letters": count(r"\p{L}"),
            "f_groups": count("[0-9]+"),
            "f_longest": longest.cast("double"),
            "f_plus": number(plain.startswith("+") | plain.startswith("00")),
            "f_brackets": count(r"[()]"),
            "f_separators": count(r"[^0-9\p{L}]"),
            "f_kinds": kinds.cast("double"),
            "f_dots": count(r"\."),
            "f_luhn": number(_luhn(digits)),
            "f_octets": number(_octets(plain)),
            "f_last": F.length(F.regexp_extract(plain, r"\.(\p{L}*)$", 1)).cast("double"),
            "f_word_before": number(F.col("before").rlike(r"[\p{L}\p{N}_=\"'/-]$")),
            "f_word_after": number(F.col("after").rlike(r"^[\p{L}\p{N}_=\"'/-]")),
            "f_hint": number(F.coalesce(hint, F.lit(False))),
            "f_zero": number(plain.rlike(r"^\(?0[1-9]")),
            "f_date": number(plain.rlike(DATE)),
            "f_account": number(F.col("before").rlike(ACCOUNT)),
        }
    ).drop("plain")


def _rewritten(labelled: DataFrame) -> DataFrame:
    """Each labelled span in one other form, chosen by hash, with the label of that form."""
    mixed = F.xxhash64(F.lit(SEED + 2), "h1", "h2", "kind", "start")
    match, passes = F.col("match"), F.col("passes")

    def number(shift: int, least: int, most: int) -> Column:
        n = F.pmod(F.shiftright(mixed, shift), F.lit(most - least + 1)) + least
        return F.lpad(n.cast("string"), len(str(most)), "0")

    def form(text: Column, label: Column = passes, before: Column | None = None) -> Column:
        before = F.col("before") if before is None else before
        return F.struct(text.alias("match"), label.alias("passes"), before.alias("before"))

    none = F.lit(False)
    neutral = F.array(*map(F.lit, ["on ", "of ", "order ", "no. ", "from ", "", "id ", "pages "]))
    neutral = F.get(neutral, F.pmod(F.shiftright(mixed, 7), F.lit(8)).cast("int"))
    account = F.concat(F.lit("IBAN DE"), number(9, 10, 99), F.lit(" "))
    local, domain = F.substring_index("match", "@", 1), F.substring_index("match", "@", -1)
    short = F.substring_index(domain, ".", -2)
    version = F.concat_ws(".", number(3, 0, 9), number(5, 10, 39), number(11, 0, 9))
    emails = [
        form(F.concat(local, F.lit(" (at) "), domain)),
        form(F.concat(local, F.lit("[at]"), F.replace(domain, F.lit("."), F.lit("[dot]")))),
        form(F.concat(local, F.lit(" {at} "), F.replace(domain, F.lit("."), F.lit(" {dot} ")))),
        form(F.concat(local, F.lit("@"), F.translate(domain, "aeou", "äéöü"))),
        form(F.concat(local, F.lit("@"), F.translate(short, "aeou", "äéöü"))),
        form(F.concat(local, F.lit("@"), F.substring_index(domain, ".", 1), F.lit("."), version), none),
        form(F.concat(local, F.lit("@"), version), none),
        form(F.concat(local, F.lit(" [at] "), version), none),
    ]
    first = F.substring_index("match", ".", 1)
    rest = F.call_function("substring", match, F.length(first) + 2)
    ips = [form(F.replace(match, F.lit("."), F.lit(dot))) for dot in ("[.]", "(.)", " . ")]
    ips += [form(F.concat(first, F.lit("[.]"), rest))]
    digits = _digits(match)
    cards = [
        form(F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{separator}"))
        for separator in (".", "/", " ", " - ", " / ")
    ]
    cards += [form(match, none, account)]
    plain = F.translate(match, "()", "")
    country = r"^(\+[0-9]{1,2})[ .-]*"
    code = F.regexp_extract(plain, country, 1)
    own = _digits(F.regexp_replace(plain, country, ""))
    area = F.when(number(21, 0, 1) == "0", F.left(own, F.lit(2))).otherwise(F.left(own, F.lit(3)))
    sign = F.get(F.array(*map(F.lit, ["-", "/", " ", " / "])), F.pmod(mixed, F.lit(4)).cast("int"))
    ending = F.call_function("substring", own, F.length(area) + 1)
    phones = [
        form(F.regexp_replace(match, r"^\+", "00")),
        form(F.regexp_replace(plain, country, "0")),
        form(F.regexp_replace(F.regexp_replace(plain, country, "0"), "[ -]+", "/")),
        form(F.regexp_replace(plain, country, "$1 (0)")),
        form(F.concat(F.lit("0"), area, sign, ending)),
        form(F.concat(code, F.lit(" (0)"), area, sign, ending)),
        form(F.concat(F.lit("00"), F.replace(code, F.lit("+"), F.lit("")), F.lit(" "), area, sign, ending)),
        form(F.regexp_replace(plain, "[ -]+", ".")),
        form(F.regexp_replace(plain, "-", " / ")),
        form(F.concat_ws("-", number(3, 1990, 2030), number(9, 1, 12), number(13, 1, 28)), none, neutral),
        form(F.concat_ws(".", number(3, 1, 28), number(9, 1, 12), number(13, 1990, 2030)), none, neutral),
        form(F.concat_ws("-", number(3, 1000, 9999), number(17, 1000, 9999)), none, neutral),
        form(F.concat_ws("-", number(3, 1990, 2030), number(17, 1, 999999)), none, neutral),
        form(F.concat_ws(".", number(3, 1, 9), number(9, 100, 999), number(19, 100, 999)), none, neutral),
        form(F.regexp_replace(match, r"^\+", "00"), none, account),
    ]
    forms = F.when(F.col("kind") == "email", F.array(*emails))
    for kind, of_kind in (("ip", ips), ("card", cards), ("phone", phones)):
        forms = forms.when(F.col("kind") == kind, F.array(*of_kind))
    nth = F.pmod(F.shiftright(mixed, 23), F.size("forms")).cast("int")
    rows = labelled.withColumn("forms", forms).withColumn("form", F.get("forms", nth))
    rows = rows.select("h1", "h2", "kind", "start", "end", "after", "form.*")
    # half of the spans stand in another place, so that one hint isn't all that is learned
    elsewhere = passes & (F.pmod(F.shiftright(mixed, 33), F.lit(2)) == 0)
    return rows.withColumn("before", F.when(elsewhere, neutral).otherwise(F.col("before")))


# -- trees ----------------------------------------------------------------------------------


def _quota(counts: list[int], weight: int) -> float:
    """The most weight of each group, so that all groups have ``weight`` at most."""
    for i, n in enumerate(ordered := sorted(counts)):
        share = weight / (len(ordered) - i)
        if n > share:
            return share
        weight -= n
    return float("inf")


def _fit(labelled: DataFrame, weight: int) -> tuple[object, dict[str, float]]:
    """Trees, and the threshold of each kind; none for kinds without the wanted precision.

    All rows are fitted, but for a quarter that is held out for the thresholds.
    """
    order = F.xxhash64(F.lit(SEED), "h1", "h2", "kind", "start")
    marked = labelled.withColumns({"order": order, "held_out": F.pmod(order, F.lit(4)) == 0})
    marked = settled(
        marked.select("order", "kind", "label", "held_out", *FEATURES), "labelled", "order"
    )
    counts = {(r["kind"], r["label"]): r["count"] for r in
              marked.groupBy("kind", "label").count().collect()}
    if marked.where("NOT held_out").select("label").distinct().count() < 2:
        return None, {}
    quota = _quota(list(counts.values()), weight)
    weigh = reduce(
        lambda found, item: found.when(
            (F.col("kind") == item[0][0]) & (F.col("label") == item[0][1]), min(1.0, quota / item[1])
        ),
        counts.items(),
        F.when(F.lit(False), 1.0),
    )
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(marked)
    fitted = data.where("NOT held_out").select("label", weigh.alias("weight"), "features")
    booster = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3, weightCol="weight"
    )
    model = booster.fit(fitted)
    scored = model.transform(data.where("held_out"))
    thresholds = _calibrated(
        scored.select("kind", "label", vector_to_array("probability")[1].alias("score"))
    )
    return model, {k: t for k, t in thresholds.items() if t is not None}


def _calibrated(scored: DataFrame) -> dict[str, float | None]:
    """``_threshold`` of each kind's (kind, label, score) rows, of which there may be any number."""
    counted = scored.groupBy("kind", "score").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("label") == 1).alias("right")
    )
    counted = written(counted, "scores")
    totals = dict(map(tuple, counted.groupBy("kind").agg(F.sum("total")).collect()))
    precise = cumulated(counted, ["kind"], ["total", "right"], descending=True).where(
        (F.col("upto_total") >= LEAST_HELD_OUT)
        & (F.col("upto_right") >= PRECISION * F.col("upto_total"))
    )
    least = precise.groupBy("kind").agg(F.min(F.struct("score", "next")).alias("least"))
    halfway = (F.col("least.score") + F.coalesce("least.next", F.lit(0.0))) / 2
    found = dict(map(tuple, least.select("kind", F.greatest(halfway, F.lit(0.5))).collect()))
    few = {kind: UNCALIBRATED for kind in KINDS if totals.get(kind, 0) < LEAST_HELD_OUT}
    return {kind: found.get(kind) for kind in KINDS} | few


def _threshold(scores: list[tuple[float, float, float]]) -> float | None:
    """The least score down to which the wanted precision holds, by (score, label, weight).

    A weight is the number of proposals that one of the list stands for. The threshold is
    halfway to the next score, as nothing speaks against those between, but a half at least.
    """
    if len(scores) < LEAST_HELD_OUT:
        return UNCALIBRATED
    found, right, total = None, 0.0, 0.0
    for n, (score, label, weight) in enumerate(scores, 1):
        right += label * weight
        total += weight
        last = n == len(scores) or scores[n][0] < score
        if last and n >= LEAST_HELD_OUT and right >= PRECISION * total:
            following = scores[n][0] if n < len(scores) else 0.0
            found = max((score + following) / 2, 0.5)
    return found


# -- spans ------------------------------------------------------------------------------------


def spans(documents: DataFrame, weight: int = TRAINING_WEIGHT) -> DataFrame:
    """(h1, h2, kind, start, end, base) of the spans of each distinct text that has one.

    h1 and h2 are hashes of the text, as ``text_keys`` gives them.
    """
    texts = documents.select(text_or_empty().alias("text")).where(F.col("text").rlike(CAN_HAVE_ONE))
    texts = texts.select("text", *text_keys(F.col("text")))
    matches = [_matches(texts, kind, pattern) for kind, pattern in BASE.items()]
    matches += [_matches(texts, f"wide {kind}", pattern) for kind, pattern in WIDE.items()]
    found = written(_places(reduce(DataFrame.unionByName, matches)), "matches")

    fixed = found.where(F.col("kind").isin(*KINDS))
    fixed = fixed.withColumn("passes", _passes(F.col("kind"), F.col("match")))
    base = fixed.where("passes").select("h1", "h2", "kind", "start", "end")
    digits = F.length(_digits(F.col("match")))
    wide = found.where(~F.col("kind").isin(*KINDS))
    kind = (
        F.when(F.col("kind") == "wide email", "email")
        .when(F.col("kind") == "wide ip", "ip")
        .when(digits.between(13, 19), "card")
        .when(digits.between(7, 15), "phone")
    )
    proposed = wide.where("kind <> 'wide number'").withColumn("kind", kind)
    proposed = proposed.unionByName(_parts(wide.where("kind = 'wide number'")))
    wide = wide.withColumn("kind", kind).where("kind IS NOT NULL")
    # labelled: fixed formats by their checks, numbers without any separator, addresses as
    # numbers, all of these rewritten, parts of numbers
    bare = wide.where(F.col("match").rlike("^[0-9]+$")).withColumn("passes", F.lit(False))
    bare = bare.where("kind = 'phone'")
    labelled = fixed.where(F.col("kind") != "card").unionByName(bare)
    cards = fixed.where((F.col("kind") == "card") & digits.between(13, 19))
    parts = _parts(cards.drop("passes")).join(
        cards.select("h1", "h2", "start", "end"), ["h1", "h2", "start", "end"], "left_anti"
    )
    dotted = fixed.where((F.col("kind") == "ip") & (digits >= 7))
    dotted = dotted.withColumns({"kind": F.lit("phone"), "passes": F.lit(False)})
    labelled = labelled.unionByName(cards).unionByName(dotted)
    labelled = labelled.unionByName(_rewritten(labelled))
    labelled = labelled.unionByName(parts.withColumn("passes", F.lit(False)))
    labelled = _features(labelled).withColumn("label", F.col("passes").cast("double"))
    model, thresholds = _fit(labelled, weight)

    own = base.withColumns({"base": F.lit(True), "score": F.lit(2.0)})
    if model is None or not thresholds:
        return own.drop("score")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    scored = model.transform(assembler.transform(_features(proposed)))
    scored = scored.withColumn("score", vector_to_array("probability")[1])
    least = F.create_map(*[F.lit(x) for item in thresholds.items() for x in item])
    more = scored.where(F.col("score") >= F.coalesce(least[F.col("kind")], F.lit(2.0)))
    more = more.select("h1", "h2", "kind", "start", "end", F.lit(False).alias("base"), "score")
    return _without_overlaps(own.unionByName(more))


def _grouped(found: DataFrame) -> DataFrame:
    """Adds ``run``, equal for spans of a text that a chain of overlaps joins."""
    order = Window.partitionBy("h1", "h2").orderBy("start", "end", "kind", "base")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start") >= before).cast("int"), F.lit(1))
    return found.withColumn("new", new).withColumn("run", F.sum("new").over(order)).drop("new")


def _apart(found: DataFrame) -> DataFrame:
    """Without the proposals that overlap a base span; base spans may overlap each other."""
    order = Window.partitionBy("h1", "h2").orderBy("start", F.desc("base"))
    ends = F.when(F.col("base"), F.col("end"))
    reached = F.max(ends).over(order.rowsBetween(Window.unboundedPreceding, 0))
    starts = F.when(F.col("base"), F.col("start"))
    back = Window.partitionBy("h1", "h2").orderBy(F.desc("start"), "base")
    next_start = F.min(starts).over(back.rowsBetween(Window.unboundedPreceding, -1))
    free = F.coalesce(reached <= F.col("start"), F.lit(True))
    free &= F.coalesce(next_start >= F.col("end"), F.lit(True))
    return found.withColumn("free", free).where("base OR free").drop("free")


def _without_overlaps(found: DataFrame) -> DataFrame:
    """Base spans, and of the others the best, the best that doesn't overlap it, and so on.

    Of equal tenths the longer goes first, and at last the one with the larger hash: so a
    large group without a difference in score is split near its middle, not at its end.
    """
    columns = ["h1", "h2", "kind", "start", "end", "base"]
    left = _apart(found)
    kept = left.where("base").select(*columns)
    mixed = F.xxhash64("h1", "h2", "start", "end", "kind")
    size = (F.col("end") - F.col("start")).alias("size")
    tenths = F.round("score", 1).alias("tenths")
    rank = F.struct(tenths, size, "score", mixed.alias("mixed"), "start", "kind")
    left = written(left.where("NOT base").withColumn("rank", rank), "proposals")
    while True:
        run = Window.partitionBy("h1", "h2", "run")
        groups = _grouped(left).withColumn("n", F.count("*").over(run))
        kept = kept.unionByName(_best_first(groups.where(F.col("n") <= TOGETHER)))
        large = groups.where(F.col("n") > TOGETHER)
        large = large.withColumn("best", F.max(F.struct("rank", "start", "end")).over(run))
        large = written(large, "proposals")
        if large.isEmpty():
            return kept
        best = F.col("rank") == F.col("best.rank")
        kept = kept.unionByName(large.where(best).select(*columns))
        away = (F.col("end") <= F.col("best.start")) | (F.col("start") >= F.col("best.end"))
        left = large.where(away).drop("run", "n", "best")


def _best_first(groups: DataFrame) -> DataFrame:
    span = F.struct("rank", "start", "end", "kind", "base")
    lists = groups.groupBy("h1", "h2", "run").agg(
        F.sort_array(F.collect_list(span), asc=False).alias("spans")
    )

    def take(taken: Column, x: Column) -> Column:
        hit = F.exists(taken, lambda t: (t["start"] < x["end"]) & (x["start"] < t["end"]))
        return F.when(hit, taken).otherwise(F.concat(taken, F.array(x)))

    chosen = F.aggregate("spans", F.slice("spans", 1, 0), take)
    rows = lists.select("h1", "h2", F.explode(chosen).alias("s"))
    return rows.select("h1", "h2", "s.kind", "s.start", "s.end", "s.base")


def text_keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def find_spans(documents: DataFrame, weight: int = TRAINING_WEIGHT) -> DataFrame:
    """doc_id and its spans, an array of (kind, start, end, base), ordered by kind and start.

    A null text is empty; a document without spans has an empty array. A row for each row;
    equal texts have equal spans. Offsets are code points of the whole text. Extra columns
    are not read; an empty table gives no rows.
    """
    number = reduce(
        lambda found, i: found.when(F.col("kind") == KINDS[i], i),
        range(1, len(KINDS)),
        F.when(F.col("kind") == KINDS[0], 0),
    )
    span = F.struct(number.alias("k"), "start", "end", "kind", "base")
    of_text = spans(documents, weight).groupBy("h1", "h2").agg(
        F.array_sort(F.collect_list(span)).alias("s")
    )

    def named(x: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("kind", "start", "end", "base")])

    of_text = of_text.select("h1", "h2", F.transform("s", named).alias("spans"))
    docs = documents.select("doc_id", *text_keys(text_or_empty()))
    joined = docs.join(of_text, ["h1", "h2"], "left")
    empty = F.array().cast(of_text.schema["spans"].dataType)
    return joined.select("doc_id", F.coalesce("spans", empty).alias("spans"))


def redact(documents: DataFrame, weight: int = TRAINING_WEIGHT) -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets.

    Rows with a null doc_id or without spans keep their text; rows with equal ids and
    texts are treated alike.
    """
    texts = documents.select("doc_id", text_or_empty().alias("text"))
    of_text = spans(documents, weight).groupBy("h1", "h2").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("s")
    )
    marked = texts.withColumns(dict(zip(("h1", "h2"), text_keys(F.col("text")), strict=True)))
    joined = marked.join(of_text, ["h1", "h2"], "left")
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))
    cut = F.aggregate(
        "s",
        start,
        lambda state, x: F.when(x["end"] <= state["at"], state).otherwise(
            F.struct(
                F.concat(
                    state["done"],
                    F.call_function(
                        "substring",
                        F.col("text"),
                        (state["at"] + 1).cast("int"),
                        F.greatest(x["start"] - state["at"], F.lit(0)).cast("int"),
                    ),
                    F.when(
                        x["start"] >= state["at"], F.concat(F.lit("["), x["kind"], F.lit("]"))
                    ).otherwise(""),
                ).alias("done"),
                x["end"].alias("at"),
            )
        ),
    )
    rest = F.call_function("substring", F.col("text"), (cut["at"] + 1).cast("int"))
    text = F.when(F.col("s").isNull(), F.col("text")).otherwise(F.concat(cut["done"], rest))
    return joined.select("doc_id", text.alias("text"))
