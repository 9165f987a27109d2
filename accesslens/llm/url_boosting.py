"""URL filter: rules first, gradient-boosted trees for what no rule decides.

Trees are fitted on the URLs that carry a label, by lexical features alone: length, depth,
share of digits, entropy of the characters, number of parameters, and how common the
host's suffix is and how often it is blocked among the labelled. A labelled URL's own fold
isn't counted in that, or its label would be among its features. What the trees learn is
applied to the others, from a score on that errs least on hosts they weren't fitted on.
Features are DataFrame expressions, the trees Spark's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import cumulated, written

#: Rules (verdict, host and start of the path). A rule fits its host and all subdomains.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: All labelled URLs are fitted. Those of a label weigh as half so many at most, so a common
#: label doesn't outweigh a rare one.
TRAINING_WEIGHT = 20_000
PART_ROWS = 50_000  # labelled URLs that are put in order together
TREES, DEPTH, SEED = 12, 4, 7
#: The threshold where held-out hosts have fewer URLs of a label than that.
UNCALIBRATED, LEAST_HELD_OUT = 0.5, 20
FOLDS = 5
BROADCAST_ROWS = 300_000  # suffixes of 150 bytes or so that go to every executor
SALTS = 16  # parts of a suffix's URLs where there are more suffixes

FEATURES = (
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_host_parts",
    "f_digit_ratio", "f_host_digits", "f_entropy", "f_host_entropy", "f_parameters",
    "f_hyphens", "f_fragment", "f_secure", "f_suffix_share", "f_suffix_blocked",
)


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z in lower case; else ''."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(found, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """Behind the host up to ? or #; else ''."""
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + start)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return nothing if found is None else found.otherwise(nothing)


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    characters = F.array_distinct(F.split(text, ""))
    total = F.aggregate(
        F.filter(characters, lambda c: c != ""),
        F.lit(0.0),
        lambda sum_, c: sum_
        + (n - F.length(F.replace(text, c))) * F.log2(n - F.length(F.replace(text, c))),
    )
    return F.when(n > 0, F.log2(n) - total / n).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the features that need no other rows."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    digits = _count(url, "[0-9]")
    return urls.withColumns(
        {
            "f_length": F.length(url).cast("double"),
            "f_host_length": F.length(host).cast("double"),
            "f_path_length": F.length(path).cast("double"),
            "f_depth": _count(path, "/[^/]"),
            "f_host_parts": _count(host, r"[^.]+"),
            "f_digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
            "f_host_digits": _count(host, "[0-9]"),
            "f_entropy": _entropy(url),
            "f_host_entropy": _entropy(host),
            "f_parameters": _count(query, "[^&;]+"),
            "f_hyphens": _count(host, "-"),
            "f_fragment": url.contains("#").cast("double"),
            "f_secure": F.startswith(F.lower(url), F.lit("https://")).cast("double"),
        }
    )


def _suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def with_suffix_statistics(urls: DataFrame) -> DataFrame:
    """Share of all URLs with the host's suffix, and its share of blocks if labelled.

    Counted over all rows, but for labelled ones over the other folds; shares are smoothed
    towards that of all labelled rows.
    """
    spread = F.pmod(F.xxhash64(F.lit(SEED + 1), "url"), F.lit(FOLDS * SALTS))
    urls = urls.withColumns({"fold": spread % FOLDS, "salt": F.floor(spread / FOLDS)})
    folds = [F.col("fold") == i for i in range(FOLDS)]
    blocked = F.coalesce("label", F.lit(0.0)) == 1
    counted = urls.groupBy("suffix").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.count_if(fold & F.col("label").isNotNull()) for fold in folds]).alias("labelled"),
        F.array(*[F.count_if(fold & blocked) for fold in folds]).alias("blocked"),
    )
    counted = written(counted, "suffixes")

    def total(column: str) -> Column:
        return F.aggregate(column, F.lit(0).cast("bigint"), lambda sum_, x: sum_ + x)

    rows, labels, blocks, suffixes = counted.agg(
        F.sum("n"), F.sum(total("labelled")), F.sum(total("blocked")), F.count("*")
    ).first()
    share = blocks / labels if labels else 0.5
    if suffixes <= BROADCAST_ROWS:
        joined = urls.join(F.broadcast(counted), "suffix")
    else:
        salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
        joined = urls.join(counted.withColumn("salt", salts), ["suffix", "salt"])

    def others(column: str) -> Column:
        own = F.when(F.col("label").isNull(), 0).otherwise(F.get(column, F.col("fold").cast("int")))
        return total(column) - own

    return joined.withColumns(
        {
            "f_suffix_share": F.col("n") / max(1, rows or 0),
            "f_suffix_blocked": (others("blocked") + 10 * share) / (others("labelled") + 10),
        }
    ).drop("n", "labelled", "blocked", "fold", "salt")


def prepared(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """host, path, rule, its verdict, the label from it, and all features."""
    found = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    found = found.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    found = found.withColumns(
        {
            "rule": F.col("match.rule"),
            "ruled": F.col("match.verdict"),
            "label": (F.col("match.verdict") == "block").cast("double"),
            "suffix": _suffix(F.col("host")),
        }
    ).drop("match")
    return lexical(with_suffix_statistics(found))


def fit(
    features: DataFrame, weight: int = TRAINING_WEIGHT, trees: int = TREES, depth: int = DEPTH
) -> tuple[object, float]:
    """Trees on labelled rows and their threshold; no trees if there are not both labels.

    All rows with a label are used. Those of a quarter of the hosts are held out for the
    threshold; ``weight`` is that of all others, of each label half at most.
    """
    order = F.xxhash64(F.lit(SEED), "url")
    held_out = F.pmod(F.xxhash64(F.lit(SEED + 2), "host"), F.lit(4)) == 0
    marked = features.withColumns({"held_out": held_out, "order": order})
    counts = features.where("label IS NOT NULL").groupBy("label").count()
    there = {r["label"]: r["count"] for r in counts.collect()}
    if len(there) < 2:
        return None, UNCALIBRATED
    # parts and order don't depend on the input's: by them Spark chooses the values to cut at
    labelled = None
    for label, n in sorted(there.items()):
        some = marked.where(F.col("label") == label)
        some = some.repartition(1 + n // PART_ROWS, "order", "page_id")
        some = some.sortWithinPartitions("order", "url")
        labelled = some if labelled is None else labelled.unionByName(some)
    # read once for each level
    labelled = written(labelled.select("label", "held_out", *FEATURES), "urls")
    if labelled.where("NOT held_out").select("label").distinct().count() < 2:
        return None, UNCALIBRATED
    weights = {label: min(1.0, weight / 2 / n) for label, n in there.items()}
    weigh = F.when(F.col("label") == 1, weights[1.0]).otherwise(weights[0.0])
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(labelled)
    fitted = assembled.where("NOT held_out").select("label", weigh.alias("weight"), "features")
    booster = GBTClassifier(
        maxIter=trees, maxDepth=depth, seed=SEED, stepSize=0.2, cacheNodeIds=False,
        weightCol="weight",
    )
    model = booster.fit(fitted)
    scored = model.transform(assembled.where("held_out"))
    return model, _calibrated(
        scored.select("label", vector_to_array("probability")[1].alias("score"))
    )


def _calibrated(scored: DataFrame) -> float:
    """``_threshold`` of (label, score) rows, of which there may be any number."""
    counted = scored.groupBy("score").agg(
        F.count_if(F.col("label") == 0).alias("allowed"),
        F.count_if(F.col("label") == 1).alias("blocked"),
    )
    counted = written(counted, "scores")
    allowed, blocked = counted.agg(F.sum("allowed"), F.sum("blocked")).first()
    if min(allowed or 0, blocked or 0) < LEAST_HELD_OUT:
        return UNCALIBRATED
    # what is blocked from the next score on, if all up to this one is allowed
    wrong = F.lit(allowed) + F.col("upto_blocked") - F.col("upto_allowed")
    above = F.coalesce("next", F.lit(1.01))
    best = F.least(F.greatest(F.lit(0.5), F.col("score") + 1e-9), above)
    choice = F.struct(wrong.alias("wrong"), F.abs(best - 0.5).alias("far"), best.alias("best"))
    found = cumulated(counted, [], ["allowed", "blocked"]).agg(F.min(choice)).first()[0]
    return min((allowed, 0.5, 0.0), tuple(found))[2]  # at first all are blocked


def _threshold(scores: list[tuple[float, float]], weights: dict[float, float]) -> float:
    """The score from which on blocking errs least; of several, the one nearest to a half.

    A weight is the number of URLs of a label that one of the list stands for.
    """
    if any(sum(label == x for _, label in scores) < LEAST_HELD_OUT for x in (0.0, 1.0)):
        return UNCALIBRATED
    ordered = sorted(scores)
    errors = [(score, weights[label] * (1 if label else -1)) for score, label in ordered]
    wrong = weights[0.0] * sum(label == 0 for _, label in scores)  # all are blocked
    found = [(wrong, 0.5, 0.0)]
    for i, (score, change) in enumerate(errors):
        wrong += change  # this one is allowed
        above = errors[i + 1][0] if i + 1 < len(errors) else 1.01
        if above > score:
            # any value between the two does the same
            best = min(max(0.5, score + 1e-9), above)
            found.append((wrong, abs(best - 0.5), best))
    return min((round(wrong, 6), far, best) for wrong, far, best in found)[2]


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    weight: int = TRAINING_WEIGHT,
    threshold: float | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' score of every URL.

    A null URL or one without :// has the host and path '', and is judged by the trees like
    others without a rule. Without labels of both kinds there are no trees, and all
    URLs without a rule are allowed with a null score. Equal URLs have equal verdicts. Extra
    columns are not read; an empty table gives no rows. ``threshold`` replaces the calibrated one.
    """
    features = prepared(pages.select("page_id", "url"), rules)
    model, calibrated = fit(features, weight)
    threshold = calibrated if threshold is None else threshold
    if model is None:
        scored = features.withColumn("score", F.lit(None).cast("double"))
    else:
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        scored = model.transform(assembler.transform(features))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    learned = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "score"
    )
