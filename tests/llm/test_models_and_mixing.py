"""URL filter, personal data, source mixing and the pipeline."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from accesslens.llm import common, flow_mixing, span_boosting, url_boosting
from accesslens.llm.common import WORDS
from accesslens.llm.queries import QUERIES

# -- URLs ------------------------------------------------------------------------------------

URLS = {
    "https://WWW.Example.ORG/es/1": ("www.example.org", "/es/1", "example.org/es/", "block"),
    "http://example.org/en/12?x=1": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://example.org/en/2#top": ("example.org", "/en/2", "org/", "allow"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "a://b.com/fr/x://y": ("b.com", "/fr/x://y", "com/fr/", "allow"),
    "http://b.com?/de/": ("b.com", "", None, None),
    "http://b.com/de": ("b.com", "/de", None, None),
    "no scheme.org/es/": ("", "", None, None),
    "://org/": ("org", "/", "org/", "allow"),
    "": ("", "", None, None),
    None: ("", "", None, None),
}


def test_hosts_paths_and_rules(spark):
    rows = [(i, url, "x") for i, url in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    found = {r.page_id: r for r in url_boosting.judge(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(URLS.values()):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict == (verdict or found[i].verdict) in ("allow", "block")
    assert url_boosting.judge(pages.where("false")).count() == 0
    no_labels = url_boosting.judge(pages, rules=()).collect()
    assert {(r.verdict, r.score) for r in no_labels} == {("allow", None)}


def test_trees_learn_what_is_lexical(spark):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        bad = i % 3 == 0
        host = f"{'x9-7z' if bad else 'plain'}{rng.randrange(50)}.{'biz' if bad else 'info'}"
        path = "/".join(str(rng.randrange(10**6)) if bad else "page" for _ in range(4 if bad else 2))
        rows.append((i, f"http://{host}/{'b' if bad else 'a'}/{path}" + "?a=1&b=2" * bad))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    some = [("block", f"x9-7z{n}.biz/b/") for n in range(30)]
    some += [("allow", f"plain{n}.info/a/") for n in range(30)]
    found = url_boosting.judge(pages, rules=some).collect()
    held_out = [r for r in found if r.rule is None]
    assert len(held_out) > 500
    right = sum((r.verdict == "block") == (r.page_id % 3 == 0) for r in held_out)
    assert right >= 0.95 * len(held_out)


def test_a_label_is_not_among_its_features(spark, monkeypatch):
    rows = [(i, f"http://h{i}.x{i}.net/{'b' if i % 4 == 0 else 'a'}/p") for i in range(200)]
    rows += [(1000 + i, f"http://www.hot.net/{'b' if i % 4 == 0 else 'a'}/{i}") for i in range(400)]
    rows += [(5000, "http://www.hot.net/c"), (5001, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    rules = [("block", "net/b/"), ("allow", "net/a/")]
    found = url_boosting.prepared(pages, rules).collect()
    assert len(found) == len(rows)
    labels = {r.page_id: (r.page_id % 1000) % 4 == 0 for r in found if r.page_id < 5000}
    share = sum(labels.values()) / len(labels)
    fold = {r.page_id: r for r in found}
    assert all(fold[i].f_suffix_blocked == pytest.approx(share) for i in range(200))
    hot = {fold[1000 + i].f_suffix_blocked for i in range(400)}
    assert len(hot) == url_boosting.FOLDS  # the same for both labels of a fold
    blocked = sum(labels[1000 + i] for i in range(400))
    assert fold[5000].f_suffix_blocked == pytest.approx((blocked + 10 * share) / 410)
    monkeypatch.setattr(url_boosting, "BROADCAST_ROWS", 0)
    assert Counter(url_boosting.prepared(pages, rules).collect()) == Counter(found)


def test_threshold_that_errs_least():
    rng = random.Random(9)
    for _ in range(50):
        scores = [(round(rng.random(), 1), float(rng.random() < 0.4)) for _ in range(100)]
        weights = {0.0: rng.random(), 1.0: rng.random()}

        def errors(threshold):
            return sum(weights[y] for s, y in scores if (s >= threshold) != (y == 1))

        found = url_boosting._threshold(scores, weights)
        assert errors(found) == pytest.approx(min(errors(i / 20) for i in range(22)))
    assert url_boosting._threshold([(0.1, 0.0)] * 30 + [(0.9, 1.0)] * 30, {0.0: 1, 1.0: 1}) == 0.5
    assert url_boosting._threshold([(0.1, 0.0)] * 30, {0.0: 1}) == url_boosting.UNCALIBRATED


def _fitted(monkeypatch, module):
    """(label, weight) of the rows that a module's trees are fitted on, filled as it fits."""
    rows = []

    class Recording(module.GBTClassifier):
        def _fit(self, dataset):
            rows.extend(map(tuple, dataset.select("label", self.getWeightCol()).collect()))
            return super()._fit(dataset)

    monkeypatch.setattr(module, "GBTClassifier", Recording)
    return rows


def test_all_labelled_urls_are_fitted(spark, monkeypatch):
    rows = [(i, f"http://h{i % 90}.{'net' if i % 3 else 'info'}/{'b' if i % 3 else 'a'}/{i}")
            for i in range(900)]
    pages = spark.createDataFrame([*rows, (1000, "http://h.com/")], "page_id bigint, url string")
    features = url_boosting.prepared(pages, [("block", "net/b/"), ("allow", "info/a/")])
    held_out = F.pmod(F.xxhash64(F.lit(url_boosting.SEED + 2), "host"), F.lit(4)) == 0
    expected = features.where("label IS NOT NULL").where(~held_out).groupBy("label").count()
    fitted = _fitted(monkeypatch, url_boosting)
    model, threshold = url_boosting.fit(features, 60, trees=2)
    assert Counter(label for label, _ in fitted) == dict(map(tuple, expected.collect()))
    assert set(fitted) == {(0.0, 30 / 300), (1.0, 30 / 600)}
    assert model is not None and 0 < threshold < 1


def test_thresholds_of_any_number_of_scores(spark, monkeypatch):
    rng = random.Random(10)
    monkeypatch.setattr(common, "CELLS", 8)
    for shift in (0.0, 0.3, 0.5):
        rows = [("", y, round(min(1.0, rng.random() * 0.7 + shift * y), 2))
                for y in (0.0, 1.0) for _ in range(60)]
        rows += [("", 0.0, 0.0), ("", 1.0, 1.0)]
        table = spark.createDataFrame(rows, "kind string, label double, score double")
        expected = url_boosting._threshold([(s, y) for _, y, s in rows], {0.0: 1, 1.0: 1})
        assert url_boosting._calibrated(table.drop("kind")) == expected
        # three kinds: as they are, few, and mostly right
        rows = [("email", y, s) for _, y, s in rows]
        rows += [("ip", 1.0, 0.5)] * 19
        rows += [("card", float(rng.random() < s * 1.5), s) for _, _, s in rows if s > 0.2]
        table = spark.createDataFrame(rows, "kind string, label double, score double")
        expected = {
            kind: span_boosting._threshold(
                sorted(((s, y, 1.0) for k, y, s in rows if k == kind), reverse=True)
            )
            for kind in span_boosting.KINDS
        }
        assert span_boosting._calibrated(table) == expected
    assert url_boosting._calibrated(table.drop("kind").where("label = 1")) == url_boosting.UNCALIBRATED


def test_url_query_uses_no_python(spark, sf_dir):
    plan = QUERIES["op7_url_boosting"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|ArrowEval", plan)


# -- personal data ------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        sums = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(s - 9 * (s > 9) for s in sums) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _base(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if _passes(kind, m[0])
    ]


def _overlaps(a, b):
    return a[1] < b[2] and b[1] < a[2]


def test_base_spans_of_any_text(spark):
    rng = random.Random(2)
    pieces = ["a", "b.c", "@", ".", "-", "_", "%", "é", "𝒳", "\n", " ", "+", "(", ")", "1", "25",
              "255", "4111111111111111", "256.1.1.1", "1.2.3.4", "+1 (212) 555-0100", "a@b.co",
              "x@y.z.", "0", "99"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(25))) for _ in range(1500)]
    texts += [None, "", "1" * 20_000, "a" * 50_000 + "@", "+" * 3000, "x@y.z " * 3000]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a@b.co", "x", 1)] * 2
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, kind string, start int")
    found = span_boosting.find_spans(documents).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r.spans for r in found}
    for i, text in [*enumerate(texts), (None, "a@b.co")]:
        base = [(s.kind, s.start, s.end) for s in by_id[i] if s.base]
        assert base == _base(text), repr(text)[:200]
        added = [(s.kind, s.start, s.end) for s in by_id[i] if not s.base]
        assert not any(_overlaps(a, b) for a in added for b in base)
        assert not any(_overlaps(a, b) for a, b in itertools.combinations(added, 2))
    assert span_boosting.find_spans(documents.where("false")).count() == 0


def _luhn(rng, valid):
    digits = [rng.randrange(10) for _ in range(15)]
    for last in range(10):
        number = "".join(map(str, [*digits, last]))
        if _passes("card", number) == valid:
            return number
    raise AssertionError


def test_trees_add_spans_in_other_forms(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        a, b, c, d = (rng.randrange(256) for _ in range(4))
        rows.append((i, "\n".join([
            f"mail me at user{i}@host{a}.example.com or call +1 ({a % 900 + 100}) 555-{i + 1000}",
            f"address {a}.{b}.{c}.{d} and version {a}.{b}.{c}.{d + 300}",
            f"card {_luhn(rng, True)} order {_luhn(rng, False)} number {rng.randrange(10**8, 10**10)}",
        ])))
    wanted = {
        5000: ("write to jane.doe [at] example [dot] com today", "email", "jane.doe [at] example [dot] com"),
        5001: ("address 97[.]51[.]17[.]173 was seen", "ip", "97[.]51[.]17[.]173"),
        5002: ("nothing personal, 12 of 2024-05-06, pages 10-20, 3.14 and 1/2", None, None),
    }
    rows += [(i, text) for i, (text, _, _) in wanted.items()]
    found = span_boosting.find_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))
    by_id = {r.doc_id: r.spans for r in found.collect()}
    for i, (text, kind, span) in wanted.items():
        spans = [(s.kind, text[s.start : s.end]) for s in by_id[i]]
        assert spans == ([(kind, span)] if kind else [])
    # numbers that fail their check stay out
    assert all(len(by_id[i]) == len(_base(rows[i][1])) for i in range(1200))


def test_other_writings(spark):
    rng = random.Random(13)
    rows = []
    for i in range(1200):
        a, b, c, d = (rng.randrange(256) for _ in range(4))
        rows.append((i, "\n".join([
            f"mail me at user{i}@host{a}.example.com or call +{a % 90 + 1} ({b + 100}) 555-{i + 1000}",
            f"address {a}.{b}.{c}.{d} and version {a}.{b}.{c}.{d + 300}",
            f"card {_luhn(rng, True)} order {_luhn(rng, False)} number {rng.randrange(10**8, 10**10)}",
        ])))
    card = _luhn(rng, True)
    in_fours = [card[i : i + 4] for i in range(0, 16, 4)]
    wanted = [
        ("write to {} today", "email", "jane.doe (at) example.com"),
        ("write to {} today", "email", "jane.doe[at]example[dot]com"),
        ("write to {} today", "email", "bob@exämple.com"),
        ("call {} now", "phone", "+49 (0)30 / 1234567"),
        ("tel {} now", "phone", "030-1234567"),
        ("tel {} now", "phone", "0049 30 1234567"),
        ("card {} expires", "card", ".".join(in_fours)),
        ("card {} expires", "card", "/".join(in_fours)),
    ]
    others = [
        "paid by IBAN DE89 3704 0044 0532 0130 00 today", "order 2024-000123 of 2024-05-06",
        "from 06.05.2024 to 12.11.2025, pages 1000-2000", "1.000.000 or 2.500.000 of them",
        "version 1.20.3 of 12.4.2020", "section 1. 2. 3. 4 of it",
    ]
    rows += [(5000 + i, text.format(span)) for i, (text, _, span) in enumerate(wanted)]
    rows += [(6000 + i, text) for i, text in enumerate(others)]
    found = span_boosting.find_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))
    texts, by_id = dict(rows), {r.doc_id: r.spans for r in found.collect()}
    spans = {i: [(s.kind, texts[i][s.start : s.end]) for s in by_id[i]] for i in texts}
    for i, (_, kind, span) in enumerate(wanted):
        # the trees don't reach these two yet; nothing else may be found in their place
        unsure = span in ("bob@exämple.com", "+49 (0)30 / 1234567")
        assert spans[5000 + i] in ([(kind, span)], [] if unsure else [(kind, span)]), span
    assert not any(spans[6000 + i] for i in range(len(others))), [spans[6000 + i] for i in range(len(others))]
    assert all(len(by_id[i]) == len(_base(rows[i][1])) for i in range(1200))


def test_numbers_side_by_side(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        a, b, c = (rng.randrange(256) for _ in range(3))
        rows.append((i, "\n".join([
            f"call +1 ({a % 900 + 100}) 555-{i + 1000} or {a}.{b}.{c}.{i % 256}",
            f"{_luhn(rng, True)} a\n{_luhn(rng, False)} b\n{rng.randrange(10**8, 10**10)} c",
        ])))
    cards = [_luhn(rng, True) for _ in range(7)]
    wanted = {
        5000: (f"{cards[0]} {cards[1]}", [("card", c) for c in cards[:2]]),
        5001: ("+1 (843) 555-7672 170.106.47.218",
               [("ip", "170.106.47.218"), ("phone", "+1 (843) 555-7672")]),
        5002: (" ".join(cards[2:]), [("card", c) for c in cards[2:]]),
    }
    rows += [(i, text) for i, (text, _) in wanted.items()]
    found = span_boosting.find_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))
    by_id = {r.doc_id: r.spans for r in found.collect()}
    for i, (text, spans) in wanted.items():
        assert [(s.kind, text[s.start : s.end]) for s in by_id[i]] == spans


def test_few_examples_of_a_kind(spark):
    """Too few to calibrate, or rare among very many plain numbers."""
    for plain, rows in ((30, 20_000), (4_000, 300)):
        rng = random.Random(7)
        texts = [f"{rng.randrange(10**8, 10**10)} is a number" for _ in range(plain)]
        texts += [f"at {rng.randrange(256)}.{i}.7.{i + 9} or 1.{i}.300.4" for i in range(12)]
        texts.append("seen at 97[.]51[.]17[.]173 today")
        table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        found = span_boosting.find_spans(table, rows).where(f"doc_id = {len(texts) - 1}").first()
        assert [(s.kind, s.start, s.end, s.base) for s in found.spans] == [("ip", 8, 26, False)]


def test_all_labelled_spans_are_fitted(spark, monkeypatch):
    rng = random.Random(8)
    texts = [f"{rng.randrange(10**8, 10**10)} is a number" for _ in range(400)]
    texts += [f"write to name{i}@mail{i}.org or 1.{i % 250}.7.9" for i in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    fitted = _fitted(monkeypatch, span_boosting)
    span_boosting.spans(table, 100)
    # 400 numbers, 600 spans, 300 addresses as numbers, all rewritten too; a quarter is held out
    assert len(fitted) > 1_000
    assert sum(weight for _, weight in fitted) < 100


@pytest.mark.parametrize("together", [2_000, 5])
def test_best_spans_first(spark, monkeypatch, together):
    monkeypatch.setattr(span_boosting, "TOGETHER", together)
    rng = random.Random(6)
    rows = []
    for text in range(20):
        for _ in range(rng.randrange(40)):
            start = rng.randrange(100)
            rows.append((text, 0, "phone", start, start + rng.randrange(1, 12), False, rng.random()))
        rows += [(text, 0, "ip", at, at + 5, True, 2.0) for at in rng.sample(range(100), 2)]
    table = spark.createDataFrame(
        rows, "h1 bigint, h2 bigint, kind string, start bigint, end bigint, base boolean, score double"
    )
    expected = set()
    for text in range(20):
        taken = [r for r in rows if r[0] == text and r[5]]
        proposals = [r for r in rows if r[0] == text and not r[5]]
        for row in sorted(proposals, key=lambda r: (round(r[6], 1), r[4] - r[3], r[6]), reverse=True):
            if not any(_overlaps(row[2:5], t[2:5]) for t in taken):
                taken.append(row)
        expected |= {r[:6] for r in taken}
    assert set(map(tuple, span_boosting._without_overlaps(table).collect())) == expected


def test_redaction(spark):
    rows = [(1, "a é x@y.zz b"), (2, "no"), (3, None), (4, "x@y.zz, +12 345 678 90")]
    found = dict(map(tuple, span_boosting.redact(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()))
    assert found == {1: "a é [email] b", 2: "no", 3: "", 4: "[email], [phone]"}


def test_digests_of_the_query(spark, sf_dir):
    found = QUERIES["op9_span_boosting"](spark, sf_dir).collect()
    texts = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    assert len(found) == len(texts)
    for row in found:
        base = _base(texts[row.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        counts = Counter(k for k, _, _ in base)
        assert [row[f"n_{k}"] for k in PLAIN] == [counts[k] for k in PLAIN]


# -- mixing ---------------------------------------------------------------------------------------


def _cheapest(sizes, quotas, repeats=2):
    """Most words that quotas take, and their least cost, by trying all flows."""
    best = (-1, 0)
    patterns = list(sizes)
    ways = []
    for p in patterns:
        options = range(repeats * sizes[p] + 1)
        ways.append([w for w in itertools.product(options, repeat=len(p)) if sum(w) <= repeats * sizes[p]])
    for chosen in itertools.product(*ways):
        into = Counter()
        for p, way in zip(patterns, chosen, strict=True):
            into.update(dict(zip(p, way, strict=True)))
        if any(into[s] > q for s, q in quotas.items()):
            continue
        totals = [sum(way) for way in chosen]
        cost = sum(max(0, t - sizes[p]) for p, t in zip(patterns, totals, strict=True))
        best = max(best, (sum(totals), -cost))
    return best


def test_flow_is_the_cheapest_of_the_largest():
    rng = random.Random(4)
    for _ in range(30):
        sizes = {p: rng.randrange(3) for p in [("a",), ("a", "b"), ("b", "c"), (None,)]}
        quotas = {s: rng.randrange(5) for s in ("a", "b", "c", None)}
        taken = flow_mixing.min_cost_flow(sizes, quotas)
        cost = sum(max(0, t - sizes[p]) for p, t in taken.items())
        assert (sum(taken.values()), -cost) == _cheapest(sizes, quotas)


def test_targets():
    sizes = {"a": 100, "b": 10, "c": 50, None: 0}
    weights = flow_mixing.by_rank(sizes, (3, 1, 2))
    assert weights == {"a": 3, "b": 1, "c": 2, None: 3}
    shares = flow_mixing.capped_shares(sizes, weights, 240)
    assert shares == {"a": 132.0, "b": 20.0, "c": 88.0, None: 0.0}
    assert sum(flow_mixing.capped_shares({}, {}, 0).values()) == 0


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        source = rng.choice(["s1"] * 6 + ["s2", "s3", "é", None])
        rows.append((i, " ".join(["w"] * min(4000, int(rng.lognormvariate(4, 1.3)))), source, "x"))
    rows += [(9000, "w " * 9000, "big", "x"), (9001, "w " * 50, "big", "x"), (9002, None, "s1", "x"),
             (9003, "", "empty", "x"), (None, "w w", "s2", "x"), (9004, "w " * 70, "s2", "x")]
    rows += rows[-1:] * 2
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, cut string")


def test_mix_report(spark, sources):
    found = flow_mixing.mix_report(sources.repartition(5)).collect()
    docs = sources.collect()
    assert len(found) == len(docs)
    sizes, taken, targets, largest = Counter(), Counter(), {}, defaultdict(int)
    for r in docs:
        sizes[r.source] += len(WORDS.findall(r.text or ""))
    for r in found:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        assert r.taken == r.size * r.repeats
        taken[r.source] += r.taken
        targets[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    weights = flow_mixing.by_rank(sizes, (3, 1, 2))
    wanted = flow_mixing.capped_shares(sizes, weights, 1.5 * sum(sizes.values()))
    assert targets == pytest.approx(wanted)
    for source, target in targets.items():
        near = 0.02 * sizes[source] if source != "big" else largest[source]
        assert abs(taken[source] - target) <= near + 1, source
    again = flow_mixing.mix_report(sources.repartition(2)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    assert flow_mixing.mix_report(sources.where("false")).count() == 0


def test_mix_repeats_documents(spark, sources):
    quotas = flow_mixing.source_quotas((3, 1, 2), 1.5, 2.0)
    mixed = flow_mixing.mix(sources, quotas)
    assert mixed.columns == sources.columns
    report = flow_mixing.mix_report(sources).where("taken > 0")
    wanted = Counter()
    for r in report.collect():
        wanted[(r.doc_id, r.source)] += r.repeats
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == wanted


def test_documents_of_several_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i < 50 else ["a", "b"]) for i in range(100)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, members array<string>")
    mixed = flow_mixing.mix(documents, lambda sizes: {"a": 300, "b": 400}, F.col("members"))
    counts = Counter(r.doc_id for r in mixed.collect())
    assert sum(counts.values()) == 70 and max(counts.values()) == 1
    assert sum(i >= 50 for i in counts) >= 40


# -- pipeline ---------------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "near-dedup", "source mix", "packing"
    ]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, sf_dir).persist()
        assert docs.columns == columns, name
        rows = docs.count()
        assert rows > 0 and (rows <= before or name == "source mix")
        if name == "near-dedup":
            assert docs.select("doc_id").distinct().count() == rows
        assert docs.where("n_chars <> length(text)").isEmpty()
        before = rows
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    ends = defaultdict(int)
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 4096
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in docs.collect())


def test_pipeline_hands_over_small_batches(spark, sf_dir, monkeypatch):
    """A session's larger batches are made smaller, its smaller ones stay; run() sets back."""
    setting = corpus_pipeline.BATCH_SETTING
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a b c' AS text").coalesce(1)

    def batches():
        def sizes(found):
            for batch in found:
                yield batch.select([0]).slice(0, 1)

        return docs.mapInArrow(sizes, "doc_id bigint").count()

    stages = dict(corpus_pipeline.STAGES)
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "10000")
        assert batches() == 1
        for name in ("quality rules", "near-dedup", "packing"):
            for given, then in (("10000", 4), ("0", 4), ("500", 8)):
                spark.conf.set(setting, given)
                stages[name](spark, docs, sf_dir)
                assert batches() == then, (name, given)
    finally:
        spark.conf.set(setting, before)
    seen = []
    monkeypatch.setattr(
        corpus_pipeline,
        "STAGES",
        [("quality rules", lambda *a: seen.append(corpus_pipeline.quality(*a)) or seen[-1])],
    )
    corpus_pipeline.run(spark, sf_dir).count()
    assert seen and spark.conf.get(setting) == before


def test_small_tables_need_no_python_worker(spark):
    """Spark makes a table of Python rows in workers; one that comes as Arrow is a local one."""
    schema = "members array<string>, n bigint, chosen array<struct<h:string,doc_id:bigint>>"
    rows = [([None], 1, [{"h": "x", "doc_id": None}]), (["a", "b"], None, [])]
    for some in (rows, []):
        found = common.small_table(spark, some, schema)
        plain = spark.createDataFrame(some, schema)
        assert found.schema == plain.schema
        assert found.collect() == plain.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "LocalTableScan" in plan and "ExistingRDD" not in plan


def test_pipeline_of_no_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
