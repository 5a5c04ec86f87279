"""URL templates, toxicity, the pipeline and the registered queries."""

from __future__ import annotations

import random
import re
import zlib

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from civicledger.llm import toxicity, url_templates
from civicledger.llm.queries import QUERIES, table
from tools.check import compare, database

SMALL = "/root/testdata/sf0.001"


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return brute.lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def ruled(host, path):
    fit = [(h + p, v) for v, h, p in url_templates.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda r: len(r[0]), default=(None, None))


def test_urls(spark):
    table(spark, SMALL, "region")
    urls = [None, "", "no scheme/en/", "http://", "https://A.Example.COM/en/7?x=/en/", "http://www.example.com/en/", "x://net", "x://NET/es/", "x://a.net/fr/#y", "x://anet/fr/", "http://com/", "a://b://c/d", "http://É.com/q"]
    good = [(k, f"http://h.org/good/{k}") for k in range(100, 140)]
    bad = [(k, f"http://h.org/bad/{k}.html") for k in range(200, 240)]
    deep = [(k, "http://deep.org/" + "/".join(f"s{i}" for i in range(30)) + f"/{k}") for k in range(300, 303)]
    many = [(k, f"http://hot.org/{k:x}x/{k}") for k in range(400, 900)]
    rows = [(k, u) for k, u in enumerate(urls)] + good + bad + deep + many + [good[0]] * 2
    pages = spark.createDataFrame([(*r, "z", "t") for r in rows], "page_id bigint, url string, host string, template string")
    labels = spark.createDataFrame([(k, int(k < 200), 0) for k, _ in good[::2] + bad[::2]] + [(None, 1, None), (205, None, None)], "doc_id bigint, quality int, toxic int")
    got = url_templates.judged(spark, pages, labels).collect()
    assert len(got) == len(rows)
    by_id = dict(rows)
    for r in got:
        host, path = parsed(by_id[r.page_id])
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if 200 <= r.page_id < 240 else "allow"))
    names = {r.page_id: r.template for r in got}
    assert names[100] == "h.org/good/{n}" and names[201] == "h.org/bad/{n}.*" and names[450] == "hot.org/*/{n}" and names[300].endswith("/s7/**") and names[0] == ""
    nothing = spark.createDataFrame([], labels.schema)
    assert {r.verdict for r in url_templates.judged(spark, pages.filter("page_id between 200 and 240"), nothing).collect()} == {"allow"}
    assert url_templates.judged(spark, pages.limit(0), labels).count() == 0


def test_small_and_deep_bad_sections_are_told_apart(spark):
    table(spark, SMALL, "region")
    deep = "/".join(f"s{i}" for i in range(9))
    sections = [f"wide.org/sec{i}" for i in range(20)] + [f"deep.org/{deep}/a", f"deep.org/{deep}/b"] + [f"year.org/{y}" for y in range(2000, 2020)]
    bad = {"wide.org/sec3", f"deep.org/{deep}/b", "year.org/2007"}
    of = {1000 * k + i: s for k, s in enumerate(sections) for i in range(20)}
    pages = spark.createDataFrame([(n, f"http://{s}/{n}") for n, s in of.items()], "page_id bigint, url string")
    labels = spark.createDataFrame([(n, int(s not in bad)) for n, s in of.items() if n % 2], "doc_id bigint, quality int")
    got = url_templates.judged(spark, pages, labels).collect()
    assert len(got) == len(of)
    assert {r.page_id for r in got if r.verdict == "block"} == {n for n, s in of.items() if s in bad}


def test_sections_without_labels_join_no_bad_ones(spark):
    table(spark, SMALL, "region")
    of = {100 * k + i: f"h.org/{s}" for k, s in enumerate(["bad", "new", "sure"]) for i in range(40)}
    of |= {1000 + i: f"h.org/sure/{'fg'[i % 2]}x" for i in range(40)}
    pages = spark.createDataFrame([(n, f"http://{s}/{n}") for n, s in of.items()], "page_id bigint, url string")
    labels = spark.createDataFrame([(n, int(s != "h.org/bad")) for n, s in of.items() if n < 1000 and s != "h.org/new"], "doc_id bigint, quality int")
    got = url_templates.judged(spark, pages, labels).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == {n for n, s in of.items() if s == "h.org/bad"}
    purity = {of[r.page_id]: r.purity for r in got}
    # 40 of 80 labelled pages of the host are good, of all pages too.
    assert purity["h.org/bad"] == pytest.approx(1 / 42) and purity["h.org/sure"] == pytest.approx(41 / 42) and purity["h.org/new"] == pytest.approx(0.5)


def naive_segments(scores):
    """Ruzzo and Tompa's definition: the best segment, then the same on either side of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0, 0, 0))
    if best[0] <= 1e-12:
        return []
    a, b = best[3:]
    return [x for x in naive_segments(scores[:a])] + [(a, b)] + [(s + b, e + b) for s, e in naive_segments(scores[b:])]


def test_maximal_segments():
    rng = random.Random(3)
    for _ in range(200):
        scores = np.array([rng.choice([-2.03, -1.11, -0.57, 1.31, 2.17, 0.73]) + rng.random() / 100 for _ in range(rng.randint(0, 14))])
        got = toxicity.maximal_segments(scores, np.flatnonzero(scores > 0), np.r_[0.0, np.cumsum(scores)])
        assert [(a, b) for a, b, _ in got] == naive_segments(list(scores))
        assert all(abs(s - scores[a:b].sum()) < 1e-9 for a, b, s in got)


def test_chance_rate_and_calibration():
    rng = np.random.default_rng(4)
    model = toxicity.Model(scale=1.0)
    scores, share = np.array([2.0, -0.5]), np.array([0.1, 0.9])
    model.rate = toxicity._chance_rate(scores, share)
    assert abs((share * np.exp(model.rate * scores)).sum() - 1) < 1e-6
    draws = rng.choice(scores, p=share, size=(400, 300))
    best = []
    for row in draws:
        found = toxicity.maximal_segments(row, np.flatnonzero(row > 0), np.r_[0.0, np.cumsum(row)])
        best.append(max(s for *_, s in found))
    # Each e-fold in the bound divides the share of texts that exceed it by about e.
    low, high = np.quantile(best, 0.7), np.quantile(best, 0.7) + 1 / model.rate
    assert 1.5 < (np.array(best) > low).mean() / max(1e-9, (np.array(best) > high).mean()) < 6


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(5)
    vocabulary = [f"word{k}" for k in range(800)]
    rows, labels = [], []
    for k in range(600):
        own = rng.choices(vocabulary, k=rng.randint(5, 120))
        toxic = int(k % 6 == 0)
        if toxic:
            at = rng.randrange(len(own))
            own[at:at] = rng.choices(["dolt", "fool", "swine"], k=4)
        rows.append((k, " ".join(own).title(), "x", 0.5))
        labels.append((k, toxic))
    rows += [(1000, None, "x", None), (1001, "", "x", None), (1002, "word1 " * 50_000, "x", None), (None, "dolt fool swine dolt", None, None), rows[0], rows[0]]
    return rows, labels


def test_toxicity(spark, talk):
    rows, labels = talk
    table(spark, SMALL, "region")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, score double").repartition(3)
    known = spark.createDataFrame([(*r, 0) for r in labels] + [(None, 1, 0), (3, None, 0), (5000, 1, 1)], "doc_id bigint, toxic int, score int")
    got = toxicity.judged(docs, known).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    assert sum(r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth and r.held_out) >= 0.97 * sum(r.held_out for r in got if r.doc_id in truth)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    assert {r.predicted for r in got if r.doc_id in (1000, 1001, 1002)} == {0} and {r.predicted for r in got if r.doc_id is None} == {1}
    model = toxicity.fit(docs, known)
    found = {r.doc_id: r.passages for r in toxicity.scored(docs, model).filter("doc_id in (6, 1002)").collect()}
    assert found[6] and not found[1002]
    # Labels of held-out rows change nothing.
    held = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    again = toxicity.judged(docs, spark.createDataFrame(held, "doc_id bigint, toxic int")).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_model_does_not_depend_on_how_rows_are_dealt(spark, talk):
    rows, labels = talk
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, score double")
    one, two = (toxicity.fit(d, known) for d in (docs.coalesce(1), docs.union(docs.filter("doc_id % 3 = 0")).orderBy(F.rand(1)).repartition(7)))
    assert len(one.words) and np.array_equal(one.words, two.words) and np.array_equal(one.scores, two.scores)
    assert (one.rate, one.scale) == (two.rate, two.scale) and np.array_equal(one.curve, two.curve)
    scores = [sorted((r.doc_id or -1, r.score) for r in toxicity.scored(d, one).collect()) for d in (docs.coalesce(1), docs.repartition(5))]
    assert scores[0] == scores[1]


def test_only_copies_do_not_count(spark):
    """Half a text of boilerplate, or a short text, makes no copy; a changed word in a long text does."""
    rng = random.Random(11)
    prose = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    boilerplate, long = prose(60), prose(100)
    texts = [" ".join(boilerplate + prose(60)) for _ in range(40)] + [" ".join(prose(k % 3)) for k in range(30)]
    first = len(texts)
    texts += [" ".join(long), " ".join(long[:50] + ["changed"] + long[51:]), " ".join(long).upper()]

    def triples(text):
        words = re.findall("[a-z0-9]+", text.lower())
        return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)}

    def alike(one, two):
        return len(one & two) >= 0.8 * len(one | two)

    sets = list(map(triples, texts))
    want = {k for k in range(len(texts)) if any(alike(sets[k], sets[j]) for j in range(k))}
    assert {first + 1, first + 2} <= want and not want & set(range(40))
    for parts in (1, 5):
        frame = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)] + [(first, " ".join(long), 1), (first + 9, None, 1)], "doc_id bigint, text string, toxic int").repartition(parts)
        assert {(r.doc_id, r.toxic) for r in toxicity.copies(frame).collect()} == {(k, 0) for k in want}


def test_toxicity_without_labels(spark, talk):
    docs = spark.createDataFrame(talk[0], "doc_id bigint, text string, source string, score double")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(0, 1), (6, 1), (12, 1)], "doc_id bigint, toxic int")
    for labels in (none, one):
        assert {r.score for r in toxicity.judged(docs, labels).collect()} == {0.0}
    assert toxicity.judged(docs.limit(0), one).count() == 0


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(QUERIES)))
def test_queries_match_sql(spark, name):
    got = queries()[name](spark, SMALL).toArrow()
    assert compare(got, database(SMALL).sql(oracle_sql()[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", ["op5_credential_links", "op8_weighted_fingerprints"])
def test_native_queries_run_no_python(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "secrets", "packing"]
    docs = table(spark, SMALL, "documents")
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    items = list(map(tuple, table(spark, SMALL, "benchmark").select("item_id", "text").collect()))
    kept = docs
    outs = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, SMALL).cache()
        assert kept.columns == docs.columns
        outs.append(dict(map(tuple, kept.select("doc_id", "text").collect())))
    clean, single, pure, masked = outs
    assert single.keys() == {i for i, (_, c) in brute.groups(clean).items() if i == c}
    hit = brute.contamination(single, items)
    assert pure.keys() == {i for i in single if not hit[i][-1]}
    assert masked.keys() == pure.keys()
    for i, text in masked.items():
        assert text == pure[i] if not brute.secrets(texts[i]) else "[SECRET]" in text and not brute.secrets(text)
    placed = corpus_pipeline.STAGES[4][1](spark, kept, SMALL)
    assert {r.doc_id for r in placed.collect()} == masked.keys()


def test_pipeline_on_awkward_rows(spark):
    rows = brute.awkward()
    docs = spark.createDataFrame([(*r[:5],) for r in rows] + [(None,) * 5] * 2, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame, least in ((docs, 30), (docs.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SMALL).cache()
            assert frame.count() >= least


def test_near_copies_among_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(8)
    one, two, three, four = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(7, one), (7, one), (None, one), (None, two), (None, two + " more"), (9, three), (3, three), (9, four), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs.repartition(3), SMALL).collect()]
    assert len(got) == 6 and {(7, one), (3, three), (9, four), (None, None), (None, "")} < set(got)
    assert sum(t in (two, two + " more") for _, t in got) == 1
