"""URL reputation and licence scan."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from episodeframe.llm import hostrep, licences, queries
from tests.llm.helpers import EXTRA, documents


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S)[0]
    path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path, rules):
    fit = [(len(t), t, a) for a, t in rules for h, _, p in [t.partition("/")]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fit)[1:] if fit else (None, None)


URLS = ["http://A.Example.ORG/es/x?q#f", "https://example.org", "x://example.org/en/12", "http://org/", "ftp://b.com/fr/1", "b.com/fr/",
        "http://notorg/", "http://b.com?x=/fr/", "http://b.com/de#/x", "http://b.com/de/#", None, "", "://", "http://ÄB.com/fr/é",
        "http://u@h.co.uk:80/a", "http://1.2.3.4/", "a://b://c/d", "http://x.net\n/y"]


def test_hosts_paths_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(None, "http://q.net/", "x"), (3, URLS[3], "x")],
                                  "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = hostrep.judge(pages, none, queries.URL_RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        if r.page_id is not None:
            host, path = brute_url(URLS[r.page_id])
            rule, verdict = brute_rule(host, path, queries.URL_RULES)
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == (verdict or "allow")
    assert hostrep.judge(pages.limit(0), none, queries.URL_RULES).count() == 0


def test_reputation_shrinks_and_blocks(spark):
    rows, outcomes, n = [], [], 0
    for host, total, bad in [("bad.com", 60, 57), ("good.com", 80, 2), ("small.com", 1, 1), ("x.evil.net", 50, 48), ("y.evil.net", 0, 0),
                             *[(f"h{i}.fine.org", 20, 1) for i in range(20)]]:
        for k in range(max(total, 1)):
            rows.append((n, f"http://{host}/{k}"))
            if k < total:
                outcomes.append((n, int(k < bad)))
            n += 1
    outcomes += [(0, None), (None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.host: r for r in hostrep.judge(pages, spark.createDataFrame(outcomes, "page_id long, bad int"), []).collect()}
    assert got["bad.com"].verdict == "block" and got["x.evil.net"].verdict == "block"
    assert got["good.com"].verdict == got["h3.fine.org"].verdict == "allow"
    assert got["y.evil.net"].bad_rate > got["h3.fine.org"].bad_rate  # from its registered domain
    assert got["small.com"].bad_rate < 0.98 and all(0 < r.bad_rate < 1 and r.bound < r.bad_rate for r in got.values())


def test_site_levels(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "co.uk": ("co.uk", ""), "localhost": ("localhost", ""),
             "1.2.3.4": ("1.2.3.4", ""), "u@www.site.org:8080": ("site.org", "org"), "": ("", "")}
    domain, suffix = hostrep.site_levels(F.col("h"))
    got = {r.h: (r.d, r.s) for r in spark.createDataFrame([(h,) for h in hosts], "h string").select("h", domain.alias("d"), suffix.alias("s")).collect()}
    assert got == hosts


BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute_licences(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(k, label) for p, label in BASE.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    starts = [k for k, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


TEXTS = [None, "", " .,!", "Released under the MIT License.", "mit mit license license mit-LICENSE", "CC BY-NC 4.0 and CC-BY; cc by",
         "the GNU General Public License, version 3. GNU general\npublic  license", "gnu lesser general public license",
         "Licensed under the Apache License, Version 2.0.", "apache licenses", "by cc by by", "license mit", "é MIT License ünd cc\x7fby",
         "x " * 30000 + "apache license", "permission is hereby granted free of charge to any person obtaining a copy of that", "cc", "by", "gnu"]


def test_licences_against_brute_force(spark):
    docs = documents(spark, [*enumerate(TEXTS), (3, TEXTS[3]), (None, TEXTS[3])], EXTRA)
    got = licences.scan(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = TEXTS[3 if r.doc_id is None else r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licences(text), text[:40]
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    by = {r.doc_id: r for r in got}
    assert by[8].labels == "apache,apache-2.0" and by[6].labels == "gpl,gpl-3" and by[7].labels == "lgpl"
    assert "mit-text" in by[14].labels and by[14].score < 1
    assert licences.scan(docs.limit(0)).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from("gnu general public license apache cc by mit the".split()), max_size=14).map(" ".join), min_size=1, max_size=6))
def test_licences_on_random_word_orders(spark, texts):
    got = licences.scan(documents(spark, list(enumerate(texts)))).collect()
    assert all((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licences(texts[r.doc_id]) for r in got)


def test_native_plans(spark):
    docs = documents(spark, [(1, "mit license")])
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    for df in (licences.scan(docs), hostrep.judge(pages, spark.createDataFrame([], "page_id long, bad int"), queries.URL_RULES)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert np.isfinite(licences.idf(licences.template_words(docs, "doc_id", "text", ["mit"]), ["mit"])["mit"])
