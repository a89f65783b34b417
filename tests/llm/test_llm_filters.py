"""URL filter, quality rules and language identification."""

import collections
import random
import re

import numpy as np
from llm_fixtures import documents, edges, nothing  # noqa: F401
from pyspark.sql import functions as F

from barforge.llm import language as L
from barforge.llm import quality as Q
from barforge.llm import url_filter as U
from barforge.llm.queries import URL_RULES

URLS = [(1, None), (2, "no scheme.com/en/x"), (3, "HTTP://WWW.Example.COM/en/1?q#f"), (4, "https://example.com/en/"), (5, "http://a.example.com?x=/en/"),
        (6, "http://x.net/es/1"), (7, "http://net/fr/"), (8, "http://x.org"), (9, "http://É.NET/Es/1"), (10, "://"), (11, ""), (12, "http://notexample.com/en/a"),
        (13, "ftp://m.www.example.com/en/x://y"), (14, "http://a.net#/es/"), (14, "http://a.net#/es/"), (None, "http://1.2.3.4/a"), (16, "http://shop.co.uk/b/c")]


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "a", "b") for i, u in URLS], "page_id long, url string, host string, mean string")
    none = spark.createDataFrame([], "host string, bad long, n long")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in U.judge(pages, none, URL_RULES).collect()), key=str)
    exp = []
    for i, u in URLS:
        host, path = plain_url(u)
        fits = [(len(r), r, v) for v, r in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith("/" + r.partition("/")[2])]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        exp.append((i, host, path, rule, verdict))
    assert got == sorted(exp, key=str)
    assert U.judge(pages.limit(0), none, URL_RULES).collect() == []


def test_domains(spark):
    hosts = ["a.b.example.com", "example.com", "com", "shop.co.uk", "x.shop.co.uk", "co.uk", "1.2.3.4", "", "www.site.org"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", U.registered_domain(F.col("h")).alias("d"), U.suffix_of(F.col("h")).alias("s"))
    assert [tuple(r)[1:] for r in df.collect()] == [
        ("example.com", "com"), ("example.com", "com"), ("com", "com"), ("shop.co.uk", "co.uk"), ("shop.co.uk", "co.uk"), ("co.uk", "uk"),
        ("1.2.3.4", "1.2.3.4"), ("", ""), ("site.org", "org")]


def test_reputation_shrinks_towards_the_domain(spark):
    good = [(f"g{i}.fine.org", 0, 40) for i in range(30)]
    bad = [(f"b{i}.spam.org", 38, 40) for i in range(30)]
    few = [("new.spam.org", 1, 1), ("new.fine.org", 1, 1)]
    out = spark.createDataFrame(good + bad + few, "host string, bad long, n long")
    hosts = out.select("host").union(spark.createDataFrame([("unseen.spam.org",), ("unseen.fine.org",)], "host string"))
    mean = {r.host: r.a / (r.a + r.b) for r in U.host_reputation(out, hosts).collect()}
    assert mean["b0.spam.org"] > 0.8 and mean["g0.fine.org"] < 0.1
    assert mean["unseen.spam.org"] > 0.6 > mean["new.fine.org"] and mean["unseen.fine.org"] < 0.2
    pages = spark.createDataFrame([(1, "http://b0.spam.org/"), (2, "http://g0.fine.org/"), (3, "http://new.fine.org/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in U.judge(pages, out, []).collect()} == {1: "block", 2: "allow", 3: "allow"}


def plain_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if times[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


def test_quality_measures(spark, edges, nothing):
    none = spark.createDataFrame([], "doc_id long")
    more = [(20, "a b c d e f " * 3 + "x y z\nx y z\n\n \n| # $"), (21, "p q r s t p q r s t p q"), (22, " ".join(map(str, range(50))))]
    df = edges.unionByName(documents(spark, more))
    got = Q.judge(df, none).collect()
    assert sorted([tuple(r)[:6] + (r.base_failed,) for r in got], key=str) == sorted(
        [(r.doc_id, *plain_measures(r.text)) for r in df.collect()], key=str)
    assert all(r.score == 0 and r.kept != r.base_failed for r in got)
    assert Q.judge(nothing, none).collect() == []


def test_quality_separates_junk_from_unlabelled_prose(spark):
    rnd = random.Random(6)
    prose = [f"p{i}" for i in range(300)]
    junk = [f"j{i}%%%" for i in range(300)]
    rows = [(i, " ".join(rnd.choice(prose if i % 4 else junk) for _ in range(120))) for i in range(240)]
    trusted = spark.createDataFrame([(i,) for i in range(120) if i % 4], "doc_id long")
    kept = {r.doc_id: r.kept for r in Q.judge(documents(spark, rows), trusted).collect()}
    assert all(kept[i] == bool(i % 4) for i in kept)


def test_repeat_windows_do_not_rest_on_hashes():
    words = b"a b c d e f a b c d e".split()
    same = np.zeros(len(words), np.uint64)  # every hash collides
    assert Q.repeated_words(words, same) == 10


def language_rows(n, seed=1):
    rnd = random.Random(seed)
    parts = {"en": ["the", "ing", "tion", "er", "and", "th"], "de": ["sch", "ung", "ein", "ver", "heit", "der"], "fr": ["eau", "oui", "que", "aux", "ment", "les"]}
    out = []
    for i in range(n):
        lang = rnd.choice(sorted(parts))
        out.append((i, " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.randrange(8, 60))), lang))
    return out


def labelled(spark, rows):
    return spark.createDataFrame([(i, t, l, f"h{i % 5}.example.org", "x") for i, t, l in rows],
                                 "doc_id long, text string, lang string, source string, scores string")


def test_language_held_out_accuracy(spark):
    train, test = labelled(spark, language_rows(200)), language_rows(150, seed=7)
    names, models = L.fit_text_models(train, "lang", per_language=40)
    assert names == ["de", "en", "fr"]
    got = {r.doc_id: r for r in L.identify(labelled(spark, test), names, models, host_col="source").collect()}
    assert sum(got[i].lang == l for i, _, l in test) >= 148 and all(got[i].kept for i, _, _ in test)


def test_language_evidence_decides_short_texts(spark):
    rows = language_rows(300)
    names, models = L.fit_text_models(labelled(spark, rows), "lang")
    docs = [(i, t, "http://www.%s.example/%d" % (l, i)) for i, t, l in rows] + [(1000, "th", "http://www.fr.example/1"), (1001, "x", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, url string")
    got = {r.doc_id: r for r in L.identify(df, names, models, url_col="url").collect()}
    assert got[0].lang == rows[0][2]
    more = spark.createDataFrame([(i, "ab cd", "fr-CA" if i % 2 else "de") for i in range(40)], "doc_id long, text string, declared string")
    both = spark.createDataFrame([(i, t, l) for i, t, l in rows], "doc_id long, text string, declared string").union(
        more.withColumn("doc_id", F.col("doc_id") + 5000))
    said = {r.doc_id: r.lang for r in L.identify(both, names, models, declared_col="declared").collect()}
    assert sum(said[5000 + i] == ("fr" if i % 2 else "de") for i in range(40)) == 40


def test_language_edges(spark, edges, nothing):
    names, models = L.fit_text_models(labelled(spark, language_rows(60)), "lang")
    got = L.identify(edges, names, models, host_col="source").collect()
    assert len(got) == edges.count()
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert all(r.lang == "und" and not r.kept for i in (1, 2, 3) for r in by_id[i])
    assert len(by_id[None]) == 2 and len(by_id[6]) == 2
    assert L.identify(nothing, names, models).collect() == []
    assert L.fit_text_models(nothing, "lang")[0] == []
    assert {r.lang for r in L.identify(edges, *L.fit_text_models(nothing, "lang")).collect()} == {"und"}


def test_other_script_is_unknown(spark):
    names, models = L.fit_text_models(labelled(spark, language_rows(200)), "lang")
    df = documents(spark, [(1, "совсем другой язык и другие буквы " * 5), (2, "完全不同的文字 " * 20)])
    assert {r.lang for r in L.identify(df, names, models).collect()} == {"und"}


def test_page_evidence_of_whole_pages_and_all_pages(spark):
    late = "<!-- " + "licence " * 2000 + "-->"
    rows = [(1, "http://a.org/1", late + '<html class="x" lang="fr">'), (2, "http://a.org/2", "<html><p>"), (3, "http://b.org/2", None),
            (5, "http://d.org/2", '<HTML LANG=es-MX>'), (4, "http://c.org/2", "<html lang='de'>"), (6, "http://a.org/3", "no markup"), (7, "http://a.org/x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.doc_id: (r.declared, r.url) for r in L.page_evidence(pages).collect()}
    assert got == {1: ("fr", "http://a.org/1"), 2: ("de", "http://a.org/2"), 3: ("", "http://a.org/3")}
