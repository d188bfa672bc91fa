"""op9: accuracy on held-out pages, and each kind of evidence by itself."""

from quarry.llm import langid as L

from ..conftest import SF001, SF01

EN = "the house on the hill was old and the people who lived there were kind to everyone that came with a question"
DE = "das haus auf dem berg war alt und die leute die dort wohnten waren freundlich zu jedem der mit einer frage kam"


def model(spark):
    docs = spark.createDataFrame([(i, "en" if i % 2 else "de", EN if i % 2 else DE) for i in range(40)],
                                 "doc_id long, lang string, text string")
    return L.train(docs)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "'q' as host")


def test_accuracy_on_given_pages(spark):
    """Truth is the language part of the address, which the operator doesn't read."""
    got = L.op9_langid(spark, SF01).collect()
    assert len(got) == 250
    assert sum(r.lang == r.url.split("/")[3][:2] for r in got) / len(got) > 0.98
    assert sum(r.text_lang == r.url.split("/")[3][:2] for r in got) / len(got) > 0.95
    assert len(L.op9_langid(spark, SF001).collect()) > 0


def test_host_and_declaration_decide_without_text(spark):
    rows = [(i, f"http://a.example.de/{i}", f"<html lang=de><article><p>{DE}</p></article>") for i in range(30)]
    rows += [(100 + i, f"http://b.example.com/{i}", f"<html lang=en><article><p>{EN}</p></article>") for i in range(30)]
    rows += [(200, "http://a.example.de/x", ""), (201, "http://b.example.com/y", None),  # the host's prior
             (202, None, "<html lang='DE-at'></html>"), (203, None, "<html lang=en></html>"),  # the declaration
             (204, "http://new.example.de/", ""),  # the name's prior
             (205, None, None), (None, None, None), (206, "no address", EN), (206, "no address", EN),
             (207, "http://a.example.de/z", f"<html lang=de><p>{EN} {EN}</p>")]  # text against the rest
    got = L.identified(pages(spark, rows), model(spark)).collect()
    assert len(got) == len(rows)
    of = {r.id: r for r in got}
    assert [of[k].lang for k in (200, 201, 202, 203, 204, 206, 207)] == ["de", "en", "de", "en", "de", "en", "en"]
    assert of[200].text_lang is None and of[207].text_lang == "en" and of[202].declared == "de"
    assert all(0.5 <= r.p <= 1 for r in got)


def test_long_text_empty_table_and_no_labels(spark):
    m = model(spark)
    got = L.identified(pages(spark, [(1, "http://x.y/", f"<p>{EN * 3000}</p>")]), m).first()
    assert got.lang == "en"
    none = pages(spark, [(1, "u", "<p>x</p>")])
    assert L.identified(none.limit(0), m).collect() == []
    docs = spark.createDataFrame([(1, None, "x"), (None, "en", "y")], "doc_id long, lang string, text string")
    bare = L.train(docs)
    assert bare.languages == [] and L.identified(none, bare).first().lang is None


def brute_fusion(rows, m):
    """(id, url) -> (lang, p) by plain sums over all pages."""
    import math
    import re
    from collections import defaultdict

    n, seen = len(m.languages), []
    sums = {k: defaultdict(lambda: [0.0] * n + [0]) for k in ("host", "name", "suffix", "declared", "all")}
    for i, url, html in rows:
        ll = [float(x) for x in m.log_likelihood(L.extract(html))]
        w = [math.exp(x - max(ll)) for x in ll]
        post = [x / sum(w) for x in w]
        found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        host = found[1].lower() if found else ""
        tail = host.split(".")
        name = ".".join(tail[-2:]) if len(tail) > 1 and tail[-1] and tail[-2] else ""
        said = L.DECLARED.search(html or "")
        keys = {"host": host, "name": name, "suffix": tail[-1], "declared": said[1].lower() if said else "", "all": ""}
        seen.append(((i, url), ll, post, keys))
        for k, v in keys.items():
            for j in range(n):
                sums[k][v][j] += post[j]
            sums[k][v][n] += 1
    out = []
    for key, ll, post, keys in seen:
        own, name, suffix, said, every = (sums[k][keys[k]] for k in ("host", "name", "suffix", "declared", "all"))
        fused = []
        for j in range(n):
            p = (every[j] + 1) / (every[n] + n)
            p = (suffix[j] + L.SUFFIX_WEIGHT * p) / (suffix[n] + L.SUFFIX_WEIGHT)
            p = (name[j] + L.DOMAIN_WEIGHT * p) / (name[n] + L.DOMAIN_WEIGHT)
            p = (max(own[j] - post[j], 0.0) + L.HOST_WEIGHT * p) / (own[n] - 1 + L.HOST_WEIGHT)
            how = math.log((said[j] + 1) / (every[j] + n) * (every[n] + n) / (said[n] + 1)) if keys["declared"] else 0.0
            fused.append(ll[j] + how + math.log(p))
        best = max(fused)
        out.append((key, m.languages[fused.index(best)], 1 / sum(math.exp(x - best) for x in fused)))
    return out


def test_fusion_matches_plain_sums(spark):
    m = model(spark)
    hosts = ["a.example.de", "b.example.de", "example.com", "x.y.com", "B.example.DE:80", "u@z.org"]
    rows = [(i, f"http://{hosts[i * i % 6]}/{i}", f"<html lang={'de' if i % 3 else 'en'}><p>{(EN, DE, '')[i % 7 % 3]}</p></html>")
            for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "mailto:x", "<p>das haus</p>"), (103, "http://a.example.de/", None), (5, None, EN)]
    rows += rows[:4]
    got = sorted(((str((r.id, r.url)), r.lang, r.p) for r in L.identified(pages(spark, rows), m).collect()))
    want = sorted((str(k), lang, p) for k, lang, p in brute_fusion(rows, m))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert max(abs(g[2] - w[2]) for g, w in zip(got, want)) < 1e-9
