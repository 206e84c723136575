import glob
import os
import random

import numpy as np
import pandas as pd
import pytest

from boutlens.llm import html_blocks, html_extract, quality, url_filter

SMALL = "/root/testdata/sf0.01"


def junk(r):
    return " ".join(r.choice(("BUY!!", "$$$", "NOW###", "WIN!!", "FREE%%%")) for _ in range(30))


def fine(r):
    return " ".join(r.choice(("the", "river", "ran", "over", "old", "stones", "and", "trees", "near")) for _ in range(30)).capitalize() + "."


@pytest.fixture(scope="module")
def judged(spark, make_docs):
    r = random.Random(2)
    rows = [(i, fine(r) if i % 3 else junk(r), r.choice(("h1", "h2", None))) for i in range(120)]
    rows += [(500, None, "h1"), (501, "", "h2"), (502, fine(r) * 200, "rare"), (503, fine(r), "h1"), (503, fine(r), "h1"), (None, fine(r), "h1")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(80)] + [(None, 1), (999, 0), (3, None)], "doc_id long, quality int")
    return make_docs(rows), labels


def test_junk_goes_and_clean_documents_stay(judged):
    docs, labels = judged
    rows = quality.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 < r.posterior < 1
        if r.doc_id is not None and r.doc_id < 500:
            assert r.kept == bool(r.doc_id % 3), r
    assert all(r.kept for r in rows if r.doc_id in (503, None))
    left = quality.keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in rows)


def test_sparse_sites_shrink_toward_their_parents(judged):
    rows = {r.doc_id: r for r in quality.judge(*judged).collect()}
    # without evidence the prior decides, and a site's share pulls it
    assert rows[500].evidence == 0 and rows[500].posterior == pytest.approx(rows[500].prior, abs=1e-6)


def test_posteriors_equal_a_plain_computation(judged):
    docs, labels = judged
    model = quality.train(docs, labels)
    rows = [(r.doc_id, r.source, r.lang, r.text) for r in docs.collect()]
    evidence = [float(model.evidence(np.array([quality.features(t)]))[0]) if t else 0.0 for *_, t in rows]
    own = [1 / (1 + np.exp(-(e + model.base))) for e in evidence]

    def moments(groups, means):
        """Prior documents by moments, from (n, good) and the prior mean of each group."""
        n, good = (np.array([g[k] for g in groups], float) for k in (0, 1))
        mean = np.array(means, float)
        variance = (n * mean * (1 - mean)).sum() / n.sum()
        between = ((n * (good / n - mean) ** 2).sum() - (len(n) - 1) * variance) / max(n.sum() - (n * n).sum() / n.sum(), 1e-9)
        return min(max(variance / between - 1, quality.STRENGTH[0]), quality.STRENGTH[1]) if between > 0 and len(n) > 1 else quality.STRENGTH[1]

    paths, hosts = {}, {}
    for (_, host, path, _), o in zip(rows, own):
        for table, key in ((paths, (host, path)), (hosts, host)):
            n, good = table.get(key, (0, 0.0))
            table[key] = n + 1, good + o
    whole = sum(own) / len(own)
    k = moments(list(hosts.values()), [whole] * len(hosts))
    prior_of = {h: (good + k * whole) / (n + k) for h, (n, good) in hosts.items()}
    k = moments(list(paths.values()), [prior_of[h] for h, _ in paths])
    expected = []
    for (doc_id, host, path, _), e, o in zip(rows, evidence, own):
        n, good = paths[host, path]
        prior = min(max((good - o + k * prior_of[host]) / (n - 1 + k), 1e-6), 1 - 1e-6)
        expected.append((str(doc_id), str(host), 1 / (1 + np.exp(-(e + np.log(prior / (1 - prior)))))))
    got = sorted((str(r.doc_id), str(r.host), r.posterior) for r in quality.judge(docs, labels).collect())
    for a, b in zip(got, sorted(expected)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-6)


def test_without_labels_all_evidence_is_zero(judged, spark):
    docs, labels = judged
    rows = quality.judge(docs, labels.filter("quality = 1")).collect()
    assert {r.evidence for r in rows} == {0.0}
    assert quality.judge(docs.limit(0), labels).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")
def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    half = quality.judge(docs, labels.filter("doc_id % 2 = 0")).toPandas().merge(labels.filter("doc_id % 2 = 1").toPandas(), on="doc_id")
    assert (half.kept == (half.quality == 1)).mean() > 0.97
    assert half[half.quality == 1].kept.mean() > 0.99


def test_blocks_of_broken_markup():
    page = "<!DOCTYPE html><html><head><title>t</title></head><body><p><b>one<br><p>two &amp; <i>three</i>\n x<script>var t='</p>';</script><ul><li>a<li>b</ul>tail < end"
    assert [b.text for b in html_blocks.blocks(page)] == ["one", "two & three x", "a", "b", "tail < end"]
    assert html_blocks.blocks("") == [] and html_blocks.blocks("<div") == [] and html_blocks.blocks("<!-- x") == []
    deep = "<div>" * 20000 + "x" + "</div>" * 20000
    assert [b.text for b in html_blocks.blocks(deep)] == ["x"]


def test_raw_elements_end_where_their_end_tag_stands():
    dotted = "<p>\u0130stanbul \u0130\u0130\u0130</p><script>var a = '\u0130<p>no</p>';</SCRIPT><p>bir</p><style>p{}</style><p>iki \u0130</p><svg><text>x</text></svg><p>son</p>"
    assert [b.text for b in html_blocks.blocks(dotted)] == ["\u0130stanbul \u0130\u0130\u0130", "bir", "iki \u0130", "son"]
    for tag in ("svg", "math", "noscript", "template", "iframe"):
        page = f"<p>one</p><{tag} a=b><p>two</p><{tag}><div>three</div>"
        assert [b.text for b in html_blocks.blocks(page)] == ["one", "two", "three"]
    assert [b.text for b in html_blocks.blocks("<p>one</p><script>x</scripts><p>no</p></script ><p>two")] == ["one", "two"]
    assert [b.text for b in html_blocks.blocks("<p>one</p><script><p>never closed")] == ["one"]


def test_held_out_pages_are_extracted():
    model = html_extract.default_model()
    # other pages, and other pages whose names and phrases the model has never seen
    unseen = {k: " ".join(w[::-1] + "x" for w in v.split()) for k, v in html_extract.KINDS.items()}
    for most, made in ((0.01, {}), (0.02, {"names": unseen, "phrases": {}})):
        wrong = total = 0
        for html, labels in html_extract.labelled_pages(200, seed=77, **made):
            got = model.decode(html_blocks.blocks(html))
            wrong += sum(a != b for a, b in zip(got, labels))
            total += len(labels)
        assert wrong / total < most


PROSE = "The council met on Tuesday to discuss the new plan for the harbour, and members spoke at length. A vote is expected soon."
MAIN = f"<h1>A title</h1><p>{PROSE}</p><p>{PROSE} And more.</p>"
SAYS = ("I think this is all wrong, and I said so before, you know.", "Well said! I will be there to see it with my own eyes.", "Nothing will ever change in this town, believe me.")


@pytest.mark.parametrize("page", [
    f"<div><a href=/>Home</a></div><div><a href=/n>News</a></div><div><a href=/s>Sport</a></div><div>{MAIN}</div><div>© 2024 Somebody</div><div><a href=/i>Imprint</a></div>",
    f"<div><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/s>Sport</a></li></ul></div><div>{MAIN}</div><div><p>All rights kept</p><p><a href=/i>Imprint</a></p></div>",
    f"<div class=hauptmenue><ul><li><a href=/>Start</a></li><li><a href=/n>Nachrichten</a></li><li><a href=/s>Sport</a></li></ul></div><div class=inhalt>{MAIN}</div><div class=fusszeile><p>Alle Rechte vorbehalten</p><p><a href=/i>Impressum</a></p></div>",
    f"<div id=ccm-root><p>We and our partners use small files to make this page better, and to measure how it is used.</p><button>OK</button><button>More</button></div><div>{MAIN}</div>",
    f"<div>{MAIN}</div><ol class=thread>" + "".join(f"<li><b>{n}</b><p>{t}</p></li>" for n, t in zip(("Joe", "Ann", "Zed"), SAYS)) + "</ol>",
])
def test_parts_without_telling_names_are_left_out(page):
    assert html_extract.main_text(f"<html><body>{page}</body></html>", html_extract.default_model()) == f"A title\n{PROSE}\n{PROSE} And more."


def test_a_slash_in_a_start_tag_closes_no_html_element():
    page = f"<p>{PROSE}<script src='a.js'/>var x = 1;</script><style/>p{{}}</style> tail</p><svg width='1'/><math/><div/><p>{PROSE}</p><a href=/x/>one</a> two"
    assert [b.text for b in html_blocks.blocks(page)] == [PROSE, "tail", PROSE, "one two"]


@pytest.mark.parametrize("page", [
    f"<body><p>{PROSE}</p></body>", PROSE, f"<html><body>{PROSE}</body></html>", f"<div><a href=/x>Here</a> {PROSE}</div>", "<body><p>Hello.</p></body>", f"<pre>{PROSE}</pre>",
])
def test_a_page_of_one_block_is_its_text(page):
    block, = html_blocks.blocks(page)
    assert html_extract.main_text(page, html_extract.default_model()) == block.text


def test_a_menu_alone_is_no_text():
    for page in ("<nav><a href=/>Home</a></nav>", "<footer>Imprint</footer>"):
        assert html_extract.main_text(page, html_extract.default_model()) == ""


def test_quotes_that_are_not_closed_lose_no_text():
    page = f"""<p title="a>hello there</p><p>{PROSE} <a href='x>link</a></p><p title="a>b" id='c"d'>last</p>"""
    assert [b.text for b in html_blocks.blocks(page)] == ["hello there", f"{PROSE} link", "last"]
    assert [b.text for b in html_blocks.blocks("<p " + "a=\"b\" '" * 20000 + "<p>end")][-1:] == ["end"]


def test_slopes_equal_differences_of_the_likelihood():
    r = np.random.default_rng(3)
    for n in (1, 2, 7):
        emitted, pairs, labels = r.normal(size=n), r.normal(size=(3, 2)), r.integers(0, 2, n)

        def path(y, emitted=emitted, pairs=pairs):
            return pairs[2][y[0]] + sum(e for e, k in zip(emitted, y) if k) + sum(pairs[a][b] for a, b in zip(y, y[1:]))

        every = [path([k >> i & 1 for i in range(n)]) for k in range(1 << n)]
        loss, by_block, by_pair = html_extract.likelihood(emitted, pairs, labels)
        assert loss == pytest.approx(np.logaddexp.reduce(every) - path(labels.tolist()))
        for i in range(n):
            step = np.eye(n)[i] * 1e-6
            assert by_block[i] == pytest.approx((html_extract.likelihood(emitted + step, pairs, labels)[0] - loss) / 1e-6, abs=1e-4)
        for i, j in np.ndindex(3, 2):
            step = np.zeros((3, 2))
            step[i, j] = 1e-6
            assert by_pair[i, j] == pytest.approx((html_extract.likelihood(emitted, pairs + step, labels)[0] - loss) / 1e-6, abs=1e-4)


def test_viterbi_is_the_best_path():
    model = html_extract.default_model()
    for html, _ in html_extract.labelled_pages(30, seed=5):
        page = html_blocks.blocks(html)[:9]
        if not page:
            continue
        e = model.scores(html_extract.block_features(page))

        def score(labels, e=e):
            s = model.pairs[2][labels[0]] + sum(x for x, y in zip(e, labels) if y)
            return s + sum(model.pairs[a][b] for a, b in zip(labels, labels[1:]))

        every = [[k >> i & 1 for i in range(len(page))] for k in range(1 << len(page))]
        assert score([int(x) for x in model.decode(page)]) == pytest.approx(max(map(score, every)))


def test_extraction_of_whole_pages(spark):
    page = ("<html><body><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies.</div><article><h1>A title</h1><p>First  paragraph, with words.</p>"
            "<div class='ad'>Buy now</div><p>Second &lt;one&gt; here.</p><section class=comments><p>Great article, thanks!</p></section></article><footer>&copy; x</footer></body></html>")  # fmt: skip
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, page)], "page_id int, html string")
    got = [r.t for r in df.select("page_id", html_extract.extract(df.html).alias("t")).orderBy("page_id").collect()]
    main = "A title\nFirst paragraph, with words.\nSecond <one> here."
    assert got == [main, "", "", main]
    assert df.limit(0).select(html_extract.extract(df.html)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")
def test_articles_of_the_given_pages():
    model = html_extract.default_model()
    for html in pd.read_parquet(glob.glob(f"{SMALL}/pages.parquet")[0]).html:
        inside = html[html.index("<article>") : html.index("</article>")]
        assert html_extract.main_text(html, model) == "\n".join(b.text for b in html_blocks.blocks(inside))


def test_urls(spark):
    urls = ["http://A.Example.ORG/es/x?porn", "https://www.example.org/en/12", "https://b.com/fr/", "http://spam-farm.net/x", "http://cheap.pills.net/", "http://cheap.net/cheap",
            "http://spammer.net/essex", None, "", "no scheme casino", "x://h#f", "HTTP://Host.net?q", "http://notexample.org/en/1"]
    rules = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"))
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "id int, url string, __host string, judged_ string")
    got = [r.judged for r in url_filter.filter_urls(df, "url", rules).orderBy("id").collect()]
    assert [(g.host, g.path, g.rule, g.verdict) for g in got] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("www.example.org", "/en/12", "example.org/en/1", "block"), ("b.com", "/fr/", "com/fr/", "allow"),
        ("spam-farm.net", "/x", None, "block"), ("cheap.pills.net", "/", None, "block"), ("cheap.net", "/cheap", None, "allow"), ("spammer.net", "/essex", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "block"), ("h", "", None, "allow"), ("host.net", "", None, "allow"),
        ("notexample.org", "/en/1", "org/", "allow"),
    ]
    # two weak terms are too little, three or a strong one beside a weak one are enough; of equal rules one decides alike
    weighed = spark.createDataFrame([(u, "x") for u in ("x://a/buy-free", "x://a/buy-free-win", "x://a/adult/win", "x://a/sex")], "url string, judged string")
    assert [r.judged.verdict for r in url_filter.filter_urls(weighed).collect()] == ["allow", "block", "block", "allow"]
    ties = [("block", "a", "/buy"), ("allow", "a", "/buy")]
    assert {url_filter.filter_urls(weighed.limit(1), "url", order).first().judged.verdict for order in (ties, ties[::-1])} == {"allow"}
    assert got[4].soft == ["cheap", "pills"] and got[3].strict == ["spam"]
    assert url_filter.filter_urls(df.limit(0)).count() == 0
