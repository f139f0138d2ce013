"""Operators on pages and embeddings against brute force, and their defined results on odd rows."""

import math
import hashlib
import io
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tallyline.llm import extract, urlfilter, vptree, warc
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string, host string, text string, digest string, kept long, cut array<string>"
BIG = "<p>" + "equal payload " * 100 + "</p>"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (None, None, None), (1, "http://Site.example.net/en/x?q#f", BIG), (2, "no scheme", BIG), (2, "no scheme", BIG), (3, "https://a.org", ""),
        (None, "ftp://x/\r\nInjected: header", BIG), (4, "http://example.com/de/", "<p>" + "long " * 200_000), (5, "http://sub.example.com/de", "x&lt;y"),
    ]
    return spark.createDataFrame([(*r, "h", "t", "d", 9, ["c"]) for r in rows], PAGES)


# ---- extraction ------------------------------------------------------------------


def test_text_of_an_article_without_its_surroundings():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>a<li>b</ul></nav>
    <div class="content"><h1>Big &amp; bold</h1><p>One <b>two<br>three<p>Four&nbsp;five <i>six</i>.<ul><li>x<li>y</ul><div class="ad">buy</div>
    tail<aside>q</aside><table><tr><td>1<td>2<tr><td>3</table></div><form>f<input></form><div id="comments"><p>nice</p></div>
    <footer>&copy;<script>x="</p>"</script></footer>"""
    assert extract.main_text(page) == "Big & bold\nOne two three\nFour five six.\nx\ny\ntail\n1\n2\n3"


def test_only_the_article_where_one_is_marked():
    assert extract.main_text("<div>promo</div><article><p>a<p>b<aside>c</aside></article><div>more</div>") == "a\nb"


@pytest.mark.parametrize("name", ["class='content has-sidebar'", "id='page-header-fixed'", "class=post-share-enabled", "class='widget-area-none no-comments'", "class='content widget'"])
def test_names_count_as_whole_words_and_never_lose_a_marked_article(name):
    assert extract.main_text(f"<div {name}><article><h1>a</h1><p>b</article><div class='x ad'>c</div></div>") == "a\nb"
    if name != "class='content widget'":
        assert extract.main_text(f"<div {name}><p>text</div>") == "text"


def test_articles_within_furniture_or_smaller_than_the_text_are_not_the_page():
    long = "a long paragraph of the page itself"
    assert extract.main_text(f"<form><article><p>{long}</article></form>") == long
    assert extract.main_text(f"<main><p>{long}</main><aside><article>teaser</article></aside>") == long
    assert extract.main_text(f"<p>{long}</p><article>teaser</article><p>{long}") == f"{long}\nteaser\n{long}"


@pytest.mark.parametrize("name", ["cookie-banner", "site-header", "main-nav", "comment-list", "advert-slot", "sidebar-left", "newsletter_signup", "post-related", "commentList"])
def test_compound_names_tell_a_purpose(name):
    part = f"<div class='{name}'><p>Reader 120 says hi</p></div>"
    assert extract.main_text(f"{part}<div><p>The story itself, told here.</p></div>{part}") == "The story itself, told here."
    assert extract.main_text(f"<article><p>The story itself, told here.</p>{part}</article>") == "The story itself, told here."


def test_no_text_is_lost_where_a_name_or_an_article_misleads():
    assert extract.main_text("<article><p>teaser…</p></article><div>long main story in a plain div</div>") == "teaser…\nlong main story in a plain div"
    assert extract.main_text("<div class='form'><p>Only text</p></div>") == "Only text"
    assert extract.main_text("<div class='related share'><article><p>The story is told at length here.</p></article></div><div>x</div>") == "The story is told at length here."
    assert extract.main_text("<div class='header-wide'><p>All of the page's text</p></div><form>f</form>") == "All of the page's text"


def brute_importance(pages):
    """The site tree of one host by counting: per branch the contents and layouts of the pages that have it."""
    seen = {}
    for page in pages:
        branches = {}
        for block in extract.blocks_of(page):
            for branch in block.branches:
                if extract.can_be_cut(branch) and not block.furniture:
                    branches.setdefault(branch, []).append(block)
        for branch, blocks in branches.items():
            seen.setdefault(branch, []).append(("\n".join(b.text for b in blocks), "\n".join(b.branches[-1] for b in blocks)))
    out = {}
    for branch, told in seen.items():
        n = len(told)
        entropy = [-sum(told_of.count(x) / n * math.log(told_of.count(x) / n) for x in set(told_of)) for told_of in ([a for a, _ in told], [b for _, b in told])]
        out[branch] = max(entropy) / math.log(n) if n > 1 else 1.0
    return out


def test_site_tree_equals_brute_force_and_decides(spark):
    """Hosts of 1 to 60 pages of three templates: what is constant goes, more surely the more pages tell it; results follow the counted tree."""
    def page(k, n):
        promo = "Subscribe today and save" if k % 5 else f"Deal {k}"
        return (
            f"<div class=top1>Welcome to the site</div><div class=mid>{promo}</div><div class=story><p>Story {k} of host {n}</p><div class=by>By A{k % 3}</div></div>"
            if k % 3 else f"<div class=top1>Welcome to the site</div><table class=grid><tr><td>Table {k} of host {n}</table><div class=foot9>Made by us</div>"
        )

    rows = [(100 * n + k, f"http://h{n}/{k}", page(k, n)) for n in (1, 3, 12, 25, 60) for k in range(n)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    tree = {(r["host"], r["branch"]): r["importance"] for r in extract.site_branches(df).collect()}
    got = {r["page_id"]: r["text"] for r in extract.extract_main_text(df).collect()}
    cut_somewhere = 0
    for n in (1, 3, 12, 25, 60):
        pages = {100 * n + k: page(k, n) for k in range(n)}
        want = brute_importance(pages.values())
        assert {b: v for (h, b), v in tree.items() if h == f"h{n}"} == pytest.approx(want)
        having = {b: sum(any(b in x.branches for x in extract.blocks_of(p)) for p in pages.values()) for b in want}
        cut = frozenset(b for b, v in want.items() if (v * having[b] + extract.DOUBT) / (having[b] + extract.DOUBT) < extract.THRESHOLD)
        cut_somewhere += bool(cut)
        assert all(got[i] == extract.main_text(p, cut) for i, p in pages.items())
    assert cut_somewhere == 2 and got[100] != "" and "Welcome" in got[300] and "Welcome" not in got[6001] and "Story 1 of host 60" in got[6001]


@pytest.mark.parametrize("page", ["", "<", "<<p>>", "<p", "</p></div>", "&#x;&bogus;", "<!-- open", "<script>open", "<div>" * 3000 + "deep", '<a href="x>y'])
def test_broken_pages_do_not_fail(page):
    assert isinstance(extract.main_text(page), str)


def test_furniture_shared_by_a_site_is_cut_and_rotating_text_stays(spark):
    rows = [(i, f"http://h/{i}", f"<div class=x1>Same words</div><div class=x2>text {i}</div><p>Same words</p>") for i in range(30)]
    got = extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {f"text {i}\nSame words" for i in range(30)}
    few = extract.extract_main_text(spark.createDataFrame(rows[:5], "page_id long, url string, html string")).collect()
    assert few[0]["text"].startswith("Same words\n")


def test_extraction_of_odd_pages(odd_pages):
    got = extract.extract_main_text(odd_pages).collect()
    assert len(got) == 8 and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[3] == "" and text[5] == "x<y" and len(text[4]) == 999_999
    assert extract.extract_main_text(odd_pages.limit(0)).count() == 0


# ---- URLs ------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        (None, "", "", None), ("none", "", "", None), ("http://A.Example.NET/en/1?x", "a.example.net", "/en/1", "example.net/en/"),
        ("http://example.net/de/", "example.net", "/de/", "net/"), ("http://example.net", "example.net", "", None),
        ("http://notexample.com/de/", "notexample.com", "/de/", None), ("https://x.org/fr/a#b", "x.org", "/fr/a", "org/fr/"),
        ("http://É.com#frag", "É.com", "", None), ("a://b://c/d", "b:", "//c/d", None),
    ],
)
def test_hosts_paths_and_rules(spark, url, host, path, rule):
    row = urlfilter.filter_urls(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
    if rule:
        assert row["verdict"] == {r.text: r.verdict for r in urlfilter.RULES}[rule]


def test_model_tells_spam_from_plain_hosts(spark):
    rows = [(1, "http://www.casino-night.com/en/3"), (2, "http://cheap-pills.org/a"), (3, "http://ththing.example.com/en/4"), (4, "http://city-library.org/x")]
    got = urlfilter.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert [r["verdict"] for r in sorted(got)] == ["block", "block", "allow", "allow"]


def test_urls_of_odd_pages(spark, odd_pages):
    got = urlfilter.filter_urls(odd_pages)
    assert got.count() == 8 and urlfilter.filter_urls(odd_pages.limit(0)).count() == 0
    none = spark.createDataFrame([], "url string, blocked int")
    assert {r["verdict"] for r in urlfilter.filter_urls(odd_pages, rules=(), labelled=none).collect()} == {"allow"}


# ---- archives --------------------------------------------------------------------


def test_round_trip_keeps_every_page(odd_pages, tmp_path):
    manifest = warc.write_pages(odd_pages, f"file://{tmp_path}/w", archive_bytes=300_000)
    got = warc.read_pages(manifest).collect()
    assert len(list((tmp_path / "w").iterdir())) == manifest.count() > 1
    want = sorted(((r["page_id"], r["html"] or "") for r in odd_pages.collect()), key=str)
    told = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str)
    expected = []
    for page_id, html in want:
        data = html.encode()
        revisit = html == BIG and page_id != 2
        expected.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert told == sorted(expected, key=str)
    assert {r["payload"].decode() for r in got if r["payload"] is not None} == {h for _, h in want}
    assert warc.round_trip(odd_pages.limit(0)).count() == 0


def archive(records):
    out = io.BytesIO()
    warc.write_archive(out, records)
    return out.getvalue()


def test_dictionary_leads_and_each_record_is_one_frame():
    draw = random.Random(1)
    records = [warc.encode(i, f"http://x/{i}", (f"<p>page {i} " + "common words of all pages " * draw.randint(3, 9)).encode(), None) for i in range(300)]
    data = archive(records)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and data.count(warc.FRAME) >= 300
    assert [f["warc-record-id"] for f, _, _ in warc.read_archive(pa.BufferReader(data))] == [f"<urn:page:{i}>" for i in range(300)]


@pytest.mark.parametrize(
    ("old", "new"),
    [(b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: ", b"Content-Length: 1"), (b"page", b"pagE"), (b"WARC-Date", b"WARC-Dote"), (b"\r\n\r\n", b"\r\n")],
)
def test_damaged_records_are_refused(old, new):
    record = warc.encode(1, "http://x", b"some page text", None)
    at = record.rfind(old) if old == b"page" else record.find(old)
    bad = record[:at] + new + record[at + len(old) :]
    with pytest.raises(ValueError):
        list(warc.read_archive(pa.BufferReader(zstandard.compress(bad))))
    with pytest.raises(ValueError):
        list(warc.read_archive(pa.BufferReader(zstandard.compress(record)[:-3])))


def test_flipped_bytes_are_refused_with_the_records_number():
    data = archive([warc.encode(i, f"http://x/{i}", b"some text " * 30 + str(i).encode(), None) for i in range(3)])
    second = data.index(warc.FRAME, data.index(warc.FRAME) + 1)
    for at in (second, second + 5, second + 20, len(data) - 5):
        flipped = bytearray(data)
        flipped[at] ^= 0x55
        with pytest.raises(ValueError, match="record [123]"):
            list(warc.read_archive(pa.BufferReader(bytes(flipped))))


# ---- nearest neighbours ----------------------------------------------------------


def brute_nearest(rows, k=10):
    out = set()
    for q, v in rows:
        if q % 100 == 0:
            away = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in rows if i != q and len(x) == len(v))
            out |= {(q, n + 1, i, round(d, 12)) for n, (d, i) in enumerate(away[:k])}
    return out


@pytest.fixture(scope="module")
def cloud():
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + draw.normal(size=8) * 0.3).tolist()) for i in range(900)]
    return [*rows, *[(i, rows[100][1]) for i in range(900, 1000)]]


@pytest.mark.parametrize("shard_rows", [20_000, 150])
def test_exact_search_equals_brute_force(spark, cloud, shard_rows):
    got = vptree.nearest(spark.createDataFrame(cloud, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0, factor=1.0, shard_rows=shard_rows)
    assert {(r[0], r[1], r[2], round(r[3], 12)) for r in got.collect()} == brute_nearest(cloud)


def test_recall_of_the_default_factor(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table.collect()]
    want = {(q, i) for q, _, i, _ in brute_nearest(rows)}
    got = {(r["query_id"], r["vec_id"]) for r in vptree.nearest(table, F.col("vec_id") % 100 == 0).collect()}
    assert len(got & want) >= 0.95 * len(want)


def test_recall_over_several_shards(spark):
    """Clustered vectors of 24 dimensions over six shards, 200 queries; and ids that are all asked go in small blocks."""
    draw = np.random.default_rng(3)
    middle = draw.normal(size=(40, 24)) * 3
    vectors = [(100 * i, [float(x) for x in middle[i % 40] + draw.normal(size=24)]) for i in range(3000)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = vptree.nearest(table, F.col("vec_id") % 1500 == 0, shard_rows=500).collect()
    x = np.array([v for _, v in vectors])
    want = set()
    for q in range(0, 3000, 15):
        away = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        away[q] = np.inf
        want |= {(100 * q, 100 * int(k)) for k in np.lexsort((np.arange(3000), away))[:10]}
    assert len(want) == 2000 and len({(r["query_id"], r["vec_id"]) for r in got} & want) >= 0.95 * len(want)
    exact = vptree.nearest(table, F.col("vec_id") % 1500 == 0, factor=1.0, shard_rows=500).collect()
    assert {(r["query_id"], r["vec_id"]) for r in exact} == want


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [1.0, None]), (400, [nan, 1.0]), (500, [inf, 1.0]), (600, []), (None, [1.0, 1.0]),
        (7, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [0.0, 1.0, 2.0]), (9, [1.0, 0.0]),
    ]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, shard string, size int")
    got = vptree.nearest(table, F.col("vec_id") % 100 == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 9, 0.0), (0, 2, 7, 1.0)]
    assert vptree.nearest(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
