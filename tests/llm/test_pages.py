"""HTML extraction and WARC: pages with known text, exact round trips, split archives, and hard rows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscout.llm import html, warc
from linkscout.operators import storage

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def text_of(page):
    return "\n\n".join(t for t, _ in html.blocks(html.tree(page)))


@pytest.mark.parametrize("page,text", [
    ("<html><body><nav><a>Menu</a></nav><article><h1>A &amp; B</h1><p>one<br>two  <b>bold</b><p>next &copy &#x41;</article><footer>f</footer>",
     "A & B\n\none two bold\n\nnext © A"),
    ("<article><p>a</p><div class='ad-box'>buy</div><form><p>sign</p></form><aside>x</aside><script>if (a < b) '<p>'</script><style>p{}</style>"
     "<div id=comments><p>first!</p></div><section class='cookie-notice'>c</section><ul><li>i<li>j</ul></article><p>out", "a\n\ni\n\nj"),
    ("<main><p>x</main><p>y", "x"), ("plain &lt;text&gt;", "plain <text>"), ("", ""), ("<", "<"), ("<p>a</p></div></article>b", "a\n\nb"),
    ("<body><!-- n --><p>p &nbsp; q\n\t r</p><div hidden>h</div><div style='display: none'>s</div><template>t</template>", "p q r"),
    ("<title>t</title><table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ("<article><p>a<article><p>b</article><p>c</article>", "a\n\nb\n\nc"), ("<article class='ad'><p>body", "body"),
    # An article's own header keeps its headings.
    ("<header><h1>Site</h1></header><article><header><nav>n</nav><p>by me</p><h1>The <b>title</b></h1>x<h2>sub</h2></header><p>text</article>",
     "The title\n\nsub\n\ntext"),
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds", "so x=2 holds"),
    # Names inside the main part count as a whole.
    ("<article><div class='related-work'><p>a</div><section id='discussion'><p>b</section><div class='header-files menu-costs'>c</div>"
     "<div class='text ad-box'>d</div><div class='cookieNotice'>e</div><div id='comments-list-2'>f</div><div class='share'>g</div></article>",
     "a\n\nb\n\nc"),
    ("<div class='related-work'>a</div><div class='x'>b</div>", "b"),
])
def test_main_text(page, text):
    assert text_of(page) == text


def test_templates_go_and_copies_stay(spark):
    rows = []
    for i in range(12):
        rows.append((i, "http://a.org/x", f"<article><h1>t{i}</h1><p>text {i} of this very article</p><div>Read more on our site</div><p>same</p></article>"))
        rows.append((100 + i, "http://b.org/x", "<article><p>copied article</p><div><p>copied part</p></div></article>"))
        rows.append((200 + i, "http://c.org/x", f"<div><p>page {i}</p></div><div><p>links</p><p>everywhere</p></div>"))
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[3] == "t3\n\ntext 3 of this very article\n\nsame" and out[103] == "copied article\n\ncopied part" and out[203] == "page 3"


def test_sitewide_notice_in_a_plain_paragraph(spark):
    notice, rows = "<p>We use small files to serve you better</p>", []
    for i in range(30):
        own = "".join(f"<p>paragraph {k} of article {i} has its own words</p>" for k in range(4))
        rows.append((i, "http://a.org/x", f"<article><h2>Summary of all this here</h2>{own}{notice}</article>"))
        # Half of the articles only, and pages that are near copies of each other.
        rows.append((100 + i, "http://b.org/x", f"<article>{own}{notice if i % 2 else ''}</article>"))
        rows.append((200 + i, "http://c.org/x", f"<article>{''.join(f'<p>long shared paragraph {k} of a text</p>' for k in range(9))}<p>version {i}</p></article>"))
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all("small files" not in out[i] and out[i].startswith("Summary of all this") and out[i].count("paragraph") == 4 for i in range(30))
    assert all(("small files" in out[100 + i]) == bool(i % 2) and out[200 + i].count("shared") == 9 for i in range(30))


def made_page(draw, host):
    """A page as nested (element, class, children or text), from the host's own stock of parts."""
    def fresh(n):
        return " ".join(draw.choice("abcdefgh") * draw.randrange(1, 9) for _ in range(n))

    body = [("h1", fresh(3))]
    for _ in range(draw.randrange(3, 7)):
        body.append((draw.choice(["p", "blockquote"]), fresh(draw.randrange(2, 12))))
    for part, share in host:
        if draw.random() < share:
            body.insert(draw.randrange(len(body) + 1), part)
    return ("article", body)


def written(node):
    tag, inner = node
    return f"<{tag}>{inner if isinstance(inner, str) else ''.join(map(written, inner))}</{tag}>"


def texts_of(node):
    return [node[1]] if isinstance(node[1], str) else [t for c in node[1] for t in texts_of(c)]


def brute_templates(pages):
    """``pages`` of one host: counts every subtree of every different article, then takes out what recurs."""
    articles = {tuple(texts_of(p)) for p in pages}
    counts = {}

    def subtrees(node, top=True):
        if not top and node[0] not in html.HEADINGS and 0 < len(texts_of(node)):
            yield node[0], tuple(texts_of(node))
        if not isinstance(node[1], str):
            for c in node[1]:
                yield from subtrees(c, False)

    for page in {tuple(texts_of(p)): p for p in pages}.values():
        for key in set(subtrees(page)):
            counts[key] = counts.get(key, 0) + 1
    gone = set()
    for (tag, inner), n in counts.items():
        prose = tag in html.PROSE
        if n >= 5 and n >= (0.75 if prose else 0.5) * len(articles) and not (prose and sum(len(t.split()) for t in inner) < html.PROSE_WORDS):
            gone.add((tag, inner))

    def left(node, prose_too):
        if (node[0], tuple(texts_of(node))) in gone and (prose_too or node[0] not in html.PROSE):
            return []
        return [node[1]] if isinstance(node[1], str) else [t for c in node[1] for t in left(c, prose_too)]

    out = []
    for page in pages:
        few, most = left(page, True), left(page, False)
        out.append("\n\n".join(few if 2 * sum(map(len, few)) > sum(map(len, most)) else most))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_templates_against_brute_force(spark, seed):
    draw, rows, want = random.Random(seed), [], {}
    for h in range(8):
        stock = [((draw.choice(["div", "section"]), [("p", f"box {h} {k} links"), ("p", f"and more {k}")]), draw.choice([0.2, 0.4, 0.6, 1])) for k in range(2)]
        stock += [(("p", f"a sentence of host {h} number {k}"), draw.choice([0.3, 0.6, 0.8, 1])) for k in range(3)]
        stock.append((("p", f"short {h}"), 1))
        pages = [made_page(draw, stock) for _ in range(draw.choice([3, 6, 25]))]
        pages += pages[:2]
        for page, text in zip(pages, brute_templates(pages)):
            want[len(rows)] = text
            rows.append((len(rows), f"http://h{h}.org/x", written(page)))
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    assert out == want


def test_extraction_hard_rows(spark):
    long = "<article>" + "".join(f"<p>w{i}</p>" for i in range(5000)) + "</article>"
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, long), (3, "http://a/b", "<article>x</article>"), (3, "http://a/b", "<article>x</article>")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("host", "row", "article", "blocks", "text", "template")})
    out = sorted((str(r.page_id), r.text) for r in html.extract(pages).collect())
    assert out == sorted([("None", ""), ("1", ""), ("1", ""), ("2", "\n\n".join(f"w{i}" for i in range(5000))), ("3", "x"), ("3", "x")])
    assert html.extract(pages.limit(0)).count() == 0


FALSE = "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: {}\r\n\r\n"
HARD = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, "http://a/3", "x" + FALSE.format(5) + "abcde\r\n\r\n" + FALSE.format(999999)),
    (4, None, None), (5, "http://a/5", ""), (None, "http://a/\r\nX-Page-Id: 9", "same"), (7, "http://é/7", "\r\n\r\n\r\n\r\né𝄞"),
    (8, "u", "line\n" * 3000), (8, "u", "line\n" * 3000), (9, "u", "line\n" * 3000), (10, "u", "WARC/1.0\r\nContent-Length: 3\r\n\r\n"),
]


def expected(rows):
    least = {}
    for key, _, page in rows:
        if key is not None:
            least[page or ""] = min(key, least.get(page or "", key))
    out = []
    for key, _, page in rows:
        raw, first = (page or "").encode(), least.get(page or "")
        again = key is not None and key > first
        out.append((str(key), len(raw), warc.digest(raw), "revisit" if again else "response", str(first if again else None)))
    return sorted(out)


def found(frame):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in frame.collect())


@pytest.mark.parametrize("split", [None, "2k"])
def test_round_trip(spark, split):
    rows = HARD + [(100 + i, f"http://b/{i}", f"page {i} " + "z" * (i * 7 % 400) + FALSE.format(i)) for i in range(120)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3).withColumns({c: F.lit("x") for c in ("payload", "sha", "value", "file")})
    folder = storage.new_folder(spark, "warc")
    warc.write(pages, folder, compression="none" if split else "gzip")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        assert found(warc.resolved(warc.read(spark, folder))) == expected(rows)
        records = storage.materialise(warc.read(spark, folder, payload=True))
        assert found(warc.resolved(records)) == expected(rows)
        payloads = {r.page_id: bytes(r.payload) for r in records.where("record_type = 'response' and page_id is not null").collect()}
        assert all(payloads[k] == (p or "").encode() for k, _, p in rows if k in payloads) and len(payloads) > 120
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_archive(spark):
    folder = storage.new_folder(spark, "warc")
    warc.write(spark.createDataFrame([], PAGES), folder)
    assert warc.resolved(warc.read(spark, folder)).count() == 0
