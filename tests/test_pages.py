import json

from pyspark.sql import functions as F

from loomtext.operators import dom
from loomtext.operators import extract as X

PROSE = "这是一段足够长的正文，用来让段落超过最短长度的要求。" * 2


def test_main_with_nested_article():
    page = f"<body><nav><p>{'菜单' * 30}</p></nav><main><p>{'外层' * 30}</p><article><p>{PROSE}</p></article></main></body>"
    assert X.read_page(page) == PROSE


def test_short_main_is_skipped():
    assert X.read_page(f"<body><article>短</article><div>{PROSE}</div></body>") == PROSE


def test_nested_blocks_repeat_their_text():
    assert X.read_page(f"<div><p>{PROSE}</p></div>") == f"{PROSE}\n{PROSE}"


def test_short_headings_are_lost_and_paragraphs_are_the_last_resort():
    assert X.read_page(f"<body><h2>短标题</h2><p>{PROSE}</p></body>") == PROSE
    assert X.read_page("<body><p>短</p><p>段</p></body>") == "短\n段"


def test_scripts_and_unclosed_elements():
    page = f'<body><script>var a = "</p>";</script><p>{PROSE}<b>粗<p>{PROSE}</body>'
    assert "var a" not in X.read_page(page) and X.read_page(page).count(PROSE) == 2


def test_nothing_raises():
    for bad in (None, "", "<", "<<p>", "</div>", "<p", "&#xZZ;", "<!-- open", "<a href='x", "\x00"):
        X.read_page(bad)
        X.extract_page(bad, "", X.ExtractSpec(main=("main",)))


def test_implied_ends():
    root = dom.parse("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table><p>x<div>y</div>")
    assert [e.text() for e in root.select("li")] == ["a", "b"]
    assert [e.text() for e in root.select("tr")] == ["1 2", "3"]
    assert root.first("p").text() == "x"


def test_selectors():
    root = dom.parse('<div id="a" class="x y"><p role=main>1</p></div>')
    assert root.first("#a").matches("div.x.y") and root.first("[role=main]").name == "p" and root.first("p[role='main']") and not root.first(".z", "h1")


SPEC = X.ExtractSpec(main=("#body", ".alt"), drop=(".ad",), noise_box=".box", noise_heads=frozenset({"推荐"}), trim=(r"^[^\n]*©[^\n]*\n?",), min_chars=10, metadata=lambda u, t: {"slug": u.rsplit("/", 1)[-1], "t": t})


def test_extract_page():
    page = "<h1>题 目</h1><div class=alt>no</div><div id=body>© 站\n<p>第一段正文</p><div class=ad>广告</div><div class=box><b>推荐</b><i>x</i></div><div class=box><b>正经</b></div><p>末行 © 留下</p></div>"
    title, body, meta = X.extract_page(page, "http://h/s", SPEC)
    assert title == "题 目" and body == "第一段正文\n正经\n末行 © 留下" and meta == {"slug": "s", "t": "题 目"}
    assert X.extract_page("<h1>t</h1>", "u", SPEC)[1] == ""


def test_extract_rows(spark):
    rows = [("s", "http://h/1", f"<div id=body>{PROSE}</div>", "other"), ("s", "http://h/2", "<div id=body>短</div>", None), ("t", "http://h/3", PROSE, None), ("s", None, None, None)]
    df = spark.createDataFrame(rows, "source string, source_url string, html string, title string")
    got = X.extract(df, {"s": SPEC}).collect()
    assert [(r["source_url"], r["raw"], r["title"]) for r in got] == [("http://h/1", PROSE, None)]
    assert json.loads(got[0]["doc_metadata"]) == {"slug": "1", "t": None}
    assert X.extract(df.where("false"), {"s": SPEC}).count() == 0


def test_clean_raw_by_kind(spark):
    df = spark.createDataFrame([(f"<p>{PROSE}</p>", "html"), ("a\na\nb", "text"), (None, None)], "raw string, kind string")
    assert [r[0] for r in df.select(X.clean_raw(F.col("raw"), F.col("kind"))).collect()] == [PROSE, "a\nb", ""]


def test_merge_pages(spark):
    rows = [("s", "k", 0, "u0", "主"), ("s", "k", 2, "u2", "二" * 121), ("s", "k", 1, "u1", "一" * 120), ("s", "k", 3, "u3", "三" * 200)]
    df = spark.createDataFrame(rows, "source string, doc_key string, part int, source_url string, text string")
    r = X.merge_pages(df).first()
    assert r["raw"] == "主\n\n" + "二" * 121 + "\n\n" + "三" * 200 and r["sub_pages"] == ["u2", "u3"]
