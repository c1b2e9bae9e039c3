import gzip

import pytest

from loomtext.config import CrawlConfig
from loomtext.operators.extract import ExtractSpec
from loomtext.sources import raw as R
from loomtext.sources import sites as Si
from loomtext.sources.fetch import FetchError, Fetcher

LONG = "一段很长的正文，足够超过最短长度。" * 30


def fetcher(pages, **config):
    asked, slept = [], []
    now = [0.0]

    def opener(url, headers, timeout):
        asked.append(url)
        got = pages.get(url, (404, b""))
        if callable(got):
            got = got()
        if isinstance(got, Exception):
            raise got
        return got

    def sleep(s):
        slept.append(s)
        now[0] += s

    f = Fetcher(CrawlConfig(delay=1.0, **config), opener=opener, sleep=sleep, clock=lambda: now[0])
    return f, asked, slept


def test_pause_with_jitter():
    f, _, slept = fetcher({"http://h/a": (200, b"x")}, respect_robots=False)
    for _ in range(3):
        assert f.get("http://h/a") == b"x"
    assert len(slept) == 2 and all(0.9 <= s <= 1.2 for s in slept)


def test_retries():
    answers = iter([(500, b""), OSError("reset"), (200, b"ok")])
    f, asked, _ = fetcher({"http://h/a": lambda: next(answers)}, respect_robots=False)
    assert f.get("http://h/a") == b"ok" and len(asked) == 3
    f, asked, _ = fetcher({"http://h/a": (503, b"")}, respect_robots=False)
    with pytest.raises(FetchError):
        f.get("http://h/a")
    assert len(asked) == 3
    f, asked, _ = fetcher({}, respect_robots=False)
    with pytest.raises(FetchError):
        f.get("http://h/none")
    assert len(asked) == 1  # refused once is refused


def test_robots():
    f, _, _ = fetcher({"http://h/robots.txt": (200, b"User-agent: *\nDisallow: /no/"), "http://h/no/a": (200, b"x"), "http://h/a": (200, b"y")})
    assert f.get("http://h/a") == b"y"
    with pytest.raises(FetchError):
        f.get("http://h/no/a")
    assert fetcher({"http://h/robots.txt": OSError()})[0].allowed("http://h/no/a")


def page(title, body):
    return 200, f"<h1>{title}</h1><div id=content>{body}</div>".encode()


def test_listed_site():
    base = "https://www.who.int/zh/news-room/fact-sheets"
    links = "".join(f'<a href="/zh/news-room/fact-sheets/detail/s{i}">' for i in (1, 2, 1, 3, 4))
    pages = {base: (200, links.encode())} | {f"{base}/detail/s{i}": page(f"T{i}", LONG if i != 3 else "短") for i in (1, 2, 3, 4)}
    f, _, _ = fetcher(pages, respect_robots=False)
    got = list(Si.crawl(Si.SITES["who_zh"], CrawlConfig(max_pages=15), fetcher=f))
    assert [d["title"] for d in got] == ["T1", "T2", "T4"] and got[0]["doc_metadata"]["fact_sheet_slug"] == "s1" and got[0]["raw"] == LONG
    assert [d["title"] for d in Si.crawl(Si.SITES["who_zh"], CrawlConfig(max_pages=15), 2, f)] == ["T1"]  # s1 and s3, s3 is short
    assert len(list(Si.crawl(Si.SITES["who_zh"], CrawlConfig(max_pages=0), None, f))) == 3


def test_fallback_list():
    url = "https://www.who.int/zh/news-room/fact-sheets/detail/asthma"
    f, _, _ = fetcher({url: page("哮喘", LONG)}, respect_robots=False)
    assert [d["source_url"] for d in Si.crawl(Si.SITES["who_zh"], CrawlConfig(max_pages=0), fetcher=f)] == [url]


def test_packed_sitemap():
    s = Si.SITES["msd_cn"]
    body = gzip.compress("﻿<loc>https://www.msdmanuals.cn/professional/a/b/topic</loc><loc>https://www.msdmanuals.cn/home/x</loc>".encode())
    url = "https://www.msdmanuals.cn/professional/a/b/topic"
    f, _, _ = fetcher({s.index[0]: (200, body), url: (200, f"<h1>题</h1><main><nav>n</nav>{LONG}</main>".encode())}, respect_robots=False)
    (d,) = Si.crawl(s, CrawlConfig(max_pages=0), fetcher=f)
    assert d["doc_metadata"] == {"section": "a", "subsection": "b", "topic_slug": "topic", "publisher": "默沙东诊疗手册"}


def test_parts_and_noise_boxes():
    s = Si.SITES["jk39"]
    main = lambda t: (200, f'<h1>病</h1><div class="list_left">{t}<div class="disease_box"><b>疾病用药</b>广告</div></div>'.encode())
    pages = {s.index[0]: (200, b'<a href="/bing/"><a href="/bw/">'), "https://jbk.39.net/bing/": main(LONG), "https://jbk.39.net/bing/blby/": main("因" * 121), "https://jbk.39.net/bing/zztz/": main("短")}
    f, _, _ = fetcher(pages, respect_robots=False)
    (d,) = Si.crawl(s, CrawlConfig(max_pages=0), fetcher=f)
    assert d["raw"] == LONG + "\n\n" + "因" * 121 and d["doc_metadata"]["sub_pages"] == ["https://jbk.39.net/bing/blby/"]


def test_gbk_and_second_try():
    s = Si.SITES["xywy"]
    url = "https://jib.xywy.com/il_sii_7.htm"
    answers = iter([(200, b"<p>empty</p>"), (200, f"<title>百日咳,症状</title><div class=jib-rec>{LONG}</div>".encode("gbk"))])
    f, _, _ = fetcher({s.index[0]: (200, b"/il_sii_7.htm /il_sii_7.htm"), url: lambda: next(answers)}, respect_robots=False)
    (d,) = Si.crawl(s, CrawlConfig(max_pages=0), fetcher=f)
    assert d["title"] == "百日咳" and d["raw"] == LONG and d["doc_metadata"]["disease_id"] == "7"


def test_hub_titles_are_left_out():
    s = Si.SITES["a_hospital"]
    pages = {s.index[0]: (200, b'<a href="/w/a"><a href="/w/b"><a href="/w/x:y"><a href="/w/b?action=1">'), "https://www.a-hospital.com/w/a": page("疾病", LONG), "https://www.a-hospital.com/w/b": page("肺炎", LONG)}
    f, _, _ = fetcher(pages, respect_robots=False)
    assert [d["title"] for d in Si.crawl(s, CrawlConfig(max_pages=0), fetcher=f)] == ["肺炎"]


def test_registry():
    with pytest.raises(KeyError):
        Si.get_sites(["nothing"])
    assert [s.key for s in Si.get_sites()][:5] == ["who_zh", "msd_cn", "a_hospital", "jk39", "xywy"]
    own = Si.Site("own", "Own", "http://h", ("http://h/i",), "/(x)", lambda x: f"http://h/{x}", ExtractSpec(main=("main",)))
    Si.register_site(own)
    assert Si.get_sites(["own"]) == [own]
    del Si.SITES["own"]


def test_data_source_has_a_partition_a_site():
    reader = R.SitesDataSource({"sites": "who_zh,xywy", "delay": "2"}).reader(None)
    assert [p.key for p in reader.partitions()] == ["who_zh", "xywy"] and reader.config.delay == 2.0


def test_data_source_reads(spark):
    # offline: every fetch fails, so the sources are empty, with the right columns
    spark.dataSource.register(R.SitesDataSource)
    df = spark.read.format("loomtext_sites").option("sites", "jk39").option("delay", "0").option("timeout", "1").option("max_retries", "0").option("max_pages", "1").load()
    assert df.columns[0] == "source" and df.count() == 0


def test_tables_as_raw_documents(spark, tmp_path):
    pages = spark.createDataFrame([("https://h.example/a", "<h1 class=x>题</h1><p>y"), ("https://h.example/b", "no")], "url string, html string")
    assert [(r["source"], r["title"]) for r in R.from_pages(pages).collect()] == [("h.example", "题"), ("h.example", None)]
    docs = spark.createDataFrame([(1, None, "s")], "doc_id long, text string, source string")
    assert R.from_texts(docs).first()["source_url"] == "s/1"
    (tmp_path / "s.xml").write_bytes(gzip.compress(b"<loc>http://h/p/1/2</loc><loc>http://h/q</loc>"))
    body = R.from_files(spark, str(tmp_path))
    assert body.select(R.sitemap_urls(body["body"], "/p/", 4)).first()[0] == ["http://h/p/1/2"]
