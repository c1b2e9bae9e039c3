import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.llm import encode as E
from loomtext.llm import mainbody as M
from loomtext.llm import mojibake as J
from loomtext.llm import packing as P
from loomtext.llm import pieces as S
from loomtext.llm import residue as R
from loomtext.llm import sitelines as W

# ---------------------------------------------------------------- main body

LONG = "手术切除病灶后，补液量控制在九十毫升，目前证据仍然有限。"
PAGE = f"""<!DOCTYPE html>
<html><head><title>t</title></head><body>
<script>
var x = "<p>no</p>";
</script>
<!-- a
b -->
<div class="nav-ab12"><span>首页</span>
<span>登录</span>
</div>
<div id="content">
<h1>题目</h1>
<p>{LONG}</p>
<div class="rel">
<div>相关阅读</div>
<div>另一篇的题目</div>
</div>
<ul>
<li>甲状腺</li>
</ul>
<p>{LONG}
{LONG}</p>
</div>
<div class="foot"><a href="/x">关于我们</a>
<a href="/y">© 2020 某站</a></div>
</body></html>"""


def weights(pages):
    a, b = collections.Counter(), collections.Counter()
    for p in pages:
        x, y = M.labelled(p)
        a += x
        b += y
    return M.TagWeights(a, b)


def test_shown_lines():
    shown = {n: t for n, t, _ in M.shown_lines(PAGE)}
    assert set(shown) == {8, 9, 12, 13, 15, 16, 19, 21, 22, 24, 25}
    assert shown[12] == "题目" and shown[22].startswith("手术")


def test_page_lines_outside():
    assert M.outside_lines(M.shown_lines(PAGE), weights([PAGE] * 3), "题目") == [8, 9, 15, 16, 24, 25]


def test_text_lines_outside():
    text = "\n".join(["首页 | 登录 | 注册", "手机版 > 心理 > 某病", "题目", "阅读 8 次 · 收藏 9 次", LONG, "大家都在看", "某病的病因", "2. 另一病的用法 >>", LONG, "某病的用法", LONG, "网友12：" + LONG, "（未完待续）", "* * *", "© 2020 某站"])
    assert M.outside_lines(M.text_lines(text), None, "题目") == [1, 2, 4, 6, 7, 8, 12, 13, 14, 15]
    # before the article its own title ends the list
    text = "\n".join(["热门问答", "某病的病因", "另一病的用法", "题目", LONG])
    assert M.outside_lines(M.text_lines(text), None, "题目") == [1, 2, 3] == M.outside_lines(M.text_lines(text), None, None)


def test_regions():
    assert M.regions([-1, 2, -1, 3, -5, 1]) == [(1, 4), (5, 6)] and M.regions([]) == [] == M.regions([-1.0])
    assert M.regions([0.4, -1, 5, -0.1, 0.5, -9, 0.9, -9, 2]) == [(2, 5), (8, 9)]
    # a run is as good as any run within it that could be cut shorter or drawn longer
    rng = random.Random(13)
    for _ in range(200):
        x = [rng.choice((-2.0, -1.0, -0.5, 0.5, 1.0, 3.0)) for _ in range(rng.randrange(1, 12))]
        got = M.regions(x, 0.0)
        best = max(sum(x[a:b]) for a in range(len(x)) for b in range(a + 1, len(x) + 1))
        assert (max((sum(x[a:b]) for a, b in got), default=0.0) == best) or best <= 0 and not got
        assert all(b <= c for (_, b), (c, _) in zip(got, got[1:])) and all(x[a] > 0 and x[b - 1] > 0 for a, b in got)


def test_regions_decide_where_tags_tell_nothing():
    w = M.TagWeights(collections.Counter({"leaf:a": 300, "box:nav": 300}), collections.Counter({"leaf:p": 300, "box:main": 300}))
    link, unknown, own = ("leaf:a", "box:nav"), ("leaf:x", "box:y"), ("leaf:p", "box:main")
    plain = [(1, "甲乙丙", link), (2, "专题", unknown), (3, "丁戊己", link), (4, "题目", unknown), (5, LONG, own), (6, "小节", unknown), (7, LONG, own), (8, "庚辛壬", link)]
    # 2 lies in a box; 4 and 6 border on the article
    assert M.outside_lines(plain, w, None) == [1, 2, 3, 8]
    # the article's tags and its title hold out between boxes, unknown words don't
    for tags, title, want in ((own, None, [1, 3]), (unknown, "专题", [1, 3]), (unknown, None, [1, 2, 3])):
        assert M.outside_lines([(1, "甲乙丙", link), (2, "专题", tags), (3, "丁戊己", link)], w, title) == want
    # boilerplate by its words weighs what its tags say
    notices = [(1, "版权所有", link), (2, "专题", unknown), (3, "版权所有", link)]
    assert M.outside_lines(notices, w, None) == [1, 2, 3]
    # a sentence that outweighs the lines around it stays
    assert M.outside_lines([(1, "版权所有", ()), (2, LONG, ()), (3, "版权所有", ())], None, None) == [1, 3]
    assert M.boxes([], []) == set() and M.boxes([-2.0, 1.0, -2.0], []) == {0, 1, 2} and M.boxes([-2.0, 1.0, -2.0], [1]) == {0, 2}
    assert M.boxes([-2.0, 3.0, -2.0], []) == {0, 2}


def test_lists_of_any_length_and_deep_pages():
    items = [f"第{i}种病的病因" for i in range(1, 15)]
    text = "\n".join(["题目", LONG, "大家都在看", *items, LONG])
    assert M.outside_lines(M.text_lines(text), None, "题目") == list(range(3, 18))
    # an end tag closes its element however many are open within it
    deep = "<nav>" + "<i>" * 30 + "\n首页\n</nav>\n<p>" + LONG + "</p>\n"
    assert M.shown_lines(deep)[-1][2] == ("leaf:p", "box:body")
    long = "© 2020 某站，" + "版权所有，" * 80
    assert M.notice_kind(long) == "notice"


def test_boilerplate_rows(spark):
    rows = [("r", 1, "html", "题目", PAGE), ("r", 2, "text", None, None), ("r", 3, None, None, ""), ("r", 4, "html", None, "<<<"), ("r", 5, "text", None, "短"), ("r", 5, "text", None, "短"), ("r", 6, "text", None, LONG * 3000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "tab string, rec_id long, kind string, title string, text string, line_no string")
    w = weights([PAGE])
    got = collections.Counter(r["rec_id"] for r in M.boilerplate_lines(df, w).collect())
    assert got[1] == 6 and not {2, 3, 5, 6} & set(got)
    assert M.boilerplate_lines(df.where("false"), w).count() == 0
    text = {r["rec_id"]: r["text"] for r in M.main_text(df, w).collect()}
    assert text[2] is None and text[3] == "" and "登录" not in text[1] and "甲状腺" in text[1]
    pages = spark.createDataFrame([(1, PAGE), (2, None)], "raw_id long, raw string")
    assert M.learn_weights(pages).cost(("leaf:p",)) < 0 < M.learn_weights(pages).cost(("leaf:a",))
    assert M.learn_weights(pages.where("false")).of == {}


# ---------------------------------------------------------------- wrong encodings


@pytest.fixture(scope="module")
def language(spark, small):
    from loomtext.llm import common

    return J.language_of(common.texts(spark, small))


ZH = "手术切除胰腺病灶后，补液量控制在157毫升，同时停用奈米西泮。"
WAYS = [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("gbk", "latin-1"), ("utf-8", "gb18030"), ("utf-8", "cp932"), ("utf-8", "cp1251")]


@pytest.mark.parametrize("written,read", WAYS)
def test_garbled_text_is_found_and_restored(language, written, read):
    bad = "".join(bytes([b]).decode(read, "strict") if read in ("latin-1",) else "" for b in ZH.encode(written)) if read == "latin-1" else ZH.encode(written).decode(read, "replace")
    if read in ("cp1252", "cp1251"):
        bad = "".join(bytes([b]).decode(read) if bytes([b]).decode(read, "ignore") else chr(b) for b in ZH.encode(written))
    assert J.find_stretches("前文。\n" + bad, language)
    got, n, _ = J.restore("前文。\n" + bad, language)
    same = sum(a == b for a, b in zip(got.removeprefix("前文。\n"), ZH))
    assert n >= 1 and (got == "前文。\n" + ZH or "�" in bad and same >= 0.5 * len(ZH)), got


def _misread(line, written, read):
    """The line as bytes, read one byte a character."""
    back = {b: c for c, b in J._bytes_of(read).items()}
    return "".join(chr(b) if b < 128 else back.get(b, "�") for b in line.encode(written))


def test_ten_channels_with_and_without_lost_bytes(spark):
    """Clean lines of the corpus, garbled: found, and restored where bytes are enough to tell."""
    import difflib
    import os
    import re as regex

    from loomtext.llm import common

    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test data here")
    df = common.texts(spark, folder)
    language, rng = J.language_of(df), random.Random(1)
    lines = [x for r in df.collect() if not J._suspect().search(r["text"]) for x in r["text"].split("\n") if 20 <= len(x) <= 200]
    hanzi = [x for x in lines if sum("一" <= c <= "鿿" for c in x) > 10]
    latin = [x for x in lines if not regex.search("[一-鿿]", x) and len(regex.findall("[à-ÿ]", x)) >= 2]
    whole = [("utf-8", read, of) for read in J.SINGLE for of in (hanzi, latin)] + [("gbk", "cp1252", hanzi)]
    swapped = [("cp1252", "cp850", latin), ("cp1252", "mac_roman", latin), ("cp1252", "cp437", latin), ("mac_roman", "cp1252", latin)]
    for written, read, of in whole + swapped:
        for lost in (0.0, 0.04) if written == "utf-8" else (0.0,):
            found, alike, picked = 0, 0.0, rng.sample(of, 30)
            for x in picked:
                x = x.encode(written, "ignore").decode(written)
                bad = "".join("�" if c > "\x7f" and rng.random() < lost else c for c in _misread(x, written, read))
                got, n, _ = J.restore("前。\n" + bad, language)
                found += n > 0
                alike += difflib.SequenceMatcher(None, got[3:], x, autojunk=False).ratio()
            swap = (written, read, of) in swapped
            assert found >= (0.75 if swap else 0.95) * len(picked), (written, read, lost, found)
            assert alike >= (0.9 if swap else 0.95) * len(picked), (written, read, lost, alike)


def test_viterbi_is_exact(language):
    """Giving up states that can't catch up changes nothing: as good as trying every way."""
    import itertools

    data = list("病程".encode())
    data[2] = data[5] = None
    ways = [language.compatible("utf-8", tuple(data[:3])), language.compatible("utf-8", tuple(data[3:]))]
    best = max(itertools.product(*ways), key=lambda w: language.step("", w[0]) + language.step(w[0], w[1]))
    got, score = J.decode_lattice(data, "utf-8", language)
    # there are still other ways to cut the bytes
    assert score >= language.step("", best[0]) + language.step(*best) - 1e-6 and len(ways[0]) * len(ways[1]) > 1


def test_latin_text_and_double_mistakes(language):
    once = "the café-au-lait spots – stay".encode().decode("cp1252")
    assert J.restore(once, language)[0] == "the café-au-lait spots – stay"
    assert J.restore(once.encode().decode("cp1252"), language)[0] == "the café-au-lait spots – stay"


def test_clean_text_is_left_alone(language):
    for t in (ZH, "São-Lume Ångvik Żelk Витал Θ波 naïve café", "Это русский текст, ВСЁ «ЦЕЛО».", "DESPUÉS DE 2 DÍAS CON VISIÓN", "漢字と仮名", "Ελληνικά", "", None, "a" * 100_000, "déjà… “vu” – É’", "以В\xad超 В\xa0"):
        assert J.restore(t, language) == (t, 0, 0), t


def test_lost_text_is_found_but_not_invented(language):
    for t in ("锟斤拷锟斤拷锟斤拷", "����������"):
        assert J.restore(t, language)[1:] == (1, 0)


def test_lost_byte_in_the_lattice(language):
    data = list("病程第三周".encode())
    data[4] = None
    assert J.decode_lattice(data, "utf-8", language)[0][0] == "病" and len(J.decode_lattice(data, "utf-8", language)[0]) == 5


def test_garbled_rows(spark, language):
    rows = [("t", 1, ZH.encode().decode("mac_roman")), ("t", 2, ZH), ("t", 3, None), ("t", 4, "")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "tab string, rec_id long, text string, n_stretches int")
    got = J.garbled(df, language).collect()
    assert [(r["rec_id"], r["text"]) for r in got] == [(1, ZH)]
    assert J.garbled(df.where("false")).count() == 0


# ---------------------------------------------------------------- repeated lines


def brute_lines(rows, least=5, share=0.1):
    total, where = collections.Counter(), collections.defaultdict(set)
    for k, (i, s, t) in enumerate(rows):
        if t is None:
            continue
        total[s] += 1
        for line in W.normalize_lines(t):
            if line:
                where[s, line].add(k)
    return sorted((i, n) for i, s, t in rows if t is not None for n, line in enumerate(W.normalize_lines(t), 1) if line and len(where[s, line]) >= least and len(where[s, line]) >= share * total[s])


def test_repeated_lines(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        s = rng.choice(("hot", "hot", "b", None))
        lines = ["".join(rng.choice("病痛炎症药量") for _ in range(rng.randrange(0, 60))) for _ in range(4)]
        lines += rng.sample([f"© {i} 本站  版权所有，转载请注明出处与作者", "a", "　分享 ", "", "只有少数"], 2)
        rows.append((i, s, "\n".join(rng.sample(lines, len(lines)))))
    rows += [(900, "b", None), (901, "b", ""), (902, "hot", "分享\n分享"), (903, "c", "分享"), (904, "hot", "x" * 100_000)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "id long, source string, text string, line_no int, chunk string")
    got = W.repeated_lines(df)
    assert sorted((r["id"], r["line_no"]) for r in got.collect()) == brute_lines(rows)
    clean = {r["id"]: r["text"] for r in W.without_lines(df, got).collect()}
    assert clean[900] is None and clean[903] == "分享" and clean[902] == "" and len(clean) == len(rows)
    assert W.repeated_lines(df.where("false")).count() == 0


def test_chunks_of_a_line_do_not_depend_on_its_surroundings():
    line = "这是一条足够长的提示，转载请注明出处，请勿自行用药，如有不适请及时就诊。"
    a = W.chunks([line])
    b = W.chunks(["前面的行", line, "后面"])
    assert a[1].tolist() == b[1][b[0] == 1].tolist() and a[3][0] == b[3][1] and len(a[1]) > 1
    assert a[2].sum() == len(line)


# ---------------------------------------------------------------- pieces

import re  # noqa: E402

TOK = re.compile(r"[㐀-鿿豈-﫿]|[a-zA-Z0-9]+(?:['’\-][a-zA-Z0-9]+)*|[^\s]")


def test_tokens_as_the_rule():
    rng = random.Random(6)
    for _ in range(300):
        t = "".join(rng.choice("ab1'’- \n。.中é　\x85\x1c-'") for _ in range(rng.randrange(0, 80)))
        assert S.count_tokens(t) == len(TOK.findall(t)), repr(t)


def test_pieces_are_a_round_trip():
    rng = random.Random(7)
    texts = ["中" * 3000, "a " * 2000, "x" * 9000, "", "短", "句子。" * 800, "第一行\n" * 900]
    texts += ["".join(rng.choice("ab中。.,， \n；") for _ in range(4000)) for _ in range(20)]
    for t in texts:
        for limit, overlap in ((512, 100), (50, 10), (50, 0), (20, 19)):
            at = 0
            for k, (a, b, n, shared) in enumerate(S.split_text(t, limit, overlap)):
                assert a <= at and n <= limit and shared <= overlap and n == len(TOK.findall(t[a:b]))
                assert shared == len(TOK.findall(t[a:at])) and (b > at or not t)
                at = b
            assert at == len(t)
    assert S.split_text(None) == []


def test_overlap_is_taken_as_given():
    t = "".join(f"句{i}。" for i in range(900))
    for limit, overlap in ((50, 40), (50, 49), (30, 29)):
        at = 0
        for a, b, n, shared in S.split_text(t, limit, overlap):
            assert a <= at and n <= limit and shared <= overlap and shared == len(TOK.findall(t[a:at])) and b > at
            at = b
        assert at == len(t)
    for limit, overlap in ((20, 20), (20, 30), (20, -1)):
        with pytest.raises(ValueError):
            S.split_text(t, limit, overlap)


def test_cuts_are_at_natural_places():
    t = ("一二三四五六七八九十。" * 30 + "\n") * 8
    ends = [t[b - 1] for _, b, _, _ in S.split_text(t)]
    assert set(ends) <= {"\n", "。"} and sum(e == "\n" for e in ends) >= len(ends) // 2


def test_piece_rows(spark):
    df = spark.createDataFrame([("t", 1, "字" * 600, "c"), ("t", 2, None, "c"), ("t", 3, "", "c"), ("t", 1, "字" * 600, "c")], "tab string, rec_id long, text string, piece string")
    got = collections.Counter((r["rec_id"], r["piece"]) for r in S.split_oversized(df).collect())
    assert got == {(1, 0): 2, (1, 1): 2, (3, 0): 1}
    assert S.split_oversized(df.where("false")).count() == 0


# ---------------------------------------------------------------- encoding and containers


def test_ids_as_the_tokenizer(spark):
    from tokenizers import Tokenizer

    from loomtext.llm import common

    tok = Tokenizer.from_file(common.tokenizer_file("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    texts = ["", None, " ", "It's 病因：naïve don't\r\n\t x  y", "<|endoftext|>", "👍🏽 ¿qué?", "a" * 30_000, "病" * 3000, "  \x85", "same", "same"]
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)] + [(None, "n", [1])], "doc_id long, text string, ids array<int>")
    got = collections.defaultdict(list)
    for r in E.encode_corpus(df).collect():
        got[r["doc_id"]].append(r["ids"])
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        assert got[i] == [tok.encode(t or "", add_special_tokens=False).ids], t
    n = {r["doc_id"]: r["n_tokens"] for r in E.count_tokens(df).collect()}
    assert all(n[i] == len(got[i][0]) for i in range(len(texts)))
    back = {r["doc_id"]: r["text"] for r in E.decode_ids(E.encode_corpus(df)).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert E.encode_corpus(df.where("false")).count() == 0


def test_decoding_null_and_cut_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [162])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in E.decode_ids(df).collect()} == {1: None, 2: "", 3: "�"}


def longest_first(counts, capacity):
    """What the plain heuristic needs."""
    left, n = counts.copy(), 0
    left[0] = 0
    while left.any():
        room = capacity
        n += 1
        while len(fits := np.flatnonzero(left[: room + 1])):
            left[fits[-1]] -= 1
            room -= int(fits[-1])
    return n


def test_plan_holds_every_item():
    rng = np.random.default_rng(3)
    for n in (0, 1, 30, 5000):
        counts = np.bincount(np.clip(rng.lognormal(3, 1, n).astype(int), 1, 100), minlength=101)
        held = np.zeros(101, int)
        made = P.plan(counts, 100)
        for config, times in made.configs:
            assert times > 0 and sum(e * k for e, k in config.items()) <= 100
            for e, k in config.items():
                held[e] += k * times
        assert (held == counts).all()
        assert made.containers <= min(longest_first(counts, 100), P.lower_bound(counts, 100) + 2) and made.bound <= made.containers + 1e-9


def test_program_finds_full_configurations():
    counts = np.zeros(101, int)
    counts[[30, 40, 60, 70]] = 1000
    made = P.plan(counts, 100)
    assert made.containers == 2000 and made.program_share >= 0.95 and made.bound >= 1999
    # longest first spoils these: 55 + 44 leaves 1 free, 55 + 45 and 44 + 56 do not
    counts = np.zeros(101, int)
    counts[[55, 45, 44, 56, 34, 33]] = (400, 400, 300, 300, 100, 200)
    assert P.plan(counts, 100).containers == P.lower_bound(counts, 100) == 800


def test_program_of_documents_like_lengths():
    rng = np.random.default_rng(5)
    for n in (2000, 40_000):
        counts = np.bincount(np.clip(rng.gamma(1.4, 500, n).astype(int), 1, 2048), minlength=2049)
        made = P.plan(counts)
        assert made.program_share >= 0.95 or n < 10_000
        assert made.containers <= longest_first(counts, 2048) and made.containers <= 1.002 * made.bound + 1


def test_pack(spark):
    sizes = [(i, (5000 if i == 7 else 700 if i % 3 == 0 else i % 2100)) for i in range(3000)] + [(9000, 0), (9001, None), (9002, 2048), (9003, 2049)]
    df = spark.createDataFrame([(*s, "c") for s in sizes], "doc_id long, n_tokens long, container string")
    rows = P.pack(df, phases=40).collect()
    per, docs = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        per[r["container"]] += r["size"]
        docs[r["doc_id"]].append((r["piece"], r["first_unit"], r["size"]))
    assert max(per.values()) <= P.CAPACITY and len(docs) == len(sizes)
    for i, n in sizes:
        assert sum(s for *_, s in docs[i]) == (n or 0) and len(docs[i]) == max(1, -(-(n or 0) // P.CAPACITY))
        at = 0
        for _, first, s in sorted(docs[i]):
            assert first == at
            at += s
    # longest first is close to the best here: most items are longer than half a container. The program alone, without taking the
    # better of the two, is within half a per cent of it
    counts = np.bincount([r["size"] for r in rows], minlength=P.CAPACITY + 1)
    assert len(per) <= 1.005 * longest_first(counts, P.CAPACITY)
    assert P.pack(df.where("false")).count() == 0
    assert {r["container"] for r in P.pack(df.where("doc_id >= 9000 AND doc_id < 9002")).collect()} == {0}


# ---------------------------------------------------------------- residue


@pytest.mark.parametrize(
    "text",
    ["题目\n" + ZH + "{{疾病名}}" + ZH, "a ${title} b", "[在此处插入作者]", "x %s y", "一 {0} 二", "____年__月__日", "<%= date %>", "[TODO: x]", "#日期#", "TBD_CITY", "@@A@@", "$BODY$", "404 Not Found", "Please enable JavaScript to view this page.", "首页 | 登录 | 注册\n抱歉，您访问的页面不存在（404）\n© 2020 某站", "Loading…\nLoading…", "此处为占位文字。此处为占位文字。", "undefined\nundefined\nundefined", "Lorem ipsum dolor sit amet, consectetur elit.", "asdf jkl; qwer asdf", "502 upstream error. Try again later.", "Your session has timed out. Please sign in again.", "Pagina non trovata", "Страница не найдена", "Página não encontrada. Tente novamente."],
)
def test_residue(text):
    assert R.is_residue(text)


@pytest.mark.parametrize(
    "text",
    [None, "", "  \n", ZH, "题", "血型基因记作 {A, B, O} 三种等位基因。", "输注0.9%saline 50毫升。", "核型为 47,XXX 者。费用约$5[1][2]，β-{1,3}-葡聚糖。", "当 <4 mmol/L 且 >2 mmol/L 时", "院内系统提示“请启用 JavaScript”时，护士会改用纸质单。\n" + ZH * 3, "For the best experience turn on JavaScript.\n" + ZH * 3, "12 34 56 78\n90 12", "phenoxyethylaminobenzene", "ACGTACGTACGTACGTACGTACGTACGTACGT", "表中 # 号表示 P<0.05，## 表示 P<0.01。", "« mot » et « autre »"],
)
def test_no_residue(text):
    assert not R.is_residue(text)


def test_coverage_does_not_depend_on_the_order_of_lines():
    lines = ["Please enable JavaScript to view this page."] * 12 + [ZH] * 30
    for t in ("\n".join(lines), "\n".join(lines[::-1])):
        n, share = R.judge(t)
        assert n == 0 and share == R.judge("\n".join(lines))[1] > 0.2
        assert R.is_residue(t, 0.2) and not R.is_residue(t, 0.9)


def test_residue_rows(spark, tmp_path):
    rows = [(1, "{{x}}"), (2, ZH), (3, None), (4, ""), (5, ZH * 5000 + "${a}"), (2, ZH)]
    spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, coverage double").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r["doc_id"] for r in R.p10_found(spark, str(tmp_path)).collect()) == [1, 5]
    assert sorted(r["doc_id"] for r in R.p10_clean(spark, str(tmp_path)).collect()) == [2, 2, 3, 4]
    spark.createDataFrame([], "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert R.p10_found(spark, str(tmp_path)).count() == 0
