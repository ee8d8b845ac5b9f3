import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from kaigi.functions import dates, text
from kaigi.operators import minutes, tfidf, tokens
from kaigi.profiles import COUNCIL, PARLIAMENT
from kaigi.sources import readers


def value(spark, column, given):
    return spark.createDataFrame([(given,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "marker, role, name",
    [("議長（佐久本洋介君）", "議長", "佐久本洋介"), ("島尻　誠君", None, "島尻　誠"), ("（発言者不明君）", None, "（発言者不明君）"), ("事務局", None, "事務局")],
)
def test_markers(spark, marker, role, name):
    assert tuple(value(spark, text.parse_marker, marker)) == (role, name)


@pytest.mark.parametrize("given, day", [("令和元年５月１日", "2019-05-01"), ("平成 31 年 13 月 40 日", "2019-13-40"), ("昭和64年1月7日", "1989-01-07"), ("2024年1月1日", None)])
def test_era_dates(spark, given, day):
    assert value(spark, dates.parse_date, given) == day


def test_front_matter(spark):
    page = "令 和 元 年 第 ３ 回 市議会定例会\n自　令和元年９月１日\n至　令和元年９月２０日"
    meta = value(spark, dates.front_matter, page)
    assert tuple(meta) == ("令和元年", 3, "定例会", "2019-09-01", "2019-09-20")
    meta = value(spark, dates.front_matter, "臨時会 至 令和2年1月2日 平成31年4月1日")
    assert tuple(meta)[1:] == (None, "臨時会", "2020-01-02", "2020-01-02")


def test_strip_agrees_with_python(spark):
    chars = [chr(c) for c in range(1, 0x3100) if not unicodedata.category(chr(c)).startswith("C") or chr(c).isspace()]
    rows = spark.createDataFrame([(c + "x" + c,) for c in chars], "x string").select(text.strip(F.col("x")).alias("y")).collect()
    assert [r.y for r in rows] == [(c + "x" + c).strip() for c in chars]


def test_names_and_files(spark):
    assert value(spark, lambda c: text.folded_name(text.nfkc(c), True), "德田　ﾔ") == "徳田ヤ"
    assert value(spark, text.safe_filename, ' a/b:c*"<>|? ') == "a_b_c______"
    assert tuple(value(spark, readers.sort_key, "20240101_a_12.json")) == ("20240101", 12)
    assert value(spark, lambda c: minutes.file_name(c, "_"), "第1回 本会議") == "第1回_本会議.txt"


@pytest.mark.parametrize("n, sizes", [(0, [0]), (2000, [2000]), (2001, [2000, 1])])
def test_chunks(spark, n, sizes):
    assert [len(x) for x in value(spark, text.chunks, "𠮷" * n)] == sizes


@pytest.mark.parametrize("speaker, role, marker", [("山田君", "", "◎山田君"), ("山田", "議長", "◎議長（山田君）"), ("　", "議長", "◎（発言者不明君）"), (None, None, "◎（発言者不明君）")])
def test_speaker_marker(spark, speaker, role, marker):
    row = spark.createDataFrame([(speaker, role)], "s string, r string").select(minutes.speaker_marker(F.col("s"), F.col("r")).alias("m")).first()
    assert row.m == marker


def test_council_header(spark):
    row = spark.sql("SELECT named_struct('nendo', null, 'kai', 3, 'session_type', '定例会', 'date_start', '2020-01-01', 'date_end', null) AS m").select(minutes.council_header(F.col("m")).alias("h")).first()
    assert row.h == "\n\n==== 年度不明 第3回 定例会 2020-01-01〜? ====\n"


def test_tfidf_by_hand(spark):
    docs = {1: "a a b", 2: "a c", 3: "b c c", 4: "d", 5: "a b"}
    tf = tfidf.term_counts(spark.createDataFrame([(k, w) for k, v in docs.items() for w in v.split()], "e int, term string"), "e")
    got = {(r.e, r.term): r.weight for r in tfidf.tfidf(tf, "e", 5, min_df=2, max_df=0.6).collect()}
    idf = {w: math.log(6 / (1 + n)) + 1 for w, n in {"a": 3, "b": 3, "c": 2}.items()}
    for e, v in docs.items():
        raw = {w: v.split().count(w) * idf[w] for w in set(v.split()) if w in idf}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        for w, x in raw.items():
            assert got[e, w] == pytest.approx(x / norm)
    assert len(got) == 8


def test_token_rules(spark):
    morphemes = [("会議録", "会議録", "名詞", "普通名詞", "一般"), ("山田", "山田", "名詞", "固有名詞", "人名"), ("カメ", "カメ", "名詞", "固有名詞", "一般"), ("カメ", "カメ", "名詞", "普通名詞", "一般"), ("１２", "１２", "名詞", "数詞", "一般"), ("走る", "走る", "動詞", "一般", ""), ("予算", None, "名詞", "普通名詞", "一般"), ("国会", "国会", "名詞", "普通名詞", "一般"), ("ab会", "ab会", "名詞", "普通名詞", "一般")]
    rows = spark.createDataFrame([(m,) for m in morphemes], "m struct<surface:string,lemma:string,pos1:string,pos2:string,pos3:string>")
    kept = lambda rules: [r.m.surface for r in rows.where(tokens.keeps(F.col("m"), rules)).collect()]
    assert kept(PARLIAMENT.session_rules) == ["会議録", "カメ", "予算"]
    assert kept(COUNCIL.session_rules) == ["会議録", "山田", "予算", "国会"]


def test_front_matter_block_goes(spark):
    body = "◎会議録情報\n出席者\n◎山田君\n予算です\n◎閉会"
    assert value(spark, tokens.without_front_matter, body) == "予算です" or value(spark, tokens.without_front_matter, body).strip() == "予算です"


def test_profile_counts():
    assert len(set(PARLIAMENT.session_rules.stop)) == 148
    assert len(set(COUNCIL.session_rules.stop)) == 130
    assert len(set(PARLIAMENT.speaker_rules.stop)) == 189
    assert len(PARLIAMENT.categories) == 12 and len(COUNCIL.categories) == 10


def test_links(spark):
    pages = spark.createDataFrame([(1, "http://h.jp/a/b.html?q", """<a href="x.pdf">1</a><a class=z href='/r/y.pdf'>2</a><a href="https://o.jp/z.pdf">3</a><a href="x.pdf?v">4</a>""")], "page_id int, url string, html string")
    assert [(r.target, r.file_name) for r in readers.links(pages).collect()] == [("http://h.jp/a/x.pdf", "x.pdf"), ("http://h.jp/r/y.pdf", "y.pdf"), ("https://o.jp/z.pdf", "z.pdf")]


def test_urls_resolve_as_in_browsers(spark):
    from urllib.parse import urljoin

    bases = ["http://h.jp/a/b/c.html", "http://h.jp/a/b/?q=1/2#x", "https://h.jp", "http://h.jp/"]
    hrefs = ["x.pdf", "../x.pdf", "../../x.pdf", "./x.pdf", "a/../b/./c.pdf", "/r/../x.pdf", "//o.jp/x", "http://o.jp/../x", "?q=2", "#f", "", "d/..", "d/.", "x.pdf?a=../b", "a//b", "../../../../x"]
    rows = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "base string, href string")
    got = {(r.base, r.href): r.u for r in rows.select("base", "href", text.resolve_url(F.col("base"), F.col("href")).alias("u")).collect()}
    assert {k: v for k, v in got.items() if v != urljoin(*k)} == {}


@pytest.mark.parametrize("made", [" " * 10**6 + "x", "a" * 10**6, "（" * 10**6, "x（" * 300_000 + "y君）", "君 " * 300_000, "=" * 10**6, "====" * 10 + "x" * 10**6, "1" * 10**6, "令和" + "1" * 10**6, "第 " * 300_000, "<a " * 333_333, "◎会議録情報\n" * 100_000, "\r\n" * 300_000, "/.." * 300_000])
def test_no_function_is_slow_on_long_texts(spark, made):
    import time

    from kaigi.operators import minutes, tokens
    from kaigi.sources import readers

    t = F.col("t")
    rows = spark.createDataFrame([(made,)], "t string")
    began = time.time()
    found = [text.strip(t), text.safe_filename(t), text.printable_ratio(t), F.size(text.words(t)), text.parse_marker(t), F.size(text.split_lines(t, True)), F.size(text.chunks(t)), text.folded_name(t, True), text.unix_lines(t), dates.parse_date(t), dates.front_matter(t), tokens.without_front_matter(t)]
    rows.select(*(F.md5(F.to_json(F.struct(c.alias("c")))) for c in found)).collect()
    minutes.loose_sessions(rows.withColumn("text", t)).count()
    readers.links(rows.select(F.lit("http://h/").alias("url"), t.alias("html"))).count()
    assert time.time() - began < 20
