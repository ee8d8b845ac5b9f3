import json
import random
import threading
import types
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from kaigi.operators import incremental, minutes, speakers, tfidf, tokens
from kaigi.plans import pipelines
from kaigi.profiles import COUNCIL, PARLIAMENT, TokenRules, categories_from, stop_words_from
from kaigi.sources import landing, meeting_api, readers, retrieval, sinks
from kaigi.streaming import incremental as streams
from kaigi.streaming.incremental import send_batch


def sequential(sessions):
    """(role, name, text) of every segment, line by line."""
    found, current = [], None
    for body in sessions:
        for line in body:
            if line.startswith("◎"):
                if "君" in line:
                    m = line[1:].strip()
                    role, name = (m[: m.index("（")], m[m.index("（") + 1 : -2]) if "（" in m[1:] and m.endswith("君）") else (None, m[:-1] if m.endswith("君") else m)
                    current = [role, name, []]
                    found.append(current)
            elif current:
                current[2].append(line)
    return [(r, n, "\n".join(t).strip()) for r, n, t in found]


def test_utterances_equal_a_sequential_model(spark):
    r = random.Random(3)
    for _ in range(3):
        sessions = [[r.choice(["◎議長（甲君）", "◎乙君", "◎議題", "text a", "", "  b ", "==== 第1回 ===="]) for _ in range(r.randrange(0, 14))] for _ in range(12)]
        rows = [(s, i, x) for s, body in enumerate(sessions) for i, x in enumerate(body)]
        got = minutes.utterances(spark.createDataFrame(rows, "session_seq int, line_no int, line string")).orderBy("seg_id").collect()
        assert [(x.role, x.name, x.text) for x in got] == sequential(sessions)


def test_lines_without_a_session_come_first(spark):
    rows = [(None, 0, "◎甲君"), (None, 1, "first"), (1, 0, "still"), (1, 1, "◎乙君"), (1, 2, "second")]
    got = minutes.utterances(spark.createDataFrame(rows, "session_seq int, line_no int, line string")).orderBy("seg_id").collect()
    assert [(x.name, x.session_seq, x.text) for x in got] == [("甲", None, "first\nstill"), ("乙", 1, "second")]


def test_prefix_sums_over_blocks(spark):
    got = minutes.prefix_sums(spark.range(20).withColumn("n", F.col("id") + 1), "id", "n", blocks=3).orderBy("id").collect()
    assert [x.before for x in got] == [sum(range(1, i + 1)) for i in range(20)]


def test_sessions_loose_and_strict(spark):
    text = "before\n==== 第1回 A 2024-01-01 ====\nx\n==== no date ====\ny\n==== 第2回 B 2024-01-02〜2024-01-05 ====\nz"
    loose = minutes.loose_sessions(spark.createDataFrame([(1, text)], "c int, text string")).orderBy("session_no").collect()
    assert [(x.label, x.content) for x in loose] == [("第1回 A 2024-01-01", "\nx\n"), ("no date", "\ny\n"), ("第2回 B 2024-01-02〜2024-01-05", "\nz")]
    lines = readers.body_lines(spark.createDataFrame([(1, text)], "c int, text string"), "c", "text")
    numbers = lambda profile: [x.session_no for x in minutes.strict_sessions(lines, ["c"], profile.header).orderBy("line_no").collect()]
    assert numbers(PARLIAMENT) == [0, 1, 1, 1, 1, 1, 1]
    assert numbers(COUNCIL) == [0, 1, 1, 1, 1, 2, 2]


def test_meetings_end_to_end(spark, tmp_path):
    for i, (name, words) in enumerate([("山田", "予算 予算 教育"), ("鈴木", "教育 医療"), ("佐藤", "医療 予算 年金")]):
        (tmp_path / f"2024010{i}_h_m_1_{i}.json").write_text(json.dumps({"session": 213, "nameOfHouse": "衆議院", "nameOfMeeting": "本会議", "issue": "第1号", "issueID": str(i), "date": f"2024-01-0{i + 1}", "speechRecord": [{"speaker": name, "speakerRole": "議長", "speech": words}, {"speaker": None, "speech": None}]}, ensure_ascii=False))
    (tmp_path / "20240109_bad.json").write_text("{no json")
    found = readers.meetings(spark, str(tmp_path))
    assert found.where("_corrupt is not null").count() == 1
    assert {x.issueID for x in incremental.to_enrich(found, "_corrupt").collect()} == {None}
    sessions = pipelines.parliament_sessions(found).orderBy("session_seq").collect()
    assert [x.label for x in sessions] == [f"第213回 衆議院 本会議 第1号 2024-01-0{i}" for i in (1, 2, 3)]
    assert "◎議長（山田君）\n予算 予算 教育\n\n◎（発言者不明君）" in sessions[0].text
    features = pipelines.session_features(pipelines.parliament_sessions(found), PARLIAMENT).collect()
    assert {x.term for x in features} == {"予算", "教育", "医療"}
    assert sinks.meeting_file(found).__class__ and found.where("issueID = '1'").select(sinks.meeting_file(found).alias("f")).first().f == "20240102_衆議院_本会議_第1号_1.json"


def test_speaker_analysis(spark):
    lines = [(i, 0, f"◎議長（{'甲乙丙丁'[i % 4]}　君）") for i in range(60)] + [(i, 1, ["予算 教育", "医療 教育", "年金 予算", "防災 医療"][i % 4]) for i in range(60)]
    segments = pipelines.named_segments(minutes.utterances(spark.createDataFrame(lines, "session_seq int, line_no int, line string")), PARLIAMENT)
    cats = spark.createDataFrame([(0, "学", "教育"), (1, "金", "予算"), (2, "無", "不在")], "cat_seq int, category string, word string")
    meta, words, scores = pipelines.speaker_analysis(segments, PARLIAMENT, cats)
    assert {(x.speaker_id, x.role, x.utterance_count, x.total_words) for x in meta.collect()} == {(s, "議長", 15, 30) for s in "甲乙丙丁"}
    assert words.where("speaker_id = '甲'").count() == 2
    assert {(x.speaker_id, x.category): x.word_count for x in scores.collect()}["甲", "無"] == 0 and scores.count() == 12


def test_metadata_rules(spark):
    speeches = spark.createDataFrame([("a", 1, "", None), ("a", 2, "議長", "X"), ("b", 1, "委員", "")], "s string, i int, r string, p string")
    assert {tuple(x) for x in speakers.harvested(speeches, "s", "i", "r", "p").collect()} == {("a", "", "X"), ("b", "委員", "")}
    profiles = spark.createDataFrame([([("n", "k", "f", [(1, "P", "F"), (2, "Q", "G")]), ("n", "k2", "m", [])],)], readers.MEMBERS)
    assert [tuple(x) for x in speakers.members(profiles).collect()] == [("n", "k2", "m", "-", "-", [])]


def test_sending_twice_is_a_no_op(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "x"), ("s2", "y")], "session_name string, text string")
    sink, log = sinks.ManifestSink(str(tmp_path / "manifest")), str(tmp_path / "log")
    assert send_batch(rows, log, sink) == 2
    assert send_batch(rows, log, sink) == 0
    assert send_batch(rows.union(spark.createDataFrame([("s3", "z")], rows.schema)), log, sink) == 1
    assert readers.upload_log(spark, log).count() == 3


def test_exports(spark, tmp_path):
    ranked = spark.createDataFrame([("l", 1, "w", 0.12345, 3, 2), ("l", 2, "v", 0.1, 1, 2)], "label string, rank int, term string, weight double, tf int, df int")
    sinks.ordered_csv(ranked.withColumn("terms", F.array(F.lit(1), F.lit(2))), str(tmp_path / "c"), "rank")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().terms == "1,2"
    sessions = spark.createDataFrame([("n m", 1, "old"), ("n m", 2, " new \n"), ("empty", 3, " ")], "session_name string, session_seq int, text string")
    folder = tmp_path / "s"
    assert sinks.session_files(sessions, str(folder)) == 1
    assert [(x.name, x.read_text()) for x in folder.iterdir()] == [("n_m.txt", "new\n")]
    assert [(x.file_name, x.text) for x in readers.session_texts(spark, str(folder)).collect()] == [("n_m.txt", "new\n")]
    assert spark.range(1).select(minutes.session_name(F.lit("n_m.txt"), "_").alias("n")).first().n == "n m"
    sinks.corpus_text(sessions, str(tmp_path / "corpus"))
    assert "".join(x.read_text() for x in sorted((tmp_path / "corpus").glob("part-*"))) == "old\n new \n\n \n"


def council(spark, tmp_path):
    first = "市議会会議録 令和５年第２回定例会 自 令和５年６月１日 至 令和５年６月２０日 "
    says = lambda i: "\n".join(f"◎議員（{'甲乙丙丁'[(i + k) % 4]}榮君）\n{['予算 教育', '医療 教育', '年金 予算', '防災 医療'][(i + k) % 4]}" for k in range(4))
    rows = [(f"/p/{i:03}.pdf", [first, "◎出席議員\n" + says(i)]) for i in range(60)]
    return spark.createDataFrame(rows, "path string, pages array<string>")


def test_council_speakers_end_to_end(spark, tmp_path):
    sessions = pipelines.council_sessions(council(spark, tmp_path))
    categories = spark.createDataFrame([(0, "学", "教育"), (1, "金", "予算"), (2, "無", "不在")], "cat_seq int, category string, word string")
    profiles = spark.createDataFrame([([("甲　栄", "こう", "男", [(1, "P", "F"), (2, "Q", "G")]), ("丙栄", "へい", "女", [])],)], readers.MEMBERS)
    with pytest.raises(ValueError):
        pipelines.speaker_tables(pipelines.corpus_segments(sessions, COUNCIL), COUNCIL, pipelines.member_dimension(profiles, COUNCIL), categories)
    profile = COUNCIL.with_speaker_stops(["する"])
    tables = pipelines.speaker_tables(pipelines.corpus_segments(sessions, profile), profile, pipelines.member_dimension(profiles, profile), categories)
    meta = {r.id: r for r in tables[0].collect()}
    assert tables[0].columns == ["id", "name", "kana", "gender", "party", "faction", "terms", "role", "in_member_json", "utterance_count", "total_words", "first_seg"]
    # the speaker of a session's last speech carries over into the next one's header and front matter, in 15 sessions
    assert tuple(meta["甲栄"])[:-2] == ("甲栄", "甲　栄", "こう", "男", "Q", "G", [1, 2], "議員", True, 60) and meta["甲栄"].total_words > 120
    assert tuple(meta["丙栄"])[1:9] == ("丙栄", "へい", "女", "-", "-", [], "議員", True) and tuple(meta["乙栄"])[1:9] == ("乙榮", "", "", "", "", [], "議員", False)
    assert tables[1].columns == ["speaker_id", "name", "role", "gender", "party", "faction", "terms", "utterance_count", "word", "tfidf", "count", "rank"]
    assert tables[2].columns == ["speaker_id", "name", "role", "gender", "party", "faction", "terms", "utterance_count", "category", "score", "word_count", "top_words", "cat_seq"]
    assert {(r.word, r["count"], r["rank"]) for r in tables[1].where("speaker_id = '甲栄'").collect()} == {("予算", 60, 1), ("教育", 60, 2)}
    assert tables[2].count() == 12 and {r.word_count for r in tables[2].where("category = '無'").collect()} == {0}
    pipelines.export_speaker_tables(tables, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "tfidf_words")).columns == tables[1].columns
    assert spark.read.json(str(tmp_path / "out" / "speakers_meta")).first().id == "甲栄"
    features = pipelines.session_features(sessions, profile)
    assert pipelines.first_session_terms(features, sessions).count() <= 10 and pipelines.corpus_size(sessions).first().n_sessions == 60


def test_parliament_speakers_end_to_end(spark, tmp_path):
    """Files to tables, against a plain model: sessions in order of day and number, a speaker who carries over a session."""
    r, expected, files = random.Random(9), {}, []
    for i in range(25):
        speeches = [{"speaker": r.choice(["山田", "鈴木", "佐藤"]), "speakerRole": r.choice([None, "委員"]), "speakerGroup": r.choice([None, "会派"]), "speech": r.choice(["予算 教育", "医療 教育 教育", "年金 予算", ""])} for _ in range(6)]
        files.append((f"202401{i % 7 + 10}_h_m_1_{i}.json", {"session": 213, "nameOfHouse": "衆議院", "nameOfMeeting": "本会議", "issue": "第1号", "issueID": str(i), "date": "2024-01-01", "speechRecord": speeches}))
    for name, record in files:
        (tmp_path / name).write_text(json.dumps(record, ensure_ascii=False))
    for name, record in sorted(files, key=lambda x: (x[0][:8], int(x[1]["issueID"]))):
        for s in record["speechRecord"]:
            e = expected.setdefault(s["speaker"], {"n": 0, "words": 0, "marker": "", "role": None, "party": ""})
            e["n"] += bool(s["speech"])
            e["words"] += len(s["speech"].split())
            e["marker"] = e["marker"] or (s["speakerRole"] or "")
            e["role"] = (s["speakerRole"] or "") if e["role"] is None else e["role"]
            e["party"] = e["party"] or (s["speakerGroup"] or "")
    found = readers.meetings(spark, str(tmp_path))
    segments = pipelines.corpus_segments(pipelines.parliament_sessions(found), PARLIAMENT)
    categories = spark.createDataFrame([(0, "学", "教育")], "cat_seq int, category string, word string")
    meta, words, scores = pipelines.speaker_tables(segments, PARLIAMENT, pipelines.harvested_speakers(found, PARLIAMENT), categories)
    assert meta.columns[:-1] == ["id", "name", "role", "party", "utterance_count", "total_words"]
    got = {x.id: x for x in meta.collect()}
    assert {tuple(x)[:4] for x in got.values()} == {(s, s, e["marker"] or e["role"], e["party"]) for s, e in expected.items()}
    # a session's header follows the last speech of the one before, as its speaker carries over: empty speeches get a text by it
    assert all(0 <= got[s].utterance_count - e["n"] <= 25 and got[s].total_words >= e["words"] for s, e in expected.items())
    assert words.columns == ["speaker_id", "name", "role", "party", "utterance_count", "word", "tfidf", "count", "rank"]
    assert scores.columns == ["speaker_id", "name", "role", "party", "utterance_count", "category", "score", "word_count", "top_words", "cat_seq"]


class Stub(BaseHTTPRequestHandler):
    """A service with 230 meetings in pages, single meetings, a page of links and files."""

    def do_GET(self):
        url = urllib.parse.urlparse(self.path)
        query = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
        kind = "application/json"
        if url.path == "/api/meeting_list":
            at = int(query["startRecord"])
            records = [{"issueID": f"{query['session']}-{i}"} for i in range(at, min(231, at + int(query["maximumRecords"])))]
            body = json.dumps({"numberOfRecords": 230, "nextRecordPosition": at + 100 if at + 100 <= 230 else None, "meetingRecord": records}).encode()
        elif url.path == "/api/meeting":
            body = json.dumps({"meetingRecord": [{"issueID": query["issueID"], "speechRecord": [{"speech": "x"}]}] if query["issueID"] != "gone" else []}).encode()
        elif url.path == "/links.html":
            body, kind = '<meta charset="Shift_JIS"><a href="a/会.pdf">会</a> <A HREF=\'/b.pdf\'>b</a> <a href="c.txt">c</a>'.encode("cp932"), "text/html"
        elif url.path.endswith(".pdf"):
            body, kind = b"%PDF " + url.path.encode(), "application/pdf"
        else:
            self.send_error(404)
            return
        self.send_response(200)
        self.send_header("Content-Type", kind)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def service():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_fetching_over_http(spark, tmp_path, service):
    meeting_api.enable(spark)
    listed = spark.read.format("meeting_api").option("base", service + "/api").option("session", "213").option("pause", "0").load()
    assert sorted(x.issueID for x in listed.collect()) == sorted(f"213-{i}" for i in range(1, 231))
    with pytest.raises(Exception, match="search condition"):
        spark.read.format("meeting_api").option("base", service).load().count()
    targets = spark.createDataFrame([("5",), ("gone",)], "issueID string")
    full = readers.full_meetings(targets, readers.meeting_by_id(service + "/api"), pause=0)
    assert [(x.issueID, x.speechRecord[0].speech) for x in full.collect()] == [("5", "x")]
    merged = incremental.enriched(readers.parsed_meetings(spark.createDataFrame([('{"issueID": "5"}',), ('{"issueID": "6"}',)], "record string")), full)
    assert {x.issueID: bool(x.speechRecord) for x in merged.collect()} == {"5": True, "6": False}
    pages = readers.fetched_pages(spark.createDataFrame([(service + "/links.html",), (service + "/none",)], "url string"), pause=0)
    assert sinks.meeting_files(merged, str(tmp_path / "m")) == 2
    links = readers.links(pages)
    assert {(x.file_name, x.target.removeprefix(service)) for x in links.collect()} == {("会.pdf", "/a/会.pdf"), ("b.pdf", "/b.pdf")}
    got = readers.downloaded(links.where("file_name = 'b.pdf'").union(links.where("file_name = 'b.pdf'").withColumn("target", F.lit(service + "/gone"))), pause=0)
    assert sinks.save_files(got, str(tmp_path / "pdf")) == 1 and (tmp_path / "pdf" / "b.pdf").read_bytes() == b"%PDF /b.pdf"
    found = readers.pdf_pages(spark, str(tmp_path / "pdf"), lambda blob: [blob.decode()] if blob else None)
    assert [x.pages for x in found.collect()] == [["%PDF /b.pdf"]]
    assert sinks.land_meetings(merged, str(tmp_path / "table")).inserted == 2
    assert landing.landed(spark, str(tmp_path / "table")).count() == 2


def test_streams(spark, tmp_path):
    land, log = tmp_path / "land", str(tmp_path / "log")
    land.mkdir()
    for name, issue in (("a", "1"), ("b", "1"), ("c", "2")):
        (land / f"{name}.json").write_text(json.dumps({"issueID": issue}))
    for _ in range(2):
        streams.land_stream(streams.landed_meetings(spark, str(land)), str(tmp_path / "t"), str(tmp_path / "ck")).awaitTermination(60)
        assert sorted(x.issueID for x in landing.landed(spark, str(tmp_path / "t")).collect()) == ["1", "2"]
    spark.createDataFrame([(f"s{i}", "x") for i in range(5)], "session_name string, text string").write.parquet(str(tmp_path / "sessions"))
    sink = sinks.ManifestSink(str(tmp_path / "manifest"))
    stream = spark.readStream.schema("session_name string, text string").parquet(str(tmp_path / "sessions"))
    for _ in range(2):
        streams.send_stream(stream, str(tmp_path / "items"), str(tmp_path / "ck2")).awaitTermination(60)
    assert retrieval.sent_items(spark, str(tmp_path / "items")).count() == 5
    assert send_batch(spark.read.parquet(str(tmp_path / "sessions")), log, sink) == 5
    more = spark.createDataFrame([(f"s{i}", "x") for i in range(8)], "session_name string, text string")
    assert send_batch(more, log, sink) == 3 and readers.upload_log(spark, log).count() == 8
    assert sinks.retrieval_filter(readers.upload_log(spark, log), "s7")["key"] == "file_id" and sinks.retrieval_filter(readers.upload_log(spark, log), "none") is None
    corpus = more.withColumnRenamed("session_name", "label")
    store = sinks.send_corpus(spark, corpus, sinks.ManifestSink(str(tmp_path / "whole"), "corpus"), "all", str(tmp_path / "id"))
    assert sinks.store_id(spark, None, str(tmp_path / "id")) == store and sinks.store_id(spark, " x ", str(tmp_path / "id")) == "x"
    with pytest.raises(ValueError):
        sinks.store_id(spark, None, str(tmp_path / "no id"))


def test_missing_inputs_fail(spark, tmp_path):
    for read in (readers.meetings, readers.member_profiles, readers.corpus, readers.pdf_pages):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / "none"))
    assert readers.upload_log(spark, str(tmp_path / "none")).count() == 0
    path = tmp_path / "members.json"
    path.write_text(json.dumps({"members": [{"name": "n", "terms": [{"term": 1, "party": "P"}]}]}))
    assert speakers.members(readers.member_profiles(spark, str(path))).first().terms == [1]
    (tmp_path / "all.txt").write_bytes(b"a\r\nb\rc")
    assert readers.corpus(spark, str(tmp_path / "all.txt")).first().text == "a\nb\nc"


def test_a_tagger_per_worker(spark):
    def tagger():
        def tag(text):
            feature = lambda w: types.SimpleNamespace(lemma=None if w.startswith("n") else w, pos1="名詞", pos2="普通名詞", pos3="一般")
            return [types.SimpleNamespace(surface=w, feature=feature(w)) for w in text.split()]

        return tag

    texts = spark.createDataFrame([("s", "Ａ予算 予算 予算 no"), ("s", None)], "e string, t string")
    got = tfidf.term_counts(tokens.token_table(texts, "e", "t", TokenRules(), tokens.morphological(tagger)), "e")
    # full-width capitals count for the weight but not for the count that is shown
    assert {(x.term, x.tf, x["count"]) for x in got.collect()} == {("予算", 2, 2), ("ａ予算", 1, 0)}


def test_dictionaries_from_files(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"甲": ["x", "x", "y"], "乙": []}, ensure_ascii=False))
    assert categories_from(str(tmp_path / "c.json")) == [(0, "甲", "x"), (0, "甲", "y")]
    (tmp_path / "s.txt").write_text("a\n\n b \n")
    assert stop_words_from(str(tmp_path / "s.txt")) == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        stop_words_from(str(tmp_path / "none"))
