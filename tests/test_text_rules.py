"""Normalisation, quality rules, cleaners and adapters on small cases."""

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import cleaners, normalize, quality
from corpusmill.sources import adapters


def one(spark, **cols):
    schema = ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'bigint'}" for k, v in cols.items())
    return spark.createDataFrame([tuple(cols.values())], schema)


def norm(spark, text):
    return normalize.normalize(one(spark, text=text)).first()


def test_white_space_and_lines(spark):
    assert norm(spark, "Hello   world \r\nnext  line\r\n\n\n\n\nend\t x ")["normalized_text"] == "Hello world\nnext line\n\n\nend\t x"
    assert norm(spark, "é")["normalized_text"] == "é"
    assert norm(spark, "a​‮\x00b­­­c")["normalized_text"] == "ab­c"


def test_redaction_counts_and_order(spark):
    r = norm(spark, "mail john.doe@example.com or +1-555-123-4567, host 192.0.2.1")
    assert r["normalized_text"] == "mail <EMAIL> or <PHONE>, host <IP>" and (r["n_email"], r["n_ip"], r["n_phone"], r["n_api_key"]) == (1, 1, 1, 0)
    assert norm(spark, "key AKIA" + "A" * 16)["n_api_key"] == 1
    assert norm(spark, "v6 2001:db8:0:0:0:0:0:1 x")["n_ip"] == 1


@pytest.mark.parametrize(
    "text, why",
    [(None, "empty_text"), ("", "empty_text"), ("short �" + "�" * 9, "fffd_ratio"), ("-----BEGIN RSA PRIVATE KEY-----", "private_key"), ("word " * 60 + "a@b.cc " * 3, "excessive_email"), ("plain text", None)],
)
def test_rejections(spark, text, why):
    assert norm(spark, text)["rejection"] == why


def judge(spark, text, category=None, least=1, english=0.5):
    m = quality.with_metrics(one(spark, text=text))
    return m.select(quality.rule(F.lit(category), F.lit(least), F.lit(english))).first()[0]


def test_quality_rules(spark):
    good = "The boat left the harbour early.\nNobody saw it return at night.\nThe keeper wrote a letter."
    assert judge(spark, good) is None and judge(spark, "") == judge(spark, " \n ") == judge(spark, None) == "empty_document"
    assert judge(spark, good, least=500) == "below_min_length"
    assert judge(spark, "a\x01b\x02c\x03 d") == "low_printable_ratio"
    assert judge(spark, "12 34 56 ab 78 90") == "low_alphabetic_ratio" and judge(spark, "12ab 34cd 5 e", "scientific", english=0) != "low_alphabetic_ratio"
    assert judge(spark, "чужой язык здесь весь") == "low_english_probability"
    assert judge(spark, "same line here\n" * 4) == "high_duplicate_line_ratio"
    assert judge(spark, "Donaudampfschifffahrt Kapitaensmuetzenhalter Oberweserdampfer") == "median_word_length_exceeded"
    assert judge(spark, "one good line\nword\nother\nthird word line") == "high_junk_line_ratio"


def test_upper_median(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],), ([5],), ([],)], "x array<int>")
    assert [r[0] for r in df.select(quality.upper_median(F.col("x"))).collect()] == [3, 5, None]


def test_host_quota_is_order_true_and_null_safe(spark):
    rows = [(i, "a.example" if i % 3 else None, "w " * (i % 7)) for i in range(9000)]
    df = spark.createDataFrame(rows, "ord long, host string, text string")
    got = {r["ord"]: r["over_quota"] for r in cleaners.quota_rule(df, "host", "ord", X.word_count("text"), F.col("ord") % 2 == 0, 500).collect()}
    total: dict = {}
    for i, h, t in rows:
        assert got[i] == (total.get(h, 0) >= 500)
        total[h] = total.get(h, 0) + (len(t.split()) if i % 2 == 0 else 0)


def test_hostname(spark):
    df = spark.createDataFrame([("https://User@Site.Example:80/x",), ("site.example/y?z",), ("",), ("http:///x",)], "u string")
    assert [r[0] for r in df.select(cleaners.hostname(F.col("u"))).collect()] == ["user@site.example:80", "site.example", "unknown", "unknown"]


def test_strips(spark):
    get = lambda f, t: one(spark, t=t).select(f(F.col("t"))).first()[0]
    assert get(cleaners.wiki_strip, "Body text\n== See also ==\nlinks") == "Body text"
    assert get(cleaners.science_strip, "Body\n## References\n[1] x") == "Body"
    assert get(cleaners.book_strip, "x\n*** START OF THE PROJECT GUTENBERG EBOOK T ***\nbody\n*** END OF THE PROJECT GUTENBERG EBOOK T ***\ny") == "body"
    assert get(cleaners.rejoin_words, "hyphen-\nated and Up-\nPer") == "hyphenated and Up-\nPer"
    assert get(cleaners.tag_equations, "a $$ x+1 $$ b \\[y\\] \\begin{equation}\nz\n\\end{equation}") == "a \n<EQUATION>\nx+1\n</EQUATION>\n b \n<EQUATION>\ny\n</EQUATION>\n \n<EQUATION>\nz\n</EQUATION>\n"
    assert get(lambda c: cleaners.boilerplate_strip(c, "educational"), "Keep\nDownload PDF now\nKeep too") == "Keep\nKeep too"


def test_clean_by_source(spark):
    body = "plain words of a long enough text here " * 200
    rows = [("arXiv", body + "\nReferences\n[1]", ""), ("PRE_1929_x", "w0rd " * 1100, ""), ("OERCommons", "Catalog Record " + "w " * 260, ""), ("wikimedia", body, "Talk:x"), ("wikimedia", "short", "T"), ("unknown", "x", ""), ("pubmed", None, None)]
    out = cleaners.clean_by_source(spark.createDataFrame(rows, "source string, text string, title string")).collect()
    assert [r["rule"] for r in out] == [None, "inner_digits_exceeded", "catalogue_stub", "disallowed_namespace", "below_min_length", None, "empty_text"]
    assert out[0]["cleaned_text"] == body


def test_answer_thread(spark):
    q, a = "why " * 25, "because of the long and winding road that leads there " * 12
    schema = "title string, question_body string, answers array<struct<body:string,score:int,is_accepted:boolean,comments:array<struct<text:string>>>>, site_name string"
    rows = [("T", q, [("low " + a, 1, False, []), ("acc " + a, 0, True, [("fix it",), ("no",)]), ("few words", 9, False, None)], "site"), ("T", q, [], "site"), ("T", "short", None, "site"), ("T", q, None, "meta.site")]
    out = cleaners.answer_thread(spark.createDataFrame(rows, schema)).collect()
    assert [r["rule"] for r in out] == [None, "no_answers_in_thread", "empty_or_short_question_body", "disallowed_meta_site"]
    t = out[0]["thread_text"]
    assert t.index("acc because") < t.index("<COMMENT>\nfix it") < t.index("low because") and "few words" not in t and "\nno\n" not in t


def test_issue_thread(spark):
    schema = "title string, body string, comments array<struct<body:string,author:string>>, is_pull_request boolean"
    long = "the change touches the reader and the writer of the table " * 6
    rows = [("T", long, [(long, "x"), ("y", "dependabot"), ("A" * 120, "z")], True), ("dependabot bump", "b", None, False), ("T", long, None, False), ("T", "b", [("```\n" + "code " * 50 + "```", "x")], None)]
    out = cleaners.issue_thread(spark.createDataFrame(rows, schema)).collect()
    assert [r["rule"] for r in out] == [None, "bot_generated_thread", "insufficient_turns", "code_ratio_exceeded"]
    assert "<PULL_REQUEST_TITLE>" in out[0]["thread_text"] and "[BASE64_BINARY_REMOVED]" in out[0]["thread_text"] and out[0]["n_turns"] == 3


def test_debate(spark):
    schema = "session_title string, utterances array<struct<speaker:string,text:string>>"
    out = cleaners.debate(spark.createDataFrame([("S", [("A", "one two three four " * 80), (None, "too short")]), ("S", []), ("S", [("A", "x")])], schema)).collect()
    assert [r["rule"] for r in out] == [None, "empty_utterances", "no_speeches_retained"] and out[0]["n_speeches"] == 1


def test_adapters(spark):
    df = spark.createDataFrame([("T", "Body", [("A1",), (" ",), (None,)], None), (None, None, None, "cc")], "title string, question_body string, answers array<struct<body:string>>, license string")
    a = adapters.adapt(df, "thread").collect()
    assert a[0]["raw_text"] == "<QUESTION_TITLE>\nT\n</QUESTION_TITLE>\n\n<QUESTION_BODY>\nBody\n</QUESTION_BODY>\n\n<ANSWER>\nA1\n</ANSWER>" and a[0]["license_status"] == "missing"
    assert a[1]["raw_text"] == "" and a[1]["metadata"]["license"] == "cc"
    pr = spark.createDataFrame([("T", "B", [("c", "x")], True)], "title string, body string, comments array<struct<body:string,author:string>>, is_pull_request boolean")
    assert "<REVIEW_COMMENT>\nc\n</REVIEW_COMMENT>" in adapters.adapt(pr, "technical").first()["raw_text"]
    web = spark.createDataFrame([("", "inner", "u")], "text string, content string, url string")
    r = adapters.adapt(web, "web").first()
    assert r["raw_text"] == "inner" and r["metadata"]["url"] == "u" and r["license_status"] == "missing"
    names = spark.createDataFrame([("peS2o",), ("my_github",), ("other",)], "s string")
    assert [r[0] for r in names.select(adapters.adapter_of(F.col("s"))).collect()] == ["scientific", "technical", "web"]
    assert names.select(adapters.adapter_of(F.col("s"), ignore_case=False)).first()[0] == "web"
