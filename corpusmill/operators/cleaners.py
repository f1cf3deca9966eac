"""Cleaners of particular kinds of sources: strip what is no content, then the first rule a text breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import SPACE, WORD, WORD_START, line_count, lines_of_at_most, ratio, strip, word_count
from corpusmill.operators.running import even_buckets, running

# The patterns of what is stripped or rejected.
WIKI_NAMESPACE = r"(?i)^(?:talk|user|wikipedia|file|mediawiki|template|help|category|portal|draft|timedtext|module|talk_page|disambiguation):"
WIKI_PROJECTS = ("wikipedia", "wikibooks", "wikiversity", "wikivoyage", "wikinews")
WIKI_TAIL = rf"(?is)\n==+[{SPACE}]*(?:References|External[{SPACE}]+links|Further[{SPACE}]+reading|Bibliography|Sources|See[{SPACE}]+also)[{SPACE}]*==+.*\z"
BOOK_START = r"(?i)\*\*\*\s*START OF (?:THIS|THE) PROJECT GUTENBERG EBOOK[^\n]*?\*\*\*"
BOOK_END = r"(?i)\*\*\*\s*END OF (?:THIS|THE) PROJECT GUTENBERG EBOOK[^\n]*?\*\*\*"
BROKEN_WORD = r"([a-zA-Z]+)-\n([a-z]+)"
INNER_DIGIT = r"[a-zA-Z]\p{Nd}+[a-zA-Z]"
SCIENCE_TAIL = rf"(?is)\n(?:#+[{SPACE}]*|\\section\*?\{{?)?[{SPACE}]*(?:References|Bibliography|Acknowledgements|Funding|Author[{SPACE}]+Contributions|Supplementary[{SPACE}]+Material).*\z"
DISPLAY_MATH = r"(?s)\\\[(.*?)\\\]|\$\$(.*?)\$\$|\\begin\{equation\}(.*?)\\end\{equation\}"
#: By kind of source: lines from such a phrase to their end are removed.
BOILERPLATE = {
    "books": r"(?i)(?:Table of Contents|Publisher Advertisement|Downloaded from)[^\n]*?\n",
    "educational": r"(?i)(?:Download PDF|Donate to LibreTexts|Back to top|Edit page)[^\n]*?\n",
    "government_legal": r"(?i)(?:Docket No\.|FOR FURTHER INFORMATION CONTACT:|Page \p{Nd}+ of \p{Nd}+)[^\n]*?\n",
    "technical": r"(?m)^(?:PEP:|Title:|Author:|Status:|Type:|Created:)[^\n]*?\n",
}
BOTS = r"(?i)dependabot|stale\[bot\]|codecov-commenter|github-actions\[bot\]"
BASE64 = r"[A-Za-z0-9+/]{100,}={0,2}"
STACK_TRACE = r"(?s)Traceback \(most recent call last\):.*?\n[^\t-\r ]+"
CODE_BLOCK = r"(?s)```.*?```"
#: Words a text must keep, by kind of source.
MIN_WORDS = {"wikimedia": 64, "books": 1024, "ocr": 1024, "book_segment": 512, "paper": 512, "abstracts": 256, "lesson": 512, "catalogue": 256, "government_legal": 256, "technical": 256, "debate": 256, "thread": 128, "issue": 96}
HOST_QUOTA = 2_250_000
SITE_QUOTA = 30_000_000


# --- hosts and quotas


def hostname(url: Column) -> Column:
    """The authority of a link, lower-cased, with user and port; unknown where there is none."""
    full = F.when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit("http://"), url))
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(full, r"^https?://([^/?#]*)", 1)), F.lit("")), F.lit("unknown"))


def quota_rule(df: DataFrame, key: str, order: str, size: Column, passes: Column, cap: int, out: str = "over_quota") -> DataFrame:
    """df with `out`: whether the rows of key before this one, in order (a whole number), that pass already sum up to cap."""
    n = F.when(passes, size).otherwise(0)
    d = running(df, key, even_buckets(df, order), [order], {"_before": ("sum", n)})
    return d.withColumn(out, F.col("_before") >= cap).drop("_before")


# --- web pages


def with_web_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """df with prose_paragraphs (of ten words or more), short_line_ratio (under four words) and link_ratio."""
    t = F.coalesce(F.col(text), F.lit(""))
    prose = F.size(F.filter(F.split(t, "\n\n"), lambda p: word_count(p) >= 10))
    return df.withColumns({
        "prose_paragraphs": prose,
        "short_line_ratio": ratio(lines_of_at_most(t, 3), line_count(t)),
        "link_ratio": ratio(F.regexp_count(t, F.lit(rf"{WORD_START}(?:https?://|www\.)")), word_count(t)),
    })


def web_rule() -> Column:
    return (
        F.when(F.col("prose_paragraphs") < 3, "insufficient_prose_paragraphs")
        .when(F.col("short_line_ratio") > 0.30, "too_many_short_lines")
        .when(F.col("link_ratio") > 0.20, "too_many_url_tokens")
    )


def web_clean(df: DataFrame, order: str, text: str = "text", url: str = "url", cap: int = HOST_QUOTA) -> DataFrame:
    """df with host, the web metrics and `rule`; a host over its quota of accepted words takes precedence."""
    d = with_web_metrics(df, text).withColumn("host", hostname(F.col(url))).withColumn("_r", web_rule())
    d = quota_rule(d, "host", order, word_count(text), F.col("_r").isNull() & (F.coalesce(F.col(text), F.lit("")) != ""), cap)
    why = F.when(F.coalesce(F.col(text), F.lit("")) == "", "empty_text").when(F.col("over_quota"), "hostname_quota_exceeded").otherwise(F.col("_r"))
    return d.withColumn("rule", why).drop("_r", "over_quota")


# --- encyclopedias, books, papers, lessons, laws, proposals


def wiki_title_rule(title: Column) -> Column:
    t = F.coalesce(title, F.lit(""))
    low = F.lower(t)
    return F.when(strip(t).rlike(WIKI_NAMESPACE), "disallowed_namespace").when(F.contains(low, F.lit("disambiguation")) | low.startswith("list of "), "list_or_disambiguation")


def wiki_project_rule(project: Column) -> Column:
    """Breaks disallowed_project unless the project, case aside, is one of the kept ones; null counts as the encyclopedia."""
    return F.when(~F.lower(F.coalesce(project, F.lit(WIKI_PROJECTS[0]))).isin(*WIKI_PROJECTS), "disallowed_project")


def wiki_strip(text: Column) -> Column:
    """Without everything from the first heading of references, links or further reading on."""
    return strip(F.regexp_replace(text, WIKI_TAIL, ""))


def book_strip(text: Column) -> Column:
    """What lies between the start and end marks of a digitised book, stripped."""
    a = F.regexp_extract(text, rf"(?s)\A.*?{BOOK_START}", 0)
    rest = F.substring(text, F.length(a) + 1, F.length(text))
    b = F.regexp_extract(rest, rf"(?s)\A(.*?){BOOK_END}", 1)
    return strip(F.when(rest.rlike(BOOK_END), b).otherwise(rest))


def rejoin_words(text: Column) -> Column:
    """Words broken by a hyphen at the end of a line, put together."""
    return F.regexp_replace(text, BROKEN_WORD, "$1$2")


def inner_digit_ratio(text: Column) -> Column:
    """The share of words with digits between letters, a mark of bad character recognition."""
    # a word once, however many such places it has
    return ratio(F.regexp_count(text, F.lit(rf"{WORD_START}[^{SPACE}]*?{INNER_DIGIT}[^{SPACE}]*+")), word_count(text))


def science_strip(text: Column) -> Column:
    """Without everything from the first line that begins with references, funding and the like on."""
    return F.regexp_replace(text, SCIENCE_TAIL, "")


def tag_equations(text: Column) -> Column:
    """Displayed equations between <EQUATION> tags, their bodies stripped."""
    t = F.regexp_replace(text, DISPLAY_MATH, "\n<EQUATION>\n$1$2$3\n</EQUATION>\n")
    t = F.regexp_replace(t, rf"<EQUATION>\n[{SPACE}]*", "<EQUATION>\n")
    return F.regexp_replace(t, rf"[{SPACE}]*\n</EQUATION>", "\n</EQUATION>")


def boilerplate_strip(text: Column, kind: str) -> Column:
    return F.regexp_replace(text, BOILERPLATE[kind], "")


def catalogue_rule(text: Column) -> Column:
    """A catalogue entry instead of a lesson."""
    stub = F.contains(text, F.lit("Catalog Record")) | F.contains(text, F.lit("Resource Description:"))
    return F.when(stub & (word_count(text) < 300), "catalogue_stub").when(word_count(text) < MIN_WORDS["catalogue"], "below_min_length")


def clean_by_category(df: DataFrame, text: str = "text", title: str = "title", category: str = "category") -> DataFrame:
    """df with cleaned_text, n_words_clean and `rule` by category: encyclopedias, books, papers, lessons, laws and
    proposals each with their own strip and minimum; other categories pass as they are. Empty texts break empty_text."""
    t, cat = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(category), F.lit(""))
    cleaned = (
        F.when(cat == "wikimedia", wiki_strip(t))
        .when(cat == "books", boilerplate_strip(rejoin_words(book_strip(t)), "books"))
        .when(cat == "scientific", tag_equations(science_strip(t)))
        .when(cat == "educational", boilerplate_strip(t, "educational"))
        .when(cat == "government_legal", boilerplate_strip(t, "government_legal"))
        .when(cat == "technical", boilerplate_strip(t, "technical"))
        .otherwise(t)
    )
    d = df.withColumn("cleaned_text", cleaned).withColumn("n_words_clean", word_count("cleaned_text"))
    least = F.lit(0)
    for c, k in (("wikimedia", "wikimedia"), ("books", "book_segment"), ("scientific", "abstracts"), ("educational", "catalogue"), ("government_legal", "government_legal"), ("technical", "technical")):
        least = F.when(cat == c, MIN_WORDS[k]).otherwise(least)
    why = F.when(t == "", "empty_text").when((cat == "wikimedia") & wiki_title_rule(F.col(title)).isNotNull(), wiki_title_rule(F.col(title))).when(F.col("n_words_clean") < least, "below_min_length")
    return d.withColumn("rule", why)


#: Parts of source names, in the order they are tried, the strip they call for and the words a text must keep.
SOURCE_CLEANERS = (
    (("wikimedia",), "wiki", 64),
    (("gutenberg",), "book", 1024),
    (("pre_1929",), "ocr", 1024),
    (("doab", "pressbooks"), "books", 512),
    (("arxiv",), "equations", 512),
    (("pes2o",), "science", 512),
    (("pubmed",), "science", 256),
    (("libretexts",), "educational", 512),
    (("oercommons",), "none", 256),
    (("usgpo", "regulations", "caselaw"), "government_legal", 256),
    (("pep", "python_enhancement"), "technical", 256),
)
MAX_INNER_DIGITS = 0.15


def clean_by_source(df: DataFrame, text: str = "text", title: str = "title", source: str = "source") -> DataFrame:
    """df with cleaned_text, n_words_clean and `rule` by parts of the source's name, case aside; other sources pass as they are."""
    t, name = F.coalesce(F.col(text), F.lit("")), F.lower(F.coalesce(source, F.lit("")))
    strips = {
        "wiki": wiki_strip(t), "book": book_strip(t), "ocr": rejoin_words(t), "equations": tag_equations(science_strip(t)), "science": science_strip(t), "none": t,
        **{k: boilerplate_strip(t, k) for k in BOILERPLATE},
    }
    kind, cleaned, least = F.lit("other"), t, F.lit(0)
    for parts, strip_, n in reversed(SOURCE_CLEANERS):
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(name, F.lit(p))
        cleaned, least = F.when(hit, strips[strip_]).otherwise(cleaned), F.when(hit, n).otherwise(least)
        kind = F.when(hit, "catalogue" if strip_ == "none" else strip_).otherwise(kind)
    d = df.withColumn("_kind", kind).withColumn("cleaned_text", cleaned).withColumn("n_words_clean", word_count("cleaned_text"))
    stub = F.when(F.col("_kind") == "catalogue", catalogue_rule(F.col("cleaned_text")))
    why = (
        F.when(t == "", "empty_text")
        .when((F.col("_kind") == "wiki") & wiki_title_rule(F.col(title)).isNotNull(), wiki_title_rule(F.col(title)))
        .when((F.col("_kind") == "ocr") & (inner_digit_ratio(F.col("cleaned_text")) > MAX_INNER_DIGITS), "inner_digits_exceeded")
        .when(stub == "catalogue_stub", "catalogue_stub")
        .when(F.col("n_words_clean") < least, "below_min_length")
    )
    return d.withColumn("rule", why).drop("_kind")


# --- threads


def _tag(name: str, body: Column) -> Column:
    return F.concat(F.lit(f"<{name}>\n"), body, F.lit(f"\n</{name}>"))


def answer_thread(df: DataFrame) -> DataFrame:
    """df (title, question_body, answers array<struct<body,score,is_accepted,comments array<struct<text>>>>, site_name) with
    thread_text, n_answers and `rule`.

    Answers come accepted first, then by score, in their given order among ties; at most 20 of ten words or more, with at
    most 40 comments each of six words or more, or that speak of a correction.
    """
    blank = F.lit("")
    order = F.transform("answers", lambda a, i: F.struct((F.coalesce(a["is_accepted"], F.lit(False)).cast("int") * -1).alias("k1"), (F.coalesce(a["score"], F.lit(0)) * -1).alias("k2"), i.alias("i"), strip(F.coalesce(a["body"], blank)).alias("body"), a["comments"].alias("comments")))
    best = F.filter(F.slice(F.array_sort(order), 1, 20), lambda a: word_count(a["body"]) >= 10)

    def comments(a: Column) -> Column:
        texts = F.transform(F.slice(F.coalesce(a["comments"], F.array().cast("array<struct<text:string>>")), 1, 40), lambda c: strip(F.coalesce(c["text"], blank)))
        return F.filter(texts, lambda t: (word_count(t) >= 6) | F.contains(F.lower(t), F.lit("correct")) | F.contains(F.lower(t), F.lit("fix")))

    d = df.withColumn("_best", F.coalesce(best, F.array().cast("array<struct<k1:int,k2:int,i:int,body:string,comments:array<struct<text:string>>>>")))
    parts = F.flatten(F.transform("_best", lambda a: F.concat(F.array(_tag("ANSWER", a["body"])), F.transform(comments(a), lambda c: _tag("COMMENT", c)))))
    head = F.array(_tag("QUESTION_TITLE", strip(F.coalesce("title", blank))), _tag("QUESTION_BODY", strip(F.coalesce("question_body", blank))))
    d = d.withColumn("thread_text", F.array_join(F.concat(head, parts), "\n\n")).withColumn("n_answers", F.size("_best"))
    n = word_count("thread_text")
    why = (
        F.when(F.contains(F.lower(F.coalesce("site_name", blank)), F.lit("meta")), "disallowed_meta_site")
        .when(word_count("question_body") < 20, "empty_or_short_question_body")
        .when(F.coalesce(F.size("answers"), F.lit(0)) <= 0, "no_answers_in_thread")
        .when(F.col("n_answers") == 0, "no_substantive_answers_retained")
        .when(n < MIN_WORDS["thread"], "thread_below_min_length")
    )
    cut = F.array_join(F.slice(F.regexp_extract_all("thread_text", F.lit(WORD), F.lit(0)), 1, 12288), " ")
    return d.withColumn("rule", why).withColumn("thread_text", F.when(n > 12288, cut).otherwise(F.col("thread_text"))).drop("_best")


def issue_thread(df: DataFrame) -> DataFrame:
    """df (title, body, comments array<struct<body,author>>, is_pull_request) with thread_text, n_turns, code_ratio and `rule`.

    Comments of bots and blank ones are left out; long encoded blocks and stack traces are replaced.
    """
    blank = F.lit("")
    pr = F.coalesce(F.col("is_pull_request"), F.lit(False))
    kept = F.filter("comments", lambda c: ~F.coalesce(c["author"], blank).rlike(BOTS))
    kept = F.filter(F.transform(kept, lambda c: strip(F.coalesce(c["body"], blank))), lambda b: b != "")
    kept = F.transform(kept, lambda b: F.regexp_replace(F.regexp_replace(b, BASE64, "[BASE64_BINARY_REMOVED]"), STACK_TRACE, "[STACK_TRACE_REMOVED]"))
    d = df.withColumn("_c", F.coalesce(kept, F.array().cast("array<string>")))
    head = lambda k: F.when(pr, _tag(f"PULL_REQUEST_{k}", strip(F.coalesce(k.lower(), blank)))).otherwise(_tag(f"ISSUE_{k}", strip(F.coalesce(k.lower(), blank))))
    parts = F.transform("_c", lambda b: F.when(pr, _tag("REVIEW_COMMENT", b)).otherwise(_tag("COMMENT", b)))
    d = d.withColumn("thread_text", F.array_join(F.concat(F.array(head("TITLE"), head("BODY")), parts), "\n\n")).withColumn("n_turns", F.size("_c") + 1)
    total = word_count("title") + word_count("body") + F.aggregate("_c", F.lit(0), lambda a, b: a + word_count(b))
    code = F.aggregate(F.flatten(F.transform("_c", lambda b: F.regexp_extract_all(b, F.lit(CODE_BLOCK), F.lit(0)))), F.lit(0), lambda a, b: a + word_count(b))
    d = d.withColumn("n_words", total).withColumn("code_ratio", ratio(code, total))
    why = (
        F.when(F.coalesce("title", blank).rlike(BOTS) | F.coalesce("body", blank).rlike(BOTS), "bot_generated_thread")
        .when(F.col("n_turns") < 2, "insufficient_turns")
        .when(F.col("code_ratio") > 0.60, "code_ratio_exceeded")
        .when(F.col("n_words") < MIN_WORDS["issue"], "thread_below_min_length")
    )
    return d.withColumn("rule", why).drop("_c")


def debate(df: DataFrame) -> DataFrame:
    """df (session_title, utterances array<struct<speaker,text>>) with debate_text, n_speeches and `rule`; speeches have four words or more."""
    blank = F.lit("")
    said = F.filter(F.transform("utterances", lambda u: F.struct(strip(F.coalesce(u["speaker"], F.lit("SPEAKER"))).alias("speaker"), strip(F.coalesce(u["text"], blank)).alias("text"))), lambda u: word_count(u["text"]) >= 4)
    d = df.withColumn("_u", F.coalesce(said, F.array().cast("array<struct<speaker:string,text:string>>")))
    parts = F.transform("_u", lambda u: F.concat(F.lit("<SPEAKER>"), u["speaker"], F.lit("</SPEAKER>\n"), _tag("UTTERANCE", u["text"])))
    d = d.withColumn("debate_text", F.array_join(F.concat(F.array(_tag("SESSION", strip(F.coalesce("session_title", blank)))), parts), "\n\n")).withColumn("n_speeches", F.size("_u"))
    why = F.when(F.coalesce(F.size("utterances"), F.lit(0)) <= 0, "empty_utterances").when(F.col("n_speeches") == 0, "no_speeches_retained").when(word_count("debate_text") < MIN_WORDS["debate"], "debate_below_min_length")
    return d.withColumn("rule", why).drop("_u")
