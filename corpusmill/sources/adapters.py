"""Source adapters: raw records of any source as (text, license, metadata)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import first_of, strip

#: Parts of source names, in the order they are tried, and the adapter they stand for.
DISPATCH = (
    ("thread", ("stackexchange",)),
    ("technical", ("github", "pep", "python_enhancement")),
    ("scientific", ("arxiv", "pes2o", "pubmed")),
    ("books", ("gutenberg", "doab", "pre_1929", "pressbooks")),
    ("wikimedia", ("wikimedia",)),
    ("web", ("cccc",)),
    ("educational", ("libretexts", "oercommons")),
    ("government_legal", ("hansard", "usgpo", "regulations", "caselaw")),
)
MAX_ANSWERS = 20


def adapter_of(source: Column, ignore_case: bool = True) -> Column:
    """The adapter of a source by its name; web for all others. ignore_case=False compares letters as they are."""
    s = F.lower(source) if ignore_case else source
    out = None
    for name, parts in DISPATCH:
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(s, F.lit(p))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("web")


def _or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def license_of(df: DataFrame) -> Column:
    """`license`, or `licence` where the first column is absent; missing where it is null or empty."""
    return first_of(_or_null(df, "license" if "license" in df.columns else "licence"), F.lit("missing"))


def _tagged(name: Column, body: Column) -> Column:
    return F.concat(F.lit("<"), name, F.lit(">\n"), body, F.lit("\n</"), name, F.lit(">"))


def thread_text(df: DataFrame) -> Column:
    """Title, question and the first answers (array<struct<body>>) between tags; the raw text without a question."""
    title = strip(F.coalesce(_or_null(df, "title"), F.lit("")))
    body = strip(F.coalesce(first_of(_or_null(df, "question_body"), _or_null(df, "body"), _or_null(df, "text")), F.lit("")))
    parts = F.array(_tagged(F.lit("QUESTION_TITLE"), title), _tagged(F.lit("QUESTION_BODY"), body))
    if "answers" in df.columns:
        texts = F.filter(F.transform(F.slice("answers", 1, MAX_ANSWERS), lambda a: strip(F.coalesce(a["body"], F.lit("")))), lambda x: x != "")
        parts = F.concat(parts, F.coalesce(F.transform(texts, lambda x: _tagged(F.lit("ANSWER"), x)), F.array().cast("array<string>")))
    return F.when(body != "", F.array_join(parts, "\n\n")).otherwise(F.coalesce(_or_null(df, "text"), F.lit("")))


def issue_text(df: DataFrame) -> Column:
    """Title, body and comments (array<struct<body>>) of an issue or pull request between tags; the raw text without a body."""
    pr = F.coalesce(_or_null(df, "is_pull_request", "boolean"), F.lit(False))
    title = strip(F.coalesce(_or_null(df, "title"), F.lit("")))
    body = strip(F.coalesce(first_of(_or_null(df, "body"), _or_null(df, "text")), F.lit("")))
    kind = F.when(pr, "PULL_REQUEST_").otherwise("ISSUE_")
    parts = F.array(_tagged(F.concat(kind, F.lit("TITLE")), title), _tagged(F.concat(kind, F.lit("BODY")), body))
    if "comments" in df.columns:
        texts = F.filter(F.transform("comments", lambda c: strip(F.coalesce(c["body"], F.lit("")))), lambda x: x != "")
        name = F.when(pr, "REVIEW_COMMENT").otherwise("COMMENT")
        parts = F.concat(parts, F.coalesce(F.transform(texts, lambda x: _tagged(name, x)), F.array().cast("array<string>")))
    return F.when(body != "", F.array_join(parts, "\n\n")).otherwise(F.coalesce(_or_null(df, "text"), F.lit("")))


def debate_text(df: DataFrame) -> Column:
    """Session title and utterances (array<struct<speaker,text>>) between tags; the raw text without utterances."""
    plain = plain_text(df)
    if "utterances" not in df.columns:
        return plain
    title = first_of(_or_null(df, "session_title"), _or_null(df, "title"), F.lit("Hansard Debate"))
    said = F.filter(F.transform("utterances", lambda u: F.struct(F.coalesce(u["speaker"], F.lit("SPEAKER")).alias("s"), strip(F.coalesce(u["text"], F.lit(""))).alias("t"))), lambda u: u["t"] != "")
    parts = F.transform(said, lambda u: F.concat(F.lit("<SPEAKER>"), u["s"], F.lit("</SPEAKER>\n"), _tagged(F.lit("UTTERANCE"), u["t"])))
    return F.when(F.size("utterances") > 0, F.array_join(F.concat(F.array(_tagged(F.lit("SESSION"), title)), parts), "\n\n")).otherwise(plain)


def plain_text(df: DataFrame) -> Column:
    return F.coalesce(first_of(_or_null(df, "text"), _or_null(df, "content")), F.lit(""))


def paper_text(df: DataFrame) -> Column:
    return F.coalesce(first_of(_or_null(df, "text"), _or_null(df, "abstract"), _or_null(df, "content")), F.lit(""))


_TEXT = {"thread": thread_text, "technical": issue_text, "scientific": paper_text, "government_legal": debate_text}
_META = {
    "thread": (("title", ("title",)), ("url", ("url",)), ("site", ("site",))),
    "technical": (("title", ("title",)), ("url", ("url",)), ("repo", ("repo",))),
    "scientific": (("title", ("title",)), ("url", ("url", "arxiv_id")), ("field_family", ("field_family", "field"))),
    "books": (("title", ("title",)), ("book_id", ("book_id", "id"))),
    "wikimedia": (("title", ("title",)), ("subproject", ("subproject", "wiki"))),
    "web": (("url", ("url", "domain")), ("title", ("title",))),
}


def adapt(df: DataFrame, adapter: str) -> DataFrame:
    """df with raw_text, license_status and metadata (map) by the named adapter; absent columns count as null."""
    meta = [F.lit("license"), license_of(df)]
    for key, columns in _META.get(adapter, (("title", ("title",)),)):
        found = [c for c in columns if c in df.columns]
        meta += [F.lit(key), F.coalesce(F.col(found[0]).cast("string"), F.lit("")) if found else F.lit("")]
    return df.withColumns({"raw_text": _TEXT.get(adapter, plain_text)(df), "license_status": license_of(df), "metadata": F.create_map(*meta)})
