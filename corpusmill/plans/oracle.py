"""DuckDB SQL of the same names and columns as the queries."""

from __future__ import annotations

import numpy as np

from corpusmill.plans.queries import PIECES, POOL_WORDS, SCAN_WORDS, SOURCE_NAMES, TITLES, VOCAB

SP = r"\t-\r\x1c-\x1f \x85\p{Z}"
WORD = rf"[^{SP}]+"

# The patterns and tables of the rules, stated here apart from the operators.
CONTROLS = r"[\x00\x{200b}\x{200e}\x{200f}\x{202a}-\x{202e}\x{e000}-\x{f8ff}]"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = rf"\+?\p{{Nd}}{{1,4}}[-.{SP}]?(?:\(\p{{Nd}}{{1,3}}\)|\p{{Nd}}{{1,3}})[-.{SP}]?\p{{Nd}}{{1,4}}[-.{SP}]?\p{{Nd}}{{1,9}}"
IPV4 = r"\b(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}\b"
IPV6 = r"\b(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}\b"
API_KEY = r"\b(?:sk-[a-zA-Z0-9]{32,}|AKIA[0-9A-Z]{16}|ghp_[a-zA-Z0-9]{36})\b"
PRIVATE_KEY = rf"-----BEGIN[{SP}]+(?:RSA|DSA|EC|OPENSSH|PGP)?[{SP}]*PRIVATE[{SP}]+KEY-----"
UNPRINTABLE = r"[^\P{C}\n\r\t]|[^\P{Z} ]"
ENGLISH_WORD = r"^[A-Za-z!-/:-@\[-`{-~]+$"
PUNCTUATION_ONLY = r"^[!-/:-@\[-`{-~]*$"
WIKI_NAMESPACE = r"(?i)^(?:talk|user|wikipedia|file|mediawiki|template|help|category|portal|draft|timedtext|module|talk_page|disambiguation):"
WIKI_TAIL = rf"(?is)\n==+[{SP}]*(?:References|External[{SP}]+links|Further[{SP}]+reading|Bibliography|Sources|See[{SP}]+also)[{SP}]*==+.*\z"
SCIENCE_TAIL = rf"(?is)\n(?:#+[{SP}]*|\\section\*?\{{?)?[{SP}]*(?:References|Bibliography|Acknowledgements|Funding|Author[{SP}]+Contributions|Supplementary[{SP}]+Material).*\z"
BROKEN_WORD, INNER_DIGIT = r"([a-zA-Z]+)-\n([a-z]+)", r"[a-zA-Z]\p{Nd}+[a-zA-Z]"
DISPLAY_MATH = r"(?s)\\\[(.*?)\\\]|\$\$(.*?)\$\$|\\begin\{equation\}(.*?)\\end\{equation\}"
BOILERPLATE = {
    "books": r"(?i)(?:Table of Contents|Publisher Advertisement|Downloaded from)[^\n]*?\n",
    "educational": r"(?i)(?:Download PDF|Donate to LibreTexts|Back to top|Edit page)[^\n]*?\n",
    "government_legal": r"(?i)(?:Docket No\.|FOR FURTHER INFORMATION CONTACT:|Page \p{Nd}+ of \p{Nd}+)[^\n]*?\n",
    "technical": r"(?m)^(?:PEP:|Title:|Author:|Status:|Type:|Created:)[^\n]*?\n",
}
BOTS = r"(?i)dependabot|stale\[bot\]|codecov-commenter|github-actions\[bot\]"
BASE64, STACK_TRACE, CODE_BLOCK = r"[A-Za-z0-9+/]{100,}={0,2}", r"(?s)Traceback \(most recent call last\):.*?\n[^\t-\r ]+", r"(?s)```.*?```"
CATEGORY_RANK = {"books": 0.95, "scientific": 0.90, "educational": 0.85, "wikimedia": 0.80, "government_legal": 0.75, "technical": 0.70, "discussion": 0.65, "web": 0.50}
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\t-\r \p{L}\p{N}]+|[\t-\r ]+"



def q(s: str) -> str:
    """A string literal."""
    return "'" + s.replace("'", "''") + "'"


def ws(x: str) -> str:
    return f"regexp_extract_all({x}, {q(WORD)})"


def nw(x: str) -> str:
    return f"coalesce(len({ws(x)}), 0)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(rf'\A[{SP}]+|[{SP}]+\z')}, '', 'g')"


def lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"


def rsub(x: str, p: str, r: str) -> str:
    return f"regexp_replace({x}, {q(p)}, {r if r.startswith(('chr(', '(')) else q(r)}, 'g')"


def count(x: str, p: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, {q(p)})), 0)"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a})::DOUBLE / ({b}) END"


def join_ids(x: str) -> str:
    return f"coalesce(array_to_string({x}, ','), '')"


def hash63(x: str) -> str:
    return f"(('0x' || substr(sha256({x}), 1, 8))::BIGINT & 2147483647) * 4294967296 + ('0x' || substr(sha256({x}), 9, 8))::BIGINT"


def priority(source: str, id_: str) -> str:
    return hash63(f"concat_ws(':', 'v0', coalesce({source}, ''), {id_}, '42')")


CONF = """conf AS (SELECT lower(trim(name)) AS name, (min({'category': category, 'min_doc_length': min_doc_length, 'min_english_prob': min_english_prob})) AS x FROM source_config GROUP BY 1),
cat AS (SELECT d.*, x.category AS category, coalesce(x.min_doc_length, 128) AS min_words, coalesce(x.min_english_prob, 0.5) AS min_english FROM documents d LEFT JOIN conf ON lower(trim(d.source)) = conf.name)"""
QUOTA = "SELECT lower(trim(name)) AS source, floor(coalesce(share, quota_3b_tokens / 3e9) * {n})::BIGINT AS quota FROM source_config GROUP BY ALL"
SHARE = "SELECT DISTINCT lower(trim(name)) AS source, coalesce(share, quota_3b_tokens / 3e9) AS share FROM source_config"
TOK = """tok AS (SELECT document_id, parent_document_id, source, coalesce(s, 'none') AS split, token_ids, paragraph_token_spans
  FROM (SELECT *, CASE WHEN lower(trim(split)) = 'val' THEN 'validation' WHEN trim(split) <> '' THEN lower(trim(split)) END AS s FROM tokenized_docs)
  QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY s IS NULL, parent_document_id NULLS FIRST, source NULLS FIRST, s, token_ids NULLS FIRST) = 1)"""

_LIST = lambda xs: "[" + ", ".join(q(x) for x in xs) + "]"
#: documents with a planted end and title, by the id.
PLANTED = f"(SELECT * REPLACE (text || {_LIST(PIECES)}[doc_id % {len(PIECES)} + 1] AS text, {_LIST(TITLES)}[doc_id % {len(TITLES)} + 1] || coalesce(title, '') AS title) FROM documents)"

SQL: dict[str, str] = {}

# --- identity
SQL["doc_priority"] = f"SELECT doc_id, source, {priority('source', 'doc_id')} AS priority FROM documents"
SQL["doc_identity"] = "SELECT doc_id, sha256(coalesce(text, '')) AS raw_text_hash, substr(sha256(concat_ws(':', coalesce(source, ''), 'unresolved:main', doc_id, sha256(coalesce(text, '')))), 1, 32) AS document_id FROM documents"
SQL["token_counts_by_source"] = f"SELECT source, count(*) AS n_docs, sum({nw('text')})::BIGINT AS n_tokens FROM documents GROUP BY 1"
SQL["source_quotas"] = f"SELECT source, quota, floor(quota * 1.35::DOUBLE)::BIGINT AS pool FROM ({QUOTA.format(n=3_000_000)})"
SQL["revision_status"] = "SELECT DISTINCT name, revision, CASE WHEN regexp_matches(coalesce(revision, ''), '^[0-9a-fA-F]{40}$') THEN 'pinned_sha' ELSE 'unresolved_fallback' END AS status FROM source_config"
SQL["sanitized_keys"] = "SELECT DISTINCT source, translate(source, '/-.', '___') AS key FROM documents"

# --- ingest and pools
_SCAN = f"""sh AS ({SHARE}), b AS (SELECT source, floor(share * {SCAN_WORDS} * 1.35::DOUBLE)::BIGINT AS budget FROM sh),
s0 AS (SELECT d.doc_id, b.source, budget, least(budget, greatest(2048, floor(budget * 0.5::DOUBLE)::BIGINT)) AS cap, {nw('text')} AS n FROM documents d JOIN b ON lower(trim(d.source)) = b.source),
s1 AS (SELECT *, (n > 0 AND n <= cap)::INT AS good, (n > cap)::INT AS over_ FROM s0),
s2 AS (SELECT *, row_number() OVER w AS scanned, sum(over_) OVER w AS overs, sum(good * n) OVER w AS toks FROM s1 WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING)),
s3 AS (SELECT *, CASE WHEN n = 0 THEN 'blank' WHEN good = 1 THEN 'balanced' WHEN overs = 1 THEN 'probe' ELSE 'oversized' END AS status, greatest(overs - 1, 0) AS skips FROM s2),
s4 AS (SELECT *, skips - coalesce(max(CASE WHEN status = 'balanced' THEN skips ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING), 0) AS run FROM s3),
s5 AS (SELECT *, CASE WHEN status IN ('balanced', 'probe') AND toks >= budget THEN 'budget_reached' WHEN status = 'oversized' AND run >= 5 THEN 'consecutive_oversized_limit' END AS why FROM s4),
e AS (SELECT source, min(doc_id) AS fin FROM s5 WHERE why IS NOT NULL GROUP BY 1),
kept AS (SELECT s5.* FROM s5 LEFT JOIN e USING (source) WHERE fin IS NULL OR doc_id <= fin)"""
SQL["bounded_scan_kept"] = f"WITH {_SCAN} SELECT doc_id, source, n AS n_tokens, status FROM kept WHERE status IN ('balanced', 'probe')"
SQL["bounded_scan_counters"] = f"""WITH {_SCAN} SELECT source, count(*) AS scanned, count(*) FILTER (status = 'balanced') AS balanced, sum(CASE WHEN status = 'balanced' THEN n ELSE 0 END)::BIGINT AS tokens,
  count(*) FILTER (status = 'probe') AS probes, count(*) FILTER (status = 'oversized') AS oversized, coalesce(max(why), 'source_exhausted') AS stop_reason FROM kept GROUP BY 1"""
_FULL = _SCAN.replace(f"share * {SCAN_WORDS} *", "share * 3000000000::BIGINT *").replace("run >= 5 ", "run >= 100 ")
SQL["bounded_scan_full"] = f"WITH {_FULL} SELECT doc_id, source, n AS n_tokens, status FROM kept"
SQL["bounded_scan_full_counters"] = SQL["bounded_scan_counters"].replace(_SCAN, _FULL)
_POOL = f"""qt AS (SELECT source, floor(quota * 1.35::DOUBLE)::BIGINT AS pool FROM ({QUOTA.format(n=POOL_WORDS)})),
p AS (SELECT doc_id, lower(trim(d.source)) AS source, {priority('d.source', 'doc_id')} AS priority, {nw('text')} AS n_tokens, pool FROM documents d JOIN qt ON qt.source = lower(trim(d.source))),
p2 AS (SELECT *, (sum(n_tokens) OVER (PARTITION BY source ORDER BY priority, doc_id ROWS UNBOUNDED PRECEDING) - n_tokens)::BIGINT AS before FROM p)"""
SQL["select_pool"] = f"WITH {_POOL} SELECT doc_id, source, priority, n_tokens, before FROM p2 WHERE before < pool"
SQL["select_pool_full"] = f"WITH {_POOL.replace(QUOTA.format(n=POOL_WORDS), QUOTA.format(n='3000000000::BIGINT'))} SELECT doc_id, source, priority, before FROM p2 WHERE before < pool"
SQL["pool_counters"] = f"WITH {_POOL} SELECT source, count(*) AS n_docs, sum(n_tokens)::BIGINT AS n_tokens FROM p2 WHERE before < pool GROUP BY 1"
SQL["raw_text_fallback"] = "SELECT DISTINCT coalesce(nullif(source_record_id, ''), document_id) AS doc_id, 'canonical' AS source, md5(coalesce(nullif(normalized_text, ''), nullif(title, ''), '')) AS text_md5 FROM canonical_docs"

# --- normalisation
_CLEAN0 = rsub(rsub(f"regexp_replace(nfc_normalize(text), '\\r\\n?', chr(10), 'g')", CONTROLS, ""), r"\x{ad}{2,}", "­")
_CLEAN = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({_CLEAN0}, {q(r'[\x0b-\r\x1c-\x1f \x85\p{Z}]+')}, ' ', 'g'), '[ \\t]*\\n[ \\t]*', chr(10), 'g'), '\\A[ \\t]+|[ \\t]+\\z', '', 'g'), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')"
SQL["normalize_text"] = f"SELECT doc_id, md5(t) AS text_md5, length(t)::BIGINT AS n_chars FROM (SELECT doc_id, {_CLEAN} AS t FROM documents)"
SQL["ufffd_reject"] = f"SELECT doc_id, round(r, 6) AS ratio, r > 0.001 AS rejected FROM (SELECT doc_id, CASE WHEN length(text) > 0 THEN {count('text', r'\x{fffd}')}::DOUBLE / length(text) ELSE 0.0 END AS r FROM documents)"
_KINDS = [("api_key", [API_KEY], "<API_KEY>"), ("email", [EMAIL], "<EMAIL>"), ("ip", [IPV4, IPV6], "<IP>"), ("phone", [PHONE], "<PHONE>")]
for _k, _ps, _m in _KINDS:
    _n = count("text", _ps[0])
    _t = rsub("text", _ps[0], _m)
    if len(_ps) > 1:
        _n += " + " + count(_t, _ps[1])
        _t = rsub(_t, _ps[1], _m)
    SQL[f"redact_{_k}"] = f"SELECT doc_id, ({_n})::BIGINT AS n, md5({_t}) AS text_md5 FROM {PLANTED}"
_NORM = f"""n0 AS (SELECT doc_id, text, {_CLEAN} AS c FROM {PLANTED}),
n1 AS (SELECT *, {count('c', API_KEY)} AS n_api_key, {rsub('c', API_KEY, '<API_KEY>')} AS c1 FROM n0),
n2 AS (SELECT *, {count('c1', EMAIL)} AS n_email, {rsub('c1', EMAIL, '<EMAIL>')} AS c2 FROM n1),
n3 AS (SELECT *, {count('c2', IPV4)} AS n_ip4, {rsub('c2', IPV4, '<IP>')} AS c3 FROM n2),
n4 AS (SELECT *, n_ip4 + {count('c3', IPV6)} AS n_ip, {rsub('c3', IPV6, '<IP>')} AS c4 FROM n3),
n5 AS (SELECT *, {count('c4', PHONE)} AS n_phone, {rsub('c4', PHONE, '<PHONE>')} AS t FROM n4),
n6 AS (SELECT *, greatest({nw('t')}, 1) AS w FROM n5),
norm AS (SELECT *, CASE WHEN coalesce(text, '') = '' THEN 'empty_text' WHEN {count('text', r'\x{fffd}')}::DOUBLE / length(text) > 0.001 THEN 'fffd_ratio'
  WHEN regexp_matches(c, {q(PRIVATE_KEY)}) THEN 'private_key' WHEN w >= 50 AND n_email * 1000 > w * 20 THEN 'excessive_email' WHEN w >= 50 AND n_phone * 1000 > w * 20 THEN 'excessive_phone' END AS rejection FROM n6)"""
SQL["pii_counts"] = f"WITH {_NORM} SELECT doc_id, n_api_key, n_email, n_ip, n_phone FROM norm"
SQL["normalize_verdict"] = f"WITH {_NORM} SELECT doc_id, rejection, md5(t) AS text_md5 FROM norm"
SQL["pii_density_reject"] = f"WITH {_NORM} SELECT doc_id, rejection FROM norm WHERE rejection IN ('excessive_email', 'excessive_phone')"
SQL["private_key_reject"] = f"SELECT doc_id, coalesce(regexp_matches(text, {q(PRIVATE_KEY)}), false) AS rejected FROM {PLANTED}"
SQL["report_pii"] = f"WITH {_NORM} SELECT count(*) AS n_docs, sum(n_api_key + n_email + n_ip + n_phone)::BIGINT AS n_pii, sum(n_api_key)::BIGINT AS n_api_key, sum(n_email)::BIGINT AS n_email, sum(n_ip)::BIGINT AS n_ip, sum(n_phone)::BIGINT AS n_phone FROM norm"

# --- quality
_JUNK = f"regexp_full_match(x, '\\p{{Nd}}+') OR regexp_full_match(x, {q(PUNCTUATION_ONLY)}) OR {nw('x')} < 2"
_MET = f"""m0 AS (SELECT *, coalesce(text, '') AS t, {ws("coalesce(text, '')")} AS w, {lines("coalesce(text, '')")} AS l FROM cat),
m1 AS (SELECT *, list_sort(list_transform(list_filter(w, lambda x: NOT starts_with(x, 'http') AND NOT starts_with(x, '<')), lambda x: length(x))) AS ls FROM m0),
met AS (SELECT *, len(w)::BIGINT AS n_words, len(l)::BIGINT AS n_lines, {ratio(f"length(t) - {count('t', UNPRINTABLE)}", 'length(t)')} AS printable_ratio,
  {ratio(count('t', r'\p{L}'), 'length(t)')} AS alphabetic_ratio, {ratio(f"len(list_filter(w, lambda x: regexp_full_match(x, {q(ENGLISH_WORD)})))", 'len(w)')} AS english_ratio,
  {ratio('len(list_distinct(l))', 'len(l)')} AS unique_line_ratio, {ratio(f'len(list_filter(l, lambda x: {_JUNK}))', 'len(l)')} AS junk_line_ratio, ls[len(ls) // 2 + 1] AS median_word_length FROM m1)"""
_VERDICT = f"""{CONF}, {_MET}, verdict AS (SELECT *, CASE WHEN n_lines = 0 THEN 'empty_document' WHEN n_words < min_words THEN 'below_min_length' WHEN printable_ratio < 0.98 THEN 'low_printable_ratio'
  WHEN alphabetic_ratio < CASE WHEN category IN ('scientific', 'technical', 'government_legal') THEN 0.25 ELSE 0.40 END THEN 'low_alphabetic_ratio' WHEN english_ratio < min_english THEN 'low_english_probability'
  WHEN 1.0::DOUBLE - unique_line_ratio > 0.20::DOUBLE THEN 'high_duplicate_line_ratio' WHEN median_word_length > 15 THEN 'median_word_length_exceeded' WHEN junk_line_ratio > 0.30::DOUBLE THEN 'high_junk_line_ratio' END AS rule FROM met)"""
SQL["quality_metrics"] = f"WITH {CONF}, {_MET} SELECT doc_id, n_words, n_lines, round(printable_ratio, 6) AS printable_ratio, round(alphabetic_ratio, 6) AS alphabetic_ratio, round(english_ratio, 6) AS english_ratio, round(unique_line_ratio, 6) AS unique_line_ratio, round(junk_line_ratio, 6) AS junk_line_ratio FROM met"
SQL["median_word_length"] = f"WITH {CONF}, {_MET} SELECT doc_id, median_word_length::BIGINT AS median_word_length FROM met"
SQL["duplicate_lines"] = f"SELECT doc_id, (len(l) - len(list_distinct(l)))::BIGINT AS n_duplicates FROM (SELECT doc_id, {lines('text')} AS l FROM documents) WHERE len(l) > len(list_distinct(l))"
SQL["junk_lines"] = f"SELECT doc_id, len(j)::BIGINT AS n_junk FROM (SELECT doc_id, list_filter({lines('text')}, lambda x: {_JUNK}) AS j FROM documents) WHERE len(j) > 0"
SQL["quality_verdict"] = f"WITH {_VERDICT} SELECT doc_id, category, rule FROM verdict"
SQL["rejections_by_rule"] = f"WITH {_VERDICT} SELECT rule, count(*) AS n_docs FROM verdict GROUP BY 1"
SQL["report_quality"] = f"WITH {_VERDICT} SELECT rule, count(*) AS n_docs FROM verdict WHERE rule IS NOT NULL GROUP BY 1"

# --- cleaners
_HOST = "coalesce(nullif(lower(regexp_extract(CASE WHEN regexp_matches(u, '^https?://') THEN u ELSE 'http://' || u END, '^https?://([^/?#]*)', 1)), ''), 'unknown')"
SQL["hostname_extract"] = f"SELECT doc_id, {_HOST} AS host FROM (SELECT doc_id, coalesce(url, '') AS u FROM documents)"
SQL["hostname_quota"] = f"SELECT doc_id, site, coalesce(sum({nw('text')}) OVER (PARTITION BY site ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 2000 AS over_quota FROM documents"
SQL["site_quota"] = f"""SELECT source, count(*) FILTER (o) AS n_over, count(*) AS n_docs FROM (SELECT source, coalesce(sum(CASE WHEN n >= 96 THEN n ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 5000 AS o
  FROM (SELECT *, {nw('text')} AS n FROM documents WHERE source IS NOT NULL)) GROUP BY 1"""
_WEB = f"""w0 AS (SELECT *, coalesce(text, '') AS t, coalesce(url, '') AS u FROM documents),
w1 AS (SELECT *, len(list_filter(string_split(t, chr(10) || chr(10)), lambda x: {nw('x')} >= 10))::BIGINT AS prose_paragraphs, {lines('t')} AS l, {ws('t')} AS w FROM w0),
w2 AS (SELECT *, {ratio(f"len(list_filter(l, lambda x: {nw('x')} < 4))", 'len(l)')} AS short_line_ratio, {ratio("len(list_filter(w, lambda x: starts_with(x, 'http://') OR starts_with(x, 'https://') OR starts_with(x, 'www.')))", 'len(w)')} AS link_ratio, {_HOST} AS host FROM w1)"""
SQL["web_metrics"] = f"WITH {_WEB} SELECT doc_id, prose_paragraphs, round(short_line_ratio, 6) AS short_line_ratio, round(link_ratio, 6) AS link_ratio FROM w2"
SQL["web_rules"] = f"""WITH {_WEB}, w3 AS (SELECT *, CASE WHEN prose_paragraphs < 3 THEN 'insufficient_prose_paragraphs' WHEN short_line_ratio > 0.30::DOUBLE THEN 'too_many_short_lines' WHEN link_ratio > 0.20::DOUBLE THEN 'too_many_url_tokens' END AS r FROM w2),
w4 AS (SELECT *, coalesce(sum(CASE WHEN r IS NULL AND t <> '' THEN len(w) ELSE 0 END) OVER (PARTITION BY host ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 1500 AS o FROM w3)
SELECT doc_id, host, CASE WHEN t = '' THEN 'empty_text' WHEN o THEN 'hostname_quota_exceeded' ELSE r END AS rule FROM w4"""
_WIKI_RULE = f"CASE WHEN regexp_matches({strip('title')}, {q(WIKI_NAMESPACE)}) THEN 'disallowed_namespace' WHEN contains(lower(title), 'disambiguation') OR starts_with(lower(title), 'list of ') THEN 'list_or_disambiguation' END"
SQL["wiki_rules"] = f"SELECT doc_id, CASE WHEN doc_id % 5 = 2 THEN 'disallowed_project' ELSE {_WIKI_RULE} END AS rule, md5({strip(rsub('text', WIKI_TAIL, ''))}) AS text_md5 FROM {PLANTED} WHERE text IS NOT NULL"
SQL["book_strip"] = f"SELECT doc_id, md5({strip('text')}) AS plain_md5, md5({strip('text')}) AS marked_md5 FROM documents WHERE text IS NOT NULL"
_OCR = f"regexp_replace(text, {q(BROKEN_WORD)}, '\\1\\2', 'g')"
SQL["ocr_rules"] = f"SELECT doc_id, md5(t) AS text_md5, round({ratio(f'len(list_filter({ws("t")}, lambda x: regexp_matches(x, {q(INNER_DIGIT)})))', nw('t'))}, 6) AS inner_digit_ratio FROM (SELECT doc_id, {_OCR} AS t FROM {PLANTED} WHERE text IS NOT NULL)"
SQL["boilerplate_strip"] = "SELECT doc_id, " + ", ".join(f"md5({rsub('text', p, '')}) AS {k}_md5" for k, p in BOILERPLATE.items()) + " FROM " + PLANTED + " WHERE text IS NOT NULL"
SQL["section_removal"] = f"SELECT doc_id, md5({rsub('text', SCIENCE_TAIL, '')}) AS text_md5 FROM {PLANTED} WHERE text IS NOT NULL"


def _tag_eq(x: str) -> str:
    t = f"regexp_replace({x}, {q(DISPLAY_MATH)}, {q(chr(10) + '<EQUATION>' + chr(10) + chr(92) + '1' + chr(92) + '2' + chr(92) + '3' + chr(10) + '</EQUATION>' + chr(10))}, 'g')"
    t = f"regexp_replace({t}, {q(f'<EQUATION>{chr(10)}[{SP}]*')}, {q('<EQUATION>' + chr(10))}, 'g')"
    return f"regexp_replace({t}, {q(f'[{SP}]*{chr(10)}</EQUATION>')}, {q(chr(10) + '</EQUATION>')}, 'g')"


SQL["equation_tags"] = f"SELECT doc_id, md5({_tag_eq('text')}) AS text_md5 FROM documents WHERE text IS NOT NULL"
SQL["catalogue_stubs"] = f"SELECT doc_id, CASE WHEN (contains(text, 'Catalog Record') OR contains(text, 'Resource Description:')) AND {nw('text')} < 300 THEN 'catalogue_stub' WHEN {nw('text')} < 256 THEN 'below_min_length' END AS rule FROM documents WHERE text IS NOT NULL"
_BYCAT = f"""{CONF}, k0 AS (SELECT *, coalesce(text, '') AS t FROM cat),
k1 AS (SELECT *, CASE category WHEN 'wikimedia' THEN {strip(rsub('t', WIKI_TAIL, ''))} WHEN 'books' THEN {rsub(f"regexp_replace({strip('t')}, {q(BROKEN_WORD)}, '\\1\\2', 'g')", BOILERPLATE['books'], '')}
  WHEN 'scientific' THEN {_tag_eq(rsub('t', SCIENCE_TAIL, ''))} WHEN 'educational' THEN {rsub('t', BOILERPLATE['educational'], '')} WHEN 'government_legal' THEN {rsub('t', BOILERPLATE['government_legal'], '')}
  WHEN 'technical' THEN {rsub('t', BOILERPLATE['technical'], '')} ELSE t END AS c FROM k0),
k2 AS (SELECT *, {nw('c')} AS n_words_clean FROM k1),
bycat AS (SELECT *, CASE WHEN t = '' THEN 'empty_text' WHEN category = 'wikimedia' AND {_WIKI_RULE} IS NOT NULL THEN {_WIKI_RULE}
  WHEN n_words_clean < CASE category WHEN 'wikimedia' THEN 64 WHEN 'books' THEN 512 WHEN 'scientific' THEN 256 WHEN 'educational' THEN 256 WHEN 'government_legal' THEN 256 WHEN 'technical' THEN 256 ELSE 0 END THEN 'below_min_length' END AS rule FROM k2)"""
SQL["clean_by_category"] = f"WITH {_BYCAT} SELECT doc_id, category, n_words_clean, rule FROM bycat"
SQL["cleaning_counters"] = f"WITH {_BYCAT} SELECT source, count(*) FILTER (rule IS NULL) AS n_kept, count(*) FILTER (rule IS NOT NULL) AS n_rejected, sum(CASE WHEN rule IS NULL THEN n_words_clean ELSE 0 END)::BIGINT AS n_words FROM bycat GROUP BY 1"


_BY_NAME = {
    "Wikimedia_dump": (strip(rsub("t", WIKI_TAIL, "")), 64), "gutenberg_books": (strip("t"), 1024), "Pre_1929_scans": (f"regexp_replace(t, {q(BROKEN_WORD)}, '\\1\\2', 'g')", 1024),
    "doab": (rsub("t", BOILERPLATE["books"], ""), 512), "pressbooks_x": (rsub("t", BOILERPLATE["books"], ""), 512), "arXiv_abstracts": (_tag_eq(rsub("t", SCIENCE_TAIL, "")), 512),
    "peS2o": (rsub("t", SCIENCE_TAIL, ""), 512), "PubMed": (rsub("t", SCIENCE_TAIL, ""), 256), "LibreTexts": (rsub("t", BOILERPLATE["educational"], ""), 512), "oercommons": ("t", 256),
    "USGPO": (rsub("t", BOILERPLATE["government_legal"], ""), 256), "caselaw": (rsub("t", BOILERPLATE["government_legal"], ""), 256), "python_enhancement_proposals": (rsub("t", BOILERPLATE["technical"], ""), 256), "other": ("t", 0),
}
_DIGITS = f"{nw('c')} > 0 AND len(list_filter({ws('c')}, lambda x: regexp_matches(x, {q(INNER_DIGIT)})))::DOUBLE / {nw('c')} > 0.15::DOUBLE"
SQL["clean_by_source"] = f"""WITH n0 AS (SELECT doc_id, coalesce(title, '') AS title, coalesce(text, '') AS t, [{', '.join(map(q, SOURCE_NAMES))}][doc_id % {len(SOURCE_NAMES)} + 1] AS source FROM documents),
n1 AS (SELECT *, CASE source {' '.join(f"WHEN '{k}' THEN {c}" for k, (c, _) in _BY_NAME.items())} END AS c, CASE source {' '.join(f"WHEN '{k}' THEN {n}" for k, (_, n) in _BY_NAME.items())} END AS least FROM n0)
SELECT doc_id, source, md5(c) AS text_md5, {nw('c')} AS n_words_clean, CASE WHEN t = '' THEN 'empty_text' WHEN source = 'Wikimedia_dump' AND {_WIKI_RULE} IS NOT NULL THEN {_WIKI_RULE} WHEN source = 'Pre_1929_scans' AND {_DIGITS} THEN 'inner_digits_exceeded'
  WHEN source = 'oercommons' AND (contains(t, 'Catalog Record') OR contains(t, 'Resource Description:')) AND {nw('t')} < 300 THEN 'catalogue_stub' WHEN {nw('c')} < least THEN 'below_min_length' END AS rule FROM n1"""


def inside(tag: str, x: str = "text") -> str:
    return f"regexp_extract_all({x}, {q(f'(?s)<{tag}>{chr(92)}n(.*?){chr(92)}n</{tag}>')}, 1)"


NL2 = "chr(10) || chr(10)"


def tagged(tag: str, x: str) -> str:
    return f"'<{tag}>' || chr(10) || {x} || chr(10) || '</{tag}>'"


_THREADS = f"th AS (SELECT doc_id, text, title AS doc_title, coalesce(license, '') AS lic, coalesce(url, '') AS url, site, coalesce({inside('QUESTION_TITLE')}[1], '') AS title, coalesce({inside('QUESTION_BODY')}[1], '') AS body, {inside('ANSWER')} AS answers FROM documents WHERE contains(text, '<QUESTION_BODY>'))"
_HEAD = f"[{tagged('QUESTION_TITLE', strip('title'))}, {tagged('QUESTION_BODY', strip('body'))}]"
SQL["thread_clean"] = f"""WITH {_THREADS},
a0 AS (SELECT doc_id, list_transform(answers, lambda b, i: {{'acc': CASE WHEN i = 2 THEN 0 ELSE 1 END, 'score': -length(b), 'i': i, 'body': {strip('b')}}}) AS a FROM th),
a1 AS (SELECT doc_id, list_filter(list_sort(a)[1:20], lambda s: {nw('s.body')} >= 10) AS a FROM a0),
a2 AS (SELECT th.*, len(a) AS n_answers, len(answers) AS n_given, array_to_string(list_concat({_HEAD}, flatten(list_transform(a, lambda s: [{tagged('ANSWER', 's.body')}, {tagged('COMMENT', "'this comment has just enough words to stay'")}]))), {NL2}) AS t FROM th JOIN a1 USING (doc_id))
SELECT doc_id, md5(t) AS text_md5, n_answers::BIGINT AS n_answers, CASE WHEN contains(lower(coalesce(site, '')), 'meta') THEN 'disallowed_meta_site' WHEN {nw('body')} < 20 THEN 'empty_or_short_question_body' WHEN n_given = 0 THEN 'no_answers_in_thread'
  WHEN n_answers = 0 THEN 'no_substantive_answers_retained' WHEN {nw('t')} < 128 THEN 'thread_below_min_length' END AS rule FROM a2"""
_ISSUES = f"""iss AS (SELECT doc_id, coalesce(license, '') AS lic, coalesce(url, '') AS url, contains(text, '<PULL_REQUEST_BODY>') AS pr, coalesce({inside('ISSUE_TITLE')}[1], {inside('PULL_REQUEST_TITLE')}[1], '') AS title,
  coalesce({inside('ISSUE_BODY')}[1], {inside('PULL_REQUEST_BODY')}[1], '') AS body, list_concat({inside('COMMENT')}, {inside('REVIEW_COMMENT')}) AS comments FROM documents WHERE contains(text, '<ISSUE_BODY>') OR contains(text, '<PULL_REQUEST_BODY>'))"""


def _itag(kind: str, x: str) -> str:
    return f"CASE WHEN pr THEN {tagged('PULL_REQUEST_' + kind, x)} ELSE {tagged('ISSUE_' + kind, x)} END"


_CTAG = f"CASE WHEN pr THEN {tagged('REVIEW_COMMENT', 'x')} ELSE {tagged('COMMENT', 'x')} END"
SQL["issue_clean"] = f"""WITH {_ISSUES},
i1 AS (SELECT *, list_transform(list_filter(list_transform(list_filter(list_transform(comments, lambda b, i: {{'b': b, 'i': i}}), lambda s: s.i <> 3), lambda s: {strip('s.b')}), lambda x: x <> ''),
  lambda x: {rsub(rsub('x', BASE64, '[BASE64_BINARY_REMOVED]'), STACK_TRACE, '[STACK_TRACE_REMOVED]')}) AS c FROM iss),
i2 AS (SELECT *, len(c) + 1 AS n_turns, {nw('title')} + {nw('body')} + coalesce(list_sum(list_transform(c, lambda x: {nw('x')})), 0) AS n,
  coalesce(list_sum(list_transform(flatten(list_transform(c, lambda x: regexp_extract_all(x, {q(CODE_BLOCK)}))), lambda y: {nw('y')})), 0) AS code,
  array_to_string(list_concat([{_itag('TITLE', strip('title'))}, {_itag('BODY', strip('body'))}], list_transform(c, lambda x: {_CTAG})), {NL2}) AS t FROM i1)
SELECT doc_id, md5(t) AS text_md5, n_turns::BIGINT AS n_turns, n::BIGINT AS n_words, round({ratio('code', 'n')}, 6) AS code_ratio,
  CASE WHEN regexp_matches(title, {q(BOTS)}) OR regexp_matches(body, {q(BOTS)}) THEN 'bot_generated_thread' WHEN n_turns < 2 THEN 'insufficient_turns' WHEN n > 0 AND code::DOUBLE / n > 0.60::DOUBLE THEN 'code_ratio_exceeded' WHEN n < 96 THEN 'thread_below_min_length' END AS rule FROM i2"""
_DEBATES = f"""deb AS (SELECT doc_id, coalesce(title, '') AS title, coalesce(license, '') AS lic, text, list_transform(list_zip({inside('SPEAKER')}, {inside('UTTERANCE')}), lambda u: {{'s': coalesce(u[1], 'SPEAKER'), 't': {strip("coalesce(u[2], '')")}}}) AS u FROM documents WHERE contains(text, '<UTTERANCE>'))"""
_SAID = f"'<SPEAKER>' || x.s || '</SPEAKER>' || chr(10) || {tagged('UTTERANCE', 'x.t')}"
SQL["utterance_clean"] = f"""WITH {_DEBATES}, d1 AS (SELECT *, list_filter(u, lambda x: {nw('x.t')} >= 4) AS k FROM deb),
d2 AS (SELECT *, array_to_string(list_concat([{tagged('SESSION', strip('title'))}], list_transform(list_transform(k, lambda x: {{'s': {strip('x.s')}, 't': x.t}}), lambda x: {_SAID})), {NL2}) AS t FROM d1)
SELECT doc_id, md5(t) AS text_md5, len(k)::BIGINT AS n_speeches, CASE WHEN len(u) = 0 THEN 'empty_utterances' WHEN len(k) = 0 THEN 'no_speeches_retained' WHEN {nw('t')} < 256 THEN 'debate_below_min_length' END AS rule FROM d2"""

# --- adapters
_NAMES = "['stackexchange_posts', 'GitHub_archive', 'arXiv_abstracts', 'peS2o', 'pre_1929_books', 'wikimedia', 'cccc', 'LibreTexts', 'uk_hansard']"
SQL["adapter_dispatch"] = f"SELECT doc_id, {_NAMES}[doc_id % 9 + 1] AS name, ['thread', 'technical', 'scientific', 'scientific', 'books', 'wikimedia', 'web', 'educational', 'government_legal'][doc_id % 9 + 1] AS adapter, ['thread', 'web', 'web', 'web', 'books', 'wikimedia', 'web', 'web', 'government_legal'][doc_id % 9 + 1] AS adapter_exact FROM documents"
SQL["license_fallback"] = "SELECT doc_id, coalesce(nullif(license, ''), 'missing') AS license FROM documents"
_LIC = "coalesce(nullif(lic, ''), 'missing') AS license_status"
SQL["thread_assembly"] = f"""WITH {_THREADS}, tb AS (SELECT * REPLACE (coalesce(nullif(body, ''), text) AS body) FROM th) SELECT doc_id, md5(CASE WHEN {strip('body')} <> '' THEN array_to_string(list_concat({_HEAD}, list_transform(list_filter(list_transform(answers[1:20], lambda x: {strip('x')}), lambda x: x <> ''), lambda x: {tagged('ANSWER', 'x')})), {NL2}) ELSE text END) AS text_md5,
  {_LIC}, title, url FROM tb"""
SQL["issue_assembly"] = f"""WITH {_ISSUES} SELECT doc_id, md5(CASE WHEN {strip('body')} <> '' THEN array_to_string(list_concat([{_itag('TITLE', strip('title'))}, {_itag('BODY', strip('body'))}], list_transform(list_filter(list_transform(comments, lambda x: {strip('x')}), lambda x: x <> ''), lambda x: {_CTAG})), {NL2}) ELSE '' END) AS text_md5,
  {_LIC}, title, url FROM iss"""
SQL["utterance_assembly"] = f"""WITH {_DEBATES} SELECT doc_id, md5(CASE WHEN len(u) > 0 THEN array_to_string(list_concat([{tagged('SESSION', "coalesce(nullif(title, ''), 'Hansard Debate')")}], list_transform(list_filter(u, lambda x: x.t <> ''), lambda x: {_SAID})), {NL2}) ELSE '' END) AS text_md5, {_LIC} FROM deb"""
SQL["web_records"] = "SELECT doc_id, md5(coalesce(text, '')) AS text_md5, coalesce(nullif(license, ''), 'missing') AS license_status, coalesce(url, '') AS url, coalesce(title, '') AS title FROM documents"
_LICENSE = "coalesce(nullif(license, ''), 'missing') AS license_status, coalesce(title, '') AS title"
SQL["paper_records"] = f"""SELECT doc_id, md5(coalesce(CASE WHEN doc_id % 4 <> 0 THEN nullif(text, '') END, 'Abstract. ' || text, '')) AS text_md5, {_LICENSE}, doc_id::VARCHAR AS url, CASE WHEN doc_id % 6 = 0 THEN 'physics' ELSE '' END AS field_family FROM documents"""
SQL["book_records"] = f"SELECT doc_id, md5(coalesce(text, '')) AS text_md5, {_LICENSE}, 'b' || doc_id AS book_id FROM documents"
SQL["wiki_records"] = f"SELECT doc_id, md5(coalesce(text, '')) AS text_md5, {_LICENSE}, coalesce(lang, '') AS subproject FROM documents"
SQL["lesson_records"] = "SELECT doc_id, md5(coalesce(text, '')) AS text_md5, 'missing' AS license_status, coalesce(title, '') AS title FROM documents"

# --- segments


def _between(table: str, gap: str) -> str:
    return f"""b0 AS (SELECT doc_id, list_transform(regexp_split_to_array(t, {q(gap)}), lambda x: length(x)) AS p, list_transform(regexp_extract_all(t, {q(gap)}), lambda x: length(x)) AS g FROM {table}),
b1 AS (SELECT doc_id, p, list_transform(p, lambda x, i: coalesce(list_sum(p[1:i - 1]), 0) + coalesce(list_sum(g[1:i - 1]), 0)) AS st FROM b0),
b2 AS (SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(st, p), lambda z: z[2] > 0), lambda z: (z[1]::BIGINT)::VARCHAR || '-' || ((z[1] + z[2])::BIGINT)::VARCHAR), ',') AS spans FROM b1)"""


SQL["paragraph_spans"] = f"WITH t0 AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {_between('t0', r'\n\n+')} SELECT doc_id, coalesce(spans, '') AS spans FROM b2"
# no look-behind here: the gap is marked by a character that no text has, then measured without the mark
_SENT = f"regexp_replace(regexp_replace(coalesce(text, ''), {q(rf'([.!?])([{SP}]+)([A-Z0-9<])')}, '\\1' || chr(57344) || '\\2' || chr(57345) || '\\3', 'g'), {q(rf'([.!?])([{SP}]+)([A-Z0-9<])')}, '\\1' || chr(57344) || '\\2' || chr(57345) || '\\3', 'g')"
SQL["sentence_spans"] = f"""WITH b0 AS (SELECT doc_id, list_transform(regexp_split_to_array(t, '\\x{{e000}}[^\\x{{e001}}]*\\x{{e001}}'), lambda x: length(x)) AS p, list_transform(regexp_extract_all(t, '\\x{{e000}}[^\\x{{e001}}]*\\x{{e001}}'), lambda x: length(x) - 2) AS g FROM (SELECT doc_id, {_SENT} AS t FROM documents)),
b1 AS (SELECT doc_id, p, list_transform(p, lambda x, i: coalesce(list_sum(p[1:i - 1]), 0) + coalesce(list_sum(g[1:i - 1]), 0)) AS st FROM b0)
SELECT doc_id, coalesce(array_to_string(list_transform(list_filter(list_zip(st, p), lambda z: z[2] > 0), lambda z: (z[1]::BIGINT)::VARCHAR || '-' || ((z[1] + z[2])::BIGINT)::VARCHAR), ','), '') AS spans FROM b1"""


def _matches(table: str, pattern: str) -> str:
    return f"""b0 AS (SELECT doc_id, list_transform(regexp_split_to_array(t, {q(pattern)}), lambda x: length(x)) AS p, list_transform(regexp_extract_all(t, {q(pattern)}), lambda x: length(x)) AS g FROM {table}),
b1 AS (SELECT doc_id, g, list_transform(g, lambda x, i: coalesce(list_sum(p[1:i]), 0) + coalesce(list_sum(g[1:i - 1]), 0)) AS st FROM b0)
SELECT doc_id, array_to_string(list_transform(list_zip(st, g), lambda z: (z[1]::BIGINT)::VARCHAR || '-' || ((z[1] + z[2])::BIGINT)::VARCHAR), ',') AS spans FROM b1 WHERE len(g) > 0"""


_TURN = "(?s)" + "|".join(f"<{t}>.*?</{t}>" for t in ("QUESTION_BODY", "ANSWER", "COMMENT", "UTTERANCE", "ISSUE_BODY", "PULL_REQUEST_BODY", "REVIEW_COMMENT"))
SQL["turn_spans"] = f"WITH t0 AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {_matches('t0', _TURN)}"
SQL["equation_spans"] = f"WITH t0 AS (SELECT doc_id, {_tag_eq('text')} AS t FROM documents WHERE text IS NOT NULL), {_matches('t0', '(?s)<EQUATION>.*?</EQUATION>')}"
_PARAS = f"list_filter(list_transform(string_split(text, {NL2}), lambda x: {strip('x')}), lambda x: x <> '')"
_SEGS = f"""RECURSIVE g0 AS (SELECT doc_id, text, {nw('text')} AS n FROM documents WHERE {nw('text')} > 0),
g1 AS (SELECT doc_id, list_transform({_PARAS}, lambda x: {{'p': x, 'n': {nw('x')}}}) AS ps FROM g0 WHERE n > 150),
f AS (SELECT doc_id, ps, 0 AS i, 0::BIGINT AS seg, 0::BIGINT AS cur FROM g1
  UNION ALL SELECT doc_id, ps, i + 1, CASE WHEN cur + ps[i + 1].n > 100 AND cur >= 20 THEN seg + 1 ELSE seg END, CASE WHEN cur + ps[i + 1].n > 100 AND cur >= 20 THEN ps[i + 1].n ELSE cur + ps[i + 1].n END FROM f WHERE i < len(ps)),
g2 AS (SELECT doc_id, seg, string_agg(ps[i].p, {NL2} ORDER BY i) AS t FROM f WHERE i > 0 GROUP BY 1, 2 UNION ALL SELECT doc_id, 0, text FROM g0 WHERE n <= 150),
segs AS (SELECT doc_id, seg AS segment_index, t, count(*) OVER (PARTITION BY doc_id) AS segment_count FROM g2)"""
SQL["segment_pack"] = f"WITH {_SEGS} SELECT doc_id, segment_index, md5(t) AS text_md5, {nw('t')} AS n_words FROM segs"
SQL["segment_adjacency"] = f"""WITH {_SEGS} SELECT doc_id || '_seg' || segment_index AS segment_id, segment_index, segment_count, CASE WHEN segment_index > 0 THEN doc_id || '_seg' || (segment_index - 1) END AS previous_segment_id,
  CASE WHEN segment_index < segment_count - 1 THEN doc_id || '_seg' || (segment_index + 1) END AS next_segment_id FROM segs"""

# --- deduplication
_RANK = "CASE lower(coalesce(category, 'web')) " + " ".join(f"WHEN '{c}' THEN {r}::DOUBLE" for c, r in CATEGORY_RANK.items()) + " ELSE 0.5::DOUBLE END"
_SCORE = f"{_RANK} * 0.35::DOUBLE + 1.0::DOUBLE * 0.25::DOUBLE + 0.40::DOUBLE"
SQL["exact_dedup"] = f"""WITH {CONF}, s AS (SELECT doc_id, sha256(text) AS text_hash, {_SCORE} AS score, {priority('source', 'doc_id')} AS priority FROM cat WHERE text IS NOT NULL)
SELECT text_hash, doc_id AS winner, n AS copies FROM (SELECT *, row_number() OVER (PARTITION BY text_hash ORDER BY score DESC, priority, doc_id) AS r, count(*) OVER (PARTITION BY text_hash) AS n FROM s) WHERE r = 1"""
SQL["dedup_scores"] = f"WITH {CONF} SELECT doc_id, round({_RANK} * 0.35::DOUBLE + CASE WHEN contains(coalesce(text, ''), {NL2}) THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END * 0.25::DOUBLE + 0.40::DOUBLE, 6) AS score FROM cat"
SQL["measured_scores"] = f"SELECT DISTINCT document_id, round({_RANK.replace('category', 'domain')} * 0.35::DOUBLE + CASE WHEN coalesce(len(structure.paragraph_spans), 0) > 0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END * 0.25::DOUBLE + (coalesce(quality.language_probability, 0) + coalesce(quality.final_quality_score, 0)) * 0.2::DOUBLE, 6) AS score FROM canonical_docs"
_FREQ = f"""tx AS (SELECT document_id AS doc_id, min(normalized_text) AS text FROM canonical_docs WHERE normalized_text IS NOT NULL GROUP BY 1),
pl AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM tx),
ph AS (SELECT doc_id, i, {strip('x')} AS p, CASE WHEN {nw('x')} >= 5 THEN md5({strip('x')}) END AS h FROM pl),
fr AS (SELECT h, count(DISTINCT doc_id) AS documents FROM ph WHERE h IS NOT NULL GROUP BY 1 HAVING count(DISTINCT doc_id) >= 10)"""
SQL["paragraph_df"] = f"WITH {_FREQ} SELECT h AS paragraph_hash, documents FROM fr"
SQL["paragraph_strip"] = f"""WITH {_FREQ}, st AS (SELECT doc_id, {strip("coalesce(string_agg(p, chr(10) ORDER BY i) FILTER (fr.h IS NULL AND p <> ''), '')")} AS t, count(fr.h) AS paragraphs_removed FROM ph LEFT JOIN fr USING (h) GROUP BY 1)
SELECT doc_id AS document_id, md5(t) AS text_md5, paragraphs_removed, {nw('t')} < 64 AS too_short FROM st"""
_FREQ50 = _FREQ.replace("chr(10))", "chr(10) || chr(10))").replace(">= 5 THEN", ">= 50 THEN")
SQL["paragraph_df_long"] = SQL["paragraph_df"].replace(_FREQ, _FREQ50)
SQL["paragraph_strip_long"] = SQL["paragraph_strip"].replace(_FREQ, _FREQ50).replace("string_agg(p, chr(10) ORDER", "string_agg(p, chr(10) || chr(10) ORDER")
_LW = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+')"
SQL["shingle_counts"] = f"SELECT doc_id, CASE WHEN len(w) >= 5 THEN len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) ELSE 0 END::BIGINT AS n_shingles FROM (SELECT doc_id, {_LW} AS w FROM documents)"
_SHING = f"""sw AS (SELECT doc_id, {_LW} AS w FROM documents), ss AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM sw WHERE len(w) >= 5),
rp AS (SELECT s, min(doc_id) AS rep FROM ss GROUP BY 1), sx AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM rp),
pr AS (SELECT a.rep AS a, b.rep AS b, count(*)::DOUBLE / (any_value(a.n) + any_value(b.n) - count(*)) AS j FROM sx a JOIN sx b ON a.x = b.x AND a.rep < b.rep AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9 GROUP BY 1, 2 HAVING count(*)::DOUBLE / (any_value(a.n) + any_value(b.n) - count(*)) >= 0.8::DOUBLE)"""
SQL["fuzzy_pairs"] = f"WITH {_SHING} SELECT a, b, round(j, 6) AS similarity FROM pr"
_CLUST = f"""RECURSIVE {_SHING}, ed AS (SELECT a, b FROM pr UNION SELECT b, a FROM pr), rc AS (SELECT a, b FROM ed UNION SELECT rc.a, ed.b FROM rc JOIN ed ON rc.b = ed.a),
mem AS (SELECT d.doc_id, coalesce(rp.rep, d.doc_id) AS class_id FROM documents d LEFT JOIN ss ON ss.doc_id = d.doc_id LEFT JOIN rp ON rp.s = ss.s),
lk AS (SELECT a, count(*) AS links FROM ed GROUP BY 1), cp AS (SELECT a, least(a, min(b)) AS c FROM rc GROUP BY 1),
near AS (SELECT mem.doc_id AS document_id, class_id, coalesce(links, 0) AS links, coalesce(c, class_id) AS cluster FROM mem LEFT JOIN lk ON lk.a = class_id LEFT JOIN cp ON cp.a = class_id)"""
_R = np.random.RandomState(42)
_COEF = ", ".join(f"({k}, {a}::HUGEINT, {b}::HUGEINT)" for k, (a, b) in enumerate(zip(_R.randint(1, 4294967295, size=128, dtype=np.uint64).tolist(), _R.randint(0, 4294967295, size=128, dtype=np.uint64).tolist(), strict=True)))
SQL["minhash_links"] = f"""WITH w0 AS (SELECT doc_id, {_LW} AS w FROM documents),
sh AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM w0 WHERE len(w) >= 5),
h AS (SELECT doc_id, ('0x' || substr(md5(s), 1, 8))::BIGINT AS h FROM sh),
sg AS (SELECT doc_id, k, min((a * h + b) % 4294967311) AS m FROM h CROSS JOIN (VALUES {_COEF}) c(k, a, b) GROUP BY 1, 2),
bd AS (SELECT doc_id, k // 8 AS band, md5(string_agg(m::VARCHAR, ',' ORDER BY k)) AS key FROM sg GROUP BY 1, 2),
hub AS (SELECT band, key, min(doc_id) AS a FROM bd GROUP BY 1, 2 HAVING count(*) > 1)
SELECT DISTINCT a, doc_id AS b FROM bd JOIN hub USING (band, key) WHERE doc_id <> a"""
SQL["fuzzy_clusters"] = f"WITH {_CLUST} SELECT document_id, class_id, cluster FROM near"
SQL["fuzzy_links"] = f"WITH {_CLUST} SELECT DISTINCT class_id, links FROM near"
SQL["fuzzy_dedup"] = f"""WITH {_CLUST}, {CONF}, s AS (SELECT doc_id AS document_id, {_SCORE} AS score, {priority('source', 'doc_id')} AS priority FROM cat)
SELECT cluster, document_id AS winner, n AS n_docs FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, priority, document_id) AS r, count(*) OVER (PARTITION BY cluster) AS n FROM near JOIN s USING (document_id)) WHERE r = 1"""
SQL["family_groups"] = """WITH RECURSIVE m AS (SELECT DISTINCT lower(trim(split_group_id)) AS g, md5(normalized_text) AS h FROM canonical_docs WHERE normalized_text IS NOT NULL AND split_group_id IS NOT NULL),
hb AS (SELECT h, min(g) AS hub FROM m GROUP BY 1), ed AS (SELECT g AS a, hub AS b FROM m JOIN hb USING (h) UNION SELECT hub, g FROM m JOIN hb USING (h)),
rc AS (SELECT a, b FROM ed UNION SELECT rc.a, ed.b FROM rc JOIN ed ON rc.b = ed.a) SELECT a AS group_id, min(b) AS family FROM rc GROUP BY 1"""
SQL["dedup_metrics"] = f"WITH {_CLUST} SELECT (SELECT count(text) FROM documents) AS n_docs, (SELECT count(DISTINCT sha256(text)) FROM documents) AS n_texts, count(DISTINCT cluster) AS n_clusters, count(DISTINCT class_id) AS n_classes FROM near"

# --- decontamination
_REG = f"reg AS (SELECT DISTINCT item_id, benchmark_name, lower({strip('text')}) AS t FROM benchmark WHERE item_id IS NOT NULL AND len(regexp_extract_all(lower({strip('text')}), '[\\p{{L}}\\p{{N}}_]+')) >= 5)"
_SH13 = "list_distinct(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: array_to_string(w[i:i + 12], ' ')))"
_CON = f"""{_REG}, ex AS (SELECT doc_id, item_id FROM documents JOIN reg ON contains(lower(text), t)),
iw AS (SELECT item_id, regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]+') AS w FROM reg), ish AS (SELECT item_id, len({_SH13}) AS k, unnest({_SH13}) AS s FROM iw),
dw AS (SELECT doc_id, {_LW} AS w FROM documents), dsh AS (SELECT doc_id, unnest({_SH13}) AS s FROM dw WHERE len(w) > 0),
ov AS (SELECT doc_id, item_id, k, count(DISTINCT s) AS shared FROM dsh JOIN ish USING (s) GROUP BY 1, 2, 3 HAVING count(DISTINCT s) >= k * 0.7::DOUBLE),
lg AS (SELECT doc_id, min(x) AS x FROM (SELECT doc_id, {{'item_id': item_id, 'match_type': 'exact', 'overlap': 1.0::DOUBLE}} AS x FROM ex UNION ALL SELECT doc_id, {{'item_id': item_id, 'match_type': 'shingle_overlap', 'overlap': round(shared::DOUBLE / k, 6)}} FROM ov) GROUP BY 1),
con AS (SELECT doc_id, x.item_id AS item_id, benchmark_name, x.match_type AS match_type, x.overlap AS overlap FROM lg JOIN reg ON reg.item_id = lg.x.item_id)"""
SQL["contam_exact"] = f"WITH {_CON} SELECT doc_id, item_id FROM ex"
SQL["contam_overlap"] = f"WITH {_CON} SELECT doc_id, item_id, shared, k::BIGINT AS item_shingles FROM ov"
SQL["contam_first_match"] = f"WITH {_CON} SELECT doc_id, item_id, benchmark_name, match_type, overlap FROM con"
SQL["decontaminate"] = f"WITH {_CON} SELECT doc_id FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM con) AND (url IS NULL OR url NOT IN (SELECT url FROM documents JOIN con USING (doc_id) WHERE url IS NOT NULL))"
SQL["report_benchmark"] = f"WITH {_CON} SELECT doc_id, item_id, benchmark_name, match_type, overlap FROM con ORDER BY doc_id LIMIT 50"

# --- splits
# group, else parent, else the record itself; blank is none; shares 4 %, 4 % and 2 %
_PARENT = f"coalesce(nullif(lower({strip('parent_document_id')}), ''), document_id)"
_SPLIT = f"""g0 AS (SELECT DISTINCT document_id, coalesce(nullif(lower({strip('split_group_id')}), ''), {_PARENT}) AS g, {_PARENT} AS parent, normalized_text FROM canonical_docs),
g1 AS (SELECT *, ('0x' || substr(md5(g || ':42'), 1, 8))::BIGINT / 4294967295.0::DOUBLE AS u FROM g0),
sp AS (SELECT *, CASE WHEN u < 0.04 THEN 'validation' WHEN u < 0.08 THEN 'test' WHEN u < 0.1 THEN 'trajectory_holdout' ELSE 'train' END AS split FROM g1)"""
SQL["assign_splits"] = f"WITH {_SPLIT} SELECT document_id, split FROM sp"
SQL["split_metrics"] = f"""WITH {_SPLIT} SELECT c.split, count(DISTINCT g) AS groups, count(DISTINCT parent) AS parents, count(sp.split) AS records, coalesce(sum({nw('normalized_text')}) FILTER (sp.split IS NOT NULL), 0)::BIGINT AS size
FROM (SELECT DISTINCT split FROM split_config) c LEFT JOIN sp ON sp.split = c.split GROUP BY 1"""

# --- tokenizers
SQL["tokenizer_sample"] = "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5000"
SQL["pretoken_counts"] = f"SELECT p AS pretoken, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, {q(PRETOKEN)})) AS p FROM documents) GROUP BY 1 HAVING count(*) >= 2"
SQL["char_to_token_spans"] = f"""WITH t0 AS (SELECT doc_id, text AS t FROM documents WHERE text IS NOT NULL),
c0 AS (SELECT doc_id, list_transform(regexp_split_to_array(t, '\\n\\n+'), lambda x: length(x)) AS p, list_transform(regexp_extract_all(t, '\\n\\n+'), lambda x: length(x)) AS g,
  list_transform(regexp_split_to_array(t, {q(WORD)}), lambda x: length(x)) AS wp, list_transform({ws('t')}, lambda x: length(x)) AS wl FROM t0),
ps AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, p, g FROM c0),
pp AS (SELECT doc_id, i, (coalesce(list_sum(p[1:i - 1]), 0) + coalesce(list_sum(g[1:i - 1]), 0))::BIGINT AS s, p[i] AS n FROM ps),
wi AS (SELECT doc_id, unnest(range(1, len(wl) + 1)) AS k, unnest(wp[1:len(wl)]) AS gap, unnest(wl) AS l FROM c0),
wo AS (SELECT doc_id, k, (sum(gap + l) OVER (PARTITION BY doc_id ORDER BY k))::BIGINT AS e, l FROM wi),
ts AS (SELECT pp.doc_id, i, count(*) FILTER (wo.e - wo.l < s) AS a, count(*) FILTER (wo.e <= s + n) AS b FROM pp JOIN wo USING (doc_id) WHERE n > 0 GROUP BY 1, 2),
tt AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY i) AS spans FROM ts WHERE b > a GROUP BY 1)
SELECT doc_id, coalesce(spans, '') AS spans FROM t0 LEFT JOIN tt USING (doc_id)"""

# --- selection and freezing
_SEL = f"""{TOK}, qt AS ({QUOTA.format(n=POOL_WORDS)}),
l0 AS (SELECT document_id, lower(trim(tok.source)) AS source, token_ids, quota, len(token_ids)::BIGINT AS n, {priority('lower(trim(tok.source))', 'document_id')} AS priority FROM tok JOIN qt ON qt.source = lower(trim(tok.source)) WHERE len(token_ids) > 0),
l1 AS (SELECT *, quota - (sum(n) OVER (PARTITION BY source ORDER BY priority, document_id ROWS UNBOUNDED PRECEDING) - n)::BIGINT AS missing FROM l0),
sel AS (SELECT document_id, source, least(n, missing) AS n_taken, missing < n AS truncated, token_ids[1:least(n, missing)] AS ids FROM l1 WHERE missing > 0)"""
SQL["quota_select"] = f"WITH {_SEL} SELECT document_id, source, n_taken, truncated, md5({join_ids('ids')}) AS ids_md5 FROM sel"
SQL["quota_tolerance"] = f"WITH {_SEL}, g AS (SELECT source, sum(n_taken)::BIGINT AS got FROM sel GROUP BY 1) SELECT source, quota, coalesce(got, 0) AS got, abs(coalesce(got, 0) - quota) <= quota * 0.0005::DOUBLE AS within FROM qt LEFT JOIN g USING (source)"
SQL["trim_spans"] = f"""WITH {TOK} SELECT document_id, coalesce(array_to_string(list_transform(list_filter(paragraph_token_spans, lambda s: s.start < 100), lambda s: s.start || '-' || least(s."end", 100)), ','), '') AS spans FROM tok"""
SQL["ab_alignment"] = """WITH a AS (SELECT DISTINCT document_id FROM canonical_docs), b AS (SELECT DISTINCT document_id FROM tokenized_docs)
SELECT side, count(*) AS n_docs FROM (SELECT 'a_only' AS side FROM a ANTI JOIN b USING (document_id) UNION ALL SELECT 'b_only' FROM b ANTI JOIN a USING (document_id)) GROUP BY 1"""
SQL["token_mismatch"] = f"WITH {TOK} SELECT document_id, list_position(list_transform(token_ids, lambda x: x >= 30000), true)::BIGINT - 1 AS first_index FROM tok WHERE len(list_filter(token_ids, lambda x: x >= 30000)) > 0"
SQL["split_isolation"] = """SELECT DISTINCT view_id, v.document_id, view_split, document_split FROM (SELECT view_id, nullif(lower(trim(split)), '') AS view_split, unnest(source_document_ids) AS document_id FROM view_records) v
JOIN (SELECT DISTINCT document_id, CASE WHEN md5(document_id) LIKE '0%' THEN 'test' ELSE nullif(lower(trim(split)), '') END AS document_split FROM tokenized_docs) d ON v.document_id = d.document_id WHERE view_split <> document_split"""

# --- views


def pick(salt: str, n: str, id_: str = "document_id") -> str:
    return f"(('0x' || substr(md5('{salt}:' || {id_}), 1, 8))::BIGINT % ({n}))"


def shifted(seq: str, c: int) -> tuple[str, str]:
    full = f"list_concat({seq}[1:{c + 1}], list_transform(range(0, greatest({c + 1} - len({seq}), 0)), lambda i: 1))"
    return f"{full}[1:{c}]", f"{full}[2:{c + 1}]"


_A, _B = shifted("s", 512)
SQL["causal_shift_mask"] = f"""WITH {TOK}, v0 AS (SELECT document_id, list_concat([0], token_ids, [1]) AS q FROM tok WHERE len(token_ids) > 0),
v1 AS (SELECT document_id, q, unnest(range(0, (len(q) + 510) // 512)) AS w FROM v0), v AS (SELECT document_id, w, q[w * 512 + 1:w * 512 + 513] AS s FROM v1)
SELECT document_id, w::BIGINT AS window_index, md5({join_ids(_A)}) AS input_md5, md5({join_ids(_B)}) AS target_md5, len(s) - 1 AS n_loss, least(len(s), 512)::BIGINT AS n_attention FROM v"""
_P, _ = shifted("s", 512)
SQL["causal_packing"] = f"""WITH RECURSIVE {TOK}, k0 AS (SELECT document_id, split, token_ids, len(token_ids) AS n FROM tok WHERE len(token_ids) BETWEEN 1 AND 510),
kg AS (SELECT split, greatest(1, ceil(count(*) / 4096.0))::BIGINT AS g FROM k0 GROUP BY 1),
k1 AS (SELECT k0.*, {pick('group', 'g')} AS part FROM k0 JOIN kg USING (split)),
k2 AS (SELECT *, row_number() OVER (PARTITION BY split, part ORDER BY document_id) AS i FROM k1),
f AS (SELECT split, part, i, 0::BIGINT AS v, n + 2 AS used FROM k2 WHERE i = 1
  UNION ALL SELECT k2.split, k2.part, k2.i, CASE WHEN used + k2.n + 2 > 513 THEN v + 1 ELSE v END, CASE WHEN used + k2.n + 2 > 513 THEN k2.n + 2 ELSE used + k2.n + 2 END FROM f JOIN k2 ON k2.split = f.split AND k2.part = f.part AND k2.i = f.i + 1),
pk AS (SELECT k2.split, k2.part || '_' || v AS view, row_number() OVER (PARTITION BY k2.split, k2.part, v ORDER BY k2.i) AS place, k2.i, token_ids FROM k2 JOIN f USING (split, part, i)),
v AS (SELECT split, view, count(*) AS n_docs, flatten(list(list_concat([CASE WHEN place = 1 THEN 0 ELSE 2 END], token_ids, [1]) ORDER BY i)) AS s FROM pk GROUP BY 1, 2)
SELECT split, view, n_docs, md5({join_ids(_P)}) AS input_md5 FROM v"""
_CROP = f"""cr AS (SELECT document_id, split, token_ids, len(token_ids) AS n, len(paragraph_token_spans) AS k, paragraph_token_spans AS ps FROM tok WHERE len(token_ids) >= 255),
cs AS (SELECT *, CASE WHEN n >= 257 AND k > 0 AND {pick('coin', '100')} < 60 THEN ps[{pick('paragraph', 'greatest(k, 1)')} + 1].start WHEN n >= 257 THEN {pick('start', 'greatest(n - 256, 1)')} ELSE 0 END AS start_idx FROM cr),
crop AS (SELECT *, token_ids[start_idx + 1:start_idx + 257] AS s FROM cs)"""
_A256, _ = shifted("s", 256)
SQL["single_doc_crop"] = f"WITH {TOK}, {_CROP} SELECT document_id, start_idx::BIGINT AS start_idx, md5({join_ids(_A256)}) AS input_md5 FROM crop WHERE len(s) >= 64"
_PS = f"ps0 AS (SELECT document_id, split, token_ids, [256, 512, 1024][{pick('prefix', '3')} + 1] AS prefix_len, [1, 4, 16, 64, 256][{pick('horizon', '5')} + 1] AS horizon FROM tok), ps AS (SELECT * FROM ps0 WHERE len(token_ids) >= 512 AND len(token_ids) > prefix_len + 64)"
SQL["prefix_suffix"] = f"WITH {TOK}, {_PS} SELECT document_id, prefix_len::BIGINT AS prefix_len, horizon::BIGINT AS horizon, md5({join_ids('token_ids[1:prefix_len]')}) AS input_md5, md5({join_ids('token_ids[prefix_len + 1:prefix_len + horizon]')}) AS target_md5 FROM ps"
_BR = f"br0 AS (SELECT *, {pick('bridge', 'greatest(len(paragraph_token_spans) - 2, 1)')} + 1 AS p_idx FROM tok WHERE len(paragraph_token_spans) >= 3), br AS (SELECT *, paragraph_token_spans[p_idx + 1] AS p FROM br0)"
SQL["bridge_mask"] = f"""WITH {TOK}, {_BR} SELECT document_id, p_idx::BIGINT AS p_idx, md5({join_ids("list_concat(token_ids[1:p.start], [11], token_ids[p.\"end\" + 1:])[1:512]")}) AS input_md5, md5({join_ids('token_ids[p.start + 1:p."end"]')}) AS target_md5 FROM br"""
_CROP512 = _CROP.replace(">= 255", ">= 511").replace("n >= 257", "n >= 513").replace("n - 256", "n - 512").replace("start_idx + 257", "start_idx + 513")
_HEAD_V = SQL["causal_packing"][: SQL["causal_packing"].index("SELECT split, view, n_docs, md5(")].rstrip()
SQL["view_union"] = f"""{_HEAD_V}, {_CROP512}, {_PS}, {_BR}, u AS (SELECT 'causal_packed' AS view_type, split, n_docs AS k, 512 AS a, 512 AS b FROM v
  UNION ALL SELECT 'causal_single_doc', split, 1, 512, 512 FROM crop WHERE len(s) >= 64
  UNION ALL SELECT 'prefix_suffix', split, 1, prefix_len, len(token_ids[prefix_len + 1:prefix_len + horizon]) FROM ps
  UNION ALL SELECT 'bridge_masked_span', split, 1, len(list_concat(token_ids[1:p.start], [11], token_ids[p."end" + 1:])[1:512]), len(token_ids[p.start + 1:p."end"]) FROM br)
SELECT view_type, split, CASE WHEN split = 'train' THEN 'pretraining' ELSE 'evaluation' END AS usage, count(*) AS n_views, sum(k)::BIGINT AS n_docs, sum(a)::BIGINT AS n_input, sum(b)::BIGINT AS n_target FROM u GROUP BY ALL"""

# --- statistics and reports
_CNT = f"tk AS (SELECT coalesce(source, '') AS scope, unnest(token_ids) AS token_id FROM tok WHERE split = 'train'), cnt AS (SELECT scope, token_id::BIGINT AS token_id, count(*) AS n FROM tk WHERE token_id BETWEEN 0 AND {VOCAB - 1} GROUP BY GROUPING SETS ((scope, token_id), (token_id)))"
SQL["unigram_counts"] = f"WITH {TOK}, {_CNT} SELECT scope, token_id, n FROM cnt"
SQL["unigram_log_probs"] = f"""WITH {TOK}, {_CNT}, sc AS (SELECT scope, sum(n) AS total FROM cnt GROUP BY 1), lp AS (SELECT sc.scope, r.id, ln((coalesce(cnt.n, 0) + 0.1::DOUBLE) / (total + 0.1::DOUBLE * {VOCAB}))::FLOAT::DOUBLE AS p
  FROM sc CROSS JOIN (SELECT unnest(range(0, {VOCAB})) AS id) r LEFT JOIN cnt ON cnt.scope IS NOT DISTINCT FROM sc.scope AND cnt.token_id = r.id)
SELECT scope, count(*) AS n_ids, round(sum(p), 1) AS sum_log_p, round(max(p), 4) AS max_log_p FROM lp GROUP BY 1"""
SQL["unigram_consistency"] = f"WITH {TOK}, {_CNT}, bad AS (SELECT * FROM cnt WHERE scope IS NULL OR token_id % 500 <> 0) SELECT token_id, coalesce(sum(n) FILTER (scope IS NULL), 0)::BIGINT AS total, coalesce(sum(n) FILTER (scope IS NOT NULL), 0)::BIGINT AS by_source FROM bad GROUP BY 1 HAVING total <> by_source"
SQL["report_source"] = """WITH c AS (SELECT source, count(DISTINCT document_id) AS n_docs FROM canonical_docs GROUP BY 1), t AS (SELECT source, sum(n)::BIGINT AS n_tokens FROM (SELECT document_id, source, max(len(token_ids)) AS n FROM tokenized_docs GROUP BY 1, 2) GROUP BY 1)
SELECT c.source, n_docs, coalesce(n_tokens, 0) AS n_tokens, round(coalesce(n_tokens, 0) * 100.0::DOUBLE / sum(coalesce(n_tokens, 0)) OVER (), 4) AS share FROM c LEFT JOIN t ON c.source IS NOT DISTINCT FROM t.source"""
SQL["report_dedup"] = "SELECT count(text) AS n_docs, count(text) - count(DISTINCT text) AS n_removed, count(DISTINCT text) AS n_retained FROM documents"
SQL["report_structure"] = "SELECT " + ", ".join(f"sum({k})::BIGINT AS {k}" for k in ("paragraph_spans", "sentence_spans", "turn_spans", "equation_spans")) + " FROM (SELECT document_id, " + ", ".join(f"max(coalesce(len(structure.{k}), 0)) AS {k}" for k in ("paragraph_spans", "sentence_spans", "turn_spans", "equation_spans")) + " FROM canonical_docs GROUP BY 1)"
SQL["report_tokenizer"] = f"WITH {TOK} SELECT count(*) AS n_docs, sum(len(token_ids))::BIGINT AS n_tokens, round(avg(len(token_ids)), 4) AS mean_tokens FROM tok"
SQL["report_split"] = f"""WITH {TOK}, t AS (SELECT split, count(*) AS k, sum(coalesce(len(token_ids), 0))::BIGINT AS n FROM tok GROUP BY 1)
SELECT split, coalesce(k, 0) AS n_docs, coalesce(n, 0) AS n_tokens, round(coalesce(n, 0)::DOUBLE / sum(coalesce(n, 0)) OVER (), 6) AS share, c.share AS target FROM (SELECT DISTINCT split, share FROM split_config) c FULL JOIN t USING (split)"""
SQL["input_files"] = "SELECT 'documents.parquet' AS file, count(*) AS n_rows FROM documents"
