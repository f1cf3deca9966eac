"""Rule-based quality filter: metrics of a text and the first rule it breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import SPACE, WORD_END, WORD_START, line_count, lines, lines_of_at_most, once, ratio, word_count

# The limits of the rules.
MIN_PRINTABLE, MAX_DUPLICATE_LINES, MAX_MEDIAN_WORD, MAX_JUNK_LINES = 0.98, 0.20, 15, 0.30
MIN_ALPHABETIC, MIN_ALPHABETIC_TECHNICAL = 0.40, 0.25
TECHNICAL = ("scientific", "technical", "government_legal")
UNPRINTABLE = r"[^\P{C}\n\r\t]|[^\P{Z} ]"
ENGLISH_WORD = rf"{WORD_START}[A-Za-z!-/:-@\[-`{{-~]++{WORD_END}"
#: A word that is neither a link nor a tag.
PLAIN_WORD = rf"{WORD_START}(?!http|<)[^{SPACE}]+"


def upper_median(xs: Column) -> Column:
    """The element at half the length of the sorted array; null for an empty one."""
    return F.get(F.sort_array(xs), (F.size(xs) / 2).cast("int"))


def junk_lines(text: Column | str) -> Column:
    """The number of lines of digits or punctuation only, or of fewer than two words: the first two are single words as well."""
    return lines_of_at_most(text, 1)


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_words, printable_ratio, alphabetic_ratio, english_ratio, n_lines, unique_line_ratio, median_word_length, junk_line_ratio.

    Ratios over nothing are 0; the median is null without words that are neither links nor tags.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("n_words", word_count(t)).withColumn("n_lines", line_count(t))  # counted over the whole text, without arrays
    n, size, n_lines = F.col("n_words"), F.length(t), F.col("n_lines")
    return df.withColumns({
        "printable_ratio": ratio(size - F.regexp_count(t, F.lit(UNPRINTABLE)), size),
        "alphabetic_ratio": ratio(F.regexp_count(t, F.lit(r"\p{L}")), size),
        "english_ratio": ratio(F.regexp_count(t, F.lit(ENGLISH_WORD)), n),
        "unique_line_ratio": ratio(F.size(F.array_distinct(lines(t))), n_lines),
        "median_word_length": upper_median(F.transform(F.regexp_extract_all(t, F.lit(PLAIN_WORD), F.lit(0)), F.length)),
        "junk_line_ratio": ratio(junk_lines(t), n_lines),
    })


def rule(category: Column, min_words: Column, min_english: Column) -> Column:
    """The first rule that the metrics break, or null."""
    floor = F.when(F.coalesce(category, F.lit("")).isin(*TECHNICAL), MIN_ALPHABETIC_TECHNICAL).otherwise(MIN_ALPHABETIC)
    c = F.col
    return (
        F.when(c("n_lines") == 0, "empty_document")
        .when(c("n_words") < min_words, "below_min_length")
        .when(c("printable_ratio") < MIN_PRINTABLE, "low_printable_ratio")
        .when(c("alphabetic_ratio") < floor, "low_alphabetic_ratio")
        .when(c("english_ratio") < min_english, "low_english_probability")
        .when(1.0 - c("unique_line_ratio") > MAX_DUPLICATE_LINES, "high_duplicate_line_ratio")
        .when(c("median_word_length") > MAX_MEDIAN_WORD, "median_word_length_exceeded")
        .when(c("junk_line_ratio") > MAX_JUNK_LINES, "high_junk_line_ratio")
    )


def with_source_limits(df: DataFrame, config: DataFrame, source: str = "source") -> DataFrame:
    """df with category, min_words and min_english of its source; 128 words and 0.5 where the configuration has none."""
    c = config.select(F.lower(F.trim("name")).alias("_name"), "category", "min_doc_length", "min_english_prob").groupBy("_name").agg(F.min(F.struct("category", "min_doc_length", "min_english_prob")).alias("_x"))
    out = df.join(F.broadcast(c), F.lower(F.trim(source)) == F.col("_name"), "left")  # a row per configured source
    return out.withColumns({"category": F.col("_x.category"), "min_words": F.coalesce("_x.min_doc_length", F.lit(128)), "min_english": F.coalesce("_x.min_english_prob", F.lit(0.5))}).drop("_x", "_name")


def judge(df: DataFrame, config: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """df with the metrics, category, min_words, min_english and `rule`, null for a text that passes."""
    out = with_metrics(with_source_limits(df, config, source), text)
    return out.withColumn("rule", once(rule(F.col("category"), F.col("min_words"), F.col("min_english"))))
