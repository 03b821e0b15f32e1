"""Line-first quality rules, in DataFrame functions only.

Every line is judged by itself: navigation (many ``|`` between few words),
boilerplate (a phrase of web pages among few words), symbols, shouting, and
missing punctuation (of any script).  A line of more than ``LONG_LINE``
characters is judged sentence by sentence, so that one phrase condemns a
sentence and not a text without line breaks.  What fails is removed from the
text; a document that loses more than ``MAX_LOST`` per cent of its text so is
rejected.  Base counts (repeated words, lines and so on) reject documents
before that.  ``keep`` hands on the cleaned texts; one without failing lines is
handed on as it is, character by character.

Everything happens within a row; nothing is shuffled, and a row's cost grows
with its own text alone (repeats within a text are found by sorting window
hashes, not by comparing windows).

Defined results: null or empty text: no words, so base_failed; repeated rows:
judged each; null doc_id: kept as it is; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the contract: runs of anything but these six characters.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED = 20
REPEAT_WINDOW = 5

#: Per cent of a document's characters that failing lines may hold.
MAX_LOST = 30
#: A line of so many words needs some punctuation.
UNPUNCTUATED_WORDS = 8
#: Longer lines are judged by sentences; where those end (fixed values): stops before a blank, and stops that need none.
LONG_LINE = 300
STOPS, FULL_STOPS = ".!?\u2026\u0964\u0965\u06d4\u061f\u1362", "\u3002\uff01\uff1f"
#: Marks that are no punctuation here, though Unicode counts them so.
NO_PUNCTUATION = "#%&*@/"
#: Fewer words than this for each part between bars are navigation; a line of more words than this is no furniture.
NAVIGATION_WORDS, BOILERPLATE_WORDS = 4, 20
#: Phrases of page furniture (fixed values).
BOILERPLATE = (
    "javascript", "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "lorem ipsum", "click here", "subscribe to our", "sign up for", "log in", "read more", "share this",
)


_SQL_SPACE = SPACE.replace("\\", "\\\\")
#: SQL: the parts of a line that are judged, which put together are the line.
_PARTS = f"if(length(x) > {LONG_LINE}, split(x, '(?<=[{STOPS}])(?=[ \\t])|(?<=[{FULL_STOPS}])(?=.)', -1), array(x))"


def line_rules(line: str) -> dict[str, str]:
    """SQL conditions under which the line (an SQL expression) fails, by rule; all three-valued logic is avoided."""
    phrases = "|".join(BOILERPLATE)
    words = f"size(filter(split({line}, '{_SQL_SPACE}'), w -> w <> ''))"
    # Bars that stand around a word (|x|) separate nothing.
    bars = f"length(regexp_replace(regexp_replace({line}, '(?<![^ \\\\t(])[|][^| \\\\t]+[|](?![^ \\\\t,.;:)])', ''), '[^|]', ''))"
    return {
        "navigation": f"length(regexp_replace({line}, '[^|]', '')) >= 3 and {bars} >= 3 and {words} < {NAVIGATION_WORDS} * (1 + {bars})",
        "symbols": f"10 * length(regexp_replace({line}, '[^{SYMBOLS}]', '')) > length({line})",
        "shouting": f"upper({line}) = {line} and lower({line}) <> {line} and length({line}) >= 20",
        "boilerplate": f"{line} rlike '(?i)\\\\b({phrases})\\\\b' and {words} <= {BOILERPLATE_WORDS}",
        "punctuation": (
            f"{line} not rlike '[\\\\p{{Po}}&&[^{NO_PUNCTUATION}\\\\\\\\]]' and"
            f" {line} rlike '^[ \\\\x09-\\\\x0D]*([^ \\\\x09-\\\\x0D]+[ \\\\x09-\\\\x0D]+){{{UNPUNCTUATED_WORDS - 1}}}[^ \\\\x09-\\\\x0D]'"
        ),
    }


def _repeat_words(words: str) -> str:
    """SQL: words of the array that lie in a window which occurs twice."""
    window = ", ".join(f"{words}[i + {k}]" for k in range(REPEAT_WINDOW))
    hashes = f"transform(sequence(0, size({words}) - {REPEAT_WINDOW}), i -> xxhash64({window}))"
    return f"if(size({words}) < {REPEAT_WINDOW + 1}, array(), {hashes})"


def _covered() -> Column:
    """Words covered by the windows at the sorted positions ``at``."""
    return F.expr(
        f"aggregate(transform(at, (p, k) -> least({REPEAT_WINDOW}, coalesce(get(at, k + 1) - p, {REPEAT_WINDOW}))),"
        " 0L, (a, x) -> a + x)"
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text, the documents' whole rows (``doc``), the base counts and the lines."""
    some = "x -> x <> ''"
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("doc"), F.coalesce("text", F.lit("")).alias("t"))
    rows = rows.withColumn("words", F.expr(f"filter(split(t, '{_SQL_SPACE}'), {some})"))
    rows = rows.withColumn("hashes", F.expr(_repeat_words("words")))
    rows = rows.withColumn(
        "lines", F.expr("filter(split(t, '\\n', -1), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')")
    )
    # Most texts repeat no window; only for the others are the hashes sorted.
    rows = rows.withColumn(
        "sorted",
        F.expr(
            "if(size(array_distinct(hashes)) = size(hashes), array(),"
            " sort_array(transform(hashes, (h, i) -> struct(h as h, i as i))))"
        ),
    )
    rows = rows.withColumn(
        "at",
        F.expr(
            "sort_array(transform(filter(transform(sorted, (s, j) -> struct(s.i as i,"
            " coalesce(get(sorted, j - 1).h = s.h, false) or coalesce(get(sorted, j + 1).h = s.h, false) as twice)),"
            " x -> x.twice), x -> x.i))"
        ),
    )
    return rows.select(
        "doc_id",
        "text",
        "doc",
        "t",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered().cast("long").alias("n_repeat_words"),
    )


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, text, the base counts, base_failed, kept, n_lines, n_failed (lines, or sentences of long ones), lost_chars and clean_text."""
    fails = " or ".join(f"({rule})" for rule in line_rules("p").values())
    rows = measured(docs).withColumn("parts", F.expr(f"transform(split(t, '\\n', -1), x -> {_PARTS})"))
    rows = rows.withColumn("good", F.expr(f"transform(parts, x -> filter(x, p -> not ({fails})))"))
    chars = "aggregate({}, 0L, (a, x) -> a + length(array_join(x, '')))"
    count = "aggregate({}, 0L, (a, x) -> a + size(x))"
    return (
        rows.withColumn("all_chars", F.expr(chars.format("parts")))
        .withColumn("lost_chars", F.expr(f"all_chars - {chars.format('good')}"))
        .withColumn(
            "base_failed",
            F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words"),
        )
        .withColumn("kept", F.expr(f"not base_failed and 100 * lost_chars <= {MAX_LOST} * all_chars"))
        .select(
            "doc_id", "text", "doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "n_lines",
            F.expr(f"{count.format('parts')} - {count.format('good')}").alias("n_failed"),
            "lost_chars",
            F.expr("array_join(transform(filter(good, x -> size(x) > 0), x -> array_join(x, '')), '\n')").alias("clean_text"),
        )
    )


def verdicts(docs: DataFrame) -> DataFrame:
    return judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text", "doc", "clean_text")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that are kept, their failing lines removed; n_chars, if there, counts the changed text."""
    # The row number keeps the optimizer from unfolding the whole judgement into the filter, many times over.
    rows = judged(docs).withColumn("number", F.monotonically_increasing_id())
    clean = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    fields = [
        F.when(F.col("n_failed") > 0, clean[c]).otherwise(F.col(f"doc.`{c}`")).alias(c) if c in clean else F.col(f"doc.`{c}`").alias(c)
        for c in docs.columns
    ]
    return rows.where("kept and number >= 0").select(*fields)
