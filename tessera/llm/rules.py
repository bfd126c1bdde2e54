"""Line-first cleaning, in DataFrame functions only.

Each line is judged by punctuation, navigation and boilerplate rules; failing lines go, and a
document that loses too large a part of its words is rejected. Beside it, word counts, repeated
lines and repeated five-word windows of the whole text reject a document outright.

Cases: a null text counts as empty and is rejected (no ten words); repeated rows are judged each; an
empty table gives an empty result; other columns of df stay as they are, and where one has the name
of a result it is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Words of a window, and the rules of the base: too few words, too many repeated (percent).
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Punctuation that ends a line of prose; a line of up to TITLE_WORDS may go without, as titles do.
ENDS = r"[.!?…。！？:;,\"'”’»)\]][\x20\x09-\x0D]*\z"
TITLE_WORDS = 8
#: Words that stand between the labels of a menu, and the percentage of them that a line of prose may hold.
SEPARATORS = "|»›·•/"
MOST_SEPARATORS = 20
#: Marks per hundred words that prose may carry: runs of symbols, or of exclamation marks.
MARKS = SYMBOLS + "+|!!+"
MOST_MARKS = 30
#: Short lines with these say nothing of a document's own.
BOILERPLATE = (
    "cookie (policy|settings|consent)", "accept (all )?cookies", "all rights reserved", "terms (of (use|service)|and conditions)",
    "privacy policy", "subscribe to our", "javascript (is|must be) (enabled|disabled)", "lorem ipsum", "back to top", "skip to content",
)
BOILERPLATE_WORDS = 20
#: Percentage of its words that a document may lose.
MOST_LOST = 50
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_words", "cleaned", "kept")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def line_fails(line: Column) -> Column:
    """Whether a line is no line of prose; a line without a word never fails."""
    separators = F.regexp_count(line, F.lit(rf"(?<![^\x20\x09-\x0D])[{SEPARATORS}](?![^\x20\x09-\x0D])"))

    def fails(n: Column) -> Column:
        return (
            ((n > TITLE_WORDS) & ~line.rlike(ENDS))
            | ((n > 2) & (100 * F.regexp_count(line, F.lit(MARKS)) > MOST_MARKS * n))
            | ((n > 0) & (100 * separators > MOST_SEPARATORS * n))
            | ((n > 0) & (n <= BOILERPLATE_WORDS) & F.lower(line).rlike("|".join(BOILERPLATE)))
        )

    return F.exists(F.array(F.regexp_count(line, F.lit(WORD))), fails)  # words are counted once


def judge(df: DataFrame, text_col: str = "text", most_lost: int = MOST_LOST) -> DataFrame:
    """df with RESULTS: the counts, base_failed, lost_words (in removed lines), cleaned (the text
    without these) and kept (neither failed nor more than most_lost percent of the words lost).
    """
    own = [c for c in df.columns if c.lower() not in RESULTS]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = df.select(*own, text.alias("_text"))
    out = out.select(*own, "_text", words_of(F.col("_text")).alias("_words"), F.split("_text", "\n").alias("_lines"))
    n = F.size("_words")
    window = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(WINDOW))))
    out = out.select(
        *own,
        "_text",
        n.cast("long").alias("n_words"),
        F.filter("_lines", lambda x: x.rlike(WORD)).alias("_full"),
        F.when(n > WINDOW, window).otherwise(F.array().cast("array<bigint>")).alias("_h"),
        F.filter("_lines", lambda x: ~line_fails(x)).alias("_good"),
        F.size("_lines").alias("_n_lines"),
    )
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    out = out.select(
        *own,
        "_text",
        "n_words",
        (F.length("_text") - F.regexp_count("_text", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_good") == F.col("_n_lines"), F.col("_text")).otherwise(F.array_join("_good", "\n")).alias("cleaned"),
        F.when(repeats, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"),
    )
    # Windows are compared by 64-bit hashes; only where two are equal are their places looked for.
    place = F.transform("_sorted", lambda s, j: F.when((s.h == F.get(F.col("_sorted"), j - 1).h) | (s.h == F.get(F.col("_sorted"), j + 1).h), s.i))
    kept_words = F.when(F.length("cleaned") == F.length("_text"), F.col("n_words")).otherwise(F.regexp_count("cleaned", F.lit(WORD)).cast("long"))
    out = out.select(*[c for c in out.columns if c not in ("_sorted", "_text")], kept_words.alias("_kept"), F.sort_array(F.filter(place, lambda p: p.isNotNull())).alias("_places"))
    gaps = F.transform("_places", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), j + 1) - p, F.lit(WINDOW))))
    out = out.select(*[c for c in out.columns if c != "_places"], F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("lost_words", F.col("n_words") - F.col("_kept"))
    out = out.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_words") <= most_lost * F.col("n_words")))
    # Results pass through a generator: filters on them are not pushed below it, where every count
    # would be written out once for each use.
    return out.select(*own, F.explode(F.array(F.struct(*RESULTS))).alias("_r")).select(*own, "_r.*")


def clean(df: DataFrame, text_col: str = "text", most_lost: int = MOST_LOST) -> DataFrame:
    """The rows that judge keeps, in the columns of df, with the text cleaned."""
    names = [f"_c{i}" for i in range(len(df.columns))]  # none is the name of a result
    at = names[df.columns.index(text_col)]
    judged = judge(df.toDF(*names), at, most_lost)
    own = [F.col("cleaned" if c == at else c).cast(f.dataType).alias(f.name) for c, f in zip(names, df.schema.fields, strict=True)]
    return judged.where("kept").select(*own)


_S = r"[\x20\x09-\x0D]"
#: judge() in DuckDB SQL over documents, written out on its own.
SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d),
wins AS (SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) > 5),
same AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(list_slice(ws, i, i + 4), ' ')) AS n FROM wins),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM same, range(5) t(k) WHERE n > 1 GROUP BY r),
lines AS (SELECT r, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT r, unnest(ls) AS x FROM w)),
bad AS (SELECT r, n, x, (n > {TITLE_WORDS} AND NOT regexp_matches(x, '[.!?…。！？:;,"''”’»)\]][\x20\x09-\x0D]*\z'))
    OR (n > 2 AND 100 * len(regexp_extract_all(x, '[#*$%&|<>]+|!!+')) > {MOST_MARKS} * n)
    OR (n > 0 AND 100 * len(list_filter(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), lambda v: v IN ({", ".join(f"'{c}'" for c in SEPARATORS)}))) > {MOST_SEPARATORS} * n)
    OR (n > 0 AND n <= {BOILERPLATE_WORDS} AND regexp_matches(lower(x), '{"|".join(BOILERPLATE)}')) AS fails FROM lines),
l AS (SELECT r, cast(count(*) FILTER (WHERE n > 0) - count(DISTINCT x) FILTER (WHERE n > 0) AS bigint) AS n_dup_lines, coalesce(sum(n) FILTER (WHERE fails), 0) AS lost FROM bad GROUP BY r),
c AS (SELECT doc_id, cast(len(ws) AS bigint) AS n_words, cast(len(t) - len(regexp_extract_all(t, '{_S}')) AS bigint) AS word_chars,
    cast(len(regexp_extract_all(t, '[#*$%&|<>]')) AS bigint) AS n_symbols, n_dup_lines, cast(coalesce(covered.n, 0) AS bigint) AS n_repeat_words, lost
    FROM w JOIN l USING (r) LEFT JOIN covered USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
    NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND 100 * lost <= {MOST_LOST} * n_words AS kept FROM c"""
