"""Quality rules: a table of thresholds compiled into one Spark projection.

Every text is measured by Spark's own functions (lengths, symbol counts,
repeated lines and word windows, stop words, line shapes). The threshold table
then turns into boolean columns of the same projection; nothing leaves the JVM.

Defined cases: a null text counts as empty; an empty or blank text has no words
and fails the base rule; an empty table gives an empty table; repeated rows and
ties are judged each on their own; only the text column is read, so other
columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on are this from or at an "
    "der die das und in zu den mit von ist auf für sich nicht ein eine dem "
    "le la les de des du et un une est en que qui dans pour sur pas par "
    "el los las y en un una que por con para del al se es su"
).split()


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _has_word(text: Column) -> Column:
    return F.length(F.translate(text, BLANKS, "")) > 0


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more in the text."""

    def covered(s: Column) -> Column:
        twin = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
        places = F.sort_array(F.transform(F.filter(s, lambda x, k: F.coalesce(twin(x, k), F.lit(False))), lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda acc, x: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n"), x.alias("last"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_bind(ordered, covered))


def measure(df: DataFrame, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and the counts of every text that the rules compare.

    Window hashes take the eight word hashes of a window in order, 64 bits.
    """
    keep = keep or []
    texts = df.select(*[df[c] for c in keep], text_of(df, column).alias("_text"))
    t = F.col("_text")
    words = texts.select(
        *keep, "_text",
        F.filter(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(t, "\n"), _has_word).alias("_lines"))
    w, lines = F.col("_words"), F.col("_lines")
    windows = F.when(
        F.size(w) >= WINDOW,
        _bind(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = words.select(*keep, "_text", "_words", "_lines", windows.alias("_windows"))
    is_stop = lambda x: F.lower(F.rtrim(x, F.lit(".,"))).isin(STOP_WORDS)
    share = {
        "n_chars": F.length(t),
        "n_words": F.size(w),
        "word_chars": _without(t, BLANKS),
        "n_symbols": F.length(t) - _without(t, SYMBOLS),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(F.col("_windows")),
        "n_stop": F.size(F.filter(w, is_stop)),
        "n_distinct": F.size(F.array_distinct(w)),
        "n_upper": F.length(F.regexp_replace(t, "[^\\p{Lu}]+", "")),
        "n_digits": F.length(t) - _without(t, "0123456789"),
        "n_marks": F.length(t) - _without(t, "!?"),
        "n_stops": F.length(t) - _without(t, ".,"),
        "n_bullets": F.size(F.filter(lines, lambda x: F.ltrim(x).rlike("^[-*•] "))),
        "n_open": F.size(F.filter(lines, lambda x: F.rtrim(x).rlike("(\\.\\.\\.|…)$"))),
    }
    return hashed.select(*keep, *[e.cast("long").alias(n) for n, e in share.items()])


@dataclass(frozen=True)
class Rule:
    """Reject if 100 * part is over (or under) ``percent`` * whole, from ``words`` words on."""

    name: str
    part: str
    whole: str
    percent: int
    over: bool = True
    words: int = 0

    def broken(self) -> Column:
        part, bound = F.col(self.part) * 100, F.col(self.whole) * self.percent
        return (F.col("n_words") >= self.words) & ((part > bound) if self.over else (part < bound))

    def sql(self) -> str:
        sign = ">" if self.over else "<"
        return f"(n_words >= {self.words} AND 100 * {self.part} {sign} {self.percent} * {self.whole})"


#: The threshold table.
RULES = (
    Rule("symbols", "n_symbols", "word_chars", 8),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 30),
    Rule("long_words", "word_chars", "n_words", 1500),
    Rule("short_words", "word_chars", "n_words", 200, over=False),
    Rule("few_stop_words", "n_stop", "n_words", 2, over=False, words=50),
    Rule("upper_case", "n_upper", "word_chars", 50),
    Rule("marks", "n_marks", "word_chars", 8),
    Rule("bullet_lines", "n_bullets", "n_lines", 90),
    Rule("open_lines", "n_open", "n_lines", 30),
)


def base_failed() -> Column:
    """The rule that holds whatever the threshold table says."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def apply_rules(df: DataFrame, keep: list[str], column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per text: ``keep``, the counts, ``base_failed``, ``broken`` (names of the rules) and ``kept``."""
    counts = measure(df, column, keep)
    broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    judged = counts.withColumns({"base_failed": base_failed(), "broken": broken})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


OUTPUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def query(spark, docs: DataFrame) -> DataFrame:
    """The rules over every document, with the counts that they are judged by."""
    return apply_rules(docs, ["doc_id"]).select("doc_id", *OUTPUT, F.array_join("broken", ",").alias("broken"))


def check_sql() -> str:
    """The same in DuckDB: windows are compared as joined text instead of hashes."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    broken = " || ".join(f"CASE WHEN {r.sql()} THEN ['{r.name}'] ELSE [] END" for r in RULES)
    any_broken = " OR ".join(r.sql() for r in RULES)
    blank = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT doc_id, row, t, regexp_extract_all(t, '{blank}+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{blank}')) AS lines FROM texts
), places AS (
  SELECT row, unnest(range(1, len(w) - {WINDOW - 2})) AS i,
         unnest(list_transform(range(1, len(w) - {WINDOW - 2}), lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' '))) AS g
  FROM words WHERE len(w) >= {WINDOW}
), windows AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, g) AS times FROM places
), covered AS (
  SELECT row, sum(least({WINDOW}, coalesce(gap, {WINDOW}))) AS n FROM (
    SELECT row, i - lag(i) OVER (PARTITION BY row ORDER BY i) AS gap FROM windows WHERE times > 1) GROUP BY row
), counts AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(rtrim(x, '.,')) IN ({stop}))) AS n_stop,
         length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS n_upper,
         length(t) - length(regexp_replace(t, '[!?]+', '', 'g')) AS n_marks,
         len(list_filter(lines, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•] '))) AS n_bullets,
         len(list_filter(lines, lambda x: regexp_matches(rtrim(x, ' '), '(\\.\\.\\.|…)$'))) AS n_open
  FROM words LEFT JOIN covered USING (row)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({any_broken}) AS kept, array_to_string({broken}, ',') AS broken
FROM judged"""
