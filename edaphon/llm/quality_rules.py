"""Line-first cleaning: rules judge lines, failing lines go, documents that lose too much go.

Everything is array and string functions of the scan: no shuffle, no Python.

Defined cases: a NULL text has no words and no lines and is rejected; blank lines are neither
judged nor counted; equal rows are judged alike; columns of the input stay beside the results,
and a clashing name is replaced by the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edaphon.llm.base import GAP_CHARS, count_of, words

# The base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Line rules.
SEPARATORS = "|»•›·"
BOILERPLATE = (
    "(?i)all rights reserved|licensed under|released under the|privacy policy|terms of (use|service)|"
    "cookie (policy|settings)|enable javascript|subscribe to our|sign up for|click here|"
    "skip to (main )?content|follow us on|share this (page|post|article)"
)
#: Longer lines are text that mentions a phrase, not boilerplate.
BOILERPLATE_WORDS = 30
SYMBOL_SHARE = 0.1
UNPUNCTUATED_WORDS = 20
MIN_KEPT_SHARE = 0.5


def line_words(line: Column) -> Column:
    """Words of one line: its gaps, counted after squeezing."""
    return F.size(F.filter(F.split(line, "[ \\t-\\r]+"), lambda w: w != ""))


def line_fails(line: Column, n: Column) -> Column:
    """Whether a line with ``n`` words breaks a rule."""
    symbols, marks = count_of(line, SYMBOLS), count_of(line, SEPARATORS)
    shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    return (
        (symbols > SYMBOL_SHARE * F.length(line))  # marks instead of prose
        | ((shouts >= 3) & (shouts * 4 >= n))  # shouted
        | ((marks >= 2) & (marks * 8 >= n))  # navigation
        | ((n >= UNPUNCTUATED_WORDS) & ~line.rlike("[.,;:!?…。、！？]"))  # no sentence anywhere
        | ((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE))
    )


def repeat_words(grams: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, from the window hashes in order."""
    seen = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        twice = F.transform(
            s,
            lambda x, k: F.when(
                (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]
            ),
        )
        return F.sort_array(F.filter(twice, lambda i: i.isNotNull()))

    covered = F.aggregate(
        starts(F.col("_seen")),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return seen, covered


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the figures the rules read, and ``_lines``, ``_kept_lines`` for what follows."""
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_words", words(F.col(text))).withColumn("n_words", F.size("_words").cast("long"))
    grams = F.when(
        F.col("n_words") >= 3,
        F.transform(
            F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int")),
            lambda i: F.xxhash64(F.get(F.col("_words"), i), F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)),
        ),
    )
    out = out.withColumn("_grams", grams)
    seen, covered = repeat_words(F.col("_grams"))
    out = out.withColumn("_seen", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), seen)).drop("_words", "_grams")
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_seen")
    lines = F.transform(
        F.split(body, "\n"), lambda line: F.struct(line.alias("line"), line_words(line).alias("n"))
    )
    out = out.withColumn("_lines", lines)
    spoken = F.transform(F.filter(F.col("_lines"), lambda x: x["n"] > 0), lambda x: x["line"])
    kept = F.filter(F.col("_lines"), lambda x: (x["n"] == 0) | ~line_fails(x["line"], x["n"]))
    return (
        out.withColumn("word_chars", F.length(F.translate(body, GAP_CHARS, "")).cast("long"))
        .withColumn("n_symbols", count_of(body, SYMBOLS))
        .withColumn("_spoken", spoken)
        .withColumn("n_dup_lines", (F.size("_spoken") - F.size(F.array_distinct("_spoken"))).cast("long"))
        .withColumn("_kept_lines", kept)
    )


def apply_rules(docs: DataFrame, text: str = "text", min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """``docs`` with figures, ``base_failed``, ``kept_words``, ``clean_text`` and ``kept``."""
    out = measure(docs, text)
    kept_words = F.aggregate(F.col("_kept_lines"), F.lit(0), lambda a, x: a + x["n"]).cast("long")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        out.withColumn("kept_words", kept_words)
        .withColumn("clean_text", F.array_join(F.transform("_kept_lines", lambda x: x["line"]), "\n"))
        .withColumn("base_failed", base_failed)
        .withColumn(
            "kept",
            ~F.col("base_failed") & (F.col("kept_words") > 0) & (F.col("kept_words") >= min_kept_share * F.col("n_words")),
        )
        .drop("_lines", "_kept_lines", "_spoken")
    )


def kept_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that ``apply_rules`` keeps, with its columns. The row number keeps the optimizer from
    moving the test below the figures it is made of, which would write them out once for each use."""
    out = apply_rules(docs, text, **options).withColumn("_row", F.monotonically_increasing_id())
    return out.filter(F.col("kept") & (F.col("_row") >= 0)).drop("_row")


def rules_sql() -> str:
    """The figures and verdicts of ``apply_rules`` over ``documents`` in DuckDB's SQL."""
    gap = "'[ \\t-\\r]+'"
    fails = f"""(length(line) - length(translate(line, '{SYMBOLS}', '')) > {SYMBOL_SHARE!r}::double * length(line)
      or (shouts >= 3 and shouts * 4 >= n) or (marks >= 2 and marks * 8 >= n)
      or (n >= {UNPUNCTUATED_WORDS} and not regexp_matches(line, '[.,;:!?…。、！？]'))
      or (n <= {BOILERPLATE_WORDS} and regexp_matches(line, '{BOILERPLATE}')))"""
    return f"""
with texts as (select doc_id, coalesce(text, '') t from documents),
spoken as (select doc_id, t, list_filter(regexp_split_to_array(t, {gap}), lambda w: w <> '') ws from texts),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) times
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) i from spoken)
),
repeated as (
  select doc_id, count(distinct j) n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) j from windows where times > 1) group by doc_id
),
lines as (
  select doc_id, line, len(list_filter(regexp_split_to_array(line, {gap}), lambda w: w <> '')) n,
    (length(line) - length(replace(line, '!!', ''))) / 2 shouts,
    length(line) - length(translate(line, '{SEPARATORS}', '')) marks
  from (select doc_id, unnest(string_split(t, chr(10))) line from texts)
),
judged as (
  select doc_id, count(*) - count(distinct line) n_dup_lines, coalesce(sum(n) filter (not {fails}), 0)::bigint kept_words
  from lines where n > 0 group by doc_id
),
figures as (
  select s.doc_id, len(ws) n_words, length(regexp_replace(t, {gap}, '', 'g')) word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) n_symbols, coalesce(n_dup_lines, 0) n_dup_lines,
    coalesce(n_repeat_words, 0) n_repeat_words, coalesce(kept_words, 0) kept_words
  from spoken s left join judged j on s.doc_id = j.doc_id left join repeated r on s.doc_id = r.doc_id
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed as base_failed,
  not failed and kept_words > 0 and kept_words >= {MIN_KEPT_SHARE!r}::double * n_words as kept, kept_words
from (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as failed from figures)"""
