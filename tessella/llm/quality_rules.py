"""Quality rules as a short-circuit cascade.

A rule is a Column that is true where a text fails. On a sample bounded in
rows and bytes, taken from the first partitions that have enough rows, each rule's cost (seconds) and
selectivity (share of texts it rejects) are measured;
the rules then run in descending order of rejections per second inside one CASE,
so that a text leaves at its first failed rule and dear rules see few texts.
The order has no influence on the verdict.

Everything is a DataFrame expression; a text's word windows never leave its row.

Defined cases: a null text has no words and fails; an empty text fails; very
long texts are read whole, in time n log n of their words; an empty table gives
an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import SPACES, WORD, documents, let, text_of

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of the sample on which cost and selectivity are measured, and the bytes of a text that may be in it.
SAMPLE_ROWS, SAMPLE_TEXT = 600, 64 << 10


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def removed(text: Column, characters: str) -> Column:
    """How many of these characters the text has."""
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.char_length(F.translate(text, SPACES, "")).cast("long")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))


def duplicate_lines(text: Column) -> Column:
    return let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more.

    Window hashes are sorted with their places; equal neighbours mark repeats.
    """

    def repeats(w: Column) -> Column:
        window = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), window))

    def same(s: Column, x: Column, i: Column) -> Column:
        return F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))

    def covered(p: Column) -> Column:
        gap = lambda i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - F.get(p, i), F.lit(3)))
        every = F.sequence(F.lit(0), F.size(p) - 1)
        return F.when(F.size(p) == 0, F.lit(0)).otherwise(F.aggregate(every, F.lit(0), lambda n, i: n + gap(i)))

    def count(w: Column) -> Column:
        places = lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: same(s, x, i)), lambda x: x["i"]))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(let(repeats(w), places), covered))

    return let(words, count).cast("long")


def base_columns(text: Column) -> dict[str, Column]:
    """The measures, by name; ``n_repeat_words`` and ``n_words`` come from a column ``__words``."""
    return {
        "n_words": F.size("__words").cast("long"),
        "word_chars": word_chars(text),
        "n_symbols": removed(text, SYMBOLS),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(F.col("__words")),
    }


def rules(text: Column, have: dict[str, Column] | None = None) -> dict[str, Column]:
    """The rules by name. ``have`` gives measures that are there already; others come from the text."""
    have = have or {}
    n = have.get("n_words", F.regexp_count(text, F.lit(WORD)).cast("long"))
    chars = have.get("word_chars", word_chars(text))
    repeats = have.get("n_repeat_words", repeated_words(words_of(text)))
    return {
        "few_words": n < 50,
        "repeated_windows": 100 * repeats > 50 * n,
        "symbols": 10 * have.get("n_symbols", removed(text, SYMBOLS)) > n,
        "duplicate_lines": 10 * have.get("n_dup_lines", duplicate_lines(text)) > 3 * F.size(lines_of(text)),
        "capitals": 10 * removed(text, CAPITALS) > 4 * chars,
        "shouting": 10 * removed(text, "!") > 3 * n,
        "word_length": (chars < 2 * n) | (chars > 15 * n),
    }


def sample_of(df: DataFrame) -> list:
    """About an eighth of the texts of up to ``SAMPLE_TEXT`` bytes, told by a hash, up to ``SAMPLE_ROWS``; reads no further partitions than that takes.

    ``df`` has one column, the text; so at most ``SAMPLE_ROWS * SAMPLE_TEXT`` bytes reach the driver.
    """
    text = F.col(f"`{df.columns[0]}`")
    return df.where((F.pmod(F.xxhash64(text), F.lit(8)) == 0) & (F.octet_length(F.coalesce(text.cast("string"), F.lit(""))) <= SAMPLE_TEXT)).take(SAMPLE_ROWS)


def measured_order(df: DataFrame, checks: dict[str, Column]) -> list[str]:
    """Rule names by descending rejections per second.

    ``df`` has the columns that the rules read. A rule's seconds are those of the
    fastest of three runs over the sample, less those of a rule that does nothing;
    rules that reject nothing in the sample come last, the cheap ones first.
    """
    rows = sample_of(df)
    if not rows:
        return list(checks)
    sample = df.sparkSession.createDataFrame(rows, df.schema).coalesce(1)

    def run(fails: Column) -> tuple[int, float]:
        took = []
        for _ in range(3):
            began = time.perf_counter()
            rejected = sample.agg(F.sum(fails.cast("long"))).first()[0] or 0
            took.append(time.perf_counter() - began)
        return rejected, min(took)

    idle = run(F.lit(False))[1]
    found = {name: run(fails) for name, fails in checks.items()}
    cost = {name: max(seconds - idle, 1e-4) for name, (_, seconds) in found.items()}
    return sorted(checks, key=lambda x: (-found[x][0] / cost[x], cost[x]))


def verdict(checks: dict[str, Column], order: list[str]) -> Column:
    """True where no rule fails; rules after the first failed one aren't computed."""
    kept = F.when(checks[order[0]], False)
    for name in order[1:]:
        kept = kept.when(checks[name], False)
    return kept.otherwise(True)


def keep_good(df: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows whose text passes all rules, with all their columns."""
    text = text_of(text_column)
    checks = rules(text)
    # the sample has the text alone, under the name that the rules read
    order = measured_order(df.select(F.col(text_column)), checks)
    return df.where(verdict(checks, order))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = documents(spark, sf_dir).select("doc_id", text_of().alias("text"))
    text = F.col("text")
    base = list(base_columns(text))
    checks = rules(text, {c: F.col(c) for c in base})
    measured = docs.withColumn("__words", words_of(text)).select("doc_id", "text", *(x.alias(c) for c, x in base_columns(text).items()))
    order = measured_order(docs.select("text"), rules(text))
    return measured.select("doc_id", *base, (checks["few_words"] | checks["repeated_windows"]).alias("base_failed"), verdict(checks, order).alias("kept"))


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce("text", '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM hit) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (
  SELECT d.doc_id, t, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals,
    length(t) - length(replace(t, '!', '')) AS shouts
  FROM d JOIN w USING (r) JOIN lines USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 3 * n_lines OR 10 * capitals > 4 * word_chars OR 10 * shouts > 3 * n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM m
"""
