"""Quality rules: a threshold table compiled into one projection of built-in functions.

Words are maximal runs outside ``[\\x20\\x09-\\x0D]``.  Every measure is computed
over the whole text.  A rule row is ``(name, measure, low, high, min_words)`` with
inclusive bounds, either of which may be None; it applies to texts of at least
``min_words`` words, below which a ratio says little.  A document is kept when it
passes the base rules and every row.

Measures
  n_words, word_chars (code points in words), n_symbols (``[#*$%&|<>]``),
  n_lines (lines with a word), n_dup_lines (such lines equal to an earlier one),
  n_repeat_words (words in 5-word windows found twice or more), n_stop_words,
  and the ratios mean_word_length, symbol_ratio (symbols to word_chars),
  stop_ratio, dup_line_ratio, repeat_ratio (each of words or lines).

Edge cases: a null or empty text has zeros everywhere and fails the base rule;
ratios of nothing are 0; a null id is kept as it is; extra columns stay out; a text of
50 words or more in a language other than the four has few stop words and fails that row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the languages served.
STOP_WORDS = {
    "en": "the of and to in a is that it for on was as with be by at are from this or an",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au il elle",
    "es": "de la que el en y a los del se las por un para con no una su al es lo",
}
Rule = tuple[str, str, float | None, float | None, int]
#: The threshold table used by the registered query and the pipeline.
RULES: Sequence[Rule] = (
    ("word length", "mean_word_length", 1.5, 20.0, 10),
    ("symbols", "symbol_ratio", None, 0.06, 0),
    ("stop words", "stop_ratio", 0.05, None, 50),
    ("repeated lines", "dup_line_ratio", None, 0.4, 0),
)
WINDOW = 5


def _covered(starts: Column) -> Column:
    """Words under the windows that start at these sorted positions."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        starts, zero,
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )


def _with_repeat_words(df: DataFrame) -> DataFrame:
    """Append ``_r``: words in windows whose hash, in ``_h``, occurs twice or more.

    Most texts have no such window and a distinct count settles them.  For the
    others one sort puts equal windows side by side.  Each step is a column of its
    own so that it is evaluated once.
    """
    none = F.lit(None)
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn("_s", F.when(repeats, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_k", F.transform("_s", lambda x: x["h"]))
    alike = lambda x, i: F.coalesce(x["h"] == F.get("_k", i + 1), F.lit(False)) | F.coalesce(x["h"] == F.when(i > 0, F.get("_k", i - 1)), F.lit(False))
    df = df.withColumn("_s", F.array_sort(F.transform(F.filter("_s", alike), lambda x: x["i"])))
    return df.withColumn("_r", F.coalesce(F.when(F.col("_s").isNotNull(), _covered(F.col("_s"))).otherwise(none), F.lit(0)).cast("bigint"))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the measures to ``docs``; a struct column ``_q`` keeps clashing names apart until the end."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumn("_w", words).withColumn("_l", lines)
    w, lines = F.col("_w"), F.col("_l")
    windows = F.when(
        F.size(w) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    stop = sorted({x for v in STOP_WORDS.values() for x in v.split()})
    df = _with_repeat_words(df.withColumn("_h", windows))
    q = {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.length(F.array_join(w, "")).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": F.col("_r"),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(stop))).cast("bigint"),
    }
    return df.withColumn("_q", F.struct(*[c.alias(k) for k, c in q.items()])).drop("_w", "_l", "_h", "_s", "_k", "_r")


def ratios() -> dict[str, Column]:
    q = F.col("_q")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return {
        "mean_word_length": share(q["word_chars"], q["n_words"]),
        "symbol_ratio": share(q["n_symbols"], q["word_chars"]),
        "stop_ratio": share(q["n_stop_words"], q["n_words"]),
        "dup_line_ratio": share(q["n_dup_lines"], q["n_lines"]),
        "repeat_ratio": share(q["n_repeat_words"], q["n_words"]),
    }


def compiled(rules: Sequence[Rule]) -> Column:
    """The table as one boolean expression over ``_q``."""
    have = ratios()
    out = F.lit(True)
    for _, measure, low, high, min_words in rules:
        value = have[measure] if measure in have else F.col("_q").getField(measure)
        bounds = F.lit(True)
        if low is not None:
            bounds = bounds & (value >= F.lit(low))
        if high is not None:
            bounds = bounds & (value <= F.lit(high))
        out = out & (bounds | (F.col("_q")["n_words"] < min_words))
    return out


def base_failed() -> Column:
    q = F.col("_q")
    return (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])


def quality(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ...)``."""
    q = F.col("_q")
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["n_lines", "n_stop_words"]
    return measures(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))).select(
        "doc_id", *[q[k].alias(k) for k in first], base_failed().alias("base_failed"),
        (~base_failed() & compiled(rules)).alias("kept"), *[q[k].alias(k) for k in more],
    )


def keep_quality(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns, held in a struct meanwhile so that any names may occur.

    The row number keeps the optimiser from moving the filter below the measures,
    which would copy their expressions into each of its terms.
    """
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"), F.col(f"`{text_col}`").cast("string").alias("text"))
    df = measures(held).withColumn("_row", F.monotonically_increasing_id())
    passed = ~base_failed() & compiled(rules) & (F.col("_row") >= 0)
    return df.where(passed).select("held.*")
