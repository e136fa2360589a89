"""Review-text cleaning (X1-X4) as built-in column expressions.

Pipeline per text: non-letters -> space, lower case, split on runs of
spaces, drop stop words, join with one space. Word tokenisation of the
original is re-aimed: its list punctuation vanishes under the letters-only
step, so splitting the cleaned text gives the same words except where a
tokenizer splits contractions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.sources.dimensions import STOPWORDS_PT

# Fixed value: the character class kept by the letters-only step (ASCII
# letters and U+00C0..U+00FF).
LETTERS_PATTERN = "[^a-zA-ZÀ-ÿ]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Upper-case letters of the kept class and their lower-case forms, built by
# rule: A-Z and U+00C0..U+00DE except U+00D7 (multiplication sign).
_UPPER = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1)) + "".join(
    chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)
_LOWER = _UPPER.lower()


def tokens(text) -> Column:
    """Lower-cased words of the letters-only text (no empties).

    Same words as letters-only -> lower -> split on spaces, computed as:
    lower-case the kept letters with ``translate`` (the only upper-case
    characters that survive the letters-only step are A-Z and U+00C0..U+00DE,
    whose lower-case forms stay in the class), then split on runs of
    characters outside the class and drop the empty ends. No
    higher-order function, no second regex pass.
    """
    lowered = F.translate(_c(text), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, LETTERS_PATTERN + "+"), "")


def clean_text(df: DataFrame, text_col: str, out_col: str = "clean_text",
               stopwords: Sequence[str] | None = None, keep_tokens: str | None = None) -> DataFrame:
    """X1-X4 on a text column: letters only, lower, split, drop stop words,
    rejoin with single spaces. NULL text stays NULL.

    Stop words go through ``StopWordsRemover`` (hash-set lookup per token);
    everything else is a built-in expression, so the whole step is one
    narrow pass with no shuffle.
    """
    from pyspark.ml.feature import StopWordsRemover

    words = list(stopwords) if stopwords is not None else list(STOPWORDS_PT)
    tmp_in, tmp_out = f"__{out_col}_tok", f"__{out_col}_kept"
    # the remover rejects a NULL array: NULL text tokenises as empty, the
    # result is set back to NULL below
    tokenised = df.withColumn(tmp_in, tokens(F.coalesce(F.col(text_col), F.lit(""))))
    remover = StopWordsRemover(inputCol=tmp_in, outputCol=tmp_out, stopWords=words,
                               caseSensitive=True)
    kept = remover.transform(tokenised)
    out = kept.withColumn(out_col, F.when(F.col(text_col).isNotNull(),
                                          F.array_join(F.col(tmp_out), " ")))
    if keep_tokens:
        out = out.withColumnRenamed(tmp_out, keep_tokens)
    return out.drop(tmp_in, tmp_out)
