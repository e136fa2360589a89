"""Lexicon sentiment.

The original scores a translated text with a third-party polarity model,
one text per call. Here the polarity of a text is the mean weight of its
words found in a (word, weight) lexicon, a table of any size, with the
original's override words and class thresholds.

One plan for every lexicon: each text becomes a row per word, with its key,
two hashes and a few flags but not the text itself; words meet the lexicon in a
join (Spark broadcasts the lexicon while it is small, and splits frequent words
when it is not), and weights are summed per row, first within each task. Rows
without a word stay in the result, and rows that share a key, null or not, are
each scored on their own text.

``learn_lexicon`` makes such a lexicon from scored reviews; with folds, one for
each fold from the reviews of the others, so that every review can be scored by
words that were learned without it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions.columns import review_score_class, sentiment_class
from bazaar.functions.text import clean_text
from bazaar.sources.dimensions import OVERRIDE_POLARITY, OVERRIDE_WORDS

Key = str | Sequence[str]
GRAIN = 64  # learned weights are multiples of 1/64


def _keys(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _scored(df: DataFrame, text_col: str, lexicon: DataFrame, key: Key, carried: Mapping[str, Column],
            stopwords: Sequence[str] | None, fold: str | None = None) -> DataFrame:
    """key columns, ``__polarity`` and the ``carried`` expressions of the row,
    one row per row of ``df``. ``fold``: a column by which rows choose among
    the lexicons of a table (fold, word, weight)."""
    keys = _keys(key)
    by = [F.col(fold).alias("__fold")] if fold else []
    cleaned = clean_text(df.select(*keys, *by, F.col(text_col).alias("__text"),
                                   *[c.alias(f"__c_{n}") for n, c in carried.items()]),
                         "__text", "__clean", stopwords=stopwords, keep_tokens="__tok")
    flags = {"__empty": F.col("__clean").isNull() | (F.col("__clean") == ""),
             "__fixed": F.coalesce(F.col("__clean").isin(list(OVERRIDE_WORDS)), F.lit(False)),
             # rows of one key are told apart by their text; equal ones are counted, those of a task together
             "__h1": F.xxhash64("__text"), "__h2": F.xxhash64(F.lit("text"), F.col("__text")),
             "__task": F.spark_partition_id()}
    kept = [f"__c_{n}" for n in carried]
    # a null word at the end stands for the row
    words = F.explode(F.concat(F.coalesce("__tok", F.array().cast("array<string>")), F.array(F.lit(None).cast("string"))))
    rows = cleaned.select(*keys, *kept, *["__fold"] * len(by), *[c.alias(n) for n, c in flags.items()], words.alias("__w"))
    # a word that is listed more than once has the mean of its weights
    lex = (lexicon.where(F.col("word").isNotNull() & F.col("weight").isNotNull())
           .groupBy(F.col("word").alias("__w"), *by).agg(F.avg(F.col("weight").cast("double")).alias("__x")))
    own = [*keys, *kept, *flags, *["__fold"] * len(by)]
    sums = (rows.join(lex, ["__w", "__fold"] if by else "__w", "left").groupBy(*own)
            .agg(F.sum("__x").alias("__s"), F.count("__x").alias("__n"), F.count_if(F.col("__w").isNull()).alias("__rows")))
    mean = F.when(F.col("__n") > 0, F.col("__s") / F.col("__n")).otherwise(F.lit(0.0))
    polarity = (F.when(F.col("__empty"), F.lit(None).cast("double"))
                .when(F.col("__fixed"), F.lit(float(OVERRIDE_POLARITY))).otherwise(mean))
    each = sums.withColumn("__one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__rows"))))
    return each.select(*keys, polarity.alias("__polarity"), *[F.col(f"__c_{n}").alias(n) for n in carried])


def lexicon_polarity(df: DataFrame, text_col: str, lexicon: DataFrame, key: Key, out: str = "polarity",
                     stopwords: Sequence[str] | None = None) -> DataFrame:
    """(key, polarity) of a text column, cleaned first with X1-X4.

    An override word as the whole text has the fixed polarity; a text that is
    empty after cleaning, or null, has none; otherwise the mean weight of the
    words in the lexicon (0.0 when none is there, as a polarity model scores
    text without opinion words). ``lexicon``: (word, weight); a word given more
    than once has the mean of its weights. ``key``: the column or columns that
    name a row; one row comes out for each row, also where keys are null or
    repeated. An empty table gives an empty one.
    """
    return _scored(df, text_col, lexicon, key, {}, stopwords).withColumnRenamed("__polarity", out)


def sentiment(df: DataFrame, text_col: str, lexicon: DataFrame, key: Key, out: str = "sentiment",
              stopwords: Sequence[str] | None = None) -> DataFrame:
    """(key, class). '' -> 'Error' (T30); else the polarity class (F16),
    where a missing polarity (null or cleaned-away text) is 'neutral' (T28,
    T29)."""
    blank = {"__blank": F.coalesce(F.col(text_col) == "", F.lit(False))}
    scored = _scored(df, text_col, lexicon, key, blank, stopwords)
    cls = F.when(F.col("__blank"), F.lit("Error")).otherwise(sentiment_class("__polarity"))
    return scored.select(*_keys(key), cls.alias(out))


def review_sentiment(df: DataFrame, title: str, message: str, score: str, lexicon: DataFrame, key: Key,
                     out: str = "sentiment", stopwords: Sequence[str] | None = None, fold: str | None = None) -> DataFrame:
    """(key, class) from title and message; when both are null, the class
    of the review score (F15). ``fold``: the column that chooses among the
    lexicons of ``learn_lexicon`` with folds."""
    text = F.concat_ws(" ", F.col(title), F.col(message))
    missing = F.col(title).isNull() & F.col(message).isNull()
    by = [F.col(fold).alias("__lexicon")] if fold else []
    rows = df.select(*_keys(key), *by, F.when(~missing, text).alias("__body"), missing.alias("__missing"),
                     F.col(score).alias("__score"))
    if fold:
        lexicon = lexicon.withColumnRenamed(fold, "__lexicon")
    carried = {"__blank": F.coalesce(F.col("__body") == "", F.lit(False)), "__missing": F.col("__missing"),
               "__score": F.col("__score")}
    scored = _scored(rows, "__body", lexicon, key, carried, stopwords, "__lexicon" if fold else None)
    by_text = F.when(F.col("__blank"), F.lit("Error")).otherwise(sentiment_class("__polarity"))
    cls = F.when(F.col("__missing"), review_score_class("__score")).otherwise(by_text)
    return scored.select(*_keys(key), cls.alias(out))


def learn_lexicon(reviews: DataFrame, text_col: str, score_col: str, least: int = 5, prior: float = 1.0,
                  shrink: float = 10.0, fold: str | None = None, folds: int = 5,
                  stopwords: Sequence[str] | None = None) -> DataFrame:
    """(word, positive, negative, weight) from scored reviews.

    positive and negative: reviews of that score class (F15) that hold the
    word; others are left out. The difference of the word's smoothed log odds,
    x = ln((p + prior) / (P + 2 prior)) - ln((q + prior) / (N + 2 prior)), is
    shrunk by n / (n + shrink), n = p + q, and mapped to (e^x - 1) / (e^x + 1),
    which lies in [-1, 1]. P and N are the sums of p and q over all words, so
    that a class of longer reviews doesn't make every word one of its own. Weights are whole multiples of 1/64, so that sums of
    them are exact. Words of fewer than ``least`` reviews are left out.

    With ``fold``, a column of integers from 0 to ``folds`` - 1, the result has
    a lexicon for each (fold, word), from the reviews of the other folds: the
    counts of all less those of the fold. A null text has no words; an empty
    table gives an empty lexicon.
    """
    own = F.col(fold).cast("int") if fold else F.lit(0)
    cls = review_score_class(score_col)
    judged = (clean_text(reviews.select(F.col(text_col).alias("__text"), (cls == "positive").cast("int").alias("p"), own.alias("fold"),
                                        cls.alias("__class")).where(F.col("__class").isin("positive", "negative")),
                         "__text", "__clean", stopwords=stopwords, keep_tokens="__tok"))
    counts = [F.sum("p").alias("p"), F.sum(1 - F.col("p")).alias("q")]
    words = judged.select("fold", "p", F.explode(F.array_distinct("__tok")).alias("word")).groupBy("word", "fold").agg(*counts)
    totals = words.groupBy("fold").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))

    def others(df: DataFrame, by: list[str], p: str, q: str) -> DataFrame:
        """For each fold, the sums over all others; of a few numbers a key."""
        if not fold:
            return df.groupBy(*by, "fold").agg(F.sum("p").alias(p), F.sum("q").alias(q))
        of = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("p", "q"))))
        summed = df.groupBy(*by).agg(F.sum("p").alias("all_p"), F.sum("q").alias("all_q"), of.alias("of"))
        each = summed.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        mine = F.col("of")[F.col("fold")]
        return each.select(*by, "fold", (F.col("all_p") - F.coalesce(mine["p"], F.lit(0))).alias(p),
                           (F.col("all_q") - F.coalesce(mine["q"], F.lit(0))).alias(q))

    seen = others(words, ["word"], "positive", "negative")
    if fold:
        seen = seen.join(others(totals, [], "P_", "N_"), "fold")
    else:
        seen = seen.withColumns({"P_": totals.agg(F.sum("p")).scalar(), "N_": totals.agg(F.sum("q")).scalar()})
    p, q, n = F.col("positive"), F.col("negative"), F.col("positive") + F.col("negative")
    odds = F.log((p + prior) / (F.col("P_") + 2 * prior)) - F.log((q + prior) / (F.col("N_") + 2 * prior))
    e = F.exp(odds * n / (n + shrink))
    weight = F.round((e - 1) / (e + 1) * GRAIN) / GRAIN
    by = [F.col("fold").alias(fold)] if fold else []
    return seen.where(n >= least).select(*by, "word", "positive", "negative", weight.alias("weight"))
