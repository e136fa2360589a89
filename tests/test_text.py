"""Review-text cleaning and lexicon sentiment."""

import pytest

from bazaar.functions.text import clean_text
from bazaar.operators.lexicon import lexicon_polarity, review_sentiment, sentiment
from bazaar.plans.marts import sentiments
from bazaar.sources.dimensions import STOPWORDS_PT

LEX = {"bom": 0.5, "ruim": -0.75, "ótimo": 1.0, "chegou": 0.0}


def lexicon(spark, weights=LEX):
    return spark.createDataFrame(list(weights.items()), "word string, weight double")


def _map(df, key, col):
    return {r[key]: r[col] for r in df.collect()}


def test_stopwords_are_the_public_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(STOPWORDS_PT) == StopWordsRemover.loadDefaultStopWords("portuguese")


def test_clean_text(spark):
    rows = [(1, "Muito BOM!!! Chegou, rápido :)"), (2, "O produto é de ótima qualidade"),
            (3, ""), (4, None), (5, "123 ... ###"), (6, "Preço×qualidade ÷ ok")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = _map(clean_text(df, "text"), "id", "clean_text")
    assert got[1] == "bom chegou rápido"          # 'muito' is a stop word
    assert got[2] == "produto é ótima qualidade"  # 'o', 'de' removed; Spark's list keeps 'é'
    assert got[3] == "" and got[4] is None and got[5] == ""
    assert got[6] == "preço×qualidade ÷ ok"       # U+00D7 and U+00F7 are inside the kept range


def test_polarity_and_classes(spark):
    rows = [(1, "bom"), (2, "Bom!"), (3, "ruim ruim bom"), (4, "chegou"), (5, "nada aqui"),
            (6, ""), (7, None), (8, "!!!"), (9, "ótimo e bom"), (10, "recomendo")]
    df = spark.createDataFrame(rows, "id int, text string")
    pol = _map(lexicon_polarity(df, "text", lexicon(spark), "id"), "id", "polarity")
    assert pol[1] == 0.4 and pol[2] == 0.4 and pol[10] == 0.4    # override words as whole text
    assert pol[3] == (-0.75 - 0.75 + 0.5) / 3
    assert pol[4] == 0.0 and pol[5] == 0.0                        # no opinion word
    assert pol[6] is None and pol[7] is None and pol[8] is None   # empty after cleaning
    assert pol[9] == 0.75
    cls = _map(sentiment(df, "text", lexicon(spark), "id"), "id", "sentiment")
    assert cls == {1: "positive", 2: "positive", 3: "negative", 4: "neutral", 5: "neutral",
                   6: "Error", 7: "neutral", 8: "neutral", 9: "positive", 10: "positive"}


def test_review_sentiment_falls_back_to_score(spark):
    rows = [(1, None, None, 5), (2, None, None, 2), (3, None, None, None), (4, "ruim", None, 5),
            (5, None, "bom", 1), (6, None, None, 3)]
    df = spark.createDataFrame(rows, "id int, title string, message string, score int")
    got = _map(review_sentiment(df, "title", "message", "score", lexicon(spark), "id"), "id", "sentiment")
    assert got == {1: "positive", 2: "negative", 3: None, 4: "negative", 5: "positive", 6: "neutral"}


@pytest.mark.parametrize("size", [0, 300, 250_000])
def test_lexicons_of_any_size(spark, size):
    rows = [(1, "bom bom ruim"), (2, "nada"), (3, ""), (4, "ótimo, chegou"), (5, "recomendo"), (6, None), (7, "wc wd")]
    df = spark.createDataFrame(rows, "id int, text string")
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda i: "w" + (letters[i % 26] + (name(i // 26)[1:] if i >= 26 else ""))
    lex = lexicon(spark, LEX | {name(i): (i % 5) / 4 for i in range(size)})
    pol = _map(lexicon_polarity(df, "text", lex, "id"), "id", "polarity")
    want = {1: (0.5 + 0.5 - 0.75) / 3, 2: 0.0, 3: None, 4: 0.5, 5: 0.4, 6: None, 7: (0.5 + 0.75) / 2 if size else 0.0}
    assert pol == want
    assert _map(sentiment(df, "text", lex, "id"), "id", "sentiment") == {
        1: "neutral", 2: "neutral", 3: "Error", 4: "positive", 5: "positive", 6: "neutral",
        7: "positive" if size else "neutral"}
    reviews = df.selectExpr("string(id) review_id", "'o' order_id", "text review_comment_title",
                            "string(null) review_comment_message", "2 review_score")
    got = _map(sentiments(reviews, lex), "review_id", "sentiment")
    assert got["1"] == "neutral" and got["6"] == "negative" and len(got) == 7


def test_texts_stay_out_of_the_join(spark):
    df = spark.createDataFrame([(1, "bom")], "id int, text string")
    plan = lexicon_polarity(df, "text", lexicon(spark), "id")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hash" in line]
    assert exchanges and not any("text" in line or "clean" in line for line in exchanges)


def test_key_of_several_columns_and_null_words(spark):
    df = spark.createDataFrame([("a", 1, "bom"), ("a", 2, "ruim"), ("b", 1, "bom ruim")], "k string, n int, text string")
    lex = spark.createDataFrame([("bom", 0.5), (None, 9.0), ("ruim", None)], "word string, weight double")
    got = {(r.k, r.n): r.polarity for r in lexicon_polarity(df, "text", lex, ["k", "n"]).collect()}
    assert got == {("a", 1): 0.4, ("a", 2): 0.0, ("b", 1): 0.5}


def test_rows_of_one_key_are_scored_apart(spark):
    rows = [("k", "produto bom"), ("k", "produto ruim ruim"), (None, "bom"), (None, "ruim"), (None, None), ("k", "produto bom"),
            (None, "")]
    df = spark.createDataFrame(rows, "id string, text string").repartition(3)
    got = sorted(((r.id, r.polarity) for r in lexicon_polarity(df, "text", lexicon(spark), "id").collect()), key=repr)
    assert got == sorted([("k", 0.5), ("k", -0.75), (None, 0.4), (None, -0.75), (None, None), ("k", 0.5), (None, None)], key=repr)
    cls = sorted(((r.id, r.sentiment) for r in sentiment(df, "text", lexicon(spark), "id").collect()), key=repr)
    assert cls == sorted([("k", "positive"), ("k", "negative"), (None, "positive"), (None, "negative"), (None, "neutral"),
                          ("k", "positive"), (None, "Error")], key=repr)
    reviews = spark.createDataFrame([("r", "o", None, None, 5), ("r", "o", None, None, 1), ("r", None, "ruim", None, 5)] * 2,
                                    "review_id string, order_id string, review_comment_title string, review_comment_message string, review_score int")
    got = sorted(r.sentiment for r in sentiments(reviews, lexicon(spark)).collect())
    assert got == ["negative"] * 4 + ["positive"] * 2


def test_a_word_listed_twice_has_its_mean_weight(spark):
    lex = spark.createDataFrame([("bom", 1.0), ("bom", 0.0), ("ruim", -1.0)], "word string, weight double")
    df = spark.createDataFrame([(1, "muito bom mesmo assim bom"), (2, "bom ruim")], "id int, text string")
    assert _map(lexicon_polarity(df, "text", lex, "id"), "id", "polarity") == {1: 0.5, 2: -0.25}


def learned_by_hand(rows, least, fold=None):
    import math
    from collections import Counter

    pos, neg = Counter(), Counter()
    for text, score, f in rows:
        if score is None or 2 < score < 4 or f == fold:
            continue
        (pos if score >= 4 else neg).update(set((text or "").split()))
    n_pos, n_neg, out = sum(pos.values()), sum(neg.values()), {}
    for w in set(pos) | set(neg):
        p, q = pos[w], neg[w]
        if p + q >= least:
            x = (math.log((p + 1) / (n_pos + 2)) - math.log((q + 1) / (n_neg + 2))) * (p + q) / (p + q + 10)
            out[w] = (p, q, round(math.tanh(x / 2) * 64) / 64)
    return out


def test_learned_lexicon(spark):
    import random

    from bazaar.operators.lexicon import learn_lexicon

    rnd = random.Random(2)
    data = []
    for i in range(300):
        good = rnd.random() < 0.6
        own = rnd.choices(["ótimo", "bom", "ruim", "péssimo", "produto"], [4, 3, 1, 1, 3] if good else [1, 1, 4, 3, 3], k=6)
        data.append((i, " ".join(own), rnd.choice([4, 5]) if good else rnd.choice([1, 2]), i % 4))
    data += [(900, None, 5, 0), (901, "bom", None, 1), (902, "ruim", 3, 2), (903, "", 1, 3)]
    df = spark.createDataFrame(data, "id int, text string, score int, fold int")
    got = {r.word: (r.positive, r.negative, r.weight) for r in learn_lexicon(df, "text", "score").collect()}
    assert got == learned_by_hand([d[1:] for d in data], 5)
    assert got["ótimo"][2] > 0.25 and got["péssimo"][2] < -0.25 and abs(got["produto"][2]) < 0.2
    folds = learn_lexicon(df, "text", "score", fold="fold", folds=4)
    assert folds.columns == ["fold", "word", "positive", "negative", "weight"]
    by = {(r.fold, r.word): (r.positive, r.negative, r.weight) for r in folds.collect()}
    for f in range(4):
        assert {w: v for (g, w), v in by.items() if g == f} == learned_by_hand([d[1:] for d in data], 5, f)
    # each row is scored by the lexicon of its own fold
    rows = df.where("score is not null").selectExpr("id", "fold", "text title", "string(null) message", "score")
    cls = _map(review_sentiment(rows, "title", "message", "score", folds, "id", fold="fold"), "id", "sentiment")
    for i, text, score, f in data[:300]:
        weights = [by[f, w][2] for w in text.split() if (f, w) in by]
        mean = sum(weights) / len(weights) if weights else 0.0
        assert cls[i] == ("positive" if mean >= 0.3 else "neutral" if mean >= 0 else "negative"), (text, mean)
    assert learn_lexicon(df.limit(0), "text", "score").collect() == []


def test_learned_lexicon_finds_the_held_out_classes(spark):
    """Documents of quality 0 are told from those of quality 1 by the lexicon
    learned without them."""
    from bazaar.plans.bindings import QUERIES

    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(truth[r.doc_id], r.sentiment) for r in QUERIES["held_out_sentiment"](spark, sf).collect() if r.doc_id in truth]
    share = lambda q, s: sum(x == (q, s) for x in got) / sum(x[0] == q for x in got)
    print({(q, s): round(share(q, s), 3) for q in (0, 1) for s in ("positive", "neutral", "negative")})
    assert share(0, "negative") > share(1, "negative") + 0.15
