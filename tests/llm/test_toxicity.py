import numpy as np

from bazaar.llm.common import table
from bazaar.llm.queries import op5_toxicity, severity_grades, toxicity_model
from bazaar.llm.toxicity import (FALSE_POSITIVES, FOLDS, PRIOR_HELD, SPAN, THRESHOLD, Model, _fit_folds, _fit_ordinal,
                                 _lowest_threshold, fit, score, without_toxic, word_features, words, worst_spans)
from pyspark.sql import functions as F
from tests.llm.util import clashing, frame, rows

SCHEMA = "doc_id long, text string"
PLAIN = ["alpha beta gamma delta", "beta gamma omega", "delta omega alpha", "gamma delta kappa"]


def graded(n=400):
    docs, grades = [], []
    for i in range(n):
        grade = (i % 10 == 0) + (i % 20 == 0)
        text = PLAIN[i % 4] + f" filler{i}" + [" ", " nasty ", " nasty vilest "][grade] + PLAIN[i % 3]
        docs.append((i, text))
        grades.append((i, grade))
    return docs, grades


def test_words_and_case():
    assert words("Nasty, NASTY!!_x 12ab é") == {"nasty", "x", "ab", "é"} and words(None) == set()


def test_ordered_cuts_and_gradient():
    rng = np.random.default_rng(0)
    n = 3000
    has = rng.random((n, 3)) < 0.3
    s = has @ np.array([2.0, 4.0, 0.0])
    y = (s + rng.logistic(size=n) > 2).astype(int) + (s + rng.logistic(size=n) > 5)
    at, x = np.nonzero(has)
    w, cuts = _fit_ordinal(x, at, y, np.array([1.0, 1.0, 1.0]), steps=800, ridge=0)
    assert np.all(np.diff(cuts) > 0) and w[1] > w[0] > w[2] >= 0
    model = Model({}, cuts.tolist())
    mean = [np.mean(y[np.isclose(s, v)]) for v in (0, 2, 4, 6)]
    got = model.severity(np.array([w @ f for f in ([0, 0, 1], [1, 0, 0], [0, 1, 0], [1, 1, 0])]))
    assert np.allclose(got, mean, atol=0.25) and np.all(np.diff(got) > 0)


def test_fit_and_score(spark):
    docs, grades = graded()
    df, g = frame(spark, docs, SCHEMA), frame(spark, grades, "doc_id long, grade int")
    model = fit(clashing(df), clashing(g))
    new = [(1, "so nasty a thing"), (2, "alpha beta gamma"), (3, "NASTY vilest"), (None, None), (5, ""), (2, "alpha beta gamma"),
           (6, "alpha beta gamma delta " * 50_000), (7, "alpha " * 200_000 + "nasty")]
    out = score(clashing(frame(spark, new, SCHEMA)), model).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(new)
    assert [by[i]["is_toxic"] for i in (1, 2, 3, None, 5, 6, 7)] == [True, False, True, False, False, False, True]
    assert by[3]["severity"] > by[1]["severity"] > by[2]["severity"] == by[5]["severity"] == by[None]["severity"]
    kept = without_toxic(clashing(frame(spark, new, SCHEMA)), model)
    assert kept.columns == clashing(frame(spark, new, SCHEMA)).columns
    assert sorted((r[0] for r in kept.collect()), key=repr) == [2, 2, 5, 6, None]


def test_nothing_to_learn(spark):
    docs, _ = graded(20)
    df = frame(spark, docs + [(None, None), (3, "again")], SCHEMA)
    for g in ([], [(1, 0), (2, 0)], [(1, None), (None, 2), (999, 1)]):
        model = fit(df, frame(spark, g, "doc_id long, grade int"))
        assert {r["is_toxic"] for r in score(df, model).collect()} == {False}
    assert rows(score(df.limit(0), Model({}, []))) == []


def test_repeated_grades_and_documents(spark):
    docs, grades = graded()
    model = fit(frame(spark, docs + docs, SCHEMA), frame(spark, grades + [(i, 0) for i, _ in grades], "doc_id long, grade int"))
    assert rows(score(frame(spark, [(1, "nasty")], SCHEMA), model))[0][2]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels, docs = table(spark, sf, "labels"), table(spark, sf, "documents")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(10))
    model = fit(docs, severity_grades(labels.where(fold < 7)))
    test = labels.where(fold >= 7)
    got = score(docs.join(test, "doc_id", "left_semi"), model).join(test, "doc_id").collect()
    hit = sum(r["is_toxic"] for r in got if r["toxic"])
    false = sum(r["is_toxic"] for r in got if not r["toxic"])
    assert hit >= 0.7 * sum(r["toxic"] for r in got) and false <= 0.01 * len(got)


def test_lowest_threshold_within_the_false_positives():
    rng = np.random.default_rng(0)
    grades = (rng.random(4000) < 0.2).astype(int) * rng.integers(1, 3, 4000)
    severity = np.round(rng.random(4000) * 0.2 + (grades > 0) * rng.random(4000), 3)
    got, clean = _lowest_threshold(grades, severity, 0), severity[grades == 0]
    assert np.mean(clean >= got) <= FALSE_POSITIVES
    lower = severity[severity < got].max()
    assert np.mean(clean >= lower) > FALSE_POSITIVES and got < severity[severity > lower].min()


def test_threshold_is_chosen_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels, docs = table(spark, sf, "labels"), table(spark, sf, "documents")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(10))
    model = fit(docs, severity_grades(labels.where(fold < 7)))
    test = labels.where(fold >= 7)
    got = score(docs.join(test, "doc_id", "left_semi"), model).join(test, "doc_id").collect()
    toxic = [r for r in got if r["toxic"]]
    found = sum(r["is_toxic"] for r in toxic)
    assert found > sum(r["severity"] >= THRESHOLD for r in toxic) and found >= 0.8 * len(toxic)


def test_one_rule_for_the_threshold_at_all_sizes(spark):
    docs, grades = graded(400)
    df = frame(spark, docs, SCHEMA)
    chosen = [fit(df, frame(spark, grades[:n], "doc_id long, grade int")).threshold for n in (1, 20, 400)]
    assert chosen[0] == THRESHOLD and 0 < min(chosen) and max(chosen) < 1
    # a few documents move it little
    assert abs(chosen[1] - THRESHOLD) <= 2 / (2 + PRIOR_HELD)


def test_models_without_a_fold_are_those_of_the_other_rows(spark):
    docs, grades = graded(400)
    rows_ = [(g, i // 10 % FOLDS, t, sorted({x for w in words(t) for x in word_features(w)})) for (i, t), (_, g) in zip(docs, grades)]
    schema = "grade int, fold int, text string, features array<long>"
    models = _fit_folds(frame(spark, rows_, schema))
    assert len(models) == FOLDS + 1
    for f in (0, 3):
        others = _fit_folds(frame(spark, [r for r in rows_ if r[1] != f], schema))[-1]
        assert set(models[f].weight) == set(others.weight) and models[f].weight
        assert np.allclose([models[f].weight[x] for x in others.weight], list(others.weight.values()))
        assert np.allclose(models[f].cuts, others.cuts)
    judged = frame(spark, rows_, schema).select("fold", "text", worst_spans(models, F.col("text"), F.col("fold")).alias("s")).collect()
    assert all(abs(r.s - models[r.fold].severity(np.array([models[r.fold].scorer()(r.text)[1]]))[0]) < 1e-12 for r in judged)


def test_long_texts_of_many_clean_words_stay(spark):
    letters = "abcdefghij"
    mild = [f"mild{letters[i // 10]}{letters[i % 10]}x" for i in range(100)]
    model = Model({word_features(w)[0]: 1.0 for w in mild}, [4.0], 0.4)
    plain = ["".join(letters[int(d)] for d in str(i)) for i in range(10_000, 40_000)]
    clean = [w for i in range(100) for w in [mild[i], *plain[300 * i:300 * i + 299]]]
    across = plain[:SPAN - 3] + mild[:5] + plain[-1000:]  # five together, wherever a span begins
    texts = [(1, " ".join(clean)), (2, " ".join(across)), (3, " ".join(plain + mild[:5])), (4, " ".join(mild[:1]))]
    df = frame(spark, texts, SCHEMA)
    by = {r["doc_id"]: r for r in score(df, model).collect()}
    assert [by[i]["is_toxic"] for i in (1, 2, 3, 4)] == [False, True, True, False]
    assert by[1]["worst_span"] == by[4]["worst_span"] == by[4]["severity"] < by[1]["severity"]
    assert sorted(r[0] for r in without_toxic(df, model).collect()) == [1, 4]


def test_query_scores_every_document(spark):
    sf = "/root/testdata/sf0.001"
    model = toxicity_model(spark, sf)
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    from bazaar.llm.toxicity import word_features
    for r in op5_toxicity(spark, sf).collect():
        found = {x for w in words(docs.pop(r["doc_id"])) for x in word_features(w) if x in model.weight}
        s = model.severity(np.array([sum(model.weight[x] for x in sorted(found))]))[0]
        assert abs(s - r["severity"]) < 1e-12
    assert not docs
