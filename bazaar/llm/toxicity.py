"""Toxicity as cumulative-link ordinal regression over sparse text features.

A text's features are its distinct words and their first letters, each once.
P(grade <= k) = sigmoid(cut_k - w.x): one weight vector for all thresholds,
ordered cuts. The output is the expected grade, the sum over the thresholds of
P(grade > k). Weights only add up, so a long text gathers them by chance:
whether a text is toxic is decided on its worst span, over spans of a fixed
number of words that overlap by half and cover the whole text. The model is
fitted on a bounded sample of graded documents; scoring runs over all
documents without a shuffle.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import pick, position, positional, stored

SAMPLE = 16_384          # graded documents that the model is fitted on, at most
FEATURES = 20_000        # features with a weight, at most
LEAST_Z = 3.0            # of a feature's log odds between grade 0 and the others
LEAST_ODDS = 2.0         # that difference itself
LEAST_DOCS = 3           # sampled documents that hold a feature
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3          # expected grade from which a document counts as toxic, before any is seen
PRIOR_HELD = 20          # documents above the lowest grade that this counts as much as
FALSE_POSITIVES = 0.0075  # share of the lowest grade's held-out documents that the chosen threshold may reach, at most
FOLDS = 10               # of the sample; each is judged by a model of the others
SPAN = 256               # words of a span, twice the step
MEMO = 250_000
FEATURE_ROWS = 256       # rows of a few numbers that the features of a text are as large as
ROWS_OUT = 1024

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return {m.group() for m in _WORD.finditer((text or "").lower())}


def word_features(word: str) -> list[int]:
    """Hashes of the word and of its prefixes."""
    names = [f"w {word}"] + [f"{n} {word[:n]}" for n in PREFIXES if len(word) >= n]
    return [xxhash.xxh64_intdigest(x) >> 1 for x in names]


@dataclasses.dataclass
class Model:
    weight: dict[int, float]   # by feature
    cuts: list[float]          # ordered; one fewer than grades
    threshold: float = THRESHOLD

    def severity(self, scores: np.ndarray) -> np.ndarray:
        if not self.cuts:
            return np.zeros(len(scores))
        return (1 / (1 + np.exp(np.clip(np.array(self.cuts)[:, None] - scores, -60, 60)))).sum(axis=0)

    def scorer(self) -> Callable[[str | None], tuple[float, float]]:
        """A function that gives the weights of a text and of its worst span."""
        memo: dict[str, tuple[int, ...]] = {}
        weight = self.weight

        def features(word: str) -> tuple[int, ...]:
            known = memo.get(word)
            if known is None:
                if len(memo) >= MEMO:
                    memo.clear()
                known = memo[word] = tuple(x for x in word_features(word) if x in weight)
            return known

        def total(found: set[int]) -> float:
            return sum(weight[x] for x in sorted(found))

        def score(text: str | None) -> tuple[float, float]:
            own = _WORD.findall((text or "").lower())
            known = {word: x for word in set(own) if (x := features(word))}
            whole = total({x for xs in known.values() for x in xs})
            if not known or len(own) <= SPAN:
                return whole, whole
            steps: dict[int, set[int]] = {}
            for i, word in enumerate(own):
                if word in known:
                    steps.setdefault(i // (SPAN // 2), set()).update(known[word])
            return whole, max(total(found | steps.get(i + 1, set())) for i, found in steps.items())

        return score

    def column(self, text: Column) -> Column:
        """Struct of the expected grades of a text and of its worst span."""
        model = self

        @F.pandas_udf("severity double, worst_span double")
        def severity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            score = model.scorer()
            for texts in batches:
                both = np.array([score(t) for t in texts], float).reshape(-1, 2)
                yield pd.DataFrame({"severity": model.severity(both[:, 0]), "worst_span": model.severity(both[:, 1])})

        return severity(text)


def worst_spans(models: list[Model], text: Column, model: Column) -> Column:
    """The expected grade of a text's worst span by the model of that number."""
    @F.pandas_udf("double")
    def severity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorers = [m.scorer() for m in models]
        for texts, numbers in batches:
            yield pd.Series([float(models[n].severity(np.array([scorers[n](t)[1]]))[0]) for t, n in zip(texts, numbers)], dtype=float)

    return severity(text, model)


def fit(docs: DataFrame, grades: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", grade_col: str = "grade") -> Model:
    """The model from graded documents; a document graded more than once takes
    its highest grade, one that occurs more than once its least text. Null ids
    and grades are left out. Without two grades the model gives 0 throughout.

    The model's threshold is chosen on held-out documents, see ``_threshold``;
    the model itself is fitted on the whole sample."""
    graded = (pick(grades, **{id_col: "long", grade_col: "int"}).dropna()
              .groupBy(id_col).agg(F.max(grade_col).alias(grade_col))
              .orderBy(F.xxhash64(id_col), id_col).limit(sample))
    # the sample has at most ``sample`` rows of two numbers, so it may be broadcast
    texts = (pick(docs, **{id_col: "long", text_col: "string"}).join(F.broadcast(graded), id_col)
             .groupBy(id_col).agg(F.min(text_col).alias(text_col), F.max(grade_col).alias(grade_col)))

    def hashed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                found = [sorted({x for w in words(t) for x in word_features(w)}) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(found, pa.list_(pa.int64()))],
                    names=["text", "grade", "fold", "features"])

    # copies of a text fall into one fold
    fold = F.pmod(F.xxhash64(text_col), F.lit(FOLDS)).cast("int")
    rows = stored(texts.select(F.col(text_col).alias("text"), F.col(grade_col).alias("grade"), fold.alias("fold"))
                  .mapInArrow(hashed, "text string, grade int, fold int, features array<long>"), "graded",
                  sample * FEATURE_ROWS)
    *folds, model = _fit_folds(rows)
    return dataclasses.replace(model, threshold=_threshold(rows, folds))


def _threshold(rows: DataFrame, folds: list[Model]) -> float:
    """The lowest threshold that at most the share ``FALSE_POSITIVES`` of the
    lowest grade's documents reach, each judged by a model fitted without its
    fold; half-way to the next lower severity seen. It is averaged with
    ``THRESHOLD``, which counts as ``PRIOR_HELD`` documents above the lowest
    grade, so that a few documents move it little."""
    judged = rows.select("grade", worst_spans(folds, F.col("text"), F.col("fold")).alias("severity"))
    # two numbers for each document of the sample
    grades, severity = (x.to_numpy() for x in judged.toArrow().columns)
    held = int((grades > grades.min()).sum()) if len(grades) else 0
    if not held:
        return THRESHOLD
    chosen = _lowest_threshold(grades, severity, grades.min())
    return (held * chosen + PRIOR_HELD * THRESHOLD) / (held + PRIOR_HELD)


def _lowest_threshold(grades: np.ndarray, severity: np.ndarray, low: int) -> float:
    clean = np.sort(severity[grades == low])[::-1]
    most = clean[int(FALSE_POSITIVES * len(clean))]  # the highest that must not be reached
    above = severity[severity > most]
    return float((most + above.min()) / 2 if len(above) else np.nextafter(most, np.inf))


def _fit_folds(rows: DataFrame) -> list[Model]:
    """A model without each fold, in order, and one of all rows.

    Features are counted by fold in one pass; the counts without a fold are
    those of all less its own. What any model may use of the sample is brought
    to the driver once, as rows of a few numbers, and the models are fitted
    there.
    """
    counts = {(r[0], r[1]): r[2] for r in rows.groupBy("fold", "grade").count().collect()}
    grades = sorted({g for _, g in counts})
    if len(grades) < 2:
        return [Model({}, [])] * (FOLDS + 1)
    found = _counted(rows, grades[0], {f: [sum(n for (k, g), n in counts.items() if k != f and (g > grades[0]) == above)
                                           for above in (False, True)] for f in [*range(FOLDS), -1]})
    ids = np.array([r[0] for r in found], np.int64)
    order = np.argsort(ids)
    ids, held = ids[order], np.array([r[1:] for r in found], float).reshape(len(found), 2 * FOLDS)[order]

    def indexed(batches):
        for batch in batches:
            lists = batch.column(2)
            values, n = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            at = np.searchsorted(ids, values)
            hit = np.flatnonzero(np.append(ids, -1)[at] == values)
            ends = np.searchsorted(hit, np.cumsum(n))
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(at[hit].astype(np.int32)))],
                names=["grade", "fold", "at"])

    # the sample's rows with the few features that were chosen
    kept = rows.select("grade", "fold", "features").mapInArrow(indexed, "grade int, fold int, at array<int>").toArrow()
    lists = kept.column("at").combine_chunks()
    doc, feature = np.repeat(np.arange(kept.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
    grade, fold = kept.column("grade").to_numpy(), kept.column("fold").to_numpy()
    toxic, clean = held[:, :FOLDS], held[:, FOLDS:]
    models = []
    for f in [*range(FOLDS), -1]:
        mine = fold != f
        t, c = (x.sum(axis=1) - (x[:, f] if f >= 0 else 0) for x in (toxic, clean))
        odds, z = _odds(t, c, grade[mine], grades[0])
        use = _informative(t, c, odds, z)
        models.append(_fit_rows(ids, odds, use, feature, doc, grade, mine))
    return models


def _counted(rows: DataFrame, low: int, totals: dict[int, list[int]]) -> list:
    """(feature, toxic documents that hold it by fold, clean ones by fold) of
    the features that any of the models may use, by their best z."""
    held = rows.select((F.col("grade") > low).cast("int").alias("y"), "fold", F.explode("features").alias("x"))
    sums = [F.count_if((F.col("fold") == f) & (F.col("y") == y)).alias(f"{'ct'[y]}{f}") for y in (1, 0) for f in range(FOLDS)]
    n = held.groupBy("x").agg(*sums)
    n = n.withColumns({f"all_{k}": sum((F.col(f"{k}{f}") for f in range(1, FOLDS)), F.col(f"{k}0")) for k in "tc"})

    def z(own: Column) -> Column:
        t, c = F.col("all_t") - own["t"] + 0.5, F.col("all_c") - own["c"] + 0.5
        odds = F.log(t / (own["nt"] - t)) - F.log(c / (own["nc"] - c))
        value = odds / F.sqrt(1 / t + 1 / (own["nt"] - t) + 1 / c + 1 / (own["nc"] - c))
        return F.when((t + c >= LEAST_DOCS + 1) & (odds >= LEAST_ODDS) & (value >= LEAST_Z), value)

    zero = F.lit(0).cast("long")
    models = F.array(*[F.struct((F.col(f"t{f}") if f >= 0 else zero).alias("t"), (F.col(f"c{f}") if f >= 0 else zero).alias("c"),
                                F.lit(toxic + 1.0).alias("nt"), F.lit(clean + 1.0).alias("nc")) for f, (clean, toxic) in totals.items()])
    kept = (n.withColumn("best", F.array_max(F.transform(models, z))).where(F.col("best").isNotNull())
            .orderBy(F.desc("best"), "x").limit(FEATURES).drop("all_t", "all_c"))
    return kept.drop("best").collect()


def _odds(t: np.ndarray, c: np.ndarray, grade: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Differences of the features' log odds between the grades above the
    lowest and the lowest, and their z."""
    nt, nc = (grade > low).sum() + 1.0, (grade == low).sum() + 1.0
    t, c = t + 0.5, c + 0.5
    odds = np.log(t / (nt - t)) - np.log(c / (nc - c))
    return odds, odds / np.sqrt(1 / t + 1 / (nt - t) + 1 / c + 1 / (nc - c))


def _informative(t: np.ndarray, c: np.ndarray, odds: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The features that speak clearly for a grade above the lowest. Features
    against it are left out: a long text holds many of them by chance."""
    return np.flatnonzero((t + c >= LEAST_DOCS) & (odds >= LEAST_ODDS) & (z >= LEAST_Z))


def _fit_rows(ids: np.ndarray, odds: np.ndarray, use: np.ndarray, feature: np.ndarray, doc: np.ndarray,
              grade: np.ndarray, mine: np.ndarray) -> Model:
    """The model of the rows ``mine`` on the features ``use``."""
    y = np.unique(grade[mine], return_inverse=True)
    if len(y[0]) < 2:
        return Model({}, [])
    place, row = np.full(len(ids), -1), np.cumsum(mine) - 1
    place[use] = np.arange(len(use))
    keep = (place[feature] >= 0) & mine[doc]
    weights, cuts = _fit_ordinal(place[feature[keep]], row[doc[keep]], y[1], odds[use])
    return Model(dict(zip(ids[use].tolist(), weights.tolist())), cuts.tolist())


def _fit_ordinal(x: np.ndarray, at: np.ndarray, y: np.ndarray, odds: np.ndarray, steps: int = 100,
                 rate: float = 0.05, ridge: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood with a ridge, by full-batch Adam from the log odds
    of the features, shared out among those of a word. The cuts are the first
    one and the logs of the distances to the next."""
    levels, rows, n = int(y.max()), len(y), len(odds)
    share = np.clip([np.mean(y <= k) for k in range(levels)], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    p = np.concatenate([odds / (1 + len(PREFIXES)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, gaps = p[:n], np.exp(p[n + 1:])
        cuts = p[n] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = np.bincount(at, weights=w[x], minlength=rows)
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        up, low = (1 / (1 + np.exp(-np.clip(edge[y + d] - s, -60, 60))) for d in (1, 0))
        prob = np.maximum(up - low, 1e-12)
        du, dl = up * (1 - up) / prob, low * (1 - low) / prob
        dcut = (np.bincount(y, weights=-du, minlength=levels + 1)[:levels]
                + np.bincount(y, weights=dl, minlength=levels + 1)[1:]) / rows
        g = np.concatenate([np.bincount(x, weights=((du - dl) / rows)[at], minlength=n) + ridge * w,
                            [dcut.sum()], [dcut[k + 1:].sum() * gaps[k] for k in range(levels - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        p[:n] = np.maximum(p[:n], 0)  # no text is excused by its length
    return p[:n], p[n] + np.concatenate([[0.0], np.cumsum(np.exp(p[n + 1:]))])


def score(docs: DataFrame, model: Model, threshold: float | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, severity, is_toxic, worst_span), one row per input row: the expected
    grade of the whole text, which grows with its length; whether that of its
    worst span, which doesn't add up, reaches the threshold, by default the
    model's; and that grade. A null or empty text has no features; texts of
    any length are read whole, an empty table gives an empty one, repeated rows
    are each judged, null ids kept; other columns are ignored."""
    own = pick(docs, **{id_col: "long", text_col: "string"})
    scored = own.select(id_col, model.column(F.col(text_col)).alias("s"))
    toxic = F.col("s.worst_span") >= (model.threshold if threshold is None else threshold)
    return scored.select(id_col, "s.severity", toxic.alias("is_toxic"), "s.worst_span")


def without_toxic(docs: DataFrame, model: Model, threshold: float | None = None, text_col: str = "text") -> DataFrame:
    """The documents, all columns, no span of which reaches the threshold, by
    default the model's. Null and empty texts stay; repeated rows stay or go
    together; an empty table gives an empty one."""
    own, names = positional(docs)
    severity = model.column(F.col(position(names, text_col)).cast("string"))["worst_span"]
    return own.where(severity < (model.threshold if threshold is None else threshold)).toDF(*names)
