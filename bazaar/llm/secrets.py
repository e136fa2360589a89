"""Secret scans: a random forest removes false findings.

A candidate is a long run of key characters, or a value of any characters that
is assigned to a secret word. The forest judges its length, character
transitions, dictionary coverage, the document's path and the neighbouring
words. It is trained by Spark ML on labelled findings and then compiled to
column expressions, so a scan is one pass of built-in functions over the
documents: no shuffle, no join, no Python.
"""

from __future__ import annotations

import dataclasses
import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import pick, position, positional, stored

KEY_CHARS = r"A-Za-z0-9+/_\-"
LEAST_CHARS = 16             # of a run of key characters
LEAST_ASSIGNED = 4           # characters of a value that is assigned to a secret word
# words beside an assignment that name a secret
SECRET_WORDS = r"(?i:token|secret|passw(?:or)?d|pwd|passphrase|api_?key|access_?key|private_?key|auth|bearer|credential)"
# the name may go on (TOKEN_V2), be quoted or in brackets
NAMED = SECRET_WORDS + r"[\w\-]{0,24}[\"'`\])]{0,3}\s{0,3}(?::=|=>|[:=])\s{0,3}[\"'`]?"
# equals signs only pad the end; a name that is assigned to is context of what follows
KEY_RUN = rf"[{KEY_CHARS}]{{{LEAST_CHARS},}}+(?!=[{KEY_CHARS}]|\s?=\s?[\"'`])={{0,2}}"
# all in quotes; without quotes up to a space or a mark that ends a value, if no call or index follows
VALUE = (rf"(?:(?<=[\"'`])[^\"'`\s]{{{LEAST_ASSIGNED},}}+"
         rf"|(?<![\"'`])[^\s\"'`,;(){{}}\[\]<>$]{{{LEAST_ASSIGNED},}}+(?![(\[{{<$]))")
# the short looks behind fail at once almost everywhere
CANDIDATE = rf"(?<![{KEY_CHARS}])(?:(?<=[:=>]\s{{0,3}}[\"'`]?)(?<={NAMED}){VALUE}|{KEY_RUN})"
MARK = "\x01"                # stands around candidates while a text is cut
LEFT, RIGHT = 48, 24         # characters of context
SAMPLE = 4_000               # labelled findings of each label, at most
DICTIONARY = 1_000           # words, at most
TREES, DEPTH, SEED = 20, 5, 42
THRESHOLD = 0.5              # share of trees that must call a finding a secret
MASK = "[SECRET]"

ASSIGNED = r"[:=]\s*[\"'`]?$"
BEARER = r"(?i)\bbearer\s+$"
KNOWN_SHAPE = (r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_\w{30,}|glpat-[\w\-]{20,}"
               r"|xox[abprs]-[\w\-]{10,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[\w\-]{35})$")
MANY_DISTINCT = 8            # characters of a value that may be a key
TEST_PATH = r"(?i)(?:test|example|sample|fixture|mock|docs?/|\.md$|\.lock$)"

FEATURES = ["length", "digits", "upper", "lower", "symbols", "case_moves", "digit_moves", "vowel_moves", "distinct",
            "dictionary", "secret_word", "assigned", "quoted", "left_words", "path_test", "path_depth", "path_digits"]


def _share(pattern: str, value: Column) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def features(value: Column, left: Column, right: Column, path: Column, dictionary: str) -> Column:
    """Struct of the numbers that the forest sees. ``dictionary``: a pattern of
    the known words, or empty."""
    covered = (F.length(value) - F.length(F.regexp_replace(F.lower(value), dictionary, ""))) / F.length(value)
    quoted = left.rlike(r"[\"'`]$") & right.rlike(r"^[\"'`]")
    parts = {
        "length": F.length(value),
        "digits": _share("[0-9]", value), "upper": _share("[A-Z]", value), "lower": _share("[a-z]", value),
        "symbols": _share("[^A-Za-z0-9]", value),
        # character transitions: between cases, between letters and digits, between vowels and consonants
        "case_moves": _share("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])", value),
        "digit_moves": _share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", value),
        "vowel_moves": _share("(?i)(?<=[aeiouy])(?=[b-df-hj-np-tv-xz])|(?<=[b-df-hj-np-tv-xz])(?=[aeiouy])", value),
        "distinct": F.size(F.array_distinct(F.split(value, "", -1))) / F.length(value),
        "dictionary": covered if dictionary else F.lit(0.0),
        "secret_word": left.rlike(SECRET_WORDS).cast("double"),
        "assigned": left.rlike(ASSIGNED).cast("double"),
        "quoted": quoted.cast("double"),
        "left_words": F.regexp_count(left, F.lit(r"\p{L}{2,}")),
        "path_test": path.rlike(TEST_PATH).cast("double"),
        "path_depth": F.regexp_count(path, F.lit("/")),
        "path_digits": F.regexp_count(path, F.lit("[0-9]")),
    }
    return F.struct(*[F.coalesce(parts[n].cast("double"), F.lit(0.0)).alias(n) for n in FEATURES])


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(id, path, value, start, left, right): every candidate of the documents.
    Null or empty texts have none, a null path is empty, an empty table gives
    an empty one; texts of any length are read whole, repeated rows each."""
    types = {id_col: "long", text_col: "string"} | ({path_col: "string"} if path_col else {})
    found = candidates(pick(docs, **types), path_col, text_col, [id_col])
    # not a plain explode: Spark would put a filter on the list's size before it, which searches
    # the texts once more for itself and again for every candidate
    each = found.select(id_col, F.col("path_").alias("path"), F.explode_outer("found_").alias("x")).where(F.col("x").isNotNull())
    return each.select(id_col, "path", "x.value", "x.start", "x.left", "x.right")


def candidates(docs: DataFrame, path_col: str | None, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, ``path_``, ``between_`` (the text around the
    candidates, one more than those) and ``found_``: for each candidate its
    value, start and context."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    # one search: marks around every candidate, cut at them; a text that holds a mark itself is searched twice
    marked = docs.select(*keep, path.alias("path_"), text.alias("text_"), F.contains(text, F.lit(MARK)).alias("holds_"),
                         F.split(F.regexp_replace(text, CANDIDATE, f"{MARK}$0{MARK}"), MARK, -1).alias("parts_"))
    cut = marked.select(
        *keep, "path_",
        F.when(F.col("holds_"), F.split("text_", CANDIDATE, -1)).otherwise(F.filter("parts_", lambda _, i: i % 2 == 0)).alias("between_"),
        F.when(F.col("holds_"), F.regexp_extract_all("text_", F.lit(CANDIDATE), F.lit(0)))
        .otherwise(F.filter("parts_", lambda _, i: i % 2 == 1)).alias("values_"))

    def finding(value: Column, i: Column) -> Column:
        before = F.slice(F.col("between_"), F.lit(1), i + 1)
        chars = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x))
        return F.struct(value.alias("value"), (chars(before) + chars(F.slice("values_", F.lit(1), i))).alias("start"),
                        F.right(F.concat(*[F.coalesce(x, F.lit("")) for x in (
                            F.get("between_", i - 1), F.get("values_", i - 1), F.get("between_", i))]), F.lit(LEFT)).alias("left"),
                        F.left(F.concat(F.get("between_", i + 1), F.coalesce(F.get("values_", i + 1), F.lit(""))), F.lit(RIGHT)).alias("right"))

    return cut.select(*keep, "path_", "between_", F.transform("values_", finding).alias("found_"))


@dataclasses.dataclass
class Forest:
    dictionary: str            # pattern of the known words
    trees: list                # nested (feature, threshold, low, high), or a leaf's vote

    def score(self, f: Column) -> Column:
        """Share of the trees that call the features those of a secret."""
        def grow(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            name, threshold, low, high = node
            return F.when(f[name] <= threshold, grow(low)).otherwise(grow(high))

        if not self.trees:
            return F.lit(0.0)
        return sum((grow(t) for t in self.trees[1:]), grow(self.trees[0])) / len(self.trees)


def train(findings: DataFrame, sample: int = SAMPLE) -> Forest:
    """The forest from labelled findings (value, left, right, path, label 0 or
    1). Equal findings are one, however often they occur; of each label the
    ``sample`` first in hash order are used. Findings without a label or a
    value are left out; without both labels, nothing is called a secret. The
    dictionary holds the words of four letters or more that are most frequent
    beside the findings, counted over all of them."""
    given = (findings.where(F.col("label").isNotNull() & (F.length("value") > 0))
             .groupBy("value", "left", "right", "path", "label").agg(F.count(F.lit(1)).alias("copies")))
    words = (given.select("copies", F.explode(F.split(F.lower(F.concat_ws(" ", "left", "right")), r"[^\p{L}]+")).alias("word"))
             .where(F.length("word") >= 4).groupBy("word").agg(F.sum("copies").alias("n"))
             .orderBy(F.desc("n"), "word").limit(DICTIONARY))
    known = sorted((r["word"] for r in words.collect()), key=lambda w: (-len(w), w))
    dictionary = "|".join(map(re.escape, known))
    order = F.xxhash64("value", "left", "right", "path")
    rows = None
    for label in (0, 1):
        part = given.where(F.col("label") == label).orderBy(order, "value", "left", "right", "path").limit(sample)
        rows = part if rows is None else rows.unionByName(part)
    f = features(F.col("value"), F.col("left"), F.col("right"), F.col("path"), dictionary)
    rows = stored(rows.select(f.alias("f"), F.col("label").cast("double").alias("label")).select("label", "f.*"),
                  "labelled-findings", 2 * sample)
    if rows.select("label").distinct().count() < 2:
        return Forest(dictionary, [])
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(vectors)

    def read(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return node.prediction()
        low, high = read(node.leftChild()), read(node.rightChild())
        if low == high:
            return low
        return FEATURES[node.split().featureIndex()], node.split().threshold(), low, high

    return Forest(dictionary, [read(t._java_obj.rootNode()) for t in model.trees])


def _judged(docs: DataFrame, forest: Forest, path_col: str | None, text_col: str, keep: list[str]) -> DataFrame:
    """``candidates`` with the score of each."""
    found = candidates(docs, path_col, text_col, keep)
    numbers = F.transform("found_", lambda x: F.struct(
        x["value"].alias("value"), x["start"].alias("start"),
        features(x["value"], x["left"], x["right"], F.col("path_"), forest.dictionary).alias("f")))
    scored = F.transform("found_", lambda x: F.struct(
        x["value"].alias("value"), x["start"].alias("start"), forest.score(x["f"]).alias("score")))
    return found.withColumn("found_", numbers).withColumn("found_", scored)


def judge(found: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """(id, start, length, value, score): the secrets among ``findings``."""
    f = features(F.col("value"), F.col("left"), F.col("right"), F.col("path"), forest.dictionary)
    # a lambda's variable is computed once, a column that many trees read might not be
    scored = found.withColumn("score", F.transform(F.array(f), forest.score)[0]).where(F.col("score") >= threshold)
    return scored.select(found.columns[0], F.col("start").cast("long").alias("start"),
                         F.length("value").cast("long").alias("length"), "value", "score")


def scan(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text",
         path_col: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """(id, start, length, value, score): a row per secret, ``start`` in
    characters from 0.

    Null or empty texts hold none; a null path counts as empty; repeated rows
    are each scanned; texts of any length are read whole; an empty table has
    no secrets; other columns are ignored.
    """
    return judge(findings(docs, id_col, text_col, path_col), forest, threshold)


def redact(docs: DataFrame, forest: Forest, text_col: str = "text", path_col: str | None = "source",
           chars_col: str | None = "n_chars", threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """The documents, all columns, with each secret replaced by the mask and
    the character count made anew where the text changed. Null texts stay."""
    own, names = positional(docs)
    text, path = position(names, text_col), position(names, path_col) if path_col else None
    judged = _judged(own, forest, path, text, own.columns)
    pieces = F.transform("found_", lambda x, i: F.concat(
        F.get("between_", i), F.when(x["score"] >= threshold, F.lit(mask)).otherwise(x["value"])))
    hit = F.exists("found_", lambda x: x["score"] >= threshold)
    clean = F.concat(F.array_join(pieces, ""), F.element_at("between_", -1))
    out = judged.withColumn("hit_", hit).withColumn(text, F.when(F.col("hit_"), clean).otherwise(F.col(text)))
    if chars_col and chars_col in names:
        n = position(names, chars_col)
        out = out.withColumn(n, F.when(F.col("hit_"), F.length(text).cast(own.schema[n].dataType)).otherwise(F.col(n)))
    return out.select(*own.columns).toDF(*names)


def labelled_by_rule(found: DataFrame) -> DataFrame:
    """Findings with a label where the case is sure, where no reviewed ones
    exist. 1: a known key shape, or a value that mixes letters with digits or
    cases and is assigned to a secret word, in quotes or not, or follows
    'Bearer'. 0: a short word of letters in one case, assigned or not, and
    whatever neither stands in such a place nor mixes letters with digits in
    many distinct characters. Null, so not trained on: the rest.

    What the rule looks for, the whole pattern of an assignment and the known
    shapes, is not among the forest's features."""
    value, left = F.col("value"), F.col("left")
    named = left.rlike(NAMED + "$") | left.rlike(BEARER)
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    cases = F.regexp_count(value, F.lit("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) >= 3
    word = value.rlike(rf"^(?:\p{{L}}?\p{{Ll}}{{1,{LEAST_CHARS - 2}}}|\p{{Lu}}{{1,{LEAST_CHARS - 1}}})$")
    doubtful = named | (mixed & (F.size(F.array_distinct(F.split(value, "", -1))) >= MANY_DISTINCT))
    return found.withColumn("label", F.when(value.rlike(KNOWN_SHAPE) | (named & (mixed | cases)), 1).when(word | ~doubtful, 0))
