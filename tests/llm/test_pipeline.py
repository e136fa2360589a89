import importlib
import re
import subprocess
import sys
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from bazaar.llm.common import table
from bazaar.llm.queries import ORACLE_SQL, QUERIES, TOKENIZER, secret_forest, toxicity_model
from bazaar.llm.secrets import MASK
from bazaar.llm.simhash import fingerprint
from bazaar.llm.toxicity import SPAN, word_features

SF = "/root/testdata/sf0.001"


def by_hand(spark):
    """The stages in plain Python, with the fitted models of the stages."""
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    model = toxicity_model(spark, SF)

    def toxic(text):
        own = re.findall(r"[^\W\d_]+", text.lower())
        spans = [own[at:at + SPAN] for at in range(0, max(1, len(own)), SPAN // 2)]
        found = [{x for w in span for x in word_features(w) if x in model.weight} for span in spans]
        return max(model.severity(np.array([sum(model.weight[x] for x in sorted(f)) for f in found]))) >= model.threshold

    docs = {i: t for i, t in docs.items() if not toxic(t)}
    fps, kept = {i: fingerprint(t) for i, t in docs.items()}, set()
    left = set(docs)
    while left:
        group, new = set(), {min(left)}
        kept.add(min(left))
        while new:
            group |= new
            new = {i for i in left - group if any((fps[i] ^ fps[j]).bit_count() <= 4 for j in new)}
        left -= group
    docs = {i: docs[i] for i in kept}
    return {i: re.sub(r'(?i)(token = ")[0-9a-f]{40}(")', rf"\1{MASK}\2", t) for i, t in docs.items()}


def test_pipeline_against_plain_python(spark):
    want, own = by_hand(spark), Tokenizer.from_file(TOKENIZER)
    got, places = defaultdict(dict), defaultdict(list)
    for r in pipeline.run(spark, SF).collect():
        got[r["doc_id"]][r["piece"]] = r
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(got) == set(want)
    for i, text in want.items():
        ids = own.encode(text, add_special_tokens=False).ids + [0]
        assert sum(r["length"] for r in got[i].values()) == len(ids)
        for r in got[i].values():
            assert zlib.crc32(array("I", ids[r["start"]:r["start"] + r["length"]]).tobytes()) == r["ids_crc32"]
    for place in places.values():
        assert sum(n for _, n in place) <= 2048
        assert [o for o, _ in sorted(place)] == list(np.cumsum([0] + [n for _, n in sorted(place)])[:-1])


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert not Counter(r["doc_id"] for r in out.collect()) - Counter(r["doc_id"] for r in docs.collect())
    masked = pipeline.secrets(spark, table(spark, "/root/testdata/sf0.01", "documents"), SF)
    assert masked.where(f"contains(text, '{MASK}')").count() > 0
    assert masked.where("n_chars <> length(text)").count() == 0
    assert secret_forest(docs) is not None


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14)) and set(QUERIES) < set(names)
    assert names["pipeline"] is pipeline.run and set(ORACLE_SQL) <= set(QUERIES)


def test_the_library_does_not_need_this_package(tmp_path):
    code = ("import sys; sys.modules['bazaar.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())")
    root = importlib.import_module("__spark_entry__").__file__.rpartition("/")[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
