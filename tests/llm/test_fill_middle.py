import hashlib
import re

import numpy as np
import pytest

from bazaar.llm import fill_middle
from bazaar.llm.fill_middle import checked, restore, transform
from bazaar.llm.queries import op11_fill_middle
from tests.llm.util import clashing, frame, rows

SF = "/root/testdata/sf0.001"


def by_hand(doc_id, text, seed=1, plain=10, spm=20):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    key = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = ["", None, "a", "abc def", "é", "日本 語x", "a<", "<P", "P>", "x<S>y", "<M>", "  \n\t", "\U0001f600ab\U0001f600", "0", "<<S>>",
         "Zz[`@{", "a\0b", "é" * 50 + "word" * 30, "one two  three\r\nfour"]


@pytest.mark.parametrize("step", [1, 3, 64, 1 << 20])
def test_as_by_hand(spark, monkeypatch, step):
    data = [(i, TEXTS[i % len(TEXTS)]) for i in range(300)] + [(7, "again again"), (7, "again again"), (None, "no id at all")]
    monkeypatch.setattr(fill_middle, "STEP", step)
    marks = checked(fill_middle.SENTINELS)
    raw = [(t or "").encode() for _, t in data]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    bytes_ = np.frombuffer(b"".join(raw), np.uint8)
    draws = [np.array([int(hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for i, _ in data])
             for k in range(4)]
    n, form, prefix, middle, built, out = fill_middle.scatter(bytes_, offsets, draws, marks, 10, 20)
    for i, (doc_id, text) in enumerate(data):
        _, units, name, p, m, output = by_hand(doc_id, text or "")
        assert (n[i], fill_middle.FORMS[form[i]], bytes(built[out[i]:out[i + 1]]).decode()) == (units, name, output)
        assert name == "plain" or (prefix[i], middle[i]) == (p, m)
    back, at = fill_middle.gather(built, out, form, marks)
    assert bytes(back) == bytes(bytes_) and at.tolist() == offsets.tolist()
    assert len({fill_middle.FORMS[f] for f in form}) == 3


def test_frame_with_nulls_repeats_long_texts_and_clashing_columns(spark):
    data = [(i, t) for i, t in enumerate(TEXTS * 20)] + [(None, "x y z"), (5, "same id"), (5, "same id"), (900, "wörd <b> " * 250_000)]
    docs = clashing(frame(spark, data, "doc_id long, text string")).repartition(3)
    got = restore(transform(docs))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    want = [(*by_hand(i, t or ""), t or "") for i, t in data]
    assert sorted(rows(got), key=repr) == sorted(want, key=repr)


def test_shares_seed_and_own_sentinels(spark):
    docs = frame(spark, [(i, f"text {i} of some words") for i in range(2000)], "doc_id long, text string")
    forms = {r[0]: r[1] for r in transform(docs, seed=5).groupBy("form").count().collect()}
    assert 140 < forms["plain"] < 260 and 280 < forms["spm"] < 440
    assert {r.form for r in transform(docs, plain_percent=0, spm_percent=100).collect()} == {"spm"}
    own = ("[pre]", "[suf]", "[mid]")
    coded = transform(docs, sentinels=own)
    assert all(r.restored == f"text {r.doc_id} of some words" for r in restore(coded, own).collect())
    for bad in (("a", "ab", "c"), ("aba", "x", "y"), ("<P>", "<S>", ""), ("xy", "yz", "q"), ("<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            checked(bad)


def test_restore_needs_each_sentinel_once(spark):
    coded = frame(spark, [("psm", "<P>a<S>b")], "form string, output string")
    with pytest.raises(Exception, match="each sentinel once"):
        restore(coded).collect()
    assert rows(restore(frame(spark, [("psm", None), ("plain", "a")], "form string, output string"))) == [
        ("psm", None, None), ("plain", "a", "a")]


def test_empty_table(spark):
    docs = frame(spark, [], "doc_id long, text string")
    assert rows(restore(transform(docs))) == []


def test_query_restores_every_text(spark):
    got = {r.doc_id: r for r in op11_fill_middle(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, r = by_hand(d.doc_id, d.text or ""), got[d.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[1:5]
        assert r.output_sha256 == hashlib.sha256(want[5].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
