import random
import re
from collections import Counter, defaultdict

import pytest

from bazaar.llm import source_audit
from bazaar.llm.source_audit import collapsed, divergence
from tests.llm.util import clashing, frame, rows

SCHEMA = "doc_id long, lang string, source string, text string"


def by_hand(data, least, top):
    """Dense, term by term."""
    docs = [(lang or "", source or "", text or "") for _, lang, source, text in data]
    out = []
    for lang in {d[0] for d in docs}:
        df, counts = Counter(), defaultdict(Counter)
        for _, source, text in (d for d in docs if d[0] == lang):
            text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
            terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
            df.update(set(terms))
            counts[source].update(terms)
        kept = [t for t, n in df.items() if n >= least]

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(sum(counts.values(), Counter()))
        for s in p:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1)
                        if part == "pair" or i <= top]
    return sorted(out)


def corpus(seed, n=400, sources=7):
    rnd = random.Random(seed)
    words = [w for w in ("the Of and été ÉTÉ naïve 日本 x Z don't a1b tail_end " * 3).split()] + [f"w{chr(97 + i)}" for i in range(26)]
    out = []
    for i in range(n):
        s = min(rnd.randrange(sources), rnd.randrange(sources))
        text = " ".join(rnd.choice(words[:5 + 5 * s]) for _ in range(rnd.randrange(40)))
        out.append((i, rnd.choice(["en", "fr"]), f"s{s}", text))
        if rnd.random() < 0.3:
            out += [(1000 + i, out[-1][1], f"s{rnd.randrange(sources)}", text)] * rnd.randrange(4)
    return out + [(1, "en", "silent", "12 34 --"), (2, "de", "one", "only source"), (3, "xx", "a", ""), (4, "xx", "b", "rare"),
                  (None, None, None, None), (None, None, "s", "x y x y"), (5, "", "Zé", "x")]


@pytest.mark.parametrize("seed, block, bucket, held", [(1, 256, 32_768, 200_000), (2, 2, 20, 5), (3, 1, 7, 50)])
def test_as_by_hand(spark, monkeypatch, seed, block, bucket, held):
    for name, value in (("BLOCK_SOURCES", block), ("BUCKET_ROWS", bucket), ("HELD", held)):
        monkeypatch.setattr(source_audit, name, value)
    data = corpus(seed)
    docs = clashing(frame(spark, data, SCHEMA)).repartition(3)
    for least, top in ((3, 4), (30, 50)):
        assert sorted(rows(divergence(docs, least, top))) == by_hand(data, least, top)


def test_equal_texts_are_read_once(spark):
    data = ([(i, "en", f"s{i % 3}", "same text") for i in range(90)] + [(1, "fr", "s0", "same text"), (2, "en", "s0", "other")])
    got = collapsed(frame(spark, data, SCHEMA).repartition(5), "text", "lang", "source").collect()
    found = {(r.lang, r.text): {s.source: s.docs for s in r.sources} for r in got}
    assert len(got) == 3
    assert found == {("en", "same text"): {"s0": 30, "s1": 30, "s2": 30}, ("fr", "same text"): {"s0": 1}, ("en", "other"): {"s0": 1}}


def test_a_very_long_text_and_large_counts(spark):
    data = [(i, "en", f"s{i % 2}", "alpha beta " * (200_000 if i == 0 else 1)) for i in range(40)]
    assert sorted(rows(divergence(frame(spark, data, SCHEMA)))) == by_hand(data, 30, 50)
    big = frame(spark, [(10**12, 3 * 10**13, 10**6)], "n long, total long, terms long")
    got = big.select(source_audit.share(*(big[c] for c in big.columns))).first()[0]
    assert got == 1 + 10**9 * (10**12 + 5) // (3 * 10**13 + 5 * 10**6)


def test_empty_table(spark):
    assert rows(divergence(frame(spark, [], SCHEMA))) == []
