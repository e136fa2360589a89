import random

import public_tokenizers as P
import tiktoken

from bazaar.llm.common import table
from bazaar.llm.edit_counts import EDIT, Counter, SegmentTree, apply_edit, edited_counts
from bazaar.llm.bpe_transducer import split_pieces
from bazaar.llm.queries import RANKS, op6_edit_counts
from bazaar.llm.vocab import load_ranks
from pyspark.sql import functions as F
from tests.llm.util import clashing, frame, rows

SF = "/root/testdata/sf0.001"
ranks = load_ranks(RANKS)
reference = tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
run = Counter(ranks, P.PATTERN)
PARTS = ["a", "the", " ", "  ", "\n", "é", "'s", "'re", "'", "12", "!!", "ing", "   \n ", "日本", " 'll", "x" * 300, " " * 90, "\t\n"]


def tree(text):
    return SegmentTree(*(x.tolist() for x in run.leaves(split_pieces(run.pattern, text))))


def count(text):
    return len(reference.encode_ordinary(text))


def check(t, text):
    assert (t.tokens[1], t.chars[1]) == (count(text), len(text))
    for i in range(1, t.size):
        assert t.tokens[i] == t.tokens[2 * i] + t.tokens[2 * i + 1] and t.chars[i] == t.chars[2 * i] + t.chars[2 * i + 1]


def test_random_edits_keep_every_sum_right():
    rnd = random.Random(2)
    for _ in range(250):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 3, 300])))
        t = tree(text)
        check(t, text)
        for _ in range(6):
            insert = "".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 1, 2, 50])))
            text, _ = apply_edit(text, t, run, rnd.randint(-2, len(text) + 2), rnd.choice([0, 1, 2, 9, 4000]), insert)
            check(t, text)


def test_an_edit_reads_only_its_surroundings():
    text = "some words of a long text, " * 4_000
    t = tree(text)
    for start, length, insert in ((50_000, 0, " new"), (7, 3, ""), (len(text), 0, " end"), (90_000, 600, "x")):
        text, again = apply_edit(text, t, run, start, length, insert)
        assert again < 2_000
        check(t, text)


def test_frame(spark):
    edits = [(1, 2, "it's"), (-5, 1, None), (10**9, 5, " end"), (None, None, None)]
    docs = [(1, "one two three", edits), (1, "one two three", edits), (None, None, edits), (2, "", None),
            (3, "x y " * 100_000, [(1000, 10, "ab"), None]), (4, "kept", [])]
    df = clashing(frame(spark, docs, f"doc_id long, text string, e array<{EDIT}>"))

    def edited(text, es):
        for e in es or []:
            s, n, ins = (e[0] or 0, e[1] or 0, e[2] or "") if e else (0, 0, "")
            s = max(0, min(s, len(text)))
            text = text[:s] + ins + text[min(len(text), s + n):]
        return text

    out = edited_counts(df, F.col("e"), RANKS, P.PATTERN)
    got = [tuple(r)[:4] + (r["text"],) for r in out.collect()]
    want = [(i, count(t or ""), count(edited(t or "", es)), len(edited(t or "", es)), edited(t or "", es)) for i, t, es in docs]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert rows(edited_counts(df.limit(0), F.col("e"), RANKS, P.PATTERN)) == []


def test_state_is_taken_up_again(spark):
    edit = F.array(F.struct(F.lit(500).cast("long").alias("start"), F.lit(2).cast("long").alias("length"), F.lit("new ").alias("insert")))
    first = edited_counts(table(spark, SF, "documents"), edit, RANKS, P.PATTERN)
    again = edited_counts(first, edit, RANKS, P.PATTERN)
    for r in again.collect():
        assert r["n_tokens_after"] == count(r["text"]) and r["reencoded_chars"] < 3_000


def test_query_on_all_documents(spark):
    got = {r[0]: r for r in op6_edit_counts(spark, SF).collect()}
    for d in table(spark, SF, "documents").collect():
        text, s, n = d["text"], d["source"], len(d["text"])
        text = text[:n // 5] + s + text[n // 5 + len(s):]
        text = text[:n // 2] + text[n // 2 + 7:]
        text = text[:n * 4 // 5] + f" {d['lang']} " + text[n * 4 // 5:]
        text += "\n" + s
        r = got.pop(d["doc_id"])
        assert (r["n_tokens"], r["n_tokens_after"], r["n_chars_after"]) == (count(d["text"]), count(text), len(text))
    assert not got
