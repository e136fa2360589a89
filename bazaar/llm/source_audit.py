"""How the sources of a language differ in their use of words.

Equal texts of a language are collapsed first: per text the number of its
documents in each source. Each text is then read into terms once, and its
counts are added to every one of its sources, times its documents there. A
language keeps the terms that occur in enough of its documents. Sources are
compared pair by pair on smoothed shares of the kept terms, from the terms that
occur on either side only; all others enter through one number for each pair.

All arithmetic is on integers: a share is 1 + floor(``UNIT`` * (count +
``PRIOR``) / (N + ``PRIOR`` * V)), with N the source's count of kept terms and
V the number of kept terms.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import pick, stored

TERM = rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT, PRIOR = 1_000_000_000, 5
LEAST_DOCS = 30
TOP_TERMS = 50
BLOCK_SOURCES = 256      # sources of a block; blocks of sources meet pair by pair
BUCKET_ROWS = 32_768     # rows (source, term) of a bucket of terms, about
HELD = 400_000           # sums that a task holds, about, before it passes them on
TEXTS = 32               # texts read at once


def collapsed(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, text, sources): each text once per language, with the number of
    its documents in each of its sources. Texts are equal if length and SHA-256
    are. Copies are counted, and all but one text dropped, before the shuffle;
    the counts travel without the text."""
    own = pick(docs, **{lang_col: "string", source_col: "string", text_col: "string"}).toDF("lang", "source", "text")
    own = own.na.fill("").withColumn("key", F.struct(F.sha2("text", 256).alias("sha"), F.length("text").alias("n")))
    texts = own.groupBy("lang", "key").agg(F.first("text").alias("text"))
    counts = (own.groupBy("lang", "key", "source").agg(F.count(F.lit(1)).alias("docs"))
              .groupBy("lang", "key").agg(F.collect_list(F.struct("source", "docs")).alias("sources")))
    return texts.join(counts, ["lang", "key"]).drop("key")


def term_sums(texts: DataFrame) -> DataFrame:
    """Two kinds of rows (lang, source, term, docs, n), sums of the texts that a
    task has read: without a source, in how many documents of the language the
    term is; with one, how often it occurs there. A row of the second kind is
    only needed for a kept term, so the first kind is shuffled alone."""
    def run(batches):
        find = re.compile(TERM).findall
        docs, counts = defaultdict(Counter), defaultdict(Counter)  # by lang; by lang and source

        def out():
            for held, with_source in ((docs, False), (counts, True)):
                for key, sums in held.items():
                    n = len(sums)
                    lang, source = key if with_source else (key, None)
                    none, value = pa.nulls(n, pa.int64()), pa.array(list(sums.values()), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                         pa.array(list(sums), pa.binary()).cast(pa.string()), none if with_source else value,
                         value if with_source else none], names=["lang", "source", "term", "docs", "n"])
                held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                for row in batch.slice(at, TEXTS).to_pylist():
                    lang, sources = row["lang"], row["sources"]
                    terms = find(row["text"].encode().lower())  # of bytes, lower() changes A-Z only
                    if len(sources) == 1 and sources[0]["docs"] == 1:
                        docs[lang].update(set(terms))
                        counts[lang, sources[0]["source"]].update(terms)
                        continue
                    own, copies = Counter(terms), sum(x["docs"] for x in sources)
                    docs[lang].update(dict.fromkeys(own, copies))
                    for x in sources:
                        counts[lang, x["source"]].update({term: n * x["docs"] for term, n in own.items()})
                if sum(map(len, docs.values())) + sum(map(len, counts.values())) >= HELD:
                    yield from out()
        yield from out()

    return texts.mapInArrow(run, "lang string, source string, term string, docs long, n long")


def share(n: Column, total: Column, terms: Column) -> Column:
    """Exact for any counts."""
    wide = (n + PRIOR).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.when(terms > 0, 1 + F.call_function("div", wide, (total + terms * PRIOR).cast("decimal(19,0)")))


def _pair_sums(a: pa.Table, b: pa.Table, same: bool, terms: int) -> tuple[list, list, list]:
    """(source, item, sum) for each source of the first block with each of the
    second, or with all others of the same: the differences of their shares,
    over ``terms`` kept terms. ``a``: the blocks' sources (source, side, base),
    base the share of a term that does not occur; ``b``: the rows
    (source, term, share) of both.

    For one source x: |base of x - base of y| for each term, corrected for the
    terms of x as if y had none of them, then for the terms of y.
    """
    names, side, base = a.column("source").to_pylist(), a.column("side").to_numpy(), a.column("base").to_numpy()
    place = {n: i for i, n in enumerate(names)}
    source = np.array([place[s] for s in b.column("source").to_pylist()], np.int64)
    coded = b.column("term").combine_chunks().dictionary_encode()
    order = np.argsort(source, kind="stable")
    source, term, p = source[order], coded.indices.to_numpy()[order], b.column("share").to_numpy()[order]
    ends = np.searchsorted(source, np.arange(len(names) + 1))
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    theirs = np.isin(source, right)
    of, at, q = source[theirs], term[theirs], p[theirs]
    shares, out = np.empty(len(coded.dictionary), np.int64), ([], [], [])
    for x in left:
        own = slice(ends[x], ends[x + 1])
        shares[:] = base[x]
        shares[term[own]] = p[own]
        got = np.zeros(len(names), np.int64)
        np.add.at(got, of, np.abs(shares[at] - q) - np.abs(shares[at] - base[of]))
        alone = np.sort(p[own])
        before = np.concatenate([[0], np.cumsum(alone)])
        k = np.searchsorted(alone, base)
        got += base * (2 * k - len(alone)) + before[-1] - 2 * before[k] + (terms - len(alone)) * np.abs(base[x] - base)
        items = right[right != x]
        out[0].extend([names[x]] * len(items))
        out[1].extend(names[y] for y in items)
        out[2].extend(got[items].tolist())
    return out


def pair_differences(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language: the sum
    of the differences of their shares over all kept terms.

    ``kept``: (lang, source, term, share); ``groups``: (lang, source, terms,
    base). Sources are cut into blocks, terms into buckets, so that neither a
    language of many sources nor one of many terms makes a large task.
    """
    size = (groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
            .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "lang", "left").na.fill(0, ["rows"]))
    blocks = F.ceil(F.col("sources") / BLOCK_SOURCES).cast("int")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / blocks / BUCKET_ROWS)).cast("int")
    # a row for each language; stored, so that Spark sees how small it is
    size = stored(size.select("lang", blocks.alias("blocks"), buckets.alias("buckets")), "blocks-of-langs", rows=1)
    own = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    # each block meets each, the smaller first
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(other, F.col("own")).alias("i"), F.greatest(other, F.col("own")).alias("j")))

    def met(df: DataFrame) -> DataFrame:
        wide = df.join(size, "lang").withColumn("own", own).withColumn("pair", F.explode(pairs))
        return wide.withColumns({"side": F.when(F.col("own") == F.col("pair.i"), 0).otherwise(1),
                                "i": F.col("pair.i"), "j": F.col("pair.j")})

    sources = met(groups).withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))).select(
        "lang", "bucket", "i", "j", "source", "side", "base", "terms")
    rows = met(kept).withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")).select(
        "lang", "bucket", "i", "j", "source", "term", "share")
    key = ["lang", "bucket", "i", "j"]

    def meet(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        lang, bucket, i, j = (k.as_py() for k in key)
        # the terms that occur on neither side are counted once, in the first bucket
        terms = a.column("terms")[0].as_py() if a.num_rows and bucket == 0 else 0
        source, item, value = _pair_sums(a, b, i == j, terms)
        if i != j:
            source, item, value = source + item, item + source, value + value
        return pa.table({"lang": pa.array([lang] * len(source), pa.string()), "source": pa.array(source, pa.string()),
                         "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})

    return (sources.groupBy(*key).cogroup(rows.groupBy(*key))
            .applyInArrow(meet, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds for each
    source all others of its language, by falling difference; part ``term`` its
    ``top_terms`` terms by which its share most exceeds the language's. Ties go
    to the item that is first in UTF-8.

    Null texts, languages and sources are empty ones. A source without any kept
    term takes part, with the shares of terms that do not occur; in a language
    without kept terms all differences are 0. Repeated rows are documents like
    any other, an empty table gives an empty one, a text of any length is read
    whole, and other columns are ignored.
    """
    own = pick(docs, **{lang_col: "string", source_col: "string"}).toDF("lang", "source").na.fill("")
    sums = stored(term_sums(collapsed(docs, text_col, lang_col, source_col)), "term-sums")
    terms = stored(sums.where(F.col("source").isNull()).groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
                   .where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    # the kept terms of a partition fit a hash table, so the many counts need no sort
    counts = stored(sums.where(F.col("source").isNotNull()).drop("docs").join(terms.hint("shuffle_hash"), ["lang", "term"])
                    .groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "terms-of-sources")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"))
    langs = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all").alias("lang_total"))
    kept = counts.join(of_lang.hint("shuffle_hash"), ["lang", "term"])
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = stored(own.distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
                    .na.fill(0, ["terms", "lang_total", "total"])
                    .withColumn("base", F.coalesce(share(zero, F.col("total"), F.col("terms")), zero)), "sources-of-langs")
    kept = stored(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("share"),
        share(F.col("all"), F.col("lang_total"), F.col("terms")).alias("of_lang")), "shares")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (pair_differences(kept.drop("of_lang"), groups.select("lang", "source", "terms", "base"))
             .withColumn("rank", F.row_number().over(by_value)))
    above = (kept.where(F.col("share") > F.col("of_lang"))
             .select("lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("of_lang")).alias("value"))
             .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms))

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionByName(part(above, "term"))
