"""URL filters: rules indexed by their rarest literal token.

A rule is (host, path, action). It fits its host and all subdomains when the
path of the URL starts with the rule's path. Each rule is filed under the one
of its literal tokens that the URLs hold least often (host labels, and path
words closed by a separator inside the rule). The tokens of a URL fetch
candidate rules from that index, and only those run as regular expressions;
the longest fitting rule wins.

Everything is DataFrame work: the index is a table, tokens meet it in a join
(Spark broadcasts it while it is small and shuffles it beyond that), and each
distinct host and path is judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import ascii_lower, pick, stored

DEFAULT_VERDICT = "allow"
ANY = "*"  # token of rules without a literal token; every URL holds it


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def _tokens(host: Column, path: Column, closed: bool) -> Column:
    """Tokens of a URL, or of a rule: there a path word counts only where a
    separator closes it inside the rule."""
    word = r"[A-Za-z0-9]+(?=[^A-Za-z0-9])" if closed else r"[A-Za-z0-9]+"
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.regexp_extract_all(path, F.lit(word), F.lit(0))
    return F.array_distinct(F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.transform(words, lambda x: F.concat(F.lit("p:"), x)),
        F.array(F.lit(ANY))))


def _escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"([^A-Za-z0-9])", r"\\$1")


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, rule, rule_host, action, pattern): one row per rule.

    ``urls`` holds host and path. Token counts cover all of its rows.
    """
    r = (pick(rules, host="string", path="string", action="string")
         .select(ascii_lower(F.coalesce("host", F.lit(""))).alias("rule_host"),
                 F.coalesce("path", F.lit("")).alias("rule_path"), "action")
         .where(F.col("action").isNotNull())
         .distinct()
         .withColumn("rule", F.concat("rule_host", "rule_path")))
    head = F.when(F.col("rule_host") == "", F.lit(r"^[^/]*")).otherwise(
        F.concat(F.lit(r"^(?:[^/]*\.)?"), _escaped(F.col("rule_host"))))
    tail = F.when(F.col("rule_path") == "", F.lit(r"(?=/|\z)")).otherwise(_escaped(F.col("rule_path")))
    r = r.withColumn("pattern", F.concat(head, tail))
    filed = r.withColumn("token", F.explode(_tokens(F.col("rule_host"), F.col("rule_path"), True)))
    seen = (urls.select(F.explode(_tokens(F.col("host"), F.col("path"), False)).alias("token"))
            .join(filed.select("token").distinct(), "token", "left_semi")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    # the sentinel sorts last: it is used only by rules that have no other token
    cost = F.struct((F.col("token") == ANY).alias("last"), F.coalesce("n", F.lit(0)).alias("n"),
                    F.col("token").alias("token"))
    return (filed.join(seen, "token", "left")
            .groupBy("rule", "rule_host", "action", "pattern").agg(F.min(cost).alias("best"))
            .select(F.col("best.token").alias("token"), "rule", "rule_host", "action", "pattern"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """(id, host, path, rule, verdict), one row per input row.

    Null URLs and URLs without ``://`` have an empty host and path and get
    the default verdict unless a rule without a host fits; repeated rows are
    each answered; an empty rule table gives the default everywhere; rules
    with a null action are ignored, null host or path count as empty. Of rules
    of equal length the one with the longer host wins, then the larger text,
    then ``block`` before ``allow``. Columns other than the two are ignored. A
    URL of any length is read whole; an empty table of pages gives an empty one.
    """
    p = pick(pages, **{id_col: "long", url_col: "string"})
    p = p.select(id_col, url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    index = stored(rule_index(p, rules), "url-rule-index", rules.count())
    target = F.concat("host", "path")
    fits = (p.select("host", "path").distinct()
            .withColumn("token", F.explode(_tokens(F.col("host"), F.col("path"), False)))
            .join(index, "token")
            .where(F.rlike(target, F.col("pattern"))))
    best = F.max(F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), "rule", "action"))
    # stored, so that the join below reads plain shuffles and a hot URL is split
    ruled = stored(fits.groupBy("host", "path").agg(best.alias("best")), "url-verdicts", p.count())
    return (p.join(ruled, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict")))
