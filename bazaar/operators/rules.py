"""Baskets and association rules.

``pair_rules`` is the relational form (counts, a self join on the basket
key, ratios); ``association_rules`` runs Spark ML's parallel FP-growth for
itemsets of any length and gives rules of one item on the right;
``lattice_rules`` gives those of any number of items on either side. All keep
only rules with a non-empty left side.

Scale notes. Before any pair is formed, basket rows are cut to frequent
items (Apriori): an item needs ``min_support * n_baskets`` baskets, so at
most ``avg_basket_size / min_support`` items survive, a bound that depends on
the threshold, not on the data volume. The distinct basket items are stored
once and feed every count. Pair counts are partially aggregated
before their shuffle; a basket with more than ``max_block`` frequent items
is split into blocks (``block_self_pairs``) instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.operators.joins import MAX_BLOCK_ROWS, block_self_pairs
from bazaar.session import stored


def baskets(df: DataFrame, order_col: str, item_col: str, out: str = "items") -> DataFrame:
    """One row per order with its distinct items, sorted.

    ``collect_set`` holds distinct items only (duplicates are removed in the
    map-side partial aggregate), as FP-growth requires.
    """
    clean = df.where(F.col(order_col).isNotNull() & F.col(item_col).isNotNull())
    return clean.groupBy(order_col).agg(F.array_sort(F.collect_set(item_col)).alias(out))


def pair_rules(df: DataFrame, order_col: str, item_col: str, min_support: float,
               min_confidence: float, min_lift: float = 1.0, digits: int = 9,
               max_block: int = MAX_BLOCK_ROWS) -> DataFrame:
    """Rules ``a -> b`` between single items.

    support = baskets with a and b / baskets; confidence = support(ab) /
    support(a); lift = confidence / support(b). Output: antecedent,
    consequent, support, confidence, lift.
    """
    rows = stored(df.where(F.col(order_col).isNotNull() & F.col(item_col).isNotNull())
                  .select(F.col(order_col).alias("o"), F.col(item_col).alias("i")).distinct(), "basket-items")
    # the number of baskets, as a scalar subquery of each plan that needs it
    n = rows.agg(F.countDistinct("o").cast("double")).scalar()
    frequent = rows.groupBy("i").agg(F.count(F.lit(1)).alias("ci")).where(F.col("ci") / n >= F.lit(min_support))
    kept = rows.join(frequent.select("i"), "i", "left_semi")
    pairs = (block_self_pairs(kept, "o", "i", max_block=max_block)
             .groupBy("l_i", "r_i").agg(F.count(F.lit(1)).alias("cab"))
             .where(F.col("cab") / n >= F.lit(min_support)))
    both = pairs.select("cab", F.explode(F.array(
        F.struct(F.col("l_i").alias("x"), F.col("r_i").alias("y")),
        F.struct(F.col("r_i").alias("x"), F.col("l_i").alias("y")))).alias("d")).select("cab", "d.*")
    fx = frequent.select(F.col("i").alias("x"), F.col("ci").alias("cx"))
    fy = frequent.select(F.col("i").alias("y"), F.col("ci").alias("cy"))
    rules = (both.join(fx, "x").join(fy, "y")
             .select(F.col("x").alias("antecedent"), F.col("y").alias("consequent"),
                     (F.col("cab") / n).alias("support"),
                     (F.col("cab") / F.col("cx")).alias("confidence"),
                     ((F.col("cab") / F.col("cx")) / (F.col("cy") / n)).alias("lift")))
    rules = rules.where((F.col("confidence") >= F.lit(min_confidence)) & (F.col("lift") >= F.lit(min_lift)))
    return rules.select("antecedent", "consequent", *[F.round(c, digits).alias(c)
                                                      for c in ("support", "confidence", "lift")])


def association_rules(basket_df: DataFrame, items_col: str, min_support: float,
                      min_confidence: float, min_lift: float = 1.0,
                      num_partitions: int | None = None, digits: int = 9) -> DataFrame:
    """R2: FP-growth rules (several items on the left, one on the right).

    Output: antecedent and consequent as arrays, support, confidence, lift;
    rules under ``min_lift`` are dropped. FP-growth partitions the
    conditional trees by item across executors.
    """
    from pyspark.ml.fpm import FPGrowth

    fp = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(basket_df.select(items_col))
    rules = model.associationRules.where(F.col("lift") >= F.lit(min_lift))
    return rules.select(F.array_sort("antecedent").alias("antecedent"), "consequent",
                        *[F.round(c, digits).alias(c) for c in ("support", "confidence", "lift")])


def frequent_itemsets(basket_df: DataFrame, items_col: str, min_support: float,
                      num_partitions: int | None = None) -> DataFrame:
    """(items, freq): the sorted itemsets of at least ``min_support``."""
    from pyspark.ml.fpm import FPGrowth

    fp = FPGrowth(itemsCol=items_col, minSupport=min_support)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    found = fp.fit(basket_df.select(items_col)).freqItemsets
    return found.select(F.array_sort("items").alias("items"), "freq")


def lattice_rules(basket_df: DataFrame, items_col: str, min_support: float, min_confidence: float,
                  min_lift: float = 1.0, num_partitions: int | None = None, digits: int = 9) -> DataFrame:
    """R2: rules with any number of items on each side.

    Every frequent itemset is split level by level on the size of the right
    side. If ``A -> C`` of an itemset is below the confidence bound, so is every
    rule of that itemset whose right side holds C: its left side is a subset of
    A, in as many baskets or more. So a right side of m items is only tried
    where all its parts of m - 1 items passed: two of them that differ in their
    last item are joined, then its other parts are looked up. The supports of
    both sides come from the itemsets by joins on the itemset itself. The bound
    prunes each level; the levels end with the longest itemset or when none
    passes. Lift doesn't prune, as it can rise with the right side.

    Output: antecedent and consequent as sorted arrays, support, confidence,
    lift. Empty baskets and an empty table give no rules.
    """
    sets = stored(frequent_itemsets(basket_df, items_col, min_support, num_partitions), "itemsets")
    n = basket_df.agg(F.count(F.lit(1)).cast("double")).scalar()
    freq_of = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("of_a"))

    def passing(tried: DataFrame) -> DataFrame:
        """Of (items, freq, consequent) those that reach the confidence."""
        split = tried.withColumn("antecedent", F.array_except("items", "consequent"))
        return stored(split.join(freq_of, "antecedent").where(F.col("freq") / F.col("of_a") >= min_confidence), "rules-of-a-level")

    several = sets.where(F.size("items") > 1)
    level = passing(several.withColumn("consequent", F.explode(F.transform("items", lambda x: F.array(x)))))
    out, m = None, 1
    while not level.isEmpty():
        out = level if out is None else out.unionByName(level)
        m += 1
        head = F.slice("consequent", 1, m - 2)
        left = level.where(F.size("items") > m).select("items", "freq", head.alias("head"), F.element_at("consequent", -1).alias("a"))
        right = left.select("items", "head", F.col("a").alias("b"))
        tried = (left.join(right, ["items", "head"]).where(F.col("a") < F.col("b"))
                 .select("items", "freq", F.concat("head", F.array("a", "b")).alias("consequent")))
        if m > 2:
            parts = F.transform("consequent", lambda x: F.array_remove("consequent", x))
            known = level.select("items", F.col("consequent").alias("part"))
            tried = (tried.withColumn("part", F.explode(parts)).join(known, ["items", "part"])
                     .groupBy("items", "freq", "consequent").agg(F.count(F.lit(1)).alias("parts"))
                     .where(F.col("parts") == m).drop("parts"))
        level = passing(tried)
    rules = level if out is None else out
    of_c = sets.select(F.col("items").alias("consequent"), F.col("freq").alias("of_c"))
    confidence = F.col("freq") / F.col("of_a")
    rules = rules.join(of_c, "consequent").select(
        "antecedent", "consequent", (F.col("freq") / n).alias("support"), confidence.alias("confidence"),
        (confidence / (F.col("of_c") / n)).alias("lift"))
    return rules.where(F.col("lift") >= min_lift).select(
        "antecedent", "consequent", *[F.round(c, digits).alias(c) for c in ("support", "confidence", "lift")])
