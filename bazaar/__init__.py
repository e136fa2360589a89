"""bazaar: store analytics (marts, basket rules, neighbour recommender,
lexicon sentiment) expressed as Spark DataFrame plans.

Every public operator is a function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions`` (and ``pyspark.ml.fpm`` for rule mining); column
names are parameters so the same operator runs on the store schema and on
the bound test tables.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
