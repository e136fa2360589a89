"""Join helpers.

``natural_join`` keeps the source's "join on all common names" behaviour
honest: the key list is explicit and the call fails when the frames share
other column names (T4). SQL null semantics by default; ``null_safe=True``
matches nulls to nulls as pandas does (T5).

No join here forces a broadcast: Catalyst and AQE broadcast a side when its
measured size is under the session's threshold and shuffle both otherwise.

``block_join`` and ``block_self_pairs`` meet rows of a key block against block.
There is one plan for all keys: a key with few rows is a single block. Hot
keys (more than ``max_block`` rows, found by a pre-aggregated count) are cut
into blocks; their sizes reach the rows through a join on the key and a salt,
so no task receives all rows of a hot key, neither there nor when the blocks
meet. Everything is lazy: nothing runs until the caller's action.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key per side of a block.
MAX_BLOCK_ROWS = 10_000
# Parts that the rows of a key are dealt to while they learn their block count.
SALTS = 64


def natural_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "inner",
                 null_safe: bool = False) -> DataFrame:
    on = [on] if isinstance(on, str) else list(on)
    common = set(left.columns) & set(right.columns)
    if common != set(on):
        raise ValueError(f"frames share {sorted(common)}, join keys are {sorted(on)}")
    if not null_safe:
        return left.join(right, on=on, how=how)
    l, r = left.alias("__l"), right.alias("__r")
    cond = None
    for k in on:
        c = F.col(f"__l.{k}").eqNullSafe(F.col(f"__r.{k}"))
        cond = c if cond is None else cond & c
    keys = [F.coalesce(F.col(f"__l.{k}"), F.col(f"__r.{k}")).alias(k) for k in on]
    rest_l = [F.col(f"__l.{c}") for c in left.columns if c not in on]
    rest_r = [F.col(f"__r.{c}") for c in right.columns if c not in on]
    return l.join(r, cond, how).select(*keys, *rest_l, *rest_r)


def _hot(df: DataFrame, key: str, max_block: int, out: str) -> DataFrame:
    """(key, number of blocks) of the keys with more than ``max_block`` rows:
    at most rows / ``max_block`` of them."""
    n = F.col("__n")
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(n > max_block)
            .select(key, F.ceil(n / F.lit(float(max_block))).cast("int").alias(out)))


def attach(df: DataFrame, key: str, member: str, hot: DataFrame, defaults: Mapping[str, int]) -> DataFrame:
    """The rows with what ``hot`` holds for their key, defaults where it lacks
    the key; by key and salt, so the rows of a key stay apart. Never by a
    broadcast: Spark takes the salted table for as small as ``hot``, and there
    may be many hot keys."""
    salted = hot.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    own = df.withColumn("__salt", F.pmod(F.xxhash64(F.col(member)), F.lit(SALTS)).cast("int"))
    joined = own.join(salted, [key, "__salt"], "left").drop("__salt")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def _own(member: str, blocks: str) -> Column:
    """A row's block: a hash of its member, so that a task that runs again
    rebuilds the same blocks. A second seed, independent of the salt."""
    return F.pmod(F.xxhash64(F.lit("block"), F.col(member)), F.col(blocks)).cast("int")


def _every(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def with_group_sum(df: DataFrame, key: str, member: str, value: Column, out: str) -> DataFrame:
    """The rows with the sum of ``value`` over the rows of their key, without
    bringing the rows of a key together: sums per key and salt, their totals
    per key, and these back to the rows by key and salt. Never by a broadcast:
    keys are as many as users."""
    x = df.withColumn("__salt", F.pmod(F.xxhash64(F.col(member)), F.lit(SALTS)).cast("int"))
    part = x.groupBy(key, "__salt").agg(F.sum(value).alias("__part"))
    total = part.groupBy(key).agg(F.sum("__part").alias(out))
    back = part.select(key, "__salt").join(total.hint("merge"), key)  # at most SALTS rows a key
    return x.join(back.hint("merge"), [key, "__salt"]).drop("__salt")


def block_join(left: DataFrame, right: DataFrame, key: str, left_member: str,
               right_member: str, max_block: int = MAX_BLOCK_ROWS,
               condition: Column | None = None) -> DataFrame:
    """Equi-join on ``key`` in which a key with many rows on either side is met
    block against block.

    The left rows of a key are cut into S_l = ceil(n_l / max_block) blocks by a
    hash of ``left_member`` and the right rows into S_r blocks by
    ``right_member``; each left row goes to every right block and each right
    row to every left block, and rows meet on (key, left block, right block):
    every matching pair once, in a task that holds about ``max_block`` rows
    per side. ``condition`` is an extra predicate on the joined columns.
    """
    hot = (_hot(left, key, max_block, "__nl").withColumn("__nr", F.lit(1))
           .unionByName(_hot(right, key, max_block, "__nr").withColumn("__nl", F.lit(1)))
           .groupBy(key).agg(F.max("__nl").alias("__nl"), F.max("__nr").alias("__nr")))
    lx = attach(left, key, left_member, hot, {"__nl": 1, "__nr": 1})
    rx = attach(right, key, right_member, hot, {"__nl": 1, "__nr": 1})
    lx = lx.withColumn("__a", _own(left_member, "__nl")).withColumn("__b", _every("__nr")).drop("__nl", "__nr")
    rx = rx.withColumn("__b", _own(right_member, "__nr")).withColumn("__a", _every("__nl")).drop("__nl", "__nr")
    j = lx.join(rx, [key, "__a", "__b"])
    return (j.where(condition) if condition is not None else j).drop("__a", "__b")


def block_self_pairs(df: DataFrame, key: str, member: str, values: Sequence[str] = (),
                     max_block: int = MAX_BLOCK_ROWS) -> DataFrame:
    """All pairs of members sharing a key, each unordered pair once
    (``l_<member> < r_<member>``), keys met in blocks as in ``block_join``.

    Output columns: key, ``l_<member>``, ``r_<member>``, ``l_<v>``, ``r_<v>``.
    """
    base = df.select(key, member, *values)
    x = attach(base, key, member, _hot(base, key, max_block, "__n"), {"__n": 1})
    cols = [member, *values]
    lh = x.select(key, *[F.col(c).alias(f"l_{c}") for c in cols], _own(member, "__n").alias("__a"), _every("__n").alias("__b"))
    rh = x.select(key, *[F.col(c).alias(f"r_{c}") for c in cols], _own(member, "__n").alias("__b"), _every("__n").alias("__a"))
    return (lh.join(rh, [key, "__a", "__b"]).where(F.col(f"l_{member}") < F.col(f"r_{member}"))
            .drop("__a", "__b"))
