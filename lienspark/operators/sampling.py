"""A uniform sample of exactly n rows, or all where there are fewer."""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 10_000
# 16 to this power times the sample size is more rows than any table has.
MAX_ZEROS = 12
HASH_DIGITS = 32
BROADCAST_GROUPS = 10_000
# So many rows of a group are ranked by one task; of more, those of one start of their
# hash, which has so many digits behind its zeros.
RANKED_ROWS = 200_000
EDGE_DIGITS = 4


def sample_quality(fact: DataFrame) -> DataFrame:
    """Loans fit for plotting: a plausible income and a spread other than 0."""
    income, spread = F.col("income"), F.col("interest_rate_spread")
    return fact.where((income > 0) & (income < 1000) & spread.isNotNull() & (spread != 0))


def _hashed(id_column: str, seed: int | None, reproducible: bool) -> Column:
    key = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    if not reproducible:
        salt = str(secrets.randbits(63) if seed is None else seed)
        key = F.concat(F.lit(salt + ":"), key)
    return F.md5(key)


def _zeros(hashed: Column) -> Column:
    """Zeros a hash starts with."""
    return HASH_DIGITS - F.length(F.ltrim(hashed, F.lit("0")))


def _cut(n: int) -> Column:
    """Most zeros that at least ``n`` of the rows counted by zeros have."""
    at_least = (
        F.when(F.sum(F.when(F.col("zeros") >= k, F.col("n_rows"))) >= n, k)
        for k in range(1, MAX_ZEROS + 1)
    )
    return F.greatest(F.lit(0), *at_least)


def _counted(rows: DataFrame, zeros: Column, *keys: str) -> DataFrame:
    known = F.least(zeros, F.lit(MAX_ZEROS)).alias("zeros")
    return rows.groupBy(*keys, known).agg(F.count("*").alias("n_rows"))


def random_rows(
    rows: DataFrame,
    n: int = SAMPLE_ROWS,
    id_column: str = "id",
    seed: int | None = None,
    reproducible: bool = False,
) -> DataFrame:
    """The ``n`` rows first in the order of a hash of their id.

    ``reproducible`` hashes the id alone, so any engine draws the same rows.
    Otherwise ``seed`` is hashed along with it, and no seed means a new one.
    Unlike ``rand`` the order does not depend on how the rows are partitioned,
    so a task that runs twice draws the same rows.

    Sorting with a limit keeps n rows per task and sends all of them to one
    task, too many at thousands of tasks. A first pass over the id therefore
    counts the rows by the zeros their hash starts with. Only rows with as many
    zeros as still leave n of them are sorted: about 16 n rows at most, and the
    same result as without. Both passes must see the same ids, so ids made on the
    fly have to be written first.
    """
    hashed = _hashed(id_column, seed, reproducible)
    zeros = _zeros(hashed)
    cut = _counted(rows, zeros).agg(_cut(n).alias("cut"))
    return rows.where(zeros >= cut.scalar()).orderBy(hashed, id_column).limit(n)


def _few(groups: DataFrame) -> DataFrame:
    """Rows of groups, found at once and broadcast up to ``BROADCAST_GROUPS``."""
    found = groups.limit(BROADCAST_GROUPS + 1).collect()
    if len(found) > BROADCAST_GROUPS:
        return groups
    return F.broadcast(groups.sparkSession.createDataFrame(found, groups.schema))


def _first_drawn(drawn: DataFrame, group: str, n: int, id_column: str) -> DataFrame:
    """The ``n`` rows of each group first in the order of ``draw``, a hash.

    Rows with enough zeros are near. Where no group has more than ``n`` of them they
    are all wanted, and nothing is ordered. Where a group has more than ``RANKED_ROWS``
    they are counted by the start of their hash: what starts lower than where the
    n-th row lies is wanted whole, and only rows that start like it are ranked.
    """
    zeros = _zeros(F.col("draw"))
    by_zeros = _counted(drawn, zeros, group).groupBy(F.col(group).alias("_of"))
    least = F.array(*(F.sum(F.when(F.col("zeros") >= k, F.col("n_rows"))) for k in range(MAX_ZEROS + 1)))
    cuts = by_zeros.agg(_cut(n).alias("_cut"), least.alias("_least"))
    cuts = _few(cuts.select("_of", "_cut", F.get("_least", F.col("_cut")).alias("_near")))
    most = cuts.agg(F.max("_near")).first()[0] or 0
    near = drawn.join(cuts, F.col(group).eqNullSafe(F.col("_of"))).where(zeros >= F.col("_cut"))
    place = F.row_number().over(Window.partitionBy(group).orderBy("draw", id_column))
    if most <= n:
        first = near
    elif most <= RANKED_ROWS:
        first = near.withColumn("_place", place).where(F.col("_place") <= n)
    else:
        crowded = F.col("_near") > n
        start = F.substring("draw", F.lit(1), F.col("_cut") + EDGE_DIGITS).alias("_edge")
        starts = near.where(crowded).groupBy("_of", start).agg(F.count("*").alias("_n"))
        line = Window.partitionBy("_of").orderBy("_edge").rowsBetween(Window.unboundedPreceding, 0)
        left = F.lit(n) - (F.sum("_n").over(line) - F.col("_n"))
        edges = starts.withColumn("_left", left).where(F.col("_left").between(1, F.col("_n")))
        edges = _few(edges.select(F.col("_of").alias("_at"), "_edge", "_left"))
        near = near.join(edges, F.col("_of").eqNullSafe(F.col("_at")), "left")
        whole = near.where(~crowded | (F.col("draw") < F.col("_edge")))
        edge = near.where(crowded & F.col("draw").startswith(F.col("_edge")))
        first = whole.unionByName(edge.withColumn("_place", place).where(F.col("_place") <= F.col("_left")).drop("_place"))
    return first.select(*drawn.columns)


def random_rows_by(
    rows: DataFrame,
    group: str,
    n: int = SAMPLE_ROWS,
    id_column: str = "id",
    seed: int | None = None,
    reproducible: bool = False,
) -> DataFrame:
    """The ``n`` rows of each group first in the order of their hash, with ``draw``, the hash.

    Of samples of all groups ``merged_rows`` makes one of all rows. A task ranks
    ``RANKED_ROWS`` at most, or one of 16 ** ``EDGE_DIGITS`` parts of about 16 n rows,
    and none where no group has more than ``n``. The passes that count run at once;
    their results, a row for each group, are broadcast up to ``BROADCAST_GROUPS``.
    """
    hashed = _hashed(id_column, seed, reproducible)
    return _first_drawn(rows.withColumn("draw", hashed), group, n, id_column)


def merged_rows(samples: DataFrame, n: int = SAMPLE_ROWS, id_column: str = "id") -> DataFrame:
    """The ``n`` rows of all groups that ``random_rows`` draws, from a sample of each group.

    They are chosen before they are ordered, so the order needs no limit, which would
    bring all of them to one task.
    """
    first = _first_drawn(samples.withColumn("_all", F.lit(0)), "_all", n, id_column)
    return first.orderBy("draw", id_column).drop("draw", "_all")
