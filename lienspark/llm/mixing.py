"""Mixing sources to target weights with equal blocks, by Sainte-Laguë apportionment.

Sources in the order of their code points, null last, get the weights in turn.
They share all words by weight; no target exceeds ``CAP`` times its source, and
what is over goes to the others by weight, until none is above.

Words are dealt in equal blocks. A block goes to the source with the highest
quotient target / (2 k + 1), k being the blocks it has; each source's blocks go to
its shards in the same way, by their words. In a shard the documents stand in an
order given by a seeded hash, and blocks are taken from the front, round after
round where the quota is larger than the shard. The last block may end within a
document, so ``taken`` counts words.

Which blocks are certain is worked out from the shares: only the few whose
quotients lie around the last one dealt are ranked, a handful for each source or
shard. A source is cut into shards by the hash, so that a large one is no single
group; there are ``SHARDS`` of one source at the most.

Nulls and corner cases: a null text has size 0; null is a source by itself, and so
is the empty name; a document without words takes nothing; without any words all
targets are 0; rows that repeat an id are documents of their own; only ``doc_id``,
``source`` and ``text`` are read. All work is done by DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lienspark.llm.io import written
from lienspark.llm.registry import read, registered

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix"
# Blocks are a millionth of all words, between 1 and 64 words.
BLOCKS, BLOCK_WORDS = 1 << 20, 64
SHARD_WORDS, SHARDS = 1 << 16, 4096
# Rows per source that are sent to every executor; more are joined.
BROADCAST_SOURCES = 10_000

WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and the number of words."""
    return docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size")
    )


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: ``number`` (its place), ``source_size``, ``target`` and ``total``."""
    place = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    weights = F.array(*map(F.lit, WEIGHTS))
    by_source = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(place))
        .withColumn("weight", F.element_at(weights, (F.col("number") - 1) % len(WEIGHTS) + 1).cast("long"))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("cap", F.col("source_size") * CAP)
    )
    # In the order of cap / weight the capped sources come first: one is capped if
    # its cap is no more than its share of what those before it have left.
    order = Window.orderBy(F.expr("CAST(cap AS DOUBLE) / weight"), "number")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    by_source = (
        by_source.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(so_far), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(so_far), F.lit(0)))
        .withColumn("capped", F.col("cap").cast(big) * F.col("rest") <= F.col("left").cast(big) * F.col("weight"))
        .withColumn("dealt", F.col("total") - F.coalesce(F.sum(F.expr("IF(capped, cap, 0L)")).over(every), F.lit(0)))
        .withColumn("open", F.sum(F.expr("IF(capped, 0L, weight)")).over(every))
    )
    target = F.expr("IF(capped, CAST(cap AS DOUBLE), CAST(dealt AS DOUBLE) * weight / open)")
    return by_source.select("source", "number", "source_size", "total", target.alias("target"))


def apportioned(parties: DataFrame, group: list[str]) -> DataFrame:
    """``parties`` with ``quota``: ``seats`` blocks by ``party_weight`` within a group.

    ``seats`` and ``weight_sum`` (of the group) stand in each row; ties go to the
    lower ``number``. With n parties the highest quotients give each party its share
    of the seats up to 1 + n * weight / weight_sum, so only seats in that range are
    ranked, about 6 n in all.
    """
    together = Window.partitionBy(*group)
    ranged = (
        parties.withColumn("parties", F.count("*").over(together))
        .withColumn("part", F.expr("IF(weight_sum > 0, CAST(party_weight AS DOUBLE) / weight_sum, 0D)"))
        .withColumn("low", F.expr("CAST(greatest(0D, floor(seats * part - (parties + 2) * part - 1)) AS BIGINT)"))
        .withColumn("high", F.expr("IF(part > 0, CAST(ceil(seats * part + (parties + 2) * part + 1) AS BIGINT), low)"))
        .withColumn("open", F.col("seats") - F.sum("low").over(together))
    )
    ranked = (
        ranged.where("high > low")
        .withColumn("k", F.explode(F.expr("sequence(low, high - 1)")))
        .withColumn("quotient", F.expr("CAST(party_weight AS DOUBLE) / (2 * k + 1)"))
        .withColumn("spot", F.row_number().over(together.orderBy(F.desc("quotient"), "number", "k")))
        .groupBy(*group, "number")
        .agg(F.sum(F.expr("IF(spot <= open, 1L, 0L)")).alias("extra"))
    )
    kept = ranged.join(ranked, [*group, "number"], "left")
    return kept.withColumn("quota", F.col("low") + F.coalesce("extra", F.lit(0))).select(*parties.columns, "quota")


def mix_sources(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: ``size``, ``source_size``, ``target`` and ``taken`` words."""
    sizes = written(sized(docs), "sizes")
    block = F.expr(f"greatest(1L, least({BLOCK_WORDS}L, total DIV {BLOCKS}))")
    sources = (
        targets(sizes)
        .withColumn("block", block)
        .withColumn("all", F.lit(0))
        .withColumn("seats", F.expr("total DIV block"))
        .withColumnsRenamed({"target": "party_weight"})
        .withColumn("weight_sum", F.col("total").cast("double"))
    )
    sources = apportioned(sources, ["all"]).withColumn(
        "shards", F.expr(f"least({SHARDS}L, greatest(1L, CAST(ceil(source_size / {SHARD_WORDS}D) AS BIGINT)))")
    )
    sources = written(
        sources.select("source", F.col("number").alias("place"), "source_size", F.col("party_weight").alias("target"), "block", "shards", "quota"),
        "sources",
    )
    few = sources.count() <= BROADCAST_SOURCES
    by_source = sources.withColumnRenamed("source", "of")
    hashed = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    placed = sizes.join(F.broadcast(by_source) if few else by_source, F.col("source").eqNullSafe(F.col("of"))).withColumn("order", hashed)
    shard = F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % F.col("shards")
    placed = placed.withColumn("shard", shard).select("doc_id", "size", "place", "shard", "order", "source_size", "target", "block", "quota")

    shards = (
        placed.groupBy("place", F.col("shard").alias("number"))
        .agg(F.sum("size").alias("party_weight"), F.first("source_size").alias("weight_sum"), F.first("quota").alias("seats"))
    )
    quotas = apportioned(shards, ["place"]).select(
        "place", F.col("number").alias("shard"), F.col("party_weight").alias("shard_size"), F.col("quota").alias("shard_quota")
    )
    line = Window.partitionBy("place", "shard").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = placed.withColumn("before", F.sum("size").over(line) - F.col("size")).join(quotas, ["place", "shard"])
    words = F.col("shard_quota") * F.col("block")
    rounds = F.expr("IF(shard_size > 0, shard_quota * block DIV shard_size, 0L)")
    rest = words - rounds * F.col("shard_size") - F.col("before")
    taken = F.least(CAP * F.col("size"), rounds * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least("size", rest)))
    return laid.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def oracle(documents: str = "documents") -> str:
    """DuckDB text for the mix of a table."""

    def apportion(name: str, parties: str, group: str) -> str:
        return f"""
{name}_range AS (
  SELECT *, seats - sum(low) OVER (PARTITION BY {group}) AS open FROM (
    SELECT *, CASE WHEN part > 0 THEN CAST(ceil(seats * part + (parties + 2) * part + 1) AS BIGINT) ELSE low END AS high FROM (
      SELECT *, CAST(greatest(0, floor(seats * part - (parties + 2) * part - 1)) AS BIGINT) AS low FROM (
        SELECT *, count(*) OVER (PARTITION BY {group}) AS parties,
          CASE WHEN weight_sum > 0 THEN CAST(party_weight AS DOUBLE) / weight_sum ELSE 0 END AS part FROM {parties})))),
{name} AS (
  SELECT r.*, low + coalesce(extra, 0) AS quota FROM {name}_range r LEFT JOIN (
    SELECT {group}, number, sum(CASE WHEN spot <= open THEN 1 ELSE 0 END) AS extra FROM (
      SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY CAST(party_weight AS DOUBLE) / (2 * k + 1) DESC, number, k) AS spot FROM (
        SELECT *, unnest(range(low, high)) AS k FROM {name}_range WHERE high > low))
    GROUP BY {group}, number) e USING ({group}, number))"""

    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    return f"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM {documents}),
by_source AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, source_size * {CAP} AS cap,
    {weights}[CAST((number - 1) % {len(WEIGHTS)} AS BIGINT) + 1] AS weight FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
    FROM sizes GROUP BY source)),
capping AS (
  SELECT *, cap * rest <= remaining * weight AS capped FROM (
    SELECT *, CAST(total - coalesce(sum(cap) OVER w, 0) AS HUGEINT) AS remaining,
      sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS rest FROM by_source
    WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
targets AS (
  SELECT *, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
    CAST(total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS DOUBLE) * weight
      / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS party_weight FROM capping),
seated AS (
  SELECT *, total // block AS seats, CAST(total AS DOUBLE) AS weight_sum, 0 AS everything FROM (
    SELECT *, greatest(1, least({BLOCK_WORDS}, total // {BLOCKS})) AS block FROM targets)),
{apportion("sources", "seated", "everything").strip()},
placed AS (
  SELECT s.doc_id, s.size, number AS place, party_weight AS target, source_size, block, quota, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{SEED}') AS spot,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{SEED}'), 1, 8) AS BIGINT)
      % least({SHARDS}, greatest(1, CAST(ceil(source_size / {SHARD_WORDS}.0) AS BIGINT))) AS shard
  FROM sizes s JOIN sources t ON s.source IS NOT DISTINCT FROM t.source),
parts AS (
  SELECT place, shard AS number, CAST(sum(size) AS BIGINT) AS party_weight, any_value(source_size) AS weight_sum, any_value(quota) AS seats
  FROM placed GROUP BY ALL),
{apportion("shards", "parts", "place").strip()},
laid AS (
  SELECT p.*, h.party_weight AS shard_size, h.quota AS shard_quota,
    CAST(sum(size) OVER (PARTITION BY p.place, shard ORDER BY spot, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
  FROM placed p JOIN shards h ON p.place = h.place AND p.shard = h.number),
rounded AS (
  SELECT *, CASE WHEN shard_size > 0 THEN CAST(shard_quota * block AS BIGINT) // shard_size ELSE 0 END AS rounds FROM laid)
SELECT doc_id, size, source_size, target,
  CAST(least({CAP} * size, rounds * size + greatest(0, least(size, shard_quota * block - rounds * shard_size - before))) AS BIGINT) AS taken
FROM rounded"""


@registered("op1_mix_sources", oracle())
def mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))
