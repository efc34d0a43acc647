"""Hard negatives by segment summary filtering.

Every component x becomes floor(256 x), and a score is the inner product of such
vectors. A vector is cut into segments, and of each the mean and the deviation are
stored, at several widths. Over a segment of w components the product of two
vectors is w * mean * mean, give or take at most w * deviation * deviation; summed
over the segments this bounds the score from both sides. Pairs whose bounds cannot
matter go, the others are bounded again by narrower segments, and what is left is
scored exactly.

An anchor's positives are the ``n_positives`` other rows of its label with the
highest scores. The negatives of a positive are the ``n_negatives`` rows of other
labels with the highest scores from ``low`` percent of the positive's score up to
that score. A pair can matter if its upper bound reaches the score to beat: that of
the last row kept so far, or the last of as many lower bounds. For negatives the
bounds must also meet the range of some positive.

Rows are dealt over parts of at most ``PART_BYTES`` of vectors by a hash of their
number, so neither a label nor copies of a vector make a part larger. The anchors
are sent to every part in blocks, and a task holds its part and one block. Each
part returns as many rows as are asked for, and the parts' rows are ranked again.
Anchors and rows pass through once for the positives and once for the negatives.

Nulls and corner cases: rows with a null label, a null vector, or any null or
non-finite component take no part; a row without an id can be found but is no
anchor, and comes last among equal scores; a shorter vector counts as filled up
with zeros; a row is not its own positive, but another row of the same id and
vector is; every row of a repeated anchor id is an anchor; equal scores go by
smaller id; a component or score beyond 64 bits counts as the nearest 64-bit
number; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lienspark.llm.io import written
from lienspark.llm.registry import read, registered

SCALE = 256
WIDTHS = (16, 4, 2)
POSITIVES = NEGATIVES = 5
LOW_PERCENT = 80
PART_BYTES = 1 << 25
LEAST_PART_ROWS = 512
BLOCK_ANCHORS = 128
BLOCK_ROWS = 4096
EXACT = 2.0**53
ENDS = 2.0**63


class Vectors:
    """Whole-number vectors in rows, with means and deviations of their segments."""

    def __init__(self, values: np.ndarray):
        n, dims = values.shape
        self.values = values
        self.largest = float(np.abs(values).max()) if values.size else 0.0
        self.levels = []
        for width in WIDTHS:
            filled = np.zeros((n, -(-dims // width) * width))
            filled[:, :dims] = values
            parts = filled.reshape(n, -1, width)
            means = parts.mean(axis=2)
            self.levels.append((width, means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))))

    def cut(self, start: int, stop: int) -> Vectors:
        out = object.__new__(Vectors)
        out.values, out.largest = self.values[start:stop], self.largest
        out.levels = [(w, m[start:stop], d[start:stop]) for w, m, d in self.levels]
        return out


def _of_pairs(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Inner products of all rows of ``a`` with all of ``b``, or of the named pairs."""
    return a @ b.T if pairs is None else np.einsum("ij,ij->i", a[pairs[0]], b[pairs[1]])


def bounds(a: Vectors, b: Vectors, level: int, pairs=None) -> tuple[np.ndarray, np.ndarray]:
    """Below and above the scores; a little wider, for the rounding of the sums."""
    width, a_means, a_spread = a.levels[level]
    _, b_means, b_spread = b.levels[level]
    middle = width * _of_pairs(a_means, b_means, pairs)
    reach = _of_pairs(a_spread, b_spread, pairs)
    slack = 0.5 + 1e-9 * a.largest * b.largest * (a.values.shape[1] + 1)
    return np.clip(middle - reach - slack, -ENDS, ENDS), np.clip(middle + reach + slack, -ENDS, ENDS)


def scores(a: Vectors, b: Vectors, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact scores of pairs, up to 64 bits; by Python's numbers where floats would not hold them."""
    if a.largest * b.largest * max(1, a.values.shape[1]) < EXACT:
        return _of_pairs(a.values, b.values, pairs)
    wide = [np.array([[int(x) for x in row] for row in side.values[at]], object) for side, at in zip((a, b), pairs, strict=True)]
    return np.array([max(-(2**63), min(2**63 - 1, x)) for x in (wide[0] * wide[1]).sum(axis=1)], object) if len(pairs[0]) else np.empty(0)


def last_of(values: np.ndarray, fits: np.ndarray, n: int) -> np.ndarray:
    """Per row the n-th largest of the values that fit, minus infinity where there are fewer."""
    if values.shape[1] < n:
        return np.full(len(values), -np.inf)
    return np.partition(np.where(fits, values, -np.inf), -n, axis=1)[:, -n]


class Best:
    """The first ``n`` of one anchor's rows seen so far: highest score, then smallest place."""

    def __init__(self, n: int):
        self.n, self.found = n, []

    def add(self, scored: np.ndarray, places: np.ndarray) -> None:
        order = np.lexsort((places, -scored))[: self.n]
        self.found = sorted([*self.found, *((-scored[i], int(places[i])) for i in order)])[: self.n]

    @property
    def to_beat(self) -> float:
        return float(-self.found[-1][0]) if len(self.found) == self.n else -np.inf


def search(anchors: Vectors, rows: Vectors, fits: np.ndarray, ranges: list[list[tuple[float, float]]], n: int) -> list[list[Best]]:
    """Per anchor and range of scores, the first ``n`` rows that fit it.

    ``fits`` tells which rows an anchor may take; a range is closed. Rows come in
    order of ids, so the place of a row decides between equal scores.
    """
    best = [[Best(n) for _ in own] for own in ranges]
    most = max(map(len, ranges), default=0)
    low, high = np.full((most, len(ranges)), np.inf), np.full((most, len(ranges)), -np.inf)
    for a, own in enumerate(ranges):
        for k, (least, greatest) in enumerate(own):
            low[k, a], high[k, a] = least, greatest
    for start in range(0, len(rows.values), BLOCK_ROWS):
        block = rows.cut(start, start + BLOCK_ROWS)
        beat = np.full(low.shape, -np.inf)
        for a, own in enumerate(best):
            for k, found in enumerate(own):
                beat[k, a] = found.to_beat
        alive = fits[:, start : start + BLOCK_ROWS]
        for level in range(len(WIDTHS)):
            under, over = np.full(alive.shape, np.inf), np.full(alive.shape, -np.inf)
            if alive.sum() * 4 > alive.size:
                under, over = bounds(anchors, block, level)
            else:
                pairs = np.nonzero(alive)
                under[pairs], over[pairs] = bounds(anchors, block, level, pairs)
            left = np.zeros(alive.shape, bool)
            for k in range(most):
                sure = alive & (under >= low[k][:, None]) & (over <= high[k][:, None])
                beat[k] = np.maximum(beat[k], last_of(under, sure, n))
                left |= (over >= np.maximum(low[k], beat[k])[:, None]) & (under <= high[k][:, None])
            alive = alive & left
            if not alive.any():
                break
        pairs = np.nonzero(alive)
        exact = scores(anchors, block, pairs)
        edges = np.searchsorted(pairs[0], np.arange(len(ranges) + 1))
        for a in np.unique(pairs[0]):
            own, places = exact[edges[a] : edges[a + 1]], pairs[1][edges[a] : edges[a + 1]] + start
            for k, found in enumerate(best[a]):
                inside = (own >= ranges[a][k][0]) & (own <= ranges[a][k][1])
                if inside.any():
                    found.add(own[inside], places[inside])
    return best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The floored vectors, filled up to ``dims`` components."""
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(column), dims))
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return np.clip(out, -ENDS, ENDS)


_RESULT = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("wanted", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])


def _searched(dims: int, n: int, low_percent: int | None):
    """A part's rows, then blocks of anchors: the part's first rows for each."""

    def ranges_of(positives: list[list[int]]) -> list[list[tuple[float, float]]]:
        if low_percent is None:
            return [[(-np.inf, np.inf)] for _ in positives]
        return [[(-(-low_percent * score // 100), score) for score in own] for own in positives]

    def answers(anchors: pa.Table, rows: pa.Table, held: Vectors) -> Iterator[pa.RecordBatch]:
        labels = rows.column("label").to_numpy(), anchors.column("label").to_numpy()
        same = labels[1][:, None] == labels[0][None, :]
        fits = ~same
        if low_percent is None:
            fits = same & (anchors.column("row").to_numpy()[:, None] != rows.column("row").to_numpy()[None, :])
        ranges = ranges_of(anchors.column("wanted").to_pylist())
        vectors = Vectors(_matrix(anchors.column("vector").combine_chunks(), dims))
        ids, numbers = rows.column("vec_id").to_pylist(), rows.column("row").to_pylist()
        out = []
        for place, own in enumerate(search(vectors, held, fits, ranges, n)):
            anchor = {"anchor": anchors.column("row")[place].as_py(), "anchor_id": anchors.column("vec_id")[place].as_py()}
            for wanted, best in enumerate(own):
                out += [anchor | {"wanted": wanted, "vec_id": ids[at], "row": numbers[at], "score": int(-negated)} for negated, at in best.found]
        yield pa.RecordBatch.from_pylist(out, _RESULT)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, rows, held = None, [], None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            parts = table.column("part").to_numpy()
            is_anchor = table.column("is_anchor").to_numpy()
            keys = parts * 2 + is_anchor
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                if part != parts[start]:
                    part, waiting, rows, held = parts[start], [], None, None
                piece = table.slice(start, stop - start)
                if not is_anchor[start]:
                    waiting.append(piece)
                    continue
                if rows is None:
                    if not waiting:
                        continue
                    rows = pa.concat_tables(waiting)
                    nulls, ids = rows.column("vec_id").is_null().to_numpy(), rows.column("vec_id").fill_null(0).to_numpy()
                    rows = rows.take(np.lexsort((rows.column("row").to_numpy(), ids, nulls)))
                    held, waiting = Vectors(_matrix(rows.column("vector").combine_chunks(), dims)), []
                for at in range(0, piece.num_rows, BLOCK_ANCHORS):
                    yield from answers(piece.slice(at, BLOCK_ANCHORS), rows, held)

    return searched


def _first(found: DataFrame, n: int) -> DataFrame:
    """The parts' rows ranked together; ``rank`` counts from 1."""
    order = Window.partitionBy("anchor", "wanted").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def usable(rows: DataFrame) -> DataFrame:
    """Numbered rows that take part: ``row vec_id label vector``."""
    vector = F.col("embedding")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(F.col("label").isNotNull() & vector.isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"), vector.alias("vector")
    )


def hard_negatives(
    rows: DataFrame, is_anchor: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT
) -> DataFrame:
    """``anchor_id positive_id rank negative_id positive_score negative_score``.

    ``rows`` has ``vec_id label embedding``; ``is_anchor`` is a condition on ``vec_id``.
    """
    spark = rows.sparkSession
    table = written(usable(rows), "vectors")
    n_rows, dims = table.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    dims = max(dims, 1)
    fitting = max(1, PART_BYTES // (8 * dims))
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // LEAST_PART_ROWS))
    parts = max(1, -(-n_rows // fitting), spread)

    def passed(anchors: DataFrame, n: int, low: int | None) -> DataFrame:
        columns = ["part", "is_anchor", "row", "vec_id", "label", "vector", "wanted"]
        nothing = F.lit(None).cast("array<long>")
        dealt = table.withColumns({"part": F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"), "is_anchor": F.lit(0), "wanted": nothing})
        sent = anchors.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "is_anchor": F.lit(1)})
        together = dealt.select(*columns).union(sent.select(*columns)).repartitionById(parts, F.col("part"))
        ordered = together.sortWithinPartitions("part", "is_anchor")
        schema = "anchor long, anchor_id long, wanted long, vec_id long, row long, score long"
        return _first(ordered.mapInArrow(_searched(dims, n, low), schema), n)

    anchors = table.where(is_anchor)
    positives = written(passed(anchors.withColumn("wanted", F.lit(None).cast("array<long>")), n_positives, None), "positives")
    ranked = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("positives"))
    asking = anchors.join(ranked, anchors.row == ranked.anchor).withColumn("wanted", F.col("positives.score"))
    found = passed(asking, n_negatives, low_percent)
    place = (F.col("wanted") + 1).alias("place")
    of = positives.select(F.col("anchor").alias("of"), F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    negatives = found.select("anchor", place, "anchor_id", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = negatives.join(of, (negatives.anchor == of.of) & (negatives.place == of.place))
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(rows: DataFrame) -> DataFrame:
    """Every seventh row with the next label, so that some are labelled wrongly."""
    return rows.withColumn("label", F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)"))


ORACLE = f"""
WITH parts AS (
  SELECT row_number() OVER () AS spot, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
components AS (SELECT spot, unnest(range(1, len(embedding) + 1)) AS place, unnest(embedding) AS x FROM parts),
whole AS (SELECT spot, place, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM components WHERE isfinite(x)),
sound AS (SELECT * FROM parts p WHERE len(embedding) = (SELECT count(*) FROM whole w WHERE w.spot = p.spot)),
anchors AS (SELECT * FROM sound WHERE vec_id % 100 = 0),
pairs AS (
  SELECT a.spot AS a, r.spot AS r, CAST(sum(a.x * r.x) AS BIGINT) AS score
  FROM whole a JOIN whole r ON a.place = r.place WHERE a.spot IN (SELECT spot FROM anchors) GROUP BY 1, 2),
scored AS (
  SELECT a.spot AS a, r.spot AS r, a.vec_id AS anchor_id, r.vec_id AS other_id, score, a.label = r.label AS same
  FROM pairs p JOIN anchors a ON a.spot = p.a JOIN sound r ON r.spot = p.r WHERE a.spot <> r.spot),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id, r) AS place FROM scored WHERE same)
  WHERE place <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.other_id, n.r) AS rank
  FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same
  WHERE {LOW_PERCENT} * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= {NEGATIVES}"""


@registered("op12_hard_negatives", ORACLE)
def mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(read(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)
