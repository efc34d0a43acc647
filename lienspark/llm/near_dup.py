"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A document is its 5-word shingles weighted by how often they occur (all words as
one shingle where there are fewer). Two documents are linked when the probability
Jaccard similarity of those weights is 0.8 or more; a class is a connected
component of links. Words are the runs of bytes between [\\x20\\x09-\\x0D].

ProbMinHash: each shingle sends points of a Poisson process whose rate is its
weight; each point falls on a random register, and a register keeps the shingle of
its first point. A shingle stops once its next point comes later than what every
register holds. Two documents agree on a register with their probability Jaccard
similarity as the chance, so registers are grouped in bands.

Texts with equal words are collapsed first; their copies get the class of the
first id. In a band's bucket every document is tested against the bucket's first
one. What is left are buckets that still hold several classes: there each document
outside the bucket's largest class meets all others, in blocks of ``BLOCK_ROWS``
documents inside which similarities are computed as matrices, and only links
between classes come out, one for each document and class. So a large group of
copies never becomes pairs, and no link is lost beyond what banding itself can
miss (5e-5 at a similarity of 0.8, less above).

Nulls and corner cases: a null text is in a class of its own; texts without a
word are copies of each other; a null ``doc_id`` gets a null class; the texts of a
repeated ``doc_id`` are compared each by itself, and its rows take the smallest of
their classes, one result row each; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read, so
further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lienspark.llm.components import components
from lienspark.llm.io import written
from lienspark.llm.registry import read, registered
from lienspark.llm.text import STEP, Words, gram_hashes, inside, mix, runs, utf8

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
# Documents of a block, shingles of a matrix of it, and the largest count of a
# shingle in a document that goes into one.
BLOCK_ROWS, BLOCK_GRAMS, BLOCK_COUNT = 512, 4096, 6
# Rows of blocks in one task.
SHARD_ROWS = 1024
RUN_BYTES = 4 << 20
# Numbers of texts that no row's id can stand for; ids are below it.
ODD = 1 << 62
# Points drawn at once for each shingle when few shingles are left.
DRAW, FEW = 32, 4096


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct weighted shingles of a run: document, hash and count, in order."""
    hashes, bounds = words.hashes(), words.bounds
    grams = gram_hashes(hashes, SHINGLE)
    whole = inside(bounds, SHINGLE, len(grams))
    documents = words.documents()
    doc, gram = documents[: len(grams)][whole], grams[whole]
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < SHINGLE))
    if len(short):
        alone = np.array([gram_hashes(hashes[bounds[d] : bounds[d + 1]], int(bounds[d + 1] - bounds[d]))[0] for d in short], np.uint64)
        doc, gram = np.concatenate((doc, short)), np.concatenate((gram, alone))
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
    at = np.flatnonzero(first)
    return doc[at], gram[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, n_docs: int) -> np.ndarray:
    """Registers of each document; a document without shingles has zeros."""
    times = np.full(n_docs * REGISTERS, np.inf)
    holds = np.zeros(n_docs * REGISTERS, np.uint32)
    clock, drawn = np.zeros(len(doc)), 0
    weight = count.astype(np.float64)
    name = mix(gram)
    while len(doc):
        width = 1 if len(doc) > FEW else DRAW
        steps = (np.arange(drawn, drawn + width, dtype=np.uint64) + np.uint64(1)) * STEP
        bits = mix(gram[:, None] + steps[None, :])
        uniform = ((bits >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52
        points = clock[:, None] + np.cumsum(-np.log(uniform), axis=1) / weight[:, None]
        register = (mix(bits) >> np.uint64(33)) % np.uint64(REGISTERS)
        spot = (doc[:, None] * REGISTERS + register.astype(np.int64)).ravel()
        at = points.ravel()
        early = at < times[spot]
        spot, at = spot[early], at[early]
        who = np.repeat(name, width)[early] if width > 1 else name[early]
        np.minimum.at(times, spot, at)
        won = times[spot] == at
        holds[spot[won]] = (who[won] >> np.uint64(32)).astype(np.uint32)
        clock, drawn = points[:, -1], drawn + width
        last = times.reshape(n_docs, REGISTERS).max(axis=1)
        going = clock < last[doc]
        doc, gram, weight, name, clock = doc[going], gram[going], weight[going], name[going], clock[going]
    return holds.reshape(n_docs, REGISTERS)


def _sequence_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each document's word sequence, as two arrays of longs."""
    hashes, bounds = words.hashes(), words.bounds
    n = len(bounds) - 1
    first, second = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
        odd = mix(place + STEP) | np.uint64(1)
        first[full] = np.add.reduceat(mix(hashes) * odd, bounds[:-1][full])
        second[full] = np.add.reduceat(mix(hashes ^ odd), bounds[:-1][full])
    return first.view(np.int64), second.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(batch, limit=RUN_BYTES):
            words = Words(*utf8(run.column("text")))
            k1, k2 = _sequence_keys(words)
            registers = signatures(*shingles(words), run.num_rows)
            some = np.diff(words.bounds) > 0
            lists = pa.FixedSizeListArray.from_arrays(pa.array(registers.view(np.int32).ravel()), REGISTERS).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id"), pa.array(k1), pa.array(k2), pa.array(some), lists], ["doc_id", "k1", "k2", "worded", "registers"]
            )


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        registers = batch.column("registers").flatten().to_numpy(zero_copy_only=False).view(np.uint32).astype(np.uint64)
        registers = registers.reshape(batch.num_rows, BANDS, ROWS)
        total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * STEP, (batch.num_rows, BANDS)).copy()
        for k in range(ROWS):
            total = mix(total * STEP + registers[:, :, k])
        ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total.view(np.int64).ravel())], ["doc_id", "bucket"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of texts; of those with keys beside them, only where they are the text's."""
    for batch in batches:
        for run in runs(batch, limit=RUN_BYTES):
            words = Words(*utf8(run.column("text")))
            asked = run.column("k1").is_valid().to_numpy(zero_copy_only=False)
            if asked.any():
                keys = np.stack([run.column(k).fill_null(0).to_numpy() for k in ("k1", "k2")])
                run = run.filter(pa.array(~asked | (keys == np.stack(_sequence_keys(words))).all(axis=0)))
                words = Words(*utf8(run.column("text")))
            doc, gram, count = shingles(words)
            cuts = pa.array(np.searchsorted(doc, np.arange(run.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    run.column("doc_id"),
                    pa.ListArray.from_arrays(cuts, pa.array(gram.view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(count.astype(np.int32))),
                ],
                ["doc_id", "grams", "counts"],
            )


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over common i of 1 / sum_j max(a_j / a_i, b_j / b_i); grams in order."""
    if not len(a) or not len(b):
        return 0.0
    spot = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = b[spot] == a
    if not common.any():
        return 0.0
    ca, cb = wa[common].astype(np.float64), wb[spot[common]].astype(np.float64)
    only_a = wa.sum() - ca.sum()
    only_b = wb.sum() - cb.sum()
    ratio = cb / ca
    order = np.argsort(ratio, kind="stable")
    ratio, ca, cb = ratio[order], ca[order], cb[order]
    below = np.searchsorted(ratio, ratio, "right")
    low, high = np.concatenate(([0.0], np.cumsum(ca))), np.concatenate(([0.0], np.cumsum(cb)))
    total = only_a + low[below] + (only_b + high[-1] - high[below]) / ratio
    return float((ca / total).sum())


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def lists(column):
        values = column.values.to_numpy(zero_copy_only=False)
        return values, column.offsets.to_numpy()

    for batch in batches:
        (ga, oa), (wa, _), (gb, ob), (wb, _) = (lists(batch.column(c)) for c in ("ga", "wa", "gb", "wb"))
        ga, gb = ga.view(np.uint64), gb.view(np.uint64)
        linked = [
            probability_jaccard(ga[oa[i] : oa[i + 1]], wa[oa[i] : oa[i + 1]], gb[ob[i] : ob[i + 1]], wb[ob[i] : ob[i + 1]]) >= SIMILARITY - 1e-9
            for i in range(batch.num_rows)
        ]
        kept = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])


def _common(rows: np.ndarray, grams: np.ndarray, small: np.ndarray, n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many grams each small row shares with each row, of the entries marked
    ``left`` in the one and ``right`` in the other."""
    total = np.zeros((len(small), n), np.float32)
    place = np.full(n, -1)
    place[small] = np.arange(len(small))
    left = left & (place[rows] >= 0)
    names = np.intersect1d(grams[left], grams[right])
    for low in range(0, len(names), BLOCK_GRAMS):
        some = names[low : low + BLOCK_GRAMS]
        sides = []
        for marked, height in ((left, len(small)), (right, n)):
            column = np.minimum(np.searchsorted(some, grams[marked]), len(some) - 1)
            held = some[column] == grams[marked]
            ones = np.zeros((height, len(some)), np.float32)
            row = rows[marked][held]
            ones[place[row] if marked is left else row, column[held]] = 1
            sides.append(ones)
        total += sides[0] @ sides[1].T
    return total


def block_similarities(small: np.ndarray, rows: np.ndarray, grams: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Probability Jaccard of the small rows with all ``n`` rows of a block.

    Common shingles fall into few kinds by their two counts c and d. With N of them
    of a kind, sum_j max(x_j / c, y_j / d) is the same for all of a kind, and the
    similarity is the sum of N over it. Shingles that no row has twice are all of
    the kind (1, 1), so only the others need a matrix for each kind.
    """
    order = np.argsort(grams, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = grams[order][1:] != grams[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    shared = (np.bincount(group) > 1)[group]
    weight = np.bincount(rows, counts, n)
    rows, group, counts = rows[shared], group[shared], counts[shared]
    every = np.ones(len(rows), bool)
    kinds = {(1, 1): _common(rows, group, small, n, every, every).astype(np.float64)}
    if len(group):
        often = np.zeros(group.max() + 1, bool)
        often[group[counts > 1]] = True
        rows, group, counts = (x[often[group]] for x in (rows, group, counts))
        values = np.unique(counts).tolist()
        marks = {c: counts == c for c in values}
        for c in values:
            for d in values:
                if (c, d) != (1, 1):
                    kinds[c, d] = _common(rows, group, small, n, marks[c], marks[d]).astype(np.float64)
                    kinds[1, 1] -= kinds[c, d]
    similarity = np.zeros((len(small), n))
    own, others = weight[small][:, None], weight[None, :]
    for (c, d), number in kinds.items():
        if number.any():
            least = sum(m * min(e / c, f / d) for (e, f), m in kinds.items())
            similarity += number / np.maximum(own / c + others / d - least, 1e-9)
    return similarity


def _at_most(small: np.ndarray, rows: np.ndarray, grams: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """What the similarity of the small rows with all rows is at most.

    With P and Q the shares of the common shingles in the two rows, it is at most
    1 / (1 / P + 1 / Q - 1): the part of a shingle with the shares p and q is at most
    1 / (1 / p + (1 - Q) / q), which is concave and homogeneous, so the sum over the
    common shingles is at most its value at their sums. It is also at most the sum of
    the geometric means of the shares.
    """
    shares = counts / np.bincount(rows, counts, n)[rows]
    names, column = np.unique(grams, return_inverse=True)
    shared = np.bincount(column) > 1
    place = np.cumsum(shared) - 1
    column = np.where(shared[column], place[column], -1)
    own, others, roots = (np.zeros((len(small), n), np.float32) for _ in range(3))
    for low in range(0, int(shared.sum()), BLOCK_GRAMS):
        part = (column >= low) & (column < low + BLOCK_GRAMS)
        share = np.zeros((n, min(BLOCK_GRAMS, int(shared.sum()) - low)), np.float32)
        share[rows[part], column[part] - low] = shares[part]
        held = (share > 0).astype(np.float32)
        own += share[small] @ held.T
        others += held[small] @ share.T
        root = np.sqrt(share)
        roots += root[small] @ root.T
    with np.errstate(divide="ignore"):
        return np.minimum(1 / (1 / np.minimum(own, 1) + 1 / np.minimum(others, 1) - 1), roots)


def block_links(small: np.ndarray, labels: np.ndarray, rows: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Links of a block between different labels: a document of the smaller classes
    and any other, the first found for each such document and label.

    ``rows``, ``grams`` and ``counts`` are the block's shingles in order of row and
    gram; ``small`` are the rows of the documents outside the largest class. Rows
    with a count above ``BLOCK_COUNT`` are compared one by one, so that the kinds of
    the others stay few.
    """
    n = len(labels)
    few = np.bincount(rows, counts > BLOCK_COUNT, n) == 0
    apart = labels[small][:, None] != labels[None, :]
    plain = few[rows]
    similarity = block_similarities(small, rows[plain], grams[plain], counts[plain], n)
    sure = few[small][:, None] & few[None, :]
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for a, b in zip(*np.nonzero(apart & sure & (similarity >= SIMILARITY - 1e-9)), strict=True):
        found.setdefault((int(small[a]), int(labels[b])), (int(small[a]), int(b)))
    cuts = np.searchsorted(rows, np.arange(n + 1))
    unsure = apart & ~sure
    if unsure.any():
        unsure &= _at_most(small, rows, grams, counts, n) >= SIMILARITY - 1e-4
    for a, b in zip(*np.nonzero(unsure), strict=True):
        one = int(small[a])
        if (one, int(labels[b])) not in found:
            x, y = slice(cuts[one], cuts[one + 1]), slice(cuts[b], cuts[b + 1])
            if probability_jaccard(grams[x], counts[x], grams[y], counts[y]) >= SIMILARITY - 1e-9:
                found[one, int(labels[b])] = (one, int(b))
    return list(found.values())


def _across(key, table):
    """Links of the blocks of a shard."""
    ids, labels = table.column("doc_id").to_numpy(), table.column("label").to_numpy()
    small = table.column("small").to_numpy(zero_copy_only=False)
    grams, counts = table.column("grams").combine_chunks(), table.column("counts").combine_chunks()
    offsets, values = grams.offsets.to_numpy(), grams.values.to_numpy(zero_copy_only=False).view(np.uint64)
    times = counts.values.to_numpy(zero_copy_only=False)
    bucket, block = table.column("bucket").to_numpy(), table.column("block").to_numpy()
    order = np.lexsort((ids, block, bucket))
    turn = np.flatnonzero(np.concatenate(([True], (np.diff(bucket[order]) != 0) | (np.diff(block[order]) != 0), [True])))
    links = set()
    for low, high in zip(turn[:-1], turn[1:], strict=True):
        mine = order[low:high]
        lengths = offsets[mine + 1] - offsets[mine]
        flat = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(offsets[mine], lengths)
        rows = np.repeat(np.arange(len(mine)), lengths)
        at = np.flatnonzero(small[mine])
        if len(at) and len(mine) > 1:
            links |= {
                (int(min(ids[mine[a]], ids[mine[b]])), int(max(ids[mine[a]], ids[mine[b]])))
                for a, b in block_links(at, labels[mine], rows, values[flat], times[flat])
            }
    a, b = zip(*sorted(links), strict=True) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def weighted_shingles(texts: DataFrame, pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """The shingles of every text in a pair ``a``, ``b`` of texts' numbers.

    A text's number is the id of a row that has it, but for the ``shared`` ones,
    whose row's id has other texts too: there the text's keys tell which.
    """
    involved = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = involved.join(shared, "node", "left").select("node", F.coalesce("first", "node").alias("doc_id"), "k1", "k2")
    rows = texts.join(wanted, "doc_id").select(F.col("node").alias("doc_id"), "text", "k1", "k2")
    found = rows.mapInArrow(_shingled, "doc_id long, grams array<long>, counts array<int>")
    return written(found.dropDuplicates(["doc_id"]), "shingles")


def verified(grams: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` of ids whose texts are similar enough."""
    of_a = grams.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga"), F.col("counts").alias("wa"))
    of_b = grams.select(F.col("doc_id").alias("b"), F.col("grams").alias("gb"), F.col("counts").alias("wb"))
    return written(pairs.join(of_a, "a").join(of_b, "b").mapInArrow(_verified, "a long, b long"), "verified")


def _links_across(members: DataFrame, labels: DataFrame, grams: DataFrame) -> DataFrame | None:
    """Links between the classes that still share a bucket; None if none does."""
    labelled = written(
        members.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
            "bucket", "doc_id", F.coalesce("label", "doc_id").alias("label")
        ),
        "labelled",
    )
    parts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = (
        parts.groupBy(F.col("bucket").alias("of"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("labels"), F.max_by("label", F.struct("n", -F.col("label"))).alias("largest"))
        .where("labels > 1")
    )
    placed = (
        labelled.join(mixed, labelled.bucket == mixed.of)
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("small", F.col("label") != F.col("largest"))
        .withColumn("block", F.explode(F.expr("IF(small, sequence(0, blocks - 1), array(own))")))
        .select("bucket", "block", "doc_id", "label", "small")
    )
    placed = written(placed, "placed")
    shards = placed.count() // SHARD_ROWS + 1
    if placed.isEmpty():
        return None
    shard = F.pmod(F.xxhash64("bucket", "block"), F.lit(shards)).alias("shard")
    return written(placed.join(grams, "doc_id").groupBy(shard).applyInArrow(_across, "a long, b long"), "across")


def _classes(docs: DataFrame) -> DataFrame:
    """``doc_id k1 k2 class_id chosen`` of rows with an id and a text; ``k1 k2`` are the text's keys.

    A text goes by the smallest id among its rows. Where that id has several texts,
    only one of them does, and the others get numbers above ``ODD``. Of each class
    the text with the smallest number is ``chosen``, in the row it goes by.
    """
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    signed = written(
        texts.mapInArrow(_signed, "doc_id long, k1 long, k2 long, worded boolean, registers array<int>"), "signed"
    )
    key = F.struct("k1", "k2")
    several = signed.groupBy("doc_id").agg(F.min(key).alias("least"), F.max(key).alias("most")).where("least <> most")
    first = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.bool_or("worded").alias("worded"))
    told = first.join(several.select(F.col("doc_id").alias("of")), F.col("first") == F.col("of"), "left")
    odd = F.lit(ODD).bitwiseOR(F.xxhash64("k1", "k2").bitwiseAND(F.lit(ODD - 1)))
    of_several = written(told.where("of IS NOT NULL").drop("of"), "of_several")
    own = of_several.groupBy("first").agg(F.min(key).alias("own"))
    shared = of_several.join(own, "first").withColumn("node", F.when(key == F.col("own"), F.col("first")).otherwise(odd))
    shared = written(shared.select("k1", "k2", "first", "worded", "node"), "shared")
    first = written(told.where("of IS NULL").withColumn("node", F.col("first")).select(*shared.columns).union(shared), "first")

    leading = first.where("worded").select(F.col("first").alias("doc_id"), "k1", "k2", "node")
    single = signed.join(leading, ["doc_id", "k1", "k2"]).dropDuplicates(["doc_id", "k1", "k2"])
    single = written(single.select(F.col("node").alias("doc_id"), "registers"), "single")
    banded = single.mapInArrow(_banded, "doc_id long, bucket long")
    heads = banded.groupBy("bucket").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("other")).where("head < other")
    members = written(banded.join(heads.select("bucket", "head"), "bucket"), "members")

    stars = members.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct()
    grams = weighted_shingles(texts, stars, shared.select("node", "first", "k1", "k2"))
    links = verified(grams, stars)
    labels = components(links)
    more = _links_across(members, labels, grams)
    if more is not None:
        labels = components(links.union(more))

    named = first.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_odd = shared.select(F.col("node").alias("label"), F.col("first").alias("low"))
    named = named.join(of_odd, "label", "left").withColumn("class_id", F.coalesce("low", "label"))
    named = named.select("k1", "k2", "class_id", F.when(F.col("label") == F.col("node"), F.col("first")).alias("chosen_id"))
    rows = signed.select("doc_id", "k1", "k2").join(named, ["k1", "k2"])
    return rows.select("doc_id", "k1", "k2", "class_id", F.coalesce(F.col("chosen_id") == F.col("doc_id"), F.lit(False)).alias("chosen"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest id of the class) and ``kept`` (it is that one)."""
    found = _classes(docs).groupBy(F.col("doc_id").alias("id")).agg(F.min("class_id").alias("found"))
    ids = docs.select("doc_id")
    class_id = F.coalesce("found", "doc_id")
    return ids.join(found, ids.doc_id == found.id, "left").select(
        "doc_id", class_id.alias("class_id"), F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(batch, limit=RUN_BYTES):
            keys = map(pa.array, _sequence_keys(Words(*utf8(run.column("text")))))
            yield pa.RecordBatch.from_arrays([*run.columns, *keys], [str(i) for i in range(run.num_columns + 2)])


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one text of each class, in the row of its smallest id.

    Rows are told apart by id and text: of equal ones one stays, and a text goes only
    if an equal or similar one stays. Rows without an id or text have no copies and
    stay.
    """
    mark = "_" * (1 + max(map(len, docs.columns)))
    k1, k2, none = f"{mark}k1", f"{mark}k2", f"{mark}none"
    schema = StructType([*docs.schema.fields, StructField(k1, LongType()), StructField(k2, LongType())])
    chosen = _classes(docs).where("chosen").select(F.col("doc_id").alias(f"{mark}id"), F.col("k1").alias(f"{mark}a"), F.col("k2").alias(f"{mark}b")).distinct()
    keyed = docs.mapInArrow(_keyed, schema)
    alone = keyed.doc_id.isNull() | keyed.text.isNull()
    # A number of their own keeps rows apart that have no id or text.
    keyed = keyed.withColumns({none: alone, k1: F.when(alone, F.monotonically_increasing_id()).otherwise(F.col(k1))})
    same = (F.col("doc_id") == F.col(f"{mark}id")) & (F.col(k1) == F.col(f"{mark}a")) & (F.col(k2) == F.col(f"{mark}b"))
    left = keyed.join(chosen, same, "left").where(F.col(none) | F.col(f"{mark}id").isNotNull())
    return left.dropDuplicates(["doc_id", k1, k2, none]).select(*docs.columns)


@registered("op4_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
