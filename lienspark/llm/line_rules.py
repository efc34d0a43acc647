"""Quality rules: measures of a text, and lines that many documents of a host share.

Base rules count a document's words, symbols, repeated lines and repeated 3-word
windows. The method hashes normalised lines (lower case, one blank between words),
counts the distinct documents of a host that hold each, and takes a line for
boilerplate when more documents than the limit have it. The limit is a number, not a
share, so a line is judged alike in hosts of any size. A document is depleted, and
rejected, when boilerplate lines hold more than half of its words or leave fewer words
than the base rules ask for. The host is ``source``. What is left of each text without
those lines, in their order, is a column of ``cleaned``.

A line counts once a document. A third of all lines may be of one host or be one
line: a line's documents are made distinct over all tasks and summed before the
counts are shuffled, and the lines above the limit are joined back in a plain join
that adaptive execution cuts. Texts are written for ``cleaned`` alone. 3-word windows
are compared by 64-bit hashes within a document.

Nulls and corner cases: a null text has no words and fails the base rules, as does
an empty one, and stays null; a null source is a host; rows that repeat an id, the null
one too, count as one document and each get a result; only ``doc_id``, ``source`` and
``text`` are read. All work is done by DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.llm.io import written
from lienspark.llm.registry import read, registered

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
# A line is boilerplate above so many documents of a host.
LINE_DOCUMENTS = 5
MAX_BOILERPLATE_PERCENT = 50
HAS_WORD = f"line RLIKE r'{WORD}'"
NORMALISED = f"trim(regexp_replace(lower(line), r'{SPACES}', ' '))"


def measures(docs: DataFrame, *carried: str) -> DataFrame:
    """Base measures of each row, ``lines``: hash and words of each line, and the columns ``carried``."""
    split = (
        docs.select("doc_id", "source", F.struct(*carried).alias("given"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("words", F.regexp_extract_all("text", F.lit(WORD), 0))
        .withColumn("with_word", F.expr(f"filter(split(text, '\\n'), line -> {HAS_WORD})"))
    )
    windows = split.withColumn(
        "windows",
        F.expr(
            "IF(size(words) < 3, array(), transform(sequence(0, size(words) - 3),"
            " i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS i)))"
        ),
    ).withColumn("ordered", F.sort_array("windows"))
    repeated = windows.withColumn(
        "at",
        F.expr(
            "sort_array(transform(filter(ordered, (x, j) -> (j > 0 AND ordered[j - 1].h = x.h)"
            " OR (j < size(ordered) - 1 AND ordered[j + 1].h = x.h)), x -> x.i))"
        ),
    )
    covered = F.expr(
        "aggregate(zip_with(at, slice(at, 2, greatest(size(at) - 1, 0)), (a, b) -> IF(b IS NULL, 3, least(3, b - a))),"
        " 0L, (sum, n) -> sum + n)"
    )
    without_space = F.length(F.translate("text", " \t\n\x0b\x0c\r", ""))
    without_symbol = F.length(F.translate("text", SYMBOLS, ""))
    lines = F.expr(
        f"transform(transform(with_word, line -> {NORMALISED}),"
        " line -> struct(xxhash64(line) AS hash, length(line) - length(replace(line, ' ', '')) + 1 AS n))"
    )
    return repeated.select(
        "row",
        "doc_id",
        "source",
        *(F.col(f"given.{name}") for name in carried),
        F.size("words").cast("long").alias("n_words"),
        without_space.cast("long").alias("word_chars"),
        (F.length("text") - without_symbol).cast("long").alias("n_symbols"),
        (F.size("with_word") - F.size(F.array_distinct("with_word"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        lines.alias("lines"),
    )


def boilerplate(measured: DataFrame, documents: int = LINE_DOCUMENTS) -> DataFrame:
    """``host`` and ``hash`` of the lines that more documents than the limit have."""
    held = measured.select("source", F.struct("doc_id").alias("document"), F.explode(F.array_distinct(F.col("lines.hash"))).alias("hash"))
    return (
        held.groupBy("source", "hash")
        .agg(F.count_distinct("document").alias("n"))
        .where(F.col("n") > documents)
        .select(F.col("source").alias("host"), "hash")
    )


def _verdicts(measured: DataFrame, documents: int) -> DataFrame:
    """The written measures with ``gone`` (hashes of the row's boilerplate lines),
    ``n_boilerplate`` (words of theirs), ``base_failed`` and ``kept``."""
    common = written(boilerplate(measured, documents), "boilerplate")
    lines = measured.select("row", "source", F.explode(F.array_distinct(F.col("lines.hash"))).alias("hash"))
    removed = (
        lines.join(common.withColumnRenamed("hash", "common"), F.col("source").eqNullSafe(F.col("host")) & (F.col("hash") == F.col("common")))
        .groupBy(F.col("row").alias("of_row"))
        .agg(F.collect_list("hash").alias("gone"))
    )
    n_boilerplate = F.expr("aggregate(filter(lines, x -> array_contains(gone, x.hash)), 0L, (sum, x) -> sum + x.n)")
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words")
    depleted = F.expr(f"100 * n_boilerplate > {MAX_BOILERPLATE_PERCENT} * n_words OR n_words - n_boilerplate < {MIN_WORDS}")
    return (
        measured.join(removed, F.col("row") == F.col("of_row"), "left")
        .withColumn("n_boilerplate", F.coalesce(n_boilerplate, F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .drop("row", "of_row", "lines")
    )


def cleaned(docs: DataFrame, documents: int = LINE_DOCUMENTS) -> DataFrame:
    """``judged``, with ``text`` as it is left without its boilerplate lines."""
    left = F.expr(f"array_join(filter(split(text, '\\n'), line -> NOT ({HAS_WORD} AND array_contains(gone, xxhash64({NORMALISED})))), '\\n')")
    found = _verdicts(written(measures(docs, "text"), "measures"), documents)
    return found.withColumn("text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left)).drop("gone")


def judged(docs: DataFrame, documents: int = LINE_DOCUMENTS) -> DataFrame:
    """The measures of each row, ``n_boilerplate`` (words), ``base_failed`` and ``kept``."""
    return _verdicts(written(measures(docs), "measures"), documents).drop("gone")


ORACLE = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, regexp_extract_all(text, '{WORD}') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS with_word FROM t),
spread AS (
  SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM split),
three AS (
  SELECT r, i, word, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM spread WINDOW w AS (PARTITION BY r ORDER BY i)),
twice AS (
  SELECT *, count(*) OVER (PARTITION BY r, word, b, c) AS times FROM three WHERE c IS NOT NULL),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(3) o(k) WHERE times > 1 GROUP BY r),
lines AS (
  SELECT r, doc_id, source, trim(regexp_replace(lower(line), '{SPACES}', ' ', 'g')) AS line
  FROM (SELECT r, doc_id, source, unnest(with_word) AS line FROM split)),
common AS (
  SELECT source, line FROM lines GROUP BY source, line
  HAVING count(DISTINCT struct_pack(d := doc_id)) > {LINE_DOCUMENTS}),
removed AS (
  SELECT r, sum(len(regexp_extract_all(l.line, '{WORD}'))) AS n FROM lines l JOIN common c
    ON l.line = c.line AND l.source IS NOT DISTINCT FROM c.source GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(with_word) - len(list_distinct(with_word)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n, 0) AS BIGINT) AS n_boilerplate
  FROM split LEFT JOIN repeats USING (r) LEFT JOIN removed USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
    AND 100 * n_boilerplate <= {MAX_BOILERPLATE_PERCENT} * n_words AND n_words - n_boilerplate >= {MIN_WORDS} AS kept, n_boilerplate
FROM measured"""


@registered("op6_quality_rules", ORACLE)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict, and the words in boilerplate lines they rest on."""
    found = judged(read(spark, sf_dir, "documents"))
    return found.select(*(name for name in found.columns if name not in ("source", "n_boilerplate")), "n_boilerplate")
