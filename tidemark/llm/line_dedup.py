"""Repeated lines: range-partitioned hashes in order of document and position, first occurrences streamed, results as bitmaps."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import dropped, written

LEAST = 10
BLANK = " \t\n\x0b\x0c\r"
WORD = 64
# A key with more than a 1 / (HOT * partitions) share of all lines is hot, so there are at most HOT * partitions of them.
HOT = 4


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(BLANK))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, ascii_uppercase, ascii_lowercase))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def _hot_keys(lines: DataFrame) -> DataFrame:
    """The hot keys with the smallest id that holds each: at most HOT * partitions rows.

    Lines are counted by a short digest of their key first (a bounded table), and only the lines of overfull digests by the key
    itself, combined before the shuffle.
    """
    spark = lines.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    digest = F.pmod("h1", F.lit(4 * HOT * parts))
    counts = written(lines.groupBy(digest.alias("digest")).agg(F.count("*").alias("n")), "line-digests")
    most = (counts.agg(F.sum("n")).first()[0] or 0) // (HOT * parts)
    full = F.broadcast(counts.where(F.col("n") > most).select("digest"))  # at most HOT * partitions rows
    keys = (lines.withColumn("digest", digest).join(full, "digest", "left_semi").groupBy("h1", "h2")
            .agg(F.count("*").alias("n"), F.min("doc_id").alias("hot_first")))
    hot = written(keys.where(F.col("n") > most).select("h1", "h2", "hot_first", F.lit(True).alias("hot")), "line-hot")
    dropped(counts)
    return hot


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Rows (row, pos): the lines whose key of at least ``least`` code points also stands in a document of smaller id.

    Keys travel as 128 bits of hash.  They are dealt out by ranges of the hash and sorted by hash, document and position, so one
    pass over the sorted rows sees each key's first document first; the window reuses that order and adds no shuffle.  A key that
    holds a great share of all lines is not sent there: its smallest document comes from a partial aggregate.
    """
    exploded = _rows(docs, id_col, text_col).select("row", "doc_id", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keyed = exploded.select("row", "doc_id", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least)
    lines = written(keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "row", "pos"),
                    "lines")
    hot = F.broadcast(_hot_keys(lines))
    marked = lines.join(hot, ["h1", "h2"], "left")
    often = marked.where("hot").where(~F.col("doc_id").eqNullSafe(F.col("hot_first")))
    order = [F.col("doc_id").asc_nulls_last(), F.col("row").asc(), F.col("pos").asc()]
    dealt = (marked.where(F.col("hot").isNull()).select("h1", "h2", "doc_id", "row", "pos")
             .repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", *order))
    so_far = Window.partitionBy("h1", "h2").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streamed = dealt.withColumn("first_id", F.first("doc_id").over(so_far))
    later = streamed.where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    return often.select("row", "pos").unionByName(later.select("row", "pos"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Per row of ``docs`` that loses lines: row, n_dropped, and keep, the compressed bitmap of its lines.

    ``keep`` holds (word, bits) in order: bit ``i`` of ``bits`` is set if line ``64 * word + i`` stays.  Words whose lines
    all stay are left out, and so are rows of which all lines stay.  ``row`` numbers the rows of ``docs`` as
    ``monotonically_increasing_id`` does.
    """
    gone = repeated_lines(docs, id_col, text_col, least).select(
        "row", F.floor(F.col("pos") / WORD).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, pos % {WORD})").alias("bit"))
    words = gone.groupBy("row", "word").agg(F.bit_or("bit").alias("bits"), F.count("*").alias("n"))
    return words.groupBy("row").agg(
        F.sum("n").alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Per row of ``docs``: row, doc_id, n_lines, n_dropped, keep (null: all lines stay) and the text that stays.

    A line is what stands between ``\\n``; null and empty texts have one empty line.  Lines whose key (white space at both ends
    stripped, A-Z lower-cased) has at least ``least`` code points stay in the document of smallest id that holds the key, all of
    them there, and go in all others.  A null id is larger than all others.  Rows that share an id count as one document and lose
    nothing to each other.  Other columns of ``docs`` are not read.  ``docs`` must give the same rows in
    the same partitions when it is read again, as files do.  Keys are equal up to a collision of 128 bits.
    """
    bitmaps = keep_bitmaps(docs, id_col, text_col, least)
    # All words up to the last that lost a line; computed here so that the lookup below is an index into a column.
    gap = F.expr("transform(keep, (e, i) -> concat(array_repeat(-1L, e.word - if(i = 0, -1, keep[i - 1].word) - 1), array(e.bits)))")
    bitmaps = bitmaps.withColumn("dense", F.flatten(gap))
    rows = _rows(docs, id_col, text_col).withColumn("n_lines", F.size(_lines(F.col("text"))).cast("long"))
    stays = F.filter(_lines(F.col("text")), lambda line, i: F.coalesce(
        F.get("dense", F.floor(i / WORD).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i % WORD)) != 0,
        F.lit(True)))
    text = F.when(F.col("keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(stays, "\n"))
    return rows.join(bitmaps, "row", "left").select(
        "row", "doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep", text.alias("text"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with all its columns and the texts of ``kept_lines``; null texts stay null."""
    name = next(n for n in (f"row{'_' * i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    kept = kept_lines(docs, id_col, text_col, least).where(F.col("keep").isNotNull())
    kept = kept.select(F.col("row").alias(name), F.struct("text").alias(f"{name}_kept"))
    rows = docs.withColumn(name, F.monotonically_increasing_id()).join(kept, name, "left")
    return rows.select(*[F.coalesce(F.col(f"{name}_kept.text"), rows[c]).alias(c) if c == text_col else rows[c]
                         for c in docs.columns])


LINE_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, r, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{ascii_uppercase}',
                          '{ascii_lowercase}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= {LEAST} GROUP BY key),
m AS (SELECT k.*, coalesce(doc_id <> first_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    kept = kept_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
