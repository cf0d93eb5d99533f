"""Exact duplicates by distributed MSD radix partitioning."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import dropped, written

WHITE = r"[\x20\x09-\x0D]+"
FIRST_DIGIT = 64
GROWTH = 16
NO_ID = (1 << 63) - 1


def normalised(text: Column) -> Column:
    """Bytes of the text (null: empty) with each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ").cast("binary")


def _round(rows: DataFrame, by: list[str], ended: Column) -> DataFrame:
    """Split groups by their next digit: how many rows share it, the one that stays, and whether the group is settled."""
    heads = rows.groupBy(*[F.col(c).alias(f"head_{c}") for c in by]).agg(
        F.count("*").alias("n"), F.min("row").alias("next_group"), F.min("doc_id").alias("keep_id"),
        F.min_by("row", F.coalesce("doc_id", F.lit(NO_ID))).alias("keep_row"))
    same = reduce(and_, [F.col(c) == F.col(f"head_{c}") for c in by])
    joined = rows.join(heads, same).drop(*[f"head_{c}" for c in by])
    return joined.withColumn("settled", (F.col("n") == 1) | ended)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are read as strings of bytes with their length in front, and groups are split by successive bytes, most significant
    first: the length and 64 bytes, then 1,024 bytes, then 16 times as many each round.  A group is settled when
    it is a single row or its bytes have ended; only the unsettled rows, with the bytes not yet looked at, go on to the next
    round.  Bytes themselves are compared, never digests; ``text_sha256`` is output only.  A digit's rows are counted before
    the shuffle and joined back by an inner equi-join, which the skew join splits, so a digit may hold any share of all rows.

    Null text counts as empty, and empty texts are equal.  The smallest id of a group stays; a null id is larger than all
    others.  Where an id is repeated, one of its rows is kept.  ``docs`` must give the same rows in the same
    partitions when it is read again, as files do.  Columns other than the two named are not read.
    """
    first = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("body"),
                        F.monotonically_increasing_id().alias("row"))
    first = first.withColumn("size", F.octet_length("body").cast("long"))
    first = first.withColumn("digit", F.substring("body", 1, FIRST_DIGIT))
    depth = FIRST_DIGIT
    done = None
    state = _round(first, ["size", "digit"], F.col("size") <= depth)
    state = state.withColumn("text_sha256", F.sha2("body", 256))
    while True:
        rest = F.when(~F.col("settled"), F.expr(f"substring(body, {depth if done is None else width} + 1)"))
        table = written(state.select("doc_id", "row", "size", "n", F.col("next_group").alias("group"), "keep_id", "keep_row",
                                     "settled", "text_sha256", rest.alias("body")), "radix")
        settled = table.where("settled").drop("body", "settled", "size", "group")
        done = settled if done is None else done.union(settled)
        longest = table.where("not settled").agg(F.max("size")).first()[0]
        if longest is None:
            break
        width = depth * (GROWTH - 1)
        depth += width
        rows = (table.where("not settled").select("doc_id", "row", "size", "group", "text_sha256", "body")
                .withColumn("digit", F.substring("body", 1, width)))
        state = _round(rows, ["group", "digit"], F.col("size") <= depth)
    return done.select("doc_id", "keep_id", F.col("n").alias("group_size"),
                       F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), "text_sha256", "row")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with all their columns (see ``exact_groups``)."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col("row").alias("_kept_row"))
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    return rows.join(kept, rows["_row"] == kept["_kept_row"], "left_semi").drop("_row")


EXACT_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)
"""


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row")
