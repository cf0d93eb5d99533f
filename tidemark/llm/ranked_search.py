"""Ranked lexical search, a term at a time: rarest terms first, and no new accumulators once they could not win any more."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import dropped, shared_folder, written

TOP = 10
# Terms of a round differ in frequency by less than this factor.
RARITY = 4.0
SEGMENT = 1 << 20
BATCH_TERMS = 1 << 18
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def terms_of(raw: bytes) -> Counter:
    """How often each term occurs in a UTF-8 text; long texts are cut between terms."""
    found, at = Counter(), 0
    while at < len(raw):
        stop = at + SEGMENT
        if stop < len(raw):
            gap = GAP.search(raw, stop)
            stop = gap.start() if gap else len(raw)
        found.update(TERM.findall(raw[at:stop].lower()))
        at = stop
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        begin, terms, counts, ends, sizes = 0, [], [], [0], []
        for i, text in enumerate(texts):
            found = terms_of(text.as_py() or b"")
            # The empty term stands for the text itself, so that texts without a wanted term are counted too.
            terms.append(b"")
            counts.append(0)
            terms += found.keys()
            counts += found.values()
            ends.append(len(terms))
            sizes.append(sum(found.values()))
            if len(terms) >= BATCH_TERMS or i + 1 == len(texts):
                tf = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.string()), pa.array(counts, pa.int64()))
                rows = batch.slice(begin, i + 1 - begin)
                yield pa.RecordBatch.from_arrays([rows.column("row"), rows.column("id"), pa.array(sizes, pa.int64()), tf],
                                                 ["row", "id", "n", "tf"])
                begin, terms, counts, ends, sizes = i + 1, [], [], [0], []


def term_counts(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row and term of its text: row, id, n (terms of the text with repeats), term, tf.  One more with the empty term."""
    kind = table.schema[id_col].dataType.simpleString()
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(_count, f"row long, id {kind}, n long, tf map<string, long>")
    return counted.select("row", "id", "n", F.explode("tf").alias("term", "tf"))


def _by_level(postings: DataFrame) -> DataFrame:
    """The postings, written into one folder for each level of rarity: a round reads its own."""
    path = f"{shared_folder(postings.sparkSession)}/postings-{uuid.uuid4().hex}"
    postings.hint("rebalance", "level").write.partitionBy("level").parquet(path)
    return postings.sparkSession.read.schema(postings.schema).parquet(path)


def _top(scores: DataFrame, k: int, by: str) -> DataFrame:
    """The ``k`` best rows of each query with their rank; Spark keeps ``k`` per task before the shuffle."""
    best = Window.partitionBy("query").orderBy(F.col(by).desc(), F.col("id").asc_nulls_last(), "row")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _exact(found: DataFrame, queries: DataFrame, postings: DataFrame) -> DataFrame:
    """Scores (query, row, id, score) of accumulators (query, row, id, partial, level): the terms of later levels are added."""
    later = queries.select("query", "term", "times", F.col("level").alias("term_level"))
    asked = written(found.join(later, "query").where(F.col("term_level") > F.col("level"))
                    .select("query", "row", "id", "term", "times"), "search-asked")
    gains = asked.join(postings.select("row", "term", "impact"), ["row", "term"])
    parts = found.select("query", "row", "id", "partial").unionByName(
        gains.select("query", "row", "id", (F.col("impact") * F.col("times")).alias("partial")))
    return parts.groupBy("query", "row", "id").agg(F.sum("partial").alias("score"))


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", k: int = TOP) -> DataFrame:
    """The ``k`` best rows of ``docs`` for each row of ``items``: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.  A term's weight falls with the
    documents that hold it, its gain grows with its occurrences in the document and falls with the document's length, all in
    integers, so scores are exact.

    Postings of the terms that some item asks for are taken in rounds, rarest first.  A round adds its gains to the
    accumulators (item, document) and opens new ones.  After it, an item whose remaining terms together can bring less than its
    k-th best partial score (a bound from each term's greatest gain) opens no more: a document without an accumulator
    can't get there.  Of its accumulators those that can still reach that score survive; the k leaders are finished first, which
    raises the bar, and then all survivors that can reach the bar get the gains of the remaining terms.  All bars are lower
    bounds of the k-th best score and equal scores pass, so the result is that of scoring every document.

    Null texts have no terms.  Items and documents are rows: repeated ids are ranked separately, equal scores by
    ascending id (null last) and then by row.  Items that no document shares a term of weight with return nothing.  Other
    columns are not read.  Spark chooses how the asked terms meet the postings by their size.
    """
    raw_queries = written(term_counts(items, item_id, item_text).where("term <> ''"), "search-items")
    wanted = raw_queries.select("term").unionByName(items.sparkSession.createDataFrame([("",)], "term string")).distinct()
    raw = written(term_counts(docs, id_col, text_col).join(wanted, "term", "left_semi"), "search-terms")
    size, total = raw.where("term = ''").agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    kinds = {"item_id": items.schema[item_id].dataType, "doc_id": docs.schema[id_col].dataType}
    if not size:
        return _nothing(items, kinds)
    length = f"(25 + (75 * n * {size}L) div {total}L)"
    gain = F.expr(f"(1000000000 * tf) div (1000 * tf + 8 * {length})")
    raw = raw.where("term <> ''").select("row", "id", "term", gain.alias("gain"))
    terms = raw.groupBy("term").agg(F.count("*").alias("df"), F.max("gain").alias("most"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * size + 2) / (2 * F.col("df") + 1).cast("double")))
    level = F.floor(F.log(RARITY, "df")).cast("int")
    terms = written(terms.select("term", weight.alias("weight"), "most", level.alias("level")).where("weight > 0"), "search-weights")
    postings = _by_level(raw.join(terms, "term").select("row", "id", "term", (F.col("weight") * F.col("gain")).alias("impact"), "level"))
    queries = written(raw_queries.join(terms, "term").select(
        F.col("row").alias("query"), "term", F.col("tf").alias("times"), "level",
        (F.col("tf") * F.col("weight") * F.col("most")).alias("bound")), "search-queries")
    levels = sorted(r[0] for r in queries.select("level").distinct().collect())  # at most log4 of the documents
    if not levels:
        return _nothing(items, kinds)

    asking, table, held, closed = queries, None, None, []
    for at in levels:
        now = asking.where(F.col("level") == at).select("query", "term", "times")
        gained = postings.where(F.col("level") == at).join(now, "term").select(
            "query", "row", "id", (F.col("impact") * F.col("times")).alias("partial"))
        held = gained if held is None else held.unionByName(gained)
        before, table = table, written(held.groupBy("query", "row", "id").agg(F.sum("partial").alias("partial")), "search-held")
        if before is not None:
            dropped(before)
        bar = _top(table, k, "partial").groupBy("query").agg(F.count("*").alias("n"), F.min("partial").alias("bar"))
        rest = asking.groupBy("query").agg(F.sum(F.when(F.col("level") > at, F.col("bound")).otherwise(0)).alias("rest"))
        state = written(rest.join(bar.where(F.col("n") == k), "query", "left").select(
            "query", "rest", F.coalesce("bar", F.lit(0).cast("long")).alias("bar")), "search-state")
        ready = (F.col("rest") < F.col("bar")) | (F.col("rest") == 0)
        done = table.join(state.where(ready), "query").where(F.col("partial") + F.col("rest") >= F.col("bar"))
        closed.append(written(done.select("query", "row", "id", "partial", "rest", F.lit(at).alias("level")), "search-closed"))
        more = state.where(~ready).select("query")
        if not more.take(1):
            break
        asking, held = asking.join(more, "query", "left_semi"), table.join(more, "query", "left_semi")
    dropped(table)

    found = closed[0]
    for part in closed[1:]:
        found = found.unionByName(part)
    leaders = _exact(_top(found, k, "partial").drop("rank"), queries, postings)
    bar = leaders.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("bar")).where(F.col("n") == k)
    reach = written(bar.select("query", "bar"), "search-bars")
    left = found.join(reach, "query", "left").where(F.col("partial") + F.col("rest") >= F.coalesce("bar", F.lit(0).cast("long")))
    scores = _exact(left.select("query", "row", "id", "partial", "level"), queries, postings)
    best = written(_top(scores, k, "score"), "search-best")
    names = raw_queries.select(F.col("row").alias("query"), F.col("id").alias("item_id")).distinct()
    return best.join(names, "query").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def _nothing(items: DataFrame, kinds: dict) -> DataFrame:
    return items.sparkSession.createDataFrame(
        [], f"item_id {kinds['item_id'].simpleString()}, rank int, doc_id {kinds['doc_id'].simpleString()}, score long")


SPLIT = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOW = f"'{ascii_uppercase}', '{ascii_lowercase}'"
SEARCH_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOW}), '{SPLIT}') AS t FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS docs, sum(len(t))::BIGINT AS total FROM d),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, docs),
i AS (SELECT q, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {LOW}), '{SPLIT}')) AS term
      FROM (SELECT row_number() OVER () AS q, * FROM benchmark)),
c AS (SELECT q, item_id, r, any_value(doc_id) AS doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(t) * docs) // total))))::BIGINT AS score
      FROM i JOIN f USING (term) JOIN p USING (term) JOIN d USING (r), s GROUP BY q, item_id, r)
SELECT item_id, rank, doc_id, score FROM
    (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank FROM c WHERE score > 0)
WHERE rank <= {TOP}
"""


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
