"""Personal data: fixed patterns as seeds, and bootstrapped contextual extraction of further identifiers."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import dropped, written
from tidemark.llm.words import text_parts

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 4
LEAST_INSTANCES = 3
LEAST_CONFIDENCE = 0.8

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
LOCAL_BYTES = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EDGES = "\"'`()[]{}<>,;:.!?"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the local part is the run of its characters to the left, no further than the
    match before; so a long run without ``@`` costs nothing."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_BYTES:
            start -= 1
        after = DOMAIN.match(text, at) if start < at else None
        if after:
            out.append((start, after.end()))
            free = after.end()
            at = text.find("@", free)
        else:
            free = at + 1  # no match can hold this character
            at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, in order of start and then of kind."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if ANY.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text)
                  if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in m.groups())]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def contexts(text: str, spans: list[tuple[str, int, int]]):
    """(kind or None, start, end, instance, pattern) of the seeds and of other tokens that hold a digit or ``@``.

    The pattern is the word before and the word after, lower-cased, without punctuation at their edges; digits in
    them count as one sign.  The instance is the text itself.
    """
    def near(word: str) -> str:
        return re.sub(r"[0-9]+", "9", word.lower().strip(EDGES))

    def left(a: int) -> str:
        part = text[max(0, a - 80):a].split()
        return near(part[-1]) if part else "^"

    def right(b: int) -> str:
        part = text[b:b + 80].lstrip(EDGES).split()
        return near(part[0]) if part else "$"

    for kind, a, b in spans:
        yield kind, a, b, text[a:b], f"{left(a)} _ {right(b)}"
    if not ANY.search(text):
        return
    taken, i = sorted((a, b) for _, a, b in spans), 0
    for m in ANY_WORD.finditer(text):
        token = m.group()
        a = m.start() + len(token) - len(token.lstrip(EDGES))
        token = token.strip(EDGES)
        b = a + len(token)
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if len(token) >= 5 and not (i < len(taken) and taken[i][0] < b):
            yield None, a, b, token, f"{left(a)} _ {right(b)}"


ANY_WORD = re.compile(r"(?<![^\x20\x09-\x0D])[^0-9@\x20\x09-\x0D]*+[0-9@][^\x20\x09-\x0D]*")
SCHEMA = ("doc_id long, row long, base string, base_spans array<struct<kind:string,start:long,stop:long>>, "
          "seen array<struct<kind:string,start:long,stop:long,instance:string,pattern:string>>")


def _scan(batches):
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    seen_type = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("instance", pa.string()),
                           ("pattern", pa.string())])
    for batch in batches:
        at = 0
        rows = batch.column(2).to_pylist()
        for ids, texts in text_parts(batch.column(0), batch.column(1)):
            base, spans, seen = [], [], []
            for raw in texts:
                text = raw.decode("utf-8", "replace")
                own = base_spans(text) if ANY.search(text) else []
                base.append(hashlib.sha256(joined(own).encode()).hexdigest())
                spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in own])
                seen.append([{"kind": k, "start": a, "stop": b, "instance": hashlib.md5(x.encode()).hexdigest(),
                              "pattern": p} for k, a, b, x, p in (contexts(text, own) if ANY.search(text) else ())])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(rows[at:at + len(ids)], pa.int64()), pa.array(base, pa.string()),
                pa.array(spans, pa.list_(span)), pa.array(seen, pa.list_(seen_type)),
            ], ["doc_id", "row", "base", "base_spans", "seen"])
            at += len(ids)


def discover(seen: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind) that the seeds make trustworthy, by rounds of scoring over the graph of patterns and instances.

    A pattern's confidence for a kind is the mean of what is known of the distinct instances it surrounds (1 for a seed of
    the kind, 0 for a seed of another or an unknown one).  An instance's confidence is that no pattern with at least
    ``LEAST_INSTANCES`` instances and ``LEAST_CONFIDENCE`` is wrong about it.  Instances so found are seeds of the next
    round, and so reveal further patterns.  All steps are counts combined before the shuffle and joins on the pattern or
    instance; a frequent pattern is one row after the count.
    """
    edges = written(seen.groupBy("pattern", "instance").agg(F.max("kind").alias("seed")), "edges")
    known = edges.where("seed IS NOT NULL").groupBy("instance").agg(F.max("seed").alias("kind"), F.lit(1.0).alias("sure"))
    known = written(known, "known")
    patterns = None
    for _ in range(rounds):
        known_as = known.select(F.col("instance").alias("known_instance"), "kind", "sure")
        facts = edges.join(known_as, F.col("instance") == F.col("known_instance"), "left")
        sums = facts.groupBy("pattern", "kind").agg(F.sum("sure").alias("sure"), F.count("*").alias("n"))
        total = edges.groupBy(F.col("pattern").alias("total_pattern")).agg(F.count("*").alias("all"))
        scored = (sums.where("kind IS NOT NULL").join(total, F.col("pattern") == F.col("total_pattern"))
                  .withColumn("confidence", F.col("sure") / F.col("all"))
                  .where(f"n >= {LEAST_INSTANCES} AND confidence >= {LEAST_CONFIDENCE}"))
        patterns = written(scored.select("pattern", "kind", "confidence"), "patterns")
        reached = edges.where("seed IS NULL").join(
            patterns.withColumnRenamed("pattern", "by"), F.col("pattern") == F.col("by"))
        doubts = reached.groupBy("instance", "kind").agg(F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))))
                                                         .alias("doubt"))
        best = doubts.groupBy("instance").agg(F.min_by("kind", F.struct("doubt", "kind")).alias("kind"),
                                              (1 - F.min("doubt")).alias("sure"))
        seeds = edges.where("seed IS NOT NULL").groupBy("instance").agg(F.max("seed").alias("kind"),
                                                                        F.lit(1.0).alias("sure"))
        fresh = best.join(seeds.select(F.col("instance").alias("s")), F.col("instance") == F.col("s"), "left_anti")
        after = written(seeds.union(fresh), "known")
        same = after.count() == known.count()
        dropped(known)
        known = after
        if same:
            break
    return patterns


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end of all spans).

    The base patterns give the seeds.  Around every seed and every other token with a digit or ``@`` (5 characters or more)
    the neighbouring words are noted; ``discover`` finds the patterns of neighbours that can be trusted for a kind, and tokens
    in such a pattern are added as spans of that kind.  Added spans never overlap base ones.  What is kept of a text
    is one row of spans and contexts, so texts are read once and not shuffled.

    Null and empty texts have no spans.  Rows of a repeated or null id are treated each on its own.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    scanned = written(texts.mapInArrow(_scan, SCHEMA), "pii")
    seen = scanned.where("size(seen) > 0").select("row", F.explode("seen").alias("s")).select("row", "s.*")
    trusted = discover(seen).select(F.col("pattern").alias("by"), F.col("kind").alias("new_kind"))
    found = seen.where("kind IS NULL").join(trusted, F.col("pattern") == F.col("by"))
    found = found.groupBy(F.col("row").alias("new_row")).agg(F.array_sort(F.collect_set(F.struct(
        F.col("new_kind").alias("kind"), "start", "stop"))).alias("added"))
    out = scanned.join(found, F.col("row") == F.col("new_row"), "left")
    spans = F.expr("""array_join(transform(array_sort(transform(
        concat(base_spans, coalesce(added, array())),
        s -> struct(s.start AS start, array_position(array('email', 'ip', 'card', 'phone'), s.kind) AS place,
                    s.stop AS stop, s.kind AS kind))),
        s -> concat_ws(':', s.kind, s.start, s.stop)), ',')""")
    counts = [F.expr(f"CAST(size(filter(base_spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.col("base").alias("base_sha256"), spans.alias("spans"))


def op10_pii(spark, sf_dir: str) -> DataFrame:
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
