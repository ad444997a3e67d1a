"""Line dedup: repeated runs of lines found by prefix doubling of line-id ranks, later copies deleted. DataFrames only.

A text is a sequence of lines (cut at \\n). Rank 0 of a position numbers its line in sorted order; rank k + 1 numbers
the pair (rank k here, rank k 2^k lines on) in sorted order, so it orders the suffixes by their first 2^(k+1) lines: the
suffix array by distributed prefix doubling. Positions that share a rank form an interval of suffixes with a common
prefix of that many lines. Positions whose rank is unique leave, since nothing longer repeats there.

A run is a stretch of consecutive lines of one document with ``MIN_WORDS`` blank-separated words or more. A run that
occurred before, in order of (doc_id, line), is a later copy. Every later run is covered by the shortest runs
that start or end at each of its lines, and a run of n lines equals another exactly if the two overlapping blocks of
2^k <= n lines at its ends have the same ranks. Their union are the maximal repeated runs; their lines are deleted.

Null text stays null, empty text empty. A text may end up empty. Rows repeating doc_id and text are one document and
get the same result; rows repeating only the doc_id are ordered by a hash of the text. Null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import settle, shuffled

MIN_WORDS = 50
FIRST_ID = -(1 << 63)
DOC = ["d", "t"]


def _identity() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("d"), F.xxhash64(F.col("text").cast("string")).alias("t")]


def _lines() -> Column:
    return F.split(F.col("text").cast("string"), "\n", -1)


def _numbered(groups: DataFrame, *by: str) -> DataFrame:
    """Distinct keys with a number that follows their sorted order; settled, so that it never changes."""
    return settle(
        groups.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id()), "line-ranks"
    )


def _repeated(rows: DataFrame, *by: str) -> DataFrame:
    """Rows whose key occurs more than once, with the key's rank."""
    groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(shuffled(_numbered(groups, *by)), list(by)).drop(*by)


def _shortest(lines: DataFrame, least: int) -> DataFrame:
    """(d, t, p, e): for each line the shortest run of ``least`` words starting there, and that ending there."""
    run = [*DOC, "island"]
    upto = W.partitionBy(*run).orderBy("p").rowsBetween(W.unboundedPreceding, 0)
    summed = lines.withColumn("total", F.sum("words").over(upto))
    before = F.col("total") - F.col("words")
    # on one scale of running words: where lines end (total) and where a run from p needs to have come (before + least)
    marks = F.explode(
        F.array(
            F.struct(F.col("total").alias("at"), F.lit(1).alias("kind"), F.col("p").alias("end"), F.lit(None).cast("int").alias("from")),
            F.struct((before + least).alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("int").alias("end"), F.col("p").alias("from")),
        )
    )
    events = summed.select(*run, marks.alias("m")).select(*run, "m.*")
    after = W.partitionBy(*run).orderBy("at", "kind", "end", "from").rowsBetween(0, W.unboundedFollowing)
    so_far = W.partitionBy(*run).orderBy("at", "kind", "from", "end").rowsBetween(W.unboundedPreceding, 0)
    found = events.select(
        *DOC,
        F.coalesce("from", F.last("from", ignorenulls=True).over(so_far)).alias("p"),
        F.coalesce("end", F.first("end", ignorenulls=True).over(after)).alias("e"),
    )
    return found.where(F.col("p").isNotNull() & F.col("e").isNotNull()).distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, t, start, end): maximal stretches of lines (from 0, both inclusive) that repeat earlier runs."""
    lines = docs.select(*_identity(), F.posexplode(_lines()).alias("p", "line"))
    lines = lines.select(*DOC, "p", F.xxhash64("line").alias("h"), F.crc32("line").alias("c"), F.regexp_count("line", F.lit("[^ ]+")).cast("long").alias("words"))
    lines = _repeated(lines.distinct(), "h", "c")
    lines = lines.withColumn("island", F.col("p") - F.row_number().over(W.partitionBy(*DOC).orderBy("p")))
    enough = F.sum("words").over(W.partitionBy(*DOC, "island")) >= min_words
    lines = settle(lines.withColumn("enough", enough).where("enough").drop("enough"), "line-islands")

    runs = _shortest(lines, min_words).withColumn("size", F.col("e") - F.col("p") + 1)
    runs = settle(runs.withColumn("level", F.floor(F.log2("size")).cast("int")), "line-runs")
    levels = runs.agg(F.max("level")).first()[0]
    if levels is None:
        return runs.select(*DOC, F.col("p").alias("start"), F.col("e").alias("end"))

    place = lines.select(*DOC, "p", "rank")
    ranks = place.withColumn("level", F.lit(0))
    for level in range(levels):
        ahead = place.select(*DOC, (F.col("p") - (1 << level)).alias("p"), F.col("rank").alias("next"))
        pairs = shuffled(place.withColumnRenamed("rank", "this")).join(ahead, [*DOC, "p"])
        place = settle(_repeated(pairs, "this", "next"), "line-places")
        ranks = ranks.unionByName(place.withColumn("level", F.lit(level + 1)))

    head = ranks.select("level", *DOC, "p", F.col("rank").alias("head"))
    tail = ranks.select("level", *DOC, F.col("p").alias("q"), F.col("rank").alias("tail"))
    power = F.expr("shiftleft(1, level)")
    named = shuffled(runs).join(head, ["level", *DOC, "p"]).withColumn("q", F.col("e") + 1 - power)
    named = named.join(shuffled(tail), ["level", *DOC, "q"])
    named = settle(named.select("size", "head", "tail", *DOC, "p", "e"), "line-named")
    first = named.groupBy("size", "head", "tail").agg(F.min(F.struct(*DOC, "p")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = shuffled(named).join(first, ["size", "head", "tail"]).where(F.struct(*DOC, "p") > F.col("first")).select(*DOC, "p", "e")

    order = W.partitionBy(*DOC).orderBy("p", "e")
    reached = F.max("e").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.coalesce((F.col("p") > reached + 1).cast("int"), F.lit(1))
    merged = later.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return merged.groupBy(*DOC, "run").agg(F.min("p").alias("start"), F.max("e").alias("end")).select(*DOC, "start", "end")


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later copies deleted from ``text``, and ``removed_lines``; other columns as given."""
    spans = later_copies(docs, min_words).groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    spans = settle(spans, "line-spans").withColumnsRenamed({"d": "__d", "t": "__t"})
    d, t = _identity()
    mine = docs.select(*[F.col(c) for c in docs.columns if c != "removed_lines"], d.alias("__my_d"), t.alias("__my_t"))
    # sorted on both sides at every size: texts move once, whether or not the spans would fit a broadcast
    joined = shuffled(mine).join(spans, (F.col("__my_d") == F.col("__d")) & (F.col("__my_t") == F.col("__t")), "left")
    first = F.concat(F.array(F.lit(0)), F.transform("__spans", lambda s: s["end"] + 1))
    stop = F.concat(F.transform("__spans", lambda s: s["start"]), F.array(F.size(_lines())))
    kept = F.flatten(F.zip_with(first, stop, lambda a, b: F.slice(_lines(), a + 1, b - a)))
    gone = F.aggregate("__spans", F.lit(0), lambda n, s: n + s["end"] - s["start"] + 1)
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn("removed_lines", F.coalesce(gone, F.lit(0))).withColumn("text", text)
    return out.select(*[c for c in docs.columns if c != "removed_lines"], "removed_lines")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents with later copies deleted; those of which nothing is left are dropped. Columns as given, n_chars renewed."""
    out = deduplicated(docs.withColumnsRenamed({"removed_lines": "__given"}), min_words)
    out = out.where((F.col("removed_lines") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("removed_lines") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", length)
    return out.drop("removed_lines").withColumnsRenamed({"__given": "removed_lines"})


#: The same result in DuckDB's SQL.
SQL = f"""
WITH lines AS (
  SELECT doc_id, line, pos - 1 AS p, len(regexp_extract_all(line, '[^ ]+')) AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents WHERE text IS NOT NULL)),
summed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY p) AS total, sum(words) OVER (PARTITION BY doc_id ORDER BY p) - words AS before
  FROM lines),
runs AS (
  SELECT s.doc_id, s.p, min(e.p) AS e FROM summed s JOIN summed e ON s.doc_id = e.doc_id AND e.p >= s.p AND e.total >= s.before + {MIN_WORDS} GROUP BY ALL
  UNION
  SELECT e.doc_id, max(s.p) AS p, e.p AS e FROM summed s JOIN summed e ON s.doc_id = e.doc_id AND s.p <= e.p AND e.total >= s.before + {MIN_WORDS} GROUP BY ALL),
named AS (
  SELECT r.doc_id, r.p, r.e, string_agg(l.line, chr(10) ORDER BY l.p) AS content
  FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND l.p BETWEEN r.p AND r.e GROUP BY ALL),
later AS (
  SELECT doc_id, p, e FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, p) AS n FROM named) WHERE n > 1),
gone AS (SELECT DISTINCT l.doc_id, l.p FROM lines l JOIN later r ON l.doc_id = r.doc_id AND l.p BETWEEN r.p AND r.e),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.p) AS text FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.p = g.p GROUP BY ALL),
lost AS (SELECT doc_id, count(*)::INT AS removed_lines FROM gone GROUP BY ALL)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(g.removed_lines, 0)::INT AS removed_lines
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN lost g USING (doc_id)
"""
