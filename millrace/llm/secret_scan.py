"""Secret scan: base rules, and character Markov models for random strings beside them. DataFrames only.

Base rules find assignments, access keys and hexadecimal runs. Two first-order Markov models over printable ASCII,
one of random strings and one of ordinary words, are trained from labelled samples; a candidate (any run of
``CANDIDATE`` characters) whose log-likelihood ratio is above ``MARGIN`` per step is one more span, of kind ``random``,
unless it touches a base span. Spans are kind:start:end in code points, end exclusive.

Labelled samples come from at most ``SAMPLE_DOCS`` documents (smallest id hashes) of those that hold base spans and as
many of the rest: values found by the base rules are random strings; words and identifiers of the rest are ordinary.
Without samples of both classes the ratio is 0 and no span is added. Null text is empty. Ties and repeated rows need no
rule: each row stands alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_sample, settle

SAMPLE_DOCS = 6_000
MARGIN = 0.2
SYMBOLS = 95  # printable ASCII
CANDIDATE = "[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex")
#: Fixed by the contract. A match of ``access`` or ``hex`` that is too short holds no longer one, so the length may stand in the pattern.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: The letters that a match of ``ASSIGN`` begins with: looked at first, they spare most places the names.
BEGINS = "(?i)(?=[psta][aepo][scki])"
#: ``ASSIGN`` with a value that is long enough.
ASSIGN_FITS = ASSIGN[:-2] + "{8,})"

OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"


def _safe(text: Column) -> Column:
    """Text whose own mark characters are replaced by one that no pattern holds; places stay."""
    return F.translate(text, OPEN + CLOSE, OTHER + OTHER)


def _cut(text: Column, pattern: str, marked: str) -> Column:
    """Text cut at the marks around each match; null without a match."""
    return F.when(text.rlike(pattern), F.split(F.regexp_replace(text, pattern, marked), f"[{OPEN}{CLOSE}]", -1))


def _placed(parts: Column, step: int, fits: Callable[[Column, Column], Column]) -> Column:
    """Spans (start, end, found) of the matches among parts: outside, match [, group], outside, ..."""
    every = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / step).cast("int") - 1)
    kind = "struct<at: int, spans: array<struct<start: int, end: int, found: string>>>"
    start = F.struct(F.lit(0).alias("at"), F.array().alias("spans")).cast(kind)

    def add(acc: Column, i: Column) -> Column:
        outside, match, value = F.get(parts, i * step), F.get(parts, i * step + 1), F.get(parts, i * step + step - 1)
        begin = acc["at"] + F.length(outside)
        end = begin + F.length(match)
        span = F.struct(begin.alias("start"), end.alias("end"), value.alias("found"))
        return F.struct(end.alias("at"), F.when(fits(match, value), F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")).cast(kind)

    none = F.array().cast("array<struct<start: int, end: int, found: string>>")
    return F.when(F.size(parts) > step, F.aggregate(every, start, add)["spans"]).otherwise(none)


def with_base_spans(docs: DataFrame, *kept: str) -> DataFrame:
    """doc_id, text (null as empty), the columns to keep, the base spans by kind, and the text cut at its candidates.

    A match of ``access`` or ``hex`` lies in a candidate, so texts without one are not searched for them. The cuts are columns of
    their own: an expression that stands in a lambda is worked out again for every element.
    """
    whole = F.length  # a match that the pattern allows always fits
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _safe(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"), *kept)
    rows = rows.withColumn("candidates", _cut(F.col("text"), CANDIDATE, f"{OPEN}$0{CLOSE}"))
    long = F.col("candidates").isNotNull()
    cuts = rows.withColumns(
        {
            "assign": _cut(F.col("text"), BEGINS + ASSIGN, f"{OPEN}$0{CLOSE}$2{OPEN}"),
            "access": F.when(long, _cut(F.col("text"), ACCESS, f"{OPEN}$0{CLOSE}")),
            "hex": F.when(long, _cut(F.col("text"), HEX, f"{OPEN}$0{CLOSE}")),
        }
    )
    return cuts.select(
        "doc_id",
        "text",
        *kept,
        _placed(F.col("assign"), 3, lambda match, value: F.length(value) >= 8).alias("assign"),
        _placed(F.col("access"), 2, lambda match, value: whole(match) > 0).alias("access"),
        _placed(F.col("hex"), 2, lambda match, value: whole(match) > 0).alias("hex"),
        "candidates",
    )


def labelled_samples(docs: DataFrame, limit: int = SAMPLE_DOCS) -> DataFrame:
    """(sample, random): values of base spans, and words of texts in which the base rules find nothing.

    Every text is looked at for base spans; at most ``limit`` documents with and ``limit`` without them are read.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    suspect = F.col("text").rlike(BEGINS + ASSIGN_FITS) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX)
    ids = settle(rows.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id"), suspect.alias("suspect")), "secret-ids")
    chosen = [bounded_sample(ids.where(which), limit, "__id").distinct() for which in ("suspect", "NOT suspect")]
    some = rows.join(F.broadcast(chosen[0].union(chosen[1])), (F.col("doc_id") == F.col("__id")) & (F.col("suspect") == suspect))
    values = F.transform(F.concat("assign", "access", "hex"), lambda s: s["found"])
    words = F.regexp_extract_all("text", F.lit("[A-Za-z0-9_-]{4,}"), F.lit(0))
    found = with_base_spans(some, "suspect").select("suspect", F.when(F.col("suspect"), values).otherwise(words).alias("found"))
    # Spark would test what explode() gets for emptiness on every text, by expressions that repeat themselves
    samples = found.select(F.explode_outer("found").alias("sample"), F.col("suspect").alias("random"))
    return settle(samples.where(F.col("sample").isNotNull()), "secret-samples")


def _codes(text: Column) -> Column:
    return F.transform(F.split(text, ""), lambda c: F.least(F.greatest(F.ascii(c) - 32, F.lit(0)), F.lit(SYMBOLS - 1)))


def _steps(text: Column) -> Column:
    """Numbers of the transitions of a string: code here * SYMBOLS + code of the next."""
    pairs = lambda codes: F.zip_with(
        F.slice(codes, F.lit(1), F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0))), lambda a, b: a * SYMBOLS + b
    )
    return F.get(F.transform(F.array(_codes(text)), pairs), F.lit(0))  # the codes of a string are worked out once


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio, random against ordinary, of each of the SYMBOLS^2 transitions (add-one smoothing)."""
    steps = samples.where(F.length("sample") > 1).select("random", F.explode_outer(_steps(F.col("sample"))).alias("step"))
    counted = steps.groupBy("step").agg(
        F.count(F.when(F.col("random"), 1)).alias("random"), F.count(F.when(~F.col("random"), 1)).alias("ordinary")
    )
    grid = samples.sparkSession.range(SYMBOLS * SYMBOLS).select(F.col("id").cast("int").alias("step"))
    full = grid.join(counted, "step", "left").na.fill(0).withColumn("row", F.floor(F.col("step") / SYMBOLS))
    sums = full.groupBy("row").agg(F.sum("random").alias("all_random"), F.sum("ordinary").alias("all_ordinary"))
    part = lambda n, total: (F.col(n) + 1) / (F.col(total) + SYMBOLS)
    ratio = F.log(part("random", "all_random") / part("ordinary", "all_ordinary"))
    rows = full.join(sums, "row").select("step", ratio.alias("ratio"), F.sum("random").over(_whole()).alias("r"), F.sum("ordinary").over(_whole()).alias("o"))
    found = {r.step: (r.ratio if r.r and r.o else 0.0) for r in rows.collect()}
    return [found[i] for i in range(SYMBOLS * SYMBOLS)]


def _whole():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))  # over the fixed grid of transitions


def scanned(docs: DataFrame, ratios: list[float], margin: float = MARGIN) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratios)), ",").cast("array<double>")
    rows = with_base_spans(docs)
    likely = lambda match: F.aggregate(_steps(match), F.lit(0.0), lambda a, s: a + F.get(table, s)) > margin * (F.length(match) - 1)
    found = _placed(F.col("candidates"), 2, lambda match, value: likely(match))
    rows = rows.withColumn("random", found)
    base = F.concat("assign", "access", "hex")
    touches = lambda s: F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    rows = rows.withColumn("random", F.filter("random", lambda s: ~touches(s)))
    listed = lambda kind, order: F.transform(
        kind, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.concat_ws(":", F.lit(kind), s["start"], s["end"]).alias("said"))
    )
    joined = lambda kinds: F.array_join(
        F.transform(F.array_sort(F.concat(*[listed(k, i) for i, k in enumerate(kinds)])), lambda s: s["said"]), ","
    )
    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(KINDS), 256).alias("base_sha256"),
        joined([*KINDS, "random"]).alias("spans"),
    )


def secrets(docs: DataFrame) -> DataFrame:
    """Trains on labelled samples of the documents themselves and scans all of them."""
    return scanned(docs, train(labelled_samples(docs)))
