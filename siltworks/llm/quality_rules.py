"""Quality rules with adaptive thresholds, in DataFrame functions only.

Method: every text gets exact base measures.  Five of them, in whole
thousandths, feed quantile sketches per language and source.  A sketch is a
log-linear histogram (a value keeps its six leading bits, so a quantile is
within 1/32): a bag of (bucket, count) rows that merges by adding counts, in
any order and to the same result.  Sketches of few documents fall back on the
merged sketch of their language, then on that of everything.  A document fails
when a measure exceeds its group's limit::

    max(median + SPREAD * (median - lower tenth), upper quarter + slack)

The spread below the median is used because junk raises only the upper side,
and the upper quarter because a quarter of a group may be junk.  The slack keeps
a measure that nearly all documents of a group agree in (no symbols, no repeats)
from failing all others.
Limits join the documents by language and source.

Null texts count as empty and fail the base rule.  Null languages and sources
form groups of their own.  A value that ties with its limit passes.  Equal rows get equal verdicts; an empty table gives
an empty result.  Added columns take the place of input columns with their
names; column names beginning with ``_q_`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import scratch
from .native import let

#: Words as runs without these, and the characters counted as symbols (fixed values).
WORD, SPACE, SYMBOL = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+", r"[#*$%&|<>]+"
#: Measures with a sketch and the slack each has over the upper quarter, in thousandths
#: (word length: thousandths of a character).
SLACK = {"symbols": 60, "capitals": 25, "dup_lines": 400, "repeats": 250, "word_length": 1000}
SPREAD = 8
#: Documents that a group's own sketch needs.
LEAST = 200
#: (language, source) groups whose limits are broadcast at most, some 10 MB.
BROADCAST_GROUPS = 100_000
WINDOW = 8


def _repeat_words(words: Column) -> Column:
    """Words in windows of eight found twice or more, counted once each.

    Windows compare by 64-bit hash; within one text an accidental match is out
    of practical reach.
    """
    size = F.size(words)

    def covered(starts: Column) -> Column:
        # each window reaches to the next one's start, eight words at most
        def reach(p: Column, j: Column) -> Column:
            return F.coalesce(F.least(F.lit(WINDOW), F.get(starts, j + 1) - p), F.lit(WINDOW))

        return F.aggregate(F.transform(starts, reach), F.lit(0).cast("long"), lambda a, x: a + x)

    def starts(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))

        return let(ordered, twice)

    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(starts(windows), covered))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(size <= WINDOW, F.lit(0).cast("long")).otherwise(let(let(hashes, windows), count))


def base_measures(text: str = "text") -> Column:
    """A struct of the exact measures of one text."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, SYMBOL, ""))).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
    )


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base measures and ``base_failed``."""
    out = docs.withColumn("_q_m", base_measures(text))
    at = {"n_words": "w.n_words", "n_repeat_words": "w.n_repeat_words", "n_lines": "l.n_lines", "n_dup_lines": "l.n_dup_lines"}
    out = out.withColumns({c: F.col(f"_q_m.{at.get(c, c)}") for c in _MEASURES}).drop("_q_m")
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _thousandths(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(1000 * F.col(part), F.col(whole)), F.lit(0)).cast("long")


def _values() -> dict[str, Column]:
    return {
        "symbols": _thousandths("n_symbols", "word_chars"),
        "capitals": _thousandths("n_capitals", "word_chars"),
        "dup_lines": _thousandths("n_dup_lines", "n_lines"),
        "repeats": _thousandths("n_repeat_words", "n_words"),
        "word_length": _thousandths("word_chars", "n_words"),
    }


def sketch(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Mergeable sketches: rows (lang, source, measure, bucket, count)."""
    values = _values()
    long = measured.select(
        F.coalesce(F.col(lang), F.lit("")).alias("_q_lang"),
        F.coalesce(F.col(source), F.lit("")).alias("_q_source"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("v")) for k, v in values.items()])).alias("x"),
    ).select("_q_lang", "_q_source", "x.measure", F.col("x.v").alias("v"))
    bucket = F.expr("if(v < 64, v, v - v % shiftleft(1L, length(bin(v)) - 6))")
    return long.groupBy("_q_lang", "_q_source", "measure", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches merged over everything but ``keys``."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Lower tenth, median and upper quarter of each sketch, and its number of documents.

    A sketch has at most about 2,000 buckets, so its window is bounded.
    """
    w = Window.partitionBy(*keys, "measure").orderBy("bucket")
    run = sketches.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys, "measure")))
    return run.groupBy(*keys, "measure").agg(
        F.min(F.when(10 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q10"),
        F.min(F.when(2 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q50"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q75"),
        F.max("total").alias("total"),
    )


def limits(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source): a limit for every measure."""
    slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])
    limit = F.greatest(F.col("q50") + SPREAD * (F.col("q50") - F.col("q10")), F.col("q75") + slack[F.col("measure")])
    own = quantiles(sketches, ["_q_lang", "_q_source"]).withColumn("own", limit)
    by_lang = quantiles(merge(sketches, ["_q_lang"]), ["_q_lang"]).select("_q_lang", "measure", limit.alias("wide"), F.col("total").alias("wide_n"))
    overall = quantiles(merge(sketches, []).withColumn("_q_all", F.lit(0)), ["_q_all"]).select("measure", limit.alias("widest"))
    joined = own.join(by_lang, ["_q_lang", "measure"]).join(overall, "measure")
    chosen = F.when(F.col("total") >= LEAST, F.col("own")).when(F.col("wide_n") >= LEAST, F.col("wide")).otherwise(F.col("widest"))
    return joined.groupBy("_q_lang", "_q_source").agg(*[F.max(F.when(F.col("measure") == k, chosen)).alias(f"_q_{k}") for k in SLACK])


def apply(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """Add the measures, ``base_failed``, ``failed`` (names of exceeded limits) and ``kept``.

    ``carry`` names the input columns to keep, all by default; without the
    text, the table written between the two passes is narrow.
    """
    names = docs.columns if carry is None else [*dict.fromkeys([*carry, lang, source])]
    measured = measure(docs, text)
    measured = scratch.table(measured.select(*[c for c in names if c not in (*_MEASURES, "base_failed")], *_MEASURES, "base_failed"), "quality-measured")
    found = scratch.table(limits(scratch.table(sketch(measured, lang, source), "quality-sketch")), "quality-limits")
    if found.count() <= BROADCAST_GROUPS:
        found = F.broadcast(found)  # else a join that adaptive execution splits where it is skewed
    keyed = measured.withColumns({"_q_lang": F.coalesce(F.col(lang), F.lit("")), "_q_source": F.coalesce(F.col(source), F.lit(""))})
    over = F.array_compact(F.array(*[F.when(v > F.col(f"_q_{k}"), F.lit(k)) for k, v in _values().items()]))
    out = keyed.join(found, ["_q_lang", "_q_source"]).withColumn("failed", over)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    return out.drop("_q_lang", "_q_source", *[f"_q_{k}" for k in SLACK])


def _sql_limits() -> str:
    values = {"symbols": ("n_symbols", "word_chars"), "capitals": ("n_capitals", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}
    longs = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{k}' AS measure, {SLACK[k]} AS slack, CASE WHEN {b} = 0 THEN 0 ELSE 1000 * {a} // {b} END AS v FROM measured" for k, (a, b) in values.items()
    )
    def level(keys: str) -> str:  # noqa: E306
        sep = f"{keys}, " if keys else ""
        return f"""SELECT {sep}measure, greatest({1 + SPREAD} * min(CASE WHEN 2 * upto >= total THEN bucket END) - {SPREAD} * min(CASE WHEN 10 * upto >= total THEN bucket END),
  min(CASE WHEN 4 * upto >= 3 * total THEN bucket END) + max(slack)) AS lim, max(total) AS total
  FROM (SELECT *, sum(n) OVER (PARTITION BY {sep}measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {sep}measure) AS total
    FROM (SELECT {sep}measure, bucket, max(slack) AS slack, count(*) AS n FROM bucketed GROUP BY {sep}measure, bucket)) GROUP BY {sep}measure"""
    return f"""longs AS ({longs}),
bucketed AS (SELECT *, CASE WHEN v < 64 THEN v ELSE v - v % (1::BIGINT << (length(bin(v)) - 6)::INT) END AS bucket FROM longs),
own AS ({level("lang, source")}),
wide AS ({level("lang")}),
widest AS ({level("")}),
verdict AS (SELECT doc_id, max(CASE WHEN v > CASE WHEN own.total >= {LEAST} THEN own.lim WHEN wide.total >= {LEAST} THEN wide.lim ELSE widest.lim END THEN 1 ELSE 0 END) AS bad
  FROM longs JOIN own USING (lang, source, measure) JOIN wide USING (lang, measure) JOIN widest USING (measure) GROUP BY doc_id)"""


#: DuckDB: a chain of common table expressions over the view in {docs}; ends with
#: ``measured`` (base measures) and ``verdict`` (doc_id, bad).
SQL_CTES = r"""
w AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM {docs}),
win AS (SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win) WHERE k > 1) GROUP BY doc_id),
measured AS (SELECT doc_id, lang, source, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
  (length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')))::BIGINT AS n_capitals,
  len(words) < 20 OR 100 * coalesce(rep.n, 0) > 30 * len(words) AS base_failed FROM w LEFT JOIN rep USING (doc_id)),
""" + _sql_limits()
