"""The contract queries: thin digests of the operators' outputs, and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Vocabulary of the tokenizer queries; ``None`` takes the installed one.
VOCABULARY: str | None = None


def vocabulary() -> str:
    return VOCABULARY or importlib.import_module("public_tokenizers").path("word_bpe_49k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the trusted model, and the verdict."""
    from . import kneser_ney

    out = kneser_ney.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "lang", "n_tokens", F.round("perplexity", 3).alias("perplexity"), "kept")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of ids and decoded text."""
    from . import bpe

    return bpe_digests(bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), packed=True, decoded=True))


def bpe_digests(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    from . import wordpiece

    return wordpiece.count(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary()).select("doc_id", "n_words", "n_pieces")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document and the adaptive verdict."""
    from . import quality_rules

    out = quality_rules.apply(read(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_sql() -> str:
    from . import quality_rules

    ctes = quality_rules.SQL_CTES.replace("{docs}", "documents")
    return f"""WITH {ctes}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad = 0 AS kept
FROM measured JOIN verdict USING (doc_id)"""


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation paired with its rejected twin, as prompt and masked completions."""
    from . import preference

    pairs = preference.with_rejected(preference.conversations(read(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), ",")
    return preference.format_pairs(pairs).select(
        "conv_id", F.col("n_prompt_turns").cast("long"), "prompt", "chosen_completion", "rejected_completion",
        spans("chosen_mask").alias("chosen_mask"), spans("rejected_mask").alias("rejected_mask"),
    )


OP5_SQL = r"""
WITH c AS (SELECT conv_id, list({'r': coalesce(role, ''), 'c': coalesce(text, '')} ORDER BY turn, role, text) AS t FROM conversations GROUP BY conv_id),
k AS (SELECT conv_id, t, list_filter(range(1, len(t) + 1), lambda i: t[i].r = 'assistant') AS sp FROM c),
p AS (SELECT conv_id, t, CASE WHEN len(sp) = 0 THEN t ELSE list_concat(t[1 : sp[-1] - 1], [{'r': 'assistant',
  'c': CASE WHEN len(sp) > 1 THEN t[sp[1]].c WHEN sp[-1] > 1 THEN t[sp[-1] - 1].c ELSE '' END}]) END AS x FROM k),
n AS (SELECT *, len(list_filter(range(1, least(len(t), len(x)) + 1), lambda i: t[1 : i] = x[1 : i])) AS n FROM p),
r AS (SELECT conv_id, n, array_to_string(list_transform(t[1 : n], lambda u: '<|' || u.r || '|>' || chr(10) || u.c || '<|end|>' || chr(10)), '') AS prompt,
  t[n + 1 :] AS a, x[n + 1 :] AS b FROM n),
s AS (SELECT *, list_transform(a, lambda u: length(u.r) + 5) AS ah, list_transform(a, lambda u: length(u.c) + 8) AS ab,
  list_transform(b, lambda u: length(u.r) + 5) AS bh, list_transform(b, lambda u: length(u.c) + 8) AS bb FROM r)
SELECT conv_id, n::BIGINT AS n_prompt_turns, prompt,
  array_to_string(list_transform(a, lambda u: '<|' || u.r || '|>' || chr(10) || u.c || '<|end|>' || chr(10)), '') AS chosen_completion,
  array_to_string(list_transform(b, lambda u: '<|' || u.r || '|>' || chr(10) || u.c || '<|end|>' || chr(10)), '') AS rejected_completion,
  array_to_string(list_transform(list_filter(range(1, len(a) + 1), lambda i: a[i].r = 'assistant'), lambda i:
    (coalesce(list_sum(ah[1 : i]), 0) + coalesce(list_sum(ab[1 : i - 1]), 0))::BIGINT || ':' || (list_sum(ah[1 : i]) + list_sum(ab[1 : i]))::BIGINT), ',') AS chosen_mask,
  array_to_string(list_transform(list_filter(range(1, len(b) + 1), lambda i: b[i].r = 'assistant'), lambda i:
    (coalesce(list_sum(bh[1 : i]), 0) + coalesce(list_sum(bb[1 : i - 1]), 0))::BIGINT || ':' || (list_sum(bh[1 : i]) + list_sum(bb[1 : i]))::BIGINT), ',') AS rejected_mask
FROM s
"""


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families in every document."""
    from . import licenses

    out = licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"]))), ",")
    lines = F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["family"], x["line"].cast("string"))), ",")
    return out.select("doc_id", "n_paragraphs", F.size("licenses").cast("long").alias("n_licensed"), families.alias("families"), lines.alias("found"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    from . import contamination

    found = contamination.scan(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 5-word shingle similarity of 0.8 or more."""
    from . import jaccard

    return jaccard.join(read(spark, sf_dir, "documents"), k=5, t=80)


#: Shingle sets and components over the view {docs}; ends with ``sets`` (doc_id,
#: n_shingles) and ``comp`` (doc_id, component_id).
JACCARD_CTES = r"""
jw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {docs}),
js AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM jw)),
jn AS (SELECT doc_id, count(*) AS n FROM js GROUP BY doc_id),
jo AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM js a JOIN js b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
jl AS (SELECT x, y FROM jo JOIN jn p ON p.doc_id = x JOIN jn q ON q.doc_id = y WHERE 100 * o >= 80 * (p.n + q.n - o)),
je AS (SELECT x, y FROM jl UNION ALL SELECT y, x FROM jl),
reach AS (SELECT doc_id AS x, doc_id AS y FROM jw UNION SELECT reach.x, je.y FROM reach JOIN je ON reach.y = je.x),
sets AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles FROM jw LEFT JOIN jn USING (doc_id)),
comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)"""

OP8_SQL = "WITH RECURSIVE " + JACCARD_CTES.replace("{docs}", "documents") + " SELECT doc_id, n_shingles, component_id FROM sets JOIN comp USING (doc_id)"


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worded lines of every document and the numbers of those that go."""
    from . import line_dedup

    docs = read(spark, sf_dir, "documents")
    found = line_dedup.decisions(docs)
    numbers = F.array_join(F.transform("dropped", lambda x: x["number"].cast("string")), ",")
    out = docs.select("doc_id").join(found, F.col("doc_id") == F.col("doc"), "left")
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce(numbers, F.lit("")).alias("dropped"))


#: Exact: pairs by prefix filter over hashed order, components by recursion.
OP9_SQL = r"""
WITH RECURSIVE occ AS (SELECT doc_id, i - 1 AS n, l[i] AS x FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)) WHERE regexp_matches(l[i], '[^\x20\x09-\x0D]')),
u AS (SELECT x, row_number() OVER (ORDER BY min((doc_id, n))) AS id FROM occ GROUP BY x),
s AS (SELECT id, list_sort(list_distinct(list_transform(range(1, greatest(length(x) - 7, 1) + 1), lambda k: {'h': hash(substr(x, k, 8)), 'g': substr(x, k, 8)}))) AS l FROM u),
p AS (SELECT id, len(l) AS m, unnest(l[1 : len(l) - ceil(0.8 * len(l))::INT + 1]) AS g FROM s),
c AS (SELECT DISTINCT a.id AS x, b.id AS y FROM p a JOIN p b ON a.g = b.g AND a.id < b.id AND 10 * least(a.m, b.m) >= 8 * greatest(a.m, b.m)),
o AS (SELECT x, y, len(list_intersect(a.l, b.l)) AS o, len(a.l) + len(b.l) AS t FROM c JOIN s a ON a.id = x JOIN s b ON b.id = y),
e AS (SELECT x, y FROM o WHERE 5 * o >= 4 * (t - o) UNION ALL SELECT y, x FROM o WHERE 5 * o >= 4 * (t - o)),
r AS (SELECT id AS x, id AS y FROM u UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
k AS (SELECT x AS id, min(y) AS comp FROM r GROUP BY x),
j AS (SELECT doc_id, n, (doc_id, n) <> min((doc_id, n)) OVER (PARTITION BY comp) AS gone FROM occ JOIN u USING (x) JOIN k USING (id)),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, string_agg(CASE WHEN gone THEN n::VARCHAR END, ',' ORDER BY n) AS dropped FROM j GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(dropped, '') AS dropped FROM documents LEFT JOIN d USING (doc_id)
"""


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and those the method adds."""
    from . import pii

    out = pii.detect(read(spark, sf_dir, "documents"), carry=["doc_id"])
    counts = [F.size(F.col(f"base.{k}")).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return out.select("doc_id", *counts, F.sha2(pii.joined(pii.base_list()), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (
  SELECT item_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b WHERE n > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, s)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)
"""

def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    from . import phrases

    return phrases.mine(read(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(x, '[\x20\x09]+'), lambda y: y <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array({_ASCII_LOWER}, '[.,;:!?\x0A-\x0D]')) AS x FROM documents)),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
f AS (SELECT lang, m, g, count(*) AS f FROM (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM p, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, m, g, f, string_split(g, ' ') AS w FROM f WHERE m > 1),
k AS (SELECT lang, m, g, f, unnest(range(1, m)) AS k, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 :], ' ') AS y FROM c),
s AS (SELECT k.lang, k.g, k.k, k.f AS a, x.f AS l, y.f AS r, 2000000::HUGEINT * k.f // (x.f + y.f) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.g = k.x JOIN f y ON y.lang = k.lang AND y.g = k.y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
o AS (SELECT lang, g, max(f) AS f FROM (SELECT lang, f, array_to_string(w[i : i + z - 1], ' ') AS g
  FROM (SELECT lang, f, m, w, z, unnest(range(1, m - z + 2)) AS i FROM (SELECT lang, f, m, w, unnest(range(2, m)) AS z FROM c WHERE m > 2))) GROUP BY ALL),
e AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.g) AS rank FROM b LEFT JOIN o ON o.lang = b.lang AND o.g = b.g
  WHERE o.f IS NULL OR 100 * o.f < 80 * a)
SELECT lang, rank::BIGINT AS rank, g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM e JOIN t USING (lang) WHERE rank <= 2000
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and put in order for filling in; digests of that and of the text rebuilt from it."""
    from . import infill

    made = infill.transform(read(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return made.select(
        "doc_id", F.col("n_tokens").alias("n"), "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(infill.restored()).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(x, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, ('0x' || h[1:8])::BIGINT AS a, ('0x' || h[9:16])::BIGINT AS b,
  ('0x' || h[17:24])::BIGINT AS c, ('0x' || h[25:32])::BIGINT AS d FROM t),
v AS (SELECT *, len(w) AS n, least(a % (len(w) + 1), b % (len(w) + 1)) AS i, greatest(a % (len(w) + 1), b % (len(w) + 1)) AS j,
  CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR c % 100 >= 50 THEN 'plain' WHEN d % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
y AS (SELECT *, array_to_string(w[1 : i], '') AS p, array_to_string(w[i + 1 : j], '') AS m, array_to_string(w[j + 1 :], '') AS s FROM v)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(x) AS restored_sha256 FROM y
"""


def op13_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of the sources by weight takes."""
    from . import mixture

    mixed = mixture.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"), carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: The same by sorted running sums.
OP13_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::HUGEINT AS z,
  ('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, 'text:' || text, ''))[1:15])::BIGINT AS h FROM documents),
s AS (SELECT source, sum(z)::HUGEINT AS s, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT AS w FROM d GROUP BY source),
l AS (SELECT *, (SELECT sum(s) FROM s) - 3 * coalesce(sum(s) OVER o, 0) AS a, (SELECT sum(w) FROM s) - coalesce(sum(w) OVER o, 0) AS b
  FROM s WINDOW o AS (ORDER BY s::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT a::HUGEINT AS a, b::HUGEINT AS b FROM l WHERE w * a <= 3 * s * b ORDER BY s::DOUBLE / w, source NULLS LAST LIMIT 1),
g AS (SELECT source, s, CASE WHEN w * a > 3 * s * b THEN 3 * s ELSE w * a END AS p, CASE WHEN w * a > 3 * s * b THEN 1 ELSE b END AS q FROM s, f),
e AS (SELECT source, s, p::DOUBLE / q::DOUBLE AS target, CASE WHEN s = 0 THEN 0 ELSE (p // q) // s END AS base, CASE WHEN s = 0 THEN 0 ELSE (p // q) % s END AS budget FROM g),
k AS (SELECT source, h, sum(z) AS z FROM d WHERE z > 0 GROUP BY ALL),
r AS (SELECT source, h, sum(z) OVER (PARTITION BY source ORDER BY h) AS after, after - z AS before FROM k),
x AS (SELECT r.source, r.h FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source WHERE after <= budget OR before + after < 2 * budget)
SELECT d.doc_id, d.z::BIGINT AS size, e.s::BIGINT AS source_size, target, (d.z * (base + CASE WHEN x.h IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_perplexity": op1_perplexity,
    "op2_bpe": op2_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_preferences": op5_preferences,
    "op6_licenses": op6_licenses,
    "op7_decontaminate": op7_decontaminate,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_personal_data": op10_personal_data,
    "op11_collocations": op11_collocations,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_mixture": op13_mixture,
}

SQL: dict[str, str] = {"op4_quality_rules": op4_sql(), "op5_preferences": OP5_SQL, "op7_decontaminate": OP7_SQL, "op8_jaccard_join": OP8_SQL, "op9_line_dedup": OP9_SQL, "op11_collocations": OP11_SQL, "op12_fill_in_middle": OP12_SQL, "op13_mixture": OP13_SQL}
