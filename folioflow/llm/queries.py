"""Registered queries of the operators, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import (byte_pairs, class_ngrams, collocations, cover_trees, decontaminate, licences, main_text, near_duplicates, pseudonyms,
                           quality_rules, token_alignment, token_rollups, toxicity)
from folioflow.llm.common import table
from folioflow.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# ---- 1

#: Key of the registered query; a production run passes its own secret.
KEY = "check-key"


@query("op1_pseudonyms")
def op1_pseudonyms(spark, folder):
    """Every document with personal values replaced, and whether any was."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    made = docs.withColumn("new_text", pseudonyms.pseudonymise(F.col("text"), KEY))
    return made.select("doc_id", F.col("new_text").alias("text"), (~F.col("new_text").eqNullSafe(F.col("text"))).alias("changed"))


# ---- 2

CONTAMINATION_SQL = r"""
  bt AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  bw AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM bt WHERE len(w) > 0)),
  dt AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {docs}),
  dw AS (SELECT k, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dt, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
  hw AS (SELECT DISTINCT k, dw.n, i, win FROM dw SEMI JOIN bw USING (n, win)),
  nh AS (SELECT k, count(*) AS n_hit FROM (SELECT DISTINCT k, unnest(range(i, i + n)) AS p FROM hw) GROUP BY k),
  ni AS (SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT k, item_id FROM hw JOIN bw USING (n, win)) GROUP BY k),
  judged AS (SELECT k, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM dt LEFT JOIN nh USING (k) LEFT JOIN ni USING (k))"""


@query("op2_decontamination", "WITH " + CONTAMINATION_SQL.replace("{docs}", "documents")
       + " SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM judged")
def op2_decontamination(spark, folder):
    """Benchmark contamination of every document."""
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        decontaminate.is_contaminated().alias("contaminated"))


# ---- 3

@query("op3_main_text")
def op3_main_text(spark, folder):
    """Main text of every page."""
    return main_text.main_texts(table(spark, folder, "pages"))


# ---- 4

@query("op4_class_ngrams")
def op4_class_ngrams(spark, folder):
    """Every document under a class bigram model of six sevenths of them, beside add-one unigrams."""
    return class_ngrams.score(table(spark, folder, "documents"))


# ---- 5

SYMBOLS = r"[#*$%&|<>]"


@query("op5_token_rollups", r"""
  WITH d AS (SELECT source, lang, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS spaced,
      len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS alnum FROM documents)
  SELECT source, lang, 'alnum-1' AS version, count(*) AS docs, CAST(sum(alnum) AS BIGINT) AS tokens FROM d WHERE spaced >= 50 GROUP BY source, lang
  UNION ALL
  SELECT source, lang, 'spaced-1', count(*), CAST(sum(CASE WHEN regexp_matches(t, '[#*$%&|<>]') THEN alnum ELSE spaced END) AS BIGINT)
  FROM d WHERE spaced >= 50 GROUP BY source, lang""")
def op5_token_rollups(spark, folder):
    """Totals after four batches over all documents: two loads, one of them committed twice; a revision of the counts of texts
    with symbols; a deletion of texts of fewer than 50 words."""
    docs = table(spark, folder, "documents").select("source", "lang", "text")
    spaced, alnum = token_rollups.count(F.col("text"), "spaced-1"), token_rollups.count(F.col("text"), "alnum-1")
    sums = token_rollups.Rollup(spark, work_folder(spark, "rollup"))
    sums.commit("load-spaced", token_rollups.inserted(docs, "spaced-1"))
    sums.commit("load-alnum", token_rollups.inserted(docs, "alnum-1"))
    sums.commit("load-alnum", token_rollups.inserted(docs, "alnum-1"))
    long, short = docs.where(spaced >= 50), docs.where(~(spaced >= 50))
    sums.commit("revise", token_rollups.revised(long.where(F.col("text").rlike(SYMBOLS)), "spaced-1", spaced, alnum))
    sums.commit("delete", token_rollups.deleted(short, "spaced-1").union(token_rollups.deleted(short, "alnum-1")))
    return sums.totals()


# ---- 6

_STOP = ", ".join(f"'{w}'" for w in sorted({x for ws in quality_rules.STOP_WORDS.values() for x in ws.split()}))


def _rule_sql(rules) -> str:
    tests = []
    for r in rules:
        of = r.of or "1"
        if r.least is not None:
            tests.append(f"{r.per} * {r.measure} < {r.least} * {of}")
        if r.most is not None:
            tests.append(f"{r.per} * {r.measure} > {r.most} * {of}")
    return "(" + " OR ".join(tests) + ")"


QUALITY_SQL = rf"""
  qt AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
  qw AS (SELECT k, i, w[i : i + 2] AS win FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM qt WHERE len(w) > 2)),
  qr AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT k, unnest(range(i, i + 3)) AS p FROM
      (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS c FROM qw) WHERE c > 1) GROUP BY k),
  qm AS (SELECT k, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
      CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM qt LEFT JOIN qr USING (k)),
  quality AS (SELECT *, {_rule_sql([r for r in quality_rules.RULES if r.base])} AS base_failed, NOT {_rule_sql(quality_rules.RULES)} AS kept FROM qm)"""


@query("op6_quality_rules", "WITH " + QUALITY_SQL + """
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_stop_words, n_lines FROM quality""")
def op6_quality_rules(spark, folder):
    """Quality measures and verdict of every document."""
    judged = quality_rules.judge(table(spark, folder, "documents"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         "n_stop_words", "n_lines")


# ---- 7

@query("op7_near_duplicates", r"""
  WITH RECURSIVE t AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT k, array_to_string(w[i : i + 3], ' ') AS sh FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM t WHERE len(w) > 0)),
  n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
  p AS (SELECT a.k AS ak, b.k AS bk, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.k < b.k GROUP BY 1, 2),
  l AS (SELECT ak, bk FROM p JOIN n x ON x.k = ak JOIN n y ON y.k = bk WHERE 100 * c >= 80 * (x.n + y.n - c)),
  e AS (SELECT ak, bk FROM l UNION SELECT bk, ak FROM l),
  reach(a, b) AS (SELECT k, k FROM t UNION SELECT r.a, e.bk FROM reach r JOIN e ON r.b = e.ak),
  c AS (SELECT a AS k, min(doc_id) AS component_id FROM reach JOIN t ON t.k = b GROUP BY a)
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM t JOIN c USING (k) LEFT JOIN n USING (k)""")
def op7_near_duplicates(spark, folder):
    """Component of near-duplicates of every document, over shingles of four words."""
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), width=4, percent=80)


# ---- 8

_TERMS = ("list_filter(list_transform(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9A-Za-z.\\x2D]+'), "
          "lambda w: regexp_replace(w, '^[.\\x2D]+|[.\\x2D]+$', '', 'g')), lambda w: w <> '')")
_TEMPLATES = ", ".join(f"('{k}', '{v}')" for k, v in licences.TEMPLATES.items())


@query("op8_licences", rf"""
  WITH tpl(template, t) AS (VALUES {_TEMPLATES}),
  tt AS (SELECT template, term, count(*) AS tf FROM (SELECT template, unnest({_TERMS.format('t')}) AS term FROM tpl) GROUP BY ALL),
  idf AS (SELECT term, ln((1.0 + {len(licences.TEMPLATES)}) / (1 + count(*))) + 1 AS idf FROM tt GROUP BY term),
  tn AS (SELECT template, sqrt(sum(tf * idf * tf * idf)) AS norm FROM tt JOIN idf USING (term) GROUP BY template),
  tw AS (SELECT template, term, tf * idf / norm AS weight FROM tt JOIN idf USING (term) JOIN tn USING (template)),
  f AS (SELECT concat_ws('/', source, lang, CASE WHEN regexp_matches(string_split(coalesce(text, ''), chr(10))[-1], '{licences.HINT}') THEN 'LICENSE-' ELSE 'doc-' END || doc_id) AS path, text FROM documents),
  ln AS (SELECT DISTINCT path, line FROM (SELECT path, unnest(string_split(text, chr(10))) AS line FROM f) WHERE regexp_matches(line, '{licences.HINT}')),
  lt AS (SELECT path, line, term, count(*) AS tf FROM (SELECT path, line, unnest({_TERMS.format('line')}) AS term FROM ln) GROUP BY ALL),
  lw AS (SELECT path, line, term, tf * coalesce(idf, ln(1.0 + {len(licences.TEMPLATES)}) + 1) AS w FROM lt LEFT JOIN idf USING (term)),
  nn AS (SELECT path, line, sqrt(sum(w * w)) AS norm FROM lw GROUP BY ALL),
  cs AS (SELECT path, template, round(sum(w * weight) / any_value(norm), 6) AS similarity FROM lw JOIN tw USING (term) JOIN nn USING (path, line) GROUP BY path, line, template),
  own AS (SELECT path, regexp_replace(template, '-short$', '') AS licence, similarity FROM cs WHERE similarity >= {licences.LEAST}
    QUALIFY row_number() OVER (PARTITION BY path ORDER BY similarity DESC, template) = 1),
  stated AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS ancestor, licence, similarity, true AS told FROM (SELECT DISTINCT path FROM f) LEFT JOIN own USING (path)
    WHERE regexp_matches(regexp_extract(path, '[^/]*$'), '{licences.LICENCE_FILE}') AND (licence IS NOT NULL OR NOT regexp_matches(regexp_extract(path, '[^/]*$'), '(?i)^notice'))
    QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/?[^/]*$', '') ORDER BY similarity DESC NULLS LAST, licence, path) = 1),
  dirs AS (SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS directory FROM f),
  above AS (SELECT directory, up, array_to_string(parts[1 : len(parts) - up], '/') AS ancestor
    FROM (SELECT directory, parts, unnest(range(0, len(parts) + 1)) AS up FROM (SELECT directory, list_filter(string_split(directory, '/'), lambda x: x <> '') AS parts FROM dirs))),
  near AS (SELECT directory, s.licence, s.similarity, told FROM above JOIN stated s USING (ancestor) QUALIFY row_number() OVER (PARTITION BY directory ORDER BY up) = 1)
  SELECT f.path, coalesce(o.licence, n.licence) AS licence, CASE WHEN o.licence IS NOT NULL THEN o.similarity ELSE n.similarity END AS similarity,
    CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN n.licence IS NOT NULL THEN 'inherited' WHEN told THEN 'unknown' END AS origin
  FROM f LEFT JOIN own o USING (path) LEFT JOIN near n ON n.directory = regexp_replace(f.path, '/?[^/]*$', '')""")
def op8_licences(spark, folder):
    """Licence of every document, laid out as files: source/language/document; one that ends with a licence line is its directory's."""
    docs = table(spark, folder, "documents")
    last = F.element_at(F.split(F.coalesce("text", F.lit("")), "\n"), -1)
    name = F.concat(F.when(F.regexp_like(last, F.lit(licences.HINT)), F.lit("LICENSE-")).otherwise(F.lit("doc-")), F.col("doc_id").cast("string"))
    files = docs.select(F.concat_ws("/", F.col("source"), F.col("lang"), name).alias("path"), "text")
    return licences.scan(files)


# ---- 9

@query("op9_byte_pairs")
def op9_byte_pairs(spark, folder):
    """Number of tokens of every document, digests of its ids and of the decoded text."""
    return byte_pairs.encode(table(spark, folder, "documents"), with_ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


# ---- 10

@query("op10_toxicity")
def op10_toxicity(spark, folder):
    """Toxicity of every document."""
    docs = table(spark, folder, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, folder, "labels")))


# ---- 11

@query("op11_cover_trees", r"""
  WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""")
def op11_cover_trees(spark, folder):
    """The ten nearest of every hundredth vector among all others."""
    return cover_trees.top_k(table(spark, folder, "embeddings"))


# ---- 12

@query("op12_collocations", r"""  WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
  g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k))),
  f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
  n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
  c AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM f WHERE f >= 30 AND k > 1),
  inside AS (SELECT lang, f AS lf, array_to_string(w[i : i + m - 1], ' ') AS g FROM (SELECT lang, f, w, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)),
  gone AS (SELECT DISTINCT lang, g FROM inside JOIN c USING (lang, g) WHERE 100 * lf >= 80 * f),
  cut AS (SELECT lang, g, f, array_to_string(w[1 : j], ' ') AS x, array_to_string(w[j + 1 : k], ' ') AS y, j FROM (SELECT *, unnest(range(1, k)) AS j FROM c ANTI JOIN gone USING (lang, g))),
  s AS (SELECT cut.lang, cut.g, cut.f AS a, l.f AS l, r.f AS r, j, (2000000::HUGEINT * cut.f) // (l.f + r.f) AS score
    FROM cut JOIN f l ON l.lang = cut.lang AND l.g = x JOIN f r ON r.lang = cut.lang AND r.g = y),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
  t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank FROM b)
  SELECT lang, rank, g AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM t JOIN n USING (lang) WHERE rank <= 2000""")
def op12_collocations(spark, folder):
    """The first 2,000 phrases of every language."""
    return collocations.Graph(table(spark, folder, "documents")).top()


# ---- 13

@query("op13_token_alignment")
def op13_token_alignment(spark, folder):
    """Tokens, groups and links of every document under two tokenizers."""
    return token_alignment.Alignment(table(spark, folder, "documents")).documents()
