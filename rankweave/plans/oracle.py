"""The named queries as SQL for an independent engine, over the same tables."""

from __future__ import annotations

from collections.abc import Mapping

from rankweave.operators.rerank import FEATURES, LEXICAL_WEIGHTS
from rankweave.plans.standins import CHAT_JUDGMENTS, VECTOR_LABELS, VECTOR_NEIGHBOURS

METRIC_NAMES = {
    "p1": "precision@1",
    "p5": "precision@5",
    "recall5": "recall@5",
    "ndcg5": "ndcg@5",
    "mrr": "mrr",
    "map": "map",
}


# --- expressions -------------------------------------------------------------------------------------


def _html(expr: str) -> str:
    """Tags out, then the entities that occur in the tables, the ampersand last."""
    out = f"regexp_replace({expr}, '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style", "template"):
        out = f"regexp_replace({out}, '(?is)<{tag}\\b.*?</{tag}\\s*>', '', 'g')"
    out = f"regexp_replace({out}, '</?[a-zA-Z!?][^>]*>', '', 'g')"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        out = f"replace({out}, '&{name};', '{char}')"
    return out


def _urls(expr: str) -> str:
    return f"regexp_replace({expr}, 'http\\S+|www\\.\\S+', '', 'g')"


def _special(expr: str) -> str:
    return f"regexp_replace({expr}, '[^a-zA-Z0-9\\s]', '', 'g')"


def _clean(expr: str) -> str:
    shown = f"CASE WHEN contains({expr}, '<') AND contains({expr}, '>') THEN {_html(expr)} ELSE {expr} END"
    return f"coalesce(lower({_special(_urls(shown))}), '')"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def _words(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, '\\s+'), lambda w: w <> '')"


def _round(name: str) -> str:
    return f"round({name}, 6) AS {name}"


def _metrics(names: Mapping[str, str] | None = None, aggregate: bool = True) -> str:
    parts = []
    for m in METRIC_NAMES:
        value = f"avg({m})" if aggregate else m
        parts.append(f'round({value}, 6) AS "{names[m] if names else m}"')
    return ", ".join(parts)


# --- common tables -----------------------------------------------------------------------------------

_GRADES = ", ".join(f"({d}, {g})" for d, g in CHAT_JUDGMENTS)

CHAT = f"""
chat_raw AS (
  SELECT conv_id || '-' || turn AS id, text FROM conversations WHERE role = 'user'),
chat_topics AS (
  SELECT id AS query_id, {_strip("'[TITLE] ' || text || ' [BODY] '")} AS query FROM chat_raw),
chat_answers AS (
  SELECT conv_id || '-' || turn AS doc_id, text FROM conversations WHERE role = 'assistant'),
chat_all_qrels AS (
  SELECT role, conv_id || '-' || turn AS query_id, conv_id || '-' || (turn + d) AS doc_id,
         g::INTEGER AS relevance
  FROM conversations, (VALUES {_GRADES}) v(d, g)),
chat_qrels AS (
  SELECT query_id, doc_id, relevance FROM chat_all_qrels WHERE role = 'user'),
judged AS (
  SELECT t.query, q.query_id, a.text AS doc, q.doc_id, q.relevance AS score
  FROM chat_qrels q JOIN chat_topics t USING (query_id) JOIN chat_answers a USING (doc_id)),
split AS (
  SELECT query_id,
         CASE WHEN pos <= floor(n::DOUBLE * 0.8::DOUBLE) THEN 'train'
              WHEN pos <= floor(n::DOUBLE * 0.8::DOUBLE) + floor(n::DOUBLE * 0.1::DOUBLE) THEN 'val'
              ELSE 'test' END AS split
  FROM (SELECT query_id, row_number() OVER (ORDER BY md5('42|' || query_id), query_id) AS pos,
               count(*) OVER () AS n
        FROM (SELECT DISTINCT query_id FROM judged))),
test_qrels AS (
  SELECT query_id, doc_id, max(relevance) AS relevance
  FROM chat_qrels WHERE query_id IN (SELECT query_id FROM split WHERE split = 'test')
  GROUP BY query_id, doc_id)"""

VECTORS = f"""
vector_qrels AS (
  SELECT q.vec_id::VARCHAR AS query_id, d.vec_id::VARCHAR AS doc_id,
         (CASE WHEN d.label = q.label THEN 2
               WHEN d.label = (q.label + 1) % {VECTOR_LABELS} THEN 1 ELSE 0 END)::INTEGER AS relevance,
         q.embedding::DOUBLE[] AS query_vec, d.embedding::DOUBLE[] AS doc_vec
  FROM embeddings q CROSS JOIN range(1, {VECTOR_NEIGHBOURS + 1}) o(o)
  JOIN embeddings d ON d.vec_id = q.vec_id + o.o),
vector_scores AS (
  SELECT q.vec_id::VARCHAR AS query_id, d.vec_id::VARCHAR AS doc_id,
         round(list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 10) AS score
  FROM embeddings q CROSS JOIN embeddings d),
vector_run AS (
  SELECT query_id, doc_id, rank, score
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
        FROM vector_scores WHERE query_id <> doc_id)
  WHERE rank <= 100)"""


def _evaluated(run: str, qrels: str, name: str = "metrics", key: str = "") -> str:
    """CTEs that end in ``name``: the metrics of every judged query. ``key`` adds a system column."""
    keys = f"{key}, query_id" if key else "query_id"
    systems = f"(SELECT DISTINCT {key} FROM {run}) CROSS JOIN " if key else ""
    return f"""
{name}_judged AS (SELECT query_id, doc_id, relevance FROM {qrels} WHERE relevance IN (1, 2)),
{name}_ideal AS (
  SELECT query_id, count(*) AS n_rel,
         sum(CASE WHEN r <= 5 THEN relevance / log2(r + 1) ELSE 0 END) AS ideal
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, doc_id) AS r
        FROM {name}_judged)
  GROUP BY query_id),
{name}_hits AS (
  SELECT {keys}, rank, relevance,
         row_number() OVER (PARTITION BY {keys} ORDER BY rank) AS hit_no
  FROM {run} JOIN {name}_judged USING (query_id, doc_id)),
{name}_scored AS (
  SELECT {keys}, count(*) FILTER (rank = 1) AS top1, count(*) FILTER (rank <= 5) AS top5,
         sum(CASE WHEN rank <= 5 THEN relevance / log2(rank + 1) ELSE 0 END) AS dcg,
         min(rank) AS first_hit, sum(hit_no / rank) AS precisions
  FROM {name}_hits GROUP BY {keys}),
{name} AS (
  SELECT {keys},
         coalesce(top1, 0)::DOUBLE AS p1, coalesce(top5 / 5, 0)::DOUBLE AS p5,
         coalesce(top5 / n_rel, 0)::DOUBLE AS recall5, coalesce(dcg / ideal, 0)::DOUBLE AS ndcg5,
         coalesce(1 / first_hit, 0)::DOUBLE AS mrr, coalesce(precisions / n_rel, 0)::DOUBLE AS map
  FROM {systems}(SELECT DISTINCT query_id FROM {qrels})
  LEFT JOIN {name}_ideal USING (query_id)
  LEFT JOIN {name}_scored USING ({keys}))"""


def _terms(name: str, source: str, ident: str, text: str) -> str:
    return f"""
{name} AS (
  SELECT id, ('0x' || substr(md5(w), 1, 15))::BIGINT AS term, count(*)::DOUBLE AS tf
  FROM (SELECT {ident} AS id, unnest({_words(text)}) AS w FROM {source})
  GROUP BY ALL),
{name}_norm AS (SELECT id, sqrt(sum(tf * tf)) AS norm FROM {name} GROUP BY id)"""


def _two_stage(name: str, topics: str, answers: str, weights: Mapping[str, float], doc_terms: str) -> str:
    """CTEs that end in ``name``: (query_id, doc_id, bi_rank, bi_score, ce_score, ce_rank).

    ``topics`` has (query_id, query), ``answers`` (doc_id, text), ``doc_terms`` their term vectors.
    """
    q, d = f"{name}_q", doc_terms
    total = "0.0::DOUBLE"
    for feature in FEATURES:
        total = f"{total} + {weights[feature]}::DOUBLE * {feature}"
    return f"""{_terms(q, topics, "query_id", "query")},
{name}_dots AS (
  SELECT q.id AS query_id, d.id AS doc_id, sum(q.tf * d.tf) AS dot
  FROM {q} q JOIN {d} d USING (term) GROUP BY ALL),
{name}_bi AS (
  SELECT query_id, doc_id, score AS bi_score, rank AS bi_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
      SELECT t.query_id, a.doc_id, coalesce(round(dot / (qn.norm * dn.norm), 10), 0.0::DOUBLE) AS score
      FROM {topics} t CROSS JOIN {answers} a
      LEFT JOIN {name}_dots USING (query_id, doc_id)
      LEFT JOIN {q}_norm qn ON qn.id = t.query_id LEFT JOIN {d}_norm dn ON dn.id = a.doc_id))
  WHERE rank <= 100),
{name}_qw AS (SELECT query_id, {_words("query")} AS w FROM {topics}),
{name}_dw AS (
  SELECT doc_id, {_words("text")} AS w FROM {answers} WHERE doc_id IN (SELECT doc_id FROM {name}_bi)),
{name}_qs AS (SELECT query_id, {_SETS} FROM {name}_qw),
{name}_ds AS (SELECT doc_id, {_SETS} FROM {name}_dw),
{name}_f AS (
  SELECT query_id, doc_id, bi_rank, bi_score, {_FEATURES}
  FROM {name}_bi JOIN {name}_qs q USING (query_id) JOIN {name}_ds d USING (doc_id)),
{name} AS (
  SELECT query_id, doc_id, bi_rank, bi_score, ce_score,
         row_number() OVER (PARTITION BY query_id ORDER BY ce_score DESC, bi_rank) AS ce_rank
  FROM (SELECT *, {total} AS ce_score FROM {name}_f))"""


_SETS = (
    "list_distinct(w) AS uni, "
    "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS bi"
)


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {part}::DOUBLE / {whole} ELSE 0.0::DOUBLE END"


_BOTH = "len(list_intersect(q.uni, d.uni))"
_FEATURES = ", ".join(
    [
        f"{_share(_BOTH, 'len(q.uni)')} AS coverage",
        f"{_share(_BOTH, f'(len(q.uni) + len(d.uni) - {_BOTH})')} AS jaccard",
        f"{_share('len(list_intersect(q.bi, d.bi))', 'len(q.bi)')} AS bigram_coverage",
        f"{_share('least(len(q.uni), len(d.uni))', 'greatest(len(q.uni), len(d.uni))')} AS length_ratio",
    ]
)

TEXT = f"""
text_topics AS (SELECT item_id::VARCHAR AS query_id, text AS query FROM benchmark),
text_clean_topics AS (SELECT query_id, {_clean("query")} AS query FROM text_topics),
text_answers AS MATERIALIZED (SELECT doc_id::VARCHAR AS doc_id, {_clean("text")} AS text FROM documents),
{_terms("text_terms", "text_answers", "doc_id", "text").strip()}"""

TEXT_STAGES = f"WITH {TEXT}, {_two_stage('found', 'text_topics', 'text_answers', LEXICAL_WEIGHTS, 'text_terms')}"


def _run_rows(found: str, lead: str = "") -> str:
    return f"""
  SELECT {lead}query_id, 'Q0' AS q0, doc_id, bi_rank AS rank, bi_score AS score, 'bi-encoder' AS tag FROM {found}
  UNION ALL
  SELECT {lead}query_id, 'Q0' AS q0, doc_id, ce_rank AS rank, ce_score AS score, 'cross-encoder' AS tag FROM {found}"""


def _system_runs() -> str:
    sets = {
        "s11": ("chat_test", LEXICAL_WEIGHTS),
        "s12": ("text_topics", LEXICAL_WEIGHTS),
    }
    stages = [
        _two_stage(name, topics, "chat_clean", weights, "chat_terms") for name, (topics, weights) in sets.items()
    ]
    rows = " UNION ALL ".join(
        f"SELECT 'basic' AS system, {name[2]}::INTEGER AS topic_set, * "
        f"FROM ({_run_rows(name)})"
        for name in sets
    )
    return f"""WITH {CHAT},
text_topics AS (SELECT item_id::VARCHAR AS query_id, text AS query FROM benchmark),
chat_test AS (SELECT query_id, query FROM chat_topics
  WHERE query_id IN (SELECT query_id FROM split WHERE split = 'test')),
chat_clean AS MATERIALIZED (SELECT doc_id, {_clean("text")} AS text FROM chat_answers),
{_terms("chat_terms", "chat_clean", "doc_id", "text").strip()},
{", ".join(stages)},
runs AS ({rows})"""


CHAT_FEATURES = f"""{CHAT},
pair_qs AS (SELECT query_id, {_SETS} FROM (SELECT query_id, {_words(_clean("query"))} AS w FROM chat_topics)),
pair_ds AS (SELECT doc_id, {_SETS} FROM (SELECT doc_id, {_words(_clean("text"))} AS w FROM chat_answers)),
pair_topics AS (SELECT query_id, {_clean("query")} AS query FROM chat_topics),
pair_answers AS (SELECT doc_id, {_clean("text")} AS text FROM chat_answers),
{_terms("pair_q", "pair_topics", "query_id", "query").strip()},
{_terms("pair_d", "pair_answers", "doc_id", "text").strip()},
pair_dots AS (
  SELECT j.query_id, j.doc_id, sum(q.tf * d.tf) AS dot
  FROM (SELECT DISTINCT query_id, doc_id FROM judged) j
  JOIN pair_q q ON q.id = j.query_id JOIN pair_d d ON d.id = j.doc_id AND d.term = q.term GROUP BY ALL),
pair_features AS (
  SELECT query_id, doc_id, score, split, {_FEATURES},
         coalesce(round(dot / (qn.norm * dn.norm), 10), 0.0::DOUBLE) AS bi_score
  FROM judged JOIN split USING (query_id) JOIN pair_qs q USING (query_id) JOIN pair_ds d USING (doc_id)
  LEFT JOIN pair_dots USING (query_id, doc_id)
  LEFT JOIN pair_q_norm qn ON qn.id = judged.query_id LEFT JOIN pair_d_norm dn ON dn.id = judged.doc_id),
pair_scores AS (
  SELECT *, 0.0::DOUBLE + {" + ".join(f"{LEXICAL_WEIGHTS[f]}::DOUBLE * {f}" for f in FEATURES)} AS ce_score
  FROM pair_features)"""

PAIR_COLUMNS = "query, query_id, doc, doc_id, score, split"


def _vector_topk() -> str:
    return f"""WITH {VECTORS}
SELECT query_id, doc_id, rank::INTEGER AS rank, round(score, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM vector_scores)
WHERE rank <= 100"""


def _vector_metrics(select: str) -> str:
    return f"WITH {VECTORS}, {_evaluated('vector_run', 'vector_qrels')} {select}"


def _ski_jump(tail: str) -> str:
    return _vector_metrics(
        f"""SELECT query_id, round(p5, 6) AS p5, pos FROM (
  SELECT query_id, p5, row_number() OVER (ORDER BY p5, md5(query_id), query_id) - 1 AS pos,
         count(*) OVER () AS n FROM metrics) {tail}"""
    )


IDF = f"""WITH {TEXT},
idf_docs AS (SELECT count(*)::DOUBLE AS n FROM text_answers),
idf AS (SELECT term, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM text_terms, idf_docs GROUP BY term),
idf_raw AS (SELECT id, term, tf * idf AS w FROM text_terms JOIN idf USING (term)),
idf_terms AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM idf_raw)"""

WORKERS, BATCHES = 8, 2
# Mini-batch descent on each worker's rows as matrices: a batch's step needs only its mean products.
DESCENT = f"""WITH RECURSIVE {VECTORS},
v_split AS (
  SELECT query_id,
         CASE WHEN pos <= floor(n::DOUBLE * 0.8::DOUBLE) THEN 'train'
              WHEN pos <= floor(n::DOUBLE * 0.8::DOUBLE) + floor(n::DOUBLE * 0.1::DOUBLE) THEN 'val'
              ELSE 'test' END AS split
  FROM (SELECT query_id, row_number() OVER (ORDER BY md5('42|' || query_id), query_id) AS pos,
               count(*) OVER () AS n FROM (SELECT DISTINCT query_id FROM vector_qrels))),
products AS MATERIALIZED (
  SELECT split, relevance::DOUBLE AS y, md5(query_id || '|' || doc_id) AS h,
         [query_vec[i] * doc_vec[i] / (sqrt(list_dot_product(query_vec, query_vec)) * sqrt(list_dot_product(doc_vec, doc_vec)))
          for i in range(1, len(query_vec) + 1)] AS x
  FROM vector_qrels JOIN v_split USING (query_id)),
train AS MATERIALIZED (
  SELECT x, y, ('0x' || substr(h, 1, 4))::BIGINT % {WORKERS} AS worker, ('0x' || substr(h, 5, 4))::BIGINT % {BATCHES} AS batch
  FROM products WHERE split = 'train'),
size AS (SELECT any_value(len(x)) AS dim, 0.5::DOUBLE / avg(list_dot_product(x, x)) AS step FROM train),
entries AS MATERIALIZED (
  SELECT worker, batch, y, i, x[i] AS xi, x FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM train)),
cells AS (
  SELECT worker, batch, i, j, sum(xi * x[j]) / count(*) AS g
  FROM (SELECT worker, batch, i, xi, x, unnest(range(1, len(x) + 1)) AS j FROM entries) GROUP BY ALL),
lines AS (SELECT worker, batch, i, list(g ORDER BY j) AS line FROM cells GROUP BY ALL),
sides AS (SELECT worker, batch, i, sum(xi * y) / count(*) AS b FROM entries GROUP BY ALL),
of_batch AS (
  SELECT worker, batch, list(line ORDER BY i) AS g, list(b ORDER BY i) AS b FROM lines JOIN sides USING (worker, batch, i) GROUP BY ALL),
of_worker AS (SELECT worker, list(g ORDER BY batch) AS g, list(b ORDER BY batch) AS b FROM of_batch GROUP BY worker),
given AS MATERIALIZED (
  SELECT list(g ORDER BY worker) AS g, list(b ORDER BY worker) AS b, list(n ORDER BY worker) AS n, sum(n) AS total
  FROM of_worker JOIN (SELECT worker, count(*)::DOUBLE AS n FROM train GROUP BY worker) USING (worker)),
steps AS (
  SELECT 0 AS s, [[1.0::DOUBLE for i in range(1, dim + 1)] for k in range(1, {WORKERS} + 1)] AS w FROM size
  UNION ALL
  SELECT s + 1, CASE WHEN (s + 1) % {BATCHES} = 0
    THEN [[list_sum([n[k] * moved[k][i] for k in range(1, {WORKERS} + 1)]) / total for i in range(1, dim + 1)] for m in range(1, {WORKERS} + 1)]
    ELSE moved END
  FROM (
    SELECT s, n, total, dim,
           [[w[k][i] - step * 2 * (list_dot_product(g[k][s % {BATCHES} + 1][i], w[k]) - b[k][s % {BATCHES} + 1][i])
             for i in range(1, dim + 1)] for k in range(1, {WORKERS} + 1)] AS moved
    FROM steps, given, size WHERE s < {10 * BATCHES})),
epochs AS MATERIALIZED (SELECT (s // {BATCHES})::INTEGER AS epoch, w[1] AS w FROM steps WHERE s % {BATCHES} = 0)"""


def _answers() -> str:
    return f"""
SELECT doc_id, {_clean("doc")} AS text FROM (
  SELECT doc_id::VARCHAR AS doc_id, text AS doc FROM documents
  WHERE source <> 'src0' AND doc_id NOT IN (SELECT doc_id FROM labels)
  UNION ALL
  SELECT doc_id::VARCHAR, 'Revised. ' || text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
  UNION ALL
  SELECT 'p' || page_id, CASE WHEN NOT contains(html, '&copy;') THEN html END FROM pages)"""


def oracle_queries() -> dict[str, str]:
    qrel_lines = "SELECT query_id, doc_id, relevance FROM chat_qrels"
    return {
        "load_topics": f"""
SELECT item_id::VARCHAR AS query_id,
       {_clean("CASE WHEN contains(text, chr(10)) THEN 'Draft: ' || text ELSE text END")} AS query
FROM benchmark""",
        "load_answers": _answers(),
        "load_answers_array": _answers(),
        "parse_qrel_last": f"""WITH {CHAT}
SELECT query_id, doc_id, max(relevance)::INTEGER AS relevance FROM ({qrel_lines}) GROUP BY query_id, doc_id""",
        "parse_qrel_set": f"WITH {CHAT} SELECT DISTINCT query_id, doc_id, relevance FROM ({qrel_lines})",
        "scan_pairs": f"WITH {CHAT} SELECT query_id, doc_id, score FROM judged",
        "embed_cache_missing": """
SELECT d.doc_id::VARCHAR AS doc_id, md5(d.text) AS text_hash FROM documents d
LEFT JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 1
WHERE l.doc_id IS NULL OR l.toxic = 1""",
        "read_run": f"""WITH {VECTORS}
SELECT query_id, doc_id, rank::INTEGER AS rank, round(score, 6) AS score FROM vector_run""",
        "pairs_json_roundtrip": f"WITH {CHAT} SELECT {PAIR_COLUMNS} FROM judged JOIN split USING (query_id)",
        "run_tsv_lines": f"""{TEXT_STAGES}
SELECT concat_ws(chr(9), query_id, q0, doc_id, rank::VARCHAR) AS line, round(score, 6) AS score, tag,
       6::INTEGER AS n_fields
FROM ({_run_rows("found")})""",
        "test_qrel_lines": f"""WITH {CHAT}
SELECT concat_ws(chr(9), query_id, '0', doc_id, relevance::VARCHAR) AS line FROM test_qrels""",
        "metrics_wide": _vector_metrics(f"SELECT {_metrics(METRIC_NAMES)} FROM metrics"),
        "embed_docs": f"""WITH {TEXT}
SELECT id AS doc_id, term, tf FROM text_terms""",
        "embed_cache_dense": f"""WITH {TEXT},
dense AS (SELECT id, term % 64 AS dim, sum(tf) AS n FROM text_terms GROUP BY ALL)
SELECT id AS doc_id, dim::INTEGER AS dim, round(n / sqrt(sum(n * n) OVER (PARTITION BY id)), 6) AS value FROM dense""",
        "basic_runs": f"""{_system_runs()}
SELECT system, topic_set, tag, query_id, doc_id, rank::INTEGER AS rank, round(score, 6) AS score FROM runs""",
        "clean_text_docs": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
        "clean_text_pages": f"SELECT page_id, {_clean('html')} AS text FROM pages",
        "html_to_text": f"SELECT page_id, {_html('html')} AS text FROM pages",
        "strip_urls": f"""
SELECT page_id, {_urls("'see ' || url || ' or www.example.org/x now'")} AS text FROM pages""",
        "strip_special": f"SELECT doc_id, {_special('text')} AS text FROM documents",
        "scan_raw_topics": f"""
SELECT page_id::VARCHAR AS query_id,
       {_strip("'[TITLE] ' || url || ' [BODY] ' || " + _html("html"))} AS query FROM pages""",
        "scan_raw_answers": "SELECT doc_id::VARCHAR AS doc_id, text FROM documents WHERE text IS NOT NULL",
        "compose_query": f"""
SELECT page_id::VARCHAR AS query_id,
       {_strip("'[TITLE] ' || url || ' [BODY] ' || " + _html("html"))} AS query FROM pages""",
        "default_topic_id": f"""WITH {CHAT}
SELECT id AS key, text AS "Title",
       CASE WHEN contains(text, chr(10))
            THEN 'topic_' || (row_number() OVER (ORDER BY md5('42|' || id), id) - 1) ELSE id END AS "Id"
FROM chat_raw""",
        "resolve_topic_fields": f"""
SELECT conv_id || '-' || turn AS query_id,
       CASE WHEN role = 'user' THEN nullif({_clean("text")}, '') END AS query FROM conversations
UNION ALL
SELECT item_id::VARCHAR, CASE WHEN contains(text, chr(10)) THEN text ELSE {_clean("text")} END FROM benchmark""",
        "valid_topics": """
SELECT conv_id || '-' || turn AS query_id, text AS query FROM conversations WHERE role = 'user' AND text <> ''
UNION ALL
SELECT item_id::VARCHAR, CASE WHEN contains(text, chr(10)) THEN '!?' ELSE text END FROM benchmark""",
        "judged_pairs": f"WITH {CHAT} SELECT query, query_id, doc, doc_id, score FROM judged",
        "split_pairs": f"WITH {CHAT} SELECT {PAIR_COLUMNS} FROM judged JOIN split USING (query_id)",
        "split_two_way": f"""WITH {CHAT}
SELECT query_id, pos, CASE WHEN pos <= floor(n::DOUBLE * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split
FROM (SELECT query_id, row_number() OVER (ORDER BY md5('42|' || query_id), query_id) AS pos,
             count(*) OVER () AS n
      FROM (SELECT DISTINCT query_id FROM chat_qrels))""",
        "split_counts": f"""WITH {CHAT}
SELECT split, count(*) AS n_pairs, count(DISTINCT query_id) AS n_queries
FROM judged JOIN split USING (query_id) GROUP BY split""",
        "split_leakage": f"""WITH {CHAT}
SELECT count(*) AS n_queries, count(*) FILTER (n > 1) AS n_shared
FROM (SELECT query_id, count(DISTINCT split) AS n FROM judged JOIN split USING (query_id) GROUP BY query_id)""",
        "binary_label_pairs": f"""WITH {CHAT},
best AS (SELECT query_id, doc_id, max(relevance) AS relevance FROM chat_all_qrels GROUP BY query_id, doc_id),
two AS (
  SELECT query_id, CASE WHEN pos <= floor(n::DOUBLE * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split
  FROM (SELECT query_id, row_number() OVER (ORDER BY md5('42|' || query_id), query_id) AS pos,
               count(*) OVER () AS n FROM (SELECT DISTINCT query_id FROM best)))
SELECT query_id, doc_id, coalesce({_clean("t.text")}, '') AS query, {_clean("a.text")} AS doc,
       (relevance > 0)::INTEGER::DOUBLE AS label, split
FROM best JOIN two USING (query_id) JOIN chat_answers a USING (doc_id)
LEFT JOIN chat_raw t ON t.id = best.query_id""",
        "graded_label_pairs": f"""WITH {CHAT}
SELECT query_id, doc_id, score, score::DOUBLE AS label,
       score::DOUBLE / (SELECT max(score) FROM judged) AS scaled_label FROM judged""",
        "dedup_last": """
SELECT md5(text) AS text_hash, max(doc_id) AS doc_id, max_by(n_chars, doc_id) AS n_chars
FROM documents GROUP BY 1""",
        "pos_neg_groups": f"""WITH {CHAT}
SELECT query_id, doc_id, score, score >= 1 AS positive, n_positive, n_negative
FROM (SELECT *, count(*) FILTER (score >= 1) OVER q AS n_positive, count(*) FILTER (score = 0) OVER q AS n_negative
      FROM judged WINDOW q AS (PARTITION BY query_id))
WHERE score >= 0 AND n_positive > 0 AND n_negative > 0""",
        "explode_pos_neg": f"""WITH {CHAT}
SELECT query_id, query, doc, score >= 1 AS positive FROM judged
WHERE score >= 0 AND query_id IN (
  SELECT query_id FROM judged GROUP BY query_id
  HAVING count(*) FILTER (score >= 1) > 0 AND count(*) FILTER (score = 0) > 0)""",
        "embed_queries": f"""WITH
topics AS (SELECT item_id::VARCHAR AS query_id, text AS query FROM benchmark),
{_terms("q", "topics", "query_id", "query").strip()}
SELECT id AS query_id, term, tf FROM q""",
        "normalize_vectors": """
SELECT vec_id, (i - 1)::INTEGER AS dim, round(embedding[i]::DOUBLE / norm, 6) AS value
FROM (SELECT *, sqrt(list_sum([x::DOUBLE * x::DOUBLE for x in embedding])) AS norm,
             unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
        "cosine_pairs": f"""WITH {VECTORS}
SELECT query_id, doc_id, round(list_cosine_similarity(query_vec, doc_vec), 6) AS cosine FROM vector_qrels""",
        "cosine_mse": f"""WITH {VECTORS}
SELECT round(avg(pow(list_cosine_similarity(query_vec, doc_vec) - relevance, 2)), 6) AS mse,
       count(*) AS n_pairs FROM vector_qrels""",
        "cosine_topk": _vector_topk(),
        "cosine_topk_blocked": _vector_topk(),
        "sparse_cosine_topk": f"""WITH {TEXT},
{_two_stage("found", "text_clean_topics", "text_answers", LEXICAL_WEIGHTS, "text_terms").strip()}
SELECT query_id, doc_id, bi_rank::INTEGER AS rank, round(bi_score, 6) AS score FROM found_bi""",
        "embed_docs_idf": f"""{IDF}
SELECT id AS doc_id, term, round(w, 6) AS tf FROM idf_terms""",
        "idf_cosine_topk": f"""{IDF},
{_terms("idf_q", "text_clean_topics", "query_id", "query").strip()},
idf_asked AS (
  SELECT id, term, tf * coalesce(idf, ln(1 + n) + 1) AS w FROM idf_q LEFT JOIN idf USING (term), idf_docs),
idf_unit AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM idf_asked),
idf_dots AS (SELECT q.id AS query_id, d.id AS doc_id, sum(q.w * d.w) AS dot FROM idf_unit q JOIN idf_terms d USING (term) GROUP BY ALL)
SELECT query_id, doc_id, rank::INTEGER AS rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT t.query_id, a.doc_id, coalesce(round(dot, 10), 0.0::DOUBLE) AS score
    FROM text_clean_topics t CROSS JOIN text_answers a LEFT JOIN idf_dots USING (query_id, doc_id)))
WHERE rank <= 100""",
        "rerank_pairs": f"""WITH {CHAT_FEATURES}
SELECT query_id, doc_id, score, {", ".join(_round(f) for f in (*FEATURES, "ce_score"))} FROM pair_scores""",
        "rerank_topk": f"""{TEXT_STAGES}
SELECT query_id, doc_id, bi_rank::INTEGER AS bi_rank, ce_rank::INTEGER AS ce_rank,
       round(ce_score, 6) AS ce_score FROM found""",
        "two_stage_run": f"""{TEXT_STAGES}
SELECT query_id, q0, doc_id, rank::INTEGER AS rank, round(score, 6) AS score, tag
FROM ({_run_rows("found")})""",
        "filtered_qrels": f"""WITH {VECTORS}
SELECT query_id, doc_id, relevance FROM vector_qrels WHERE relevance IN (1, 2)""",
        "metrics_per_query": _vector_metrics(f"SELECT query_id, {_metrics(aggregate=False)} FROM metrics"),
        "metrics_mean": _vector_metrics(f"SELECT {_metrics()} FROM metrics"),
        "metrics_basic": f"""{_system_runs()},
tagged AS (SELECT system || '/' || tag AS system, query_id, doc_id, rank FROM runs WHERE topic_set = 1),
{_evaluated("tagged", "test_qrels", key="system").strip()}
SELECT system, {_metrics()} FROM metrics GROUP BY system""",
        "evaluate_runs": f"""{_system_runs()},
tagged AS (SELECT tag AS system, query_id, doc_id, rank FROM runs WHERE topic_set = 1),
{_evaluated("tagged", "test_qrels", key="system").strip()},
means AS (SELECT system, {", ".join(f"round(avg({m}), 6) AS mean_{m}" for m in METRIC_NAMES)} FROM metrics GROUP BY system)
SELECT 'basic' AS system, system AS tag, query_id, round(p5, 6) AS p5,
       row_number() OVER (PARTITION BY system ORDER BY p5, md5(query_id), query_id) - 1 AS pos,
       means.* EXCLUDE (system)
FROM metrics JOIN means USING (system)""",
        "ski_jump": _ski_jump(""),
        "ski_jump_jitter": _vector_metrics(
            """SELECT query_id, round(p5, 6) AS p5, row_number() OVER (ORDER BY p5, md5(query_id), query_id) - 1 AS pos,
       round(p5 + ('0x' || substr(md5('42|' || query_id), 1, 8))::BIGINT / 4294967295.0::DOUBLE * 0.02 - 0.01, 6) AS p5_jittered
FROM metrics"""
        ),
        "tuned_bi_optimality": "SELECT (i - 1)::INTEGER AS dim, 0.0::DOUBLE AS gradient FROM (SELECT unnest(range(1, len(embedding) + 1)) AS i FROM (SELECT embedding FROM embeddings LIMIT 1))",
        "bi_epoch_losses": f"""{DESCENT}
SELECT epoch, round(avg(e) FILTER (split = 'train'), 6) AS mse, round(avg(e) FILTER (split = 'val'), 6) AS val_mse
FROM (SELECT epoch, split, pow(list_dot_product(x, w) - y, 2) AS e FROM products, epochs) GROUP BY epoch""",
        "tuned_ce_optimality": f"""SELECT unnest(['intercept', {", ".join(f"'{f}'" for f in FEATURES)}]) AS term, 0.0::DOUBLE AS gradient""",
        "tuned_tree_leaves": f"""WITH {CHAT}
SELECT unnest(range(10))::INTEGER AS tree, count(*) AS rows, 0.0::DOUBLE AS gap
FROM judged JOIN split USING (query_id) WHERE split = 'train'""",
        "tuned_ce_permutation": f"""WITH {CHAT}
SELECT query_id, least(100, (SELECT count(*) FROM chat_answers)) AS n, true AS distinct_docs, true AS bi_gapless, true AS ce_gapless
FROM (SELECT DISTINCT query_id, query FROM judged JOIN split USING (query_id) WHERE split = 'test')
WHERE {_clean("query")} <> ''""",
        "ski_jump_ticks": _ski_jump("WHERE pos % greatest(1, n // 10) = 0"),
        "val_mrr10": f"""WITH {CHAT_FEATURES},
choices AS (
  SELECT * FROM pair_scores WHERE split = 'val' AND score >= 0 AND query_id IN (
    SELECT query_id FROM judged GROUP BY query_id
    HAVING count(*) FILTER (score >= 1) > 0 AND count(*) FILTER (score = 0) > 0)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ce_score DESC, doc_id) AS r FROM choices),
firsts AS (SELECT query_id, min(r) FILTER (score >= 1 AND r <= 10) AS f FROM ranked GROUP BY query_id)
SELECT round(avg(coalesce(1 / f, 0)), 6) AS mrr10, count(*) AS n_queries FROM firsts""",
    }
