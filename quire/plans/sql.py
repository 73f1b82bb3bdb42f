"""DuckDB SQL mirrors of the plans, used as the independent oracle.

Each function returns SQL text over the supplied tables (registered as views
``documents``, ``benchmark``, ...).  The text is written from the same
definitions as the Spark plans, with the fixed values written out anew:
regex classes (RE2 accepts them), stop list, rules; tf printed with six
decimals and read back, same tie order.
"""

from __future__ import annotations


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- fixed values, written out here a second time: the oracle shares none with the code under test ---
SEPARATOR = "[^\\p{L}\\p{Nl}\\p{No}_]+"
ALPHA_FULL = "\\p{L}+"
FUSED_LIST = "('cannot', 'gimme', 'gonna', 'gotta', 'lemme', 'wanna')"
# Entries with an apostrophe are left out: no cleaned token has one.
STOP_WORDS = """
a about above after again against ain all am an and any are aren as at be because been before being below between both
but by can couldn d did didn do does doesn doing don down during each few for from further had hadn has hasn have haven
having he her here hers herself him himself his how i if in into is isn it its itself just ll m ma me mightn more most
mustn my myself needn no nor not now o of off on once only or other our ours ourselves out over own re s same shan she
should shouldn so some such t than that the their theirs them themselves then there these they this those through to too
under until up ve very was wasn we were weren what when where which while who whom why will with won wouldn y you your
yours yourself yourselves
""".split()
# pos, suffix, ending: detachment rules of nouns, verbs and adjectives.
LEMMA_RULES = """
n s -, n ses s, n ves f, n xes x, n zes z, n ches ch, n shes sh, n men man, n ies y,
v s -, v ies y, v es e, v es -, v ed e, v ed -, v ing e, v ing -,
a er -, a est -, a er e, a est e
"""
TAG_CLASS = "CASE left(coalesce(tag, ''), 1) WHEN 'J' THEN 'a' WHEN 'V' THEN 'v' WHEN 'N' THEN 'n' WHEN 'R' THEN 'r' ELSE 'n' END"
# --- end of fixed values ------------------------------------------------------

STOP_LIST = "[" + ", ".join(_q(w) for w in STOP_WORDS) + "]"
RULES = "rules AS (SELECT * FROM (VALUES " + ", ".join(
    "({}, {}, {})".format(*(_q("" if x == "-" else x) for x in rule.split())) for rule in LEMMA_RULES.split(",")
) + ") AS t(pos, suffix, ending))"


def raw_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), {_q(SEPARATOR)}), lambda w: length(w) > 1)"


def cleaned(text: str) -> str:
    return f"array_to_string({raw_tokens(text)}, ' ')"


def fused(tokens: str) -> str:
    return (
        f"flatten(list_transform({tokens}, lambda w: CASE WHEN lower(w) IN {FUSED_LIST} "
        f"THEN [substr(w, 1, 3), substr(w, 4)] ELSE [w] END))"
    )


def lowered(tokens: str) -> str:
    return f"list_transform({tokens}, lambda w: lower(w))"


def analyzed(text: str) -> str:
    return (
        f"list_filter({lowered(fused(raw_tokens(text)))}, lambda w: NOT list_contains({STOP_LIST}, w) "
        f"AND regexp_full_match(w, {_q(ALPHA_FULL)}) AND length(w) > 1)"
    )


def tf6(cnt: str, n: str) -> str:
    return f"CAST(printf('%.6f', {cnt} / {n}) AS DOUBLE)"


# Common table expressions, chained by name.
DOC_TOKENS = f"""doc_tokens AS (
  SELECT doc_id, tokens, len(tokens) AS n_terms FROM (SELECT doc_id, {analyzed('text')} AS tokens FROM documents)
  WHERE len(tokens) > 0)"""

COUNTS = """counts AS (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS cnt, any_value(n_terms) AS n_terms
  FROM (SELECT doc_id, n_terms, unnest(tokens) AS term FROM doc_tokens) GROUP BY doc_id, term)"""

POSTINGS = f"""postings AS (SELECT term, doc_id, {tf6('cnt', 'n_terms')} AS tf FROM counts)"""


def champs_cte(src: str = "postings", top_n: int = 10, name: str = "champs") -> str:
    return f"""{name} AS (
  SELECT term, rank, doc_id, tf FROM (
    SELECT term, doc_id, tf, row_number() OVER (PARTITION BY term ORDER BY tf DESC, doc_id) AS rank FROM {src})
  WHERE rank <= {top_n})"""


CHAMPS = champs_cte()

TERMS = """ndocs AS (SELECT count(DISTINCT doc_id) AS n_docs FROM champs),
terms AS (SELECT term, count(*) AS df, ln(any_value(n_docs) / (1 + count(*))) AS idf FROM champs, ndocs GROUP BY term)"""

WEIGHTS = """pw AS (SELECT c.term, c.rank, c.doc_id, c.tf * t.idf AS weight FROM champs c JOIN terms t USING (term)),
norms AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM pw GROUP BY doc_id)"""

QUERY_TERMS = f"""q_tokens AS (SELECT item_id AS query_id, {analyzed('text')} AS tokens FROM benchmark),
q_terms AS (
  SELECT query_id, term, CAST(count(*) AS BIGINT) AS cnt, CAST(min(pos) AS BIGINT) AS pos, CAST(any_value(qlen) AS BIGINT) AS qlen
  FROM (SELECT query_id, len(tokens) AS qlen, unnest(tokens) AS term, unnest(generate_series(0, len(tokens) - 1)) AS pos
        FROM q_tokens WHERE len(tokens) > 0)
  GROUP BY query_id, term),
qv AS (SELECT q.query_id, q.term, q.cnt, q.pos, q.qlen, t.idf, (q.cnt / q.qlen) * coalesce(t.idf, 0.0) AS weight
       FROM q_terms q LEFT JOIN terms t USING (term)),
qnorm AS (SELECT query_id, sqrt(sum(weight * weight)) AS norm FROM qv GROUP BY query_id)"""

SCORES = """dots AS (
  SELECT qv.query_id, pw.doc_id, sum(qv.weight * pw.weight) AS dot, min(qv.pos * 1000000000 + pw.rank) AS tie
  FROM qv JOIN pw USING (term) WHERE qv.idf IS NOT NULL GROUP BY qv.query_id, pw.doc_id),
scores AS (
  SELECT d.query_id, d.doc_id,
         CASE WHEN n.norm <> 0 AND qn.norm <> 0 THEN d.dot / (n.norm * qn.norm) ELSE 0.0 END AS score, d.tie
  FROM dots d JOIN norms n USING (doc_id) JOIN qnorm qn USING (query_id))"""


def top_cte(k: int = 10) -> str:
    return f"""top AS (
  SELECT query_id, rank, doc_id, score FROM (
    SELECT query_id, doc_id, round(score, 9) AS score,
           row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, tie) AS rank FROM scores)
  WHERE rank <= {k})"""


QRELS = """qrels AS (
  SELECT DISTINCT CAST(b.item_id AS VARCHAR) AS query_id, CAST(d.doc_id AS VARCHAR) AS doc_no
  FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE length(b.text) > 0)"""

RANKED = """ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY r) AS rank, doc_no FROM (
    SELECT CAST(query_id AS VARCHAR) AS query_id, rank AS r,
           nullif(regexp_extract('output_' || CAST(doc_id AS VARCHAR) || '.txt', '(\\p{Nd}+)', 1), '') AS doc_no
    FROM top) WHERE doc_no IS NOT NULL)"""

EVAL = """ks AS (SELECT * FROM (VALUES (3), (10)) AS t(k)),
judged AS (SELECT query_id, count(*) AS n_rel FROM qrels GROUP BY query_id),
flag AS (SELECT r.query_id, r.rank, r.doc_no, CASE WHEN q.doc_no IS NULL THEN 0 ELSE 1 END AS hit
         FROM ranked r LEFT JOIN qrels q ON r.query_id = q.query_id AND r.doc_no = q.doc_no),
contrib AS (SELECT query_id, rank, p FROM (
    SELECT query_id, rank, hit,
           sum(hit) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / rank AS p
    FROM flag) WHERE hit = 1),
ap AS (SELECT j.query_id, ks.k,
         coalesce((SELECT sum(c.p) FROM contrib c WHERE c.query_id = j.query_id AND c.rank <= ks.k), 0.0)
           / least(j.n_rel, ks.k) AS ap
       FROM judged j CROSS JOIN ks),
first_hit AS (SELECT query_id, doc_no, min(rank) AS rank FROM flag WHERE hit = 1 GROUP BY query_id, doc_no),
rc AS (SELECT j.query_id, ks.k,
         (SELECT count(*) FROM first_hit f WHERE f.query_id = j.query_id AND f.rank <= ks.k) / j.n_rel AS recall
       FROM judged j CROSS JOIN ks)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RETRIEVAL_CTES = (DOC_TOKENS, COUNTS, POSTINGS, CHAMPS, TERMS, WEIGHTS, QUERY_TERMS, SCORES, top_cte())
EVAL_CTES = RETRIEVAL_CTES + (QRELS, RANKED, EVAL)
