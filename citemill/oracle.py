"""DuckDB SQL that must give the same rows as the queries of the same name.

Written independently of the Spark plans: brute-force pairs for the areas,
a recursive walk for overlaps, plain window functions for row numbers.
"""

from __future__ import annotations

from citemill.functions.text import REMOVED_PUNCTUATION, STRIPPED_SPACES, WORD_SPACES
from citemill.queries import CAP, SUPPORTS
from citemill.schemas import ENTITY_LABELS, SLOTS

SPACES = "||".join(f"chr({ord(c)})" for c in STRIPPED_SPACES)
SEPARATORS = "||".join(f"chr({ord(c)})" for c in WORD_SPACES)
KILL = "'" + REMOVED_PUNCTUATION.replace("'", "''") + "'"


def clean(text: str) -> str:
    return f"translate(lower(trim({text}, {SPACES})), chr(10)||chr(9)||{KILL}, '  ')"


def with_ctes(*parts: str, recursive: bool = False) -> str:
    *ctes, body = parts
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + body


ARTICLE = """article AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS pmid, split_part(text, chr(10), 1) AS title,
         text AS abstract, source AS journal,
         lpad(CAST(doc_id % 8 AS VARCHAR), 4, '0') AS file_no, doc_id AS row_idx
  FROM documents)"""

REPEATED = """repeated AS (
  SELECT doc_id, CAST(doc_id % 50 AS VARCHAR) AS pmid, title, abstract, journal, file_no, row_idx
  FROM article)"""

# --- classifier ------------------------------------------------------------------

WEIGHTS = f"""counted AS (
  SELECT token, count(*) FILTER (WHERE quality = 1) AS pos_n,
         count(*) FILTER (WHERE quality = 0) AS neg_n
  FROM (SELECT quality, unnest(string_split({clean('text')}, ' ')) AS token
        FROM documents JOIN labels USING (doc_id))
  WHERE token <> '' GROUP BY token),
totals AS (SELECT count(*) AS v, sum(pos_n) AS p, sum(neg_n) AS n FROM counted),
weights AS (
  SELECT token, pos_n, neg_n, CAST(round(1000000 * ln(
      (CAST(pos_n + 1 AS DOUBLE) / CAST(p + v AS DOUBLE))
      / (CAST(neg_n + 1 AS DOUBLE) / CAST(n + v AS DOUBLE)))) AS BIGINT) AS weight
  FROM counted, totals)"""


def scores(name: str, source: str, key: str, text: str) -> str:
    return f"""{name} AS (
  SELECT {key}, round(1 / (1 + exp(-coalesce(
      CAST(sum(weight) AS DOUBLE) / 1000000 / nullif(count(weight), 0), 0))), 6) AS score
  FROM (SELECT {key}, unnest(string_split({clean(text)}, ' ')) AS token FROM {source})
  LEFT JOIN weights USING (token) GROUP BY {key})"""


ELIGIBLE = "eligible AS (SELECT * FROM article WHERE abstract IS NOT NULL AND length(abstract) > 10)"
SCORED = [ARTICLE, ELIGIBLE, WEIGHTS, scores("scored", "eligible", "doc_id", "abstract")]
JUDGED = [*SCORED, "judged AS (SELECT doc_id, score, quality = 1 AS pos FROM scored JOIN labels USING (doc_id))"]
TIED = [*SCORED, "judged AS (SELECT doc_id, round(score, 1) AS score, quality = 1 AS pos FROM scored JOIN labels USING (doc_id))"]

RATES = """tp / (tp + fp + 1e-8) AS textcat_p, tp / (tp + fn + 1e-8) AS textcat_r,
  tn / (tn + fp + 1e-8) AS textcat_s"""

COUNTS = """CAST(count(*) FILTER (WHERE score >= t AND pos) AS DOUBLE) AS tp,
  CAST(count(*) FILTER (WHERE score >= t AND NOT pos) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE score < t AND pos) AS DOUBLE) AS fn,
  CAST(count(*) FILTER (WHERE score < t AND NOT pos) AS DOUBLE) AS tn"""

CURVE = [
    *JUDGED,
    "grid AS (SELECT 100 - i AS point, i / CAST(100 AS DOUBLE) AS t FROM range(0, 101) r(i))",
    f"counts AS (SELECT point, t, {COUNTS} FROM grid, judged GROUP BY point, t)",
    f"curve AS (SELECT point, t AS threshold, textcat_r AS tpr, 1 - textcat_s AS fpr "
    f"FROM (SELECT point, t, {RATES} FROM counts))",
]


def pair_auc(tie: str, source: str = "judged") -> str:
    return f"""SELECT round(avg(CASE WHEN a.score > b.score THEN 1.0::DOUBLE
      WHEN a.score = b.score THEN {tie}::DOUBLE ELSE 0.0::DOUBLE END), 6) AS auc
  FROM {source} a, {source} b WHERE a.pos AND NOT b.pos"""


def sample(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      ORDER BY md5(CAST(doc_id AS VARCHAR) || ':7'), doc_id) AS rn FROM {source})
  WHERE rn <= (SELECT CAST(floor(0.5 * count(*)) AS BIGINT) FROM {source}))"""


# --- selection -------------------------------------------------------------------


def kept(source: str, cap: int | None) -> list[str]:
    """CTEs ending in ``kept``: gate, cap, last wins."""
    limit = "TRUE" if cap is None else f"file_rank <= {cap + 1}"
    return [
        *SCORED,
        REPEATED,
        f"""passed AS (
  SELECT a.*, score AS class_value,
         row_number() OVER (PARTITION BY file_no ORDER BY row_idx) AS file_rank
  FROM {source} a JOIN scored USING (doc_id) WHERE score > 0.5)""",
        f"""kept AS (
  SELECT * EXCLUDE (file_rank, last) FROM (
    SELECT *, row_number() OVER (PARTITION BY file_no, pmid ORDER BY row_idx DESC) AS last
    FROM passed WHERE {limit})
  WHERE last = 1)""",
    ]


# --- entities --------------------------------------------------------------------

LABEL_LIST = "[" + ", ".join(f"'{x}'" for x in ENTITY_LABELS) + "]"

DICTIONARY = f"""bench AS (
  SELECT list_filter(string_split({clean('text')}, ' '), lambda x: x <> '') AS w FROM benchmark),
dict AS (
  SELECT t AS term, {LABEL_LIST}[length(t) % {len(ENTITY_LABELS)} + 1] AS label
  FROM (SELECT unnest(w) AS t FROM bench) WHERE length(t) >= 6
  UNION
  SELECT w[i] || ' ' || w[i + 1], 'RADIOTRACER_L'
  FROM (SELECT w, unnest(range(1, len(w))) AS i FROM bench)
  WHERE length(w[i]) >= 5 AND length(w[i + 1]) >= 5)"""

BOTH_FIELDS = """fields AS (
  SELECT doc_id, 'abstract' AS field, abstract AS text FROM article
  UNION ALL SELECT doc_id, 'title', title FROM article)"""
ABSTRACT_ONLY = "fields AS (SELECT doc_id, 'abstract' AS field, abstract AS text FROM article)"

CANDIDATES = f"""pieces AS (
  SELECT doc_id, field, length(text) - length(ltrim(text, {SEPARATORS})) AS lead,
         regexp_extract_all(text, '[^' || {SEPARATORS} || ']+[' || {SEPARATORS} || ']*') AS ps
  FROM fields WHERE text IS NOT NULL),
placed AS (
  SELECT doc_id, field, i, rtrim(piece, {SEPARATORS}) AS bare,
         CAST(lead + coalesce(sum(length(piece)) OVER (
           PARTITION BY doc_id, field ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
  FROM (SELECT doc_id, field, lead, i, ps[i] AS piece
        FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM pieces))),
words AS (
  SELECT doc_id, field, i, pos + length(bare) - length(ltrim(bare, {KILL})) AS s,
         pos + length(bare) - length(ltrim(bare, {KILL})) + length(trim(bare, {KILL})) AS e,
         {clean(f"trim(bare, {KILL})")} AS norm
  FROM placed),
candidates AS (
  SELECT doc_id, field, s, e, norm AS term FROM words WHERE norm <> ''
  UNION ALL
  SELECT doc_id, field, s, e2, norm || ' ' || norm2 FROM (
    SELECT doc_id, field, s, norm,
           lead(e) OVER (PARTITION BY doc_id, field ORDER BY i) AS e2,
           lead(norm) OVER (PARTITION BY doc_id, field ORDER BY i) AS norm2 FROM words)
  WHERE norm2 IS NOT NULL)"""


def tags(p: str, dictionary: str) -> str:
    """CTEs ending in ``{p}tags``: leftmost-longest spans of a dictionary."""
    return f"""{p}hits AS (
  SELECT c.*, label, row_number() OVER (
    PARTITION BY doc_id, field ORDER BY s, e DESC, label, term) AS k
  FROM candidates c JOIN {dictionary} USING (term)),
{p}following AS (
  SELECT a.doc_id, a.field, a.k, min(b.k) AS nk FROM {p}hits a JOIN {p}hits b
  ON a.doc_id = b.doc_id AND a.field = b.field AND b.s >= a.e GROUP BY ALL),
{p}walk AS (
  SELECT doc_id, field, CAST(1 AS BIGINT) AS k FROM {p}hits WHERE k = 1
  UNION ALL
  SELECT f.doc_id, f.field, f.nk FROM {p}walk w JOIN {p}following f USING (doc_id, field, k)),
{p}tags AS (
  SELECT doc_id, field, h.s, h.e, h.label, h.term, substring(text, h.s + 1, h.e - h.s) AS surface
  FROM {p}hits h JOIN {p}walk USING (doc_id, field, k) JOIN fields USING (doc_id, field))"""


TAGGED = [ARTICLE, DICTIONARY, BOTH_FIELDS, CANDIDATES, tags("", "dict")]
SPAN_COLUMNS = "doc_id, field, s AS start, e AS \"end\", label, surface"
SLOT_LIST = ", ".join(f"'{x}'" for x in SLOTS)


def annotated(compat: bool) -> str:
    columns = []
    for field in ("abstract", "title"):
        for label, slot in SLOTS.items():
            source = "title" if compat and label == "CELL_LINE" else field
            columns.append(
                f"max_by(surface, s) FILTER (WHERE field = '{source}' AND label = '{label}') "
                f'AS "{slot}_{field}"'
            )
    slots = ",\n    ".join(columns)
    return f"""annotated AS (
  SELECT a.doc_id AS tab_id, a.title, a.abstract, a.journal, a.pmid, t.* EXCLUDE (doc_id)
  FROM article a LEFT JOIN (SELECT doc_id, {slots} FROM tags GROUP BY doc_id) t USING (doc_id))"""


STATISTICS = """best AS (
  SELECT term, label, support FROM (
    SELECT term, label, support,
           row_number() OVER (PARTITION BY term ORDER BY support DESC, label) AS r
    FROM (SELECT term, label, count(*) AS support FROM tags GROUP BY term, label))
  WHERE r = 1),
statistics AS (
  SELECT b.term, len(string_split(b.term, ' ')) AS n, b.label, b.support, o.occurrences,
         round(b.support / o.occurrences, 6) AS precision
  FROM best b JOIN (SELECT term, count(*) AS occurrences FROM candidates GROUP BY term) o
  USING (term))"""
GOLD = [ARTICLE, DICTIONARY, ABSTRACT_ONLY, CANDIDATES, tags("", "dict"), STATISTICS]


def matched(p: str, condition: str) -> list[str]:
    """CTEs ending in ``{p}matched`` and ``{p}by_label`` for a learned dictionary."""
    return [
        f"{p}learned AS (SELECT term, label FROM statistics WHERE {condition})",
        tags(p, f"{p}learned"),
        f"""{p}matched AS (
  SELECT coalesce(g.doc_id, p.doc_id) AS doc_id, coalesce(g.s, p.s) AS start,
         coalesce(g.e, p.e) AS "end", coalesce(g.label, p.label) AS label,
         CASE WHEN g.doc_id IS NOT NULL AND p.doc_id IS NOT NULL THEN 1 ELSE 0 END AS tp,
         CASE WHEN g.doc_id IS NULL THEN 1 ELSE 0 END AS fp,
         CASE WHEN p.doc_id IS NULL THEN 1 ELSE 0 END AS fn
  FROM tags g FULL JOIN {p}tags p
    ON g.doc_id = p.doc_id AND g.s = p.s AND g.e = p.e AND g.label = p.label)""",
        f"""{p}by_label AS (
  SELECT l.label, tp, fp, fn FROM (VALUES ('RADIOTRACER_S'), ('RADIOTRACER_L')) l(label)
  LEFT JOIN (SELECT label, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp,
                    CAST(sum(fn) AS BIGINT) AS fn FROM {p}matched GROUP BY label) USING (label))""",
        f"""{p}pooled AS (SELECT CAST(coalesce(sum(tp), 0) AS BIGINT) AS tp,
  CAST(coalesce(sum(fp), 0) AS BIGINT) AS fp, CAST(coalesce(sum(fn), 0) AS BIGINT) AS fn
  FROM {p}by_label)""",
    ]


def by_label(p: str) -> str:
    return f"""SELECT label, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall,
  round(2 * (p * r / (p + r + 1e-100)), 6) AS fscore
  FROM (SELECT *, tp / (tp + fp + 1e-100) AS p, tp / (tp + fn + 1e-100) AS r FROM {p}by_label)"""


def pooled(p: str) -> str:
    return f"""SELECT 'RADIOTRACER' AS label, tp, fp, fn, round(p, 6) AS precision,
  round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS fscore
  FROM (SELECT *, tp / (tp + fp + 1e-8) AS p, tp / (tp + fn + 1e-8) AS r FROM {p}pooled)"""


def history(p: str, support: int) -> str:
    every = f"SELECT * FROM ({by_label(p)}) UNION ALL SELECT * FROM ({pooled(p)})"
    return " UNION ALL ".join(
        f"SELECT {support} AS iteration, label, '{m}' AS metric, {m} AS value FROM ({every})"
        for m in ("precision", "recall", "fscore")
    )


MATCHED = [*GOLD, *matched("p_", "support >= 2 AND precision >= 0.9")]

# --- genes -----------------------------------------------------------------------

def words(text: str) -> str:
    return f"list_distinct(list_filter(string_split_regex(lower({text}), '[^a-z0-9]+'), lambda x: x <> ''))"


GENES = """hits AS (
  SELECT p_name, min_by(CASE WHEN p_partkey % 11 <> 0 THEN p_type END, p_partkey)
           FILTER (WHERE first) AS name,
         min_by(p_brand, p_partkey) AS symbol, min(p_partkey) AS k
  FROM (SELECT *, p_partkey = min(p_partkey) OVER (PARTITION BY p_name) AS first FROM part)
  GROUP BY p_name),
proteins AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS row_id,
         CASE WHEN p_size > 45 THEN 'unknown'
              WHEN l_linenumber <> 7 THEN ' ' || upper(p_name) END AS protein_1_abstract
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
joined AS (
  SELECT row_id, protein_1_abstract, name, symbol, k % 3 AS genes,
         CASE WHEN k % 3 <> 0 THEN 'ENSG' || k || 'a' END AS gene
  FROM proteins LEFT JOIN hits ON lower(trim(protein_1_abstract)) = p_name)"""

EVERY_ARTICLE = "SELECT pmid, title, abstract, journal"

ORACLE_SQL: dict[str, str] = {
    "article_projection": with_ctes(
        ARTICLE, "SELECT doc_id AS tab_id, title, abstract, journal, pmid FROM article"
    ),
    "eligibility_gate": with_ctes(ARTICLE, ELIGIBLE, "SELECT doc_id, abstract FROM eligible"),
    "preprocessed_text": f"SELECT doc_id, {clean('text')} AS clean FROM documents",
    "file_lineage": """
  SELECT doc_id, file_name, right(split_part(file_name, '.xml', 1), 4) AS file_no,
         CASE WHEN ends_with(file_name, '.gz') THEN left(file_name, length(file_name) - 3)
              ELSE split_part(file_name, '.xml', 1) END AS stem
  FROM (SELECT doc_id, 'pubmed23n' || CASE WHEN doc_id < 10000
          THEN lpad(CAST(doc_id AS VARCHAR), 4, '0') ELSE left(CAST(doc_id AS VARCHAR), 4) END
          || CASE WHEN lang = 'en' THEN '.xml.gz' ELSE '.xml' END AS file_name FROM documents)""",
    "none_to_null": """
  SELECT CAST(doc_id AS VARCHAR) AS doc_id,
         CASE WHEN lang <> 'fr' THEN source END AS journal, CAST(n_chars AS VARCHAR) AS n_chars
  FROM documents""",
    "pure_classes": "SELECT doc_id, quality = 1 AS positive FROM labels",
    "nb_token_weights": with_ctes(WEIGHTS, "SELECT * FROM weights"),
    "score_documents": with_ctes(*SCORED, "SELECT * FROM scored"),
    "score_gate": with_ctes(*SCORED, "SELECT * FROM scored WHERE score > 0.5"),
    "saved_model_scores": with_ctes(
        ARTICLE, WEIGHTS, scores("s", "article", "pmid", "abstract"), "SELECT * FROM s"
    ),
    "saved_logistic_change": with_ctes(
        ARTICLE, ELIGIBLE, "SELECT doc_id, CAST(0 AS DOUBLE) AS change, true AS valid FROM eligible"
    ),
    "cap_per_file": with_ctes(
        *SCORED,
        f"""ranked AS (
  SELECT doc_id, file_no, row_idx, pmid, score,
         row_number() OVER (PARTITION BY file_no ORDER BY row_idx) AS file_rank
  FROM article JOIN scored USING (doc_id) WHERE score > 0.5)""",
        f"SELECT * FROM ranked WHERE file_rank <= {CAP + 1}",
    ),
    "last_wins_dedup": with_ctes(
        ARTICLE, REPEATED,
        """SELECT file_no, pmid, max(row_idx) AS row_idx, min(row_idx) AS first_idx
  FROM repeated GROUP BY file_no, pmid""",
    ),
    "sampled_examples": with_ctes(sample("labels", "chosen"), "SELECT * FROM chosen"),
    "keep_articles": with_ctes(*kept("article", None), "SELECT * FROM kept"),
    "keep_articles_capped": with_ctes(*kept("repeated", CAP), "SELECT * FROM kept"),
    "confusion_metrics": with_ctes(
        *JUDGED,
        f"c AS (SELECT {COUNTS} FROM judged, (SELECT 0.5 AS t))",
        f"r AS (SELECT *, {RATES} FROM c)",
        """SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
  CAST(tn AS BIGINT) AS tn, round(textcat_p, 6) AS textcat_p, round(textcat_r, 6) AS textcat_r,
  round(CASE WHEN textcat_p + textcat_r = 0 THEN 0
        ELSE 2 * textcat_p * textcat_r / (textcat_p + textcat_r) END, 6) AS textcat_f,
  round(textcat_s, 6) AS textcat_s FROM r""",
    ),
    "roc_curve": with_ctes(
        *CURVE,
        """SELECT point, round(threshold, 6) AS threshold, round(tpr, 6) AS tpr,
  round(fpr, 6) AS fpr FROM curve""",
    ),
    "auc_trapezoid": with_ctes(
        *CURVE,
        """SELECT round(sum((b.fpr - a.fpr) * (b.tpr + a.tpr) / 2), 6) AS auc
  FROM curve a JOIN curve b ON b.point = a.point + 1""",
    ),
    "auc_pairs_ties_one": with_ctes(*TIED, pair_auc("1.0")),
    "auc_rank_ties_half": with_ctes(*TIED, pair_auc("0.5")),
    "auc_sampled": with_ctes(*TIED, sample("judged", "half"), pair_auc("1.0", "half")),
    "running_positives": with_ctes(
        *JUDGED,
        """SELECT score, count(*) FILTER (WHERE pos) AS p, count(*) FILTER (WHERE NOT pos) AS n,
  (SELECT count(*) FROM judged o WHERE o.pos AND o.score > j.score) AS above
  FROM judged j GROUP BY score""",
    ),
    "ranked_documents": with_ctes(
        *TIED,
        """SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id DESC) AS rank
  FROM judged""",
    ),
    "dictionary_matches": with_ctes(
        *TAGGED,
        """SELECT doc_id, field, s AS start, e AS "end", label,
  substring(text, s + 1, e - s) AS surface, term FROM hits JOIN fields USING (doc_id, field)""",
        recursive=True,
    ),
    "tag_entities": with_ctes(*TAGGED, f"SELECT {SPAN_COLUMNS} FROM tags", recursive=True),
    "saved_dictionary_tags": with_ctes(*TAGGED, f"SELECT {SPAN_COLUMNS} FROM tags", recursive=True),
    "slot_entities": with_ctes(
        *TAGGED, f"SELECT {SPAN_COLUMNS} FROM tags WHERE label IN ({SLOT_LIST})", recursive=True
    ),
    "entity_pivot_last_wins": with_ctes(
        *TAGGED,
        "SELECT doc_id, field, "
        + ", ".join(f"max_by(surface, s) FILTER (WHERE label = '{x}') AS {x}" for x in SLOTS)
        + f" FROM tags WHERE label IN ({SLOT_LIST}) GROUP BY doc_id, field",
        recursive=True,
    ),
    "annotate_documents": with_ctes(
        *TAGGED, annotated(False), "SELECT * FROM annotated", recursive=True
    ),
    "annotate_documents_compat": with_ctes(
        *TAGGED, annotated(True), "SELECT * FROM annotated", recursive=True
    ),
    "co_mention_rule": with_ctes(
        *TAGGED,
        annotated(False),
        """SELECT * FROM annotated
  WHERE (protein_1_abstract IS NOT NULL OR protein_1_title IS NOT NULL
         OR "DNA_1_abstract" IS NOT NULL OR "DNA_1_title" IS NOT NULL)
    AND (radiotracer_1_abstract IS NOT NULL OR radiotracer_1_title IS NOT NULL
         OR radiotracer_2_abstract IS NOT NULL OR radiotracer_2_title IS NOT NULL)""",
        recursive=True,
    ),
    "co_mention_in_abstract": with_ctes(
        *TAGGED,
        annotated(False),
        """SELECT tab_id, pmid FROM annotated
  WHERE (protein_1_abstract IS NOT NULL OR "DNA_1_abstract" IS NOT NULL)
    AND (radiotracer_1_abstract IS NOT NULL OR radiotracer_2_abstract IS NOT NULL)""",
        recursive=True,
    ),
    "learn_dictionary": with_ctes(*GOLD, "SELECT * FROM statistics", recursive=True),
    "span_matches": with_ctes(*MATCHED, "SELECT * FROM p_matched", recursive=True),
    "span_prf_by_label": with_ctes(*MATCHED, by_label("p_"), recursive=True),
    "span_prf_pooled": with_ctes(*MATCHED, pooled("p_"), recursive=True),
    "tagger_history": with_ctes(
        *GOLD,
        *[cte for n in SUPPORTS for cte in matched(f"p{n}_", f"support >= {n}")],
        " UNION ALL ".join(history(f"p{n}_", n) for n in SUPPORTS),
        recursive=True,
    ),
    "gene_lookup_first_hit": with_ctes(
        GENES,
        """SELECT row_id, protein_1_abstract, name AS "SIMILAR_PROTEIN",
  gene AS "SIMILAR_ENSEMBL", symbol AS "SIMILAR_GENE_LIST" FROM joined""",
    ),
    "gene_lookup_strict": with_ctes(
        GENES,
        """SELECT row_id, protein_1_abstract, name AS "SIMILAR_PROTEIN",
  CASE WHEN name IS NOT NULL AND genes < 2 THEN gene END AS "SIMILAR_ENSEMBL",
  CASE WHEN name IS NOT NULL AND genes < 2 THEN symbol END AS "SIMILAR_GENE_LIST" FROM joined""",
    ),
    "gene_search": with_ctes(
        f"""forms AS (
  SELECT p_partkey AS id, 2 AS kind, {words('p_brand')} AS w FROM part
  UNION ALL SELECT p_partkey, 1, {words('p_type')} FROM part WHERE p_partkey % 11 <> 0
  UNION ALL SELECT p_partkey, 0, {words('p_name')} FROM part)""",
        """mentions AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS row_id,
         CASE l_linenumber WHEN 1 THEN split_part(p_name, ' ', -1) WHEN 2 THEN ' ' || upper(p_name)
           WHEN 3 THEN replace(p_brand, '#', '-') WHEN 4 THEN p_type || ' / ' || p_type
           WHEN 5 THEN p_name || ' ' || p_type WHEN 6 THEN '#' END AS protein_1_abstract
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)""",
        f"""asked AS (
  SELECT key, {words('key')} AS q
  FROM (SELECT DISTINCT lower(trim(protein_1_abstract)) AS key FROM mentions WHERE protein_1_abstract IS NOT NULL))""",
        """best AS (
  SELECT key, id FROM asked JOIN (SELECT *, unnest(w) AS word FROM forms) ON word = q[1] AND list_has_all(w, q)
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY len(q) * 1000 // len(w) DESC, kind DESC, id) = 1)""",
        """SELECT row_id, protein_1_abstract, CASE WHEN id % 11 <> 0 THEN p_type END AS "SIMILAR_PROTEIN",
  CASE WHEN id % 3 <> 0 THEN 'ENSG' || id || 'a' END AS "SIMILAR_ENSEMBL", p_brand AS "SIMILAR_GENE_LIST"
  FROM mentions LEFT JOIN best ON lower(trim(protein_1_abstract)) = key LEFT JOIN part ON id = p_partkey""",
    ),
    "xml_roundtrip": with_ctes(ARTICLE, EVERY_ARTICLE + " FROM article"),
    "reject_corrupt_files": with_ctes(
        ARTICLE, "SELECT pmid, journal FROM article WHERE journal <> 'src3'"
    ),
    "parquet_row_order": "SELECT 'documents' AS file_no, doc_id AS row_idx, doc_id FROM documents",
    "resume_anti_join": """
  SELECT repeat('0', 12 - length(CAST(doc_id AS VARCHAR))) || CAST(doc_id AS VARCHAR) AS file_no,
         doc_id
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "keyed_json_source": with_ctes(
        ARTICLE,
        EVERY_ARTICLE + ", CAST(length(abstract) AS DOUBLE) / 2 AS class_value FROM article",
    ),
    "keyed_json_per_file": with_ctes(
        ARTICLE,
        "SELECT file_no, " + EVERY_ARTICLE.removeprefix("SELECT ")
        + ", CAST(length(abstract) AS DOUBLE) / 2 AS class_value FROM article",
    ),
    "labelled_json_source": """
  SELECT text, CAST(quality AS DOUBLE) AS positive, CAST(1 - quality AS DOUBLE) AS negative
  FROM documents JOIN labels USING (doc_id)""",
    "labelled_list_source": """
  SELECT text, CAST(quality AS DOUBLE) AS positive, CAST(1 - quality AS DOUBLE) AS negative
  FROM documents JOIN labels USING (doc_id)""",
    "labelled_spans_source": with_ctes(
        *GOLD, 'SELECT s AS start, e AS "end", label, surface FROM tags', recursive=True
    ),
    "load_with_surrogate_id": with_ctes(
        *kept("article", None),
        """SELECT row_number() OVER (ORDER BY file_no, row_idx) AS tab_id, title, abstract, journal,
  pmid, class_value, '' AS clean_abstract, '' AS clean_title FROM kept""",
    ),
    "insert_ignore_append": with_ctes(
        *TAGGED,
        annotated(False),
        """SELECT annotated.*, CASE WHEN l.doc_id IS NULL THEN 'second' ELSE 'first' END AS load
  FROM annotated LEFT JOIN labels l ON l.doc_id = tab_id""",
        recursive=True,
    ),
    "stream_new_files": with_ctes(*kept("article", None), "SELECT * FROM kept"),
    "stream_new_files_capped": with_ctes(*kept("repeated", CAP), "SELECT * FROM kept"),
    "equal_file_names": with_ctes(
        *kept("article", None),
        "SELECT doc_id, CAST(2022 + doc_id % 2 AS INTEGER) AS year, class_value FROM kept",
    ),
    "resume_over_years": with_ctes(*kept("article", None), "SELECT doc_id, class_value FROM kept"),
    "ranked_by_text_key": with_ctes(
        *TIED,
        """SELECT CAST(doc_id AS VARCHAR) AS pmid, score,
  row_number() OVER (ORDER BY score DESC, CAST(doc_id AS VARCHAR) DESC) AS rank FROM judged""",
    ),
    "unscored_samples": with_ctes(
        *TIED,
        "scored_ones AS (SELECT * FROM judged WHERE doc_id % 7 > 1)",
        "area AS (" + pair_auc("1.0", "scored_ones") + ")",
        "SELECT (SELECT count(*) FROM scored_ones) AS n, auc FROM area",
    ),
    "table_listing": "SELECT count(*) AS rows, CAST(1 AS BIGINT) AS tables FROM documents",
}
