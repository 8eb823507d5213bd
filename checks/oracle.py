"""SQL for the registered queries: common table expressions and how they join up.

Patterns are written for the SQL engine's own regular expressions; those without anything of an engine in
them, as for amounts and dates, are spelled as on the Spark side.
"""

from __future__ import annotations

from checks import settings as S
from docsearch import fixed_values as V

WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
AMOUNT = r"\$?\p{Nd}{1,3}(?:,\p{Nd}{3})*(?:\.\p{Nd}{2})?"
DATE = r"\p{Nd}{1,2}[/-]\p{Nd}{1,2}[/-]\p{Nd}{2,4}"
INVOICE = rf"(?i)(?:invoice|inv)(?:{WS}|#)*({WORD}+)"
ORDER = rf"(?i)(?:po|purchase{WS}+order)(?:{WS}|#)*({WORD}+)"
BLANK = rf"^{WS}*$"


def words(values) -> str:
    """List of SQL string literals."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def blank(c: str) -> str:
    return rf"({c} IS NULL OR regexp_full_match({c}, '{WS}*'))"


def mask(c: str) -> str:
    for pattern, token in (
        (AMOUNT, "AMOUNT_TOKEN"), (DATE, "DATE_TOKEN"),
        (INVOICE, "INVOICE_TOKEN"), (ORDER, "PO_TOKEN"),
    ):
        c = f"regexp_replace({c}, '{pattern}', '{token}', 'g')"
    return c


def clean(c: str) -> str:
    spaced = f"trim(regexp_replace(lower({c}), '{WS}+', ' ', 'g'))"
    plain = rf"regexp_replace({mask(spaced)}, '[^\p{{L}}\p{{N}}_ $.,/-]', ' ', 'g')"
    return f"coalesce(trim(regexp_replace({plain}, ' +', ' ', 'g')), '')"


def tokens(c: str, stop_words=S.STOP_WORDS) -> str:
    ascii_text = rf"regexp_replace(strip_accents(lower({c})), '[^\x00-\x7F]', '', 'g')"
    found = rf"regexp_extract_all({ascii_text}, '\b[a-zA-Z][a-zA-Z0-9]*\b')"
    return f"list_filter({found}, lambda w: w NOT IN ({words(stop_words)}))"


def bigrams(t: str) -> str:
    return (
        f"list_concat({t}, list_transform(range(1, len({t})), "
        f"lambda i: {t}[i] || ' ' || {t}[i + 1]))"
    )


def query_words(c: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({c}), '{WS}+'), lambda t: t <> '')"


def matched(content: str, terms: str) -> str:
    return (
        f"list_sort(list_distinct(list_concat("
        f"list_filter({terms}, lambda t: contains(lower({content}), t)), "
        f"list_filter([{words(V.FINANCE_TERMS)}], lambda f: contains(lower({content}), f) "
        f"AND len(list_filter({terms}, lambda t: contains(f, t))) > 0))))"
    )


def snippet(source: str, name: str, length: int = 200) -> str:
    """CTEs that add ``context_snippet`` to ``source`` (columns content, terms)."""
    return rf"""
{name}_1 AS MATERIALIZED (SELECT *, lower(content) AS low, length(content) AS n,
    list_filter(terms, lambda t: contains(lower(content), t)) AS present FROM {source}),
{name}_2 AS MATERIALIZED (SELECT * EXCLUDE (present), CASE WHEN n > {length} AND len(present) > 0
    THEN list_max(list_transform(list_transform(range(0, n - {length} + 1, 20),
        lambda i: {{'at': i, 'w': substring(low, CAST(i AS INTEGER) + 1, {length})}}),
    lambda x: len(list_filter(present, lambda t: contains(x.w, t))) * 1000000000 - x.at))
    ELSE 0 END AS score_at FROM {name}_1),
{name}_3 AS MATERIALIZED (SELECT * EXCLUDE (score_at),
    CASE WHEN score_at <= 0 THEN 0
    ELSE ((score_at + 999999999) // 1000000000) * 1000000000 - score_at END AS best FROM {name}_2),
{name}_4 AS MATERIALIZED (SELECT *, substring(content, best + 1, {length}) AS raw FROM {name}_3),
{name}_5 AS MATERIALIZED (SELECT *, CASE WHEN best > 0 AND strpos(raw, ' ') > 1
    THEN substring(raw, strpos(raw, ' ') + 1) ELSE raw END AS cut FROM {name}_4),
{name}_6 AS MATERIALIZED (SELECT *, length(cut) - strpos(reverse(cut), ' ') AS gap FROM {name}_5),
{name}_7 AS MATERIALIZED (SELECT * REPLACE (CASE WHEN length(cut) = {length}
    AND substring(content, best + {length} + 1, 1) <> ' ' AND strpos(cut, ' ') > 0
    AND gap > {length} * 0.8 THEN substring(cut, 1, gap) ELSE cut END AS cut) FROM {name}_6),
{name}_8 AS MATERIALIZED (SELECT * REPLACE (CASE WHEN best > 0 THEN '...' || cut ELSE cut END AS cut) FROM {name}_7),
{name} AS MATERIALIZED (SELECT * EXCLUDE (low, n, best, raw, cut, gap),
    CASE WHEN len(terms) = 0 THEN substring(content, 1, {length})
    ELSE {strip(f"CASE WHEN best + length(cut) < n THEN cut || '...' ELSE cut END")} END
    AS context_snippet FROM {name}_8)"""


def unit(c: str) -> str:
    """Vector of length one, in single precision."""
    norm = f"sqrt(list_sum(list_transform({c}, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
    return f"list_transform({c}, lambda x: CAST(CAST(x AS DOUBLE) / {norm} AS FLOAT))"


def inner(a: str, b: str) -> str:
    return f"list_inner_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


_TYPES = f"[{words(V.DOC_TYPES)}]"
_FINANCIAL = f"[{words(V.FINANCIAL_DOC_TYPES)}]"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTES[name] = (needs, body)


cte("docs", (), f"""docs AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS content,
    source AS entity_id, {_TYPES}[doc_id % 16 + 1] AS doc_type,
    TIMESTAMP '2024-01-01' - to_days(CAST(doc_id % 365 AS INTEGER)) AS date, lang, n_chars
    FROM documents)""")
cte("cleaned", ("docs",), f"""cleaned AS MATERIALIZED (SELECT * FROM (
    SELECT * REPLACE ({clean("content")} AS content) FROM docs) WHERE content <> '')""")
cte("toks", ("cleaned",), f"""toks AS MATERIALIZED (
    SELECT doc_id, {tokens("content")} AS t FROM cleaned)""")
cte("tf", ("toks",), f"""tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest({bigrams("t")}) AS term FROM toks) GROUP BY ALL)""")
cte("n", ("cleaned",), "n AS (SELECT count(*) AS n FROM cleaned)")
cte("freq", ("tf",), """freq AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf
    FROM tf GROUP BY term)""")
cte("vocab", ("freq", "n"), f"""vocab AS MATERIALIZED (
    SELECT term, df, ctf, ln((1.0 + n) / (1.0 + df)) + 1 AS idf FROM freq, n
    WHERE df >= {V.MIN_DF} AND df <= {V.MAX_DF} * n
    ORDER BY ctf DESC, term LIMIT {V.MAX_FEATURES})""")
cte("postings", ("tf", "vocab"), """raw_postings AS (
    SELECT term, doc_id, tf, tf * idf AS raw FROM tf JOIN vocab USING (term)),
postings AS MATERIALIZED (SELECT term, doc_id, tf,
    raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw_postings)""")


def query_table(threshold: float = 0.05, max_results: int = 10, filtered: bool = True) -> str:
    def when(condition: str, value: str) -> str:
        return f"CASE WHEN {condition if filtered else 'false'} THEN {value} END"

    sources = ", ".join(f"'src' || ((item_id + {s}) % 20)" for s in (0, 3, 7, 11, 13))
    return f"""queries AS (SELECT CAST(item_id AS VARCHAR) AS query_id, text,
    {when("item_id % 2 = 0", f"[{sources}]")} AS entity_ids,
    {when("item_id % 3 = 0", _FINANCIAL)} AS doc_types,
    {when("item_id % 5 = 0", "TIMESTAMP '2023-04-01'")} AS date_from,
    {when("item_id % 4 = 0", "TIMESTAMP '2023-12-01'")} AS date_to,
    CAST({threshold} AS DOUBLE) AS similarity_threshold, {max_results} AS max_results
    FROM benchmark)"""


cte("queries", (), query_table())
cte("query_weights", ("queries", "vocab"), f"""query_toks AS (
    SELECT query_id, {tokens(clean("text"))} AS t FROM queries),
query_tf AS (SELECT query_id, term, count(*) AS tf FROM (
    SELECT query_id, unnest({bigrams("t")}) AS term FROM query_toks) GROUP BY ALL),
query_raw AS (SELECT query_id, term, tf * idf AS raw FROM query_tf JOIN vocab USING (term)),
query_weights AS MATERIALIZED (SELECT query_id, term,
    raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_id)) AS query_weight FROM query_raw)""")
cte("scored", ("postings", "query_weights"), """scored AS MATERIALIZED (
    SELECT query_id, doc_id, least(round(sum(weight * query_weight), 10), 1.0) AS score
    FROM postings JOIN query_weights USING (term) GROUP BY ALL)""")


def top(source: str, name: str, factor: int, share: float = 1.0) -> str:
    """CTE: first rows per query at or above its threshold."""
    return f"""{name} AS MATERIALIZED (SELECT query_id, doc_id, score, max_results, position FROM (
    SELECT s.query_id, s.doc_id, s.score, q.max_results,
        row_number() OVER (PARTITION BY s.query_id ORDER BY s.score DESC, s.doc_id) AS position
    FROM {source} s JOIN queries q USING (query_id)
    WHERE s.score >= q.similarity_threshold * {share})
    WHERE position <= max_results * {factor})"""


PASSES = """(q.entity_ids IS NULL OR len(q.entity_ids) = 0 OR list_contains(q.entity_ids, d.entity_id))
    AND (q.doc_types IS NULL OR len(q.doc_types) = 0 OR list_contains(q.doc_types, d.doc_type))
    AND (q.date_from IS NULL OR d.date >= q.date_from)
    AND (q.date_to IS NULL OR d.date <= q.date_to)"""

cte("sparse_top", ("scored",), top("scored", "sparse_top", 2))
cte("sparse_wide", ("scored",), top("scored", "sparse_wide", 3, 0.5))
cte("vectors", (), f"""vectors AS MATERIALIZED (
    SELECT CAST(vec_id AS VARCHAR) AS doc_id, {unit("embedding")} AS e FROM embeddings)""")
cte("query_vectors", ("queries", "vectors"), """query_vectors AS (
    SELECT q.query_id, v.e AS qe FROM queries q JOIN vectors v ON v.doc_id = q.query_id)""")
cte("dense_scored", ("query_vectors",), f"""dense_scored AS MATERIALIZED (
    SELECT query_id, doc_id, least(round({inner("e", "qe")}, 10), 1.0) AS score
    FROM vectors, query_vectors)""")
cte("dense_top", ("dense_scored",), top("dense_scored", "dense_top", 2))
cte("dense_wide", ("dense_scored",), top("dense_scored", "dense_wide", 3, 0.5))
cte("fusion", ("sparse_wide", "dense_wide"), """fusion AS MATERIALIZED (
    SELECT coalesce(s.query_id, d.query_id) AS query_id, coalesce(s.doc_id, d.doc_id) AS doc_id,
        s.score AS sparse_score, s.position AS sparse_rank,
        d.score AS dense_score, d.position AS dense_rank
    FROM sparse_wide s FULL JOIN dense_wide d ON s.query_id = d.query_id AND s.doc_id = d.doc_id)""")

WEIGHTED = "round(0.4 * coalesce(sparse_score, 0) + 0.6 * coalesce(dense_score, 0), 12)"
MAX = "round(greatest(coalesce(sparse_score, 0), coalesce(dense_score, 0)), 12)"
RRF = """round(1.0 / (60 + coalesce(sparse_rank, coalesce(max(sparse_rank) OVER q, 0) + 1))
    + 1.0 / (60 + coalesce(dense_rank, coalesce(max(dense_rank) OVER q, 0) + 1)), 12)"""


def fused(score: str, name: str = "hybrid_top") -> str:
    return f"""fused AS (SELECT query_id, doc_id, {score} AS score,
    sparse_rank IS NOT NULL AS in_sparse FROM fusion WINDOW q AS (PARTITION BY query_id)),
{name} AS MATERIALIZED (SELECT query_id, doc_id, score, in_sparse, position FROM (
    SELECT f.*, q.max_results, row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, doc_id) AS position
    FROM fused f JOIN queries q USING (query_id)) WHERE position <= 2 * max_results)"""


def presented(hits: str, source: str, name: str = "results", texts: bool = True) -> str:
    """CTEs from hits to result rows; ``source`` is the SQL that gives the
    document of a hit (columns of ``docs``). Without ``texts`` the snippet and
    the matched terms are left out."""
    extras, cut = "", f"{name}_hits"
    content = ""
    if texts:
        cut = f"{name}_cut"
        extras = f"{snippet(f'{name}_hits', cut)},"
        content = f"d.content, {query_words('q.text')} AS terms,"
    matches = f"{matched('content', 'terms')} AS matched_terms," if texts else ""
    kept = f"WHERE NOT {blank('context_snippet')}" if texts else ""
    return f"""
{name}_hits AS MATERIALIZED (SELECT h.query_id, h.doc_id, h.score, d.entity_id, d.doc_type, d.date,
    {content} q.max_results
    FROM {hits} h JOIN queries q USING (query_id) JOIN ({source}) d ON d.doc_id = h.doc_id
    WHERE {PASSES}),
{extras}
{name}_ranked AS MATERIALIZED (SELECT *, {matches}
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM {cut}),
{name} AS MATERIALIZED (SELECT * FROM {name}_ranked {kept}
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank) <= max_results)"""


RESULT = """query_id, doc_id, entity_id, doc_type, strftime(date, '%Y-%m-%d') AS date,
    round(score, 6) AS score, context_snippet,
    array_to_string(matched_terms, '|') AS matched_terms, rank"""


def sql(needs: tuple[str, ...] | str, select: str, extra: str = "", **override: str) -> str:
    """Statement with the needed CTEs in order, then ``extra`` CTEs."""
    needs = (needs,) if isinstance(needs, str) else needs
    done: list[str] = []

    def add(name: str) -> None:
        if name not in done:
            for other in CTES[name][0]:
                add(other)
            done.append(name)

    for name in needs:
        add(name)
    parts = [override.get(name, CTES[name][1]) for name in done]
    if extra:
        parts.append(extra)
    return (f"WITH {','.join(parts)} " if parts else "") + select
