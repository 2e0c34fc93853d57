"""SQL for the registered queries, for an engine with RE2 patterns, lists and lambdas."""

from paperlake.constants import MODEL_MAP, STOP_WORDS
from paperlake.functions.porter import AFTER_PLURALS, DOUBLES, EXCEPTIONS, STEP_2, STEP_3, STEP_4, WHOLE_PREFIXES
from paperlake.operators.dense import hyperplanes

DIM = 64
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
_DATE = "(DATE '2000-01-01' + n_chars::INT)"
_SAMPLE = r"'\textbf{foo} \alpha $x$ {k} '"
_SPACE = r"[\t-\r\x1C-\x1F \x{85}\p{Z}]"


def words(expression: str) -> str:
    return _WORDS.format(expression)


def strip(expression: str) -> str:
    return f"regexp_replace(coalesce({expression}, ''), '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def squeeze(expression: str) -> str:
    return rf"trim(regexp_replace({expression}, '[\s\x0B]+', ' ', 'g'))"


# --- views ------------------------------------------------------------------------

PAPERS = f"""papers AS (
  SELECT doc_id::VARCHAR AS paper_id, string_split(text, chr(10))[1] AS title, text AS abstract,
         source AS categories, 'https://arxiv.org/abs/' || doc_id AS url,
         {_DATE} AS published_date, year({_DATE})::INT AS published_year, embedding,
         CASE WHEN lang <> 'en' THEN '{{"lang":"' || lang || '","source":"' || source || '"}}' END AS metadata
  FROM documents LEFT JOIN embeddings ON doc_id = vec_id)"""

QUESTIONS = """questions AS (
  SELECT item_id AS query_id, text, embedding,
         CASE WHEN length(text) > 300 THEN 'gpt-4o' WHEN length(text) > 200 THEN 'DeepSeek-V3' ELSE 'unheard-of' END AS model_tag
  FROM benchmark LEFT JOIN embeddings ON item_id = vec_id)"""

_ABSTRACT = _SAMPLE + " || text"
for _pattern, _new in (
    (r"[\r\n\t]+", " "),
    (r"\$.*?\$", " [MATH] "),
    (r"\\[a-zA-Z]+\{[^}]*\}", ""),
    (r"\\[a-zA-Z]+", ""),
    (r"[\x00-\x1F\x7F]", ""),
):
    _ABSTRACT = f"regexp_replace({_ABSTRACT}, '{_pattern}', '{_new}', 'g')"
_ABSTRACT = squeeze(f"replace(replace({_ABSTRACT}, '{{', '('), '}}', ')')")

_AUTHORS = """CASE WHEN lang = 'de' THEN source ELSE array_to_string(list_transform(string_split(text, chr(10)),
    lambda l: trim(coalesce(string_split(l, ' ')[2], '') || ' ' || coalesce(string_split(l, ' ')[1], ''))), ', ') END"""

CLEAN = f"""clean AS (
  SELECT doc_id::VARCHAR AS paper_id, {squeeze("string_split(text, chr(10))[1]")} AS title, {_ABSTRACT} AS abstract,
         {_AUTHORS} AS authors, source || ', ' || lang AS categories, 'https://arxiv.org/abs/' || doc_id AS url,
         CASE WHEN lang <> 'es' THEN {_DATE} END AS published_date,
         CASE WHEN lang <> 'es' THEN year({_DATE})::INT END AS published_year, lang
  FROM documents)"""

_DESCRIPTION = r"regexp_replace('arXiv:1 Announce Type: new ' || chr(10) || 'Abstract: ' || html, '(?s)^arXiv:.*?\bAbstract:\s*', '')"
_PAGE_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


def page_text(html: str) -> str:
    return strip(f"regexp_replace(regexp_replace({html}, '<[^>]+>', '', 'g'), '{_SPACE}+', ' ', 'g')")


_FEED_DATE = "(make_timestamp((1700000000 + 86400 * (page_id % 9000)) * 1000000)::DATE)"
FEED = rf"""feed AS (
  SELECT CASE WHEN url LIKE 'https%' THEN lpad(page_id::VARCHAR, 9, '0') ELSE page_id::VARCHAR END AS paper_id,
         {strip(_PAGE_TITLE)} AS title, {page_text(_DESCRIPTION)} AS abstract,
         nullif(regexp_extract(html, 'lang="(\w+)"', 1), '') AS authors,
         replace(regexp_extract(url, '//([^/]+)/', 1), '.', ', ') AS categories,
         url || '/abs/' || page_id || 'v3' || CASE WHEN page_id % 3 = 0 THEN '/' ELSE '' END AS url, {_FEED_DATE} AS published_date, year({_FEED_DATE})::INT AS published_year
  FROM pages)"""
_FEED_COLUMNS = "paper_id, title, abstract, authors, categories, url, published_date, published_year"


# --- search ------------------------------------------------------------------------

DENSE = """dense AS (
  SELECT * FROM (
    SELECT query_id, paper_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance NULLS LAST, paper_id) AS rank_dense
    FROM (SELECT q.query_id, p.paper_id, round(list_cosine_distance(q.embedding::DOUBLE[], p.embedding::DOUBLE[]), 9) AS distance
          FROM questions q, papers p WHERE q.embedding IS NOT NULL))
  WHERE rank_dense <= 20)"""

POSTINGS = f"""
  places AS (SELECT paper_id, unnest({words("title || ' ' || abstract")}) AS term,
                    generate_subscripts({words("title || ' ' || abstract")}, 1) - 1 AS pos,
                    len({words("title")}) AS n_title FROM papers),
  kept AS (SELECT * FROM places WHERE term NOT IN ({_STOPS})),
  lengths AS (SELECT paper_id, count(*) AS dl FROM kept GROUP BY 1),
  corpus AS (SELECT (SELECT count(*) FROM papers) AS n_docs, (SELECT count(*) FROM kept)::DOUBLE / (SELECT count(*) FROM papers) AS avg_dl),
  freq AS (SELECT term, count(DISTINCT paper_id) AS df FROM kept GROUP BY 1)"""


def postings(weight: str = "1e0") -> str:
    return f"""
  post AS (SELECT paper_id, term, sum({weight}) AS tf FROM kept GROUP BY ALL),
  scored AS (
    SELECT paper_id, term, ln(1e0 + (n_docs - df + 0.5e0) / (df + 0.5e0)) * (tf * 2.2e0) / (tf + 1.2e0 * (0.25e0 + 0.75e0 * dl / avg_dl)) AS part
    FROM post JOIN freq USING (term) JOIN lengths USING (paper_id), corpus)"""


ASKED = f"""asked AS (SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest({words("text")}) AS term FROM questions) WHERE term NOT IN ({_STOPS}))"""
_NEEDED = "needed AS (SELECT query_id, count(*) AS n FROM asked GROUP BY 1)"
MATCH_ALL = f"""{_NEEDED}, matched AS (
    SELECT query_id, paper_id, sum(part) AS score FROM asked JOIN scored USING (term) JOIN needed USING (query_id)
    GROUP BY ALL HAVING count(*) = any_value(n))"""
MATCH_ANY = "matched AS (SELECT query_id, paper_id, sum(part) AS score FROM asked JOIN scored USING (term) GROUP BY ALL)"
SPARSE = """sparse AS (
  SELECT * FROM (
    SELECT query_id, paper_id, round(score, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, paper_id) AS rank_sparse
    FROM matched) WHERE rank_sparse <= 20)"""
FUSED = """fused AS (
  SELECT *, 1e0 / (60e0 + rank_dense) + 1e0 / (60e0 + rank_sparse) AS rrf_score FROM (
    SELECT query_id, paper_id, coalesce(rank_dense, 999) AS rank_dense, coalesce(rank_sparse, 999) AS rank_sparse
    FROM dense FULL JOIN sparse USING (query_id, paper_id)))"""


def keyword(match: str, weight: str = "1e0") -> str:
    return ", ".join([PAPERS, QUESTIONS, POSTINGS, postings(weight), ASKED, match, SPARSE])


def best(limit: int) -> str:
    return f"""best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, paper_id) AS place FROM fused) WHERE place <= {limit})"""


_SPARSE_OUT = "SELECT query_id, paper_id, round(score, 6) AS score, rank_sparse FROM sparse"
HYBRID = ", ".join([keyword(MATCH_ALL), DENSE, FUSED])
_HYBRID_OUT = f"""WITH {HYBRID}, {best(5)}
  SELECT query_id, place, paper_id, title, abstract, url, published_date, rank_dense, rank_sparse, round(rrf_score, 9) AS rrf_score
  FROM best JOIN papers USING (paper_id)"""


def dense_query(condition: str = "TRUE") -> str:
    papers = PAPERS + f", some_papers AS (SELECT * FROM papers WHERE {condition})"
    return f"WITH {papers}, {QUESTIONS}, {DENSE.replace('papers p', 'some_papers p')} SELECT query_id, paper_id, round(distance, 6) AS distance, rank_dense FROM dense"


def lsh_query(tables: int, bits: int, probes: int, seed: int = 7) -> str:
    """Cells by the sides of the hyperplanes, written as numbers; per table the nearest cells by squared margins."""
    planes = ", ".join(
        f"({t}, {b}, {[float(x) for x in plane]})"
        for t, table in enumerate(hyperplanes(DIM, bits, seed, tables))
        for b, plane in enumerate(table)
    )
    side = lambda source: f"""SELECT s.id, t, sum(CASE WHEN m > 0 THEN 1 << b ELSE 0 END) AS cell, list({{'b': b, 'm': m}}) AS margins
      FROM (SELECT id, t, b, list_inner_product(v, plane) AS m FROM {source}, planes) s GROUP BY ALL"""  # noqa: E731
    return f"""WITH {PAPERS}, {QUESTIONS}, planes(t, b, plane) AS (SELECT t, b, plane::DOUBLE[] FROM (VALUES {planes}) x(t, b, plane)),
      documents_v AS (SELECT paper_id AS id, embedding::DOUBLE[] AS v FROM papers WHERE embedding IS NOT NULL),
      queries_v AS (SELECT query_id AS id, embedding::DOUBLE[] AS v FROM questions WHERE embedding IS NOT NULL),
      document_cells AS ({side("documents_v")}), query_cells AS ({side("queries_v")}),
      probed AS (SELECT id, t, xor(cell::BIGINT, flips) AS cell FROM (
          SELECT id, t, cell, flips, list_sum(list_transform(margins, lambda x: CASE WHEN (flips >> x.b) & 1 = 1 THEN x.m * x.m ELSE 0 END)) AS away
          FROM query_cells, range({1 << bits}) f(flips))
        QUALIFY row_number() OVER (PARTITION BY id, t ORDER BY away) <= {probes}),
      met AS (SELECT DISTINCT p.id AS query_id, d.id AS paper_id FROM probed p JOIN document_cells d ON p.t = d.t AND p.cell = d.cell),
      ranked AS (SELECT query_id, paper_id, round(list_cosine_distance(q.v, d.v), 9) AS distance
        FROM met JOIN queries_v q ON q.id = query_id JOIN documents_v d ON d.id = paper_id)
      SELECT query_id, paper_id, round(distance, 6) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, paper_id) AS rank_dense
      FROM ranked QUALIFY rank_dense <= 20"""


def cells_query(share: float = 0.85, part: int = 4, entries: int = 64, rounds: int = 4, rerank: int = 100) -> str:
    """Integer vectors, Lloyd's rounds for the cells and for every run of what they leave over, code distances, exact ranks."""
    away = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def lloyd(name: str, points: str, book: str) -> str:
        """Books of a table of (run, r, v), from the first `book` rows of every run."""
        steps = [f"{name}0 AS MATERIALIZED (SELECT run, r - 1 AS e, v AS b FROM {points} WHERE r <= {book})"]
        for i in range(rounds):
            steps.append(f"""{name}_at{i} AS MATERIALIZED (
              SELECT run, r, v, min((({away.format("v", "b")})::BIGINT, e))[2] AS e FROM {points} JOIN {name}{i} USING (run) GROUP BY ALL)""")
            steps.append(f"""{name}_sum{i} AS (SELECT run, e, k, sum(x)::BIGINT AS s, count(*) AS n FROM (
              SELECT run, e, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM {name}_at{i}) GROUP BY ALL)""")
            steps.append(f"{name}_mean{i} AS (SELECT run, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS b FROM {name}_sum{i} GROUP BY ALL)")
            steps.append(f"""{name}{i + 1} AS MATERIALIZED (
              SELECT run, e, coalesce(m.b, o.b) AS b FROM {name}{i} o LEFT JOIN {name}_mean{i} m USING (run, e))""")
        return ", ".join(steps)

    whole = "list_transform({0}, lambda x: floor(x / sqrt(list_inner_product({0}, {0})) * 4096)::BIGINT)"
    runs = f"range({DIM // part}) t(run)"
    cut = f"list_slice({{0}}, run * {part} + 1, run * {part} + {part})"
    left = "list_transform(list_zip({0}, {1}), lambda z: z[1] - z[2])"
    return f"""WITH {PAPERS}, {QUESTIONS},
      vectors AS MATERIALIZED (SELECT paper_id, {whole.format("d")} AS v FROM (SELECT paper_id, embedding::DOUBLE[] AS d FROM papers WHERE embedding IS NOT NULL)),
      asked AS MATERIALIZED (SELECT query_id, {whole.format("d")} AS v FROM (SELECT query_id, embedding::DOUBLE[] AS d FROM questions WHERE embedding IS NOT NULL)),
      sample AS MATERIALIZED (SELECT 0 AS run, row_number() OVER (ORDER BY md5(paper_id), paper_id) AS r, v FROM vectors QUALIFY r <= 4096),
      n_cells AS (SELECT ceil(sqrt(count(*)) / 2)::BIGINT AS n FROM vectors),
      {lloyd("cell", "sample", "(SELECT n FROM n_cells)")},
      placed AS MATERIALIZED (SELECT paper_id, v, min((({away.format("v", "b")})::BIGINT, e))[2] AS cell FROM vectors, cell{rounds} GROUP BY ALL),
      over AS MATERIALIZED (SELECT paper_id, cell, {left.format("v", "b")} AS v FROM placed JOIN cell{rounds} ON e = cell),
      kept AS MATERIALIZED (
        SELECT run, r, {cut.format("v")} AS v
        FROM (SELECT v, row_number() OVER (ORDER BY md5(paper_id), paper_id) AS r FROM over QUALIFY r <= 4096), {runs}),
      {lloyd("book", "kept", str(entries))},
      pieces AS (SELECT paper_id, cell, run, {cut.format("v")} AS v FROM over, {runs}),
      coded AS MATERIALIZED (
        SELECT paper_id, cell, run, min((({away.format("v", "b")})::BIGINT, e))[2] AS e FROM pieces JOIN book{rounds} USING (run) GROUP BY paper_id, cell, run, v),
      probed AS (SELECT query_id, e AS cell, a.v, c.b FROM asked a, cell{rounds} c
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY {away.format("a.v", "c.b")}, e) <= ceil({share} * (SELECT n FROM n_cells))),
      questioned AS (SELECT query_id, cell, run, {cut.format(left.format("v", "b"))} AS q FROM probed, {runs}),
      looked_up AS MATERIALIZED (SELECT query_id, cell, run, e, {away.format("q", "b")} AS d FROM questioned JOIN book{rounds} USING (run)),
      near AS (SELECT query_id, paper_id, sum(d) AS d FROM coded JOIN looked_up USING (cell, run, e) GROUP BY ALL),
      best AS (SELECT query_id, paper_id FROM near QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, paper_id) <= {rerank}),
      ranked AS (SELECT query_id, paper_id, round(list_cosine_distance(q.embedding::DOUBLE[], p.embedding::DOUBLE[]), 9) AS distance
        FROM best JOIN questions q USING (query_id) JOIN papers p USING (paper_id))
      SELECT query_id, paper_id, round(distance, 6) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, paper_id) AS rank_dense
      FROM ranked QUALIFY rank_dense <= 20"""


# A phrase holds at a start s if the word at offset i of the question lies at s + i in the paper.
MATCH_PHRASE = f"""
  spelled AS (SELECT query_id, unnest({words("text")}) AS term, generate_subscripts({words("text")}, 1) - 1 AS off FROM questions),
  wanted AS (SELECT * FROM spelled WHERE term NOT IN ({_STOPS})),
  length_of AS (SELECT query_id, count(*) AS n FROM wanted GROUP BY 1),
  starts AS (SELECT query_id, paper_id, k.pos - w.off AS s, count(*) AS c FROM wanted w JOIN kept k USING (term) GROUP BY ALL),
  hit AS (SELECT DISTINCT query_id, paper_id FROM starts JOIN length_of USING (query_id) WHERE c = n),
  matched AS (SELECT query_id, paper_id, sum(part) AS score FROM hit JOIN asked USING (query_id) JOIN scored USING (paper_id, term) GROUP BY ALL)"""

# Any sentence with all its words, without the last indexed word of the question.
MATCH_BOOLEAN = f"""
  sentences AS (SELECT query_id, unnest(string_split(text, '.')) AS sentence, generate_subscripts(string_split(text, '.'), 1) AS alt FROM questions),
  alt_terms AS (SELECT DISTINCT query_id, alt, term FROM (SELECT query_id, alt, unnest({words("sentence")}) AS term FROM sentences) WHERE term NOT IN ({_STOPS})),
  alt_needed AS (SELECT query_id, alt, count(*) AS n FROM alt_terms GROUP BY ALL),
  last_word AS (SELECT query_id, list_filter({words("text")}, lambda w: w NOT IN ({_STOPS}))[-1] AS term FROM questions),
  banned AS (SELECT query_id, paper_id FROM last_word JOIN post USING (term)),
  hit AS (SELECT DISTINCT query_id, paper_id FROM (
            SELECT query_id, alt, paper_id FROM alt_terms JOIN post USING (term) JOIN alt_needed USING (query_id, alt)
            GROUP BY ALL HAVING count(*) = any_value(n)) ANTI JOIN banned USING (query_id, paper_id)),
  matched AS (SELECT query_id, paper_id, sum(part) AS score FROM hit JOIN (SELECT DISTINCT query_id, term FROM alt_terms) USING (query_id)
              JOIN scored USING (paper_id, term) GROUP BY ALL)"""

_STEM = """CASE WHEN regexp_matches(term, 'ies$') AND NOT regexp_matches(term, '[ea]ies$') THEN regexp_replace(term, 'ies$', 'y')
    WHEN regexp_matches(term, 'es$') AND NOT regexp_matches(term, '[aeo]es$') THEN regexp_replace(term, 'es$', 'e')
    WHEN regexp_matches(term, 's$') AND NOT regexp_matches(term, '[us]s$') THEN regexp_replace(term, 's$', '') ELSE term END"""
STEMMED = keyword(MATCH_ANY).replace("kept AS (SELECT * FROM", f"kept AS (SELECT * REPLACE ({_STEM} AS term) FROM")
STEMMED = STEMMED.replace("asked AS (SELECT DISTINCT query_id, term FROM", f"asked AS (SELECT DISTINCT query_id, {_STEM} AS term FROM")


def _english() -> str:
    """Porter2 on the distinct words, step by step: w is what is left, p1 and p2 are where the regions begin."""
    region = "CASE WHEN regexp_matches({0}, '[aeiouy][^aeiouy]') THEN length(regexp_extract({0}, '^.*?[aeiouy][^aeiouy]')) ELSE length({0}) END"
    short = "regexp_matches({0}, '[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$')"
    cut = lambda n, w="w": f"substr({w}, 1, length({w}) - {n})"

    def suffix(source: str, endings: dict[str, str], p: str, allowed: str) -> str:
        pattern = "|".join(sorted(endings, key=len, reverse=True))
        new = "CASE s " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in endings.items()) + " END"
        return f"""(SELECT * REPLACE (CASE WHEN s <> '' AND length(rest) >= {p} AND {allowed} THEN rest || {new} ELSE w END AS w) FROM (
          SELECT *, {cut("length(s)")} AS rest FROM (SELECT * EXCLUDE (s, rest), regexp_extract(w, '({pattern})$', 1) AS s FROM {source})))"""

    fixed = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EXCEPTIONS.items())
    after = ", ".join(f"'{w}'" for w in AFTER_PLURALS)
    return f"""
  e0 AS (SELECT DISTINCT term AS x FROM places UNION SELECT DISTINCT unnest({words("text")}) FROM questions),
  e1 AS (SELECT x, regexp_replace(regexp_replace(x, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w,
           CASE x {fixed} ELSE CASE WHEN length(x) <= 2 THEN x END END AS done FROM e0),
  e2 AS (SELECT *, CASE WHEN regexp_matches(w, '^({"|".join(WHOLE_PREFIXES)})') THEN length(regexp_extract(w, '^({"|".join(WHOLE_PREFIXES)})')) ELSE {region.format("w")} END AS p1 FROM e1),
  e3 AS (SELECT *, p1 + {region.format("substr(w, p1 + 1)")} AS p2, '' AS s, '' AS rest FROM e2),
  e4 AS (SELECT * REPLACE (CASE WHEN w LIKE '%sses' THEN {cut(2)} WHEN regexp_matches(w, 'ie[ds]$') THEN CASE WHEN length(w) > 4 THEN {cut(2)} ELSE {cut(1)} END
           WHEN regexp_matches(w, '[us]s$') THEN w WHEN regexp_matches(w, '[aeiouy].+s$') THEN {cut(1)} ELSE w END AS w) FROM e3),
  e5 AS (SELECT * REPLACE (coalesce(done, CASE WHEN w IN ({after}) THEN w END) AS done, regexp_extract(w, '(eedly|eed|ingly|edly|ing|ed)$', 1) AS s) FROM e4),
  e6 AS (SELECT * REPLACE ({cut("length(s)")} AS rest) FROM e5),
  e7 AS (SELECT * REPLACE (CASE WHEN s IN ('eed', 'eedly') THEN CASE WHEN length(rest) >= p1 THEN rest || 'ee' ELSE w END
           WHEN s <> '' AND regexp_matches(rest, '[aeiouy]') THEN
             CASE WHEN regexp_matches(rest, '(at|bl|iz)$') THEN rest || 'e' WHEN regexp_matches(rest, '({DOUBLES})$') THEN {cut(1, "rest")}
                  WHEN length(rest) <= p1 AND {short.format("rest")} THEN rest || 'e' ELSE rest END ELSE w END AS w) FROM e6),
  e8 AS (SELECT * REPLACE (regexp_replace(w, '^(.+[^aeiouy])[yY]$', '\\1i') AS w) FROM e7),
  e9 AS (SELECT * FROM {suffix("e8", STEP_2, "p1", "(s <> 'li' OR regexp_matches(rest, '[cdeghkmnrt]$')) AND (s <> 'ogi' OR rest LIKE '%l')")}),
  e10 AS (SELECT * FROM {suffix("e9", STEP_3, "p1", "(s <> 'ative' OR length(rest) >= p2)")}),
  e11 AS (SELECT * FROM {suffix("e10", dict.fromkeys(STEP_4, ""), "p2", "(s <> 'ion' OR regexp_matches(rest, '[st]$'))")}),
  e12 AS (SELECT * REPLACE ({cut(1)} AS rest) FROM e11),
  stems AS (SELECT x AS term, coalesce(done, replace(CASE
      WHEN w LIKE '%e' AND (length(rest) >= p2 OR (length(rest) >= p1 AND NOT {short.format("rest")})) THEN rest
      WHEN w LIKE '%ll' AND length(rest) >= p2 THEN rest ELSE w END, 'Y', 'y')) AS stem FROM e12),"""


ENGLISH = keyword(MATCH_ANY).replace("  kept AS (SELECT * FROM places", f"{_english()}\n  kept AS (SELECT places.* REPLACE (stem AS term) FROM places JOIN stems USING (term)")
ENGLISH = ENGLISH.replace("asked AS (SELECT DISTINCT query_id, term FROM", "asked AS (SELECT DISTINCT query_id, stem AS term FROM").replace(
    f"unnest({words('text')}) AS term FROM questions) WHERE term NOT IN", f"unnest({words('text')}) AS term FROM questions) JOIN stems USING (term) WHERE term NOT IN")

# What is typed: (place in the item, alternative, piece, forbidden). Pieces of more than one indexed word are phrases.
_TYPED = {0: ((0, 0, 0, 0), (1, 0, 0, 0), (5, 0, 1, 1), (2, 1, 2, 0), (3, 1, 3, 0)), 1000: ((6, 0, 0, 0), (7, 0, 1, 1), (8, 0, 1, 1), (9, 1, 2, 0), (10, 1, 2, 0))}
_PIECES = ", ".join(f"({shift}, {place}, {alt}, {piece}, {no} = 1)" for shift, rows in _TYPED.items() for place, alt, piece, no in rows)
SEARCH_BOX = f"""typed AS (
    SELECT query_id + shift AS query_id, term, alt, piece, no, place FROM (
      SELECT query_id, ws[place + 1] AS term, shift, alt, piece, no, place FROM (SELECT query_id, {words("text")} AS ws FROM questions), (VALUES {_PIECES}) t(shift, place, alt, piece, no))
    WHERE term IS NOT NULL AND term NOT IN ({_STOPS})),
  sized AS (SELECT *, count(*) OVER (PARTITION BY query_id, piece) AS n, place - min(place) OVER (PARTITION BY query_id, piece) AS off FROM typed),
  stands AS (SELECT DISTINCT query_id, alt, piece, no, paper_id FROM (
    SELECT query_id, alt, piece, no, paper_id, k.pos - off AS s, count(*) AS c, any_value(n) AS n FROM sized JOIN kept k USING (term) GROUP BY ALL) WHERE c = n),
  wanted AS (SELECT query_id, alt, count(DISTINCT piece) AS n FROM sized WHERE NOT no GROUP BY ALL),
  hit AS (SELECT DISTINCT query_id, paper_id FROM (
    SELECT query_id, alt, paper_id FROM stands JOIN wanted USING (query_id, alt) GROUP BY ALL HAVING count(*) FILTER (NOT no) = any_value(n) AND count(*) FILTER (no) = 0)),
  asked AS (SELECT DISTINCT query_id, term FROM sized WHERE NOT no),
  matched AS (SELECT query_id, paper_id, sum(part) AS score FROM hit JOIN asked USING (query_id) JOIN scored USING (paper_id, term) GROUP BY ALL)"""
_INDEXED = f"list_filter({words('text')}, lambda w: w NOT IN ({_STOPS}))"
PAIRS = f"""asked AS (SELECT DISTINCT query_id, term FROM (
    SELECT item * 1000 + i AS query_id, unnest(terms[i + 1:i + 2]) AS term
    FROM (SELECT query_id AS item, {_INDEXED} AS terms, unnest(range(len({_INDEXED}) - 1)) AS i FROM questions)))"""

# The boolean questions, or the whole item as a phrase.
MATCH_EITHER = MATCH_BOOLEAN.replace("  hit AS (", "  boolean_hit AS (").replace("  matched AS (", f"""  {MATCH_PHRASE.split("matched AS")[0].strip().removesuffix(",").replace("hit AS (", "phrase_hit AS (")},
  hit AS (SELECT * FROM boolean_hit UNION SELECT * FROM phrase_hit),
  matched AS (""")
RENEWED = PAPERS.replace("papers AS (", "first_papers AS (") + """, papers AS (
  SELECT * REPLACE (CASE WHEN paper_id::BIGINT % 5 = 0 THEN 'renewed ' || title ELSE title END AS title) FROM first_papers)"""

_MODEL = "CASE model_tag " + " ".join(f"WHEN '{t}' THEN '{m}'" for t, m in MODEL_MAP.items()) + f" ELSE '{MODEL_MAP['gemini-3.7-flash']}' END"
_NL = "chr(10)"
_CONTEXT = f"""string_agg('[' || place || '] Title: ' || title || {_NL} || 'Abstract: ' || abstract || {_NL} || 'URL: ' || url || {_NL}
    || CASE WHEN coalesce(metadata, '') <> '' THEN {_NL} || 'Structured Metadata: ' || metadata ELSE '' END || {_NL} || {_NL}, '' ORDER BY place)"""
_PROMPT = f"""'Context:' || {_NL} || coalesce(context, 'No specific matching papers found in the local database.') || {_NL} || {_NL} || 'Question: ' || text"""

# --- gate, upsert -------------------------------------------------------------------

_OK = "(paper_id IS NOT NULL AND title IS NOT NULL AND length(title) > 0 AND abstract IS NOT NULL AND length(abstract) >= 20)"
_PAGE = f"page AS (SELECT page_id::VARCHAR AS paper_id, {_PAGE_TITLE} AS title, {page_text('html')} AS abstract, url FROM pages)"


def reasons(rules: dict[str, str]) -> str:
    names = ", ".join(f"CASE WHEN NOT coalesce({rule}, FALSE) THEN '{name}' END" for name, rule in rules.items())
    return f"concat_ws(',', {names})"


_DAILY = reasons(
    {
        "paper_id": f"length({strip('paper_id')}) BETWEEN 1 AND 64",
        "title": f"length({strip('title')}) > 0",
        "abstract": f"length({strip('abstract')}) >= 20",
        "url": "url LIKE 'https://%'",
    }
)
_SERVING = reasons(
    {
        "paper_id": "length(abstract) % 7 <> 0",
        "categories": "CASE WHEN length(abstract) > 3000 THEN length(categories) * 100 ELSE length(categories) END <= 255",
        "metadata": "metadata IS NULL OR length(abstract) % 5 <> 0",
        "embedding": f"embedding IS NULL OR length(abstract) >= 2000 OR {DIM - 1} = {DIM}",
    }
)
_SIDES = """known AS (SELECT *, 'old' AS touched FROM customer WHERE c_mktsegment <> 'MACHINERY'),
  updates AS (SELECT c_custkey, 'New ' || c_name AS c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, NULL::VARCHAR AS c_mktsegment, 'new' AS touched
              FROM customer WHERE c_acctbal > 4000)"""
_UPSERT_FULL = f"WITH {_SIDES} SELECT * FROM known ANTI JOIN updates USING (c_custkey) UNION ALL BY NAME SELECT * FROM updates"

_FULL = """'{"core_method": "m' || k || '", "dataset_used": "' || kind || '", "key_findings": "f"}'"""
_NS = "'Not specified'"
_METHOD = r"(?i)\b(?:we (?:propose|present|introduce|develop)|using|based on)\s+([^.,;:]+)"
_DATASET = r"(?i)\b(?:dataset|data set|data from|benchmark|corpus|evaluated on|trained on)\s+([^.,;:]+)"
_FINDINGS = r"(?i)\b(?:we (?:show|find|demonstrate|observe)|results? (?:show|suggest|indicate))\s+(?:that\s+)?([^.;:]+)"


def cues(text: str) -> str:
    """The extracted fields as one JSON text; quotes, backslashes and control characters are escaped by to_json."""
    value = lambda p: f"coalesce(nullif(trim(regexp_extract({text}, '{p}', 1)), ''), {_NS})"
    return f"to_json(struct_pack(core_method := {value(_METHOD)}, dataset_used := {value(_DATASET)}, key_findings := {value(_FINDINGS)}))::VARCHAR"


_DEFAULT_RECORD = """'{"core_method":"Not specified","dataset_used":"Not specified","key_findings":"Not specified"}'"""
_EMBED = f"""WITH tokens AS (SELECT doc_id, unnest({words("text")}) AS term FROM documents),
  placed AS (SELECT doc_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % {DIM} AS i,
                    1 - 2 * (('0x' || substr(md5(term), 9, 2))::BIGINT % 2) AS sign FROM tokens),
  summed AS (SELECT doc_id, i, sum(sign)::DOUBLE AS x FROM placed GROUP BY ALL),
  norms AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM summed GROUP BY 1)
  SELECT doc_id, i::INT AS i, round((x / norm)::FLOAT::DOUBLE, 6) AS x FROM summed JOIN norms USING (doc_id) WHERE x <> 0"""
_DAILY_MERGED = f"""WITH {FEED} SELECT {_FEED_COLUMNS}, TIMESTAMP '2026-02-02 00:00:00' AS ingested_at,
  CASE WHEN url LIKE 'https%' THEN 'kept ' || paper_id END AS metadata, CASE WHEN url LIKE 'https%' THEN 1 END::BIGINT AS dim FROM feed"""

_INVERTED = f"""WITH {PAPERS}, {POSTINGS} SELECT term, paper_id, CASE WHEN pos < n_title THEN 'title' ELSE 'abstract' END AS field,
        count(*) AS tf, string_agg(pos::VARCHAR, ' ' ORDER BY pos) AS positions, any_value(dl) AS dl
        FROM kept JOIN lengths USING (paper_id) GROUP BY 1, 2, 3"""

ORACLE = {
    "clean_text": f"WITH {CLEAN} SELECT paper_id, title, abstract, categories FROM clean",
    "authors_join": f"WITH {CLEAN} SELECT paper_id, authors FROM clean",
    "dates_years": """SELECT o_orderkey, d AS published_date, year(d)::INT AS published_year FROM (
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS d FROM orders)""",
    "snapshot_scan": f"WITH {CLEAN} SELECT * EXCLUDE (lang) FROM clean",
    "feed_scan": f"WITH {FEED} SELECT * FROM feed",
    "feed_parse": f"WITH {FEED} SELECT * FROM feed",
    "lake_by_year": """SELECT year(o_orderdate)::INT AS published_year, o_orderstatus, count(*) AS orders,
        sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY ALL""",
    "gate_accept": f"WITH {PAPERS} SELECT paper_id, title, abstract FROM papers WHERE {_OK}",
    "gate_reject": f"""WITH {PAPERS} SELECT paper_id, title, abstract,
        {reasons({"title": "length(title) > 0", "abstract": "length(abstract) >= 20"})} AS reject_reasons FROM papers WHERE NOT {_OK}""",
    "gate_report": f"""WITH {PAPERS} SELECT count(*) AS total, count(*) FILTER (WHERE {_OK}) AS valid, count(*) FILTER (WHERE NOT {_OK}) AS invalid,
        count(*) FILTER (WHERE NOT {_OK}) / count(*)::DOUBLE AS error_rate FROM papers""",
    "gate_enforced": f"WITH {PAPERS} SELECT paper_id, CASE WHEN {_OK} THEN 'lake' ELSE 'dlq' END AS went_to FROM papers",
    "daily_gate": f"WITH {_PAGE} SELECT paper_id, {_DAILY} = '' AS ok, {_DAILY} AS reject_reasons FROM page",
    "serving_constraints": f"WITH {PAPERS} SELECT CASE WHEN length(abstract) % 7 <> 0 THEN paper_id END AS paper_id, {_SERVING} = '' AS ok, {_SERVING} AS reject_reasons FROM papers",
    "dedupe_latest": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "upsert_full": _UPSERT_FULL,
    "upsert_published": _UPSERT_FULL,
    "upsert_partial": f"""WITH {_SIDES} SELECT coalesce(k.c_custkey, u.c_custkey) AS c_custkey,
        CASE WHEN u.c_custkey IS NOT NULL THEN u.c_name ELSE k.c_name END AS c_name,
        CASE WHEN u.c_custkey IS NULL THEN k.c_nationkey END AS c_nationkey,
        CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE k.c_acctbal END AS c_acctbal,
        k.c_mktsegment, CASE WHEN u.c_custkey IS NOT NULL THEN 'now' ELSE k.touched END AS touched
        FROM known k FULL JOIN updates u ON k.c_custkey = u.c_custkey""",
    "staging_rows": f"""WITH {PAPERS} SELECT paper_id, title, abstract, 'by ' || paper_id AS authors, categories, url, published_date, published_year,
        TIMESTAMP '2026-01-02 00:00:00' AS ingested_at, round(list_sum(embedding::DOUBLE[]), 4) AS vector_sum, metadata AS metadata_json FROM papers""",
    "vector_text": """SELECT vec_id, (unnest(range(len(embedding))))::INT AS i, round(unnest(embedding)::DOUBLE, 6) AS x FROM embeddings""",
    "cosine_to_mean": """WITH parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
        means AS (SELECT label, i, avg(x) AS x FROM parts GROUP BY ALL), centers AS (SELECT label, list(x ORDER BY i) AS center FROM means GROUP BY 1)
        SELECT vec_id, round(list_cosine_distance(embedding::DOUBLE[], center), 6) AS distance FROM embeddings JOIN centers USING (label)""",
    "dense_topk": dense_query(),
    "dense_blocks": dense_query(),
    "lsh_topk": lsh_query(tables=3, bits=6, probes=26),
    "lsh_all_cells": dense_query("embedding IS NOT NULL"),
    "cells_topk": cells_query(),
    "inverted_index": _INVERTED,
    "index_written": _INVERTED,
    "keyword_topk": f"WITH {keyword(MATCH_ALL)} {_SPARSE_OUT}",
    "keyword_any": f"WITH {keyword(MATCH_ANY)} {_SPARSE_OUT}",
    "keyword_bounded": f"WITH {keyword(MATCH_ANY)} {_SPARSE_OUT}",
    "keyword_weighted": f"WITH {keyword(MATCH_ANY, 'CASE WHEN pos < n_title THEN 1e0 ELSE 0.4e0 END')} {_SPARSE_OUT}",
    "keyword_phrase": f"WITH {keyword(MATCH_PHRASE)} {_SPARSE_OUT}",
    "keyword_boolean": f"WITH {keyword(MATCH_BOOLEAN)} {_SPARSE_OUT}",
    "keyword_stemmed": f"WITH {STEMMED} {_SPARSE_OUT}",
    "keyword_english": f"WITH {ENGLISH} {_SPARSE_OUT}",
    "search_box": f"WITH {', '.join([PAPERS, QUESTIONS, POSTINGS, postings(), SEARCH_BOX, SPARSE])} {_SPARSE_OUT}",
    "keyword_pairs": f"WITH {keyword(MATCH_ALL).replace(ASKED, PAIRS)} {_SPARSE_OUT}",
    "rrf_fuse": f"WITH {keyword(MATCH_ANY)}, {DENSE}, {FUSED} SELECT * REPLACE (round(rrf_score, 9) AS rrf_score) FROM fused",
    "hybrid_search": _HYBRID_OUT,
    "hybrid_stored": _HYBRID_OUT,
    "hybrid_boolean": _HYBRID_OUT.replace(MATCH_ALL, MATCH_EITHER),
    "search_after_merge": _HYBRID_OUT.replace(PAPERS, RENEWED),
    "search_counts": f"WITH {keyword(MATCH_ALL)} SELECT query_id, count(paper_id) AS count FROM questions LEFT JOIN sparse USING (query_id) GROUP BY 1",
    "hybrid_counts": f"WITH {HYBRID}, {best(5)} SELECT query_id, count(paper_id) AS count FROM questions LEFT JOIN best USING (query_id) GROUP BY 1",
    "rag_context": f"""WITH {HYBRID}, {best(3)}, contexts AS (
        SELECT query_id, {_CONTEXT} AS context, string_agg(concat_ws('|', paper_id, published_date::VARCHAR, metadata), ';' ORDER BY place) AS matched
        FROM best JOIN papers USING (paper_id) GROUP BY 1)
        SELECT query_id, {_MODEL} AS model, {_PROMPT} AS prompt, coalesce(matched, '') AS matched FROM questions LEFT JOIN contexts USING (query_id)""",
    "rag_no_match": f"""WITH {keyword(MATCH_ALL)}, contexts AS (
        SELECT query_id, {_CONTEXT} AS context, count(*) AS n
        FROM (SELECT query_id, paper_id, rank_sparse AS place FROM sparse WHERE rank_sparse <= 3) JOIN papers USING (paper_id) GROUP BY 1)
        SELECT query_id, {_PROMPT} AS prompt, coalesce(n, 0) AS n FROM questions LEFT JOIN contexts USING (query_id)""",
    "json_fuse": """SELECT event_id, concat_ws('. ', event_type, CASE WHEN value > 10 THEN props END,
        'k=' || json_extract_string(props, '$.k'), event_type) AS embedding_text FROM events""",
    "response_recover": f"""WITH e AS (SELECT event_id, event_type AS kind, value, json_extract_string(props, '$.k') AS k FROM events)
        SELECT event_id,
          CASE WHEN kind IN ('click', 'view') THEN 'json' WHEN kind = 'error' THEN 'text' WHEN value > 20 THEN 'json' WHEN value > 10 THEN 'text' ELSE 'none' END AS recovered,
          CASE WHEN kind IN ('click', 'view', 'error') THEN 'm' || k WHEN value > 20 THEN k WHEN value > 10 THEN 'm' || k ELSE 'Extraction Error' END AS core_method,
          CASE WHEN kind IN ('click', 'view') THEN kind WHEN kind = 'error' OR value > 20 THEN {_NS} WHEN value > 10 THEN kind ELSE 'Extraction Error' END AS dataset_used,
          CASE WHEN kind IN ('click', 'view') THEN 'f' WHEN kind = 'error' THEN 'cut sho' WHEN value > 20 THEN {_NS} WHEN value > 10 THEN 'f' ELSE 'Extraction Error' END AS key_findings
        FROM e""",
    "extract_metadata": f"""SELECT doc_id, CASE WHEN lang = 'es' THEN {_DEFAULT_RECORD} ELSE {cues("'We propose ' || source || ' nets. Evaluated on ' || lang || ' texts. We show that ' || text")} END AS metadata_json
        FROM documents""",
    "enrich_in_batches": f"""SELECT doc_id, CASE WHEN lang = 'es' THEN {_DEFAULT_RECORD} ELSE {cues("'We propose ' || source || ' nets. Evaluated on ' || lang || ' texts. We show that ' || text")} END AS metadata_json
        FROM documents""",
    "enrich_slices": f"""SELECT doc_id, CASE WHEN lang = 'es' THEN {_DEFAULT_RECORD} ELSE {cues("'We propose ' || source || ' nets. Evaluated on ' || lang || ' texts. We show that ' || text")} END AS metadata_json
        FROM documents""",
    "default_fill": f"""SELECT doc_id, CASE WHEN quality IS NOT NULL THEN '{{"quality":' || quality || ',"toxic":' || toxic || '}}' ELSE {_DEFAULT_RECORD} END AS metadata_json
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "embed_hash": _EMBED,
    "embed_batches": _EMBED,
    "embed_balanced": _EMBED,
    "pipeline_load": f"""WITH {CLEAN} SELECT * EXCLUDE (lang), CASE WHEN trim(abstract) = '' THEN {_DEFAULT_RECORD} ELSE {cues("abstract")} END AS metadata,
        {DIM}::BIGINT AS dim FROM clean WHERE length(title) > 0 AND length(abstract) >= 20""",
    "stage_tables": f"""WITH {CLEAN}, held AS (
        SELECT *, CASE WHEN trim(abstract) = '' THEN {_DEFAULT_RECORD} ELSE {cues("abstract")} END AS metadata FROM clean)
        SELECT 'lake' AS stage, paper_id, title, abstract, published_year, NULL::VARCHAR AS metadata, NULL::VARCHAR AS dim FROM held
        UNION ALL SELECT 'metadata', paper_id, title, abstract, published_year, metadata, NULL FROM held
        UNION ALL SELECT 'embeddings', paper_id, title, abstract, published_year, metadata, '{DIM}' FROM held""",
    "daily_merge": _DAILY_MERGED,
    "feed_stream": _DAILY_MERGED,
}

# What is stored as typed values reads like the text it was made from.
ORACLE |= {
    "json_fuse_variant": ORACLE["json_fuse"],
    "rag_context_variant": ORACLE["rag_context"],
    "metadata_fields": f"""WITH {PAPERS} SELECT json_extract_string(metadata, '$.lang') AS lang, json_extract_string(metadata, '$.source') AS source,
        json_extract_string(metadata, '$.none') AS "none", count(*) AS n FROM papers GROUP BY 1, 2, 3""",
}
