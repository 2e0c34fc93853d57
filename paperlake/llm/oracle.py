"""SQL for the queries of this package that SQL can express."""

from paperlake.llm.chat import CONT, CONTROL, END, START

URL_FILTER = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                          ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
found AS (
  SELECT host, path, arg_max(h || p, length(h) * 1000 + length(p)) AS rule, arg_max(v, length(h) * 1000 + length(p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN found USING (host, path)"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(place % 3 + 1)::INT] AS w, 2 * source_size AS room, sum(source_size) OVER () AS total FROM ranked),
levels AS (
  SELECT *, (total * 1.5::DOUBLE - coalesce(sum(room) OVER (ORDER BY room::DOUBLE / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY room::DOUBLE / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
level AS (SELECT arg_min(level, (room::DOUBLE / w) * 1e6 + place) AS level FROM levels WHERE room >= level * w),
goals AS (SELECT l.source, l.source_size, least(l.room::DOUBLE, coalesce(level.level * w, l.room::DOUBLE)) AS target FROM levels l, level),
placed AS (
  SELECT doc_id, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, round(target) - start)) + greatest(0, least(size, round(target) - start - source_size)))::BIGINT AS taken
FROM placed"""


def _escaped(text: str) -> str:
    text = rf"replace({text}, '\', '\\')"
    for control in CONTROL:
        text = f"replace({text}, '{control}', '{control[0]}\\{control[1:]}')"
    return text


CHAT_FORMAT = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), false) AS merged FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_escaped("text")}) + CASE WHEN merged THEN {len(CONT)}
           ELSE length(replace({_escaped("role")}, chr(10), '<|nl|>')) + {len(START) + 1 + len(END)} END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id"""

SUBSTRING_DEDUP = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM texts),
windows AS (
  SELECT r, p, n, word, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS w FROM words),
hashed AS (SELECT r, p, word, CASE WHEN p + 34 <= n THEN md5(w) END AS h FROM windows),
counted AS (SELECT r, p, word, CASE WHEN h IS NOT NULL AND count(*) OVER (PARTITION BY h) > 1 THEN p END AS start FROM hashed),
covered AS (SELECT r, p, word, coalesce(p - max(start) OVER (PARTITION BY r ORDER BY p) <= 34, false) AS removed FROM counted),
done AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (removed) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT removed), '') AS kept
  FROM covered GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN done USING (r)"""

JACCARD_JOIN = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents),
words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM texts),
windows AS (
  SELECT r, p, n, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS w FROM words),
sets AS (SELECT DISTINCT r, md5(w) AS s FROM windows WHERE p + 4 <= n OR (n < 5 AND p = 1)),
sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(r, x) AS (SELECT r, r FROM texts UNION SELECT reached.r, both_ways.b FROM reached JOIN both_ways ON reached.x = both_ways.a)
SELECT t.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other.doc_id) AS component_id
FROM texts t JOIN reached USING (r) JOIN texts other ON other.r = x LEFT JOIN sizes ON sizes.r = t.r GROUP BY t.r, t.doc_id"""


def _codes(positions: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round assigns all parts, then takes the floor of the means of entries that are used."""

    def assigned(book: str) -> str:
        far = "list_sum(list_transform(list_zip(v, b), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"
        return f"SELECT r, p, v, min((({far})::BIGINT, e)) AS hit FROM parts JOIN {book} USING (p) GROUP BY r, p, v"

    steps = []
    for i in range(rounds):
        steps.append(f"""
a{i} AS MATERIALIZED ({assigned(f"book{i}")}),
s{i} AS (SELECT p, e, k, sum(x)::BIGINT AS s, count(*) AS n FROM (
  SELECT p, hit[2] AS e, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM a{i}) GROUP BY p, e, k),
m{i} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS b FROM s{i} GROUP BY p, e),
book{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{i}.b, book{i}.b) AS b FROM book{i} LEFT JOIN m{i} USING (p, e)),""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, list_slice(v, p * (len(v) // {positions}) + 1, (p + 1) * (len(v) // {positions})) AS v FROM kept, range({positions}) AS t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v AS b FROM parts WHERE r <= {entries}),{"".join(steps)}
last AS MATERIALIZED ({assigned(f"book{rounds}")}),
coded AS (SELECT r, string_agg(lpad(lower(to_hex(hit[2])), 2, '0'), '' ORDER BY p) AS code, sum(hit[1])::BIGINT AS error FROM last GROUP BY r),
digest AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, k)) AS d FROM (
  SELECT p, e, unnest(b) AS x, generate_subscripts(b, 1) AS k FROM book{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, d AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word"
RESAMPLING = rf"""
WITH found AS (SELECT doc_id, {_WORDS} FROM documents),
wanted AS (SELECT {_WORDS} FROM benchmark),
crc AS (SELECT list_transform(range(256), lambda n: list_reduce(
  list_concat([n], range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS steps),
spelt AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM found UNION SELECT word FROM wanted)),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
    lambda c, b: xor(steps[xor(c & 255, b) + 1], c >> 8))) % 10000 AS bucket FROM spelt, crc),
corpus AS (SELECT bucket, count(*) AS s FROM found JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM found)::DOUBLE AS s_all, (SELECT count(*) FROM wanted)::DOUBLE AS t_all),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
  FROM corpus LEFT JOIN target USING (bucket), sums),
weights AS (
  SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM found JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight, coalesce(weight, 0)::BIGINT
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored s LEFT JOIN places USING (doc_id)"""

ORACLE = {"op6_jaccard_join": JACCARD_JOIN, "op8_substring_dedup": SUBSTRING_DEDUP, "op1_url_filter": URL_FILTER, "op3_mixing": MIXING, "op7_chat_format": CHAT_FORMAT, "op12_vector_codes": _codes(), "op13_resampling": RESAMPLING}
