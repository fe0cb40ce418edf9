"""The same results in DuckDB SQL, written independently of the package's expressions."""

from __future__ import annotations

from checks.queries import NOTES
from jobweave import fixed
from jobweave.config import JobConfig
from jobweave.functions.prompts import CLASSIFICATION_INSTRUCTIONS, TRANSLATION_INSTRUCTIONS

CONFIG = JobConfig()
NL = "chr(10)"
SPACE = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"\p{L}+"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(e: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({e}, {lit(pattern)}, {lit(by)}, 'g')"


# --- cleaning -------------------------------------------------------------------------


def entities(e):
    for name, character in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        e = sub(e, f"&{name};?", character)
    return e


def tags(e):
    return sub(e, r"<[^<]+?>")


def urls(e):
    return sub(e, rf"https?://(?:www\.)?[^{SPACE}/$.?#][^\n][^{SPACE}]*")


def notices(e):
    for notice in ("You need to enable JavaScript to run this app", "reCAPTCHA check page"):
        e = f"replace({e}, {lit(notice)}, ' ')"
    return e


def stars(e):
    return sub(e, rf"\*[{SPACE}*]*")


def nbsp(e):
    return f"replace({e}, chr(160), ' ')"


def squeeze(e):
    return sub(e, f"[{SPACE}]{{2,}}")


def strip(e):
    return sub(e, f"^[{SPACE}]+|[{SPACE}]+$", "")


def cleaned(e):
    return strip(squeeze(nbsp(stars(notices(urls(tags(entities(e))))))))


# --- stand-in inputs ----------------------------------------------------------------------

FIRST_LINE = f"string_split(text, {NL})[1]"
ADS = f"""ads AS (SELECT CAST(doc_id AS VARCHAR) AS id, {FIRST_LINE} AS title, text AS description, lang
FROM documents)"""
GAPPY = f"""gappy AS (SELECT CAST(d.doc_id AS VARCHAR) AS id,
  CASE WHEN l.quality = 0 THEN NULL ELSE string_split(d.text, {NL})[1] END AS title,
  CASE WHEN l.toxic = 1 THEN '<br> ' || {NL} WHEN l.quality IS NOT NULL THEN d.text END AS description,
  d.lang
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def four(e):
    return f"CASE WHEN length(CAST({e} AS VARCHAR)) >= 4 THEN CAST({e} AS VARCHAR) ELSE lpad(CAST({e} AS VARCHAR), 4, '0') END"


def noted(key, text):
    cases = " ".join(f"WHEN {n} THEN {lit(tail)}" for n, tail in NOTES.items())
    return f"{text} || CASE {key} % 5 {cases} ELSE '' END"


LABELS = f"""taxonomy AS (SELECT {four('item_id')} AS code, regexp_extract(text, '^[^.,\n]*', 0) AS label,
  {noted('item_id', 'text')} AS description FROM benchmark)"""


def position(headings):
    return "coalesce(" + ", ".join(
        f"nullif(coalesce(list_position(lines, {lit(h)}), 0), 0)" for h in headings
    ) + ", 0)"


def section(at, marker):
    rest = f"list_slice(lines, {at} + 1, len(lines))"
    marks = f"list_transform({rest}, lambda x: starts_with(x, {lit(marker)}))"
    end = f"coalesce(nullif(coalesce(list_position({marks}, false), 0), 0), len({rest}) + 1)"
    return (
        f"CASE WHEN {at} = 0 THEN []::VARCHAR[] ELSE "
        f"list_concat([lines[{at}]], list_slice({rest}, 1, {end} - 1)) END"
    )


def info(source, key, text, paragraphs, name):
    """Three CTEs, the last one is ``name(key, info)``."""
    tasks, examples = section("task_at", "("), section("example_at", "-")
    head = "[lines[1]]"
    if paragraphs == ["description"]:
        whole = head
    elif "tasks" in paragraphs:
        whole = f"CASE WHEN task_at = 0 THEN {head} ELSE list_concat(list_concat({head}, {tasks}), {examples}) END"
    else:
        whole = f"list_concat({head}, {examples})"
    return f"""{name}_lines AS (SELECT {key}, list_transform(string_split({text}, {NL}), lambda x: {strip('x')}) AS lines FROM {source}),
{name}_at AS (SELECT *, {position(fixed.TASK_HEADINGS)} AS task_at, {position(fixed.EXAMPLE_HEADINGS)} AS example_at FROM {name}_lines),
{name} AS (SELECT {key}, array_to_string({whole}, {NL}) AS info FROM {name}_at)"""


# --- answers --------------------------------------------------------------------------------

CODE = four("p_size")
RAW = f"""answers AS (SELECT *, p_partkey % 9 AS kind, {CODE} AS code FROM part),
parsed AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS lang, kind,
  kind NOT IN (2, 4, 7) AS parsed,
  kind NOT IN (1, 2, 4, 7) AS codable,
  CASE WHEN kind IN (0, 1, 6, 8) THEN code WHEN kind = 5 THEN '9' || code END AS class_code,
  CASE kind WHEN 0 THEN 0.5::DOUBLE WHEN 6 THEN 0.5::DOUBLE WHEN 8 THEN 0.5::DOUBLE WHEN 1 THEN 0.25::DOUBLE
    WHEN 3 THEN 7.5::DOUBLE WHEN 5 THEN 1::DOUBLE END AS likelihood
  FROM answers)"""
CHECKED = f"""{RAW}, {LABELS},
checked AS (SELECT p.id, p.lang, p.codable AND t.code IS NOT NULL AS codable, p.class_code,
  CASE WHEN t.code IS NOT NULL THEN p.likelihood END AS likelihood, t.label AS label_code,
  CASE WHEN NOT parsed THEN 'parse_error' WHEN t.code IS NULL THEN 'invalid_code' ELSE 'ok' END AS outcome
  FROM parsed p LEFT JOIN taxonomy t ON p.class_code = t.code)"""

# --- prompts -----------------------------------------------------------------------------------


def filled(template: str, **values: str) -> str:
    """SQL text concatenation of a template; a null value reads None."""
    parts = []
    while template:
        places = [(template.find("{" + n + "}"), n) for n in values]
        places = [(at, n) for at, n in places if at >= 0]
        if not places:
            parts.append(lit(template))
            break
        at, name = min(places)
        if at:
            parts.append(lit(template[:at]))
        parts.append(f"coalesce({values[name]}, 'None')")
        template = template[at + len(name) + 2 :]
    return " || ".join(parts)


def turn(role, content):
    m = CONFIG.chat
    return f"{lit(m.before_role)} || {role} || {lit(m.after_role)} || {content} || {lit(m.after_content)}"


def chat(*messages):
    return " || ".join([*(turn(lit(r), c) for r, c in messages), lit(CONFIG.chat.generation)])


LANGUAGES = "languages(language, lang, lang_iso_3) AS (VALUES " + ", ".join(
    f"({lit(a)}, {lit(b)}, {lit(c)})" for a, b, c in fixed.LANGUAGES
) + ")"


def translation_chat(title, description, language):
    values = {"title": title, "description": description, "language": language,
              "format_instructions": lit(TRANSLATION_INSTRUCTIONS)}
    extraction = chat(("system", filled(fixed.EXTRACTION_SYSTEM, **values)),
                      ("user", filled(fixed.EXTRACTION_USER, **values)))
    translation = chat(("system", filled(fixed.TRANSLATION_SYSTEM, **values)),
                       ("user", filled(fixed.TRANSLATION_USER, **values)))
    return f"CASE WHEN {language} = 'English' THEN {extraction} ELSE {translation} END"


def query_text(e):
    return f"{lit('Instruct: ' + fixed.RETRIEVAL_TASK + chr(10) + 'Query: ')} || {e}"


# --- vectors ------------------------------------------------------------------------------------


def counts(source, keys, text, dimensions, name):
    """``name(keys, bucket, n, norm)``: word counts per hash bucket and the vector's length."""
    return f"""{name}_words AS (SELECT {keys}, unnest(regexp_extract_all(lower({text}), {lit(WORD)})) AS w FROM {source}),
{name}_n AS (SELECT {keys}, CAST('0x' || left(md5(w), 8) AS BIGINT) % {dimensions} AS bucket, count(*) AS n
  FROM {name}_words GROUP BY ALL),
{name} AS (SELECT *, sqrt(sum(n * n) OVER (PARTITION BY {keys})) AS norm FROM {name}_n)"""


INDEX = ", ".join([
    LABELS,
    info("taxonomy", "code", "description", ["description", "tasks", "examples"], "chunk_info"),
    f"chunks AS (SELECT t.code, t.label, {strip('c.info')} AS chunk FROM taxonomy t JOIN chunk_info c USING (code))",
    info("chunks", "code", "chunk", ["description", "examples"], "shown"),
    counts("chunks", "code", "chunk", CONFIG.dimensions, "cv"),
])


def searched(source: str, name: str = "hits") -> str:
    """``name(id, code, pos)``: labels near title, description, keywords of ``source`` in order."""
    return f"""{INDEX},
{name}_asked AS (
  SELECT id, 1 AS field, {query_text('title_en')} AS q FROM {source} WHERE title_en IS NOT NULL
  UNION ALL SELECT id, 2, {query_text('description_en')} FROM {source} WHERE description_en IS NOT NULL
  UNION ALL SELECT id, 3, {query_text('keywords')} FROM {source} WHERE keywords IS NOT NULL),
{counts(name + '_asked', 'id, field', 'q', CONFIG.dimensions, name + '_qv')},
{name}_dot AS (SELECT q.id, q.field, c.code, sum(q.n * c.n / (q.norm * c.norm)) AS s
  FROM {name}_qv q JOIN cv c USING (bucket) GROUP BY ALL),
{name}_ranked AS (SELECT a.id, a.field, k.code,
  row_number() OVER (PARTITION BY a.id, a.field ORDER BY round(coalesce(s, 0), 6) DESC, k.code) AS place
  FROM {name}_asked a CROSS JOIN chunks k
  LEFT JOIN {name}_dot d ON d.id = a.id AND d.field = a.field AND d.code = k.code),
{name} AS (SELECT id, code, min(field * 10 + place) AS pos FROM {name}_ranked
  WHERE place <= {CONFIG.top_k} GROUP BY id, code)"""


def classification_chat(title: str, description: str, categories: str) -> str:
    body = filled(
        fixed.CLASSIFICATION_USER, title=title, description=description,
        proposed_categories=categories, format_instructions=lit(CLASSIFICATION_INSTRUCTIONS),
    )
    return chat(("system", lit(fixed.CLASSIFICATION_SYSTEM)), ("user", body))


def prompts(source: str) -> str:
    """``prompted(id, prompt)`` on top of ``searched(source)``."""
    whole = classification_chat("s.title_en", "s.description_en", "coalesce(p.categories, '')")
    return f"""{searched(source)},
proposed AS (SELECT id, string_agg(code || ': ' || label || ' - ' || info, {NL} || {NL} ORDER BY pos) AS categories
  FROM hits JOIN chunks USING (code) JOIN shown USING (code) GROUP BY id),
prompted AS (SELECT s.id, {whole} AS prompt
  FROM {source} s LEFT JOIN proposed p USING (id))"""


SEARCHED_ADS = f"""{GAPPY}, found AS (SELECT id, lang, title AS title_en, description AS description_en,
  CASE WHEN lang <> 'es' THEN array_to_string(string_split(title, ' ')[1:3], ', ') END AS keywords FROM gappy)"""


def words_of(e):
    return f"list_distinct(regexp_extract_all(lower({e}), {lit(WORD)}))"


def coded(source: str) -> str:
    """``coded(id, class_code, label, likelihood)``: the stand-in's first proposed category."""
    return f"""{searched(source)},
firsts AS (SELECT id, arg_min(code, pos) AS code FROM hits GROUP BY id),
judged AS (SELECT s.id, f.code AS class_code, c.label,
  {words_of("coalesce(s.title_en, 'None') || ' ' || coalesce(s.description_en, 'None')")} AS ad_words,
  {words_of(f"string_split(c.label || ' - ' || i.info, {NL})[1]")} AS label_words
  FROM {source} s LEFT JOIN firsts f USING (id) LEFT JOIN chunks c ON c.code = f.code
  LEFT JOIN shown i ON i.code = f.code),
coded AS (SELECT id, class_code, label, CASE WHEN class_code IS NULL THEN NULL
  WHEN len(label_words) = 0 THEN 0 ELSE len(list_intersect(ad_words, label_words)) / len(label_words) END AS likelihood
  FROM judged)"""


def translated(source: str, title: str, description: str, keys: str = "id, lang") -> str:
    """``translated``: the stand-in translator's fields for ``source``."""
    return f"""said AS (SELECT {keys}, coalesce({title}, 'None') AS title_en, coalesce({description}, 'None') AS description_en FROM {source}),
said_words AS (SELECT id, unnest(regexp_extract_all(lower(description_en), {lit(WORD)})) AS w FROM said),
said_counts AS (SELECT id, w, count(*) AS n FROM said_words WHERE length(w) >= 4 GROUP BY ALL),
said_top AS (SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY n DESC, w) AS place FROM said_counts),
said_keywords AS (SELECT id, list(w ORDER BY place) AS keywords FROM said_top WHERE place <= 5 GROUP BY id),
translated AS (SELECT {keys}, description_en NOT IN ('', 'None') AS job_desc_extracted, title_en, description_en,
  coalesce(keywords, []::VARCHAR[]) AS keyword_list FROM said LEFT JOIN said_keywords USING (id))"""


# --- language -------------------------------------------------------------------------------------

PROFILE = f"""profile_words AS (SELECT lang, unnest(regexp_extract_all(lower(text), {lit(WORD)})) AS token FROM documents),
profile AS (SELECT token, lang, count(*) AS n FROM profile_words GROUP BY ALL),
vocabulary AS (SELECT count(DISTINCT token) AS v FROM profile),
totals AS (SELECT lang, sum(n) AS total FROM profile GROUP BY lang)"""


def detected(source, key, text):
    return f"""{PROFILE},
spoken AS (SELECT {key}, unnest(regexp_extract_all(lower({text}), {lit(WORD)})) AS token FROM {source}),
spoken_n AS (SELECT {key}, token, count(*) AS times FROM spoken GROUP BY ALL),
means AS (SELECT s.{key}, t.lang, sum(times * ln((coalesce(p.n, 0) + 1) / (t.total + v.v))) / sum(times) AS m
  FROM spoken_n s CROSS JOIN totals t CROSS JOIN vocabulary v
  LEFT JOIN profile p ON p.token = s.token AND p.lang = t.lang GROUP BY ALL),
shares AS (SELECT *, exp(m) / sum(exp(m)) OVER (PARTITION BY {key}) AS score,
  row_number() OVER (PARTITION BY {key} ORDER BY m DESC, lang DESC) AS place FROM means),
spoken_lang AS (SELECT {key}, lang, score FROM shares WHERE place = 1)"""


def detect_on(source):
    return f"""cleaned AS (SELECT id, title, description, {cleaned('description')} AS dc, {cleaned('title')} AS title_clean FROM {source}),
fallen AS (SELECT id, coalesce(description, title) AS description, title_clean,
  CASE WHEN coalesce(dc, title_clean) = '' THEN title_clean ELSE coalesce(dc, title_clean) END AS description_clean FROM cleaned),
{detected('fallen', 'id', 'description_clean')},
detected AS (SELECT f.*, score, CASE WHEN score < 0.4 OR s.lang IS NULL OR s.lang NOT IN
  ({', '.join(lit(code) for _, code, _ in fixed.LANGUAGES)}) THEN 'un' ELSE s.lang END AS lang
  FROM fallen f LEFT JOIN spoken_lang s USING (id))"""


def noticed(e):
    return f"{e} || CASE WHEN doc_id % 2 = 0 THEN {lit(chr(10) + 'You need to enable JavaScript to run this app.')} ELSE 'reCAPTCHA check page' END"


def starred(e):
    return sub(e, r"\. ", ". * ** *\n* ")


def blanked(e):
    return f"chr(160) || ' ' || chr(9) || replace({e}, ', ', ',' || chr(160) || ' ') || ' ' || chr(8195) || chr(31)"


def documents_line(e):
    return f"SELECT doc_id, {e} AS line FROM documents"


def pages_text(e):
    return f"SELECT page_id, {e} AS text FROM pages"


def sections(paragraphs):
    text = noted("doc_id", "text")
    return f"WITH {info('documents', 'doc_id', text, paragraphs, 'i')} SELECT doc_id, info FROM i"


HALF = f"""p AS (SELECT *, doc_id % 10 AS kind, {FIRST_LINE} AS t FROM documents)"""

SHARD = """least(3, (row_number() OVER (ORDER BY {order}) - 1) // greatest(1, count(*) OVER () // 3) + 1)"""
NEIGHBOURS = """SELECT a.vec_id, a.label AS own, b.vec_id AS neighbour, b.label,
  round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
  FROM embeddings a CROSS JOIN embeddings b"""
TOPK = f"""WITH s AS ({NEIGHBOURS}),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbour) AS place FROM s)
SELECT vec_id, place, neighbour, score FROM r WHERE place <= 5"""
CODES = f"""WITH {SEARCHED_ADS}, {searched('found')}
SELECT f.id, coalesce(string_agg(h.code, ',' ORDER BY h.pos), '') AS codes FROM found f LEFT JOIN hits h USING (id) GROUP BY f.id"""
WINDOWS = f"""words AS (SELECT doc_id, list_filter(regexp_split_to_array(text, {lit(f'[{SPACE}]+')}), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, w, unnest(range(0, CAST(greatest(ceil((len(w) - 100) / 90), 0) AS BIGINT) + 1)) AS chunk_no
  FROM words WHERE len(w) > 0)"""



def held_out(own: int) -> str:
    """One half of the documents scored with the profile of the other."""
    scored = detected("own", "doc_id", "text").replace(
        "AS token FROM documents)", f"AS token FROM documents WHERE doc_id % 2 <> {own})")
    return f"""SELECT * FROM (WITH own AS (SELECT * FROM documents WHERE doc_id % 2 = {own}), {scored}
SELECT own.doc_id, spoken_lang.lang AS lang, round(score, 6) AS score FROM own LEFT JOIN spoken_lang USING (doc_id))"""


STAGE_ROWS = "SELECT lang, count(*) AS n, count(DISTINCT doc_id) AS ids, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang"

ORACLES = {
    "na_normalise": """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'na' END AS event_type FROM events""",
    "head_n": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100",
    "lang_filter": "SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE lang IN ('fr', 'de') GROUP BY lang",
    "partition_roundtrip": "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents",
    "overwrite_partition": "SELECT lang, count(*) AS n, CAST(sum(CASE WHEN lang = 'de' THEN 0 ELSE n_chars END) AS BIGINT) AS chars FROM documents GROUP BY lang",
    "submission": f"WITH {CHECKED} SELECT id, CASE WHEN codable THEN class_code END AS class_code FROM checked",
    "submission_compat": f"WITH {CHECKED} SELECT id, class_code FROM checked",
    "stage_mixed_shards": STAGE_ROWS,
    "stage_rerun_shards": STAGE_ROWS,
    "stage_whole_to_shards": """SELECT lang, count(*) AS n, count(DISTINCT doc_id) AS ids,
CAST(sum(CASE WHEN after < 3 THEN n_chars ELSE doc_id % 3 + 1 END) AS BIGINT) AS chars, CAST(after AS INTEGER) AS after
FROM documents, range(4) r(after) GROUP BY lang, after""",
    "submission_from_parts": "SELECT CAST(doc_id AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS class_code FROM documents",
    "empty_guard": "SELECT count(*) FILTER (lang = 'zz') = 0 AS zz_empty, count(*) FILTER (lang = 'en') = 0 AS en_empty FROM documents",
    "dim_codes_by_major_group": """WITH c AS (SELECT DISTINCT CASE WHEN p_partkey < 10000 THEN lpad(CAST(p_partkey AS VARCHAR), 4, '0') END AS code FROM part)
SELECT left(code, 1) AS major, count(*) AS n FROM c WHERE code IS NOT NULL GROUP BY 1""",
    "overrides": f"""WITH {ADS} SELECT a.id, a.title, md5(CASE WHEN l.toxic = 1 THEN 'override ' || l.quality ELSE a.description END) AS description_md5
FROM ads a LEFT JOIN labels l ON a.id = CAST(l.doc_id AS VARCHAR)""",
    "text_fallback": f"""WITH {GAPPY}, c AS (SELECT id, coalesce(description, title) AS description, {cleaned('description')} AS dc, {cleaned('title')} AS title_clean FROM gappy)
SELECT id, description, title_clean, CASE WHEN coalesce(dc, title_clean) = '' THEN title_clean ELSE coalesce(dc, title_clean) END AS description_clean FROM c""",
    "eol_to_space": documents_line("replace(replace(text, chr(13), ' '), chr(10), ' ')"),
    "lang_threshold": "SELECT event_id, CASE WHEN event_type <> 'view' AND value / 100 < 0.4 THEN 'un' ELSE event_type END AS lang FROM events",
    "lang_whitelist": "SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'un' END AS lang FROM documents",
    "shard_contiguous": f"SELECT doc_id, {SHARD.format(order='doc_id')} AS shard FROM documents",
    "shard_contiguous_lineitem": f"""WITH s AS (SELECT l_orderkey, {SHARD.format(order='l_orderkey, l_linenumber')} AS shard FROM lineitem)
SELECT shard, count(*) AS n, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order FROM s GROUP BY shard""",
    "shard_sizes_repeated_key": f"""WITH s AS (SELECT l_returnflag, {SHARD.format(order='l_returnflag')} AS shard FROM lineitem)
SELECT shard, l_returnflag, count(*) AS n FROM s GROUP BY ALL""",
    "shard_by_hash": "SELECT count(*) AS n, 1::BIGINT AS first_shard, 3::BIGINT AS last_shard FROM lineitem",
    "code_validity": f"""WITH {LABELS}, p AS (SELECT *, CASE WHEN p_size % 10 <> 0 THEN {four('p_size * 3')} END AS class_code FROM part)
SELECT p_partkey, p_retailprice > 950 AND t.code IS NOT NULL AS codable, class_code,
  CASE WHEN t.code IS NOT NULL THEN p_retailprice END AS likelihood, t.label AS label_code
FROM p LEFT JOIN taxonomy t ON p.class_code = t.code""",
    "result_join": "SELECT d.doc_id, d.lang, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "result_join_dup": "SELECT conv_id, turn, length(text) AS result FROM conversations",
    "code_label_lookup": "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS code, n_name AS label_code FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "lang_name": f"WITH {LANGUAGES} SELECT doc_id, lang, language, lang_iso_3 FROM documents LEFT JOIN languages USING (lang)",
    "unknown_lang_anti": f"WITH {LANGUAGES} SELECT event_id, left(event_type, 2) AS lang FROM events WHERE left(event_type, 2) NOT IN (SELECT lang FROM languages)",
    "chunk_count": f"WITH {WINDOWS} SELECT count(*) AS n_chunks FROM windows",
    "outcome_report": f"WITH {CHECKED} SELECT lang, outcome, count(*) AS n FROM checked GROUP BY ALL",
    "outcome_observed": f"WITH {CHECKED} SELECT lang, outcome, count(*) AS n FROM checked GROUP BY ALL",
    "quoted_newlines": """SELECT CAST(doc_id AS VARCHAR) AS id, md5(text || ' "said"' || chr(10) || 'and,more') AS description_md5, lang FROM documents""",
    "shard_by_position": """SELECT event_id, least((row_number() OVER (ORDER BY event_id) - 1) // (count(*) OVER () // 3) + 1, 3)::BIGINT AS shard
FROM events""",
    "index_update": """SELECT count(*) - 1 AS "right", count(*) AS first_embedded, count(*) - 1 AS chunks, 3::BIGINT AS embedded, 4::BIGINT AS removed,
0::BIGINT AS changed_again FROM benchmark""",
    "chunk_tokens": "SELECT doc_id, md5(regexp_replace(text, '[ \\n]', '', 'g')) AS letters_md5, true AS fits FROM documents WHERE trim(text) <> ''",
    "topk_similarity": TOPK,
    "topk_partitioned": TOPK,
    "topk_lsh_recall": "SELECT count(*) AS n_queries, true AS reached, CAST(0 AS BIGINT) AS wrong_scores FROM embeddings",
    "topk_compressed_recall": """SELECT count(*) AS n_queries, true AS reached, CAST(0 AS BIGINT) AS wrong_scores,
count(*) AS n_indexed, CAST(max(len(embedding)) / 4 AS INTEGER) AS bytes_per_vector FROM embeddings""",
    "knn_label_vote": f"""WITH s AS ({NEIGHBOURS}),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbour) AS place FROM s WHERE vec_id <> neighbour),
v AS (SELECT vec_id, own, label, count(*) AS n FROM r WHERE place <= 5 GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) AS place FROM v)
SELECT CAST(own AS BIGINT) AS label, count(*) AS n, count(*) FILTER (own = label) AS agreed FROM w WHERE place = 1 GROUP BY own""",
    "ordered_union_hits": """WITH l AS (SELECT vec_id, [vec_id % 7, (vec_id + 1) % 7, (vec_id + 2) % 7]
  || CASE WHEN label % 2 = 1 THEN [(vec_id + 2) % 7, (vec_id + 4) % 7, vec_id % 7] ELSE []::BIGINT[] END
  || [(vec_id + 5) % 7, (vec_id + 1) % 7] AS docs FROM embeddings),
u AS (SELECT vec_id, unnest(docs) AS doc, generate_subscripts(docs, 1) AS pos FROM l),
f AS (SELECT vec_id, doc, min(pos) AS pos FROM u GROUP BY ALL)
SELECT vec_id, string_agg(CAST(doc AS VARCHAR), ',' ORDER BY pos) AS docs FROM f GROUP BY vec_id""",
    "html_unescape": pages_text(entities("html")),
    "strip_tags": pages_text(tags("html")),
    "strip_urls": pages_text(urls("('see ' || url || ' or http://a, https://www.x.y/z.')")),
    "strip_notices": documents_line(notices(f"({noticed('text')})")),
    "strip_stars": documents_line(stars(starred("text"))),
    "nbsp": documents_line(nbsp(f"({blanked('text')})")),
    "squeeze_ws": documents_line(squeeze(f"({blanked('text')})")),
    "py_strip": documents_line(strip(f"({blanked('text')})")),
    "clean_pages": pages_text(cleaned("html")),
    "clean_documents": documents_line(cleaned(f"({blanked(starred('(' + noticed('text') + ')'))})")),
    "extract_sections": sections(["description", "tasks", "examples"]),
    "extract_sections_for_prompt": sections(["description", "examples"]),
    "extract_first_line": sections(["description"]),
    "format_hits": f"""WITH t AS ({TOPK})
SELECT t.vec_id, string_agg(lpad(CAST(neighbour AS VARCHAR), 6, '0') || ': label ' || e.label || ' - vector ' || neighbour, {NL} || {NL} ORDER BY place) AS categories
FROM t JOIN embeddings e ON e.vec_id = t.neighbour GROUP BY t.vec_id""",
    "keywords_text": "SELECT conv_id, turn, CASE WHEN role <> 'system' THEN array_to_string(list_filter(string_split(text, ' '), lambda x: starts_with(x, 'e')), ', ') END AS keywords FROM conversations",
    "retrieval_query": f"WITH {GAPPY} SELECT id, {query_text('title')} AS query FROM gappy",
    "translation_prompt": f"""WITH {GAPPY}, {LANGUAGES}, g AS (SELECT id, title || ' {{description}}' AS title, description, CASE WHEN lang = 'es' THEN 'un' ELSE lang END AS lang FROM gappy)
SELECT id, {translation_chat('title', 'description', 'language')} AS translation_prompt FROM g LEFT JOIN languages USING (lang)""",
    "classification_prompt": f"WITH {GAPPY} SELECT id, {classification_chat('title', 'description', 'lang')} AS prompt FROM gappy",
    "chat_template": f"""SELECT conv_id, turn, {turn("'system'", "'Conversation ' || conv_id")} || {turn('role', 'text')} || {lit(CONFIG.chat.generation)} AS chat FROM conversations""",
    "parse_translation": f"""WITH {HALF} SELECT doc_id, kind NOT IN (2, 4, 5) AS parsed, kind NOT IN (1, 2, 4, 5) AS job_desc_extracted,
  CASE WHEN kind IN (0, 1, 6, 7, 8) THEN t WHEN kind = 9 THEN 'two' || chr(10) || 'lines' END AS title,
  CASE WHEN kind IN (0, 1, 6, 7, 8) THEN text END AS description,
  CASE WHEN kind IN (0, 1, 6, 7, 8) THEN lang || '|' || source WHEN kind = 9 THEN lang END AS keywords FROM p""",
    "parse_classification": f"WITH {RAW} SELECT id, parsed, codable, class_code, likelihood FROM parsed",
    "parse_props": """SELECT event_id, event_type <> 'view' AS parsed, event_type <> 'view' AS codable, CAST(NULL AS VARCHAR) AS class_code,
  CASE WHEN event_type <> 'view' THEN value END AS likelihood FROM events""",
    "process_response": f"WITH {CHECKED} SELECT id, codable, class_code, likelihood, label_code, outcome FROM checked",
    "coerce_objects": f"""WITH {RAW} SELECT parsed.id, parsed OR kind = 7 AS parsed, codable OR kind = 7 AS codable,
  CASE WHEN kind = 7 THEN '{{"code":"' || lpad(CAST(p_size AS VARCHAR), 4, '0') || '"}}' ELSE class_code END AS class_code,
  CASE WHEN kind = 7 THEN 1::DOUBLE ELSE likelihood END AS likelihood
FROM parsed JOIN part ON parsed.id = CAST(p_partkey AS VARCHAR)""",
    "chunk_cover": "SELECT doc_id, md5(regexp_replace(text, '[ \\n]', '', 'g')) AS letters_md5, true AS fits FROM documents WHERE trim(text) <> ''",
    "chunk_words": f"WITH {WINDOWS} SELECT doc_id, chunk_no, array_to_string(list_slice(w, chunk_no * 90 + 1, chunk_no * 90 + 100), ' ') AS chunk FROM windows",
    "hash_embed": f"WITH {counts('documents', 'doc_id', 'text', 64, 'v')} SELECT doc_id, bucket, round(n / norm, 6) AS weight FROM v",
    "label_index": f"""WITH {INDEX}, w AS (SELECT code, round(sum(n / norm), 6) AS weight_sum FROM cv GROUP BY code)
SELECT code, label, 0::BIGINT AS chunk_no, chunk, info, weight_sum FROM chunks JOIN shown USING (code) JOIN w USING (code)""",
    "multi_field_hits": CODES,
    "multi_field_hits_once": CODES,
    "train_lang_profile": f"WITH {PROFILE} SELECT token, lang, n FROM profile",
    "detect_language": f"WITH {detected('documents', 'doc_id', 'text')} SELECT doc_id, lang, round(score, 6) AS score FROM spoken_lang RIGHT JOIN documents d USING (doc_id)".replace(
        "SELECT doc_id, lang, round", "SELECT doc_id, spoken_lang.lang AS lang, round"),
    "detect_held_out": f"{held_out(0)} UNION ALL {held_out(1)}",
    "generate_offline": f"""WITH {ADS}, {translated('ads', 'title', 'description')}
SELECT id, true AS parsed, title_en AS title, array_to_string(keyword_list, ',') AS keywords FROM translated""",
    "generate_resumed": """SELECT count(*) AS n, count(*) AS "right", true AS first_failed, true AS kept_some, true AS sent_only_missing,
0::BIGINT AS sent_again, count(DISTINCT text) AS answers FROM documents""",
    "detect_stage": f"WITH {GAPPY}, {detect_on('gappy')} SELECT id, description_clean, title_clean, lang, round(score, 6) AS score FROM detected",
    "translate_stage": f"""WITH {GAPPY}, {translated('gappy', 'title', 'description')}
SELECT id, lang, job_desc_extracted, title_en, description_en, array_to_string(keyword_list, ',') AS keywords, 'ok' AS outcome FROM translated""",
    "prompt_stage": f"WITH {SEARCHED_ADS}, {prompts('found')} SELECT id, prompt FROM prompted",
    "classify_stage": f"""WITH {SEARCHED_ADS}, {coded('found')}
SELECT id, class_code IS NOT NULL AS codable, class_code, likelihood, label AS label_code,
  CASE WHEN class_code IS NULL THEN 'invalid_code' ELSE 'ok' END AS outcome FROM coded""",
    "all_stages": f"""WITH {GAPPY}, {detect_on('gappy')}, {translated('detected', 'title_clean', 'description_clean')},
found AS (SELECT *, array_to_string(keyword_list, ', ') AS keywords FROM translated), {coded('found')}
SELECT id, class_code, lang FROM coded JOIN found USING (id)""",
    "documents_by_language": f"""WITH {ADS}, {detect_on('ads')}
SELECT lang, count(*) AS n, CAST(sum(length(description_clean)) AS BIGINT) AS chars FROM detected GROUP BY lang""",
}
