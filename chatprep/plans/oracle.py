"""The same results in SQL, written from the rules rather than from the plans.

Each text runs on DuckDB with the test tables as views.
"""

from __future__ import annotations

from chatprep.functions import conversations as c, text as t
from chatprep.functions.answers import ANSWERS_HEADER, SHOPS_HEADER
from chatprep.operators import search as s
from chatprep.plans.queries import PAIRS_FROM, QUESTION_FORMS, SYSTEM

# White space: as a string to trim and as a regular-expression class.
BLANKS = "'" + t.WHITESPACE + "'"
BLANK_CLASS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def clean(expression: str) -> str:
    return f"trim(coalesce({expression}, ''), {BLANKS})"


# Facts of an answer, as select items.
FACTS = (
    f"trim(regexp_extract(assistant, '「([^」]+)」', 1), {BLANKS}) AS name, "
    f"trim(regexp_extract(assistant, '特徴：([^）\\n]+)', 1), {BLANKS}) AS feature, "
    f"regexp_extract(assistant, 'https?://[^{BLANK_CLASS}]+') AS url"
)


def query(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# Turns of conversations: seq, turn, role, content -----------------------------------

TURNS = f"""turns AS (
  SELECT conv_id AS seq, turn, lower({clean('role')}) AS role, {clean('text')} AS content
  FROM conversations)"""

FAULTY = f"""turns AS (
  SELECT conv_id * 5 + fault AS seq, turn,
         CASE WHEN fault = 1 AND role = 'assistant' THEN 'bot'
              WHEN fault = 4 THEN 'system' ELSE role END AS role,
         CASE WHEN fault = 2 AND role = 'assistant' THEN '' ELSE {clean('text')} END AS content
  FROM conversations, (VALUES (0), (1), (2), (3), (4)) f(fault)
  WHERE NOT (fault = 3 AND turn = 0))"""

DIALOGS = """dialogs AS (
  SELECT seq, string_agg(role || ': ' || content, chr(10) ORDER BY turn) AS dialog
  FROM turns GROUP BY seq)"""

PROBLEMS = f"""per_turn AS (
  SELECT seq, turn, 1 AS k, 'unknown role ''' || role || ''' / 不明なrole' AS problem
  FROM turns WHERE role NOT IN ('system', 'user', 'assistant')
  UNION ALL
  SELECT seq, turn, 2, 'empty ' || role || ' message / ' || role || ' の中身が空です'
  FROM turns WHERE content = ''),
in_turns AS (
  SELECT seq, string_agg(problem, '|' ORDER BY turn, k) AS problems FROM per_turn GROUP BY seq),
body AS (
  SELECT seq, role, row_number() OVER (PARTITION BY seq ORDER BY turn) AS i,
         count(*) OVER (PARTITION BY seq) AS n
  FROM turns WHERE role <> 'system'),
shape AS (
  SELECT seq, max(CASE WHEN i = 1 THEN role END) AS first_role,
         max(CASE WHEN i = n THEN role END) AS last_role,
         bool_or(role <> CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END) AS mixed
  FROM body GROUP BY seq),
checked AS (
  SELECT a.seq, concat_ws('|', p.problems,
           CASE WHEN b.seq IS NULL THEN {quoted(c.NO_TURNS)} END,
           CASE WHEN b.first_role <> 'user' THEN {quoted(c.MUST_START_WITH_USER)} END,
           CASE WHEN b.last_role <> 'assistant' THEN {quoted(c.MUST_END_WITH_ASSISTANT)} END,
           CASE WHEN b.mixed THEN {quoted(c.MUST_ALTERNATE)} END) AS problems
  FROM (SELECT DISTINCT seq FROM turns) a
  LEFT JOIN in_turns p ON p.seq = a.seq LEFT JOIN shape b ON b.seq = a.seq)"""

TOKENS = (
    "length(regexp_replace({0}, '[^\\x00-\\x7F]', '', 'g')) // 4"
    " + length(regexp_replace({0}, '[\\x00-\\x7F]', '', 'g'))"
)

LENGTHS = f"""lengths AS (
  SELECT seq, CAST(sum(length(content)) AS BIGINT) AS chars,
         CAST(sum({TOKENS.format('content')}) AS BIGINT) AS tokens, count(*) AS turns
  FROM turns GROUP BY seq)"""

# A system turn first where the conversation has none.
SYSTEM_TURNS = f"""with_system AS (
  SELECT * FROM turns
  UNION ALL
  SELECT seq, -1, 'system', {quoted(SYSTEM)} FROM turns GROUP BY seq
  HAVING NOT bool_or(role = 'system'))"""

PAIRS_OF_TURNS = """shapes AS (
  SELECT seq,
         string_agg(role, ',' ORDER BY turn) FILTER (role <> 'system') AS roles,
         arg_min(content, turn) FILTER (role = 'system') AS system,
         max(content) FILTER (role = 'user') AS "user",
         max(content) FILTER (role = 'assistant') AS assistant
  FROM turns GROUP BY seq),
conv_pairs AS (
  SELECT seq, nullif(system, '') AS system, "user", assistant
  FROM shapes WHERE roles = 'user,assistant')"""

# Pairs made from parts ---------------------------------------------------------------

PART_PAIRS = """part_pairs AS (
  SELECT p_partkey * 3 + copy AS seq, '' AS system,
         '神戸で' || p_brand || p_size || 'を食べるなら？' AS "user",
         CASE WHEN copy < 2 THEN '「' || p_name || '」（特徴：' || p_type
           || '）https://example.com/p/' || p_size ELSE '' END AS assistant
  FROM part, (VALUES (0), (1), (2)) c(copy))"""

FILLED = f"""filled AS (SELECT seq, "user", assistant FROM part_pairs WHERE assistant <> '')"""

KNOWLEDGE_PAIRS = f"""pairs AS (
  SELECT seq, "user", assistant FROM filled
  UNION ALL SELECT seq + {PAIRS_FROM}, "user", assistant FROM conv_pairs)"""


def merged(source: str) -> str:
    """``groups``: one row per (system, user) of ``source`` (seq, system, user, assistant)."""
    return f"""answers AS (
  SELECT system, "user", assistant, min(seq) AS seq, count(*) AS rows
  FROM {source} GROUP BY system, "user", assistant),
listed AS (
  SELECT *, row_number() OVER (PARTITION BY system, "user" ORDER BY seq) AS i,
         {FACTS},
         regexp_matches(assistant, '「[^」]+」') AS has_name
  FROM answers WHERE assistant <> ''),
lines AS (
  SELECT system, "user", count(*) AS k, min(assistant) AS only_answer,
         bool_and(has_name) AND count(DISTINCT name) = count(*) AS shops,
         string_agg(i || '. ' || name || CASE WHEN feature <> '' THEN '（特徴：' || feature || '）'
           ELSE '' END || CASE WHEN url <> '' THEN chr(10) || '   地図: ' || url ELSE '' END,
           chr(10) ORDER BY i) AS shop_lines,
         string_agg(i || '. ' || assistant, chr(10) ORDER BY i) AS answer_lines
  FROM listed GROUP BY system, "user"),
sizes AS (
  SELECT system, "user", min(seq) AS seq, sum(rows) AS rows FROM answers GROUP BY system, "user"),
groups AS (
  SELECT s.seq, s.system, s."user", s.rows, coalesce(l.k, 0) AS k,
         CASE WHEN l.k IS NULL THEN '' WHEN l.k = 1 THEN only_answer
              WHEN shops THEN {quoted(SHOPS_HEADER)} || chr(10) || shop_lines
              ELSE {quoted(ANSWERS_HEADER)} || chr(10) || answer_lines END AS assistant
  FROM sizes s LEFT JOIN lines l ON l.system = s.system AND l."user" = s."user")"""


CATEGORY = (
    "CASE"
    + "".join(
        f" WHEN regexp_matches({{0}}, '{p}') THEN trim(regexp_extract({{0}}, '{p}', 1), {BLANKS})"
        for p in [
            "おすすめの([^\\n]+?)のお店",
            "神戸で([^\\n]+?)を食べるなら",
            "([^\\n]+?)が食べたい",
            "人気の([^\\n]+?)のお店",
        ]
    )
    + " ELSE '' END"
)

KNOWLEDGE = f"""facts AS (
  SELECT seq, "user", assistant, {FACTS},
         {CATEGORY.format('"user"')} AS category FROM pairs),
grouped AS (
  SELECT min(seq) AS doc_seq, arg_min(CASE WHEN name <> '' THEN name ELSE "user" END, seq) AS title,
         coalesce(string_agg(DISTINCT category, ',' ORDER BY category) FILTER (category <> ''), '')
           AS categories,
         coalesce(string_agg(DISTINCT category, ' ' ORDER BY category) FILTER (category <> ''), '')
           AS category_words,
         coalesce(arg_min(feature, seq) FILTER (feature <> ''), '') AS feature,
         coalesce(arg_min(url, seq) FILTER (url <> ''), '') AS url,
         arg_min(assistant, seq) AS answer, string_agg("user", ' ' ORDER BY seq) AS questions
  FROM facts GROUP BY name, CASE WHEN name = '' THEN seq END),
documents_of_pairs AS (
  SELECT doc_seq, title, categories, feature, url, answer,
         concat_ws(chr(10), nullif(title, ''), nullif(category_words, ''), nullif(feature, ''),
           nullif(url, ''), questions, answer) AS text
  FROM grouped)"""


# Terms and scores --------------------------------------------------------------------


def terms(name: str, source: str, key: str) -> str:
    """``<name>``: key, term, tf of the texts of ``source`` (key, text)."""
    return f"""{name}_folded AS (
  SELECT {key}, lower({clean('text')}) AS line,
         regexp_extract_all(regexp_replace(lower({clean('text')}), '[{BLANK_CLASS}]+', '', 'g'),
           '(?s).') AS chars
  FROM {source}),
{name}_chars AS (
  SELECT {key}, unnest(chars) AS c, generate_subscripts(chars, 1) AS i FROM {name}_folded),
{name}_runs AS (
  SELECT {key}, c, lead(c, 1) OVER w AS c2, lead(c, 2) OVER w AS c3 FROM {name}_chars
  WINDOW w AS (PARTITION BY {key} ORDER BY i)),
{name} AS (
  SELECT {key}, term, count(*) AS tf FROM (
    SELECT {key}, unnest(regexp_extract_all(line, '[a-z0-9]+|[ぁ-んァ-ン一-龥ー]+')) AS term
    FROM {name}_folded
    UNION ALL SELECT {key}, c || c2 FROM {name}_runs WHERE c2 IS NOT NULL
    UNION ALL SELECT {key}, c || c2 || c3 FROM {name}_runs WHERE c3 IS NOT NULL)
  GROUP BY {key}, term)"""


QUESTIONS = "questions AS (SELECT item_id AS query_id, text FROM benchmark)"
TEXTS = "texts AS (SELECT doc_id AS doc_seq, text FROM documents)"


def hits(texts: str, k: int) -> str:
    """``hits`` of ``questions`` in ``texts``."""
    return f"""{terms('asked', 'questions', 'query_id')},
{terms('held', texts, 'doc_seq')},
stats AS (
  SELECT term, count(*) AS df,
         ln(((SELECT count(*) FROM {texts}) + 1) / (count(*) + 0.5)) + 1 AS idf
  FROM held GROUP BY term),
scores AS (
  SELECT query_id, doc_seq, sum(a.tf * idf * (1 + ln(h.tf))) AS score
  FROM asked a JOIN stats USING (term) JOIN held h USING (term) GROUP BY query_id, doc_seq),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_seq) AS rank
  FROM scores),
hits AS (SELECT query_id, rank, doc_seq, score FROM ranked WHERE rank <= {k})"""


SHOP_QUESTIONS = """questions AS (
  SELECT p_brand || '/0' AS query_id, p_brand AS text FROM (SELECT DISTINCT p_brand FROM part)
  UNION ALL
  SELECT p_brand || '/1', repeat('☆', length(p_brand)) FROM (SELECT DISTINCT p_brand FROM part))"""

CONTEXTS = f"""contexts AS (
  SELECT query_id, string_agg(concat_ws(chr(10), '[' || rank || '] ' || title,
      CASE WHEN categories <> '' THEN '{s.CATEGORY_LABEL}' || replace(categories, ',', ', ') END,
      CASE WHEN feature <> '' THEN '{s.FEATURE_LABEL}' || feature END,
      CASE WHEN url <> '' THEN '{s.MAP_LABEL}' || url END,
      '{s.SOURCE_LABEL}' || answer), chr(10) || chr(10) ORDER BY rank) AS context
  FROM hits JOIN documents_of_pairs USING (doc_seq) GROUP BY query_id)"""

KNOWLEDGE_CHAIN = [PART_PAIRS, FILLED, TURNS, PAIRS_OF_TURNS, KNOWLEDGE_PAIRS, KNOWLEDGE]

DOCUMENT_STATS = """count(*) AS "count",
  coalesce(CAST(sum(chars) // count(*) AS BIGINT), 0) AS avg_chars,
  coalesce(list_sort(list(chars))[count(*) // 2 + 1], 0) AS median_chars,
  coalesce(max(chars), 0) AS max_chars,
  coalesce(CAST(sum(tokens) // count(*) AS BIGINT), 0) AS avg_tokens,
  coalesce(max(tokens), 0) AS max_tokens"""

RENDERED = f"""string_agg('<|turn>' || CASE WHEN role = 'assistant' THEN 'model' ELSE role END
  || chr(10) || content || '<turn|>' || chr(10), '' ORDER BY turn) AS text"""

MERGED_INPUT = f"""passed AS (
  SELECT seq, turn, role, content FROM turns WHERE seq NOT IN (SELECT seq FROM conv_pairs)
  UNION ALL
  SELECT seq, -1, 'system', {quoted(SYSTEM)} FROM turns
  WHERE seq NOT IN (SELECT seq FROM conv_pairs) GROUP BY seq HAVING NOT bool_or(role = 'system')),
asked AS (
  SELECT seq, coalesce(system, {quoted(SYSTEM)}) AS system, "user", assistant FROM conv_pairs
  UNION ALL
  SELECT seq + {PAIRS_FROM}, {quoted(SYSTEM)}, "user", assistant FROM part_pairs)"""

MERGED_CONVERSATIONS = query(
    PART_PAIRS,
    TURNS,
    PAIRS_OF_TURNS,
    MERGED_INPUT,
    merged("asked"),
    select=f"""SELECT seq, string_agg(role || ': ' || content, chr(10) ORDER BY turn) AS dialog
FROM passed GROUP BY seq
UNION ALL
SELECT seq + {1 << 62}, 'system: ' || system || chr(10) || 'user: ' || "user" || chr(10)
  || 'assistant: ' || assistant FROM groups""",
)

ORACLE: dict[str, str] = {
    "conversations_checked": query(FAULTY, PROBLEMS, select="SELECT seq, problems FROM checked"),
    "conversations_rejects": query(
        FAULTY,
        PROBLEMS,
        select="SELECT seq, split_part(problems, '|', 1) AS reason FROM checked WHERE problems <> ''",
    ),
    "conversations_kept": query(
        FAULTY,
        PROBLEMS,
        DIALOGS,
        select="SELECT seq, dialog FROM dialogs JOIN checked USING (seq) WHERE problems = ''",
    ),
    "dedup_kept": query(
        TURNS,
        DIALOGS,
        select="""SELECT min(seq * 2) AS seq, 2 * count(*) AS copies, dialog
FROM dialogs GROUP BY dialog""",
    ),
    "duplicates_dropped": query(
        TURNS,
        DIALOGS,
        "copies AS (SELECT seq * 2 + copy AS seq, dialog FROM dialogs, (VALUES (0), (1)) c(copy))",
        select="""SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY dialog ORDER BY seq) AS i
FROM copies) WHERE i > 1""",
    ),
    "conversation_lengths": query(TURNS, LENGTHS, select="SELECT seq, chars, tokens FROM lengths"),
    "too_long": query(TURNS, LENGTHS, select="SELECT seq, tokens > 64 AS too_long FROM lengths"),
    "default_system": query(
        TURNS,
        SYSTEM_TURNS,
        select="""SELECT seq, string_agg(role || ': ' || content, chr(10) ORDER BY turn) AS dialog
FROM with_system GROUP BY seq""",
    ),
    "sharegpt_rows": query(
        TURNS,
        select="""SELECT seq, CAST(row_number() OVER (PARTITION BY seq ORDER BY turn) - 1 AS INTEGER) AS pos,
  CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS speaker,
  content AS value FROM turns""",
    ),
    "sharegpt_round_trip": query(TURNS, DIALOGS, select="SELECT seq, dialog FROM dialogs"),
    "flat_pairs": query(
        TURNS, PAIRS_OF_TURNS, select='SELECT seq, system, "user", assistant FROM conv_pairs'
    ),
    "non_pair_conversations": query(
        TURNS,
        PAIRS_OF_TURNS,
        DIALOGS,
        select="SELECT seq, dialog FROM dialogs WHERE seq NOT IN (SELECT seq FROM conv_pairs)",
    ),
    "json_shapes": query(
        FAULTY,
        DIALOGS,
        """known AS (
  SELECT seq, string_agg(role || ': ' || content, chr(10) ORDER BY turn) AS dialog
  FROM turns WHERE role <> 'bot' GROUP BY seq)""",
        select="""SELECT seq * 2 AS seq, dialog FROM dialogs
UNION ALL
SELECT d.seq * 2 + 1, coalesce(k.dialog, '') FROM dialogs d LEFT JOIN known k ON k.seq = d.seq""",
    ),
    "json_pairs": query(
        PART_PAIRS,
        select=f"""SELECT seq, 'system: ' || {quoted(SYSTEM)} || chr(10) || 'user: ' || "user"
  || chr(10) || 'assistant: ' || assistant AS dialog FROM part_pairs""",
    ),
    "unusable_records": f"SELECT event_id AS seq, {quoted(c.NO_PAIR)} AS reason FROM events",
    "named_columns": query(PART_PAIRS, select='SELECT seq, "user", assistant FROM part_pairs'),
    "dataset_statistics": query(
        TURNS,
        PROBLEMS,
        LENGTHS,
        select=f"SELECT {DOCUMENT_STATS} FROM lengths JOIN checked USING (seq) WHERE problems = ''",
    ),
    "counters": query(
        FAULTY,
        PROBLEMS,
        DIALOGS,
        select="""SELECT 2 * count(*) AS input_rows,
  2 * count(*) FILTER (problems <> '') AS skipped,
  2 * count(*) FILTER (problems = '') - count(DISTINCT dialog) FILTER (problems = '') AS duplicates
FROM dialogs JOIN checked USING (seq)""",
    ),
    "guidance": query(
        TURNS,
        LENGTHS,
        "sizes AS (SELECT turns, count(*) AS n, max(tokens) AS max_tokens FROM lengths GROUP BY turns)",
        select="""SELECT CAST(turns AS INTEGER) AS turns, n AS "count", max_tokens,
  CASE WHEN n = 0 THEN 'error' WHEN n < 10 THEN 'barely changes' WHEN n < 30 THEN 'small'
       ELSE 'ok' END AS level,
  max_tokens > 64 AS over_length,
  CASE WHEN n BETWEEN 30 AND 60 THEN '8-10' WHEN n BETWEEN 100 AND 300 THEN '4-6'
       WHEN n >= 500 THEN '2-3' END AS epochs
FROM sizes""",
    ),
    "split_sizes": query(
        TURNS,
        PROBLEMS,
        "kept AS (SELECT count(*) AS n FROM checked WHERE problems = '')",
        """sizes AS (
  SELECT n, CASE WHEN n < 2 THEN n
    ELSE least(greatest(1, CAST(round_even(n * 0.1, 0) AS BIGINT)), n - 1) END AS v FROM kept)""",
        select="""SELECT 'train' AS side, CASE WHEN n < 2 THEN n ELSE n - v END AS n FROM sizes
UNION ALL SELECT 'valid', v FROM sizes
UNION ALL SELECT 'both', CASE WHEN n < 2 THEN n ELSE 0 END FROM sizes""",
    ),
    "merged_pairs": query(
        PART_PAIRS, merged("part_pairs"), select='SELECT seq, "user", assistant FROM groups'
    ),
    "merge_counters": query(
        PART_PAIRS,
        merged("part_pairs"),
        select="""SELECT count(*) FILTER (k > 1) AS merged_prompt_groups,
  CAST(coalesce(sum(rows) FILTER (k > 1), 0) AS BIGINT) AS merged_input_rows,
  count(*) AS rows_after_merge FROM groups""",
    ),
    "merged_conversations": MERGED_CONVERSATIONS,
    "merged_table": query(
        PART_PAIRS,
        "asked AS (SELECT * FROM part_pairs WHERE assistant <> '')",
        merged("asked"),
        select='SELECT seq, "user", assistant FROM groups',
    ),
    "answer_facts": query(
        PART_PAIRS,
        FILLED,
        select=f"SELECT seq, {FACTS} FROM filled",
    ),
    "question_category": query(
        *KNOWLEDGE_CHAIN[:5],
        select=f"""SELECT seq, {CATEGORY.format('"user"')} AS category FROM pairs""",
    ),
    "knowledge_documents": query(*KNOWLEDGE_CHAIN, select="SELECT * FROM documents_of_pairs"),
    "benchmark_terms": query(
        QUESTIONS, terms("asked", "questions", "query_id"), select="SELECT * FROM asked"
    ),
    "document_idf": query(
        TEXTS,
        terms("held", "texts", "doc_seq"),
        select="""SELECT term, count(*) AS df,
  round(ln(((SELECT count(*) FROM texts) + 1) / (count(*) + 0.5)) + 1, 6) AS idf
FROM held GROUP BY term""",
    ),
    "query_weights": query(
        QUESTIONS,
        TEXTS,
        hits("texts", 0),
        select="""SELECT query_id, term, round(tf * idf, 6) AS weight
FROM asked JOIN stats USING (term)""",
    ),
    "search_topk": query(
        QUESTIONS,
        TEXTS,
        hits("texts", 6),
        select="""SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_seq, round(score, 6) AS score
FROM hits""",
    ),
    "search_context": query(
        *KNOWLEDGE_CHAIN,
        SHOP_QUESTIONS,
        hits("documents_of_pairs", 3),
        CONTEXTS,
        select=f"""SELECT query_id, text, coalesce(context, '{s.NOTHING_FOUND}') AS answer
FROM questions LEFT JOIN contexts USING (query_id)""",
    ),
    "search_prompts": query(
        *KNOWLEDGE_CHAIN,
        SHOP_QUESTIONS,
        hits("documents_of_pairs", 3),
        CONTEXTS,
        select=f"""SELECT query_id, {quoted(s.SYSTEM_TEXT)} AS system_text,
  '質問: ' || text || chr(10) || chr(10) || 'CSV検索結果:' || chr(10) || context || chr(10)
    || chr(10) || 'この情報だけで日本語で答えてください。' AS user_text
FROM questions JOIN contexts USING (query_id)""",
    ),
    "chat_text": query(TURNS, select=f"SELECT seq, {RENDERED} FROM turns GROUP BY seq"),
    "response_mask": query(
        FAULTY,
        select=f"""SELECT seq,
  CAST(coalesce(sum(length(content)) FILTER (role = 'assistant'), 0) AS BIGINT) AS learned_chars,
  CAST(coalesce(sum({TOKENS.format('content')}) FILTER (role = 'assistant'), 0) AS BIGINT)
    AS learned_tokens,
  coalesce(sum(length(content)) FILTER (role = 'assistant'), 0) > 0 AS has_response
FROM turns GROUP BY seq""",
    ),
    "json_lines_file": query(TURNS, DIALOGS, select="SELECT dialog FROM dialogs"),
    "json_list_file": query(TURNS, DIALOGS, select="SELECT dialog FROM dialogs"),
    "csv_file": query(PART_PAIRS, select='SELECT "user", assistant FROM part_pairs'),
    "csv_pairs": query(PART_PAIRS, FILLED, select='SELECT "user", assistant FROM filled'),
    "rendered_file": query(
        TURNS,
        f"rendered AS (SELECT seq, {RENDERED} FROM turns GROUP BY seq)",
        select="SELECT text FROM rendered, (VALUES (0), (1)) c(copy)",
    ),
}

ORACLE["prepared_csv"] = query(
    PART_PAIRS,
    "asked AS (SELECT * FROM part_pairs WHERE assistant <> '')",
    merged("asked"),
    select="""SELECT 'user: ' || "user" || chr(10) || 'assistant: ' || assistant AS dialog
FROM groups""",
)

# Builds work on two copies of every conversation, with a default system message.
_BUILT = [
    TURNS,
    SYSTEM_TURNS,
    PROBLEMS,
    """kept AS (
  SELECT seq, string_agg(role || ': ' || content, chr(10) ORDER BY turn) AS dialog,
         CAST(sum(length(content)) AS BIGINT) AS chars,
         CAST(sum("""
    + TOKENS.format("content")
    + """) AS BIGINT) AS tokens
  FROM with_system JOIN checked USING (seq) WHERE problems = '' GROUP BY seq),
once AS (SELECT dialog, min(seq) AS seq, any_value(chars) AS chars, any_value(tokens) AS tokens
  FROM kept GROUP BY dialog)""",
]

ORACLE["built_sharegpt"] = query(*_BUILT, select="SELECT dialog FROM once")
ORACLE["built_report"] = query(
    *_BUILT,
    f"stats AS (SELECT {DOCUMENT_STATS} FROM once)",
    select="""SELECT *, CASE WHEN "count" = 0 THEN 'error' WHEN "count" < 10 THEN 'barely changes'
    WHEN "count" < 30 THEN 'small' ELSE 'ok' END AS level,
  max_tokens > 1024 AS over_length,
  CASE WHEN "count" BETWEEN 30 AND 60 THEN '8-10' WHEN "count" BETWEEN 100 AND 300 THEN '4-6'
       WHEN "count" >= 500 THEN '2-3' END AS epochs,
  2 * (SELECT count(*) FROM checked) AS input_rows,
  2 * (SELECT count(*) FROM checked WHERE problems <> '') AS skipped,
  2 * (SELECT count(*) FROM kept) - "count" AS duplicates FROM stats""",
)
ORACLE["built_merged"] = query(
    PART_PAIRS,
    TURNS,
    PAIRS_OF_TURNS,
    MERGED_INPUT,
    merged("asked"),
    PROBLEMS,
    select=f"""SELECT DISTINCT dialog FROM (
  SELECT string_agg(role || ': ' || content, chr(10) ORDER BY turn) AS dialog
  FROM passed JOIN checked USING (seq) WHERE problems = '' GROUP BY seq
  UNION ALL
  SELECT 'system: ' || system || chr(10) || 'user: ' || "user" || chr(10) || 'assistant: ' || assistant
  FROM groups WHERE assistant <> '' AND "user" <> '')""",
)
ORACLE["written_order"] = query(*_BUILT, select="SELECT row_number() OVER (ORDER BY seq) - 1 AS place, dialog FROM once")
ORACLE["written_sides"] = query(
    *_BUILT,
    "total AS (SELECT count(*) AS n FROM once)",
    """sizes AS (
  SELECT n, CASE WHEN n < 2 THEN n
    ELSE least(greatest(1, CAST(round_even(n * 0.1, 0) AS BIGINT)), n - 1) END AS v FROM total)""",
    select="""SELECT 'train_sharegpt' AS side, n FROM sizes
UNION ALL SELECT 'train', CASE WHEN n < 2 THEN n ELSE n - v END FROM sizes
UNION ALL SELECT 'valid', v FROM sizes
UNION ALL SELECT 'found', n FROM sizes""",
)
ORACLE["validation_passed"] = query(
    TURNS,
    PROBLEMS,
    DIALOGS,
    select="""SELECT count(DISTINCT dialog) AS "count", count(*) AS input_rows, CAST(0 AS BIGINT) AS skipped,
  count(*) - count(DISTINCT dialog) AS duplicates, count(*) > 0 AS passed
FROM dialogs JOIN checked USING (seq) WHERE problems = ''""",
)
ORACLE["json_object_file"] = ORACLE["json_list_file"]
ORACLE["rendered_mask"] = f"""SELECT learned_chars, learned_tokens, has_response
FROM ({ORACLE["response_mask"].replace(FAULTY, TURNS)}), (VALUES (0), (1)) c(copy)"""
ORACLE["question_categories"] = f"""SELECT p_partkey, CAST(form AS INTEGER) AS form, {CATEGORY.format("question")} AS category FROM (
  SELECT p_partkey, form, a || p_brand || ' ' || p_size || b AS question
  FROM part, (VALUES {", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(QUESTION_FORMS))}) f(form, a, b))"""
ORACLE["validation_report"] = query(
    TURNS,
    PROBLEMS,
    DIALOGS,
    """counted AS (
  SELECT count(DISTINCT dialog) FILTER (problems = '') AS n, 2 * count(*) AS input_rows,
         2 * count(*) FILTER (problems <> '') AS skipped,
         2 * count(*) FILTER (problems = '') AS fine
  FROM dialogs JOIN checked USING (seq))""",
    select="""SELECT n AS "count", input_rows, skipped, fine - n AS duplicates,
  skipped = 0 AND n > 0 AS passed FROM counted""",
)
ORACLE["search_stored_index"] = ORACLE["search_topk"]
ORACLE["learned"] = f"""SELECT count(*) AS conversations, count(*) FILTER (has_response) AS with_response,
  CAST(coalesce(sum(learned_tokens), 0) AS BIGINT) AS learned_tokens, coalesce(sum(learned_tokens), 0) > 0 AS passed
FROM ({ORACLE["response_mask"]})"""
