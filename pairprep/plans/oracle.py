"""The registered queries once more, as plain SQL over the driver's tables."""

from __future__ import annotations

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
TOKEN = r"\p{L}+|\p{N}|[" + WS + r"]+|[^\p{L}\p{N}" + WS + r"]+"
REFERENCE = (
    r"(?i)\A(?:fixe[sd]?|close[sd]?|resolve[sd]?|refs?)[" + WS + r"]*#?[\p{L}\p{N}_]+[^\n]*\z"
)
DIFF_LINE = r"(?m)^(?:diff --git |@@ |index |[+-])"
SIGNALS = {
    "git_header": r"(?m)^diff --git ",
    "hunk_header": r"(?m)^@@ ",
    "new_file": r"(?m)^\+\+\+ ",
    "old_file": r"(?m)^--- ",
    "index_line": r"(?m)^index ",
    "changed_line": r"(?m)^[+-]",
}
STOPLIST = "('update', 'updated', 'fix', 'fixed', 'wip', '.', '..', '...', 'temp', 'test')"
SEP = "chr(10) || chr(10) || 'Commit message:' || chr(10)"
CAPS = {"train": 100, "validation": 20, "test": 40}
VOCAB_SIZE = 2000
MAX_LENGTH = 512


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\A[{WS}]+', ''), '[{WS}]+\\z', '')"


def normalize(x: str) -> str:
    return strip(f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))")


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{WS}]+'))"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '{TOKEN}')"


def is_diff(x: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), '{DIFF_LINE}')"


def is_message(x: str) -> str:
    return f"({x} <> '' AND NOT {is_diff(x)} AND {words(x)} <= 200)"


def csv(x: str) -> str:
    return f"array_to_string({x}, ',')"


PAIRS = """
pairs AS (
  SELECT doc_id AS pair_id,
    CASE WHEN doc_id % 29 = 0 THEN NULL ELSE
    CASE doc_id % 7
      WHEN 0 THEN text
      WHEN 1 THEN 'diff --git a/f b/f' || chr(10) || '@@ -1 +1 @@' || chr(10) || '+' || text
      WHEN 2 THEN 'diff --git a/f b/f' || chr(13) || chr(10) || '@@ -1 +1 @@' || chr(13) || chr(10)
                  || '+' || text
      WHEN 3 THEN 'diff --git a/f b/f' || chr(10) || '+' || text || chr(10) || 'diff --git a/g b/g'
                  || chr(10) || '-' || text
      WHEN 4 THEN 'index 12..34' || chr(10) || text
      WHEN 5 THEN chr(12288) || chr(13) || chr(10) || text || ' ' || chr(13)
      ELSE '+++ b/f' || chr(10) || text END END AS diff,
    CASE doc_id % 23
      WHEN 0 THEN regexp_extract(text, '\\A[^.\\n]*', 0)
      WHEN 1 THEN 'fix' WHEN 2 THEN 'FIXED' WHEN 3 THEN 'WIP ' WHEN 4 THEN '' WHEN 5 THEN 'ab'
      WHEN 6 THEN 'two words' WHEN 7 THEN 'Fixes #123 in parser'
      WHEN 8 THEN 'Refactor the parser code' WHEN 9 THEN 'Look at <URL> for more'
      WHEN 10 THEN 'Bump #<I> to latest' WHEN 11 THEN 'Closes' || chr(10) || 'the open issue'
      WHEN 12 THEN 'Fixes the bug' || chr(10) || chr(10) || 'Long body text here'
      WHEN 13 THEN chr(12288) || 'Add new option' || chr(160)
      WHEN 14 THEN 'fix the crash in parser' WHEN 15 THEN 'fix #123'
      WHEN 16 THEN 'Look at <url> for more' WHEN 17 THEN 'Add <HASH> lookup table'
      WHEN 18 THEN '- add a bullet' WHEN 19 THEN 'closest pair search added'
      WHEN 20 THEN 'resolve: odd case here' WHEN 21 THEN 'Closed, as agreed' END AS message,
    CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split
  FROM documents)"""

NORM = f"""
norm AS (
  SELECT pair_id, split, {normalize("coalesce(diff, '')")} AS diff,
    {normalize("coalesce(message, '')")} AS message
  FROM pairs)"""

JUDGED = f"""
judged AS (
  SELECT *, message = '' AS is_empty, lower(message) IN {STOPLIST} AS in_stoplist,
    length(message) < 3 AS few_chars, {words("message")} < 3 AS few_words,
    regexp_matches(message, '{REFERENCE}') AS is_reference,
    regexp_matches(message, '<HASH>|<URL>|#<I>') AS has_placeholder,
    length(diff) < 50 AS diff_short, length(diff) > 8000 AS diff_long
  FROM norm),
kept AS (
  SELECT *, NOT (is_empty OR in_stoplist OR few_chars OR few_words OR is_reference OR has_placeholder) AS
    good_message
  FROM judged),
clean AS (
  SELECT pair_id, diff, message, split FROM kept WHERE good_message AND NOT diff_short AND NOT diff_long)"""

CAPPED = """
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('9105:' || pair_id), pair_id) AS rn
  FROM clean),
capped AS (
  SELECT pair_id, diff, message, split FROM ordered
  WHERE rn <= CASE split WHEN 'train' THEN 100 WHEN 'validation' THEN 20 ELSE 40 END)"""

VOCAB = f"""
counted AS (
  SELECT token, count(*) AS n FROM (
    SELECT unnest({tokens(f"diff || {SEP} || message")}) AS token
    FROM clean WHERE split = 'train')
  GROUP BY token),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id
  FROM (SELECT * FROM counted ORDER BY n DESC, token LIMIT {VOCAB_SIZE})
  UNION ALL SELECT '<|endoftext|>', 0 UNION ALL SELECT '<|unknown|>', 1)"""

TOKENIZED = f"""
prepared AS (
  SELECT pair_id, split,
    list_append({tokens(f"diff || {SEP} || message")}, '<|endoftext|>')[1:{MAX_LENGTH}] AS toks,
    least(len({tokens(f"diff || {SEP}")}), {MAX_LENGTH}) AS prompt_size
  FROM clean),
placed AS (
  SELECT pair_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM prepared),
coded AS (
  SELECT p.pair_id, list(coalesce(v.id, 1) ORDER BY p.pos) AS input_ids,
    list(CASE WHEN p.pos <= q.prompt_size THEN -100 ELSE coalesce(v.id, 1) END ORDER BY p.pos) AS labels
  FROM placed p JOIN prepared q USING (pair_id) LEFT JOIN vocab v USING (token) GROUP BY p.pair_id),
tokenized AS (
  SELECT c.pair_id, q.split, c.input_ids, [1 for x in c.input_ids] AS attention_mask, c.labels,
    least(q.prompt_size, len(q.toks)) AS prompt_size
  FROM coded c JOIN prepared q USING (pair_id))"""

BATCHED = """
shuffled AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || pair_id), pair_id) - 1 AS rank FROM tokenized),
mega AS (SELECT *, rank // 300 AS megabatch FROM shuffled),
sorted AS (
  SELECT *, row_number() OVER (PARTITION BY megabatch ORDER BY len(input_ids) DESC, rank) - 1 AS place
  FROM mega),
batched AS (
  SELECT *, megabatch * 50 + place // 6 AS batch_id, CAST(place % 6 AS INTEGER) AS batch_pos FROM sorted)"""

RUN_LOG = """
run_log AS (
  SELECT user_id AS run_id, 300 * row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
    CASE WHEN event_type <> 'error' THEN 1 + value / 100 END AS eval_loss,
    CAST(14400 AS BIGINT) AS samples, ts
  FROM events)"""

SPECIAL_TOKENS = [
    "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<|object_ref_start|>", "<|object_ref_end|>",
    "<|box_start|>", "<|box_end|>", "<|quad_start|>", "<|quad_end|>", "<|vision_start|>",
    "<|vision_end|>", "<|vision_pad|>", "<|image_pad|>", "<|video_pad|>", "<tool_call>",
    "</tool_call>", "<|fim_prefix|>", "<|fim_middle|>", "<|fim_suffix|>", "<|fim_pad|>",
    "<|repo_name|>", "<|file_sep|>",
]

SCORES = f"""
scored AS (
  SELECT pair_id, list_filter([
    CASE WHEN diff IS NOT NULL THEN {{'name': 'diff', 'd': 2 * {is_diff("diff")}::INT
      + (length(diff) > 500)::INT, 'm': {is_message("diff")}::INT + (length(diff) < 300)::INT}} END,
    CASE WHEN message IS NOT NULL THEN {{'name': 'message', 'd': 2 * {is_diff("message")}::INT
      + (length(message) > 500)::INT, 'm': {is_message("message")}::INT
      + (length(message) < 300)::INT}} END], lambda s: s IS NOT NULL) AS scores, split
  FROM pairs),
long AS (
  SELECT pair_id, split, s.name AS name, s.d AS d, s.m AS m, pos FROM (
    SELECT pair_id, split, unnest(scores) AS s, generate_subscripts(scores, 1) AS pos FROM scored)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY d DESC, pos) AS dr,
    row_number() OVER (PARTITION BY pair_id ORDER BY m DESC, pos) AS mr,
    count(*) OVER (PARTITION BY pair_id) AS n
  FROM long),
chosen AS (
  SELECT pair_id, max(split) AS split, max(CASE WHEN dr = 1 THEN name END) AS diff_column,
    CASE WHEN max(n) > 1 AND max(CASE WHEN dr = 1 THEN name END) = max(CASE WHEN mr = 1 THEN name END)
      THEN max(CASE WHEN mr = 2 THEN name END) ELSE max(CASE WHEN mr = 1 THEN name END) END AS
      message_column
  FROM ranked GROUP BY pair_id)"""

EARLY_STOP = """
evals AS (
  SELECT run_id, step, eval_loss AS v, row_number() OVER w AS rn,
    min(eval_loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      AS prev
  FROM run_log WHERE eval_loss IS NOT NULL WINDOW w AS (PARTITION BY run_id ORDER BY step)),
flagged AS (SELECT *, prev IS NULL OR v < prev AS improved FROM evals),
counted AS (
  SELECT *, rn - max(CASE WHEN improved THEN rn END) OVER (PARTITION BY run_id ORDER BY step) AS counter
  FROM flagged),
stops AS (SELECT run_id, min(rn) AS stop_rn FROM counted WHERE counter >= 5 GROUP BY run_id),
used AS (SELECT c.*, s.stop_rn FROM counted c LEFT JOIN stops s USING (run_id)
  WHERE s.stop_rn IS NULL OR c.rn <= s.stop_rn),
stopped AS (
  SELECT run_id, max_by(v, rn) FILTER (improved) AS best_value, max_by(step, rn) FILTER (improved) AS
    best_step, arg_max_null(prev, rn) FILTER (improved) AS previous_best,
    CAST(max_by(counter, rn) AS INTEGER) AS counter, max(CASE WHEN rn = stop_rn THEN step END) AS stop_step
  FROM used GROUP BY run_id)"""

PREDICTIONS = f"""
predictions AS (
  SELECT pair_id, diff, diff || {SEP} AS prompt,
    diff || {SEP} || '  Update ' || length(diff) || ' characters' || chr(10) AS generated
  FROM clean),
messages AS (
  SELECT *, {strip("substr(generated, length(prompt) + 1)")} AS commit_message FROM predictions)"""


FOLDED = """
fold AS (
  SELECT run_id, rn, v AS best_value, step AS best_step, CAST(NULL AS DOUBLE) AS previous_best, 0 AS counter,
    CAST(NULL AS BIGINT) AS stop_step
  FROM evals WHERE rn = 1
  UNION ALL
  SELECT e.run_id, e.rn, CASE WHEN e.v < f.best_value - 0.25 THEN e.v ELSE f.best_value END,
    CASE WHEN e.v < f.best_value - 0.25 THEN e.step ELSE f.best_step END,
    CASE WHEN e.v < f.best_value - 0.25 THEN f.best_value ELSE f.previous_best END,
    CASE WHEN e.v < f.best_value - 0.25 THEN 0 ELSE f.counter + 1 END,
    CASE WHEN NOT e.v < f.best_value - 0.25 AND f.counter + 1 >= 5 THEN e.step END
  FROM fold f JOIN evals e ON e.run_id = f.run_id AND e.rn = f.rn + 1 WHERE f.stop_step IS NULL),
ended AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY rn DESC) = 1)
"""


def chat(ending: str) -> str:
    return f"""
WITH msgs AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    lag(coalesce(role, '')) OVER w AS prev, lead(coalesce(role, '')) OVER w AS next
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pieces AS (
  SELECT conv_id, turn,
    CASE WHEN prev IS NULL AND role <> 'system'
      THEN '<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10)
      ELSE '' END ||
    CASE WHEN role IN ('user', 'assistant', 'system')
      THEN '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)
      WHEN role = 'tool' THEN CASE WHEN coalesce(prev, '') <> 'tool' THEN '<|im_start|>user' ELSE '' END
        || chr(10) || '<tool_response>' || chr(10) || text || chr(10) || '</tool_response>'
        || CASE WHEN coalesce(next, '') <> 'tool' THEN '<|im_end|>' || chr(10) ELSE '' END
      ELSE '' END AS piece
  FROM msgs)
SELECT conv_id, string_agg(piece, '' ORDER BY turn){ending} AS text FROM pieces GROUP BY conv_id"""


def chat_tools() -> str:
    """`chat`, where assistant messages of odd turns call one tool or two."""
    arguments = (
        """'{"query": ' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ', "options": {"limit": ' || turn """
        """|| ', "exact": ' || (conv_id % 2 = 0) || '}, "tags": ["a, b: c", "assistant"]}'"""
    )
    call = (
        "chr(10) || '<tool_call>' || chr(10) || '{\"name\": \"{}\", \"arguments\": ' || " + arguments
        + " || '}' || chr(10) || '</tool_call>'"
    )
    offered = (
        "chr(10) || chr(10) || '# Tools' || chr(10) || chr(10) || 'You may call one or more functions to assist with the "
        "user query.' || chr(10) || chr(10) || 'You are provided with function signatures within <tools></tools> XML "
        "tags:' || chr(10) || '<tools>' || chr(10) || '{\"type\": \"function\", \"function\": {\"name\": \"look_up\", "
        "\"parameters\": {\"query\": \"string\", \"limit\": \"integer\"}}}' || chr(10) || '{\"type\": \"function\", "
        "\"function\": {\"name\": \"note\", \"description\": \"Keeps a \\\"note\\\", é\", \"parameters\": {}}}' || "
        "chr(10) || '</tools>' || chr(10) || chr(10) || 'For each function call, return a json object with function "
        "name and arguments within <tool_call></tool_call> XML tags:' || chr(10) || '<tool_call>' || chr(10) || "
        "'{\"name\": <function-name>, \"arguments\": <args-json-object>}' || chr(10) || '</tool_call>'"
    )
    return f"""
WITH msgs AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, text,
    CASE WHEN role = 'assistant' AND turn % 2 = 1 THEN {call.replace("{}", "look_up")}
      || CASE WHEN conv_id % 3 = 0 THEN {call.replace("{}", "note")} ELSE '' END ELSE '' END AS calls,
    lag(coalesce(role, '')) OVER w AS prev, lead(coalesce(role, '')) OVER w AS next
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
said AS (
  SELECT * REPLACE (CASE WHEN calls <> '' AND conv_id % 4 = 0 THEN '' ELSE coalesce(text, '') END AS text) FROM msgs),
pieces AS (
  SELECT conv_id, turn,
    CASE WHEN prev IS NULL THEN '<|im_start|>system' || chr(10) || CASE WHEN role = 'system' THEN text
      ELSE 'You are a helpful assistant.' END || {offered} || '<|im_end|>' || chr(10) ELSE '' END ||
    CASE WHEN calls <> '' THEN '<|im_start|>assistant' || CASE WHEN text <> '' THEN chr(10) || text ELSE '' END
        || calls || '<|im_end|>' || chr(10)
      WHEN role = 'system' AND prev IS NULL THEN ''
      WHEN role IN ('user', 'assistant', 'system')
      THEN '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)
      WHEN role = 'tool' THEN CASE WHEN coalesce(prev, '') <> 'tool' THEN '<|im_start|>user' ELSE '' END
        || chr(10) || '<tool_response>' || chr(10) || text || chr(10) || '</tool_response>'
        || CASE WHEN coalesce(next, '') <> 'tool' THEN '<|im_end|>' || chr(10) ELSE '' END
      ELSE '' END AS piece
  FROM said)
SELECT conv_id, string_agg(piece, '' ORDER BY turn) AS text FROM pieces GROUP BY conv_id"""


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def oracle_sql() -> dict[str, str]:
    base = (PAIRS, NORM, JUDGED)
    tok = (*base, VOCAB, TOKENIZED)
    sent = f"array_to_string({tokens(f'diff || {SEP}')}[1:{MAX_LENGTH}], '')"
    specials = "list_value(" + ", ".join(f"'{t}'" for t in SPECIAL_TOKENS) + ")"
    dropped = r"<\|endoftext\|>|<\|im_start\|>|<\|im_end\|>|<\|object_ref_start\|>|<\|object_ref_end\|>|<\|box_start\|>|<\|box_end\|>|<\|quad_start\|>|<\|quad_end\|>|<\|vision_start\|>|<\|vision_end\|>|<\|vision_pad\|>|<\|image_pad\|>|<\|video_pad\|>"  # noqa: E501
    clean_body = "SELECT pair_id, diff, message, split FROM clean"
    stop_body = "SELECT * FROM stopped"
    decoded = f"""
ids AS (SELECT pair_id, {{part}} AS xs FROM tokenized),
spread AS (SELECT pair_id, unnest(xs) AS id, generate_subscripts(xs, 1) AS pos FROM ids),
texts AS (
  SELECT i.pair_id, coalesce(max(j.text), '') AS text FROM ids i LEFT JOIN (
    SELECT pair_id, string_agg(token, '' ORDER BY pos) AS text FROM spread JOIN vocab USING (id)
    WHERE id >= 2 GROUP BY pair_id) j USING (pair_id) GROUP BY i.pair_id)"""
    prompt_texts = decoded.format(part="input_ids[1:prompt_size]")
    target_texts = (
        decoded.format(part="labels[prompt_size + 1:]")
        .replace("ids AS (", "ids2 AS (", 1)
        .replace("spread", "spread2")
        .replace("FROM ids)", "FROM ids2)")
        .replace("FROM ids i", "FROM ids2 i")
        .replace("texts AS", "texts2 AS")
    )
    found = {
        # sources and sinks
        "load_pairs": _with(PAIRS, body="SELECT pair_id, diff, message, split FROM pairs"),
        "split_inventory": _with(
            PAIRS,
            body="SELECT split, count(*) AS n_rows, 'pair_id,diff,message' AS columns FROM pairs GROUP BY split",
        ),
        "token_cache": _with(
            *tok,
            body=f"SELECT pair_id, split, {csv('input_ids')} AS input_ids, {csv('attention_mask')} AS "
            f"attention_mask, {csv('labels')} AS labels FROM tokenized",
        ),
        "predictions_json": _with(
            *base,
            PREDICTIONS,
            body="SELECT commit_message, CAST(0.0 AS DOUBLE) AS generation_time, diff FROM messages",
        ),
        "predictions_text": _with(
            PAIRS,
            body="SELECT replace(replace(replace(coalesce(diff, ''), chr(92), chr(92) || chr(92)), "
            "chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r') AS line FROM pairs",
        ),
        # text scalars
        "normalize_newlines": _with(
            PAIRS,
            body=f"SELECT pair_id, {normalize('diff')} AS diff, {normalize('message')} AS message FROM pairs",
        ),
        "preprocess_pair": _with(
            PAIRS, NORM, body="SELECT pair_id, diff, message, split FROM norm"
        ),
        "looks_like_diff": _with(
            PAIRS,
            body=f"SELECT pair_id, {is_diff('diff')} AS diff_is_diff, {is_diff('message')} AS "
            "message_is_diff FROM pairs",
        ),
        "diff_signals": _with(
            PAIRS,
            body="SELECT pair_id, "
            + ", ".join(
                f"regexp_matches(coalesce(diff, ''), '{p}') AS {name}" for name, p in SIGNALS.items()
            )
            + " FROM pairs",
        ),
        "looks_like_message": _with(
            PAIRS,
            body=f"SELECT pair_id, coalesce({is_message('diff')}, false) AS diff_is_message, "
            f"coalesce({is_message('message')}, false) AS message_is_message FROM pairs",
        ),
        "word_count": f"SELECT doc_id, CAST({words('text')} AS INTEGER) AS n_words FROM documents",
        "preview": "SELECT doc_id, CASE WHEN length(text) > 800 THEN substr(text, 1, 800) || '...' ELSE "
        "text END AS preview FROM documents",
        "build_prompt": _with(*base, body=f"SELECT pair_id, diff || {SEP} AS prompt FROM clean"),
        "build_training_text": _with(
            *base, body=f"SELECT pair_id, diff || {SEP} || message || '<|endoftext|>' AS text FROM clean"
        ),
        "extract_completion": _with(
            *base, PREDICTIONS, body="SELECT pair_id, commit_message FROM messages"
        ),
        "strip_special_tokens": f"SELECT doc_id, regexp_replace(t || text || t, '{dropped}', '', 'g') AS text "
        f"FROM (SELECT doc_id, text, {specials}[doc_id % 22 + 1] AS t FROM documents)",
        # filters
        "is_bad_message": _with(*base, body="SELECT pair_id, NOT good_message AS is_bad FROM kept"),
        "reject_reason": _with(
            *base,
            body="SELECT pair_id, split, CASE WHEN diff_short THEN 'diff_short' WHEN diff_long THEN "
            "'diff_long' WHEN is_empty THEN 'empty' WHEN in_stoplist THEN 'stoplist' WHEN few_chars THEN "
            "'few_chars' WHEN few_words THEN 'few_words' WHEN is_reference THEN 'reference' WHEN "
            "has_placeholder THEN 'placeholder' END AS reason FROM kept",
        ),
        "in_stoplist": _with(*base, body="SELECT pair_id, in_stoplist AS hit FROM judged"),
        "too_few_chars": _with(*base, body="SELECT pair_id, few_chars AS hit FROM judged"),
        "too_few_words": _with(*base, body="SELECT pair_id, few_words AS hit FROM judged"),
        "is_reference_only": _with(*base, body="SELECT pair_id, is_reference AS hit FROM judged"),
        "has_placeholder": _with(*base, body="SELECT pair_id, has_placeholder AS hit FROM judged"),
        "diff_length_ok": _with(
            *base, body="SELECT pair_id, NOT diff_short AND NOT diff_long AS hit FROM judged"
        ),
        "keep_pair": _with(
            *base,
            body="SELECT pair_id, good_message AND NOT diff_short AND NOT diff_long AS hit FROM kept",
        ),
        "clean_pairs": _with(*base, body=clean_body),
        "has_target": _with(
            *tok, body="SELECT pair_id, len(labels) > prompt_size AS has_target FROM tokenized"
        ),
        "has_input": _with(
            PAIRS, body="SELECT pair_id, message FROM pairs WHERE message IS NOT NULL AND message <> ''"
        ),
        # schema inference
        "score_text_columns": _with(
            PAIRS,
            SCORES,
            body="SELECT pair_id, array_to_string([s.name || ':' || s.d || ':' || s.m for s in scores], ',') "
            "AS scores FROM scored",
        ),
        "choose_columns": _with(
            PAIRS,
            SCORES,
            body="SELECT p.pair_id, c.diff_column, c.message_column FROM pairs p LEFT JOIN chosen c USING "
            "(pair_id)",
        ),
        "infer_columns": _with(
            PAIRS,
            SCORES,
            body="SELECT coalesce(diff_column, 'diff') AS diff_column, coalesce(message_column, 'message') AS "
            "message_column FROM pairs p LEFT JOIN chosen c USING (pair_id) WHERE p.split = 'train' ORDER BY "
            "p.pair_id LIMIT 1",
        ),
        "summed_columns": _with(
            PAIRS,
            SCORES,
            "sums AS (SELECT name, min(CASE name WHEN 'diff' THEN 1 ELSE 2 END) AS pos, sum(d) AS d, sum(m) AS m "
            "FROM long GROUP BY name)",
            body="SELECT d.name AS diff_column, CASE WHEN d.name = m.name THEN coalesce((SELECT name FROM sums "
            "WHERE name <> d.name), d.name) ELSE m.name END AS message_column FROM (SELECT name FROM sums ORDER "
            "BY d DESC, pos LIMIT 1) d, (SELECT name FROM sums ORDER BY m DESC, pos LIMIT 1) m",
        ),
        # aggregations
        "reject_breakdown": _with(
            *base,
            body="SELECT split, CASE WHEN diff_short THEN 'diff_short' WHEN diff_long THEN 'diff_long' WHEN "
            "is_empty THEN 'empty' WHEN in_stoplist THEN 'stoplist' WHEN few_chars THEN 'few_chars' WHEN few_words "
            "THEN 'few_words' WHEN is_reference THEN 'reference' WHEN has_placeholder THEN 'placeholder' END AS "
            "reason, count(*) AS n_rows FROM kept GROUP BY ALL",
        ),
        "split_overlap": _with(
            PAIRS,
            NORM,
            body="SELECT split, count(*) AS n_rows, count(*) FILTER (message IN (SELECT message FROM norm WHERE "
            "split = 'train')) AS n_in_train FROM norm WHERE split <> 'train' GROUP BY split",
        ),
        "token_stats": _with(
            *tok,
            body="SELECT split, count(*) AS n_rows, CAST(sum(len(input_ids)) AS BIGINT) AS n_tokens, "
            "CAST(max(len(input_ids)) AS INTEGER) AS longest, quantile_cont(len(input_ids), 0.5)::DOUBLE AS median, "
            f"count(*) FILTER (len(input_ids) >= {MAX_LENGTH}) AS n_full, "
            "CAST(sum(len(labels) - prompt_size) AS BIGINT) AS n_targets, "
            "count(*) FILTER (len(labels) = prompt_size) AS n_without_target FROM tokenized GROUP BY split",
        ),
        "retention_report": _with(
            *base,
            body="SELECT split, count(*) AS before, count(*) FILTER (good_message AND NOT diff_short AND NOT "
            "diff_long) AS after, 100.0::DOUBLE * count(*) FILTER (good_message AND NOT diff_short AND NOT "
            "diff_long) / count(*) AS kept_pct FROM kept GROUP BY split",
        ),
        "total_size": _with(*base, body="SELECT count(*) AS n_rows FROM clean"),
        "eval_summary": _with(
            PAIRS,
            body="SELECT split, round(sum(loss * n) / sum(n), 9) AS loss, round(exp(sum(loss * n) / sum(n)), "
            "6) AS perplexity FROM (SELECT split, 1 + length(coalesce(diff, '')) % 500 / "
            f"100.0::DOUBLE AS loss, {words(chr(39) * 2 + ' || coalesce(message, ' + chr(39) * 2 + ')')} AS n "
            "FROM pairs WHERE pair_id % 11 <> 0) GROUP BY split",
        ),
        "run_summary": _with(
            RUN_LOG,
            body="SELECT run_id, runtime, samples, CASE WHEN runtime > 0 THEN round(samples / runtime, 9) END "
            "AS samples_per_second FROM (SELECT run_id, (epoch_us(max(ts)) - epoch_us(min(ts))) / "
            "1e6::DOUBLE AS runtime, CAST(sum(samples) AS BIGINT) AS samples FROM run_log GROUP BY run_id)",
        ),
        "sample_count": _with(
            *tok, body="SELECT count(*) AS n_samples FROM tokenized WHERE len(labels) > prompt_size"
        ),
        # sampling
        "cap_splits": _with(*base, CAPPED, body="SELECT pair_id, diff, message, split FROM capped"),
        "get_splits": _with(*base, CAPPED, body="SELECT pair_id, diff, message, split FROM capped"),
        "eval_sample": _with(
            *tok,
            body="SELECT pair_id, split FROM (SELECT * FROM tokenized WHERE split = 'test' ORDER BY md5('42:' "
            "|| pair_id), pair_id LIMIT 20) WHERE len(labels) > prompt_size",
        ),
        # token arrays
        "split_tokens": f"SELECT doc_id, len(t) AS n_tokens, array_to_string(t, '|') AS tokens FROM (SELECT "
        f"doc_id, {tokens('text')} AS t FROM documents)",
        "truncate": f"SELECT doc_id, array_to_string({tokens('text')}[1:{MAX_LENGTH}], '|') AS tokens FROM "
        "documents",
        "build_vocab": _with(*base, VOCAB, body="SELECT token, id FROM vocab"),
        "encode": _with(
            *base,
            VOCAB,
            body=f"SELECT doc_id, {csv('list(coalesce(id, 1) ORDER BY pos)')} AS ids FROM (SELECT doc_id, "
            f"unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM (SELECT doc_id, {tokens('text')} AS t "
            "FROM documents)) LEFT JOIN vocab USING (token) GROUP BY doc_id",
        ),
        "decode": _with(
            *tok, decoded.format(part="input_ids"), body="SELECT pair_id, text FROM texts"
        ),
        "tokenize_pairs_with": _with(
            *base,
            f"made AS (SELECT pair_id, split, list_transform(string_split(diff || {SEP} || message || '<|endoftext|>', ''), "
            f"lambda c: unicode(c))[1:{MAX_LENGTH}] AS input_ids, least(length(diff || {SEP}), {MAX_LENGTH}) AS p FROM clean)",
            body=f"SELECT pair_id, split, {csv('input_ids')} AS input_ids, {csv('[1 for x in input_ids]')} AS "
            f"attention_mask, {csv('[-100 for x in input_ids[1:p]] || input_ids[p + 1:]')} AS labels FROM made",
        ),
        "attention_mask": _with(
            *tok, body=f"SELECT pair_id, {csv('attention_mask')} AS attention_mask FROM tokenized"
        ),
        "mask_labels": _with(*tok, body=f"SELECT pair_id, {csv('labels')} AS labels FROM tokenized"),
        "prompt_len": _with(
            *tok, body="SELECT pair_id, CAST(prompt_size AS INTEGER) AS prompt_len FROM tokenized"
        ),
        "target_ids": _with(
            *tok,
            body=f"SELECT pair_id, {csv('input_ids[1:prompt_size]')} AS prompt_ids, "
            f"{csv('[x for x in labels if x <> -100]')} AS target_ids FROM tokenized",
        ),
        "tokenize_pairs": _with(
            *tok,
            body=f"SELECT pair_id, split, {csv('input_ids')} AS input_ids, {csv('attention_mask')} AS "
            f"attention_mask, {csv('labels')} AS labels FROM tokenized",
        ),
        "length_batches": _with(
            *tok, BATCHED, body="SELECT pair_id, megabatch, batch_id, batch_pos FROM batched"
        ),
        "pad_batches": _with(
            *tok,
            BATCHED,
            body="""
, widths AS (
  SELECT batch_id, CAST(ceil(max(len(input_ids)) / 8.0) * 8 AS INTEGER) AS width FROM batched GROUP BY batch_id),
padded AS (
  SELECT batch_id, width, batch_pos, pair_id,
    array_to_string(input_ids || [0 for i in range(width - len(input_ids))], ',') AS i,
    array_to_string(attention_mask || [0 for i in range(width - len(input_ids))], ',') AS a,
    array_to_string(labels || [-100 for i in range(width - len(input_ids))], ',') AS l
  FROM batched JOIN widths USING (batch_id))
SELECT batch_id, width, string_agg(pair_id, ',' ORDER BY batch_pos) AS pair_ids,
  string_agg(i, ';' ORDER BY batch_pos) AS input_ids, string_agg(a, ';' ORDER BY batch_pos) AS attention_mask,
  string_agg(l, ';' ORDER BY batch_pos) AS labels
FROM padded GROUP BY batch_id, width""",
        ),
        "padding_waste": _with(
            *tok,
            BATCHED,
            "widths AS (SELECT batch_id, count(*) * CAST(ceil(max(len(input_ids)) / 8.0) * 8 AS BIGINT) AS places, "
            "sum(len(input_ids)) AS used FROM batched GROUP BY batch_id)",
            body="SELECT CAST(sum(places) AS BIGINT) AS places, CAST(sum(places - used) AS BIGINT) AS padding, "
            "round(100.0::DOUBLE * sum(places - used)::DOUBLE / sum(places)::DOUBLE, 6) AS padding_pct FROM widths",
        ),
        "step_plan": _with(
            *tok,
            BATCHED,
            body="SELECT pair_id, batch_id AS micro_batch, batch_id // 8 AS optimizer_step FROM batched",
        ),
        # metrics and run logs
        "perplexity": _with(
            RUN_LOG,
            body="SELECT run_id, step, round(exp(eval_loss), 9) AS perplexity FROM run_log",
        ),
        "run_perplexity": "SELECT user_id AS run_id, min(CASE WHEN event_type = 'view' THEN 1 + value / 100 "
        "END) AS val_loss, min(CASE WHEN event_type = 'error' THEN 1 + value / 100 END) AS test_loss, "
        "round(exp(min(CASE WHEN event_type = 'view' THEN 1 + value / 100 END)), 9) AS val_perplexity, "
        "round(exp(min(CASE WHEN event_type = 'error' THEN 1 + value / 100 END)), 9) AS test_perplexity FROM "
        "events GROUP BY user_id",
        "early_stop": _with(RUN_LOG, EARLY_STOP, body=stop_body),
        "early_stop_threshold": "WITH RECURSIVE "
        + ",".join((RUN_LOG, EARLY_STOP, FOLDED))
        + "SELECT run_id, best_value, best_step, previous_best, counter, stop_step FROM ended",
        "early_stop_higher": _with(
            RUN_LOG, EARLY_STOP.replace("min(eval_loss)", "max(eval_loss)").replace("v < prev", "v > prev"), body=stop_body
        ),
        "best_checkpoint": _with(
            RUN_LOG,
            body="SELECT run_id, first(step ORDER BY eval_loss, step) AS best_step, min(eval_loss) AS eval_loss "
            "FROM run_log WHERE eval_loss IS NOT NULL GROUP BY run_id",
        ),
        "thin_log": _with(RUN_LOG, body="SELECT run_id, step, eval_loss FROM run_log WHERE step % 900 = 0"),
        "format_log": _with(
            RUN_LOG,
            body="SELECT run_id, step, 'Step ' || step || ': ' || CASE WHEN eval_loss IS NULL THEN '' ELSE "
            "'eval_loss=' || printf('%.4f', eval_loss) || ', ' END || 'scaled=' || printf('%.4f', step / "
            "32768.0::DOUBLE) || ', perplexity=' || CAST(3 * CAST(pow(2::DOUBLE, (step // 300) % 40 + 50) AS HUGEINT) AS "
            "VARCHAR) || '.0000' AS line FROM run_log WHERE step % 900 = 0",
        ),
        # sub-words
        "subword_round_trip": "SELECT doc_id, text FROM documents",
        "subword_pairs": _with(
            *base,
            body=f"SELECT pair_id, split, diff || {SEP} AS prompt, message || '<|endoftext|>' AS target FROM clean",
        ),
        # generation, review, chat
        "split_diff_by_file": _with(
            PAIRS,
            "cut AS (SELECT pair_id, list_filter(string_split(replace(chr(10) || diff, chr(10) || 'diff --git ', "
            "chr(10) || chr(1) || 'diff --git '), chr(1)), lambda x: true) AS parts FROM pairs WHERE diff <> ''), "
            "named AS (SELECT pair_id, list_filter(list_transform(parts, lambda x, i: CASE WHEN i = 1 THEN substr(x, 2) "
            "ELSE x END), lambda x: x <> '') AS parts FROM cut)",
            body="SELECT pair_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS part, unnest(parts) AS diff "
            "FROM named",
        ),
        "read_patch_sections": _with(
            PAIRS,
            "cut AS (SELECT pair_id, string_split(replace(chr(10) || diff || chr(10), chr(10) || 'diff --git ', "
            "chr(10) || chr(1) || 'diff --git '), chr(1)) AS parts FROM pairs WHERE diff <> ''), "
            "named AS (SELECT pair_id, list_filter(list_transform(parts, lambda x, i: CASE WHEN i = 1 THEN substr(x, 2) "
            "ELSE x END), lambda x: x <> '') AS parts FROM cut), "
            "flat AS (SELECT pair_id, generate_subscripts(parts, 1) AS part, unnest(parts) AS diff FROM named)",
            body="SELECT pair_id, CAST(coalesce(sum(strlen(diff)) OVER (PARTITION BY pair_id ORDER BY part "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS position, diff FROM flat",
        ),
        "read_patches": "SELECT doc_id, replace(replace(text, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n') "
        "AS diff FROM documents WHERE text <> ''",
        "generate_batch": _with(
            *base,
            body=f"SELECT pair_id, diff || {SEP} AS prompt, 'Update ' || length({sent}) || ' characters' AS "
            "commit_message, CASE WHEN length(diff) > 800 THEN substr(diff, 1, 800) || '...' ELSE diff END AS "
            "truncated_diff FROM clean",
        ),
        "generation_results": _with(
            *base,
            body=f"SELECT diff, 'Update ' || length({sent}) || ' characters' AS commit_message, diff || {SEP} "
            "AS prompt, true AS timed, CASE WHEN length(diff) > 800 THEN substr(diff, 1, 800) || '...' ELSE "
            "diff END AS truncated_diff FROM clean",
        ),
        "eval_records": _with(
            *tok,
            prompt_texts,
            target_texts,
            body=f"SELECT t.pair_id AS index, p.text AS prompt, 'Update ' || length(p.text) || ' characters' "
            f"AS prediction, {strip('g.text')} AS ground_truth FROM tokenized t JOIN texts p USING (pair_id) "
            "JOIN texts2 g USING (pair_id) WHERE len(t.labels) > t.prompt_size",
        ),
        "render_chat": chat(""),
        "render_chat_prompt": chat(" || '<|im_start|>assistant' || chr(10)"),
        "render_chat_tools": chat_tools(),
        # streaming
        "clean_pairs_stream": _with(*base, body=clean_body),
        "early_stop_stream": _with(RUN_LOG, EARLY_STOP, body=stop_body),
    }
    same = {"encode_blocks": "encode", "decode_blocks": "decode", "clean_pairs_counted": "retention_report"}
    same["token_store"] = "token_cache"
    return found | {name: found[other] for name, other in same.items()}
