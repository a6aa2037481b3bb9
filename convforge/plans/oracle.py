"""DuckDB SQL fragments shared by the oracle statements of the catalog.

These are independent restatements of each rule in DuckDB SQL over the
same Parquet tables; they share no code with the Spark plans.
"""

from __future__ import annotations

# The 29 white-space code points of Python's str.strip() as a DuckDB string.
WHITE_SPACE = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197,
               8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288)
DUCK_WS = "(" + " || ".join(f"chr({c})" for c in WHITE_SPACE) + ")"


def strip(expr: str) -> str:
    return f"trim({expr}, {DUCK_WS})"


# Per-message reason and per-conversation profile of the long table.
PROFILE_CTE = f"""
msg AS (
  SELECT conv_id, turn, role, text,
         CASE WHEN role IS NULL OR role NOT IN ('system', 'user', 'assistant') THEN 'bad_role'
              WHEN text IS NULL THEN 'content_not_string'
              WHEN length({strip('text')}) = 0 THEN 'blank_content' END AS mr
  FROM conversations),
prof0 AS (
  SELECT conv_id,
         CAST(count(*) AS BIGINT) AS n_messages,
         CAST(count(*) FILTER (WHERE role = 'system') AS BIGINT) AS n_system,
         CAST(count(*) FILTER (WHERE role = 'user') AS BIGINT) AS n_user,
         CAST(count(*) FILTER (WHERE role = 'assistant') AS BIGINT) AS n_assistant,
         CAST(coalesce(sum(length({strip('text')})), 0) AS BIGINT) AS n_chars,
         arg_min(mr, turn) FILTER (WHERE mr IS NOT NULL) AS first_r,
         min(turn) FILTER (WHERE mr IS NOT NULL) AS first_turn
  FROM msg GROUP BY conv_id),
prof AS (
  SELECT *,
         CASE WHEN n_messages < 2 THEN 'messages_not_list_or_short'
              WHEN first_r IS NOT NULL THEN first_r
              WHEN n_user = 0 OR n_assistant = 0 THEN 'missing_user_or_assistant' END AS reason
  FROM prof0),
valid AS (SELECT * FROM prof WHERE reason IS NULL)"""


def split_cte(val_ratio: float = 0.1, seed: int = 42) -> str:
    """Rank of valid conversations in md5 order and the exact-size cut."""
    return f"""
ranked AS (
  SELECT *, CAST(row_number() OVER (ORDER BY md5(CAST(conv_id AS VARCHAR) || ':{int(seed)}')) AS BIGINT) AS shuffle_rank,
         count(*) OVER () AS n_all
  FROM valid),
splitted AS (
  SELECT *,
         CAST(floor(CAST(n_all AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST({float(val_ratio)!r} AS DOUBLE))) AS BIGINT) AS cut
  FROM ranked),
labelled AS (
  SELECT *, CASE WHEN shuffle_rank <= cut THEN 'train' ELSE 'val' END AS split,
         CAST(CASE WHEN shuffle_rank <= cut THEN shuffle_rank ELSE shuffle_rank - cut END AS BIGINT) AS split_rank
  FROM splitted)"""


STATS_SELECT = """
  CAST(count(*) AS BIGINT) AS conversations,
  CAST(coalesce(sum(n_messages), 0) AS BIGINT) AS total_turns,
  CAST(coalesce(sum(n_system), 0) AS BIGINT) AS system_prompts,
  CAST(coalesce(sum(n_user), 0) AS BIGINT) AS user_messages,
  CAST(coalesce(sum(n_assistant), 0) AS BIGINT) AS assistant_messages,
  CAST(count(*) FILTER (WHERE n_user > 1) AS BIGINT) AS multi_turn_conversations,
  CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS total_characters,
  CAST(coalesce(sum(n_chars), 0) // 3 AS BIGINT) AS estimated_tokens"""


# Stripped messages of valid conversations.
VALID_MSGS_CTE = PROFILE_CTE + f""",
vm AS (
  SELECT c.conv_id, c.turn, c.role, {strip('c.text')} AS content
  FROM conversations c SEMI JOIN valid v ON c.conv_id = v.conv_id)"""


def chatml(role: str, content: str) -> str:
    """One ChatML-rendered message in DuckDB SQL."""
    return f"('<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10))"


GEN_PROMPT = "('<|im_start|>assistant' || chr(10))"


# Chat text per valid conversation with its split label.
def labelled_text_cte(val_ratio: float = 0.1, seed: int = 42) -> str:
    return VALID_MSGS_CTE + "," + split_cte(val_ratio, seed) + f""",
ct AS (SELECT conv_id, string_agg({chatml('role', 'content')}, '' ORDER BY turn) AS text
       FROM vm GROUP BY conv_id),
lt AS (SELECT l.conv_id, l.split, l.split_rank, ct.text FROM labelled l JOIN ct USING (conv_id))"""


WORD_RE = r"'[\p{L}\p{M}\p{N}]+'"

UNIGRAM_SCORES_CTE = f""",
trtok AS (SELECT unnest(regexp_extract_all(text, {WORD_RE})) AS tok FROM lt WHERE split = 'train'),
model AS (SELECT tok, count(*) AS cnt FROM trtok GROUP BY tok),
tot AS (SELECT sum(cnt) AS n, count(*) AS v FROM model),
vtok AS (SELECT conv_id, split_rank, unnest(regexp_extract_all(text, {WORD_RE})[1:2048]) AS tok
         FROM lt WHERE split = 'val'),
sc AS (SELECT conv_id, split_rank, CAST(count(*) AS BIGINT) AS n_tokens,
              avg(-ln((coalesce(model.cnt, 0) + 1) / (tot.n + tot.v + 1))) AS loss
       FROM vtok LEFT JOIN model USING (tok) CROSS JOIN tot
       GROUP BY conv_id, split_rank)"""


# Expected outcome of the injected raw lines (see plans/injected.py).
INJECTED_CTE = PROFILE_CTE + """,
inj AS (
  SELECT conv_id, n_messages, CAST(conv_id % 12 AS INTEGER) AS m, reason, first_r, first_turn
  FROM prof),
expct AS (
  SELECT conv_id, m, n_messages,
         CASE WHEN m IN (1, 2) THEN 'parse_error'
              WHEN m = 3 THEN 'no_messages_key'
              WHEN m = 4 THEN 'messages_not_list_or_short'
              WHEN n_messages < 2 THEN 'messages_not_list_or_short'
              WHEN m = 5 THEN 'message_not_object'
              WHEN m = 6 THEN 'missing_role_or_content'
              WHEN m = 7 THEN 'bad_role'
              WHEN m = 8 THEN 'blank_content'
              WHEN m = 9 THEN 'content_not_string'
              ELSE coalesce(reason, 'ok') END AS outcome,
         CAST(CASE WHEN n_messages >= 2 AND m = 5 THEN 1
                   WHEN n_messages >= 2 AND m = 7 THEN n_messages - 1
                   WHEN n_messages >= 2 AND m IN (6, 8, 9) THEN 0
                   WHEN m IN (0, 10, 11) AND reason = first_r THEN first_turn
                   ELSE -1 END AS BIGINT) AS bad_index
  FROM inj)"""

# For concatenated files: no truncation damage; cases 1 and 2 get two junk
# characters before the object instead.
INJECTED_MIXED_CTE = PROFILE_CTE + """,
expct AS (
  SELECT conv_id, CAST(conv_id % 12 AS INTEGER) AS m,
         CASE WHEN conv_id % 12 = 3 THEN 'no_messages_key'
              WHEN conv_id % 12 = 4 THEN 'messages_not_list_or_short'
              WHEN n_messages < 2 THEN 'messages_not_list_or_short'
              WHEN conv_id % 12 = 5 THEN 'message_not_object'
              WHEN conv_id % 12 = 6 THEN 'missing_role_or_content'
              WHEN conv_id % 12 = 7 THEN 'bad_role'
              WHEN conv_id % 12 = 8 THEN 'blank_content'
              WHEN conv_id % 12 = 9 THEN 'content_not_string'
              ELSE coalesce(reason, 'ok') END AS outcome,
         CAST(CASE WHEN conv_id % 12 IN (1, 2) THEN 2 ELSE 0 END AS BIGINT) AS errors_before
  FROM prof)"""


def echo_generated(prompt: str) -> str:
    """The stand-in generator's stripped reply, in DuckDB SQL."""
    return f"('reply:' || length({prompt}) || ' ' || md5({prompt}))"


EVAL_CTE = f""",
fu AS (SELECT conv_id, min(turn) AS ut FROM vm WHERE role = 'user' GROUP BY conv_id),
ctx AS (SELECT vm.conv_id,
               string_agg({chatml('vm.role', 'vm.content')}, '' ORDER BY vm.turn) || {GEN_PROMPT} AS prompt
        FROM vm JOIN fu USING (conv_id) WHERE vm.turn <= fu.ut GROUP BY vm.conv_id),
fx AS (SELECT conv_id,
              arg_min(content, turn) FILTER (WHERE role = 'user') AS user_query,
              arg_min(content, turn) FILTER (WHERE role = 'assistant') AS expected
       FROM vm GROUP BY conv_id),
rv AS (SELECT l.split_rank, fx.user_query, fx.expected, {echo_generated('ctx.prompt')} AS generated
       FROM labelled l JOIN ctx USING (conv_id) JOIN fx USING (conv_id) WHERE l.split = 'val')"""

REVIEW_SELECT = """split_rank, user_query, expected, generated,
       substring(user_query, 1, 100) || '...' AS user_preview,
       substring(coalesce(nullif(expected, ''), 'N/A'), 1, 100) || '...' AS expected_preview,
       substring(generated, 1, 100) || '...' AS generated_preview"""

# Replay log derived from the table: a session is four conversations; some
# lines become commands or blanks by fixed modular rules.
REPLAY_LOG_CTE = f"""
lg AS (
  SELECT CAST(conv_id // 4 AS BIGINT) AS session, CAST(conv_id * 1000 + turn AS BIGINT) AS line_no,
         CASE WHEN (conv_id * 7 + turn) % 13 = 5 THEN 'reset'
              WHEN (conv_id * 7 + turn) % 13 = 9 THEN ' Reset '
              WHEN (conv_id * 3 + turn) % 29 = 7 THEN 'quit'
              WHEN (conv_id + turn) % 31 = 11 THEN ' EXIT'
              WHEN (conv_id + turn) % 17 = 3 THEN '   '
              ELSE text END AS text
  FROM conversations),
k AS (
  SELECT session, line_no, {strip('text')} AS content,
         CASE WHEN length({strip('text')}) = 0 THEN 'blank'
              WHEN lower({strip('text')}) IN ('quit', 'exit') THEN 'quit'
              WHEN lower({strip('text')}) = 'reset' THEN 'reset'
              ELSE 'user' END AS kind
  FROM lg),
q AS (SELECT session, min(line_no) FILTER (WHERE kind = 'quit') AS qline FROM k GROUP BY session),
live AS (SELECT k.* FROM k JOIN q USING (session)
         WHERE (q.qline IS NULL OR k.line_no < q.qline) AND k.kind IN ('reset', 'user')),
seg AS (SELECT *, CAST(sum(CASE WHEN kind = 'reset' THEN 1 ELSE 0 END)
                       OVER (PARTITION BY session ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment
        FROM live),
u AS (SELECT session, segment, content,
             CAST(row_number() OVER (PARTITION BY session, segment ORDER BY line_no) AS BIGINT) AS position
      FROM seg WHERE kind = 'user')"""
