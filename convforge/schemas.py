"""Canonical schemas, fixed values and default parameters."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])
MESSAGES = T.ArrayType(MESSAGE)

# Processed split files hold exactly this one column.
CONV_FILE = T.StructType([T.StructField("messages", MESSAGES)])

# Long form, the shape of the test table ``conversations``.
TURN = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])

STATS_COLUMNS = [
    "conversations", "total_turns", "system_prompts", "user_messages",
    "assistant_messages", "multi_turn_conversations", "total_characters",
    "estimated_tokens",
]

# ---------------------------------------------------------------------------
# Fixed values that must agree with the reference behaviour.
# ---------------------------------------------------------------------------
# Accepted message roles (case-sensitive, untrimmed).
ROLES = ("system", "user", "assistant")
# Characters per estimated token in the corpus statistics.
CHARS_PER_TOKEN = 3
# A conversation needs at least this many messages.
MIN_MESSAGES = 2
# Separators skipped between values of a concatenated JSON file.
MIXED_JSON_SEPARATORS = " \t\r\n,"
# Running perplexity is reported after every this many examples.
RUNNING_EVERY = 10
# Default split parameters and sequence budget.
DEFAULT_VAL_RATIO = 0.1
DEFAULT_SEED = 42
DEFAULT_MAX_TOKENS = 2048
DEFAULT_NUM_SAMPLES = 5
# Display widths of the review report and the sample preview.
REVIEW_PREVIEW_CHARS = 100
ROW_PREVIEW_CHARS = 80
TEXT_PREVIEW_CHARS = 500
# Replay-log commands (compared after strip + lower).
QUIT_COMMANDS = ("quit", "exit")
RESET_COMMAND = "reset"
# Generation parameters passed through to a user generator untouched.
DEFAULT_GENERATION = {
    "max_new_tokens": 512,
    "temperature": 0.7,
    "top_p": 0.9,
    "top_k": 50,
    "repetition_penalty": 1.1,
    "do_sample": True,
}


def _python_whitespace() -> str:
    # Python's str.strip() removes exactly the code points for which
    # str.isspace() is true; derive the set by that rule (29 code points).
    return "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


# Trim set equal to Python's str.strip(); Spark's plain trim() removes only
# U+0020.
WS = _python_whitespace()

# Default system prompt for built prompts and replayed sessions.  The
# deployment-specific persona text is a parameter, not part of the library.
DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant."
