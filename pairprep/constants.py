"""Values that decide results and therefore must stay exactly as they are."""

# Column and split names
DIFF = "diff"
MESSAGE = "message"
SPLIT = "split"
KEY = "pair_id"
SPLITS = ("train", "validation", "test")

# Filter thresholds
MIN_DIFF_CHARS = 50
MAX_DIFF_CHARS = 8000
MIN_MESSAGE_CHARS = 3
MIN_MESSAGE_WORDS = 3
MAX_MESSAGE_LIKE_WORDS = 200
DIFF_LIKE_CHARS = 500
MESSAGE_LIKE_CHARS = 300

# Messages rejected on an exact, lower-cased match
STOPLIST = ("update", "updated", "fix", "fixed", "wip", ".", "..", "...", "temp", "test")

# Split caps and shuffle seed
CAPS = {"train": 120000, "validation": 15000, "test": 15000}
SHUFFLE_SEED = 9105

# Prompt and sequence layout
SEPARATOR = "\n\nCommit message:\n"
MAX_LENGTH = 512
IGNORED_LABEL = -100
BATCH_SIZE = 6
ACCUMULATION = 8
PAD_MULTIPLE = 8
PREVIEW_CHARS = 800

# evaluation
EVAL_SAMPLES = 5
SAMPLE_SEED = 42
PATIENCE = 5
LOG_EVERY = 50
EVAL_EVERY = 300

# The characters that count as whitespace, as a plain set and as the
# inside of a Java character class
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Line starts that mark a diff, matched after "\n" or at the start only
DIFF_LINE_STARTS = {
    "git_header": r"(?md)^diff --git ",
    "hunk_header": r"(?md)^@@ ",
    "new_file": r"(?md)^\+\+\+ ",
    "old_file": r"(?md)^--- ",
    "index_line": r"(?md)^index ",
    "changed_line": r"(?md)^[+-]",
}
# The two file markers also match the changed-line pattern, so one alternation covers all six.
ANY_DIFF_LINE = r"(?md)^(?:diff --git |@@ |index |[+-])"

# Whole message is only a reference; message has a placeholder. The possessive
# quantifiers match the same texts and keep long lines linear.
REFERENCE_ONLY = (
    r"(?iu)\A(?:fixe[sd]?|close[sd]?|resolve[sd]?|refs?)[" + WS + r"]*#?[\p{L}\p{N}_]++[^\n]*+\z"
)
PLACEHOLDER = r"<HASH>|<URL>|#<I>"

# Added tokens, their ids and whether decoding drops them
SPECIAL_TOKENS = (
    ("<|endoftext|>", 151643, True),
    ("<|im_start|>", 151644, True),
    ("<|im_end|>", 151645, True),
    ("<|object_ref_start|>", 151646, True),
    ("<|object_ref_end|>", 151647, True),
    ("<|box_start|>", 151648, True),
    ("<|box_end|>", 151649, True),
    ("<|quad_start|>", 151650, True),
    ("<|quad_end|>", 151651, True),
    ("<|vision_start|>", 151652, True),
    ("<|vision_end|>", 151653, True),
    ("<|vision_pad|>", 151654, True),
    ("<|image_pad|>", 151655, True),
    ("<|video_pad|>", 151656, True),
    ("<tool_call>", 151657, False),
    ("</tool_call>", 151658, False),
    ("<|fim_prefix|>", 151659, False),
    ("<|fim_middle|>", 151660, False),
    ("<|fim_suffix|>", 151661, False),
    ("<|fim_pad|>", 151662, False),
    ("<|repo_name|>", 151663, False),
    ("<|file_sep|>", 151664, False),
)

# Chat rendering
DEFAULT_SYSTEM = "You are a helpful assistant."
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
TOOLS_BEFORE = (
    "\n\n# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_AFTER = (
    "\n</tools>\n\nFor each function call, return a json object with function name and arguments within "
    '<tool_call></tool_call> XML tags:\n<tool_call>\n{"name": <function-name>, "arguments": <args-json-object>}\n'
    "</tool_call>"
)
CALL_START = '\n<tool_call>\n{"name": "'
CALL_BETWEEN = '", "arguments": '
CALL_END = "}\n</tool_call>"

# Own vocabulary layout: two reserved ids, then tokens by frequency
EOS_TOKEN = "<|endoftext|>"
EOS_ID = 0
UNKNOWN_TOKEN = "<|unknown|>"
UNKNOWN_ID = 1
RESERVED_IDS = 2
