"""Run configuration and the small dimension tables.

Everything here is either a frozen dataclass that lives on the driver (and is
folded into the plan as literals) or a handful of rows that become tiny
DataFrames broadcast into joins.  None of these tables grows with the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES -- these must equal the original tool's constants for the
# results to agree.  They are stated here once, in their natural order.
# ---------------------------------------------------------------------------

CHARS_PER_TOKEN = 4

STRATEGIES = ("none", "truncate", "extractive", "abstractive", "hierarchical")

# filename rules, tested as substrings of the lowered name, in this order
CODE_NAME_MARKERS = (".py", ".js", ".ts", ".java", ".cpp", ".go")
DOCUMENT_NAME_MARKERS = (".md", ".txt", ".doc", ".pdf")
TRANSCRIPT_NAME_MARKERS = ("transcript", "otter")

# content signals, checked on the first 2000 lowered characters
SIGNAL_WINDOW_CHARS = 2000
# patterns in Python's regular expression dialect, searched in the lowered window
TRANSCRIPT_PATTERNS = (r"\d{1,2}:\d{2}", r"speaker \d", r"\[.*?\]:", r"um+|uh+|like,", r"yeah|okay|right\?")
TRANSCRIPT_SIGNAL_MIN = 3
EMAIL_SIGNALS = ("from:", "to:", "subject:", "sent:", "cc:", "bcc:")
EMAIL_SIGNAL_MIN = 2
WEB_SIGNALS = ("<html", "<div", "<script", "http://", "https://", "cookie", "privacy policy")
WEB_SIGNAL_MIN = 2
CODE_SIGNALS = ("def ", "function ", "class ", "import ", "const ", "let ", "var ")
CODE_SIGNAL_MIN = 3
CHAT_PATTERNS = (r"^\w+:", r"^\[\d{1,2}:\d{2}\]", r"lol", r"brb", r"omg")
CHAT_SIGNAL_MIN = 2

# sentence-scoring keywords per content type (substring tests on lowered text)
TRANSCRIPT_BOOST_WORDS = ("decide", "agreed", "will do", "action", "next step")
TRANSCRIPT_FILLER_WORDS = ("um", "uh", "like,", "you know")
DOCUMENT_BOOST_WORDS = ("important", "key", "critical", "must", "should")
EMAIL_BOOST_WORDS = ("please", "request", "deadline", "by", "asap")
EMAIL_DAMP_WORDS = ("fyi", "regards", "thanks")

TRUNCATION_MARKER = "\n\n[... content truncated ...]"
EXTRACT_JOINER = " [...] "
PROMPT_CONTENT_CHARS = 12000
SUMMARY_MAX_TOKENS = 2000
SUMMARY_TOKEN_HEADROOM = 100
SUMMARY_SYSTEM_PROMPT = "You are a precise summarizer. Be concise but preserve key information."
HIERARCHY_RECOMPRESS_FACTOR = 1.2

# summarisation request text
PROMPT_TEMPLATE = (
    "Summarize the following {content_type} in approximately {target_tokens} tokens.\n"
    "\n"
    "Instructions: {instruction}\n"
    "\n"
    "Content:\n"
    "{content}\n"
    "\n"
    "Summary:"
)

# per-type summarisation instructions
TYPE_INSTRUCTIONS = (
    ("transcript", "Extract key decisions, action items, and main discussion points. Preserve speaker attributions for important statements."),
    ("document", "Summarize the main points, preserving structure and key details."),
    ("web_page", "Extract the main content, ignoring navigation, ads, and boilerplate."),
    ("email", "Summarize the request/information and any action items or deadlines."),
    ("code", "Describe what the code does, key functions, and any important patterns."),
    ("chat", "Summarize the conversation, key decisions, and any action items."),
    ("unknown", "Provide a concise summary of the main content."),
)

# model price list: (model key, input $ per 1K tokens, output $ per 1K tokens).
# Order matters: partial-name matches take the first key in this order.
MODEL_PRICES = (
    ("gpt-4o", 0.0025, 0.01),
    ("gpt-4o-mini", 0.00015, 0.0006),
    ("gpt-4-turbo", 0.01, 0.03),
    ("gpt-3.5-turbo", 0.0005, 0.0015),
    ("claude-3-opus", 0.015, 0.075),
    ("claude-3-sonnet", 0.003, 0.015),
    ("claude-3-haiku", 0.00025, 0.00125),
    ("gemini-pro", 0.00025, 0.0005),
    ("mistral-large", 0.004, 0.012),
    ("mistral-small", 0.001, 0.003),
)
DEFAULT_PRICE_MODEL = "gpt-4o-mini"
DEFAULT_MODEL = "gpt-4o-mini"
DEFAULT_DOC_TYPE = "document"

ACCEPT_ACCURACY = 0.90

# thresholds, budgets and the price of the default configuration
NO_COMPRESS_THRESHOLD = 500
TRUNCATE_THRESHOLD = 2000
EXTRACTIVE_THRESHOLD = 8000
TARGET_RATIO = 0.3
MAX_OUTPUT_TOKENS = 2000
INPUT_COST_PER_1K = 0.00015
SUMMARIZATION_MODEL = "gpt-4o-mini"
CHUNK_SIZE = 3000

STAGE_NAMES = ("Intake", "Parse", "Normalize", "Optimize", "Cost Analysis", "Benchmark")
RUN_HASH_HEX = 6
RUN_TS_FORMAT = "yyyyMMdd_HHmm"
PREVIEW_CHARS = 500

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class OptimizerConfig:
    """Thresholds and budgets.  Values are folded into plans as literals."""

    no_compress_threshold: int = NO_COMPRESS_THRESHOLD
    truncate_threshold: int = TRUNCATE_THRESHOLD
    extractive_threshold: int = EXTRACTIVE_THRESHOLD
    target_ratio: float = TARGET_RATIO
    max_output_tokens: int = MAX_OUTPUT_TOKENS
    input_cost_per_1k: float = INPUT_COST_PER_1K
    summarization_model: str = SUMMARIZATION_MODEL
    chunk_size: int = CHUNK_SIZE
    # characters of the text that a prompt carries; None: all of it
    prompt_content_chars: int | None = PROMPT_CONTENT_CHARS

    def with_(self, **kw) -> "OptimizerConfig":
        return replace(self, **kw)


DEFAULT_CONFIG = OptimizerConfig()

PRICE_SCHEMA = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("model_key", T.StringType(), False),
        T.StructField("input_per_1k", T.DoubleType(), False),
        T.StructField("output_per_1k", T.DoubleType(), False),
    ]
)


def price_table(spark: SparkSession, prices=MODEL_PRICES) -> DataFrame:
    """Ten-row price dimension; `ordinal` keeps the partial-match order."""
    rows = [(i, k, float(a), float(b)) for i, (k, a, b) in enumerate(prices)]
    return spark.createDataFrame(rows, PRICE_SCHEMA)
