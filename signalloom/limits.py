"""Limits, defaults and vocabularies that decide results.

Fixed values: they have to be exactly these for results to agree with the
producers and consumers of the data, so they are listed plainly here and are
imported everywhere else.
"""

# Redaction.
MAX_NESTING = 5
MAX_ARRAY_ITEMS = 100
MAX_STRING_CHARS = 8192

# Validation.
MAX_MESSAGE_BYTES = 2048
MAX_METADATA_BYTES = 8192
MAX_TAGS = 20
MAX_TAG_CHARS = 64
MAX_BODY_BYTES = {"fetch": 256 * 1024, "beacon": 64 * 1024}
MAX_ERROR_TEXT_CHARS = 10_000

# Queue, batches, delivery.
QUEUE_CAPACITY = 1000
SPOOL_ITEM_CHARS = 8 * 1024
SPOOL_TOTAL_CHARS = 1024 * 1024
SPOOL_TTL_HOURS = 2
CLIENT_BATCH = 10
REQUEST_BATCH = 100
MAX_RETRIES = 3
RETRY_BASE_MS = 1000
RETRY_MAX_MS = 30_000
FLUSH_INTERVAL = "5 seconds"
FLUSH_MS = 5000
POLL_MS = 45_000
POLL_BACKOFF_MAX_MS = 300_000

# Vocabularies.
LOG_LEVELS = ("DEBUG", "INFO", "WARN", "ERROR", "FATAL")  # in rising priority
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
CONSOLE_LEVELS = {"error": "ERROR", "warn": "WARN", "log": "INFO", "debug": "DEBUG"}
DEFAULT_SOURCE = "app"

# Signatures.
REPLAY_WINDOW_SECONDS = 300

# Snapshots and their schedule.
MIN_RETRY_MINUTES = 30
WINDOW_MINUTES = 60
IV_BYTES = 12
TAG_BYTES = 16
ARTIFACT_MAGIC = b"SGLOOM01"  # our own format marker
HEADER_BYTES = len(ARTIFACT_MAGIC) + IV_BYTES
