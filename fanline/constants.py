"""Fixed values the results depend on.

These are semantics, not tuning: they must equal the behaviour being
reproduced (defaults of a subscription, queue retry windows, TTLs, status
names and response messages).
"""

from __future__ import annotations

# --- fixed values: subscription defaults ---------------------------------
DEFAULT_ELEMENTS = 60
DEFAULT_PER_MS = 3_000
DEFAULT_MAX_CONNECTIONS = 4
DEFAULT_MIN_BACKOFF_MS = 100
DEFAULT_MAX_BACKOFF_MS = 600_000
DEFAULT_MAX_RETRIES = 150
DEFAULT_HTTP_METHOD = "POST"
ALLOWED_HTTP_METHODS = ("POST", "PUT")
BACKOFF_BASE = 2.0
BACKOFF_JITTER = 0.2

# --- fixed values: queue / ledger / cluster --------------------------------
IN_PROGRESS_RETRY_AFTER_MS = 24 * 3_600_000
FAILED_RETRY_AFTER_MS = 3_600_000
NUMBER_OF_RETRIES = 3  # strict ">" test before incrementing: 5 dispatches
LEDGER_TTL_SECONDS = 86_400
DEAD_WORK_TTL_SECONDS = 86_400
INSTANCE_TIMEOUT_MS = 30_000
HEARTBEAT_INTERVAL_MS = 3_000
POLLING_INTERVAL_MS = 10

# --- fixed values: names and patterns ---------------------------------------
NAME_PATTERN = r"[0-9a-z-]+"
QUEUE_SUFFIX = "_queue"
AUDIT_SOURCE = "fanline-publisher"
AUDIT_TYPE = "TxFailed"
CLOSED_CONNECTION_TEXT = "The http server closed the connection unexpectedly"
REQUEST_TIMEOUT_CLASS = "RequestTimeoutException"
EXCEPTIONAL = "exceptional"
CONTENT_TYPE = "application/json"

# --- fixed values: work item states ------------------------------------------
TODO = "todo"
IN_PROGRESS = "in-progress"
FAILED = "failed"
PERMANENTLY_FAILED = "permanently-failed"
SUCCEEDED = "succeeded"

# --- fixed values: send outcomes ----------------------------------------------
SENT = "Sent"
FAILED_OUTCOME = "Failed"
REMOVED = "Removed"

# --- fixed values: publish statuses, HTTP codes and messages ------------------
ST_PUBLISHED = "published"
ST_DUPLICATE = "duplicate"
ST_NO_TOPIC = "no-topic"
ST_NO_SUBSCRIBERS = "no-subscribers"
ST_INVALID = "invalid"
MSG_DUPLICATE = "Duplicate Event: Event with eventId already exists"
MSG_NO_TOPIC = "No such topic"
MSG_NO_SUBSCRIBERS = "No subscribers for topic"
CODE_CREATED = 201
CODE_NOT_FOUND = 404
CODE_BAD_REQUEST = 400
CODE_SERVER_ERROR = 500
