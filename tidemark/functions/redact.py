"""Credential redaction and error classes over text columns.

Both are chains of built-in regex / substring expressions applied to a whole
text column, so they run inside the JVM over every row of every partition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (pattern, replacement) pairs applied in this order,
# case-insensitive, with '.' matching newlines.
SENSITIVE_PATTERNS = [
    (r"postgresql://[^:]+:([^@]+)@", "postgresql://***:***@"),
    (r"mysql://[^:]+:([^@]+)@", "mysql://***:***@"),
    (r"mongodb://[^:]+:([^@]+)@", "mongodb://***:***@"),
    (r"password['\"]?\s*[:=]\s*['\"]?([^'\";\s,}]+)", "password=***"),
    (r"pwd['\"]?\s*[:=]\s*['\"]?([^'\";\s,}]+)", "pwd=***"),
    (r"passwd['\"]?\s*[:=]\s*['\"]?([^'\";\s,}]+)", "passwd=***"),
    (r"api[_-]?key['\"]?\s*[:=]\s*['\"]?([^'\";\s,}]+)", "api_key=***"),
    (r"token['\"]?\s*[:=]\s*['\"]?([^'\";\s,}]+)", "token=***"),
    (r"secret['\"]?\s*[:=]\s*['\"]?([^'\";\s,}]+)", "secret=***"),
    (r"-----BEGIN (RSA |)PRIVATE KEY-----.*?-----END (RSA |)PRIVATE KEY-----", "-----BEGIN PRIVATE KEY----- [REDACTED] -----END PRIVATE KEY-----"),
    (r"Authorization:\s*Bearer\s+([^\s]+)", "Authorization: Bearer ***"),
    (r"Authorization:\s*Basic\s+([^\s]+)", "Authorization: Basic ***"),
]

# Message fragment -> friendly text, first match wins
# (matched against the lower-cased message).
ERROR_MAPPINGS = [
    ("connection refused", "Database Connection Refused"),
    ("connection timed out", "Database Connection Timeout"),
    ("connection reset", "Database Connection Reset"),
    ("connection closed", "Database Connection Closed"),
    ("could not connect", "Unable to Connect to Database"),
    ("no route to host", "Database Server Unreachable"),
    ("host is unreachable", "Database Server Unreachable"),
    ("network is unreachable", "Network Connection Failed"),
    ("authentication failed", "Database Authentication Failed"),
    ("access denied", "Database Access Denied"),
    ("permission denied", "Database Permission Denied"),
    ("invalid username", "Database Authentication Failed"),
    ("invalid password", "Database Authentication Failed"),
    ("incorrect password", "Database Authentication Failed"),
    ("login failed", "Database Login Failed"),
    ("ssl error", "SSL Connection Error"),
    ("certificate", "SSL Certificate Error"),
    ("tls", "TLS Connection Error"),
    ("snowflake error", "Snowflake Connection Error"),
    ("jwt token", "Snowflake Authentication Error"),
    ("account not found", "Snowflake Account Error"),
    ("psycopg2", "PostgreSQL Connection Error"),
    ("duckdb", "Database Query Error"),
    ("relation does not exist", "Table Not Found"),
    ("table does not exist", "Table Not Found"),
    ("column does not exist", "Column Not Found"),
    ("schema does not exist", "Schema Not Found"),
    ("timeout", "Operation Timeout"),
    ("out of memory", "System Resource Error"),
    ("disk full", "Storage Error"),
]

# Storage-side categories, first match wins.
DB_CATEGORIES = [
    (("connection refused", "could not connect", "connection timed out"), "Unable to connect to destination database"),
    (("authentication failed", "access denied", "permission denied", "login failed"), "Database authentication failed"),
    (("connection closed", "connection reset", "broken pipe"), "Database connection was interrupted"),
    (("timeout", "timed out"), "Database operation timeout"),
    (("table does not exist", "relation does not exist"), "Target table not found in destination"),
    (("column does not exist",), "Column mismatch between source and destination"),
    (("ssl", "certificate", "tls"), "SSL/TLS connection error"),
]

MAX_MESSAGE_LENGTH = 500


# Every pattern above starts with one of these literals (lower case): a text
# containing none of them cannot change, so a cheap substring scan decides
# whether the regex chain runs at all.
ANCHOR_LITERALS = [
    "postgresql://", "mysql://", "mongodb://", "password", "pwd", "passwd",
    "api_key", "api-key", "apikey", "token", "secret", "-----begin", "authorization:",
]


def might_hold_credentials(text: Column) -> Column:
    low = F.lower(text)
    cond = None
    for lit in ANCHOR_LITERALS:
        c = low.contains(lit)
        cond = c if cond is None else cond | c
    return cond


def redact(text: Column) -> Column:
    """Every credential pattern replaced, in order, case-insensitively,
    over the whole text (texts without any pattern anchor skip the chain)."""
    out = text
    for pattern, replacement in SENSITIVE_PATTERNS:
        out = F.regexp_replace(out, "(?is)" + pattern, replacement.replace("$", "\\$"))
    return F.when(might_hold_credentials(text), out).otherwise(text)


def truncate_message(text: Column, limit: int | None = None) -> Column:
    """For display only: a text cut to ``limit`` characters (default: not cut).
    Classes and stored messages always come from whole texts."""
    if limit is None:
        return text
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)


def _mapped(low: Column) -> Column:
    """Friendly text of the first fragment (in list order) the lower-cased
    message contains, else NULL."""
    out = F.lit(None).cast("string")
    for fragment, friendly in reversed(ERROR_MAPPINGS):
        out = F.when(low.contains(fragment), F.lit(friendly)).otherwise(out)
    return out


def friendly_message(message: Column, context: Column | None = None) -> Column:
    """R2 (log map): first matching fragment's friendly text, else the whole
    redacted message; prefixed with ``context: `` if given."""
    m = F.trim(message)
    out = F.coalesce(_mapped(F.lower(m)), redact(m))
    out = F.when(m == "", F.lit("Unknown error occurred")).otherwise(out)
    if context is not None:
        out = F.concat(context, F.lit(": "), out)
    return out


def error_class(message: Column) -> Column:
    """R2 (storage map): category of an error for the database, first match
    wins; otherwise the friendly/redacted text, and credential-looking text
    becomes a configuration error."""
    m = F.trim(message)
    low = F.lower(m)
    mapped = _mapped(low)
    red = redact(m)
    # Friendly labels never mention credentials, so only the redacted text
    # needs the check.
    credential = mapped.isNull() & (F.lower(red).contains("password") | F.lower(red).contains("credential"))
    out = F.when(credential, F.lit("Database authentication configuration error")).otherwise(F.coalesce(mapped, red))
    for fragments, label in reversed(DB_CATEGORIES):
        cond = None
        for frag in fragments:
            c = low.contains(frag)
            cond = c if cond is None else cond | c
        out = F.when(cond, F.lit(label)).otherwise(out)
    return F.when(message.isNull() | (m == ""), F.lit("Unknown error occurred")).otherwise(out)
