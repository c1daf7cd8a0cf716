"""Error classification and retry decisions over attempt tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import col_

# ---- fixed values (must equal the reference's behaviour) -------------------
MAX_ATTEMPTS = 3
BASE_DELAY_SECONDS = 1
TRANSIENT_TIMEOUT, TRANSIENT_NETWORK = "transient_timeout", "transient_network"
TRANSIENT_HTTP, PERMANENT_HTTP = "transient_http", "permanent_http"
TRANSIENT_SERVICE, UNKNOWN = "transient_service", "unknown"
# -----------------------------------------------------------------------------


def classify_error(error_type, error_message) -> Column:
    """First matching rule wins (name / message, case-insensitive)."""
    name = F.lower(F.coalesce(col_(error_type), F.lit("")))
    msg = F.lower(F.coalesce(col_(error_message), F.lit("")))
    return (F.when(name.contains("timeout") | msg.contains("timeout"), F.lit(TRANSIENT_TIMEOUT))
            .when(name.contains("connect"), F.lit(TRANSIENT_NETWORK))
            .when(name.contains("statuserror") & (msg.contains("429") | msg.contains(" 5")), F.lit(TRANSIENT_HTTP))
            .when(name.contains("statuserror"), F.lit(PERMANENT_HTTP))
            .when(name.contains("serviceunavailable"), F.lit(TRANSIENT_SERVICE))
            .otherwise(F.lit(UNKNOWN)))


def retry_decision(kind, attempt, max_attempts: int = MAX_ATTEMPTS,
                   base_delay: int = BASE_DELAY_SECONDS) -> tuple[Column, Column]:
    """(retry?, delay seconds) after a failed attempt (1-based)."""
    a = col_(attempt)
    retry = (a < max_attempts) & col_(kind).startswith("transient")
    delay = F.when(retry, (F.lit(base_delay) * F.pow(F.lit(2), a - 1)).cast("bigint"))
    return retry, delay
