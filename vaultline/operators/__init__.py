"""DataFrame operators: dedupe, incremental logic, quality checks, schema tracking."""

from vaultline.operators.dedupe import keep_latest
from vaultline.operators.incremental import (
    has_new,
    new_or_newer,
    preserve_created,
    since_watermark,
    upsert,
    watermark_value,
)

__all__ = [
    "has_new",
    "keep_latest",
    "new_or_newer",
    "preserve_created",
    "since_watermark",
    "upsert",
    "watermark_value",
]
