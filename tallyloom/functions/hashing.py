"""Content hashes of binary columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_BYTES = 4 * 1024 * 1024


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def block_hash(content: Column, block_bytes: int = BLOCK_BYTES) -> Column:
    """SHA-256 over the joined SHA-256 digests of fixed-size blocks; an empty value has no blocks."""
    size = F.octet_length(content)
    blocks = F.ceil(size / F.lit(block_bytes)).cast("int")
    digests = F.transform(
        F.sequence(F.lit(1), F.greatest(blocks, F.lit(1))),
        lambda i: F.sha2(F.substring(content, (i - 1) * block_bytes + 1, F.lit(block_bytes)), 256),
    )
    joined = F.when(size == 0, F.lit("")).otherwise(F.array_join(digests, ""))
    return F.sha2(F.unhex(joined), 256)
