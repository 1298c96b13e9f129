"""Stable names: sequence ids and fingerprints of settings."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the namespace of URL names (RFC 4122).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The name-based UUID (version 5), from built-in functions."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), 1, 4)
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant.substr(nibble + 1, F.lit(1)), F.substring(h, 18, 3)), F.substring(h, 21, 12))


@F.pandas_udf(StringType())
def fixed9(x):
    """Nine decimals of the exact binary value, halves to even, which the built-in formatter rounds differently."""
    return x.map(lambda v: None if v is None or v != v else f"{v:.9f}")


def sequence_id(*parts: Column) -> Column:
    """The UUID of the parts joined by a bar; format times with fixed9 first."""
    return uuid5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def fingerprint(settings: dict) -> str:
    """The first 16 hex digits of sha256 over canonical JSON."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def file_sha256(path: str, block: int = 8 << 20) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(block):
            h.update(part)
    return h.hexdigest()
