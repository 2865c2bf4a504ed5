"""Fingerprints, keyed hashes and reproducible draws."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(type_: Column, file: Column, line: Column, message: Column | None = None) -> Column:
    """sha1 over type|file|line. ``message`` is left out unless given."""
    parts = [type_, file, line.cast("string")] + ([] if message is None else [message])
    return F.sha1(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]))


def hmac_sha256(col: Column, key: str) -> Column:
    """HMAC-SHA256 as lower-case hex; null for a null or empty value."""
    block = key.encode()
    if len(block) > 64:
        block = hashlib.sha256(block).digest()
    block = block.ljust(64, b"\0")
    inner_pad = F.unhex(F.lit(bytes(b ^ 0x36 for b in block).hex()))
    outer_pad = F.unhex(F.lit(bytes(b ^ 0x5C for b in block).hex()))
    inner = F.unhex(F.sha2(F.concat(inner_pad, F.encode(col, "UTF-8")), 256))
    return F.when(col != "", F.sha2(F.concat(outer_pad, inner), 256))


DRAW_RANGE = 1_000_000


def portable_draw(key: Column, seed: str) -> Column:
    """An integer in [0, 1e6) from sha1(key:seed), the same on every engine."""
    digest = F.sha1(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % DRAW_RANGE


def fast_draw(key: Column, seed: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(DRAW_RANGE))
