"""Row hashes, and fingerprints that can be merged in any order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Separator of a row text, and what stands for NULL in a raw extract.
SEPARATOR, NULL_SENTINEL, NULL_WORD = "|", "", "NULL"


def row_concat(values: list[Column], sep: str = SEPARATOR, sentinel: str = NULL_SENTINEL) -> Column:
    """Values joined by the separator; NULLs keep their place as the sentinel."""
    return F.concat_ws(sep, *[F.coalesce(v, F.lit(sentinel)) for v in values])


def row_sha256(values: list[Column], sep: str = SEPARATOR) -> Column:
    """Upper-case hex SHA-256 of the row text; NULL when there is nothing to hash."""
    if not values:
        return F.lit(None).cast("string")
    return F.upper(F.sha2(row_concat(values, sep), 256))


def extract_text(c: Column) -> Column:
    """A column as plain text with a word for NULL."""
    return F.coalesce(c.cast("string"), F.lit(NULL_WORD))


def row_md5(values: list[Column]) -> Column:
    """Lower-case hex MD5 of the plain row text."""
    return F.md5(F.concat_ws(SEPARATOR, *[extract_text(v) for v in values]))


LIMB_BITS = 20


def fingerprint_limbs(digest: Column) -> list[Column]:
    """120 bits of an MD5 as six 20-bit numbers.

    Sums of 20-bit numbers stay inside BIGINT for 2**43 rows, so the aggregate keeps a
    fixed-width, map-side combinable buffer.
    """
    mask = (1 << LIMB_BITS) - 1
    limbs = []
    for start in (1, 16):
        word = F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")
        limbs += [
            F.shiftright(word, 2 * LIMB_BITS),
            F.shiftright(word, LIMB_BITS).bitwiseAND(F.lit(mask)),
            word.bitwiseAND(F.lit(mask)),
        ]
    return limbs


def fingerprint_sums(digest: Column) -> list[Column]:
    return [F.sum(limb).alias(f"limb_{i}") for i, limb in enumerate(fingerprint_limbs(digest))]


def fingerprint_of_sums() -> Column:
    """Digest of the summed limbs and the row count ``n``."""
    parts = [F.col(f"limb_{i}").cast("string") for i in range(6)] + [F.col("n").cast("string")]
    return F.md5(F.concat_ws("-", *parts))
