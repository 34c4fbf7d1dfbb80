"""Deterministic variant assignment hash (HS1).

The key is the parity of the MD5 digest of the user id as text: the last hex
digit even gives 0 (control), odd gives 1 (treatment). It is a pure function
of the id, so it is stable across runs, partitionings and row orders, splits
about 50/50, and any SQL engine with ``md5`` computes the same assignment.
A NULL id gives a NULL key, and the variant then falls through to
'treatment' exactly as a CASE without an ELSE-branch match does.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CONTROL = "control"
TREATMENT = "treatment"


def variant_key(user_id: Column) -> Column:
    """0/1 bucket of ``user_id``; NULL for a NULL id."""
    last_hex = F.substring(F.md5(user_id.cast("string")), 32, 1)
    return F.pmod(F.conv(last_hex, 16, 10).cast("int"), F.lit(2))


def variant_of(key: Column) -> Column:
    return F.when(key == 0, F.lit(CONTROL)).otherwise(F.lit(TREATMENT))
