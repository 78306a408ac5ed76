"""Stable result-row ids."""

from pyspark.sql import Column, functions as F

from netbaseline.functions.text import _c

ID_PREFIX = "msf_"
ID_HEX_CHARS = 22


def result_id(*key_cols) -> Column:
    """``msf_`` + 22 hex characters of SHA-256 over the key: same key, same id.

    Stable under replay of a micro-batch, unlike a time-based unique id.  The
    key is encoded as a JSON array of texts, so that no separator inside a
    value can make two keys alike.  Blank parts are expected as one form
    (:func:`netbaseline.functions.text.blank_to_empty`).
    """
    parts = [F.coalesce(_c(k).cast("string"), F.lit("")) for k in key_cols]
    return F.concat(F.lit(ID_PREFIX), F.substring(F.sha2(F.to_json(F.array(*parts)), 256), 1, ID_HEX_CHARS))
