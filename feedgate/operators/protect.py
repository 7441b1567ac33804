"""Encryption of sensitive columns with AES-256-GCM.

Stored text is base64(12-byte nonce, ciphertext, 16-byte tag).  The nonce is random, so the
text differs every time it is computed: protect once, right before the write, and read back
what was written.

The key reaches the tasks through a scalar subquery.  A literal would appear in query plans
and event logs; the subquery shows up there by number only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedgate.contract import TableContract

KEY_BYTES = 32
_MODE = "GCM"


def key_column(spark: SparkSession, key: str | bytes) -> Column:
    """The key as a column expression that does not show its value."""
    raw = key.encode("utf-8") if isinstance(key, str) else bytes(key)
    if len(raw) != KEY_BYTES:
        raise ValueError(f"the encryption key must be exactly {KEY_BYTES} bytes, got {len(raw)}")
    return spark.createDataFrame([(bytearray(raw),)], "k binary").scalar()


def encrypted(value: Column, key: Column) -> Column:
    """Cipher text of a text column; NULL stays NULL."""
    text = F.base64(F.aes_encrypt(value, key, F.lit(_MODE)))
    # Also right where the session still breaks base64 lines.
    return F.translate(text, "\r\n", "")


def decrypted(value: Column, key: Column, strict: bool = True) -> Column:
    """Plain text of a cipher text column.

    ``strict`` fails on bad base64, short values and a wrong key; otherwise they give NULL.
    """
    if strict:
        return F.aes_decrypt(F.unbase64(value), key, F.lit(_MODE)).cast("string")
    return F.try_aes_decrypt(F.try_to_binary(value, F.lit("base64")), key, F.lit(_MODE)).cast(
        "string"
    )


def json_key_replaced(document: Column, name: str, change) -> Column:
    """A JSON object's text with one key's value replaced by ``change(text of the value)``.

    A missing or null key, or a document that is not an object, leaves the text unchanged.
    """
    sent = F.try_variant_get(F.try_parse_json(document), f"$.{name}", "string")
    others = F.map_filter(
        F.from_json(document, "map<string,variant>"), lambda k, _: k != F.lit(name)
    )
    # The new value joins outside the lambda: the key subquery is not allowed inside one.
    replaced = F.map_concat(others, F.create_map(F.lit(name), change(sent).cast("variant")))
    return F.when(sent.isNotNull(), F.to_json(replaced)).otherwise(document)


def protected(rows: DataFrame, contract: TableContract, key: Column) -> DataFrame:
    """Replace protected columns by their cipher text; the plain text is gone afterwards."""
    return rows.withColumns(
        {f.name: _protect(f, key) for f in contract.protected}
    )


def _protect(field, key: Column) -> Column:
    if field.protect:
        return encrypted(F.col(field.name), key)
    return json_key_replaced(F.col(field.name), field.protect_key, lambda v: encrypted(v, key))


def unprotected(
    rows: DataFrame, contract: TableContract, key: Column, strict: bool = True
) -> DataFrame:
    """Decrypt protected columns.  Blank cipher text gives NULL."""
    return rows.withColumns({f.name: _unprotect(f, key, strict) for f in contract.protected})


def _unprotect(field, key: Column, strict: bool) -> Column:
    value = F.col(field.name)
    if field.protect:
        return F.when(~value.rlike(r"^\s*$"), decrypted(value, key, strict))

    def change(text: Column) -> Column:
        return F.when(text.rlike(r"^\s*$"), text).otherwise(decrypted(text, key, strict))

    return F.when(
        ~value.rlike(r"^\s*$"), json_key_replaced(value, field.protect_key, change)
    )
