"""Masks and pseudonyms as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# What a masked value looks like.
NO_EMAIL = "anonymized@example.invalid"
NO_PHONE = "+XX-XXXXX-XXXXX"
SHORT_PHONE = "+XX-XXXX-XXXX"
NO_IP = "0.0.0.0"
ODD_IP = "x.x.x.x"


def mask_email(email: Column, missing: str = NO_EMAIL) -> Column:
    """First and last letter of the name; only the first when it is short."""
    at = F.instr(email, "@")
    name = F.substring_index(email, "@", 1)
    tail = F.when(F.length(name) > 2, F.right(name, F.lit(1))).otherwise(F.lit(""))
    masked = F.concat(F.left(name, F.lit(1)), F.lit("***"), tail, email.substr(at, F.length(email)))
    return F.when(at > 1, masked).otherwise(F.lit(missing))


def mask_phone(phone: Column, country_code: str = "91") -> Column:
    """Last four digits of a full number."""
    digits = F.regexp_replace(phone, r"\D", "")
    full = F.concat(F.lit(f"+{country_code}-XXXXX-"), F.right(digits, F.lit(4)))
    return (
        F.when(F.coalesce(phone, F.lit("")) == "", F.lit(NO_PHONE))
        .when(F.length(digits) >= 10, full)
        .otherwise(F.lit(SHORT_PHONE))
    )


def mask_ip(ip: Column) -> Column:
    """First two parts of a dotted address."""
    parts = F.split(ip, r"\.")
    kept = F.concat_ws(".", F.get(parts, 0), F.get(parts, 1), F.lit("x"), F.lit("x"))
    return (
        F.when(F.coalesce(ip, F.lit("")) == "", F.lit(NO_IP))
        .when(F.size(parts) == 4, kept)
        .otherwise(F.lit(ODD_IP))
    )


def _xor_pad(key: bytes, pad: int) -> bytes:
    return bytes(b ^ pad for b in key.ljust(64, b"\0"))


def secret(key: str) -> DataFrame:
    """A key as a one-row table of what the hashes need; its values stand in no plan, only the table does."""
    raw = key.encode()
    if not raw:
        raise ValueError("a key is needed")
    if len(raw) > 64:
        raise ValueError("key must be at most 64 bytes")
    return SparkSession.active().createDataFrame([(bytearray(raw), bytearray(_xor_pad(raw, 0x36)), bytearray(_xor_pad(raw, 0x5C)))], "salt binary, inner binary, outer binary")


def pseudonymize(col: Column, method: str = "hmac", key: str | DataFrame | None = None) -> Column:
    """``hmac`` (keyed SHA-256), ``sha256`` (salted) or ``raw``. The first two need a key, as text or as :func:`secret` makes it.

    The key is read by a scalar subquery, so neither plans nor event logs hold it.
    """
    text = col.cast("string")
    if method == "raw":
        return text
    if method not in ("sha256", "hmac"):
        raise ValueError(f"unknown method {method!r}")
    known = secret(key or "") if key is None or isinstance(key, str) else key
    part = lambda name: known.select(name).scalar()
    bytes_ = F.encode(text, "utf-8")
    if method == "sha256":
        return F.sha2(F.concat(part("salt"), bytes_), 256)
    return F.sha2(F.concat(part("outer"), F.unhex(F.sha2(F.concat(part("inner"), bytes_), 256))), 256)


# Free text. Runs of name characters are taken whole (possessively) and only
# from their first character or where the last match ended, so the work stays
# linear even in texts with very long unbroken runs.
_NAME = "[A-Za-z0-9._%+-]"
_DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
_FROM_START = rf"(?:(?<!{_NAME})|\G)"
EMAIL_PATTERN = rf"{_FROM_START}{_NAME}++@{_DOMAIN}"
IP_PATTERN = r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"
PHONE_PATTERN = r"\+[0-9]{1,3}[ -]?\(?[0-9]{3,5}\)?[ -]?[0-9]{3}[ -]?[0-9]{2,4}"

_LONG_NAME = rf"{_FROM_START}({_NAME}){_NAME}{{2,}}+(?<=({_NAME}))@({_DOMAIN})"
_SHORT_NAME = rf"(^|[^A-Za-z0-9._%+*-])({_NAME}){_NAME}?@({_DOMAIN})"
_IP_PARTS = r"\b([0-9]{1,3})\.([0-9]{1,3})\.[0-9]{1,3}\.[0-9]{1,3}\b"
_PHONE_PARTS = r"\+[0-9]{1,3}[ -]?\(?[0-9]{3,5}\)?[ -]?[0-9]{3}[ -]?([0-9]{2,4})"


def mask_free_text(text: Column, country_code: str = "91") -> Column:
    """Mask every e-mail, address and phone number inside a text.

    A plain character test lets most texts skip the costlier patterns.
    """
    mails = F.regexp_replace(F.regexp_replace(text, _LONG_NAME, "$1***$2@$3"), _SHORT_NAME, "$1$2***@$3")
    out = F.when(text.contains("@"), mails).otherwise(text)
    out = F.regexp_replace(out, _IP_PARTS, "$1.$2.x.x")
    phones = F.regexp_replace(out, _PHONE_PARTS, f"+{country_code}-XXXXX-$1")
    return F.when(text.contains("+"), phones).otherwise(out)


def count_finds(text: Column) -> dict[str, Column]:
    """Number of personal-data finds of each kind in a text."""
    hits = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return {
        "email": F.when(text.contains("@"), hits(EMAIL_PATTERN)).otherwise(F.lit(0)),
        "ip": hits(IP_PATTERN),
        "phone": F.when(text.contains("+"), hits(PHONE_PATTERN)).otherwise(F.lit(0)),
    }
