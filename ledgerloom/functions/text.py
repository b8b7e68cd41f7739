"""Business key, address and other text rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The form of a customer id.
CUSTOMER_ID_PREFIX = "CUST-"
CUSTOMER_ID_HEX_DIGITS = 16
PHONE_LENGTH = 20

# Every white-space character. trim() alone would remove blanks only.
WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def business_key(name: Column, email: Column) -> Column:
    """Customer id that depends on name and e-mail only, so that it is the same in every load."""
    identity = F.concat(F.lower(strip(name)), F.lit("|"), F.lower(strip(email)))
    digest = F.substring(F.md5(identity), 1, CUSTOMER_ID_HEX_DIGITS)
    return F.concat(F.lit(CUSTOMER_ID_PREFIX), F.upper(digest))


def has_customer_id_form(customer_id: Column) -> Column:
    return customer_id.startswith(CUSTOMER_ID_PREFIX)


def joined_address(*parts: Column) -> Column:
    """Parts joined with commas, unknown parts left out."""
    return F.concat_ws(", ", *parts)


def one_line(address: Column) -> Column:
    return F.regexp_replace(address, "\n", ", ")


def short_phone(phone: Column) -> Column:
    return F.substring(phone, 1, PHONE_LENGTH)
