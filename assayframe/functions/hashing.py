"""Record ids and content hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import snake_case


def record_id(cols: Sequence[Column], length: int = 16) -> Column:
    """First characters of the SHA-256 of the fields put together, missing ones as nothing."""
    return F.substring(F.sha2(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256), 1, length)


def json_text(col: Column) -> Column:
    """A JSON string of a text as a writer that escapes all but ASCII makes it; NULL gives null."""

    def escaped(c: Column) -> Column:
        code = F.ascii(c)
        unit = lambda x: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(x), 4, "0")))
        high = code - 0x10000
        pair = F.concat(unit(F.shiftright(high, 10) + 0xD800), unit(high.bitwiseAND(F.lit(0x3FF)) + 0xDC00))
        named = F.when(c == "\n", "\\n").when(c == "\r", "\\r").when(c == "\t", "\\t").when(c == "\b", "\\b").when(c == "\f", "\\f").when(c.isin('"', "\\"), F.concat(F.lit("\\"), c))
        return named.when(code > 0xFFFF, pair).when((code > 126) | (code < 32), unit(code)).otherwise(c)

    body = F.array_join(F.transform(F.filter(F.split(col, ""), lambda c: c != ""), escaped), "")
    return F.when(col.isNull(), "null").otherwise(F.concat(F.lit('"'), body, F.lit('"')))


def fields_hash(fields: dict[str, Column], numbers: Sequence[str] = ()) -> Column:
    """SHA-256 of a JSON object of the fields by sorted name, ``", "`` and ``": "`` between; missing is null.

    Fields named in ``numbers`` are written without quotes.
    """
    value = lambda name: F.coalesce(fields[name].cast("string"), F.lit("null")) if name in numbers else json_text(fields[name].cast("string"))
    parts = [F.concat(F.lit(f'"{name}": '), value(name)) for name in sorted(fields)]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")), 256)


def sample_hash(product_name: Column, producer: Column, batch_number: Column, total_thc: Column, date_tested: Column) -> Column:
    """Hash of the fields that identify a record; the date as text, the total as a number."""
    fields = {"product_name": product_name, "producer": producer, "batch_number": batch_number, "total_thc": total_thc, "date_tested": date_tested}
    return fields_hash(fields, ["total_thc"])


def url_hash(col: Column) -> Column:
    return F.md5(col)


def label_hash(col: Column) -> Column:
    """SHA-256 of the lower-cased, trimmed text."""
    return F.sha2(F.lower(F.trim(col)), 256)


def joined_id(cols: Sequence[Column]) -> Column:
    """Fields that are there, joined by ``-``."""
    return F.concat_ws("-", *[c.cast("string") for c in cols])


def sample_id(private_key: str, public: Column, salt: Column | None = None) -> Column:
    """HMAC-SHA256 under a constant key of the snake-cased public key and salt."""
    key = private_key.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    pads = [F.unhex(F.lit(bytes(b ^ x for b in key).hex())) for x in (0x36, 0x5C)]
    message = F.concat(snake_case(public), snake_case(salt) if salt is not None else F.lit("")).cast("binary")
    inner = F.unhex(F.sha2(F.concat(pads[0], message), 256))
    return F.sha2(F.concat(pads[1], inner), 256)
