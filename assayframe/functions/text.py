"""Text functions: names, labels, test descriptions, n-grams, links."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: separators and endings that a product name is cut at
STRAIN_CUTS = r" - | \| | _ | x |–|—|:|\(|\)|/"
STRAIN_ENDINGS = ("Buds", "Bulk", "Flower", "Pre-Roll")


def blank_to_null(col: Column) -> Column:
    return F.when(F.trim(col) != "", col)


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, NULL if there is none."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def snake_case(col: Column) -> Column:
    """Lower case; runs of other characters than letters and digits become one underscore."""
    return F.lower(F.trim(F.regexp_replace(F.trim(col), "[^A-Za-z0-9]+", "_"), F.lit("_")))


def snake_name(name: str) -> str:
    """snake_case of a column name, with breaks before the capitals of camel case."""
    parted = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    return re.sub(r"[^A-Za-z0-9]+", "_", parted).strip("_").lower()


def slug(col: Column) -> Column:
    return F.regexp_replace(F.lower(col), " ", "-")


def test_parts(col: Column) -> dict[str, Column]:
    """``name (units) type`` in three columns; all NULL if the text isn't of that form."""
    pattern = r"^(.+?) \((.+?)\) (.+)$"
    return {"test_name": extract(col, pattern, 1), "units": extract(col, pattern, 2), "product_type": extract(col, pattern, 3)}


def before_bracket(col: Column) -> Column:
    return F.trim(F.substring_index(col, "(", 1))


def longest_suffix(col: Column, suffixes: Sequence[str]) -> Column:
    """The longest of the suffixes that the text ends with, NULL if none."""
    return F.coalesce(*[F.when(F.endswith(col, F.lit(s)), F.lit(s)) for s in sorted(suffixes, key=lambda s: (-len(s), s))])


def bracket_type(col: Column, default: str = "R&D Testing") -> Column:
    """What follows the last bracket, behind the default's name where it holds that; the default if there is one part only, or nothing is left."""
    parts = F.filter(F.transform(F.split(col, r"[()]"), lambda p: F.trim(p)), lambda p: p != "")
    last = F.trim(F.substring_index(F.element_at(parts, -1), default, -1))
    return F.when(F.size(parts) <= 1, default).otherwise(F.coalesce(blank_to_null(last), F.lit(default)))


def bracket_units(col: Column) -> Column:
    """Text between the first pair of brackets, NULL if there is none."""
    return extract(col, r"\(([^()]*)\)", 1)


def strain_of_product(col: Column) -> Column:
    """Product name up to the first separator, then up to an ending such as "Flower", trimmed each time."""
    out = F.trim(F.split(col, STRAIN_CUTS)[0])
    for ending in STRAIN_ENDINGS:
        out = F.trim(F.substring_index(out, ending, 1))
    return out


def words(col: Column) -> Column:
    """Lower-case runs of letters and digits of any script, and underscores."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def ngrams_to(tokens: Column, most: int, stop: Sequence[str] = ()) -> Column:
    """n-grams of 1 to ``most`` words, without those that hold a stop word."""
    return F.concat(*[ngrams(tokens, n, stop) for n in range(1, most + 1)])


def joined_strains(names: Column) -> Column:
    """Strain names of a list as one text."""
    return F.array_join(names, " × ")


def identified(text: Column, labs: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """The first lab one of whose marks (name, link) the text holds; else the default."""
    found = [F.when(F.coalesce(*[F.when(F.contains(text, F.lit(m)), F.lit(True)) for m in marks], F.lit(False)), F.lit(name)) for name, marks in labs.items()]
    return F.coalesce(*found, F.lit(default).cast("string"))


def natural_key(name: Column) -> Column:
    """A sort key by which ``file2`` comes before ``file10``: runs of digits padded to 20."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]"), F.lpad(p, 20, "0")).otherwise(p)), "")


def ngrams(tokens: Column, n: int, stop: Sequence[str] = ()) -> Column:
    """n-grams of an array of words, without those that hold a stop word."""
    # the array is bound to a name, so that it is made once
    runs = F.transform(
        F.array(tokens),
        lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.slice(w, i, n))).otherwise(F.array().cast("array<array<string>>")),
    )[0]
    if stop:
        runs = F.filter(runs, lambda g: ~F.arrays_overlap(g, F.array(*[F.lit(s) for s in stop])))
    return F.transform(runs, lambda g: F.array_join(g, " "))


def label_name(product: Column, strain: Column) -> Column:
    """Product and strain as one label: the other one if one is empty, the product alone if it holds the strain."""
    p, s = F.trim(F.coalesce(product, F.lit(""))), F.trim(F.coalesce(strain, F.lit("")))
    return F.when(p == "", s).when((s == "") | F.contains(F.lower(p), F.lower(s)), p).otherwise(F.concat_ws(" ", p, s))


def title(product: Column, strain: Column, fallbacks: Sequence[Column]) -> Column:
    """``product (strain)``; the one that is there; else the first fallback."""
    p, s = blank_to_null(product), blank_to_null(strain)
    both = F.when(F.contains(p, s), p).otherwise(F.concat(p, F.lit(" ("), s, F.lit(")")))
    return F.coalesce(F.when(p.isNotNull() & s.isNotNull(), both), p, s, *[blank_to_null(c) for c in fallbacks])


def data_link(record: Column, kind: str, base: str = "") -> Column:
    return F.concat_ws("/", F.lit(base), F.lit(kind), record)


def between(col: Column, left: str, right: str) -> Column:
    """Text after the last ``left``, up to the next ``right``."""
    return F.substring_index(F.substring_index(col, left, -1), right, 1)


def tag_producer(tag: Column) -> Column:
    """Characters 13 to 15 of a package tag."""
    return F.substring(tag, 13, 3)


def license_code(col: Column) -> Column:
    """``WAL...`` or ``WA...`` of a compound id, up to the first dot."""
    return extract(col, r"(WAL?[^.]*)\.", 1)


def shortened(col: Column, most: int = 11) -> Column:
    return F.when(F.length(col) > most, F.concat(F.substring(col, 1, most), F.lit("..."))).otherwise(col)


def url_name(url: Column) -> Column:
    """Last path segment of a link, without the query."""
    return F.substring_index(F.substring_index(F.substring_index(url, "#", 1), "?", 1), "/", -1)


def unwrapped_url(url: Column) -> Column:
    """The link in a ``?q=`` parameter, else the link itself."""
    return F.coalesce(extract(url, r"[?&]q=(https?://[^&]*)", 1), url)


def address_parts(col: Column) -> dict[str, Column]:
    """``street, city ST zip`` in four columns."""
    tail = F.split(F.trim(F.substring_index(col, ",", -1)), r"\s+")
    return {
        "street": F.trim(F.substring_index(col, ",", 1)),
        "city": F.array_join(F.slice(tail, 1, F.greatest(F.size(tail) - 2, F.lit(0))), " "),
        "state": F.try_element_at(tail, F.lit(-2)),
        "zipcode": F.try_element_at(tail, F.lit(-1)),
    }


def status_word(col: Column) -> dict[str, Column]:
    """Value text without its PASS or FAIL, and that word; ``Not Detected`` becomes ``ND``."""
    value = F.trim(F.regexp_replace(F.regexp_replace(col, "(?i)not detected", "ND"), r"(?i)\b(pass|fail)\b", ""))
    return {"value": blank_to_null(value), "status": F.lower(extract(col, r"(?i)\b(pass|fail)\b", 1))}


def weight_grams(col: Column) -> Column:
    """Grams of ``(3.5g)``, ``3.5g``, ``1/8 oz`` and ``1oz``; NULL if there is no weight."""
    ounce = F.lit(28.35)
    fraction = r"([0-9]+)\s*/\s*([0-9]+)\s*(?:oz|g)"
    part = F.try_divide(extract(col, fraction, 1).try_cast("double"), extract(col, fraction, 2).try_cast("double")) * ounce
    grams = extract(col, r"([0-9]*\.?[0-9]+)\s*g\b", 1).try_cast("double")
    return F.coalesce(part, extract(col, r"([0-9]*\.?[0-9]+)\s*oz", 1).try_cast("double") * ounce, grams)


def money(col: Column) -> Column:
    """Number of a price or percentage text."""
    return F.regexp_replace(col, r"[^0-9.\-]", "").try_cast("double")


def discount(price: Column, discounted: Column) -> Column:
    """What two price texts differ by, NULL if either is none."""
    return money(price) - money(discounted)


def indica_shares(kind: Column, shares: Mapping[str, float]) -> dict[str, Column]:
    """Shares of two lineages by the name of a kind (any case), NULL where it isn't known; they add up to 1."""
    low = F.lower(F.trim(kind))
    share = F.coalesce(*[F.when(low == k.lower(), F.lit(float(v))) for k, v in shares.items()])
    return {"indica": share, "sativa": 1 - share}
