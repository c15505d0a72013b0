"""Text forms of names, numbers and JSON."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, functions as F


def filled(template: str, /, **fields: Column) -> Column:
    """``"Hi {name}"`` with the placeholders replaced by columns."""
    parts = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field:
            parts.append(fields[field].cast("string"))
    return F.concat(*parts)


def or_default(value: Column, default: Column | str) -> Column:
    """The value, or the default where it is null or empty text."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(value, F.lit("")), fallback)


def stripped(value: Column) -> Column:
    """Without blanks and line ends around it."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def has_at(value: Column) -> Column:
    return F.coalesce(F.contains(value, F.lit("@")), F.lit(False))


def capitalized(value: Column) -> Column:
    """First character upper case, all others lower case."""
    return F.concat(F.upper(F.substring(value, 1, 1)), F.lower(F.substr(value, F.lit(2))))


def local_part(email: Column) -> Column:
    return F.substring_index(email, "@", 1)


def is_number_text(value: Column) -> Column:
    """Digits with at most one dot. A missing name counts as a number, too."""
    return F.coalesce(value.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"), F.lit(True))


def as_number(text: Column) -> Column:
    """Decimal text to a double, anything else (also "NaN" and Java's "1d") to null."""
    return F.when(text.rlike(NUMBER_PATTERN), stripped(text).try_cast("double"))


# Fixed value: optional sign, digits with at most one dot, optional exponent.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def float_text(value: Column) -> Column:
    """The shortest decimal text of a double, in plain form from 1e-4 up to 1e16. Above that
    the JVM may print a digit more than needed."""
    size = F.abs(value)
    short = value.cast("string")
    plain = F.regexp_replace(value.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(short, "E", 1), r"\.0$", "")
    exponent = F.substring_index(short, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.format_string("%02d", F.abs(exponent)),
    )
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), short)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def fixed_text(value: Column, places: int) -> Column:
    """A non-negative double with a fixed number of decimals, rounded from its exact binary
    value (ties to even); a formatter that rounds the decimal text gives other digits.

    The value is split into two halves of 26 bits, so that the products with ``scale`` are
    exact and the sign of the distance to the midpoint is right.
    """
    scale = float(2 * 10**places)
    below = F.floor(value * 10**places)
    spread = value * 134217729.0
    high = spread - (spread - value)
    distance = (high * scale - (below * 2 + 1)) + (value - high) * scale
    up = (distance > 0) | ((distance == 0) & (below % 2 == 1))
    steps = below + F.when(up, 1).otherwise(0)
    whole = F.floor(steps / 10**places).cast("string")
    if places == 0:
        return whole
    return F.concat(whole, F.lit("."), F.lpad((steps % 10**places).cast("string"), places, "0"))


# --- JSON ---------------------------------------------------------------------------

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# A member or element with the comma or colon behind it.
_CHUNK = rf'(?:{_STRING}|[^",:]++)++[,:]?'

# A quoted key before a colon, a quoted value after one.
SINGLE_QUOTED_KEY = "'([^']*)':"
SINGLE_QUOTED_VALUE = ": '([^']*)'"


def is_json(text: Column) -> Column:
    """Whether the whole text is an object or list. What cannot be one by its first
    characters is not tried: a failed parse costs far more than the test.

    The parser stops after the first value. So the text is also read as a member of an
    object with one more behind it, which fails unless the text is exactly one value.
    """
    may_be = text.rlike(r'^(\{\s*["}]|\[)')
    members = F.json_object_keys(F.concat(F.lit('{"value":'), text, F.lit(',"end":0}')))
    alone = members.eqNullSafe(F.array(F.lit("value"), F.lit("end")))
    return F.when(may_be, F.try_parse_json(text).isNotNull() & alone).otherwise(False)


def spaced_json(text: Column) -> Column:
    """Valid JSON with one blank after each comma and colon and none elsewhere."""
    dense = F.regexp_replace(text, rf"({_STRING})|\s+", "$1")
    return F.array_join(F.regexp_extract_all(dense, F.lit(_CHUNK), F.lit(0)), " ")


def repair_json(rows: DataFrame, name: str) -> DataFrame:
    """A text column with its objects and lists as JSON; single quotes become double ones
    where that makes the text parse. What cannot be parsed stays as it is.

    In steps, so that each text is rewritten, parsed and spaced once and the generated code
    stays small.
    """
    text = F.col(name)
    keys = F.regexp_replace(text, SINGLE_QUOTED_KEY, '"$1":')
    rows = rows.withColumn("_requoted", F.regexp_replace(keys, SINGLE_QUOTED_VALUE, ': "$1"'))
    requoted = F.col("_requoted")
    rows = rows.withColumn("_json", F.when(is_json(text), text).when(is_json(requoted), requoted))
    return rows.withColumn(name, F.coalesce(spaced_json(F.col("_json")), text)).drop("_requoted", "_json")
