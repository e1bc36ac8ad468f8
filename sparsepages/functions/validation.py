"""Field rules as boolean Column expressions.

A blank value passes every rule but ``required``, ``equalTo`` and
``nonalphamin``. Text is compared as a browser field holds it: carriage returns
are dropped and lengths count UTF-16 units.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The white space that trimming removes.
WHITESPACE = " \t\n\v\f\r" + "".join(
    map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF))
)

# The text forms accepted as a date.
DATE_FORMATS = (
    "yyyy-M-d",
    "yyyy/M/d",
    "M/d/yyyy",
    "MMM d, yyyy",
    "d MMM yyyy",
    "yyyy-M-d H:mm:ss",
    "yyyy-M-d'T'H:mm:ss",
)

# Address patterns, put together from character classes. No group with
# alternatives is repeated and no two repetitions compete, so matching takes
# neither deep recursion nor more than one or two passes over a long text.
# The characters each part of an address may hold.
_WIDE = r"\x{A0}-\x{D7FF}\x{F900}-\x{FDCF}\x{FDF0}-\x{FFEF}"
_LETTER = rf"[a-zA-Z{_WIDE}]"
_ALNUM = rf"[a-zA-Z0-9{_WIDE}]"
_HOST = rf"[a-zA-Z0-9{_WIDE}._~-]"
# A host name starts with a letter or digit, ends with a letter, and has a dot
# between a letter or digit and a letter.
_DOTTED = rf"(?={_HOST}*{_ALNUM}\.{_LETTER})"
_MAIL_HOST = rf"(?={_ALNUM}{_HOST}*+(?<={_LETTER})\z){_DOTTED}{_HOST}*+\z"
_MAIL_ATOMS = rf"\A[a-zA-Z0-9{_WIDE}!#$%&'*+/=?^_`{{|}}~.-]+@{_MAIL_HOST}"
_MAIL_DOTS = r"\A\.|\A[^@]*\.[.@]"
_MAIL_QUOTED = rf'\A"([\x01-\x09\x0B-\x7F{_WIDE}]*)"@{_MAIL_HOST}'
_MAIL_ESCAPE = rf"\\[\x01-\x09\x0B-\x7F{_WIDE}]"
_MAIL_QUOTED_PLAIN = rf"\A[\x01-\x09\x0B\x0C\x0E-\x21\x23-\x5B\x5D-\x7F{_WIDE}]*\z"

_URL_END = r"(?=[:/?#]|\z)"
_URL_HOST = rf"(?={_ALNUM}{_HOST}*+(?<={_LETTER}|{_LETTER}\.){_URL_END}){_DOTTED}{_HOST}*+"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_URL_USER = rf"[a-zA-Z0-9{_WIDE}._~!$&'()*+,;=:%-]"
_URL_CHARS = rf"a-zA-Z0-9{_WIDE}._~!$&'()*+,;=:@%-"
_URL = (
    rf"\A(?i:https?|s?ftp)://(?:{_URL_USER}*+@)?(?:{_OCTET}(?:\.{_OCTET}){{3}}{_URL_END}|{_URL_HOST})(?::[0-9]*)?"
    rf"(?:/(?:[{_URL_CHARS}][{_URL_CHARS}/]*)?)?(?:\?[{_URL_CHARS}/?\x{{E000}}-\x{{F8FF}}]*)?(?:#[{_URL_CHARS}/?]*)?\z"
)
_URL_BAD_ESCAPE = "%(?![0-9a-fA-F]{2})"

# The forms of text that the rules accept.
_DATE_ISO = r"\A[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}\z"
_THOUSANDS = r"\A[0-9]{1,3}(?:,[0-9]{3})+\z"
_DIGITS = r"\A[0-9]+\z"
_NUMERIC_TEXT = r"\A[+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\z"


@dataclass(frozen=True)
class Rule:
    """One rule on one column.

    ``param`` is the bound, the pair of bounds, the pattern or the other
    column's name. A rule of your own gives ``test``, called with the column
    and returning a boolean column. With ``when``, a boolean column or SQL
    text, the rule holds only where that is true: other rows, also where it is
    NULL, are neither checked nor failed.
    """

    column: str
    name: str
    param: Any = None
    test: Callable[[Column], Column] | None = None
    when: Column | str | None = None


def applies(rule: Rule) -> Column | None:
    """Where the rule holds, never NULL; ``None`` for every row."""
    if rule.when is None:
        return None
    return F.coalesce(F.expr(rule.when) if isinstance(rule.when, str) else rule.when, F.lit(False))


def field_text(value: Column) -> Column:
    """Text as a browser field holds it."""
    return F.replace(value.cast("string"), F.lit("\r"), F.lit(""))


def trimmed(text: Column) -> Column:
    """Without white space at either end.

    Trimming a set of characters walks the whole text; most texts show by their
    first and last character that there is nothing to trim.
    """
    spaces = F.lit(WHITESPACE)
    touches = F.contains(spaces, F.left(text, F.lit(1))) | F.contains(spaces, F.right(text, F.lit(1)))
    return F.when(touches, F.btrim(text, spaces)).otherwise(text)


def utf16_length(text: Column) -> Column:
    wide = F.shiftright(F.octet_length(F.encode(text, "UTF-16BE")), 1)
    return F.when(F.octet_length(text) == F.length(text), F.length(text)).otherwise(wide)


# What a digit counts at every second place: doubled, less 9 if above 9.
_DOUBLED = [2 * d - (9 if d > 4 else 0) for d in range(10)]
# The same for two neighbouring digits, by their value as one number.
_PAIRS = [right + _DOUBLED[left] for left in range(10) for right in range(10)]
_LONG_DIGITS = 18  # that many fit into a bigint


def luhn_valid(text: Column) -> Column:
    """Check digit of a text of digits, spaces and dashes; no digits at all pass."""
    digits = F.translate(text, " -", "")
    number = F.coalesce(F.right(digits, F.lit(_LONG_DIGITS)).try_cast("bigint"), F.lit(0))
    pairs = (F.call_function("div", number, F.lit(100**k)) % 100 for k in range(_LONG_DIGITS // 2))
    short = reduce(lambda a, b: a + b, (F.get(F.lit(_PAIRS), pair.cast("int")) for pair in pairs))

    # Longer than any card number: a higher-order function, which adds nothing to
    # the generated code that all other texts run through.
    worth = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.coalesce(F.when(i % 2 == 0, c.try_cast("bigint")).otherwise(F.get(F.lit(_DOUBLED), c.try_cast("int"))), F.lit(0)).cast("bigint"),
    )
    total = F.aggregate(worth, F.lit(0).cast("bigint"), lambda a, b: a + b)

    # ``short`` stands outside the CASE, so that Catalyst converts the number once.
    is_long = F.length(digits) > _LONG_DIGITS
    return (~is_long & (short % 10 == 0)) | F.when(is_long, total % 10 == 0).otherwise(False)


def _is_number(text: Column) -> Column:
    """Without a sign and a fraction only digits are left, which may stand in groups of three; nothing left will do."""
    unsigned = F.when(F.startswith(text, F.lit("-")), F.substr(text, F.lit(2))).otherwise(text)
    whole = F.regexp_replace(unsigned, r"\.[0-9]+\z", "")
    return ~whole.rlike("[^0-9]") | whole.rlike(_THOUSANDS)


def _is_email(text: Column) -> Column:
    atoms = text.rlike(_MAIL_ATOMS) & ~text.rlike(_MAIL_DOTS)
    quoted = F.regexp_extract(text, _MAIL_QUOTED, 1)
    plain = F.regexp_replace(quoted, _MAIL_ESCAPE, "")
    return F.when(text.startswith('"'), text.rlike(_MAIL_QUOTED) & plain.rlike(_MAIL_QUOTED_PLAIN)).otherwise(atoms)


def _number_in(value: Column, kind: T.DataType, test: Callable[[Column], Column]) -> Column:
    if isinstance(kind, T.NumericType):
        number = value.cast("double")
        return ~F.isnan(number) & test(number)
    return value.rlike(_NUMERIC_TEXT) & test(value.try_cast("double"))


def _date_shape(form: str) -> str:
    """Pattern for texts that look like the date form; the parser is asked about no others."""
    letters = {"yyyy": "[0-9]{4}", "MMM": "[A-Za-z]{3}", "mm": "[0-9]{2}", "ss": "[0-9]{2}", "'T'": "T"}
    one_or_two = dict.fromkeys(("M", "d", "H"), "[0-9]{1,2}")
    parts = re.findall(r"yyyy|MMM|mm|ss|'T'|.", form)
    return r"\A" + "".join({**letters, **one_or_two}.get(part, part) for part in parts) + r"\z"


def _is_date(text: Column) -> Column:
    # A failed parse costs an exception per value and form.
    tries = [F.when(text.rlike(_date_shape(form)), F.try_to_timestamp(text, F.lit(form))) for form in DATE_FORMATS]
    return F.coalesce(*tries).isNotNull()


def rule_passes(
    rule: Rule, kind: T.DataType, text: Column | None = None, bare: Column | None = None
) -> Column:
    """TRUE or FALSE, never NULL: does the column of type ``kind`` meet the rule?

    For a text column, ``text`` and ``bare`` hand in ``field_text`` of it and
    that ``trimmed``, so that several rules can share them.
    """
    col, name, param = F.col(rule.column), rule.name, rule.param
    if rule.test is not None:
        return F.coalesce(rule.test(col), F.lit(False))
    if name == "equalTo":
        return col.eqNullSafe(F.col(param))

    if isinstance(kind, T.ArrayType):
        blank, length = F.coalesce(F.size(col) <= 0, F.lit(True)), F.size(col)
    elif isinstance(kind, T.StringType):
        text = field_text(col) if text is None else text
        bare = trimmed(text) if bare is None else bare
        blank, length = F.coalesce(bare == "", F.lit(True)), utf16_length(bare)
    else:
        text = bare = col.cast("string")
        blank, length = col.isNull(), F.length(text)
    number = col if isinstance(kind, T.NumericType) else bare

    if name == "required":
        return ~blank
    if name == "nonalphamin":
        rest = F.regexp_replace(text, "[A-Za-z0-9_]+", "")
        return F.coalesce(utf16_length(rest) >= param, F.lit(False))
    if name == "email":
        test = _is_email(text)
    elif name == "url":
        test = text.rlike(_URL) & ~text.rlike(_URL_BAD_ESCAPE)
    elif name == "date":
        test = _is_date(bare) if isinstance(kind, T.StringType) else F.lit(isinstance(kind, T.DatetimeType))
    elif name == "dateISO":
        test = text.rlike(_DATE_ISO)
    elif name == "number":
        test = ~F.isnan(col.cast("double")) if isinstance(kind, T.NumericType) else _is_number(text)
    elif name == "digits":
        test = text.rlike(_DIGITS)
    elif name == "creditcard":
        test = ~text.rlike("[^0-9 -]") & luhn_valid(text)
    elif name == "minlength":
        test = length >= param
    elif name == "maxlength":
        test = length <= param
    elif name == "rangelength":
        test = length.between(*param)
    elif name == "min":
        test = _number_in(number, kind, lambda n: n >= param)
    elif name == "max":
        test = _number_in(number, kind, lambda n: n <= param)
    elif name == "range":
        test = _number_in(number, kind, lambda n: n.between(*param))
    elif name == "regex":
        # The first match must be the whole value, so alternatives count in order.
        test = F.regexp_extract(text, param, 0) == text
    else:
        raise ValueError(f"unknown rule {name!r}")
    return blank | F.coalesce(test, F.lit(False))


def _by_bounds(column: str, low, high, names: Sequence[str]) -> list[Rule]:
    if low is not None and high is not None:
        return [Rule(column, names[2], (low, high))]
    if low is not None:
        return [Rule(column, names[0], low)]
    return [Rule(column, names[1], high)] if high is not None else []


def length_rule(column: str, low: int | None = None, high: int | None = None) -> list[Rule]:
    return _by_bounds(column, low, high, ("minlength", "maxlength", "rangelength"))


def range_rule(column: str, low=None, high=None) -> list[Rule]:
    return _by_bounds(column, low, high, ("min", "max", "range"))


def password_rules(
    column: str, low: int | None = None, nonalphamin: int | None = None, regex: str | None = None
) -> list[Rule]:
    given = [("minlength", low), ("nonalphamin", nonalphamin), ("regex", regex)]
    return [Rule(column, name, param) for name, param in given if param]
