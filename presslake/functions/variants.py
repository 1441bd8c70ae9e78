"""Reading JSON lines, and VARIANT values with the text conventions of Python.

The helpers return Spark SQL text: the expressions are long, and one parsed
string builds faster than hundreds of Column calls.
"""

from __future__ import annotations

from collections.abc import Sequence

# No limit on the length of strings and numbers but that of a Java array.
_STRICT = """map('columnNameOfCorruptRecord', '_bad', 'allowSingleQuotes', 'false',
                'allowNonNumericNumbers', 'false', 'maxStringLen', '2147483647', 'maxNumLen', '2147483647')"""


def enclosed(line: str) -> str:
    """The line as the value of key ``r``, followed by ``"end": 0``.

    Spark's readers stop after one document and ignore the rest of a line. Only
    a line that is one JSON document, and nothing else, lets them reach ``end``.
    """
    return f"""concat('{{"r":', {line}, ',"end":0}}')"""


def read_enclosed(text: str, fields: str) -> str:
    """Typed reading of an ``enclosed`` line: ``r`` (the record), ``end``, ``_bad``."""
    return f"from_json({text}, 'r struct<{fields}>, end int, _bad string', {_STRICT})"


def read_variant(text: str) -> str:
    """An ``enclosed`` line as one VARIANT with members ``r`` and ``end``; NULL if it is no JSON."""
    return f"try_parse_json({text})"


def read_members(text: str, names: Sequence[str]) -> str:
    """An ``enclosed`` line whose record is an object: ``r`` holds the named members as VARIANT.

    Other members are skipped, so only a named one can exceed what a VARIANT holds (128 MiB).
    """
    fields = ", ".join(f"{name} variant" for name in names)
    return f"from_json({text}, 'r struct<{fields}>, end int, _bad string', {_STRICT})"


def variant_text(value: str, path: str = "$") -> str:
    """Text of the value; NULL for JSON null and for a missing member."""
    return f"try_variant_get({value}, '{path}', 'string')"


def python_text(text: str, value: str, typed: str) -> str:
    """``str()`` of the JSON value ``value`` whose ``variant_text`` is ``text``.

    ``typed`` is the same value read as a string: whole numbers keep all their
    digits there, and any other number is the text of a double. Booleans are
    capitalised, ``1.0E16`` becomes ``1e+16``, a number beyond all doubles ``inf``;
    objects and arrays stay compact JSON text. The JSON type is looked up only for
    texts that begin like a boolean or a number. Name columns here, not
    expressions: all are referenced several times.
    """
    number = rf"""coalesce({typed},
        if(schema_of_variant({value}) rlike r'^DECIMAL\(\d+,0\)$', concat({text}, '.0'), {text}))"""
    exponent = f"try_cast(substring_index({number}, 'E', -1) as int)"
    plain = rf"regexp_replace(cast(try_cast({number} as decimal(38,20)) as string), r'(\.\d+?)0+$', '$1')"
    mantissa = rf"regexp_replace(substring_index({number}, 'E', 1), r'\.0$', '')"
    scientific = (
        f"concat({mantissa}, if({exponent} < 0, 'e-', 'e+'), lpad(abs({exponent}), greatest(2, length(abs({exponent}))), '0'))"
    )
    return rf"""
    case when not (left({text}, 1) between '-' and '9' or left({text}, 1) in ('t', 'f', 'I')) then {text}
         when schema_of_variant({value}) = 'BOOLEAN' then initcap({text})
         when not schema_of_variant({value}) rlike '^(DECIMAL|DOUBLE|FLOAT)' then {text}
         when contains({number}, 'Infinity') then if(contains({number}, '-'), '-inf', 'inf')
         when not contains({number}, 'E') then {number}
         when {exponent} between -4 and 15 then {plain}
         else {scientific}
    end"""


def is_object(value: str) -> str:
    return f"startswith(schema_of_variant({value}), 'OBJECT')"
