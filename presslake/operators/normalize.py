"""Heterogeneous JSON records to the strict article schema.

Every line is read once with a typed ``from_json``. The few records the typed
reader cannot settle are ``odd`` and are looked at again as a VARIANT, which
knows the JSON type of every value: mixed lists, booleans and exponent numbers
in text fields, a media provider that may be absent or an explicit null, and
anything malformed. Both paths end in the same columns.

``reason`` tells what became of a line:

``malformed``   not a JSON document
``falsy``       JSON that Python treats as false (null, {}, [], 0, "", false)
``not_object``  other JSON that is no object
``ghost``       no article_id or no url after cleaning
``ok``          an article
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from presslake.functions.text import WHITESPACE_SQL, ustrip
from presslake.functions.variants import (
    enclosed,
    is_object,
    python_text,
    read_enclosed,
    read_members,
    read_variant,
    variant_text,
)
from presslake.schema import ARTICLE_COLUMNS, MEDIA_DDL, MEDIA_FIELDS, SCALAR_FIELDS

# JSON texts Python treats as false.
FALSY_JSON = ("null", "[]", "{}", '""', "0", "0.0", "-0.0", "false")
_FALSY = "(" + ", ".join(f"'{text}'" for text in FALSY_JSON) + ")"


def _ambiguous_text(text: str) -> str:
    """Text that a boolean or a double would also have produced."""
    return rf"""({text} in ('true', 'false', '"Infinity"', '"-Infinity"')
        or contains({text}, 'E') and {text} rlike r'^-?\d(\.\d+)?E-?\d+$')"""


def _scalars(columns: Sequence[str]) -> list[str]:
    """The text fields to read for ``columns``; id and URL decide about ghosts."""
    return [name for name in SCALAR_FIELDS if name in columns or name in ("article_id", "url")]


def _fields(columns: Sequence[str]) -> str:
    fields = [f"{name}: string" for name in _scalars(columns)]
    if "tags" in columns:
        fields.append("tags: array<string>")
    if "media" in columns:
        fields += [f"media: {MEDIA_DDL}", f"images: {MEDIA_DDL}"]
    return ", ".join(fields)


def _members(columns: Sequence[str]) -> list[str]:
    """The members of a record that ``columns`` need."""
    lists = [name for name in ("tags", "media") if name in columns]
    return [*_scalars(columns), *lists, *(["images"] if "media" in columns else [])]


def _is_odd(read: str, line: str, columns: Sequence[str]) -> str:
    """Whether the typed reading ``read`` of ``line`` needs a second look."""
    record = f"{read}.r"
    texts = "array(" + ", ".join(f"{record}.{name}" for name in _scalars(columns)) + ")"
    if "tags" in columns:
        texts = f"concat({texts}, coalesce({record}.tags, array()))"
    tests = [
        f"{record} is null",
        f"{read}._bad is not null",
        f"{read}.end is null",
        f"exists({texts}, t -> coalesce({_ambiguous_text('t')}, false))",
    ]
    if "media" in columns:
        no_provider = "m -> m is not null and m.provider is null"
        tests.append(
            f"""(coalesce(exists({record}.media, {no_provider}), false)
                 or coalesce(exists({record}.images, {no_provider}), false))
                and contains({line}, '"provider"')"""
        )
    return "(" + " or ".join(tests) + ")"


def _odd_texts(record: str, columns: Sequence[str]) -> str:
    """The text fields of an odd record, in the order of ``_scalars``."""
    doc = f"{record}.doc"
    values = (
        f"""struct({variant_text(f'{doc}.{n}')} as text, {doc}.{n} as raw, {record}.typed.{n} as typed)"""
        for n in _scalars(columns)
    )
    return f"transform(array({', '.join(values)}), v -> {python_text('v.text', 'v.raw', 'v.typed')})"


def _tags(record: str) -> str:
    """A list: nulls dropped, items stripped, blanks kept. Else an empty list."""
    strip = f"btrim({{}}, '{WHITESPACE_SQL}')"
    odd_tags = f"""transform(
        filter(transform(try_variant_get({record}.doc.tags, '$', 'array<variant>'),
                         (tag, i) -> struct({variant_text('tag')} as text, tag as raw,
                                            get({record}.typed.tags, i) as typed)),
               tag -> not is_variant_null(tag.raw)),
        tag -> {strip.format(python_text('tag.text', 'tag.raw', 'tag.typed'))})"""
    tags = f"""transform(filter({record}.typed.tags, tag -> tag is not null),
                         tag -> {strip.format('tag')})"""
    return f"coalesce(if({record}.odd, {odd_tags}, {tags}), cast(array() as array<string>))"


def _media(record: str) -> str:
    """``media``, or ``images`` where media is falsy; objects only, five fixed fields.

    A truthy non-list blocks the fallback. A missing provider gets the default,
    an explicit null stays null.
    """
    as_list = f"try_variant_get({record}.doc.{{}}, '$', 'array<variant>')".format
    falsy = f"""case when {as_list('media')} is not null then size({as_list('media')}) = 0
        else coalesce(to_json({record}.doc.media) in {_FALSY}, true)
        end"""
    fields = {name: variant_text("item", f"$.{name}") for name in MEDIA_FIELDS}
    fields["provider"] = f"""if(try_variant_get(item, '$.provider', 'variant') is null,
        'internal', {fields['provider']})"""
    item = ", ".join(f"{text} as {name}" for name, text in fields.items())
    odd_media = f"""transform(
        filter(if({falsy}, {as_list('images')}, {as_list('media')}), item -> {is_object('item')}),
        item -> struct({item}))"""
    typed = f"{record}.typed"
    plain = ", ".join(f"item.{name} as {name}" for name in MEDIA_FIELDS if name != "provider")
    media = f"""transform(
        filter(if(coalesce(size({typed}.media) > 0, false), {typed}.media, {typed}.images),
               item -> item is not null),
        item -> struct({plain}, coalesce(item.provider, 'internal') as provider))"""
    return f"coalesce(if({record}.odd, {odd_media}, {media}), cast(array() as {MEDIA_DDL}))"


def parse_lines(
    lines: DataFrame, value: str = "value", columns: Sequence[str] = ARTICLE_COLUMNS
) -> DataFrame:
    """Replace the text column by the raw article fields and the line's ``state``.

    Text fields come as ``_name``, not stripped yet. ``state`` is NULL for a
    usable object, else the reject reason.

    All reading happens in one generator, each step naming the result of the one
    before (``session.configure`` lets repeated keys pass, the last wins): a filter on parsed fields would be pushed below a plain projection
    and parse every line a second time. Nor can Spark prune fields there: name
    the article ``columns`` that are needed, and the reader skips all others.
    """
    others = [c for c in lines.columns if c != value]
    # An object without any quote is empty. Trimming copies, so it only happens
    # where it matters.
    shaped = lines.selectExpr(
        *others,
        f"{enclosed(value)} as _line",
        f"""case when not startswith(
                    if(startswith({value}, '{{'), {value}, ltrim(' \\t\\r\\n', {value})), '{{') then 'other'
                when not contains({value}, '"') then 'empty'
                else 'object' end as _shape""",
    )
    steps = [
        f"struct(x.r as typed, _shape <> 'object' or {_is_odd('x', '_line', columns)} as odd)",
        f"""struct(x.typed as typed, x.odd as odd,
                   if(x.odd and _shape = 'object', {read_members('_line', _members(columns))}, null) as json,
                   if(x.odd and _shape <> 'object', {read_variant('_line')}, null) as other)""",
        """struct(x.typed as typed, x.odd as odd,
                  coalesce(if(_shape = 'object', x.json.end = 0 and x.json._bad is null and x.json.r is not null,
                              try_variant_get(x.other, '$.end', 'int') = 0), false) as valid,
                  if(x.json.end = 0 and x.json._bad is null, x.json.r, null) as doc,
                  try_variant_get(x.other, '$.r', 'variant') as whole)""",
    ]
    steps.append(
        f"""struct(x.typed as typed, x.odd as odd, x.valid as valid, x.doc as doc, x.whole as whole,
                   if(x.odd, {_odd_texts('x', columns)}, null) as texts)"""
    )
    state = f"""
        case when not x.odd then null
             when not x.valid then 'malformed'
             when _shape = 'object' then null
             when _shape = 'empty' or x.whole is null or to_json(x.whole) in {_FALSY} then 'falsy'
             else 'not_object' end as state"""
    fields = [f"if(x.odd, x.texts[{i}], x.typed.{n}) as _{n}" for i, n in enumerate(_scalars(columns))]
    fields += [f"{make('x')} as {n}" for n, make in (("tags", _tags), ("media", _media)) if n in columns]
    steps.append("struct(" + ", ".join([state, *fields]) + ")")
    rows = f"array({read_enclosed('_line', _fields(columns))})"
    for step in steps:
        rows = f"transform({rows}, x -> {step})"
    return shaped.selectExpr(*others, f"inline({rows})")


def _articles(parsed: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Article ``columns`` (and always id and URL): texts stripped, blank is NULL."""
    names = _scalars(columns)
    nested = [name for name in ("tags", "media") if name in columns]
    stripped = parsed.select(*keep, *(ustrip(f"_{n}").alias(f"_{n}") for n in names), *nested)
    return stripped.selectExpr(*keep, *(f"nullif(_{n}, '') as {n}" for n in names), *nested)


def classify(
    lines: DataFrame, value: str = "value", columns: Sequence[str] = ARTICLE_COLUMNS
) -> DataFrame:
    """Every line with its ``reason``; article columns matter for ``ok`` and ``ghost`` only."""
    parsed = parse_lines(lines, value, columns)
    keep = [c for c in lines.columns if c != value] + ["state"]
    ghost = F.col("article_id").isNull() | F.col("url").isNull()
    reason = F.coalesce("state", F.when(ghost, "ghost"), F.lit("ok"))
    return _articles(parsed, keep, columns).withColumn("reason", reason).drop("state")


def normalize(
    lines: DataFrame, value: str = "value", columns: Sequence[str] = ARTICLE_COLUMNS
) -> DataFrame:
    """Usable articles only: other columns of ``lines``, then the article ``columns``."""
    parsed = parse_lines(lines, value, columns).filter("state is null")
    keep = [c for c in lines.columns if c != value]
    rows = _articles(parsed, keep, columns).filter("article_id is not null and url is not null")
    return rows.select(*keep, *(name for name in ARTICLE_COLUMNS if name in columns))


def reject_report(lines: DataFrame, position: list[str], value: str = "value") -> DataFrame:
    """Number of lines per outcome, with repeated ids counted as ``duplicate``.

    Duplicates are the surplus of ok lines over distinct ids per file, so the
    bodies never move: one partial aggregation, then a shuffle of short keys.
    ``position`` names the columns that identify the input file.
    """
    outcome = classify(lines, value, ["article_id", "url"]).select(
        *position, "reason", F.when(F.col("reason") == "ok", F.col("article_id")).alias("id")
    )
    per_id = outcome.groupBy(*position, "reason", "id").agg(F.count("*").alias("n"))
    surplus = F.when(F.col("reason") == "ok", F.col("n") - 1).otherwise(0)
    split = F.array(
        F.struct(F.col("reason").alias("reason"), (F.col("n") - surplus).alias("n")),
        F.struct(F.lit("duplicate").alias("reason"), surplus.alias("n")),
    )
    return (
        per_id.select(F.inline(split))
        .filter("n > 0")
        .groupBy("reason")
        .agg(F.sum("n").alias("n_lines"))
    )
