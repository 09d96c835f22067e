"""Reading polymorphic source records that are kept as VARIANT.

The project API gives the same field as a number, a text, a list or an object, depending on the
account. VARIANT keeps that apart, so "0 and false count as missing" stays decidable.

The helpers take and give SQL text: they nest inside lambdas, and one `expr` builds the whole
column. The usual text value costs one extraction; only the few ambiguous readings look closer.
"""

from __future__ import annotations

EMPTY_JSON = "('null', 'false', '0', '\"\"', '[]', '{}')"
AMBIGUOUS = "('0', 'false', 'true', '[]', '{}')"
NO_VARIANTS = "cast(array() as array<variant>)"

# Where a custom field that comes as an object carries its key.
FIELD_KEY_NAMES = ("name", "field_name", "code", "key", "id")


def let(value: str, name: str, body: str) -> str:
    """Evaluate `value` once and use it in `body` under a name."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def field(record: str, name: str) -> str:
    """A field as VARIANT: SQL NULL when absent, variant null when the record says null."""
    return f"try_variant_get({record}, '$.{name}', 'variant')"


def known(value: str) -> str:
    """The variant, with variant null turned into SQL NULL."""
    return f"if(is_variant_null({value}), null, {value})"


def text(value: str) -> str:
    """A variant as text; missing, empty, zero and false values become NULL."""
    plain = f"try_variant_get({value}, '$', 'string')"
    exact = f"case when to_json({value}) in {EMPTY_JSON} then null when to_json({value}) = 'true' then 'True' else {plain} end"
    return f"case when {plain} in {AMBIGUOUS} then {exact} else nullif({plain}, '') end"


def text_at(record: str, name: str) -> str:
    plain = f"try_variant_get({record}, '$.{name}', 'string')"
    return f"case when {plain} in {AMBIGUOUS} then {text(field(record, name))} else nullif({plain}, '') end"


def text_of(record: str, *names: str) -> str:
    """Text of the first of the named fields that has a value, else NULL."""
    return f"coalesce({', '.join(text_at(record, name) for name in names)})" if len(names) > 1 else text_at(record, names[0])


def elements(value: str) -> str:
    """A list as array<variant>; NULL when the variant is no list."""
    return f"try_variant_get({value}, '$', 'array<variant>')"


def elements_at(record: str, name: str) -> str:
    return f"coalesce(try_variant_get({record}, '$.{name}', 'array<variant>'), {NO_VARIANTS})"


def is_object(value: str) -> str:
    return f"coalesce(try_variant_get({value}, '$', 'string') like '{{%' and schema_of_variant({value}) like 'OBJECT%', false)"


def joined(items: str) -> str:
    """Comma list of the non-empty elements of an array<variant>."""
    return f"array_join(array_compact(transform({items}, el -> {text('el')})), ', ')"


def any_text(value: str) -> str:
    """A variant as text, a list as the comma list of its elements; empty when missing."""
    return f"coalesce({joined(elements(value))}, {text(value)}, '')"


def any_text_at(record: str, name: str) -> str:
    plain = f"try_variant_get({record}, '$.{name}', 'string')"
    return f"case when {plain} like '[%' then {any_text(field(record, name))} else coalesce({text_at(record, name)}, '') end"


def custom_fields(record: str) -> str:
    """Custom fields as map<string,variant>, whatever of the three shapes the record uses."""
    raw = f"coalesce({known(field(record, 'customFields'))}, {known(field(record, 'custom_fields'))})"
    entry = (
        f"named_struct('key', {text_of('item', *FIELD_KEY_NAMES)}, "
        f"'value', coalesce({field('item', 'value')}, {field('item', 'values')}))"
    )
    entries = f"filter(transform(coalesce({elements('raw')}, {NO_VARIANTS}), item -> {entry}), x -> x.key is not null)"
    last_wins = "filter(es, (x, nr) -> not exists(slice(es, nr + 2, size(es)), y -> y.key = x.key))"
    listed = f"map_from_entries({let(entries, 'es', last_wins)})"
    return let(raw, "raw", f"coalesce(try_variant_get(raw, '$', 'map<string,variant>'), {listed})")


def custom_texts(fields: str) -> str:
    """The values of a custom field map as text; those the record gives as null stay NULL."""
    return f"transform_values({fields}, (k, v) -> if(is_variant_null(v), null, {any_text('v')}))"


def custom_text(texts: str, record: str, key: str) -> str:
    """A custom field as text: the map first, then a flattened field of the record."""
    return f"coalesce(try_element_at({texts}, '{key}'), {any_text_at(record, key)})"


def person_label(name: str, lastname: str, search_name: str, position: str) -> str:
    """`search name`, or else first and last name, with the position in parentheses."""
    person = f"coalesce(nullif({search_name}, ''), trim(concat_ws(' ', nullif({name}, ''), nullif({lastname}, ''))))"
    label = "concat(p.person, if(p.person <> '' and p.role <> '', concat(' (', p.role, ')'), ''))"
    return let(f"named_struct('person', {person}, 'role', trim(coalesce({position}, '')))", "p", label)


def contact_name(contact: str) -> str:
    """Display label of a related contact record."""
    name, lastname, search, position = (text_at(contact, n) for n in ("name", "lastname", "search_name", "position"))
    return (
        f"if(lower({text_at(contact, 'contact_type')}) = 'person', {person_label(name, lastname, search, position)}, "
        f"trim(coalesce({name}, {search}, '')))"
    )
