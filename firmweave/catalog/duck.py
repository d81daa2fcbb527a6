"""SQL fragments for the DuckDB side of the check."""

from __future__ import annotations

from firmweave.functions.text import WHITESPACE

# The white-space set inside an RE2 character class.
_WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_TOKENS = "('nan', 'none', 'null')"


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def squeeze(x: str) -> str:
    return f"regexp_replace({strip(f'coalesce({x}, {chr(39) * 2})')}, '[{_WS}]+', ' ', 'g')"


def name_clean(x: str) -> str:
    return strip(f"coalesce({x}, '')")


def key(x: str) -> str:
    return f"regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]', '', 'g')"


def corporate_id(name_key: str, address_key: str) -> str:
    return f"substr(sha256({name_key} || '_' || {address_key}), 1, 16)"


def null_tokens(x: str) -> str:
    s = strip(x)
    return f"CASE WHEN {x} IS NULL OR {s} = '' OR {s} IN {_TOKENS} THEN NULL ELSE {s} END"


def filled(items: str) -> str:
    return f"list_filter(list_transform({items}, lambda q: {strip('q')}), lambda q: q IS NOT NULL AND q <> '')"


def list_array(x: str) -> str:
    return f"coalesce(list_transform({x}, lambda q: coalesce({strip('q')}, 'None')), [])"


def list_delim(x: str) -> str:
    return f"coalesce({filled(f'string_split({x}, {chr(39)};{chr(39)})')}, [])"


def bracketed(s: str) -> str:
    return f"""({s} LIKE '[%' AND {s} LIKE '%]' AND ({s} LIKE '%''%' OR {s} LIKE '%"%'))"""


def quoted(s: str) -> str:
    return (
        f"""CASE WHEN len(regexp_extract_all({s}, '''([^'']+)''', 1)) > 0 """
        f"""THEN regexp_extract_all({s}, '''([^'']+)''', 1) """
        f"""ELSE regexp_extract_all({s}, '"([^"]+)"', 1) END"""
    )


def customers_array(x: str) -> str:
    s = strip("item")
    expanded = f"CASE WHEN {bracketed(s)} THEN {quoted(s)} ELSE [{s}] END"
    return f"coalesce({filled(f'flatten(list_transform({x}, lambda item: {expanded}))')}, [])"


def customers_string(x: str) -> str:
    s = strip(x)
    flat = f"replace({s}, chr(10), ' ')"
    pieces = (
        f"CASE WHEN {bracketed(s)} THEN {quoted(s)} "
        f"WHEN len(string_split_regex({flat}, '[;,|]')) > 1 THEN string_split_regex({flat}, '[;,|]') "
        f"WHEN len(string_split_regex({flat}, '[{_WS}]{{2,}}')) > 1 THEN string_split_regex({flat}, '[{_WS}]{{2,}}') "
        f"ELSE string_split({flat}, ' ') END"
    )
    return f"CASE WHEN {x} IS NULL THEN [] ELSE {filled(pieces)} END"


def join_array(x: str) -> str:
    kept = (
        f"list_filter(list_transform({x}, lambda q: {strip('q')}), "
        f"lambda q: q IS NOT NULL AND q <> '' AND lower(q) NOT IN {_TOKENS})"
    )
    return f"nullif(array_to_string({kept}, '; '), '')"


def join_text(x: str) -> str:
    s = strip(x)
    return (
        f"CASE WHEN {x} IS NULL OR {s} = '' OR lower({s}) IN {_TOKENS} THEN NULL "
        f"WHEN {bracketed(s)} THEN nullif(array_to_string({filled(quoted(s))}, '; '), '') ELSE {s} END"
    )


def count_items(x: str) -> str:
    s = strip(x)
    return (
        f"CAST(CASE WHEN {x} IS NULL OR {s} = '' OR lower({s}) IN {_TOKENS} THEN 0 "
        f"WHEN contains({s}, ';') THEN len({list_delim(s)}) ELSE 1 END AS INTEGER)"
    )


def count_items_unstripped(x: str) -> str:
    return (
        f"CAST(CASE WHEN {x} IS NULL OR {x} = '' OR lower({x}) IN {_TOKENS} THEN 0 "
        f"WHEN contains({x}, ';') THEN len({list_delim(x)}) ELSE 1 END AS INTEGER)"
    )


def to_number(x: str) -> str:
    number = r"[ \t-\r]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t-\r]*"
    plain = f"ltrim(trim({x}, '{' '}\t\n\x0b\x0c\r'), '+')"
    return (
        f"CASE WHEN {x} IS NULL THEN 0.0 "
        f"WHEN regexp_full_match({x}, '{number}') "
        f"THEN CASE WHEN isfinite(TRY_CAST({plain} AS DOUBLE)) THEN TRY_CAST({plain} AS DOUBLE) ELSE 0.0 END "
        f"WHEN regexp_full_match(lower({x}), '[+]?inf(inity)?') THEN CAST('inf' AS DOUBLE) "
        f"WHEN regexp_full_match(lower({x}), '-inf(inity)?') THEN CAST('-inf' AS DOUBLE) ELSE 0.0 END"
    )


def margin(revenue: str, profit: str) -> str:
    return (
        f"CASE WHEN {revenue} IS NULL OR {profit} IS NULL OR {revenue} <= 0 THEN 0.0 "
        f"ELSE {profit} / {revenue} * 100 END"
    )


def category(revenue: str) -> str:
    return (
        f"CASE WHEN {revenue} IS NULL THEN 'Unknown' WHEN {revenue} < 100 THEN 'Small' "
        f"WHEN {revenue} < 1000 THEN 'Medium' WHEN {revenue} < 5000 THEN 'Large' ELSE 'Enterprise' END"
    )


def shown(items: str) -> str:
    """A list column as text, so that both engines hand over the same type."""
    return f"array_to_string({items}, ' ~ ')"
