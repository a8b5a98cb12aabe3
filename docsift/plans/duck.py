"""Building blocks of the SQL twins: expressions as text, for the engine that checks results."""

from __future__ import annotations

from collections.abc import Sequence

from docsift.functions import vocab

WS = r"[\s\x0B\x1c-\x1f\x{85}\pZ]+"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words: Sequence[str]) -> str:
    return ", ".join(q(w) for w in words)


def quote(word: str) -> str:
    return "".join(c if c.isalnum() or c in " _/%'\"<>!@#&=:;,~`-" else "\\" + c for c in word)


def any_word(c: str, words: Sequence[str]) -> str:
    return f"regexp_matches({c}, {q('|'.join(quote(w) for w in words))})"


def first_word(c: str, words: Sequence[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains({c}, {q(w)}) THEN {q(w)}" for w in words) + " END"


def folded(c: str) -> str:
    return f"translate(coalesce(CAST({c} AS VARCHAR), ''), {q(vocab.SPACES + vocab.ZERO_WIDTH)}, {q(' ' * len(vocab.SPACES))})"


def clean(c: str, collapse: bool = True) -> str:
    text = f"trim(regexp_replace({folded(c)}, {q(WS)}, ' ', 'g'))" if collapse else f"regexp_replace({folded(c)}, {q(f'^{WS}|{WS}$')}, '', 'g')"
    return f"(CASE WHEN lower({text}) IN ({listed(vocab.PLACEHOLDERS)}) THEN '' ELSE {text} END)"


def distinct(c: str) -> str:
    """A list's members, each where it comes first."""
    return f"list_filter({c}, lambda x, i: list_position({c}, x) = i)"


def multi_enum(c: str, allowed: Sequence[str]) -> str:
    parts = f"list_filter(list_transform(string_split({clean(c)}, '|'), lambda x: trim(x)), lambda x: x IN ({listed(allowed)}))"
    return f"array_to_string({distinct(parts)}, '|')"


def in_enum(c: str, allowed: Sequence[str], default: str) -> str:
    return f"(CASE WHEN {c} IN ({listed(allowed)}) THEN {c} ELSE {q(default)} END)"


def whole(c: str) -> str:
    text = f"regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), {q(f'^{WS}|{WS}$')}, '', 'g')"
    return f"(CASE WHEN regexp_matches({text}, '^[+-]?[0-9]+$') THEN CAST(CAST({text} AS HUGEINT) AS VARCHAR) ELSE '' END)"


def yn(c: str) -> str:
    return f"(CASE WHEN upper(trim(coalesce(CAST({c} AS VARCHAR), ''))) IN ('Y', 'YES', 'TRUE', '1') THEN 'Y' ELSE 'N' END)"


def conf(c: str) -> str:
    x = f"coalesce(TRY_CAST({c} AS DOUBLE), 0)"
    return f"printf('%.2f', round(CASE WHEN isnan({x}) THEN 0 ELSE least(1, greatest(0, {x})) END, 2))"


SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: str, k: int) -> str:
    return f"regexp_extract({url}, {q(SPLIT)}, {k})"


def host(url: str) -> str:
    return rf"lower(regexp_extract({part(url, 2)}, '^(?:.*@)?(\[[^\]]*\]|[^:]*)', 1))"


def canonical(url: str) -> str:
    u = f"trim({url})"
    scheme = f"lower(CASE WHEN {part(u, 1)} = '' THEN 'https' ELSE {part(u, 1)} END)"
    port = f"regexp_extract({part(u, 2)}, ':([0-9]+)$', 1)"
    p = f"(CASE WHEN {part(u, 3)} = '' THEN '/' ELSE {part(u, 3)} END)"
    p = f"regexp_replace({p}, '(?i)/(index\\.html|index\\.htm|default\\.aspx|index\\.aspx)$', '/')"
    p = f"(CASE WHEN length({p}) > 1 THEN regexp_replace({p}, '/+$', '') ELSE {p} END)"
    p = f"regexp_replace({p}, '/{{2,}}', '/', 'g')"
    p = f"(CASE WHEN {p} = '' THEN '/' ELSE {p} END)"
    junk = "^(" + "|".join(vocab.TRACKING_PREFIXES) + ")"
    kept = f"array_to_string(list_sort(list_filter(string_split({part(u, 4)}, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(string_split(x, '=')[1]), {q(junk)}))), '&')"
    shown = f"(CASE WHEN {port} = '' OR ({scheme} = 'https' AND {port} = '443') OR ({scheme} = 'http' AND {port} = '80') THEN '' ELSE ':' || {port} END)"
    return f"(CASE WHEN {host(u)} = '' THEN {u} ELSE {scheme} || '://' || {host(u)} || {shown} || {p} || (CASE WHEN {kept} = '' THEN '' ELSE '?' || {kept} END) END)"


def domain(h: str) -> str:
    h = f"regexp_replace(lower({h}), '^\\.+|\\.+$', '', 'g')"
    last = lambda k: f"array_to_string(list_slice(string_split({h}, '.'), -{k}, -1), '.')"
    return f"(CASE WHEN {last(2)} IN ({listed(vocab.TWO_LABEL_TLDS)}) THEN {last(3)} ELSE {last(2)} END)"


def title_key(c: str) -> str:
    text = f"lower({clean(c)})"
    for pattern in vocab.TITLE_NOISE:
        text = f"regexp_replace({text}, {q('(?i)' + pattern)}, ' ', 'g')"
    words = f"list_filter(string_split(regexp_replace(regexp_replace({text}, '[^a-z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g'), ' '), lambda w: w <> '' AND w NOT IN ({listed(vocab.TITLE_STOPWORDS)}))"
    return f"(CASE WHEN len({words}) < 2 THEN '' ELSE array_to_string({words}, ' ') END)"


def doc_type(strong: str, weak: str, value: str) -> str:
    """value picks 'type' or 'strength'."""
    tries = []
    for kind, phrases in vocab.TYPE_RULES:
        for p in phrases:
            tries.append(f"WHEN contains({strong}, {q(p)}) THEN {q(kind) if value == 'type' else (0.9 if len(p) > 8 else 0.65)}")
    for kind, phrases in vocab.TYPE_RULES:
        for p in phrases:
            if len(p) > 8:
                tries.append(f"WHEN contains({weak}, {q(p)}) THEN {q(kind) if value == 'type' else 0.5}")
    return f"(CASE {' '.join(tries)} ELSE {q('other') if value == 'type' else 0.2} END)"


def lob_hits(c: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {any_word(c, phrases)} THEN {q(name)} END" for name, phrases in vocab.LOB_RULES) + "], lambda x: x IS NOT NULL)"


WINNER = (
    "CASE WHEN effective_date = '' THEN NULL ELSE effective_date END DESC NULLS LAST, CASE WHEN last_updated_date = '' THEN NULL ELSE last_updated_date END DESC NULLS LAST, "
    "coalesce(TRY_CAST(confidence_score AS DOUBLE), 0) DESC, CASE WHEN http_status = '200' THEN 0 ELSE 1 END, "
    "CASE file_type WHEN 'pdf' THEN 0 WHEN 'docx' THEN 1 WHEN 'doc' THEN 1 WHEN 'xlsx' THEN 2 WHEN 'xls' THEN 2 WHEN 'html' THEN 3 ELSE 4 END, "
    "length(document_url) - length(replace(document_url, '/', '')), length(document_url), document_url, seq"
)
