"""SQL twins of the column text steps, written for DuckDB so the oracle
queries compute the same thing from the same fixed lists."""

from __future__ import annotations

from ..functions import text as T
from ..functions.resources import (
    CONTRACTION_SUFFIXES, CONTRACTIONS, STOPWORDS_EN, TRANSLIT_FROM,
    TRANSLIT_MULTI, TRANSLIT_TO,
)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(items) -> str:
    return "[" + ", ".join(lit(x) for x in items) + "]"


STOP_LIST = str_list(STOPWORDS_EN)


def translit(x: str) -> str:
    src = "[" + ", ".join(lit(c) for c in TRANSLIT_MULTI) + "]"
    dst = "[" + ", ".join(lit(c) for c in TRANSLIT_MULTI.values()) + "]"
    one = f"list_transform(string_split({x}, ''), lambda c: coalesce({dst}[list_position({src}, c)], c))"
    x = f"CASE WHEN regexp_matches({x}, {lit('[' + T.MULTI + ']')}) THEN array_to_string({one}, '') ELSE {x} END"
    x = f"translate({x}, {lit(TRANSLIT_FROM)}, {lit(TRANSLIT_TO)})"
    return f"regexp_replace({x}, {lit(T.NON_ASCII)}, '', 'g')"


def contractions(x: str) -> str:
    rules = "s"
    for suffix, rep in CONTRACTION_SUFFIXES:
        rules = f"regexp_replace({rules}, {lit(suffix + '$')}, {lit(rep)})"
    table = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in CONTRACTIONS.items())
    seg = (f"coalesce(CASE s {table} END, "
           f"CASE WHEN instr(s, '''') > 0 THEN {rules} ELSE s END)")
    body = (f"array_to_string(list_transform(regexp_extract_all({x}, {lit(T.SEGMENTS)}), "
            f"lambda s: {seg}), '')")
    return f"(CASE WHEN instr({x}, '''') > 0 THEN {body} ELSE {x} END)"


def urls(x: str, mode: str = "greedy") -> str:
    pat = T.URL_GREEDY if mode == "greedy" else T.URL_STRICT
    return f"regexp_replace({x}, {lit(pat)}, '', 'g')"


def letter_runs(x: str) -> str:
    # RE2 has no back-references: one pass per letter
    for ch in "abcdefghijklmnopqrstuvwxyz":
        x = f"regexp_replace({x}, '{ch}{{3,}}', '{ch}{ch}', 'g')"
    return x


def parens(x: str) -> str:
    return f"translate({x}, '()', '')"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {lit(T.EDGE_WS)}, '', 'g')"


def stopwords_single_space(x: str) -> str:
    kept = f"list_filter(string_split({x}, ' '), lambda w: NOT list_contains({STOP_LIST}, w))"
    return strip_ws(f"array_to_string({kept}, ' ')")


def clean_text(x: str, mode: str = "greedy") -> str:
    x = f"CAST({x} AS VARCHAR)"
    x = translit(x)
    x = f"lower({x})"
    x = contractions(x)
    x = urls(x, mode)
    x = letter_runs(x)
    x = parens(x)
    return stopwords_single_space(x)


def remove_punct(x: str) -> str:
    return f"regexp_replace({x}, {lit(T.PUNCT)}, '', 'g')"


def split_ws(x: str) -> str:
    return (f"list_filter(regexp_split_to_array({strip_ws(x)}, {lit(T.WS_RUN)}), "
            f"lambda w: length(w) > 0)")


def split_merged(tokens: str) -> str:
    cases = " ".join(f"WHEN {lit(k)} THEN {str_list(v)}" for k, v in T.SPLIT_FORMS.items())
    return f"flatten(list_transform({tokens}, lambda t: CASE t {cases} ELSE [t] END))"


def word_tokens(x: str) -> str:
    return split_merged(split_ws(remove_punct(x)))


def stem_text(x: str) -> str:
    return (f"array_to_string(list_transform({split_ws(x)}, "
            f"lambda w: regexp_extract(w, {lit(T.STEM)}, 1)), ' ')")


def normalized_tokens(x: str) -> str:
    s = stem_text(remove_punct(f"lower(CAST({x} AS VARCHAR))"))
    toks = split_merged(split_ws(s))
    return f"list_filter({toks}, lambda w: NOT list_contains({STOP_LIST}, w))"


def rake_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {lit(T.RAKE_TOKEN)})"


def is_rake_delimiter(t: str) -> str:
    return (f"(list_contains({STOP_LIST}, {t}) OR NOT regexp_matches({t}, "
            f"{lit(T.HAS_WORD_CHAR)}))")
