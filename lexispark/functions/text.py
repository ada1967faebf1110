"""Column-level text steps.  Every function takes and returns a Column and
uses only built-in Spark expressions, so the steps stay inside whole-stage
codegen and never leave the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .resources import (
    ASCII_WS, CONTRACTION_SUFFIXES, CONTRACTIONS, STOPWORDS_EN, TRANSLIT_FROM,
    TRANSLIT_MULTI, TRANSLIT_TO, WORD, WS, WS_CHARS,
)

# Patterns (fixed values: the URL pattern of the reference and its strict
# variant, with \w and \s written out for ASCII text).
URL_GREEDY = r"https?://(www\.)?[-_a-zA-Z0-9" + ASCII_WS + r"./]*"
URL_STRICT = r"http[^" + ASCII_WS + r"]+"
LETTER_RUN = r"([a-z])\1{2,}"
SEGMENTS = r"[a-z']+|[^a-z']+"
NON_ASCII = r"[^\x00-\x7F]"
MULTI = "".join(TRANSLIT_MULTI)  # characters that become several
MULTI_PIECES = f"[{MULTI}]|[^{MULTI}]+"
PUNCT = r"[^" + WORD + WS + r"]"
WS_RUN = r"[" + WS + r"]+"
OTHER_WS = r"[" + WS.replace(" ", "") + r"]"  # white space that is no blank
EDGE_WS = r"\A[" + WS + r"]+|[" + WS + r"]+\z"
RAKE_TOKEN = r"[" + WORD + r"]+|[^" + WORD + WS + r"]+"
HAS_WORD_CHAR = r"[" + WORD + r"]"
STEM = r"^(.*ss|.*?)(s)?$"

# fixed values: merged forms the word tokenizer splits in two
SPLIT_FORMS = {
    "cannot": ("can", "not"), "gimme": ("gim", "me"), "gonna": ("gon", "na"),
    "gotta": ("got", "ta"), "lemme": ("lem", "me"), "wanna": ("wan", "na"),
}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def transliterate(c) -> Column:
    """multi-letter replacements, 1:1 table, then drop what is left
    outside ASCII.  A text of as many bytes as characters is ASCII and stays
    as it is; only texts that hold a multi-letter character are cut at them."""
    c = col(c)
    table = F.create_map(*[F.lit(x) for kv in TRANSLIT_MULTI.items() for x in kv])
    pieces = F.regexp_extract_all(c, F.lit(MULTI_PIECES), 0)
    multi = F.array_join(F.transform(pieces, lambda s: F.coalesce(
        F.when(F.length(s) == 1, F.try_element_at(table, s)), s)), "")
    has_multi = F.length(F.translate(c, MULTI, "")) < F.length(c)
    c = F.when(F.octet_length(c) > F.length(c), F.when(has_multi, multi).otherwise(c)).otherwise(c)
    rest = F.regexp_replace(F.translate(c, TRANSLIT_FROM, TRANSLIT_TO), NON_ASCII, "")
    return F.when(F.octet_length(c) > F.length(c), rest).otherwise(c)


def _expand_segment(s: Column, table: Column) -> Column:
    r = s
    for suffix, rep in CONTRACTION_SUFFIXES:
        r = F.regexp_replace(r, suffix + "$", rep)
    return F.coalesce(F.try_element_at(table, s),
                      F.when(F.instr(s, "'") > 0, r).otherwise(s))


def expand_contractions(c) -> Column:
    """cut the text into word / non-word segments, expand each word
    segment from the fixed table or the suffix rules, glue back.  Texts
    without an apostrophe skip the work."""
    c = col(c)
    table = F.create_map(*[F.lit(x) for kv in CONTRACTIONS.items() for x in kv])
    segs = F.regexp_extract_all(c, F.lit(SEGMENTS), 0)
    expanded = F.array_join(F.transform(segs, lambda s: _expand_segment(s, table)), "")
    return F.when(F.instr(c, "'") > 0, expanded).otherwise(c)


def remove_urls(c, mode: str = "greedy") -> Column:
    """``greedy`` is the reference pattern (it eats following words up to
    the next other character); ``strict`` removes ``http`` up to whitespace."""
    if mode not in ("greedy", "strict"):
        raise ValueError(f"unknown url mode {mode!r}")
    return F.regexp_replace(col(c), URL_GREEDY if mode == "greedy" else URL_STRICT, "")


def squeeze_letter_runs(c) -> Column:
    """three or more equal letters become two (input is ASCII lower case)."""
    return F.regexp_replace(col(c), LETTER_RUN, "$1$1")


def drop_parentheses(c) -> Column:
    """remove ( and ), keep what is inside."""
    return F.translate(col(c), "()", "")


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace (a
    character-set trim, no regex)."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def not_stopword(w: Column, stopwords=STOPWORDS_EN) -> Column:
    # a literal IN list of more than ten items becomes a hash-set lookup
    return ~w.isin(list(stopwords))


def drop_stopwords_single_space(c, stopwords=STOPWORDS_EN) -> Column:
    """split on one space (empty pieces and newlines survive), drop
    stopwords, join with one space, strip."""
    parts = F.split(col(c), " ", -1)
    kept = F.filter(parts, lambda w: not_stopword(w, stopwords))
    return strip_ws(F.array_join(kept, " "))


def clean_steps(url_mode: str = "greedy", stopwords=STOPWORDS_EN) -> list:
    """F1-F7 in the reference's order."""
    return [lambda x: transliterate(x.cast("string")), F.lower, expand_contractions,
            lambda x: remove_urls(x, url_mode), squeeze_letter_runs, drop_parentheses,
            lambda x: drop_stopwords_single_space(x, stopwords)]


def compose(c, steps) -> Column:
    x = col(c)
    for fn in steps:
        x = fn(x)
    return x


def clean_text(c, url_mode: str = "greedy", stopwords=STOPWORDS_EN) -> Column:
    """F1-F7 as one expression (prefer ``apply_steps`` with ``clean_steps``
    in jobs: see its note)."""
    return compose(c, clean_steps(url_mode, stopwords))


def remove_punctuation(c) -> Column:
    """drop every character that is neither a word character nor space."""
    return F.regexp_replace(col(c), PUNCT, "")


def blanks(c) -> Column:
    """Every whitespace character as a blank."""
    return F.regexp_replace(col(c), OTHER_WS, " ")


def split_ws(c) -> Column:
    """Python ``str.split()``: split on whitespace runs, no empty pieces.
    Cutting at a blank needs no regular expression, which ``split`` would
    compile anew for every row."""
    return F.array_remove(F.split(blanks(c), " ", -1), "")


# A whole word, in whitespace-separated text
_W0, _W1 = r"(?<![^" + WS + r"])", r"(?![^" + WS + r"])"
MERGED = _W0 + "(?:" + "|".join(f"({a})({b})" for a, b in SPLIT_FORMS.values()) + ")" + _W1
MERGED_REPL = "".join(f"${2 * i + 1}" for i in range(len(SPLIT_FORMS))) + " " + \
    "".join(f"${2 * i + 2}" for i in range(len(SPLIT_FORMS)))
STEM_TEXT = r"s(?<!ss)(?=[" + WS + r"]|\z)"  # looks back at an s only, not at every character


def split_merged_text(c) -> Column:
    """Word-tokenizer splits of merged forms (``cannot`` -> ``can not``),
    one regex pass over the text (groups that did not take part are empty).
    The regex only runs on texts that contain one of the forms."""
    c = col(c)
    has = None
    for word in SPLIT_FORMS:
        h = F.instr(c, word) > 0
        has = h if has is None else (has | h)
    return F.when(has, F.regexp_replace(c, MERGED, MERGED_REPL)).otherwise(c)


WORD_TOKEN_STEPS = [remove_punctuation, split_merged_text, split_ws]


def word_tokens(c) -> Column:
    """punctuation removal + word tokenisation."""
    return compose(c, WORD_TOKEN_STEPS)


def stem_text(c) -> Column:
    """F10 on every whitespace-separated word at once: a final ``s`` not
    preceded by ``s`` goes."""
    return F.regexp_replace(col(c), STEM_TEXT, "")


def normalized_steps(stopwords=STOPWORDS_EN) -> list:
    """F2, F9, F10, F11, F12 (lemmas are a join, see operators.terms)."""
    return [lambda x: F.lower(x.cast("string")), remove_punctuation, stem_text, split_merged_text,
            split_ws, lambda t: F.filter(t, lambda w: not_stopword(w, stopwords))]


def normalized_tokens(c, stopwords=STOPWORDS_EN) -> Column:
    return compose(c, normalized_steps(stopwords))


def vectorizer_tokens(c) -> Column:
    """F17 on space-joined word tokens: ``\\b\\w\\w+\\b`` keeps tokens of two
    or more characters."""
    return F.filter(split_ws(F.lower(col(c))), lambda w: F.length(w) >= 2)


def rake_tokens(c) -> Column:
    """Word and punctuation-run tokens of the lower-cased text."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(RAKE_TOKEN), 0)


def is_rake_delimiter(t: Column, stopwords=STOPWORDS_EN) -> Column:
    return t.isin(list(stopwords)) | ~t.rlike(HAS_WORD_CHAR)


def apply_steps(df, src, out: str, steps, once: bool = False):
    """Run ``steps`` on column ``src`` one projection per step; the result is
    column ``out``.

    Expressions under higher-order functions are evaluated without common
    subexpression elimination, so a step that reads its input twice would
    recompute the whole chain below it.  With one projection per step every
    input is a plain column; Catalyst keeps a costly column in its own
    projection when the next step reads it more than once.  ``once`` makes
    the last step come out of a one-element generator so that a later filter
    on ``out`` cannot be pushed below it (and compute it again)."""
    names = []
    cur = col(src)
    last = len(steps) - 1
    for i, fn in enumerate(steps):
        if i == last and once:
            keep = [c for c in df.columns if c != out]
            df = df.select(*keep, F.explode_outer(F.array(fn(cur))).alias(out))
        else:
            name = f"__step{i}"
            df = df.withColumn(name, fn(cur))
            names.append(name)
            cur = F.col(name)
    if not once:
        df = df.withColumn(out, cur)
    return df.drop(*names)
