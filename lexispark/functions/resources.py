"""Fixed word lists and character tables used by the text steps.

Everything here is plain data shared by the Spark expressions and by the
SQL twins, so both sides see exactly the same lists.
"""

from __future__ import annotations

import unicodedata

# --- fixed values: English stopword list (the common 179-word list) ---------
STOPWORDS_EN = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself it "
    "it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't "
    "didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't "
    "ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# --- fixed values: contractions expanded whole (checked before the suffix rules)
CONTRACTIONS = {
    "can't": "cannot",
    "won't": "will not",
    "shan't": "shall not",
    "ain't": "are not",
    "let's": "let us",
    "it's": "it is",
    "he's": "he is",
    "she's": "she is",
    "that's": "that is",
    "what's": "what is",
    "there's": "there is",
    "here's": "here is",
    "who's": "who is",
    "where's": "where is",
    "how's": "how is",
    "y'all": "you all",
    "ma'am": "madam",
    "o'clock": "of the clock",
}

# --- fixed values: contraction suffix rules, applied in this order ----------
CONTRACTION_SUFFIXES = (
    ("n't", " not"),
    ("'re", " are"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
    ("'d", " would"),
)

# --- fixed values: ASCII forms of characters that no decomposition gives
TRANSLIT_BASE = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ð": "d", "Ð": "D", "ı": "i",
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"',
    "–": "-", "—": "--", "‐": "-", "‑": "-", "−": "-", "«": "<<", "»": ">>", "⁄": "/", "×": "x", "÷": "/",
    "©": "(c)", "®": "(r)", "€": "EUR", "£": "GBP", "¥": "JPY", "°": "deg", "·": "*", "•": "*",
    # Greek
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh",
    "ψ": "ps", "ω": "o",
    # Cyrillic
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch",
    "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "є": "ie", "і": "i", "ґ": "g",
}


def _ascii_form(ch: str) -> str | None:
    """ASCII form of a character: NFKD, combining marks dropped, then each
    letter as it is or from the table above (capitals from small letters)."""
    out = []
    for c in unicodedata.normalize("NFKD", ch) if ch not in TRANSLIT_BASE else ch:
        if unicodedata.combining(c):
            continue
        if c.isascii():
            out.append(c)
        elif c in TRANSLIT_BASE:
            out.append(TRANSLIT_BASE[c])
        elif c.lower() in TRANSLIT_BASE:
            out.append(TRANSLIT_BASE[c.lower()].capitalize())
        else:
            return None
    return "".join(out) or None


def _build_tables() -> tuple[dict[str, str], str, str]:
    """Characters of Latin, Greek and Cyrillic, punctuation, currency, letter-like and
    presentation forms that have an ASCII form: those that become several
    characters, and the 1:1 table."""
    multi, src, dst = {}, [], []
    for first, last in ((0xA0, 0x52F), (0x1E00, 0x1FFF), (0x2000, 0x218F), (0xFB00, 0xFB06), (0xFF01, 0xFF5E)):
        for cp in range(first, last + 1):
            form = _ascii_form(chr(cp))
            if form and len(form) == 1:
                src.append(chr(cp))
                dst.append(form)
            elif form:
                multi[chr(cp)] = form
    return multi, "".join(src), "".join(dst)


TRANSLIT_MULTI, TRANSLIT_FROM, TRANSLIT_TO = _build_tables()

# Character classes shared by both engines.  Java and RE2 differ on \w, \s and
# \b, so every pattern spells its classes out.
WS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# the same whitespace set as plain characters (for trim functions)
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")
WORD = r"\p{L}\p{N}_"
ASCII_WS = r"\t\n\x0B\f\r\x1C-\x1F "
