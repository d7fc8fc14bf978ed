"""Text cleaning, tokens and stems as plain column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Named character references and the character each stands for.
NAMED_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&amp;": "&",
}

# Stop words used when the caller reads no list of their own (see sources.readers.stop_words).
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "been", "but", "by", "for", "from", "had", "has",
    "have", "he", "her", "his", "if", "in", "into", "is", "it", "its", "no", "not", "of", "on",
    "or", "our", "she", "so", "than", "that", "the", "their", "them", "then", "there", "these",
    "they", "this", "those", "to", "was", "we", "were", "what", "when", "which", "who", "will",
    "with", "you", "your",
    "s", "t", "u",
)


def unescape(text: Column) -> Column:
    """Replace character references: named ones, then numeric ones.

    A numeric reference becomes nothing if it stands for a non-ASCII character (those
    are dropped from tokens anyway) and a blank otherwise.
    """
    text = F.regexp_replace(text, r"&#(12[89]|1[3-9]\d|[2-9]\d\d|\d{4,});", "")
    text = F.regexp_replace(text, r"&#\d{1,3};", " ")
    for entity, char in NAMED_ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def strip_markup(html: Column) -> Column:
    """Text of a markup fragment: comments, scripts and tags become blanks."""
    html = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>", " ")
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(html, r"(?s)<[^>]*>", " ")), r"\s+", " "))


def clean(text: Column) -> Column:
    """Drop non-ASCII characters (neighbours close up), blank out the rest, lower-case."""
    ascii_only = F.regexp_replace(text, r"[^\x00-\x7F]+", "")
    return F.lower(F.regexp_replace(ascii_only, r"\P{Alnum}+", " "))


def words(text: Column) -> Column:
    """Array of the cleaned words of ``text``; :data:`IS_TOKEN` tells which ones count."""
    return F.split(clean(text), " ")


# Cleaned words hold letters and digits only: a letter means not empty and not all digits.
IS_TOKEN = "token RLIKE '[a-z]'"


# ------------------------------------------------------------------------- stemming
#
# Porter's suffix stripping (M. F. Porter, "An algorithm for suffix stripping", 1980)
# with the usual later departures: a few irregular words, words of up to two letters
# stay, "ies"/"ied" of four-letter words keep the e, y becomes i only after a consonant,
# bli/fulli/logi endings. A leading y is a consonant and is written Y while stemming.

_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
HAS_VOWEL = f"^({_C})?[aeiouy]"
MEASURE_OVER_0 = f"^({_C})?{_V}{_C}"
MEASURE_IS_1 = f"^({_C})?{_V}{_C}({_V})?$"
MEASURE_OVER_1 = f"^({_C})?{_V}{_C}{_V}{_C}"
ENDS_CVC = "([^aeiouy]|[aeiou]y)[aeiouy][^aeiouywx]$|^[aeiou][^aeiou]$"

# Irregular words and their stems.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
# Suffixes and what replaces them, steps 2 and 3 (measure > 0 before them).
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
# Suffixes dropped in step 4 (measure > 1 before them).
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)


def _cut(n: int | str) -> str:
    """The word without its last ``n`` letters."""
    return f"left(w, length(w) - {n})"


def _before(pattern: str, ending: str) -> str:
    """Test of the word without ``ending``, which it has, against a pattern that starts with ``^`` or ends with ``$``."""
    parts = [f"{x[:-1]}{ending}$" if x.endswith("$") else f"{x}.*{ending}$" for x in pattern.split("|^")]
    return f"w RLIKE '{'|^'.join(parts)}'"


def _suffix(suffixes) -> str:
    """The longest listed suffix the word ends with, or an empty text; most words are spared the pattern by their last letters."""
    ends = ", ".join(f"'{x}'" for x in sorted({x[-2:] for x in suffixes}))
    return f"if(substr(w, -2) IN ({ends}), regexp_extract(w, '({'|'.join(suffixes)})$', 1), '')"


_HEAD = "left(w, length(w) - length(suffix))"  # the word before its suffix


def _swap(pairs: dict[str, str]) -> str:
    """Replace the suffix if the measure before it is over 0."""
    new = ", ".join(f"'{x}', '{y}'" for x, y in pairs.items())
    return f"if(suffix <> '' AND {_HEAD} RLIKE '{MEASURE_OVER_0}', concat({_HEAD}, element_at(map({new}), suffix)), w)"


def _steps() -> list[str | tuple[str, str]]:
    """SQL of the steps in order; each maps the word ``w`` to its next form.

    Cheap suffix tests come first, so a pattern only runs on words it may change. Steps
    with many suffixes are pairs: first the suffix alone, then its one replacement. All steps
    end up in one generated method, which the JVM never compiles beyond 8000 bytes (several times the CPU time):
    so lists are one pattern or map instead of a chain of conditions, and words are tested whole instead of cut first.
    """
    last = "substr(w, -2, 1)"  # of a marked word
    return [
        # plurals
        f"""if(NOT endswith(w, 's') OR endswith(w, 'ss') AND NOT endswith(w, 'sses'), w,
            {_cut("if(w RLIKE 'sses$|^ies$|..ies$', 2, 1)")})""",
        # past tense and -ing; a word that lost its ending is marked with a trailing "+"
        f"""CASE WHEN NOT endswith(w, 'ed') AND NOT endswith(w, 'ing') THEN w
            WHEN endswith(w, 'ied') THEN {_cut("if(length(w) = 4, 1, 2)")}
            WHEN endswith(w, 'eed') THEN if({_before(MEASURE_OVER_0, 'eed')}, {_cut(1)}, w)
            WHEN {_before(HAS_VOWEL, '(ed|ing)')} THEN concat({_cut("if(endswith(w, 'd'), 2, 3)")}, '+') ELSE w END""",
        f"""CASE WHEN NOT endswith(w, '+') THEN w
            WHEN w RLIKE '(at|bl|iz)[+]$' THEN concat({_cut(1)}, 'e')
            WHEN {last} = substr(w, -3, 1) AND w RLIKE '[^aeiou][+]$' THEN {_cut("if(w RLIKE '[lsz][+]$', 1, 2)")}
            ELSE concat({_cut(1)}, if({_before(MEASURE_IS_1, '[+]')} AND {_before(ENDS_CVC, '[+]')}, 'e', '')) END""",
        # final y after a consonant that is not the first letter
        f"if(endswith(w, 'y') AND w RLIKE '^.+[^aeiouy]y$|^.*[aeiou]yy$', concat({_cut(1)}, 'i'), w)",
        # alli first, so that its result goes through the step once more
        f"if(endswith(w, 'alli') AND {_before(MEASURE_OVER_0, 'alli')}, {_cut(2)}, w)",
        f"if(endswith(w, 'logi') AND {_before(MEASURE_OVER_0, 'ogi')}, {_cut(1)}, w)",
        (_suffix(STEP_2), _swap(STEP_2)),
        (_suffix(STEP_3), _swap(STEP_3)),
        (
            f"if(w RLIKE '[st]ion$', 'ion', {_suffix(STEP_4)})",
            f"if(suffix <> '' AND {_HEAD} RLIKE '{MEASURE_OVER_1}', {_HEAD}, w)",
        ),
        # final e, then final double l
        f"""if(endswith(w, 'e') AND ({_before(MEASURE_OVER_1, 'e')}
            OR {_before(MEASURE_IS_1, 'e')} AND NOT {_before(ENDS_CVC, 'e')}), {_cut(1)}, w)""",
        f"if(endswith(w, 'll') AND {_before(MEASURE_OVER_1, 'l')}, {_cut(1)}, w)",
    ]


def with_stem(df: DataFrame, token: str, stem: str = "stem") -> DataFrame:
    """Add the stem of ``token``; all steps are built-in expressions in one stage."""
    out = df.withColumn("w", F.expr(f"if(startswith({token}, 'y'), concat('Y', substr({token}, 2)), {token})"))
    for step in _steps():
        if isinstance(step, tuple):
            out, step = out.withColumn("suffix", F.expr(step[0])), step[1]
        out = out.withColumn("w", F.expr(step))
    irregular = ", ".join(f"'{word}', '{form}'" for word, form in IRREGULAR.items())
    result = f"""CASE WHEN length({token}) <= 2 THEN {token}
        ELSE coalesce(element_at(map({irregular}), {token}), if(startswith(w, 'Y'), concat('y', substr(w, 2)), w)) END"""
    return out.withColumn(stem, F.expr(result)).drop("w", "suffix")
