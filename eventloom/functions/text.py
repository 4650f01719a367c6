"""String expressions: Column in, Column out, null in, null out."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


#: How letters without a decomposition are written in ASCII, in lower case. Capitals follow by rule.
LATIN = {"æ": "ae", "œ": "oe", "ĳ": "ij", "ß": "ss", "þ": "th", "ŋ": "ng", "ð": "d", "đ": "d", "ø": "o", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t", "ĸ": "k", "ƒ": "f", "ɓ": "b", "ɗ": "d", "ƙ": "k", "ƴ": "y"}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p",
    "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "ё": "io", "ђ": "dj", "ѓ": "gj", "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "tsh", "ќ": "kj", "ў": "u", "џ": "dzh", "ґ": "g",
}
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p",
    "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
#: Marks and spaces of print, as they are typed.
MARKS = {"‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,", "«": "<<", "»": ">>", "–": "-", "—": "--", "…": "...", "‐": "-", "‑": "-", "\u00a0": " ", "\u2009": " ", "\u202f": " "}


def transliterations() -> dict[str, str]:
    """What each covered character becomes: accented letters by their decomposition, others by the fixed values."""
    table = dict(MARKS)
    for letters in (LATIN, CYRILLIC, GREEK):
        for small, plain in letters.items():
            table[small] = plain
            if len(small.upper()) == 1:
                table.setdefault(small.upper(), plain.upper() if letters is LATIN and small != "þ" else plain.capitalize())
    for code in [*range(0x00C0, 0x0250), *range(0x0370, 0x0530), *range(0x1E00, 0x2000)]:
        first, *rest = unicodedata.normalize("NFD", chr(code))
        if rest and all(map(unicodedata.combining, rest)) and (first in table or (first.isascii() and first.isalpha())):
            table.setdefault(chr(code), table.get(first, first))
    return table


_TABLE = transliterations()
_ONE = {c: to for c, to in _TABLE.items() if len(to) == 1}
_MANY = {c: to for c, to in _TABLE.items() if len(to) > 1}


def fold_accents(text: Column) -> Column:
    """Text in ASCII letters, as far as it can be told: accents and combining marks go; Latin letters of their own,
    Cyrillic and Greek ones and the marks of print are written out, some as several letters. Other characters stay.

    Characters that become one are translated in one pass; those that become several are replaced one by one, in texts
    that hold any.
    """
    plain = unmarked(F.translate(text, "".join(_ONE), "".join(_ONE.values())))
    written = plain
    for c, to in _MANY.items():
        written = F.replace(written, F.lit(c), F.lit(to))
    other = F.when(plain.rlike(f"[{''.join(_MANY)}]"), written).otherwise(plain)
    return F.when(text.rlike(r"[^\x00-\x7F]"), other).otherwise(text)


_OTHER = re.compile("[^\x00-\x7f]+")
_FOLDED = {ord(c): to for c, to in _TABLE.items()}


def unmarked(text: Column) -> Column:
    """Text without combining marks."""
    return F.regexp_replace(text, r"\p{Mn}+", "")


def folded(text: str | None) -> str | None:
    """fold_accents of one text that is unmarked() before, for kernels: only runs of other characters than ASCII are looked at."""
    return text if text is None or text.isascii() else _OTHER.sub(lambda run: run[0].translate(_FOLDED), text)


def fold_texts(text: Column) -> Column:
    """fold_accents for long texts of many scripts, by an Arrow kernel; it can't stand in a lambda."""

    @F.arrow_udf("string")
    def fold(column: pa.Array) -> pa.Array:
        return pa.array([folded(t) for t in column.to_pylist()], pa.string())

    return fold(unmarked(text))


def _each(text: Column, *rules: tuple[str, str]) -> Column:
    for pattern, by in rules:
        text = F.trim(F.regexp_replace(text, pattern, by))
    return text


def clean_query(text: Column) -> Column:
    """A mention without articles, ordinals, possessives and leading numbers, for lookups; empty if nothing useful is left."""
    text = F.regexp_replace(text, r"^[\s]+|[\s]+$", "")
    cleaned = F.regexp_replace(F.regexp_replace(text, " +", " "), "\n+", " ")
    cleaned = _each(cleaned, ("(?i)^the ", ""), ("(?i)^an ", ""), ("(?i)^a ", ""), (" of$", ""), ("^'s", ""), (r"(?<=\d\d)(?:st|nd|rd|th)\b", ""), (r"(?<=\d)(?:st|nd|rd|th)\b", ""), (r"^\d+? ", ""), ("'s$", ""))
    return F.when(text.isin("The", "the", "a", "an", "") | (F.length(cleaned) < 2), F.lit("")).otherwise(cleaned)


def title_case(text: Column) -> Column:
    """Every run of letters begins with a capital and goes on in lower case (initcap looks at white space only).

    A first letter whose capital has several letters, as that of an eszett, keeps the first of them large.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    first = lambda r: F.upper(F.substring(r, 1, 1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.substring(first(r), 1, 1), F.lower(F.substr(first(r), F.lit(2))), F.lower(F.substr(r, F.lit(2))))), "")


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 less the edit distance per character of the longer string; 0 for two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 0.0).otherwise(1 - F.levenshtein(a, b) / longest)


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, by one row of the table at a time."""
    left, right = F.split(a, ""), F.split(b, "")
    zeros = F.transform(F.sequence(F.lit(0), F.length(b)), lambda _: F.lit(0))

    def next_row(row: Column, x: Column) -> Column:
        start = F.array(F.lit(0))

        def cell(done: Column, j: Column) -> Column:
            diagonal, above, before = F.element_at(row, j), F.element_at(row, j + 1), F.element_at(done, -1)
            return F.concat(done, F.array(F.when(F.element_at(right, j) == x, diagonal + 1).otherwise(F.greatest(above, before))))

        return F.aggregate(F.sequence(F.lit(1), F.length(b)), start, cell)

    table = F.aggregate(left, zeros, next_row)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.element_at(table, -1))


def subsequence_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 0.0).otherwise(common_subsequence(a, b) / longest)


def query_forms(query: Column, country: Column) -> list[Column]:
    """The query, and the query with a country in brackets."""
    return [query, F.concat(query, F.lit(" ("), country, F.lit(")"))]


def exact_title(query: Column, country: Column, title: Column) -> Column:
    """Whether a title is the query as it is, in capitals, in title case, or as it is but for accents; with or without the country."""
    return F.coalesce(F.greatest(*[F.coalesce((title == q) | (title == F.upper(q)) | (title == title_case(q)) | (fold_accents(title) == q), F.lit(False)) for q in query_forms(query, country)]), F.lit(False))


def redirect_hit(query: Column, country: Column, redirects: Column) -> Column:
    """Whether a form of the query is one of the redirects; false without any."""
    forms = F.array(*[f(q) for q in query_forms(query, country) for f in (lambda x: x, title_case, F.upper)])
    return F.coalesce(F.arrays_overlap(redirects, F.filter(forms, lambda x: x.isNotNull())), F.lit(False))


def alternative_hit(query: Column, names: Column, infobox_name: Column) -> Column:
    """Whether the query is an alternative name (as it is, in title case or capitals; accents or the name's case may differ) or the infobox's name."""
    forms = F.array(query, title_case(query), F.upper(query))
    plain = F.transform(names, fold_accents)
    hit = F.arrays_overlap(names, forms) | F.arrays_overlap(plain, forms) | F.array_contains(F.transform(names, title_case), query)
    return F.coalesce(hit, F.lit(False)) | F.coalesce(infobox_name == query, F.lit(False))


def clean_names(names: Column) -> Column:
    """Names without link markup, those that end in a colon left out, with their plain forms, each once, sorted."""
    bare = F.transform(names, lambda x: F.trim(F.regexp_replace(F.trim(F.regexp_replace(x, r"\|.+?\]\]", "")), r"[\[\]]", "")))
    kept = F.filter(bare, lambda x: ~x.endswith(":"))
    return F.array_sort(F.array_distinct(F.concat(kept, F.transform(kept, fold_accents))))


def clean_entries(names: Column) -> Column:
    """Names without those that hold # or /, and without a note of ambiguity; each once, sorted."""
    kept = F.filter(names, lambda x: ~x.rlike("[#/]"))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda x: F.trim(F.replace(x, F.lit("(disambiguation)"), F.lit(""))))))


def split_list(value: Column) -> Column:
    """The entries of an infobox field: parted by line ends, then commas; trimmed."""
    return F.filter(F.transform(F.split(value, "[\n,]"), lambda x: F.trim(x)), lambda x: x != "")


def context_window(document: Column, query: Column, around: int = 200, otherwise: int = 400) -> Column:
    """What stands around the first place of the query (its spaces squeezed), or the document's beginning."""
    wanted = F.trim(F.regexp_replace(query, r"\s+", " "))
    at = F.instr(document, wanted)
    start = F.greatest(at - around, F.lit(1))
    return F.when(at > 0, F.substring(document, start, at + F.length(wanted) + around - start)).otherwise(F.substring(document, 1, otherwise))


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """{name} placeholders replaced one after the other; a null value is left as an empty string."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return template
