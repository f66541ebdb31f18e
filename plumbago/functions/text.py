"""Column functions on text: cleaning, labels, headings, links, codes and steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from plumbago import config

TRIM = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(text, TRIM, "")


def clean(text: Column, controls: str = r"[\x00-\x06\x08-\x0c\x0e-\x1f\x7f-\x9f]") -> Column:
    return strip(F.regexp_replace(text, controls, ""))


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, " {2,}", " "))


def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(F.lower(text), F.lit(p.lower())) for p in parts))


def word_hits(text: Column, words: list[str]) -> Column:
    """All full-word hits of any case, in their own case; longer words first."""
    escape = lambda w: "".join(c if c.isalnum() or c == "_" else "\\" + c for c in w)
    pattern = "|".join(escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))
    return F.regexp_extract_all(text, F.lit(rf"(?iu)(?<![A-Za-z0-9_])({pattern})(?![A-Za-z0-9_])"), 1)


def label_value(paragraphs: Column) -> Column:
    """(label, value) of a cell's paragraphs: split at the colon of a single paragraph, or the first one with a colon and all others."""
    labelled = F.get(F.filter(paragraphs, lambda p: F.contains(p, F.lit(":"))), F.lit(0))
    only = F.get(paragraphs, F.lit(0))
    pair = lambda label, value: F.struct(label.alias("label"), value.alias("value"))
    return (
        F.when(F.size(paragraphs) == 0, F.lit(None))
        .when(labelled.isNull(), pair(F.lit(""), F.array_join(paragraphs, " ")))
        .when(F.size(paragraphs) == 1, pair(strip(F.substring_index(only, ":", 1)), strip(only.substr(F.locate(":", only) + 1, F.length(only)))))
        .otherwise(pair(labelled, strip(F.array_join(F.array_remove(paragraphs, labelled), " "))))
    )


def is_placeholder(value: Column) -> Column:
    v = strip(value)
    return (v == "") | (v.startswith("(") & v.endswith(")") & v.rlike(config.HINT)) | v.rlike(config.PLACEHOLDER)


def is_caps_heading(text: Column) -> Column:
    t = strip(text)
    single = (F.size(F.split(t, r"\s+")) == 1) & (F.length(t) < 8)
    return t.rlike(config.CAPS_HEADING) & ~single & ~t.rlike(config.NOT_HEADING)


def is_section_heading(text: Column) -> Column:
    """Upper-case text without its page digits: no underscore, four letters, and a single word only if it is known or long."""
    t = strip(F.regexp_replace(strip(F.regexp_replace(text, r"^\d+", "")), r"\d+$", ""))
    letters = F.regexp_replace(t, r"[^\p{L}]", "")
    words = F.filter(F.split(t, r"\s+"), lambda w: w.rlike(r"^\p{L}+$"))
    one = F.get(words, F.lit(0))
    return (t != "") & ~F.contains(t, F.lit("_")) & (F.length(letters) >= 4) & (letters == F.upper(letters)) & ((F.size(words) != 1) | one.isin(*config.SINGLE_HEADINGS) | (F.length(one) > 8))


def urls(text: Column) -> Column:
    """Links of fields, then those in the text that follow no quote or word, each once in first-seen order; no schema names."""
    fields = F.regexp_extract_all(text, F.lit(r'(?i)\x13[^\x14\x15]*?HYPERLINK\s+"?(https?://[^"\s\x13\x14\x15\x07\r]+)'), 1)
    bare = F.regexp_extract_all(text, F.lit(r'(?<!["\w])(https?://[^\s\x07\x13\x14\x15\r"]{8,})'), 1)
    good = lambda u: u.startswith("http") & ~reduce(lambda a, b: a | b, (u.startswith(p) for p in config.NAMESPACE_URLS))
    return F.array_distinct(F.filter(F.transform(F.concat(fields, bare), lambda u: F.regexp_replace(u, "\"*'*$", "")), good))


def object_type(program: Column, extension: Column) -> Column:
    found = None
    for name, programs, extensions in config.OBJECT_TYPES:
        test = reduce(lambda a, b: a | b, (F.contains(program, F.lit(p)) for p in programs)) | extension.isin(*extensions)
        found = F.when(test, name) if found is None else found.when(test, name)
    bare = F.upper(F.regexp_replace(extension, r"^\.+", ""))
    return found.otherwise(F.when(bare == "", "Object").otherwise(bare))


def codes(text: Column, patterns: tuple[str, ...] = config.CODE_PATTERNS) -> Column:
    """Distinct transaction codes in order."""
    found = F.concat(*(F.regexp_extract_all(text, F.lit(p), 1) for p in patterns))
    upper = F.transform(found, lambda c: F.regexp_replace(F.replace(F.upper(c), F.lit("-"), F.lit("_")), "^T_CODE_", ""))
    return F.array_sort(F.array_distinct(F.filter(upper, lambda c: ~c.isin(*config.NO_CODES) & (F.length(c) >= 2) & c.rlike("^[A-Z][A-Z0-9_]+$"))))


def clean_step(text: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(text, r"\*+[^*]+\*+", ""), config.STEP_NOISE, "")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def expand_synonyms(text: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in config.SYNONYMS.items() for x in kv))
    return F.array_join(F.transform(F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != ""), lambda w: F.coalesce(F.element_at(table, w), w)), " ")


def column_letters(index: Column) -> Column:
    """0 is A, 25 Z, 26 AA, up to three letters."""
    letter = lambda i: F.char(F.lit(65) + F.pmod(i, F.lit(26)))
    return F.when(index < 26, letter(index)).when(index < 702, F.concat(letter(F.floor(index / 26) - 1), letter(index))).otherwise(F.concat(letter(F.floor((index - 26) / 676) - 1), letter(F.floor((index - 26) / 26)), letter(index)))


def decode_path(url: Column) -> Column:
    """Percent-decoded; a plus stays a plus."""
    return F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(F.element_at(F.split(F.split(path, r"[?#]")[0], "/"), -1), r"(\.[A-Za-z0-9]+)$", 1))
