"""Normalisers of names and addresses. All is built-in expressions but the folding of accents, for which
Spark has no function: that is one Arrow column, free for ASCII text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import forms
from . import tables as R
from . import text as T
from . import words as W

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def java(pattern: str) -> str:
    """A rule's pattern for Java: edges, blanks and digits of Unicode, `.` all but a new line, case ignored."""
    pattern = pattern.replace(r"[\w\s]", f"[{WORD}{SPACE}]")
    # before a letter, an edge is just the absence of a word character
    pattern = re.sub(r"\\b(?=[a-z0-9]|\((?:\?:)?[a-z0-9])", lambda _: rf"(?<![{WORD}])", pattern)
    return "(?iud)" + pattern.replace(r"\b", EDGE).replace(r"\s", f"[{SPACE}]").replace(r"\d", r"\p{Nd}")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rewrite(t: Column, listed: list[tuple[str, str]]) -> Column:
    for pattern, by in listed:
        t = F.regexp_replace(t, java(pattern), by)
    return t


def squeeze(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, f"[{SPACE}]+", " "))


# ------------------------------------------------------------------- accents
def _without_diacritics(s: str) -> str:
    parts = unicodedata.normalize("NFKD", s)
    return unicodedata.normalize("NFC", re.sub("[\u0300-\u036f]", "", parts))


def _without_marks(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def _arrow(f: Callable[[str], str], t: Column) -> Column:
    from pyspark.sql.pandas.functions import arrow_udf
    from pyspark.sql.types import StringType

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([s if s is None or s.isascii() else f(s) for s in batch.to_pylist()], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(run, StringType())(t)


def strip_accents(t: Column) -> Column:
    """Latin diacritics go, compatible forms are folded; marks of other scripts stay. Null stays null."""
    return _arrow(_without_diacritics, t)


def fold(t: Column) -> Column:
    """The fold before scoring: all non-spacing marks go, and French legal forms as whole words; null is empty."""
    bare = _arrow(_without_marks, F.coalesce(t, F.lit("")))
    return squeeze(F.regexp_replace(bare, java(rf"\b{forms.one_of(R.FOLDED_AWAY)}\b").replace("(?iud)", ""), ""))


def _lower(t: Column) -> Column:
    return strip_accents(F.replace(F.replace(F.lower(t), F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae")))


# --------------------------------------------------------- transliteration
def letters() -> dict[str, str]:
    """Latin spelling of each Indic letter, from its Unicode name."""
    out: dict[str, str] = {}
    for script, consonants in R.LETTERS.items():
        spelt = R.SPELT | (R.SPELT_TAMIL if script == "TAMIL" else {})
        named = {f"LETTER {c}A": spelt.get(c, re.sub(r"(.)\1+", r"\1", c.lower())) for c in consonants}
        named |= {f"LETTER {v}": s for v, s in R.VOWELS.items()} | {f"VOWEL SIGN {v}": s for v, s in R.VOWELS.items()}
        named |= {"SIGN VIRAMA": ""} | ({"SIGN ANUSVARA": "n"} if script != "TAMIL" else {})
        for name, spelling in named.items():
            try:
                out[unicodedata.lookup(f"{script} {name}")] = spelling
            except KeyError:
                continue  # the script has no such letter
    return out


def transliterate(t: Column) -> Column:
    """Indic letters spelt in Latin ones; text without any is left alone. Null stays null."""
    table = letters()
    groups: dict[str, str] = {}
    for c, s in table.items():
        groups[s] = groups.get(s, "") + c
    several = [(chars, s) for s, chars in groups.items() if len(s) > 1]
    singles = [(c, s) for s, chars in groups.items() if len(s) == 1 for c in chars]
    out = t
    for chars, s in several:
        out = F.regexp_replace(out, "[" + "".join(rf"\x{{{ord(c):x}}}" for c in chars) + "]", s)
    out = F.translate(out, "".join(c for c, _ in singles) + groups[""], "".join(s for _, s in singles))
    return F.when(t.rlike(r"[\x{900}-\x{c7f}]"), out).otherwise(t)


# --------------------------------------------------------------------- names
def normalize_name(name: Column, country: Column) -> Column:
    """A business name in lower case, without accents, signs and noise, its legal form spelt out; null is empty."""
    raw = F.coalesce(name, F.lit(""))
    tail = squeeze_ends(F.regexp_extract(raw, java(R.alias()), 1))
    t = rewrite(F.when(F.length(tail) >= 3, tail).otherwise(raw), R.name_noise())
    t = rewrite(T.clean_punct(_lower(t)), [*R.legal(), *R.indic_legal(), *[forms.doubled([w]) for w in R.DOUBLED_NAME]])
    t = let(t, lambda v: F.when(country == "India", F.regexp_replace(v, java(r"\bprivate\b$"), "private limited")).otherwise(v))
    return squeeze(T.clean_dots(t))


def squeeze_ends(t: Column) -> Column:
    return F.regexp_replace(t, f"^[{SPACE}]+|[{SPACE}]+\\z", "")


# ----------------------------------------------------------------- addresses
def _state_in(segment: Column, states: dict[str, str]) -> Column:
    """The segment with the first state's name that counts as one written as its code, else null. States are tried
    longest first; of each only its first occurrence, which must not name a street or stand at a landmark."""
    after = rf"(?!\s*(?:{'|'.join(R.NO_STATE_BEFORE)})\b)"
    before = "".join(rf"(?<!(?<![{WORD}]){w}\s{{0,3}})" for w in R.NO_STATE_AFTER)
    tried = []
    for name in sorted(states, key=lambda n: -len(n)):
        hit = rf"\b{name}\b"
        pattern = java(rf"^((?:(?!{hit}).)*){before}{hit}{after}")
        tried.append(F.when(segment.rlike(pattern), F.regexp_replace(segment, pattern, f"$1{states[name]}")))
    named = java(rf"\b(?:{'|'.join(states)})\b")
    return F.when(segment.rlike(named), F.coalesce(*tried))


def _state_by_segment(t: Column, states: dict[str, str]) -> Column:
    segments = F.transform(F.split(t, ","), lambda s: squeeze_ends(s))

    def pick(parts: Column) -> Column:
        n = F.size(parts)
        last = F.element_at(parts, -1)
        bare = F.lower(F.regexp_replace(last, java(r"\s+\d+(?:-\d+)?$"), ""))
        # the last segment, the one before it, then from the first on
        order = F.concat(F.array(n - 1), F.when(n >= 2, F.array(n - 2)).otherwise(F.array().cast("array<int>")), F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")))
        joined = lambda made: F.array_join(made, ", ")
        found = let(
            F.transform(parts, lambda s: _state_in(s, states)),
            lambda made: let(F.get(F.filter(order, lambda i: F.get(made, i).isNotNull()), F.lit(0)), lambda at: joined(F.transform(parts, lambda s, i: F.when(i == at, F.get(made, i)).otherwise(s)))),
        )
        whole = F.when(bare.isin(sorted(set(states.values()))), t)
        if states is R.US_STATES:
            whole = whole.when(bare == "district of columbia", joined(F.concat(F.slice(parts, 1, n - 1), F.array(F.lit("dc")))))
        return F.coalesce(whole, F.when(t.rlike(java(rf"\b(?:{'|'.join(states)})\b")), found), t)

    return let(segments, pick)


def _first_contained(t: Column, table: dict[str, str], names: list[str]) -> Column:
    return F.coalesce(*[F.when(F.contains(t, F.lit(n)), F.replace(t, F.lit(n), F.lit(table[n]))) for n in names])


def normalize_state(t: Column, country: Column) -> Column:
    """State names of a clean address as codes, French regions in their plain spelling; other countries as they are."""
    regions = sorted(W.FR_REGIONS, key=lambda r: -len(r))
    spelt = {r: W.FR_CODES.get(r, r) for r in regions}

    def pick(v: Column) -> Column:
        indic = F.when(v.rlike(r"[\x{900}-\x{d7f}]"), _first_contained(v, R.INDIC_STATES, list(R.INDIC_STATES)))
        return (
            F.when(country == "India", F.coalesce(indic, _state_by_segment(v, R.IN_STATES))).when(country == "US", _state_by_segment(v, R.US_STATES))
            .when(country == "France", F.coalesce(_first_contained(v, spelt, regions), v)).otherwise(v)
        )

    return let(t, pick)


def normalize_address(address: Column, country: Column) -> Column:
    """An address in lower case, without accents and signs but commas, its words spelt out and its state as a code; null is empty."""
    t = rewrite(_lower(F.coalesce(address, F.lit(""))), [(rf"\b{forms.one_of(R.NO_VALUE)}\b", "")])
    t = F.regexp_replace(T.clean_punct(t), r"([a-zA-Z]-)0+(\p{Nd}+)", "$1$2")
    t = normalize_state(T.clean_dots(t), country)
    # a saint after a number, or last in its part, is a street
    t = T.expand_saints(rewrite(t, [(r"\b(\d+(?:st|nd|rd|th))\s+saint\b", "$1 street")]))
    street = [(r"(\b[a-zA-Z]{3,}\s+)saint(?=\s*,|\s*$)", "$1street")]
    t = let(t, lambda v: F.when(country.isin("US", "India"), rewrite(v, street)).when(country == "France", rewrite(v, R.french_letters())).otherwise(v))
    return squeeze(rewrite(t, R.address_words()))


def landmarks(address: Column) -> Column:
    """What an address says to be near, opposite and so on, in order, as `near x`; null has none."""
    low = F.lower(F.coalesce(address, F.lit("")))
    group = lambda n: F.regexp_extract_all(low, F.lit(java(R.landmark())), F.lit(n))
    full = {short: p for p, short in R.PREPOSITIONS.items() if short}
    prep = F.transform(group(1), lambda p: F.coalesce(*[F.when(F.rtrim(p, F.lit(".")) == a, to) for a, to in full.items()], p))
    said = F.zip_with(prep, F.transform(group(2), squeeze_ends), lambda p, d: F.when(d != "", F.concat_ws(" ", p, d)))
    return F.array_compact(said)


def with_clean(records, country: str = "country"):
    """records with name_clean and address_clean."""
    return records.withColumns({"name_clean": normalize_name(F.col("business_name"), F.col(country)), "address_clean": normalize_address(F.col("business_address"), F.col(country))})
