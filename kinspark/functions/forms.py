"""Written forms of names and addresses, and the patterns that find them.

A form says how something is written, what it means, and what must stand around it. Patterns
are made from forms: words are parted by blanks; an abbreviation may end with a dot, and two
of them may stand without a blank; letters joined by dots may go without these. Patterns use
`\\b`, `\\s` and `\\d` in their Unicode sense, which `normalize.java` spells out.
"""

from __future__ import annotations

import re
from typing import NamedTuple

Rule = tuple[str, str]


class Form(NamedTuple):
    written: tuple[str, ...]
    meaning: str
    #: A key of AROUND.
    where: str = "word"
    #: Blanks between words may be missing.
    loose: bool = False


#: What stands after a form; before it, there is always an edge.
AROUND = {
    "word": r"\b",  # an edge
    "start": "",  # anything
    "blank": r"\b(?=\s|$)",  # a blank or the end
    "part": r"(?=\s|,|$)",  # a blank, a comma or the end
    "number": r"\b(?=\s*\d)",  # a number
    "letter": r"\b(?=\s+[a-z])",  # another word
    "sign": r"\s*[-:#]?\s*",  # a sign of numbering, which goes with it
}
# Abbreviations, by the dot that may end them.
ABBREVIATED = {"pvt", "ltd", "p", "inc", "corp", "co"}


def one_of(words: list[str] | tuple[str, ...]) -> str:
    """Any of the words, longer ones first; blanks within them are any blanks."""
    ordered = sorted(words, key=lambda w: (-len(w), w))
    return "(?:" + "|".join(re.escape(w).replace(r"\ ", r"\s+") for w in ordered) + ")"


def body(written: str, loose: bool = False) -> str:
    """The pattern of a form's words."""
    words = written.split(" ")
    out = ""
    for i, w in enumerate(words):
        if i:
            short = words[i - 1] in ABBREVIATED and w in ABBREVIATED
            out += r"\s*" if loose or short or words[i - 1].endswith(".") else r"\s+"
        if re.fullmatch(r"[a-z](\.[a-z])+", w):
            out += r"\.?".join(w.split(".")) + r"\.?"
        else:
            out += re.escape(w) + (r"\.?" if w in ABBREVIATED else "")
    return out


def rule(form: Form) -> Rule:
    """A form as a pattern and what replaces it."""
    each = "|".join(body(w, form.loose) for w in form.written)
    return rf"\b(?:{each}){AROUND[form.where]}" if len(form.written) > 1 else rf"\b{each}{AROUND[form.where]}", form.meaning


def rules(forms: list[Form]) -> list[Rule]:
    return [rule(f) for f in forms]


def short_forms(table: dict[str, str]) -> list[Rule]:
    """Short words before a blank, a comma or the end."""
    return rules([Form((short,), full, "part") for short, full in table.items()])


def doubled(words: list[str]) -> Rule:
    """A word, of those given, that stands twice."""
    return rf"\b({'|'.join(w.replace(' ', r'\s') for w in words)})\s+\1\b", "$1"


def re2(listed: list[Rule]) -> list[Rule]:
    """Rules for an engine without a look ahead: what a rule only looks at is captured and put back."""
    out = []
    for pattern, by in listed:
        by = re.sub(r"\$(\d)", r"\\\1", by)
        if m := re.search(r"\(\?=(.*)\)$", pattern):
            groups = len(re.findall(r"(?<!\\)\((?!\?)", pattern[: m.start()]))
            pattern, by = pattern[: m.start()].removesuffix(r"\b") + f"({m[1]})", f"{by}\\{groups + 1}"
        out.append((pattern, by))
    return out
