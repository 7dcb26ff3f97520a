"""Normalisers held against records made up from their rules."""

import itertools
import unicodedata

import pytest
from pyspark.sql import functions as F

from kinspark.functions import forms, tables
from kinspark.functions import normalize as N
from kinspark.functions import text as T

#: One made-up record for each rule of names: (name, country, what is left).
NAMES = [
    ("Quorlex", "US", "quorlex"), ("QUORLEX  Tovin", None, "quorlex tovin"), (None, "US", ""), ("  ", "India", ""),
    ("Quorlex Inc.", "US", "quorlex incorporated"), ("Quorlex Corp", "US", "quorlex corporation"), ("Quorlex Co", "US", "quorlex company"), ("Quorlex & Tovin Co x", "US", "quorlex and tovin company x"),
    ("Quorlex L.L.C.", "US", "quorlex llc"), ("Quorlex LLP", "US", "quorlex llp"), ("Quorlex l.l.p", "US", "quorlex llp"),
    ("Quorlex s.a.r.l.", "France", "quorlex sarl"), ("Quorlex S.A.S", "France", "quorlex sas"), ("Quorlex SASU", "France", "quorlex sasu"), ("Quorlex s.c.i", "France", "quorlex sci"), ("Quorlex S.A", "France", "quorlex sa"),
    ("Quorlex Tovin Private", "India", "quorlex tovin private limited"), ("Quorlex Tovin Private", "France", "quorlex tovin private"),
    ("Tovin llc llc", "US", "tovin llc"), ("Tovin services services", "US", "tovin services"), ("Tovin tovin", "US", "tovin tovin"),
    ("Quorlex-Limited", "India", "quorlex limited"), ("Quorlex - 12345678", "US", "quorlex"), ("Quorlex - 123456", "US", "quorlex - 123456"),
    ("Mrs. Quorlex", "India", "quorlex"), ("Messrs Quorlex", "India", "quorlex"), ("quorlex.co.in", "India", "quorlex"), ("Quorlex.org", "US", "quorlex"),
    ("Quorlex | http://quorlex.net", "US", "quorlex"), ("Quorlex [Tovin] #4", "US", "quorlex tovin 4"), ("Čuørlèx Ñandú", "US", "cuørlex nandu"), ("Bœuf", "France", "boeuf"),
]
#: One for each rule of addresses.
ADDRESSES = [
    (None, "US", ""), ("", None, ""), ("9 Tovin nil, Q", None, "9 tovin , q"), ("9 Tovin Place", None, "9 tovin place"),
    ("9 Tovin-007", "US", "9 tovin-7"), ("Q-0042", "India", "q-42"), ("9, St. Thomas", "US", "9, saint thomas"), ("3rd Saint, Q", "US", "3rd street, q"),
    ("9 Tovin Saint", "India", "9 tovin street"), ("9 Tovin Saint", "France", "9 tovin saint"), ("9 Tovin Ct", "US", "9 tovin court"), ("9 To Ct", "US", "9 to ct"),
    ("First Lane, Second Place", None, "1st lane, 2nd place"), ("Third Q", None, "third q"), ("Unit unit 4, room Room 5", "US", "unit 4, room 5"),
    ("4 R des Q", None, "4 rue des q"), ("4 r Tovin", "France", "4 rue tovin"), ("4 r Tovin", "US", "4 r tovin"), ("ch du Q", None, "chemin du q"), ("2 ch Q", "France", "2 chemin q"),
    ("Iind Flr, 4 fl", None, "2nd floor, 4th floor"), ("g floor", None, "ground floor"), ("Bsmt Q", None, "basement q"), ("care of Q", None, "c/o q"), ("wo Q", None, "w/o q"), ("so 4", None, "so 4"),
    ("H.No 4", "India", "h no 4"), ("hn 4", None, "h no 4"), ("hn q", None, "hn q"), ("plot 4", None, "plot no 4"), ("doro no 4", None, "door no 4"), ("off no 4", None, "office no 4"), ("khasra no 4", None, "kh no 4"),
    ("P.O. Box # 44", None, "po box 44"), ("pmb-4", None, "pmb 4"), ("bussiness bay", None, "business bay"), ("co rd-4", None, "county road-4"),
    ("opp Q", None, "opposite q"), ("nr Q", None, "near q"), ("next   to Q", None, "next to q"),
]


def run(spark, rows, made):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, c string")
    return {r.i: r.x for r in df.select("i", made(F.col("t"), F.col("c")).alias("x")).collect()}


def test_names(spark):
    got = run(spark, [r[:2] for r in NAMES], N.normalize_name)
    assert [(r[0], got[i]) for i, r in enumerate(NAMES)] == [(r[0], r[2]) for r in NAMES]


def test_every_way_to_write_a_legal_form(spark):
    rows = []
    for first, second in (("pvt", "ltd"), ("Pvt.", "Ltd."), ("PRIVATE", "LTD"), ("Ltd.", "Pvt"), ("Limited", "Private"), ("P.", "Ltd"), ("pvt.", "limited"), ("(Private)", "[Limited]")):
        rows += [(f"Quorlex {first} {second}", "India"), (f"Quorlex, {first} {second}", "US")]
    got = run(spark, rows, N.normalize_name)
    assert set(got[i].replace(",", "") for i in got) == {"quorlex private limited"}


def test_indic_legal_forms(spark):
    said = [(w, m) for m, words in tables.INDIC_LEGAL.items() for w in words]
    got = run(spark, [(f"Quorlex {w}", "India") for w, _ in said], N.normalize_name)
    assert [got[i] for i in range(len(said))] == [f"quorlex {m}" for _, m in said]


def test_aliases(spark):
    rows = [(f"Tovin Hall {a}{sign} Quorlex", "US") for a in tables.ALIASES for sign in ("", ":", " -")] + [("Tovin aka ab", "US"), ("Tovinaka Quorlex", "US")]
    got = run(spark, rows, N.normalize_name)
    assert {got[i] for i in range(len(rows) - 2)} == {"quorlex"}
    assert got[len(rows) - 2] == "tovin aka ab" and got[len(rows) - 1] == "tovinaka quorlex"


def test_addresses(spark):
    got = run(spark, [r[:2] for r in ADDRESSES], N.normalize_address)
    assert [(r[0], got[i]) for i, r in enumerate(ADDRESSES)] == [(r[0], r[2]) for r in ADDRESSES]


def test_short_words(spark):
    table = tables.STREETS | tables.FRENCH_STREETS | tables.DIRECTIONS
    rows = [(f"5 Q {w}, R {w}", None) for w in table] + [(f"5 {w}q {w}-4", None) for w in table]
    got = run(spark, rows, N.normalize_address)
    assert [got[i] for i in range(len(table))] == [f"5 q {m}, r {m}" for m in table.values()]
    assert [got[len(table) + i] for i in range(len(table))] == [f"5 {w}q {w}-4" for w in table]


def test_states(spark):
    us, india = tables.US_STATES, tables.IN_STATES
    rows = [(f"5 Q, R, {n.title()}", "US") for n in us] + [(f"5 Q, R, {n.upper()} 4", "India") for n in india]
    rows += [(f"5 Q, {n}", "India") for n in tables.INDIC_STATES] + [("5 Texas Street, Utah", "US"), ("Near Goa Gate, Kerala", "India"), ("5 Ohio Q, CA", "US"), ("5 Texas, R", "France")]
    got = run(spark, rows, N.normalize_address)
    short = tables.DIRECTIONS | tables.STREETS | tables.FRENCH_STREETS  # a code that is a short word as well is spelt out
    want = [f"5 q, r, {short.get(c, c)}" for c in us.values()] + [f"5 q, r, {c} 4" for c in india.values()] + [f"5 q, {c}" for c in tables.INDIC_STATES.values()]
    assert [got[i] for i in range(len(want))] == want
    assert [got[len(want) + i] for i in range(4)] == ["5 texas street, ut", "near goa gate, kl", "5 ohio q, ca", "5 texas, r"]


def test_landmarks(spark):
    said = [(p, p) for p in tables.PREPOSITIONS] + [(s, p) for p, s in tables.PREPOSITIONS.items() if s] + [(s + ".", p) for p, s in tables.PREPOSITIONS.items() if s]
    rows = [(f"5, {w.title()} Tovin Hall, Q", "US") for w, _ in said] + [("5 Tovin", None), (None, None), ("Near Q", None), ("nr Tovin, opp. Quorlex", None)]
    got = run(spark, rows, lambda a, _: N.landmarks(a))
    assert [got[i] for i in range(len(said))] == [[f"{p} tovin hall"] for _, p in said]
    assert [got[len(said) + i] for i in range(4)] == [[], [], [], ["near tovin", "opposite quorlex"]]


def test_postal_codes(spark):
    rows = [
        ("5 Q, CA 12345", "US"), ("12345 Q, CA 54321-1234, R", "US"), ("5 Q 12345-6789 ", "US"), ("12345 Q", "US"), ("5 Q CAL 12345 R", "US"), ("Q, ca 12345, tx 54321", "US"),
        ("Q 400001", "India"), ("Pin: 400001, 500002", "India"), ("pin code 400001 R 500002", "India"), ("Plot No. 400001", "India"), ("phone 400001, 500002", "India"), ("Q 012345", "India"), ("300001 Q 400001", "India"),
        ("5 Q 75001 R 69001", "France"), ("00500 Q 99000", "France"), ("750011 Q", "France"), ("12345", None), (None, "US"),
    ]
    got = run(spark, rows, T.postal_code)
    assert [got[i] for i in range(len(rows))] == ["12345", "54321", "12345", "", "", "12345", "400001", "400001", "400001", "", "500002", "", "400001", "75001", "", "", "", ""]


def test_re2_rules_put_back_what_they_look_at():
    assert forms.re2([(r"\bst(?=\s|,|$)", "street"), (r"(\ba\s+)ct(?=\s|$)", "$1court"), (r"\bx\b", "y"), (r"\bso\b(?=\s+[a-z])", "s/o")]) == [
        (r"\bst(\s|,|$)", r"street\1"), (r"(\ba\s+)ct(\s|$)", r"\1court\2"), (r"\bx\b", "y"), (r"\bso(\s+[a-z])", r"s/o\1"),
    ]


def test_letters_are_spelt_as_the_table_is(spark):
    table = N.letters()
    assert len(table) == 253
    assert [table[c] for c in "खछषழசஙைং"] == ["kh", "ch", "sh", "zh", "s", "ng", "ai", "n"] and "ஂ" not in table and table["्"] == ""
    texts = ["तोविन क्वोर", "தோவின் ltd", "plain", "", "".join(table)]
    got = run(spark, [(t, None) for t in texts], lambda t, _: N.transliterate(t))
    assert [got[i] for i in range(len(texts))] == [t.translate(str.maketrans(table)) for t in texts]


def test_folds(spark):
    def plain(s):
        return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFKD", s) if not 0x300 <= ord(c) <= 0x36F))

    texts = ["Tovín ﬁn ½ quôrlex", "तोविन", "éa", "Σσ Ünï", "ab", ""]
    got = run(spark, [(t, None) for t in texts], lambda t, _: F.struct(N.strip_accents(t).alias("a"), N.fold(t).alias("f")))
    assert [got[i].a for i in range(len(texts))] == [plain(t) for t in texts]
    assert [got[i].f for i in (0, 2, 3, 4, 5)] == ["Tovin ﬁn ½ quorlex", "ea", "Σσ Uni", "ab", ""]
    away = run(spark, [(" ".join(x), None) for x in itertools.permutations(["sci", "quor", "eurl"])], lambda t, _: N.fold(t))
    assert set(away.values()) == {"quor"}


@pytest.mark.parametrize("name, want", [("तोविन Foods Ltd", ["tovin", "foods"]), ("The Quorlex of Tovin", ["quorlex", "tovin"])])
def test_tokens_are_transliterated(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(T.sig_tokens(N.transliterate(F.col("n"))).alias("t")).first().t == want
