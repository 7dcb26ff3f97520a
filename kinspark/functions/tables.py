"""Fixed values of the name and address normalisers: what is written, what it means, and what must stand around it."""

from __future__ import annotations

from .forms import Form, Rule, doubled, one_of, rules, short_forms

# ------------------------------------------------------------------------ names
#: What stands before the name that is used.
ALIASES = ["dba", "d/b/a", "formerly known as", "formerly", "f/k/a", "fka", "a/k/a", "aka", "t/a"]
#: Ends of domains that are written as names.
DOMAINS = ["com", "org", "net", "in", "co.in"]
#: Legal words that follow a hyphen.
HYPHENATED = ["incorporated", "inc", "corporation", "corp", "llc", "limited", "ltd", "private", "pvt", "co", "company", "sarl", "sas"]
HONORIFICS = ["m/s", "messrs", "shri", "smt", "dr", "dr.", "mr", "mr.", "mrs", "mrs."]

#: Legal forms, in the order in which they are looked for.
LEGAL = [
    Form(("private limited",), "private limited"), Form(("limited private",), "private limited"), Form(("pvt limited",), "private limited"),
    Form(("pvt ltd",), "private limited"), Form(("ltd pvt",), "private limited"), Form(("private ltd",), "private limited"), Form(("p ltd",), "private limited"),
    Form(("ltd",), "limited"), Form(("pvt",), "private"), Form(("l.l.c",), "llc"), Form(("inc",), "incorporated"), Form(("corp",), "corporation"),
    Form(("co",), "company", "blank"), Form(("l.l.p",), "llp"), Form(("s.a.r.l",), "sarl"), Form(("s.a.s.u",), "sasu"), Form(("s.a.s",), "sas"),
    Form(("s.c.i",), "sci"), Form(("s.a",), "sa", "blank"),
]

#: Legal forms in Indic scripts, whole words, by what they mean; longer ones first.
INDIC_LEGAL = {
    "private limited": ["प्राइवेट लिमिटेड", "प्रा. लि.", "प्रा. लि", "ప్రైవేట్ లిమిటెడ్", "பிரைவேட் லிமிடெட்", "ಪ್ರೈವೇಟ್ ಲಿಮಿಟೆಡ್", "প্রাইভেট লিমিটেড", "પ્રાઇવેટ લિમિટેડ", "પ્રાઈવેટ લિમિટેડ"],
    "limited": ["लिमिटेड", "లిమిటెడ్", "லிமிடெட்", "ಲಿಮಿಟೆಡ್", "লিমিটেড", "લિમિટેડ"],
    "llp": ["एलएलपी", "எல்எல்பி", "ఎల్‌ఎల్‌పీ", "ఎల్ఎల్‌పి", "ಎಲ್‌ಎಲ್‌ಪಿ", "এলএলপি", "એલએલપી"],
}

#: Words of a name that collapse when doubled.
DOUBLED_NAME = "llc,incorporated,corporation,limited,private limited,private,group,services,holdings,enterprises,associates,solutions,industries,unit,vidyalaya".split(",")
#: French legal forms that the fold for scoring deletes.
FOLDED_AWAY = ["sarl", "sas", "sasu", "sa", "eurl", "sci", "snc", "earl", "gaec", "gie", "scop", "scic"]

# -------------------------------------------------------------------- addresses
#: Words that say that an address has no such part.
NO_VALUE = ["null", "n/a", "na", "none", "nil", "not applicable"]

#: Short words before a blank, a comma or the end.
STREETS = {
    "apt": "apartment", "ave": "avenue", "bldg": "building", "blvd": "boulevard", "cir": "circle", "hwy": "highway", "ln": "lane",
    "pkwy": "parkway", "rd": "road", "st": "street", "ste": "suite", "trl": "trail",
}
FRENCH_STREETS = {"all": "allee", "av": "avenue", "bd": "boulevard", "imp": "impasse", "rte": "route"}
DIRECTIONS = {"ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest"}
#: French letters for words of streets: before these articles everywhere, in France before any word.
FRENCH_LETTERS = {"r": "rue", "ch": "chemin", "av": "avenue"}
ARTICLES = ["de", "des", "du"]

#: Floors by how their number is written.
FLOORS = {"1st": ["1st", "first", "ist", "1"], "2nd": ["2nd", "second", "iind", "2"], "3rd": ["3rd", "third", "iiird", "3"], "4th": ["4th", "fourth", "ivth", "4"]}
FLOOR = ["flr", "floor", "fl"]
#: Parts of an address. Dots are gone by then.
PARTS = [
    Form(("ground floor", "gr floor", "g floor", "fl 0"), "ground floor", loose=True), Form(("bsmt",), "basement"),
    Form(("care of",), "c/o"), Form(("so",), "s/o", "letter"), Form(("wo",), "w/o", "letter"), Form(("do",), "d/o", "letter"),
    Form(("h no",), "h no", "start", True), Form(("hn",), "h no", "number"), Form(("plot no",), "plot no", "start", True), Form(("plot",), "plot no", "number"),
    Form(("door no", "doro no", "dor no", "d no", "d-no"), "door no", "start", True), Form(("flat no",), "flat no", "start", True), Form(("shop no",), "shop no", "start", True),
    Form(("office no", "off no"), "office no", "start", True), Form(("kh no", "khasra no"), "kh no", "start", True),
    Form(("p o box", "p o b"), "po box ", "sign", True), Form(("pmb",), "pmb ", "sign"),
    Form(("buisness", "bssiness", "bussiness"), "business"), Form(("townshiip",), "township"), Form(("ks city",), "kansas city"),
    Form(("county rd", "co rd"), "county road"), Form(("state rd",), "state road"),
]

ORDINALS = {"first": "1st", "second": "2nd", "third": "3rd", "fourth": "4th", "fifth": "5th", "sixth": "6th", "seventh": "7th", "eighth": "8th", "ninth": "9th", "tenth": "10th"}
STREET_WORDS = ["street", "avenue", "road", "drive", "lane", "boulevard", "court", "circle", "place"]
DOUBLED_ADDRESS = ["unit", "floor", "suite", "room", "block"]

#: Prepositions of landmarks and how else they are written (with or without a dot).
PREPOSITIONS = {"near": "nr", "opposite": "opp", "adjacent": "adj", "behind": None, "beside": None, "next to": None, "in front of": None}

# ------------------------------------------------------------- postal codes
#: What an Indian postal code may be called, and what other numbers of six digits are called.
POSTAL_LABELS = ["pin", "pincode", "pin code"]
OTHER_LABELS = ["plot no", "h no", "kh no", "khasra", "flat no", "survey", "sr no", "ph no", "mobile", "tel", "phone", "contact"]


# ------------------------------------------------------------ rules made of them
def alias() -> str:
    return rf"\b{one_of(ALIASES)}\b\s*[:\-]?\s*(.+)$"


def name_noise() -> list[Rule]:
    """What a name carries beside itself, before lower-casing: a link, a domain, a long number, a hyphen, an honorific."""
    host = r"[a-zA-Z0-9.-]+\.[a-zA-Z]{2,4}\b"
    return [
        (rf"\|\s*(?:www\.|https?://)?{host}", " "), (rf"\b([a-zA-Z0-9-]+)\.{one_of(DOMAINS)}\b", "$1"), (r"\s*[-–]\s*\d{7,12}\s*$", ""),
        (rf"-(?={one_of(HYPHENATED)}\b)", " "), (rf"^{one_of(HONORIFICS)}\s+", ""),
    ]


def legal() -> list[Rule]:
    return rules(LEGAL)


def indic_legal() -> list[Rule]:
    blank = lambda w: w.replace(". ", r"\.\s*").replace(" ", r"\s+")
    return [(rf"(?:^|\s+)(?:{'|'.join(map(blank, words))})(?:\s+|$)", f" {meaning} ") for meaning, words in INDIC_LEGAL.items()]


def floors() -> list[Rule]:
    return [(rf"\b{one_of(said)}\s*{one_of(FLOOR)}\b", f"{n} floor") for n, said in FLOORS.items()]


def court() -> list[Rule]:
    return [(r"(\b[a-zA-Z]{3,}\s+)ct(?=\s|,|$)", "$1court")]


def french_articles() -> list[Rule]:
    """Letters before an article, which for a road may be the begin of any word."""
    return rules([Form((f"r {a}",), f"rue {a}") for a in ARTICLES] + [Form((f"ch {a}",), f"chemin {a}", "start") for a in ARTICLES])


def french_letters() -> list[Rule]:
    return [(rf"\b{letter}\s+(?=[a-zA-Z])", f"{word} ") for letter, word in FRENCH_LETTERS.items()]


def ordinals() -> list[Rule]:
    return [(rf"\b{word}\s+(?={'|'.join(STREET_WORDS)})", f"{short} ") for word, short in ORDINALS.items()]


def prepositions() -> list[Rule]:
    return rules([Form((short,), full) for full, short in PREPOSITIONS.items() if short] + [Form((p,), p) for p in PREPOSITIONS if " " in p])


def address_words() -> list[Rule]:
    """Words of an address, spelt out, in order."""
    return [*short_forms(STREETS), *court(), *french_articles(), *short_forms(FRENCH_STREETS), *floors(), *rules(PARTS), *short_forms(DIRECTIONS), *ordinals(), doubled(DOUBLED_ADDRESS), *prepositions()]


def landmark() -> str:
    """A preposition (1) and what it is said of (2)."""
    said = "|".join([p.replace(" ", r"\s+") for p in PREPOSITIONS] + [rf"{s}\.?" for s in PREPOSITIONS.values() if s])
    return rf"\b({said})\s+([\w\s]{{3,40}}?)(?:,|$)"


# --------------------------------------------------------------------- states
#: States by name.
IN_STATES = {
    "andhra pradesh": "ap", "arunachal pradesh": "ar", "himachal pradesh": "hp", "jammu and kashmir": "jk", "madhya pradesh": "mp", "tamil nadu": "tn",
    "tamilnadu": "tn", "uttar pradesh": "up", "west bengal": "wb", "andaman and nicobar": "an", "dadra and nagar haveli": "dn", "daman and diu": "dd",
    "new delhi": "dl", "assam": "as", "bihar": "br", "chhattisgarh": "cg", "goa": "ga", "gujarat": "gj", "haryana": "hr", "jharkhand": "jh", "karnataka": "ka",
    "kerala": "kl", "maharashtra": "mh", "manipur": "mn", "meghalaya": "ml", "mizoram": "mz", "nagaland": "nl", "odisha": "od", "orissa": "od", "punjab": "pb",
    "rajasthan": "rj", "sikkim": "sk", "telangana": "tg", "tripura": "tr", "uttarakhand": "uk", "delhi": "dl", "chandigarh": "ch", "puducherry": "py",
    "pondicherry": "py", "ladakh": "la", "lakshadweep": "ld",
}
US_STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de",
    "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky",
    "louisiana": "la", "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo",
    "montana": "mt", "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny", "north carolina": "nc",
    "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri", "south carolina": "sc",
    "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv",
    "wisconsin": "wi", "wyoming": "wy", "district of columbia": "dc",
}
#: Indian states in Indic scripts, in this order.
INDIC_STATES = {
    "महाराष्ट्र": "mh", "दिल्ली": "dl", "दिल्‍ली": "dl", "गुजरात": "gj", "राजस्थान": "rj", "राजस्‍थान": "rj", "उत्तर प्रदेश": "up", "उत्‍तर प्रदेश": "up",
    "मध्य प्रदेश": "mp", "हरियाणा": "hr", "बिहार": "br", "झारखंड": "jh", "छत्तीसगढ़": "cg", "ओडिशा": "od", "पंजाब": "pb", "गोवा": "ga", "केरल": "kl",
    "तेलंगाना": "tg", "आंध्र प्रदेश": "ap", "पश्चिम बंगाल": "wb", "ಕರ್ನಾಟಕ": "ka", "தமிழ்நாடு": "tn", "ગુજરાત": "gj", "পশ্চিমবঙ্গ": "wb", "ఆంధ్రప్రదేశ్": "ap", "తెలంగాణ": "tg",
    "ਪੰਜਾਬ": "pb", "കേരളം": "kl",
}
#: What follows a state's name where it names a street or a place, and what stands before it at a landmark.
NO_STATE_BEFORE = """street st avenue ave road rd boulevard blvd drive dr lane ln way highway hwy court ct parkway pkwy place pl circle cir terrace trail trl
bank gate bhavan bhawan house tower towers building complex colony nagar school college hospital clinic temple church hall park square center centre""".split()
NO_STATE_AFTER = ["near", "nr", "opp", "opposite", "behind", "adjacent", "next to"]

#: Letters that are transliterated, by their Unicode names, script by script: initial vowels and their signs, then consonants without their A.
VOWELS = {"A": "a", "AA": "a", "I": "i", "II": "i", "U": "u", "UU": "u", "E": "e", "EE": "e", "AI": "ai", "O": "o", "OO": "o", "AU": "au"}
CONSONANTS = "K KH G GH C CH J JH TT TTH DD DDH NN T TH D DH N P PH B BH M Y R L V SH SS S H".split()
LETTERS = {
    "DEVANAGARI": CONSONANTS,
    "TELUGU": CONSONANTS,
    "TAMIL": "K NG C NY TT NN T N P M Y R L V LLL LL RR NNN".split(),
    "BENGALI": [c for c in CONSONANTS if c != "V"],
    "GUJARATI": CONSONANTS,
}
#: Consonants that are not written as their lower-case name (without the doubling that marks retroflexes).
SPELT = {"C": "ch", "SS": "sh", "LLL": "zh"}
SPELT_TAMIL = {"C": "s"}
