"""Profiles of records: how often patterns occur, how text is cased, what normalising changed. Each is one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N

# The patterns of the profiles, by label. A pair holds the full and the short form.
SUFFIXES = {
    "Private Limited": r"\bprivate\s+limited\b", "Pvt Ltd": r"\bpvt\.?\s*ltd\.?\b", "Pvt. Limited": r"\bpvt\.?\s+limited\b", "Private Ltd": r"\bprivate\s+ltd\.?\b",
    "Limited": r"\blimited\b", "Ltd": r"\bltd\.?\b", "LLC": r"\bllc\b", "L.L.C": r"\bl\.l\.c\.?\b", "Inc": r"\binc\.?\b", "Incorporated": r"\bincorporated\b",
    "Corp": r"\bcorp\.?\b", "Corporation": r"\bcorporation\b", "Co": r"\bco\.?\b", "Company": r"\bcompany\b", "LLP": r"\bllp\b", "SARL": r"\bsarl\b", "SAS": r"\bsas\b",
    "SASU": r"\bsasu\b", "SCI": r"\bsci\b", "SA": r"\bsa\b", "S.A.": r"\bs\.a\.?\b", "S.A.S": r"\bs\.a\.s\.?\b", "PC": r"\bpc\b", "PLLC": r"\bpllc\b", "DBA": r"\bdba\b",
}
ADDRESS_FORMS = {
    "Street": (r"\bstreet\b", r"\bst\.?\b"), "Road": (r"\broad\b", r"\brd\.?\b"), "Avenue": (r"\bavenue\b", r"\bave\.?\b"), "Boulevard": (r"\bboulevard\b", r"\bblvd\.?\b"),
    "Drive": (r"\bdrive\b", r"\bdr\.?\b"), "Lane": (r"\blane\b", r"\bln\.?\b"), "Court": (r"\bcourt\b", r"\bct\.?\b"), "Circle": (r"\bcircle\b", r"\bcir\.?\b"),
    "Highway": (r"\bhighway\b", r"\bhwy\.?\b"), "Place": (r"\bplace\b", r"\bpl\.?\b"), "Floor": (r"\bfloor\b", r"\bfl\.?\b"), "Apartment": (r"\bapartment\b", r"\bapt\.?\b"),
    "Building": (r"\bbuilding\b", r"\bbldg\.?\b"), "Suite": (r"\bsuite\b", r"\bste\.?\b"), "Opposite": (r"\bopposite\b", r"\bopp\.?\b"), "Near": (r"\bnear\b", None),
    "Behind": (r"\bbehind\b", None), "Nagar": (r"\bnagar\b", None), "Colony": (r"\bcolony\b", None), "PO Box": (r"\bpo\s*box\b", None),
}
SIGNS = {
    "ampersand": "&", "and": r"\band\b", "hash": "#", "no": r"\bno\.?\s", "dot": r"\.", "hyphen": "-", "slash": "/", "parenthesis": "[()]", "bracket": r"[\[\]]", "angle": "[<>]",
    "accented": "[àáâãäåèéêëìíîïòóôõöùúûüýÿñçÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÝŸÑÇ]", "Devanagari": r"[\x{0900}-\x{097F}]", "Tamil": r"[\x{0B80}-\x{0BFF}]", "Kannada": r"[\x{0C80}-\x{0CFF}]",
    "Telugu": r"[\x{0C00}-\x{0C7F}]", "Bengali": r"[\x{0980}-\x{09FF}]", "Gujarati": r"[\x{0A80}-\x{0AFF}]", "Malayalam": r"[\x{0D00}-\x{0D7F}]",
}
LANDMARKS = {
    "Near": r"\bnear\b", "Opposite": r"\b(opp\.?|opposite)\b", "Behind": r"\bbehind\b", "Adjacent": r"\b(adjacent|adj\.?)\b", "Next to": r"\bnext\s+to\b", "In front of": r"\bin\s+front\s+of\b",
    "Beside": r"\bbeside\b", "ATM": r"\batm\b", "Hospital": r"\bhospital\b", "Temple": r"\b(temple|mandir|mandiar)\b", "School": r"\bschool\b", "Church": r"\bchurch\b",
    "Mosque": r"\b(mosque|masjid)\b", "Post Office": r"\bpost\s*office\b", "Police Station": r"\bpolice\s*station\b", "Bus Stand": r"\bbus\s*(stand|stop)\b", "Railway Station": r"\brailway\s*station\b",
}
#: Codes are matched in upper case only.
IN_STATES = {
    "Maharashtra": (r"\bmaharashtra\b", r"\bMH\b"), "Karnataka": (r"\bkarnataka\b", r"\bKA\b"), "Tamil Nadu": (r"\btamil\s*nadu\b", r"\bTN\b"), "Delhi": (r"\bdelhi\b", r"\bDL\b"),
    "Gujarat": (r"\bgujarat\b", r"\bGJ\b"), "Rajasthan": (r"\brajasthan\b", r"\bRJ\b"), "Uttar Pradesh": (r"\buttar\s*pradesh\b", r"\bUP\b"), "West Bengal": (r"\bwest\s*bengal\b", r"\bWB\b"),
    "Telangana": (r"\btelangana\b", r"\bTG\b"), "Andhra Pradesh": (r"\bandhra\s*pradesh\b", r"\bAP\b"), "Madhya Pradesh": (r"\bmadhya\s*pradesh\b", r"\bMP\b"), "Kerala": (r"\bkerala\b", r"\bKL\b"),
    "Haryana": (r"\bharyana\b", r"\bHR\b"), "Odisha": (r"\b(orissa|odisha)\b", None),
}
US_STATES = {
    "California": (r"\bcalifornia\b", r"\bCA\b"), "Texas": (r"\btexas\b", r"\bTX\b"), "New York": (r"\bnew\s*york\b", r"\bNY\b"), "Florida": (r"\bflorida\b", r"\bFL\b"),
    "North Carolina": (r"\bnorth\s*carolina\b", r"\bNC\b"), "Virginia": (r"\bvirginia\b", r"\bVA\b"), "Ohio": (r"\bohio\b", r"\bOH\b"), "Illinois": (r"\billinois\b", r"\bIL\b"),
    "Tennessee": (r"\btennessee\b", r"\bTN\b"), "Georgia": (r"\bgeorgia\b", r"\bGA\b"),
}
FRENCH = {
    "Rue": r"\brue\b", "Boulevard": r"\b(boulevard|bd\.?)\b", "Avenue": r"\b(avenue|av\.?)\b", "Allée": r"\ball[ée]e?\b", "Place": r"\bplace\b", "Impasse": r"\bimpasse\b", "Chemin": r"\bchemin\b",
    "Hauts-de-France": "hauts.de.france", "Nouvelle-Aquitaine": "nouvelle.aquitaine", "SARL": r"\bsarl\b", "SAS": r"\bs\.?a\.?s\.?\b", "SASU": r"\bsasu\b", "SCI": r"\bsci\b",
    "Accented": "[àâéèêëîïôùûüçÀÂÉÈÊËÎÏÔÙÛÜÇ]",
}
CITIES_FIRST = ["mumbai", "delhi", "kolkata", "chennai", "bangalore"]


def hits(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    made = N.java(pattern)
    return F.coalesce(text.rlike(made if ignore_case else made.replace("(?iud)", "(?d)")), F.lit(False))


def pattern_counts(df: DataFrame, columns: list[str], patterns: dict[str, str | tuple[str, str | None]], upper_short: bool = False, ignore_case: bool = True) -> DataFrame:
    """(label, n_full, n_short): in how many values of the columns a pattern occurs; n_short is null where there is no short form."""

    def total(pattern: str, ignore: bool) -> Column:
        return sum((F.count_if(hits(F.col(c), pattern, ignore)) for c in columns), F.lit(0).cast("long"))

    made = []
    for label, p in patterns.items():
        full, short = p if isinstance(p, tuple) else (p, None)
        n_short = total(short, not upper_short) if short else F.lit(None).cast("long")
        made.append(F.struct(F.lit(label).alias("label"), total(full, ignore_case).alias("n_full"), n_short.alias("n_short")))
    return df.agg(F.array(*made).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def titled(t: Column) -> Column:
    """Each run of letters with its first one upper and the others lower."""
    runs = F.regexp_extract_all(t, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def case_counts(df: DataFrame, column: str) -> DataFrame:
    """Values of over three characters in upper, lower and title case; mixed is what these counts leave of all values."""
    t = F.coalesce(F.col(column), F.lit(""))
    n = lambda same: F.count_if((t == same) & (F.length(t) > 3))
    c = df.agg(n(F.upper(t)).alias("upper"), n(F.lower(t)).alias("lower"), n(titled(t)).alias("title"), F.count("*").alias("n"))
    return c.withColumn("mixed", F.col("n") - F.col("upper") - F.col("lower") - F.col("title"))


def mixed_scripts(df: DataFrame, column: str) -> DataFrame:
    """Values with a Latin letter and one of Devanagari, Tamil or Kannada."""
    t = F.col(column)
    return df.where(t.rlike("[a-zA-Z]") & t.rlike(r"[\x{0900}-\x{097F}\x{0B80}-\x{0BFF}\x{0C80}-\x{0CFF}]"))


def address_order(df: DataFrame) -> DataFrame:
    """Addresses that begin with a US state's code (state-first), or with an Indian city before two more parts (city-first)."""
    a = F.coalesce(F.col("business_address"), F.lit(""))
    parts = F.split(a, ",")
    city = F.lower(F.get(parts, F.lit(0))).rlike("|".join(CITIES_FIRST)) & (F.size(parts) >= 3)
    kind = F.when((F.col("country") == "US") & a.rlike("^[A-Z]{2},"), "state-first").when((F.col("country") == "India") & city, "city-first")
    return df.withColumn("kind", kind).where("kind is not null")


def truth_profile(lists: DataFrame) -> DataFrame:
    """Of id lists (s1_id, ids): entities, singletons, those with ids of S2, S3 and both, mean and most ids."""
    has = lambda p: F.exists("ids", lambda x: F.startswith(x, F.lit(p)))
    n = F.size("ids")
    return lists.agg(
        F.count("*").alias("entities"), F.count_if(n == 0).alias("singletons"), F.count_if(has("S2-")).alias("with_s2"), F.count_if(has("S3-")).alias("with_s3"),
        F.count_if(has("S2-") & has("S3-")).alias("with_both"), F.round(F.avg(n), 6).alias("mean_ids"), F.max(n).cast("long").alias("most_ids"),
    )


def normalized_quality(clean: DataFrame) -> DataFrame:
    """Of records with name_clean and address_clean, by country: changed, empty, grown over twofold, destroyed, commas kept, with landmarks."""
    raw = {c: F.coalesce(F.col(c), F.lit("")) for c in ("business_name", "business_address")}
    commas = lambda c: F.sum(F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))).cast("long")
    return clean.groupBy("country").agg(
        F.count("*").alias("records"), F.count_if(F.lower(raw["business_name"]) != F.col("name_clean")).alias("names_changed"), F.count_if(F.col("name_clean") == "").alias("names_empty"),
        F.count_if(F.lower(raw["business_address"]) != F.col("address_clean")).alias("addresses_changed"), F.count_if(F.col("address_clean") == "").alias("addresses_empty"),
        F.count_if(F.length("name_clean") > 2 * F.greatest(F.length(raw["business_name"]), F.lit(1))).alias("names_grown"),
        F.count_if((raw["business_address"] != "") & (F.col("address_clean") == "")).alias("addresses_destroyed"), commas(raw["business_address"]).alias("commas"), commas(F.col("address_clean")).alias("commas_kept"),
        F.count_if((F.col("country") == "India") & (F.size(N.landmarks(F.col("business_address"))) > 0)).alias("with_landmarks"),
    )
