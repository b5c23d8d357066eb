"""Column functions for curating text, date and number fields.

All are plain expressions on columns, so a whole curation runs as one projection.  Nulls stay null unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


# -- names and free text ------------------------------------------------------------------------------------------

def normalise_string(col: Column) -> Column:
    """Trim and turn runs of white space into one space."""
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def titlecase(col: Column, articles: Sequence[str] = (), abbreviations: Sequence[str] = ()) -> Column:
    """Capitalise words between spaces and hyphens; articles stay lower (but first), abbreviations upper."""
    words = F.split(F.regexp_replace(F.lower(col), r"([ \-])", "$1\u0001"), "\u0001")

    def one(word: Column, i: Column) -> Column:
        bare = F.regexp_replace(word, r"[ \-]+$", "")
        out = F.initcap(word)
        if articles:
            out = F.when(bare.isin(*[a.lower() for a in articles]) & (i > 0), word).otherwise(out)
        if abbreviations:
            out = F.when(bare.isin(*[a.lower() for a in abbreviations]), F.upper(word)).otherwise(out)
        return out

    return F.array_join(F.transform(words, one), "")


def abbreviate_authors(col: Column, default: str = "?") -> Column:
    """First author and ``et al.``; one author alone stays; null or blank gives the default."""
    names = F.split(F.trim(col), r"\s*[;,]\s*")
    return F.when(F.trim(F.coalesce(col, F.lit(""))) == "", F.lit(default)).when(F.size(names) > 1, F.concat(names[0], F.lit(" et al."))).otherwise(F.trim(col))


#: Ordered patterns of passage histories and their categories.
PASSAGE_PATTERNS = [
    (r"AM[1-9]|E[1-9]|AMNIOTIC|EGG|EX|AM_[1-9]", "egg"),
    (r"AM-[1-9]|EMBRYO|^E$", "egg"),
    (r"LUNG|P0|OR_|ORIGINAL|CLINICAL|DIRECT", "unpassaged"),
    (r"ORGINAL|ORIGNAL|CLINCAL|THROAT|PRIMARY|NASO|AUTOPSY|BRONCHIAL|INITIAL|NASAL|NOSE|ORIG|SWAB|NO PASSAGE", "unpassaged"),
    (r"TMK|RMK|RHMK|RII|PMK|R[1-9]|RX|RHESUS", "cell"),
    (r"S[1-9]|SX|SIAT|MDCK|MDCK[1-9]|C[1-9]|CX|M[1-9]|MX|X[1-9]|HCK|^X_$", "cell"),
    (r"C_[1-9]|C [1-9]|MD[1-9]|MK[1-9]|MEK[1-9]", "cell"),
    (r"CELL", "cell"),
    (r"^S[1-9]_$| ^SX_$|SIAT2_SIAT1|SIAT3_SIAT1", "cell"),
]


def first_pattern(col: Column, patterns: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first pattern that a text contains."""
    return reduce(lambda rest, p: F.when(col.rlike(p[0]), F.lit(p[1])).otherwise(rest), reversed(list(patterns)), F.lit(default))


def passage_category(col: Column) -> Column:
    """egg, unpassaged, cell or undetermined, by the first pattern found in the upper-cased history."""
    return first_pattern(F.upper(col), PASSAGE_PATTERNS, "undetermined")


def lineage_match(col: Column, patterns: Sequence[str]) -> Column:
    """Whether a subtype fits any pattern, ignoring case.

    ``H5Nx``: any value whose H number is 5; ``H5``: that without an N; ``HxN3``: any value whose N number is 3; ``N2``:
    that without an H; anything else: equality.
    """
    value = F.upper(col)
    h = F.regexp_extract(value, r"^H(\d+)", 1)
    n = F.regexp_extract(value, r"N(\d+)", 1)

    def one(pattern: str) -> Column:
        p = pattern.upper()
        if p.startswith("HXN") and p[3:].isdigit():
            return n == p[3:]
        if p.startswith("H") and p.endswith("NX") and p[1:-2].isdigit():
            return h == p[1:-2]
        if p.startswith("H") and p[1:].isdigit():
            return (h == p[1:]) & ~F.contains(value, F.lit("N"))
        if p.startswith("N") and p[1:].isdigit():
            return (n == p[1:]) & ~F.contains(value, F.lit("H"))
        return value == p

    return reduce(lambda a, b: a | b, [one(p) for p in patterns], F.lit(False))


#: Beginnings of notes that name a lineage.
NOTE_PATTERNS = [
    (r"(?i)^(?:H1N1pdm09$|lineage: A\(H1N1\)pdm09|Influenza A\(H1N1\) pandemic)", "pdm09"),
    (r"(?i)^(?:Victoria$|B/Vic|type: Vic|Victoria lineage|lineage: Victoria)", "victoria"),
    (r"(?i)^(?:Yamagata$|B/Yam|type: Yam|Yamagata lineage|lineage: Yamagata)", "yamagata"),
]


def lineage_from_note(col: Column) -> Column:
    return first_pattern(F.trim(col), NOTE_PATTERNS, "")


def combine_age(age: Column, unit: Column, default_unit: str = "y") -> Column:
    """Integer age and lower-cased unit; anything that isn't an integer gives ``?``."""
    number = F.trim(age).try_cast("int")
    kind = F.when(F.trim(F.coalesce(unit, F.lit(""))) == "", F.lit(default_unit)).otherwise(F.lower(F.trim(unit)))
    return F.when(number.isNull(), F.lit("?")).otherwise(F.concat(number.cast("string"), kind))


def age_in_years(col: Column) -> Column:
    """``12y`` as 12.0, ``6m`` as 0.5; anything else null."""
    number = F.regexp_extract(col, r"^(\d+)[ym]$", 1).try_cast("double")
    return F.when(col.rlike("y$"), number).when(col.rlike("m$"), number / 12)


def standardise_gender(col: Column) -> Column:
    """Lower case; null or empty gives ``?``."""
    return F.when(F.trim(F.coalesce(col, F.lit(""))) == "", F.lit("?")).otherwise(F.lower(F.trim(col)))


def flag_substring(col: Column, pattern: str) -> Column:
    """``True`` or ``False`` as text: whether the value contains the pattern (null: False)."""
    return F.when(F.contains(F.coalesce(col, F.lit("")), F.lit(pattern)), F.lit("True")).otherwise(F.lit("False"))


def split_location(col: Column, names: Sequence[str] = ("region", "country", "division", "location")) -> Column:
    """A struct of the slash-separated parts, trimmed; missing ones are empty."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), "/"), lambda x: F.trim(x))
    return F.struct(*[F.coalesce(F.get(parts, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])


def append_strain_location(parts: Column, strain: Column, least: int = 4) -> Column:
    """Append the place in a name (its second part) to fewer than ``least`` parts unless one of them contains it."""
    place = F.get(F.split(strain, "/"), F.lit(1))
    known = F.exists(parts, lambda x: F.contains(F.lower(x), F.lower(place)))
    return F.when((F.size(parts) < least) & place.isNotNull() & (place != "") & ~known, F.array_append(parts, place)).otherwise(parts)


def drop_numeric_parts(parts: Column) -> Column:
    """The parts without any digit."""
    return F.filter(parts, lambda x: ~x.rlike("[0-9]"))


def split_division(division: Column, location: Column) -> Column:
    """``a, b`` as division a with location b where there is none yet."""
    first, rest = F.trim(F.substring_index(division, ",", 1)), F.trim(F.regexp_replace(division, "^[^,]*,", ""))
    has = F.contains(division, F.lit(","))
    empty = F.coalesce(location, F.lit("")) == ""
    return F.struct(F.when(has, first).otherwise(division).alias("division"), F.when(has & empty, rest).otherwise(location).alias("location"))


def strip_invalid(col: Column, charset: str = r"A-Za-z0-9_.\-/") -> Column:
    """The value without characters outside the set; what becomes empty is for the caller to reject."""
    return F.regexp_replace(col, f"[^{charset}]", "")


def apply_rewrites(col: Column, rules: Sequence[tuple[str, str]], when: Column | None = None) -> Column:
    """Ordered regular-expression rewrites; with ``when``, only where it holds."""
    out = reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, col)
    return out if when is None else F.when(when, out).otherwise(col)


def replace_substrings(col: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, col)


#: Texts removed from names, in order, and their replacements.
NAME_LITERALS = [
    ("H1N1", ""), ("H5N6", ""), ("H3N2", ""), ("Human", ""), ("human", ""), ("//", "/"), (".", ""), (",", ""), ("&", ""),
    (" ", ""), ("'", ""), (">", ""), ("-like", ""), ("+", ""), ("(Mixed)", "/Mixed"), ("/H7N9/", "/"),
]
#: Rewrites of seasonal names, in order; applied to a whole name from its start.
SEASONAL_REWRITES = [
    (r"^(A/HongKong/H090-[0-9]{3}-V[0-9])$", "$1/2009"),
    (r"^([A|B]/)NorthAmerica/Canada/(NewBrunswick/[^/]+/[0-9]{4}).*$", "$1$2"),
    (r"^([A|B]/[^/]+/)UAE/([^/]+/[0-9]{4}).*$", "$1$2"),
    (r"^([A|B]/[^/]+/)CRIE/([^/]+/[0-9]{4}).*$", "$1$2"),
    (r"^([A|B]/Uganda/UVRI_[^/^_]+)_(2024).*$", "$1/$2"),
    (r"^([A|B]/)LA(/EVTL-[^/]+/[0-9]{4}).*$", "$1Louisiana$2"),
    (r"^([A|B]/)Unknown(/DE-DHSS-[^/]+/[0-9]{4}).*$", "$1UnitedStates$2"),
    (r"^([A|B]/)NJ(/DE-DHSS-[^/]+/[0-9]{4}).*$", "$1NewJersey$2"),
    (r"^([A|B]/)FL(/DE-DHSS-[^/]+/[0-9]{4}).*$", "$1Florida$2"),
    (r"^([A|B]/)AL(/DE-DHSS-[^/]+/[0-9]{4}).*$", "$1Alabama$2"),
    (r"^([A|B]/Lyon/)CHU/([^/]+/[0-9]{4}).*$", "$1$2"),
    (r"^([A|B]/)([0-9]*/)Hungary/([0-9]{4}).*$", "$1Hungary/$2$3"),
    (r"^(A/Sendai/TU[0-9]{2}.*)$", "$1/2010"),
    (r"^([A|B]/)clinicalisolate(SA[0-9]+)([^/]+)(/[0-9]{4}).*$", "$1$3/$2$4"),
    (r"^([1-2]+)IRL([0-9]+)$", "A/Ireland/$2/20$1"),
    (r"^([\w\s\-/]+)(\(?)(B/Victoria/2/87|B/Victoria/2/1987)$", "$1"),
    (r"^([A|B]/[^0-9/]+)([0-9]+[A-Za-z]*/[0-9/]*[0-9]{2,4})$", "$1/$2"),
    (r"^([A|B]/[A-Za-z-]+/[A-Za-z0-9_-]+/[0-9]{4}).+$", "$1"),
]


def expand_year(col: Column, pivot: int = 66) -> Column:
    """A name ending in a two-digit year gets the century: under the pivot 20, else 19."""
    year = F.regexp_extract(col, r"^[\w\s\-/]+/([0-9][0-9])$", 1)
    century = F.when(year.try_cast("int") < pivot, F.lit("20")).otherwise(F.lit("19"))
    return F.when(year == "", col).otherwise(F.concat(F.regexp_replace(col, r"[0-9][0-9]$", ""), century, year))


def python_title(col: Column) -> Column:
    """Upper case after every character that isn't a letter, lower case after a letter."""
    parts = F.split(F.regexp_replace(F.lower(col), r"([^a-z])", "$1\u0001"), "\u0001")
    return F.array_join(F.transform(parts, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1_000_000))), "")


def tidy_four_part(col: Column) -> Column:
    """In names of four parts: a place in one case gets title case, and parts 3 and 4 lose leading zeros."""
    p = F.split(col, "/")
    place = F.get(p, F.lit(1))
    single = (place.rlike("[A-Za-z]")) & ((F.upper(place) == place) | (F.lower(place) == place))
    tidy = F.concat_ws("/", F.get(p, F.lit(0)), F.when(single, python_title(place)).otherwise(place), F.ltrim(F.get(p, F.lit(2)), F.lit("0")), F.ltrim(F.get(p, F.lit(3)), F.lit("0")))
    return F.when(F.size(p) == 4, tidy).otherwise(col)


def fix_name(col: Column, seasonal: Column, part_fixes: Column | None = None) -> Column:
    """Repair a strain name: accents, subtype around the name, literals, edges, parts by lookup, rewrites, year, case.

    ``part_fixes`` is a map column from a part without spaces in lower case to its spelling.
    """
    name = F.regexp_replace(col, r"[^\x00-\x7F]", "?")
    name = F.regexp_replace(name, r"^(?:H1N1|H3N2)/([^/]+/[^/]+/[0-9]{4}).*$", "A/$1")
    name = F.regexp_replace(name, r"^(.+)\(?H\dN\d\)?$", "$1")
    name = replace_substrings(name, NAME_LITERALS)
    for edge in ("-", "_", ")", "("):
        name = F.ltrim(name, F.lit(edge))
    name = F.ltrim(name, F.lit("-"))
    for edge in ("_", ")", "("):
        name = F.rtrim(name, F.lit(edge))
    name = F.when(seasonal, name).otherwise(F.replace(name, F.lit("_"), F.lit("")))
    if part_fixes is not None:
        name = fix_name_parts(name, part_fixes)
    # A name in lower case ends where its letters, digits, spaces, dashes and slashes do.
    lower = r"^[ab|]([\w\s\-/]+)"
    name = F.when(name.rlike(lower), F.concat(F.upper(F.substring(name, 1, 1)), F.regexp_extract(name, lower, 1))).otherwise(name)
    name = F.regexp_replace(name, r"^([^(]+)[^)]+\)(.+)$", "$1$2")
    name = F.regexp_replace(name, r"^([^(]+)[^)]+\)$", "$1")
    name = apply_rewrites(name, SEASONAL_REWRITES, seasonal)
    return F.trim(tidy_four_part(expand_year(F.rtrim(name, F.lit("/")))))


def fix_name_parts(col: Column, fixes: Column) -> Column:
    """Each slash-separated part replaced by its entry in a map column, if it has one."""
    return F.array_join(F.transform(F.split(col, "/"), lambda x: F.coalesce(F.try_element_at(fixes, F.lower(F.replace(x, F.lit(" "), F.lit("")))), x)), "/")


def finalise_strain(col: Column, passage: Column, kind: Column, seasonal: Column, suffix: str = "-egg") -> Column:
    """Egg suffix for seasonal egg passages, and the type's letter in front where the name has another."""
    name = F.when(seasonal & (passage == "egg"), F.concat(col, F.lit(suffix))).otherwise(col)
    first = F.substring_index(name, "/", 1)
    wrong = F.contains(name, F.lit("/")) & F.lower(kind).isin("a", "b", "c", "d") & (F.lower(first) != F.lower(kind))
    return F.when(wrong, F.concat(F.upper(kind), F.substr(name, F.length(first) + 1))).otherwise(name)


#: Marks that simplified names lose.
PUNCTUATION = "/_(),- ;."


def simplify_name(col: Column) -> Column:
    """Lower case, no zeros at the start of numbers after a slash, no punctuation."""
    return F.translate(F.regexp_replace(F.lower(col), r"/0+(\d)", "/$1"), PUNCTUATION, "")


def compare_keys(col: Column) -> Column:
    """(digits, digits without zeros, normalised) of a name, for blocking comparisons."""
    digits = F.regexp_replace(col, "[^0-9]", "")
    return F.struct(digits.alias("digits"), F.translate(digits, "0", "").alias("no_zeros"), simplify_name(col).alias("normalised"))


def is_accession(col: Column) -> Column:
    return F.coalesce(col.rlike(r"^[A-Z]{2}\d+(\.\d+)?$"), F.lit(False))


def classify_host(host: Column, strain: Column, classes: Column, mammal: str = "Nonhuman Mammal", cattle: str = "Cattle") -> Column:
    """A host's class by a map column from simplified host to class.

    An empty host is taken from the second part of a name of five; a mammal whose name says cattle is cattle; a host not
    in the map stays as it is.
    """
    simple = F.lower(F.replace(host, F.lit(" "), F.lit("")))
    parts = F.split(strain, "/")
    guess = F.when(F.size(parts) == 5, F.lower(F.replace(F.get(parts, F.lit(1)), F.lit(" "), F.lit(""))))
    found = F.try_element_at(classes, F.when(simple == "", F.coalesce(guess, F.lit(""))).otherwise(simple))
    return F.when((found == mammal) & (F.try_element_at(classes, guess) == cattle), F.lit(cattle)).otherwise(F.coalesce(found, host))


def repair_utf8(col: Column) -> Column:
    """Text whose Latin-1 bytes are valid UTF-8 is read as that; other text stays."""
    encodable = ~col.rlike(r"[^\x00-\xFF]")
    return F.when(encodable, F.coalesce(F.try_validate_utf8(F.encode(F.regexp_replace(col, r"[^\x00-\xFF]", "?"), "ISO-8859-1").cast("string")), col)).otherwise(col)


# -- dates and numbers --------------------------------------------------------------------------------------------

def format_date(col: Column, formats: Sequence[tuple[str, str]]) -> Column:
    """ISO text by the first (pattern, format) that fits; a date known to the year or month gets XX parts."""
    masked = F.when(col.rlike(r"^\d{4}$"), F.concat(col, F.lit("-XX-XX"))).when(col.rlike(r"^\d{4}-\d{2}$"), F.concat(col, F.lit("-XX"))).when(col.rlike(r"^\d{4}-XX-XX$|^\d{4}-\d{2}-XX$"), col)
    tried = [F.when(col.rlike(p), F.date_format(F.try_to_timestamp(col, F.lit(f)), "yyyy-MM-dd")) for p, f in formats]
    return F.coalesce(masked, *tried)


def date_range(col: Column) -> Column:
    """(lo, hi, precision) of a date with XX parts, or of a year or month alone."""
    year, month = F.regexp_extract(col, r"^(\d{4})", 1), F.regexp_extract(col, r"^\d{4}-(\d{2})", 1)
    day = F.regexp_extract(col, r"^\d{4}-\d{2}-(\d{2})", 1)
    lo = F.to_date(F.when(year != "", F.concat_ws("-", year, F.when(month != "", month).otherwise(F.lit("01")), F.when(day != "", day).otherwise(F.lit("01")))))
    hi = F.when(day != "", lo).when(month != "", F.last_day(lo)).when(year != "", F.to_date(F.concat(year, F.lit("-12-31"))))
    precision = F.when(day != "", "day").when(month != "", "month").when(year != "", "year").otherwise("none")
    return F.struct(lo.alias("lo"), hi.alias("hi"), precision.alias("precision"))


def first_of_month(col: Column) -> Column:
    return F.replace(col, F.lit("XX"), F.lit("01"))


def epiweek(day: Column) -> Column:
    """The surveillance week as YYYYWW: weeks start on Sunday and belong to the year of their Wednesday."""
    wednesday = F.date_add(day, 4 - F.dayofweek(day))
    return (F.year(wednesday) * 100 + F.floor((F.dayofyear(wednesday) - 1) / 7) + 1).cast("int")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def bin_days(day: Column, as_of: Column, bins: Sequence[int], labels: Sequence[str], outside: str = "undefined") -> Column:
    """The label of the bin of days from a date to ``as_of``: right-closed, the lowest edge included."""
    d = F.datediff(as_of, day)
    out = F.lit(outside)
    for i in reversed(range(len(labels))):
        low = (d >= bins[i]) if i == 0 else (d > bins[i])
        out = F.when(low & (d <= bins[i + 1]), F.lit(labels[i])).otherwise(out)
    return out


def relative_date(text: str, as_of: Column) -> Column:
    """``12Y``, ``6M``, ``4W`` or ``0D`` before as_of; otherwise the text as a date."""
    unit, number = text[-1:].upper(), text[:-1]
    if not number.isdigit() or unit not in "YMWD":
        return F.to_date(F.lit(text))
    n = int(number)
    return F.add_months(as_of, -n * (12 if unit == "Y" else 1)) if unit in "YM" else F.date_sub(as_of, n * (7 if unit == "W" else 1))


def to_decimal_year(day: Column) -> Column:
    return F.year(day) + (F.dayofyear(day) - 1) / 365.25


def from_decimal_year(x: Column) -> Column:
    return F.date_add(F.make_date(F.floor(x).cast("int"), F.lit(1), F.lit(1)), F.round((x - F.floor(x)) * 365.25).cast("int"))


def strain_year(name: Column, meta_year: Column, as_of_year: int, least: int = 1960, floor: int = 1990) -> Column:
    """The year from metadata or a name's last part; unlikely ones ``unknown``, early ones ``<=floor``."""
    year = F.coalesce(meta_year.try_cast("int"), F.regexp_replace(F.element_at(F.split(name, "/"), -1), "-egg$", "").try_cast("int"))
    return F.when(year.isNull() | ~year.between(least, as_of_year), F.lit("unknown")).when(year <= floor, F.lit(f"<={floor}")).otherwise(year.cast("string"))


def count_band(col: Column) -> Column:
    return F.when(col == 0, F.lit("0")).when(col <= 5, F.lit("1-5")).when(col <= 10, F.lit("6-10")).when(col > 10, F.lit(">10"))


def growth_status(delta: Column, eps: float = 0.05) -> Column:
    return F.when(F.abs(delta) < eps, F.lit("persist")).when(delta < 0, F.lit("decline")).when(delta >= 0, F.lit("grow"))


def short_hash(col: Column, n: int = 7) -> Column:
    return F.substring(F.sha2(col.cast("binary"), 256), 1, n)


def source_centre(col: Column) -> Column:
    return F.substring_index(col, "_", 1)


def waning(t: Column, t0: Column, years: float) -> Column:
    return F.greatest(1 - (t - t0) / years, F.lit(0.0))


def cross_immunity_weight(distance: Column, d0: float) -> Column:
    return F.exp(-distance / d0)


def log_floor(col: Column, floor: float = 1e-6) -> Column:
    return F.ln(F.greatest(col, F.lit(floor)))


# -- sequences ----------------------------------------------------------------------------------------------------

def mask_invalid(col: Column, alphabet: str = "ACGTN-", mask: str = "N") -> Column:
    return F.regexp_replace(F.upper(col), f"[^{alphabet}]", mask)


def gap_count(col: Column, chars: str = "X-") -> Column:
    return F.length(col) - F.length(F.translate(col, chars, ""))


def motif_count(col: Column, motif: str = "N[^P][ST][^P]") -> Column:
    """Matches of a motif that don't overlap."""
    return F.regexp_count(col, F.lit(motif))


def parse_mutations(col: Column) -> Column:
    """``GENE:A123B,…`` as (gene, ref, site, alt) structs; without a gene the field is empty; unreadable ones are left out."""
    parts = F.filter(F.split(F.coalesce(col, F.lit("")), ","), lambda x: x.rlike(r"^(?:[^:]+:)?[A-Z*-]\d+[A-Z*-]$"))
    return F.transform(
        parts,
        lambda x: F.struct(
            F.regexp_extract(x, r"^([^:]+):", 1).alias("gene"),
            F.regexp_extract(x, r"([A-Z*-])\d+[A-Z*-]$", 1).alias("ref"),
            F.regexp_extract(x, r"(\d+)[A-Z*-]$", 1).cast("int").alias("site"),
            F.regexp_extract(x, r"\d+([A-Z*-])$", 1).alias("alt"),
        ),
    )


def sequence_diff(base: Column, other: Column) -> Column:
    """(site, ref, alt) where two sequences differ, sites from 1, over the shorter length."""
    n = F.least(F.length(base), F.length(other))
    sites = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.filter(
        F.transform(sites, lambda i: F.struct(i.alias("site"), F.substr(base, i, F.lit(1)).alias("ref"), F.substr(other, i, F.lit(1)).alias("alt"))),
        lambda x: x["ref"] != x["alt"],
    )


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two strings of equal length."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(1)))


def gene_coverage(col: Column, gene: str) -> Column:
    """The gene's number in ``HA1:0.98,HA2:0.5``; 0.0 where it has none."""
    return F.coalesce(F.try_element_at(F.str_to_map(F.coalesce(col, F.lit("")), F.lit(","), F.lit(":")), F.lit(gene)).try_cast("double"), F.lit(0.0))


def list_size(col: Column) -> Column:
    """Entries of a comma-separated list; the empty list counts 1."""
    return F.size(F.split(F.coalesce(col, F.lit("")), ","))


def derived_haplotype(clade: Column, mutations: Column, genes: Sequence[str] | None = None, strip: bool = True) -> Column:
    """``clade:mut-mut`` of the mutations in the genes (all, if none are named); without any, the clade."""
    parts = F.filter(F.split(F.coalesce(mutations, F.lit("")), ","), lambda x: x != "")
    if genes is not None:
        parts = F.filter(parts, lambda x: F.substring_index(x, ":", 1).isin(*genes))
    if strip:
        parts = F.transform(parts, lambda x: F.substring_index(x, ":", -1))
    return F.when(F.size(parts) > 0, F.concat(clade, F.lit(":"), F.array_join(parts, "-"))).otherwise(clade)


def label(pattern: str, *columns: Column) -> Column:
    """A text with columns filled in, as ``%s (%s, %s)``; null where a column is."""
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in columns]), F.format_string(pattern, *columns))
