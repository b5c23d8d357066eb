"""Personal data by weak supervision, in DataFrame functions only.

1. Regular expressions find candidate spans: the base kinds (email, ip, card, phone), with a verdict on their digits, and
   looser forms (secrets, phone numbers without a plus sign, spelled-out email addresses).
2. Labelers vote for or against each candidate or abstain: the pattern itself, gazetteers, words before it, its
   characters, and its borders.
3. Candidates are counted by their pattern of votes, at most 3**5 patterns; expectation-maximisation over that table
   estimates how far each labeler can be trusted and the probability of each pattern, in one SQL expression.
4. A naive Bayes classifier over hashed features of the spans (class priors, and each feature's share of each class) is
   trained on those probabilities, and decides which of the looser candidates are added.  Base spans always stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Fixed patterns of the output contract.  Possessive repetition and the borders in front change no match; they keep the
#: matcher from trying every suffix of a long run.  A card is a whole run of 12 to 19 digits with single separators.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"
#: Looser forms, added where the classifier agrees.
SECRET = r"(?i:(?:password|passwd|pwd|secret|token|api[_-]?key)\x20?[=:]\x20?)[\"']?[A-Za-z0-9+/_-]{8,}+(?:\.[A-Za-z0-9+/_-]++)*+[\"']?|\bAKIA[0-9A-Z]{12,}+\b"
PHONE_LOOSE = r"(?<![0-9A-Za-z+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])"
EMAIL_LOOSE = r"(?i)\b[a-z0-9._%+-]{2,40}(?:\x20?[\[(]at[\])]\x20?[a-z0-9-]{2,40}\x20?(?:[\[(]dot[\])]|\x20dot\x20|\.)|\x20at\x20[a-z0-9-]{2,40}\x20dot\x20)\x20?(?:com|org|net|edu|gov|info|io|de|fr|es|uk)\b"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "secret": SECRET, "phone_loose": PHONE_LOOSE, "email_loose": EMAIL_LOOSE}
BASE = ("email", "ip", "card", "phone")
#: Fixed gazetteers: top-level domains, country calling codes, ranges of card issuers' numbers by four digits, names of
#: secrets, first numbers of addresses that no host on the net has.
DOMAINS = "com org net edu gov mil int info biz io dev app ai co me tv uk de fr es it nl be ch at eu us ca au nz jp cn in br mx ar ru pl se no dk fi pt gr ie cz hu ro tr il kr sg".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 218 234 254 351 352 353 354 356 357 358 359 370 371 372 380 381 385 386 387 420 421 852 880 886 961 962 966 971 972 974".split()
ISSUERS = [(2221, 2720), (3000, 3059), (3400, 3499), (3528, 3589), (3600, 3699), (3700, 3799), (3800, 3999), (4000, 4999), (5100, 5599), (6011, 6011), (6200, 6299), (6440, 6599)]
SECRET_NAMES = "password passwd pwd secret token apikey akia".split()
RESERVED_NETS = ["0", "127", "255"]
CUES = r"(?i)\b(?:e-?mail|mail|contact|write|phone|tel|call|fax|mobile|card|visa|account|password|login|token|key|ip|host|address|server)\W*$"
COUNTER_CUES = r"(?i)\b(?:version|license|isbn|page|figure|table|chapter|section|no|nr)\W*$"
SPANS = "array<struct<kind:string,start:int,end:int,txt:string,before:string,after:string>>"
LABELERS = 5
BUCKETS = 4096
BEFORE = 24


def spans(text: Column, kind: str, pattern: str) -> Column:
    """All matches in a text as (kind, start, end, txt, before, after): code points, end exclusive.

    ``before`` has the last BEFORE characters since the match before, ``after`` the next one.

    The pieces between matches and the matches alternate, so running lengths give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.struct(p.alias("before"), m.alias("txt"))),
        F.slice(pieces, F.lit(2), F.size(found)),
        lambda x, after: F.struct(F.length(x["before"]).alias("gap"), F.right(x["before"], F.lit(BEFORE)).alias("before"), x["txt"].alias("txt"), F.left(after, F.lit(1)).alias("after")),
    )
    empty = F.array().cast(SPANS)

    def place(x: Column, end: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (end - F.length(x["txt"])).alias("start"), end.alias("end"), x["txt"].alias("txt"), x["before"].alias("before"), x["after"].alias("after"))

    placed = _let(pairs, lambda p: F.zip_with(p, running_sums(F.transform(p, lambda x: x["gap"] + F.length(x["txt"]))), place))
    return F.when(F.regexp_like(text, F.lit(pattern)), placed).otherwise(empty)


def _let(value: Column, use) -> Column:
    """An expression of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(lengths: Column, block: int = 256) -> Column:
    """Sums of an array up to each element: in blocks, so that many elements cost little more than their number."""
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def summed(xs: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(xs) / block).cast("int") - 1, F.lit(0))), lambda b: F.slice(xs, b * block + 1, F.lit(block)))
        return _let(blocks, placed)

    def placed(bs: Column) -> Column:
        starts = _let(F.transform(bs, add), lambda t: F.transform(t, lambda _, i: add(F.slice(t, F.lit(1), i))))
        return F.flatten(F.zip_with(bs, starts, lambda b, s: F.transform(b, lambda _, j: s + add(F.slice(b, F.lit(1), j + 1)))))

    return _let(lengths, summed)


def luhn(txt: Column) -> Column:
    """Whether the digits of a text have a Luhn sum divisible by 10."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(txt, "[^0-9]", "")), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    value = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(value, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def candidates(docs: DataFrame, text: str, row: Column) -> DataFrame:
    """(rk, kind, start, end, txt, before, after, valid) of every candidate; valid is null for loose kinds."""
    whole = F.coalesce(F.col(text), F.lit(""))
    # What a text must have for a pattern to be worth trying; each is one cheap pass.
    has = lambda *signs: reduce(lambda a, b: a | b, [F.contains(F.col("_t"), F.lit(x)) for x in signs])
    digit = F.regexp_like(F.col("_t"), F.lit("[0-9]"))
    hints = {"email": has("@"), "ip": digit, "card": digit, "phone": has("+"), "secret": has("=", ":", "AKIA"), "phone_loose": digit, "email_loose": F.regexp_like(F.col("_t"), F.lit(r"(?i)[\[(]at[\])]|\x20dot\x20"))}
    arrays = [F.when(hints[kind], spans(F.col("_t"), kind, pattern)).otherwise(F.array().cast(SPANS)) for kind, pattern in KINDS.items()]
    found = docs.select(row.alias("rk"), whole.alias("_t")).select("rk", F.explode(F.concat(*arrays)).alias("s"))
    txt, kind = F.col("s.txt"), F.col("s.kind")
    digits = F.length(F.regexp_replace(txt, "[^0-9]", ""))
    valid = (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", txt.rlike(OCTETS))
        .when(kind == "card", luhn(txt))
        .when(kind == "phone", digits.between(9, 15))
    )
    return found.select(
        "rk",
        "s.*",
        valid.alias("valid"),
    ).dropDuplicates(["rk", "kind", "start"])


def votes() -> Column:
    """The labelers' votes on a candidate: 1 for, -1 against, 0 abstains."""
    kind, txt = F.col("kind"), F.col("txt")
    digits = F.regexp_replace(txt, "[^0-9]", "")
    issuer = F.substring(digits, 1, 4).try_cast("int")
    listed = (
        F.when(kind.isin("email", "email_loose"), F.element_at(F.split(F.lower(txt), "[^a-z]+"), -1).isin(*DOMAINS))
        .when(kind == "ip", ~F.substring_index(txt, ".", 1).isin(*RESERVED_NETS))
        .when(kind == "card", reduce(lambda a, b: a | b, [issuer.between(lo, hi) for lo, hi in ISSUERS]))
        .when(kind == "phone", reduce(lambda a, b: a | b, [F.substring(digits, 1, n).isin(*[c for c in CALLING_CODES if len(c) == n]) for n in (1, 2, 3)]))
        .when(kind == "phone_loose", F.substring(digits, 1, 1).between("2", "9") & F.substring(digits, 4, 1).between("2", "9"))
        .when(kind == "secret", F.regexp_replace(F.lower(F.regexp_extract(txt, r"^(AKIA|[A-Za-z_-]+)", 1)), "[_-]", "").isin(*SECRET_NAMES))
        .otherwise(F.lit(False))
    )
    by_pattern = F.when(F.col("valid"), 1).when(~F.col("valid"), -1).when((kind == "secret") & txt.rlike(r"[0-9a-f]{16,}|AKIA[0-9A-Z]{16}"), 1).otherwise(0)
    by_gazetteer = F.when(listed, 1).when(kind.isin("card", "ip", "phone_loose"), -1).otherwise(0)
    by_context = F.when(F.col("before").rlike(CUES), 1).when(F.col("before").rlike(COUNTER_CUES), -1).otherwise(0)
    variety = F.size(F.array_distinct(F.split(txt, "")))
    by_characters = F.when(variety >= 6, 1).when(variety <= 3, -1).otherwise(0)
    glued = F.col("before").rlike(r"[\p{L}\p{Nd}]$") | F.col("after").rlike(r"^[\p{L}\p{Nd}]")
    by_borders = F.when(glued, -1).when(F.col("before").rlike(r"(?:^|\s)$"), 1).otherwise(0)
    return F.array(by_pattern, by_gazetteer, by_context, by_characters, by_borders)


def reliabilities(counted: DataFrame, rounds: int, smoothing: float) -> DataFrame:
    """(v, q): the probability of each pattern of votes, from one row of parameters found by EM.

    Labelers are independent given the truth; labeler l votes for with probability a[l] on true candidates and b[l] on
    others, where it votes.  Starts from labelers right 8 times of 10.
    """
    table = counted.groupBy().agg(F.collect_list(F.struct("v", "n")).alias("p"))

    def posterior(v: Column, m: Column) -> Column:
        z = F.log(m["pi"] / (1 - m["pi"]))
        for i in range(LABELERS):
            a, b, x = F.get(m["a"], F.lit(i)), F.get(m["b"], F.lit(i)), F.get(v, F.lit(i))
            z = z + F.when(x == 1, F.log(a / b)).when(x == -1, F.log((1 - a) / (1 - b))).otherwise(0.0)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))

    def step(m: Column) -> Column:
        # q has (v, for, against): a pattern's count split by its probability.
        q = F.transform(F.col("p"), lambda x: F.struct(x["v"].alias("v"), (x["n"] * posterior(x["v"], m)).alias("yes"), (x["n"] * (1 - posterior(x["v"], m))).alias("no")))
        add = lambda q, part, test: F.aggregate(F.filter(q, test), F.lit(0.0), lambda s, x: s + x[part])
        rate = lambda q, part, i: (add(q, part, lambda x: F.get(x["v"], F.lit(i)) == 1) + smoothing) / (add(q, part, lambda x: F.get(x["v"], F.lit(i)) != 0) + 2 * smoothing)
        every = lambda x: F.lit(True)
        new = F.transform(
            F.array(q),
            lambda q: F.struct(
                ((add(q, "yes", every) + smoothing) / (add(q, "yes", every) + add(q, "no", every) + 2 * smoothing)).alias("pi"),
                F.array(*[rate(q, "yes", i) for i in range(LABELERS)]).alias("a"),
                F.array(*[rate(q, "no", i) for i in range(LABELERS)]).alias("b"),
            ),
        )
        return F.get(new, F.lit(0))

    start = F.struct(F.lit(0.5).alias("pi"), F.array(*[F.lit(0.8)] * LABELERS).alias("a"), F.array(*[F.lit(0.2)] * LABELERS).alias("b"))
    fitted = table.withColumn("m", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda m, _: step(m)))
    return fitted.select(F.explode(F.transform("p", lambda x: F.struct(x["v"].alias("v"), posterior(x["v"], F.col("m")).alias("q")))).alias("x")).select("x.v", "x.q")


def span_features() -> Column:
    """Hashed features of a candidate: kind with shape, length, borders, and kind of characters before."""
    kind, txt = F.col("kind"), F.col("txt")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(txt, "[0-9]+", "9"), "[A-Z]+", "A"), "[a-z]+", "a")
    features = [
        F.concat(F.lit("shape "), kind, F.lit(" "), F.substring(shape, 1, 16)),
        F.concat(F.lit("size "), kind, F.lit(" "), F.floor(F.log2(F.length(txt))).cast("string")),
        F.concat(F.lit("cue "), kind, F.lit(" "), F.col("before").rlike(CUES).cast("string")),
        F.concat(F.lit("edge "), F.regexp_replace(F.substring(F.col("before"), -1, 1), r"[\p{L}\p{Nd}]", "w"), F.lit(" "), F.regexp_replace(F.col("after"), r"[\p{L}\p{Nd}]", "w")),
    ]
    return F.transform(F.array(*features), lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))


def classified(found: DataFrame, rounds: int, smoothing: float) -> DataFrame:
    """Candidates with log_odds, the classifier's verdict."""
    voted = found.withColumn("v", votes()).withColumn("f", span_features())
    soft = reliabilities(voted.groupBy("v").agg(F.count("*").cast("double").alias("n")), rounds, smoothing)
    joined = voted.join(soft, "v")
    sums = joined.agg(F.coalesce(F.sum("q"), F.lit(0.0)).alias("yes_all"), F.coalesce(F.sum(1 - F.col("q")), F.lit(0.0)).alias("no_all"))
    trained = joined.select("q", F.explode("f").alias("f")).groupBy("f").agg(F.sum("q").alias("yes"), F.sum(1 - F.col("q")).alias("no"))
    slots = found.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("f")).join(trained, "f", "left")
    slots = slots.withColumns({"yes_all": sums.select("yes_all").scalar(), "no_all": sums.select("no_all").scalar()})
    # Shares are smoothed towards the classes' own, so that a feature never seen says nothing.
    part = lambda total: (F.col(total) + 1) / (F.col("yes_all") + F.col("no_all") + 2)
    share = lambda n, total: F.log((F.coalesce(F.col(n), F.lit(0.0)) + smoothing * part(total)) / part(total))
    listed = slots.groupBy().agg(
        F.collect_list(F.struct("f", (share("yes", "yes_all") - share("no", "no_all")).alias("w"))).alias("w"),
        F.max(F.log(part("yes_all") / part("no_all"))).alias("prior"),
    )
    # The prior stands after the features' weights.
    model = stored(listed.select(F.concat(F.transform(F.array_sort("w"), lambda x: x["w"]), F.array("prior")).alias("w")), "pii-weights")
    scored = voted.withColumn("w", model.scalar())
    total = F.aggregate("f", F.get(F.col("w"), F.lit(BUCKETS)), lambda s, b: s + F.get(F.col("w"), b))
    return scored.withColumn("log_odds", total).drop("v", "f", "w")


def find_pii(docs: DataFrame, *, key: str = "doc_id", text: str = "text", rounds: int = 25, smoothing: float = 1.0) -> DataFrame:
    """(rk, found): the spans of each row that has any, as an array of (start, place, kind, end, base) in order.

    rk is ``xxhash64(key, text)`` of a row; rows that repeat both share it.  place is the kind's in KINDS.  base marks
    spans of the base patterns whose digits pass their check; others are added by the classifier, where they overlap no
    base span.  A null or empty text has none; an empty table gives an empty result.
    """
    found = stored(candidates(docs, text, F.xxhash64(F.col(key), F.col(text))), "pii-candidates")
    scored = classified(found, rounds, smoothing)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    base = F.coalesce(F.col("valid"), F.lit(False))
    loose = ~F.col("kind").isin(*BASE) & (F.col("log_odds") > 0)
    rows = scored.where(base | loose).groupBy("rk").agg(F.sort_array(F.collect_list(F.struct("start", place.alias("place"), "kind", "end", base.alias("base")))).alias("all"))
    certain = F.filter("all", lambda x: x["base"])
    apart = lambda x: x["base"] | ~F.exists(F.col("certain"), lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"]))
    return rows.withColumn("certain", certain).select("rk", F.filter("all", apart).alias("found"))


def listed(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
