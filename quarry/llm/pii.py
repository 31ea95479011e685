"""Personal data: generated candidates, boosted trees, calibrated thresholds.

Base spans (email, ip, card, phone) come from fixed patterns and checks and
always stay.  High-recall generators propose further spans, which may overlap;
boosted trees score each from its format and its context, and a span is added
if its score passes the kind's threshold, calibrated to a wanted precision.  The
trees learn from a bounded sample of documents, the thresholds come from all
others.  A candidate's label comes from evidence besides the base patterns: its
check sum, its format once written-out marks are read, and the words before it.
Candidates without evidence either way take no part in either, and are scored
like the others.

All work on a document happens in its own row: patterns give matches and the
text between them, running lengths give positions.  Nothing is shuffled.

Defined results: null and empty texts have no spans; positions count code
points, ends are exclusive; rows are independent, so repeated rows and ties
give the same result; with no candidate in the sample nothing is added; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import gbt
from quarry.llm.common import save

KINDS = ["email", "ip", "card", "phone"]

# The base patterns.  Possessive quantifiers match the same text without
# stacking up frames on long runs; a match may begin where a run begins or the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: High-recall generators: written-out marks, and any digits with separators.
AT = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?: ?[(\[]at[)\]] ?|@)[A-Za-z0-9-]++(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]++)*+"
DIGITS = r"[+(]?+[0-9](?:[ ().\-/]{0,2}+[0-9]){6,}+"

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_PLACED = "struct<kind:int,start:bigint,m:string,before:string,after:string>"
SPAN = "array<struct<kind:int,start:bigint,end:bigint>>"
FEATURES = ["kind", "size", "digits", "separators", "groups", "longest", "plus", "luhn", "dots", "at_marks",
            "before", "after", "secret_word", "contact_word", "open_bracket", "whole_address", "number_format",
            "date_format", "phone_word", "mail_word", "card_word"]

#: Formats and words that tell candidates apart, besides the base patterns.
ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
DATE = r"^(?:(?:19|20)[0-9]{2}([-/.])(?:0?[1-9]|1[0-2])\1[0-3]?[0-9]|[0-3]?[0-9]([-/.])[0-3]?[0-9]\2(?:19|20)?[0-9]{2})(?![0-9\-/.])"
FOUR_NUMBERS = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"
DECIMAL = r"^[0-9]+\.[0-9]+$"
PHONE_WORD = r"\b(?:phone|telephone|tel|mobile|cell|call|fax|dial|whatsapp|sms)\b"
MAIL_WORD = r"\b(?:e-?mail|mail|write|contact|address)\b"
CARD_WORD = r"\b(?:card|visa|mastercard|amex|credit|debit|pay)\b"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check."""
    n = F.length(digits)
    chars = F.filter(F.split(digits, ""), lambda x: x != "")

    def value(d, i):
        x = d.cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def running(found: Column, chunk: int = 256) -> Column:
    """``start`` for an array of structs with ``gap`` and ``size``: matches and the text before each.

    Running sums in two levels, so that n matches cost n * chunk, not n * n.
    """
    n = F.size(found)
    cuts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int"))).otherwise(F.array().cast("array<int>"))
    zero = F.lit(0).cast("bigint")

    def within(c):
        return F.aggregate(
            F.slice(found, c * chunk + 1, F.lit(chunk)), F.struct(zero.alias("at"), F.array().cast(f"array<{_PLACED}>").alias("out")),
            lambda a, x: F.struct((a["at"] + x["gap"] + x["size"]).alias("at"), F.concat(a["out"], F.array(F.struct(
                x["kind"].alias("kind"), (a["at"] + x["gap"]).alias("start"), x["m"].alias("m"),
                x["before"].alias("before"), x["after"].alias("after")))).alias("out")))

    return F.aggregate(
        F.transform(cuts, within), F.struct(zero.alias("at"), F.array().cast(f"array<array<{_PLACED}>>").alias("out")),
        lambda a, c: F.struct((a["at"] + c["at"]).alias("at"), F.concat(a["out"], F.array(F.transform(
            c["out"], lambda x: x.withField("start", x["start"] + a["at"])))).alias("out")),
        lambda a: F.flatten(a["out"]))


def matches(found: Column, parts: Column, kind: int) -> Column:
    """Matches with the length of the text before each, and 24 and 8 characters around it.

    ``parts`` is the text between the matches, one more than ``found``.
    """
    return F.transform(
        F.arrays_zip(found.alias("m"), F.slice(parts, F.lit(1), F.size(found)).alias("p"), F.slice(parts, F.lit(2), F.size(found)).alias("q")),
        lambda x: F.struct(F.lit(kind).alias("kind"), F.length(x["p"]).cast("bigint").alias("gap"),
                           F.length(x["m"]).cast("bigint").alias("size"), x["m"].alias("m"),
                           F.right(x["p"], F.lit(24)).alias("before"), F.left(x["q"], F.lit(8)).alias("after")))


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def valid(x: Column) -> Column:
    """The checks that a match of a base pattern must pass."""
    d = digits_of(x["m"])
    n = F.length(d)
    return (F.when(x["kind"] == 0, True)
            .when(x["kind"] == 1, x["m"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
            .when(x["kind"] == 2, n.between(14, 19) & luhn(d))
            .otherwise(n.between(10, 15)))


def as_span(x: Column) -> Column:
    return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["m"])).alias("end"))


def ordered(spans: Column) -> Column:
    """Spans by start, then kind."""
    by = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    return F.transform(F.array_sort(F.array_distinct(by)), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of ordered spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def found(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__base`` (spans) and ``__candidates`` (kind, start, m, before, after)."""
    out = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    patterns = [(EMAIL, 0), (IP, 1), (CARD, 2), (PHONE, 3), (AT, 0), (DIGITS, 2)]
    # what a text must hold for a pattern to match at all, and no text is split where nothing matched
    t, none = F.col("__text"), F.array().cast("array<string>")
    digit, at = F.col("__digit"), t.contains("@")
    needs = [at, digit, digit, t.contains("+"), at | t.contains("at)") | t.contains("at]"), digit]
    out = out.withColumn("__digit", t.rlike("[0-9]"))
    out = out.withColumns({f"__r{k}": F.when(needs[k], F.regexp_extract_all(t, F.lit(p), 0)).otherwise(none) for k, (p, _) in enumerate(patterns)})
    out = out.withColumns({f"__p{k}": F.when(F.size(f"__r{k}") > 0, F.split(t, p, -1)).otherwise(none) for k, (p, _) in enumerate(patterns)})
    out = out.withColumns({f"__m{k}": matches(F.col(f"__r{k}"), F.col(f"__p{k}"), kind) for k, (_, kind) in enumerate(patterns)})
    out = out.withColumns({f"__s{k}": running(F.col(f"__m{k}")) for k in range(6)})
    base = F.flatten(F.array(*[F.transform(F.filter(F.col(f"__s{k}"), valid), as_span) for k in range(4)]))
    # digits may be a card or a phone: both are proposed, and overlap
    n = lambda x: F.length(digits_of(x["m"]))
    cards = F.filter(F.col("__s5"), lambda x: n(x).between(13, 19))
    phones = F.transform(F.filter(F.col("__s5"), lambda x: n(x).between(7, 15)), lambda x: x.withField("kind", F.lit(3)))
    known = lambda k: F.col(f"__s{k}")
    return out.withColumns({"__base": ordered(base), "__candidates": F.concat(known(4), known(1), known(2), known(3), cards, phones)}).drop(
        *[f"__{c}{k}" for c in "rpms" for k in range(6)], "__text", "__digit")


def described(x: Column, base: Column) -> Column:
    """Features of a candidate, with its place and whether it is a base span."""
    m, d = x["m"], digits_of(x["m"])
    near = F.lower(x["before"])
    kind_of = lambda c: F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^\p{L}"), 3).otherwise(4)
    runs = F.filter(F.split(m, "[^0-9]+"), lambda r: r != "")
    span = as_span(x)
    # an address with its written-out marks read
    address = F.regexp_replace(F.regexp_replace(m, r" ?[(\[]at[)\]] ?", "@"), r" ?[(\[]dot[)\]] ?", ".")
    date = m.rlike(DATE)
    f = {"kind": x["kind"], "size": F.length(m), "digits": F.length(d),
         "separators": F.length(m) - F.length(F.translate(m, " -().", "")), "groups": F.size(runs),
         "longest": F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)), "plus": m.startswith("+").cast("int"),
         "luhn": luhn(d).cast("int"), "dots": F.length(m) - F.length(F.translate(m, ".", "")),
         "at_marks": F.length(m) - F.length(F.translate(m, "@", "")),
         "before": kind_of(F.right(x["before"], F.lit(1))), "after": kind_of(F.left(x["after"], F.lit(1))),
         "secret_word": near.rlike("token|key|secret|password|passwd|order|serial|version").cast("int"),
         "contact_word": near.rlike("mail|phone|tel|call|fax|card|contact|address|ip").cast("int"),
         "open_bracket": near.rlike(r"[(\[]\s*$").cast("int"),
         "whole_address": F.when(x["kind"] == 0, address.rlike(ADDRESS).cast("int")),
         "number_format": (F.size(runs).between(2, 6) & (F.array_max(F.transform(runs, F.length)) <= 8)
                           & ~date & ~m.rlike(FOUR_NUMBERS) & ~m.rlike(DECIMAL)).cast("int"),
         "date_format": date.cast("int"), "phone_word": near.rlike(PHONE_WORD).cast("int"),
         "mail_word": near.rlike(MAIL_WORD).cast("int"), "card_word": near.rlike(CARD_WORD).cast("int")}
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), F.array_contains(base, span).alias("is_base"),
                    *[F.coalesce(f[c].cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])


def evidence(x: Column, base: Column) -> Column:
    """Label of a described candidate: 1.0, 0.0, or null where nothing speaks for either.

    Base spans are positive.  Others need a whole format and, for a phone, a
    phone word before it; for a card, the check sum and separators or a card word.
    What overlaps a base span of its own kind is never added and has no label.
    """
    yes, no, unknown = F.lit(1.0), F.lit(0.0), F.lit(None).cast("double")
    overlaps = lambda own: F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])
                                    & ((b["kind"] == x["kind"].cast("int")) == F.lit(own)))
    glued = x["before"].isin(2.0, 3.0) | x["after"].isin(2.0, 3.0)
    bad = glued | (x["secret_word"] == 1) | (x["date_format"] == 1)
    mail = F.when(x["whole_address"] == 1, yes).when(x["mail_word"] == 1, unknown).otherwise(no)
    card = (F.when(bad | (x["luhn"] == 0), no).when((x["card_word"] == 1) | (x["number_format"] == 1) & (x["groups"] >= 3), yes)
            .when(x["groups"] > 1, unknown).otherwise(no))
    # four numbers and decimals are no phones even after a phone word
    phone = (F.when(bad, no).when((x["phone_word"] == 1) & ((x["number_format"] == 1) | (x["groups"] == 1)), yes)
             .when(x["number_format"] == 1, unknown).otherwise(no))
    return (F.when(x["is_base"], yes).when(overlaps(True), unknown).when(overlaps(False), no)
            .when(x["kind"] == 0, mail).when(x["kind"] == 2, card).when(x["kind"] == 3, phone).otherwise(no))


def labelled(docs: DataFrame) -> DataFrame:
    """The candidates that have a label, described."""
    rows = found(docs.select("text")).select("__base", F.explode(F.transform(
        F.col("__candidates"), lambda x: described(x, F.col("__base")))).alias("__x"))
    rows = rows.withColumn("label", evidence(F.col("__x"), F.col("__base")))
    return rows.where("label IS NOT NULL").select("__x.is_base", *[F.col("__x")[c].alias(c) for c in FEATURES], "label")


def train(docs: DataFrame, max_docs: int = 4_000, trees: int = 12, depth: int = 3, precision: float = 0.98,
          ) -> tuple[list, dict[int, float]]:
    """(trees, threshold of each kind): trees from a sample, thresholds from all other documents.

    The trees are fitted on about ``max_docs`` documents chosen by hash, seven
    tenths of all at most.  A kind's threshold is the lowest score (in steps of
    0.02) above which at least ``precision`` of the labelled candidates that are
    no base spans are positive, in every document outside the sample.  A kind
    that never gets there has none.
    """
    total = docs.count()
    if not total:
        return [(1.0, -4.0)], {}
    place = F.pmod(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(1 << 20))
    cut = F.lit(min(7 * (1 << 20) // 10, -(-max_docs * (1 << 20) // total)))
    model = gbt.fit(save(labelled(docs.where(place < cut)), "pii-candidates"), FEATURES, "label", trees, depth)
    # base spans stay whatever their score: the thresholds are for what is added
    held = labelled(docs.where(place >= cut)).where(~F.col("is_base")).select(
        "kind", "label", F.floor(gbt.probability(model, F.col) * 50).cast("int").alias("bin"))
    bins: dict[int, list[tuple[int, int, float]]] = {}
    for r in held.groupBy("kind", "bin").agg(F.count("*").alias("n"), F.sum("label").alias("p")).collect():
        bins.setdefault(int(r["kind"]), []).append((r["bin"], r["n"], r["p"]))
    thresholds = {}
    for kind, rows_ in bins.items():
        n = p = 0
        for b, m, q in sorted(rows_, reverse=True):
            n, p = n + m, p + q
            if q and p >= precision * n:
                thresholds[kind] = b / 50
    return model, thresholds


def detect(docs: DataFrame, model: list, thresholds: dict[int, float]) -> DataFrame:
    """``docs`` with ``__base`` and ``__spans`` (base and added), both ordered."""
    rows = found(docs)
    rows = rows.withColumn("__x", F.transform(F.col("__candidates"), lambda x: described(x, F.col("__base")))).drop("__candidates")
    least = lambda k: F.coalesce(*[F.when(k == kind, F.lit(t)) for kind, t in thresholds.items()], F.lit(2.0))
    good = F.filter(F.col("__x"), lambda x: ~x["is_base"] & (gbt.probability(model, lambda c: x[c]) >= least(x["kind"])))
    # a candidate that touches a base span of its own kind adds nothing
    new = F.filter(good, lambda x: ~F.exists(F.col("__base"), lambda b: (b["kind"] == x["kind"].cast("int")) & (b["start"] < x["end"]) & (x["start"] < b["end"])))
    added = F.transform(new, lambda x: F.struct(x["kind"].cast("int").alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return rows.withColumn("__spans", ordered(F.concat(F.col("__base"), added))).drop("__x")


def redact(docs: DataFrame, model: list, thresholds: dict[int, float]) -> DataFrame:
    """``docs`` with every span of its text replaced by ``[KIND]``; overlapping spans become one."""
    columns = docs.columns
    rows = detect(docs, model, thresholds)
    none = F.array().cast(SPAN)
    merged = F.aggregate(F.col("__spans"), none, lambda a, x: F.when(
        (F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["end"] > x["start"]),
        F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.struct(
            F.try_element_at(a, F.lit(-1))["kind"].alias("kind"), F.try_element_at(a, F.lit(-1))["start"].alias("start"),
            F.greatest(F.try_element_at(a, F.lit(-1))["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(a, F.array(x))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("text")

    def piece(x, i):
        start = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.try_element_at(F.col("__merged"), i)["end"])
        return F.concat(F.substring(text, (start + 1).cast("int"), (x["start"] - start).cast("int")), F.element_at(names, x["kind"] + 1))

    rows = rows.withColumn("__merged", merged)
    tail = F.substring(text, (F.try_element_at(F.col("__merged"), F.lit(-1))["end"] + 1).cast("int"), F.length(text))
    clean = F.when(F.size("__merged") > 0, F.concat(F.array_join(F.transform(F.col("__merged"), piece), ""), tail)).otherwise(text)
    return rows.withColumn("text", clean).select(*columns)


def report(docs: DataFrame, model: list, thresholds: dict[int, float]) -> DataFrame:
    """doc_id, base counts by kind, the digest of the base spans, and all spans."""
    rows = detect(docs, model, thresholds)
    n = lambda k: F.size(F.filter(F.col("__base"), lambda x: x["kind"] == k)).cast("long")
    return rows.select("doc_id", *[n(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                       F.sha2(listed(F.col("__base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("__spans")).alias("spans"))
