"""Personal data by pattern, and terms that give it away.

Addresses, numbers and cards are found by pattern; each distinct value is a protected entity. The corpus then tells
which terms reveal an entity: if e stands near a term t in n(e, t) of the n(t) occurrences of t, the
pointwise mutual information PMI(e; t) falls short of the information content IC(e) by log2(n(t) / n(e, t)) bits.
A term whose shortfall is log2(100 / ``SHARE``) bits at most, in enough different contexts, is generalised too. In whole
numbers: of 100 occurrences of the term, ``SHARE`` or more stand near the entity.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, let, packed, pieces_of, running, staged, unpacked

CONTEXT = 80  # characters before and after an entity whose whole words are its context
CONTEXTS = 3  # different contexts of one entity in which a term must stand
SHARE = 80  # of 100 occurrences of a term, so many near one entity reveal it
TERM = r"[\p{L}\p{N}]+"
TERM_CHARS = 3  # shorter terms are never generalised
_MAP_WORDS = 1 << 12  # 64-bit words of the bit map that thins out terms before they are shuffled

# The kinds in order, and what they look like. Runs are taken whole (possessive), and an address or
# number starts where no longer one could have: the same matches, in time proportional to the text.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_NEEDED = {"email": "@", "phone": "+"}  # a text without it has no match


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda found: F.lit(True),
    "ip": lambda found: found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": lambda found: F.when(F.length(_digits(found)).between(12, 19), let(_digits(found), luhn)).otherwise(F.lit(False)),
    "phone": lambda found: F.length(_digits(found)).between(9, 15),
}

_FAR = (1 << 62) - 1  # beyond every text
_SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def spans_of(found: Column, gaps: Column, rank: int, kind: str, wanted: Callable[[Column], Column]) -> Column:
    """Spans of the wanted matches; matches and the gaps between them alternate, so their lengths give the places."""
    paired = F.arrays_zip(found.alias("found"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"))
    sizes = F.transform(paired, lambda p: (F.length(p["gap"]) + F.length(p["found"])).cast("bigint"))

    def spanned(ends: Column) -> Column:
        def span(match: Column, i: Column) -> Column:
            end = F.get(ends, i)
            own = F.struct((end - F.length(match)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
            return F.when(F.coalesce(wanted(match), F.lit(False)), own)

        return F.filter(F.transform(found, span), lambda s: s.isNotNull()).cast(_SPANS)

    return let(running(sizes, lambda a, b: a + b, 0), spanned)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``whole``) with one column of spans per kind and all of them, sorted, as ``base``."""
    none = F.array().cast("array<string>")
    matches, gaps = {}, {}
    for kind in KINDS:
        found = F.regexp_extract_all(F.col("whole"), F.lit(PATTERNS[kind]), F.lit(0))
        needed = F.contains(F.col("whole"), F.lit(_NEEDED.get(kind, "")))
        matches[f"{kind}_found"] = F.when(needed, found).otherwise(none)
        gaps[f"{kind}_gaps"] = F.when(F.size(f"{kind}_found") > 0, F.split("whole", PATTERNS[kind]))
    read = docs.withColumns(matches).withColumns(gaps)
    spans = {}
    for rank, kind in enumerate(KINDS):
        own = spans_of(F.col(f"{kind}_found"), F.col(f"{kind}_gaps"), rank, kind, CHECKS[kind])
        spans[kind] = F.when(F.size(f"{kind}_found") > 0, own).otherwise(F.array().cast(_SPANS))
    spanned = read.withColumns(spans).drop(*matches, *gaps)
    return spanned.withColumn("base", F.sort_array(F.concat(*[F.col(kind) for kind in KINDS])))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _terms(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), lambda t: F.length(t) >= TERM_CHARS)


def contexts(based: DataFrame) -> DataFrame:
    """``entity, context, term, n``: every occurrence of a term near an entity, once, and how many equal texts have it.

    Windows around mentions of one entity that overlap are one context, without these mentions. Words that its outer
    ends cut are left out: a run of term characters there goes.
    """
    def mention(pieces: Column) -> Callable[[Column], Column]:
        def of(span: Column) -> Column:
            start, end = span["start"], span["end"]
            value = cut(pieces, start, end)
            entity = F.when(span["kind"].isin("card", "phone"), _digits(value)).otherwise(F.lower(value))
            return F.struct(
                F.xxhash64(span["kind"], entity).alias("entity"), start.alias("start"), end.alias("end"),
                cut(pieces, F.greatest(start - 2 * CONTEXT, F.lit(0)), start).alias("before"),
                cut(pieces, end, end + CONTEXT).alias("after"),
            )

        return of

    # Mentions take their surroundings with them, and the text stays behind.
    met = let(pieces_of(F.col("whole")), lambda pieces: F.transform("base", mention(pieces)))
    # No filter: Spark would find the spans once for it and once more for what it lets pass.
    known = based.select(
        F.xxhash64("whole").alias("version"), F.length("whole").alias("length"), F.when(F.size("base") > 0, met).alias("mentions")
    )
    mentions = known.select("version", "length", F.explode("mentions").alias("mention")).select("version", "length", "mention.*")
    mentions = mentions.groupBy(*mentions.columns).agg(F.count(F.lit(1)).alias("n"))  # equal texts are one
    alike = Window.partitionBy("version", "length", "entity")
    gap = F.col("start") - F.lag("end").over(alike.orderBy("start"))
    gap_after = F.lead("start").over(alike.orderBy("start")) - F.col("end")
    met = mentions.withColumns({"gap": gap, "gap_after": gap_after})
    met = met.withColumns({
        "first": F.coalesce(F.col("gap") >= 2 * CONTEXT, F.lit(True)), "last": F.coalesce(F.col("gap_after") >= 2 * CONTEXT, F.lit(True))
    })
    size = F.when(F.col("first"), F.least(F.col("start"), F.lit(CONTEXT))).otherwise(F.col("gap"))
    before = F.substring("before", (F.length("before") - size + 1).cast("int"), size.cast("int"))
    before = F.when(F.col("first") & (F.col("start") > CONTEXT), F.regexp_replace(before, rf"^{TERM}", "")).otherwise(before)
    shortened = F.col("end") + CONTEXT < F.col("length")
    after = F.when(shortened, F.regexp_replace("after", rf"{TERM}$", "")).otherwise(F.col("after"))
    near = met.select(
        "version", "length", "entity", "start", "n", F.sum(F.col("first").cast("int")).over(alike.orderBy("start")).alias("merged"),
        F.concat(before, F.lit("\n"), F.when(F.col("last"), after).otherwise("")).alias("near"),
    )
    whole = Window.partitionBy("version", "length", "entity", "merged")
    near = near.withColumn("place", F.col("start") - F.min("start").over(whole))
    near = near.withColumn("context", F.bit_xor(F.xxhash64("near", "place")).over(whole))
    return near.select("entity", "context", F.explode(_terms(F.col("near"))).alias("term"), "n")


def bit_map(terms: DataFrame) -> Column:
    """A constant of fixed size that holds a bit per hashed term: what it lacks need not be joined."""
    number = F.pmod(F.xxhash64("term"), F.lit(_MAP_WORDS * 64))
    bits = terms.select(number.alias("bit")).select(
        F.floor(F.col("bit") / 64).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 64).cast("int")).alias("mask"),
    )
    words = {row["word"]: row["mask"] for row in bits.groupBy("word").agg(F.bit_or("mask").alias("mask")).collect()}
    return F.split(F.lit(",".join(str(words.get(i, 0)) for i in range(_MAP_WORDS))), ",").cast("array<bigint>")


def _in_map(bits: Column, term: Column) -> Column:
    number = F.pmod(F.xxhash64(term), F.lit(_MAP_WORDS * 64))
    word = F.get(bits, F.floor(number / 64).cast("int"))
    return F.call_function("shiftright", word, (number % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def revealing_terms(based: DataFrame) -> DataFrame:
    """``term``: the terms of the whole corpus that reveal an entity."""
    near = staged(contexts(based), "contexts")
    known = near.groupBy("entity", "term").agg(
        F.sum("n").alias("n_near"), F.count_distinct("context").alias("n_contexts")
    )
    known = staged(known.filter(F.col("n_contexts") >= CONTEXTS).groupBy("term").agg(F.max("n_near").alias("n_near")), "near-terms")
    if known.isEmpty():
        return known.select("term")
    bits = bit_map(known)
    words = based.select(F.explode(_terms(F.col("whole"))).alias("term")).filter(_in_map(bits, F.col("term")))
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    reveals = 100 * F.col("n_near") >= SHARE * F.col("n")
    return staged(known.join(counted, "term").filter(reveals).select("term"), "revealing-terms")


def outside(base: Column, terms: Column) -> Column:
    """The spans of both, sorted, without the terms that meet a base span."""

    def judged(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: F.when(s["rank"] < len(KINDS), s["end"]).otherwise(0))
        starts = F.transform(spans, lambda s: F.when(s["rank"] < len(KINDS), s["start"]).otherwise(_FAR))
        reached = running(ends, F.greatest, 0)  # by base spans up to here
        next_ = F.reverse(running(F.reverse(starts), F.least, _FAR))  # base span from here on
        zipped = F.arrays_zip(spans.alias("span"), reached.alias("reached"), next_.alias("next"))
        free = F.filter(
            zipped,
            lambda z: (z["span"]["rank"] < len(KINDS)) | ((z["reached"] <= z["span"]["start"]) & (z["next"] >= z["span"]["end"])),
        )
        return F.transform(free, lambda z: z["span"])

    return let(F.sort_array(F.concat(base, terms)), judged)


def with_term_spans(based: DataFrame, terms: DataFrame) -> DataFrame:
    """``based`` with ``marked``: base spans and those of revealing terms outside of them, sorted."""
    if terms.isEmpty():
        return based.withColumn("marked", F.col("base"))
    bits = bit_map(terms)
    runs = F.regexp_extract_all(F.col("whole"), F.lit(TERM), F.lit(0))
    words = based.filter(F.col("doc").isNotNull()).select(
        "doc", "version", F.posexplode(F.transform(runs, F.lower)).alias("place", "term")
    ).filter((F.length("term") >= TERM_CHARS) & _in_map(bits, F.col("term")))
    # Written first: its real size then decides whether the texts must be shuffled to meet it.
    met = words.join(terms, "term").groupBy("doc", "version").agg(F.sort_array(F.collect_set("place")).alias("places"))
    held = staged(met, "held-terms").withColumnsRenamed({"doc": "held_doc", "version": "held_version"})
    joined = based.join(held, (F.col("doc") == F.col("held_doc")) & (F.col("version") == F.col("held_version")), "left")
    # All runs have spans first; those at the places of terms are picked.
    split = joined.withColumns({"runs": F.when(F.col("places").isNotNull(), runs), "gaps": F.when(F.col("places").isNotNull(), F.split("whole", TERM))})
    everywhere = spans_of(F.col("runs"), F.col("gaps"), len(KINDS), "term", lambda run: F.lit(True))
    picked = let(everywhere, lambda spans: F.transform("places", lambda place: F.get(spans, place)))
    spans = F.when(F.col("places").isNull(), F.col("base")).otherwise(outside(F.col("base"), picked))
    return split.withColumn("marked", spans).drop("held_doc", "held_version", "places", "runs", "gaps")


def generalised(whole: Column, spans: Column) -> Column:
    """The text with the kind in brackets in place of every span; spans that overlap are one gap."""

    def replaced(reached: Column, pieces: Column) -> Column:
        zipped = F.transform(spans, lambda s, i: F.struct(s.alias("span"), F.when(i > 0, F.get(reached, i - 1)).otherwise(0).alias("at")))
        first = F.filter(zipped, lambda z: z["span"]["start"] >= z["at"])
        parts = F.transform(first, lambda z: F.concat(cut(pieces, z["at"], z["span"]["start"]), F.lit("["), z["span"]["kind"], F.lit("]")))
        rest = cut(pieces, F.element_at(reached, -1), F.length(whole).cast("bigint"))
        return F.concat(F.array_join(parts, ""), rest)

    ends = F.transform(spans, lambda s: s["end"])
    changed = let(running(ends, F.greatest, 0), lambda reached: let(pieces_of(whole), lambda pieces: replaced(reached, pieces)))
    return F.when(F.size(spans) > 0, changed).otherwise(whole)


def sanitise(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_spans``, ``spans`` and ``sanitised``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and kind. ``spans`` adds the
    terms that reveal an entity, wherever they stand. ``sanitised`` has the kind in place of every span.

    A null text counts as empty. Rows with a null id keep the base spans only, but count in the corpus. Rows
    that repeat an id are documents of their own; repeated contexts count once for support and as often as they
    stand there for the share; mentions whose windows overlap have one context, and a term in it counts once for each
    place. The work grows in proportion to a text, whatever it holds. Other columns pass through, whatever their names; input
    columns named like a result give way. An empty table stays empty.
    """
    given = F.col(f"`{text}`")
    based = with_base_spans(
        packed(docs, doc=F.col(f"`{doc_id}`"), version=F.xxhash64(given), whole=F.coalesce(given, F.lit("")))
    )
    spanned = with_term_spans(based, revealing_terms(based))
    results = {f"n_{kind}": F.size(kind).cast("bigint") for kind in KINDS}
    results["base_spans"] = listed(F.col("base"))
    results["spans"] = listed(F.col("marked"))
    results["sanitised"] = generalised(F.col("whole"), F.col("marked"))
    return unpacked(spanned, docs.columns, results)
