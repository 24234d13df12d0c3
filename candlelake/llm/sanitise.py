"""Information-theoretic sanitisation of personal data, in DataFrame expressions only.

Base spans are four kinds of personal data found by pattern and checked (parts of an address, digits,
check sum). Their positions come from splitting the text at the matches: pieces and matches alternate,
so lengths add up to positions, in code points, end exclusive.

The corpus then says what else gives them away. A base value is a protected entity; all terms of the
documents that hold it are counted with it, document by document. With ``IC(e) = -log p(e)`` and
``PMI(e, t) = log p(e, t) / (p(e) p(t))``, a term discloses the share ``PMI / IC`` of an entity: 1 if
the term occurs nowhere but with it. Wherever it stands in a document that holds the entity (but inside a
base span), a term is generalised if it discloses ``GENERALISE`` of it, and removed from ``REMOVE`` on. One
document is enough: an entity of a single document has all terms that hardly any other document has.

A null text counts as empty and has no spans. Repeated rows are documents of their own. A null id is
returned as it is. An entity that every document has carries no information and discloses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import staged, text_or_empty

MIN_SUPPORT, GENERALISE, REMOVE = 1, 0.6, 0.9

# Possessive forms, and a start only where a run of the first class starts (or the last match ended):
# the same matches as the plain patterns, in time linear in the text.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SIGNS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]{2}|[0-9][\\x20-][0-9]", "phone": "\\+[0-9]"}
ADDRESS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$"
#: A word of letters that is no part of an address or a number.
INSIDE = r"\p{L}\p{N}@._%+-"
TERM = rf"(?<![{INSIDE}])\p{{L}}{{3,}}+(?![{INSIDE}]*+(?<=[\p{{N}}@]))(?![._%+-]*[\p{{N}}@])(?![\p{{L}}\p{{N}}@])"
SPAN = "struct<start:int,end:int,value:string>"


def matches(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches that pass, as an array of ``start, end, value``."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, value: F.struct(
        F.length(gap).alias("gap"), F.length(value).alias("size"), value.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(done: Column, match: Column) -> Column:
        low = done["at"] + match["gap"]
        high = low + match["size"]
        span = F.array(F.struct(low.alias("start"), high.alias("end"), match["value"].alias("value")))
        grown = F.concat(done["spans"], span)
        if keep is not None:
            grown = F.when(keep(match["value"]), grown).otherwise(done["spans"])
        return F.struct(high.alias("at"), grown.alias("spans"))

    return F.aggregate(steps, start, step)["spans"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(digits, F.lit(0), lambda total, d: total + d) % 10 == 0


def _size(value: Column, low: int, high: int) -> Column:
    return F.length(_digits(value)).between(low, high)


KEEP = {
    "email": None,
    "ip": lambda value: value.rlike(ADDRESS),
    "card": lambda value: F.when(_size(value, 16, 19), _luhn(value)).otherwise(False),
    "phone": lambda value: _size(value, 8, 15),
}


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one kind; texts without its sign are not searched."""
    return F.when(text.rlike(SIGNS[kind]), matches(text, PATTERNS[kind], KEEP[kind])) \
        .otherwise(F.array().cast(f"array<{SPAN}>"))


def _entity_of(kind: str) -> Callable[[Column], Column]:
    def entity(span: Column) -> Column:
        value = F.lower(span["value"]) if kind in ("email", "ip") else _digits(span["value"])
        return F.concat(F.lit(f"{kind}:"), value)
    return entity


def _terms(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def found_spans(docs: DataFrame) -> DataFrame:
    """Stored table with a row per document: ``at, doc_id, body``, base spans by kind, and its text if it has any."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("body"), text_or_empty().alias("text"))
    rows = rows.select("*", *(base_spans(F.col("text"), kind).alias(kind) for kind in PATTERNS))
    entities = F.array_distinct(F.concat(*(F.transform(kind, _entity_of(kind)) for kind in PATTERNS)))
    return staged(rows.select(
        F.monotonically_increasing_id().alias("at"), "doc_id", "body",
        *(F.transform(kind, lambda span: F.struct(span["start"], span["end"])).alias(kind) for kind in PATTERNS),
        entities.alias("entities"), F.when(F.size(entities) > 0, F.col("text")).alias("text")), "spans")


def held_pairs(found: DataFrame) -> DataFrame:
    """``at, entity, term``: every term of a document with every entity of it, once."""
    return found.filter("text is not null").select("at", "entities", F.explode(_terms(F.col("text"))).alias("term")) \
        .select("at", F.explode("entities").alias("entity"), "term")


def disclosures(docs: DataFrame, found: DataFrame, support: int = MIN_SUPPORT) -> DataFrame:
    """``entity, term, disclosed``: share of an entity's information that a term of its documents gives away."""
    total = found.count()
    entities = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = held_pairs(found).groupBy("entity", "term").agg(F.count("*").alias("n_both")).filter(F.col("n_both") >= support)
    terms = docs.select(F.explode(_terms(text_or_empty())).alias("term")) \
        .groupBy("term").agg(F.count("*").alias("n_term"))
    information = -F.log(F.col("n_entity") / F.lit(total))
    shared = F.log(F.col("n_both") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term").cast("double")))
    return pairs.join(entities, "entity").join(terms, "term").filter(F.col("n_entity") < total) \
        .select("entity", "term", (shared / information).alias("disclosed"))


def term_spans(found: DataFrame, disclosed: DataFrame, generalise: float = GENERALISE,
               remove: float = REMOVE) -> DataFrame:
    """``at, generalise, remove``: arrays of the spans to generalise and to remove, by row of ``found``."""
    level = held_pairs(found).join(disclosed.filter(F.col("disclosed") >= generalise), ["entity", "term"]) \
        .groupBy("at", "term").agg(F.max("disclosed").alias("disclosed"))
    levels = level.groupBy("at").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosed"))).alias("levels"))
    base = F.concat(*PATTERNS)
    marked = F.filter(matches(F.col("text"), TERM, lambda value: F.map_contains_key("levels", F.lower(value))),
                      lambda x: ~F.exists(base, lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"])))

    def spans(keep: Callable[[Column], Column]) -> Column:
        chosen = F.filter("marked", lambda x: keep(F.element_at("levels", F.lower(x["value"]))))
        return F.transform(chosen, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    return found.join(levels, "at").withColumn("marked", marked).select(
        "at", spans(lambda share: share < remove).alias("generalise"), spans(lambda share: share >= remove).alias("remove"))


def all_spans(docs: DataFrame) -> DataFrame:
    """Row of each document with its spans by kind: the four base kinds, ``generalise`` and ``remove``."""
    found = found_spans(docs)
    none = F.array().cast("array<struct<start:int,end:int>>")
    terms = term_spans(found, disclosures(docs, found))
    return found.join(terms, "at", "left").withColumns({
        name: F.coalesce(name, none) for name in ("generalise", "remove")}).drop("entities", "text")


def _written(*kinds: str) -> Column:
    def lines(kind: str) -> Column:
        return F.transform(kind, lambda span: F.concat(
            F.lit(f"{kind}:"), span["start"].cast("string"), F.lit(":"), span["end"].cast("string")))
    return F.array_join(F.concat(*map(lines, kinds)), ",")


def span_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, a digest of the base spans, and all spans written out."""
    return all_spans(docs).select(
        "doc_id", *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in PATTERNS),
        F.sha2(_written(*PATTERNS), 256).alias("base_sha256"),
        _written(*PATTERNS, "generalise", "remove").alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with every span replaced: ``[KIND]`` for base spans and general terms, nothing for removed."""
    marks = {**{kind: f"[{kind.upper()}]" for kind in PATTERNS}, "generalise": "[TERM]", "remove": ""}

    def marked(kind: str, mark: str) -> Column:
        return F.transform(kind, lambda span: F.struct(
            span["start"].alias("start"), span["end"].alias("end"), F.lit(mark).alias("mark")))

    spans = all_spans(docs).withColumn("cuts", F.array_sort(F.concat(*(marked(*x) for x in marks.items())))) \
        .filter(F.size("cuts") > 0).groupBy("doc_id", "body").agg(F.first("cuts").alias("cuts")) \
        .select(F.col("doc_id").alias("id"), F.col("body").alias("hash"), "cuts")
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64("text").alias("body"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, cut: Column) -> Column:
        kept = F.substring(F.col("text"), done["at"] + 1, F.greatest(cut["start"] - done["at"], F.lit(0)))
        mark = F.when(cut["start"] >= done["at"], cut["mark"]).otherwise("")
        return F.struct(F.greatest(cut["end"], done["at"]).alias("at"),
                        F.concat(done["parts"], F.array(kept, mark)).alias("parts"))

    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("hash")), "left") \
        .withColumn("done", F.when(F.col("cuts").isNotNull(), F.aggregate("cuts", start, step)))
    rest = F.substring(F.col("text"), F.col("done.at") + 1, F.length("text"))
    return joined.select("doc_id", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(
        F.concat(F.array_join("done.parts", ""), rest)).alias("text"))
