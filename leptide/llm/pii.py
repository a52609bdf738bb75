"""Personal data: fixed patterns, and terms that give the found entities away.

Emails, IP addresses, card and phone numbers are found by patterns and checks.
Co-occurrence over the corpus then estimates how strongly a term reveals an
entity: pointwise mutual information over the information content of the
entity. Terms above the thresholds are generalised or removed as well: in the
documents that hold the entity, or wherever they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .decontaminate import _bit_map, _in_map

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract in possessive form. A match can't begin inside
# a run of its own characters unless a match has just ended there (\G): so
# long runs are read once, and leftmost matches are the same.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
#: What a text must hold for the pattern to be tried.
HINTS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]", "phone": "\\+[0-9]"}
TERM = r"[\p{L}\p{N}]++"

SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _passes(kind: str, x: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(x, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(F.substring(part(p), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(x)).between(16, 19) & F.call_function("luhn_check", _digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(8, 15)
    return F.lit(True)


def located(text: Column, kind: str, pattern: str, passes) -> Column:
    """Spans of the matches that pass, in order; offsets count code points.

    What lies between the matches gives their places.
    """
    pair = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gap"))
    none = F.array().cast(SPANS)

    def step(p: Column, s: Column, i: Column) -> Column:
        start = s["at"] + F.length(F.get(p["gap"], i))
        value = F.get(p["m"], i)
        end = start + F.length(value)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.when(passes(value), F.array_append(s["found"], span)).otherwise(s["found"]).alias("found"))

    def walk(p: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), none.alias("found"))
        found = F.aggregate(F.sequence(F.lit(0), F.size(p["m"]) - 1), zero, lambda s, i: step(p, s, i), lambda s: s["found"])
        return F.when(F.size(p["m"]) > 0, found).otherwise(none)

    return F.flatten(F.transform(F.array(pair), walk))


def base_spans(text: Column) -> Column:
    """Spans of all four kinds, in their order, then by start."""
    found = []
    for kind in KINDS:
        spans = located(text, kind, PATTERNS[kind], lambda x, k=kind: _passes(k, x))
        found.append(F.when(text.rlike(HINTS[kind]), spans).otherwise(F.array().cast(SPANS)))
    return F.concat(*found)


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def line_terms(line: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0)))


def entity(span: Column) -> Column:
    return F.concat(span["kind"], F.lit(":"), F.lower(span["value"]))


def disclosures(docs: DataFrame, found: DataFrame, *, support: int, generalise_at: float) -> DataFrame:
    """(entity, term, disclosure) of terms that reveal an entity beyond the threshold.

    Contexts are lines, and every line of the corpus counts: copies weigh alike
    in the joint count, the entity's own, the term's own and the total. A term
    must meet the entity in `support` lines.
    """
    # no base pattern matches across a line break: a line's spans are the text's within it
    held = found.select(F.explode(F.split("text", "\n", -1)).alias("line")).where(F.col("line").rlike("|".join(HINTS.values())))
    held = held.select("line", F.explode(F.array_distinct(F.transform(base_spans(F.col("line")), entity))).alias("entity"))
    held = saved(held.groupBy("entity", F.xxhash64("line").alias("key")).agg(F.min("line").alias("line"), F.count("*").alias("copies")), "entity-lines")
    entities = held.groupBy("entity").agg(F.sum("copies").alias("n_e")).where(F.col("n_e") >= support)
    own = r"^(email|ip|card|phone):"
    joint = (
        held.join(entities.select("entity"), "entity", "left_semi").select("entity", "copies", F.explode(line_terms(F.col("line"))).alias("term")).groupBy("entity", "term")
        .agg(F.sum("copies").alias("n_te")).where(F.col("n_te") >= support)
        .where(~F.array_contains(F.regexp_extract_all(F.regexp_replace("entity", own, ""), F.lit(TERM), F.lit(0)), F.col("term")))
    )
    every = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"))
    counts = every.select(F.explode(line_terms(F.col("line"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    total = every.agg(F.count("*").alias("n")).scalar()
    met = joint.join(entities, "entity").join(counts, "term")
    mutual = F.log(total * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    return met.select("entity", "term", (mutual / F.log(total / F.col("n_e"))).alias("disclosure")).where(F.col("disclosure") >= generalise_at)


def term_table(top: DataFrame, n: int) -> Column:
    """The n rows (term, d) as one array of n buckets by hash, looked up as a scalar."""
    held = top.select(_bucket(F.col("term"), n).alias("b"), F.struct("term", "d").alias("e")).groupBy("b").agg(F.collect_list("e").alias("es"))
    every = top.sparkSession.range(n).select(F.col("id").cast("int").alias("b")).join(held, "b", "left")
    return saved(every.agg(F.array_sort(F.collect_list(F.struct("b", "es"))).alias("t")).select(F.transform("t", lambda x: x["es"]).alias("t")), "term-table").scalar()


def _bucket(term: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(max(1, n))).cast("int")


def _replaced(rich: DataFrame, remove_at: float) -> DataFrame:
    """(doc_id, base, spans, text): the text with its spans replaced; `told` has the disclosure of each term."""
    mark = lambda s: F.when(s["kind"] != "term", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).when(
        F.element_at("told", F.lower(s["value"])) >= remove_at, ""
    ).otherwise("[TERM]")
    text = F.col("text")
    ordered = F.array_sort("spans", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0))
    written = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], text.substr(acc["at"] + 1, s["start"] - acc["at"]), mark(s)).alias("out"))
        ),
        lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text))),
    )
    return rich.select("doc_id", "base", "spans", written.alias("text"))


def sanitise(
    docs: DataFrame, *, with_text: bool = True, everywhere: bool = False, support: int = 3, generalise_at: float = 0.5, remove_at: float = 0.8, few: int = 200_000
) -> DataFrame:
    """(doc_id, spans, base, text) for every row: all spans, those of the base kinds, the sanitised text.

    Base spans become [EMAIL] and the like, terms at or above `generalise_at`
    [TERM], at or above `remove_at` nothing. Overlapping spans are replaced
    once, by the one that starts first. Terms are looked for in the documents
    that hold an entity they reveal; with `everywhere`, in all documents, at
    the highest disclosure of the term: up to `few` terms are looked up where a
    text is read, more of them are joined; the result is the same. Without with_text, the texts of documents
    without base spans are not carried along and come out null. Null texts count as empty; repeated
    rows and null ids keep their rows; an empty table gives no rows. Other
    columns are ignored.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    row = F.xxhash64("doc_id", "text").alias("row")
    scanned = docs.select("doc_id", row, "text", base_spans(F.col("text")).alias("spans"))
    held_text = F.col("text") if with_text else F.when(F.size("spans") > 0, F.col("text"))
    scanned = saved(scanned.select("doc_id", "row", "spans", held_text.alias("text")), "spans")
    held = scanned.where(F.size("spans") > 0)
    terms = saved(disclosures(docs, held, support=support, generalise_at=generalise_at), "terms")
    if everywhere:
        # a bit map of the terms, of a fixed size, drops most words where they are read
        top = saved(terms.groupBy("term").agg(F.max("disclosure").alias("d")), "top-terms")
        n = top.count()
    if everywhere and n <= few:
        lookup = term_table(top, n)
        entry = lambda x: F.filter(F.get("lookup", _bucket(x, n)), lambda e: e["term"] == x)
        known = lambda x: F.coalesce(F.size(entry(F.lower(x))) > 0, F.lit(False))
        read = docs.select("doc_id", "text", lookup.alias("lookup")).select("doc_id", "text", "lookup", base_spans(F.col("text")).alias("base"), located(F.col("text"), "term", TERM, known).alias("terms"))
        told = F.map_from_entries(F.array_distinct(F.transform("terms", lambda s: F.get(entry(F.lower(s["value"])), F.lit(0)))))
        held_text = F.col("text") if with_text else F.when(F.size("base") > 0, F.col("text"))
        return _replaced(read.select("doc_id", held_text.alias("text"), "base", told.alias("told"), F.concat("base", "terms").alias("spans")), remove_at)
    if everywhere:
        bits = _bit_map(top.select(F.xxhash64("term").alias("x")))
        may = lambda x: F.coalesce(_in_map(bits, F.xxhash64(F.lower(x)), F.col("bits")), F.lit(False))
        near = docs.select(row, "text", bits.words.alias("bits")).where(F.exists(line_terms(F.col("text")), may))
        near = saved(near.select("row", located(F.col("text"), "term", TERM, may).alias("near")).dropDuplicates(["row"]), "near-terms")
        asked = near.select("row", F.explode(F.array_distinct(F.transform("near", lambda s: F.lower(s["value"])))).alias("term"))
        met = asked.join(top, "term")
    else:
        met = held.select("row", F.explode(F.array_distinct(F.transform("spans", entity))).alias("entity")).join(terms, "entity").groupBy("row", "term").agg(F.max("disclosure").alias("d"))
    told = saved(met.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "d"))).alias("told")), "told")
    is_told = lambda x: F.map_contains_key("told", F.lower(x))
    none = F.array().cast(SPANS)
    if everywhere:
        told = saved(told.join(near, "row").select("row", "told", F.filter("near", lambda s: is_told(s["value"])).alias("terms")), "told-spans")
        with_terms = scanned.join(told, "row", "left").withColumn("terms", F.coalesce("terms", none))
    else:
        with_terms = held.join(told, "row", "left").withColumn("terms", F.when(F.col("told").isNotNull(), located(F.col("text"), "term", TERM, is_told)).otherwise(none))
    rich = with_terms.select("doc_id", "text", F.col("spans").alias("base"), "told", F.concat("spans", "terms").alias("spans"))
    rich = _replaced(rich, remove_at)
    if everywhere:
        return rich
    plain = scanned.where(F.size("spans") == 0).select("doc_id", none.alias("base"), none.alias("spans"), "text")
    return rich.unionByName(plain)
