"""SpotSigs: fingerprints from what follows common words.

A spot is a common word (an anchor) with the next content words behind it; a
document's signature is the set of its spots. Layout text, menus and lists hold
few anchors, so the running prose decides. Two sets can be as alike as their
lengths let them, at most the shorter through the longer: sets are put into
partitions by length so that only the own and the next partition can hold a
partner, and a pair is looked at no further once its bound is too low.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

# fixed values: common function words of four languages
ANCHORS = (
    "a an and are as at be but by for from had has have he her his in is it not of on or she that the this to was were which will with you "
    "le la les un une des du de et est en que qui dans pour par sur au aux avec ne pas plus il elle ce se "
    "el los las una del y es que con por para su como más no lo al "
    "der die das den dem des ein eine und ist im zu mit von auf für nicht sich auch"
).split()
CHAIN = 2
#: A word is a run of anything but ASCII white space; punctuation at its ends is not part of it.
EDGES = r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$"


def _held(value: Column, then) -> Column:
    """`then` of a value that is computed once: a lambda's variable is not computed again."""
    return F.transform(F.array(value), then)[0]


def text_words(text: Column) -> Column:
    """Lower-cased words of a whole text, without punctuation around them."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.filter(F.transform(parts, lambda w: F.regexp_replace(w, EDGES, "")), lambda w: w != "")


def _number(*words: Column) -> Column:
    """First 32 bits of the MD5 of the words, as an int."""
    digits = F.substring(F.md5(F.concat_ws(" ", *words).cast("binary")), 1, 8)
    return _held(F.conv(digits, 16, 10).cast("long"), lambda x: F.when(x < 1 << 31, x).otherwise(x - (1 << 32)).cast("int"))


def signature(text: Column, *, chain: int = CHAIN) -> Column:
    """Sorted distinct 32-bit hashes of the spots of a whole text.

    A spot takes the anchor and the `chain` content words that follow it, other
    anchors between them passed over. Where no anchor has that many behind it,
    each run of `chain` + 1 words is a spot, and a shorter text is one; a text
    without words, or null, has none.
    """

    def spots(words: Column) -> Column:
        common = F.filter(F.transform(words, lambda w, i: F.when(w.isin(ANCHORS), i)), lambda i: i.isNotNull())
        content = F.filter(words, lambda w: ~w.isin(ANCHORS))
        packed = F.struct(words.alias("w"), common.alias("at"), content.alias("c"))

        def of(p: Column) -> Column:
            # before the k-th anchor, at place i, there are i - k content words
            return F.filter(F.transform(p["at"], lambda i, k: F.when(
                i - k + chain <= F.size(p["c"]), _number(F.get(p["w"], i), *[F.get(p["c"], i - k + j) for j in range(chain)])
            )), lambda x: x.isNotNull())

        return _held(packed, of)

    def runs(words: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(words) - (chain + 1)), lambda i: _number(*[F.get(words, i + j) for j in range(chain + 1)]))
        return F.when(F.size(words) == 0, F.array().cast("array<int>")).when(F.size(words) <= chain, F.array(_number(F.array_join(words, " ")))).otherwise(many)

    both = _held(text_words(text), lambda w: _held(F.struct(w.alias("w"), spots(w).alias("s")), lambda p: F.when(F.size(p["s"]) > 0, p["s"]).otherwise(runs(p["w"]))))
    return F.array_sort(F.array_distinct(both))


def fingerprint(sig: Column) -> Column:
    """The signature as text: eight hex digits a spot, sorted."""
    return F.array_join(F.array_sort(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")))), "")


def likeness(a: Column, b: Column, *, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two signatures; 0 where their lengths alone keep it below `at_least`. Two empty ones are alike."""

    def of(p: Column) -> Column:
        short, long = F.least(F.size(p["a"]), F.size(p["b"])), F.greatest(F.size(p["a"]), F.size(p["b"]))

        def exact(common: Column) -> Column:
            return common / (short + long - common)

        value = F.when(long == 0, F.lit(1.0)).when(short < F.lit(at_least) * long, F.lit(0.0))
        return value.when(p["a"] == p["b"], F.lit(1.0)).otherwise(_held(F.size(F.array_intersect(p["a"], p["b"])), exact)).cast("double")

    return _held(F.struct(a.alias("a"), b.alias("b")), of)


# ---- pairs of alike documents ---------------------------------------------


def _partition(n: Column, at_least: float, most: int) -> Column:
    """Number of the length partition: each begins past what the shortest of the one before can reach."""
    starts, at = [], 1
    while at <= most:
        starts.append(at)
        at = int(at / at_least) + 1
    return F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= n))


def near_pairs(docs: DataFrame, *, at_least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """((doc_id, class), (a, b, similarity)): documents by class of equal signatures, and pairs of alike classes.

    docs: (doc_id, text). A class is named by its smallest doc_id; documents
    without words, and those of null id, are in none. Each set is posted under
    its rarest spots only, as many as one of at least `at_least` must share,
    and under its length partition; partners come from the same or the next
    one. A pair meets once, under the first spot both are posted under.
    """
    if not 0.0 < at_least <= 1.0:
        raise ValueError("at_least lies between 0 and 1")
    known = saved(docs.where("doc_id is not null").select("doc_id", signature(F.col("text")).alias("sig")).where(F.size("sig") > 0), "signatures")
    classes = known.groupBy("sig").agg(F.min("doc_id").alias("class"))
    sets = saved(classes.select("class", "sig", F.size("sig").alias("n")), "sets")
    most = sets.agg(F.max("n")).first()[0] or 0
    posts = sets.select("class", "n", F.explode("sig").alias("spot"))
    often = posts.groupBy("spot").agg(F.count("*").alias("often")).where("often > 1")
    by = Window.partitionBy("class")
    # spots of a single class are rarest of all; they need no list
    ranked = posts.join(often, "spot").withColumn("rank", F.row_number().over(by.orderBy("often", "spot"))).withColumn("single", F.col("n") - F.count("*").over(by))
    prefix = F.col("n") - F.ceil(F.lit(at_least) * F.col("n") - 1e-9) + 1
    lists = saved(ranked.where(F.col("rank") + F.col("single") <= prefix).select("class", "n", "spot", "often", _partition(F.col("n"), at_least, most).alias("part")), "lists")
    first = lists.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("often", "spot"))).alias("posted"))
    a = lists.select(F.col("class").alias("a"), F.col("n").alias("n_a"), "spot", "part")
    b = lists.select(F.col("class").alias("b"), F.col("n").alias("n_b"), "spot", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    fits = ((F.col("n_b") < F.col("n_a")) | ((F.col("n_a") == F.col("n_b")) & (F.col("b") < F.col("a")))) & (F.col("n_b") >= F.lit(at_least) * F.col("n_a") - 1e-9)
    met = a.join(b, ["spot", "part"]).where(fits).select("a", "b", "spot")
    one = lambda k: first.select(F.col("class").alias(k), F.col("posted.spot").alias(f"posted_{k}"))
    once = met.join(one("a"), "a").join(one("b"), "b").where(F.get(F.array_intersect("posted_a", "posted_b"), F.lit(0)) == F.col("spot")).select("a", "b")
    side = lambda k: sets.select(F.col("class").alias(k), F.col("sig").alias(f"sig_{k}"))
    judged = once.join(side("a"), "a").join(side("b"), "b").select("a", "b", likeness(F.col("sig_a"), F.col("sig_b"), at_least=at_least).alias("similarity"))
    pairs = judged.where(F.col("similarity") >= at_least).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")
    return known.join(classes, "sig").select("doc_id", "class"), pairs


# ---- neighbours in the order of ids ----------------------------------------


def _count_up_to(cuts: list[int], x: Column) -> Column:
    """How many of the sorted numbers are at most x, by halving."""
    if not cuts:
        return F.lit(0)
    jumps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    numbers = F.array(*[F.lit(c).cast("long") for c in cuts])
    # past the end there is no number, and the comparison with null is not taken
    return F.aggregate(F.array(*[F.lit(j) for j in jumps]), F.lit(0), lambda at, j: F.when(F.get(numbers, at + j - 1) <= x, at + j).otherwise(at))


def with_next(rows: DataFrame, *, order: str, value: str, ranges: int | None = None) -> DataFrame:
    """The rows with `next`, the `value` column of the row of the next lower `order`; after the last comes the first.

    Null ones come last, by the hash of their value; rows of equal order stand
    by their value. A single row follows itself. The order is cut into
    `ranges` (as many as the session has shuffle partitions) of about equal
    counts, and nulls into as many by their hash: a row moves once, to its
    range, and the first rows of a range to the end of the range before too.
    What the driver sees is two rows a range.
    """
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(k / ranges) for k in range(1, ranges)]) if ranges > 1 else F.array(F.lit(0.5))
    found = rows.agg(F.percentile_approx(order, shares, 10 * ranges).alias("cuts"), F.count_if(F.col(order).isNull()).alias("nulls")).first()
    cuts = sorted(set(found["cuts"] or []))
    # only then is the value read for this
    place = F.when(F.col(order).isNull(), F.shiftrightunsigned(F.xxhash64(value), 1)) if found["nulls"] else F.lit(None).cast("long")
    spread = F.floor(F.col("_place") / F.lit(2.0**63 / ranges))
    at = F.when(F.col(order).isNull(), -1 - F.least(spread, F.lit(ranges - 1))).otherwise(_count_up_to(cuts, F.col(order))).cast("long")
    rows = rows.withColumn("_place", place).withColumn("_range", at)

    heads = rows.groupBy("_range").agg(F.max(order).alias("_head"), F.min("_place").alias("_first")).collect()  # two a range at most
    heads = sorted(heads, key=lambda r: -r["_range"])
    back = [(r["_range"], r["_head"], r["_first"], heads[i - 1]["_range"]) for i, r in enumerate(heads)]
    kind = dict(rows.dtypes)[order]
    edges = spark.createDataFrame(back, f"_at long, _head {kind}, _first long, _before long")
    guest = F.col(order).eqNullSafe(F.col("_head")) & F.col("_place").eqNullSafe(F.col("_first"))
    own = F.struct(F.col("_range").alias("r"), F.lit(0).alias("guest"))
    both = F.array(own, F.struct(F.col("_before").alias("r"), F.lit(1).alias("guest")))
    sent = rows.join(F.broadcast(edges), F.col("_range") == F.col("_at")).withColumn("_to", F.explode(F.when(guest, both).otherwise(F.array(own))))
    line = Window.partitionBy("_to.r").orderBy("_to.guest", F.desc_nulls_last(order), "_place", value)
    out = sent.withColumn("next", F.lead(F.struct(value)).over(line)).where("_to.guest = 0")
    return out.withColumn("next", F.col("next").getField(value)).drop("_place", "_range", "_at", "_head", "_first", "_before", "_to")


def with_edited(docs: DataFrame, *, chain: int = CHAIN) -> DataFrame:
    """(doc_id, n_chars, edited, sig, edited_sig, next_sig): signatures of each text, of its edited text and of the next.

    docs: (doc_id, text); a null text is empty. The next document is that of
    the next lower doc_id. The edited text has its last n_chars / 2 code
    points, rounded down, replaced by as many first ones of the next text, or
    all.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.struct("text", signature(F.col("text"), chain=chain).alias("sig")).alias("own"))
    rows = with_next(rows, order="doc_id", value="own")
    n = F.char_length("own.text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("own.text", n - half), F.left("next.text", half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), F.col("own.sig").alias("sig"), F.col("next.sig").alias("next_sig"))
    return rows.withColumn("edited_sig", signature(F.col("edited"), chain=chain))


#: The same spot by spot with window functions, in another engine's SQL.
SQL = rf"""
with t as (select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id desc nulls last) as nr, count(*) over () as many from documents),
e as (select x.doc_id, x.nr, x.many, x.text, x.text[1:length(x.text) - length(x.text) // 2] || y.text[1:length(x.text) // 2] as edited from t x join t y on y.nr = x.nr % x.many + 1),
b as (select nr * 2 as id, text from e union all select nr * 2 + 1, edited from e),
w0 as (select id, list_filter(list_transform(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: regexp_replace(x, '^[\p{{P}}\p{{S}}]+|[\p{{P}}\p{{S}}]+$', '', 'g')), lambda x: x <> '') as w from b),
w1 as (select id, w, unnest(w) as word, unnest(range(len(w))) as i from w0),
w2 as (select *, word in ({", ".join(repr(a) for a in ANCHORS)}) as anchor from w1),
w3 as (select *, coalesce(sum((not anchor)::int) over (partition by id order by i rows between unbounded preceding and 1 preceding), 0)::bigint as before from w2),
c as (select id, list(word order by i) filter (not anchor) as c from w3 group by id),
s0 as (select id, word || ' ' || c[before + 1] || ' ' || c[before + 2] as spot from w3 join c using (id) where anchor and before + 2 <= len(c)),
s1 as (select id, unnest(case when len(w) > 2 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as spot
  from w0 where id not in (select id from s0)),
s as (select id, list_sort(list_distinct(list(substr(md5(spot), 1, 8)))) as s from (select * from s0 union all select * from s1) group by id),
f as (select b.id, coalesce(s.s, []::varchar[]) as s from b left join s using (id))
select e.doc_id, length(e.text)::bigint as n_chars, sha256(e.edited) as edited_sha256, array_to_string(a.s, '') as fingerprint, array_to_string(d.s, '') as edited_fingerprint,
  case when len(a.s) + len(d.s) = 0 then 1e0 else len(list_intersect(a.s, d.s))::double / (len(a.s) + len(d.s) - len(list_intersect(a.s, d.s))) end as near_edited,
  case when len(a.s) + len(n.s) = 0 then 1e0 else len(list_intersect(a.s, n.s))::double / (len(a.s) + len(n.s) - len(list_intersect(a.s, n.s))) end as near_next
from e join f a on a.id = e.nr * 2 join f d on d.id = e.nr * 2 + 1 join f n on n.id = (e.nr % e.many + 1) * 2
"""
