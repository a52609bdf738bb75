"""Removal of repeated content-defined chunks of lines.

A hash rolling over the hashes of two neighbouring lines decides where a chunk
ends, so the same passage is cut the same way wherever it stands. A line of
more than LONG_WORDS words is a chunk of its own. Chunks of several lines, and
long lines, that occur again are removed after their bytes are compared with
the first occurrence, which stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, saved
from .decontaminate import _bit_map, _in_map

LONG_WORDS = 50
#: A line ends a chunk if the rolling hash's first hex digit is one of these (5 in 16).
CUT_DIGITS = "01234"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def chunk_ends(ls: Column) -> Column:
    """Indices (from 0) of the last line of each chunk, for an array of lines."""
    hashes = F.transform(ls, lambda x: F.md5(x.cast("binary")))
    # a text of more than 50 words has 101 bytes or more; only such lines are looked at closely
    long = F.transform(ls, lambda x: F.when(F.octet_length(x) > 2 * LONG_WORDS, F.regexp_count(x, F.lit(WORD)) > LONG_WORDS).otherwise(False))
    packed = F.struct(hashes.alias("h"), long.alias("long"), F.size(ls).alias("n"))

    def cut(p: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(p["h"], i - 1)).otherwise(F.lit(""))
        rolled = F.substring(F.md5(F.concat(before, F.get(p["h"], i)).cast("binary")), 1, 1)
        return (i == p["n"] - 1) | F.get(p["long"], i) | F.coalesce(F.get(p["long"], i + 1), F.lit(False)) | (rolled <= CUT_DIGITS[-1])

    # one element arrays let the lambda see the hashes computed once
    return F.flatten(F.transform(F.array(packed), lambda p: F.filter(F.sequence(F.lit(0), p["n"] - 1), lambda i: cut(p, i))))


def chunks(text: Column) -> Column:
    """Chunks of a whole text in order: struct(text, removable)."""
    both = F.transform(F.array(F.struct(lines(text).alias("l"))), lambda s: F.struct(s["l"].alias("l"), chunk_ends(s["l"]).alias("e")))

    def chunk(s: Column, end: Column, k: Column) -> Column:
        start = F.when(k > 0, F.get(s["e"], k - 1) + 1).otherwise(F.lit(0))
        part = F.slice(s["l"], start + 1, end - start + 1)
        several = F.size(F.filter(part, lambda x: F.regexp_like(x, F.lit(WORD)))) >= 2
        alone = (F.size(part) == 1) & (F.octet_length(F.get(part, F.lit(0))) > 2 * LONG_WORDS) & (F.regexp_count(F.get(part, F.lit(0)), F.lit(WORD)) > LONG_WORDS)
        return F.struct(F.array_join(part, "\n").alias("text"), (several | alone).alias("removable"))

    return F.flatten(F.transform(both, lambda s: F.transform(s["e"], lambda end, k: chunk(s, end, k))))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chunks, n_removed, text) for every row of docs (doc_id, text).

    The first occurrence, by doc_id, hash of the text and place, stays. Rows of one
    id and text are one document: a chunk at the same place in them is the same
    occurrence. Rows of one id, or of none, with different texts are documents
    of their own. Null texts stay null, with one empty chunk; an empty table
    gives no rows. What is left of a text keeps its order and line breaks.
    Other columns are ignored.
    """
    return rebuild(docs.select("doc_id", "text"), removed_chunks(docs)).select("doc_id", "n_chunks", "n_removed", "text")


def _row(text: Column) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def removed_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, row, places): which chunks of which documents occurred before."""
    cut = docs.select("doc_id", _row(F.col("text")).alias("row"), F.posexplode(chunks(F.col("text"))).alias("place", "c")).where("c.removable").select(
        F.struct("doc_id", "row", "place").alias("at"), F.md5(F.col("c.text").cast("binary")).alias("key"), F.col("c.text").alias("chunk")
    )
    # hashes and places are combined map-side; no text is moved for this
    repeated = saved(cut.groupBy("key").agg(F.count("*").alias("n"), F.min("at").alias("first")).where("n > 1").select("key", "first"), "repeated")
    found = saved(cut.join(repeated, "key").withColumn("stays", F.col("first").eqNullSafe(F.col("at"))).drop("first"), "occurrences")
    again, kept = found.where("not stays"), found.where("stays").select(F.col("key").alias("key_"), F.col("chunk").alias("chunk_"))
    gone = again.join(kept, (F.col("key") == F.col("key_")) & (F.col("chunk") == F.col("chunk_")), "left_semi")
    return saved(gone.groupBy("at.doc_id", "at.row").agg(F.collect_set("at.place").alias("places")), "removed")


def rebuild(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Texts without the chunks at the places that `gone` (doc_id, row, places) lists.

    Columns: row (all of the input's), doc_id, text, n_chunks, n_removed.
    """
    g = gone.select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row"), F.col("places").alias("gone_places"))
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (_row(F.col("row.text")) == F.col("gone_row"))
    # only documents that may have lost something move to where their places are
    held = _in_map(_bit_map(gone.select(F.xxhash64("doc_id", "row").alias("x"))), F.xxhash64(F.col("row.doc_id"), _row(F.col("row.text"))))
    touched = rows.where(held).join(g, same, "left").select("row", "gone_places")
    whole = rows.where(~held).withColumn("gone_places", F.lit(None).cast(dict(g.dtypes)["gone_places"]))
    out = touched.unionByName(whole).select("row", "gone_places", chunks(F.col("row.text")).alias("chunks"))
    left = F.filter("chunks", lambda c, i: ~F.array_contains("gone_places", i))
    text = F.when(F.col("gone_places").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(left, lambda c: c["text"]), "\n"))
    n_removed = F.when(F.col("gone_places").isNull(), 0).otherwise(F.size("gone_places"))
    return out.select("row", "row.doc_id", text.alias("text"), F.size("chunks").cast("long").alias("n_chunks"), n_removed.cast("long").alias("n_removed"))


#: The same in another engine's SQL, line by line with window functions.
SQL = r"""
with r as (select doc_id, text, md5(coalesce(text, '')) as row, row_number() over () as nr from documents),
u as (select doc_id, row, min(nr) as nr, any_value(coalesce(text, '')) as text from r group by doc_id, row),
l0 as (select doc_id, row, nr, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from u),
l1 as (select *, md5(line) as h, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as w from l0),
l2 as (select *, lag(h) over d as h0, lead(w) over d as w1, i = max(i) over (partition by nr) as final from l1 window d as (partition by nr order by i)),
l3 as (select *, (final or w > 50 or coalesce(w1, 0) > 50 or substr(md5(coalesce(h0, '') || h), 1, 1) <= '4')::int as cut from l2),
l4 as (select *, coalesce(sum(cut) over (partition by nr order by i rows between unbounded preceding and 1 preceding), 0) as place from l3),
c as (select doc_id, row, nr, place, string_agg(line, chr(10) order by i) as chunk, sum((w > 0)::int) >= 2 or (count(*) = 1 and max(w) > 50) as removable from l4 group by all),
f as (select *, removable and row_number() over (partition by removable, chunk order by doc_id nulls first, row, place) > 1 as gone from c),
d as (select doc_id, row, count(*) as n_chunks, sum(gone::int)::bigint as n_removed, coalesce(string_agg(chunk, chr(10) order by place) filter (not gone), '') as text from f group by doc_id, row)
select r.doc_id, d.n_chunks, d.n_removed, case when r.text is not null then d.text end as text from r join d on r.doc_id is not distinct from d.doc_id and r.row = d.row
"""
