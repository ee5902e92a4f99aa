"""Document fingerprints: bottom-k sketches of word shingles, with DataFrame functions only.

A text's shingles are its runs of ``SHINGLE_WORDS`` words (a shorter text is one shingle), hashed to 16 hexadecimal
digits of their MD5. The ``K`` smallest distinct hashes in ascending order are the fingerprint, written one after the
other. Fingerprints of parts are merged by ``merged``: the smallest of all together. From two fingerprints
come the resemblance (Jaccard similarity), the containment of one in the other, and from one the number of distinct
shingles.

Words are what stands between blanks, line feeds, tabs and carriage returns. Equal texts have equal fingerprints.
A null text counts as empty; a text without words has an empty fingerprint, which resembles only another empty one. Extra
columns are ignored, repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import range_of, splits

K = 128
SHINGLE_WORDS = 5
DIGITS = 16
#: Documents in a range that is put in order together.
RANGE_ROWS = 500


def words(text: Column) -> Column:
    for blank in ("\n", "\t", "\r"):
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column) -> Column:
    def hashed(part: Column) -> Column:
        return F.substring(F.md5(F.concat_ws(" ", part).cast("binary")), 1, DIGITS)

    def all_of(w: Column) -> Column:
        n = F.size(w)
        runs = F.transform(F.sequence(F.lit(1), F.greatest(n - SHINGLE_WORDS + 1, F.lit(1))),
                           lambda i: hashed(F.slice(w, i, SHINGLE_WORDS)))
        return F.when(n > 0, runs).otherwise(F.array().cast("array<string>"))

    return _once(words(text), all_of)


def smallest(hashes: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, K)


def fingerprint(text: Column) -> Column:
    """The fingerprint as an array of hashes."""
    return smallest(shingle_hashes(text))


def written(sketch: Column) -> Column:
    return F.array_join(sketch, "")


def read(text: Column) -> Column:
    """The array of hashes of a written fingerprint."""
    n = F.length(text) / DIGITS
    at = F.sequence(F.lit(0), F.greatest(n.cast("int") - 1, F.lit(0)))
    return F.when(F.length(text) > 0, F.transform(at, lambda i: F.substr(text, i * DIGITS + 1, F.lit(DIGITS)))) \
        .otherwise(F.array().cast("array<string>"))


def merged(a: Column, b: Column) -> Column:
    """The fingerprint of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, K)


def resemblance(a: Column, b: Column) -> Column:
    """Share of common shingles, from the smallest hashes of both together."""
    def of(union: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(union, a), b))
        return F.when(F.size(union) > 0, common.cast("double") / F.size(union)).otherwise(F.lit(1.0))

    return _once(merged(a, b), of)


def distinct_shingles(sketch: Column) -> Column:
    """How many distinct shingles the text has; exact below ``K``."""
    largest = F.conv(F.substring(F.element_at(sketch, K), 1, 12), 16, 10).cast("double") / float(1 << 48)
    return F.when(F.size(sketch) < K, F.size(sketch).cast("double")).otherwise((K - 1) / largest)


def containment(a: Column, b: Column) -> Column:
    """Share of the shingles of ``a`` that ``b`` has."""
    union = merged(a, b)
    common = resemblance(a, b) * distinct_shingles(union)
    return F.when(F.size(a) > 0, F.least(F.lit(1.0), common / distinct_shingles(a))).otherwise(F.lit(1.0))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>`` of the document behind in descending doc_id; behind the last comes the first.

    Ids are cut into ranges; the largest of each range, a value of the table, is also dealt to the range above,
    where it stands last, and the first document of all to the lowest range. Null ids come last, equal ones by text.
    """
    named = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    cuts = splits(named, "doc_id", RANGE_ROWS)
    top = named.agg(F.max("doc_id")).first()[0]

    def place(part: Column, wraps: bool, guest: bool) -> Column:
        return F.struct(part.cast("int").alias("part"), F.lit(wraps).alias("wraps"), F.lit(guest).alias("guest"))

    own = range_of("doc_id", cuts)
    none = F.array().cast("array<struct<part:int,wraps:boolean,guest:boolean>>")
    is_cut = F.get(F.lit(cuts).cast("array<bigint>"), own) == F.col("doc_id") if cuts else F.lit(False)
    places = F.concat(F.array(place(own, False, False)),
                      F.when(is_cut, F.array(place(own + 1, False, True))).otherwise(none),
                      F.when(F.col("doc_id").eqNullSafe(F.lit(top).cast("long")),
                             F.array(place(F.lit(0), True, True))).otherwise(none))
    order = "partition by place.part order by place.wraps, doc_id desc nulls last, text"
    leads = [f"lead(`{c}`) over ({order}) as `next_{c}`" for c in columns]
    return named.withColumn("place", F.explode(places)).selectExpr("*", *leads).where("not place.guest").drop("place")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, its fingerprint with commas between the hashes, which is smaller to send than an array."""
    text = F.coalesce("text", F.lit(""))
    listed = F.array_join(fingerprint(F.col("text")), ",")
    return docs.select("doc_id", text.alias("text")).withColumn("sketch", listed)


def edits(docs: DataFrame) -> DataFrame:
    """Each document, its text with the second half taken from the next document, both fingerprints and likenesses."""
    near = with_next(fingerprints(docs), ["text", "sketch"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    changed = near.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    hashed = changed.withColumn("edited_sketch", fingerprint(F.col("edited"))) \
        .withColumns({c: F.array_remove(F.split(c, ","), "") for c in ("sketch", "next_sketch")})
    return hashed.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"), written(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
