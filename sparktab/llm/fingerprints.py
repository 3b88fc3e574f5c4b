"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle is hashed once; the top bits of the hash choose one of ``BINS`` bins, and each bin keeps its least hash. An empty bin takes the value of another one by
optimal densification: it probes bins in a pseudo-random order of its own, the same for all documents, until one is filled. The low
``BITS`` bits of each bin are packed, ``PER_LONG`` bins to a long. Likeness is the share of equal bins, less what
equal low bits give by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import cut
from sparktab.llm.manifest import let
from sparktab.llm.order import numbered

WORDS = 5
BIN_BITS, BITS = 8, 8
BINS, PER_LONG = 1 << BIN_BITS, 64 // BITS
PROBES = 8
LOWEST = sum(1 << at for at in range(0, 64, BITS))  # the low bit of each packed value
SPACE = "[ \\t-\\r]+"


def shingle_hashes(body: Column, words: int = WORDS) -> Column:
    """A hash of every run of ``words`` words (ASCII white space parts them, case is ignored); of all words if there are fewer; none if there are none."""
    found = F.filter(F.split(F.lower(body), SPACE), lambda w: w != "")
    hashes = F.transform(found, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
        return F.when(F.size(h) >= words, several).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.slice(h, 1, 0))

    return let(hashes, runs)


def bin_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BIN_BITS).cast("int")


def least_of_bins(hashes: Column) -> Column:
    """The least hash of every bin that is not empty, in the order of signed hashes: those of one bin are neighbours there."""
    return let(F.sort_array(hashes), lambda s: F.filter(s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(s, i - 1)))))


def densified(least: Column) -> Column:
    """A value for each bin, from the non-empty array ``least``.

    An empty bin tries ``PROBES`` bins drawn by hash, then takes the filled bin that comes first in a hash order of all bins (there are few filled ones when this is needed).
    """

    def fill(known: Column) -> Column:
        def own(i: Column) -> Column:
            return F.element_at(known, i)

        def probed(i: Column) -> Column:
            tries = [own(F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
            first = F.array_min(F.transform(F.map_entries(known), lambda e: F.struct(F.xxhash64(i, e["key"], F.lit(PROBES)).alias("h"), e["value"].alias("v"))))["v"]
            return F.coalesce(own(i), *tries, first)

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), probed)

    def by_bin(mins: Column) -> Column:
        # all bins filled: the signed order starts at the upper half of the bins
        whole = F.concat(F.slice(mins, BINS // 2 + 1, BINS // 2), F.slice(mins, 1, BINS // 2))
        return F.when(F.size(mins) == BINS, whole).otherwise(let(F.map_from_arrays(F.transform(mins, bin_of), mins), fill))

    return let(least, by_bin)


def packed(bins: Column) -> Column:
    """Low bits of each bin, ``PER_LONG`` to a long."""
    def one(g: Column) -> Column:
        return F.aggregate(F.slice(bins, g * PER_LONG + 1, F.lit(PER_LONG)), F.lit(0).cast("long"), lambda a, v: F.shiftleft(a, BITS).bitwiseOR(v.bitwiseAND(F.lit((1 << BITS) - 1))))

    return F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), one)


def fingerprint(body: Column, words: int = WORDS) -> Column:
    """Packed fingerprint as an array of longs; empty for a text without words. ``body`` is not null."""
    none = F.array().cast("array<bigint>")
    return let(least_of_bins(shingle_hashes(body, words)), lambda m: F.when(F.size(m) == 0, none).otherwise(let(densified(m), packed)))


def hex_of(print_: Column) -> Column:
    return F.array_join(F.transform(print_, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1: equal bins, corrected for low bits that are equal by chance."""
    def equal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for k in range(BITS.bit_length() - 1):  # gather the bits of every value in its lowest
            d = d.bitwiseOR(F.shiftrightunsigned(d, 1 << k))
        return PER_LONG - F.bit_count(d.bitwiseAND(F.lit(LOWEST)))

    same = F.aggregate(F.zip_with(a, b, equal), F.lit(0).cast("long"), lambda s, v: s + v)
    chance = 1.0 / (1 << BITS)
    share = F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1.0 - chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), ((F.size(a) == 0) & (F.size(b) == 0)).cast("double")).otherwise(share)


def edited_fingerprints(df: DataFrame, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row.

    The next document has the next smaller key (ties by a hash of the text; a null key comes last); after the last comes the first. The edited text has its
    last ``floor(n_chars / 2)`` characters replaced by the first as many of the next document. A null text is empty; a text without words has an empty
    fingerprint, like only its equals. Repeated rows (equal key and text) are one document: each has the same result. Other columns are ignored; an
    empty table gives no rows.

    Texts are shuffled once, by document, copies folded before; what a document gives to the one before it (its beginning, no longer than half of that one's
    text, and its fingerprint) is shuffled once more. Both sides of the last join read the one shuffle of the texts.
    """
    body = F.coalesce(df[text], F.lit(""))
    node = F.coalesce(F.concat(F.lit("="), df[key].cast("string")), F.lit(""))  # not null, for joins
    docs = df.select(df[key].alias("id"), node.alias("node"), F.xxhash64(body).alias("mark"), body.alias("body"))
    known = docs.groupBy("node", "mark").agg(F.first("id").alias("id"), F.first(F.char_length("body")).cast("long").alias("chars"))
    places = cut(numbered(cut(known).withColumn("grp", F.lit("")), ["grp"], [F.col("id").desc_nulls_last(), "mark"]).drop("grp"))
    taker = places.select(F.col("node").alias("t_node"), F.col("mark").alias("t_mark"), F.col("chars").alias("t_chars"), ((F.col("idx") + 1) % F.col("n")).alias("idx"))
    links = places.select("node", "mark", "chars", "idx").join(taker, "idx").drop("idx")

    folded = docs.withColumn("print", fingerprint(F.col("body"), words)).groupBy("node", "mark").agg(
        *[F.first(c).alias(c) for c in ("id", "body", "print")], F.count(F.lit(1)).alias("copies")
    )
    own = folded.join(links.select("node", "mark", "chars"), ["node", "mark"])
    # all columns of ``folded`` are used here as well, so that its shuffle is the same for both sides and written once
    given = folded.where("copies > 0").join(links, ["node", "mark"]).select(
        F.col("t_node").alias("node"), F.col("t_mark").alias("mark"), F.left("body", F.expr("int(t_chars div 2)")).alias("start"), F.col("print").alias("next_print"), F.col("id").alias("next_id")
    )
    half = F.expr("int(chars div 2)")
    both = own.join(given, ["node", "mark"]).withColumn("edited", F.concat(F.left("body", F.col("chars").cast("int") - half), "start"))
    both = both.select("id", "chars", "print", "next_print", "next_id", "copies", F.sha2("edited", 256).alias("sha"), fingerprint(F.col("edited"), words).alias("edited_print"))
    out = both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(
        F.col("id").alias(key), F.col("chars").alias("n_chars"), F.col("sha").alias("edited_sha256"), hex_of(F.col("print")).alias("fingerprint"), hex_of(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"), "next_id",
    )
