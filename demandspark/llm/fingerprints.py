"""Document fingerprints by a homomorphic multiset hash, as column expressions.

Every paragraph (line) of a text is hashed to a wide vector, and a text's
fingerprint is the sum of its paragraphs' vectors modulo 2**16 in every lane.
So it doesn't depend on the order of paragraphs, two fingerprints are equal if
the texts hold the same paragraphs equally often, and a paragraph that is
inserted or deleted is added or subtracted without reading the rest.

The vector of a paragraph comes from its SHA-256, read as four words of 60
bits: 240 sign lanes take one bit each, 12 lanes take 16 bits each, and one lane
counts. Lanes are packed by three into a long, 20 bits apart, so that one
addition and one mask serve three lanes and no sum leaves the long. The sign
lanes, read as +1 and -1, make the product of two fingerprints an estimate of
how many paragraphs the texts share, with a deviation of about 0.065.
Blank lines count in the 12 lanes only: they tell texts apart, but make no likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import content_key, full_text, materialize
from demandspark.sources.ids import with_consecutive_id

LANE = (1 << 16) - 1
SLOT = 20                                               # bits from one lane to the next in a long
ONES = 1 | 1 << SLOT | 1 << 2 * SLOT                    # the lowest bit of each lane
MASK = LANE * ONES
BORROW = (LANE + 1) * ONES                              # what keeps a difference of lanes positive
WORDS = 4                                               # words of 60 bits in a digest
SIGNS = WORDS * SLOT                                    # longs of sign lanes
COUNT = SIGNS + WORDS                                   # place of the count
SIZE = COUNT + 1                                        # longs of a fingerprint
COPIES = 1_000_000                                      # rows made from one at once


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def empty_fingerprint() -> Column:
    """The fingerprint of no paragraph."""
    return F.array_repeat(_long(0), SIZE)


def paragraphs(text: Column) -> Column:
    """The lines of a text, blank ones too; the empty text has one, blank."""
    return F.split(text, "\n", -1)


def _words(lines: Column) -> Column:
    """Per line: whether it holds more than white space, and its digest as words."""
    hashed = F.transform(lines, lambda p: F.struct(
        p.rlike("[^\\x20\\x09-\\x0D]").alias("full"), F.sha2(p, 256).alias("hex")))
    return F.transform(hashed, lambda h: F.struct(
        h["full"].alias("full"),
        F.array(*[F.conv(F.substring(h["hex"], 1 + 15 * k, 15), 16, 10).cast("long") for k in range(WORDS)])
        .alias("words")))


def paragraph_sum(lines: Column) -> Column:
    """Sum of the vectors of an array of lines."""
    def total(words: Column, lane) -> Column:
        return F.aggregate(words, _long(0), lambda acc, w: (acc + lane(w)).bitwiseAND(_long(MASK)))

    def signs(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(SLOT - 1)), lambda j: total(
            words, lambda w: F.call_function("shiftright", w, j).bitwiseAND(_long(ONES))))

    def vector(hashed: Column) -> Column:
        def word(lines: Column, k: int) -> Column:
            return F.transform(lines, lambda x: x["words"][k])

        full = F.filter(hashed, lambda x: x["full"])
        wide = [total(word(hashed, k), lambda w: w.bitwiseAND(_long(MASK))) for k in range(WORDS)]
        return F.concat(*[signs(word(full, k)) for k in range(WORDS)],
                        F.array(*wide, F.size(full).cast("long").bitwiseAND(_long(LANE))))

    # the digests are made once, as the element of an array of one
    return F.get(F.transform(F.array(_words(lines)), vector), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as an array of packed lanes."""
    return paragraph_sum(paragraphs(text))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of two fingerprints together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(_long(MASK)))


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of ``a`` without those of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x + (_long(BORROW) - y)).bitwiseAND(_long(MASK)))


def as_text(fp: Column) -> Column:
    """A fingerprint as hex digits, 15 for each long."""
    return F.array_join(F.transform(fp, lambda w: F.lpad(F.lower(F.hex(w)), 15, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared paragraphs as a share of both texts' paragraphs, from 0 to 1, as the sign
    lanes estimate it. Equal fingerprints give 1, without any paragraph on one side 0."""
    def signed(word: Column, l: int, fp: Column) -> Column:
        s = F.call_function("shiftright", word, F.lit(l * SLOT)).bitwiseAND(_long(LANE))
        # 2 * ones - count, as a number around zero
        centred = (s * 2 - F.get(fp, F.lit(COUNT)) + _long((1 << 15) + (1 << 16))).bitwiseAND(_long(LANE))
        return centred - _long(1 << 15)

    def lanes(fp: Column) -> Column:
        return F.flatten(F.transform(F.slice(fp, 1, SIGNS), lambda w: F.array(*[signed(w, l, fp) for l in range(3)])))

    def total(x: Column) -> Column:
        return F.aggregate(x, _long(0), lambda s, v: s + v)

    def ratio(z: Column) -> Column:
        both = total(F.zip_with(z["a"], z["b"], lambda x, y: x * y)) * 2
        size = total(F.zip_with(z["a"], z["b"], lambda x, y: x * x + y * y))
        return F.when(size == 0, F.lit(0.0)).otherwise(
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), both.cast("double") / size.cast("double"))))

    # the lanes are unpacked once, as elements of an array of one
    pair = F.array(F.struct(lanes(a).alias("a"), lanes(b).alias("b")))
    return F.when(a == b, F.lit(1.0)).otherwise(F.get(F.transform(pair, ratio), F.lit(0)))


def replace_tail(fp: Column, text: Column, kept: Column, new: Column) -> Column:
    """The fingerprint of ``text`` whose code points after the first ``kept`` give way to ``new``: the
    lines from the cut on are subtracted, what stands there then is added."""
    head = F.substring_index(F.left(text, kept), "\n", -1)     # what is left of the line that is cut
    old = F.substr(text, kept - F.char_length(head) + 1)
    return add(subtract(fp, paragraph_sum(paragraphs(old))), paragraph_sum(paragraphs(F.concat(head, new))))


def _times(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, which is dropped; no row's array is longer than COPIES."""
    some = df.withColumn("_b", F.explode(F.sequence(_long(0), F.floor((F.col(times) - 1) / COPIES).cast("long"))))
    left = F.least(_long(COPIES), F.col(times) - F.col("_b") * COPIES)
    return some.withColumn("_c", F.explode(F.sequence(_long(1), left))).drop("_b", "_c", times)


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every text, and that text edited with the start of the next document.

    docs: doc_id, text (other columns are ignored, whatever their names). The
    edited text is the text with its last floor(n_chars / 2) code points
    replaced by as many, or all, first ones of the next document in descending
    doc_id (null last, then by content hashes; the first follows the last).
    Returns one row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. A null text is empty; repeated
    rows follow each other, so all but one of them are edited with their own
    start; a lone document follows itself; an empty table gives no rows.
    """
    key = ["d", "missing", "k1", "k2"]     # none is null, so that one shuffle by them serves every join
    base = (docs.select(F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("missing"),
                        full_text().alias("_t"))
            .select("d", "missing", "_t", *content_key(F.col("_t"))))
    rows = (base.withColumn("n", F.char_length("_t").cast("long")).groupBy(*key)
            .agg(F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")))
    numbered = materialize(with_consecutive_id(rows, ["missing", F.desc("d"), "k1", "k2"], "place"), "places")
    last = numbered.agg(F.max("place")).first()[0] or 1
    after = numbered.select(*[F.col(c).alias(f"next_{c}") for c in key], F.col("place").alias("next_place"))
    steps = materialize(numbered.join(after, F.col("place") % last + 1 == F.col("next_place"))
                        .select(*key, "copies", F.col("n"), F.floor(F.col("n") / 2).cast("int").alias("half"),
                                *[f"next_{c}" for c in key]), "steps")
    # one text of each; the same shuffle serves both sides
    texts = base.groupBy(*key).agg(F.first("_t").alias("_t"))
    starts = (texts.join(steps.select(*[F.col(f"next_{c}").alias(c) for c in key],
                                      *[F.col(c).alias(f"own_{c}") for c in key], "half"), key)
              .select(*[F.col(f"own_{c}").alias(c) for c in key], F.left("_t", F.col("half")).alias("start"),
                      fingerprint(F.col("_t")).alias("next_fp")))
    own = (texts.join(steps.select(*key, "copies", "n", "half"), key)
           .select(*key, "_t", "copies", "n", "half", fingerprint(F.col("_t")).alias("fp")))
    met = own.join(starts, key).withColumn("doc_id", F.when(~F.col("missing"), F.col("d")))
    follow = F.array(F.struct(F.col("start"), F.col("next_fp").alias("fp"), F.lit(1).cast("long").alias("times")))
    itself = F.array(F.struct(F.left("_t", F.col("half")).alias("start"), F.col("fp").alias("fp"),
                              (F.col("copies") - 1).alias("times")))
    each = met.select("doc_id", "_t", "n", "fp", (F.col("n") - F.col("half")).cast("int").alias("kept"),
                      F.explode(F.when(F.col("copies") > 1, F.concat(follow, itself)).otherwise(follow)).alias("x"))
    edited = each.select("doc_id", "n", "fp", "x", F.concat(F.left("_t", F.col("kept")), "x.start").alias("edited"),
                         replace_tail(F.col("fp"), F.col("_t"), F.col("kept"), F.col("x.start")).alias("edited_fp"))
    out = edited.select(
        "doc_id", F.col("n").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("x.fp")).alias("near_next"), F.col("x.times").alias("times"))
    return _times(out, "times")
