"""Document fingerprints by winnowing, in DataFrame functions only.

Every run of ``GRAM`` code points has a hash of 31 bits. Of every ``WINDOW``
successive hashes the smallest is chosen, the rightmost of equal ones: a hash
and its position make one number whose order does that, and the minima of all
windows are found at once by doubling. The fingerprint is the list of chosen
(hash, position), so two texts that share ``GRAM + WINDOW - 1`` code points
anywhere share a chosen hash, and no match shorter than ``GRAM`` counts. Text is
taken as it stands: letter case and separators matter.

SQL arrays have no running state, so the runs are cut by one regular expression
that moves on by a code point, and each is hashed by itself; a hash updated from
its predecessor took twice the time as array functions. Long texts are cut into
blocks of ``BLOCK`` window starts that overlap by a window, so the arrays in
memory are those of a block and a fingerprint (8 bytes for ``WINDOW / 2`` code
points), whatever the length.

A text shorter than a run is one run by itself, one with fewer runs than a
window one window; an empty or null text has an empty fingerprint. Likeness is
the Jaccard index of the sets of hashes; of two empty ones it is 1.

``edited_likeness`` sets each document against the next one in descending order
of ids, whole numbers. A null id comes last; rows that share an id follow each
other by a hash of their texts, and rows that are equal in both are next to each
other. Only ids and hashes are sorted as a whole. Their order is cut into at
most 65,536 chunks, whose first keys are all that reaches the driver; a text is
shuffled once, to its chunk, and the first of each chunk to the one before it
too, with the positions of its fingerprint; the hashes are made again from them. Chunks are bounded in rows, except that equal rows (id and text) share one.
Columns besides doc_id and text are not read. An empty table gives no rows; a
single document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import materialize, numbered

GRAM = 16
WINDOW = 32
BLOCK = 4096
SPAN = GRAM + WINDOW - 1
"""Shortest passage that is sure to share a chosen hash."""
ALL = 2**30  # more than an array holds here; larger lengths overflow in slice
HASH_BITS = 0x7FFFFFFF00000000
CELL = 256
CHUNK_ROWS = 256
FANOUT = 256


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _doubled(start: Column, to: int, combine) -> Column:
    """Fold ``to`` (a power of two) neighbours of every element, in log2 passes;
    what reaches over the end is combined with null."""

    def step(values: Column, size: int) -> Column:
        if size == to:
            return values
        joined = F.zip_with(values, F.slice(values, size + 1, ALL), lambda x, y: combine(x, y))
        return _let(joined, lambda v: step(v, 2 * size))

    return _let(start, lambda v: step(v, 1))


def gram_hashes(text: Column) -> Column:
    """The hash of every run, in the upper 31 bits; of the whole text if that is
    shorter than a run; none of no text."""
    runs = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))."), F.lit(1))
    short = F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(text))
    return F.transform(
        F.when(F.length(text) >= GRAM, runs).otherwise(short), lambda run: F.xxhash64(run).bitwiseAND(F.lit(HASH_BITS))
    )


def _blocks(text: Column) -> Column:
    """``BLOCK`` window starts each, with the rest of their last window."""
    windows = F.greatest(F.length(text) - (SPAN - 1), F.lit(1))
    cut = f"(?s)(?=(.{{1,{BLOCK + SPAN - 1}}})).{{1,{BLOCK}}}"
    return F.slice(F.regexp_extract_all(text, F.lit(cut), F.lit(1)), 1, F.ceil(windows / BLOCK).cast("int"))


def _chosen(block: Column) -> Column:
    """Chosen numbers of a block: the hash in the upper bits, less the position."""

    def choose(hashes: Column) -> Column:
        smallest = _doubled(F.transform(hashes, lambda h, i: h - i), WINDOW, F.least)
        return F.array_distinct(F.slice(smallest, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(1))))

    return _let(gram_hashes(block), choose)


def chosen_offsets(text: Column) -> Column:
    """Where the chosen runs of each block start, in two bytes each: with the
    text all there is to a fingerprint, and small enough to be shuffled."""
    return F.transform(
        _blocks(text), lambda b: F.transform(_chosen(b), lambda v: position_of(v).cast("smallint"))
    )


def from_offsets(text: Column, offsets: Column) -> Column:
    """Chosen (hash, position) numbers, by position. Runs are taken from short
    cells of the text, since a part of a string is found by counting to it."""
    cells = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{CELL + GRAM - 1}}})).{{1,{CELL}}}"), F.lit(1))
    places = F.flatten(F.transform(offsets, lambda own, i: F.transform(own, lambda at: at.cast("int") + i * BLOCK)))

    def numbers(cell: Column) -> Column:
        def number(at: Column) -> Column:
            run = F.substring(F.get(cell, F.floor(at / CELL).cast("int")), at % CELL + 1, F.lit(GRAM))
            return F.xxhash64(run).bitwiseAND(F.lit(HASH_BITS)) - at

        return F.transform(F.array_distinct(places), number)

    return _let(cells, numbers)


def fingerprint(text: Column) -> Column:
    """Chosen (hash, position) numbers of a text that is not null, by position."""
    return F.array_distinct(
        F.flatten(F.transform(_blocks(text), lambda b, i: F.transform(_chosen(b), lambda v: v - i.cast("long") * BLOCK)))
    )


def hash_of(value: Column) -> Column:
    return F.shiftright(value + F.lit(2**32 - 1), 32)


def position_of(value: Column) -> Column:
    return F.pmod(-value, F.lit(2**32))


def hashes_of(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, hash_of))


def as_text(chosen: Column) -> Column:
    """``hash:position`` of each, comma-joined."""
    return F.array_join(F.transform(chosen, lambda v: F.concat_ws(":", hash_of(v), position_of(v))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two sets of hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both.cast("double") / either)


def _joined(first: Column, first_chosen: Column, kept: Column, second: Column, second_chosen: Column, added: Column) -> Column:
    """The fingerprint of ``first[:kept] + second[:added]`` from the two texts'
    own and the windows at the seam: what windows within a prefix chose is what
    the text chose, up to what the prefix's last window chose."""

    def upto(chosen: Column, last: Column) -> Column:
        return _let(position_of(last), lambda at: F.filter(chosen, lambda v: position_of(v) <= at))

    def build(seam: Column) -> Column:
        tail = fingerprint(F.substring(second, added - (SPAN - 1), F.lit(SPAN)))[0] - (added - SPAN)
        behind = F.transform(upto(second_chosen, tail), lambda v: v - kept)
        return F.array_distinct(F.concat(upto(first_chosen, seam[0]), seam, behind))

    joint = F.concat(F.substring(first, kept - (SPAN - 1), F.lit(SPAN)), F.left(second, F.lit(SPAN)))
    shifted = F.transform(fingerprint(joint), lambda v: v - (kept - SPAN))
    whole = fingerprint(F.concat(F.left(first, kept), F.left(second, added)))
    return F.when((kept >= SPAN) & (added >= SPAN), _let(shifted, build)).otherwise(whole)


def _order(doc_id: Column, text: Column) -> Column:
    """Text whose ascending order is that of documents: id descending, null last, then hash."""

    def digits(value: Column) -> Column:  # of two's complement, least long first
        return F.lpad(F.hex(value.bitwiseXOR(F.lit(-(2**63)))), 16, "0")

    down = digits(F.bitwise_not(F.coalesce(doc_id.cast("long"), F.lit(0).cast("long"))))
    return F.concat(F.when(doc_id.isNull(), "1").otherwise("0"), down, digits(F.xxhash64(text)))


def _chunk(key: Column, firsts: list[str]) -> tuple[Column, Column]:
    """(number of the last of the sorted ``firsts`` that is not after ``key``, whether it is equal)."""
    groups = [firsts[i : i + FANOUT] for i in range(0, len(firsts), FANOUT)]
    heads = F.split(F.lit(",".join(g[0] for g in groups)), ",")
    within = F.transform(F.split(F.lit(";".join(",".join(g) for g in groups)), ";"), lambda g: F.split(g, ","))
    group = F.size(F.filter(heads, lambda h: h <= key)) - 1
    place = _let(within[group], lambda own: F.struct(F.size(F.filter(own, lambda h: h <= key)).alias("n"), F.array_contains(own, key).alias("first")))
    return group * FANOUT + place["n"] - 1, place["first"]


def _beside_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, text, offsets, next: struct of the same) of every row."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("key", _order(F.col("doc_id"), F.col("text")))
    keys = numbered(spark, materialize(spark, base.select("key"), "winnow-keys"), ["key"], "winnow-order")
    rows = max(CHUNK_ROWS, -(-keys.count() // FANOUT**2))
    firsts = sorted({r.key for r in keys.where((F.col("place") - 1) % rows == 0).select("key").collect()})
    if not firsts:
        firsts = [""]
    chunk, first = _chunk(F.col("key"), firsts)
    base = base.withColumn("chunk", chunk).withColumn("first", first).withColumn("offsets", chosen_offsets(F.col("text")))
    own = F.struct(F.col("chunk"), F.lit(False).alias("lent"))
    before = F.struct(F.pmod(F.col("chunk") - 1, F.lit(len(firsts))).alias("chunk"), F.lit(True).alias("lent"))
    dealt = base.withColumn("to", F.explode(F.when(F.col("first"), F.array(own, before)).otherwise(F.array(own))))
    dealt = dealt.select("to.chunk", "to.lent", "key", "doc_id", "text", "offsets")
    order = Window.partitionBy("chunk").orderBy("lent", "key")
    beside = dealt.withColumn("next", F.lead(F.struct("doc_id", "text", "offsets")).over(order))
    return beside.where(~F.col("lent")).select("doc_id", "text", "offsets", "next")


def edited_likeness(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, next_id) of every row: its text against that text
    with the second half replaced by the beginning of the next document."""
    rows = _beside_next(spark, docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select(
        "doc_id",
        "text",
        from_offsets(F.col("text"), F.col("offsets")).alias("own"),
        n.cast("long").alias("n_chars"),
        (n - half).alias("kept"),
        F.least(half, F.length("next.text")).alias("added"),
        F.col("next.doc_id").alias("next_id"),
        F.col("next.text").alias("next_text"),
        from_offsets(F.col("next.text"), F.col("next.offsets")).alias("next"),
    )
    edited = F.concat(F.left("text", F.col("kept")), F.left("next_text", F.col("added")))
    rows = rows.select(
        "doc_id",
        "next_id",
        "n_chars",
        "own",
        "next",
        F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
        _joined(*(F.col(c) for c in ("text", "own", "kept", "next_text", "next", "added"))).alias("edited"),
    )
    rows = rows.withColumn("hashes", hashes_of(F.col("own")))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), hashes_of(F.col("edited"))).alias("near_edited"),
        likeness(F.col("hashes"), hashes_of(F.col("next"))).alias("near_next"),
        "next_id",
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with the array ``fingerprint`` of (hash long, position long)."""
    chosen = fingerprint(F.coalesce("text", F.lit("")))
    pair = F.transform(chosen, lambda v: F.struct(hash_of(v).alias("hash"), position_of(v).alias("position")))
    return docs.withColumn("fingerprint", pair)
