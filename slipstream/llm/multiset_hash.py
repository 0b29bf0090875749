"""Document fingerprints by a homomorphic multiset hash, in DataFrame functions only.

A paragraph (a line with something on it) is hashed to a wide vector, and a document's fingerprint is the sum of its
paragraphs' vectors, lane by lane, modulo a power of two. So the order of paragraphs does not matter, and paragraphs can be
added to or taken from a fingerprint without the text. A vector has two parts:

- ``WHOLE`` lanes modulo 2^32, uniform hashes of the whole paragraph. Documents with equal multisets of paragraphs have
  equal sums; others have so with a chance of 2^-128.
- ``SIGNS`` lanes modulo 2^32, each the sum of +1 or -1 for each run of up to ``RUN`` words in the paragraph's sentences. The
  inner product of two such sums estimates how many runs two documents share, which gives the likeness of two fingerprints.

Sums are taken in whole-stage code by one hash aggregation over exploded runs: a 64-bit hash holds one bit for each
of 64 lanes, and two lanes are counted in each long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.llm.ordering import previous, sort_id
from slipstream.llm.staging import staged

SIGNS, WHOLE = 128, 4
_SIGN_MOD = _WHOLE_MOD = 1 << 32
#: Words of a run, counted from the beginning of its sentence.
RUN = 8
_TWO_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF
#: Where a paragraph is cut into sentences.
_SPACES = r"[\x20\x09-\x0D]+"
SENTENCE = r"(?<=[.!?])" + _SPACES
_BLANK = r"^[\x20\x09-\x0D]*$"

#: Documents whose texts meet in one group to find the next document's text.
BUCKET_BITS = 10


def _hash(value: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), value)


def _runs(text: Column) -> Column:
    """A struct for each run of words: its two hashes, and with the first of a paragraph those of the whole paragraph."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda p: ~p.rlike(_BLANK))

    def parts(p: Column) -> Column:
        def run(words: Column, i: Column, k: Column) -> Column:
            some = F.slice(words, k * RUN + 1, F.lit(RUN))
            whole = lambda seed: F.when((i == 0) & (k == 0), _hash(p, seed)).otherwise(0)
            return F.struct(_hash(some, 1).alias("s0"), _hash(some, 2).alias("s1"), whole(3).alias("p0"), whole(4).alias("p1"))

        def sentence(s: Column, i: Column) -> Column:
            words = F.split(s, _SPACES, -1)
            places = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / RUN).cast("int"))
            return F.flatten(F.transform(F.array(words), lambda w: F.transform(places, lambda k: run(w, i, k))))

        return F.flatten(F.transform(F.split(p, SENTENCE, -1), sentence))

    return F.flatten(F.transform(lines, parts))


def vectors(rows: DataFrame, keys: list[str], text: str = "text", out: str = "vector") -> DataFrame:
    """``keys`` and the fingerprint vector ``out`` (array of long) of all text with these keys.

    The texts of rows with equal keys add up. A null, empty or blank text adds nothing, and its vector is all zero.
    """
    each = rows.select(*keys, F.explode_outer(_runs(F.col(text))).alias("u")).select(*keys, "u.*")
    ones = [F.sum(F.shiftright(h, j).bitwiseAND(F.lit(_TWO_LANES))).alias(f"{h}_{j}") for h in ("s0", "s1") for j in range(32)]
    whole = [
        F.sum((F.col(p) if part == 0 else F.shiftrightunsigned(p, 32)).bitwiseAND(F.lit(_LOW))).alias(f"{p}_{part}") for p in ("p0", "p1") for part in (0, 1)
    ]
    sums = each.groupBy(*keys).agg(F.count("s0").alias("n"), *ones, *whole).na.fill(0)
    # a long holds the counts of lanes j and j + 32
    low = [2 * F.col(f"{h}_{j}").bitwiseAND(F.lit(_LOW)) - F.col("n") for h in ("s0", "s1") for j in range(32)]
    high = [2 * F.shiftrightunsigned(f"{h}_{j}", 32) - F.col("n") for h in ("s0", "s1") for j in range(32)]
    lanes = [F.pmod(x, F.lit(_SIGN_MOD)) for x in low + high] + [F.pmod(F.col(f"{p}_{part}"), F.lit(_WHOLE_MOD)) for p in ("p0", "p1") for part in (0, 1)]
    return sums.select(*keys, F.array(*lanes).alias(out))


def _reduced(vector: Column) -> Column:
    return F.transform(vector, lambda x, i: F.pmod(x, F.when(i < SIGNS, F.lit(_SIGN_MOD)).otherwise(F.lit(_WHOLE_MOD))))


def inserted(vector: Column, more: Column) -> Column:
    """The vector of a document with the paragraphs of another added."""
    return _reduced(F.zip_with(vector, more, lambda a, b: a + b))


def deleted(vector: Column, less: Column) -> Column:
    """The vector of a document with the paragraphs of another, which it has, taken away."""
    return _reduced(F.zip_with(vector, less, lambda a, b: a - b))


def as_hex(vector: Column) -> Column:
    """A vector as lowercase hex digits: four for each sign lane, which is reduced modulo 2^16, then eight for each whole lane."""
    printed = lambda x, i: F.when(i < SIGNS, F.pmod(x, F.lit(1 << 16))).otherwise(x)
    digits = F.transform(vector, lambda x, i: F.lower(F.lpad(F.hex(printed(x, i)), F.when(i < SIGNS, 4).otherwise(8), F.lit("0"))))
    return F.array_join(digits, "")


def _signed(vector: Column) -> Column:
    return F.transform(F.slice(vector, 1, SIGNS), lambda x: F.when(x >= _SIGN_MOD // 2, x - _SIGN_MOD).otherwise(x).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of word runs that two documents have in common, from their vectors: 0 to 1, and 1 if they are equal."""
    x, y = _signed(a), _signed(b)
    size = _dot(x, x) + _dot(y, y)
    shared = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * _dot(x, y) / size))).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(shared)


def _heads(own: DataFrame) -> DataFrame:
    """``(head, to)``: the first id of each bucket, and the bucket before it; before the first comes the last."""
    return previous(own.groupBy("bucket").agg(F.min("sort_id").alias("head"))).select("head", "to")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(bucket, place, own, doc_id, text, next_text)``: every document with the whole text of the next by ascending id.

    After the last comes the first. Ids are dealt out in buckets of 2^10; the first document of a bucket is also sent
    to the bucket before (``own`` false there), so one exchange of the texts is enough. A null id sorts first; rows
    with one id follow each other by a hash of their texts; null texts are empty.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), sort_id(doc_id).alias("sort_id"))
    own = own.withColumn("bucket", F.shiftright("sort_id", BUCKET_BITS))
    heads = staged(_heads(own), "heads")
    here = F.struct(F.col("bucket"), F.lit(True).alias("own"))
    there = F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("bucket"), F.lit(False).alias("own")))
    dealt = own.join(heads, own["sort_id"] == heads["head"], "left").select("doc_id", "sort_id", "text", F.explode(F.array_compact(F.array(here, there))).alias("at"))
    dealt = dealt.select("at.bucket", "at.own", "doc_id", "sort_id", "text")
    order = Window.partitionBy("bucket").orderBy(F.col("own").desc(), "sort_id", F.xxhash64("text"))
    return dealt.select("bucket", F.row_number().over(order).alias("place"), "own", "doc_id", "text", F.lead("text").over(order).alias("next_text"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text, of its edited text, and their likeness to each other and to the next document's.

    The edited text has the last quarter of the code points (rounded down) replaced by as many of the next document's
    first ones, or all if it has fewer. A single document is followed by itself. An empty table gives an empty result.
    """
    rows = with_next(docs, doc_id, text)
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - quarter), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), quarter))
    both = rows.select("bucket", "place", "own", "doc_id", F.length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"))
    both = both.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    version = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("v")
    keys = ["bucket", "place", "own", "doc_id", "n_chars", "edited_sha256"]
    found = vectors(both.select(*keys, version).select(*keys, "v.kind", "v.text"), [*keys, "kind"])
    order = Window.partitionBy("bucket").orderBy("place", "kind")
    ahead = found.withColumns({"edited_vector": F.lead("vector", 1).over(order), "next_vector": F.lead("vector", 2).over(order)})
    return ahead.where("own and kind = 0").select("doc_id", "n_chars", "edited_sha256", "vector", "edited_vector", "next_vector")
