"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a bag of words weighted by how often they occur.  For each of
``SAMPLES`` samples every word k of weight S draws, from hashes of (k,
sample), r and c of Gamma(2, 1) and b of U(0, 1), and has

    t = floor(ln S / r + b),    ln a = ln c - r (t - b + 1);

the word of least a gives the sample (k, t).  Two texts share a sample with
probability sum(min(S, S')) / sum(max(S, S')), the generalised Jaccard
similarity of their bags, so the share of equal samples estimates it
(standard error at most 0.5 / sqrt(SAMPLES)).

A sample is held in one long, ln a in fixed point above 32 bits of a hash
of (k, t), so that the smallest long is the sample and a fingerprint is a
plain minimum per sample; the hash is what a fingerprint keeps.  Word counts come from sorted hashes within a
row; the words of a text never leave its partition.  A word of both texts of
a document draws once for both: only t and a depend on its count.

The edited text of a document has its last third replaced by the head of
the document before it in ascending id order (the next one, descending).
Neighbours are found by a range partitioning of the ids; only the heads,
cut to the length needed, travel to the document that takes them.

Cases: null text counts as empty; a text without words has one pseudo-word,
so such texts are alike and unlike all others; rows that repeat an id are
one document (its smallest text); rows without an id have no neighbour and
are left out; a single document is its own neighbour; an empty table gives
no rows; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queryscope.llm.common import documents, ids_and_texts, stored

SAMPLES = 32
LOW = 0xFFFFFFFF


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bag(text: Column) -> Column:
    """array<struct<w, tf>>: hashes of the words of a text and their counts."""
    words = F.filter(F.split(text, r"[ \t-\r]+"), lambda x: x != "")
    hashes = F.sort_array(F.transform(F.when(F.size(words) > 0, words).otherwise(F.array(F.lit(""))), lambda x: F.xxhash64(x)))

    def counted(h):
        first = F.filter(F.sequence(F.lit(1), F.size(h)),
                         lambda i: (i == 1) | (F.element_at(h, i) != F.element_at(h, F.greatest(i - 1, F.lit(1)))))
        return let(F.concat(first, F.array(F.size(h) + 1)), lambda p: F.transform(
            F.slice(p, 1, F.size(p) - 1),
            lambda v, j: F.struct(F.element_at(h, v).alias("w"), (F.element_at(p, j + 2) - v).alias("tf"))))

    return let(hashes, counted)


def bags(own: Column, edited: Column) -> Column:
    """array<struct<w, own, edited>>: the words of either text and their counts in both; null where a text has none."""
    def of(text, side):
        return F.transform(bag(text), lambda x: F.struct(x["w"].alias("w"), F.lit(side).alias("side"), x["tf"].alias("tf")))

    def merged(m):
        first = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (F.get(m, i)["w"] != F.get(m, i - 1)["w"]))
        return F.transform(first, lambda i: F.struct(
            F.get(m, i)["w"].alias("w"),
            F.when(F.get(m, i)["side"] == 0, F.get(m, i)["tf"]).alias("own"),
            F.when(F.get(m, i)["side"] == 1, F.get(m, i)["tf"])
            .when(F.get(m, i + 1)["w"] == F.get(m, i)["w"], F.get(m, i + 1)["tf"]).alias("edited")))

    return let(F.sort_array(F.concat(of(own, 0), of(edited, 1))), merged)


def uniform(h: Column, shift: int, bits: int) -> Column:
    """``bits`` bits of a hash as a number strictly between 0 and 1."""
    return (F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) + F.lit(0.5)) / float(1 << bits)


def drawn(df: DataFrame, w: str, samples: int) -> DataFrame:
    """A row for each row and sample: ``df``'s columns, the sample's number, r, b, ln c and the hash g that names it.

    Columns of their own, as an expression that is used twice is computed twice.
    """
    h, g = F.col("__h"), F.col("__g")
    return (df.select("*", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("__i"))
            .select("*", F.xxhash64(w, 2 * F.col("__i")).alias("__h"), F.xxhash64(w, 2 * F.col("__i") + 1).alias("__g"))
            .select("*", (-F.log(uniform(h, 0, 24) * uniform(h, 24, 24))).alias("__r"), uniform(h, 48, 16).alias("__b"),
                    F.log(-F.log(uniform(g, 0, 20) * uniform(g, 20, 20))).alias("__ln_c")))


def sample(t: Column) -> Column:
    """The long of a row of ``drawn`` whose t is known."""
    ln_a = F.col("__ln_c") - F.col("__r") * (t - F.col("__b") + 1)
    fixed = F.floor((ln_a + 160) * float(1 << 22)).cast("long")  # -160 < ln a < 32 for weights below e^64
    name = F.col("__g").bitwiseXOR(F.xxhash64(t)).bitwiseAND(F.lit(LOW).cast("long"))
    return F.shiftleft(fixed, 32).bitwiseOR(name)


def fingerprints(df: DataFrame, keys: list[str], w: str = "w", weight: str | dict[str, str] = "weight", samples: int = SAMPLES,
                 kept: list[str] | None = None) -> DataFrame:
    """keys, ``kept``, samples array<int>, over (keys, word hash, positive weight) rows; ``kept``: columns that depend on the keys.

    ``weight`` may be a dictionary from weight columns to names of their
    fingerprints: what a word draws is then drawn once for all of them.  A
    word whose weight is null takes no part.
    """
    out = weight if isinstance(weight, dict) else {weight: "samples"}
    rows = drawn(df.select(*keys, *(kept or []), w, *[F.log(x).alias(f"__ln_{name}") for x, name in out.items()]), w, samples)
    rows = rows.select("*", *[F.floor(F.col(f"__ln_{name}") / F.col("__r") + F.col("__b")).alias(f"__t_{name}") for name in out.values()])
    least = rows.groupBy(*keys, "__i").agg(*[F.min(sample(F.col(f"__t_{name}"))).alias(name) for name in out.values()],
                                           *[F.max(c).alias(c) for c in kept or []])

    def in_order(name):
        return F.transform(F.sort_array(F.collect_list(F.struct("__i", name))), lambda x: F.shiftright(F.shiftleft(x[name], 32), 32).cast("int"))

    return least.groupBy(*keys).agg(*[F.max(c).alias(c) for c in kept or []], *[in_order(name).alias(name) for name in out.values()])


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of equal samples."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(samples))


def as_text(col: str) -> Column:
    return F.concat_ws("", F.transform(col, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(LOW).cast("long"))), 8, "0")))


def before(ids: DataFrame) -> DataFrame:
    """doc_id, next_id: the largest smaller id, or the largest of all for the smallest."""
    ranged = stored(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "fingerprint-ids")
    ends = ranged.groupBy("part").agg(F.max("doc_id").alias("last"))  # a row for each partition
    over = Window.orderBy("part")
    ends = ends.select("part", F.coalesce(F.lag("last").over(over), F.max("last").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("end"))
    own = Window.partitionBy("part").orderBy("doc_id")
    return (ranged.withColumn("own", F.lag("doc_id").over(own)).join(F.broadcast(ends), "part")
            .select("doc_id", F.coalesce("own", "end").alias("next_id")))


def edited(texts: DataFrame, order: DataFrame) -> DataFrame:
    """doc_id, next_id, text, edited."""
    own = texts.join(order, "doc_id").withColumn("third", F.expr("char_length(text) div 3"))
    wanted = own.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), "third")
    heads = texts.join(wanted, "doc_id").select(F.col("for_id").alias("doc_id"), F.expr("substring(text, 1, int(third))").alias("head"))
    return own.join(heads, "doc_id").select(
        "doc_id", "next_id", "text",
        F.concat(F.expr("substring(text, 1, int(char_length(text) - third))"), "head").alias("edited"))


def digits(sha: Column) -> list[Column]:
    """A hexadecimal digest as four longs, which aggregate like any number."""
    return [F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("long").alias(f"d{i}") for i in range(4)]


def op6(spark, sf_dir: str) -> DataFrame:
    docs = ids_and_texts(documents(spark, sf_dir)).where("doc_id is not null")
    order = stored(before(docs.select("doc_id").distinct()), "fingerprint-order")
    both = edited(docs.groupBy("doc_id").agg(F.min("text").alias("text")), order)
    about = ["next_id", "n_chars", "d0", "d1", "d2", "d3"]
    # a document's own columns lie below the explode, so they are computed once a document
    whole = (both.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("sha", F.sha2("edited", 256))
             .select("doc_id", "next_id", "n_chars", *digits(F.col("sha")), "text", "edited"))
    words = whole.select("doc_id", *about, F.explode(bags(F.col("text"), F.col("edited"))).alias("x"))
    # both texts of a document share most of their words
    terms = words.select("doc_id", *about, "x.w", F.col("x.own").cast("double").alias("tf"), F.col("x.edited").cast("double").alias("edited_tf"))
    rows = stored(fingerprints(terms, ["doc_id"], weight={"tf": "own", "edited_tf": "edit"}, kept=about), "fingerprints")
    following = rows.select(F.col("doc_id").alias("next_id"), F.col("own").alias("following"))
    sha = F.lower(F.concat(*[F.lpad(F.hex(f"d{i}"), 16, "0") for i in range(4)]))
    return (rows.join(following, "next_id")
            .select("doc_id", "n_chars", sha.alias("edited_sha256"), as_text("own").alias("fingerprint"), as_text("edit").alias("edited_fingerprint"),
                    likeness("own", "edit").alias("near_edited"), likeness("own", "following").alias("near_next")))
