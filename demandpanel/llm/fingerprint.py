"""Document fingerprints by consistent weighted sampling, in DataFrame expressions alone.

For a term of weight w and sample k let r and c be Gamma(2, 1) and b uniform, all three drawn
from hashes of (term, k). With t = floor(ln w / r + b), the term bids ln c - r * (t - b + 1),
and the lowest bid of a document gives its sample (term, t). Two documents draw the same
sample with a probability equal to the generalised Jaccard similarity of their weights, the
sum of minima over the sum of maxima.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What lies between the words of a lower-cased text: ASCII letters and digits, and all that is
#: not ASCII, make words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SAMPLES = 64
#: Samples drawn from one exploded row: small enough for the JVM to compile the loop body.
AT_ONCE = 4
#: A bid b is kept as floor((b + BID_OFFSET) * BID_SCALE) in the upper half of a long; bids
#: lie between -90 and 4 for weights up to 10 ** 9.
BID_OFFSET, BID_SCALE = 96.0, float(1 << 24)
#: Rows a bucket of neighbouring ids aims at, and bounds kept as a literal.
BUCKET_ROWS, BOUNDS = 1500, 512

_HALF = float(1 << 32)


def _words(text: Column) -> Column:
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN)
    return F.transform(F.array_remove(found, ""), lambda word: F.xxhash64(word))


def weighted(df: DataFrame, texts: list[Column], column: str = "terms") -> DataFrame:
    """Add the distinct terms of one or two texts with their counts in each.

    ``array<struct<term: bigint, w0: int, w1: int>>``. Terms are hashes of words; a text without
    words (null counts as empty) is one term of its own, so that every text has a term. Sorted tagged hashes bring the
    occurrences of a term together, so the cost is that of a sort, also for very long texts.
    """
    s, at, runs = (f"__cws_{x}" for x in ("sorted", "at", "runs"))
    out, tagged = df, []
    # Each step is a column of its own, so that no expression is evaluated inside a lambda.
    for k, text in enumerate(texts):
        words = f"__cws_words{k}"
        out = out.withColumn(words, _words(text))
        own = F.array(F.xxhash64(F.coalesce(text, F.lit("")), F.lit(True)))
        some = F.when(F.size(words) > 0, F.col(words)).otherwise(own)
        tag = (lambda h: h.bitwiseOR(F.lit(1))) if k else (lambda h: h.bitwiseAND(F.lit(~1)))
        tagged.append(F.transform(some, tag))
    out = out.withColumn(s, F.sort_array(F.concat(*tagged)))
    out = out.withColumn(
        at,
        F.expr(f"filter(sequence(0, size({s}) - 1), i -> i = 0 OR {s}[i] <> {s}[greatest(i - 1, 0)])"),
    )
    out = out.withColumn(
        runs,
        F.expr(
            f"transform({at}, (a, j) -> named_struct('x', {s}[a], 'n', "
            f"if(j + 1 < size({at}), {at}[least(j + 1, size({at}) - 1)], size({s})) - a))"
        ),
    )
    after = f"{runs}[least(j + 1, size({runs}) - 1)]"
    before = f"{runs}[greatest(j - 1, 0)]"
    paired = F.expr(
        f"filter(transform({runs}, (r, j) -> CASE"
        f" WHEN r.x & 1 = 0 THEN named_struct('term', r.x, 'w0', r.n,"
        f" 'w1', if({after}.x = (r.x | 1), {after}.n, 0))"
        f" WHEN {before}.x <> (r.x & -2) THEN named_struct('term', r.x & -2, 'w0', 0, 'w1', r.n)"
        f" END), u -> u IS NOT NULL)"
    )
    return out.withColumn(column, paired).drop(s, at, runs, *[f"__cws_words{k}" for k in range(len(texts))])


def _uniform(bits: Column) -> Column:
    """The lower 32 bits as a double between 0 and 1, both excluded."""
    return (bits.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double") + 0.5) / _HALF


def _gamma(bits: Column) -> Column:
    """Gamma(2, 1) from 64 bits: minus the logarithm of a product of two uniforms."""
    return -F.log(_uniform(bits) * _uniform(F.shiftrightunsigned(bits, 32)))


def signatures(df: DataFrame, keys: list[str], column: str = "terms", samples: int = SAMPLES):
    """``keys`` and ``sig0, sig1: array<bigint>``, the samples of both weights of ``column``.

    ``keys`` must tell the rows apart. If ``df`` is already distributed by some of them, no
    row moves. Without terms of one weight, its samples are -1.
    """
    if samples % AT_ONCE:
        raise ValueError(f"samples must be a multiple of {AT_ONCE}")
    # Not a plain explode: from that a filter on the whole expression of ``column`` is inferred
    # and evaluated once more below the window.
    one = df.select(*keys, F.explode_outer(column).alias("__cws_u"))
    one = one.select(
        *keys,
        F.col("__cws_u.term").alias("__cws_term"),
        *[
            F.when(F.col(f"__cws_u.w{k}") > 0, F.log(F.col(f"__cws_u.w{k}").cast("double"))).alias(
                f"__cws_ln{k}"
            )
            for k in (0, 1)
        ],
    )
    groups = F.array(*[F.lit(g) for g in range(samples // AT_ONCE)])
    one = one.select("*", F.explode(groups).alias("__cws_g"))
    base = F.xxhash64(F.col("__cws_term"), F.col("__cws_g"))
    one = one.withColumn("__cws_h", base)
    drawn = []
    for k in range(AT_ONCE):
        first, second, third = (
            F.xxhash64(F.col("__cws_h").bitwiseXOR(F.lit(3 * k + j + 1))) for j in range(3)
        )
        drawn += [
            _gamma(first).alias(f"__cws_r{k}"),
            F.log(_gamma(second)).alias(f"__cws_c{k}"),
            _uniform(third).alias(f"__cws_b{k}"),
        ]
    one = one.select(*keys, "__cws_g", "__cws_h", "__cws_ln0", "__cws_ln1", *drawn)
    lows = []
    for w in (0, 1):
        for k in range(AT_ONCE):
            r, c, b = (F.col(f"__cws_{x}{k}") for x in "rcb")
            t = F.floor(F.col(f"__cws_ln{w}") / r + b)
            bid = F.floor((c - r * (t - b + 1) + BID_OFFSET) * BID_SCALE)
            name = F.xxhash64(F.col("__cws_h").bitwiseXOR(t)).bitwiseAND(F.lit(0xFFFFFFFF))
            packed = F.when(
                F.col(f"__cws_ln{w}").isNotNull(), F.shiftleft(bid, 32).bitwiseOR(name)
            )
            lows.append(F.min(packed).alias(f"__cws_low{w}_{k}"))
    low = one.groupBy(*keys, "__cws_g").agg(*lows)
    parts = [
        F.array(
            *[
                F.coalesce(F.col(f"__cws_low{w}_{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(-1))
                for k in range(AT_ONCE)
            ]
        ).alias(f"s{w}")
        for w in (0, 1)
    ]
    joined = low.select(*keys, F.struct(F.col("__cws_g").alias("g"), *parts).alias("part"))
    whole = joined.groupBy(*keys).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.select(
        *keys, *[F.flatten(F.col("parts")[f"s{w}"]).alias(f"sig{w}") for w in (0, 1)]
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples: an estimate of the generalised Jaccard similarity."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.size(a)


def as_string(signature: Column) -> Column:
    """Eight hexadecimal digits a sample."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """``doc_id, fingerprint: array<bigint>``, one row for every row of ``docs``."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__cws_text")
    )
    # Rows may repeat; equal texts have equal signatures, so one of each suffices.
    distinct = weighted(rows.select("__cws_text").distinct(), [F.col("__cws_text")])
    distinct = distinct.withColumn("__cws_key", F.sha2("__cws_text", 256))
    sigs = signatures(distinct, ["__cws_key"], samples=samples)
    rows = rows.select("doc_id", F.sha2("__cws_text", 256).alias("__cws_key"))
    return rows.join(sigs, "__cws_key").select("doc_id", F.col("sig0").alias("fingerprint"))


def _buckets(docs: DataFrame, order: str) -> Column:
    """Buckets of neighbouring values: quantiles, each cut into equal widths if there are many."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = docs.count()
    wanted = max(4 * parts, n // BUCKET_ROWS)
    coarse = min(wanted, BOUNDS)
    cuts = [k / coarse for k in range(coarse + 1)]
    found = docs.select(F.percentile_approx(order, F.array(*map(F.lit, cuts)), 10_000)).first()[0]
    bounds = sorted(set(found or [0]))
    fine = -(-wanted // len(bounds))
    lows = F.array(*map(F.lit, bounds))
    at = F.greatest(F.size(F.filter(lows, lambda b: b <= F.col(order))), F.lit(1))
    if fine == 1:
        return F.coalesce(at.cast("long"), F.lit(0))
    low = F.get(lows, at - 1)
    width = F.greatest(F.coalesce(F.get(lows, at), low + 1) - low, F.lit(1))
    step = F.floor((F.col(order) - low).cast("double") / width * fine)
    step = F.least(F.greatest(step, F.lit(0)), F.lit(fine - 1))
    return F.coalesce(at.cast("long") * fine + step, F.lit(0))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows by descending id in buckets, each with the text that follows it in that order.

    Columns ``bucket, seq, guest, doc_id, text, next_text``, distributed by ``bucket`` and in
    the order of ``seq`` there. The texts are shuffled once. The first row of every bucket is
    also sent, as a guest, to the bucket before; that of the first to the last, which closes
    the circle. Rows of the same id follow each other by their text's hash; null ids come last.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    bucket = _buckets(base, "doc_id")
    base = base.withColumn("bucket", bucket)
    tops = base.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    # One row a bucket.
    up = Window.orderBy("bucket")
    lowest = F.min("bucket").over(Window.partitionBy())
    tops = tops.select(
        F.col("bucket").alias("home"),
        "top",
        F.coalesce(F.lead("bucket").over(up), lowest).alias("target"),
    )
    guests = base.join(
        tops, (base["bucket"] == tops["home"]) & base["doc_id"].eqNullSafe(tops["top"])
    ).select("doc_id", "text", F.col("target").alias("bucket"), F.lit(True).alias("guest"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = base.withColumn("guest", F.lit(False)).unionByName(guests).repartition(parts, "bucket")
    line = Window.partitionBy("bucket").orderBy(
        "guest", F.desc_nulls_last("doc_id"), F.xxhash64("text")
    )
    return both.select(
        "bucket",
        F.row_number().over(line).alias("seq"),
        "guest",
        "doc_id",
        "text",
        F.lead("text").over(line).alias("next_text"),
    )


def compare_edited(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    The edited text has the last third of the code points (rounded down) replaced by the first
    as many, or all, of the text that follows by descending id; the last is followed by the
    first. Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. A null text counts as empty; repeated rows stay; an empty table
    gives an empty one; other columns are not read.
    """
    rows = with_next(docs, doc_id, text)
    third = F.floor(F.char_length("text") / 3).cast("int")
    rows = rows.select(
        "bucket",
        "seq",
        "guest",
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "text",
        F.concat(
            F.substring("text", F.lit(1), F.char_length("text") - third),
            F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third),
        ).alias("edited"),
    )
    rows = weighted(rows, [F.col("text"), F.col("edited")])
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256)).drop("text", "edited")
    keys = ["bucket", "seq", "guest", "doc_id", "n_chars", "edited_sha256"]
    signed = signatures(rows, keys, samples=samples)
    line = Window.partitionBy("bucket").orderBy("seq")
    signed = signed.withColumn("following", F.lead("sig0").over(line)).where(~F.col("guest"))
    return signed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_string(F.col("sig0")).alias("fingerprint"),
        as_string(F.col("sig1")).alias("edited_fingerprint"),
        likeness(F.col("sig0"), F.col("sig1")).alias("near_edited"),
        likeness(F.col("sig0"), F.col("following")).alias("near_next"),
    )
