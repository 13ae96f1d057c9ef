"""Quality rules: counts with fixed limits, and a likelihood ratio of hashed n-grams.

Every document is compared under two multinomials over hashed words and word pairs, one of
the whole corpus and one of trusted documents. Its score is the mean over its n-grams of
``ln p(trusted) - ln p(corpus)``; a document below the threshold is not kept. The trusted
shares are smoothed towards those of the corpus, so that little trusted text says little
about any n-gram. The threshold is a constant, lowered where trusted documents score below it: all of
them, each under shares that were counted without its part. The verdict of a document is not drawn by chance.

A mean over a long text hides a few words, so toxic documents are known by single words: those
that many documents labelled as toxic hold and trusted ones do not.

Everything is DataFrame code on the JVM. The corpus counts cover every n-gram of
every document; they are summed by bucket before the shuffle, so no word is hot. The
table of ratios has one number per bucket whatever the corpus. It is one row, broadcast to
the tasks that score the documents: as a constant it would be printed into every plan the driver keeps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.stats import percentiles
from lakekit.llm.mixing import GAP
from lakekit.operators.lookup import join_lookup
from lakekit.session import checkpointed, staged

# Fixed values of the rules.
SYMBOLS = "[#*$%&|<>]"
SPACES = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3

BUCKETS = 1 << 14
SMOOTHING = 1.0
# The corpus share of a bucket counts in the trusted share like so many n-grams a bucket.
PRIOR = 10.0
THRESHOLD = -0.06
# To set the threshold trusted documents are scored in so many parts, each by the others; one in so many
# may be lost to it.
PARTS = 5
LOST = 0.001
# A toxic word is in so many labelled documents and such a share of them, and in so many times the share of
# trusted ones.
TOXIC_LEAST, TOXIC_SHARE, TOXIC_TIMES = 5, 0.1, 8.0
# A word's place in its text takes so many bits of a sorted number, its hash the others.
PLACE_BITS = 24


def word_array(text: Column) -> Column:
    """The words of a text; none for null or blank."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, GAP))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _bound(x: Column, of: Callable[[Column], Column]) -> Column:
    """``of(x)``, with ``x`` taken from its row once and not anew for each element of an array."""
    return F.get(F.transform(F.array(x), of), 0)


def _runs(hashes: Column) -> Column:
    """A hash for every run of three words."""

    def of(all_hashes: Column) -> Column:
        heads = F.slice(all_hashes, 1, F.greatest(F.size(all_hashes) - WINDOW + 1, F.lit(0)))
        return F.transform(
            heads, lambda h, i: F.xxhash64(h, F.get(all_hashes, i + 1), F.get(all_hashes, i + 2))
        )

    return _bound(hashes, of)


def _sorted_runs(runs: Column) -> Column:
    """The runs' hashes, each with its place, in order; null if no two are equal."""
    packed = F.transform(
        runs, lambda h, i: F.shiftleft(h, PLACE_BITS).bitwiseOR(i.cast("long"))
    )
    return F.when(F.size(F.array_distinct(runs)) < F.size(runs), F.sort_array(packed))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def _repeated_places(packed: Column, words: Column) -> Column:
    """Where the runs begin that the text holds twice or more: equal neighbours whose words
    are equal too. Exact for texts of up to ``2 ** PLACE_BITS`` words."""

    def same(x: Column, y: Column) -> Column:
        alike = F.shiftright(x, PLACE_BITS) == F.shiftright(y, PLACE_BITS)
        a, b = _place(x), _place(y)
        for k in range(WINDOW):
            alike = alike & (F.get(words, a + k) == F.get(words, b + k))
        return F.coalesce(alike, F.lit(False))

    def repeated(x: Column, i: Column) -> Column:
        return same(x, F.get(packed, i - 1)) | same(x, F.get(packed, i + 1))

    return F.sort_array(F.transform(F.filter(packed, repeated), _place))


def _covered(places: Column) -> Column:
    """The size of the union of the runs that begin at the sorted places."""
    steps = F.transform(
        places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))
    )
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s)
    return F.coalesce(covered, F.lit(0))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_words``, their ``_hashes`` and the counts of the fixed rules: ``n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words``. A null text counts as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("_words", word_array(body))
    words = F.col("_words")
    rows = rows.withColumn("_hashes", word_hashes(words))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({"_runs": _runs(F.col("_hashes")), "_lines": lines})
    rows = rows.withColumn("_packed", _sorted_runs(F.col("_runs")))
    rows = rows.withColumn("_places", _repeated_places(F.col("_packed"), words))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _covered(F.col("_places")),
    }
    rows = rows.withColumns({name: c.cast("long") for name, c in counts.items()})
    return rows.drop("_runs", "_packed", "_lines", "_places")


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _bucket(hashed: Column, buckets: int) -> Column:
    """As ``pmod``; the last bits are the remainder where the buckets are a power of two."""
    if buckets & (buckets - 1) == 0:
        return hashed.bitwiseAND(F.lit(buckets - 1))
    return F.pmod(hashed, F.lit(buckets))


def hashed_ngrams(hashes: Column, buckets: int = BUCKETS) -> Column:
    """A bucket for every word and every pair of neighbours (the last has none)."""
    singles = F.transform(hashes, lambda h: _bucket(h, buckets).cast("int"))
    pairs = F.transform(hashes, lambda h, i: _bucket(F.xxhash64(h, F.get(hashes, i + 1)), buckets).cast("int"))
    return F.concat(singles, pairs)


def _summed_ratios(hashes: Column, ratios: Column, buckets: int) -> Column:
    """The sum of the ratios of :func:`hashed_ngrams`, without an array of them."""

    def of(all_hashes: Column, table: Column) -> Column:
        def ratio(h: Column, i: Column) -> Column:
            pair = F.xxhash64(h, F.get(all_hashes, i + 1))
            return F.get(table, _bucket(h, buckets)) + F.get(table, _bucket(pair, buckets))

        return F.aggregate(F.transform(all_hashes, ratio), F.lit(0.0), lambda total, x: total + x)

    return _bound(hashes, lambda all_hashes: _bound(ratios, lambda table: of(all_hashes, table)))


def _known(ids: DataFrame) -> DataFrame:
    """All distinct ids but null."""
    return ids.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(parts)).cast("int")


def log_ratios(
    docs: DataFrame, trusted: DataFrame, *, buckets: int = BUCKETS, parts: int = 0
) -> DataFrame:
    """One row with the array ``ratios``: for each bucket the log of its share in
    trusted documents, smoothed by ``PRIOR``, over that in all documents. ``without`` has such an array for
    each of the ``parts`` of the trusted documents, counted without that part.

    ``trusted`` has doc_id; all distinct ids are used.
    Without trusted documents in the corpus every ratio is 0.
    """
    chosen = _known(trusted).withColumn("_trusted", F.lit(1))
    hashed = docs.select("doc_id", word_hashes(word_array(F.col("text"))).alias("_hashes"))
    flagged = join_lookup(hashed, chosen, ["doc_id"])
    # Each word beside its neighbour: hashed_ngrams(), but with the hashes of pairs made after the explode.
    words = flagged.select(
        F.coalesce("_trusted", F.lit(0)).alias("_trusted"),
        F.when(F.col("_trusted") == 1, _part(parts) if parts else F.lit(0)).alias("_part"),
        F.inline(F.arrays_zip(F.col("_hashes").alias("_h"), F.slice("_hashes", 2, F.size("_hashes")).alias("_next"))),
    ).toDF("_trusted", "_part", "_h", "_next")
    both = F.array(_bucket(F.col("_h"), buckets), _bucket(F.xxhash64("_h", "_next"), buckets))
    grams = words.select("_trusted", "_part", F.explode(both.cast("array<int>")).alias("_gram"))
    own = [f"_t{p}" for p in range(parts)]
    counts = grams.groupBy("_gram").agg(
        F.count("*").alias("_n"),
        F.sum("_trusted").alias("_t"),
        *[F.count_if(F.col("_part") == p).alias(name) for p, name in enumerate(own)],
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_gram"))
    counts = every.join(counts, "_gram", "left").na.fill(0, ["_n", "_t", *own])
    one = counts.agg(F.sort_array(F.collect_list(F.struct("_gram", "_n", "_t", *own))).alias("c"))
    add, prior = SMOOTHING, PRIOR * buckets

    def total(name: str) -> Column:
        return F.aggregate(F.col("c")[name], F.lit(0).cast("long"), lambda a, x: a + x)

    totals = [total(name).alias(f"all{name}") for name in ("_t", *own)]
    one = one.select("c", (total("_n") + add * buckets).alias("all_n"), *totals)

    def ratios(less: str | None = None) -> Column:
        seen = F.col("all_t") - (F.col(f"all{less}") if less else F.lit(0))

        def of(x: Column) -> Column:
            share = (x["_n"] + add) / F.col("all_n")
            n = x["_t"] - (x[less] if less else F.lit(0))
            return F.log((n + prior * share) / (seen + prior)) - F.log(share)

        return F.transform("c", lambda x: F.when(seen == 0, 0.0).otherwise(of(x)))

    without = F.array(*map(ratios, own)) if parts else F.array().cast("array<array<double>>")
    return one.select(ratios().alias("ratios"), without.alias("without"))


def _scored(docs: DataFrame, tables: DataFrame, buckets: int, part: Column | None = None) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``score``, by the one row of ``tables`` with ``_ratios``,
    or by that whose ``_part`` is theirs."""
    tables = F.broadcast(tables)
    # The arrays of ratios meet the hashes last, so that rows hold them for one step only.
    rows = measure(docs).drop("_words")
    if part is None:
        rows = rows.crossJoin(tables)
    else:
        rows = rows.withColumn("_part", part).join(tables, "_part")
    # A word and a pair for each place.
    summed = _summed_ratios(F.col("_hashes"), F.col("_ratios"), buckets)
    score = summed / F.greatest(2 * F.size("_hashes"), F.lit(1))
    rows = rows.withColumns({"base_failed": base_failed(), "score": score})
    return rows.drop("_hashes", "_ratios", "_part")


def _lowered_threshold(
    docs: DataFrame, trusted: DataFrame, without: DataFrame, parts: int, buckets: int, threshold: float
) -> float:
    """The threshold, or if lower the score that a share of ``LOST`` of all trusted documents are below."""
    chosen = join_lookup(docs.select("doc_id", "text"), _known(trusted), ["doc_id"], "left_semi")
    # No filter on the verdict: it would be moved below the words' arrays, see judge().
    passed = F.when(~F.col("base_failed"), F.col("score"))
    scored = _scored(chosen, without, buckets, _part(parts))
    found = scored.groupBy("doc_id").agg(F.min(passed).alias("s"))
    with staged(found.select("s"), "trusted_scores") as scores:
        (lowest,) = percentiles(scores, [], "s", {"s": LOST}).first() or (None,)
    # A score may end in other digits when it is computed in another place.
    return threshold if lowest is None else min(threshold, lowest - 1e-9)


def plain_words(text: Column) -> Column:
    """Runs of letters and digits, in small letters."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


def toxic_words(docs: DataFrame, trusted: DataFrame, toxic: DataFrame) -> list[str]:
    """The words that tell documents of ``toxic`` from those of ``trusted``, in order.

    A word is in a tenth of the toxic documents at least, so there are at most ten times as many
    as a document has.
    """
    ids = _known(toxic).withColumn("_toxic", F.lit(1))
    ids = ids.unionByName(_known(trusted).withColumn("_toxic", F.lit(0)))
    found = join_lookup(docs.select("doc_id", "text"), ids, ["doc_id"], "inner")
    seen = found.agg(F.sum("_toxic").alias("t"), F.count("*").alias("n")).collect()[0]
    n_toxic = seen["t"] or 0
    if n_toxic < TOXIC_LEAST:
        return []
    words = found.select("_toxic", F.explode(F.array_distinct(plain_words(F.col("text")))).alias("_word"))
    counts = words.filter("_word <> ''").groupBy("_word").agg(F.sum("_toxic").alias("t"), F.count("*").alias("n"))
    share = F.col("t") / (n_toxic + 1)
    usual = (F.col("n") - F.col("t") + 0.5) / (seen["n"] - n_toxic + 1)
    many = F.col("t") >= max(TOXIC_LEAST, TOXIC_SHARE * n_toxic)
    return sorted(r["_word"] for r in counts.filter(many & (share >= TOXIC_TIMES * usual)).collect())


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    parts: int = 0,
    toxic: DataFrame | None = None,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with the counts of :func:`measure`, ``base_failed``, ``score``, ``toxic_words`` and
    ``kept``.

    ``docs`` has doc_id and text, and no columns of these names or that begin
    with an underscore. Null, empty
    and blank texts have no words, score 0 and fail the first rule. Repeated rows are judged
    alike. A null doc_id is never trusted. No documents, no rows. With ``parts`` the threshold is lowered so that
    it keeps the trusted documents, each scored by what the other parts say. A document with a word of
    :func:`toxic_words` is not kept; without ``toxic`` there are none.
    """
    # One number per bucket, whatever the corpus: small enough to be sent to every task.
    found = checkpointed(log_ratios(docs, trusted, buckets=buckets, parts=parts))
    if parts:
        without = found.select(F.posexplode("without").alias("_part", "_ratios"))
        threshold = _lowered_threshold(docs, trusted, without, parts, buckets, threshold)
    listed = [] if toxic is None else toxic_words(docs, trusted, toxic)
    hits = F.lit(False)
    if listed:
        hits = F.arrays_overlap(plain_words(F.col("text")), F.split(F.lit(" ".join(listed)), " "))
    rows = _scored(docs, found.select(F.col("ratios").alias("_ratios")), buckets)
    rows = rows.withColumn("toxic_words", hits)
    kept = ~F.col("base_failed") & ~F.col("toxic_words") & (F.col("score") >= threshold)
    rows = rows.withColumn("kept", kept)
    # A filter on a verdict must not be moved below the words' arrays, where it would split the
    # text anew for every use of them: a condition on a row number holds it here.
    numbered = rows.withColumn("_number", F.monotonically_increasing_id())
    return numbered.filter("_number >= 0").drop("_number")


def judge_labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`judge` by a table of labels: all trusted documents are fitted and, in parts, set the threshold;
    the toxic ones say which words are toxic."""
    return judge(docs, trusted_documents(labels), parts=PARTS, toxic=toxic_documents(labels))


def toxic_documents(labels: DataFrame) -> DataFrame:
    """Labelled as toxic, but good otherwise: what sets them apart from the trusted is not junk."""
    by_id = labels.groupBy("doc_id").agg(F.min("quality").alias("_quality"), F.max("toxic").alias("_toxic"))
    return by_id.filter("_quality = 1 AND _toxic = 1").select("doc_id")


def trusted_documents(labels: DataFrame) -> DataFrame:
    """Labelled as good and not as toxic, under every label of the id."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    by_id = labels.groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("_good"))
    return by_id.filter("_good").select("doc_id")
