"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Every text gets five measures. A rule "measure above its cut: reject" gets its
cut, per stratum, from labelled documents. A cut is *certified* when the exact
binomial (Clopper-Pearson) test rejects "this cut rejects more than ``alpha``
of the good documents": with n good labelled documents, of which the cut
rejects k, P(Binomial(n, alpha) <= k) <= delta'. Cuts are tested from the most
lenient to the strictest and stop at the first failure (fixed-sequence testing
needs no correction along the sequence; k only grows along it), and delta is
shared among all rules of all strata (Bonferroni). Labels count only for
documents that pass the base rules, as the rules decide nothing for others. So
with probability 1 - delta no rule rejects more than ``alpha`` of those good
documents of any stratum, and all five together no more than 5 x ``alpha``.
Among the certified cuts, the one with the largest difference between the
rejected share of bad and of good documents is used, the more lenient at ties;
a cut that rejects no bad document is not used.

A stratum with too few good labels to certify any cut alone takes the cuts of a
pool: all such strata and, if their labels do not suffice together either, the
next larger strata until they do (these lend labels and keep their own cuts).
The pool is one member of the family in place of the strata it serves, so there
are never more members than strata; who is in it depends on the numbers of good
labels only. The bound then holds for the good documents of the pool, not of each
stratum in it, so a pooled cut is left out where it rejects more than ``alpha``
of a stratum's own good labels. Only if all labels together are too few to
certify a cut, or a stratum has no label at all, its documents are kept (unless
the base rules reject them).

The measures are binned on fixed grids, and a rule fires on the bin, so the
fitted counts and the applied rule agree exactly. What the fit gathers is one
count per (stratum, measure, bin): at most 677 strata x 5 measures x 64 bins.

Defined cases: a null or empty text has no words, all measures 0, and fails
the base rules; a null, odd or unknown language is the stratum ``other``;
labels that are null are ignored, a document labelled both good and bad counts
as bad; repeated documents are judged one by one (and counted one by one in
the fit); with no usable labels no rule is certified; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .text import BLANKS, whole_text, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
BINS = 64
#: Measure -> bins per unit; values from (BINS - 1) / scale on share the last bin.
MEASURES = {
    "symbols_per_word": 32,
    "exclamations_per_word": 32,
    "dup_line_share": 63,
    "repeat_word_share": 63,
    "mean_word_length": 2,
}
ALPHA, DELTA = 0.005, 0.05
#: No stratum is called so.
POOL = "pool"


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def with_features(df: DataFrame, text: str | Column = "text") -> DataFrame:
    """Adds the struct ``quality`` with the base counts and the bins, in place
    of a column of that name. Other columns may have any names."""
    kept = [c for c in df.columns if c != "quality"]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), whole_text(text if isinstance(text, Column) else f"`{text}`").alias("_t"))
    columns, t = [F.col("row")], F.col("_t")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    a = rows.select(*columns, "_t", words(t).alias("_w"), lines.alias("_l"))
    n = F.size("_w").cast("long")
    windows = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0).cast("long"), n - 3),
                    lambda i: F.xxhash64(F.get("_w", i.cast("int")), F.get("_w", (i + 1).cast("int")),
                                         F.get("_w", (i + 2).cast("int")))),
    )
    b = a.select(
        *columns, n.alias("_n"),
        F.length(F.translate("_t", BLANKS, "")).cast("long").alias("_c"),
        _count_of(F.col("_t"), SYMBOLS).cast("long").alias("_s"),
        _count_of(F.col("_t"), "!").cast("long").alias("_e"),
        F.size("_l").cast("long").alias("_nl"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("_d"),
        windows.alias("_h"),
    )
    # Repeated windows: the hashes are sorted as plain longs with the window's
    # start in the low bits (2^k > n); neighbours with equal full hashes repeat.
    # A running pass over their starts counts the words that they cover.
    base = F.pow(F.lit(2.0), F.length(F.bin(F.col("_n")))).cast("long")
    c = b.withColumn("_b", base).withColumn("_p", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: h - F.pmod(h, F.col("_b")) + i)),
    ))

    def full(i: Column) -> Column:
        return F.get("_h", F.pmod(F.get("_p", i), F.col("_b")).cast("int"))

    starts = F.sort_array(F.transform(
        F.filter("_p", lambda v, i: F.coalesce(full(i) == full(i - 1), F.lit(False))
                 | F.coalesce(full(i) == full(i + 1), F.lit(False))),
        lambda v: F.pmod(v, F.col("_b")),
    ))
    zero = F.lit(0).cast("long")
    covered = F.aggregate(
        starts, F.struct(zero.alias("n"), F.lit(-3).cast("long").alias("last")),
        lambda acc, s: F.struct((acc["n"] + F.least(F.lit(3).cast("long"), s - acc["last"])).alias("n"), s.alias("last")),
        lambda acc: acc["n"],
    )
    d = c.select(*columns, "_n", "_c", "_s", "_e", "_nl", "_d", F.coalesce(covered, zero).alias("_r"))

    def share(x: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(x) / F.col(of)).otherwise(0.0)

    measures = {
        "symbols_per_word": share("_s", "_n"),
        "exclamations_per_word": share("_e", "_n"),
        "dup_line_share": share("_d", "_nl"),
        "repeat_word_share": share("_r", "_n"),
        "mean_word_length": share("_c", "_n"),
    }
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_r") > 50 * F.col("_n"))
    return d.select(*[F.col("row")[c].alias(c) for c in kept], F.struct(
        F.col("_n").alias("n_words"), F.col("_c").alias("word_chars"), F.col("_s").alias("n_symbols"),
        F.col("_d").alias("n_dup_lines"), F.col("_r").alias("n_repeat_words"), failed.alias("base_failed"),
        *[F.least(F.lit(BINS - 1), F.floor(measures[m] * scale)).cast("int").alias(m) for m, scale in MEASURES.items()],
    ).alias("quality"))


def stratum(lang: str | Column) -> Column:
    """Two ASCII letters, else ``other``: at most 677 strata."""
    code = F.lower(F.col(lang) if isinstance(lang, str) else lang)
    return F.when(code.rlike("^[a-z][a-z]$"), code).otherwise("other")


def most_false_rejections(n: Column, alpha: float, delta: Column) -> Column:
    """Largest k with P(Binomial(n, alpha) <= k) <= delta, -1 if there is none.

    Sums the exact terms from 0 upwards, each from the one before in log space;
    k is below n * alpha, so the walk ends there."""
    log_odds, log_rest = math.log(alpha / (1 - alpha)), math.log1p(-alpha)
    init = F.struct((n * log_rest).alias("term"), F.lit(0.0).alias("cdf"), F.lit(-1).cast("long").alias("k"))

    def step(acc: Column, i: Column) -> Column:
        cdf = acc["cdf"] + F.exp(acc["term"])
        return F.struct(
            (acc["term"] + F.log((n - i).cast("double")) - F.log((i + 1).cast("double")) + log_odds).alias("term"),
            cdf.alias("cdf"),
            F.when(cdf <= delta, i).otherwise(acc["k"]).alias("k"),
        )

    last = F.floor(n * alpha).cast("long")
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), last), init, step, lambda acc: acc["k"])).otherwise(-1)


def fit(features: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", lang: str = "lang",
        label: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a cut: ``stratum`` and for each measure its cut,
    its own or the pool's (null: no certified cut that rejects a bad document)."""
    truth = (labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").alias("_y"))
             .where("_id is not null and _y is not null").groupBy("_id").agg(F.min("_y").alias("_y")))
    seen = features.select(F.col(f"`{doc_id}`").alias("_id"), stratum(f"`{lang}`").alias("stratum"), "quality")
    # Summed, not filtered: a filter would be pushed below and compute the measures twice.
    ruled = (~F.col("base_failed")).cast("long")
    pairs = ", ".join(f"'{m}', quality.{m}" for m in MEASURES)
    counts = (
        seen.join(truth, "_id")
        .select("stratum", "_y", F.col("quality.base_failed").alias("base_failed"), F.expr(f"stack({len(MEASURES)}, {pairs}) as (measure, bin)"))
        .groupBy("stratum", "measure", "bin")
        .agg(F.sum((F.col("_y") > 0).cast("long") * ruled).alias("good"), F.sum((F.col("_y") <= 0).cast("long") * ruled).alias("bad"))
    ).checkpoint()  # small, and read several times
    sizes = counts.groupBy("stratum", "measure").agg(F.sum("good").alias("n")).groupBy("stratum").agg(F.max("n").alias("n"))
    tests = counts.agg(F.countDistinct("stratum").alias("n_strata"))
    each = F.lit(delta) / (F.col("n_strata") * len(MEASURES))
    # One row per stratum (at most 677): those too small alone, and who is in their pool.
    fewer = Window.orderBy("n", "stratum").rowsBetween(Window.unboundedPreceding, -1)
    members = (
        sizes.crossJoin(F.broadcast(tests))
        .withColumn("before", F.coalesce(F.sum("n").over(fewer), F.lit(0)))
        .select("stratum", "n", (most_false_rejections(F.col("n"), alpha, each) < 0).alias("small"),
                (most_false_rejections(F.col("before"), alpha, each) < 0).alias("needed"))
    ).checkpoint()
    pooled = counts.join(F.broadcast(members.where("small or needed").select("stratum")), "stratum").groupBy("measure", "bin").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    own = counts.join(F.broadcast(members.where("not small").select("stratum")), "stratum")
    # One cut below each occupied bin: it rejects that bin and those above.
    whole = Window.partitionBy("stratum", "measure")
    above = whole.orderBy(F.desc("bin"))
    tested = own.select("stratum", "measure", "bin", "good", "bad").unionByName(
        pooled.select(F.lit(POOL).alias("stratum"), "measure", "bin", "good", "bad")).select(
        "stratum", "measure", (F.col("bin") - 1).alias("cut"),
        F.sum("good").over(above).alias("good_hit"), F.sum("bad").over(above).alias("bad_hit"),
        F.sum("good").over(whole).alias("n_good"), F.sum("bad").over(whole).alias("n_bad"),
    )
    limits = (
        tested.groupBy("stratum").agg(F.max("n_good").alias("n")).crossJoin(F.broadcast(tests))
        .select("stratum", most_false_rejections(F.col("n"), alpha, each).alias("most"))
    )
    gain = F.col("bad_hit") / F.col("n_bad") - F.col("good_hit") / F.col("n_good")
    certified = tested.join(limits, "stratum").where("good_hit <= most and bad_hit > 0").withColumn("gain", gain).where("gain > 0")
    best = certified.groupBy("stratum", "measure").agg(F.max_by("cut", F.struct("gain", "cut")).alias("cut")).checkpoint()
    # The pool's cuts for the small strata whose own good labels do not speak against them.
    lent = (
        counts.join(F.broadcast(members.where("small").select("stratum", "n")), "stratum")
        .join(F.broadcast(best.where(F.col("stratum") == POOL).select("measure", "cut")), "measure")
        .groupBy("stratum", "measure", "cut", "n").agg(F.sum(F.when(F.col("bin") > F.col("cut"), F.col("good")).otherwise(0)).alias("hit"))
        .where(F.col("hit") <= alpha * F.col("n")).select("stratum", "measure", "cut")
    )
    best = best.where(F.col("stratum") != POOL).unionByName(lent)
    return best.groupBy("stratum").pivot("measure", list(MEASURES)).agg(F.first("cut"))


def judge(features: DataFrame, cuts: DataFrame, *, lang: str = "lang") -> DataFrame:
    """Adds ``kept`` to rows with features, in place of a column of that name.
    The cuts are at most 677 rows."""
    names = [c for c in features.columns if c != "kept"]
    rules = cuts.select(F.col("stratum").alias("of"), F.struct(*MEASURES).alias("cuts"))
    rows = features.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("quality").alias("q"), stratum(f"`{lang}`").alias("s"))
    joined = rows.join(F.broadcast(rules), F.col("s") == F.col("of"), "left")
    # One expression over both sides of the join: a filter on it cannot be split
    # and pushed below, where it would compute the measures once more for each use.
    against = F.array(F.col("q")["base_failed"], *[F.coalesce(F.col("q")[m] > F.col("cuts")[m], F.lit(False)) for m in MEASURES])
    return joined.select(*[F.col("row")[c].alias(c) for c in names], (~F.array_contains(against, True)).alias("kept"))
