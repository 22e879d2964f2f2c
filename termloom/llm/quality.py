"""Quality rules: robust multivariate outliers per language and source.

Every document gets counts of its text and a vector of four transformed statistics.
For each (language, source) a minimum-covariance-determinant estimate is fitted: from
two starts, concentration steps keep the ``SHARE`` of documents nearest to the centre
and estimate centre and covariance anew; the start that ends with the smaller
determinant wins. Documents beyond a cut of the Mahalanobis distance are rejected.
Small groups take the estimate of their language, or of all documents.

All of it is DataFrame work: text counts are expressions inside the scan, each
step is one partial aggregate over the narrow statistics, a quantile sketch
(``percentile_approx``) gives the border of the half set, so that a source with a third of
all rows is never gathered in one task, and the estimates are one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import kept, let, words_of
from termloom.operators import scale

MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
SHARE = 0.5
STEPS = 3
#: Groups with fewer usable documents are judged by the estimate of their language, and
#: languages with fewer by that of all documents; only fewer in all get no verdict.
MIN_GROUP = 50
#: The group of all documents.
ALL = "all"
#: Cut of the squared distance, after its median is set to that of chi-squared with 4
#: degrees of freedom; far in the tail, so that clean documents stay.
CUT = 60.0
CHI2_MEDIAN = 3.3567
#: Added to the variances: keeps estimates regular when a statistic hardly varies.
RIDGE = (0.25, 0.04, 0.09, 0.01)
DIM = len(RIDGE)
ACCURACY = 2000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice among ``words``."""

    def covered(spots: Column) -> Column:
        last = F.lit(3)
        steps = F.transform(
            spots, lambda x, i: F.least(last, F.coalesce(F.get(spots, i + 1) - x, last))
        )
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x).cast("long")

    def repeated(pairs: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            same = F.get(pairs, i + 1)["h"] == x["h"]
            before = F.when(i > 0, F.get(pairs, i - 1)["h"] == x["h"])
            return F.coalesce(same, F.lit(False)) | F.coalesce(before, F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, twice), lambda x: x["i"]))

    def by_hash(hashes: Column) -> Column:
        pairs = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        many = let(let(pairs, repeated), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(many)

    def windows(w: Column) -> Column:
        spots = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(
            spots, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(let(hashes, by_hash))

    return let(words, windows)


def text_counts(text: Column) -> Column:
    """Struct of the counts of a text; zeros for null."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias(
                "n_dup_lines"
            ),
            _repeat_words(w).alias("n_repeat_words"),
        )

    return let(words_of(text), of_words)


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _vector() -> list[Column]:
    """The transformed statistics; only for documents that have words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return [
        F.log(n),
        chars / n,
        F.log1p(100.0 * F.col("n_symbols") / chars),
        F.sqrt((F.col("n_repeat_words") + 3 * F.col("n_dup_lines")) / n),
    ]


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(DIM) for j in range(i + 1)]


def _estimate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Centre, Cholesky factor of the covariance and its log determinant by ``keys``."""
    found = [F.avg(f"x{i}").alias(f"m{i}") for i in range(DIM)]
    found += [F.covar_pop(f"x{i}", f"x{j}").alias(f"s{i}{j}") for i, j in _pairs()]
    out = rows.groupBy(*keys).agg(*found)
    for i, j in _pairs():  # row by row: l_ij needs l of earlier rows and columns
        s = F.col(f"s{i}{j}") + (F.lit(RIDGE[i]) if i == j else F.lit(0.0))
        for k in range(j):
            s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(s) if i == j else s / F.col(f"l{j}{j}"))
    det = sum((F.log(F.col(f"l{i}{i}")) for i in range(DIM)), F.lit(0.0))
    lower = [f"l{i}{j}" for i, j in _pairs()]
    return out.select(*keys, *[f"m{i}" for i in range(DIM)], *lower, (2 * det).alias("det"))


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. under m0.. and the factor l00.."""
    z: list[Column] = []
    for i in range(DIM):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * z[j]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((x * x for x in z), F.lit(0.0))


def fit(rows: DataFrame) -> DataFrame:
    """One estimate per group: ``key, m*, l*, det, scale``.

    ``rows`` has ``key, x0..x3`` of the usable documents. Groups under ``MIN_GROUP``
    rows have no estimate.
    """
    middle = [
        F.percentile_approx(f"x{i}", 0.5, ACCURACY).alias(f"c{i}") for i in range(DIM)
    ]
    sized = rows.groupBy("key").agg(F.count("*").alias("n"), *middle).where(F.col("n") >= MIN_GROUP)
    sized = kept(sized.drop("n"), "mcd")
    groups = sized.count()

    def beside(estimates: DataFrame, each: int = 1) -> DataFrame:
        """``rows`` with the estimates of their group; the rows stay where they are."""
        return scale.lookup_join(rows, estimates, ["key"], each * groups, "x0")

    centred = beside(sized)
    spread = [
        F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"c{i}")), 0.5, ACCURACY).alias(f"a{i}")
        for i in range(DIM)
    ]
    mad = sized.join(centred.groupBy("key").agg(*spread), "key")
    zero = F.lit(0.0)

    def start(number: int, factors: list[Column]) -> DataFrame:
        lower = [
            (factors[i] if i == j else zero).alias(f"l{i}{j}") for i, j in _pairs()
        ]
        centre = [F.col(f"c{i}").alias(f"m{i}") for i in range(DIM)]
        return mad.select("key", F.lit(number).alias("start"), *centre, *lower)

    # Start 0 weighs each statistic by its own spread, start 1 all alike.
    own = [F.sqrt((1.4826 * F.col(f"a{i}")) ** 2 + F.lit(RIDGE[i])) for i in range(DIM)]
    model = kept(start(0, own).unionByName(start(1, [F.lit(1.0)] * DIM)), "mcd")
    for _ in range(STEPS):
        away = beside(model, 2).withColumn("d", _distance())
        border = away.groupBy("key", "start").agg(
            F.percentile_approx("d", SHARE, ACCURACY).alias("q")
        )
        # The border goes with the estimate: one narrow table per step.
        bordered = kept(model.join(border, ["key", "start"]), "mcd")
        near = beside(bordered, 2).where(_distance() <= F.col("q"))
        model = kept(_estimate(near.select("key", "start", *_x()), ["key", "start"]), "mcd")
    fields = [c for c in model.columns if c not in ("key", "det", "start")]
    best = model.groupBy("key").agg(F.min(F.struct("det", "start", *fields)).alias("b"))
    best = best.select("key", *[F.col(f"b.{c}").alias(c) for c in fields])
    scaled = beside(best).groupBy("key").agg(
        F.percentile_approx(_distance(), 0.5, ACCURACY).alias("middle")
    )
    width = F.greatest(F.col("middle") / CHI2_MEDIAN, F.lit(1e-6)).alias("scale")
    return kept(best.join(scaled, "key").select("key", *fields, width), "mcd")


def _x() -> list[str]:
    return [f"x{i}" for i in range(DIM)]


def _levels(usable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, by``: the group that judges each group; and the rows under every group that
    judges one, ``key, x0..x3``.

    ``usable`` has ``key, above, x0..x3``, ``above`` being the group of the language.
    """
    groups = kept(usable.groupBy("key", "above").agg(F.count("*").alias("n")), "groups")
    small = F.col("n") < MIN_GROUP
    langs = groups.groupBy("above").agg(F.sum("n").alias("total"), F.max(small).alias("asked"))
    langs = kept(langs, "groups")
    enough, asked = F.col("total") >= MIN_GROUP, F.col("asked")
    found = langs.agg(F.sum("total").alias("n"), F.max(asked & ~enough).alias("asked")).first()
    last = F.lit(ALL if found["asked"] and found["n"] >= MIN_GROUP else None).cast("string")
    by = F.when(~small, F.col("key")).when(enough, F.col("above")).otherwise(last)
    above = F.when(asked & enough, F.col("above"))
    levels = F.array_compact(F.array(F.when(~small, F.col("key")), above, last))
    placed = kept(groups.join(langs, "above").select("key", by.alias("by"), levels.alias("levels")), "groups")
    rows = scale.lookup_join(usable, placed.select("key", "levels"), ["key"], placed.count(), "x0")
    rows = rows.select(F.explode("levels").alias("key"), *_x())
    return placed.select("key", "by"), kept(rows, "usable")


def judged(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns in a struct ``row``, the counts, ``base_failed`` and ``kept``.

    Null text counts as empty and fails the base rules. Null language or source is a
    group of its own. Documents that fail the base rules take no part in estimates.
    Groups too small for an estimate are judged by that of their language, then of all
    documents; under ``MIN_GROUP`` usable documents in all, what passes the base rules is
    kept. Rows with equal ids are judged each on its own; other columns of ``docs`` change nothing.
    """
    group = F.to_json(F.struct(F.col("lang").alias("l"), F.col("source").alias("s")))
    above = F.concat(F.lit("lang"), F.to_json(F.struct(F.col("lang").alias("l"))))
    counted = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"),
        group.alias("key"),
        above.alias("above"),
        text_counts(F.col("text").cast("string")).alias("c"),
    ).select("row", "key", "above", *[F.col(f"c.{c}").alias(c) for c in COUNTS])
    x = [v.alias(f"x{i}") for i, v in enumerate(_vector())]
    counted = kept(counted.select("*", base_failed().alias("base_failed"), *x), "quality")
    groups, usable = _levels(counted.where(~F.col("base_failed")).select("key", "above", *_x()))
    estimates = fit(usable).withColumnRenamed("key", "by")
    estimates = kept(groups.join(estimates, "by").drop("by"), "mcd")
    placed = scale.lookup_join(counted, estimates, ["key"], estimates.count(), "x0", "left")
    outlier = F.coalesce(_distance() / F.col("scale") > CUT, F.lit(False))
    verdict = (~F.col("base_failed") & ~outlier).alias("kept")
    return placed.select("row", *COUNTS, "base_failed", verdict)


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    return judged(docs, docs.columns).where("kept").select("row.*")
