"""Quality rules: simple limits and robust multivariate outliers, in DataFrame operations only.

Words are runs of characters other than blank, tab and line breaks. Five transformed statistics of a
text form its vector. Per language and source the minimum covariance determinant is estimated. From
each of three starts (median deviations, hyperbolic tangents, spatial signs) the share CORE of rows
with the least distances gives the next mean and covariance, until a step no longer lowers the log
determinant by SETTLED; the start with the least determinant wins. The rows within the 97.5% point
of a chi-square of it give the final mean and covariance. Both covariances are made consistent for
normal rows. A text is rejected if its squared Mahalanobis distance passes the 99.9% point of the
F distribution that such distances have with so many rows (a chi-square if there are many). Rows
that fail the limits take no part in the estimates.

Most texts have no symbols, equal lines or repeated words, so a covariance may be singular. Half the
least step of each statistic at the pool's median text is therefore added to its spread. As it keeps
determinants from below, the steps end.

Groups with fewer than MIN_ROWS such rows use those of their language over all sources, then all
rows; if even those are too few, none is rejected by distance. Null language and source are
values of their own. Null text has no words and fails. Each group's statistics are sums and
quantile sketches, so a hot group is never gathered. Pools, their limits and parameters are written before
they are joined, so that Spark sees their size: a step then moves sums and sketches, but no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.functions.text import bind
from wikiloom.scale import landed

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_ROWS = 100
CORE = 0.75
SETTLED = 1e-4
ACCURACY = 10_000
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Of a chi-square with five degrees of freedom: the points that 2.5% and 0.1% of normal rows pass,
# and the factors that make covariances of the nearest 75% and 97.5% consistent.
CHI2_INNER = 12.8325
CHI2_CUT = 20.515
NORMAL_CUT = 3.0902
CORE_FACTOR = 1.41207
INNER_FACTOR = 1.05553
_PLACE_BITS = 24

FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "size"]
_N = range(len(FEATURES))
_PAIRS = [(i, j) for i in _N for j in range(i + 1)]


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window which is found twice or more.

    Each window is a long: the upper bits of its hash, the lower 24 its place. After a sort of
    plain longs equal windows are neighbours; the words themselves decide.
    """
    low = F.lit((1 << _PLACE_BITS) - 1)
    high = F.lit(-(1 << _PLACE_BITS))

    def windows(w: Column) -> Column:
        return F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            .bitwiseAND(high).bitwiseOR(i.cast("long")),
        ))

    def covered(w: Column, keys: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            p, q = a.bitwiseAND(low).cast("int"), b.bitwiseAND(low).cast("int")
            equal = a.bitwiseAND(high) == b.bitwiseAND(high)
            for i in range(3):
                equal = equal & (F.get(w, p + i) == F.get(w, q + i))
            return F.coalesce(equal, F.lit(False))

        twice = F.filter(
            keys, lambda k, i: same(k, F.get(keys, i - 1)) | same(k, F.get(keys, i + 1))
        )
        places = F.sort_array(F.transform(twice, lambda k: k.bitwiseAND(low).cast("int")))
        return bind(places, lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))),
            F.lit(0).cast("long"), lambda a, x: a + x,
        ))

    return F.when(
        F.size(words) >= 4, bind(windows(words), lambda keys: covered(words, keys))
    ).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """The kept columns and the statistics of each text."""
    rows = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    trimmed = F.btrim("_text", F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )
    lines = F.filter(F.split("_text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    length = F.length("_text")
    rows = rows.withColumn("_words", words).withColumn("_lines", lines)
    return rows.select(
        *[c for c in rows.columns if c not in ("_text", "_words", "_lines")],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (length - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
    )


def _vector() -> list[Column]:
    """The transformed statistics: roots of shares and logarithms."""
    words = F.greatest("n_words", F.lit(1))

    def share(part: str, whole: Column) -> Column:
        return F.sqrt(F.col(part) / whole)

    return [
        F.log(F.greatest("word_chars", F.lit(1)) / words),
        share("n_symbols", F.greatest("word_chars", F.lit(1))),
        share("n_dup_lines", F.greatest("n_lines", F.lit(1))),
        share("n_repeat_words", words),
        F.log(words.cast("double")),
    ]


def _cholesky(params: DataFrame) -> DataFrame:
    """Add l<i><j>, the triangular factor of the covariance c<i><j>."""
    for j in _N:
        rest = {}
        for i in range(j, len(FEATURES)):
            rest[i] = F.col(f"c{i}{j}") if i != j else F.col(f"c{i}{i}") + F.col(f"r{i}") ** 2
            for k in range(j):
                rest[i] = rest[i] - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        params = params.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest.pop(j), F.lit(1e-12))))
        params = params.withColumns({f"l{i}{j}": r / F.col(f"l{j}{j}") for i, r in rest.items()})
    return params


def _distance(rows: DataFrame) -> Column:
    """Squared Mahalanobis distance by forward substitution, from x<i>, m<i>, l<i><j>."""
    solved: list[Column] = []
    for i in range(len(FEATURES)):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l{i}{i}"))
    return sum((z * z for z in solved[1:]), solved[0] * solved[0])


def _grouped(rows: DataFrame) -> DataFrame:
    """Add grp, the group that a row's estimates come from, or null if there are too few rows."""
    taken = F.sum(F.col("used").cast("long"))
    cells = rows.groupBy("lang_", "source_").agg(taken.alias("n"))
    langs = cells.groupBy("lang_").agg(F.sum("n").alias("n_lang"))
    whole = langs.agg(F.sum("n_lang").alias("n_all")).first()["n_all"] or 0
    everything = F.lit("all") if whole >= MIN_ROWS else F.lit(None)
    names = cells.join(langs, "lang_").select(
        "lang_", "source_",
        F.when(F.col("n") >= MIN_ROWS, F.concat(F.lit("c"), F.sha2(F.to_json(F.struct("lang_", "source_")), 256)))
        .when(F.col("n_lang") >= MIN_ROWS, F.concat(F.lit("l"), F.sha2("lang_", 256)))
        .otherwise(everything).alias("grp"),
    )
    return rows.join(landed(names, "mcd-names"), ["lang_", "source_"], "left")


def _pools(rows: DataFrame) -> DataFrame:
    """Rows for the estimates: one per own group; pooled groups draw on all rows of their pool."""
    needed = landed(rows.select("grp").distinct().where("grp is not null"), "mcd-groups")
    pools = rows.select("*", F.explode(F.array_distinct(F.array(
        F.col("grp"), F.concat(F.lit("l"), F.sha2("lang_", 256)), F.lit("all")
    ))).alias("pool")).where("used and pool is not null")
    return pools.join(needed.withColumnRenamed("grp", "pool"), "pool", "left_semi").select(
        "pool", "n_words", "word_chars", "n_lines", *[f"x{i}" for i in _N]
    )


def _steps() -> list[Column]:
    """Half the least step of each statistic at a pool's median text; a repeat has four words."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return [0.5 / chars, 0.5 / F.sqrt(chars), 0.5 / F.sqrt(lines), 1 / F.sqrt(words), 0.5 / words]


def _quantile(column: Column, share: float) -> Column:
    return F.percentile_approx(column, F.lit(share), ACCURACY)


def _starts(pools: DataFrame) -> DataFrame:
    """Per pool and start: m<i>, r<i> and a first covariance c<i><j>."""
    middle = pools.groupBy("pool").agg(
        *[_quantile(F.col(f"x{i}"), 0.5).alias(f"m{i}") for i in _N],
        *[_quantile(F.col(c), 0.5).alias(c) for c in ("n_words", "word_chars", "n_lines")],
    ).select("pool", *[f"m{i}" for i in _N], *[r.alias(f"r{i}") for i, r in enumerate(_steps())])
    middle = landed(middle, "mcd-middle")
    narrow = pools.select("pool", *[f"x{i}" for i in _N])
    mads = narrow.join(middle, "pool").groupBy("pool").agg(
        *[(_quantile(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5) * 1.4826).alias(f"d{i}") for i in _N],
    )
    spread = landed(middle.join(mads, "pool").select(
        "*", *[F.sqrt(F.col(f"d{i}") ** 2 + F.col(f"r{i}") ** 2).alias(f"s{i}") for i in _N]
    ), "mcd-spread")
    z = [((F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i in _N]
    scaled = narrow.join(spread, "pool").select("pool", *z)
    norm = F.greatest(F.sqrt(sum((F.col(f"z{i}") ** 2 for i in _N), F.lit(0.0))), F.lit(1e-9))
    tanh = [F.tanh(f"z{i}") for i in _N]
    sign = [F.col(f"z{i}") / norm for i in _N]
    sums = scaled.groupBy("pool").agg(
        *[F.covar_pop(tanh[i], tanh[j]).alias(f"t{i}{j}") for i, j in _PAIRS],
        *[F.covar_pop(sign[i], sign[j]).alias(f"u{i}{j}") for i, j in _PAIRS],
    )
    both = spread.join(sums, "pool")
    firsts = [
        [F.col(f"d{i}") ** 2 if i == j else F.lit(0.0) for i, j in _PAIRS],
        [F.col(f"t{i}{j}") * F.col(f"s{i}") * F.col(f"s{j}") for i, j in _PAIRS],
        [F.col(f"u{i}{j}") * len(FEATURES) * F.col(f"s{i}") * F.col(f"s{j}") for i, j in _PAIRS],
    ]
    entries = [
        F.struct(F.lit(k).alias("start"), *[c.alias(f"c{i}{j}") for c, (i, j) in zip(first, _PAIRS)])
        for k, first in enumerate(firsts)
    ]
    each = both.select("pool", *[f"m{i}" for i in _N], *[f"r{i}" for i in _N], F.explode(F.array(*entries)).alias("e"))
    return each.select("pool", "e.*", *[f"m{i}" for i in _N], *[f"r{i}" for i in _N])


def _moments(rows: DataFrame, keys: list[str], factor: float, kept: list[str]) -> DataFrame:
    """Mean and covariance of rows, times a factor, with their factor l<i><j> and log determinant."""
    # Moments around the last centre, so that no large squares cancel.
    off = [F.col(f"x{i}") - F.col(f"m{i}") for i in _N]
    kept = [*kept, *[f"m{i}" for i in _N], *[f"r{i}" for i in _N]]
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(c).alias(c) for c in kept],
        *[F.avg(off[i]).alias(f"a{i}") for i in _N],
        *[F.avg(off[i] * off[j]).alias(f"b{i}{j}") for i, j in _PAIRS],
    )
    fresh = {f"m{i}": F.col(f"m{i}") + F.col(f"a{i}") for i in _N}
    params = sums.select(
        *keys, "n", *[fresh.get(c, F.col(c)).alias(c) for c in kept],
        *[((F.col(f"b{i}{j}") - F.col(f"a{i}") * F.col(f"a{j}")) * factor).alias(f"c{i}{j}") for i, j in _PAIRS],
    )
    return _cholesky(params).withColumn("det", sum((F.log(f"l{i}{i}") * 2 for i in _N), F.lit(0.0)))


def estimates(pools: DataFrame) -> DataFrame:
    """Per pool: m<i>, l<i><j> and n, the rows that they come from."""
    pools = landed(pools, "mcd-pools")
    narrow = pools.select("pool", *[f"x{i}" for i in _N])

    def near(params: DataFrame) -> DataFrame:
        return narrow.join(params, "pool").withColumn("d2", _distance(narrow))

    first = _cholesky(landed(_starts(pools), "mcd-start")).withColumn("last", F.lit(float("inf")))
    moving = landed(first, "mcd-params")
    settled = None
    while True:
        rows = near(moving)
        limits = rows.groupBy("pool", "start").agg(_quantile(F.col("d2"), CORE).alias("limit"))
        core = rows.join(landed(limits, "mcd-limits"), ["pool", "start"]).where("d2 <= limit")
        stepped = landed(_moments(core, ["pool", "start"], CORE_FACTOR, ["last"]), "mcd-step")
        done = stepped.where(F.col("last") - F.col("det") <= SETTLED)
        settled = done if settled is None else settled.unionByName(done)
        moving = stepped.where(F.col("last") - F.col("det") > SETTLED)
        moving = moving.drop("last").withColumnRenamed("det", "last")
        if moving.isEmpty():
            break
    best = settled.groupBy("pool").agg(
        F.min_by(F.struct(*settled.columns), F.struct("det", "start")).alias("best")
    ).select("best.*")
    inner = near(landed(best, "mcd-best")).where(F.col("d2") <= CHI2_INNER)
    return landed(_moments(inner, ["pool"], INNER_FACTOR, []), "mcd")


def _finite_cut() -> Column:
    """The point of CHI2_CUT for distances from estimates of n rows: of F with 5 and n - 5 degrees
    of freedom, by Paulson's approximation."""
    p = len(FEATURES)
    n, z = F.col("n"), NORMAL_CUT
    a, b = 2 / (9 * p), 2 / (9 * (n - p))
    root = F.sqrt(a * (1 - b) ** 2 + b * (1 - a) ** 2 - a * z * z * b)
    cube = ((1 - a) * (1 - b) + z * root) / ((1 - b) ** 2 - z * z * b)
    return (n + 1) / n * (n - 1) * p / (n - p) * cube ** 3


def quality(
    docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang",
    source: str = "source", cut: float = CHI2_CUT,
) -> DataFrame:
    """Per row: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    distance (null without an estimate; squared, scaled so that CHI2_CUT is the cut at any number of
    rows), kept."""
    null = F.lit("\x00null")
    keep = [
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(lang).cast("string"), null).alias("lang_"),
        F.coalesce(F.col(source).cast("string"), null).alias("source_"),
    ]
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    rows = measured(docs, text, keep).withColumn("base_failed", failed)
    rows = rows.withColumn("used", ~F.col("base_failed"))
    for i, value in enumerate(_vector()):
        rows = rows.withColumn(f"x{i}", value)
    rows = landed(rows, "quality-rows")
    grouped = _grouped(rows)
    params = estimates(_pools(grouped)).withColumnRenamed("pool", "grp")
    near = grouped.join(params, "grp", "left")
    distance = _distance(near) * CHI2_CUT / _finite_cut()
    return near.select(
        F.col("doc_id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", distance.alias("distance"),
        (~F.col("base_failed") & F.coalesce(distance <= cut, F.lit(True))).alias("kept"),
    )
