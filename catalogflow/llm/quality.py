"""Quality rules: robust multivariate outliers (minimum covariance determinant).

Each text is turned into counts, and the counts into a vector of transformed statistics. For each
language and source, location and scatter of the vectors are those of the three quarters of the rows whose scatter has the
least determinant that is found: concentration steps go from several starts (medians and quartiles, all rows, and
two parts of the rows by hash), after two steps the start with the least determinant goes on, and its steps end when the
determinant no longer falls. The scatter is scaled for the share and has a floor. A row is rejected when its Mahalanobis
distance is beyond a quantile of the chi-squared law.

A concentration step is one pass over the vectors of the rows of cells that still improve: rows are counted, and their moments
summed, by cell, start and distance bin, and the bins up to the wanted share give the next estimate. No cell
is gathered, whatever its share of the rows, and nothing goes to the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.llm.common import by_batch, stored

# White space and symbols as bytes.
_WHITE = " \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(i for i in range(256) if i not in _SYMBOLS)
_NOT_UPPER = bytes(i for i in range(256) if not 65 <= i <= 90)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
_STATS = "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS)
_STATS_ARROW = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), *((c, pa.int64()) for c in COUNTS)])

#: Least standard deviation of each statistic: most rows have no symbols and no repeats at all, which alone would make the scatter singular.
FLOORS = (0.25, 0.05, 0.04, 0.2, 0.15, 0.08)
P = len(FLOORS)
_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_BINS_PER_E = 64
_FALL = 1e-3  # of the logarithm of the determinant, from which a step counts as one


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six ASCII white space characters
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    grams = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(grams)) < len(grams):
        found = Counter(grams)
        covered = -1  # last word that is counted
        for i, gram in enumerate(grams):
            if found[gram] > 1:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    return (
        len(words), len(text) - sum(map(text.count, _WHITE)), len(raw.translate(None, _NOT_SYMBOL)), len(lines) - len(set(lines)), repeated, len(lines),
        len(raw.translate(None, _NOT_UPPER)),
    )


def _counted(rows: Iterator[tuple]) -> Iterator[tuple]:
    for *keys, text in rows:
        yield (*keys, *text_counts(text))


def document_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row of counts per row of ``docs``; null languages and sources become empty text."""
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return by_batch(docs.select(F.col(doc_id).cast("long"), key(lang), key(source), text), _STATS, _STATS_ARROW, _counted)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return [
        F.log1p("n_words"), F.log(chars / words), F.sqrt(F.col("n_symbols") / chars), F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words), F.sqrt(F.col("n_upper") / chars),
    ]


def _chi2_cdf(x: float, k: int) -> float:
    """For an even number ``k`` of degrees of freedom."""
    term, total = 1.0, 0.0
    for i in range(k // 2):
        total += term
        term *= x / 2 / (i + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(share: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_cdf(middle, k) < share else (low, middle)
    return high


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x0``.. from ``mean`` by the inverse scatter ``inv``."""
    gap = [F.col(f"x{i}") - F.col("mean")[i] for i in range(P)]
    return sum(((1 if i == j else 2) * F.col("inv")[k] * gap[i] * gap[j] for k, (i, j) in enumerate(_PAIRS)), F.lit(0.0))


def _inverses(spread: float):
    """From counts and moments of a cell and start to its mean, the upper half of its inverse scatter, and the logarithm of the scatter's determinant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means, inverses, determinants = [], [], []
            for n, first, second in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                mean = np.array(first) / n
                scatter = np.zeros((P, P))
                for k, (i, j) in enumerate(_PAIRS):
                    scatter[i, j] = scatter[j, i] = second[k] / n - mean[i] * mean[j]
                scatter = spread * scatter + np.diag(np.square(FLOORS))
                inverse = np.linalg.pinv(scatter)
                means.append(mean.tolist())
                inverses.append([float(inverse[p]) for p in _PAIRS])
                determinants.append(float(np.linalg.slogdet(scatter)[1]))
            doubles = pa.list_(pa.float64())
            columns = [batch.column(0), batch.column(1), pa.array(means, doubles), pa.array(inverses, doubles), pa.array(determinants, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "start", "mean", "inv", "logdet"])

    return run


_CELLS = "cell string, start int, mean array<double>, inv array<double>, logdet double"


def _moments() -> list[Column]:
    return [F.sum(f"x{i}").alias(f"s{i}") for i in range(P)] + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{k}") for k, (i, j) in enumerate(_PAIRS)]


def _estimate(near: DataFrame, spread: float) -> DataFrame:
    """Estimates from rows of (cell, start, n, s0.., q0..)."""
    sums = near.groupBy("cell", "start").agg(
        F.sum("n").cast("double").alias("n"), F.array(*[F.sum(f"s{i}") for i in range(P)]).alias("first"),
        F.array(*[F.sum(f"q{k}") for k in range(len(_PAIRS))]).alias("second"),
    )
    return stored(sums.mapInArrow(_inverses(spread), _CELLS), "scatter")


def _starts(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """First estimates: 0 from medians and quartiles, 1 from all rows, 2 and 3 from the rows of an eighth each by hash."""
    width = [F.pow(F.greatest((F.col(f"m{i}")[2] - F.col(f"m{i}")[0]) / 1.349, F.lit(FLOORS[i])), -2) for i in range(P)]
    inverse = [width[i] if i == j else F.lit(0.0) for i, j in _PAIRS]
    middle = sized.select("cell", F.lit(0).alias("start"), F.array(*[F.col(f"m{i}")[1] for i in range(P)]).alias("mean"), F.array(*inverse).alias("inv"), F.lit(float("inf")).alias("logdet"))
    part = F.pmod(F.xxhash64(*[f"x{i}" for i in range(P)]), F.lit(8)).cast("int")
    of = F.when(part < 2, F.array(F.lit(1), part + 2)).otherwise(F.array(F.lit(1)))
    sums = rows.join(sized.select("cell"), "cell").withColumn("start", F.explode(of)).groupBy("cell", "start").agg(F.count(F.lit(1)).alias("n"), *_moments())
    return stored(middle.unionByName(_estimate(sums, 1.0)), "starts")


def _concentrate(rows: DataFrame, cells: DataFrame, share: float, spread: float) -> DataFrame:
    """The next estimate of each cell and start from the nearest ``share`` of the cell's rows, to the width of a bin."""
    d = rows.join(cells.drop("logdet"), "cell").withColumn("bin", F.least(F.floor(F.log1p(_distance()) * _BINS_PER_E), F.lit(40 * _BINS_PER_E)))
    bins = d.groupBy("cell", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *_moments())
    cell = Window.partitionBy("cell", "start")  # over the bins of a cell, whose number is bounded
    before = F.sum("n").over(cell.orderBy("bin")) - F.col("n")
    near = bins.withColumn("before", before).withColumn("all", F.sum("n").over(cell)).where(F.col("before") < share * F.col("all"))
    return _estimate(near, spread)


def _least_determinant(rows: DataFrame, starts: DataFrame, share: float, spread: float, most_steps: int) -> DataFrame:
    """(cell, mean, inv, logdet): of each cell the estimate at which the determinant no longer falls."""
    tried = _concentrate(rows, _concentrate(rows, starts, share, spread), share, spread)
    best = F.min_by(F.struct("start", "mean", "inv", "logdet"), F.struct("logdet", "start")).alias("b")
    cells = stored(tried.groupBy("cell").agg(best).select("cell", "b.*"), "best")
    falling = cells
    for _ in range(most_steps):
        later = _concentrate(rows, falling, share, spread)
        met = later.join(cells.select("cell", F.col("logdet").alias("_before")), "cell").where(F.col("logdet") < F.col("_before") - _FALL)
        falling = stored(met.drop("_before"), "falling")
        if falling.isEmpty():
            break
        cells = stored(cells.join(falling.select("cell"), "cell", "left_anti").unionByName(falling), "best")
    return cells


def _cells(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` with ``cell``: language and source, or the language's small sources together, or all that is left."""
    one = F.to_json(F.array("lang", "source"))
    small = lambda n: F.coalesce(F.col(n), F.lit(0)) < least
    by_source = rows.where("usable").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_a"))
    by_lang = by_source.where(F.col("_a") < least).groupBy("lang").agg(F.sum("_a").alias("_b"))
    named = rows.join(stored(by_source, "sources"), ["lang", "source"], "left").join(stored(by_lang, "languages"), "lang", "left")
    cell = F.when(~small("_a"), one).when(~small("_b"), F.to_json(F.array("lang"))).otherwise(F.lit("[]"))
    return named.withColumn("cell", cell).drop("_a", "_b")


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    share: float = 0.75, most_steps: int = 20, confidence: float = 0.999999, least_rows: int = 100,
) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` and ``kept`` of every row of ``docs``.

    Estimates come from the rows that pass the base rules. Sources with fewer than ``least_rows`` of
    those are judged together with the other small ones of their language, and languages that remain
    small are judged together; with fewer rows than that in the last cell, base rules alone decide there.
    Null text counts as empty and fails the base rules; repeated rows count each time.
    """
    counts = stored(document_counts(docs, doc_id, text, lang, source), "counts")
    vector = [x.alias(f"x{i}") for i, x in enumerate(_vector())]
    rows = _cells(counts.select("*", base_failed().alias("base_failed"), (~base_failed()).alias("usable"), *vector), least_rows)
    usable = rows.where("usable").select("cell", *[f"x{i}" for i in range(P)])
    quartiles = [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 10000).alias(f"m{i}") for i in range(P)]
    sized = usable.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *quartiles).where(F.col("n") >= least_rows)
    inner = chi2_quantile(share, P)
    cells = _least_determinant(usable, _starts(usable, stored(sized, "sized")), share, share / _chi2_cdf(inner, P + 2), most_steps)
    judged = rows.join(cells.drop("start", "logdet"), "cell", "left").withColumn("distance", _distance())
    far = F.coalesce(F.col("distance") > chi2_quantile(confidence, P), F.lit(False))
    return judged.select("doc_id", "lang", "source", *COUNTS, "base_failed", "distance", (~F.col("base_failed") & ~far).alias("kept"))
