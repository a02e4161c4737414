"""Batch search: matching, ranking, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.functions.keys import acronyms, let, text
from catalogflow.operators.ordering import top_per_group
from catalogflow.session import cut

# Order of result types, and results shown per type.
TYPE_RANK = {"PART": 0, "MANUFACTURER": 1, "SUBCATEGORY": 2, "CATEGORY": 3}
PER_TYPE = 8
# Lengths of the runs by which names are looked up; every pair is checked, so they change no result.
GRAMS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)


def match_score(query: Column, label: Column) -> Column:
    """1 exact, 2 prefix, 3 acronym, 4 substring, null when nothing matches.

    The acronym test looks at the original label, the others ignore case.
    """
    q, l = F.lower(text(query)), F.lower(text(label))
    by_acronym = F.exists(acronyms(label), lambda a: a.startswith(q))
    return F.when((q != "") & (l != ""), F.when(l == q, 1).when(l.startswith(q), 2).when(by_acronym, 3).when(l.contains(q), 4))


def best_score(query: Column, names: Column) -> Column:
    """F7 over label and aliases: the least score."""
    return F.array_min(F.filter(F.transform(names, lambda n: match_score(query, n)), lambda s: s.isNotNull()))


def _grams(s: Column, n: Column) -> Column:
    """Substrings of length ``n`` of a text that is not shorter."""
    return F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: s.substr(i, n))


def _lengths(s: Column) -> Column:
    """Lengths of runs that a text has."""
    return F.filter(F.array(*[F.lit(n) for n in GRAMS]), lambda n: n <= F.length(s))


_FIELDS = ["entry_id", "type", "label", "url", "names"]


def _uses(entries: DataFrame) -> DataFrame:
    """(at, name) and the fields of each entry for each of its names."""
    named = entries.withColumn("names", F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>"))))
    return named.select(F.posexplode("names").alias("at", "name"), *_FIELDS).where(text("name") != "")


def _pieces(queries: DataFrame) -> DataFrame:
    """(q, g): the longest runs of each query that names are looked up by."""
    q = queries.select(F.lower(text("query")).alias("q")).where("q <> ''").distinct()
    return q.select("q", F.explode(F.array_distinct(_grams(F.col("q"), F.array_max(_lengths(F.col("q")))))).alias("g"))


def _name_grams(names: DataFrame) -> DataFrame:
    """(g, name): the runs of each name."""
    s = F.lower(text("name"))
    return names.select(F.explode(F.array_distinct(F.flatten(F.transform(_lengths(s), lambda n: _grams(s, n))))).alias("g"), "name")


def _heads(names: DataFrame) -> DataFrame:
    """(g, name): the beginnings of the acronyms of each name."""
    beginnings = F.flatten(F.transform(F.filter(acronyms("name"), lambda a: a != ""), lambda a: F.transform(F.sequence(F.lit(1), F.length(a)), lambda i: a.substr(F.lit(1), i))))
    return names.select(F.explode(F.array_distinct(beginnings)).alias("g"), "name")


def _rarest(pieces: DataFrame, frequency: DataFrame) -> DataFrame:
    """(q, g): of each query the run that the fewest names have."""
    return pieces.join(frequency, "g", "left").groupBy("q").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("x")).where("x.n > 0").select("q", "x.g")


def _matched(by_text: DataFrame, by_acronym: DataFrame) -> DataFrame:
    """(q, name) that match among those of the two look-ups; no pair is in both."""
    contains = F.lower(text("name")).contains(F.col("q"))
    return by_text.where(contains).select("q", "name").unionByName(by_acronym.where(~contains).select("q", "name"))


def _scored(matched: DataFrame, uses: DataFrame) -> DataFrame:
    """The entries with a matching name, once each: where the first of their names that match is met."""
    scores = F.transform("names", lambda n: match_score(F.col("q"), n))
    x = let(scores, lambda s: F.struct(F.array_min(s).alias("score"), (F.array_position(F.transform(s, lambda v: v.isNotNull()), True) - 1).alias("first")))
    found = matched.join(uses.hint("merge"), "name").withColumn("x", x).where("x.first = at")
    return found.select(F.col("q").alias("query"), "entry_id", "type", "label", "url", "x.score")


def search(entries: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, entry) pairs that match, with their score.

    ``entries``: entry_id, type, label, aliases, url. ``queries``: query. Instead of meeting every
    entry, a query looks names up by a piece of itself: the rarest of its runs of the longest length in ``GRAMS`` that it has
    for exact, prefix and substring matches, and by acronym prefixes. Every pair found is then checked exactly, so the result is
    that of a full scan.

    Names are looked up once each, however many entries bear them, and runs are long enough that candidates grow like
    matches do, not like queries times names. Entries are joined to the names that matched, and one with several of them is taken at its
    first, so nothing is shuffled by entry and ``rank_matches`` cuts to the first few of a query inside the tasks. Joins with runs or names are merge
    joins: Spark takes a side for as small as the rows it was exploded from, and would broadcast it.
    """
    uses, pieces = _uses(entries), _pieces(queries)
    names = uses.select("name").distinct()
    asked = pieces.select("g").distinct()
    frequency = _name_grams(names).hint("merge").join(asked, "g", "left_semi").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    by_text = _name_grams(names).hint("merge").join(_rarest(pieces, frequency), "g")
    by_acronym = _heads(names).withColumnRenamed("g", "q").hint("merge").join(pieces.select("q").distinct(), "q")
    return _scored(_matched(by_text, by_acronym), uses)


# ---- search on a kept index (J13, B17) -----------------------------------------------------

class SearchIndex:
    """An inverted index in a folder, for many batches of queries over the same entries.

    ``text`` has the names by their runs, ``acronym`` by the beginnings of their acronyms, ``counts`` the names of
    each run, ``entries`` the entries by name; all are in folders by batch and by hash of the run or name, and sorted by it inside a file. Entries are added in batches: a
    batch writes its own folders and touches no others, and writing it again replaces it. An entry belongs to one batch.
    Queries read the counts of their own runs, then only the names of the rarest run of each, then the entries of the names that match. ``buckets``, the number of folders of a part,
    has to be the same for all who use an index.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 256):
        self._spark, self._folder, self._buckets = spark, folder.rstrip("/"), buckets

    def _bucket(self, c) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self._buckets)).cast("int").alias("bucket")

    def add(self, entries: DataFrame, batch: str) -> None:
        uses = _uses(entries)
        names = uses.select("name").distinct()
        self._write(_name_grams(names), "text", batch)
        self._write(_heads(names), "acronym", batch)
        self._write(_name_grams(names).groupBy("g").agg(F.count(F.lit(1)).alias("n")), "counts", batch)
        self._write(uses.withColumn("g", F.col("name")), "entries", batch)

    def _write(self, rows: DataFrame, part: str, batch: str) -> None:
        # rebalance splits a bucket with a very common run over several files
        dealt = rows.select("*", F.lit(batch).alias("batch"), self._bucket("g")).hint("rebalance", "bucket").sortWithinPartitions("bucket", "g")
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(f"{self._folder}/{part}")

    def rows(self, part: str, keys: DataFrame) -> DataFrame:
        """Rows of a part of the index for the runs in ``keys`` (g); only folders with one of them are read."""
        buckets = [r[0] for r in keys.select(self._bucket("g")).distinct().collect()]  # a fixed number at most
        return self._spark.read.parquet(f"{self._folder}/{part}").where(F.col("bucket").isin(buckets)).drop("bucket", "batch")

    def search(self, queries: DataFrame) -> DataFrame:
        """J13 as ``search`` gives it over all entries of the index."""
        pieces = cut(_pieces(queries))
        asked = pieces.select("g").distinct()
        rarest = cut(_rarest(pieces, self.rows("counts", asked).join(asked, "g").groupBy("g").agg(F.sum("n").alias("n"))))
        by_text = self.rows("text", rarest).join(rarest, "g")
        whole = pieces.select(F.col("q").alias("g")).distinct()
        by_acronym = self.rows("acronym", whole).join(whole, "g").withColumnRenamed("g", "q")
        matched = cut(_matched(by_text, by_acronym).distinct())  # batches may have names in common
        return _scored(matched, self.rows("entries", matched.select(F.col("name").alias("g"))).drop("g"))


def rank_matches(matches: DataFrame, per_type: int = PER_TYPE) -> DataFrame:
    """O1: first ``per_type`` of each type by score and label."""
    return top_per_group(matches, ["query", "type"], ["score", F.lower("label"), "label", "entry_id"], per_type)


def best_overall(matches: DataFrame) -> DataFrame:
    """O1: best match per query by score, then type."""
    rank = F.create_map(*[F.lit(x) for kv in TYPE_RANK.items() for x in kv])[F.col("type")]
    key = F.struct("score", rank.alias("t"), F.lower("label").alias("l"), F.col("label").alias("label"), F.col("entry_id").alias("e"), F.col("url").alias("u"), F.col("type").alias("type"))
    return matches.groupBy("query").agg(F.min(key).alias("b")).select("query", "b.type", "b.label", F.col("b.u").alias("url"), "b.score")


def route(matches: DataFrame, queries: DataFrame) -> DataFrame:
    """Where a query goes: its one exact part, else results if any part matches, else its one
    other entity, else results."""
    part = F.col("type") == "PART"
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    facts = matches.groupBy("query").agg(
        n(part & (F.col("score") == 1)).alias("exact"), n(part).alias("parts"), n(~part).alias("others"),
        F.min(F.when(part & (F.col("score") == 1), F.col("url"))).alias("part_url"), F.min(F.when(~part, F.col("url"))).alias("other_url"))
    q = queries.select(F.lower(text("query")).alias("query")).where("query <> ''").distinct()
    results = F.concat(F.lit("/search/?q="), F.url_encode("query"))
    url = (
        F.when(F.col("exact") == 1, F.col("part_url")).when(F.col("parts") >= 1, results)
        .when(F.col("others") == 1, F.col("other_url")).otherwise(results))
    return q.join(facts, "query", "left").select("query", url.alias("url"))
