"""Tagging against a taxonomy that is a table: phrases met by joins, patterns run on hits only.

A phrase of n words is found among the word n-grams of a text, so the cost per text depends on the
lengths of the phrases, not on their number. Where the longer phrases start with few words, only the
n-grams that start with one of those are made.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators.tagging import Term, words_of

#: First words of longer phrases that a plan holds; with more of them all n-grams are made.
HEADS = 1000
INDEX = "term string, phrase string, size int, pattern string"


def phrase_index(phrases: DataFrame, term: str, phrase: str, pattern: str | None = None) -> DataFrame:
    """The index of a table of phrases: one row per term and phrase, its words in lower case.

    A row may have a regex, which its texts must match as well. Phrases without a word are left out.
    """
    words = F.filter(words_of(F.col(phrase)), lambda w: w != "")
    return phrases.select(
        F.col(term).alias("term"),
        F.array_join(words, " ").alias("phrase"),
        F.size(words).alias("size"),
        (F.col(pattern) if pattern else F.lit(None).cast("string")).alias("pattern"),
    ).filter("size > 0")


def taxonomy_index(spark: SparkSession, taxonomy: Iterable[Term]) -> DataFrame:
    """The index of terms written in code; each must name the phrases its pattern asks for.

    It is as small as the code it stands in, but of no size known to Spark, so it asks to be
    broadcast: else all n-grams of the texts would be shuffled to meet it.
    """
    rows = []
    for term in taxonomy:
        if not term.alternatives():
            raise ValueError(f"{term.name} names no phrase to look for")
        pattern = None if term.whole_words() else term.regex()
        rows += [(term.name, " ".join(words), len(words), pattern) for words in term.alternatives()]
    return F.broadcast(spark.createDataFrame(rows, INDEX))


def _grams(words: Column, sizes: list[int], heads: dict[int, list[str]] | None) -> Column:
    """The distinct n-grams of a list of words, for each n in `sizes`; those of several words only
    where they start with one of `heads`, if given."""

    def grams(n: int) -> Column:
        if n == 1:
            return words
        last = F.size(words) - n
        none = F.array().cast("array<int>")
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(none)
        if heads is not None:
            starts = F.filter(starts, lambda i: F.get(words, i).isin(heads[n]))
        # Word by word: a slice makes a list of its own for each place.
        return F.transform(
            starts, lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(n)))
        )

    return F.array_distinct(F.concat(*map(grams, sizes)))


def _heads(index: DataFrame) -> dict[int, list[str]] | None:
    """The first words of the phrases of several words, by length; none if there are very many."""
    first = F.substring_index("phrase", " ", 1).alias("head")
    rows = index.filter("size > 1").select("size", first).distinct().limit(HEADS + 1).collect()
    if len(rows) > HEADS:
        return None
    heads: dict[int, list[str]] = {}
    for r in sorted(rows):
        heads.setdefault(r["size"], []).append(r["head"])
    return heads


def phrase_hits(docs: DataFrame, key: str, text: str, index: DataFrame) -> DataFrame:
    """(key, term), one row per document and term found in it; `key` tells the documents apart.

    The n-grams of all texts meet the index in one join, which Spark makes a broadcast if the index
    is small. Phrases with a pattern, if there are any, are met by themselves; only the texts that
    hold one are read again for it.
    """
    # The lengths of the phrases without and with a pattern: a few numbers.
    kinds = index.select("size", F.col("pattern").isNotNull().alias("tested")).distinct().collect()
    sure, maybe = (sorted(k["size"] for k in kinds if k["tested"] == tested) for tested in (False, True))
    found = []
    if sure:
        plain = index.filter("pattern IS NULL")
        found.append(_met(docs, key, text, plain, sure).select(key, "term"))
    if maybe:
        met = _met(docs, key, text, index.filter("pattern IS NOT NULL"), maybe)
        texts = docs.select(key, text).join(met.distinct(), key)
        found.append(texts.filter(F.rlike(F.col(text), F.col("pattern"))).select(key, "term"))
    if not found:
        return docs.select(key).limit(0).withColumn("term", F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, found).distinct()


def _met(docs: DataFrame, key: str, text: str, index: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, term, pattern) of the phrases of these lengths in each document, repeats included."""
    # The words are a column of their own: each length of phrase reads them.
    words = docs.select(F.col(key), words_of(F.col(text)).alias("_words"))
    heads = _heads(index) if sizes[-1] > 1 else None
    grams = words.select(key, F.explode(_grams(F.col("_words"), sizes, heads)).alias("phrase"))
    return grams.join(index, "phrase").select(key, "term", "pattern")


def tag_phrases(
    docs: DataFrame, key: str, text: str, index: DataFrame, out: str = "terms"
) -> DataFrame:
    """The documents with the sorted names of the terms found in each, none as an empty array."""
    hits = phrase_hits(docs, key, text, index)
    # A document has as many terms as it holds phrases.
    tagged = hits.groupBy(key).agg(F.array_sort(F.collect_set("term")).alias(out))
    none = F.array().cast("array<string>")
    return docs.join(tagged, key, "left").withColumn(out, F.coalesce(out, none))
