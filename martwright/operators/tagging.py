"""Tagging texts against a taxonomy of named patterns, and counting the terms."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright import fixed
from martwright.functions.ladders import set_ladder, threshold_ladder
from martwright.functions.numbers import pct
from martwright.functions.text import WHITESPACE_CLASS, column

# A word character is a letter, number or underscore of any script. Spelled out,
# because what \b and \s mean beyond ASCII differs between Java versions.
WORD = r"[\p{L}\p{N}_]"
GAP = r"[^a-z\p{L}\p{N}_]+"  # a-z is one of the letters; tried first, it is the quick way out
BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# Patterns that only ask for one of some whole words.
_WHOLE_WORDS = re.compile(r"\\b(?:\(([^\W_]+(?:\|[^\W_]+)*)\)|([^\W_]+))\\b")


@dataclass(frozen=True)
class Term:
    """A name, its pattern, and a first test: alternatives of lower-case whole words.

    Every match of the pattern must hold all words of at least one alternative,
    as whole words in any order. With none given the pattern is always tried.
    """

    name: str
    pattern: str
    first_test: tuple[str, ...] = ()

    def regex(self) -> str:
        phrase = re.fullmatch(r"\\b(\w[\w ]*\w)\\b", self.pattern)
        if phrase:  # the literal first: most places in a text fail on its first letter
            return rf"(?iu){phrase[1]}(?!{WORD})(?<!{WORD}{phrase[1]})"
        # Next to a word character at the very start or end one side of \b is known.
        spelled = re.sub(r"^\\b(?=\w)", lambda _: rf"(?<!{WORD})", self.pattern)
        spelled = re.sub(r"(?<=\w)\\b$", lambda _: rf"(?!{WORD})", spelled)
        spelled = spelled.replace(r"\b", BOUNDARY).replace(r"\s", WHITESPACE_CLASS)
        return "(?iu)" + spelled

    def whole_words(self) -> tuple[str, ...]:
        """The words the pattern asks for, when that is all it does; else nothing."""
        match = _WHOLE_WORDS.fullmatch(self.pattern)
        if not match:
            return ()
        words = (match[1] or match[2]).lower().split("|")
        # Lower-casing a Greek sigma depends on its place in the word.
        return () if any(set(word) & set("\u03c3\u03c2") for word in words) else tuple(words)

    def alternatives(self) -> list[list[str]]:
        return [words.split() for words in self.whole_words() or self.first_test]


def word_taxonomy(phrases: Iterable[str]) -> list[Term]:
    """One term per whole word or phrase of words."""
    return [Term(phrase, rf"\b{phrase}\b", (phrase.lower(),)) for phrase in phrases]


# First tests of the fixed skill patterns that ask for more than whole words.
_SKILL_FIRST_TESTS = {
    "R": ("r",),
    "Java": ("java",),
    "Power BI": ("power bi",),
    "Qlik": ("qlik", "qlikview", "qliksense"),
    "AWS": ("aws", "amazon web services"),
    "GCP": ("gcp", "google cloud"),
    "Airflow": ("airflow",),
    "Spark": ("spark", "pyspark"),
    "SQL Server": ("sql server", "mssql", "microsoft sql"),
    "Data Modeling": ("data model", "data modeling", "data modeler"),
    "Data Warehouse": ("data warehouse",),
    "Data Lake": ("data lake",),
    "Data Lakehouse": ("data lakehouse",),
    "Star Schema": ("star schema",),
    "Dimensional Modeling": ("dimensional model", "dimensional modeling"),
    "Machine Learning": ("machine", "ml"),
    "Statistics": ("statistics", "statistical analysis"),
    "Data Governance": ("data governance",),
    "Data Quality": ("data quality",),
    "Data Catalog": ("data catalog",),
    "Lineage": ("data lineage",),
    "KPIs": ("kpi", "kpis", "key performance"),
    "Data Pipeline": ("data pipeline",),
    "Reporting": ("reporting", "report", "reports"),
    "Business Intelligence": ("business", "bi"),
}


def skill_taxonomy() -> list[Term]:
    """The fixed skill patterns."""
    return [
        Term(name, pattern, _SKILL_FIRST_TESTS.get(name, ()))
        for name, pattern in fixed.SKILL_PATTERNS.items()
    ]


# Letters that fold to ASCII in a case-blind search but not in `lower`.
_FOLDING = "\u0130\u0131\u017f\u212a"


def words_of(text: Column) -> Column:
    """The lower-case words of a text."""
    folds = F.lit(False)
    for letter in _FOLDING:
        folds = folds | text.contains(letter)
    lower = F.when(folds, F.lower(F.translate(text, _FOLDING, "iisk")))
    return F.split(lower.otherwise(F.lower(text)), GAP)


def tag_terms(df: DataFrame, text: str, taxonomy: Iterable[Term], out: str = "terms") -> DataFrame:
    """The names of the patterns found in a text, in taxonomy order, each once.

    One narrow pass over the whole text, without Python. The text is cut into
    words once and met with the words of the taxonomy, so the cost hardly grows
    with the number of terms: whole words are settled by that, and any other
    pattern runs only on texts that pass its first test.

    Spark moves a later filter on the terms below this step and so tags twice;
    to filter on them, write the tagged table first.
    """
    taxonomy = list(taxonomy)
    wanted = sorted({w for term in taxonomy for words in term.alternatives() for w in words})
    vocabulary = F.array(*(F.lit(word) for word in wanted))
    found = F.concat_ws(" ", F.array_intersect(words_of(F.col(text)), vocabulary))
    # The words found stand in the expression once, bound to the lambda's
    # argument: as a column of their own Spark may copy them into every test.
    once = F.array(F.concat(F.lit(" "), found, F.lit(" ")))
    terms = F.transform(once, lambda words: _names(words, F.col(text), taxonomy))
    return df.withColumn(out, F.get(terms, F.lit(0)))


def _names(words: Column, text: Column, taxonomy: list[Term]) -> Column:
    """Names of the terms that hold, given the taxonomy words found in the text."""
    hits = []
    for term in taxonomy:
        maybe = F.lit(False)
        for alternative in term.alternatives():
            all_words = F.lit(True)
            for word in alternative:
                all_words = all_words & words.contains(f" {word} ")
            maybe = maybe | all_words
        if not term.whole_words():
            matches = text.rlike(term.regex())
            maybe = maybe & matches if term.first_test else matches
        hits.append(F.when(maybe, F.lit(term.name)))
    return F.array_except(F.array(*hits), F.array(F.lit(None).cast("string")))


def spread(scan: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """The rows dealt over `partitions` by a unique key, before heavy work per row; as they
    are where no number is given. Worth its shuffle only if a table lies in few files."""
    return scan.repartition(partitions, key) if partitions else scan


def term_pairs(df: DataFrame, keep: list[str], terms: str = "terms", out: str = "term") -> DataFrame:
    """One row per document and term."""
    # The outer form, because for the plain one Spark adds a filter on the size of
    # the array below, which would tag every text a second time.
    return df.select(*keep, F.explode_outer(terms).alias(out)).filter(F.col(out).isNotNull())


def term_frequency(df: DataFrame, terms: str = "terms") -> DataFrame:
    """Documents per term, and the percentage of all documents, tagged or not.

    The counts are combined before the shuffle, so a term in every document
    costs one row per task. The total is a scalar subquery that reads no column.
    """
    documents = df.agg(F.count(F.lit(1))).scalar()
    return (
        term_pairs(df, [], terms)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .withColumn("pct_of_posts", pct("frequency", documents))
    )


def term_table(
    df: DataFrame,
    terms: str,
    tiers: list[tuple[float, str]],
    last_tier: str,
    categories: Mapping[str, list[str]],
    default_category: str,
) -> DataFrame:
    """`term_frequency` with its demand tier and category."""
    return (
        term_frequency(df, terms)
        .withColumn("demand_tier", threshold_ladder("pct_of_posts", tiers, last_tier))
        .withColumn("term_category", set_ladder("term", categories, default_category))
    )


def count_with_all(df: DataFrame, col: str | Column, wanted: list[str]) -> DataFrame:
    """How many rows hold all the wanted texts, anywhere and in any case."""
    text = F.lower(column(col))
    condition = F.lit(True)
    for word in wanted:
        condition = condition & text.contains(word.lower())
    return df.filter(condition).agg(F.count(F.lit(1)).alias("rows_with_all"))
