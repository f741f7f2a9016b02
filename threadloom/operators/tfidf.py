"""TF-IDF over uni- and bigrams with a bounded vocabulary.

Weights are ``tf * (ln((1 + n) / (1 + df)) + 1)`` with unit L2 norm.  Fitting
shuffles only term counts; weighting a document is a narrow JVM-side
transformation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import WORD
from ..session import stage, widen
from .skew import is_small

# Fixed value: size of the vocabulary.
MAX_FEATURES = 5000
# Words (as a multiple of the vocabulary) up to which bigrams are pruned by a list.
PRUNE_FACTOR = 4


def english_stop_words() -> list[str]:
    """The list that Spark ships."""
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-cased runs of two or more word characters, stop words removed."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"{WORD}{{2,}}"), F.lit(0))
    if not stop_words:
        return found
    return F.filter(found, lambda t: ~t.isin(list(stop_words)))


def bigrams(words: Column) -> Column:
    """Adjacent tokens joined by a space, after stop words are gone."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.concat(a, F.lit(" "), b))


def terms(words: Column) -> Column:
    """Unigrams and bigrams of a token array."""
    return F.concat(words, bigrams(words))


def _counted(items: Column) -> Column:
    """Rows to explode: one (item, 1, 0) per occurrence, one (item, 0, 1) per document."""
    def tagged(occurrence: int, document: int):
        return lambda x: F.struct(
            x.alias("item"), F.lit(occurrence).cast("bigint").alias("tf"), F.lit(document).cast("bigint").alias("df"))
    return F.concat(F.transform(items, tagged(1, 0)), F.transform(F.array_distinct(items), tagged(0, 1)))


def _totals(items: DataFrame) -> DataFrame:
    """(term, total, docs) from rows (item, tf, df), combined on the map side."""
    return items.groupBy(F.col("item").alias("term")).agg(F.sum("tf").alias("total"), F.sum("df").alias("docs"))


@dataclass
class TfidfModel:
    """Vocabulary (at most ``max_features`` terms) with its idf weights."""

    vocabulary: list[str]
    idf: list[float]
    stop_words: tuple[str, ...]

    @property
    def size(self) -> int:
        return len(self.vocabulary)

    def transform(self, df: DataFrame, text_col: str, out: str = "tfidf") -> DataFrame:
        """Add the unit-length sparse vector of a text."""
        counter = CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol="_terms", outputCol="_tf")
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_w")
        unit = Normalizer(p=2.0, inputCol="_w", outputCol=out)
        prepared = (
            widen(df).withColumn("_words", tokens(F.col(text_col), self.stop_words))
            .withColumn("_terms", terms(F.col("_words")))
        )
        return unit.transform(weigh.transform(counter.transform(prepared))).drop("_words", "_terms", "_tf", "_w")

    def weights(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """Long form (id, term, weight) of the same vectors."""
        parts = F.unwrap_udt("tfidf")
        # One literal that is split once; terms hold word characters and spaces only.
        vocabulary = F.split(F.lit("\n".join(self.vocabulary)), "\n")
        return (
            self.transform(df, text_col)
            .select(id_col, F.explode(F.arrays_zip(
                parts["indices"].alias("at"), parts["values"].alias("weight"))).alias("entry"))
            .select(id_col, F.element_at(vocabulary, F.col("entry.at") + 1).alias("term"), F.col("entry.weight").alias("weight"))
        )


def fit_tfidf(
    corpus: DataFrame, text_col: str, max_features: int = MAX_FEATURES, stop_words: Sequence[str] = ()
) -> TfidfModel:
    """Choose the most frequent terms (ties by term) and their idf.

    A bigram is never more frequent than either of its words.  Once the
    ``max_features`` best unigrams are known, only bigrams of words at least as
    frequent as the last of them can still get in, so all others are dropped
    before the shuffle.  The result is the same as without the pruning.
    """
    words = widen(corpus.select(text_col)).select(tokens(F.col(text_col), stop_words).alias("words"))
    documents = corpus.count()
    single = stage(_totals(words.select(F.explode(_counted(F.col("words"))).alias("e")).select("e.*")), "unigrams")
    last = single.orderBy(F.desc("total"), "term").limit(max_features).agg(
        F.min("total").alias("least"), F.count("*").alias("n")).first()
    frequent = None
    if last["n"] == max_features:
        candidates = single.filter(F.col("total") >= last["least"]).select("term")
        if is_small(candidates, PRUNE_FACTOR * max_features):
            frequent = [row["term"] for row in candidates.collect()]
    if frequent:
        # Tokens are word characters only, so plain quotes are safe.
        listed = ", ".join(f"'{term}'" for term in frequent)
        words = words.select(F.expr(f"transform(words, w -> if(w in ({listed}), w, null))").alias("words"))
    pairs = words.select(bigrams(F.col("words")).alias("pairs")).select(
        F.explode(_counted(F.filter("pairs", lambda p: p.isNotNull()))).alias("e")).select("e.*")
    double = _totals(pairs)
    chosen = (
        single.unionByName(double).orderBy(F.desc("total"), "term").limit(max_features).collect()
    )
    return TfidfModel(
        vocabulary=[row["term"] for row in chosen],
        idf=[math.log((1 + documents) / (1 + row["docs"])) + 1 for row in chosen],
        stop_words=tuple(stop_words),
    )
