"""Word vectors: vocabulary tables, training pairs, neighbours, words to show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tinta.functions.rows import explode_rows
from tinta.functions.text import digit_pattern
from tinta.operators.neighbours import nearest
from tinta.operators.ranking import running_offset
from tinta.session import cut_lineage

VECTOR_SIZE = 300
WINDOW = 5
EPOCHS = 5
TOP_WORDS = 30
TOP_NEIGHBOURS = 10
SEED = 42

# Default query words, unseen query words, and frequent words that are no queries.
DEFAULT_WORDS = ("gobierno", "presidente", "ciudad", "equipo", "mercado")
DEFAULT_OOV_WORDS = ("hiperconectividad", "futbolísticamente")
LIGHT_STOPWORDS = ("para", "como", "pero", "este", "esta", "sobre", "entre", "desde", "también")

OUT_OF_VOCABULARY = "fuera_del_vocabulario"


def vocabulary_index(counts: DataFrame) -> DataFrame:
    """``word, idx, count`` from ``token, count``: idx is 0 for the most frequent word, ties by word."""
    key = F.concat(F.lpad((F.lit(2**62) - F.col("count")).cast("string"), 20, "0"), F.col("token"))
    # the vocabulary is read for its cut points and again to number it; the corpus is read once
    keyed = cut_lineage(counts.select(key.alias("_key"), F.lit(1).alias("_one")))
    numbered = running_offset(keyed, "_key", "_one")
    # the key holds both columns, so nothing is joined back
    return numbered.select(
        F.substr("_key", F.lit(21)).alias("word"),
        F.col("offset").cast("bigint").alias("idx"),
        (F.lit(2**62) - F.substring("_key", 1, 20).cast("bigint")).alias("count"),
    )


def skipgram_pairs(sentences: DataFrame, window: int = WINDOW) -> DataFrame:
    """``center, context, count`` of all words at most ``window`` apart.

    The pairs of a sentence are built inside its row, so no self-join is needed, and equal pairs are
    added up per task before the shuffle. Two words meet as often one way round as the other, so only the
    words to the right are paired, both orders of a pair are counted as one, and counts are turned round at the end.
    """
    tokens = F.col("tokens")

    def after(center: Column, i: Column) -> Column:
        return F.struct(center.alias("center"), F.slice(tokens, i + 2, F.lit(window)).alias("contexts"))

    centers = explode_rows(sentences, F.transform(tokens, after), "_after")
    pairs = explode_rows(centers, F.col("_after.contexts"), "_context", F.col("_after.center").alias("_center"))
    ends = F.least("_center", "_context").alias("_low"), F.greatest("_center", "_context").alias("_high")
    counted = pairs.groupBy(*ends).agg(F.count("*").alias("_n"))

    def turned(center: str, context: str, n: Column) -> Column:
        return F.struct(F.col(center).alias("center"), F.col(context).alias("context"), n.alias("count"))

    both = F.array(turned("_low", "_high", F.col("_n")), turned("_high", "_low", F.col("_n")))
    one = F.array(turned("_low", "_high", F.col("_n") * 2))
    return counted.select(F.inline(F.when(F.col("_low") == F.col("_high"), one).otherwise(both)))


def vocabulary_stats(vectors: DataFrame, model_type: str, top_n: int = TOP_WORDS) -> DataFrame:
    """One row: vocabulary size, vector size and the most frequent words with their counts."""
    top = vectors.where(F.col("idx") < top_n).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("idx", "word", "count"))),
            lambda x: F.struct(x["word"].alias("word"), x["count"].alias("count")),
        ).alias("top")
    )
    return vectors.agg(
        F.count("*").alias("vocab_size"), F.max(F.size("vector")).cast("bigint").alias("vector_size")
    ).select(
        F.lit(model_type).alias("model_type"), "vocab_size", "vector_size", top.scalar().alias("top_words")
    )


def embedding_matrix(vectors: DataFrame, max_words: int | None = None) -> DataFrame:
    """``index, word, vector`` of the most frequent words."""
    rows = vectors if max_words is None else vectors.where(F.col("idx") < max_words)
    return rows.select(F.col("idx").alias("index"), "word", "vector")


def first_vectors(vectors: DataFrame, order: str, max_items: int = 5000) -> DataFrame:
    return vectors.orderBy(order).limit(max_items)


def word_list(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """Words of a caller's list with their place in it."""
    return spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, position bigint")


def similar_words(vectors: DataFrame, words: DataFrame, model: str, n: int = TOP_NEIGHBOURS) -> DataFrame:
    """The n nearest words of each query word; a word outside the vocabulary gets a marker row."""
    words = cut_lineage(words.select("word"))  # the words, and the vectors of those that have one, are read several times below
    known = cut_lineage(vectors.join(words, "word", "left_semi").select("word", "vector"))
    ranked = nearest(vectors, known, n, "word", "vector")
    found = ranked.select(
        F.lit(model).alias("modelo"),
        F.col("query_id").alias("palabra_consultada"),
        F.col("neighbour_id").alias("palabra_similar"),
        "score",
        "ranking",
        F.lit("ok").alias("estado"),
    )
    missing = words.join(vectors.select("word"), "word", "left_anti").select(
        F.lit(model).alias("modelo"),
        F.col("word").alias("palabra_consultada"),
        F.lit(None).cast("string").alias("palabra_similar"),
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("bigint").alias("ranking"),
        F.lit(OUT_OF_VOCABULARY).alias("estado"),
    )
    return found.unionByName(missing)


def common_words(words: DataFrame, *vocabularies: DataFrame) -> DataFrame:
    """The words every vocabulary holds."""
    for vectors in vocabularies:
        words = words.join(vectors.select("word"), "word", "left_semi")
    return words


def similarity_report(
    first: DataFrame, second: DataFrame, words: DataFrame, names: tuple[str, str], n: int = TOP_NEIGHBOURS
) -> DataFrame:
    """Neighbours of the words both models know, of both models; no common word is an error."""
    shared = cut_lineage(common_words(words.select("word"), first, second))
    if shared.isEmpty():
        raise ValueError("no query word is in both vocabularies")
    return similar_words(first, shared, names[0], n).unionByName(similar_words(second, shared, names[1], n))


def _by_priority(preferred: DataFrame, others: DataFrame, n: int) -> DataFrame:
    """Preferred words in their order, then others by frequency, n in all."""
    rest = others.join(preferred.select("word"), "word", "left_anti")
    ranked = preferred.select("word", F.lit(0).alias("priority"), F.col("position").alias("place")).unionByName(
        rest.select("word", F.lit(1).alias("priority"), F.col("idx").alias("place"))
    )
    best = ranked.orderBy("priority", "place").limit(n)
    order = Window.orderBy("priority", "place")  # over n rows
    return best.select("word", F.row_number().over(order).cast("bigint").alias("position"))


def default_words(
    first: DataFrame, second: DataFrame, n: int = 5, preferred: Sequence[str] = DEFAULT_WORDS
) -> DataFrame:
    """Query words: preferred ones both vocabularies hold, topped up with frequent longer words."""
    wanted = common_words(word_list(first.sparkSession, preferred), first, second)
    frequent = common_words(first.select("word", "idx"), second).where(
        (F.length("word") >= 4) & ~F.col("word").isin(*LIGHT_STOPWORDS) & ~F.col("word").rlike(digit_pattern())
    )
    return _by_priority(wanted, frequent, n)


def display_words(vectors: DataFrame, max_words: int = 200, preferred: Sequence[str] = ()) -> DataFrame:
    """Words to show: preferred ones first, then frequent words of three letters or more, no digits."""
    wanted = common_words(word_list(vectors.sparkSession, list(dict.fromkeys(preferred))), vectors)
    frequent = vectors.where((F.length("word") >= 3) & ~F.col("word").rlike(digit_pattern()))
    return _by_priority(wanted, frequent.select("word", "idx"), max_words)


def vectors_of(words: DataFrame, vectors: DataFrame) -> DataFrame:
    """Vectors of the words that have one, with their place in the list."""
    return vectors.join(words.select("word", "position"), "word").select("word", "position", "vector")
