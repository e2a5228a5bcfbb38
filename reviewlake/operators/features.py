"""Text features (section 2.10), in two equivalent forms.

* Relational: tokens, vocabulary, tf-idf and Naive Bayes weights as plain
  tables ``(doc, term, ...)``. They are computed with explode + grouped
  aggregation, are checkable against SQL, and show *why* a model weighs a term.
* MLlib: ``text_pipeline`` builds the Tokenizer -> StopWordsRemover ->
  CountVectorizer/HashingTF -> IDF -> classifier pipeline.

A document is one row, so its term counts are taken inside the row
(``doc_terms``): no shuffle by (doc, term). Per-term totals are partially
aggregated on the map side, so a term present in every document costs one row
per map task before the only shuffle.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (IDF, CountVectorizer, HashingTF, StopWordsRemover,
                                StringIndexer, Tokenizer)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions.exprs import tokens_expr
from reviewlake.operators.sampling import MAX_BROADCAST_GROUPS
from reviewlake.schemas import STOP_WORDS_EN
from reviewlake.session import ensure_checkpoint_dir


def tokenize(df: DataFrame, text_col: str = "review_text", out_col: str = "words",
             parity: bool = False) -> DataFrame:
    """Lower-case and split on single whitespace characters.

    ``parity=True`` keeps MLlib ``Tokenizer``'s empty tokens (two spaces give
    an empty token between them); the default drops them. Null text gives a
    null token array (MLlib would raise).
    """
    return df.withColumn(out_col, tokens_expr(text_col, keep_empty=parity))


def remove_stopwords(df: DataFrame, in_col: str = "words", out_col: str = "filtered_words",
                     stop_words: list[str] | None = None, case_sensitive: bool = False) -> DataFrame:
    """Drop stop words (default: MLlib's English list), keeping order and duplicates."""
    words = list(stop_words if stop_words is not None else STOP_WORDS_EN)
    if case_sensitive:
        keep = lambda w: ~w.isin(words)
    else:
        lowered = [w.lower() for w in words]
        keep = lambda w: ~F.lower(w).isin(lowered)
    return df.withColumn(out_col, F.filter(F.col(in_col), keep))


def terms(df: DataFrame, doc_col: str = "event_id", text_col: str = "review_text",
          keep: tuple[str, ...] = (), stop_words: list[str] | None = None) -> DataFrame:
    """(doc, *keep, term): one row per non-empty, non-stop-word token.

    The exploded form of ``remove_stopwords(tokenize(df))``: ``split`` +
    ``explode`` + a plain ``NOT IN`` (a hash-set lookup) all stay inside
    whole-stage codegen, unlike a per-element lambda over the token array.
    """
    stop = [w.lower() for w in (stop_words if stop_words is not None else STOP_WORDS_EN)]
    t = F.col("term")
    return (df.where(F.col(text_col).isNotNull())
            .select(doc_col, *keep, F.explode(F.split(F.lower(text_col), r"\s")).alias("term"))
            .where((t != "") & ~t.isin(stop)))


def doc_terms(df: DataFrame, doc_col: str = "event_id", text_col: str = "review_text",
              keep: tuple[str, ...] = (), stop_words: list[str] | None = None,
              parity: bool = False) -> DataFrame:
    """(doc, *keep, term, tf): occurrences of each non-stop-word term in each row's text.

    Counted inside the row: the tokens are sorted, each run of equal ones is a
    term and its length the count. One row per (document, term) comes out of
    one explode; nothing is shuffled. ``parity=True`` keeps MLlib's empty
    tokens. A null text and one of stop words only have no rows; rows that
    repeat an id are counted each by itself.
    """
    stop = [w.lower() for w in (stop_words if stop_words is not None else STOP_WORDS_EN)]
    tokens = tokens_expr(text_col, keep_empty=True) if parity else F.split(F.lower(text_col), r"\s")
    words = df.where(F.col(text_col).isNotNull()).select(doc_col, *keep, F.sort_array(tokens).alias("__w"))
    w, n = F.col("__w"), F.size("__w")
    first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))
    runs = words.where(n > 0).select(doc_col, *keep, "__w", first.alias("__first"))
    end = lambda k: F.coalesce(F.get("__first", k + 1), n)
    cells = F.transform("__first", lambda i, k: F.struct(F.get(w, i).alias("term"), (end(k) - i).cast("long").alias("tf")))
    term = F.col("term")
    return (runs.select(doc_col, *keep, F.inline(cells))
            .where(~term.isin(stop) & (F.lit(True) if parity else term != "")))


def term_frequencies(terms_df: DataFrame, doc_col: str = "event_id",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc, *keep, term, tf): occurrences of each term in each document.

    ``keep`` carries per-document columns (e.g. the label) through the
    aggregation, so later steps need no join back to the documents.
    """
    return terms_df.groupBy(doc_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(tf: DataFrame, vocab_size: int = 5000, min_df: int = 5) -> DataFrame:
    """(term, term_count, doc_freq, rank): CountVectorizer's vocabulary as a table.

    Terms in at least ``min_df`` documents, the ``vocab_size`` most frequent
    by total count; equal counts are ordered by term (MLlib leaves them
    unordered). ``rank`` is the 0-based vector index. ``tf`` is the output of
    ``term_frequencies``: per-term totals are partially aggregated per map task.
    """
    top = (tf.groupBy("term").agg(F.sum("tf").alias("term_count"),
                                  F.count(F.lit(1)).alias("doc_freq"))
           .where(F.col("doc_freq") >= min_df)
           .orderBy(F.desc("term_count"), F.asc("term"))
           .limit(vocab_size))
    # the window runs over at most vocab_size rows
    w = Window.orderBy(F.desc("term_count"), F.asc("term"))
    return top.withColumn("rank", (F.row_number().over(w) - 1).cast("long"))


def tfidf(tf: DataFrame, vocab: DataFrame, docs: DataFrame, doc_col: str = "event_id",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc, *keep, term, tf, idf, weight) over vocabulary terms.

    idf = ln((m + 1) / (df + 1)) with m = number of rows of ``docs`` (every
    document, also those without a vocabulary term), as MLlib IDF with
    minDocFreq 0. The vocabulary side is bounded by ``vocab_size`` and is
    broadcast.
    """
    m = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    v = vocab.select("term", "doc_freq")
    idf = F.log((m + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))
    return (tf.join(F.broadcast(v), "term", "inner")
            .select(doc_col, *keep, "term", "tf", idf.alias("idf"))
            .withColumn("weight", F.col("tf") * F.col("idf")))


def nb_theta(weights: DataFrame, vocab: DataFrame, label_col: str = "label",
             smoothing: float = 1.0, classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """(label, term, theta): multinomial Naive Bayes log-weights as a table.

    ``weights`` is ``tfidf(..., keep=(label_col,))``. theta = ln((w(label,
    term) + s) / (W(label) + s * V)) with w the summed feature weight of the
    term in the label's documents, W its total over the vocabulary and V the
    vocabulary size; equal to ``NaiveBayesModel.theta``. Per-term class sums
    are conditional aggregates (no label x term grid join); class totals and
    V are windows over the vocabulary-sized frame (at most ``vocab_size`` rows).
    """
    sums = weights.groupBy("term").agg(*[
        F.sum(F.when(F.col(label_col) == c, F.col("weight"))).alias(f"w{c}") for c in classes])
    full = F.broadcast(vocab.select("term")).join(sums, "term", "left").fillna(
        0.0, subset=[f"w{c}" for c in classes])
    whole = Window.partitionBy()
    V = F.count(F.lit(1)).over(whole).cast("double")
    with_theta = full.select("term", *[
        F.log((F.col(f"w{c}") + smoothing) / (F.sum(f"w{c}").over(whole) + F.lit(smoothing) * V))
        .alias(f"t{c}") for c in classes])
    args = ", ".join(f"{c}, `t{c}`" for c in classes)
    return (with_theta.select("term", F.expr(f"stack({len(classes)}, {args}) AS (`{label_col}`, `theta`)"))
            .select(label_col, "term", "theta"))


def _slots(df: DataFrame, words_col: str, num_features: int) -> DataFrame:
    """Adds ``__tf``: MLlib's hashed count vector of a token array as a struct. Rows without tokens drop."""
    return HashingTF(inputCol=words_col, outputCol="__tf", numFeatures=num_features).transform(
        df.where(F.col(words_col).isNotNull())).withColumn("__tf", F.unwrap_udt("__tf"))


def hashing_tf(df: DataFrame, words_col: str = "filtered_words", doc_col: str = "event_id",
               num_features: int = 20000) -> DataFrame:
    """(doc, index, tf): MLlib HashingTF's entries as rows; no shuffle, no join."""
    cells = F.arrays_zip(F.col("__tf.indices").alias("index"), F.col("__tf.values").alias("tf"))
    return _slots(df, words_col, num_features).select(doc_col, F.inline(cells))


def label_index(label_col: str = "label_text", out_col: str = "label") -> StringIndexer:
    """label text -> 0/1 in alphabetical order (negative=0, positive=1); unknown skipped."""
    return StringIndexer(inputCol=label_col, outputCol=out_col, handleInvalid="skip",
                         stringOrderType="alphabetAsc")


def feature_stages(text_col: str = "review_text", vocab_size: int = 5000, min_df: int = 5,
                   hashing_features: int | None = None) -> list:
    """label index, tokenizer, stop words, counts (vocabulary or hashing), IDF."""
    counts = (HashingTF(inputCol="filtered_words", outputCol="tf_features",
                        numFeatures=hashing_features) if hashing_features else
              CountVectorizer(inputCol="filtered_words", outputCol="tf_features",
                              vocabSize=vocab_size, minDF=float(min_df)))
    return [label_index(),
            Tokenizer(inputCol=text_col, outputCol="words"),
            StopWordsRemover(inputCol="words", outputCol="filtered_words"),
            counts,
            IDF(inputCol="tf_features", outputCol="features")]


def text_pipeline(classifier, text_col: str = "review_text", vocab_size: int = 5000,
                  min_df: int = 5, hashing_features: int | None = None) -> Pipeline:
    """The five feature stages plus ``classifier`` as one Pipeline."""
    return Pipeline(stages=feature_stages(text_col, vocab_size, min_df, hashing_features)
                    + [classifier])


# the numeric features of a review (E1), in vector order
NUMERIC_FEATURES = ["review_text_length", "review_text_word_count", "review_votes", "app_review_count", "app_positive_ratio"]


def with_numeric(df: DataFrame, train: DataFrame, app_col: str = "app_id",
                 text_col: str = "review_text", class_col: str = "sentiment",
                 votes_col: str = "review_votes") -> DataFrame:
    """``df`` plus text length, word count, app review count and app positive ratio.

    App statistics come from ``train`` only (computing them on all rows would
    leak test labels into the features); apps unseen in training get nulls.
    The per-app frame has one row per app. It is computed and counted when this
    is called and broadcast if the apps are few, so that no text is shuffled
    and an app with very many reviews is no task of its own; else it is joined
    by AQE's choice.
    """
    ensure_checkpoint_dir(train.sparkSession)
    apps = train.groupBy(F.col(app_col).alias("__app")).agg(
        F.count(F.lit(1)).alias("app_review_count"),
        F.avg(F.when(F.col(class_col) == "positive", 1.0).otherwise(0.0)).alias("app_positive_ratio")).checkpoint(eager=True)
    if apps.count() <= MAX_BROADCAST_GROUPS:
        apps = F.broadcast(apps)
    words = F.size(tokens_expr(text_col))
    rows = df.withColumns({
        "review_text_length": F.length(text_col).cast("long"),
        "review_text_word_count": F.when(F.col(text_col).isNull(), None).otherwise(words).cast("long"),
        "review_votes": F.col(votes_col)})
    return rows.join(apps, F.col(app_col) == F.col("__app"), "left").drop("__app")


def numeric_features(df: DataFrame, train: DataFrame, app_col: str = "app_id",
                     text_col: str = "review_text", class_col: str = "sentiment",
                     votes_col: str = "review_votes", key: str = "event_id") -> DataFrame:
    """(key, text length, word count, votes, app review count, app positive ratio): ``with_numeric``'s columns alone."""
    narrow = list(dict.fromkeys([key, app_col, text_col, votes_col]))
    return with_numeric(df.select(*narrow), train, app_col, text_col, class_col, votes_col).select(key, *NUMERIC_FEATURES)


def mixed_stages(text_stages: list, numeric: list[str] = NUMERIC_FEATURES, out_col: str = "features") -> list:
    """Text feature stages followed by scaled numeric columns, as one sparse-text-plus-numbers vector.

    ``text_stages`` end in the text vector (``features``). Missing numbers take
    the training mean; numbers are divided by their training deviation and not
    centred, so that the text part stays sparse. Both are fitted with the
    pipeline, on its training rows only.
    """
    from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
    text_stages[-1].setOutputCol("text_features")
    filled = [f"{c}_filled" for c in numeric]
    return [*text_stages,
            Imputer(inputCols=numeric, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="scaled_numbers", withMean=False, withStd=True),
            VectorAssembler(inputCols=["text_features", "scaled_numbers"], outputCol=out_col)]


def class_weights(df: DataFrame, label_col: str = "label_text") -> DataFrame:
    """(label, weight): total / (classes * class count), the balanced loss weight."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # one row per class
    return counts.select(label_col, (F.sum("n").over(whole) /
                                     (F.count(F.lit(1)).over(whole) * F.col("n"))).alias("weight"))


def with_class_weights(df: DataFrame, label_col: str = "label_text",
                       out_col: str = "weight") -> DataFrame:
    """Adds the class weight column (``weightCol`` for MLlib) instead of undersampling.

    The weight frame has one row per class, so it is broadcast.
    """
    w = class_weights(df, label_col).withColumnRenamed("weight", out_col)
    return df.join(F.broadcast(w), label_col, "left")


def term_lookup(tf: DataFrame, vocab: DataFrame, doc_col: str = "event_id") -> DataFrame:
    """(doc, index, tf): term -> vector index through the vocabulary.

    The relational CountVectorizer output; the vocabulary side is bounded by
    ``vocab_size`` and broadcast.
    """
    v = F.broadcast(vocab.select("term", F.col("rank").alias("index")))
    return tf.join(v, "term", "inner").select(doc_col, "index", "tf")


def resolve_hashed_features(importance: DataFrame, tf: DataFrame,
                            num_features: int = 20000) -> DataFrame:
    """Name ``hash_feature_<i>`` rows by the corpus terms hashing to slot i.

    Adds ``top_term`` (the most frequent term in the slot, ties by term) and
    ``n_terms`` (distinct terms sharing the slot). Only the ranked slots (a
    bounded frame, broadcast) are matched; per slot the result is one
    aggregate row, never a list of all colliding terms.
    """
    slots = (importance.where(F.col("feature").startswith("hash_feature_"))
             .select("feature", F.substring_index("feature", "_", -1).cast("int").alias("index"))
             .distinct())
    totals = tf.groupBy("term").agg(F.sum("tf").alias("__n"))
    hashed = _slots(totals.withColumn("__w", F.array("term")), "__w", num_features).withColumn(
        "index", F.get("__tf.indices", F.lit(0)))
    named = (hashed.join(F.broadcast(slots), "index", "inner")
             .groupBy("feature")
             .agg(F.max_by("term", F.struct(F.col("__n"), F.col("term"))).alias("top_term"),
                  F.count(F.lit(1)).alias("n_terms")))
    return importance.join(named, "feature", "left")
