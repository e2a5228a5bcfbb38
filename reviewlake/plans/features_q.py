"""Text-feature queries over all documents; Naive Bayes weights over the labelled ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import clean as C
from reviewlake.operators import features as X
from reviewlake.plans.registry import register, with_views
from reviewlake.schemas import STOP_WORDS_EN
from reviewlake.sources.tables import reviews, texts

VOCAB_SIZE = 5000
MIN_DF = 5

_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS_EN) + "]"
# Java's \s is [ \t\n\x0B\f\r]; written out for RE2.
_SPLIT = "'[ \\t\\n\\v\\f\\r]'"



def slots_sql(source: str, term: str, n: int) -> str:
    """CTEs ending in ``slots`` (term, slot): Murmur3 (32 bits, seed 42) of a term's bytes, modulo ``n``, as MLlib hashes."""
    m = "4294967295::UBIGINT"

    def mul(x: str, c: int) -> str:
        return f"(({x}) * {c}::UBIGINT) & {m}"

    def rotl(x: str, r: int) -> str:
        return f"((({x}) << {r}::UBIGINT) | (({x}) >> {32 - r}::UBIGINT)) & {m}"

    def mixed(x: str) -> str:                          # of a list of 32-bit words
        once = f"list_transform({x}, lambda k: {mul('k', 0xcc9e2d51)})"
        return f"list_transform({once}, lambda k: {mul(rotl('k', 15), 0x1b873593)})"

    step = f"({rotl('xor(a, k)', 13)}) * 5::UBIGINT + {0xe6546b64}::UBIGINT"
    return f"""h0 AS (SELECT DISTINCT {term} AS term, hex(encode({term})) AS x, octet_length(encode({term})) AS n FROM {source}),
h1 AS (SELECT term, n, x[8 * (n // 4) + 1:] AS t, list_transform(range(0, n // 4), lambda i:
         ('0x' || x[8 * i + 7:8 * i + 8] || x[8 * i + 5:8 * i + 6] || x[8 * i + 3:8 * i + 4] || x[8 * i + 1:8 * i + 2])::UBIGINT) AS b FROM h0),
h2 AS (SELECT term, n, [('0x0' || t[5:6] || t[3:4] || t[1:2])::UBIGINT] AS t,
              list_reduce(list_prepend(42::UBIGINT, {mixed('b')}), lambda a, k: ({step}) & {m}) AS h FROM h1),
h3 AS (SELECT term, xor(xor(h, ({mixed('t')})[1]), n::UBIGINT) AS h FROM h2),
h4 AS (SELECT term, {mul('xor(h, h >> 16::UBIGINT)', 0x85ebca6b)} AS h FROM h3),
h5 AS (SELECT term, {mul('xor(h, h >> 13::UBIGINT)', 0xc2b2ae35)} AS h FROM h4),
h6 AS (SELECT term, xor(h, h >> 16::UBIGINT)::BIGINT AS h FROM h5),
slots AS MATERIALIZED (SELECT term, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {n} + {n}) % {n} AS slot FROM h6)"""


_CORPUS = f"""
tok AS (SELECT event_id, LABEL AS label,
               list_filter(string_split_regex(lower(review_text), {_SPLIT}), lambda x: x <> '') AS words
        FROM VIEW WHERE review_text IS NOT NULL),
filt AS (SELECT event_id, label, words,
                list_filter(words, lambda x: NOT list_contains({_STOP}, lower(x))) AS fw FROM tok),
tf AS (SELECT event_id, term, count(*) AS tf
       FROM (SELECT event_id, unnest(fw) AS term FROM filt) u GROUP BY event_id, term),
vocab AS (SELECT term, term_count, doc_freq,
                 row_number() OVER (ORDER BY term_count DESC, term) - 1 AS rank
          FROM (SELECT term, sum(tf)::BIGINT AS term_count, count(*) AS doc_freq FROM tf
                GROUP BY term HAVING count(*) >= {MIN_DF}
                ORDER BY term_count DESC, term LIMIT {VOCAB_SIZE}) v),
m AS (SELECT count(*)::DOUBLE AS m FROM filt),
tfidf AS (SELECT tf.event_id, tf.term, tf.tf, ln((m.m + 1.0) / (vocab.doc_freq + 1.0)) AS idf,
                 tf.tf * ln((m.m + 1.0) / (vocab.doc_freq + 1.0)) AS weight
          FROM tf JOIN vocab ON tf.term = vocab.term, m)"""


def _sql(body: str, view: str = "texts", label: str = "0") -> str:
    s = with_views(body, view)
    head, rest = s.split("\n", 1)
    idx = rest.index(")\n") + 1
    return head + "\n" + rest[:idx] + "," + _CORPUS.replace("VIEW", view).replace("LABEL", label) + rest[idx:]


def corpus(spark, sf):
    """All documents with a text."""
    return texts(spark, sf).select("event_id", "review_text").where(F.col("review_text").isNotNull())


def labelled(spark, sf):
    """The review model frame with the 0/1 label (labelled documents, text not null)."""
    mf = C.model_frame(reviews(spark, sf))
    return mf.withColumn("label", F.when(F.col("label_text") == "positive", 1).otherwise(0))


def tf_frame(spark, sf):
    """(event_id, term, tf) over all documents."""
    return X.doc_terms(corpus(spark, sf))


def vocab_frame(spark, sf):
    return X.vocabulary(tf_frame(spark, sf), vocab_size=VOCAB_SIZE, min_df=MIN_DF)


@register("tokenize", _sql("""
SELECT event_id, generate_subscripts(words, 1) - 1 AS pos, unnest(words) AS token FROM tok"""))
def q_tokenize(spark, sf):
    t = X.tokenize(corpus(spark, sf))
    return t.select("event_id", F.posexplode("words").alias("pos", "token")).withColumn(
        "pos", F.col("pos").cast("long"))


@register("remove_stopwords", _sql("""
SELECT event_id, generate_subscripts(fw, 1) - 1 AS pos, unnest(fw) AS token FROM filt"""))
def q_remove_stopwords(spark, sf):
    toks = X.remove_stopwords(X.tokenize(corpus(spark, sf)))
    return toks.select("event_id", F.posexplode("filtered_words").alias("pos", "token")).withColumn(
        "pos", F.col("pos").cast("long"))


@register("vocabulary", _sql("SELECT term, term_count, doc_freq, rank FROM vocab"))
def q_vocabulary(spark, sf):
    return vocab_frame(spark, sf)


@register("idf", _sql("""
SELECT term, ln((m.m + 1.0) / (doc_freq + 1.0)) AS idf FROM vocab, m"""))
def q_idf(spark, sf):
    m = corpus(spark, sf).select(F.count(F.lit(1)).cast("double")).scalar()
    return vocab_frame(spark, sf).select(
        "term", F.log((m + 1.0) / (F.col("doc_freq") + 1.0)).alias("idf"))


@register("tfidf", _sql("SELECT event_id, term, tf, weight FROM tfidf"))
def q_tfidf(spark, sf):
    w = X.tfidf(tf_frame(spark, sf), vocab_frame(spark, sf), corpus(spark, sf))
    return w.select("event_id", "term", "tf", "weight")


@register("nb_theta", _sql("""
, w AS (SELECT t.term, sum(t.weight) FILTER (WHERE f.label = 0) AS w0,
               sum(t.weight) FILTER (WHERE f.label = 1) AS w1
        FROM tfidf t JOIN filt f ON t.event_id = f.event_id GROUP BY t.term)
, full_w AS (SELECT v.term, coalesce(w.w0, 0.0) AS w0, coalesce(w.w1, 0.0) AS w1
             FROM vocab v LEFT JOIN w ON v.term = w.term)
, tot AS (SELECT sum(w0) AS t0, sum(w1) AS t1, count(*)::DOUBLE AS V FROM full_w)
SELECT 0 AS label, term, ln((w0 + 1.0) / (t0 + 1.0 * V)) AS theta FROM full_w, tot
UNION ALL
SELECT 1, term, ln((w1 + 1.0) / (t1 + 1.0 * V)) FROM full_w, tot""",
    "reviews", "CASE WHEN sentiment = 'positive' THEN 1 ELSE 0 END").replace(
    "\n, w AS", ", w AS", 1))
def q_nb_theta(spark, sf):
    docs = labelled(spark, sf)
    tf = X.doc_terms(docs, keep=("label",))
    vocab = X.vocabulary(tf, vocab_size=VOCAB_SIZE, min_df=MIN_DF)
    return X.nb_theta(X.tfidf(tf, vocab, docs, keep=("label",)), vocab)


@register("hashing_tf", _sql(f""", {slots_sql("tf", "term", 20000)}
SELECT event_id, slot::INT AS "index", sum(tf)::DOUBLE AS tf FROM tf JOIN slots USING (term) GROUP BY ALL"""))
def q_hashing_tf(spark, sf):
    """Hashed counts of every document, 20,000 slots; the hash is recomputed in SQL."""
    return X.hashing_tf(X.remove_stopwords(X.tokenize(corpus(spark, sf))), num_features=20000)


@register("term_lookup", _sql("""
SELECT tf.event_id, vocab.rank AS "index", tf.tf FROM tf JOIN vocab ON tf.term = vocab.term"""))
def q_term_lookup(spark, sf):
    """Document-term counts indexed by vocabulary rank (relational CountVectorizer)."""
    return X.term_lookup(tf_frame(spark, sf), vocab_frame(spark, sf))
