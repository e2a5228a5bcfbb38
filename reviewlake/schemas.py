"""Fixed schemas and constant value lists of the review lake."""

from pyspark.sql import types as T

# Event message value, as published by the producer (9 fields). event_id is a
# long here: an int field silently nulls on overflow under from_json.
REVIEW_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("app_id", T.IntegerType(), True),
    T.StructField("app_name", T.StringType(), True),
    T.StructField("review_text", T.StringType(), True),
    T.StructField("review_score", T.IntegerType(), True),
    T.StructField("review_votes", T.IntegerType(), True),
    T.StructField("sentiment", T.StringType(), True),
])

# Raw review CSV as read by the producer.
RAW_CSV_SCHEMA = T.StructType([
    T.StructField("app_id", T.StringType(), True),
    T.StructField("app_name", T.StringType(), True),
    T.StructField("review_text", T.StringType(), True),
    T.StructField("review_score", T.StringType(), True),
    T.StructField("review_votes", T.StringType(), True),
])

# Stream record as a message-bus source delivers it (file-stream stand-in).
RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

BRONZE_COLUMNS = ["kafka_key", "raw_json", "topic", "partition", "offset",
                  "kafka_timestamp", "ingest_time"]

SILVER_COLUMNS = [f.name for f in REVIEW_SCHEMA.fields] + ["event_time"]

# The two sentiment classes, in label-index order (alphabetical).
SENTIMENTS = ["negative", "positive"]

# Strings pandas.read_csv treats as missing by default.
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# The characters Python's str.strip() removes (str.isspace()).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# MLlib StopWordsRemover's default English list (181 words), in its order.
# The relational remover and the SQL oracle both use it; a test checks it against
# StopWordsRemover.loadDefaultStopWords("english").
STOP_WORDS_EN = [
    'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves', 'you', 'your', 'yours',
    'yourself', 'yourselves', 'he', 'him', 'his', 'himself', 'she', 'her', 'hers',
    'herself', 'it', 'its', 'itself', 'they', 'them', 'their', 'theirs', 'themselves',
    'what', 'which', 'who', 'whom', 'this', 'that', 'these', 'those', 'am', 'is', 'are',
    'was', 'were', 'be', 'been', 'being', 'have', 'has', 'had', 'having', 'do', 'does',
    'did', 'doing', 'a', 'an', 'the', 'and', 'but', 'if', 'or', 'because', 'as', 'until',
    'while', 'of', 'at', 'by', 'for', 'with', 'about', 'against', 'between', 'into',
    'through', 'during', 'before', 'after', 'above', 'below', 'to', 'from', 'up', 'down',
    'in', 'out', 'on', 'off', 'over', 'under', 'again', 'further', 'then', 'once', 'here',
    'there', 'when', 'where', 'why', 'how', 'all', 'any', 'both', 'each', 'few', 'more',
    'most', 'other', 'some', 'such', 'no', 'nor', 'not', 'only', 'own', 'same', 'so',
    'than', 'too', 'very', 's', 't', 'can', 'will', 'just', 'don', 'should', 'now', "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've",
    "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't",
    "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", 'cannot', 'could', "here's", "how's",
    "let's", 'ought', "that's", "there's", "what's", "when's", "where's", "who's", "why's",
    'would',]

# Display names used by the reports.
SCORE_LABELS = {1: "Positive (1)", -1: "Negative (-1)"}
METRIC_LABELS = {
    "area_under_roc": "AUC-ROC", "f1_score": "F1-Score", "accuracy": "Accuracy",
    "weighted_recall": "Recall", "weighted_precision": "Precision",
}
MODEL_SHORT_NAMES = {
    "Logistic Regression Existing": "LR", "Decision Tree Classifier": "DT",
    "Random Forest Classifier": "RF", "Gradient Boosted Trees Classifier": "GBT",
    "Naive Bayes": "NB",
    # this library's own names of the first and fourth
    "Logistic Regression": "LR", "GBT Classifier": "GBT",
}
