"""Property tests for the text primitives (F13, F14) with generated strings."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import Tokenizer

from reviewlake.functions.exprs import strip_py, tokens_expr

# whitespace Python and Java disagree on, plus ordinary characters
ALPHABET = list(" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u2003\u3000abZ.\u00e9")
texts = st.lists(st.text(alphabet=st.sampled_from(ALPHABET), max_size=12), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(texts)
def test_strip_py_equals_python_strip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r.t for r in df.select("i", strip_py("s").alias("t")).orderBy("i").collect()]
    assert got == [v.strip() for v in values]


@settings(max_examples=8, deadline=None)
@given(texts)
def test_parity_tokenizer_equals_mllib(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, review_text string")
    ours = df.select("i", tokens_expr("review_text", keep_empty=True).alias("w")).orderBy("i")
    mllib = Tokenizer(inputCol="review_text", outputCol="w").transform(df).select("i", "w").orderBy("i")
    assert [r.w for r in ours.collect()] == [r.w for r in mllib.collect()]
    clean = df.select(tokens_expr("review_text").alias("w")).collect()
    assert all("" not in r.w for r in clean)
