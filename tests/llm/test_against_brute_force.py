"""Queries without SQL equal a plain version; trained ones are measured on held-out rows."""

import collections
import zlib

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute
from tests.util import duck


@pytest.fixture(scope="module")
def docs():
    return sorted(duck(SF_SMALL).execute("select doc_id, text, lang, source from documents").fetchall())


def result(spark, name, sf=SF_SMALL):
    return E.queries()[name](spark, sf).toPandas()


def test_substring_dedup(spark, docs):
    got = result(spark, "op2_substring_dedup").set_index("doc_id")
    for (i, *_), (n, gone, kept) in zip(docs, brute.substring_dedup([d[:2] for d in docs])):
        assert tuple(got.loc[i]) == (n, gone, brute.sha(kept))


def test_fingerprints(spark, docs):
    got = result(spark, "op3_document_fingerprints").set_index("doc_id")
    for n, (i, text, *_) in enumerate(docs):
        after = docs[(n + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        row = got.loc[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), brute.sha(edited))
        mine = brute.paragraphs(text)
        assert row.near_edited == pytest.approx(brute.likeness(mine, brute.paragraphs(edited)))
        assert row.near_next == pytest.approx(brute.likeness(mine, brute.paragraphs(after)))
    by_text = collections.defaultdict(set)
    for i, text, *_ in docs:
        by_text[text].add(got.loc[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_language_of_held_out_documents(spark):
    got = result(spark, "op4_language_id", SF_MID).set_index("doc_id")
    lang = duck(SF_MID).execute("select doc_id, lang from documents").df().set_index("doc_id").lang
    assert (got.held_out == [brute.crc_mod(i, 3) == 1 for i in got.index]).all()
    held = got[got.held_out]
    assert (held.lang_pred == lang[held.index]).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_near_dedup(spark, docs):
    want = brute.near_classes([d[:2] for d in docs])
    got = result(spark, "op6_near_dedup").set_index("doc_id")
    assert got.class_id.to_dict() == want
    size = collections.Counter(want.values())
    assert all(r.class_size == size[r.class_id] and r.kept == (i == r.class_id) for i, r in got.iterrows())


def test_url_verdicts(spark):
    got = result(spark, "op7_url_filter").set_index("page_id")
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    for i, url in duck(SF_SMALL).execute("select page_id, url from pages").fetchall():
        rest = (url or "").partition("://")[2]
        host = min((rest.split(c)[0] for c in "/?#"), key=len)
        path = min((rest[len(host):].split(c)[0] for c in "?#"), key=len)
        host = host.lower()
        fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
        row = got.loc[i]
        assert (row.host, row.path, row.rule) == (host, path, best and best[1] + best[2])
        assert row.verdict == (best[0] if best else "block" if row.score >= .5 else "allow")


def test_language_model(spark, docs):
    model = brute.Bigrams([t for i, t, *_ in docs if brute.crc_mod(i, 10)])
    got = result(spark, "op8_lm_scoring").set_index("doc_id")
    for i, text, *_ in docs:
        n, known, base, score = model.score(text)
        row = got.loc[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (not brute.crc_mod(i, 10), n, known, model.n)
        assert (row.base_score, row.score) == (pytest.approx(base), pytest.approx(score))
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    some = next(u for u in model.ctx if u)
    assert sum(model.p(some, w) for w in [*model.c, b"never seen"]) == pytest.approx(1)


def check_packing(got, docs):
    """Pieces equal the tokenizer's ids; sequences are gapless, within length and few."""
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, text in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        for k, (start, piece) in enumerate(brute.pieces(ids)):
            want[i, k, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert collections.Counter(map(tuple, got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))) == want
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == [0, *np.cumsum(seq.length)[:-1]] and seq.length.sum() <= 1024
    assert got.sequence_id.nunique() <= 1.01 * brute.best_fit(got.length.tolist()) + 1


def test_packing(spark, docs):
    check_packing(result(spark, "op9_best_fit_packing"), [d[:2] for d in docs])


def test_vector_codes(spark):
    rows = duck(SF_SMALL).execute("select vec_id, embedding from embeddings").fetchall()
    want, final = brute.vector_codes(rows)
    got = result(spark, "op12_vector_codes").set_index("vec_id")
    assert {i: (r.code, r.error) for i, r in got.iterrows()} == want
    assert set(got.codebooks_sha256) == {brute.sha(",".join(map(str, final)))}


def test_vector_packing(spark, docs):
    """Pieces hold the tokenizer's ids once each; no sequence needs padding."""
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = result(spark, "op13_vector_packing")
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t, *_ in docs}
    for i, mine in got.sort_values("start").groupby("doc_id"):
        assert mine.start.tolist() == [0, *np.cumsum(mine.length)[:-1]] and set(mine.doc_tokens) == {len(ids[i])}
        assert mine.length.sum() == len(ids[i])
        for r in mine.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][r.start:r.start + r.length], "<u4").tobytes())
    assert set(got.doc_id) == set(ids)
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq.offset.tolist() == [0, *np.cumsum(seq.length)[:-1]]
        total = seq.length.sum()
        assert total == 4096 or total & (total - 1) == 0 and total < 4096
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 4096) + 24


def test_pipeline(spark, docs):
    """Each stage against its plain version, on what its predecessor kept."""
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages, before = dict(corpus_pipeline.STAGES), docs
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    for name in list(stages)[:-1]:
        columns = frame.columns
        frame = stages[name](spark, frame, SF_SMALL)
        assert frame.columns == columns
        frame = spark.createDataFrame(frame.toPandas(), frame.schema)
        now = sorted((r.doc_id, r.text, r.lang, r.source) for r in frame.collect())
        texts = dict(d[:2] for d in before)
        if name == "language_id":
            assert [r[0] for r in now] == [i for i, t, *_ in before if any(c.isalpha() for c in t or "")]
        elif name == "exact_dedup":
            first = {}
            for i, t in sorted(texts.items()):
                first.setdefault(brute.normalised(t), i)
            assert [r[0] for r in now] == sorted(first.values())
        elif name == "near_dedup":
            assert [r[0] for r in now] == sorted(set(brute.near_classes(texts.items()).values()))
        else:
            assert {r[0] for r in now} <= set(texts)
            assert 0.6 * len(before) < len(now) < 1.4 * len(before)
        before = now
    got = stages["packing"](spark, frame, SF_SMALL).toPandas()
    check_packing(got, [d[:2] for d in before])
    whole = E.queries()["pipeline"](spark, SF_SMALL).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole[columns].itertuples(index=False))) == sorted(map(tuple, got[columns].itertuples(index=False)))
