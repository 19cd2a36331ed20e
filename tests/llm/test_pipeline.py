import hashlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.test_copies import expected
from watchfold.llm import bpe, language, mixing
from watchfold.llm.common import table


def test_stages_equal_plain_versions(spark):
    docs = table(spark, SMALL, "documents")
    stage = dict(corpus_pipeline.STAGES)

    one = stage["language"](spark, docs, SMALL).cache()
    scored = language.predict(docs, language.fit_on(docs)).collect()
    want = {r.doc_id for r in scored if r.language.lang != "und" and r.language.score >= corpus_pipeline.LEAST_SCORE}
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == want

    two = stage["near_copies"](spark, one, SMALL).cache()
    lows = expected([(r.doc_id, r.text) for r in one.collect()])
    assert two.columns == docs.columns and sorted(r.doc_id for r in two.collect()) == lows

    three = stage["secrets"](spark, two, SMALL).cache()
    before = {r.doc_id: r.text for r in two.collect()}
    assert three.columns == docs.columns and three.count() == two.count()
    for r in three.collect():
        t = before[r.doc_id]
        assert r.n_chars == len(r.text)
        assert "[secret]" in r.text or r.text == t
        assert all(t[a:b] not in r.text for a, _, b in brute.secrets(t)[0])

    four = stage["mix"](spark, three, SMALL).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(three).collect() if r.copies}
    assert four.columns == docs.columns and Counter(r.doc_id for r in four.collect()) == copies

    text = {r.doc_id: r.text for r in three.collect()}
    coder = bpe.coder(bpe.default_ranks(), bpe.default_pattern())
    for r in stage["tokens"](spark, four, SMALL).collect():
        assert r.token_ids == coder.encode(text[r.doc_id])
        assert r.text_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_odd_and_empty_tables(spark):
    odd = brute.documents(spark, [None, "", "123", "a b c", "a b c d e"], [(3, "a b c", "en", None, 1)] * 3)
    wide = table(spark, SMALL, "documents").limit(60).unionByName(odd)
    empty = odd.limit(0)
    for docs in (wide, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns
            docs = out.cache()
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 0) == (docs.count() > 0)


HELPERS = (
    "_m _gap _step _before _assign _access _hex _token tokens base spans all row was_null h keys s id low root win first none "
    "node rest key left right words size_ part copies target print lang_ json a b"
).split()


def test_columns_named_like_helpers(spark):
    """Every stage keeps further columns, whatever their names and types."""
    plain = brute.documents(spark, ["the cat and the dog ran over the hill " * 3, "password = 'abcdefgh12345678'", None, "the cat and the dog ran over the hill " * 3])
    wide = plain
    for i, c in enumerate(HELPERS):
        wide = wide.withColumn(c, F.create_map(F.lit("k"), F.lit(i)) if i % 5 == 0 else F.lit(f"v{i}"))
    for name, stage in corpus_pipeline.STAGES:
        before = stage(spark, plain, SMALL).cache()
        after = stage(spark, wide, SMALL).cache()
        assert sorted(map(repr, after.select(*before.columns).collect())) == sorted(map(repr, before.collect())), name
        if name != "tokens":
            assert after.columns == wide.columns
            kept = {(r["_gap"], str(r["_m"]), r["lang_"]) for r in after.collect()}
            assert kept <= {("v1", "{'k': 0}", wide.first()["lang_"])}
