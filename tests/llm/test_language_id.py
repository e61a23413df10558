"""Language identification: held-out accuracy, code-switched words, texts without letters."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sonomere.llm import language_id, queries
from sonomere.llm.batches import hashes
from tests.llm.conftest import ODD, table, words_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return language_id.learn(documents, ~language_id.held_out(), per_language=60)


def test_held_out_accuracy(documents, model):
    found = language_id.identify(documents, model).join(documents.select("doc_id", "lang"), "doc_id")
    row = found.filter(language_id.held_out()).agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count("*").alias("n"),
        F.min("score").alias("low"), F.max("score").alias("high"),
    ).first()
    assert row.n > 200 and row.right > 0.98 and 0 <= row.low <= row.high <= 1


def test_code_switched_words(spark, documents, model):
    halves = [documents.filter(f"lang = '{x}' AND n_chars BETWEEN 500 AND 3000 AND NOT text RLIKE '[|#$]'").first().text for x in ("en", "fr")]
    words = [" ".join(h.split()[:60]) for h in halves]
    rows = [(1, " ".join(words), None), (2, words[0], None), (3, words[1], None)]
    found = {r.doc_id: r for r in language_id.identify(table(spark, rows), model).collect()}
    shares = dict(zip(model.labels, found[1].shares))
    assert 0.4 < shares["en"] < 0.6 and 0.4 < shares["fr"] < 0.6
    assert found[2].lang_pred == "en" and found[3].lang_pred == "fr"


def test_odd_documents(spark, odd, none, model):
    found = language_id.identify(odd, model).collect()
    assert len(found) == len(ODD)
    for r in found:
        texts = [t for i, t, *_ in ODD if i == r.doc_id]
        lettered = [any(c.isalpha() for c in t or "") for t in texts]
        if not any(lettered):
            assert (r.lang_pred, r.score, r.shares) == ("und", 0.0, None)
        elif all(lettered):
            assert r.lang_pred in model.labels and 0 < r.score <= 1
    assert language_id.identify(none, model).count() == 0
    kept = language_id.with_main_language(odd, model, 0.0)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {None, 4, 5, 6, 7, 8, 9, 11}


def test_without_labels(spark, odd, none):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.learn(unlabelled, F.lit(True)) is None
    assert language_id.learn(none, F.lit(True)) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}
    assert language_id.with_main_language(odd, None, 0.5).count() == 9


def test_held_out_rows_teach_nothing(spark, documents):
    wrong = documents.withColumn("lang", F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    model = language_id.learn(wrong, ~language_id.held_out(), per_language=5)
    assert model.labels == ["de", "en", "es", "fr"]


def test_query(spark):
    found = queries.op5_crf_language_id(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == 200


def plain_lexicon(rows, entries):
    uses = {}
    for _, text, lang in rows:
        if text is not None and lang is not None:
            for word in words_of(text):
                uses.setdefault(word, Counter())[lang] += 1
    own = []
    for word, langs in uses.items():
        top = max((n, lang) for lang, n in langs.items())
        if langs.total() >= language_id.LEXICON_USES and top[0] >= language_id.LEXICON_SHARE * langs.total():
            own.append((word, top[1], langs.total()))
    return own if len(own) <= entries else sorted(own, key=lambda x: -x[2])[:entries]


def hashes_of(words):
    data = [w.encode() for w in words]
    joined = np.frombuffer(b" ".join(data), np.uint8)
    stop = np.cumsum([len(d) + 1 for d in data]) - 1
    return hashes(joined, stop - [len(d) for d in data], stop)


def test_lexicon_counts_all_texts(spark, odd):
    rng = random.Random(2)
    words = {"en": ["the", "of", "THE"], "fr": ["le", "été", "de"], "de": ["der", "de", "über"]}
    rows = [(i, " ".join(rng.choices(words[x] + ["0", "in"], k=30)), x) for i in range(60) for x in words]
    rows += [(99, None, "en"), (98, "once only", "en"), (97, "le le le le", None)]
    known, owner, names = language_id.lexicon(table(spark, rows).repartition(3))
    wanted = plain_lexicon(rows, 1 << 16)
    assert {w for w, _, _ in wanted} >= {"the", "le", "été", "über"} and "0" not in {w for w, _, _ in wanted}
    found = dict(zip(known.tolist(), (names[i] for i in owner)))
    assert found == dict(zip(hashes_of([w for w, _, _ in wanted]).tolist(), (x for _, x, _ in wanted)))
    assert np.all(known[1:] > known[:-1])
    few, _, _ = language_id.lexicon(table(spark, rows), entries=2)
    assert set(few.tolist()) == set(hashes_of([w for w, _, _ in plain_lexicon(rows, 2)]).tolist())
    assert len(language_id.lexicon(odd.filter("doc_id < 0"))[0]) == 0


def test_lexicon_is_learnt_from_and_used(spark, documents, model):
    assert len(model.extra[0]) > 1000 and model.extra[2] == ["de", "en", "es", "fr"]
    held = documents.withColumn("text", F.when(language_id.held_out(), F.lit("zzyzx " * 50)).otherwise(F.col("text")))
    again = language_id.lexicon(held.filter(~language_id.held_out()))
    assert hashes_of(["zzyzx"])[0] not in again[0]
    # A word that only the lexicon knows leans to its language.
    word, code = model.extra[0], model.extra[1]
    text = pa.array(["qqqq vvvv"])
    plain = language_id._labelled(model, text)[0][0]
    added = np.append(word, hashes_of(["qqqq", "vvvv"]))
    order = np.argsort(added)
    for i, name in enumerate(model.extra[2]):
        codes = np.append(code, [i, i])[order]
        told = language_id.replace(model, extra=(added[order], codes, model.extra[2]))
        share = language_id._labelled(told, text)[0][0]
        assert share[model.labels.index(name)] > plain[model.labels.index(name)]
