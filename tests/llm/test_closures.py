"""What operators send to workers: small closures, whatever was computed on the driver before."""

import numpy as np
import public_tokenizers as vocabularies
import pytest
from pyspark import cloudpickle
from pyspark.sql.classic.dataframe import DataFrame

from sonomere.llm import byte_bpe, crf, language_id, near_dups, periodic_runs, quality, warc
from sonomere.llm.batches import sequence_hashes

MODEL = crf.Model(["a", "b"], np.zeros((1 << 18, 2), np.float32), np.zeros((2, 2)))
OPERATORS = {
    "language": lambda df, path: language_id.identify(df, MODEL),
    "main language": lambda df, path: language_id.with_main_language(df, MODEL, 0.4),
    "quality": lambda df, path: quality.judge(df, MODEL),
    "periodic runs": lambda df, path: periodic_runs.find_periodic_runs(df),
    "bpe": lambda df, path: byte_bpe.encode(df, vocabularies.path("byte_bpe_multi_50k.tiktoken"), vocabularies.PATTERN),
    "near copies": lambda df, path: near_dups.near_duplicates(df, percent=80),
    "archives": lambda df, path: warc.write_archives(df, path, "doc_id", "source", "text", "key"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_closures_stay_small(odd, tmp_path, monkeypatch, name):
    sequence_hashes(np.arange(1 << 20).astype(np.uint64), np.array([0]), np.array([1 << 20]))
    sizes, plain = [], DataFrame.mapInArrow

    def measured(self, func, *args, **kwargs):
        sizes.append(len(cloudpickle.dumps(func)))
        return plain(self, func, *args, **kwargs)

    monkeypatch.setattr(DataFrame, "mapInArrow", measured)
    OPERATORS[name](odd, str(tmp_path))
    assert sizes and max(sizes) < 100_000


def test_a_model_is_fitted_by_one_task(spark):
    sample = spark.createDataFrame([(1, "A plain line of words."), (0, "a | b | c")] * 5, "quality int, text string")
    found, here = crf.fit_in_a_task(sample, quality.fit), quality.fit(sample.toArrow())
    assert found.labels == here.labels and np.array_equal(found.weights, here.weights)
    assert crf.fit_in_a_task(sample.limit(0), quality.fit) is None
