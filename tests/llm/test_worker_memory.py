"""What a Python worker holds between the pipeline's stages."""

from twinfold.llm import quality, shared
from twinfold.llm.bpe import worker_encoder
from twinfold.llm.queries import default_vocabulary


def test_other_stages_free_the_encoder(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    path = default_vocabulary()
    assert worker_encoder(path) is worker_encoder(path) and shared._KEPT
    tasks = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: tasks.append(run))
    quality.keep_quality(docs)
    assert list(tasks[0](iter([]))) == [] and not shared._KEPT
