from pyspark.sql import functions as F

from earshot.llm import language
from tests.llm.helpers import DOCS


def test_every_language_is_learned(spark):
    rows = [(i, f"word {i} of its own", f"l{i % 300:03}", "a", 20) for i in range(600)] + [(999, "no name", None, "a", 7)]
    network = language.train(spark.createDataFrame(rows, DOCS), F.lit(True), sample=2, epochs=1)
    assert network.languages == [f"l{i:03}" for i in range(300)]


def test_the_sample_goes_by_the_hash_of_the_id(spark, monkeypatch):
    rows = [(i, f"{i} is the number", "en", "a", 20) for i in range(4000)]
    seen = []
    monkeypatch.setattr(language.Network, "fit", lambda self, windows, target, epochs: seen.extend(windows))
    language.train(spark.createDataFrame(rows, DOCS), F.lit(True), sample=800)
    ids = {int(bytes(w).split()[0]) for w in seen if b"is the" in bytes(w) and bytes(w)[:1].isdigit()}
    assert max(ids) > 3900 and len([i for i in ids if i >= 2000]) > 250
