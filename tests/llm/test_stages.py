import pytest

from panelcast.llm import collocations
from panelcast.llm.shared import BATCH_BYTES, BATCH_SETTING, components, small_batches
from panelcast.sources import storage


def test_batch_setting_is_put_back(spark):
    before = spark.conf.get(BATCH_SETTING, None)
    with pytest.raises(KeyError), small_batches(spark):
        assert spark.conf.get(BATCH_SETTING) == str(BATCH_BYTES)
        raise KeyError
    assert spark.conf.get(BATCH_SETTING, None) == before
    spark.conf.set(BATCH_SETTING, "12345678")
    with small_batches(spark):
        assert spark.conf.get(BATCH_SETTING) == str(BATCH_BYTES)
    assert spark.conf.get(BATCH_SETTING) == "12345678"
    spark.conf.unset(BATCH_SETTING)


def gone(path: str) -> bool:
    from pathlib import Path

    return not Path(path.removeprefix("file:")).exists()


def test_relations_are_deleted_when_the_next_is_written(spark, monkeypatch):
    made = []
    plain = storage.scratch_path
    monkeypatch.setattr(storage, "scratch_path", lambda s, name: made.append(plain(s, name)) or made[-1])
    docs = spark.createDataFrame([("a b c a b c d", "x")] * 4 + [(None, None)], "text string, lang string")
    found = collocations.collocations(docs, least=3).count()
    assert found > 0
    large = [p for p in made if "phrases-words" in p or "phrases-relation" in p]
    assert len(large) == 5 and all(map(gone, large))


def test_components_keep_only_their_last_round(spark, monkeypatch):
    made = []
    plain = storage.scratch_path
    monkeypatch.setattr(storage, "scratch_path", lambda s, name: made.append(plain(s, name)) or made[-1])
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    star = components(chain)
    assert {r.root for r in star.collect()} == {0} and star.count() == 40
    assert [gone(p) for p in made] == [True] * (len(made) - 1) + [False]
