import pytest

from tradepanel.operators import models
from tradepanel.sources import model_versions, stores


def _rows(spark, slope):
    return spark.range(60).selectExpr("cast(id as double) a", "cast(id * id % 17 as double) b", f"cast({slope} * id + 1 as double) y")


def test_versions_are_numbered_and_pinned(spark, tmp_path):
    path = str(tmp_path)
    assert model_versions.manifests(spark, path).count() == 0
    with pytest.raises(ValueError, match="no published model"):
        model_versions.pinned(spark, path, "imports")
    for slope, number in ((3, 1), (5, 2)):
        model = models.fit(_rows(spark, slope), ["a", "b"], "y", "ols")
        assert model_versions.publish(spark, model, path, "imports", {"r2": slope / 10}) == number
    assert model_versions.publish(spark, model, path, "exports", {}) == 1
    rows = _rows(spark, 1)
    for version, slope in ((1, 3), (2, 5), (None, 5)):
        model, row = model_versions.pinned(spark, path, "imports", version, ["a", "b"])
        assert row["version"] == (version or 2) and row["metrics"] == {"r2": slope / 10} and row["features"] == ["a", "b"]
        got = [r["prediction"] for r in models.predict(model, rows).orderBy("a").collect()]
        assert got == pytest.approx([slope * i + 1 for i in range(60)], abs=1e-6)
    with pytest.raises(ValueError, match="version 9"):
        model_versions.pinned(spark, path, "imports", 9)
    with pytest.raises(ValueError, match="stored model wants"):
        model_versions.pinned(spark, path, "imports", 1, ["b", "a"])


def test_a_model_without_manifest_is_not_seen(spark, tmp_path):
    path = str(tmp_path)
    model = models.fit(_rows(spark, 3), ["a", "b"], "y", "ols")
    stores.save_model(model, f"{path}/models/imports-broken")
    assert model_versions.manifests(spark, path).count() == 0
    with pytest.raises(ValueError, match="no published model"):
        model_versions.pinned(spark, path, "imports")
    with pytest.raises(ValueError, match="letters"):
        model_versions.publish(spark, model, path, "a/b", {})


def test_the_second_of_two_writers_gets_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    model = models.fit(_rows(spark, 3), ["a", "b"], "y", "ols")
    none = model_versions.manifests(spark, path)
    assert model_versions.publish(spark, model, path, "imports", {}) == 1
    monkeypatch.setattr(model_versions, "manifests", lambda *_: none)
    with pytest.raises(Exception, match="already exists"):
        model_versions.publish(spark, model, path, "imports", {})
