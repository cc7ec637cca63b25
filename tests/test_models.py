from graphlib import CycleError

import pytest

from tests.conftest import SMALL
from tidemark.plans.marts import MARTS, star_models
from tidemark.plans.models import Model, resolve, sql_models
from tidemark.plans.staging import STAGING
from workloads import domain, stores


def test_order_follows_from_names(spark):
    opened = []

    def source(name):
        return lambda: opened.append(name) or spark.range(10)

    models = [
        Model.sql("top", "SELECT max(id) AS m, count(*) AS n FROM {middle} JOIN {low} USING (id)"),
        Model.sql("middle", "SELECT id FROM {low} WHERE id % 2 = 0 UNION SELECT id FROM {low} WHERE id = 3"),
        Model("low", ("numbers",), lambda numbers: numbers.filter("id < 7")),
        Model("never", ("others",), lambda others: others),
    ]
    tables = resolve({"numbers": source("numbers"), "others": source("others")}, models, ["top"])
    assert list(tables) == ["top"]
    assert tables["top"].first() == (6, 5)
    assert opened == ["numbers"]


def test_errors(spark):
    sources = {"numbers": lambda: spark.range(1)}
    one = Model.sql("one", "SELECT * FROM {two}")
    with pytest.raises(KeyError, match="two is neither .* read by one"):
        resolve(sources, [one])
    with pytest.raises(CycleError):
        resolve(sources, [one, Model.sql("two", "SELECT * FROM {one}")])
    with pytest.raises(ValueError, match="twice"):
        resolve(sources, [Model.sql("numbers", "SELECT 1")])
    with pytest.raises(ValueError, match="twice"):
        resolve(sources, [one, one])
    with pytest.raises(ValueError, match="plain names"):
        Model.sql("bad", "SELECT * FROM {a.b}")
    assert resolve(sources, [Model.sql("curly", "SELECT '{{x}}' AS c")])["curly"].first()["c"] == "{x}"


def test_star_schema_from_named_sources(spark):
    sources = {name: (lambda name=name: stores.silver(spark, SMALL, name)) for name in domain.SILVER}
    tables = resolve(sources, star_models())
    assert set(tables) == {*STAGING, *MARTS}
    twice = Model.sql("dim_products_again", "SELECT product_id, name, category, price, stock FROM {stg_products}")
    both = resolve(sources, [twice, *star_models()], ["dim_products", "dim_products_again"])
    assert both["dim_products"].schema == both["dim_products_again"].schema
    assert both["dim_products"].exceptAll(both["dim_products_again"]).isEmpty()
    assert both["dim_products_again"].exceptAll(both["dim_products"]).isEmpty()


def test_models_in_files(tmp_path):
    (tmp_path / "b.sql").write_text("SELECT * FROM {a}")
    (tmp_path / "a.sql").write_text("SELECT 1 AS x")
    (tmp_path / "note.txt").write_text("not a model")
    assert [(m.name, m.reads) for m in sql_models(tmp_path)] == [("a", ()), ("b", ("a",))]
