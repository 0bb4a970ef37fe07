"""Paths of relations: joins once each, aliases, ways, conditions over many rows."""

import re

import pytest

import __spark_entry__
from quillgrid.operators.relations import Relations


@pytest.fixture
def shop(spark):
    people = spark.createDataFrame([(1, "ann", 10, None), (2, "bob", 20, 1), (3, "cid", None, 1)], "id int, name string, city int, boss int")
    cities = spark.createDataFrame([(10, "Rome"), (20, "Oslo")], "id int, name string")
    pets = spark.createDataFrame([(1, "cat"), (1, "dog"), (2, "cat")], "owner int, kind string")
    r = Relations({"person": people, "city": cities, "pet": pets})
    return r.add("person", "city", "city", "id").add("person", "boss", "person", "id", name="boss", back="staff").add("pet", "owner", "person", "id", name="owner", back="pets")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_paths_and_nulls(shop):
    assert rows(shop.of("person").sort("name").select("name", "city.name", "boss.name", "boss.city.name")) == [("ann", "Rome", None, None), ("bob", "Oslo", "ann", "Rome"), ("cid", None, "ann", "Rome")]
    assert rows(shop.of("person").sort("-city.name", "-name").select("name")) == [("ann",), ("bob",), ("cid",)]
    assert rows(shop.of("person").where("city.name", "neq", "Rome").sort("name").select("name")) == [("bob",), ("cid",)]
    assert rows(shop.of("person").where("city.name", "null", True).select("name")) == [("cid",)]
    assert rows(shop.of("pet").where("owner.boss.city.name", "starts", "ro").select("kind", "owner.name")) == [("cat", "bob")]


def test_many(shop):
    assert rows(shop.of("person").where("pets.kind", "eq", "dog").select("name")) == [("ann",)]
    assert rows(shop.of("person").where("pets.kind", "neq", "dog").sort("name").select("name")) == [("bob",), ("cid",)]
    assert rows(shop.of("person").where("boss.pets.kind", "in", ["dog", "cow"]).sort("name").select("name")) == [("bob",), ("cid",)]
    assert rows(shop.of("city").where("person.pets.kind", "contains", "CA").sort("name").select("name")) == [("Oslo",), ("Rome",)]
    with pytest.raises(ValueError, match="many values"):
        shop.of("person").select("pets.kind")


def test_what_cannot_be_named(shop):
    with pytest.raises(KeyError, match="no column"):
        shop.of("person").select("city.size")
    with pytest.raises(KeyError, match="no way"):
        shop.of("city").where("owner.name", "eq", "x")
    with pytest.raises(ValueError, match="unknown condition"):
        shop.of("person").where("name", "like", "x")
    with pytest.raises(ValueError, match="two relations named"):
        shop.add("person", "id", "city", "id")


def test_shortest_way_and_two_ways(spark):
    t = lambda cols: spark.createDataFrame([], ", ".join(f"{c} int" for c in cols))
    r = Relations({"a": t(["id", "b", "c"]), "b": t(["id", "d"]), "c": t(["id", "d", "e"]), "d": t(["id", "e"]), "e": t(["id"])})
    r.add("a", "b", "b", "id").add("a", "c", "c", "id").add("b", "d", "d", "id").add("c", "d", "d", "id", back="c_of_d").add("d", "e", "e", "id").add("c", "e", "e", "id", back="c_of_e")
    assert [e.name for e in r.steps("a", "e")] == ["c", "e"]
    with pytest.raises(ValueError, match="b.d or c.d"):
        r.steps("a", "d")


def test_each_relation_is_joined_once(spark):
    plan = __spark_entry__.queries()["relation_paths"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bJoin\b", plan)) == 6 and len(re.findall("Relation ", plan)) == 7
