"""Step parameters as texts give what typed ones give, in every registry."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.functions import imaging as I
from quillgrid.functions.params import kinds, typed
from quillgrid.operators import blocks
from quillgrid.plans.steps import Registry, Step


def test_readers():
    def f(df, a: int, b: float | None = None, c: bool = False, d: "list[int] | None" = None, e: str = "x", g=1.5):
        return a, b, c, d, e, g

    assert kinds(f) == {"a": "int", "b": "float", "c": "bool", "d": "list", "e": "str", "g": "float"}
    assert typed(f, {"a": "7.0", "b": " none", "c": "Y", "d": "[1, 2]", "e": "3", "g": "2", "other": "4"}) == {"a": 7, "b": None, "c": True, "d": [1, 2], "e": "3", "g": 2.0, "other": "4"}
    assert typed(f, {"a": 3.0, "b": 2, "c": False}) == {"a": 3, "b": 2, "c": False}
    with pytest.raises(ValueError, match="a is no int: seven"):
        typed(f, {"a": "seven"})


def test_images_and_blocks():
    img = np.full((60, 90), 255, np.uint8)
    img[20:23, 10:80] = img[40:50, 30:60] = 0
    for name, texts, values in (
        ("scale", {"width": "40", "height": "30"}, {"width": 40, "height": 30}), ("threshold", {"at": "100", "inverse": "true"}, {"at": 100, "inverse": True}), ("del_blank_set1", {"padding": "3"}, {"padding": 3}),
        ("separate_areas_set1", {"offset": "[5, 6]", "width": "20", "height": "-1"}, {"offset": [5, 6], "width": 20, "height": -1}), ("canny", {"low": "20", "high": "90"}, {"low": 20, "high": 90}),
    ):
        assert (I.step(img, name, texts, {}) == I.step(img, name, values, {})).all()
    one, two = {}, {}
    I.step(img, "calc_angle_set4", {"angle_key": "a", "limit": "2", "delta": "0.5"}, one)
    I.step(img, "calc_angle_set4", {"angle_key": "a", "limit": 2, "delta": 0.5}, two)
    assert one == two
    cut = lambda p: [(b.name, b.box, b.child) for b in blocks.cut(blocks.Block("b", (0, 0, 90, 60), img), [("split_image_by_left_ratio", p)])]
    assert cut({"split_ratio": "0.25", "angle": "0"}) == cut({"split_ratio": 0.25}) != cut({})


def test_registry(spark):
    r = Registry()

    @r.add("plus", by="int")
    def plus(df, by=1):
        return df.withColumn("id", F.col("id") + by)

    assert [x.id for x in r.run(spark.range(1), [Step("plus", {"by": "41"}), Step("plus")]).collect()] == [42]
