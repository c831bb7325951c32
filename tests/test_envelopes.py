"""Extractions beside other objects in their envelope."""

import json

from loomset.operators.flatten import Flattened

IR = {"packages": [{"name": "A", "classes": [{"name": "C"}]}]}
OTHER = {"packages": [{"name": "B"}]}
FEED = {
    1: {"header": {"n": 1}, "ir": IR},
    2: {"ir": IR, "header": {"n": {"packages": 1}}},
    3: {"a": {"x": {"y": 1}}, "b": "{broken", "c": json.dumps({"d": "text", "e": {"f": 2}, "g": IR})},
    4: json.dumps({"header": "\"quoted", "z": json.dumps(IR)}),
    5: {"b": {"b": OTHER}, "c": IR},
    6: {"z": OTHER, "y": IR, "é": OTHER},
    7: {"a": {"b": {"c": {"d": {"e": IR}}}}},
    8: {"a": {"b": {"c": {"h": {}, "d": IR}}}},
    9: {"a": None, "b": [IR], "c": 1.5, "d": {}},
    10: "plain",
}


def test_all_values_of_an_envelope_are_searched(spark):
    deep = IR
    for k in range(60):
        deep = {"more": json.dumps(deep) if k % 20 == 0 else deep, "less": {"n": k}}
    rows = [(k, json.dumps(v)) for k, v in FEED.items()] + [(11, None), (12, "{broken"), (13, "null"), (14, ""), (15, json.dumps(deep)), (16, '{"packages": [{"name": "A", "x": 1e999, "classes": {"name": "\\ud800"}}]}'), (17, '{"packages": NaN}')]
    f = Flattened.text(spark.createDataFrame(rows, "id bigint, payload string"), "id", "payload", "packages")
    names = {r.rec_id: r.name for r in f.table("packages").collect()}
    assert names == dict.fromkeys([1, 2, 3, 4, 5, 6, 7, 8, 15, 16], "A")
    assert {r.rec_id for r in f.nodes["packages.classes"].collect()} == {1, 2, 3, 4, 5, 6, 7, 8, 15, 16}
